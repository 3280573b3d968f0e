"""URL filters: host and path rules first, a weighted vocabulary for the rest.

One Aho-Corasick automaton counts vocabulary terms in the lower-cased url, only where the term is
not part of a longer run of letters and digits. One strict term, or several different soft ones,
reject the url.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, values

STRICT = ("casino", "gambling", "jackpot", "poker", "porn", "sex", "viagra", "xxx")
SOFT = ("ads", "adult", "bet", "bets", "bonus", "cheap", "click", "dating", "deal", "free", "loan", "pills", "promo",
        "slots", "track", "win")
SOFT_LIMIT = 2
MOST_TERMS = 1_000_000
# (host and path, verdict); the host comes before the first slash
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
_UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): both empty for null or without ``://``. A-Z in the host is lower-cased."""
    found = _PARTS.search(url or "")
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


class Rules:
    """Rules by host. A rule fits its host and all subdomains if the path starts with its path."""

    def __init__(self, rules: Sequence[tuple[str, str]]) -> None:
        self.by_host: dict[str, list] = {}
        for rule, verdict in rules:
            if verdict not in ("allow", "block") or "/" not in rule:
                raise ValueError(f"not a rule: {rule!r} {verdict!r}")
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host.translate(_UPPER), []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the longest rule that fits; of equal ones the first by code point."""
        labels, fits = host.split("."), []
        for at in range(len(labels)):
            for start, rule, verdict in self.by_host.get(".".join(labels[at:]), ()):
                if path.startswith(start):
                    fits.append((-len(rule), rule, verdict))
        return min(fits)[1:] if fits else (None, None)


class Vocabulary:
    """Strict terms, one of which rejects, and soft terms with a weight each.

    Soft terms reject if two or more different ones are there and their weights, each counted
    once, add up to ``soft_limit``.
    """

    def __init__(self, strict: Iterable[str], soft: Mapping[str, int], soft_limit: int) -> None:
        self.soft_limit, self.automaton = soft_limit, ahocorasick.Automaton()
        self.weights = {t.translate(_UPPER): w for t, w in soft.items()}
        for term in strict:  # a term of both is strict
            self.weights[term.translate(_UPPER)] = 0
        if "" in self.weights or any(w < 1 for w in soft.values()):
            raise ValueError("a term has one character at least, a soft one a weight of 1 at least")
        for term in self.weights:
            self.automaton.add_word(term, term)
        self.automaton.make_automaton()

    def hits(self, url: str | None) -> Counter:
        """How often each term stands in the url with a boundary on both sides."""
        found: Counter = Counter()
        if url and len(self.automaton):
            low = url.translate(_UPPER)
            for end, term in self.automaton.iter(low):
                start = end - len(term) + 1
                if not (start and _inner(low[start - 1])) and not (end + 1 < len(low) and _inner(low[end + 1])):
                    found[term] += 1
        return found

    def is_strict(self, term: str) -> bool:
        return self.weights[term] == 0

    def blocks(self, found: Iterable[str]) -> bool:
        weights = [self.weights[t] for t in found]
        return 0 in weights or (len(weights) > 1 and sum(weights) >= self.soft_limit)


def read_vocabulary(terms: DataFrame, soft_limit: int = SOFT_LIMIT) -> Vocabulary:
    """A vocabulary from a table (term, weight): weight 0 or null marks a strict term.

    Of a term that is listed often the strict row counts, else the largest weight. Every task
    holds the whole vocabulary, so one of more than ``MOST_TERMS`` terms is refused.
    """
    weight = F.coalesce(F.col("weight").cast("int"), F.lit(0))
    term = F.translate("term", string.ascii_uppercase, string.ascii_lowercase)
    rows = terms.filter("term is not null").groupBy(term.alias("term")).agg(F.min(weight).alias("low"), F.max(weight).alias("high"))
    rows = rows.limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    return Vocabulary([r.term for r in rows if r.low == 0], {r.term: r.high for r in rows if r.low}, soft_limit)


def _inner(c: str) -> bool:
    return c.isascii() and c.isalnum()


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, vocabulary: Vocabulary | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict, hits) per row; hits are (term, n, strict), by term.

    A fitting rule decides, else the vocabulary (by default the terms above, soft ones of weight
    1). A null or empty url has no host, path or hit and is allowed. Only page_id and url are
    read; rows are judged one by one, repeated ones too.
    """
    known, terms = Rules(rules), vocabulary or Vocabulary(STRICT, dict.fromkeys(SOFT, 1), SOFT_LIMIT)
    held = pages.sparkSession.sparkContext.broadcast((terms.weights, terms.soft_limit))

    def work(batches):
        weights, limit = held.value
        terms = Vocabulary([t for t, w in weights.items() if not w], {t: w for t, w in weights.items() if w}, limit)
        hit = pa.struct([("term", pa.string()), ("n", pa.int64()), ("strict", pa.bool_())])
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for url in values(batch.column("url")):
                host, path = split_url(url)
                rule, verdict = known.find(host, path)
                found = terms.hits(url)
                verdict = verdict or ("block" if terms.blocks(found) else "allow")
                listed = [{"term": t, "n": n, "strict": terms.is_strict(t)} for t, n in sorted(found.items())]
                for col, value in zip(cols, (host, path, rule, verdict, listed)):
                    col.append(value)
            kinds = [pa.string()] * 4 + [pa.list_(hit)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["page_id", "host", "path", "rule", "verdict", "hits"],
            )

    schema = "page_id long, host string, path string, rule string, verdict string"
    schema += ", hits array<struct<term: string, n: long, strict: boolean>>"
    return map_rows(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")), schema, work)
