"""Divergence of sources against a plain count."""

import random
import re
from collections import Counter, defaultdict

import pytest
from brute import SCHEMA, frame
from pyspark.sql import functions as F

from tidemark.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3, most=200):
    docs = [(lang or "", source or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for *_, w in own for t in set(w))
        kept = sorted(t for t, n in held.items() if n >= least)
        cnt = defaultdict(Counter)
        for _, source, w in own:
            cnt[source].update(t for t in w if held[t] >= least)
        total = sum(cnt.values(), Counter())

        def shares(c):
            n = c.total() + len(kept)
            return [1 + 10**9 * (c[t] + 1) // n for t in kept]

        q = shares(total)
        p = {s: shares(c) for s, c in cnt.items()}
        for s in p:
            pairs = [(-sum((x - y) ** 2 // y for x, y in zip(p[s], p[o])), o) for o in p if o != s]
            over = [(-((x - y) ** 2 // y), t) for x, y, t in zip(p[s], q, kept) if cnt[s][t] and x > y]
            for part, found, end in (("pair", pairs, None), ("term", over, most)):
                found.sort(key=lambda f: (f[0], f[1].encode()))
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(found[:end])}
    return out


def audited(docs, **options):
    rows = [tuple(r) for r in divergence.audit(docs, **options).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def corpus(seed, n=400):
    chance = random.Random(seed)
    words = ["the", "The", "of", "Éa", "éa", "ß", "𝒳", "x1y", "don't"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(9)]
    texts = [" ".join(chance.choices(words, weights=[9] * 9 + [1] * 180, k=chance.randint(0, 60))) for _ in range(n // 2)]
    return [(i, chance.choice(texts), chance.choice(["en", "de"]), f"s{min(chance.randint(0, 9), chance.randint(0, 9))}") for i in range(n)]


def test_against_a_plain_count(spark):
    rows = corpus(1)
    assert audited(frame(spark, rows)) == brute(rows)
    assert audited(frame(spark, rows), least_docs=40, most=3) == brute(rows, 40, 3)


@pytest.mark.parametrize("name,value", [("HELD", 50), ("BLOCK", 3), ("CELLS", 40)])
def test_bounds_change_nothing(spark, monkeypatch, name, value):
    rows = corpus(2, 200)
    if name == "BLOCK":
        profile = divergence.Profile(frame(spark, rows))
        sums = [
            {tuple(r) for r in divergence.shared_terms(profile.counts, profile.groups, b).groupBy("lang", "idx_a", "idx_b")
             .agg(F.sum("x")).collect()} for b in (value, 512)]
        assert sums[0] == sums[1] and len(sums[0]) > 50
    else:
        monkeypatch.setattr(divergence, name, value)
        assert audited(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    """Nulls, a language with one source, groups without terms, copies, one id twice, a very long text."""
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i % 7)}" for i in range(200_000))
    rows = [
        (1, None, "en", "a"), (2, "", "en", "b"), (3, "one two", None, None), (4, "one two", None, None), (4, "one TWO", None, "z"),
        (5, "one three one", "", ""), (6, "12 34", "fr", "a"), (7, "12 34", "fr", "b"), (8, "uno", "es", "a"), (8, "uno", "es", "a"),
        (9, "uno dos", "es", "a"), (10, long, "de", "x"), (11, long, "de", "y"), (12, long, "de", "y"), (13, "w", "de", "x"),
        (None, None, None, "q"), (None, "one", None, "q"),
    ]
    docs = frame(spark, rows)
    for name in ("th", "term", "copies", "idx", "p", "p0", "q", "n", "v", "cnt", "item", "rank", "value", "block"):
        docs = docs.withColumn(name, F.lit("x"))
    got = audited(docs)
    assert got == brute(rows)
    assert ("fr", "a", "pair", "b", 0, 1) in got and not any(r[0] == "es" and r[2] == "pair" for r in got)
    assert audited(spark.createDataFrame([], SCHEMA)) == set()


def test_texts_are_split_once(spark):
    """Copies of a text, in whatever source, come as one row with a count per source."""
    rows = [(i, "same text here", "en", f"s{i % 3}") for i in range(90)] + [(99, "same text here", "de", "s0")]
    texts, groups = divergence.folded(frame(spark, rows))
    found = {r.lang: sorted((c.source, c.n) for c in r.copies) for r in texts.collect()}
    assert found == {"en": [("s0", 30), ("s1", 30), ("s2", 30)], "de": [("s0", 1)]} and groups.count() == 4
