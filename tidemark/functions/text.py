"""News text: ticker matching, word-list and substring sentiment, ticker lists."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: words of the lexicon sentiment
POSITIVE_WORDS = (
    "bullish", "growth", "profit", "surge", "gain", "rise",
    "positive", "beat", "upward", "boost", "success", "higher",
)
NEGATIVE_WORDS = (
    "bearish", "loss", "fall", "drop", "decline", "negative",
    "miss", "downward", "slump", "crash", "plunge", "lower",
)

# fixed values: fragments of the substring sentiment
POSITIVE_FRAGMENTS = ("up", "growth", "gain", "profit", "beat", "surge", "success")
NEGATIVE_FRAGMENTS = ("down", "loss", "decline", "fail", "slump", "warn", "crash")

# fixed values: keywords that name a ticker in an article
TICKER_KEYWORDS: dict[str, tuple[str, ...]] = {
    "AAPL": ("apple", "aapl"),
    "MSFT": ("microsoft", "msft"),
    "GOOGL": ("google", "googl", "alphabet"),
    "AMZN": ("amazon", "amzn"),
    "NVDA": ("nvidia", "nvda"),
    "META": ("meta", "facebook", "instagram"),
    "TSLA": ("tesla", "tsla"),
    "LLY": ("eli lilly", "lilly", "lly"),
    "V": ("visa",),
    "UNH": ("unitedhealth", "unh", "united health"),
    "JPM": ("jpmorgan", "chase", "jp morgan", "jpm"),
    "JNJ": ("johnson & johnson", "jnj", "johnson and johnson"),
    "WMT": ("walmart", "wmt"),
    "XOM": ("exxon", "mobil", "xom", "exxonmobil"),
    "PG": ("procter", "gamble", "p&g", "pg"),
    "AVGO": ("broadcom", "avgo"),
    "HD": ("home depot", "hd"),
    "CVX": ("chevron", "cvx"),
    "ORCL": ("oracle", "orcl"),
    "MRK": ("merck", "mrk"),
    "KO": ("coca-cola", "coke", "ko"),
    "ABBV": ("abbvie", "abbv"),
    "PEP": ("pepsi", "pep"),
    "COST": ("costco", "cost"),
    "BAC": ("bank of america", "bac", "bofa"),
    "ADBE": ("adobe", "adbe"),
    "MCD": ("mcdonald", "mcd"),
    "CSCO": ("cisco", "csco"),
    "AMD": ("amd", "ryzen"),
    "NFLX": ("netflix", "nflx"),
    "CRM": ("salesforce", "crm"),
    "TMO": ("thermo fisher", "tmo"),
    "ABT": ("abbott", "abt"),
    "NKE": ("nike", "nke"),
    "DIS": ("disney", "dis"),
    "BTC": ("bitcoin", "btc"),
    "ETH": ("ethereum", "eth"),
    "SOL": ("solana", "sol"),
}

SENTIMENT_COLUMNS = ("sentiment_pos", "sentiment_neg", "sentiment_neu", "sentiment_net")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def article_text(title: str | Column, description: str | Column) -> Column:
    empty = F.lit("")
    return F.lower(
        F.concat_ws(" ", F.coalesce(_col(title), empty), F.coalesce(_col(description), empty))
    )


def _pattern(words: Sequence[str]) -> str:
    """Any of the words at a word's start, the longest first; words are grouped by first letter, so
    that a place in the text is held against few of them. What is found is group 1."""
    groups: dict[str, list[str]] = {}
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        groups.setdefault(word[:1], []).append(word[1:])
    quoted = lambda w: r"\Q" + w + r"\E" if w else ""
    options = "|".join(quoted(first) + "(?:" + "|".join(map(quoted, rest)) + r")\b" for first, rest in groups.items())
    return rf"(?U)\b(?=({options}))"


def _whole_prefix(short: str, long: str) -> bool:
    return re.match(re.escape(short) + r"\b", long) is not None


def keyword_tickers(text: Column, keywords: Mapping[str, Sequence[str]]) -> Column:
    """Tickers that a keyword names as whole words in the lower-cased text, found in one scan.

    The scan looks ahead from each word's start and so also finds words that overlap. Where one
    keyword goes on as another, the longer is found and the literal map adds the shorter."""
    meant = {w: [t for t, own in keywords.items() if any(_whole_prefix(k, w) for k in own)]
             for own in keywords.values() for w in own}
    if not meant:
        return F.array().cast("array<string>")
    named = F.create_map(*[x for w, ts in meant.items() for x in (F.lit(w), F.array(*map(F.lit, ts)))])
    hits = F.array_distinct(F.regexp_extract_all(text, F.lit(_pattern(list(meant))), F.lit(1)))
    return F.flatten(F.transform(hits, lambda w: F.element_at(named, w)))


def match_tickers(
    title: str | Column,
    description: str | Column,
    query_tickers: Column,
    keywords: Mapping[str, Sequence[str]] = TICKER_KEYWORDS,
) -> Column:
    """Candidates named as whole words in the article, in candidate order, comma-joined.

    ``query_tickers`` is an array. A candidate without keywords is named by its own symbol; no
    match at all means every candidate. The article is scanned once for all keywords with one
    literal pattern, compiled once for the job; only other candidates need one of their own.
    """
    own = lambda t: F.concat(F.lit(r"(?U)\b\Q"), F.lower(t), F.lit(r"\E\b"))

    def named(ticker: Column, row: Column) -> Column:
        by_name = F.rlike(row["text"], own(ticker))
        if not keywords:
            return by_name
        by_keyword = F.coalesce(F.array_contains(row["found"], ticker), F.lit(False))
        return F.when(ticker.isin(*keywords), by_keyword).otherwise(by_name)

    # an array of one struct binds its fields, so that they are computed once, not per candidate
    row = F.array(F.struct(article_text(title, description).alias("text"), query_tickers.cast("array<string>").alias("asked")))
    row = F.transform(row, lambda r: F.struct(
        r["text"].alias("text"), r["asked"].alias("asked"), keyword_tickers(r["text"], keywords).alias("found")))
    hits = F.transform(row, lambda r: F.filter(r["asked"], lambda t: named(t, r)))[0]
    return F.array_join(F.when(F.size(hits) > 0, hits).otherwise(query_tickers.cast("array<string>")), ",")


def lexicon_sentiment(
    text: str | Column,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> Column:
    """Struct (label, score) from the distinct words of a text; ties with any hit are negative."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(_col(text), F.lit(""))), r"(?U)\s+"))
    up = F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in positive]))).cast("double")
    down = F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in negative]))).cast("double")
    total = up + down
    label = F.when(total == 0, "Neutral").when(up > down, "Positive").otherwise("Negative")
    score = F.when(total == 0, 1.0).otherwise(F.greatest(up, down) / F.nullif(total, F.lit(0.0)))
    return F.struct(label.alias("label"), score.alias("score"))


def label_scores(label: Column, score: Column) -> dict[str, Column]:
    """Spread one labelled score over the four sentiment columns."""
    zero = F.lit(0.0)
    pos = F.when(F.lower(label) == "positive", score).otherwise(zero)
    neg = F.when(F.lower(label) == "negative", score).otherwise(zero)
    neu = F.when(F.lower(label) == "neutral", score).otherwise(zero)
    return dict(zip(SENTIMENT_COLUMNS, (pos, neg, neu, pos - neg)))


def with_lexicon_scores(
    df: DataFrame,
    text: str = "title",
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> DataFrame:
    scored = df.withColumn("_mood", lexicon_sentiment(text, positive, negative))
    mood = label_scores(F.col("_mood.label"), F.col("_mood.score"))
    return scored.withColumns(mood).drop("_mood")


Scorer = Callable[[list[str]], list[Mapping[str, float]]]
# (start, end) of each token of a text
Tokens = Callable[[str], Sequence[tuple[int, int]]]
WINDOW = 4096  # texts that are sorted by length before they are scored
WINDOW_CHARS = 16 << 20
SLICE = 64  # rows of an Arrow batch whose whole texts are Python objects at a time


def _windows(batches: Iterator, at: int, cut: Callable[[str], tuple[str, int]]) -> Iterator[tuple]:
    """Batches in runs of about WINDOW rows, whatever the sizes they come in, with what ``cut`` makes of each
    text of column ``at``: rows stay in Arrow, and only a few texts are whole Python objects at a time."""
    held, texts, chars = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            held.append(part)
            for t in part.column(at).to_pylist():
                t = t if isinstance(t, str) else ""
                texts.append(cut(t))
                chars += len(t)
            if len(texts) >= WINDOW or chars >= WINDOW_CHARS:
                yield held, texts
                held, texts, chars = [], [], 0
    if held:
        yield held, texts


def with_model_scores(
    df: DataFrame,
    load_scorer: Callable[[], Scorer],
    text: str = "title",
    batch_size: int = 32,
    fallback: Callable[[DataFrame], DataFrame] | None = None,
    load_tokens: Callable[[], Tokens] | None = None,
    max_tokens: int = 512,
) -> DataFrame:
    """Class scores of a model the caller brings, loaded once per Python worker.

    ``load_scorer`` returns a function from a list of texts to one mapping of class (positive,
    negative, neutral) to score per text. ``load_tokens`` returns the model's tokenizer as a function
    from a text to (start, end) of each token: texts are then cut after ``max_tokens`` of them. Texts
    of like length are scored together, across the borders of Arrow batches, so that a model that
    pads to the longest of a batch pads little; rows come out in the order they came. With a
    ``fallback`` a batch the model fails on is left null and scored by the fallback instead (word
    lists by default in the news plan).
    """
    schema = T.StructType(
        [f for f in df.schema.fields if f.name not in SENTIMENT_COLUMNS]
        + [T.StructField(c, T.DoubleType()) for c in SENTIMENT_COLUMNS]
    )
    swallow = fallback is not None

    def scored_part(scorer, part: list[str]) -> list[tuple]:
        results = [{k.lower(): float(v) for k, v in r.items()} for r in scorer(part)]
        if len(results) != len(part):
            raise ValueError("the scorer must return one result per text")
        found = [(r.get("positive", 0.0), r.get("negative", 0.0), r.get("neutral", 0.0)) for r in results]
        return [(pos, neg, neu, pos - neg) for pos, neg, neu in found]

    at = df.columns.index(text)
    kept = [i for i, c in enumerate(df.columns) if c not in SENTIMENT_COLUMNS]

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer, tokens = None, load_tokens() if load_tokens else None

        def cut(t: str) -> tuple[str, int]:
            if not tokens:
                return t, len(t)
            spans = tokens(t)
            return t[: spans[max_tokens - 1][1]] if len(spans) > max_tokens else t, min(len(spans), max_tokens)

        for held, texts in _windows(batches, at, cut):
            order = sorted(range(len(texts)), key=lambda i: texts[i][1])
            found: list[tuple] = [(None, None, None, None)] * len(texts)
            for start in range(0, len(order), batch_size):
                rows = order[start : start + batch_size]
                try:
                    scorer = scorer or load_scorer()
                    for row, result in zip(rows, scored_part(scorer, [texts[i][0] for i in rows])):
                        found[row] = result
                except Exception:
                    if not swallow:
                        raise
            done = 0
            for part in held:
                own = found[done : done + part.num_rows]
                done += part.num_rows
                scores = [pa.array([row[i] for row in own], pa.float64(), from_pandas=True) for i in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept), *scores], [*(part.schema.names[i] for i in kept), *SENTIMENT_COLUMNS]
                )

    scored = df.mapInArrow(score, schema)
    if fallback is None:
        return scored
    plain = fallback(scored.withColumnsRenamed({c: f"_m_{c}" for c in SENTIMENT_COLUMNS}))
    failed = F.isnull("_m_sentiment_net") | F.isnan("_m_sentiment_net")
    return plain.withColumns(
        {c: F.when(failed, F.col(c)).otherwise(F.col(f"_m_{c}")) for c in SENTIMENT_COLUMNS}
    ).drop(*[f"_m_{c}" for c in SENTIMENT_COLUMNS])


def fragment_count(title: str, description: str, fragments: Sequence[str]) -> Column:
    """How many fragments occur in the title or the description; missing text holds none."""
    total = F.lit(0)
    for fragment in fragments:
        in_title = F.coalesce(F.lower(F.col(title)).contains(fragment), F.lit(False))
        in_description = F.coalesce(F.lower(F.col(description)).contains(fragment), F.lit(False))
        total = total + F.when(in_title | in_description, 1).otherwise(0)
    return total


def fragment_sentiment(
    title: str = "title",
    description: str = "description",
    positive: Sequence[str] = POSITIVE_FRAGMENTS,
    negative: Sequence[str] = NEGATIVE_FRAGMENTS,
) -> Column:
    difference = fragment_count(title, description, positive) - fragment_count(
        title, description, negative
    )
    return F.signum(difference.cast("double"))


def explode_tickers(
    df: DataFrame, column: str = "matched_tickers", out: str = "ticker", keep_blank: bool = False
) -> DataFrame:
    """One row per ticker of a comma-separated list, trimmed."""
    rows = df.withColumn(out, F.explode(F.split(F.col(column), ",")))
    rows = rows.withColumn(out, F.trim(out))
    return rows if keep_blank else rows.filter(F.col(out) != "")


def contribution_text(names: Sequence[str], values: Column, top: int = 2) -> Column:
    """Strongest positive and negative contributions of a row, as text.

    ``values`` is an array in the order of ``names``; later names win ties among positives and
    earlier names among negatives, the order a stable sort leaves.
    """
    pairs = F.zip_with(
        F.array(*[F.lit(n) for n in names]),
        F.zip_with(values, F.sequence(F.lit(1), F.lit(len(names))), lambda v, i: F.struct(
            v.alias("v"), i.alias("i")
        )),
        lambda n, s: F.struct(s["v"].alias("v"), s["i"].alias("i"), n.alias("n")),
    )
    ranked = F.array_sort(pairs)
    up = F.slice(F.filter(F.reverse(ranked), lambda p: p["v"] > 0), 1, top)
    down = F.slice(F.filter(ranked, lambda p: p["v"] < 0), 1, top)

    def text(items: Column, pattern: str) -> Column:
        return F.array_join(
            F.transform(items, lambda p: F.format_string(pattern, p["n"], p["v"])), ", "
        )

    return F.concat(
        F.lit("Pos: "), text(up, "%s (+%.4f)"), F.lit(" | Neg: "), text(down, "%s (%.4f)")
    )
