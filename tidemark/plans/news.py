"""Daily news sentiment per ticker, scored by word list, model or substrings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import (
    NEGATIVE_FRAGMENTS,
    POSITIVE_FRAGMENTS,
    SENTIMENT_COLUMNS,
    explode_tickers,
    fragment_sentiment,
    with_lexicon_scores,
)

Score = Callable[[DataFrame], DataFrame]


def calendar_day(c: str | Column) -> Column:
    return F.to_date(F.col(c) if isinstance(c, str) else c)


def news_sentiment(
    news: DataFrame,
    score: Score = with_lexicon_scores,
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Mean scores per (ticker, date). ``score`` adds the four sentiment columns to articles.

    ``normalise`` may rewrite tickers, e.g. to the traded pairs that price rows use."""
    rows = score(news.select("title", "published_at", "matched_tickers"))
    rows = explode_tickers(rows)
    if normalise:
        rows = rows.withColumn("ticker", normalise(F.col("ticker")))
    return rows.groupBy("ticker", calendar_day("published_at").alias("date")).agg(
        *[F.avg(c).alias(c) for c in SENTIMENT_COLUMNS]
    )


def mart_news_sentiment(
    news: DataFrame,
    positive: Sequence[str] = POSITIVE_FRAGMENTS,
    negative: Sequence[str] = NEGATIVE_FRAGMENTS,
) -> DataFrame:
    """Mean sign of the fragment counts per (symbol, date); blanks between commas are kept."""
    rows = news.filter(F.col("matched_tickers").isNotNull() & (F.col("matched_tickers") != ""))
    rows = rows.select(
        "matched_tickers",
        calendar_day("published_at").alias("date"),
        fragment_sentiment("title", "description", positive, negative).alias("net"),
    )
    rows = explode_tickers(rows, out="symbol", keep_blank=True)
    return rows.groupBy("symbol", "date").agg(F.avg("net").alias("sentiment_net"))
