"""Landed API payloads to bronze rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import lenient_double, lower_names, with_lineage
from tidemark.functions.text import TICKER_KEYWORDS, match_tickers
from tidemark.operators.dedup import keep_first, latest_first
from tidemark.sources.reference_data import CRYPTO_COINS, CRYPTO_PAIRS, MACRO_SERIES, pairs


def read_json(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """All batches of a landing folder in one read, with a given schema."""
    return spark.read.schema(schema).json(path)


def stock_bars(raw: DataFrame) -> DataFrame:
    rows = lower_names(raw).withColumn("timestamp", F.col("timestamp").cast("string"))
    return with_lineage(rows, "alpaca", "equity")


def crypto_bars(
    raw: DataFrame, coins: Sequence[str] = CRYPTO_COINS, mapping: Mapping[str, str] = CRYPTO_PAIRS
) -> DataFrame:
    """Bars of the pairs the coins map to; coins without a pair are left out."""
    wanted = {c: mapping[c] for c in coins if c in mapping}
    rows = lower_names(raw).withColumn("timestamp", F.col("timestamp").cast("string"))
    # at most as many rows as the mapping
    table = pairs(raw.sparkSession, wanted, "coin", "symbol").select("symbol").distinct()
    return with_lineage(rows.join(F.broadcast(table), "symbol", "left_semi"), "alpaca", "crypto")


def macro_observations(
    raw: DataFrame, names: Mapping[str, str] = MACRO_SERIES
) -> DataFrame:
    """One row per observation with a number; "." and other text count as missing."""
    rows = raw.select("series_id", F.explode("observations").alias("o")).select(
        F.col("o.date").alias("date"),
        lenient_double("o.value").alias("value"),
        "series_id",
    )
    # at most as many rows as the mapping
    titles = F.broadcast(pairs(raw.sparkSession, names, "series_id", "series_name"))
    rows = rows.filter(F.col("value").isNotNull() & ~F.isnan("value")).join(titles, "series_id")
    rows = rows.select("date", "value", "series_id", "series_name")
    return with_lineage(rows, "fred")


def news_articles(
    raw: DataFrame, keywords: Mapping[str, Sequence[str]] = TICKER_KEYWORDS
) -> DataFrame:
    """One row per article, each url once, removed articles dropped.

    The first occurrence of a url follows the search group and article order."""
    rows = raw.select(
        "tickers",
        F.col("group") if "group" in raw.columns else F.lit(0).alias("group"),
        F.posexplode("articles").alias("rank", "a"),
    )
    blank = F.lit("")
    rows = rows.select(
        F.col("a.title").alias("title"),
        F.col("a.description").alias("description"),
        F.coalesce(F.col("a.url"), blank).alias("url"),
        F.coalesce(F.col("a.source.name"), blank).alias("source"),
        F.coalesce(F.col("a.publishedAt"), blank).alias("published_at"),
        F.array_join("tickers", ",").alias("query_tickers"),
        match_tickers("a.title", "a.description", F.col("tickers"), keywords).alias(
            "matched_tickers"
        ),
        "group",
        "rank",
    )
    rows = keep_first(rows, ["url"], ["group", "rank", *latest_first(rows, ["url"])])
    return with_lineage(live_titles(rows).drop("group", "rank"), "newsapi")


def live_titles(df: DataFrame) -> DataFrame:
    return df.filter(F.col("title").isNotNull() & (F.col("title") != "[Removed]"))


def bars_summary(df: DataFrame, key: str = "symbol", date: str = "timestamp") -> DataFrame:
    """Row count, distinct keys and date range of an ingested table."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def distinct_sorted(df: DataFrame, column: str = "symbol") -> DataFrame:
    return df.select(column).distinct().orderBy(column)

