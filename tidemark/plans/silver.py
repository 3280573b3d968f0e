"""Bronze to silver: dedup, dates, required values, sectors, advisory checks."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import lenient_date, lookup, strict_date
from tidemark.operators.dedup import keep_first, latest_first
from tidemark.operators.quality import write_checked, write_suite
from tidemark.sources import reference_data
from tidemark.sources.lake import Lake


def silver_bars(bars: DataFrame, strict: bool, daily_unique: bool = False) -> DataFrame:
    """Each (symbol, timestamp) once, timestamp cut to its day, required values present.

    Two bars of one day both stay, as the key is the full timestamp; ``daily_unique`` keeps the
    later one."""
    keys = ["symbol", "timestamp"]
    rows = keep_first(bars, keys, latest_first(bars, keys))
    day = strict_date("timestamp") if strict else lenient_date("timestamp")
    if daily_unique:
        rows = rows.withColumn("_raw", F.col("timestamp")).withColumn("timestamp", day)
        rows = keep_first(rows, keys, [F.col("_raw").desc(), *latest_first(rows, keys)]).drop("_raw")
    else:
        rows = rows.withColumn("timestamp", day)
    return rows.na.drop(subset=["symbol", "timestamp", "close"])


def silver_stocks(
    bars: DataFrame, sectors: DataFrame | None = None, daily_unique: bool = False
) -> DataFrame:
    """A timestamp that is no date is an error; a symbol without a sector gets "Unknown"."""
    rows = silver_bars(bars, strict=True, daily_unique=daily_unique)
    table = sectors if sectors is not None else reference_data.sectors(bars.sparkSession)
    unknown = F.lit("Unknown")
    out = lookup(rows, table, "symbol", {"sector": unknown, "industry": unknown})
    first = [c for c in bars.columns if c not in ("sector", "industry")]
    return out.select(*first, "sector", "industry")


def silver_crypto(bars: DataFrame, daily_unique: bool = False) -> DataFrame:
    """A timestamp that is no date drops the row."""
    return silver_bars(bars, strict=False, daily_unique=daily_unique)


def silver_macro(macro: DataFrame) -> DataFrame:
    keys = ["series_id", "date"]
    rows = keep_first(macro, keys, latest_first(macro, keys))
    rows = rows.withColumn("date", lenient_date("date"))
    return rows.na.drop(subset=["series_id", "date", "value"])


def silver_news(news: DataFrame) -> DataFrame:
    rows = keep_first(news, ["url"], latest_first(news, ["url"]))
    rows = rows.na.fill("", subset=["description", "matched_tickers"])
    return rows.na.drop(subset=["title", "published_at", "url"])


STEPS = {
    "stocks": silver_stocks,
    "crypto": silver_crypto,
    "macro": silver_macro,
    "news": silver_news,
}


def build_silver(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Write every silver table whose bronze table exists and report the checks on what was
    written, counted during the write. Failing checks do not stop a table."""
    result = None
    for table, step in STEPS.items():
        if not lake.exists(table, "bronze"):
            continue
        report = write_checked(
            step(lake.read(table, "bronze")), write_suite(table),
            partial(lake.write, name=table, layer="silver"), partial(lake.read, table, "silver"),
        )
        report = report.select(F.lit(table).alias("table"), "*")
        result = report if result is None else result.unionByName(report)
    return result
