"""The SQL models: staging, intermediate and mart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.macro import MART_SERIES, macro_daily
from tidemark.operators.series import Layout, measure_layout
from tidemark.operators.technical import mart_technicals, with_relative_strength
from tidemark.plans.news import mart_news_sentiment
from tidemark.scale import broadcast_if_small, freeze
from tidemark.sources.lake import Lake, as_table, as_view

_BAR_CASTS = (
    "symbol",
    "cast(timestamp as date) as date",
    "cast(open as double) as open",
    "cast(high as double) as high",
    "cast(low as double) as low",
    "cast(close as double) as close",
    "cast(volume as double) as volume",
    "cast(trade_count as bigint) as trade_count",
    "cast(vwap as double) as vwap",
)
_INGESTED = "cast(ingestion_timestamp as timestamp) as ingestion_timestamp"

PRICE_COLUMNS = [
    "symbol", "date", "open", "high", "low", "close", "volume", "trade_count", "vwap",
    "asset_class", "sector", "industry",
]
TECHNICAL_COLUMNS = [
    "sma_20", "sma_50", "sma_200", "bb_upper", "bb_lower", "bb_width", "return_1d", "return_5d",
    "return_20d", "volatility_20d", "rel_strength_sector", "target_1d_return", "target_5d_return",
]
MACRO_COLUMNS = [*MART_SERIES.values(), "yield_curve_slope"]


def stg_stocks(silver: DataFrame) -> DataFrame:
    return silver.selectExpr(*_BAR_CASTS, "sector", "industry", "asset_class", _INGESTED)


def stg_crypto(silver: DataFrame) -> DataFrame:
    return silver.selectExpr(*_BAR_CASTS, "asset_class", _INGESTED)


def stg_macro(silver: DataFrame) -> DataFrame:
    return silver.selectExpr(
        "cast(date as date) as date",
        "cast(value as double) as value",
        "series_id",
        "series_name",
        "data_source",
        _INGESTED,
    )


def stg_news(silver: DataFrame) -> DataFrame:
    return silver.selectExpr(
        "title",
        "description",
        "url",
        "source",
        "cast(published_at as timestamp) as published_at",
        "query_tickers",
        "matched_tickers",
        "data_source",
        _INGESTED,
    )


def mart_prices(stocks: DataFrame, crypto: DataFrame) -> DataFrame:
    """All prices; crypto gets one constant sector and industry."""
    coins = crypto.withColumns({"sector": F.lit("Crypto"), "industry": F.lit("Cryptocurrency")})
    return stocks.select(*PRICE_COLUMNS).unionByName(coins.select(*PRICE_COLUMNS))


def mart_features(
    stocks: DataFrame,
    crypto: DataFrame,
    macro: DataFrame,
    news: DataFrame,
    layout: Layout | None = None,
) -> DataFrame:
    """The feature mart from the four staging tables."""
    prices = mart_prices(stocks, crypto)
    layout = layout or measure_layout(prices)
    rows = with_relative_strength(mart_technicals(prices, layout), prices, "date", layout)
    rows = rows.select(*PRICE_COLUMNS, *TECHNICAL_COLUMNS)
    # one row per price date
    daily = freeze(macro_daily(prices.select("date"), macro))
    moods = freeze(mart_news_sentiment(news))
    return (
        rows.join(broadcast_if_small(daily), "date", "left")
        .join(broadcast_if_small(moods), ["symbol", "date"], "left")
        .withColumn("sentiment_net", F.coalesce("sentiment_net", F.lit(0.0)))
        .select(*PRICE_COLUMNS, *TECHNICAL_COLUMNS, *MACRO_COLUMNS, "sentiment_net")
    )


def mart_sector_performance(features: DataFrame) -> DataFrame:
    return features.groupBy("sector", "date").agg(
        F.avg("return_1d").alias("avg_return_1d"),
        F.avg("volatility_20d").alias("avg_volatility_20d"),
        F.sum("volume").alias("total_volume"),
        F.count_distinct("symbol").alias("active_assets"),
    )


def build_marts(spark: SparkSession, lake: Lake, database: str | None = None) -> list[str]:
    """Staging and intermediate models as views, marts as tables."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        spark.catalog.setCurrentDatabase(database)
    staging = {"stg_stocks": stg_stocks, "stg_crypto": stg_crypto,
               "stg_macro": stg_macro, "stg_news": stg_news}
    views = {
        name: as_view(model(lake.read(name[4:], "silver")), name) for name, model in staging.items()
    }
    dates = views["stg_stocks"].select("date").union(views["stg_crypto"].select("date"))
    as_view(macro_daily(dates, views["stg_macro"]), "int_macro_daily")
    as_view(mart_news_sentiment(views["stg_news"]), "int_news_sentiment")
    features = as_table(mart_features(*views.values()), "mart_features")
    as_table(mart_sector_performance(features), "mart_sector_perf")
    return [*views, "int_macro_daily", "int_news_sentiment", "mart_features", "mart_sector_perf"]
