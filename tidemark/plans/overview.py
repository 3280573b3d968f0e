"""Queries behind the dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import inferred_asset_class, lookup, percent
from tidemark.operators.recommend import latest_slice


def market_slice(features: DataFrame, names: DataFrame) -> DataFrame:
    """Newest day with asset class, display name and the return in percent."""
    rows = latest_slice(features)
    if "asset_class" not in rows.columns:
        rows = rows.withColumn("asset_class", inferred_asset_class("symbol"))
    rows = rows.withColumn("return_1d_pct", percent("return_1d"))
    return lookup(rows, names, "symbol", {"asset_name": F.col("symbol")})


def snapshot(market: DataFrame) -> DataFrame:
    return market.agg(
        F.count_if(F.col("asset_class") == "equity").alias("n_equities"),
        F.count_if(F.col("asset_class") == "crypto").alias("n_crypto"),
        F.avg("sentiment_net").alias("avg_sentiment"),
    )


def movers(market: DataFrame, gainers: bool = True, n: int = 5) -> DataFrame:
    """Largest or smallest one-day returns; rows without a return come last."""
    r = F.col("return_1d")
    order = r.desc_nulls_last() if gainers else r.asc_nulls_last()
    return market.orderBy(order, "symbol").select(
        "symbol", "asset_name", "close", "return_1d_pct"
    ).limit(n)


def sector_returns(market: DataFrame) -> DataFrame:
    rows = market.filter((F.col("asset_class") == "equity") & F.col("sector").isNotNull())
    return rows.groupBy("sector").agg(F.avg("return_1d_pct").alias("return_1d_pct"))


def symbol_series(features: DataFrame, symbol: str) -> DataFrame:
    return features.filter(F.col("symbol") == symbol).orderBy("date")


def signals(
    recommendations: DataFrame, names: DataFrame, positive: bool, n: int = 5
) -> DataFrame:
    """Newest recommendations with a positive (or negative) prediction, strongest first."""
    rows = latest_slice(recommendations)
    p = F.col("predicted_5d_return")
    rows = rows.filter(p > 0 if positive else p < 0)
    rows = lookup(rows, names, "symbol", {"asset_name": F.col("symbol")})
    rows = rows.withColumn("predicted_5d_return_pct", percent(p))
    return rows.orderBy(p.desc() if positive else p.asc(), "symbol").select(
        "symbol", "asset_name", "predicted_5d_return_pct", "confidence_score", "risk_score",
        "explainability",
    ).limit(n)


def live_ticks(store: DataFrame, n: int = 20) -> DataFrame:
    """Up to ``n`` items of the latest-tick store, sorted by symbol.

    The scan of the reference stops at any ``n`` items; here they are the first by key."""
    stamp = F.translate(F.substring("last_updated", 1, 19), "T", " ")
    rows = store.orderBy("symbol", "date").limit(n)
    return rows.select(
        "symbol",
        F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(F.col("size").cast("double"), F.lit(0.0)).alias("size"),
        stamp.alias("last_updated"),
    ).orderBy("symbol")
