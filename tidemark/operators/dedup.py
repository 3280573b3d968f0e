"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of every key in the given order.

    Spark drops all but the first row per key before the shuffle (window group limit), so a key
    with very many copies sends at most one row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_first(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Latest ingestion first, then every other column, so that the choice never depends on
    file order."""
    rest = sorted(c for c in df.columns if c not in keys and c != "ingestion_timestamp")
    order = [F.col(c).asc_nulls_last() for c in rest]
    if "ingestion_timestamp" in df.columns:
        order.insert(0, F.col("ingestion_timestamp").desc_nulls_last())
    return order
