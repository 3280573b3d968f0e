"""Load gold tables into a warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.lake import Lake, last_days

# fixed values: warehouse type of each column type; anything else is text
WAREHOUSE_TYPES: dict[type, str] = {
    T.ByteType: "BIGINT",
    T.ShortType: "BIGINT",
    T.IntegerType: "BIGINT",
    T.LongType: "BIGINT",
    T.FloatType: "FLOAT8",
    T.DoubleType: "FLOAT8",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
}
TEXT_TYPE = "VARCHAR(512)"

# tables of the sync; the feature table is trimmed to its last days
SYNC_TABLES = {
    "mart_features": "features",
    "backtest_report": "backtest_report",
    "recommendations": "recommendations",
}


def column_types(schema: T.StructType) -> str:
    return ", ".join(
        f"{f.name} {WAREHOUSE_TYPES.get(type(f.dataType), TEXT_TYPE)}" for f in schema.fields
    )


def create_statement(schema: T.StructType, table: str, keep: bool = False) -> str:
    return f"CREATE TABLE {'IF NOT EXISTS ' if keep else ''}{table} ({column_types(schema)})"


class TargetTaken(ValueError):
    """The target of a load is a table that must not be replaced or extended by it."""


def load_table(
    df: DataFrame,
    table: str,
    replace: bool = True,
    jdbc: dict[str, str] | None = None,
    batch_size: int = 10_000,
) -> None:
    """Drop, create and fill, or (``replace=False``) create if needed and append.

    Over JDBC the executors insert their partitions in batches; without it the table goes to
    Spark's own catalog. A catalog table with other columns is left alone and the load refused."""
    mode = "overwrite" if replace else "append"
    if jdbc:
        types = column_types(df.schema)
        (
            df.write.format("jdbc")
            .options(dbtable=table, batchsize=str(batch_size), createTableColumnTypes=types, **jdbc)
            .mode(mode)
            .save()
        )
    else:
        spark = df.sparkSession
        if spark.catalog.tableExists(table) and spark.table(table).dtypes != df.dtypes:
            raise TargetTaken(f"{table} exists with other columns")
        df.write.mode(mode).saveAsTable(table)


def sync(
    spark: SparkSession, lake: Lake, namespace: str, days: int = 30, replace: bool = True, **options
) -> list[str]:
    """Load the gold tables that exist into ``namespace``; one that is missing does not stop the
    others.

    In Spark's own catalog the namespace must not be the current one: the marts are built there
    under the same names, and a sync would put its last days in their place."""
    if not options.get("jdbc"):
        if namespace == spark.catalog.currentDatabase():
            raise TargetTaken(f"{namespace} holds the tables that are synced")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    loaded = []
    for table, stored in SYNC_TABLES.items():
        if not lake.exists(stored, "gold"):
            continue
        df = lake.read(stored, "gold", essential=True)
        if table == "mart_features":
            df = last_days(df, days)
        load_table(df, f"{namespace}.{table}", replace, **options)
        loaded.append(table)
    return loaded
