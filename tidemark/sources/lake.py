"""Layered tables: paths, reads, writes, models as views or tables, catalog discovery."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.schemas import TABLES

LAYERS = ("bronze", "silver", "gold")
ESSENTIAL = (("silver", "stocks"),)


class MissingTable(ValueError):
    """A table the job cannot do without does not exist."""


class Lake:
    """Tables under ``root/layer/name``. ``root`` is a folder, a bucket address or any other
    path the cluster reads; parquet unless another installed format is named."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    @classmethod
    def from_environment(cls, spark: SparkSession, local_root: str = "data", **kw) -> Lake:
        """``LOCAL_DEV=true`` means a local folder, otherwise the bucket in ``S3_BUCKET``."""
        if os.getenv("LOCAL_DEV", "false").lower() == "true":
            return cls(spark, local_root, **kw)
        bucket = os.getenv("S3_BUCKET")
        if not bucket:
            raise ValueError("S3_BUCKET must be set when LOCAL_DEV is not true")
        return cls(spark, f"s3a://{bucket}", **kw)

    def path(self, name: str, layer: str = "bronze") -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.root}/{layer}/{name}"

    def exists(self, name: str, layer: str) -> bool:
        return bool(self._children(self.path(name, layer)))

    def read(self, name: str, layer: str = "silver", essential: bool | None = None) -> DataFrame:
        """A missing optional table is empty; a missing essential one is an error."""
        essential = (layer, name) in ESSENTIAL if essential is None else essential
        try:
            return self.spark.read.format(self.fmt).load(self.path(name, layer))
        except AnalysisException as error:
            if self.exists(name, layer):
                raise
            if essential or (layer, name) not in TABLES:
                raise MissingTable(f"{layer}.{name} not found at {self.path(name, layer)}") from error
            return self.spark.createDataFrame([], TABLES[(layer, name)])

    def write(
        self,
        df: DataFrame,
        name: str,
        layer: str,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
    ) -> str:
        """Modes are append, overwrite, error, ignore; overwrite also replaces the schema."""
        writer = df.write.format(self.fmt).mode(mode)
        if mode == "overwrite":
            writer = writer.option("overwriteSchema", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        target = self.path(name, layer)
        writer.save(target)
        return target

    def load_table(self, name: str, layer: str = "gold", rename: dict[str, str] | None = None):
        """Catalog table of that name, else the stored table, else nothing (an empty frame).

        Stored gold features answer to the name of the mart."""
        if self.spark.catalog.tableExists(name):
            return self.spark.table(name)
        stored = (rename or {"mart_features": "features"}).get(name, name)
        if self.exists(stored, layer):
            return self.spark.read.format(self.fmt).load(self.path(stored, layer))
        schema = TABLES.get((layer, stored), "symbol string, date date")
        return self.spark.createDataFrame([], schema)

    def _children(self, path: str) -> list[str]:
        """Folder names below a path, through the file system Spark itself uses."""
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(target):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(target))

    def discover(self, prefix: str = "lake_") -> list[str]:
        """Register every table folder of every layer, partitions and columns of all files included.

        A known table is brought up to date where it stands: new columns are added, partitions
        follow the folders. It is entered anew only if a column has gone or changed its type, or
        the partitioning has changed. A name used in two layers carries its layer, so that
        neither hides the other."""
        found = [(layer, n) for layer in LAYERS for n in self._children(f"{self.root}/{layer}")
                 if not n.startswith(("_", "."))]
        names = [n for _, n in found]
        registered = []
        for layer, name in found:
            table = f"{prefix}{name}" if names.count(name) == 1 else f"{prefix}{layer}_{name}"
            table = table.replace("-", "_").replace(".", "_")
            if self._register(table, self.path(name, layer)):
                registered.append(table)
        return registered

    def _register(self, table: str, path: str) -> bool:
        """False for a folder in which no file tells its columns."""
        catalog, quoted = self.spark.catalog, f"`{table}`"
        try:
            schema = self.spark.read.format(self.fmt).option("mergeSchema", "true").load(path).schema
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return False
            raise
        partitions = self._partition_columns(path)
        if catalog.tableExists(table):
            # external: dropping the entry leaves the files alone, which a managed one would lose
            if catalog.getTable(table).tableType == "MANAGED":
                raise ValueError(f"{table} is a managed table of that name")
            known = {f.name: f.dataType for f in self.spark.table(table).schema}
            split = [c.name for c in catalog.listColumns(table) if c.isPartition]
            added = [f for f in schema if f.name not in known and f.name not in partitions]
            kept = all(f.dataType == known.get(f.name) for f in schema if f not in added)
            if split == partitions and kept and set(known) <= set(schema.names):
                if added:
                    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                    self.spark.sql(f"ALTER TABLE {quoted} ADD COLUMNS ({columns})")
            else:
                self.spark.sql(f"DROP TABLE {quoted}")
        if not catalog.tableExists(table):
            data = [f for f in schema if f.name not in partitions]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*data, *[schema[c] for c in partitions]])
            location = path.replace("'", r"\'")
            by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions else ""
            self.spark.sql(f"CREATE TABLE {quoted} ({columns}) USING {self.fmt} {by} LOCATION '{location}'")
        if partitions:
            self.spark.sql(f"MSCK REPAIR TABLE {quoted} SYNC PARTITIONS")
        catalog.refreshTable(table)
        return True

    def _partition_columns(self, path: str) -> list[str]:
        """Names of the key=value folders below a table folder, outermost first."""
        out = []
        while keyed := [n for n in self._children(path) if "=" in n and not n.startswith(("_", "."))]:
            out.append(keyed[0].partition("=")[0])
            path = f"{path}/{keyed[0]}"
        return out

    def tables(self, prefix: str = "lake_") -> DataFrame:
        """Registered tables and how many columns each has."""
        rows = [
            (t.name, len(self.spark.catalog.listColumns(t.name)))
            for t in self.spark.catalog.listTables()
            if t.name.startswith(prefix)
        ]
        return self.spark.createDataFrame(rows, "table string, n_columns int").orderBy("table")


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Create or replace a stored table."""
    df.write.mode("overwrite").format(fmt).saveAsTable(name)
    return df.sparkSession.table(name)


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Ad-hoc SQL over catalog tables or over frames named in ``{braces}``."""
    return spark.sql(query, **tables)


def last_days(df: DataFrame, days: int = 30, date: str = "date") -> DataFrame:
    """Rows of the last ``days`` days of the table. The newest day is one value, found first,
    so the filter on it reaches the scan."""
    newest = df.agg(F.max(date)).first()[0]
    return df.filter(F.col(date) >= F.date_sub(F.lit(newest), days)) if newest else df.limit(0)
