"""What the corpus operators share: words, row keys, stored intermediates, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scale import ensure_checkpoint_dir

LAST = (1 << 63) - 1  # stands for a null doc_id wherever documents are put in order
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder, which the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once as parquet in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs no earlier stage, and later passes read only the
    columns they need. The files stay until the checkpoint folder is emptied.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def order_key(doc_id: str = "doc_id") -> Column:
    """Place of a document among the others; a null id comes last."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def plain(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that further columns of any name can't clash."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def map_rows(
    df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    return df.mapInArrow(work, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in runs of few rows, so that Python holds copies of few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def values(column: pa.Array) -> list:
    return column.to_pylist()


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, ord, th, text): the place in order and a digest that tells texts of one id apart.

    Rows with the same id and the same text share a key; they get the same result.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        order_key().alias("ord"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
        F.col("text").cast("string").alias("text"),
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the graph of ``edges`` (a, b: long); root is the smallest node reachable.

    Large-star and small-star rounds: each hangs neighbours on the smallest node seen, until
    every edge points at a root. A round moves as many rows as there are edges, minima are
    combined before the shuffle, and each round is stored, so no task ever holds a component.
    """
    edges = store(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if not now[0] or now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store(large.distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = store(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
