"""Placement helpers: bounded broadcasts, frozen intermediates, distributed positions.

One key may own a third of all rows, and an executor may be lost at any time. So nothing here
sorts a whole table in one task, collects a group, or relies on executor-local storage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Largest row count that is still broadcast. Callers pass narrow tables (a key, some doubles).
BROADCAST_ROWS = 200_000
# Rows that a task holds on average where a shuffle has a number of partitions of its own.
TASK_ROWS = 500_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; make a local one only for a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            current = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        context.setCheckpointDir(current)
    return current


def freeze(df: DataFrame) -> DataFrame:
    """Write an intermediate to the checkpoint folder once and read it back from there.

    Parquet, so that later passes read the columns and row groups they need and no more. The
    files stay until the checkpoint folder is emptied.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/frozen-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Ask the JVM to drop what no plan refers to, so that files of finished shuffles leave the disks.

    Spark deletes them once their plan is collected, which a large heap puts off."""
    spark.sparkContext._jvm.System.gc()


def in_tasks(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """The table shuffled by ``keys`` so that a task gets about ``TASK_ROWS`` of its ``rows``.

    Spark sizes tasks by compressed bytes, of which narrow sorted rows have very few, so a task could
    get many millions. Left to Spark while every core would get no more than that."""
    tasks = -(-rows // TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast behind a row count; beyond the bound the join shuffles on its keys.

    The count runs the plan of ``df``, so pass a frozen or cheaply scanned table.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def running_total(
    df: DataFrame,
    order: Sequence[str | Column],
    weight: Column | None = None,
    out: str = "running",
) -> DataFrame:
    """Inclusive running total of ``weight`` in a global order, without one sorting task.

    A range shuffle on the order keys splits hot keys, the result is frozen so that partition
    numbers stay put, and one row of offsets per partition is broadcast.
    Without ``weight`` the result is the 1-based position and needs no second shuffle.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # partition number in the upper bits, row number inside the partition in the lower 33
    tagged = freeze(ranged.withColumn("_tag", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_part", F.shiftright("_tag", 33))
    if weight is None:
        inside = F.col("_tag").bitwiseAND(F.lit((1 << 33) - 1)) + 1
        amount = F.count(F.lit(1))
    else:
        inside = F.sum(weight).over(
            Window.partitionBy("_part").orderBy("_tag").rowsBetween(Window.unboundedPreceding, 0)
        )
        amount = F.sum(weight)
    # one row per shuffle partition, so the unpartitioned window below is tiny
    offsets = (
        tagged.groupBy("_part")
        .agg(amount.alias("_amount"))
        .withColumn(
            "_offset",
            F.coalesce(
                F.sum("_amount").over(
                    Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .select("_part", "_offset")
    )
    return (
        tagged.withColumn(out, inside)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col(out) + F.col("_offset"))
        .drop("_part", "_tag", "_offset")
    )


def global_position(df: DataFrame, order: Sequence[str | Column], out: str = "pos") -> DataFrame:
    """0-based position of each row in a global order."""
    return running_total(df, order, None, out).withColumn(out, F.col(out) - 1)
