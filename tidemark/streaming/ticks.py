"""Latest tick per (symbol, date) from a stream: decoding, and a store of batches in hash buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scalars import date_prefix
from tidemark.sources.schemas import TABLES, TICK

KEY = ["symbol", "date"]
STORE_SCHEMA = TABLES[("gold", "feature_store")]
BATCHES_SCHEMA = "batch_id long, n_rows long, n_rejected long"
ARRIVAL = "_arrival"  # number of the batch that brought a row


def file_source(
    spark: SparkSession, path: str, files_per_batch: int | None = None, fmt: str = "text",
    schema: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """Files of a landing folder as a stream of lines (``value``) or of typed rows.

    A batch takes all files that are there unless ``files_per_batch`` limits it."""
    reader = spark.readStream.format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if schema:
        reader = reader.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def broker_source(
    spark: SparkSession, servers: str, topic: str, per_batch: int | None = None
) -> DataFrame:
    """All partitions of a topic from the latest position; a restart goes on from the checkpoint.

    A batch takes all there is unless ``per_batch`` limits it. Needs the Kafka connector on the
    cluster."""
    limit = {"maxOffsetsPerTrigger": per_batch} if per_batch else {}
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .options(**limit)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def decode(lines: DataFrame, schema: str = TICK) -> DataFrame:
    """JSON bodies to columns; the raw text stays for rows that fail."""
    parsed = lines.withColumn("tick", F.from_json("value", schema))
    return parsed.select("value", "tick.*")


def is_valid() -> Column:
    """A tick needs its key fields."""
    return F.col("symbol").isNotNull() & F.col("timestamp").isNotNull()


def to_items(ticks: DataFrame) -> DataFrame:
    return ticks.select(
        "symbol",
        date_prefix("timestamp").alias("date"),
        "price",
        "size",
        F.col("timestamp").alias("last_updated"),
        F.lit("realtime_stream").alias("feature_source"),
    )


def newest_per_key(items: DataFrame, *first: str) -> DataFrame:
    """Last row per key by the given columns, then event time; a map-side partial result keeps
    hot symbols small. Equal times fall back to the values, so that the result is fixed."""
    by = F.struct(*first, "last_updated", "price", "size")
    return items.groupBy(*KEY).agg(
        *[F.max_by(c, by).alias(c) for c in items.columns if c not in (*KEY, *first)]
    ).select(*[c for c in items.columns if c not in first])


def land(lines: DataFrame, landing: str, name: str) -> None:
    """Put lines into a new folder below ``landing``, which a stream over ``landing/*`` sees at once or not at all."""
    jvm, conf = lines.sparkSession.sparkContext._jvm, lines.sparkSession.sparkContext._jsc.hadoopConfiguration()
    made = jvm.org.apache.hadoop.fs.Path(f"{landing}-staged/{name}")
    target = jvm.org.apache.hadoop.fs.Path(f"{landing}/{name}")
    fs = target.getFileSystem(conf)
    fs.mkdirs(target.getParent())
    lines.select("value").write.mode("overwrite").text(made.toString())
    if not fs.rename(made, target):
        raise OSError(f"{target} could not be put in place")


class TickStore:
    """Latest ticks under one folder, in hash buckets of their keys.

    A batch appends its latest rows per key to the log, in a folder named after it, so a replayed
    batch writes the same folder again. After ``compact_after`` batches the log is folded into the
    base: only buckets that the log touched are written anew. A reader takes, per bucket, the
    newest base and the batches after the last compaction; a lookup opens the one bucket of its
    key, and in it the row groups whose bloom filter knows the symbol.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, compact_after: int = 20):
        if buckets < 1 or compact_after < 1:
            raise ValueError("a store has one bucket and one batch at least")
        self.spark, self.root, self.buckets, self.compact_after = spark, root.rstrip("/"), buckets, compact_after

    def bucket(self, symbol: Column, date: Column) -> Column:
        return F.pmod(F.xxhash64(symbol, date), F.lit(self.buckets)).cast("int")

    def _save(self, rows: DataFrame, path: str) -> None:
        rows = rows.withColumn("bucket", self.bucket(F.col("symbol"), F.col("date"))).repartition("bucket", "symbol")
        rows.write.mode("overwrite").partitionBy("bucket").option("parquet.bloom.filter.enabled#symbol", "true").parquet(path)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Good rows to the log, others to ``rejected``, their numbers to ``batches``; all carry the batch id.

        The batch is kept for the writes, so its source is read once; the rows are counted as they
        are written."""
        ticks = (decode(batch) if "value" in batch.columns else batch).persist()
        try:
            bad = ~F.coalesce(is_valid(), F.lit(False))
            seen = Observation()
            counted = ticks.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_rejected"))
            good = newest_per_key(to_items(counted.filter(~bad)))
            self._save(good.withColumn(ARRIVAL, F.lit(batch_id).cast("long")), f"{self.root}/log/batch={batch_id}")
            numbers = seen.get
            if "value" in ticks.columns:
                ticks.filter(bad).select("value").write.mode("overwrite").text(f"{self.root}/rejected/batch={batch_id}")
            row = [(batch_id, numbers["n_rows"], numbers["n_rejected"])]
            row = self.spark.createDataFrame(row, BATCHES_SCHEMA).withColumn("finished", F.current_timestamp())
            row.write.mode("overwrite").parquet(f"{self.root}/batches/batch={batch_id}")
        finally:
            ticks.unpersist()
        if len(self._log()) >= self.compact_after:
            self.compact()

    def start(
        self, stream: DataFrame, checkpoint: str, once: bool = False, seconds: int = 1
    ) -> StreamingQuery:
        writer = (
            stream.writeStream.foreachBatch(self.write_batch)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
        )
        trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} second"}
        return writer.trigger(**trigger).start()

    def batches(self) -> DataFrame:
        """(batch_id, n_rows, n_rejected, finished) of every batch written."""
        paths = [f"{self.root}/batches/batch={n}" for n in self._numbers("batches", "batch=")]
        schema = f"{BATCHES_SCHEMA}, finished timestamp"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def rejected(self) -> DataFrame:
        """(batch_id, value) of the lines that were no tick."""
        if not self._children("rejected"):
            return self.spark.createDataFrame([], "batch_id long, value string")
        rows = self.spark.read.option("basePath", f"{self.root}/rejected").schema("value string, batch long").text(f"{self.root}/rejected")
        return rows.select(F.col("batch").alias("batch_id"), "value")

    def _folder(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _children(self, folder: str) -> list[str]:
        fs, path = self._folder(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        """Numbers whose folders are complete, ascending."""
        numbers = sorted(int(n[len(prefix) :]) for n in self._children(folder) if n.startswith(prefix))
        return [n for n in numbers if self._folder(f"{folder}/{prefix}{n}/_SUCCESS")[0].exists(
            self._folder(f"{folder}/{prefix}{n}/_SUCCESS")[1])]

    def _bases(self) -> dict[int, list[int]]:
        """Per bucket the numbers of the bases that hold it, ascending."""
        held: dict[int, list[int]] = {}
        for upto in self._numbers("base", "upto="):
            for bucket in self._buckets(f"base/upto={upto}"):
                held.setdefault(bucket, []).append(upto)
        return held

    def _buckets(self, folder: str) -> list[int]:
        return [int(n[len("bucket=") :]) for n in self._children(folder) if n.startswith("bucket=")]

    def _log(self) -> list[int]:
        """Batches after the last compaction."""
        bases = self._numbers("base", "upto=")
        return [b for b in self._numbers("log", "batch=") if b > (bases[-1] if bases else -1)]

    def _paths(self, buckets: set[int] | None = None) -> list[str]:
        """Bucket folders that make up the store, or those of some buckets."""
        found = [f"base/upto={uptos[-1]}/bucket={b}" for b, uptos in self._bases().items() if buckets is None or b in buckets]
        for batch in self._log():
            found += [f"log/batch={batch}/bucket={b}" for b in self._buckets(f"log/batch={batch}") if buckets is None or b in buckets]
        return [f"{self.root}/{name}" for name in found]

    def _rows(self, paths: list[str]) -> DataFrame:
        schema = f"{STORE_SCHEMA}, {ARRIVAL} long"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """Latest item per key; a later batch wins over an earlier one."""
        return newest_per_key(self._rows(self._paths()), ARRIVAL)

    def lookup(self, symbol: str, date: str) -> DataFrame:
        """The latest item of one key, from its bucket alone."""
        bucket = self.spark.range(1).select(self.bucket(F.lit(symbol), F.lit(date))).first()[0]
        rows = self._rows(self._paths({bucket}))
        return newest_per_key(rows.filter((F.col("symbol") == symbol) & (F.col("date") == date)), ARRIVAL)

    def compact(self) -> int:
        """Fold the log into the base; readers switch once it is complete. The last batch folded in.

        What the base before had already replaced is removed, so a reader that listed the store
        has until the next compaction to finish."""
        log, bases = self._log(), self._bases()
        known = self._numbers("base", "upto=")
        before = known[-1] if known else -1
        if not log:
            return before
        touched = {b for batch in log for b in self._buckets(f"log/batch={batch}")}
        self._save(newest_per_key(self._rows(self._paths(touched)), ARRIVAL).withColumn(
            ARRIVAL, F.lit(log[-1]).cast("long")), f"{self.root}/base/upto={log[-1]}")
        old = [f"log/batch={n}" for n in self._numbers("log", "batch=") if n <= before]
        old += [f"base/upto={n}/bucket={b}" for b, uptos in bases.items() for n in uptos[:-1]]
        for name in old:
            fs, path = self._folder(name)
            fs.delete(path, True)
        return log[-1]
