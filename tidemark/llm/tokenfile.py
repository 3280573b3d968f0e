"""Token-id files: parquet with one list column of ids, in document order, read selectively.

One row per document: doc_id, part, offset (ids before it in its part), n_tokens, ids. Ids are
dictionary-encoded, the sorted numbers delta-encoded; row groups and pages are small enough that
the page index lets a reader of few documents, or of the numbers alone, skip the rest.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keyed, map_rows, slices
from tidemark.llm.tokenizer import encoder, load, pieces

SCHEMA = "doc_id long, part int, offset long, n_tokens long, ids array<int>"


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, by_word: bool = False,
    row_group_bytes: int = 32 << 20, page_rows: int = 1000, page_bytes: int = 256 << 10,
    codec: str = "snappy",
) -> None:
    """Encode ``text`` of every row and write the files in ascending doc_id order.

    Equal ids are ordered by a digest of the text; a null id comes last. A null text is empty. A
    range shuffle splits the rows evenly, whatever their source; each task encodes and writes one
    range in bounded pieces, so a lost task is simply run again.
    """
    held = docs.sparkSession.sparkContext.broadcast(load(tokenizer))
    rows = keyed(docs).repartitionByRange("ord", "th").sortWithinPartitions("ord", "th")
    rows = rows.select("doc_id", F.spark_partition_id().alias("part"), F.col("text").cast("binary").alias("text"))

    def work(batches):
        coder, offset = encoder(*held.value, by_word), 0
        for batch in batches:
            for cut in pieces(batch.column("text")):
                few = batch.slice(cut.start, cut.stop - cut.start)
                ids, ends = coder.flat(few.column("text"))
                if end_id is not None:
                    ids = np.insert(ids, ends, end_id)
                    ends = ends + np.arange(1, len(ends) + 1)
                n = np.diff(ends, prepend=0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), few.column("part"), pa.array(offset + ends - n), pa.array(n), lists],
                    ["doc_id", "part", "offset", "n_tokens", "ids"],
                )
                offset += int(ends[-1])

    options = {
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "true",
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "offset", "n_tokens")},
        "compression": codec,
    }
    map_rows(rows, SCHEMA, work).write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as they are; select few columns or filter on doc_id to read little of them."""
    return spark.read.schema(SCHEMA).parquet(path)


def with_start(tokens: DataFrame, stored: DataFrame) -> DataFrame:
    """Add start, the number of ids before a row in the whole set of files.

    Only part, offset and n_tokens of ``stored`` are read for it; one row per part is broadcast.
    """
    ends = stored.groupBy("part").agg(F.max(F.col("offset") + F.col("n_tokens")).alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    joined = tokens.join(F.broadcast(base), "part")
    return joined.withColumn("start", F.col("_base") + F.col("offset")).drop("_base")


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit numbers."""

    def work(batches):
        for batch in slices(batches):
            lists = batch.column("ids")
            ids = lists.values.to_numpy().view("<u4")
            cuts = lists.offsets.to_numpy()
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    rows = tokens.select("doc_id", "start", "n_tokens", "ids")
    return map_rows(rows, "doc_id long, start long, n_tokens long, ids_crc32 long", work)
