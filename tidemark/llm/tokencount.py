"""Token counts behind a digest cache: only texts never counted before are encoded.

The cache is a parquet table (tokenizer, digest, n_tokens), partitioned by the digest of the
tokenizer file, so that another tokenizer or version never meets these counts.
"""

from __future__ import annotations

import string
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, store
from tidemark.llm.tokenizer import encoder, load, pieces, version

SCHEMA = "digest binary, n_tokens long, tokenizer string"


def normalised(text: Column) -> Column:
    """Texts with the same normal form share a count: null counts as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def folded(text: Column) -> Column:
    """A normal form for tokenizers that lower-case and drop white space, such as word_bpe_49k.

    A-Z become a-z, and each run of ASCII white space one blank, none at the ends. A text that
    might hold a special token stays as it is, as their strings are told apart by case.
    """
    plain = normalised(text)
    low = F.translate(plain, string.ascii_uppercase, string.ascii_lowercase)
    squeezed = F.trim(F.regexp_replace(low, r"[\x20\x09-\x0D]+", " "))
    return F.when(F.contains(plain, F.lit("<|")), plain).otherwise(squeezed)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """All stored counts; empty before the first append."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def count_tokens(
    docs: DataFrame, cache: str, tokenizer: str, by_word: bool = False,
    normalise: Callable[[Column], Column] = normalised,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row, after appending to the cache at ``cache``.

    Digests are 256 bits. Copies are combined in each input task before the shuffle, so a text
    that makes up a third of all rows is moved once per task, and encoded once. A run that failed
    after the append, or two runs at a time, may leave a digest twice; readers take one of them.
    ``normalise`` must not change what the tokenizer gives. A null text has 0 bytes; a null doc_id
    and repeated rows are answered like any other.
    """
    spark = docs.sparkSession
    name, model = load(tokenizer)
    tag = version(name, model)
    held = spark.sparkContext.broadcast((name, model))
    form = normalise(F.col("text"))
    digest = F.unhex(F.sha2(form.cast("binary"), 256)).alias("digest")

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        digest,
    )
    rows = store(rows, "digests")

    def stored() -> DataFrame:
        found = read_cache(spark, cache).filter(F.col("tokenizer") == tag)
        return found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    distinct = docs.select(digest, form.cast("binary").alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(stored().select("digest"), "digest", "left_anti")

    def work(batches):
        coder = encoder(*held.value, by_word)
        for batch in batches:
            texts, counts = batch.column("text"), [np.zeros(0, np.int64)]
            for cut in pieces(texts):
                counts.append(np.diff(coder.flat(texts.slice(cut.start, cut.stop - cut.start))[1], prepend=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(np.concatenate(counts))], ["digest", "n_tokens"])

    fresh = map_rows(misses, "digest binary, n_tokens long", work).withColumn("tokenizer", F.lit(tag))
    fresh.write.mode("append").partitionBy("tokenizer").parquet(cache)
    # both sides of the answer's join are plain stored tables, so that a digest which many
    # documents share can be split between tasks
    known = stored().join(rows.select("digest").distinct(), "digest", "left_semi")
    return rows.join(store(known, "known-counts"), "digest").select("doc_id", "n_bytes", "n_tokens")
