"""Corpus pipeline: documents in, stages one after the other, each written and read again.

quality rules -> near-duplicates -> benchmark leaks -> source mix -> token files. Each stage works
on every row its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import crf, decontaminate, mixing, simhash, tokenfile
from tidemark.llm.common import shared_path
from tidemark.llm.queries import END_ID, TOKENIZER, table

SHINGLE, BITS = 3, 3  # words of a shingle, most bits in which linked fingerprints differ
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose counts and content share pass; the line model learns from the rows at hand."""
    docs = docs.select(*COLUMNS)
    field = crf.fit(docs, table(spark, sf_dir, "labels"))
    return crf.judge(docs, field).filter("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that link: that of the smallest doc_id."""
    return simhash.keep_one(docs.select(*COLUMNS), bits=BITS, size=SHINGLE)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to be contaminated."""
    found = decontaminate.scan(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.filter("not contaminated").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: never, once or twice."""
    return mixing.mixed(docs.select(*COLUMNS)).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in doc_id order, and what they hold of each row."""
    path = shared_path(spark, "pipeline-token-files")
    tokenfile.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID, by_word=True)
    written = tokenfile.read_tokens(spark, path)
    return tokenfile.digests(tokenfile.with_start(written, written))


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", leaks),
    ("source mix", mix),
    ("token files", tokens),
]

# A trained line model, SimHash links and a tokenizer decide here, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
