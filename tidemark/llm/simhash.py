"""Near duplicates by SimHash: fingerprints of word shingles, linked at few differing bits.

Pigeonhole: 64 bits are cut into ``bits + 3`` blocks. Two fingerprints that differ in at most
``bits`` bits agree in three whole blocks, so each fingerprint is filed under every choice of
three blocks (20 keys of about 32 bits for 3 bits) and only files with company are looked at.
Keys this long keep chance company rare also among billions of documents.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, map_rows, order_key, plain, slices, store, values

CROWD = 4096  # files with more fingerprints are filed once more, by the bits outside their key
SUB_BLOCKS = 8
CHUNK = 1 << 16


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """SimHash of the shingles of ``size`` words, as a signed 64-bit number."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    size = min(size, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = slice(at, min(at + CHUNK, n))
        pairs = zip(starts[part].tolist(), ends[part.start + size - 1 : part.stop + size - 1].tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > n, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, *carry: str, size: int = 3) -> DataFrame:
    """(carry..., fp) of each row; a null or empty text has fingerprint 0."""
    if size < 1:
        raise ValueError("a shingle has one word at least")
    docs = docs.select(*carry, F.col("text").cast("binary").alias("_text"))
    schema = docs.select(*carry, F.lit(0).cast("long").alias("fp")).schema

    def work(batches):
        for batch in slices(batches):
            found = pa.array([fingerprint(t, size) for t in values(batch.column("_text"))], pa.int64())
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, found], [*batch.schema.names[:-1], "fp"])

    return map_rows(docs, schema, work)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(positions: list[int], blocks: int, shared: int) -> list[int]:
    """Bit masks of every choice of ``shared`` blocks out of ``blocks`` cut from the positions."""
    cut = [sum(1 << int(p) for p in part) for part in np.array_split(positions, blocks)]
    return [sum(choice) for choice in combinations(cut, shared)]


def _links(bits: int):
    """Within runs of equal (t, s, k): edges of a spanning forest of the fingerprints that link."""

    def tree(members: np.ndarray, out: list) -> None:
        left = members
        while len(left):
            todo, left = [left[0]], left[1:]
            while todo and len(left):
                near = np.bitwise_count((left ^ todo[-1]).view(np.uint64)) <= bits
                seed = int(todo.pop())
                if near.any():
                    reached = left[near]
                    out.extend((seed, x) for x in reached.tolist())
                    todo.extend(reached)
                    left = left[~near]

    def work(batches):
        held, key = [], None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            fps, out = batch.column(3).to_numpy(zero_copy_only=False), []
            if not len(fps):
                continue
            turns = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            for a, b in zip([0, *turns], [*turns, len(fps)]):
                now = tuple(int(c[a]) for c in cols)
                if now != key:
                    if held:
                        tree(np.concatenate(held), out)
                    held, key = [], now
                held.append(fps[a:b])
            yield _edges(out)
        if held:
            tree(np.concatenate(held), out := [])
            yield _edges(out)

    return work


def _edges(pairs: list) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links(fps: DataFrame, bits: int = 3, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) that join the distinct fingerprints ``fp`` into the components of all links.

    Files of two are compared as they are counted. Larger ones give a spanning forest in place of
    all their pairs. A file above ``crowd`` is filed again by five of eight blocks of its other
    bits, which bounds a file at about 2^12 fingerprints whatever the number of rows.
    """
    if not 0 <= bits <= 3:
        raise ValueError("bits must be from 0 to 3")
    spark, shared = fps.sparkSession, 3
    masks = _masks(list(range(64)), bits + shared, shared)
    filed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(_signed(m)) for m in masks]))
                       .alias("t", "k"))
    files = filed.groupBy("t", "k").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    files = store(files.filter("n > 1"), "files")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    pairs = files.filter(F.col("n") == 2).filter(near).select("a", "b")
    larger = filed.join(files.filter("n > 2").select("t", "k", "n"), ["t", "k"])
    sub = [
        (t, s, _signed(mask | more))
        for t, mask in enumerate(masks)
        for s, more in enumerate(
            _masks([p for p in range(64) if not mask >> p & 1], SUB_BLOCKS, SUB_BLOCKS - bits))
    ]
    sub = spark.createDataFrame(sub, "t int, s int, mask long")  # 20 x 56 rows
    crowded = larger.filter(F.col("n") > crowd).join(F.broadcast(sub), "t")
    runs = larger.filter(F.col("n") <= crowd).select("t", F.lit(-1).alias("s"), "k", "fp").union(
        crowded.select("t", "s", F.col("fp").bitwiseAND(F.col("mask")).alias("k"), "fp"))
    runs = runs.repartition("t", "s", "k").sortWithinPartitions("t", "s", "k", "fp")
    return pairs.union(map_rows(runs, "a long, b long", _links(bits))).distinct()


def near_duplicates(docs: DataFrame, bits: int = 3, size: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) per row; component_id is the smallest doc_id of the component.

    Null texts, empty texts and texts of white space share fingerprint 0. Repeated rows keep their
    own row. A null doc_id is linked like any other and is no component's smallest unless alone.
    """
    marked = store(fingerprints(plain(docs, "doc_id", "text"), "doc_id", size=size), "fingerprints")
    return with_components(marked, bits).drop("root")


def with_components(marked: DataFrame, bits: int = 3) -> DataFrame:
    """Add root (a fingerprint of the component) and component_id to rows with doc_id and fp."""
    fps = store(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), bits)).withColumnRenamed("node", "fp")
    fps = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = fps.groupBy("root").agg(F.min("low").alias("component_id"))
    named = fps.join(lows, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp")


def keep_one(docs: DataFrame, bits: int = 3, size: int = 3) -> DataFrame:
    """One row of each component: the one with the smallest doc_id (ties: the smaller row hash).

    All columns are returned as they came. Null doc_ids come last; of identical rows one stays.
    """
    names = docs.columns
    if len(set(n.lower() for n in names)) < len(names):
        raise ValueError("column names must differ")
    whole = [F.col(f"`{n}`") for n in names]
    place = (order_key().alias("o"), F.xxhash64(*whole).alias("h"))
    marked = fingerprints(docs.select("doc_id", "text", *place), "doc_id", "o", "h", size=size)
    marked = with_components(store(marked, "fingerprints"), bits)
    kept = marked.groupBy("root").agg(F.min(F.struct("o", "h")).alias("first"))
    kept = kept.select("first.o", "first.h").distinct()
    rows = docs.select(*place, F.struct(*whole).alias("row"))
    return rows.join(kept, ["o", "h"]).dropDuplicates(["o", "h"]).select("row.*")
