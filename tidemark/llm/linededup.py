"""Repeated lines: keep a line in the first document that has it, as keep bitmaps per document.

Line digests are range-partitioned by (digest, document, position) and sorted in that order. Each
task streams its range: the first row of a digest names the document that keeps the line. A very
common line may fill several ranges, so what a range begins with is settled afterwards against
one row per range and digest at its edges; no digest has to fit into one task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed, map_rows, store, values

MIN_CHARS = 10


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The line stripped of ASCII white space, A-Z lower-cased; None if it is too short to count."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def line_digests(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(ord, th, pos, h1, h2) of each line that is long enough; ``rows`` come from ``keyed``."""
    rows = rows.filter("text is not null").select("ord", "th", F.col("text").cast("binary").alias("text"))

    def work(batches):
        for batch in batches:
            which, pos, parts = [], [], []
            for i, text in enumerate(values(batch.column("text"))):
                for at, line in enumerate(text.split(b"\n")):
                    key = line_key(line, min_chars)
                    if key is not None:
                        which.append(i)
                        pos.append(at)
                        parts.append(xxhash.xxh3_128_digest(key))
            halves = np.frombuffer(b"".join(parts), ">i8").astype(np.int64).reshape(-1, 2)
            take = np.array(which, np.int64)
            ids = [batch.column(c).to_numpy()[take] for c in ("ord", "th")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (*ids, np.array(pos, np.int32), halves[:, 0].copy(), halves[:, 1].copy())],
                ["ord", "th", "pos", "h1", "h2"],
            )

    return map_rows(rows, "ord long, th long, pos int, h1 long, h2 long", work)


DROP, OPEN, EDGE = 0, 1, 2


def _later(batches):
    """Rows after a digest's first document. Of the range's first digest: all, still open."""
    names = ["h1", "h2", "ord", "th", "pos"]
    last, low, opening = None, 0, True
    for batch in batches:
        h1, h2, order, th, pos = (batch.column(c).to_numpy() for c in names)
        n = len(h1)
        if not n:
            continue
        new = np.empty(n, bool)
        new[0] = last != (h1[0], h2[0])
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        starts = np.flatnonzero(new)
        run = np.cumsum(new)  # 0: goes on from the batch before
        lows = np.concatenate(([low], order[starts]))[run]
        first_run = np.zeros(n, bool)
        edge: list[int] = []
        if last is None:
            first_run = run == 1
            edge.append(0)
        elif opening:
            first_run = run == 0
        opening = bool(first_run[-1])
        kind = np.where(first_run, OPEN, np.where(order > lows, DROP, -1))
        last, low = (h1[-1], h2[-1]), int(lows[-1])
        take = np.concatenate((np.flatnonzero(kind >= 0), np.array(edge, np.int64)))
        kinds = np.concatenate((kind[kind >= 0], np.full(len(edge), EDGE)))
        yield _rows([x[take] for x in (h1, h2, order, th, pos)] + [kinds])
    if last is not None:
        yield _rows([np.array([x]) for x in (*last, low, 0, 0, EDGE)])


def _rows(cols) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(cols, kinds)],
        ["h1", "h2", "ord", "th", "pos", "kind"],
    )


def dropped_lines(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(ord, th, pos) of every line to drop; ``rows`` come from ``keyed``."""
    key = ["h1", "h2", "ord", "th", "pos"]
    lines = line_digests(rows, min_chars).repartitionByRange(*key).sortWithinPartitions(*key)
    found = store(map_rows(lines.select(*key), "h1 long, h2 long, ord long, th long, pos int, kind int", _later),
                  "later-lines")
    # two rows at most per range
    edges = found.filter(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.min("ord").alias("low"))
    settled = found.filter(F.col("kind") == OPEN).join(F.broadcast(edges), ["h1", "h2"]).filter("ord > low")
    return found.filter(F.col("kind") == DROP).select("ord", "th", "pos").union(settled.select("ord", "th", "pos"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, ord, th, n_lines, keep) per distinct (doc_id, text): a zlib-packed bit per line, 1 kept.

    A line is dropped if its key has ``min_chars`` code points and also stands in a document with
    a smaller doc_id. A null doc_id comes last; rows with equal ids are one document, whose lines
    never drop one another. A null or empty text has one line, which stays. Bits are in line
    order, most significant first.
    """
    rows = keyed(docs.select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    lines = rows.select("doc_id", "ord", "th", (breaks + 1).cast("long").alias("n_lines")).distinct()
    drops = dropped_lines(rows, min_chars).groupBy("ord", "th").agg(F.collect_set("pos").alias("drops"))

    def work(batches):
        for batch in batches:
            keep = []
            for n, drop in zip(values(batch.column("n_lines")), values(batch.column("drops"))):
                bits = np.ones(n, np.uint8)
                bits[drop or []] = 0
                keep.append(zlib.compress(np.packbits(bits).tobytes(), 1))
            kept = [batch.column(c) for c in ("doc_id", "ord", "th", "n_lines")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(keep, pa.binary())],
                                             ["doc_id", "ord", "th", "n_lines", "keep"])

    joined = lines.join(drops, ["ord", "th"], "left").select("doc_id", "ord", "th", "n_lines", "drops")
    return map_rows(joined, "doc_id long, ord long, th long, n_lines long, keep binary", work)


def kept_text(text: bytes | None, packed: bytes, n: int) -> bytes:
    bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n)
    text = text or b""
    if bits.all():
        return text
    return b"\n".join(line for line, bit in zip(text.split(b"\n"), bits) if bit)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) per row of ``docs`` with the dropped lines gone."""
    rows = keyed(docs.select("doc_id", "text")).join(bitmaps.drop("doc_id"), ["ord", "th"])
    rows = rows.select("doc_id", "n_lines", "keep", F.col("text").cast("binary").alias("text"))

    def work(batches):
        for batch in batches:
            counts, texts = [], []
            for n, keep, text in zip(*(values(batch.column(c)) for c in ("n_lines", "keep", "text"))):
                ones = int.from_bytes(zlib.decompress(keep), "big").bit_count()
                counts.append(n - ones)
                texts.append(kept_text(text, keep, n).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_lines"), pa.array(counts, pa.int64()), pa.array(texts, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "text"],
            )

    return map_rows(rows, "doc_id long, n_lines long, n_dropped long, text string", work)
