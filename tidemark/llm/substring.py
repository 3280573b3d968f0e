"""Repeated passages: Rabin-Karp hashes of every window of words, counted in Spark.

A window repeats if its words also start in a document with a smaller doc_id. Every window is
hashed, but shuffling one row per window would move several times the corpus. So windows travel
in runs: neighbouring windows with the same minimiser (the least hash of the short grams inside
a window, on average that of some twenty windows). Equal windows have equal minimisers, hence

* a run whose minimiser occurs in one document only cannot repeat;
* a run whose list of window hashes is found in an earlier document repeats as a whole;
* only where one minimiser has different runs, at the ends of shared passages, the windows of the
  first holders of each run are counted one by one.

Repeated windows and runs then merge into maximal intervals of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keyed, map_rows, store, values
from tidemark.scale import broadcast_if_small

WINDOW = 50
GRAM = 12
# odd multipliers of the two rolling hashes, and their inverses modulo 2^64
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Hashes modulo 2^64 of all windows of any length over one list of words."""

    def __init__(self, words: list[bytes]) -> None:
        digest, n = xxhash.xxh64_intdigest, len(words)
        self.n, self.digests = n, np.fromiter(map(digest, words), np.uint64, n)
        self.sums: dict[int, tuple] = {}

    def windows(self, size: int, which: int = 0) -> np.ndarray:
        if which not in self.sums:
            terms = self.digests * _powers(BASES[which], self.n)
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
            self.sums[which] = total, _powers(INVERSES[which], self.n)
        total, back = self.sums[which]
        many = self.n - size + 1
        return (total[size:] - total[:many]) * back[:many]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by running minima inside blocks from both sides."""
    n = len(x)
    if width == 1:
        return x
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs_of(words: list[bytes], window: int, gram: int):
    """(window hashes, minimiser of each window, starts of the runs, ends of the runs)."""
    rolling = Rolling(words)
    # a bijective scramble, as sums of few terms are not evenly spread in their high bits
    grams = rolling.windows(gram) * np.uint64(BASES[1])
    grams ^= grams >> np.uint64(32)
    low = sliding_min(grams * np.uint64(BASES[0]), window - gram + 1)
    turns = np.flatnonzero(low[1:] != low[:-1]) + 1
    starts = np.concatenate(([0], turns))
    return rolling, low, starts, np.concatenate((turns, [len(low)]))


def window_runs(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(m, r1, r2, n, ord, th, start): runs of ``n`` windows under minimiser m, digest (r1, r2)."""
    rows = rows.filter("text is not null").select("ord", "th", F.col("text").cast("binary").alias("text"))

    def work(batches):
        for batch in batches:
            ids = [batch.column(c).to_numpy() for c in ("ord", "th")]
            found: list[list] = [[], [], [], [], []]
            for i, text in enumerate(values(batch.column("text"))):
                words = text.split()
                if len(words) < window:
                    continue
                rolling, low, starts, ends = runs_of(words, window, gram)
                hashes = rolling.windows(window).tobytes()
                digest = xxhash.xxh3_128_digest
                cuts = zip((starts * 8).tolist(), (ends * 8).tolist())
                parts = b"".join([digest(hashes[a:b]) for a, b in cuts])
                new = (np.full(len(starts), i), low[starts].view(np.int64), np.frombuffer(parts, "<i8").reshape(-1, 2),
                       ends - starts, starts)
                for col, value in zip(found, new):
                    col.append(value)
            if not found[0]:
                continue
            take, m, r, n, start = (np.concatenate(c) for c in found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (m, r[:, 0].copy(), r[:, 1].copy(), n.astype(np.int32), ids[0][take],
                                       ids[1][take], start.astype(np.int32))],
                ["m", "r1", "r2", "n", "ord", "th", "start"],
            )

    return map_rows(rows, "m long, r1 long, r2 long, n int, ord long, th long, start int", work)


def single_windows(rows: DataFrame, wanted: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h1, h2, ord, th, pos) of each window of the wanted runs (ord, th, start, n)."""
    lists = wanted.groupBy("ord", "th").agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    lists = store(lists, "wanted-runs")
    # where the keys are few, the texts of other documents are not even shuffled
    few = rows.join(broadcast_if_small(lists.select("ord", "th")), ["ord", "th"], "left_semi")
    few = few.dropDuplicates(["ord", "th"]).join(lists, ["ord", "th"])
    few = few.select("ord", "th", F.col("text").cast("binary").alias("text"), "runs")

    def work(batches):
        for batch in batches:
            columns = (values(batch.column(c)) for c in ("ord", "th", "text", "runs"))
            for order, th, text, runs in zip(*columns):
                rolling = Rolling(text.split())
                pos = np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in runs])
                hashes = [rolling.windows(window, k)[pos].view(np.int64) for k in (0, 1)]
                same = [np.full(len(pos), x, np.int64) for x in (order, th)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (*hashes, *same, pos.astype(np.int32))], ["h1", "h2", "ord", "th", "pos"])

    return map_rows(few, "h1 long, h2 long, ord long, th long, pos int", work)


def removal_intervals(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(ord, th, start, end) of the maximal runs of words to remove; ``rows`` come from ``keyed``."""
    if not 0 < gram <= window:
        raise ValueError("a gram must fit into the window")
    runs = store(window_runs(rows, window, gram), "runs")
    digest = F.struct("r1", "r2", "n")
    shared = runs.groupBy("m").agg(
        F.min("ord").alias("low"), F.max("ord").alias("high"), (F.min(digest) != F.max(digest)).alias("varied"))
    # aggregates are stored before they are joined, so that a skewed join has two plain shuffles
    # to split between tasks
    shared = store(shared.filter("low < high").select("m", "varied"), "shared-minimisers")
    met = store(runs.join(shared, "m"), "shared-runs")
    key = ["m", "r1", "r2", "n"]
    first = store(met.groupBy(*key).agg(F.min("ord").alias("low")), "first-runs")
    judged = store(met.join(first, key).select("ord", "th", "start", "n", "varied", (F.col("ord") > F.col("low")).alias("later")),
                   "judged-runs")
    whole = judged.filter("later").select("ord", "th", "start", (F.col("start") + F.col("n") - 1 + window).alias("end"))
    single = store(single_windows(rows, judged.filter("varied and not later"), window), "windows")
    low = single.groupBy("h1", "h2").agg(F.min("ord").alias("low"), F.max("ord").alias("high"))
    low = store(low.filter("low < high").select("h1", "h2", "low"), "first-windows")
    few = single.join(low, ["h1", "h2"]).filter("ord > low")
    few = few.select("ord", "th", F.col("pos").alias("start"), (F.col("pos") + window).alias("end"))
    return islands(whole.union(few).distinct())


def islands(spans: DataFrame) -> DataFrame:
    """Overlapping and touching [start, end) of one (ord, th) as one; a window holds one text's spans."""
    w = Window.partitionBy("ord", "th").orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    numbered = spans.withColumn("_new", fresh).withColumn("_isle", F.sum("_new").over(w))
    merged = numbered.groupBy("ord", "th", "_isle").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.drop("_isle")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) per row; kept: the words left, joined by a space.

    Words are separated by ASCII white space and compared unchanged. A null text has none. A null
    doc_id comes last; rows with equal ids are one document and remove nothing from one another.
    Windows are judged on the input, not on what is left.
    """
    rows = keyed(docs.select("doc_id", "text"))
    found = removal_intervals(rows, window, gram)
    found = found.groupBy("ord", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(found, ["ord", "th"], "left")
    joined = joined.select("doc_id", F.col("text").cast("binary").alias("text"), "spans")

    def work(batches):
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, spans in zip(*(values(batch.column(c)) for c in ("text", "spans"))):
                words = text.split() if text else []
                spans = sorted(spans or [], key=lambda s: s["start"])
                kept, at = [], 0
                for s in spans:
                    kept += words[at : s["start"]]
                    at = s["end"]
                kept += words[at:]
                for col, value in zip(out, (len(words), len(words) - len(kept), spans, b" ".join(kept).decode())):
                    col.append(value)
            kinds = [pa.int64(), pa.int64(), span, pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start: int, end: int>>, kept string"
    return map_rows(joined, schema, work)


