"""Benchmark leaks: one Aho-Corasick automaton over the words of all items, one scan of each text.

Words are runs of a-z, 0-9 (A-Z lower-cased) and of any character beyond ASCII. The automaton's
alphabet is words, not characters, so its size is the number of windows times their length.
"""

from __future__ import annotations

import math

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, slices, store, values

ITEM_BYTES = 8 << 20  # benchmark text behind one automaton; a larger benchmark takes several scans
RATE = 20  # contaminated: one word in so many is hit
_BREAKS = bytes(
    (b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32) for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_BREAKS).split()


class Leaks:
    """The windows of the items, and the automaton that finds them in a list of words."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int) -> None:
        windows: dict[tuple, set] = {}
        self.codes: dict[bytes, int] = {}
        for item_id, text in items:
            found = [self.codes.setdefault(w, len(self.codes) + 1) for w in words(text)]
            for at in range(max(1, len(found) - size + 1) if found else 0):
                windows.setdefault(tuple(found[at : at + size]), set()).add(item_id)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, ids in windows.items():
            self.automaton.add_word(window, (len(window), frozenset(ids - {None})))
        if windows:
            self.automaton.make_automaton()
        self.empty = not windows

    def find(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Maximal runs [first, last] of hit words in order, and the ids of the items found."""
        if self.empty or not text_words:
            return [], set()
        coded = tuple(self.codes.get(w, 0) for w in text_words)
        spans, ids = [], set()
        for end, (length, found) in self.automaton.iter(coded):
            spans.append((end - length + 1, end))
            ids |= found
        return merged(spans), ids


def merged(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def original(text: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """Runs of words as [start, end) code points of the text as it was."""
    if not runs:
        return []
    kept = np.frombuffer(text.translate(_BREAKS), np.uint8) != 32
    edges = np.diff(kept.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    raw = np.frombuffer(text, np.uint8)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [{"start": int(points[starts[a]]), "end": int(points[ends[b]])} for a, b in runs]


def scan(docs: DataFrame, benchmark: DataFrame, size: int = 13, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """Add to each row what of the benchmark its text holds; rows and other columns stay as they are.

    n_words, n_hit (words inside an occurrence of a window), items (ids found, sorted as strings),
    spans (start, end: code points of the original text, maximal runs of hit words) and
    contaminated (n_hit > 0 and n_hit at least one word in ``RATE``).

    A null text has no words. An item without words has no window; one without an id hits words
    but is not listed. ``docs`` may hold any columns but the five names above. The item text on
    the driver and in a broadcast is at most about ``item_bytes``: a larger benchmark is split by
    hash and the texts are scanned once for each part.
    """
    if size < 1:
        raise ValueError("a window has one word at least")
    added = "n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"
    names = [*docs.columns]
    clash = {"n_words", "n_hit", "items", "spans", "contaminated"} & {n.lower() for n in names}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary").alias("text"))
    items = items.filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, math.ceil(total / item_bytes))
    share = items.withColumn("_p", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    runs = "_hits"
    while runs in {n.lower() for n in names}:
        runs += "_"
    state = docs
    for part in range(parts):
        rows = [tuple(r) for r in share.filter(F.col("_p") == part).select("item_id", "text").collect()]
        held = docs.sparkSession.sparkContext.broadcast([(i, bytes(t)) for i, t in rows])
        later = part > 0
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", " + added
        schema += f", {runs} array<int>"
        state = map_rows(state, schema, _scanner(held, size, names, runs, later))
        if parts > 1:
            state = store(state, "leaks")
    rate = F.col("n_hit") * RATE
    return state.drop(runs).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (rate >= F.col("n_words"))
    )


def _scanner(held, size: int, names: list[str], kept_runs: str, later: bool):
    def work(batches):
        leaks = None
        for batch in slices(batches):
            leaks = leaks or Leaks(held.value, size)
            texts = values(batch.column(names.index("text")).cast(pa.binary()))
            before = values(batch.column(kept_runs)) if later else [()] * len(texts)
            listed = values(batch.column("items")) if later else [()] * len(texts)
            cols: list[list] = [[], [], [], [], []]
            for text, old, ids in zip(texts, before, listed):
                found = words(text) if text else []
                runs, hit = leaks.find(found)
                if old:
                    runs = merged(runs + list(zip(old[::2], old[1::2])))
                row = (
                    len(found),
                    sum(b - a + 1 for a, b in runs),
                    sorted(hit.union(ids)),
                    original(text, runs) if runs else [],
                    [x for run in runs for x in run],
                )
                for col, value in zip(cols, row):
                    col.append(value)
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(span), pa.list_(pa.int32())]
            kept = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(c, k) for c, k in zip(cols, kinds))],
                [*names, "n_words", "n_hit", "items", "spans", kept_runs],
            )

    return work
