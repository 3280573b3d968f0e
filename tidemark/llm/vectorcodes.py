"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, exactly.

Components are scaled and floored to integers and all that follows is integer arithmetic. Parts
and entries are padded with zeros to a power of two and go through a Walsh-Hadamard transform,
which multiplies squared distances by its length and gathers most of them in the coefficients of
low sequency. Differences are summed in that order, and an entry is dropped as soon as its sum
passes the whole distance of another one; what is left is exact, not an estimate.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, plain, store

LIMB = 40  # bits of a partial sum that travel in one row, so that sums of any size stay exact
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """entries[part][entry] is a list of ``width`` integers."""

    entries: list
    width: int
    scale: int

    def digest(self) -> str:
        flat = (str(x) for book in self.entries for entry in book for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def sequency(length: int) -> np.ndarray:
    """Rows of the butterfly's Hadamard matrix by their number of sign changes (length: 2^k)."""
    bits = length.bit_length() - 1
    gray = [k ^ k >> 1 for k in range(length)]
    return np.array([int(f"{g:0{bits}b}"[::-1], 2) if bits else 0 for g in gray])


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients along the last axis, padded to a power of two, in sequency order."""
    width = x.shape[-1]
    length = 1 << max(0, width - 1).bit_length()
    out = np.zeros((*x.shape[:-1], length), x.dtype)
    out[..., :width] = x
    step = 1
    while step < length:
        pairs = out.reshape(*x.shape[:-1], -1, 2, step)
        out = np.concatenate((pairs[..., :1, :] + pairs[..., 1:, :], pairs[..., :1, :] - pairs[..., 1:, :]), axis=-2)
        out = out.reshape(*x.shape[:-1], length)
        step *= 2
    return out[..., sequency(length)]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each row, in coefficients; ties go to the lower entry.

    A row's likeliest entry by the first coefficient gives a whole distance; entries whose sum so
    far is beyond it are out, and fewer and fewer pairs see the later, longer runs of coefficients.
    """
    total = (points[:, None, 0] - entries[None, :, 0]) ** 2
    bound = ((points - entries[total.argmin(axis=1)]) ** 2).sum(axis=1)
    rows, cols = np.nonzero(total <= bound[:, None])
    sums, at, run = total[rows, cols], 1, 1
    while at < points.shape[1]:
        part = slice(at, at + run)
        sums = sums + ((points[rows, part] - entries[cols, part]) ** 2).sum(axis=1)
        live = sums <= bound[rows]
        rows, cols, sums = rows[live], cols[live], sums[live]
        at, run = at + run, 2 * run
    least = np.minimum.reduceat(sums, np.searchsorted(rows, np.arange(len(points))))
    best = np.flatnonzero(sums == least[rows])
    return cols[best[np.unique(rows[best], return_index=True)[1]]], least


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each list as a row, zeros after its end; Python integers if they are large."""
    sizes = np.asarray(column.value_lengths())
    rows = np.zeros((len(column), width))
    rows[np.arange(width)[None, :] < sizes[:, None]] = np.asarray(column.flatten().cast(pa.float64()))
    # far below where the distance of two rows, times the transform's length, could leave 64 bits
    if np.abs(rows).max(initial=0) * scale < min(1 << 26, (1 << 30) / max(1, width)):
        return np.floor(rows * scale).astype(np.int64)
    whole = np.abs(rows) >= 1 << 52  # such a number is an integer, and scaling it might overflow
    out = np.floor(np.where(whole, 0, rows) * scale).astype(object)
    out[~whole] = [int(x) for x in out[~whole]]
    out[whole] = [int(x) * scale for x in rows[whole]]
    return out


class Matcher:
    """Assigns the parts of a batch of vectors to the entries of the codebooks."""

    def __init__(self, books: Codebooks) -> None:
        self.books = books
        large = max((abs(x) for book in books.entries for e in book for x in e), default=0) >= 1 << 26
        kind = object if large or books.width * len(books.entries) > 1 << 8 else np.int64
        self.entries = [np.array(book, kind).reshape(len(book), books.width) for book in books.entries]
        self.coefficients = [transform(e) for e in self.entries]

    def assign(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(integers by part, codes, summed squared distances): n x parts x width, n x parts, n."""
        parts = len(self.entries)
        x = integers(column, parts * self.books.width, self.books.scale)
        if x.dtype != object and self.entries[0].dtype == object:
            x = x.astype(object)
        x = x.reshape(len(x), parts, self.books.width)
        found = [nearest(transform(x[:, p]), self.coefficients[p]) for p in range(parts)]
        length = self.coefficients[0].shape[1]
        errors = sum(d.astype(object) for _, d in found) // length  # the transform's length divides them
        return x, np.stack([c for c, _ in found], axis=1), errors


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, label, v), stored: the rows whose vector is there and has finite components only."""
    rows = plain(vectors, "vec_id", "label", column).toDF("vec_id", "label", "v")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return store(rows.filter(F.col("v").isNotNull() & ~bad), "vectors")


def fit(kept: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Codebooks:
    """Codebooks of all rows of ``usable``: the first entries, then rounds of assigning and averaging.

    The first entries are the parts of the rows with the smallest vec_id (null last, then by
    vector). With fewer rows there are fewer entries. Vectors are read as if zeros followed up to
    the longest one, rounded up to whole parts. ``scale`` is a power of two, so scaling is exact.
    The driver holds the codebooks alone: parts x entries x width integers, whatever the rows.
    """
    if scale < 1 or scale & scale - 1:
        raise ValueError("the scale must be a power of two")
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte: 1 to 256 entries")
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    start = integers(pa.array([r.v for r in first], pa.list_(pa.float64())), parts * width, scale).tolist()
    books = Codebooks([[row[p * width : (p + 1) * width] for row in start] for p in range(parts)], width, scale)
    for _ in range(rounds if start else 0):
        books = _averaged(kept, books)
    return books


def _averaged(kept: DataFrame, books: Codebooks) -> Codebooks:
    parts, entries, width = len(books.entries), len(books.entries[0]), books.width

    def work(batches):
        matcher = Matcher(books)
        sums = np.zeros((parts, entries, width + 1), object)  # the last column counts
        for batch in batches:
            if not batch.num_rows:
                continue
            x, codes, _ = matcher.assign(batch.column(0))
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                used, turns, n = np.unique(codes[order, p], return_index=True, return_counts=True)
                sums[p, used, width] += n.astype(object)
                if width:
                    sums[p, used, :width] += np.add.reduceat(x[order, p], turns).astype(object)
        out = []
        for slot, total in enumerate(sums.ravel()):
            sign, left, limb = (1 if total > 0 else -1), abs(int(total)), 0
            while left:
                out.append((slot, limb, sign * (left & (1 << LIMB) - 1)))
                left, limb = left >> LIMB, limb + 1
        cols = list(zip(*out)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["slot", "limb", "total"])

    partial = map_rows(kept.select("v"), "slot long, limb long, total long", work)
    sums = np.zeros(parts * entries * (width + 1), object)
    for slot, limb, total in partial.groupBy("slot", "limb").agg(F.sum("total")).collect():
        sums[slot] += total << LIMB * limb
    sums = sums.reshape(parts, entries, width + 1).tolist()
    new = [
        [[s // row[width] for s in row[:width]] if row[width] else old for row, old in zip(book, before)]
        for book, before in zip(sums, books.entries)
    ]
    return Codebooks(new, width, books.scale)


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of rows of ``usable``: one byte per part, the summed squared distances.

    An error beyond 64 bits is null. Repeated rows keep their own rows; a null vec_id or label stays null.
    """
    ids = kept.schema

    def work(batches):
        matcher = Matcher(books)
        for batch in batches:
            if not batch.num_rows:
                continue
            _, codes, errors = matcher.assign(batch.column("v"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("label"),
                    pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary()),
                    pa.array([int(e) if e <= _LONG else None for e in errors], pa.int64()),
                ],
                ["vec_id", "label", "code", "error"],
            )

    kinds = f"vec_id {ids['vec_id'].dataType.simpleString()}, label {ids['label'].dataType.simpleString()}"
    return map_rows(kept, f"{kinds}, code binary, error long", work)


def label_totals(coded: DataFrame) -> DataFrame:
    """(label, label_error): the errors of each label, null labels together; null beyond 64 bits."""
    whole = F.count("error") == F.count(F.lit(1))
    return coded.groupBy("label").agg(F.when(whole, F.try_sum("error")).alias("label_error"))
