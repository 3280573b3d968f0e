"""Vector codes against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import queries, vectorcodes
from tidemark.llm.vectorcodes import Codebooks, nearest, sequency, transform

SCHEMA = "vec_id long, embedding array<double>, label int, v string, code string"


def brute(rows, parts=8, size=16, rounds=6):
    """Codes, errors and codebooks of (vec_id, vector, label) rows by the definition, in Python integers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(r[1]) for r in rows), default=0) // parts)

    def whole(x):
        n, d = x.as_integer_ratio()
        return 4096 * n // d

    vectors = [[whole(float(x)) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in rows]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in vectors]
    books = [[v[p] for v in cut[:size]] for p in range(parts)]

    def assign():
        out = []
        for v in cut:
            found = [min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p])) for p, x in enumerate(v)]
            out.append(([i for _, i in found], sum(d for d, _ in found)))
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, (c, _) in zip(cut, codes) if c[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    done = sorted(((str(r[0]), r[2], bytes(c), d) for r, (c, d) in zip(rows, assign())), key=repr)
    return done, books


def coded(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    kept = vectorcodes.usable(table)
    books = vectorcodes.fit(kept, **options)
    found = [(str(r.vec_id), r.label, bytes(r.code), r.error) for r in vectorcodes.encode(kept, books).collect()]
    return sorted(found, key=repr), books.entries


@pytest.mark.parametrize("length", [1, 2, 4, 8, 32])
def test_transform(length):
    """Rows of signs with 0, 1, 2, ... changes, each orthogonal to the others."""
    rows = transform(np.eye(length, dtype=np.int64)).T
    assert [int((r[1:] != r[:-1]).sum()) for r in rows] == list(range(length))
    assert np.array_equal(rows @ rows.T, length * np.eye(length)) and len(set(sequency(length).tolist())) == length


@pytest.mark.parametrize("kind", [np.int64, object])
@pytest.mark.parametrize("width", [1, 3, 8, 13])
def test_nearest_is_exact(kind, width):
    rng = np.random.default_rng(width)
    for spread in (2, 50, 5000):
        points, entries = rng.integers(-spread, spread, (200, width)), rng.integers(-spread, spread, (16, width))
        entries[9] = entries[4]  # a tie for every point
        plain = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        code, error = nearest(transform(points.astype(kind)), transform(entries.astype(kind)))
        length = transform(entries).shape[1]
        assert np.array_equal(code, plain.argmin(axis=1)) and np.array_equal(error // length, plain.min(axis=1))


def test_against_plain_arithmetic(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 24).tolist(), i % 3 if i % 7 else None) for i in range(300)]
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 1), (None, rows[3][1], None), (None, [0.0] * 24, 2), (5, [-0.0] * 24, 2)]
    rows += [(900, None, 1), (901, [None] * 24, 1), (902, [math.nan] + [0.0] * 23, 1), (903, [math.inf] * 24, 0)]
    want, books = brute(rows)
    assert coded(spark, rows) == (want, books)
    assert coded(spark, rows[:5], entries=16) == brute(rows[:5])  # fewer rows than entries


def test_uneven_and_large_vectors(spark):
    """Short vectors end in zeros; components beyond 64 bits stay exact, and too large an error is null."""
    rows = [(i, [float((i * k) % 11) / 3 for k in range(1 + i % 20)], 0) for i in range(60)] + [(61, [], 0)]
    assert coded(spark, rows) == brute(rows)
    rows += [(70 + i, [1e30 * i, -3e17, 2.5] * 4, 1) for i in range(3)] + [(80, [1e308] * 3, 1)]
    want, books = brute(rows)
    got, entries = coded(spark, rows)
    assert entries == books
    assert got == sorted([(*r[:3], r[3] if r[3] < 1 << 63 else None) for r in want], key=repr)


def test_nothing_to_code(spark):
    for rows in ([], [(1, None, 1), (2, [math.nan], 1)]):
        assert coded(spark, rows) == ([], [[]] * 8)
    assert coded(spark, [(1, [], None), (2, [], 3)]) == brute([(1, [], None), (2, [], 3)])


def test_digest_and_labels(spark, sf):
    rows = queries.op11_codes(spark, sf).collect()
    start = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want, books = brute([(r.vec_id, list(r.embedding), r.label) for r in start])
    flat = ",".join(str(x) for book in books for e in book for x in e)
    assert {r.codebooks_sha256 for r in rows} == {hashlib.sha256(flat.encode()).hexdigest()}
    assert Codebooks(books, 8, 4096).digest() == rows[0].codebooks_sha256
    assert sorted((str(r.vec_id), r.code, r.error) for r in rows) == sorted((i, c.hex(), e) for i, _, c, e in want)
    label = {r.vec_id: r.label for r in start}
    total = {x: sum(r.error for r in rows if label[r.vec_id] == x) for x in set(label.values())}
    assert all(r.label_error == total[label[r.vec_id]] for r in rows)
