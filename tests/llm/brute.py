"""The corpus operators' rules, written out plainly over Python lists."""

import re
from collections import defaultdict

import duckdb
import numpy as np
import xxhash
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def frame(spark, rows):
    """Documents from (doc_id, text[, lang, source]) with missing parts null."""
    full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) > 2 else [words] * bool(words)
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints):
    ids = sorted(fingerprints)
    bits = np.array([fingerprints[i] for i in ids], np.uint64)
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= 3):
            a, b = sorted((top(i), top(int(j))))
            root[b] = a
    return {d: ids[top(i)] for i, d in enumerate(ids)}


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def brute_leaks(sf, texts):
    """Whether each text is contaminated by the benchmark of a folder."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def split(text):
        return word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))

    windows = set()
    for _, text in duckdb.sql(f"SELECT * FROM '{sf}/benchmark.parquet'").fetchall():
        w = split(text)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes, out = {len(w) for w in windows}, {}
    for d, text in texts.items():
        w = split(text)
        hit = {i + k for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for k in range(n)}
        out[d] = bool(hit) and 20 * len(hit) >= len(w)
    return out
