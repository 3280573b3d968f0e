"""The stages against brute force, and the last rows against the stages' own rules."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from brute import brute_components, brute_counts, brute_fingerprint, brute_leaks
from tokenizers import Tokenizer

import corpus_pipeline as P


def test_stages(spark, sf, tmp_path):
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    names = docs.columns
    for k, (_, stage) in enumerate(P.STAGES):
        path = f"{tmp_path}/{k}"
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == names or k == len(P.STAGES) - 1
        kept.append(docs.collect())
    start = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    good, single, clean, mix, tokens = kept

    for r in good:
        n, *_, repeated = brute_counts(r.text)
        assert r == start[r.doc_id] and n >= 10 and 100 * repeated <= 20 * n
    quality = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    ids = {r.doc_id for r in good}
    sound = [d for d, r in start.items() if quality.get(d) == 1 and brute_counts(r.text)[0] >= 10]
    assert sum(d in ids for d in sound) >= 0.9 * len(sound)

    roots = brute_components({r.doc_id: brute_fingerprint(r.text) for r in good})
    assert sorted(r.doc_id for r in single) == sorted(set(roots.values()))

    dirty = {d for d, bad in brute_leaks(sf, {r.doc_id: r.text for r in single}).items() if bad}
    assert {r.doc_id for r in clean} == {r.doc_id for r in single} - dirty

    times = Counter(r.doc_id for r in mix)
    assert set(times) <= {r.doc_id for r in clean} and max(times.values()) <= 2
    size = {r.doc_id: len(r.text.split()) for r in clean}
    words = sum(n * times[d] for d, n in size.items())
    assert abs(words - 1.5 * sum(size.values())) <= max(size.values()) * 20

    library = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    at, want = 0, []
    for d in sorted(times.elements()):
        seq = np.array([*library.encode(start[d].text, add_special_tokens=False).ids, 2], "<u4")
        want.append((d, at, len(seq), zlib.crc32(seq.tobytes())))
        at += len(seq)
    assert sorted(map(tuple, tokens)) == want


def test_run_is_the_stages(spark, sf):
    first = sorted(map(tuple, P.run(spark, sf).collect()))
    assert first and first == sorted(map(tuple, P.run(spark, sf).collect()))
