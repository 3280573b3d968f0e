"""The registered corpus queries: against SQL where there is SQL, else against brute force."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from brute import brute_components, brute_counts, brute_fingerprint
from tokenizers import Tokenizer

from tidemark.checks.compare import compare
from tidemark.llm import queries as Q


def rows(spark, sf, name):
    return {r[0]: r for r in Q.QUERIES[name](spark, sf).collect()}


@pytest.mark.parametrize("name", list(Q.SQL))
def test_sql(spark, sf, name):
    ok, note = compare(spark, name, Q.QUERIES[name], Q.SQL[name], sf)
    assert ok, note


def test_language(spark, sf, documents):
    got = rows(spark, sf, "op1_langid")
    assert len(got) == len(documents)
    right = Counter()
    for doc_id, _, lang, _ in documents:
        r = got[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        right[r.held_out, r.lang_pred == lang] += 1
    assert right[True, True] >= 0.97 * (right[True, True] + right[True, False])


def test_simhash(spark, sf, documents):
    got = rows(spark, sf, "op2_simhash")
    fingerprints = {d: brute_fingerprint(t) for d, t, *_ in documents}
    assert {d: int(r.fingerprint, 16) for d, r in got.items()} == fingerprints
    assert {d: r.component_id for d, r in got.items()} == brute_components(fingerprints)


def test_quality(spark, sf, documents):
    got = rows(spark, sf, "op3_quality")
    quality = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    agree = Counter()
    for doc_id, text, *_ in documents:
        r = got[doc_id]
        n, *_, repeated = counts = brute_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert not (r.base_failed and r.kept)
        if not r.base_failed and doc_id in quality:
            agree[r.kept == bool(quality[doc_id])] += 1
    assert agree[True] >= 0.97 * agree.total()


def test_mixing_nears_targets(spark, sf, documents):
    got = rows(spark, sf, "op4_mixing")
    source = {d: s for d, _, _, s in documents}
    taken, target, longest = Counter(), {}, Counter()
    for d, r in got.items():
        assert r.taken in (0, r.size, 2 * r.size)
        s = source[d]
        taken[s] += r.taken
        target[s] = r.target
        longest[s] = max(longest[s], r.size)
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in target)
    assert math.isclose(sum(target.values()), 1.5 * sum(r.size for r in got.values()))
    assert rows(spark, sf, "op4_mixing") == got


@pytest.fixture(scope="module")
def encoded(documents):
    library = Tokenizer.from_file(public_tokenizers.path(Q.TOKENIZER))
    return {d: library.encode(t or "", add_special_tokens=False).ids for d, t, *_ in documents}


def test_tokens(spark, sf, encoded):
    got, start = rows(spark, sf, "op8_tokens"), 0
    for d in sorted(encoded):
        ids = np.array([*encoded[d], 2], "<u4")
        assert tuple(got[d]) == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_counts(spark, sf, documents, encoded):
    got = rows(spark, sf, "op10_counts")
    for d, t, *_ in documents:
        n = len(encoded[d])
        assert (got[d].n_bytes, got[d].n_tokens, got[d].over_limit) == (len((t or "").encode()), n, n > 2048)


def test_digest_columns(spark, sf, documents):
    """What the digests stand for, on one document each."""
    lines = rows(spark, sf, "op6_lines")
    kept = [d for d, r in lines.items() if not r.n_dropped]
    texts = {d: t for d, t, *_ in documents}
    assert kept and all(lines[d].kept_sha256 == hashlib.sha256(texts[d].encode()).hexdigest() for d in kept)
