"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import SCHEMA, brute_components, brute_counts, brute_fingerprint, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import (
    crf, decontaminate, langid, linededup, mixing, simhash, substring, tokencount, tokenfile, urlfilter,
)
from tidemark.llm.common import components, keyed
from tidemark.llm import tokenizer
from tidemark.llm.tokenizer import Encoder, load

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and blank texts, a repeated row, one id twice, one very long text."""
    rows = [
        (1, None, "en", "a"), (2, "", "en", "b"), (3, " \t\n ", None, None), (4, "One two", "de", "a"),
        (5, LONG, "en", "a"), (6, LONG, "en", None), (7, "same row of words", "en", "a"),
        (7, "same row of words", "en", "a"), (8, "first text of id eight", "en", "b"), (8, "second text", "en", "b"),
        (None, "no id at all here", "en", "a"), (None, None, None, None), (None, LONG, "en", "b"),
    ]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (None, 0, 0), (5, None, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "one, TWO"), (2, None), (3, " .. "), (None, "first text")], "item_id long, text string")


def clashing(docs):
    """Further columns named as the operators name their own."""
    names = ("ord", "th", "fp", "w", "p", "rank", "start", "end", "size", "target", "m", "n", "k", "part", "score", "spans_",
             "_h", "_o", "_th", "_n", "_m", "_hits", "_text", "_c", "o", "h", "row", "first", "root")
    for name in names:
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def every_operator(spark, docs, labels, items, tmp):
    field = crf.fit(docs, labels)
    tokens = f"{tmp}/tokens"
    tokenfile.write_tokens(docs, tokens, TOKENIZER, 2, by_word=True)
    stored = tokenfile.read_tokens(spark, tokens)
    return {
        "language": langid.identify(docs, held_out()),
        "simhash": simhash.near_duplicates(docs),
        "quality": crf.judge(docs.select("doc_id", "text"), field),
        "mix": mixing.mix(docs),
        "passages": substring.remove_repeats(docs),
        "lines": linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)),
        "tokens": tokenfile.digests(tokenfile.with_start(stored, stored)),
        "leaks": decontaminate.scan(docs, items),
        "counts": tokencount.count_tokens(docs, f"{tmp}/cache", TOKENIZER, by_word=True),
    }


def test_a_row_for_each_row(spark, odd, labels, items, tmp_path):
    ids = Counter(r.doc_id for r in odd.select("doc_id").collect())
    for name, out in every_operator(spark, clashing(odd), labels, items, tmp_path).items():
        assert Counter(r.doc_id for r in out.select("doc_id").collect()) == ids, name


def test_rows_come_back_as_they_were(spark, odd, items):
    """Operators that return the caller's rows change none of its columns, whatever their names."""
    docs = clashing(odd)
    start = {tuple(r) for r in docs.collect()}
    for out in (simhash.keep_one(docs), mixing.mixed(docs), decontaminate.scan(docs, items).select(*docs.columns)):
        assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= start
    assert decontaminate.scan(docs, items, item_bytes=20).select(*docs.columns).count() == docs.count()


def test_equal_rows_are_dealt_together(spark, monkeypatch):
    """A row that is there often is copied as often as its equals are taken, in portions."""
    monkeypatch.setattr(mixing, "PORTION", 7)
    rows = frame(spark, [(5, "five words are in here", "en", "a")] * 60 + [(i, "two words", "en", "b") for i in range(40)])
    taken = Counter({r.doc_id: 0 for r in rows.collect()})
    for r in mixing.mix(rows).collect():
        taken[r.doc_id] += r.n_copies
    assert Counter(r.doc_id for r in mixing.mixed(rows).collect()) == +taken and taken[5] > 14


def test_empty_tables(spark, nothing, labels, items, tmp_path):
    for name, out in every_operator(spark, nothing, labels.limit(0), items.limit(0), tmp_path).items():
        assert out.count() == 0, name
    assert urlfilter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert mixing.mixed(nothing).count() == simhash.keep_one(nothing).count() == 0


def test_pipeline_on_odd_rows(spark, odd, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{rows.count()}-{k}"
            stage(spark, docs.withColumn("extra", F.lit(1)) if k == 0 else docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            assert k == 4 or docs.columns == odd.columns


# language


def test_language_edges(spark):
    rows = [(i, t, x) for i, (t, x) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 30)]
    rows += [(1001, None, "en"), (1002, "12 + 4", "en"), (1003, "", "de"), (1004, "the dog", None), (None, "und die", "de")]
    got = {r.doc_id: r for r in langid.identify(frame(spark, rows), held_out()).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1001, 1002, 1003))
    assert got[1004].lang_pred == "en" and got[None].lang_pred == "de" and got[None].held_out is False


def test_nothing_to_learn(spark):
    got = langid.identify(frame(spark, [(1, "words", None), (2, None, "en")]), held_out()).collect()
    assert {r.lang_pred for r in got} == {"und"}


def test_held_out_rows_teach_nothing(spark):
    held = [i for i in range(400) if (zlib.crc32(str(i).encode()) % 3 == 1)]
    rows = [(i, "hund katze maus", "xx" if i in held else "de") for i in range(400)]
    assert {r.lang_pred for r in langid.identify(frame(spark, rows), held_out()).collect()} == {"de"}


@pytest.mark.parametrize("n", [2, 3, 6, 7, 40])
def test_codewords_differ(n):
    code = langid.codebook(n)
    assert len({tuple(c) for c in code.tolist()}) == n
    assert all(0 < column.sum() < n for column in code.T)
    least = min(int((a != b).sum()) for a, b in combinations(code, 2))
    assert least >= (1 if n == 2 else 2) and (n < 7 or least >= 3)


def test_grams_of_a_long_text_do_not_depend_on_slices(monkeypatch):
    whole = langid.gram_counts("abc déf " * 50)
    monkeypatch.setattr(langid, "CHUNK", 100)
    cut = langid.gram_counts("abc déf " * 50)
    assert np.abs(whole - cut).sum() <= 24 * 4  # a few at the seams


# near duplicates


def test_simhash_edges(spark, odd):
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(odd).collect()]
    by_text = Counter(got)
    zero = [c for d, f, c in got if f == 0]
    assert len(zero) == 4 and set(zero) == {1}
    assert by_text[next(x for x in got if x[0] == 7)] == 2
    assert {c for d, f, c in got if f == next(x for x in got if x[0] == 5)[1]} == {5}


@pytest.mark.parametrize("crowd", [2, 50, 4096])
def test_crowded_files(spark, crowd):
    """Dense balls of fingerprints, with files far above the bound, against all pairs."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    fps = set()
    for c in centres.tolist():
        for _ in range(150):
            flips = rng.choice(64, rng.integers(0, 9), replace=False)
            fps.add(c ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    marked = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    edges = simhash.links(marked.select("fp"), crowd=crowd)
    assert edges.count() <= 20 * 56 * len(fps)
    roots = {r.node: r.root for r in components(edges).collect()}
    want = brute_components(dict(enumerate(fps)))
    mine = {}
    for i, f in enumerate(signed):
        mine.setdefault(roots.get(f, f), set()).add(i)
    theirs = {}
    for i, c in want.items():
        theirs.setdefault(c, set()).add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, 0) for i in range(1, 301)}


def test_keep_one(spark, odd):
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(odd).collect()]
    assert Counter(d for d, _ in kept) == Counter([1, 4, 5, 7, 8, 8, None])
    assert brute_fingerprint(None) == 0


# quality rules


def test_counts_by_hand():
    text = "a b c d e f a b c d e\n## x\n\n## x\n \n|"
    assert crf.text_counts(text.encode()) == brute_counts(text)
    assert crf.text_counts(None) == crf.text_counts(b" \n ")[:4] + (0,) == (0, 0, 0, 0, 0)
    same = ("word " * 40).encode()
    assert crf.text_counts(same)[4] == 40
    assert crf.text_counts(LONG.encode()) == brute_counts(LONG)


def test_repeats_beyond_one_number(monkeypatch):
    words = [f"u{i}".encode() for i in range(8000)] * 2
    assert crf.repeated_words(words) == 16_000
    assert crf.repeated_words(words[:8000]) == 0


def test_viterbi_against_every_labelling():
    rng = np.random.default_rng(0)
    for n in range(1, 7):
        field = crf.LineField(rng.normal(size=len(crf.FEATURES)), rng.normal(size=(2, 2)))
        x = rng.normal(size=(n, len(crf.FEATURES)))

        def score(states, x=x, field=field):
            steps = sum(field.steps[a, b] for a, b in zip(states, states[1:]))
            return steps + sum(x[t] @ field.weights for t, s in enumerate(states) if s)

        every = [tuple(s >> t & 1 for t in range(n)) for s in range(1 << n)]
        assert tuple(field.viterbi(x)) == max(every, key=score)


def test_training_climbs_the_likelihood():
    rng = np.random.default_rng(1)
    states = [np.repeat(rng.integers(0, 2, 4), 3) for _ in range(60)]
    lines = []
    for s in states:
        x = rng.normal(size=(len(s), len(crf.FEATURES)))
        x[:, 0] = 1
        x[:, 1] = s + 0.3 * rng.normal(size=len(s))
        lines.append(x)
    field = crf.train(lines, states)
    assert field.weights[1] > 1 and field.steps[0, 0] + field.steps[1, 1] > field.steps[0, 1] + field.steps[1, 0]
    right = [np.mean(field.viterbi(x) == s) for x, s in zip(lines, states)]
    assert np.mean(right) > 0.95


def test_without_labels_the_default_decides(spark, nothing, labels):
    assert crf.fit(nothing, labels).weights.tolist() == list(crf.PRIOR)
    field = crf.default_field()
    assert field.content_share(b"A plain line of words that ends here.\nAnd one more of the kind.") == 1
    assert field.content_share(b"### $$$ &&& %%%\n<<>> || ##") == 0


def test_labels_of_other_documents_teach_nothing_and_hide_nothing(spark):
    """However many labelled ids are missing or without words, those that are there teach."""
    good = "The first line is a plain sentence.\nAnother sentence follows here, as it should."
    rows = [(i, good if i % 2 else "### $$$ |||\n*** && <<>>") for i in range(40)] + [(i, " \n") for i in range(40, 60)]
    labels = [(i, i % 2, 0) for i in range(5000)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    field = crf.fit(frame(spark, rows), labels, per_class=10)
    assert not np.array_equal(field.weights, crf.default_field().weights)
    assert field.content_share(good.encode()) == 1 and field.content_share(b"### $$$ |||\n*** && <<>>") == 0


def test_lines_are_not_taken_from_the_top():
    """Runs of a long text start where a digest of it says, so its end teaches as well."""
    starts = set()
    for k in range(200):
        text = "\n".join(f"{k} " + "word " * (i + 1) for i in range(30)).encode()
        run, whole = crf.line_run(text, 4), crf.line_features(text)[0]
        starts |= {i for i in range(27) if np.array_equal(run, whole[i : i + 4])}
    assert {0, 26} <= starts and len(starts) > 20
    assert len(crf.line_run(b"one\ntwo", 4)) == 2 and len(crf.line_run(b"", 4)) == 0


# mixing


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100), (None, 90)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    # 450 words wanted; a is full at 20; 430 by 2 : 1 : 5 puts the null source above 180, so it is full;
    # 250 by 2 : 1
    assert got["a"] == 20 and got[None] == 180
    assert got["b"] == pytest.approx(250 * 2 / 3) and got["c"] == pytest.approx(250 / 3)


def test_copies_of_each_class(spark):
    rows = [(0, w, n, t) for w, n, t in ((0, 0, 60.0), (2, 10, 60.0), (3, 20, 60.0), (4, 30, 60.0))]
    got = {r.w: r.copies for r in mixing.class_rates(spark.createDataFrame(rows, "source_rank long, w int, words long, target double")).collect()}
    assert got[0] == 0 and all(0 <= c <= 2 for c in got.values())
    assert sum(got[w] * n for w, n in ((2, 10), (3, 20), (4, 30))) == pytest.approx(60)
    assert got[2] / 2 == pytest.approx(got[3] / 3) == pytest.approx(got[4] / 4)


def test_mixed_rows_follow_the_counts(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 50)), "en", f"s{i % 3}" if i % 2 else "s0") for i in range(600)]
    docs = frame(spark, [*rows, *rows[:5], rows[0]])
    n = Counter()
    for r in mixing.mix(docs).collect():
        n[r.doc_id] += r.n_copies
    assert Counter(r.doc_id for r in mixing.mixed(docs).collect()) == +n


# passages and lines


def passages(rows, window):
    split = [(o if o is not None else 1 << 63, (t or "").split()) for o, t in rows]
    first = {}
    for o, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, o), o)
    out = []
    for o, w in split:
        gone = {i + k for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < o for k in range(window)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("window,gram", [(50, 12), (8, 3), (8, 8), (5, 1)])
def test_passages_against_brute_force(spark, window, gram):
    rng = np.random.default_rng(window + gram)
    shared = [[f"s{k}.{i}" for i in range(int(rng.integers(window - 2, 4 * window)))] for k in range(6)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(int(rng.integers(1, 5))):
            words += [f"d{d}.{rng.integers(1 << 30)}" for _ in range(int(rng.integers(0, window)))]
            part = shared[rng.integers(len(shared))]
            a = int(rng.integers(0, window // 2 + 1))
            words += part[a:] if rng.random() < 0.5 else part
        rows.append((int(rng.integers(0, 50)) if d % 9 else None, " ".join(words)))
    rows += [(70, "x " * (3 * window)), (71, "x " * (2 * window)), (71, "x " * (2 * window)), (72, None), (73, ""), rows[5]]
    rows += [(None, rows[3][1]), (2, LONG), (1, LONG)]
    got = substring.remove_repeats(frame(spark, rows), window, gram).collect()
    want = Counter((d, *x) for (d, _), x in zip(rows, passages(rows, window)))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == want
    spans = [s for r in got for s in zip(r.spans, r.spans[1:])]
    assert all(a.end < b.start for a, b in spans)


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 99, 101).astype(np.uint64)
    for width in (1, 2, 7, 100, 101):
        assert substring.sliding_min(x, width).tolist() == [min(x[i : i + width]) for i in range(101 - width + 1)]


def test_windows_of_equal_words_have_equal_hashes():
    words = [b"a", b"b", b"c"] * 40
    hashes = substring.Rolling(words).windows(50)
    assert len(set(hashes.tolist())) == 3 and (hashes[3:] == hashes[:-3]).all()


def test_lines_of_one_document_stay(spark):
    line = "A line that is long enough"
    rows = [(1, f"{line}\n{line}\nshort"), (2, f" {line.upper()}\t\nshort\n{line}"), (2, f"{line}\nown words of this row"),
            (None, f"{line}\nonly nulls have this one"), (None, "only nulls have this one"), (3, None), (4, "")]
    docs = frame(spark, rows)
    got = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)).collect()
    found = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got)
    assert found == Counter([
        (1, 3, 0, rows[0][1]), (2, 3, 2, "short"), (2, 2, 1, "own words of this row"),
        (None, 2, 1, "only nulls have this one"), (None, 1, 0, "only nulls have this one"), (3, 1, 0, ""), (4, 1, 0, ""),
    ])


def test_a_line_that_fills_many_ranges(spark):
    rows = [(i, f"the very common line\nown line number {i}") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        gone = linededup.dropped_lines(keyed(frame(spark, rows))).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert Counter((r.ord, r.pos) for r in gone) == Counter((i, 0) for i in range(1, 3000))


@pytest.mark.parametrize("sizes", [(1, 1, 1), (3, 2, 5), (7,), (2, 9, 1)])
def test_streamed_ranges(sizes):
    """Batches of any size give what one batch gives."""
    rng = np.random.default_rng(sum(sizes))
    rows = sorted((int(h), 0, int(d), 0, int(p)) for h, d, p in rng.integers(0, 3, (sum(sizes), 3)))
    cuts = np.cumsum((0, *sizes))

    def batch(part):
        import pyarrow as pa

        cols = list(zip(*part))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["h1", "h2", "ord", "th", "pos"])

    def settled(parts):
        out = [r for b in linededup._later(map(batch, parts)) for r in b.to_pylist()]
        low = {}
        for r in out:
            if r["kind"] == linededup.EDGE:
                low[r["h1"]] = min(low.get(r["h1"], r["ord"]), r["ord"])
        kept = [r for r in out if r["kind"] == linededup.DROP or (r["kind"] == linededup.OPEN and r["ord"] > low[r["h1"]])]
        return Counter((r["h1"], r["ord"], r["pos"]) for r in kept)

    first = {}
    for h, _, d, _, _ in rows:
        first.setdefault(h, d)
    want = Counter((h, d, p) for h, _, d, _, p in rows if d > first[h])
    assert settled([rows[a:b] for a, b in zip(cuts, cuts[1:])]) == settled([rows]) == want


# urls


def test_urls_by_hand(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme.net/x"), (4, "HTTP://WWW.Example.NET/en/1?q"), (5, "http://a.net"), (6, "http://a.net/"),
        (7, "http://x.example.com/de/2#f"), (8, "http://x.org/fr/xxx"), (9, "http://x.io/sexton"), (10, "http://x.io/a-SEX?b"),
        (11, "http://x.io/free-free"), (12, "http://free.io/?win=1"), (13, "http://notexample.com/de/"), (14, "x://h?://g/p"),
        (5, "http://a.net"),
    ]
    out = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)))
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect())
    assert got == Counter([
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "www.example.net", "/en/1", "example.net/en/", "allow"), (5, "a.net", "", None, "allow"), (5, "a.net", "", None, "allow"),
        (6, "a.net", "/", "net/", "block"), (7, "x.example.com", "/de/2", "example.com/de/", "block"),
        (8, "x.org", "/fr/xxx", "org/fr/", "allow"), (9, "x.io", "/sexton", None, "allow"), (10, "x.io", "/a-SEX", None, "block"),
        (11, "x.io", "/free-free", None, "allow"), (12, "free.io", "/", None, "block"), (13, "notexample.com", "/de/", None, "allow"),
        (14, "h", "", None, "allow"),
    ])


def test_a_vocabulary_from_a_table(spark):
    """Weights of different soft terms add up, each counted once; one alone never rejects."""
    rows = [("Alpha", 0), ("beta", 1), ("beta", 3), ("gamma", 2), ("delta", 5), ("x y", None), (None, 1), ("é", 1)]
    terms = urlfilter.read_vocabulary(spark.createDataFrame(rows, "term string, weight int"), soft_limit=5)
    urls = ["h://a/alpha", "h://a/alphabet", "h://a/delta-delta", "h://a/beta.gamma", "h://a/é.gamma.GAMMA", "h://a/é.gamma.beta", "h://a/x y", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in urlfilter.judge_urls(pages, (), terms).collect()}
    assert [got[i].verdict for i in range(8)] == ["block", "allow", "allow", "block", "allow", "block", "block", "allow"]
    assert [tuple(h) for h in got[4].hits] == [("gamma", 2, False), ("é", 1, False)] and got[0].hits[0].strict
    with pytest.raises(ValueError, match="one character"):
        urlfilter.Vocabulary([""], {}, 2)


def test_a_vocabulary_has_a_bound(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "MOST_TERMS", 3)
    with pytest.raises(ValueError, match="more than 3"):
        urlfilter.read_vocabulary(spark.range(4).selectExpr("cast(id as string) as term", "1 as weight"))


def test_many_terms(spark):
    """Thousands of terms, against a search for each."""
    words = [f"w{i}" for i in range(3000)]
    terms = urlfilter.read_vocabulary(spark.createDataFrame([(w, 1 + i % 2) for i, w in enumerate(words)], "term string, weight int"), 3)
    rng = np.random.default_rng(8)
    urls = ["h://x/" + "-".join(f"w{k}" for k in rng.integers(0, 6000, 4)) for _ in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in urlfilter.judge_urls(pages, (), terms).collect():
        here = {w for w in urls[r.page_id].split("/")[-1].split("-") if w in set(words)}
        total = sum(1 + int(w[1:]) % 2 for w in here)
        assert {h.term for h in r.hits} == here and (r.verdict == "block") == (len(here) > 1 and total >= 3)


# tokens


def test_folding_keeps_the_count(spark):
    """Texts with one normal form have one count, whatever their case and white space; digests are shared."""
    library = Tokenizer.from_file(TOKENIZER)
    rng = np.random.default_rng(9)
    parts = ["Abc", "aBC", "É", "ß", " ", "  ", "\n", "\t\r", "\x0b", "12", "3,", "'S", "don't", "<|", "<|startoftext|>", "<|ENDOFTEXT|>", "日本", "\u00a0", "ﬁ", "İ", "e\u0301"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(4000)]
    rows = frame(spark, list(enumerate(texts))).select("doc_id", tokencount.folded(F.col("text")).alias("form")).collect()
    forms = {r.doc_id: r.form for r in rows}
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    assert all(count(forms[i]) == count(t) for i, t in enumerate(texts))
    assert len(set(forms.values())) < len(set(texts))


def test_cache_shares_normal_forms(spark, tmp_path, monkeypatch):
    """A second table answered by what the first one stored: other case, other white space."""
    rows = [(i, f"Some Words of  text {i}\n") for i in range(30)]
    first = tokencount.count_tokens(frame(spark, rows), f"{tmp_path}/c", TOKENIZER, True, tokencount.folded)
    want = {r.doc_id: r.n_tokens for r in first.collect()}
    again = frame(spark, [(i, t.upper().replace(" ", "\t ")) for i, t in rows] + [(99, "new")])
    got = {r.doc_id: r for r in tokencount.count_tokens(again, f"{tmp_path}/c", TOKENIZER, True, tokencount.folded).collect()}
    assert {i: got[i].n_tokens for i in want} == want and got[0].n_bytes == len(rows[0][1]) + 5
    assert tokencount.read_cache(spark, f"{tmp_path}/c").count() == 31


def test_words_encode_as_whole_texts(documents):
    texts = [t for _, t, *_ in documents] + [
        "A<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>", "e\u0301 \u0301x I'LL it's\u00a0\u2003y", "\u03a3\u03a3 \u0130 \ud55c \u1112\u1161",
        "It's. Don'T, &c.; a.b. \u00c9t\u00e9!! it'll... 's. !? \u212b, \ufb01x. \u01c5. x\u0301. \u0e01\u0e33.", "1234 5 x9y _-_ 'S", "\x00 \x1c a\x85b", "", "\U0001f600\U0001f468\u200d\U0001f469 <| endoftext|>",
    ]
    library = Tokenizer.from_file(TOKENIZER)
    got = Encoder(*load(TOKENIZER), by_word=True).encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(name):
    path, texts = public_tokenizers.path(name), ["Two  words\n", "", "x <|endoftext|> </s>"]
    got = [np.frombuffer(x, "<u4").tolist() for x in Encoder(*load(path)).encode([t.encode() for t in texts])]
    if name.endswith("json"):
        library = Tokenizer.from_file(path)
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    else:
        import sentencepiece

        assert got == sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)


def test_token_files_are_in_order_and_read_in_part(spark, tmp_path):
    rows = [(i * 7919 % 3001, f"text number {i} of many") for i in range(3000)]
    path = f"{tmp_path}/t"
    tokenfile.write_tokens(frame(spark, rows).repartition(5), path, TOKENIZER, 2, True, row_group_bytes=4096, page_rows=20)
    files = spark.read.parquet(path).select("*", "_metadata.file_name", "_metadata.row_index")
    order = [r.doc_id for r in files.orderBy("file_name", "row_index").collect()]
    assert order == sorted(d for d, _ in rows)
    few = tokenfile.read_tokens(spark, path).filter("doc_id = 77").select("n_tokens")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,77)" in plan and "ids" not in plan.split("ReadSchema")[1]

    import pyarrow.parquet as pq

    part = pq.ParquetFile(next(tmp_path.glob("t/part-*")))
    columns = {part.metadata.row_group(0).column(i).path_in_schema: part.metadata.row_group(0).column(i) for i in range(5)}
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings or "PLAIN_DICTIONARY" in ids.encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_offset_index


def test_cache_answers_known_texts(spark, odd, tmp_path, monkeypatch):
    cache = f"{tmp_path}/cache"
    first = Counter(map(tuple, tokencount.count_tokens(odd, cache, TOKENIZER, True).collect()))
    stored = tokencount.read_cache(spark, cache).count()
    assert stored == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert Counter(map(tuple, tokencount.count_tokens(odd, cache, TOKENIZER, True).collect())) == first
    assert tokencount.read_cache(spark, cache).count() == stored
    more = odd.union(frame(spark, [(99, "a text never met")]))
    assert tokencount.count_tokens(more, cache, TOKENIZER, True).count() == odd.count() + 1
    assert tokencount.read_cache(spark, cache).count() == stored + 1
    other = public_tokenizers.path("byte_bpe_50k.json")
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(odd.filter("doc_id = 4"), cache, other).collect()}
    assert got == {4: 2} and tokencount.read_cache(spark, cache).count() == stored + 2
    # a digest stored twice, as two runs at a time may do, is answered once
    tokencount.read_cache(spark, cache).limit(3).write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert Counter(map(tuple, tokencount.count_tokens(odd, cache, TOKENIZER, True).collect())) == first


# leaks


def test_leaks_by_hand(spark):
    item = "What is the name, of the long river that runs through all the land?"  # 14 words
    docs = frame(spark, [
        (1, f"Intro. {item.upper()} end"), (2, "é " * 400 + " ".join(item.split()[:13])), (3, " ".join(item.split()[:12])), (4, "yes/no"),
        (5, None), (6, "Ünïcode w\u00f6rd yes NO"), (7, "yes " * 5),
    ])
    items = spark.createDataFrame([(10, item), (9, "yes, no"), (9, "yes NO"), (8, None), (7, "?!")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.scan(docs, items).collect()}
    assert [(got[d].n_words, got[d].n_hit, got[d].items, got[d].contaminated) for d in range(1, 8)] == [
        (16, 14, ["10"], True), (413, 13, ["10"], False), (12, 0, [], False), (2, 2, ["9"], True), (0, 0, [], False),
        (4, 2, ["9"], True), (5, 0, [], False),
    ]
    text = f"Intro. {item.upper()} end"
    assert [text[s.start : s.end] for s in got[1].spans] == [item.upper()[:-1]]
    assert "Ünïcode w\u00f6rd yes NO"[got[6].spans[0].start :] == "yes NO"


def test_a_benchmark_in_parts(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    whole = decontaminate.scan(docs.select("doc_id", "text"), items).collect()
    parts = decontaminate.scan(docs.select("doc_id", "text"), items, item_bytes=2000).collect()
    assert sorted(whole) == sorted(parts) and any(r.contaminated for r in whole)


def test_taken_names_are_refused(odd, items):
    with pytest.raises(ValueError, match="n_hit"):
        decontaminate.scan(odd.withColumn("n_hit", F.lit(1)), items)
    with pytest.raises(ValueError, match="kept"):
        crf.judge(odd.withColumn("kept", F.lit(1)), crf.default_field())


def test_digest_of_kept_text():
    assert hashlib.sha256(linededup.kept_text(b"a\nb\nc", zlib.compress(bytes([0b10100000])), 3)).hexdigest() == hashlib.sha256(b"a\nc").hexdigest()


def test_words_are_known_to_the_next_task_and_without_their_marks():
    held = load(TOKENIZER)
    first = tokenizer.encoder(*held, True)
    assert tokenizer.encoder(*load(TOKENIZER), True) is first
    texts = ["Word wORD, w\u00f6rt! W\u00f6rt? a.. b.c, d) 3, '\u00e9; \u00d7, x\u0301. e\u0301! <|endoftext|>. <|EndOfText|>, A. ",
             "word, w\u00f6rt: \u00f7. \u0100, \u00df; end.", "N\u00c3\u00b7, mid.dle\x85, tab.\tline;\n"]
    library = Tokenizer.from_file(str(TOKENIZER))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    coder = Encoder(*held, by_word=True)
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode([t.encode() for t in texts])] == want
    coder = Encoder(*held, by_word=True)
    coder.encode([b"Thing thing, THING. thing"])
    assert set(coder.words) == {b"thing", b",", b"."}


def test_new_words_are_encoded_together_and_case_falls_after_composition(monkeypatch):
    """Calls of the library grow with pieces, not with words; H and U+0331 have no composed form, h and U+0331 have one."""
    library = Tokenizer.from_file(TOKENIZER)
    rng = np.random.default_rng(3)
    parts = ["Abc", "H", "\u0331", "\u00c9", "\u0301", "\u00df", " ", "\n", "12", ",", ".***", "!!", "'s", "'", "<|", "<|ENDOFTEXT|>",
             "\u65e5\u672c", "\u0130", "\u00d7", "\u00f7", "\u00fe", "=", "\u0338", "\u304b", "\u3099"]
    texts = [None, "", " \n", "H\u0331 x", "abT\u0308.", *("".join(rng.choice(parts, rng.integers(1, 12))) for _ in range(3000))]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    monkeypatch.setattr(tokenizer, "KNOWN", 50)
    coder = Encoder(*load(TOKENIZER), by_word=True)
    rows = pa.array([t and t.encode() for t in texts], pa.binary())
    ids, ends = coder.flat(rows.slice(2))  # a slice, as pieces are
    assert np.split(ids, ends[:-1])[1].tolist() == want[3] and ids.tolist() == [i for x in want[2:] for i in x]
    got = coder.encode(rows.to_pylist())
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert len(coder.words) <= 50 and len(coder.words.before) <= 50

    coder, calls = Encoder(*load(TOKENIZER), by_word=True), []
    monkeypatch.setattr(coder, "_merged", lambda text: pytest.fail("a word by itself"))
    whole = coder._letters
    monkeypatch.setattr(coder, "_letters", lambda words: calls.append(len(words)) or whole(words))
    words = ["".join(rng.choice(list("abc\u00e9"), 9)) for _ in range(6000)]
    coder.encode([f"{w}, {w.upper()}!!".encode() for w in words])
    assert len(calls) == 2 and sum(calls) == len(set(words))


def test_workers_remember_little():
    """An executor keeps a worker per core, each with an encoder that stays between tasks."""
    coder = Encoder(*load(TOKENIZER), by_word=True)
    for at in range(0, 400_000, 10_000):
        coder.encode([" ".join("x" + "".join("abcdefghij"[int(d)] for d in f"{n:06}") for n in range(at, at + 10_000)).encode()])
    assert len(coder.words) + len(coder.words.before) <= 200_000
    assert [c.stop - c.start for c in tokenizer.pieces(pa.array([b"x" * (1 << 20)] * 5, pa.binary()))] == [2, 2, 1]
