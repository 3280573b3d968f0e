"""How far the sources of a language differ in their words, in exact integers.

Identical texts of a language are folded into one row with a count per source, so each is split
into words once and counts for all its copies. Counts are sparse: a row for each (lang, source,
term) that occurs. A pair of sources is compared over all kept terms, but only terms that both
hold are looked at one by one: what a term held by one of them adds depends on its count alone,
so a histogram of counts gives it, and what a term of neither adds is one constant.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, slices, store, values
from tidemark.scale import broadcast_if_small

UNIT = 1_000_000_000  # shares are counted in billionths
HELD = 300_000  # counts that a task holds before it passes them on
BLOCK = 512  # sources whose pairs one task adds up at a time
CELLS = 1 << 20  # pairs that are in memory at once
_LETTERS = bytes(
    (b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32) for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII; A-Z are lower-cased."""
    return text.translate(_LETTERS).split()


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + kept)); decimal, as the product may leave 64 bits."""
    return 1 + F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(UNIT), total + kept)


def excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def folded(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((lang, text, copies) per distinct text of a language, (lang, source) that occur).

    copies lists (source, n). Texts are told apart by a 128-bit digest. Each task passes on a
    text once, however often it has it, so a text that fills a third of the table reaches its
    reducer at most once per task.
    """
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumn("th", F.md5("text"))
    copies = store(rows.groupBy("lang", "source", "th").agg(F.count("*").alias("n")), "copies")
    lists = copies.groupBy("lang", "th").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("lang", "th").agg(F.first("text").alias("text"))
    return texts.join(lists, ["lang", "th"]).drop("th"), copies.select("lang", "source").distinct()


def weighted_counts(texts: DataFrame) -> DataFrame:
    """(lang, source, term, cnt, docs) of folded texts: occurrences and documents, copies counted."""
    schema = "lang string, source string, term string, cnt long, docs long"

    def flushed_counts(found: dict):
        for (lang, source), (cnt, docs) in found.items():
            # both counters met their terms in the same order
            term = pa.array(list(cnt), pa.binary()).cast(pa.string())
            cols = [pa.repeat(pa.scalar(x, pa.string()), len(term)) for x in (lang, source)]
            cols += [term, pa.array(list(cnt.values()), pa.int64()), pa.array(list(docs.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "cnt", "docs"])

    def work(batches):
        held, found = 0, defaultdict(lambda: (Counter(), Counter()))
        for batch in slices(batches):
            texts_, langs = values(batch.column("text").cast(pa.binary())), values(batch.column("lang"))
            for lang, text, copies in zip(langs, texts_, values(batch.column("copies"))):
                words = terms(text)
                once = None if len(copies) == 1 and copies[0]["n"] == 1 else Counter(words)
                for copy in copies:
                    cnt, docs = found[lang, copy["source"]]
                    n, before = copy["n"], len(cnt)
                    if once is None:
                        cnt.update(words)
                        docs.update(dict.fromkeys(words).keys())
                    else:
                        for term, k in once.items():
                            cnt[term] += n * k
                            docs[term] += n
                    held += len(cnt) - before
                if held >= HELD:
                    yield from flushed_counts(found)
                    found.clear()
                    held = 0
        yield from flushed_counts(found)

    partial = map_rows(texts, schema, work)
    return partial.groupBy("lang", "source", "term").agg(F.sum("cnt").alias("cnt"), F.sum("docs").alias("docs"))


class Profile:
    """Sparse counts of the kept terms and the sizes of all groups, stored.

    counts: lang, source, term, cnt, p (share in the group), q (share in the language)
    groups: lang, source, idx (from 0 per language, by source), v (kept terms), p0 (share of a
    term that does not occur; null where nothing is kept)
    """

    def __init__(self, docs: DataFrame, least_docs: int = 3) -> None:
        texts, occurring = folded(docs)
        counts = store(weighted_counts(texts), "term-counts")
        kept = counts.groupBy("lang", "term").agg(F.sum("cnt").alias("total"), F.sum("docs").alias("docs"))
        kept = store(kept.filter(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
        langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
        counts = store(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
        sizes = counts.groupBy("lang", "source").agg(F.sum("cnt").alias("n"))
        # as many rows in a window as a language has sources
        idx = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        groups = occurring.withColumn("idx", idx).join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n", "v", "n_lang")})
        zero = F.when(F.col("v") > 0, share(F.lit(0), F.col("n"), F.col("v")))
        self.groups = store(groups.withColumn("p0", zero), "groups")
        placed = counts.join(broadcast_if_small(self.groups), ["lang", "source"])
        p = share(F.col("cnt"), F.col("n"), F.col("v"))
        q = share(F.col("total"), F.col("n_lang"), F.col("v"))
        self.counts = store(
            placed.select("lang", "source", "idx", "term", "cnt", p.alias("p"), "p0", q.alias("q")), "shares")

    def term_excess(self, most: int = 200) -> DataFrame:
        """(lang, source, item, value, rank): the terms a group has most in excess of its language."""
        over = self.counts.filter("p > q").select(
            "lang", "source", F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value"))
        return ranked(over).filter(F.col("rank") <= most)

    def pair_excess(self) -> DataFrame:
        """(lang, source, item, value, rank) for each other source ``item`` of a group's language."""
        side = self.groups.select("lang", "idx", "source", "v", "p0")
        one, two = (side.toDF("lang", *[f"{c}_{x}" for c in side.columns[1:]]) for x in "ab")
        base = excess(F.col("p0_a"), F.col("p0_b"))
        # terms that neither holds: all of them, taken back below where one is held
        pairs = one.join(two, "lang").filter("idx_a <> idx_b")
        pairs = pairs.withColumn("none", F.coalesce(F.col("v_a") * base, F.lit(0)))
        steps = self.counts.groupBy("lang", "idx", "p", "p0").agg(F.count("*").alias("h"))
        steps = store(steps, "count-histogram")
        other = broadcast_if_small(side.select("lang", F.col("idx").alias("_idx"), F.col("p0").alias("_p0")))
        met = steps.join(other, "lang").filter("idx <> _idx")
        p, p0, q0 = F.col("p"), F.col("p0"), F.col("_p0")
        first = met.select("lang", F.col("idx").alias("idx_a"), F.col("_idx").alias("idx_b"),
                           (F.col("h") * (excess(p, q0) - excess(p0, q0))).alias("x"))
        second = met.select("lang", F.col("_idx").alias("idx_a"), F.col("idx").alias("idx_b"),
                            (F.col("h") * (excess(q0, p) - excess(q0, p0))).alias("x"))
        parts = first.union(second).union(shared_terms(self.counts, self.groups)).groupBy("lang", "idx_a", "idx_b")
        parts = parts.agg(F.sum("x").alias("x"))
        found = pairs.join(parts, ["lang", "idx_a", "idx_b"], "left")
        value = F.col("none") + F.coalesce("x", F.lit(0))
        return ranked(found.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), value.alias("value")))


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def shared_terms(counts: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, idx_a, idx_b, x): what terms held by both add beyond what each adds alone.

    All rows of a term meet in one task, at most one per source. Sums per pair are added up inside
    the task; with many sources a task adds up the pairs of ``block`` of them, so that what it
    holds is ``block`` times the sources of a language.
    """
    blocks = groups.groupBy("lang").agg(F.floor(F.max("idx") / block).cast("int").alias("last"))
    rows = counts.join(broadcast_if_small(blocks), "lang")
    rows = rows.select("lang", F.explode(F.sequence(F.lit(0), "last")).alias("block"), "term", "idx", "p", "p0")
    rows = rows.repartition("lang", "block", "term").sortWithinPartitions("lang", "block", "term", "idx")

    def work(batches):
        open_, sums, rest = None, {}, None
        for batch in batches:
            table = pa.table(batch) if rest is None else pa.concat_tables([rest, pa.table(batch)])
            table = table.combine_chunks()
            if not table.num_rows:
                continue
            keys = [table.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "block", "term")]
            turn = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            starts = np.concatenate(([0], turn))
            rest = table.slice(starts[-1])  # the last term may go on in the next batch
            for found in whole(table, keys, starts[:-1], starts[1:]):
                open_, done = add(open_, sums, *found)
                if done:
                    yield done
        if rest is not None:
            for found in whole(rest, [np.zeros(rest.num_rows, int)] * 3, np.array([0]), np.array([rest.num_rows])):
                open_, done = add(open_, sums, *found)
                if done:
                    yield done
        if sums:
            yield flushed(open_[0], sums)

    def whole(table, keys, starts, ends):
        """((lang, block), idx, p, p0, starts, sizes) for each run of terms of one block."""
        cuts = np.flatnonzero((keys[0][starts][1:] != keys[0][starts][:-1]) | (keys[1][starts][1:] != keys[1][starts][:-1])) + 1
        cols = [table.column(c).to_numpy() for c in ("idx", "p", "p0")]
        for some in np.split(np.arange(len(starts)), cuts):
            if len(some):
                at = int(starts[some[0]])
                key = (table.column("lang")[at].as_py(), table.column("block")[at].as_py())
                yield key, cols, starts[some], (ends - starts)[some]

    def add(open_, sums, key, cols, starts, sizes):
        done = None
        if open_ is not None and open_ != key:
            done = flushed(open_[0], sums) if sums else None
            sums.clear()
        idx, p, p0 = cols
        for size in np.unique(sizes[sizes > 1]).tolist():
            at = starts[sizes == size][:, None] + np.arange(size)
            for rows_ in np.array_split(at, max(1, -(-at.size * min(size, CELLS) // CELLS))):
                for side in np.array_split(np.arange(size), max(1, -(-size * size // CELLS))):
                    pair_sums(sums, key[1], idx[rows_], p[rows_], p0[rows_], side, block)
        return key, done

    return map_rows(rows, "lang string, idx_a int, idx_b int, x long", work)


def pair_sums(sums: dict, block: int, idx: np.ndarray, p: np.ndarray, p0: np.ndarray, side: np.ndarray, width: int) -> None:
    """Add the pairs of ``side`` with all sources of terms (rows: terms, columns: their sources)."""
    a = (slice(None), side, None)
    b = (slice(None), None, slice(None))
    x = _excess(p[a], p[b]) - _excess(p[a], p0[b]) - _excess(p0[a], p[b]) + _excess(p0[a], p0[b])
    keys = (idx[a].astype(np.int64) << 32) + idx[b]
    own = np.broadcast_to((idx[a] // width == block) & (idx[a] != idx[b]), keys.shape)
    found, where = np.unique(keys[own], return_inverse=True)
    totals = np.zeros(len(found), np.int64)
    np.add.at(totals, where, x[own])
    for key, total in zip(found.tolist(), totals.tolist()):
        sums[key] = sums.get(key, 0) + total


def _excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def flushed(lang: str, sums: dict) -> pa.RecordBatch:
    pairs = np.fromiter(sums, np.int64, len(sums))
    cols = [pa.array([lang] * len(sums), pa.string()), pa.array((pairs >> 32).astype(np.int32))]
    cols += [pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(list(sums.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(cols, ["lang", "idx_a", "idx_b", "x"])


def audit(docs: DataFrame, least_docs: int = 3, most: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and each source's foremost terms.

    Null text, lang and source count as empty strings. A term is kept in a language if it stands
    in ``least_docs`` of its documents, copies counted. A group without terms is compared like
    any other; a language without kept terms has pairs of value 0, one with a single source has
    none. Repeated rows and ids count as documents of their own.
    """
    profile = Profile(docs, least_docs)
    pairs = profile.pair_excess().withColumn("part", F.lit("pair"))
    return pairs.unionByName(profile.term_excess(most).withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank")
