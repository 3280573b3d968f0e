r"""Personal data: patterns, and terms that tell which personal value stands beside them.

Values found by pattern (addresses, numbers) are the protected entities. A term t discloses an
entity c as far as seeing t tells that c is near: the pointwise mutual information PMI(c; t)
reaches the whole information content IC(c) = -log2 p(c) when t occurs beside c alone. What is
left, IC(c) - PMI(c; t) = log2(documents with t / documents with t beside c), is counted over the
whole corpus in integers. A term that leaves at most ``remove_bits`` for some entity is removed,
one that leaves at most ``general_bits`` is generalised, wherever they occur. An entity must
stand beside the term in ``support`` different texts, so that a single text and its copies prove
nothing.

Everything here is DataFrame functions: patterns, offsets, counts and redaction run in the JVM.
Offsets are code points. The patterns are written so that each text is walked once: a run that
can't match is not tried again from its middle, and no pattern backtracks over a run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store
from tidemark.scale import BROADCAST_ROWS, broadcast_if_small, fits_broadcast

KINDS = ("email", "ip", "card", "phone", "term", "general")
TERM, GENERAL = 4, 5
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]++"
NEAR = 8  # words on each side that count as beside an entity
SPAN = "struct<start:int,kind:int,end:int,value:string>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def before_each(steps: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What ``join`` makes of all steps before each one; blocks of about sqrt(n) keep it below n^1.5."""

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, join)

    def inside(steps: Column, n: Column, width: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int")), lambda b: total(F.slice(steps, b * width + 1, width)))
        heads = bound(blocks, lambda bs: F.transform(bs, lambda _, i: total(F.slice(bs, F.lit(1), i))))
        return bound(heads, lambda hs: F.transform(steps, lambda _, i: join(
            F.get(hs, F.floor(i / width).cast("int")), total(F.slice(steps, i - i % width + 1, i % width)))))

    def sized(steps: Column) -> Column:
        n = F.size(steps)
        return bound(F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1)), lambda w: inside(steps, n, w))

    return F.when(F.size(steps) == 0, F.slice(steps, 1, 0)).otherwise(bound(steps, sized))


def lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def occurrences(text: Column, regex: str, kind: Column, value: Callable[[Column], Column]) -> Column:
    """Spans of all matches in order; ``value`` gives null for a match that does not count.

    What lies between the matches, from a split by the same pattern, gives their offsets.
    """

    def placed(hits: Column) -> Column:
        def spans(gaps: Column) -> Column:
            steps = F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + F.length(h))
            return bound(before_each(steps, F.lit(0), lambda a, b: a + b), lambda heads: F.transform(
                hits, lambda h, i: bound(F.get(heads, i) + F.length(F.get(gaps, i)), lambda start: F.struct(
                    start.alias("start"), kind.alias("kind"), (start + F.length(h)).alias("end"),
                    value(h).alias("value")))))

        return F.when(F.size(hits) == 0, F.array().cast(f"array<{SPAN}>")).otherwise(bound(F.split(text, regex, -1), spans))

    return F.filter(bound(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), placed), lambda s: s["value"].isNotNull())


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]++", "")


def ip_value(match: Column) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    small = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return F.when(small, match)


def card_value(match: Column) -> Column:
    return bound(digits(match), lambda d: F.when(F.length(d).between(12, 19) & F.call_function("luhn_check", d), d))


def phone_value(match: Column) -> Column:
    return bound(digits(match), lambda d: F.when(F.length(d).between(9, 15), F.concat(F.lit("+"), d)))


PATTERNS = ((EMAIL, lower), (IP, ip_value), (CARD, card_value), (PHONE, phone_value))


def base_spans(text: Column) -> Column:
    """Spans of the four patterns, by start, then kind."""
    found = [occurrences(text, regex, F.lit(k), value) for k, (regex, value) in enumerate(PATTERNS)]
    # a text without the sign that a pattern needs is not searched for it
    none = F.array().cast(f"array<{SPAN}>")
    found[0] = F.when(F.contains(text, F.lit("@")), found[0]).otherwise(none)
    found[3] = F.when(F.contains(text, F.lit("+")), found[3]).otherwise(none)
    return F.array_sort(F.concat(*found))


def words(text: Column) -> Column:
    """Runs of letters outside addresses, A-Z lower-cased."""
    rest = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, " ")).otherwise(text)
    return F.regexp_extract_all(lower(rest), F.lit(LETTERS), F.lit(0))


def beside(text: Column, regex: str, kind: int, value: Callable[[Column], Column]) -> Column:
    """(kind, value, term) for the words next to each match that counts, up to its neighbours of the kind."""

    def pairs(hits: Column) -> Column:
        def around(gaps: Column) -> Column:
            heads = F.transform(gaps, lambda ws: F.slice(ws, 1, NEAR))
            tails = F.transform(gaps, lambda ws: F.slice(ws, F.greatest(F.size(ws) - NEAR + 1, F.lit(1)), NEAR))
            return bound(F.struct(heads.alias("heads"), tails.alias("tails")), lambda g: F.flatten(F.transform(
                hits, lambda h, i: bound(value(h), lambda v: F.when(v.isNotNull(), F.transform(
                    F.array_union(F.get(g["tails"], i), F.get(g["heads"], i + 1)),
                    lambda t: F.struct(F.lit(kind).alias("kind"), v.alias("value"), t.alias("term"))))
                    .otherwise(F.array().cast("array<struct<kind:int,value:string,term:string>>"))))))

        return bound(F.transform(F.split(text, regex, -1), words), around)

    return bound(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), pairs)


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): null texts are empty; th tells texts apart by a 128-bit digest."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("th", F.unhex(F.md5("text")))


def disclosing_terms(
    docs: DataFrame, marked: DataFrame, support: int = 3, remove_bits: int = 1, general_bits: int = 2
) -> DataFrame:
    """(term, kind, near, documents), stored: the terms of the corpus that disclose an entity.

    ``near`` is the number of documents in which the term stands beside the entity it tells most
    of. ``marked`` holds (th, spans) of the texts with base spans.
    """
    texts = texts_of(docs)
    held = marked.filter(F.size("spans") > 0).select("th").distinct()
    held = texts.join(broadcast_if_small(held), "th", "left_semi").select("th", "text")
    sides = [beside(F.col("text"), regex, k, value) for k, (regex, value) in enumerate(PATTERNS)]
    pairs = held.select("th", F.explode(F.array_distinct(F.concat(*sides))).alias("pair")).select("th", "pair.*")
    # combined per text first, so an entity or a text that is everywhere is cut down before it moves
    pairs = pairs.groupBy("kind", "value", "term", "th").agg(F.count("*").alias("n"))
    pairs = pairs.groupBy("kind", "value", "term").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
    near = pairs.filter(F.col("texts") >= support).groupBy("term").agg(F.max("n").alias("near"))
    near = store(near, "near-entities")
    each = texts.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    if fits_broadcast(near):
        each = each.join(F.broadcast(near.select("term")), "term", "left_semi")
    known = each.groupBy("term").agg(F.count("*").alias("documents")).join(near, "term")

    def leaves(bits: int) -> Column:
        return F.col("near") * (1 << bits) >= F.col("documents")

    kind = F.when(leaves(remove_bits), F.lit(TERM)).when(leaves(general_bits), F.lit(GENERAL))
    known = known.select("term", kind.alias("kind"), "near", "documents")
    return store(known.filter("kind is not null"), "disclosing-terms")


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(th, found) for each text that holds one of the terms; found is sorted by start."""
    texts = texts_of(docs).select("th", "text")
    some = broadcast_if_small(terms.select("term", "kind"))
    hit = texts.select("th", F.explode(F.array_distinct(words(F.col("text")))).alias("term")).join(some, "term", "left_semi")
    hit = store(hit.select("th").distinct(), "texts-with-terms")
    held = texts.join(broadcast_if_small(hit), "th", "left_semi")

    def masked(text: Column) -> Column:
        # addresses blanked, all offsets kept
        blanks = F.transform(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)), lambda m: F.repeat(F.lit(" "), F.length(m)))
        return bound(blanks, lambda bs: F.when(F.size(bs) == 0, text).otherwise(F.array_join(F.transform(
            F.split(text, EMAIL, -1), lambda gap, i: F.concat(gap, F.coalesce(F.get(bs, i), F.lit("")))), "")))

    every = bound(masked(F.col("text")), lambda t: occurrences(t, LETTERS, F.lit(TERM), lower))
    placed = held.select("th", F.explode(every).alias("s")).select("th", "s.start", "s.end", F.col("s.value").alias("term"))
    found = placed.join(some, "term").select("th", F.struct("start", "kind", "end", F.col("term").alias("value")).alias("s"))
    # one row per text: its own spans, once for all its copies
    return found.groupBy("th").agg(F.sort_array(F.collect_set("s")).alias("found"))


def find(docs: DataFrame, support: int = 3, remove_bits: int = 1, general_bits: int = 2) -> DataFrame:
    """(doc_id, th, spans) per row: spans are (start, kind, end, value) by start, then kind.

    ``kind`` counts in ``KINDS``: patterns, then terms to remove and terms to generalise. A null
    or empty text has none. Repeated rows get the same spans; null ids stay null; other columns
    of ``docs`` are not looked at.
    """
    texts = texts_of(docs)
    marked = store(texts.select("doc_id", "th", base_spans(F.col("text")).alias("spans")), "base-spans")
    terms = disclosing_terms(docs, marked.select("th", "spans"), support, remove_bits, general_bits)
    extra = store(term_spans(docs, terms), "term-spans")
    size = extra.agg(F.sum(F.size("found") + 1)).first()[0] or 0
    side = F.broadcast(extra) if size <= BROADCAST_ROWS else extra
    spans = F.when(F.col("found").isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", "found")))
    return marked.join(side, "th", "left").select("doc_id", "th", spans.alias("spans"))


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text without its spans: values become their kind in brackets, terms go, general ones keep a letter."""

    def cut(t: Column) -> Column:
        ends = F.transform(t["spans"], lambda s: s["end"])
        return bound(before_each(ends, F.lit(0), lambda a, b: F.greatest(a, b)), lambda done: join(t, done))

    def join(t: Column, done: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            label = F.when(s["kind"] == TERM, F.lit("")).when(
                s["kind"] == GENERAL, F.concat(F.substring(s["value"], 1, 1), F.lit("*"))).otherwise(
                F.concat(F.lit("["), F.get(F.array(*map(F.lit, KINDS)), s["kind"]), F.lit("]")))
            gap = F.slice(t["chars"], F.get(done, i) + 1, F.greatest(s["start"] - F.get(done, i), F.lit(0)))
            # a span that starts inside an earlier one has no label of its own
            return F.concat(F.array_join(gap, ""), F.when(s["start"] < F.get(done, i), F.lit("")).otherwise(label))

        last = F.array_max(F.transform(t["spans"], lambda s: s["end"]))
        tail = F.array_join(F.slice(t["chars"], last + 1, F.size(t["chars"])), "")
        return F.concat(F.array_join(F.transform(t["spans"], piece), ""), tail)

    whole = F.struct(F.split(text, "").alias("chars"), spans.alias("spans"))
    return F.when(F.size(spans) > 0, bound(whole, cut)).otherwise(text)


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, text) per row, the text redacted; null texts stay null."""
    spans = find(docs, **options).select("th", "spans").dropDuplicates(["th"])
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("th", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    spans = store(spans.filter(F.size("spans") > 0), "spans")
    size = spans.agg(F.sum(F.size("spans") + 1)).first()[0] or 0
    side = F.broadcast(spans) if size <= BROADCAST_ROWS else spans
    done = F.when(F.col("spans").isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col("spans")))
    return rows.join(side, "th", "left").select("doc_id", done.alias("text"))
