"""Mix sources to target weights: whole copies, then Pareto order sampling of the rest.

Targets: each source asks for its share of the words wanted, but for no more than ``most`` times
what it has; what is over goes to the others by weight until nobody is above (water-filling).

Copies: a document of class w (the bit length of its size) is expected ``min(most, c * w)``
times, c chosen so that its source's expected words equal the target. So longer documents are
likelier, mildly, and none is taken more than ``most`` times. The whole part is certain. The rest
is Pareto order sampling: with u uniform and p the fractional part, documents are ranked by
(u / (1 - u)) / (p / (1 - p)), and the first ones are taken until the words their source still
lacks are there. u comes from a digest of the document, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, store
from tidemark.scale import broadcast_if_small, global_position, running_total

WEIGHTS = (5, 2, 1)
CLASSES = 64
PORTION = 1024  # copies of one row made at a time


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Bit length: 0 for 0, 1 for 1, 2 for 2 and 3, 3 for 4 to 7, ..."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) drawn by a digest of the parts, the same on every run and engine."""
    digits = F.substring(F.md5(F.concat(*parts)), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") * 2 + 1) / F.lit(float(1 << 49))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_rank, source_size, target) of a table (source, source_size).

    Sources take ``weights`` in turn, by code point, null last. Sorting the sources by the ratio
    at which they are full turns the repeated sharing into one running total.
    """
    placed = global_position(sizes, [F.col("source").isNull(), "source"], "source_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int"))
    placed = placed.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    total = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted, all_weight = share * (total[0] or 0), total[1] or 0
    order = [F.col("cap") / F.col("weight"), "source_rank"]
    full = running_total(placed, order, F.col("cap"), "full")
    full = running_total(full, order, F.col("weight"), "taken")
    # the rate per weight if this source and all that fill before it are full; it falls short of
    # their own ratio from the first source on that is not full
    rest = (F.lit(wanted) - (F.col("full") - F.col("cap"))) / (F.lit(all_weight) - (F.col("taken") - F.col("weight")))
    rated = full.withColumn("rate", rest).withColumn("open", F.col("rate") * F.col("weight") < F.col("cap"))
    first = rated.filter("open").agg(F.min(F.struct(*order, "rate")).alias("x")).select("x.rate").first()
    rate = first[0] if first and first[0] is not None else None
    cap = F.col("cap").cast("double")
    target = cap if rate is None else F.least(cap, F.lit(rate) * F.col("weight"))
    return placed.select("source", "source_rank", "source_size", target.alias("target"))


def class_rates(classes: DataFrame, most: int = 2) -> DataFrame:
    """Add expected copies to a table (source_rank, w, words, target) of size classes.

    A source has at most 64 classes, so its window is small whatever its documents are.
    """
    down = Window.partitionBy("source_rank").orderBy(F.desc("w"))
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(F.col("w") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    rate = F.when(F.col("_below") > 0, (F.col("target") - F.col("_above") * most) / F.col("_below"))
    rated = classes.withColumn("_above", above).withColumn("_below", below).withColumn("_rate", rate)
    fits = F.when(F.col("_rate") * F.col("w") <= most, F.struct((-F.col("w")).alias("d"), F.col("_rate").alias("c")))
    c = F.min(fits).over(Window.partitionBy("source_rank"))["c"]
    copies = F.least(F.lit(float(most)), F.coalesce(c * F.col("w"), F.lit(float(most))))
    return rated.withColumn("copies", F.when(F.col("w") > 0, copies).otherwise(0.0)).drop("_above", "_below", "_rate")


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2, seed: str = "mix"
) -> DataFrame:
    """(doc_id, th, size, source_size, target, n_copies) per row; th is a digest of the whole row.

    Null texts and texts of white space have size 0 and are not taken. A null source is a source,
    placed last. Equal ranks are ordered by doc_id, then by th; rows equal in both are
    interchangeable. A row without doc_id draws by its digest alone.

    Only narrow rows are moved. One range shuffle by (source, rank) puts the drawn documents in
    order, which splits a source that holds a third of all rows over many tasks.
    """
    every = F.xxhash64(*[F.col(f"`{n}`") for n in docs.columns])
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        every.alias("th"),
        F.col("source").cast("string").alias("source"),
        word_count().alias("size"),
    )
    rows = store(rows.withColumn("w", size_class(F.col("size"))), "sizes")
    classes = rows.groupBy("source", "w").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    classes = store(classes, "classes")
    sources = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = store(targets(sources, weights, share, most), "targets")
    same = classes["source"].eqNullSafe(sources["source"])
    classes = classes.join(sources, same).drop(classes["source"])
    classes = class_rates(classes, most)
    certain = F.floor("copies")
    lacking = F.col("target") - F.sum(certain * F.col("words")).over(Window.partitionBy("source_rank"))
    classes = classes.select(
        F.col("source").alias("_source"), F.col("w").alias("_w"), "source_rank", "source_size", "target",
        certain.alias("certain"), (F.col("copies") - certain).alias("p"), lacking.alias("lacking"), "words",
    )
    classes = store(classes, "class-rates")
    met = F.col("source").eqNullSafe(F.col("_source")) & (F.col("w") == F.col("_w"))
    rated = rows.join(broadcast_if_small(classes.drop("words")), met).drop("_source", "_w", "source", "w")
    out = ["doc_id", "th", "size", "source_size", "target"]
    sure = rated.filter("p = 0").select(*out, F.col("certain").alias("n_copies"))
    own = F.coalesce(F.col("doc_id").cast("string"), F.col("th").cast("string"))
    u = uniform(F.lit(f"{seed}:"), own)
    drawn = rated.filter("p > 0").withColumn("rank", (u / (1 - u)) / (F.col("p") / (1 - F.col("p"))))
    drawn = running_total(drawn, ["source_rank", "rank", "doc_id", "th"], F.col("size"), "through")
    bases = classes.groupBy("source_rank").agg(
        F.sum(F.when(F.col("p") > 0, F.col("words")).otherwise(0)).alias("words"))
    bases = running_total(bases, ["source_rank"], F.col("words"), "base")
    bases = bases.select("source_rank", (F.col("base") - F.col("words")).alias("base"))
    drawn = drawn.join(broadcast_if_small(bases), "source_rank")
    # taken while more than half of it is still lacking, so the sum ends nearest to the target
    extra = (2 * (F.col("through") - F.col("base")) - F.col("size")) < 2 * F.col("lacking")
    return sure.unionByName(drawn.select(*out, (F.col("certain") + extra.cast("long")).alias("n_copies")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, all columns as they came.

    Identical rows are folded into one before they are copied, and many copies of one row are
    made in portions, so that no task holds or makes all of them.
    """
    names = [F.col(f"`{n}`") for n in docs.columns]
    taken = mix(docs, **options).groupBy("th").agg(F.sum("n_copies").alias("n"), F.count("*").alias("m"))
    taken = store(taken.filter("n > 0"), "taken")
    rows = docs.select(F.xxhash64(*names).alias("th"), F.struct(*names).alias("row"))
    once = rows.join(broadcast_if_small(taken.filter("m = 1").select("th", "n")), "th")
    equal = taken.filter("m > 1")
    folded = rows.join(broadcast_if_small(equal.select("th")), "th", "left_semi")
    folded = store(folded.groupBy("th").agg(F.first("row").alias("row")), "folded")
    at = F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(PORTION)))
    portions = equal.select("th", "n", at.alias("at")).select("th", F.least(F.col("n") - F.col("at"), F.lit(PORTION)).alias("n"))
    out = once.select("row", "n").union(folded.join(portions, "th").select("row", "n"))
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
