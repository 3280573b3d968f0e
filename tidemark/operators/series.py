"""Ordered work along per-key time series.

Usual layout: one shuffle by key, all windows share it. When some key owns more rows than one task
should sort, the series is cut into segments by exact position; each segment also carries
the rows before and after it that its frames reach, and only its own rows are kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scale import broadcast_if_small, freeze, global_position, in_tasks

MAX_SERIES_ROWS = 1_000_000
SEGMENT_ROWS = 65_536
EWM_BLOCK = 2_048
# a weight of 1e-60 changes no double, as long as values stay within 40 orders of magnitude
NEGLIGIBLE = 60.0 * math.log(10.0)

_SEGMENT, _CORE, _POS = "_segment", "_core", "_pos"


@dataclass(frozen=True)
class Layout:
    """How a series table is split; ``hot`` means some key exceeds one task's share.

    ``longest`` bounds the rows of one series, ``rows`` those of the table, where they are known."""

    hot: bool
    segment_rows: int = SEGMENT_ROWS
    longest: int | None = None
    rows: int | None = None


def measure_layout(df: DataFrame, key: str = "symbol", max_rows: int = MAX_SERIES_ROWS) -> Layout:
    """One narrow count per key decides the layout. Any table with at least as many rows per
    key as the series will do, e.g. the raw trades behind a table of bars."""
    largest, rows = df.groupBy(key).count().agg(F.max("count"), F.sum("count")).first()
    return Layout(hot=(largest or 0) > max_rows, longest=largest or 0, rows=rows or 0)


def over_series(
    df: DataFrame,
    compute: Callable[[DataFrame, list[str], list[str]], DataFrame],
    *,
    key: str = "symbol",
    order: Sequence[str] = ("date",),
    back: int,
    ahead: int = 0,
    layout: Layout | None = None,
) -> DataFrame:
    """Run ``compute(df, partition_columns, order_columns)`` along every series.

    ``back`` and ``ahead`` are the farthest rows its frames reach.
    """
    layout = layout or measure_layout(df, key)
    if not layout.hot:
        return compute(in_tasks(df, layout.rows or 0, key), [key], list(order))
    cut = segmented(df, key=key, order=order, back=back, ahead=ahead, rows=layout.segment_rows)
    out = compute(cut, [_SEGMENT, key], list(order))
    return out.filter(F.col(_CORE)).drop(_SEGMENT, _CORE)


def segmented(
    df: DataFrame, *, key: str, order: Sequence[str], back: int, ahead: int, rows: int
) -> DataFrame:
    placed = global_position(df, [key, *order], out=_POS)
    pos = F.col(_POS)
    home = F.floor(pos / rows)
    first = F.greatest(F.floor((pos - ahead) / rows), F.lit(0))
    last = F.floor((pos + back) / rows)
    return (
        placed.withColumn(_SEGMENT, F.explode(F.sequence(first, last)))
        .withColumn(_CORE, F.col(_SEGMENT) == home)
        .drop(_POS)
    )


def ordered(parts: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*parts).orderBy(*order)


def trailing(parts: Sequence[str], order: Sequence[str], n: int):
    """Frame of the last ``n`` rows, the current one included."""
    return ordered(parts, order).rowsBetween(-(n - 1), 0)


def full_window(agg: Column, x: Column, frame, min_rows: int) -> Column:
    """Null until the frame holds ``min_rows`` non-null values."""
    return F.when(F.count(x).over(frame) >= min_rows, agg.over(frame))


# ---------------------------------------------------------------------------
# long frames from short ones
#
# Spark walks every row of a moving frame again for each output row. Frames of 50 to 252 rows are
# therefore put together from a short frame and a few lags of it, without any subtraction
# that could cancel digits.
# ---------------------------------------------------------------------------


def _earlier(c: str, rows: int, w) -> Column:
    return F.lag(c, rows).over(w) if rows else F.col(c)


def chained_sum(short: str, step: int, n: int, w, partial: bool = False) -> Column:
    """Sum of the last ``n`` rows from ``short``, the sum of the last ``step`` rows.

    Null until the look-back is full (a null short sum spreads), unless ``partial``."""
    parts = [_earlier(short, k, w) for k in range(0, n, step)]
    if partial:
        parts = [F.coalesce(p, F.lit(0.0)) for p in parts]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def chained_extreme(pick, short: str, step: int, n: int, w) -> Column:
    """``pick`` is ``F.least`` or ``F.greatest``; the pieces may overlap and may be missing."""
    offsets = sorted({min(k, n - step) for k in range(0, n, step)})
    return pick(*[_earlier(short, k, w) for k in offsets])


def chained_deviation(mean: str, variance: str, step: int, n: int, w) -> Column:
    """Sample deviation of ``n`` rows from means and sample variances of ``step`` rows."""
    means = [_earlier(mean, k, w) for k in range(0, n, step)]
    spreads = [_earlier(variance, k, w) * float(step - 1) for k in range(0, n, step)]
    center = sum(means[1:], means[0]) / float(len(means))
    # a product, as the built-in power runs in strict software arithmetic
    between = [(m - center) * (m - center) * float(step) for m in means]
    total = sum(spreads[1:], spreads[0]) + sum(between[1:], between[0])
    return F.sqrt(total / float(n - 1))


# ---------------------------------------------------------------------------
# exponentially weighted mean
# ---------------------------------------------------------------------------


def ewm_reach(alpha: float) -> int:
    """Rows after which an old value no longer changes a double."""
    return math.ceil(NEGLIGIBLE / -math.log1p(-alpha))


def pack(df: DataFrame, keep: Sequence[str], name: str = "_rest") -> DataFrame:
    """Put the columns no window reads into one struct, which windows copy as one value."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.struct(*rest).alias(name)) if rest else df


def unpack(df: DataFrame, columns: Sequence[str], added: Sequence[str], name: str = "_rest"):
    """Undo ``pack``: the packed table's own columns in their order, then the added ones."""
    own = [F.col(c) if c in df.columns else F.col(f"{name}.{c}") for c in columns]
    return df.select(*own, *added)


def add_blocks(
    df: DataFrame, parts: Sequence[str], order: Sequence[str], layout: Layout | None = None
) -> tuple[DataFrame, list[str]]:
    """Number rows in blocks of ``EWM_BLOCK`` so that powers of the decay stay finite.

    Returns the block columns: none when every series is known to fit one block, which saves a
    sort. Later windows should order by block and then ``order``, to keep that sort."""
    index = F.row_number().over(ordered(parts, order)) - 1
    df = df.withColumn("_index", index)
    if layout and not layout.hot and layout.longest is not None and layout.longest <= EWM_BLOCK:
        return df.withColumnRenamed("_index", "_slot"), []
    df = df.withColumn("_block", F.floor(F.col("_index") / EWM_BLOCK)).withColumn(
        "_slot", F.col("_index") % EWM_BLOCK
    )
    return df.drop("_index"), ["_block"]


def decay_power(alpha: float, sign: int, slot: Column) -> Column:
    """``(1 - alpha) ** (sign * slot)`` for a slot inside a block, from two short literal tables
    (the built-in power runs in strict software arithmetic and would dominate the pass)."""
    q = 1.0 - alpha
    fine, coarse = 64, EWM_BLOCK // 64

    def pick(values: list[float], index: Column) -> Column:
        table = F.expr("array(" + ", ".join(f"{v!r}D" for v in values) + ")")
        return F.get(table, index)

    low = pick([q ** (sign * j) for j in range(fine)], (slot % fine).cast("int"))
    high = pick([q ** (sign * fine * j) for j in range(coarse)], F.floor(slot / fine).cast("int"))
    return low * high


def ewm_means(
    df: DataFrame,
    specs: dict[str, tuple[str, float]],
    parts: Sequence[str],
    order: Sequence[str],
    blocks: Sequence[str] = (),
    known: dict[str, str] | None = None,
) -> DataFrame:
    """``e_t = (1-a) e_{t-1} + a x_t`` seeded with the first non-null value.

    ``specs`` maps an output to (input column, alpha); ``blocks`` comes from ``add_blocks``. Inputs may be
    null only before their first value. ``known`` maps an input to a column that is null where the row before has
    no value of it, which saves a pass. Inside a block the recurrence is a running sum of
    ``x_i q^-i``; the ends of earlier blocks sit at fixed distances and are added by ``lag``.
    """
    inside = Window.partitionBy(*parts, *blocks).orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    # same sort order as above, so no further sort
    along = Window.partitionBy(*parts).orderBy(*blocks, *order)
    slot = F.col("_slot")

    known = known or {}
    before = {f"_before_{x}": F.lag(x).over(along) for x, _ in specs.values() if x not in known}
    tails, carried, results = {}, {}, {}
    for out, (x, alpha) in specs.items():
        last = F.col(known.get(x, f"_before_{x}"))
        weight = F.when(last.isNull(), F.lit(1.0)).otherwise(F.lit(alpha))
        term = F.coalesce(weight * F.col(x) * decay_power(alpha, -1, slot), F.lit(0.0))
        tails[f"_local_{out}"] = F.sum(term).over(running) * decay_power(alpha, 1, slot)
        if not blocks:
            results[out] = F.when(F.col(x).isNotNull(), F.col(f"_local_{out}"))
            continue
        decay = (1.0 - alpha) ** EWM_BLOCK
        past = F.lit(0.0)
        for k in range(math.ceil(ewm_reach(alpha) / EWM_BLOCK)):
            end = F.lag(f"_local_{out}", 1 + k * EWM_BLOCK).over(along)
            past = past + F.coalesce(end, F.lit(0.0)) * F.lit(decay**k)
        carried[f"_carry_{out}"] = F.when(F.col("_slot") == 0, past)
        carry = F.first(f"_carry_{out}").over(running)
        reach = decay_power(alpha, 1, slot) * F.lit(1.0 - alpha)
        value = F.col(f"_local_{out}") + reach * carry
        results[out] = F.when(F.col(x).isNotNull(), value)
    df = df.withColumns(before).withColumns(tails)
    if carried:
        df = df.withColumns(carried)
    return df.withColumns(results).drop(*before, *tails, *carried)


# ---------------------------------------------------------------------------
# forward fill
# ---------------------------------------------------------------------------


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    *,
    key: str,
    order: Sequence[str],
    layout: Layout | None = None,
) -> DataFrame:
    """Latest non-null value at or before each row of its series."""
    layout = layout or measure_layout(df, key)
    filled = [F.last(c, ignorenulls=True) for c in columns]
    if not layout.hot:
        frame = ordered([key], order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: f.over(frame) for c, f in zip(columns, filled)})
    # fill inside a segment, then carry the last value of earlier segments into it
    cut = segmented(df, key=key, order=order, back=0, ahead=0, rows=layout.segment_rows)
    cut = cut.drop(_CORE)
    frame = ordered([_SEGMENT, key], order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({c: f.over(frame) for c, f in zip(columns, filled)})
    stamp = F.struct(*order)
    ends = cut.groupBy(key, _SEGMENT).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), stamp)).alias(f"_end_{c}") for c in columns]
    )
    before = ordered([key], [_SEGMENT]).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        key,
        _SEGMENT,
        *[F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_in_{c}") for c in columns],
    )
    joined = local.join(broadcast_if_small(freeze(carry)), [key, _SEGMENT], "left")
    return joined.withColumns({c: F.coalesce(c, f"_in_{c}") for c in columns}).drop(
        _SEGMENT, *[f"_in_{c}" for c in columns]
    )


# ---------------------------------------------------------------------------
# look-back sequences
# ---------------------------------------------------------------------------


def sequences(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    length: int = 10,
    *,
    key: str = "symbol",
    order: Sequence[str] = ("date",),
    layout: Layout | None = None,
) -> DataFrame:
    """The ``length`` rows of features before a row, with that row's target."""

    def compute(rows: DataFrame, parts: list[str], by: list[str]) -> DataFrame:
        frame = ordered(parts, by).rowsBetween(-length, -1)
        vector = F.array(*[F.col(c).cast("double") for c in features])
        return rows.withColumn("sequence", F.collect_list(vector).over(frame)).filter(
            F.size("sequence") == length
        )

    out = over_series(df, compute, key=key, order=order, back=length, layout=layout)
    return out.select(key, *order, "sequence", F.col(target).alias("target"))
