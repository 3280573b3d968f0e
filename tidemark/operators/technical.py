"""Technical indicators, in two readings that differ at the start of a series.

``technical_indicators`` waits for a full look-back; ``mart_technicals`` averages what is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import guarded_ratio, ratio_or_zero
from tidemark.operators.series import (
    Layout,
    add_blocks,
    chained_deviation,
    chained_extreme,
    chained_sum,
    ewm_means,
    ewm_reach,
    full_window,
    measure_layout,
    ordered,
    over_series,
    pack,
    trailing,
    unpack,
)
from tidemark.scale import broadcast_if_small, freeze

YEAR_ROWS = 252
# the signal line smooths a smoothed value, so old rows may reach through both
REACH = ewm_reach(2 / 27) + ewm_reach(2 / 10) + YEAR_ROWS

INDICATORS = (
    "sma_20", "sma_50", "sma_200", "rsi_14", "macd", "macd_signal", "macd_hist",
    "bb_upper", "bb_lower", "bb_width", "return_1d", "return_5d", "return_20d",
    "volatility_20d", "volume_ratio", "price_position_52w", "momentum_acceleration",
    "vol_regime_ratio", "target_1d_return", "target_5d_return", "target_smooth_return",
)


MART_INDICATORS = (
    "sma_20", "sma_50", "sma_200", "bb_upper", "bb_lower", "bb_width", "return_1d", "return_5d",
    "return_20d", "volatility_20d", "target_1d_return", "target_5d_return",
)

# columns the indicators are built from
_SCRATCH = {
    "_std", "_seen", "_in_year", "_mean_r", "_var_r", "_std_r5", "_std_r60", "_low", "_high",
    "_volume_10", "_volume_20", *[f"_{k}_{n}" for k in ("sum", "seen") for n in (10, 20, 50, 200)],
    *[f"_{k}_{n}" for k in ("low", "high") for n in (16, 64)],
}


def change(later: Column, earlier: Column) -> Column:
    """Relative change; null where the base is zero or missing."""
    return F.try_divide(later, earlier) - 1.0


def returns(parts, order, spans=(1, 5, 20), close: str = "close") -> dict[str, Column]:
    w = ordered(parts, order)
    c = F.col(close)
    return {f"return_{n}d": change(c, F.lag(c, n).over(w)) for n in spans}


def forward_targets(parts, order) -> dict[str, Column]:
    w = ordered(parts, order)
    c = F.col("close")
    ahead = {n: change(F.lead(c, n).over(w), c) for n in (1, 3, 5, 10)}
    return {
        "target_1d_return": ahead[1],
        "target_5d_return": ahead[5],
        "target_smooth_return": (ahead[3] + ahead[5] + ahead[10]) / 3.0,
    }


def rsi(gain_mean: str, loss_mean: str) -> Column:
    strength = guarded_ratio(gain_mean, loss_mean)
    return F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + strength)


def with_smoothed(
    rows: DataFrame, parts, order, layout: Layout | None = None
) -> tuple[DataFrame, list[str]]:
    """RSI and MACD, and the order that later windows should use."""
    c = F.col("close")
    rows, blocks = add_blocks(rows, parts, order, layout)
    order = [*blocks, *order]
    w = ordered(parts, order)
    last, earlier = F.lag(c, 1).over(w), F.lag(c, 2).over(w)
    rows = rows.withColumns({"_last": last, "_delta": c - last, "_last_delta": last - earlier})
    # every smoothed value is there where its close or change is
    known = {"close": "_last", "macd": "_last", "_gain": "_last_delta", "_loss": "_last_delta"}
    rows = rows.withColumns(
        {
            "_gain": F.when(F.col("_delta").isNotNull(), F.greatest("_delta", F.lit(0.0))),
            "_loss": F.when(F.col("_delta").isNotNull(), -F.least("_delta", F.lit(0.0))),
        }
    )
    rows = ewm_means(
        rows,
        {
            "_ema_12": ("close", 2 / 13),
            "_ema_26": ("close", 2 / 27),
            "_gain_mean": ("_gain", 1 / 14),
            "_loss_mean": ("_loss", 1 / 14),
        },
        parts,
        order[len(blocks) :],
        blocks,
        known,
    )
    rows = rows.withColumn("macd", F.col("_ema_12") - F.col("_ema_26")).withColumn(
        "rsi_14", rsi("_gain_mean", "_loss_mean")
    )
    rows = ewm_means(rows, {"macd_signal": ("macd", 2 / 10)}, parts, order[len(blocks) :], blocks, known)
    rows = rows.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    return rows.drop(
        "_last", "_delta", "_last_delta", "_gain", "_loss", "_ema_12", "_ema_26", "_gain_mean", "_loss_mean", "_slot"
    ), order


def technical_indicators(
    prices: DataFrame, order: str = "timestamp", layout: Layout | None = None
) -> DataFrame:
    """All indicators and targets of a price table with symbol, ``order``, close and volume.

    Rows without a close must be gone already (the silver step drops them).
    """

    layout = layout or measure_layout(prices)

    def compute(rows: DataFrame, parts: list[str], by: list[str]) -> DataFrame:
        c, v = F.col("close"), F.col("volume").cast("double")
        # the smoothing passes come first, while rows are narrow
        rows, by = with_smoothed(rows, parts, by, layout)
        w = ordered(parts, by)
        ten, sixteen = trailing(parts, by, 10), trailing(parts, by, 16)
        seen = F.count(c).over(w.rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumns(
            {
                **returns(parts, by),
                **forward_targets(parts, by),
                "_sum_10": full_window(F.sum(c), c, ten, 10),
                "_volume_10": full_window(F.sum(v), v, ten, 10),
                "_low_16": F.min(c).over(sixteen),
                "_high_16": F.max(c).over(sixteen),
                "_std": full_window(F.stddev_samp(c), c, trailing(parts, by, 20), 20),
                "_seen": seen,
            }
        )
        r, month = F.col("return_1d"), trailing(parts, by, 20)
        rows = rows.withColumns(
            {
                "_sum_20": chained_sum("_sum_10", 10, 20, w),
                "_sum_50": chained_sum("_sum_10", 10, 50, w),
                "_volume_20": chained_sum("_volume_10", 10, 20, w),
                "_low_64": chained_extreme(F.least, "_low_16", 16, 64, w),
                "_high_64": chained_extreme(F.greatest, "_high_16", 16, 64, w),
                "_mean_r": full_window(F.avg(r), r, month, 20),
                "_var_r": full_window(F.var_samp(r), r, month, 20),
                "_std_r5": full_window(F.stddev_samp(r), r, trailing(parts, by, 5), 5),
                "_in_year": F.col("_seen")
                - F.coalesce(F.lag("_seen", YEAR_ROWS).over(w), F.lit(0)),
            }
        )
        # what needs no more rows comes before the last windows, and so into their input: the code Spark
        # generates for one step must stay below 8,000 bytes, beyond which the JVM only interprets it
        mid, std = F.col("_sum_20") / 20.0, F.col("_std")
        rows = rows.withColumns(
            {
                "sma_20": mid,
                "sma_50": F.col("_sum_50") / 50.0,
                "volatility_20d": F.sqrt("_var_r"),
                "bb_upper": mid + 2 * std,
                "bb_lower": mid - 2 * std,
                "bb_width": guarded_ratio((mid + 2 * std) - (mid - 2 * std), mid),
                "volume_ratio": guarded_ratio(v, F.col("_volume_20") / 20.0),
                "momentum_acceleration": F.col("return_5d") - F.col("return_20d"),
            }
        )
        year_known = F.col("_in_year") >= 20
        rows = rows.withColumns(
            {
                "sma_200": chained_sum("_sum_50", 50, 200, w) / 200.0,
                "_low": chained_extreme(F.least, "_low_64", 64, YEAR_ROWS, w),
                "_high": chained_extreme(F.greatest, "_high_64", 64, YEAR_ROWS, w),
                "_std_r60": chained_deviation("_mean_r", "_var_r", 20, 60, w),
            }
        )
        low, high = F.col("_low"), F.col("_high")
        rows = rows.withColumns(
            {
                "vol_regime_ratio": guarded_ratio("_std_r5", "_std_r60"),
                "price_position_52w": F.when(year_known, guarded_ratio(c - low, high - low)),
            }
        )
        return rows.drop(*[x for x in rows.columns if x in _SCRATCH])

    own = [c for c in prices.columns if c not in INDICATORS]
    packed = pack(prices.select(*own), ["symbol", order, "close", "volume"])
    out = over_series(packed, compute, order=(order,), back=REACH, ahead=10, layout=layout)
    return unpack(out, own, INDICATORS)


def mart_technicals(prices: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Indicators of the feature mart: partial windows at the start, plain ratios."""

    def compute(rows: DataFrame, parts: list[str], by: list[str]) -> DataFrame:
        c = F.col("close")
        w = ordered(parts, by)
        month = trailing(parts, by, 20)
        gap = {
            f"return_{n}d": F.try_divide(c - F.lag(c, n).over(w), F.lag(c, n).over(w))
            for n in (1, 5, 20)
        }
        rows = rows.withColumns(
            {
                **gap,
                "_sum_10": F.sum(c).over(trailing(parts, by, 10)),
                "_std": F.stddev_samp(c).over(month),
                "_seen": F.count(c).over(w.rowsBetween(Window.unboundedPreceding, 0)),
                "target_5d_return": F.try_divide(F.lead(c, 5).over(w) - c, c),
            }
        )
        rows = rows.withColumns(
            {
                "_sum_20": chained_sum("_sum_10", 10, 20, w, partial=True),
                "_sum_50": chained_sum("_sum_10", 10, 50, w, partial=True),
                "volatility_20d": F.stddev_samp("return_1d").over(month),
                "target_1d_return": F.lead("return_1d", 1).over(w),
                **{
                    f"_seen_{n}": F.col("_seen") - F.coalesce(F.lag("_seen", n).over(w), F.lit(0))
                    for n in (20, 50, 200)
                },
            }
        )
        rows = rows.withColumn("_sum_200", chained_sum("_sum_50", 50, 200, w, partial=True))
        rows = rows.withColumns(
            {
                f"sma_{n}": F.when(F.col(f"_seen_{n}") > 0, F.col(f"_sum_{n}") / F.col(f"_seen_{n}"))
                for n in (20, 50, 200)
            }
        )
        mid, std = F.col("sma_20"), F.col("_std")
        return rows.withColumns(
            {
                "bb_upper": mid + 2.0 * std,
                "bb_lower": mid - 2.0 * std,
                "bb_width": ratio_or_zero(4.0 * std, mid),
            }
        ).drop(*[x for x in rows.columns if x in _SCRATCH])

    out = over_series(prices, compute, back=200, ahead=5, layout=layout)
    return out.select(*prices.columns, *MART_INDICATORS)


def latest_returns(
    prices: DataFrame, order: str, keep: list[str], layout: Layout | None = None
) -> DataFrame:
    """Only the one-day return, from a narrow scan and shuffle."""

    def compute(rows: DataFrame, parts: list[str], by: list[str]) -> DataFrame:
        return rows.withColumns(returns(parts, by, spans=(1,)))

    narrow = prices.select("symbol", order, "close", *keep)
    return over_series(narrow, compute, order=(order,), back=1, layout=layout)


def with_relative_strength(
    features: DataFrame,
    prices: DataFrame,
    order: str = "timestamp",
    layout: Layout | None = None,
) -> DataFrame:
    """Return less the mean return of the sector on that day; null without a sector.

    A window over (sector, day) would move every wide row again and put one sector's whole
    day in one task. The means come from a narrow partial aggregate instead, are frozen, and
    join by broadcast when their count allows.
    """
    narrow = latest_returns(prices, order, ["sector"], layout)
    means = freeze(
        narrow.filter(F.col("sector").isNotNull())
        .groupBy("sector", order)
        .agg(F.avg("return_1d").alias("_sector_mean"))
    )
    joined = features.join(broadcast_if_small(means), ["sector", order], "left")
    return (
        joined.withColumn("rel_strength_sector", F.col("return_1d") - F.col("_sector_mean"))
        .drop("_sector_mean")
        .select(*features.columns, "rel_strength_sector")
    )
