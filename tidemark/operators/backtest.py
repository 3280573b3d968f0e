"""Long/short backtest over daily predictions, without a day loop.

Only tables with one row per day, or a few holdings per rebalance, are ordered as a whole. The
predictions themselves are scanned, joined by broadcast and summed per day.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scale import broadcast_if_small, freeze

# fixed value: trading days of a year
YEAR = 252


@dataclass(frozen=True)
class Rules:
    """Fixed values of the reference strategy as defaults."""

    start: float = 100_000.0
    cost_bps: float = 5.0
    top_n: int = 5
    bottom_n: int = 5
    every: int = 5
    lag_signal: bool = False  # trade on the prediction of the asset's row before; the first has none


def trading_calendar(predictions: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per day: index, whether it trades and rebalances, the rebalance in force.

    A rebalance that falls on a day with too few assets waits for the next multiple."""
    days = predictions.groupBy("date").agg(
        F.count(F.lit(1)).alias("n_assets"),
        F.avg(F.coalesce("return_1d", F.lit(0.0))).alias("benchmark_return"),
    )
    by_day = Window.orderBy("date")
    index = F.row_number().over(by_day) - 1
    days = days.withColumn("day_index", index).withColumn(
        "tradable", F.col("n_assets") >= rules.top_n + rules.bottom_n
    )
    days = days.withColumn(
        "rebalance", F.col("tradable") & (F.col("day_index") % rules.every == 0)
    )
    past = by_day.rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumn(
        "active", F.last(F.when(F.col("rebalance"), F.col("day_index")), ignorenulls=True).over(past)
    )


def ranked_picks(df: DataFrame, order: list[Column], n: int, keys=("day_index",)) -> DataFrame:
    """First ``n`` rows per key; each input task forwards at most ``n`` rows per key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def target_weights(
    predictions: DataFrame, calendar: DataFrame, rules: Rules = Rules()
) -> DataFrame:
    """Equal weights of the best and the worst predictions on each rebalance day."""
    days = calendar.filter("rebalance").select("date", "day_index")
    candidates = predictions.select("date", "symbol", "predicted_return").join(
        broadcast_if_small(days), "date"
    )
    p = F.col("predicted_return")
    longs = ranked_picks(candidates, [p.desc(), F.col("symbol").desc()], rules.top_n)
    shorts = ranked_picks(candidates, [p.asc(), F.col("symbol").asc()], rules.bottom_n)
    return longs.select(
        "day_index", "symbol", F.lit(1.0 / rules.top_n).alias("weight")
    ).unionByName(
        shorts.select("day_index", "symbol", F.lit(-1.0 / rules.bottom_n).alias("weight"))
    )


def turnover(weights: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sum of absolute weight changes per rebalance; a symbol missing on one side counts as 0."""
    order = Window.orderBy("day_index")
    # a calendar at most
    steps = calendar.filter("rebalance").select(
        "day_index", F.lead("day_index").over(order).alias("next_index")
    )
    old = (
        weights.join(F.broadcast(steps), "day_index")
        .filter(F.col("next_index").isNotNull())
        .select(
            F.col("next_index").alias("day_index"), "symbol", F.col("weight").alias("old_weight")
        )
    )
    both = weights.join(old, ["day_index", "symbol"], "full_outer")
    change = F.abs(
        F.coalesce("weight", F.lit(0.0)) - F.coalesce("old_weight", F.lit(0.0))
    )
    return both.groupBy("day_index").agg(F.sum(change).alias("turnover"))


def day_returns(predictions: DataFrame, calendar: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted return of the holdings in force on each day; a missing return counts as 0."""
    days = calendar.filter(F.col("tradable") & F.col("active").isNotNull()).select("date", "active")
    held = weights.withColumnRenamed("day_index", "active")
    rows = (
        predictions.select("date", "symbol", "return_1d")
        .join(broadcast_if_small(days), "date")
        .join(broadcast_if_small(held), ["active", "symbol"])
    )
    gain = F.col("weight") * F.coalesce("return_1d", F.lit(0.0))
    return rows.groupBy("date").agg(F.sum(gain).alias("strategy_return"))


def backtest_days(predictions: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Calendar with turnover, returns and both curves."""
    if rules.lag_signal:
        # an asset has one row per day, so its window is a calendar at most
        before = F.lag("predicted_return").over(Window.partitionBy("symbol").orderBy("date"))
        predictions = predictions.withColumn("predicted_return", before)
        predictions = predictions.filter(F.col("predicted_return").isNotNull())
    calendar = freeze(trading_calendar(predictions, rules))
    weights = freeze(target_weights(predictions, calendar, rules))
    moved = turnover(weights, calendar)
    gains = day_returns(predictions, calendar, weights)
    days = calendar.join(moved, "day_index", "left").join(gains, "date", "left")
    none = F.lit(0.0)
    cost = F.lit(1.0) - F.coalesce("turnover", none) * (rules.cost_bps / 10_000.0)
    factor = cost * (1.0 + F.coalesce("strategy_return", none))
    days = days.withColumns(
        {
            "_factor": F.when(F.col("tradable"), factor).otherwise(1.0),
            "_market": F.when(F.col("tradable"), 1.0 + F.col("benchmark_return")).otherwise(1.0),
        }
    )
    past = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumns(
        {
            "portfolio_value": F.product("_factor").over(past) * rules.start,
            "benchmark_value": F.product("_market").over(past) * rules.start,
        }
    ).drop("_factor", "_market")


def backtest(predictions: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Report with date, portfolio_value and benchmark_value.

    ``predictions`` has date, symbol, predicted_return, return_1d, each (date, symbol) once. As in
    the reference, a day's prediction earns that same day's return, unless ``lag_signal`` is set."""
    return backtest_days(predictions, rules).select("date", "portfolio_value", "benchmark_value")


def statistics(report: DataFrame, start: float = Rules.start) -> DataFrame:
    """CAGR of both curves, Sharpe, Sortino, maximum drawdown and win rate; one row."""
    by_day = Window.orderBy("date")
    v = F.col("portfolio_value")
    past = by_day.rowsBetween(Window.unboundedPreceding, 0)
    rows = report.withColumns(
        {
            "_r": F.try_divide(v, F.lag(v).over(by_day)) - 1.0,
            "_peak": F.max(v).over(past),
        }
    )
    r = F.col("_r")
    mean, deviation = F.avg(r), F.stddev_pop(r)
    losses = F.when(r < 0, r)
    downside = F.when(F.count(losses) > 0, F.stddev_pop(losses)).otherwise(1e-8)
    years = F.lit(float(YEAR)) / F.count(F.lit(1))

    def growth(curve: str) -> Column:
        return F.pow(F.max_by(curve, "date") / start, years) - 1.0

    return rows.agg(
        F.max_by("portfolio_value", "date").alias("final_value"),
        F.max_by("benchmark_value", "date").alias("final_benchmark"),
        growth("portfolio_value").alias("cagr"),
        growth("benchmark_value").alias("benchmark_cagr"),
        (mean / F.when(deviation > 0, deviation).otherwise(1e-8) * math.sqrt(YEAR)).alias("sharpe"),
        (F.try_divide(mean, downside) * math.sqrt(YEAR)).alias("sortino"),
        F.min((v - F.col("_peak")) / F.col("_peak")).alias("max_drawdown"),
        F.avg(F.when(r.isNotNull(), (r > 0).cast("double"))).alias("win_rate"),
    )


def total_returns(report: DataFrame, start: float = Rules.start) -> DataFrame:
    """Total return of both curves in percent, and the difference."""
    last = report.agg(
        F.max_by("portfolio_value", "date").alias("_p"),
        F.max_by("benchmark_value", "date").alias("_b"),
    )
    strategy = (F.col("_p") - start) / start * 100.0
    market = (F.col("_b") - start) / start * 100.0
    return last.select(
        strategy.alias("strategy_return_pct"),
        market.alias("benchmark_return_pct"),
        (strategy - market).alias("excess_pct"),
    )
