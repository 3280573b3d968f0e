"""Macro series: pivot, forward fill, daily grid, as-of join."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scale import broadcast_if_small, freeze

# fixed values: series and the mart columns they fill
MART_SERIES: dict[str, str] = {
    "FEDFUNDS": "fedfunds",
    "CPIAUCSL": "cpi",
    "UNRATE": "unemployment_rate",
    "GDP": "gdp",
    "DGS10": "treasury_10y",
    "DGS2": "treasury_2y",
    "VIXCLS": "vix",
    "M2SL": "m2_money_supply",
    "DCOILWTICO": "crude_oil",
    "DEXUSEU": "usd_eur",
}
LONG_RATE, SHORT_RATE = "DGS10", "DGS2"


def slope(df: DataFrame, long_rate: str = LONG_RATE, short_rate: str = SHORT_RATE) -> Column:
    """Long less short rate; null when the table lacks one of them."""
    if long_rate in df.columns and short_rate in df.columns:
        return F.col(long_rate) - F.col(short_rate)
    return F.lit(None).cast("double")


def pivot_series(macro: DataFrame, series: Sequence[str], strict: bool = True) -> DataFrame:
    """One row per date, one column per series.

    The series are named up front, so the schema is fixed and one partial aggregate does it.
    ``strict`` turns a repeated (date, series) into an error; otherwise the largest value wins.
    """
    columns = []
    for s in series:
        mine = F.col("series_id") == s
        value = F.max(F.when(mine, F.col("value")))
        if strict:
            repeated = F.raise_error(F.lit(f"series {s} has two values on one date"))
            value = F.when(F.count_if(mine) > 1, repeated.cast("double")).otherwise(value)
        columns.append(value.alias(s))
    return macro.groupBy("date").agg(*columns)


def fill_calendar(daily: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Last known value of each column. One row per calendar day, so one task orders them all."""
    past = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumns({c: F.last(c, ignorenulls=True).over(past) for c in columns})


def macro_features(
    macro: DataFrame, series: Sequence[str] | None = tuple(MART_SERIES)
) -> DataFrame:
    """Pivot, fill forward over the series' own dates, add the slope of the yield curve.

    ``series=None`` takes every series of the table; a list that leaves some out says so in a
    warning. Series are a few names, however many observations they have."""
    found = macro.filter(F.col("series_id").isNotNull()).select("series_id").distinct()
    names = sorted(r[0] for r in found.collect())
    if series is None:
        series = names
    elif others := sorted(set(names) - set(series)):
        warnings.warn(f"series not among the features: {', '.join(others)}", stacklevel=2)
    filled = fill_calendar(pivot_series(macro, series), series)
    return filled.withColumn("yield_curve_slope", slope(filled))


def as_of_join(
    left: DataFrame, daily: DataFrame, date: str = "date", right_date: str = "date"
) -> DataFrame:
    """Attach the latest ``daily`` row at or before each date of ``left``.

    ``daily`` has one row per date and is stretched to every day it stays current, which makes
    the as-of an equi join: the large side is neither sorted nor moved.
    """
    values = [c for c in daily.columns if c != right_date]
    fixed = freeze(daily.filter(F.col(right_date).isNotNull()))
    last_day = fixed.agg(F.max(right_date)).first()[0]
    if last_day is None:
        types = dict(daily.dtypes)
        return left.withColumns({c: F.lit(None).cast(types[c]) for c in values})
    following = F.lead(right_date).over(Window.orderBy(right_date))
    stretched = fixed.withColumn("_until", F.coalesce(F.date_sub(following, 1), right_date)).select(
        F.explode(F.sequence(right_date, "_until")).alias("_day"), *values
    )
    # a row without a date matches nothing
    day = F.when(F.col(date).isNotNull(), F.least(F.col(date), F.lit(last_day)))
    joined = left.withColumn("_day", day).join(broadcast_if_small(stretched), "_day", "left")
    return joined.select(*left.columns, *values)


def macro_daily(
    price_dates: DataFrame, macro: DataFrame, columns: Mapping[str, str] = MART_SERIES
) -> DataFrame:
    """Forward-filled series on the dates that have prices, one column each.

    A print on a day without any price is not seen, as the grid holds price dates only.
    """
    printed = pivot_series(macro, list(columns), strict=False)
    known = price_dates.select("date").distinct().join(printed, "date", "left")
    daily = fill_calendar(known, list(columns))
    daily = daily.withColumn("yield_curve_slope", slope(daily))
    return daily.withColumnsRenamed(dict(columns))
