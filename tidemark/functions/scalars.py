"""Column expressions for casts, guarded arithmetic, labels and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scale import broadcast_if_small

# fixed value: keeps denominators away from zero
EPSILON = 1e-9

# fixed values: volatility limits of the risk labels
LOW_RISK_BELOW = 0.015
MEDIUM_RISK_BELOW = 0.035

# fixed values: range and neutral value of the confidence score
CONFIDENCE_MIN, CONFIDENCE_MAX, CONFIDENCE_NEUTRAL = 10.0, 99.0, 50.0

# fixed values: symbol prefixes that mark a crypto asset
CRYPTO_PREFIXES = ("BTC", "ETH", "ADA", "SOL", "BNB", "XRP", "DOGE", "MATIC", "DOT", "AVAX")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def with_lineage(df: DataFrame, data_source: str, asset_class: str | None = None) -> DataFrame:
    """UTC ingestion time as ISO text, the source, and the asset class where there is one."""
    stamp = F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'",
    )
    df = df.withColumn("ingestion_timestamp", stamp).withColumn("data_source", F.lit(data_source))
    return df.withColumn("asset_class", F.lit(asset_class)) if asset_class else df


def strict_date(c: str | Column) -> Column:
    """Day of an ISO timestamp; text that is no date is an error whatever the ANSI setting."""
    parsed = lenient_date(c)
    bad = _col(c).isNotNull() & parsed.isNull()
    return F.when(
        bad, F.raise_error(F.concat(F.lit("not a date: "), _col(c).cast("string"))).cast("date")
    ).otherwise(parsed)


def lenient_date(c: str | Column) -> Column:
    """Day of an ISO timestamp as written, in any session zone; text that is no date becomes null."""
    text = _col(c).cast("string")
    return F.when(F.try_to_timestamp(text).isNotNull(), text.try_cast("date"))


def lenient_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def not_nan(c: str | Column) -> Column:
    """One missing value: NaN becomes null."""
    return F.when(~F.isnan(_col(c)), _col(c))


def date_prefix(c: str | Column) -> Column:
    """Day part of an ISO timestamp kept as text."""
    return F.substring(_col(c), 1, 10)


def guarded_ratio(a: str | Column, b: str | Column) -> Column:
    return _col(a) / (_col(b) + F.lit(EPSILON))


def ratio_or_zero(a: str | Column, b: str | Column) -> Column:
    """``a / b`` where ``b`` is not zero, else 0 (also for a null ``b``)."""
    return F.when(_col(b) != 0, F.try_divide(_col(a), _col(b))).otherwise(F.lit(0.0))


def percent(c: str | Column) -> Column:
    return _col(c) * 100.0


def risk_label(volatility: str | Column) -> Column:
    """A missing volatility counts as high."""
    v = _col(volatility)
    return F.when(v < LOW_RISK_BELOW, "Low").when(v < MEDIUM_RISK_BELOW, "Medium").otherwise("High")


def confidence_score(predicted: str | Column, largest: str | Column) -> Column:
    """Size of a prediction against the largest one, as a bounded percentage."""
    p, top = _col(predicted), _col(largest)
    share = F.abs(p) / F.when(top > 0, top) * 100.0
    bounded = F.greatest(F.lit(CONFIDENCE_MIN), F.least(F.lit(CONFIDENCE_MAX), share))
    return F.when(top <= 0, F.lit(CONFIDENCE_NEUTRAL)).otherwise(F.when(p.isNotNull(), bounded))


def inferred_asset_class(symbol: str | Column) -> Column:
    upper = F.upper(_col(symbol))
    hit = F.lit(False)
    for prefix in CRYPTO_PREFIXES:
        hit = hit | upper.startswith(prefix)
    return F.when(hit, "crypto").otherwise("equity")


def clip(c: str | Column, low: Column, high: Column) -> Column:
    """Null stays null, unlike ``greatest`` and ``least`` alone."""
    return F.when(_col(c).isNotNull(), F.greatest(low, F.least(high, _col(c))))


def z_score(c: str | Column, mean: Column, std: Column) -> Column:
    """Population deviation, with a small floor against constant columns."""
    return (_col(c) - mean) / (std + F.lit(1e-8))


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The wanted columns that the table has, in the wanted order."""
    return [c for c in columns if c in df.columns]


def columns_first(df: DataFrame, first: Sequence[str]) -> DataFrame:
    return df.select(*first, *[c for c in df.columns if c not in first])


def lookup(
    df: DataFrame, table: DataFrame, key: str, defaults: Mapping[str, Column]
) -> DataFrame:
    """Left join of a lookup table with a default for keys it does not hold. Of the table only the
    key and the columns with a default are taken."""
    joined = df.drop(*defaults).join(broadcast_if_small(table.select(key, *defaults)), key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})
