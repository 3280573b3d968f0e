"""Data-quality rules, reports and layer suites.

Row rules of a table are all counted in one aggregate; uniqueness adds one aggregate per key set.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REPORT_SCHEMA = "position int, rule string, passed boolean, failures long"


@dataclass(frozen=True)
class Rule:
    """``kind`` is "row" (``failing`` marks bad rows), "columns", "unique", "rows", "width"
    or "share" (share of bad rows must stay below ``limit``)."""

    name: str
    kind: str
    columns: tuple[str, ...] = ()
    failing: Column | None = None
    limit: float = 0.0
    optional: bool = field(default=False)  # passes when its columns are missing


def not_null(column: str) -> Rule:
    return Rule(f"not_null({column})", "row", (column,), F.col(column).isNull())


def min_value(column: str, minimum: float) -> Rule:
    """Values below the minimum fail, nulls pass."""
    return Rule(f"min_value({column} >= {minimum})", "row", (column,),
                F.coalesce(F.col(column) < minimum, F.lit(False)))


def at_least(column: str, threshold: float) -> Rule:
    """Values below the threshold fail, and so do nulls."""
    return Rule(f"at_least({column} >= {threshold})", "row", (column,),
                ~F.coalesce(F.col(column) >= threshold, F.lit(False)))


def high_not_below_low() -> Rule:
    ok = F.coalesce(F.col("high") >= F.col("low"), F.lit(False))
    return Rule("high >= low", "row", ("high", "low"), ~ok)


def between(column: str, low: float, high: float, optional: bool = False) -> Rule:
    ok = F.coalesce(F.col(column).between(low, high), F.lit(False))
    return Rule(f"between({column}, {low}, {high})", "row", (column,), ~ok, optional=optional)


def accepted_values(column: str, values: Sequence[str]) -> Rule:
    """Null passes, as a comparison with it is unknown."""
    bad = F.coalesce(~F.col(column).isin(list(values)), F.lit(False))
    return Rule(f"accepted_values({column})", "row", (column,), bad)


def has_columns(*columns: str) -> Rule:
    return Rule(f"column_exists({', '.join(columns)})", "columns", columns)


def unique(*columns: str) -> Rule:
    return Rule(f"unique({', '.join(columns)})", "unique", columns)


def min_rows(n: int) -> Rule:
    return Rule(f"rows >= {n}", "rows", limit=n)


def min_columns(n: int) -> Rule:
    return Rule(f"columns >= {n}", "width", limit=n)


def null_share_below(column: str, share: float) -> Rule:
    return Rule(f"null_share({column}) < {share}", "share", (column,), F.col(column).isNull(), share)


def _row(position: int, rule: Rule, passed: Column, failures: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(rule.name).alias("rule"),
        passed.cast("boolean").alias("passed"),
        failures.cast("long").alias("failures"),
    )


REPORT = "position int, rule string, passed boolean, failures long"


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Report with one row per rule. A rule on a column that is missing fails (unless optional).

    The rows are checked in one pass. If that raises, each rule is run alone, and one that raises
    is a failed row with unknown failures; the report is one row per rule, so it is collected."""
    try:
        rows = [tuple(r) for r in planned(df, rules).collect()]
    except PySparkException:
        rows = []
        for i, rule in enumerate(rules):
            try:
                found = planned(df, [rule]).first()
                rows.append((i, rule.name, found.passed, found.failures))
            except PySparkException:
                rows.append((i, rule.name, False, None))
    return df.sparkSession.createDataFrame(rows, REPORT)


def planned(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The report of ``run_suite`` as a plan."""
    rows_in_one_pass: list[Column] = []
    reports: list[DataFrame] = []
    for i, rule in enumerate(rules):
        missing = [c for c in rule.columns if c not in df.columns]
        if rule.kind == "columns":
            rows_in_one_pass.append(_row(i, rule, F.lit(not missing), F.lit(len(missing))))
        elif missing:
            rows_in_one_pass.append(_row(i, rule, F.lit(rule.optional), F.lit(None)))
        elif rule.kind == "row":
            bad = F.count_if(rule.failing)
            rows_in_one_pass.append(_row(i, rule, bad == 0, bad))
        elif rule.kind == "share":
            bad, n = F.count_if(rule.failing), F.count(F.lit(1))
            rows_in_one_pass.append(_row(i, rule, (n > 0) & (bad < n * rule.limit), bad))
        elif rule.kind == "rows":
            n = F.count(F.lit(1))
            short = F.greatest(F.lit(int(rule.limit)) - n, F.lit(0))
            rows_in_one_pass.append(_row(i, rule, n >= int(rule.limit), short))
        elif rule.kind == "width":
            width = len(df.columns)
            short = max(int(rule.limit) - width, 0)
            rows_in_one_pass.append(_row(i, rule, F.lit(short == 0), F.lit(short)))
        elif rule.kind == "unique":
            extra = F.coalesce(F.sum(F.col("count") - 1), F.lit(0))
            reports.append(
                df.groupBy(*rule.columns).count().agg(_row(i, rule, extra == 0, extra).alias("r"))
            )
        else:
            raise ValueError(f"unknown rule kind {rule.kind}")
    if rows_in_one_pass:
        one = df.agg(F.array(*rows_in_one_pass).alias("_r")).select(F.explode("_r").alias("r"))
        reports.insert(0, one)
    report = reports[0]
    for more in reports[1:]:
        report = report.unionByName(more)
    return report.select("r.*")


def write_checked(
    df: DataFrame, rules: Sequence[Rule], write: Callable[[DataFrame], object], written: Callable[[], DataFrame]
) -> DataFrame:
    """Write a table and report the suite on it, the rows counted as they pass into the sink.

    ``write`` gets the frame to write, ``written`` reads the table back: only rules on uniqueness
    need that, and a table on whose rows a rule raises, which is written without the checks and
    then reported by ``run_suite``."""
    missing = {i: [c for c in rule.columns if c not in df.columns] for i, rule in enumerate(rules)}
    counted = {i: rule for i, rule in enumerate(rules) if rule.kind in ("row", "share") and not missing[i]}
    seen = Observation()
    counts = [F.count_if(rule.failing).alias(f"r{i}") for i, rule in counted.items()]
    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("n"), *counts))
    except PySparkException:
        write(df)
        return run_suite(written(), rules)
    found = seen.get
    n, rows = found["n"], []
    for i, rule in enumerate(rules):
        if i in counted:
            bad = found[f"r{i}"]
            rows.append((i, rule.name, bad == 0 if rule.kind == "row" else n > 0 and bad < n * rule.limit, bad))
        elif rule.kind == "rows":
            rows.append((i, rule.name, n >= int(rule.limit), max(int(rule.limit) - n, 0)))
        elif rule.kind == "unique" and not missing[i]:
            rows.append((i, *planned(written(), [rule]).select("rule", "passed", "failures").first()))
        else:  # columns, width, and rules whose columns are not there: known without rows
            rows.append((i, *planned(df.limit(0), [rule]).select("rule", "passed", "failures").first()))
    return df.sparkSession.createDataFrame(rows, REPORT)


def all_passed(report: DataFrame) -> bool:
    return report.filter(~F.col("passed")).limit(1).count() == 0


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def rejected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list, with their counts."""
    return value_counts(df, column).filter(~F.col(column).isin(list(accepted)))


def test_result(failures: DataFrame) -> DataFrame:
    """Summary of a test query: how many failing rows, and whether that warns or stops a build."""
    n = F.count(F.lit(1))
    return failures.agg(
        n.alias("failures"), (n != 0).alias("should_warn"), (n != 0).alias("should_error")
    )


# ---------------------------------------------------------------------------
# suites
# ---------------------------------------------------------------------------



def write_suite(table: str) -> list[Rule]:
    """Checks while silver is written; advisory, the write goes on."""
    return {
        "stocks": lambda: [
            not_null("symbol"), not_null("timestamp"), min_value("close", 0.01),
            min_value("volume", 0), has_columns("sector"), has_columns("industry"),
        ],
        "crypto": lambda: [
            not_null("symbol"), not_null("timestamp"), min_value("close", 0.000001),
            min_value("volume", 0),
        ],
        "macro": lambda: [not_null("series_id"), not_null("date"), not_null("value")],
        "news": lambda: [not_null("title"), not_null("published_at"), not_null("url")],
    }[table]()


def bronze_suite(table: str) -> list[Rule]:
    key = {
        "stocks": ("symbol", "timestamp"),
        "crypto": ("symbol", "timestamp"),
        "macro": ("series_id", "date"),
        "news": ("title", "published_at"),
    }[table]
    return [*[not_null(c) for c in key], min_rows(1)]


def silver_suite(table: str) -> list[Rule]:
    return {
        "stocks": lambda: [
            not_null("symbol"), not_null("timestamp"), at_least("close", 0.01),
            at_least("volume", 0), high_not_below_low(), unique("symbol", "timestamp"),
        ],
        "crypto": lambda: [
            not_null("symbol"), not_null("timestamp"), at_least("close", 0.000001),
            unique("symbol", "timestamp"),
        ],
        "macro": lambda: [
            not_null("series_id"), not_null("date"), not_null("value"),
            unique("series_id", "date"),
        ],
        "news": lambda: [
            not_null("title"), not_null("published_at"), not_null("url"), unique("url"),
        ],
    }[table]()


def gold_suite(rows: int = 50_000, columns: int = 40, null_share: float = 0.01) -> list[Rule]:
    """The limits suit a universe of 60 assets over five years; pass others for other tables."""
    return [
        not_null("symbol"),
        not_null("date"),
        between("sentiment_net", -1.0, 1.0, optional=True),
        has_columns("macd_hist", "rsi_14"),
        null_share_below("target_5d_return", null_share),
        min_rows(rows),
        min_columns(columns),
    ]


def staging_suite(model: str) -> list[Rule]:
    """Schema tests of the staging models."""
    price = lambda asset: [
        not_null("symbol"), not_null("date"),
        accepted_values("asset_class", [asset]), not_null("close"),
    ]
    return {
        "stg_stocks": lambda: price("equity"),
        "stg_crypto": lambda: price("crypto"),
        "stg_macro": lambda: [not_null("series_id"), not_null("date"), not_null("value")],
    }[model]()


def run_layers(
    tables: Mapping[tuple[str, str], DataFrame | None],
    gold_rules: Sequence[Rule] | None = None,
    optional: Sequence[tuple[str, str]] = (("silver", "news"),),
) -> DataFrame | None:
    """Suites of all layers in order; keys are (layer, table), None marks a table not found.

    A missing optional table is a warning (passes), any other missing table a failure.
    """
    order = {"bronze": 0, "silver": 1, "gold": 2}
    result = None
    for layer, table in sorted(tables, key=lambda k: order[k[0]]):
        df = tables[(layer, table)]
        if df is None:
            spark = next(t for t in tables.values() if t is not None).sparkSession
            found = (layer, table) in optional
            report = spark.range(1).select(
                F.lit(0).alias("position"), F.lit("table exists").alias("rule"),
                F.lit(found).alias("passed"), F.lit(None).cast("long").alias("failures"),
            )
        else:
            rules = {
                "bronze": lambda t=table: bronze_suite(t),
                "silver": lambda t=table: silver_suite(t),
                "gold": lambda: list(gold_rules or gold_suite()),
            }[layer]()
            report = run_suite(df, rules)
        report = report.select(F.lit(layer).alias("layer"), F.lit(table).alias("table"), "*")
        result = report if result is None else result.unionByName(report)
    return result
