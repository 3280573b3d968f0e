"""Registered queries of sources, sinks, catalog, loads and the remaining check suites.

Each writes a given table to a new folder or catalog name, reads it back and is compared with SQL
over the table itself. Loads over JDBC need a database server and are not among them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.checks import views
from tidemark.checks.views import rnd, rounded, sql
from tidemark.operators import metrics, quality
from tidemark.plans import training
from tidemark.scale import ensure_checkpoint_dir, freeze
from tidemark.sources import landing, reference_data, schemas, warehouse
from tidemark.sources.lake import Lake, as_table, as_view, run_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name, statement):
    def add(function):
        QUERIES[name], SQL[name] = function, statement
        return function

    return add


def new_lake(spark) -> Lake:
    return Lake(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}")


def narrow(df):
    return rounded(df.select("symbol", "date", "trade_count", "close"), 4)


NARROW = f"SELECT symbol, date, trade_count, {rnd('close', 4)} AS close FROM "


@register("s1_k1_lake_round_trip", sql(NARROW + "bars", "bars"))
def lake_round_trip(spark, sf):
    """Overwritten with other columns, then appended to."""
    lake, rows = new_lake(spark), freeze(views.bars(spark, sf))
    late = F.col("date") >= "1995-01-01"
    lake.write(rows.select("symbol"), "bars", "gold")
    lake.write(rows.filter(late), "bars", "gold")
    lake.write(rows.filter(~late), "bars", "gold", mode="append")
    return narrow(lake.read("bars", "gold", essential=True))


@register("k1_write_modes", sql(NARROW + "bars WHERE symbol::INTEGER % 3 = 0", "bars"))
def write_modes(spark, sf):
    """What is there stays: an ignored write changes nothing, and one that must not meet a table is refused."""
    lake, rows = new_lake(spark), freeze(views.bars(spark, sf))
    lake.write(rows.filter(F.col("symbol").cast("int") % 3 == 0), "bars", "gold", mode="error")
    lake.write(rows, "bars", "gold", mode="ignore")
    try:
        lake.write(rows, "bars", "gold", mode="error")
    except AnalysisException as refused:
        if refused.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return narrow(lake.read("bars", "gold", essential=True))
    raise AssertionError("written over a table")


@register("s2_optional_table", sql("""SELECT symbol, count(*) AS n_days, 0::BIGINT AS n_coins,
    count(*) FILTER (WHERE asset_class = 'crypto') AS n_coins_later FROM prices GROUP BY symbol""", "prices"))  # fmt: skip
def optional_table(spark, sf):
    """Bars beside the optional crypto table, before and after it is there."""
    lake, rows = new_lake(spark), freeze(views.prices(spark, sf))
    days = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_days"))
    for name in ("n_coins", "n_coins_later"):
        coins = lake.read("crypto", "silver").groupBy("symbol").agg(F.count(F.lit(1)).alias(name))
        days = freeze(days.join(coins, "symbol", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long"))))
        lake.write(rows.filter("asset_class = 'crypto'"), "crypto", "silver")
    return days


@register("s9_stored_or_catalog_table", sql(
    "SELECT 'catalog' AS place, * FROM (" + NARROW + "bars) UNION ALL SELECT 'stored', * FROM (" + NARROW + "bars)", "bars"))
def stored_or_catalog(spark, sf):
    lake = new_lake(spark)
    lake.write(views.bars(spark, sf), "bars", "gold")
    prefix = f"t{uuid.uuid4().hex[:12]}_"
    lake.discover(prefix)
    places = {"catalog": f"{prefix}bars", "stored": "bars"}
    parts = [narrow(lake.load_table(n)).select(F.lit(p).alias("place"), "*") for p, n in places.items()]
    return parts[0].unionByName(parts[1])


@register("s13_k2_k3_views", sql(
    "SELECT symbol, count(*) AS n_days, max(date) AS last_day FROM bars GROUP BY symbol", "bars"))
def views_and_sql(spark, sf):
    """A query over a view, kept as a table that takes the place of one with other columns."""
    rows = as_view(views.bars(spark, sf), f"v{uuid.uuid4().hex[:12]}")
    found = run_sql(spark, "SELECT symbol, count(*) AS n_days, max(date) AS last_day FROM {bars} GROUP BY symbol", bars=rows)
    name = f"k3_{uuid.uuid4().hex[:12]}"
    as_table(rows.select("date"), name)
    return as_table(found, name)


@register("s14_discovered_tables", sql("""SELECT unnest(['bars', 'bronze_macro', 'gold_macro']) AS "table",
    unnest([(SELECT count(*) FROM (DESCRIBE SELECT * FROM bars)), 2, 4])::INTEGER AS n_columns""", "bars"))  # fmt: skip
def discovered(spark, sf):
    """A name in two layers carries its layer."""
    lake, prefix = new_lake(spark), f"d{uuid.uuid4().hex[:12]}_"
    lake.write(views.bars(spark, sf), "bars", "silver")
    macro = views.macro(spark, sf)
    lake.write(macro.select("date", "series_id", "series_name", "value"), "macro", "gold")
    lake.write(macro.select("date", "value"), "macro", "bronze")
    lake.discover(prefix)
    return lake.tables(prefix).select(F.substring_index("table", prefix, -1).alias("table"), "n_columns")


@register("s14_partitioned_table", sql(f"""SELECT symbol, date, trade_count, {rnd('close', 4)} AS close, year(date)::INTEGER AS year,
    CASE WHEN symbol::INTEGER % 2 = 1 THEN {rnd('vwap', 4)} END AS vwap FROM bars""", "bars"))  # fmt: skip
def discovered_partitions(spark, sf):
    """A table folder by year that gains a column and years after it was registered."""
    lake, prefix = new_lake(spark), f"p{uuid.uuid4().hex[:12]}_"
    rows = freeze(views.bars(spark, sf).withColumn("year", F.year("date")).select(
        "symbol", "date", "trade_count", "close", "vwap", "year"))
    even = F.col("symbol").cast("int") % 2 == 0
    lake.write(rows.filter(even & (F.col("year") % 2 == 0)).drop("vwap"), "bars", "gold", partition_by=["year"])
    lake.discover(prefix)
    lake.write(rows.filter(~even), "bars", "gold", mode="append", partition_by=["year"])
    lake.write(rows.filter(even & (F.col("year") % 2 == 1)).drop("vwap"), "bars", "gold", mode="append", partition_by=["year"])
    lake.discover(prefix)
    return rounded(lake.load_table(f"{prefix}bars"), 4)


@register("c15_k6_sync", sql(
    NARROW + "bars WHERE date >= (SELECT max(date) FROM bars) - 30", "bars"))
def synced(spark, sf):
    """The last days of the gold features, loaded into a namespace of their own."""
    lake, name = new_lake(spark), f"load_{uuid.uuid4().hex[:12]}"
    lake.write(views.bars(spark, sf), "features", "gold")
    warehouse.sync(spark, lake, name)
    return narrow(spark.table(f"{name}.mart_features"))


@register("k6_append", sql(NARROW + "(SELECT * FROM bars UNION ALL SELECT * FROM bars)", "bars"))
def appended(spark, sf):
    rows, table = freeze(views.bars(spark, sf)), f"load_{uuid.uuid4().hex[:12]}"
    for _ in range(2):
        warehouse.load_table(rows, table, replace=False)
    return narrow(spark.table(table))


@register("k8_published", sql(NARROW + "bars WHERE trade_count > 1", "bars"))
def published(spark, sf):
    lake = new_lake(spark)
    training.publish(lake, "backtest_report", views.bars(spark, sf).filter("trade_count > 1"))
    return narrow(lake.read("backtest_report", "gold", essential=True))


@register("u6_landed_files", sql("SELECT symbol, strftime(date, '%Y-%m-%d') AS timestamp, trade_count FROM bars", "bars"))
def landed(spark, sf):
    """Payloads landed in two folders, read as one table."""
    root = new_lake(spark).root
    rows = views.bars(spark, sf).select("symbol", F.date_format("date", "yyyy-MM-dd").alias("timestamp"), "trade_count")
    even = F.col("trade_count") % 2 == 0
    rows.filter(even).write.json(f"{root}/a")
    rows.filter(~even).write.json(f"{root}/b")
    found = landing.read_json(spark, [f"{root}/a", f"{root}/b"], schemas.BAR_PAYLOAD)
    return found.select("symbol", "timestamp", F.col("trade_count").cast("long").alias("trade_count"))


_SECTORS = ", ".join(f"({i}, '{s}', '{a}', '{b}')" for i, (s, a, b) in enumerate(reference_data.SECTORS))


@register("s7_s8_reference_tables", sql(f"""SELECT s.symbol, s.sector, s.industry, count(*) AS n_days,
    s.symbol IN ({", ".join(f"'{s}'" for s in reference_data.EQUITIES)}) AS listed
    FROM bars b JOIN (VALUES {_SECTORS}) s (i, symbol, sector, industry) ON b.symbol::INTEGER % {len(reference_data.SECTORS)} = s.i
    GROUP BY ALL""", "bars"))  # fmt: skip
def reference_tables(spark, sf):
    """The bars under the names of the reference assets, by number."""
    names = F.array(*[F.lit(s[0]) for s in reference_data.SECTORS])
    number = (F.col("symbol").cast("int") % len(reference_data.SECTORS) + 1).cast("int")
    rows = views.bars(spark, sf).select(F.element_at(names, number).alias("symbol"))
    rows = freeze(rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_days")))
    listed = reference_data.in_universe(rows.select("symbol"), reference_data.universe(spark))
    listed = listed.select("symbol", F.lit(True).alias("listed"))
    joined = rows.join(reference_data.sectors(spark), "symbol").join(listed, "symbol", "left")
    return joined.withColumn("listed", F.coalesce("listed", F.lit(False)))


@register("s12_j8_leaderboard_with_parameters", sql("""SELECT symbol AS run_uuid, avg(trade_count) AS rmse,
    max(trade_count)::DOUBLE AS sharpe, min(trade_count)::DOUBLE AS depth,
    CASE WHEN symbol::INTEGER % 2 = 0 THEN 0.5 END AS rate
    FROM bars GROUP BY symbol HAVING symbol::INTEGER % 7 <> 0""", "bars"))  # fmt: skip
def board_with_parameters(spark, sf):
    """Runs, metrics and parameters as a tracking store keeps them; runs without rmse drop out."""
    number = F.col("symbol").cast("int")
    runs = views.bars(spark, sf).groupBy(F.col("symbol").alias("run_uuid")).agg(
        F.avg("trade_count").alias("rmse"), F.max("trade_count").cast("double").alias("sharpe"),
        F.min("trade_count").cast("double").alias("depth"))
    runs = freeze(runs.withColumn("symbol", F.col("run_uuid")))

    def stored(**columns):
        entries = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in columns.items()]
        return runs.select("run_uuid", F.inline(F.array(*entries))).filter("value is not null")

    known = stored(rmse=F.when(number % 7 != 0, F.col("rmse")), sharpe=F.col("sharpe"))
    params = stored(depth=F.col("depth"), rate=F.when(number % 2 == 0, F.lit(0.5)))
    return metrics.leaderboard(runs.select("run_uuid"), known, params, ("depth", "rate"), ("rmse", "sharpe"))


def _bad(view: str, *rules: tuple[str, str]) -> str:
    rows = [f"SELECT {i} AS position, '{name}' AS rule, count(*) FILTER (WHERE {failing}) AS failures FROM {view}"
            for i, (name, failing) in enumerate(rules)]
    return f"SELECT position::INTEGER AS position, rule, failures = 0 AS passed, failures FROM ({' UNION ALL '.join(rows)})"


_SUITES = {
    "crypto": _bad("prices", ("not_null(symbol)", "symbol IS NULL"), ("not_null(timestamp)", "date IS NULL"),
                   ("min_value(close >= 1e-06)", "close < 1e-6"), ("min_value(volume >= 0)", "volume < 0")),
    "macro": _bad("macro", *((f"not_null({c})", f"{c} IS NULL") for c in ("series_id", "date", "value"))),
    "news": _bad("articles", ("not_null(title)", "title IS NULL"), ("not_null(published_at)", "date IS NULL"),
                 ("not_null(url)", "url IS NULL")),
    "stg_macro": _bad("macro", *((f"not_null({c})", f"{c} IS NULL") for c in ("series_id", "date", "value"))),
    "stg_stocks": _bad("prices", ("not_null(symbol)", "symbol IS NULL"), ("not_null(date)", "date IS NULL"),
                       ("accepted_values(asset_class)", "asset_class <> 'equity'"), ("not_null(close)", "close IS NULL")),
}


@register("q5_q11_suites", sql(" UNION ALL ".join(f"SELECT '{n}' AS suite, * FROM ({s})" for n, s in _SUITES.items()),
                               "prices", "macro", "articles"))
def suites(spark, sf):
    prices = freeze(views.prices(spark, sf))
    macro = freeze(views.macro(spark, sf))
    reports = {
        "crypto": (prices.withColumnRenamed("date", "timestamp"), quality.write_suite("crypto")),
        "macro": (macro, quality.write_suite("macro")),
        "news": (views.news(spark, sf), quality.write_suite("news")),
        "stg_macro": (macro, quality.staging_suite("stg_macro")),
        "stg_stocks": (prices, quality.staging_suite("stg_stocks")),
    }
    out = None
    for name, (rows, rules) in reports.items():
        report = quality.run_suite(rows, rules).select(F.lit(name).alias("suite"), "position", "rule", "passed", "failures")
        out = report if out is None else out.unionByName(report)
    return out
