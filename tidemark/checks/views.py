"""The given tables in the shape of market data: once for Spark, once as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.series import Layout, measure_layout
from tidemark.scale import in_tasks
from tidemark.sources.reference_data import MACRO_SERIES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("symbol"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("industry"),
        )
    )


def cents(c: str) -> Column:
    """Whole cents, so that sums are exact in any order."""
    return F.round(F.col(c) * 100).cast("bigint")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        (F.floor(cents("l_extendedprice") / F.col("l_quantity")) / 100).alias("price"),
        F.col("l_quantity").alias("quantity"),
        cents("l_extendedprice").alias("amount"),
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One OHLCV bar per supplier and ship day.

    The order inside a day is one number, so that Spark aggregates by hash; a struct would
    make it sort all trades first. Large tables are shuffled as trades: the hash table of a task would else grow
    with its part of the file, and again with what it reads of the shuffle."""
    when = F.col("l_orderkey").cast("decimal(13,0)") * 10 + F.col("l_linenumber")
    when = when * F.lit(10**11).cast("decimal(12,0)") + F.col("l_partkey").cast("decimal(11,0)")
    when = when * F.lit(10**10).cast("decimal(11,0)") + F.floor(F.col("price") * 100)
    rows = trades(spark, sf_dir).withColumn("when", when.cast("decimal(38,0)"))
    return (
        in_tasks(rows, table(spark, sf_dir, "lineitem").count(), "l_suppkey", "date")
        .groupBy("l_suppkey", "date")
        .agg(
            F.min_by("price", "when").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "when").alias("close"),
            F.sum("quantity").alias("volume"),
            (F.floor(F.sum("amount") / F.sum("quantity")) / 100).alias("vwap"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .withColumn("symbol", F.col("l_suppkey").cast("string"))
        .select("symbol", "date", "open", "high", "low", "close", "volume", "vwap", "trade_count")
    )


def asset_class() -> Column:
    return F.when(F.col("symbol").cast("bigint") % 5 == 0, "crypto").otherwise("equity")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        bars(spark, sf_dir)
        .join(sectors(spark, sf_dir), "symbol")
        .withColumn("asset_class", asset_class())
    )


def price_layout(spark: SparkSession, sf_dir: str) -> Layout:
    """A supplier has at most as many bars as line items: one scan of one column decides."""
    return measure_layout(table(spark, sf_dir, "lineitem").select("l_suppkey"), "l_suppkey")


def _lineage(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns(
        {"ingestion_timestamp": F.lit("2024-01-01T00:00:00+00:00"), "data_source": F.lit(source)}
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equity bars in the silver shape."""
    rows = prices(spark, sf_dir).filter(F.col("asset_class") == "equity")
    return _lineage(rows.withColumnRenamed("date", "timestamp"), "alpaca")


def crypto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crypto bars in the silver shape, which has no sector."""
    rows = bars(spark, sf_dir).withColumn("asset_class", asset_class())
    rows = rows.filter(F.col("asset_class") == "crypto")
    return _lineage(rows.withColumnRenamed("date", "timestamp"), "alpaca")


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten series: one per order priority and whether the order is pending."""
    ids = F.array(*[F.lit(s) for s in MACRO_SERIES])
    names = F.array(*[F.lit(n) for n in MACRO_SERIES.values()])
    index = F.substring("o_orderpriority", 1, 1).cast("int") + F.when(
        F.col("o_orderstatus") == "P", 5
    ).otherwise(0)
    rows = (
        table(spark, sf_dir, "orders")
        .groupBy(index.alias("i"), F.to_date("o_orderdate").alias("date"))
        .agg((F.floor(F.avg(cents("o_totalprice"))) / 100).alias("value"))
        .select(
            "date",
            "value",
            F.element_at(ids, F.col("i")).alias("series_id"),
            F.element_at(names, F.col("i")).alias("series_name"),
        )
    )
    return _lineage(rows, "fred")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as articles: the first line is the title, the rest the description."""
    doc = F.col("doc_id")
    day = F.date_add(F.lit("1995-01-02").cast("date"), (doc % 2500).cast("int"))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(
            F.instr("text", "\n") > 0, F.expr("substring(text, instr(text, '\n') + 1)")
        ).alias("description"),
        F.md5("text").alias("url"),
        "source",
        F.concat(day.cast("string"), F.lit("T12:00:00Z")).alias("published_at"),
        F.lit("AAPL,MSFT").alias("query_tickers"),
        F.concat_ws(", ", (doc * 7 % 100).cast("string"), (doc * 13 % 100).cast("string")).alias(
            "matched_tickers"
        ),
    )
    return _lineage(rows, "newsapi")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).drop("doc_id")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("size"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit("events").alias("source"),
    )


# ---------------------------------------------------------------------------
# the same views as SQL
# ---------------------------------------------------------------------------

_IDS = ", ".join(f"'{s}'" for s in MACRO_SERIES)
_NAMES = ", ".join(f"'{n}'" for n in MACRO_SERIES.values())

_VIEWS: dict[str, str] = {
    "sectors": """
        SELECT CAST(s_suppkey AS VARCHAR) AS symbol, r_name AS sector, n_name AS industry
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "trades": """
        SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
               floor(CAST(round(l_extendedprice * 100) AS BIGINT) / l_quantity) / 100 AS price,
               l_quantity AS quantity,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS amount, l_orderkey, l_linenumber, l_partkey
        FROM lineitem""",
    "bars": """
        SELECT symbol, date,
               first(price ORDER BY l_orderkey, l_linenumber, l_partkey, price) AS open,
               max(price) AS high, min(price) AS low,
               last(price ORDER BY l_orderkey, l_linenumber, l_partkey, price) AS close,
               sum(quantity) AS volume, floor(sum(amount) / sum(quantity)) / 100 AS vwap,
               count(*) AS trade_count
        FROM trades GROUP BY symbol, date""",
    "prices": """
        SELECT b.*, s.sector, s.industry,
               CASE WHEN CAST(b.symbol AS BIGINT) % 5 = 0 THEN 'crypto' ELSE 'equity' END
                   AS asset_class
        FROM bars b JOIN sectors s ON b.symbol = s.symbol""",
    "macro": f"""
        SELECT date, value, ([{_IDS}])[i] AS series_id, ([{_NAMES}])[i] AS series_name
        FROM (
            SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
                       + CASE WHEN o_orderstatus = 'P' THEN 5 ELSE 0 END AS i,
                   CAST(o_orderdate AS DATE) AS date,
                   floor(avg(CAST(round(o_totalprice * 100) AS BIGINT))) / 100 AS value
            FROM orders GROUP BY 1, 2)""",
    "articles": """
        SELECT doc_id, split_part(text, chr(10), 1) AS title,
               CASE WHEN instr(text, chr(10)) > 0
                    THEN substr(text, instr(text, chr(10)) + 1) END AS description,
               md5(text) AS url, source,
               CAST(DATE '1995-01-02' + CAST(doc_id % 2500 AS INTEGER) AS DATE) AS date,
               concat_ws(', ', CAST(doc_id * 7 % 100 AS VARCHAR),
                               CAST(doc_id * 13 % 100 AS VARCHAR)) AS matched_tickers
        FROM documents""",
    "ticks": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS symbol, value AS price,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, 'events' AS source
        FROM events""",
}
_NEEDS = {"bars": ["trades"], "prices": ["bars", "sectors"]}


def sql(body: str, *views: str, recursive: bool = False) -> str:
    """Prefix a query with the views it reads. ``body`` may go on with more ``, name AS (...)``."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in views:
        add(name)
    keep = " AS MATERIALIZED "
    heads = ", ".join(f"{n}{keep}({_VIEWS[n]})" for n in wanted)
    word = "WITH RECURSIVE " if recursive else "WITH "
    return f"{word}{heads} {body}" if heads else body


# with more doubles than this some are rounded as an array
WIDE = 30


def nudge(digits: int) -> float:
    """Less than the last digit, more than rounding noise: moves exact halves off the edge, which
    the engines would otherwise round by different rules."""
    return 2.5 * 10.0 ** -(digits + 3)


def rnd(expression: str, digits: int = 6) -> str:
    scale = 10.0**digits
    shift = 0.5 + nudge(digits) * scale
    return f"floor(({expression}) * {scale} + {shift}) / {scale}"


def rounded_col(c: str | Column, digits: int = 6) -> Column:
    """Plain arithmetic, which is the same in both engines and much cheaper than ``round``."""
    scale = 10.0**digits
    x = F.col(c) if isinstance(c, str) else c
    return F.floor(x * F.lit(scale) + F.lit(0.5 + nudge(digits) * scale)) / F.lit(scale)


def rounded(df: DataFrame, digits: int | dict[str, int] = 6) -> DataFrame:
    """Round doubles, as the two engines add in different orders.

    Of many columns a few are rounded as an array, since Spark compiles a step with a lambda as many small methods.
    All in one, with the joins before, would be a method of over 8,000 bytes, which the JVM only interprets."""
    rules = digits if isinstance(digits, dict) else {}
    default = digits if isinstance(digits, int) else 6
    doubles = {f.name: rules.get(f.name, default) for f in df.schema.fields if f.dataType.typeName() == "double"}
    plain = {c: rounded_col(c, n) for c, n in doubles.items()}
    if len(doubles) <= WIDE:
        return df.withColumns(plain)
    n = next(iter(doubles.values()))
    few = [c for c in doubles if doubles[c] == n][:2]
    array = F.transform(F.array(*few), lambda x: rounded_col(x, n)).alias("_few")
    rows = df.select(*[plain.get(c, F.col(c)).alias(c) for c in df.columns if c not in few], array)
    return rows.select(*[F.get("_few", F.lit(few.index(c))).alias(c) if c in few else c for c in df.columns])
