"""Registered queries: landed payloads, silver tables, quality reports, text operators."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from tidemark.checks import views
from tidemark.checks.market import (
    LEXICON_SQL,
    NEGATIVE_TOKENS,
    POSITIVE_TOKENS,
    fragment_count,
    scored_by_tokens,
)
from tidemark.checks.views import rnd, rounded, rounded_col, sql
from tidemark.functions import scalars, text
from tidemark.operators import quality
from tidemark.operators.dedup import keep_first
from tidemark.operators.series import over_series
from tidemark.operators.technical import forward_targets, technical_indicators
from tidemark.plans import gold, marts, news, silver
from tidemark.scale import ensure_checkpoint_dir
from tidemark.sources import landing
from tidemark.sources.lake import Lake, last_days

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name, statement=None):
    def add(function):
        QUERIES[name] = function
        if statement:
            SQL[name] = statement
        return function

    return add


# ---------------------------------------------------------------------------
# landed payloads
# ---------------------------------------------------------------------------


def observation_payloads(spark, sf):
    """API answers of one series and year each; every seventh day has no number."""
    rows = views.macro(spark, sf)
    value = F.when(F.dayofyear("date") % 7 == 0, ".").otherwise(F.col("value").cast("string"))
    entry = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), value.alias("value"))
    return rows.groupBy("series_id", F.year("date")).agg(  # at most 366 entries
        F.collect_list(entry).alias("observations")
    )


@register(
    "s5_macro_observations",
    sql("""SELECT strftime(date, '%Y-%m-%d') AS date, value, series_id, series_name,
        'fred' AS data_source FROM macro WHERE dayofyear(date) % 7 <> 0""", "macro"),
)
def observations(spark, sf):
    return landing.macro_observations(observation_payloads(spark, sf)).drop("ingestion_timestamp")


# tickers whose keywords occur in the given documents, one without keywords
KEYWORDS = {"AAA": ["the", "of the"], "BBB": ["de la", "été"], "CCC": ["und", "que"]}
CANDIDATES = ["CCC", "AAA", "BBB", "EN"]


def article_payloads(spark, sf):
    """API answers of up to 50 articles."""
    rows = views.table(spark, sf, "documents")
    rows = rows.select(
        F.floor(F.col("doc_id") / 50).alias("group"),
        F.struct(
            "doc_id",
            F.struct(F.col("source").alias("name")).alias("source"),
            F.when(F.col("doc_id") % 11 == 0, "[Removed]")
            .otherwise(F.substring_index("text", "\n", 1)).alias("title"),
            F.col("text").alias("description"),
            F.md5("text").alias("url"),
            F.lit("1995-01-02T12:00:00Z").alias("publishedAt"),
        ).alias("a"),
    )
    return rows.groupBy("group").agg(
        F.array_sort(F.collect_list("a")).alias("articles")
    ).withColumn("tickers", F.array(*[F.lit(t) for t in CANDIDATES]))


def _word(keyword: str) -> str:
    return rf"(^|[^\p{{L}}\p{{M}}\p{{N}}_]){keyword}($|[^\p{{L}}\p{{M}}\p{{N}}_])"


def _named(body: str, words) -> str:
    return " OR ".join(f"regexp_matches({body}, '{_word(w)}')" for w in words)


def _matched(body: str) -> str:
    cases = []
    for t in CANDIDATES:
        words = KEYWORDS.get(t, [t.lower()])
        cases.append(f"CASE WHEN {_named(body, words)} THEN '{t}' END")
    everything = ",".join(CANDIDATES)
    return f"coalesce(nullif(concat_ws(',', {', '.join(cases)}), ''), '{everything}')"


@register(
    "s6_t1_news_articles",
    f"""WITH a AS (SELECT doc_id, source, text AS description, md5(text) AS url,
            CASE WHEN doc_id % 11 = 0 THEN '[Removed]' ELSE split_part(text, chr(10), 1) END AS title
            FROM documents),
        one AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS k FROM a)
        SELECT title, description, url, source, '1995-01-02T12:00:00Z' AS published_at,
            '{",".join(CANDIDATES)}' AS query_tickers,
            {_matched("lower(title || ' ' || description)")} AS matched_tickers,
            'newsapi' AS data_source
        FROM one WHERE k = 1 AND title <> '[Removed]'""",
)
def articles(spark, sf):
    out = landing.news_articles(article_payloads(spark, sf), KEYWORDS)
    return out.drop("ingestion_timestamp")


def upper_bars(spark, sf):
    """Bars with the upper-case names of a vendor file."""
    rows = views.bars(spark, sf)
    stamp = F.concat(F.col("date").cast("string"), F.lit(" 05:00:00+00:00"))
    return rows.select(
        F.col("symbol").alias("SYMBOL"), stamp.alias("Timestamp"),
        *[F.col(c).alias(c.upper()) for c in ("open", "high", "low", "close", "volume")],
    )


@register(
    "s3_p1_p2_stock_bars",
    sql("""SELECT symbol, CAST(date AS VARCHAR) || ' 05:00:00+00:00' AS timestamp, open, high, low,
        close, volume, 'alpaca' AS data_source, 'equity' AS asset_class FROM bars""", "bars"),
)
def stock_bars(spark, sf):
    return landing.stock_bars(upper_bars(spark, sf)).drop("ingestion_timestamp")


@register(
    "s4_crypto_bars",
    sql("""SELECT symbol, CAST(date AS VARCHAR) || ' 05:00:00+00:00' AS timestamp, open, high, low,
        close, volume, 'alpaca' AS data_source, 'crypto' AS asset_class FROM bars
        WHERE symbol IN ('0', '5')""", "bars"),
)
def crypto_bars(spark, sf):
    pairs = {"zero": "0", "five": "5", "unused": "3"}
    out = landing.crypto_bars(upper_bars(spark, sf), ["zero", "five", "unknown"], pairs)
    return out.drop("ingestion_timestamp")


@register(
    "a8_ingestion_summary",
    sql("""SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_keys, min(date) AS first_date,
        max(date) AS last_date FROM bars""", "bars"),
)
def summary(spark, sf):
    return landing.bars_summary(views.bars(spark, sf), date="date")


@register("a17_distinct_symbols", sql("SELECT DISTINCT symbol FROM trades", "trades"))
def symbols(spark, sf):
    return landing.distinct_sorted(views.trades(spark, sf))


# ---------------------------------------------------------------------------
# silver
# ---------------------------------------------------------------------------


def bronze_bars(spark, sf, bad_dates: bool = False):
    """Bars as landed: text timestamps, and an older copy of every second bar."""
    rows = views.bars(spark, sf)
    stamp = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T05:00:00+00:00"))
    if bad_dates:
        stamp = F.when(F.col("volume") % 7 == 0, F.concat(F.lit("bad "), stamp)).otherwise(stamp)
    rows = rows.withColumn("timestamp", stamp).drop("date")
    rows = rows.withColumn("close", F.when(F.col("volume") % 5 != 0, F.col("close")))
    new = rows.withColumn("ingestion_timestamp", F.lit("2024-01-02T00:00:00+00:00"))
    old = rows.filter(F.col("volume") % 2 == 0).withColumn("close", F.lit(-1.0))
    return new.unionByName(
        old.withColumn("ingestion_timestamp", F.lit("2024-01-01T00:00:00+00:00"))
    )


_SILVER = "symbol, date AS timestamp, open, high, low, close, volume, vwap, trade_count, ingestion_timestamp"


@register(
    "c1_silver_stocks",
    sql(f""", known AS (SELECT * FROM sectors WHERE CAST(symbol AS BIGINT) % 3 <> 0)
        SELECT {_SILVER.replace("symbol,", "b.symbol,")}, coalesce(sector, 'Unknown') AS sector,
            coalesce(industry, 'Unknown') AS industry
        FROM (SELECT *, '2024-01-02T00:00:00+00:00' AS ingestion_timestamp FROM bars
              WHERE CAST(volume AS BIGINT) % 5 <> 0) b LEFT JOIN known k ON b.symbol = k.symbol""",
        "bars", "sectors"),
)
def silver_stocks(spark, sf):
    known = views.sectors(spark, sf).filter(F.col("symbol").cast("bigint") % 3 != 0)
    return silver.silver_stocks(bronze_bars(spark, sf), known)


@register(
    "c2_silver_crypto",
    sql(f"""SELECT {_SILVER} FROM (SELECT *, '2024-01-02T00:00:00+00:00' AS ingestion_timestamp
        FROM bars WHERE CAST(volume AS BIGINT) % 5 <> 0 AND CAST(volume AS BIGINT) % 7 <> 0)""",
        "bars"),
)
def silver_crypto(spark, sf):
    return silver.silver_crypto(bronze_bars(spark, sf, bad_dates=True))


@register(
    "c3_silver_macro",
    sql("""SELECT date, value, series_id, series_name FROM macro
        WHERE CAST(value * 100 AS BIGINT) % 3 <> 0 AND dayofmonth(date) <> 1""", "macro"),
)
def silver_macro(spark, sf):
    rows = views.macro(spark, sf)
    odd = F.round(F.col("value") * 100).cast("bigint") % 3 == 0
    new = rows.withColumn("value", F.when(~odd, F.col("value"))).withColumn(
        "ingestion_timestamp", F.lit("2024-02-01T00:00:00+00:00")
    )
    both = new.unionByName(rows.withColumn("value", F.lit(-1.0)))
    stamp = F.when(F.dayofmonth("date") == 1, "unknown").otherwise(F.col("date").cast("string"))
    out = silver.silver_macro(both.withColumn("date", stamp))
    return out.select("date", "value", "series_id", "series_name")


@register(
    "c4_silver_news",
    sql("""SELECT title, coalesce(description, '') AS description, url, source,
        CAST(date AS VARCHAR) || 'T12:00:00Z' AS published_at, matched_tickers
        FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY matched_tickers, date, source)
              AS k FROM articles) WHERE k = 1""", "articles"),
)
def silver_news(spark, sf):
    out = silver.silver_news(views.news(spark, sf))
    return out.select("title", "description", "url", "source", "published_at", "matched_tickers")


@register(
    "u5_keep_first",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1""",
)
def first_events(spark, sf):
    rows = keep_first(
        views.table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]
    )
    return rows.select("user_id", "event_type", "event_id", "value")


@register(
    "p3_stg_stocks",
    sql("""SELECT symbol, date, open, high, low, close, volume, trade_count, vwap, sector, industry,
        asset_class FROM prices WHERE asset_class = 'equity'""", "prices"),
)
def stg_stocks(spark, sf):
    return marts.stg_stocks(views.stocks(spark, sf)).drop("ingestion_timestamp")


@register(
    "p4_stg_crypto",
    sql("""SELECT symbol, date, open, high, low, close, volume, trade_count, vwap, asset_class
        FROM prices WHERE asset_class = 'crypto'""", "prices"),
)
def stg_crypto(spark, sf):
    return marts.stg_crypto(views.crypto(spark, sf)).drop("ingestion_timestamp")


@register(
    "p5_stg_macro",
    sql("SELECT date, value, series_id, series_name, 'fred' AS data_source FROM macro", "macro"),
)
def stg_macro(spark, sf):
    return marts.stg_macro(views.macro(spark, sf)).drop("ingestion_timestamp")


@register(
    "p6_p25_stg_news",
    sql("""SELECT title, description, url, source, date, 'AAPL,MSFT' AS query_tickers,
        matched_tickers, 'newsapi' AS data_source FROM articles""", "articles"),
)
def stg_news(spark, sf):
    out = marts.stg_news(views.news(spark, sf))
    out = out.withColumn("date", news.calendar_day("published_at"))
    return out.drop("published_at", "ingestion_timestamp")


@register(
    "u1_union_prices",
    sql("""SELECT symbol, date, open, high, low, close, volume, trade_count, vwap, asset_class,
        CASE WHEN asset_class = 'crypto' THEN 'Crypto' ELSE sector END AS sector,
        CASE WHEN asset_class = 'crypto' THEN 'Cryptocurrency' ELSE industry END AS industry
        FROM prices""", "prices"),
)
def union_prices(spark, sf):
    return marts.mart_prices(
        marts.stg_stocks(views.stocks(spark, sf)), marts.stg_crypto(views.crypto(spark, sf))
    )


@register(
    "f10_last_days",
    sql("""SELECT symbol, date, close FROM bars
        WHERE date >= (SELECT max(CAST(l_shipdate AS DATE)) - 30 FROM lineitem)""", "bars"),
)
def trailing_month(spark, sf):
    return last_days(views.bars(spark, sf).select("symbol", "date", "close"), 30)


# ---------------------------------------------------------------------------
# quality
# ---------------------------------------------------------------------------


def _report(table: str, rules: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS rule, {bad} = 0 AS passed,"
        f" CAST({bad} AS BIGINT) AS failures FROM {table}"
        for i, (name, bad) in enumerate(rules)
    ]
    return " UNION ALL ".join(parts)


def _bad(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


@register(
    "q1_q5_write_suite_stocks",
    sql(_report("prices", [
        ("not_null(symbol)", _bad("symbol IS NULL")),
        ("not_null(timestamp)", _bad("date IS NULL")),
        ("min_value(close >= 0.01)", _bad("close < 0.01")),
        ("min_value(volume >= 0)", _bad("volume < 0")),
        ("column_exists(sector)", "0 * count(*)"),
        ("column_exists(industry)", "0 * count(*)"),
    ]), "prices"),
)
def write_suite(spark, sf):
    rows = views.prices(spark, sf).withColumnRenamed("date", "timestamp")
    return quality.run_suite(rows, quality.write_suite("stocks"))


@register(
    "q4_checked_write",
    sql(_report("prices", [
        ("not_null(symbol)", _bad("symbol IS NULL")),
        ("not_null(timestamp)", _bad("date IS NULL")),
        ("min_value(close >= 0.01)", _bad("close < 0.01")),
        ("min_value(volume >= 0)", _bad("volume < 0")),
        ("column_exists(sector)", "0 * count(*)"),
        ("column_exists(industry)", "0 * count(*)"),
        ("min_value(volume >= 100)", _bad("volume < 100")),
        ("unique(symbol)", "count(*) - count(DISTINCT symbol)"),
        ("rows >= 1000000000", "1000000000 - count(*)"),
    ]), "prices"),
)
def checked_write(spark, sf):
    """The suite of the silver write and three rules that fail, counted while the table is written."""
    rows = views.prices(spark, sf).withColumnRenamed("date", "timestamp")
    rules = [*quality.write_suite("stocks"), quality.min_value("volume", 100), quality.unique("symbol"), quality.min_rows(10**9)]
    lake = Lake(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}")
    return quality.write_checked(rows, rules, lambda df: lake.write(df, "stocks", "silver"), lambda: lake.read("stocks", "silver"))


_TWICE = "(SELECT * FROM bars UNION ALL SELECT * FROM bars WHERE CAST(volume AS BIGINT) % 9 = 0)"


@register(
    "q6_q9_silver_suite",
    sql(f""", twice AS {_TWICE}, shaky AS (SELECT symbol, date,
            CASE WHEN CAST(volume AS BIGINT) % 4 <> 0 THEN close END AS close, volume, low,
            CASE WHEN CAST(volume AS BIGINT) % 6 = 0 THEN low - 1 ELSE high END AS high FROM twice)
        """ + _report("shaky", [
        ("not_null(symbol)", _bad("symbol IS NULL")),
        ("not_null(timestamp)", _bad("date IS NULL")),
        ("at_least(close >= 0.01)", _bad("NOT coalesce(close >= 0.01, false)")),
        ("at_least(volume >= 0)", _bad("NOT coalesce(volume >= 0, false)")),
        ("high >= low", _bad("NOT coalesce(high >= low, false)")),
        ("unique(symbol, timestamp)", "(count(*) - count(DISTINCT (symbol, date)))"),
    ]), "bars"),
)
def silver_suite(spark, sf):
    rows = views.bars(spark, sf).withColumnRenamed("date", "timestamp")
    rows = rows.unionByName(rows.filter(F.col("volume") % 9 == 0))
    rows = rows.withColumns({
        "close": F.when(F.col("volume") % 4 != 0, F.col("close")),
        "high": F.when(F.col("volume") % 6 == 0, F.col("low") - 1).otherwise(F.col("high")),
    })
    return quality.run_suite(rows, quality.silver_suite("stocks"))


@register(
    "q13_q16_gold_suite",
    sql("""SELECT * FROM (VALUES (0, 'not_null(symbol)'), (1, 'not_null(date)'),
            (2, 'between(sentiment_net, -1.0, 1.0)'), (3, 'column_exists(macd_hist, rsi_14)'),
            (4, 'null_share(target_5d_return) < 0.02'), (5, 'rows >= 1000'), (6, 'columns >= 6'))
            AS v(position, rule)
        JOIN (SELECT i, passed, CAST(bad AS BIGINT) AS failures FROM (
            SELECT 0 AS i, true AS passed, 0 AS bad UNION ALL SELECT 1, true, 0
            UNION ALL SELECT 2, count(*) FILTER (WHERE volume % 8 = 0) = 0,
                count(*) FILTER (WHERE volume % 8 = 0) FROM bars
            UNION ALL SELECT 3, false, 1
            UNION ALL SELECT 4, 5 * count(DISTINCT symbol) < 0.02 * count(*),
                5 * count(DISTINCT symbol) FROM bars
            UNION ALL SELECT 5, count(*) >= 1000, greatest(1000 - count(*), 0) FROM bars
            UNION ALL SELECT 6, false, 1)) r ON r.i = v.position""", "bars")
    .replace("SELECT * FROM (VALUES", "SELECT CAST(position AS INTEGER) AS position, rule, passed,"
             " failures FROM (VALUES"),
)
def gold_suite(spark, sf):
    def compute(rows, parts, order):
        return rows.withColumns(forward_targets(parts, order))

    layout = views.price_layout(spark, sf)
    rows = over_series(views.bars(spark, sf), compute, back=0, ahead=10, layout=layout)
    rows = rows.select(
        "symbol", "date", "target_5d_return",
        F.lit(1.0).alias("macd_hist"),
        F.when(F.col("volume") % 8 == 0, 2.0).otherwise(0.5).alias("sentiment_net"),
    )
    return quality.run_suite(rows, quality.gold_suite(rows=1000, columns=6, null_share=0.02))


@register(
    "q10_a16_accepted_values",
    sql("""SELECT asset_class, count(*) AS n_records FROM prices
        WHERE asset_class NOT IN ('equity') GROUP BY asset_class""", "prices"),
)
def accepted(spark, sf):
    return quality.rejected_values(views.prices(spark, sf), "asset_class", ["equity"])


@register(
    "q11_test_result",
    sql("""SELECT count(*) AS failures, count(*) <> 0 AS should_warn, count(*) <> 0 AS should_error
        FROM prices WHERE asset_class = 'crypto'""", "prices"),
)
def dbt_style_result(spark, sf):
    rows = views.prices(spark, sf).filter(F.col("asset_class") == "crypto")
    return quality.test_result(rows)


@register(
    "q12_q18_bronze_suites",
    sql(" UNION ALL ".join(
        f"SELECT 'bronze' AS layer, '{t}' AS \"table\", * FROM ("
        + _report(v, [(f"not_null({a})", _bad(f"{x} IS NULL")), (f"not_null({b})",
                  _bad(f"{y} IS NULL")), ("rows >= 1", "CAST(count(*) = 0 AS INTEGER)")]) + ")"
        for t, v, a, x, b, y in (
            ("stocks", "bars", "symbol", "symbol", "timestamp", "date"),
            ("macro", "macro", "series_id", "series_id", "date", "date"),
            ("news", "articles", "title", "title", "published_at", "date"),
        )), "bars", "macro", "articles"),
)
def layers(spark, sf):
    return quality.run_layers({
        ("bronze", "stocks"): views.bars(spark, sf).withColumnRenamed("date", "timestamp"),
        ("bronze", "macro"): views.macro(spark, sf),
        ("bronze", "news"): views.news(spark, sf),
    })


def _layer(layer: str, table: str, report: str) -> str:
    return f"SELECT '{layer}' AS layer, '{table}' AS \"table\", position, rule, passed, failures FROM ({report})"


_ABSENT = "SELECT 0::INTEGER AS position, 'table exists' AS rule, {} AS passed, NULL::BIGINT AS failures"


@register(
    "q17_q18_all_layers",
    sql(" UNION ALL ".join([
        _layer("bronze", "stocks", _report("bars", [
            ("not_null(symbol)", _bad("symbol IS NULL")), ("not_null(timestamp)", _bad("date IS NULL")),
            ("rows >= 1", "CAST(count(*) = 0 AS INTEGER)")])),
        _layer("silver", "macro", _report("macro", [
            ("not_null(series_id)", _bad("series_id IS NULL")), ("not_null(date)", _bad("date IS NULL")),
            ("not_null(value)", _bad("value IS NULL")),
            ("unique(series_id, date)", "count(*) - count(DISTINCT (series_id, date))")])),
        _layer("silver", "crypto", _ABSENT.format("false")), _layer("silver", "news", _ABSENT.format("true")),
        _layer("gold", "features", _report("bars", [
            ("not_null(symbol)", _bad("symbol IS NULL")), ("min_value(close >= 100)", _bad("close < 100"))])),
        _layer("gold", "features", "SELECT 2::INTEGER AS position, 'raises' AS rule, false AS passed, NULL::BIGINT AS failures"),
    ]), "bars", "macro"),
)
def all_layers(spark, sf):
    """Every layer in order: a rule that raises fails, a missing table fails unless it is optional."""
    raises = quality.Rule("raises", "row", ("close",), F.raise_error(F.concat(F.lit("no rule for "), "symbol")).cast("boolean"))
    bars = views.bars(spark, sf)
    return quality.run_layers({
        ("gold", "features"): bars, ("silver", "news"): None, ("bronze", "stocks"): bars.withColumnRenamed("date", "timestamp"),
        ("silver", "crypto"): None, ("silver", "macro"): views.macro(spark, sf),
    }, gold_rules=[quality.not_null("symbol"), quality.min_value("close", 100), raises])


@register(
    "a14_target_nulls",
    sql("""SELECT count(*) AS n_rows, count(DISTINCT symbol) AS target_1d_nulls,
        5 * count(DISTINCT symbol) AS target_5d_nulls FROM bars""", "bars"),
)
def target_nulls(spark, sf):
    rows = views.bars(spark, sf)
    return gold.target_nulls(technical_indicators(rows, "date", views.price_layout(spark, sf)))


# ---------------------------------------------------------------------------
# text and scalars
# ---------------------------------------------------------------------------


@register(
    "t2_t3_lexicon",
    sql(LEXICON_SQL + f"""SELECT doc_id, label, {rnd("score")} AS score,
        {rnd("sentiment_pos")} AS sentiment_pos, {rnd("sentiment_neg")} AS sentiment_neg,
        {rnd("sentiment_neu")} AS sentiment_neu,
        {rnd("sentiment_pos - sentiment_neg")} AS sentiment_net FROM scores""", "articles"),
)
def lexicon(spark, sf):
    rows = views.articles(spark, sf)
    mood = text.lexicon_sentiment("title", POSITIVE_TOKENS, NEGATIVE_TOKENS)
    rows = scored_by_tokens(rows.withColumn("m", mood))
    rows = rows.select("doc_id", F.col("m.label").alias("label"), F.col("m.score").alias("score"),
                       *text.SENTIMENT_COLUMNS)
    return rounded(rows, 6)


@register(
    "t4_fragment_counts",
    sql(f"""SELECT doc_id, CAST({fragment_count(news.POSITIVE_FRAGMENTS)} AS INTEGER) AS pos_count,
        CAST({fragment_count(news.NEGATIVE_FRAGMENTS)} AS INTEGER) AS neg_count FROM articles""",
        "articles"),
)
def fragments(spark, sf):
    return views.articles(spark, sf).select(
        "doc_id",
        text.fragment_count("title", "description", text.POSITIVE_FRAGMENTS).alias("pos_count"),
        text.fragment_count("title", "description", text.NEGATIVE_FRAGMENTS).alias("neg_count"),
    )


def length_scorer():
    """A stand-in for a classifier: scores from the text length."""

    def score(texts):
        return [
            {"Positive": len(t) % 7 / 10, "Negative": len(t) % 3 / 10, "Neutral": 0.1} for t in texts
        ]

    return score


@register(
    "t5_model_scores",
    sql(f"""SELECT doc_id, {rnd("length(title) % 7 / 10.0")} AS sentiment_pos,
        {rnd("length(title) % 3 / 10.0")} AS sentiment_neg, 0.1 AS sentiment_neu,
        {rnd("length(title) % 7 / 10.0 - length(title) % 3 / 10.0")} AS sentiment_net
        FROM articles""", "articles").replace("0.1 AS", "CAST(0.1 AS DOUBLE) AS"),
)
def model_scores(spark, sf):
    rows = views.articles(spark, sf).select("doc_id", "title")
    return rounded(text.with_model_scores(rows, length_scorer).drop("title"), 6)


def ascii_words():
    return lambda t: [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]


def window_scorer():
    """A stand-in for a classifier with a window: tells how many words and characters it was given."""

    def score(texts):
        words = ascii_words()
        return [{"Positive": len(words(t)) / 1000, "Negative": len(t) % 1000 / 1000, "Neutral": 0.0} for t in texts]

    return score


@register(
    "t5_token_window",
    rf"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n FROM documents),
        c AS (SELECT doc_id, least(n, 512) / 1000.0 AS p, length(CASE WHEN n > 512
            THEN regexp_extract(t, '^(?:[ 	-
]*[^ 	-
]+){{512}}') ELSE t END) % 1000 / 1000.0 AS q FROM w)
        SELECT doc_id, {rnd("p")} AS sentiment_pos, {rnd("q")} AS sentiment_neg, 0::DOUBLE AS sentiment_neu,
            {rnd("p - q")} AS sentiment_net FROM c""",
)
def token_window(spark, sf):
    """Whole documents, most of them longer than the window."""
    rows = views.table(spark, sf, "documents").select("doc_id", "text")
    return rounded(text.with_model_scores(rows, window_scorer, "text", load_tokens=ascii_words).drop("text"), 6)


@register(
    "t6_t7_explode_tickers",
    sql("""SELECT doc_id, trim(unnest(string_split(matched_tickers, ','))) AS ticker FROM articles""",
        "articles"),
)
def exploded(spark, sf):
    rows = views.articles(spark, sf).select("doc_id", "matched_tickers")
    return text.explode_tickers(rows).select("doc_id", "ticker")


@register(
    "f1_live_titles",
    sql("SELECT doc_id FROM articles WHERE title IS NOT NULL AND title <> '[Removed]'", "articles"),
)
def titles(spark, sf):
    return landing.live_titles(views.articles(spark, sf)).select("doc_id")


_V = "(volume % 50) / 1000"


@register(
    "p13_p20_scalars",
    sql(f"""SELECT symbol, date, {rnd("close / (volume + 1e-9)")} AS guarded,
        {rnd("CASE WHEN volume % 2 <> 0 THEN close / (volume % 2) ELSE 0 END")} AS ratio,
        CASE WHEN {_V} < 0.015 THEN 'Low' WHEN {_V} < 0.035 THEN 'Medium' ELSE 'High' END AS risk,
        {rnd("greatest(10.0, least(99.0, volume / 40 * 100))")} AS confidence,
        {rnd("close * 100")} AS pct, substr(strftime(date, '%Y-%m-%dT05:00'), 1, 10) AS day,
        TRY_CAST(CASE WHEN volume % 3 = 0 THEN '.' ELSE CAST(trade_count AS VARCHAR) END AS DOUBLE)
            AS number,
        CASE WHEN upper(CASE WHEN volume % 2 = 0 THEN 'eth' ELSE 'x' END || symbol) LIKE 'ETH%'
            THEN 'crypto' ELSE 'equity' END AS class FROM bars""", "bars"),
)
def scalar_columns(spark, sf):
    rows = views.bars(spark, sf)
    volume = F.col("volume")
    name = F.concat(F.when(volume % 2 == 0, "eth").otherwise("x"), "symbol")
    number = F.when(volume % 3 == 0, ".").otherwise(F.col("trade_count").cast("string"))
    return rows.select(
        "symbol", "date",
        rounded_col(scalars.guarded_ratio("close", "volume")).alias("guarded"),
        rounded_col(scalars.ratio_or_zero(F.col("close"), volume % 2)).alias("ratio"),
        scalars.risk_label(volume % 50 / 1000).alias("risk"),
        rounded_col(scalars.confidence_score(volume, F.lit(40.0))).alias("confidence"),
        rounded_col(scalars.percent("close")).alias("pct"),
        scalars.date_prefix(F.date_format("date", "yyyy-MM-dd'T'05:00")).alias("day"),
        scalars.lenient_double(number).alias("number"),
        scalars.inferred_asset_class(name).alias("class"),
    )


@register(
    "j1_p17_lookup",
    sql("""SELECT b.symbol, b.date, coalesce(k.sector, 'Unknown') AS sector,
        coalesce(k.industry, b.symbol) AS industry FROM bars b
        LEFT JOIN (SELECT * FROM sectors WHERE sector <> 'ASIA') k ON b.symbol = k.symbol""",
        "bars", "sectors"),
)
def looked_up(spark, sf):
    known = views.sectors(spark, sf).filter(F.col("sector") != "ASIA")
    rows = views.bars(spark, sf).select("symbol", "date")
    return scalars.lookup(
        rows, known, "symbol", {"sector": F.lit("Unknown"), "industry": F.col("symbol")}
    )
