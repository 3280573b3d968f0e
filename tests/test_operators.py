"""Text, quality, silver, lake, split, metric, backtest, recommendation and stream behavior."""

import datetime as dt
import json
import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars, text
from tidemark.operators import backtest, metrics, models, quality, quantiles, recommend
from tidemark.operators.dedup import keep_first
from tidemark.operators.macro import as_of_join, macro_daily, macro_features, pivot_series
from tidemark.operators.split import chronological_split, walk_forward
from tidemark.plans import gold, marts, news, overview, silver, training
from tidemark.sources import landing, reference_data, schemas, warehouse
from tidemark.sources.lake import Lake, MissingTable, last_days
from tidemark.streaming.ticks import TickStore, decode, file_source


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# text -----------------------------------------------------------------------


@pytest.mark.parametrize(
    ("title", "description", "tickers", "want"),
    [
        ("Nvidia and AMD both ship", None, ["AMD", "NVDA", "DIS"], "AMD,NVDA"),
        ("quarterly figures", "sales of Disney+ grew, says DIS", ["CRM", "DIS"], "DIS"),
        ("Weather tomorrow", "Rain in the north.", ["PEP", "NKE"], "PEP,NKE"),
        ("The nikes are sold out", "a kodak moment", ["NKE", "KO"], "NKE,KO"),
        ("Coke or pepsi?", "", ["KO", "PEP", "MCD"], "KO,PEP"),
        ("P&G, then Johnson & Johnson", None, ["V", "JNJ", "PG"], "JNJ,PG"),
        (None, "prices of gold: GLD up", ["BTC", "GLD"], "GLD"),
        ("nothing", None, [], ""),
    ],
)
def test_match_tickers(spark, title, description, tickers, want):
    array = F.array(*[F.lit(t) for t in tickers])
    lit = lambda s: F.lit(s).cast("string")
    assert one(spark, text.match_tickers(lit(title), lit(description), array)) == want


def test_keywords_that_overlap(spark):
    """Keywords that start alike or lie across each other are all found, as by a pattern of each alone."""
    keywords = {"A": ("big",), "B": ("big blue", "blue sky"), "C": ("big blue sky",), "D": ("sky",), "E": ("bigger", "a&b")}
    array = F.array(*[F.lit(t) for t in "ABCDE"])
    find = lambda t: one(spark, text.match_tickers(F.lit(t), F.lit(None).cast("string"), array, keywords))
    for t in ("a big blue sky", "BIG BLUE", "blue sky", "bigger", "big bluesky", "so a&b, sky", "big big blue skyline", "none"):
        want = [k for k, words in keywords.items() if any(re.search(rf"\b{re.escape(w)}\b", t.lower()) for w in words)]
        assert find(t) == ",".join(want or "ABCDE"), t
    assert one(spark, text.match_tickers(F.lit("big A"), F.lit(""), array, {})) == "A"


def test_lexicon(spark):
    mood = lambda s: tuple(one(spark, text.lexicon_sentiment(F.lit(s))))
    # three positive words against one negative; a repeated word counts once
    assert mood("rise RISE boost beat then fall") == ("Positive", 0.75)
    assert mood("plunge miss success") == ("Negative", pytest.approx(2 / 3))
    assert mood("surge drop") == ("Negative", 0.5)
    assert mood("") == mood("risen falling") == ("Neutral", 1.0)


def articles(spark):
    return spark.createDataFrame(
        [
            ("chips boost", "2025-03-04T08:30:00Z", "NVDA, AMD"),
            ("chips miss and drop", "2025-03-04T21:00:00Z", "AMD"),
            ("a quiet day", "2025-03-05T00:00:00Z", "AMD"),
        ],
        "title string, published_at string, matched_tickers string",
    )


def test_news_sentiment(spark):
    rows = {(r.ticker, r.date.day): r for r in news.news_sentiment(articles(spark)).collect()}
    assert {k: r.sentiment_net for k, r in rows.items()} == {("NVDA", 4): 1.0, ("AMD", 4): 0.0, ("AMD", 5): 0.0}
    assert rows["AMD", 4].sentiment_neg == 0.5 and rows["AMD", 5].sentiment_neu == 1.0


def test_model_scores_fall_back(spark):
    def broken():
        raise RuntimeError("no model")

    rows = text.with_model_scores(articles(spark), broken, fallback=text.with_lexicon_scores)
    assert rows.filter("title like '%miss%'").first().sentiment_net == -1.0
    with pytest.raises(Exception, match="no model"):
        text.with_model_scores(articles(spark), broken).collect()


def test_model_window(spark, monkeypatch):
    """Texts are cut after the window, scored with others of their length, and come out in order."""
    texts = [" ".join(["w"] * (1 + i * 37 % 90)) for i in range(300)] + [None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, title string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")

    def padded():
        # tells the words of a text and the longest text of its batch
        return lambda part: [{"positive": len(t.split()), "negative": max(len(x.split()) for x in part), "neutral": len(part)} for t in part]

    try:
        words = lambda: lambda t: [m.span() for m in re.finditer(r"\S+", t)]
        got = text.with_model_scores(rows, padded, batch_size=10, load_tokens=words, max_tokens=50).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.i for r in got] == list(range(302))
    assert [r.sentiment_pos for r in got] == [min(50, len((t or "").split())) for t in texts]
    assert sum(r.sentiment_neg - r.sentiment_pos for r in got) < 302 * 2  # hardly any padding
    assert sorted({r.sentiment_neu for r in got}) == [2.0, 10.0]


# scalars --------------------------------------------------------------------


@pytest.mark.parametrize(
    ("v", "want"), [(0.0, "Low"), (0.0151, "Medium"), (0.029, "Medium"), (0.06, "High"), (None, "High")]
)
def test_risk(spark, v, want):
    assert one(spark, scalars.risk_label(F.lit(v).cast("double"))) == want


@pytest.mark.parametrize(
    ("p", "top", "want"), [(0.03, 0.04, 75), (-0.04, 0.05, 80), (0.5, 0.0, 50), (0.0001, 1.0, 10), (2.0, 1.0, 99)]
)
def test_confidence(spark, p, top, want):
    assert one(spark, scalars.confidence_score(F.lit(p), F.lit(top))) == pytest.approx(want)


def test_dates(spark):
    assert one(spark, scalars.lenient_date(F.lit("2024-05-06T23:30:00+00:00"))) == dt.date(2024, 5, 6)
    assert one(spark, scalars.lenient_date(F.lit("nonsense"))) is None
    assert one(spark, scalars.strict_date(F.lit("2024-05-06"))) == dt.date(2024, 5, 6)
    with pytest.raises(Exception, match="not a date"):
        one(spark, scalars.strict_date(F.lit("nonsense")))
    assert one(spark, scalars.lenient_double(F.lit("."))) is None


# quality --------------------------------------------------------------------


def passed(df, rules):
    return quality.all_passed(quality.run_suite(df, rules))


SUITE_ROWS = {
    "stocks": ("symbol string, timestamp string, close double, volume long, sector string, industry string",
               ("X1", "2020-02-03", 7.5, 12, "s", "i")),
    "crypto": ("symbol string, timestamp string, close double, volume double", ("Q/USD", "2020-02-03", 0.25, 8.0)),
    "macro": ("series_id string, date string, value double", ("ABC", "2020-02-03", -1.0)),
    "news": ("title string, published_at string, url string", ("words", "2020-02-03", "x://y")),
}


@pytest.mark.parametrize(
    ("table", "spoil"),
    [("stocks", {"drop": ["industry"]}), ("stocks", {"symbol": None}), ("crypto", {"close": 5e-8}),
     ("macro", {"series_id": None}), ("news", {"title": None})],
)
def test_write_suites(spark, table, spoil):
    schema, row = SUITE_ROWS[table]
    df = spark.createDataFrame([row], schema)
    assert passed(df, quality.write_suite(table))
    for name, value in spoil.items():
        df = df.drop(*value) if name == "drop" else df.withColumn(name, F.lit(value).cast(df.schema[name].dataType))
    assert not passed(df, quality.write_suite(table))


def test_nulls_in_thresholds(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    report = quality.run_suite(df, [quality.min_value("x", 0), quality.at_least("x", 0),
                                    quality.not_null("missing"), quality.unique("x")])
    assert [(r.passed, r.failures) for r in report.orderBy("position").collect()] == [
        (True, 0), (False, 1), (False, None), (True, 0),
    ]


def test_a_raising_rule_is_a_failed_row(spark):
    df = spark.createDataFrame([("7",), ("x",)], "x string")
    broken = quality.Rule("number", "row", ("x",), F.col("x").cast("int") < 0)
    report = quality.run_suite(df, [quality.not_null("x"), broken, quality.unique("x")])
    assert [(r.rule, r.passed, r.failures) for r in report.orderBy("position").collect()] == [
        ("not_null(x)", True, 0), ("number", False, None), ("unique(x)", True, 0)]


def test_missing_optional_layer_table(spark):
    df = spark.createDataFrame([("s", dt.date(2020, 1, 1), 1.0)], "series_id string, date date, value double")
    report = quality.run_layers({("silver", "news"): None, ("silver", "macro"): df,
                                 ("silver", "crypto"): None})
    rows = {r.table: r.passed for r in report.filter("rule = 'table exists'").collect()}
    assert rows == {"news": True, "crypto": False}


# silver, landing, lake ------------------------------------------------------


def test_two_bars_of_a_day_stay_unless_asked(spark):
    rows = [("A", "2024-01-01T05:00:00Z", 1.0, "x"), ("A", "2024-01-01T06:00:00Z", 2.0, "x"),
            ("A", "2024-01-01T06:00:00Z", 2.0, "x"), ("B", "2024-01-01T05:00:00Z", None, "x")]
    df = spark.createDataFrame(rows, "symbol string, timestamp string, close double, ingestion_timestamp string")
    assert silver.silver_stocks(df).count() == 2
    daily = silver.silver_stocks(df, daily_unique=True).collect()
    assert [r.close for r in daily] == [2.0] and daily[0].sector == "Unknown"


def test_keep_first_limits_before_the_shuffle(spark):
    out = keep_first(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], ["id"])
    assert sorted(r.id for r in out.collect()) == [0, 1, 2]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_landing_files(spark, tmp_path):
    bars = {"Symbol": "BTC/USD", "timestamp": "2024-01-01 05:00:00+00:00", "open": 1, "high": 2,
            "low": 1, "close": 2, "volume": 3, "trade_count": 1, "vwap": 1.5}
    (tmp_path / "bars.json").write_text("\n".join(json.dumps({**bars, "Symbol": s})
                                                  for s in ("BTC/USD", "XYZ/USD")))
    raw = landing.read_json(spark, str(tmp_path / "bars.json"), schemas.BAR_PAYLOAD.replace("symbol", "Symbol"))
    out = landing.crypto_bars(raw).collect()
    assert [(r.symbol, r.asset_class, r.data_source) for r in out] == [("BTC/USD", "crypto", "alpaca")]
    assert out[0].ingestion_timestamp.endswith("+00:00")
    macro = {"series_id": "DGS2", "observations": [{"date": "2024-01-01", "value": "."},
                                                   {"date": "2024-01-02", "value": "4.25"}]}
    (tmp_path / "macro.json").write_text(json.dumps(macro))
    raw = landing.read_json(spark, str(tmp_path / "macro.json"), schemas.OBSERVATION_PAYLOAD)
    rows = landing.macro_observations(raw).collect()
    assert [(r.date, r.value, r.series_name) for r in rows] == [("2024-01-02", 4.25, "2-Year Treasury Yield")]


def test_lake_round_trip(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(MissingTable):
        lake.read("stocks", "silver")
    assert lake.read("news", "silver").count() == 0
    df = spark.createDataFrame([("A", 1.0)], "symbol string, x double")
    lake.write(df, "t", "gold")
    lake.write(df, "t", "gold", mode="append")
    assert lake.read("t", "gold", essential=True).count() == 2
    lake.write(df.withColumn("y", F.lit(1)), "t", "gold")
    assert lake.read("t", "gold", essential=True).columns == ["symbol", "x", "y"]
    lake.write(df, "t", "gold", mode="ignore")
    with pytest.raises(Exception, match="already exists"):
        lake.write(df, "t", "gold", mode="error")
    assert lake.discover("demo_") == ["demo_t"]
    assert [tuple(r) for r in lake.tables("demo_").collect()] == [("demo_t", 3)]
    assert lake.load_table("demo_t").count() == 1
    spark.sql("DROP TABLE demo_t")


def test_discovered_partitions(spark, tmp_path):
    """Partitions and columns that come later are found in place; other changes enter the table anew."""
    lake = Lake(spark, str(tmp_path / "it's"))
    rows = spark.range(40).select((F.col("id") % 4).cast("int").alias("day"), "id")
    table = lambda: spark.table("found_t")
    lake.write(rows.filter("day < 2"), "t", "gold", partition_by=["day"])
    assert lake.discover("found_") == ["found_t"] and table().count() == 20
    lake.write(rows.filter("day >= 2").withColumn("x", F.lit(1.5)), "t", "gold", mode="append", partition_by=["day"])
    lake.discover("found_")
    assert table().columns == ["id", "x", "day"] and table().count() == 40 and table().filter("x is null").count() == 20
    assert lake.load_table("found_t").filter("day = 3").count() == 10
    lake.write(rows.filter("day = 1"), "t", "gold", partition_by=["day"])  # three partitions and a column fewer
    lake.discover("found_")
    assert table().columns == ["id", "day"] and table().count() == 10
    lake.write(rows, "t", "gold")  # no partitions any more
    lake.discover("found_")
    assert table().count() == 40
    lake.write(rows.filter("false"), "u", "gold", partition_by=["day"])  # a folder without files
    assert lake.discover("found_") == ["found_t"]
    spark.sql("DROP TABLE found_t")


def test_checks_are_counted_during_the_write(spark, tmp_path):
    """The table is not read again but for uniqueness; the report is that of the suite."""
    rows = spark.createDataFrame([("A", 1.0), ("A", None), (None, -1.0), ("B", 3.0)], "symbol string, close double")
    rules = [quality.not_null("symbol"), quality.min_value("close", 0), quality.has_columns("x"), quality.not_null("x"), quality.min_rows(9),
             quality.min_columns(2), quality.null_share_below("close", 0.5), quality.between("y", 0, 1, optional=True)]
    lake = Lake(spark, str(tmp_path / "lake"))

    def unread():
        raise AssertionError("read again")

    report = quality.write_checked(rows, rules, lambda df: lake.write(df, "t", "gold"), unread)
    key = lambda r: sorted(map(tuple, r.select("position", "rule", "passed", "failures").collect()))
    assert key(report) == key(quality.run_suite(rows, rules))
    back = lambda: lake.read("t", "gold", essential=True)
    assert back().count() == 4
    more = [*rules, quality.unique("symbol")]
    report = quality.write_checked(rows, more, lambda df: lake.write(df, "t", "gold"), back)
    assert key(report) == key(quality.run_suite(rows, more))
    # a rule that raises is a failed row, and the table is there all the same
    text_rows = rows.withColumn("close", F.lit("n/a"))
    more = [quality.not_null("symbol"), quality.min_value("close", 0)]
    report = quality.write_checked(text_rows, more, lambda df: lake.write(df, "t", "gold"), back)
    assert key(report) == [(0, "not_null(symbol)", False, 1), (1, "min_value(close >= 0)", False, None)] and back().count() == 4


def test_environment_paths(spark, monkeypatch):
    monkeypatch.delenv("LOCAL_DEV", raising=False)
    monkeypatch.delenv("S3_BUCKET", raising=False)
    with pytest.raises(ValueError, match="S3_BUCKET"):
        Lake.from_environment(spark)
    monkeypatch.setenv("LOCAL_DEV", "true")
    assert Lake.from_environment(spark).path("stocks", "silver") == "data/silver/stocks"


def test_whole_lake(spark, tmp_path):
    """Bronze to gold, checks and marts on stored tables."""
    lake = Lake(spark, str(tmp_path / "lake"))
    days = pd.date_range("2024-01-01", periods=40)
    bars = [(s, f"{d.date()}T05:00:00Z", 1.0, 3.0, 1.0, 2.0 + i % 5, 10.0, 1.0, 2.0, "2024-03-01T00:00:00Z", "alpaca", "x")
            for s in ("AAPL", "MSFT") for i, d in enumerate(days)]
    lake.write(spark.createDataFrame(bars, schemas.TABLES[("bronze", "stocks")]), "stocks", "bronze")
    coins = [("BTC/USD", *b[1:]) for b in bars[:40]]
    lake.write(spark.createDataFrame(coins, schemas.TABLES[("bronze", "crypto")]), "crypto", "bronze")
    series = [(str(d.date()), float(i), s, s, "2024-03-01T00:00:00Z", "fred") for i, d in enumerate(days[::7])
              for s in ("DGS10", "DGS2")]
    lake.write(spark.createDataFrame(series, schemas.TABLES[("bronze", "macro")]), "macro", "bronze")
    story = [("Apple growth", "up", "u1", "s", "2024-01-05T10:00:00Z", "AAPL", "AAPL", "2024-03-01T00:00:00Z", "n")]
    lake.write(spark.createDataFrame(story, schemas.TABLES[("bronze", "news")]), "news", "bronze")
    report = silver.build_silver(spark, lake)
    assert quality.all_passed(report)
    gold.build_gold(spark, lake)
    out = lake.read("features", "gold", essential=True)
    assert out.columns[:4] == ["symbol", "date", "close", "asset_class"]
    assert out.count() == 120 and len(out.columns) >= 40
    row = out.filter("symbol = 'AAPL' and date = '2024-01-05'").first()
    assert row.sentiment_net == 1.0 and row.DGS10 == 0.0 and row.yield_curve_slope == 0.0
    assert row.sector == "Technology"
    assert out.filter("asset_class = 'crypto' and sector is not null").count() == 0
    names = marts.build_marts(spark, lake)
    assert spark.table("mart_features").count() == 120
    assert spark.table("mart_sector_perf").filter("sector = 'Crypto'").count() == 40
    with pytest.raises(warehouse.TargetTaken, match="default"):
        warehouse.sync(spark, lake, "default")
    assert warehouse.sync(spark, lake, "loaded") == ["mart_features"]
    assert warehouse.sync(spark, lake, "loaded") == ["mart_features"]  # replaced by its like
    assert spark.table("loaded.mart_features").count() == 93 and spark.table("mart_features").count() == 120
    with pytest.raises(warehouse.TargetTaken, match="other columns"):
        warehouse.load_table(spark.table("mart_sector_perf"), "loaded.mart_features")
    with pytest.raises(ValueError, match="managed"):
        lake.write(spark.range(1), "mart_sector_perf", "gold")
        lake.discover("")
    assert spark.table("mart_sector_perf").count() > 1
    spark.sql("DROP DATABASE loaded CASCADE")
    for name in reversed(names):
        kind = "TABLE" if name.startswith("mart") else "VIEW"
        spark.sql(f"DROP {kind} IF EXISTS {name}")


def test_warehouse_statement(spark):
    df = spark.createDataFrame([], "a long, b double, c boolean, d string, e timestamp, f date")
    assert warehouse.create_statement(df.schema, "t", keep=True) == (
        "CREATE TABLE IF NOT EXISTS t (a BIGINT, b FLOAT8, c BOOLEAN, d VARCHAR(512), "
        "e TIMESTAMP, f VARCHAR(512))"
    )


# macro ----------------------------------------------------------------------


def test_macro_slope_and_duplicates(spark):
    rows = [("2026-06-01", "DGS10", 4.2), ("2026-06-01", "DGS2", 4.0), ("2026-06-02", "DGS10", 4.3),
            ("2026-06-02", "DGS2", 4.1)]
    df = spark.createDataFrame(rows, "date string, series_id string, value double")
    df = df.withColumn("date", F.col("date").cast("date"))
    out = macro_features(df).orderBy("date").collect()
    assert [r.yield_curve_slope for r in out] == [pytest.approx(0.2)] * 2
    with pytest.raises(Exception, match="two values"):
        pivot_series(df.unionByName(df), ["DGS10"]).collect()
    with pytest.warns(UserWarning, match="DGS2"):
        assert macro_features(df, ["DGS10"]).first().yield_curve_slope is None
    assert macro_features(df.replace("DGS2", "OTHER"), None).columns == ["date", "DGS10", "OTHER", "yield_curve_slope"]


def test_daily_macro_has_no_grid(spark):
    day = lambda *d: spark.createDataFrame([(dt.date(2024, 1, x),) for x in d], "date date")
    rows = [(dt.date(2024, 1, d), s, v) for d, s, v in ((1, "GDP", 1.0), (2, "GDP", 2.0), (3, "DGS10", 4.0), (3, "DGS2", 3.0))]
    macro = spark.createDataFrame(rows, "date date, series_id string, value double")
    out = macro_daily(day(1, 3, 4, 4), macro)
    assert [(r.date.day, r.gdp, r.yield_curve_slope) for r in out.orderBy("date").collect()] == [
        (1, 1.0, None), (3, 1.0, 1.0), (4, 1.0, 1.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_as_of(spark):
    left = pd.DataFrame({"date": pd.to_datetime(["2024-01-01", "2024-01-05", "2024-01-09", "2024-03-01"])})
    right = pd.DataFrame({"date": pd.to_datetime(["2024-01-05", "2024-01-08"]), "v": [1.0, 2.0]})
    want = pd.merge_asof(left, right, on="date").v.tolist()
    frames = [spark.createDataFrame(f).withColumn("date", F.to_date("date")) for f in (left, right)]
    got = [r.v for r in as_of_join(*frames).orderBy("date").collect()]
    assert got == [None if np.isnan(x) else x for x in want]
    nothing = as_of_join(frames[0], frames[1].limit(0))
    assert [r.v for r in nothing.collect()] == [None] * 4


# splits, quantiles, metrics, models ------------------------------------------


def grid(spark, days=30, symbols=13):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(d), f"s{i:02d}") for d in range(days)
            for i in range(symbols - d % 3)]
    return spark.createDataFrame(rows, "date date, symbol string"), sorted(rows)


def test_split_and_folds(spark):
    df, rows = grid(spark)
    n = len(rows)
    got = chronological_split(df).orderBy("date", "symbol").collect()
    a, b = int(n * 0.70), int(n * 0.70) + int(n * 0.15)
    assert [r.split for r in got] == ["train"] * a + ["val"] * (b - a) + ["test"] * (n - b)
    size = n // 6
    for k, (train, test) in enumerate(walk_forward(df, 5)):
        start = n - size * (5 - k)
        assert [tuple(r) for r in df.filter(train).orderBy("date", "symbol").collect()] == rows[:start]
        assert [tuple(r) for r in df.filter(test).orderBy("date", "symbol").collect()] == rows[start : start + size]


def test_quantiles_beyond_the_small_limit(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"a": rng.normal(size=5000), "b": np.where(rng.random(5000) < 0.6, 0.0, rng.random(5000)),
                          "c": rng.integers(0, 4, 5000).astype(float)})
    df = spark.createDataFrame(frame).repartition(5)
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], (0.01, 0.5, 0.99), small_rows=100, accuracy=200)
    for c in frame:
        assert got[c] == pytest.approx(frame[c].quantile([0.01, 0.5, 0.99]).tolist(), rel=1e-12)


def scored(spark, n, seed=5):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=n).date, "symbol": "A",
                          "y": rng.normal(size=n).round(1), "p": rng.normal(size=n).round(1)})
    frame["p"] = frame.p + frame.y / 2
    return frame, spark.createDataFrame(frame)


def blocks(spark, spreads, extra=1):
    """Twenty rows per block: the higher half of the predictions earns ``spread`` more."""
    rows, day = [], dt.date(2020, 1, 1)
    for k in range(20 * len(spreads) + extra):
        upper = k % 2
        gain = spreads[k // 20] if k < 20 * len(spreads) else 0.0
        rows.append((day + dt.timedelta(k), "A", 0.5 + gain * upper, upper + k % 20 / 100))
    return spark.createDataFrame(rows, "date date, symbol string, y double, p double")


def test_simulated_sharpe(spark):
    sharpe = lambda *a, **k: metrics.simulated_sharpe(blocks(spark, *a, **k)).first().sharpe
    # mean 2 and deviation 1 of the spreads, 252 / 20 blocks a year
    assert sharpe([1.0, 3.0]) == pytest.approx(2 * (252 / 20) ** 0.5)
    assert sharpe([-3.0, -1.0, -3.0, -1.0]) == pytest.approx(-2 * (252 / 20) ** 0.5)
    assert sharpe([2.0, 2.0, 2.0]) == 0.0  # no deviation
    assert sharpe([], extra=19) == 0.0 and sharpe([], extra=20) is None


def test_rank_correlation(spark):
    frame, df = scored(spark, 300)
    want = np.corrcoef(frame.y.rank(), frame.p.rank())[0, 1]
    assert metrics.information_coefficient(df).first().ic == pytest.approx(want)
    flat = df.withColumn("p", F.lit(1.0))
    assert metrics.information_coefficient(flat).first().ic == 0.0


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=200)
    frame = pd.DataFrame(x, columns=["a", "b", "c"]).assign(t=y)
    model = models.fit_ridge(spark.createDataFrame(frame), ["a", "b", "c"], "t", alpha=7.0)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 7.0 * np.eye(3), xc.T @ yc)
    assert list(model.coefficients) == pytest.approx(want.tolist(), rel=1e-6)


def feature_table(spark, days=60, symbols=12, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for d in range(days):
        for i in range(symbols):
            r, t = rng.normal(0, 0.02, 2)
            rows.append((f"s{i:02d}", dt.date(2024, 1, 1) + dt.timedelta(d), float(rng.random()), float(r),
                         float(abs(rng.normal(0, 0.02))), float(t) if d < days - 5 else None))
    return spark.createDataFrame(
        rows, "symbol string, date date, close double, return_1d double, volatility_20d double, target_5d_return double"
    )


def test_training_chain(spark):
    df = feature_table(spark)
    board = training.train_leaderboard(df, top_n=3, forest=False, rounds=3)
    rows = board.collect()
    assert {r.name for r in rows} == {"Ridge", "GradientBoosted", "LeafwiseBoosted"}
    assert rows[0].sharpe >= rows[1].sharpe >= rows[2].sharpe
    model, best, trials, prepared = training.tuned_ridge(df, trials=2, folds=2)
    assert trials.count() == 2 and 1e-3 <= best["alpha"] <= 100 and prepared.test.count() > 0
    report = training.run_backtest(df, fits=(models.fit_ridge,))
    assert report.count() > 5
    assessed = training.assess_latest(df)
    assert assessed.count() == 12
    assert {r.date for r in assessed.collect()} == {dt.date(2024, 2, 29)}


# backtest, recommendations ----------------------------------------------------


def test_backtest_by_hand(spark):
    """Two assets held long, two short, every fifth day; 10 basis points; the figures by hand."""
    day = lambda d: dt.date(2024, 1, 1) + dt.timedelta(d)
    rows = []
    for d in range(7):
        rank = {"a": 4, "b": 3, "c": 2, "d": 1} if d < 5 else {"a": 1, "b": 3, "c": 2, "d": 4}
        gain = {"a": 0.02, "b": 0.0, "c": None, "d": -0.02}
        names = "abc" if d == 3 else "abcd"  # day 3 has too few assets to trade
        rows += [(day(d), s, float(rank[s]), gain[s]) for s in names]
    df = spark.createDataFrame(rows, "date date, symbol string, predicted_return double, return_1d double")
    rules = backtest.Rules(start=1000.0, cost_bps=10.0, top_n=2, bottom_n=2)
    report = backtest.backtest(df, rules).orderBy("date").collect()
    # days 0 to 4 hold a, b long and c, d short at a half each: 2 % a day, turnover 2 at first;
    # on day 5 a and d change sides: turnover 2, and the book loses 2 % a day
    value, want = 1000.0, []
    for d in range(7):
        if d in (0, 5):
            value *= 1 - 2 * 0.001
        value *= 1 if d == 3 else 1.02 if d < 5 else 0.98
        want.append(value)
    np.testing.assert_allclose([r.portfolio_value for r in report], want, rtol=1e-12)
    np.testing.assert_allclose([r.benchmark_value for r in report], [1000.0] * 7, rtol=1e-12)
    late = backtest.backtest(df, backtest.Rules(start=1000.0, cost_bps=10.0, top_n=2, bottom_n=2, lag_signal=True))
    first = late.orderBy("date").first()  # the first day has no signal of a day before
    assert first.date == day(1) and first.portfolio_value == pytest.approx(1000 * (1 - 2 * 0.001) * 1.02)


def test_statistics_by_hand(spark):
    """Equity 100, 110, 99, 108.9: returns 10 %, -10 %, 10 %."""
    rows = [(dt.date(2024, 1, 1 + k), v, 100.0) for k, v in enumerate((100.0, 110.0, 99.0, 108.9))]
    days = spark.createDataFrame(rows, "date date, portfolio_value double, benchmark_value double")
    s = backtest.statistics(days, 100.0).first()
    spread = (2 * (0.1 - 0.1 / 3) ** 2 + (0.1 + 0.1 / 3) ** 2) / 3
    assert s.sharpe == pytest.approx(0.1 / 3 / spread**0.5 * 252**0.5)
    assert s.max_drawdown == pytest.approx(-0.1) and s.win_rate == pytest.approx(2 / 3)
    assert s.cagr == pytest.approx(1.089 ** (252 / 4) - 1)


def test_picks_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("day_index"), "id")
    out = backtest.ranked_picks(df, [F.col("id").desc()], 3)
    assert sorted(r.id for r in out.collect()) == [994, 995, 996, 997, 998, 999]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_contributions_and_report(spark, tmp_path):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), 0.1, 0.01, 1.0, -2.0, 0.5, 3.0)],
                               "symbol string, date date, predicted_return double, volatility_20d double,"
                               "f double, g double, h double, i double")  # fmt: skip
    out = recommend.with_contributions(df, ["f", "g", "h", "i"], [0.5, 1.0, 0.1, 1.0])
    assessed = recommend.assess(out)
    row = assessed.first()
    assert row.explainability == "Pos: i (+3.0000), f (+0.5000) | Neg: g (-2.0000)"
    assert (row.confidence_score, row.risk_score) == (99.0, "Low")
    recommend.write_report(assessed, str(tmp_path / "report"))
    body = "\n".join(r.value for r in spark.read.text(str(tmp_path / "report")).collect())
    assert body.count("| **A** | 10.00% | 99.0% | Low |") == 2
    names = reference_data.asset_names(spark)
    recs = recommend.recommendations(assessed)
    assert overview.signals(recs, names, True).count() == 2
    assert overview.signals(recs, names, False).count() == 0


def test_last_days(spark):
    df, _ = grid(spark, days=40, symbols=3)
    assert last_days(df, 30).agg(F.min("date")).first()[0] == dt.date(2024, 1, 10)


# ticks -------------------------------------------------------------------------


def tick(symbol, price, stamp):
    return json.dumps({"symbol": symbol, "price": price, "size": 1, "timestamp": stamp, "source": "t"})


def test_tick_stream(spark, tmp_path):
    landing_dir, root = tmp_path / "in", str(tmp_path / "batch=9" / "store")
    landing_dir.mkdir()
    (landing_dir / "1.json").write_text("\n".join([
        tick("AAPL", 10, "2026-07-01T10:00:00"), tick("AAPL", 11, "2026-07-01T10:00:05"),
        tick("AAPL", 20, "2026-07-02T09:00:00"), "{broken", tick(None, 5, "2026-07-01T10:00:00"),
    ]))
    store = TickStore(spark, root)

    def drain():
        query = store.start(file_source(spark, str(landing_dir)), str(tmp_path / "cp"), once=True)
        query.awaitTermination()
        return {(r.symbol, r.date): r.price for r in store.read().collect()}

    assert drain() == {("AAPL", "2026-07-01"): 11.0, ("AAPL", "2026-07-02"): 20.0}
    assert spark.read.text(f"{root}/rejected").count() == 2
    # a later batch wins even with an older event time, and a restart reads only new files
    (landing_dir / "2.json").write_text(tick("AAPL", 12, "2026-07-01T09:00:00"))
    want = {("AAPL", "2026-07-01"): 12.0, ("AAPL", "2026-07-02"): 20.0}
    assert drain() == want
    # a replayed batch changes nothing
    replay = spark.createDataFrame([(tick("AAPL", 12, "2026-07-01T09:00:00"),)], "value string")
    store.write_batch(replay, 1)
    assert {(r.symbol, r.date): r.price for r in store.read().collect()} == want
    store.compact()
    assert {(r.symbol, r.date): r.price for r in store.read().collect()} == want
    (landing_dir / "3.json").write_text(tick("MSFT", 7, "2026-07-01T09:00:00"))
    want = {**want, ("MSFT", "2026-07-01"): 7.0}
    assert drain() == want
    # what a base replaced goes with the next one
    assert store.compact() == 2 and store.compact() == 2
    assert sorted(p.name for p in (tmp_path / "batch=9/store/log").iterdir()) == ["batch=2"]
    assert {(r.symbol, r.date): r.price for r in store.read().collect()} == want
    assert overview.live_ticks(store.read()).first().last_updated == "2026-07-01 09:00:00"


def test_store_in_buckets(spark, tmp_path):
    """Lookups open one bucket; compaction starts by itself and rewrites what the log touched."""
    store = TickStore(spark, str(tmp_path / "store"), buckets=8, compact_after=3)
    lines = lambda *rows: spark.createDataFrame([(tick(*r),) for r in rows], "value string")
    day = "2026-07-01"
    store.write_batch(lines(*[(f"S{i}", i, f"{day}T10:00:00") for i in range(40)]), 0)
    names = lambda p: sorted(x.name for x in (tmp_path / "store" / p).iterdir() if x.name[:1] not in "._")
    assert names("log/batch=0") == [f"bucket={b}" for b in range(8)] and not (tmp_path / "store/base").exists()
    store.write_batch(lines(("S1", 100, f"{day}T09:00:00")), 1)
    store.write_batch(lines(("S1", 101, f"{day}T08:00:00"), ("S1", 102, "2026-07-02T08:00:00")), 2)
    assert names("base") == ["upto=2"]
    store.write_batch(lines(("S2", 200, f"{day}T07:00:00")), 3)
    assert store.compact() == 3
    touched = names("base/upto=3")
    assert len(touched) == 1 and names("base/upto=2") == [f"bucket={b}" for b in range(8)]
    want = {("S1", day): 101.0, ("S1", "2026-07-02"): 102.0, ("S2", day): 200.0} | {(f"S{i}", day): float(i) for i in range(40) if i not in (1, 2)}
    assert {(r.symbol, r.date): r.price for r in store.read().collect()} == want
    found = store.lookup("S2", day)
    assert found.first().price == 200.0 and store.lookup("S2", "1999-01-01").count() == 0
    assert {f.split("/bucket=")[1].split("/")[0] for f in found.inputFiles()} == {touched[0].split("=")[1]}
    store.write_batch(lines(("S2", 201, f"{day}T06:00:00")), 4)
    store.compact()
    assert touched[0] not in names("base/upto=2")  # replaced by the base before the last
    assert store.read().count() == 41 and store.lookup("S2", day).first().price == 201.0
    assert [tuple(r)[:3] for r in store.batches().orderBy("batch_id").collect()] == [(0, 40, 0), (1, 1, 0), (2, 2, 0), (3, 1, 0), (4, 1, 0)]


def test_rejected_lines_and_empty_store(spark, tmp_path):
    store = TickStore(spark, str(tmp_path / "store"))
    assert store.read().count() == store.batches().count() == store.rejected().count() == store.lookup("A", "x").count() == 0
    assert store.compact() == -1
    store.write_batch(spark.createDataFrame([("{broken",), (tick(None, 1, "2026-07-01"),), (None,)], "value string"), 0)
    assert store.read().count() == 0
    assert [tuple(r)[:3] for r in store.batches().collect()] == [(0, 3, 3)] and store.rejected().count() == 3
    with pytest.raises(ValueError, match="one bucket"):
        TickStore(spark, "x", buckets=0)


def test_decode_keeps_bad_rows(spark):
    df = spark.createDataFrame([("nope",), (tick("A", 1, "2026-01-01"),)], "value string")
    assert decode(df).filter("symbol is null").count() == 1


@pytest.mark.parametrize("few", [0, 40, 100_000])
def test_quantiles_of_odd_values(spark, few, monkeypatch):
    """Whatever share of the bits one pass settles: both signs, both zeros, infinities, repeats, NaN last, nulls left out."""
    monkeypatch.setattr(quantiles, "FEW", few)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=300), rng.normal(size=300) * 1e-300, np.full(200, 7.25), [np.inf, -np.inf, 0.0, -0.0] * 3])
    rows = [(float(v), None, float("nan") if k % 2 else 1.0) for k, v in enumerate(x)] + [(None, None, None)] * 9
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], (0.3, 0.5, 0.9), small_rows=100)
    order, places = np.sort(x), [(len(x) - 1) * p for p in (0.3, 0.5, 0.9)]
    want = [order[int(h)] + (order[math.ceil(h)] - order[int(h)]) * (h - int(h)) for h in places]
    assert got["a"] == pytest.approx(want, rel=1e-12, abs=0.0)
    assert got["b"] == [None] * 3 and got["c"][0] == 1.0 and math.isnan(got["c"][2])
