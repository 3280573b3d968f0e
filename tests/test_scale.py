"""What a job stores, shuffles and holds at a time."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark import scale
from tidemark.checks import learning, market, portfolio, views
from tidemark.functions import text
from tidemark.operators import metrics
from tidemark.operators.series import Layout
from tidemark.operators.technical import mart_technicals
from tidemark.plans import training


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_market_pages_store_no_mart(spark, sf, monkeypatch):
    stored = []
    monkeypatch.setattr(portfolio, "freeze", lambda df: stored.append(df.columns) or df)
    for page in (portfolio.snapshot, portfolio.sector_page, portfolio.movers):
        assert page(spark, sf).collect()
    assert all("sma_200" not in columns for columns in stored)


def test_recommendations_read_the_gold_rows_once(spark, sf, monkeypatch):
    """No stored gold table, and the newest day comes from the rows of the model."""
    stored, sliced = [], []
    monkeypatch.setattr(learning, "freeze", lambda df: stored.append(df.columns) or scale.freeze(df))
    newest = training.latest_slice
    monkeypatch.setattr(training, "latest_slice", lambda df: sliced.append(plan(df)) or newest(df))
    rows = learning.model_recommendations(spark, sf).collect()
    assert rows and all("sma_200" not in columns for columns in stored)
    assert sliced and all("Window" not in p for p in sliced)


@pytest.mark.parametrize("piece", [7, 40, 10_000])
def test_ranks_by_intervals(spark, monkeypatch, piece):
    """Ties, one value in most rows, nulls of one model, NaN and -0.0, in many intervals or one."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        y = float(rng.normal()) if i % 3 else 0.0
        p = float(round(rng.normal() + y, 1))
        rows.append((i // 10, f"s{i % 10}", None if i % 17 == 0 else y, -0.0 if p == 0 and i % 2 else p,
                     None if i % 5 == 0 else 0.0 if i % 2 else float(rng.normal()), float("nan") if i % 11 == 0 else y + p, 1.0))
    df = spark.createDataFrame(rows, "date int, symbol string, t double, p double, q double, r double, flat double").repartition(3)
    monkeypatch.setattr(metrics, "RANK_ROWS", piece)
    names = ["p", "q", "r", "flat"]
    found = {r.run_uuid: r for r in metrics.evaluate_all(df, "t", names, top_n=4).collect()}
    for name in names:
        one = metrics.information_coefficient(df, "t", name).first().ic
        assert found[name].ic == pytest.approx(one, rel=1e-9, abs=1e-12), name


def test_board_stores_rows_once(spark, monkeypatch):
    """Only the ordered rows are stored: no table with a row per model and value."""
    stored = []
    keep = scale.freeze
    for module in (scale, metrics):
        monkeypatch.setattr(module, "freeze", lambda df: stored.append(df.columns) or keep(df))
    df = spark.range(100).select(
        F.col("id").alias("date"), F.lit("s").alias("symbol"), F.rand(1).alias("t"), F.rand(2).alias("p"), F.rand(3).alias("q"))
    assert metrics.evaluate_all(df, "t", ["p", "q"], top_n=4).count() == 2
    assert len(stored) == 1 and {"p", "q"} <= set(stored[0])


def test_tasks_of_large_tables_hold_a_bounded_number_of_rows(spark, sf, monkeypatch):
    """More rows make more tasks, whatever few bytes they have; the rows are the same."""
    few = sorted(views.bars(spark, sf).collect())
    monkeypatch.setattr(scale, "TASK_ROWS", 500)
    rows = views.bars(spark, sf)
    assert rows.rdd.getNumPartitions() > 4 and sorted(rows.collect()) == few
    prices = rows.localCheckpoint()
    out = mart_technicals(prices, Layout(hot=False, rows=5_000))
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (\d+)\)", plan(out))
    assert shuffles == [("symbol", "10")]
    by_spark = mart_technicals(prices, Layout(hot=False)).select("symbol", "date", "sma_20")
    assert sorted(out.select("symbol", "date", "sma_20").collect()) == sorted(by_spark.collect())
    twice = market.mart_sector_perf(spark, sf).collect()
    monkeypatch.setattr(scale, "TASK_ROWS", 500_000)
    assert sorted(twice) == sorted(market.mart_sector_perf(spark, sf).collect())


def test_windows_of_texts_hold_cut_texts_only(spark):
    """200 MB of long texts, of which a window of the model keeps a few characters each."""
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 100_000] * 2_000)], ["text"])
    tracemalloc.start()
    seen = sum(len(texts) for _, texts in text._windows(iter([batch]), 0, lambda t: (t[:10], 10)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 2_000 and peak < 20_000_000


def test_scored_rows_keep_their_columns_and_order(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else "w " * i, [i]) for i in range(300)], "k long, body string, l array<int>").coalesce(1)
    scorer = lambda: lambda texts: [{"Positive": float(len(t)), "Negative": float("nan") if t == "w " else 0.0} for t in texts]
    rows = text.with_model_scores(df, scorer, "body").collect()
    assert [r.k for r in rows] == list(range(300)) and rows[9].l == [9]
    assert [r.sentiment_pos for r in rows] == [0.0 if i % 7 == 0 else 2.0 * i for i in range(300)]
    assert rows[1].sentiment_net is None and rows[2].sentiment_neg == 0


def test_gold_steps_are_small_enough_to_be_compiled(spark, sf):
    """The JVM interprets methods of over 8,000 bytes; and no indicator takes the strict power."""
    df = market.gold_features(spark, sf)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        steps = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
        text = plan(df.select("*"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [steps.apply(i)._3().maxMethodCodeSize() for i in range(steps.size())]
    assert sizes and max(sizes) < 8_000
    assert "POWER(" not in text and text.count("Window [") <= 7


def test_wide_tables_are_rounded_like_narrow_ones(spark, monkeypatch):
    nasty = [1.2345675, None, -0.0, float("nan"), -2.5e-7, 1e12, 0.0000005]
    df = spark.createDataFrame([(i, *[None if x is None else x * (k + 1) for k in range(5)]) for i, x in enumerate(nasty)], "id int, a double, b double, c double, d double, e double").drop("id")
    df = df.withColumn("s", F.lit("x"))
    rules = {"a": 2, "c": 4, "d": 2}
    want = [str(r) for r in views.rounded(df, rules).collect()]
    monkeypatch.setattr(views, "WIDE", 3)
    wide = views.rounded(df, rules)
    assert wide.columns == df.columns and [str(r) for r in wide.collect()] == want
