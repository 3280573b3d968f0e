"""Every registered query against its SQL on the smallest tables."""

import math
from functools import partial

import pytest

import __spark_entry__ as entry
from tidemark.checks import learning, registry
from tidemark.checks.compare import compare
from tidemark.operators import backtest, metrics, models
from tidemark.operators.split import chronology
from tidemark.plans import training
from tidemark.scale import freeze

QUERIES, SQL = registry.queries(), registry.oracle_sql()
# fitted trees have no SQL; test_trees.py compares them with plain trees, tests below their use
UNCHECKED = {"m6_random_forest", "m7_m8_boosted_ensemble", "m13_fitted_board", "c13_model_backtest"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in UNCHECKED])
def test_query(spark, sf, name):
    ok, note = compare(spark, name, QUERIES[name], SQL.get(name), sf)
    assert ok, note


def test_every_other_query_has_sql():
    assert set(SQL) == set(QUERIES) - UNCHECKED


@pytest.fixture(scope="module")
def gold(spark, sf):
    return learning.gold_table(spark, sf)


@pytest.fixture(scope="module")
def prepared(gold):
    return models.preprocess(gold[0], layout=gold[1])


@pytest.fixture
def few_trees(monkeypatch):
    """The queries with few trees: test_trees.py compares trees, and each one costs a pass per level."""
    monkeypatch.setattr(models, "fit_boosted", partial(models.fit_boosted, rounds=5))
    monkeypatch.setattr(models, "fit_forest", partial(models.fit_forest, count=10))


def values(df, column="predicted_return"):
    return {(r.symbol, r.date): r[column] for r in df.collect()}


def test_forest_query(spark, sf, prepared, few_trees):
    """The held-out rows, each with a mean of leaf means of the training rows."""
    got = values(QUERIES["m6_random_forest"](spark, sf))
    low, high = prepared.train.selectExpr(f"min({models.TARGET})", f"max({models.TARGET})").first()
    assert got.keys() == values(prepared.test, models.TARGET).keys()
    assert all(low - 1e-6 <= p <= high + 1e-6 for p in got.values()) and len(set(got.values())) > len(got) / 10


def test_ensemble_is_half_ridge_half_trees(spark, sf, prepared, few_trees):
    out = freeze(QUERIES["m7_m8_boosted_ensemble"](spark, sf))
    train = freeze(prepared.train)
    cut = chronology(train, lambda n: [int(n * 0.85)]).cuts[0]
    line = values(models.score(models.fit_ridge(train.filter(cut.before()), prepared.features), prepared.test, prepared.features))
    level, both = values(out, "by_level"), values(out)
    assert all(both[k] == pytest.approx((line[k] + level[k]) / 2, rel=1e-9) for k in line) and both.keys() == line.keys()
    assert values(out, "by_leaf") != level


def test_board_of_fitted_models(spark, sf, prepared, few_trees):
    """All models are there, best first; the ridge's row equals its own fit scored by itself."""
    rows = QUERIES["m13_fitted_board"](spark, sf).collect()
    assert {r.name for r in rows} == {"Ridge", "RandomForest", "GradientBoosted", "LeafwiseBoosted"}
    assert [r.sharpe for r in rows] == sorted((r.sharpe for r in rows), reverse=True)
    train = freeze(prepared.train)
    cut = chronology(train, lambda n: [int(n * 0.85)]).cuts[0]
    model = training.board_fits(train, prepared.features, forest=False, boosted=False)["Ridge"]
    late = models.score(model, train.filter(~cut.before()), prepared.features, "p")
    one = metrics.evaluate(freeze(late), models.TARGET, "p").first()
    ridge = next(r for r in rows if r.name == "Ridge")
    assert [ridge[c] for c in metrics.METRICS] == pytest.approx([one[c] for c in metrics.METRICS], rel=1e-6)


def test_model_backtest(spark, sf, gold, few_trees):
    """A curve over every day of the held-out rows; predictions are the mean of the fits given."""
    rows = QUERIES["c13_model_backtest"](spark, sf).orderBy("date").collect()
    few = models.fit_boosted
    parts = [freeze(training.out_of_sample(gold[0], layout=gold[1], fits=fits)) for fits in ((models.fit_ridge,), (few,), (models.fit_ridge, few))]
    line, trees, both = map(values, parts)
    assert all(both[k] == pytest.approx((line[k] + trees[k]) / 2, rel=1e-9, abs=1e-12) for k in both)
    assert [r.date for r in rows] == sorted({k[1] for k in both}) and all(math.isfinite(r.portfolio_value) for r in rows)
    assert backtest.backtest(parts[2]).count() == len(rows)


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["sector", "date", "avg_return_1d", "avg_volatility_20d", "total_volume",
                           "active_assets"]
    assert out.count() > 0
