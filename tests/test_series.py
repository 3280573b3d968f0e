"""Series operators against their definitions, in the plain and in the segmented layout."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import series, technical
from tidemark.operators.series import Layout, forward_fill, measure_layout, sequences
from tidemark.operators.technical import INDICATORS, mart_technicals, technical_indicators
from tidemark.scale import global_position, running_total

PLAIN = Layout(False)


def walk(n_rows, symbols=("A", "B"), seed=1):
    rng = np.random.default_rng(seed)
    frames = []
    for i, s in enumerate(symbols):
        n = n_rows if i == 0 else max(n_rows // 7, 1)
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        volume = rng.integers(0, 1000, n).astype(float)
        day = pd.date_range("1950-01-01", periods=n).date
        frames.append(pd.DataFrame({"symbol": s, "timestamp": day, "close": close, "volume": volume,
                                    "sector": "X"}))
    return pd.concat(frames, ignore_index=True)


def smoothed(x, weight):
    """y[0] = x[0], then y[k] = y[k-1] + weight * (x[k] - y[k-1])."""
    y = np.array(x, float)
    for k in range(1, len(y)):
        y[k] = y[k - 1] + weight * (x[k] - y[k - 1])
    return y


def over(x, n, what, least=None):
    """``what`` of each slice of ``n`` entries that ends at a row, once ``least`` of them exist."""
    least = n if least is None else least
    parts = [x[max(0, k + 1 - n) : k + 1] for k in range(len(x))]
    return np.array([what(p) if len(p) >= least and not np.isnan(p).any() else np.nan for p in parts], float)


def deviation(p):
    return np.std(p, ddof=1)


def symbol_indicators(c, v):
    """The indicators of one series from their definitions."""
    tiny, n = 1e-9, len(c)
    step = np.diff(c, prepend=c[:1])
    seed = slice(1, None)  # the first row has no change
    gain, loss = np.full(n, np.nan), np.full(n, np.nan)
    if n > 1:
        gain[seed] = smoothed(np.maximum(step[seed], 0), 1 / 14)
        loss[seed] = smoothed(np.maximum(-step[seed], 0), 1 / 14)
    out = {"rsi_14": 100 - 100 * (loss + tiny) / (loss + tiny + gain)}
    out["macd"] = smoothed(c, 2 / 13) - smoothed(c, 2 / 27)
    out["macd_signal"] = smoothed(out["macd"], 2 / 10)
    out |= {f"sma_{k}": over(c, k, np.mean) for k in (20, 50, 200)}
    change = np.full(n, np.nan)
    change[1:] = c[1:] / c[:-1] - 1
    out["return_1d"] = change
    out["volatility_20d"] = over(change, 20, deviation)
    out["vol_regime_ratio"] = over(change, 5, deviation) / (over(change, 60, deviation) + tiny)
    out["bb_upper"] = over(c, 20, lambda p: np.mean(p) + 2 * deviation(p))
    out["volume_ratio"] = v / (over(v, 20, np.mean) + tiny)
    out["price_position_52w"] = over(c, 252, lambda p: (p[-1] - p.min()) / (p.max() - p.min() + tiny), 20)
    ahead = [np.append(c[k:], np.full(min(k, n), np.nan))[:n] / c - 1 for k in (3, 5, 10)]
    out["target_smooth_return"] = np.mean(ahead, axis=0)
    return out


def plain_indicators(frame):
    parts = [g.assign(**symbol_indicators(g.close.to_numpy(), g.volume.to_numpy()))
             for _, g in frame.sort_values("timestamp").groupby("symbol")]
    return pd.concat(parts)


COLUMNS = ["rsi_14", "macd", "macd_signal", "sma_20", "sma_50", "sma_200", "return_1d",
           "volatility_20d", "vol_regime_ratio", "bb_upper", "volume_ratio", "price_position_52w",
           "target_smooth_return"]


def compare(spark, frame, layout):
    got = technical_indicators(spark.createDataFrame(frame), "timestamp", layout).toPandas()
    got = got.sort_values(["symbol", "timestamp"]).reset_index(drop=True)
    want = plain_indicators(frame).sort_values(["symbol", "timestamp"]).reset_index(drop=True)
    assert len(got) == len(want)
    for c in COLUMNS:
        np.testing.assert_allclose(got[c].astype(float), want[c], rtol=1e-9, atol=1e-9, err_msg=c)


@pytest.mark.parametrize("rows", [1, 2, 20, 21, 253, 700])
def test_indicators_equal_their_definitions(spark, rows):
    compare(spark, walk(rows), None)


def test_indicators_over_several_blocks(spark, monkeypatch):
    """Blocks of 64 rows: carries cross many block borders."""
    monkeypatch.setattr(series, "EWM_BLOCK", 64)
    compare(spark, walk(700), PLAIN)


def test_hot_symbol_is_cut_into_segments(spark):
    """A symbol over the limit gives the same values from bounded segments."""
    frame = walk(9000, ("HOT", "B", "C"))
    assert measure_layout(spark.createDataFrame(frame), max_rows=5000).hot
    compare(spark, frame, Layout(True, segment_rows=4000))


def test_mart_windows_segmented(spark):
    frame = spark.createDataFrame(walk(900).rename(columns={"timestamp": "date"}))
    plain = mart_technicals(frame, PLAIN).orderBy("symbol", "date").toPandas()
    cut = mart_technicals(frame, Layout(True, segment_rows=100)).orderBy("symbol", "date").toPandas()
    pd.testing.assert_frame_equal(plain, cut, rtol=1e-12)


def test_segmented_forward_fill_and_sequences(spark):
    frame = walk(500)
    frame.loc[frame.index % 37 != 5, "volume"] = None
    df = spark.createDataFrame(frame).withColumn("volume", F.nanvl("volume", F.lit(None)))
    args = {"key": "symbol", "order": ["timestamp"]}
    for layout in (PLAIN, Layout(True, segment_rows=30)):
        got = forward_fill(df, ["volume"], layout=layout, **args).toPandas()
        got = got.sort_values(["symbol", "timestamp"])["volume"].to_numpy(dtype=float)
        want = frame.groupby("symbol").volume.ffill().to_numpy(dtype=float)
        np.testing.assert_array_equal(got, want)
        seq = sequences(df, ["close"], "close", 10, layout=layout, **args)
        rows = seq.orderBy("symbol", "timestamp").collect()
        assert len(rows) == (500 - 10) + (71 - 10)
        first = frame.groupby("symbol").close.apply(list)
        assert [x[0] for x in rows[0]["sequence"]] == first["A"][:10]
        assert rows[0]["target"] == first["A"][10]


def test_price_ramp(spark):
    """Ten rising closes: exact returns and targets, nulls where the future is missing."""
    day = pd.date_range("2026-06-01", periods=10).date
    frame = pd.DataFrame({"symbol": "AAPL", "timestamp": day, "close": [100.0 + i for i in range(10)],
                          "volume": 1000.0})
    rows = technical_indicators(spark.createDataFrame(frame)).orderBy("timestamp").collect()
    assert rows[0]["target_1d_return"] == pytest.approx(0.01)
    assert rows[8]["target_1d_return"] == pytest.approx(109 / 108 - 1)
    assert rows[9]["target_1d_return"] is None
    assert rows[0]["target_5d_return"] == pytest.approx(0.05)
    assert all(r["target_5d_return"] is None for r in rows[5:])
    assert rows[1]["return_1d"] == pytest.approx(0.01)
    assert rows[5]["return_5d"] == pytest.approx(0.05)
    assert rows[0]["rsi_14"] is None and rows[1]["rsi_14"] == pytest.approx(100, abs=1e-6)


def test_empty_and_zero_volume(spark):
    empty = spark.createDataFrame([], "symbol string, timestamp date, close double, volume double")
    assert technical_indicators(empty).count() == 0
    frame = walk(30).assign(volume=0.0)
    out = technical_indicators(spark.createDataFrame(frame)).filter("volume_ratio is not null")
    assert {r.volume_ratio for r in out.collect()} == {0.0}


def test_positions_do_not_depend_on_hot_keys(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    rows = global_position(df, ["k", "id"]).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(5000))
    assert [(r.k, r.id) for r in rows] == sorted((r.k, r.id) for r in rows)
    total = running_total(df, ["id"], F.col("id"), "s").orderBy("id").collect()
    assert [r.s for r in total] == list(np.cumsum(range(5000)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_for_all_indicators(spark, tmp_path):
    path = str(tmp_path / "prices")
    spark.createDataFrame(walk(50)).write.parquet(path)
    text = plan(technical_indicators(spark.read.parquet(path), "timestamp"))
    assert text.count("Exchange hashpartitioning(symbol") == 1
    assert text.count("Exchange ") == 1


def test_only_wanted_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "prices")
    spark.createDataFrame(walk(50)).write.parquet(path)
    out = technical_indicators(spark.read.parquet(path), "timestamp").select("symbol", "sma_20")
    schema = plan(out).split("ReadSchema: ")[1]
    assert "volume" not in schema and "sector" not in schema


def test_registered_outputs_cover_the_indicators(spark):
    out = technical_indicators(spark.createDataFrame(walk(5)))
    assert set(INDICATORS) <= set(out.columns)
    assert not [c for c in out.columns if c.startswith("_")]
    assert technical.REACH > 252
