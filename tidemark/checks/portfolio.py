"""Registered queries: splits, metrics, backtest, recommendations, pages, ticks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.checks import views
from tidemark.checks.market import FRAGMENT_SQL, _full_windows, mart_from
from tidemark.checks.views import rnd, rounded, rounded_col, sql
from tidemark.functions.scalars import inferred_asset_class
from tidemark.operators import backtest as bt
from tidemark.operators import metrics, recommend
from tidemark.operators.split import chronological_split, walk_forward
from tidemark.operators.technical import technical_indicators
from tidemark.plans import overview
from tidemark.scale import ensure_checkpoint_dir, freeze
from tidemark.sources.reference_data import pairs
from tidemark.streaming import ticks

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name, statement=None):
    def add(function):
        QUERIES[name] = function
        if statement:
            SQL[name] = statement
        return function

    return add


INPUTS = ["close", "volume", "sma_20", "return_1d", "return_20d", "volatility_20d"]
KEEP = ["symbol", "date", "target_5d_return", *INPUTS]


def feature_rows(spark, sf):
    """Labelled feature rows for one pass."""
    layout = views.price_layout(spark, sf)
    return technical_indicators(views.bars(spark, sf), "date", layout).select(*KEEP), layout


def features(spark, sf):
    """The same, kept for the several passes of the operators below."""
    rows, layout = feature_rows(spark, sf)
    return freeze(rows), layout


FEATURES_SQL = _full_windows(
    ", feat AS (SELECT symbol, date, target_5d_return, close, volume, sma_20, return_1d, return_20d,"
    " volatility_20d FROM g)"
)

# ---------------------------------------------------------------------------
# splits
# ---------------------------------------------------------------------------


@register(
    "m2_chronological_split",
    sql(""", p AS (SELECT symbol, date, row_number() OVER (ORDER BY date, symbol) - 1 AS i,
            count(*) OVER () AS n FROM bars)
        SELECT symbol, date, CASE WHEN i < floor(n * 0.70) THEN 'train'
            WHEN i < floor(n * 0.70) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split FROM p""",
        "bars"),
)
def split_rows(spark, sf):
    return chronological_split(views.bars(spark, sf).select("symbol", "date"))


@register(
    "m3_walk_forward",
    sql(""", p AS (SELECT symbol, date, row_number() OVER (ORDER BY date, symbol) - 1 AS i,
            count(*) OVER () AS n FROM bars),
        f AS (SELECT unnest([0, 1, 2, 3, 4]) AS fold)
        SELECT CAST(fold AS INTEGER) AS fold, symbol, date,
            CASE WHEN i < n - (n // 6) * (5 - fold) THEN 'train' ELSE 'test' END AS role
        FROM p CROSS JOIN f WHERE i < n - (n // 6) * (4 - fold)""", "bars"),
)
def folds(spark, sf):
    rows = views.bars(spark, sf).select("symbol", "date")
    out = None
    for k, (train, test) in enumerate(walk_forward(rows, 5)):
        role = F.when(train, "train").when(test, "test")
        part = rows.withColumns({"fold": F.lit(k), "role": role}).filter(F.col("role").isNotNull())
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------------------
# metrics
# ---------------------------------------------------------------------------


def predictions(spark, sf, rows=features):
    """Model-free predictions: the return of the last 20 rows."""
    return rows(spark, sf)[0].filter(F.col("target_5d_return").isNotNull() & F.col("return_20d").isNotNull())


def _metric_sql(p: str) -> str:
    return f"""
    (WITH y AS (SELECT date, symbol, target_5d_return AS y, {p} AS p FROM lp),
     rk AS (SELECT y, p, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry,
                   rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rp FROM y),
     pos AS (SELECT y, p, row_number() OVER (ORDER BY date, symbol) - 1 AS i, count(*) OVER () AS n FROM y),
     ch AS (SELECT y, i // 20 AS run, row_number() OVER (PARTITION BY i // 20 ORDER BY p, i) AS k
            FROM pos WHERE (i // 20) * 20 < n - 20),
     pnl AS (SELECT run, avg(CASE WHEN k > 10 THEN y END) - avg(CASE WHEN k <= 10 THEN y END) AS d
             FROM ch GROUP BY run)
     SELECT (SELECT sqrt(avg((y - p) ** 2)) FROM y) AS rmse,
            (SELECT avg(CASE WHEN sign(y) = sign(p) THEN 1.0 ELSE 0.0 END) FROM y) AS dir_acc,
            (SELECT corr(ry, rp) FROM rk) AS ic,
            (SELECT avg(d) / stddev_pop(d) * sqrt(252 / 20.0) FROM pnl) AS sharpe)"""


_LP = ", lp AS (SELECT * FROM feat WHERE target_5d_return IS NOT NULL AND return_20d IS NOT NULL) "


@register(
    "m9_m12_evaluate",
    sql(FEATURES_SQL + _LP + "SELECT " + ", ".join(f"{rnd(c)} AS {c}" for c in metrics.METRICS)
        + f" FROM {_metric_sql('return_20d')}", "prices"),
)
def evaluated(spark, sf):
    return rounded(metrics.evaluate(predictions(spark, sf), "target_5d_return", "return_20d"), 6)


@register(
    "m11_rank_correlation_ties",
    f"""WITH r AS (SELECT rank() OVER (ORDER BY quality)
            + (count(*) OVER (PARTITION BY quality) - 1) / 2.0 AS a, rank() OVER (ORDER BY toxic)
            + (count(*) OVER (PARTITION BY toxic) - 1) / 2.0 AS b FROM labels)
        SELECT {rnd("coalesce(corr(a, b), 0)")} AS ic FROM r""",
)
def tied_ranks(spark, sf):
    out = metrics.information_coefficient(views.table(spark, sf, "labels"), "quality", "toxic")
    return rounded(out, 6)


RUNS = ("return_1d", "return_20d", "volatility_20d")


@register(
    "m13_a13_leaderboard",
    sql(FEATURES_SQL + _LP + " UNION ALL ".join(
        f"SELECT '{p}' AS run_uuid, '{p}' AS name, "
        + ", ".join(f"{rnd(c)} AS {c}" for c in metrics.METRICS) + f" FROM {_metric_sql(p)}"
        for p in RUNS), "prices"),
)
def board(spark, sf):
    found = freeze(metrics.evaluate_all(predictions(spark, sf, feature_rows), "target_5d_return", RUNS))
    runs = found.select("run_uuid", F.col("run_uuid").alias("name"))
    return rounded(metrics.leaderboard(runs, metrics.as_entries(found)), 6)


# ---------------------------------------------------------------------------
# backtest
# ---------------------------------------------------------------------------

_DAYS = """
    , dy AS (SELECT date, count(*) AS n, avg(coalesce(return_1d, 0)) AS bench FROM pr GROUP BY date)
    , c1 AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS idx, n >= 10 AS tradable FROM dy)
    , c2 AS (SELECT *, tradable AND idx % 5 = 0 AS reb FROM c1)
    , cal AS (SELECT *, last_value(CASE WHEN reb THEN idx END IGNORE NULLS) OVER (ORDER BY date
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS active FROM c2)
    , rk AS (SELECT cal.idx, pr.symbol,
              row_number() OVER (PARTITION BY pr.date ORDER BY predicted_return, symbol) AS up,
              row_number() OVER (PARTITION BY pr.date ORDER BY predicted_return DESC, symbol DESC) AS dn
             FROM pr JOIN cal ON pr.date = cal.date WHERE cal.reb)
    , wt AS (SELECT idx, symbol, CASE WHEN dn <= 5 THEN 0.2 ELSE -0.2 END AS w FROM rk
             WHERE dn <= 5 OR up <= 5)
    , steps AS (SELECT idx, lead(idx) OVER (ORDER BY idx) AS nxt FROM cal WHERE reb)
    , olds AS (SELECT s.nxt AS idx, wt.symbol, wt.w FROM wt JOIN steps s ON wt.idx = s.idx
               WHERE s.nxt IS NOT NULL)
    , turn AS (SELECT coalesce(a.idx, b.idx) AS idx,
                      sum(abs(coalesce(a.w, 0) - coalesce(b.w, 0))) AS turnover
               FROM wt a FULL OUTER JOIN olds b ON a.idx = b.idx AND a.symbol = b.symbol
               GROUP BY 1)
    , gain AS (SELECT cal.date, sum(wt.w * coalesce(pr.return_1d, 0)) AS r
               FROM cal JOIN wt ON wt.idx = cal.active
               JOIN pr ON pr.date = cal.date AND pr.symbol = wt.symbol
               WHERE cal.tradable GROUP BY cal.date)
    , fac AS (SELECT cal.*, turnover, r,
                CASE WHEN tradable THEN (1 - coalesce(turnover, 0) * 0.0005) * (1 + coalesce(r, 0))
                     ELSE 1 END AS f,
                CASE WHEN tradable THEN 1 + bench ELSE 1 END AS g
              FROM cal LEFT JOIN turn ON turn.idx = cal.idx LEFT JOIN gain ON gain.date = cal.date)
    , days AS (SELECT *, 100000 * product(f) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING
                 AND CURRENT ROW) AS portfolio_value,
               100000 * product(g) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING
                 AND CURRENT ROW) AS benchmark_value FROM fac)
"""



def backtest_sql(signal: str = "return_20d", gain: str = "return_1d", source: str = "feat") -> str:
    """The days of a backtest that trades on ``signal`` and earns ``gain``."""
    return f"""
    , pr AS (SELECT date, symbol, {signal} AS predicted_return, {gain} AS return_1d FROM {source}
             WHERE {signal} IS NOT NULL)
    """ + _DAYS


_BT = backtest_sql()


def backtest_input(spark, sf):
    rows, _ = features(spark, sf)
    return rows.filter(F.col("return_20d").isNotNull()).select(
        "date", "symbol", F.col("return_20d").alias("predicted_return"), "return_1d"
    )


@register(
    "b1_b7_backtest_days",
    sql(FEATURES_SQL + _BT + f"""SELECT date, CAST(idx AS INTEGER) AS day_index, tradable,
        reb AS rebalance, CAST(active AS INTEGER) AS active, {rnd("turnover")} AS turnover,
        {rnd("r")} AS strategy_return, {rnd("bench")} AS benchmark_return FROM days""", "prices"),
)
def backtest_days(spark, sf):
    out = bt.backtest_days(backtest_input(spark, sf))
    return rounded(out.select(
        "date", "day_index", "tradable", "rebalance", "active", "turnover", "strategy_return",
        "benchmark_return"), 6)


_LAGGED = """
    , late AS (SELECT date, symbol, return_1d, lag(return_20d) OVER (PARTITION BY symbol ORDER BY date) AS signal
               FROM feat WHERE return_20d IS NOT NULL)
""" + backtest_sql("signal", source="late")


@register(
    "b_lag_signal",
    sql(FEATURES_SQL + _LAGGED + f"""SELECT date, {rnd("turnover")} AS turnover, {rnd("r")} AS strategy_return
        FROM days""", "prices"),
)
def lagged_backtest(spark, sf):
    out = bt.backtest_days(backtest_input(spark, sf), bt.Rules(lag_signal=True))
    return rounded(out.select("date", "turnover", "strategy_return"), 6)


@register(
    "b3_weights",
    sql(FEATURES_SQL + _BT + "SELECT CAST(idx AS INTEGER) AS day_index, symbol,"
        " CAST(w AS DOUBLE) AS weight FROM wt", "prices"),
)
def weights(spark, sf):
    rows = backtest_input(spark, sf)
    return bt.target_weights(rows, freeze(bt.trading_calendar(rows)))


# the given prices are no market, so returns are made small enough for curves to stay finite
def calm_report(spark, sf):
    rows = backtest_input(spark, sf).withColumn("return_1d", F.col("return_1d") / 1000)
    return freeze(bt.backtest(rows))


_CALM = backtest_sql(gain="return_1d / 1000")
_STATS = """
    , e AS (SELECT date, portfolio_value AS v, benchmark_value AS b,
              CASE WHEN row_number() OVER (ORDER BY date) > 1 THEN f - 1 END AS r,
              max(portfolio_value) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                AS peak FROM days)
"""


@register(
    "b8_b15_equity_curve",
    sql(FEATURES_SQL + _CALM + f"""SELECT date, {rnd("ln(portfolio_value)")} AS portfolio,
        {rnd("ln(benchmark_value)")} AS benchmark FROM days""", "prices"),
)
def curve(spark, sf):
    out = calm_report(spark, sf)
    return rounded(out.select(
        "date", F.log("portfolio_value").alias("portfolio"),
        F.log("benchmark_value").alias("benchmark")), 6)


@register(
    "b9_b14_statistics",
    sql(FEATURES_SQL + _CALM + _STATS + f"""SELECT
        {rnd("arg_max(v, date)", 3)} AS final_value, {rnd("arg_max(b, date)", 3)} AS final_benchmark,
        {rnd("(arg_max(v, date) / 100000) ** (252.0 / count(*)) - 1")} AS cagr,
        {rnd("(arg_max(b, date) / 100000) ** (252.0 / count(*)) - 1")} AS benchmark_cagr,
        {rnd("avg(r) / CASE WHEN stddev_pop(r) > 0 THEN stddev_pop(r) ELSE 1e-8 END * sqrt(252)")}
            AS sharpe,
        {rnd("avg(r) / CASE WHEN count(*) FILTER (WHERE r < 0) > 0 THEN"
             " stddev_pop(CASE WHEN r < 0 THEN r END) ELSE 1e-8 END * sqrt(252)")} AS sortino,
        {rnd("min((v - peak) / peak)")} AS max_drawdown,
        {rnd("avg(CASE WHEN r > 0 THEN 1.0 WHEN r IS NOT NULL THEN 0.0 END)")} AS win_rate FROM e""",
        "prices"),
)
def statistics(spark, sf):
    out = bt.statistics(calm_report(spark, sf))
    return rounded(out, {"final_value": 3, "final_benchmark": 3})


@register(
    "p24_total_returns",
    sql(FEATURES_SQL + _CALM + f"""SELECT
        {rnd("arg_max(portfolio_value, date) / 1000 - 100")} AS strategy_return_pct,
        {rnd("arg_max(benchmark_value, date) / 1000 - 100")} AS benchmark_return_pct,
        {rnd("(arg_max(portfolio_value, date) - arg_max(benchmark_value, date)) / 1000")} AS excess_pct
        FROM days""", "prices"),
)
def totals(spark, sf):
    return rounded(bt.total_returns(calm_report(spark, sf)), 6)


# ---------------------------------------------------------------------------
# recommendations and pages
# ---------------------------------------------------------------------------

CONTRIBUTING = {"return_1d": 0.37, "return_20d": -0.21, "volatility_20d": 0.113}

_LATEST = """
    , latest AS (SELECT *, return_20d AS predicted, volatility_20d AS vol FROM feat WHERE date = (SELECT max(date) FROM feat))
"""
_CONTRIB = "[" + ", ".join(
    f"{{'v': {c} * CAST({w} AS DOUBLE), 'i': {i}, 'n': '{c}'}}"
    for i, (c, w) in enumerate(CONTRIBUTING.items())
) + "]"


def assessed_sql(contributions: str) -> str:
    """ass: the assets of ``latest`` (symbol, date, predicted, vol) with confidence, risk and the strongest inputs."""
    return f"""
    , top AS (SELECT max(abs(predicted)) AS m FROM latest)
    , con AS (SELECT symbol, unnest({contributions}) AS s FROM latest)
    , con2 AS (SELECT symbol, s.v AS v, s.n AS n,
        row_number() OVER (PARTITION BY symbol, sign(s.v) ORDER BY abs(s.v) DESC) AS k FROM con)
    , txt AS (SELECT symbol,
        'Pos: ' || coalesce(string_agg(CASE WHEN v > 0 AND k <= 2 THEN n || printf(' (+%.4f)', v) END,
            ', ' ORDER BY k), '') || ' | Neg: ' ||
        coalesce(string_agg(CASE WHEN v < 0 AND k <= 2 THEN n || printf(' (%.4f)', v) END,
            ', ' ORDER BY k), '') AS explainability FROM con2 GROUP BY symbol)
    , ass AS (SELECT l.symbol, date, predicted, vol,
        CASE WHEN top.m <= 0 THEN 50.0 ELSE greatest(10.0, least(99.0, abs(predicted) / top.m * 100)) END AS conf,
        CASE WHEN vol < 0.015 THEN 'Low' WHEN vol < 0.035 THEN 'Medium' ELSE 'High' END AS risk, explainability
        FROM latest l JOIN txt ON l.symbol = txt.symbol CROSS JOIN top)
"""


_ASSESSED = assessed_sql(_CONTRIB)


def assessed(spark, sf):
    rows, _ = features(spark, sf)
    newest = recommend.latest_slice(rows).withColumn("predicted_return", F.col("return_20d"))
    explained = recommend.with_contributions(
        newest, list(CONTRIBUTING), list(CONTRIBUTING.values())
    )
    return freeze(recommend.assess(explained))


_ASSESS_OUT = f"""symbol, date, {rnd("predicted")} AS predicted_5d_return,
    {rnd("conf")} AS confidence_score, risk AS risk_score, explainability,
    {rnd("vol")} AS volatility_20d"""


@register(
    "m14_t9_assessed_slice",
    sql(FEATURES_SQL + _LATEST + _ASSESSED + f"SELECT {_ASSESS_OUT} FROM ass", "prices"),
)
def assessed_slice(spark, sf):
    return rounded(assessed(spark, sf), 6)


@register(
    "m15_recommendations",
    sql(FEATURES_SQL + _LATEST + _ASSESSED + f"""SELECT {_ASSESS_OUT} FROM
        ((SELECT * FROM ass ORDER BY predicted DESC, symbol LIMIT 5) UNION ALL
         (SELECT * FROM ass ORDER BY predicted, symbol LIMIT 5))""", "prices"),
)
def ranked(spark, sf):
    return rounded(recommend.recommendations(assessed(spark, sf)), 6)


@register(
    "k7_report_lines",
    sql(FEATURES_SQL + _LATEST + _ASSESSED + """SELECT side, date, '| **' || symbol || '** | '
        || printf('%.2f%%', predicted * 100) || ' | ' || printf('%.1f%%', conf) || ' | ' || risk
        || ' | ' || explainability || ' |' AS line FROM
        ((SELECT 'buy' AS side, * FROM ass ORDER BY predicted DESC, symbol LIMIT 5) UNION ALL
         (SELECT 'sell' AS side, * FROM ass ORDER BY predicted, symbol LIMIT 5))""", "prices"),
)
def lines(spark, sf):
    return recommend.report_lines(assessed(spark, sf)).drop("predicted_5d_return")


NAMES = {"1": "One Inc.", "2": "Two Inc.", "5": "Five Coin"}


def market(spark, sf):
    """The newest day of the mart. Both passes over it need few of its columns, so it is not stored."""
    return overview.market_slice(mart_from(spark, sf), pairs(spark, NAMES, "symbol", "asset_name"))


_MARKET = _full_windows("""
    , newest AS (SELECT * FROM g WHERE date = (SELECT max(date) FROM g))
    , mkt AS (SELECT symbol, CASE symbol WHEN '1' THEN 'One Inc.' WHEN '2' THEN 'Two Inc.'
        WHEN '5' THEN 'Five Coin' ELSE symbol END AS asset_name, asset_class,
        CASE WHEN asset_class = 'crypto' THEN 'Crypto' ELSE sector END AS sector, close, return_1d,
        return_1d * 100 AS return_1d_pct FROM newest) """)


@register(
    "a7_snapshot",
    sql(FRAGMENT_SQL + _MARKET + f"""SELECT count(*) FILTER (WHERE asset_class = 'equity') AS n_equities,
        count(*) FILTER (WHERE asset_class = 'crypto') AS n_crypto,
        {rnd("avg(coalesce(sentiment_net, 0))")} AS avg_sentiment
        FROM mkt LEFT JOIN mart_news n ON n.symbol = mkt.symbol AND n.date = (SELECT max(date) FROM g)""",
        "prices", "articles"),
)
def snapshot(spark, sf):
    return overview.snapshot(market(spark, sf)).withColumn("avg_sentiment", rounded_col("avg_sentiment", 6))


@register(
    "o3_movers",
    sql(_MARKET + f""" SELECT side, symbol, asset_name, close, {rnd("return_1d_pct")} AS return_1d_pct
        FROM ((SELECT 'up' AS side, * FROM mkt ORDER BY return_1d DESC NULLS LAST, symbol LIMIT 5)
        UNION ALL (SELECT 'down' AS side, * FROM mkt ORDER BY return_1d ASC NULLS LAST, symbol LIMIT 5))""",
        "prices"),
)
def movers(spark, sf):
    rows = freeze(market(spark, sf).select("symbol", "asset_name", "close", "return_1d", "return_1d_pct"))
    up = overview.movers(rows, True).withColumn("side", F.lit("up"))
    down = overview.movers(rows, False).withColumn("side", F.lit("down"))
    out = up.unionByName(down)
    return out.withColumn("return_1d_pct", rounded_col("return_1d_pct"))


@register(
    "a6_sector_returns",
    sql(_MARKET + f"""SELECT sector, {rnd("avg(return_1d_pct)")} AS return_1d_pct FROM mkt
        WHERE asset_class = 'equity' AND sector IS NOT NULL GROUP BY sector""", "prices"),
)
def sector_page(spark, sf):
    return rounded(overview.sector_returns(market(spark, sf)), 6)


@register(
    "f6_symbol_series",
    sql("SELECT symbol, date, close FROM bars WHERE symbol = '7'", "bars"),
)
def one_symbol(spark, sf):
    return overview.symbol_series(views.bars(spark, sf).select("symbol", "date", "close"), "7")


@register(
    "o4_signals",
    sql(FEATURES_SQL + _LATEST + _ASSESSED + f""", rec AS (
            (SELECT * FROM ass ORDER BY predicted DESC, symbol LIMIT 5) UNION ALL
            (SELECT * FROM ass ORDER BY predicted, symbol LIMIT 5))
        SELECT side, symbol, CASE symbol WHEN '1' THEN 'One Inc.' WHEN '2' THEN 'Two Inc.'
            WHEN '5' THEN 'Five Coin' ELSE symbol END AS asset_name,
            {rnd("predicted * 100")} AS predicted_5d_return_pct, {rnd("conf")} AS confidence_score,
            risk AS risk_score, explainability FROM (
            (SELECT 'buy' AS side, * FROM rec WHERE predicted > 0 ORDER BY predicted DESC, symbol LIMIT 5)
            UNION ALL
            (SELECT 'sell' AS side, * FROM rec WHERE predicted < 0 ORDER BY predicted, symbol LIMIT 5))""",
        "prices"),
)
def signal_page(spark, sf):
    recs = freeze(recommend.recommendations(assessed(spark, sf)))
    names = pairs(spark, NAMES, "symbol", "asset_name")
    up = overview.signals(recs, names, True).withColumn("side", F.lit("buy"))
    return rounded(up.unionByName(
        overview.signals(recs, names, False).withColumn("side", F.lit("sell"))), 6)


@register(
    "p18_asset_class",
    """SELECT event_id, CASE WHEN event_type LIKE 'S%' OR upper(event_type) LIKE 'SOL%'
        OR upper(event_type) LIKE 'DOT%' THEN 'crypto' ELSE 'equity' END AS asset_class
        FROM (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'solana' WHEN user_id % 3 = 1
        THEN 'dot-usd' ELSE 'aapl' END AS event_type FROM events)""",
)
def classes(spark, sf):
    k = F.col("user_id") % 3
    name = F.when(k == 0, "solana").when(k == 1, "dot-usd").otherwise("aapl")
    rows = views.table(spark, sf, "events")
    return rows.select("event_id", inferred_asset_class(name).alias("asset_class"))


# ---------------------------------------------------------------------------
# ticks
# ---------------------------------------------------------------------------

# the second half of each day lands first, so the batch that wins is the one older in event time
_ITEMS = """
    , landed AS (SELECT *, CASE WHEN substr(timestamp, 12, 2) < '12' THEN 1 ELSE 0 END AS batch FROM ticks)
    , items AS (SELECT symbol, substr(timestamp, 1, 10) AS date,
        arg_max(price, (batch, timestamp, price, size)) AS price, arg_max(size, (batch, timestamp, price, size)) AS size,
        arg_max(timestamp, (batch, timestamp)) AS last_updated, 'realtime_stream' AS feature_source
        FROM landed GROUP BY 1, 2)
"""


@register(
    "st1_st2_decode",
    sql("""SELECT symbol, substr(timestamp, 1, 10) AS date, price, size, timestamp AS last_updated,
        'realtime_stream' AS feature_source FROM ticks""", "ticks"),
)
def decoded(spark, sf):
    rows = views.ticks(spark, sf).drop("event_id")
    lines = rows.select(F.to_json(F.struct("*")).alias("value"))
    return ticks.to_items(ticks.decode(lines).filter(ticks.is_valid()))


def shared_folder(spark, name: str) -> str:
    """A new folder in the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def tick_lines(spark, sf):
    rows = views.ticks(spark, sf).drop("event_id")
    return rows.select(F.to_json(F.struct("*")).alias("value"), F.substring("timestamp", 12, 2).alias("hour"))


def stored_ticks(spark, sf, **options):
    """Two folders landed and drained one after the other, each as one batch of the same stream."""
    root, lines = shared_folder(spark, "ticks"), freeze(tick_lines(spark, sf))
    store = ticks.TickStore(spark, f"{root}/store", **options)
    for k, part in enumerate((lines.filter("hour >= '12'"), lines.filter("hour < '12'"))):
        ticks.land(part, f"{root}/landing", str(k))
        stream = ticks.file_source(spark, f"{root}/landing/*")
        store.start(stream, f"{root}/checkpoint", once=True).awaitTermination()
    return store


@register("st3_latest_tick_store", sql(_ITEMS + "SELECT * FROM items", "ticks"))
def tick_store(spark, sf):
    return stored_ticks(spark, sf).read()


@register("k4_compacted_store", sql(_ITEMS + "SELECT * FROM items", "ticks"))
def compacted(spark, sf):
    """Folded into the base after each batch, by the store itself."""
    return stored_ticks(spark, sf, buckets=4, compact_after=1).read()


@register(
    "s11_live_ticks",
    sql(_ITEMS + """SELECT symbol, price, size, replace(substr(last_updated, 1, 19), 'T', ' ')
        AS last_updated FROM items ORDER BY symbol, date LIMIT 20""", "ticks"),
)
def live(spark, sf):
    return overview.live_ticks(stored_ticks(spark, sf).read())


@register(
    "st4_st5_timed_batches",
    sql("""SELECT (substr(timestamp, 12, 2)::INTEGER // 8)::BIGINT AS batch_id, count(*) AS n_rows,
        count(*) FILTER (WHERE symbol::INTEGER % 9 = 0) AS n_rejected FROM ticks GROUP BY ALL""", "ticks"),
)
def timed_batches(spark, sf):
    """A stream that looks every second, over three landings with lines that are no ticks."""
    root, lines = shared_folder(spark, "timed-ticks"), tick_lines(spark, sf)
    third = F.floor(F.col("hour").cast("int") / 8)
    broken = F.get_json_object("value", "$.symbol").cast("int") % 9 == 0
    value = F.when(broken, F.substring("value", 1, 20)).otherwise(F.col("value"))
    lines = freeze(lines.select(value.alias("value"), third.alias("third")))
    store = ticks.TickStore(spark, f"{root}/store")
    ticks.land(lines.filter("third = 0"), f"{root}/landing", "0")
    query = store.start(ticks.file_source(spark, f"{root}/landing/*"), f"{root}/checkpoint", seconds=1)
    try:
        for k in (0, 1, 2):
            if k:
                ticks.land(lines.filter(F.col("third") == k), f"{root}/landing", str(k))
            query.processAllAvailable()
    finally:
        query.stop()
    return store.batches().drop("finished")
