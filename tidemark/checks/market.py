"""Registered queries: indicators, sector strength, macro, news, gold and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import views
from tidemark.checks.views import rnd, rounded, sql
from tidemark.operators import macro as macro_ops
from tidemark.operators.series import (
    add_blocks,
    ewm_means,
    forward_fill,
    over_series,
    sequences,
)
from tidemark.operators.technical import (
    REACH,
    latest_returns,
    mart_technicals,
    technical_indicators,
    with_relative_strength,
)
from tidemark.plans import gold, marts, news
from tidemark.scale import global_position

QUERIES: dict = {}
SQL: dict[str, str] = {}

# indicator -> digits in the comparison
DIGITS = {
    "sma_20": 5, "sma_50": 5, "sma_200": 5, "ema_12": 5, "ema_26": 5, "macd": 5, "macd_signal": 5, "macd_hist": 5,
    "bb_upper": 4, "bb_lower": 4, "rsi_14": 4, "close": 2, "value": 2,
    "return_1d": 8, "return_5d": 8, "return_20d": 8, "target_1d_return": 8,
    "target_5d_return": 8, "momentum_acceleration": 8,
    **{c: 2 for c in macro_ops.MART_SERIES}, **{c: 2 for c in marts.MACRO_COLUMNS},
}


def register(name, text=None):
    def add(function):
        QUERIES[name] = function
        if text:
            SQL[name] = text
        return function

    return add


def _r(column: str, alias: str | None = None) -> str:
    alias = alias or column
    return f"{rnd(column, DIGITS.get(alias, 6))} AS {alias}"


def _full(agg: str, x: str, n: int, least: int | None = None) -> str:
    frame = f"OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {frame} >= {least or n} THEN {agg}({x}) {frame} END"


W = "OVER (PARTITION BY symbol ORDER BY date)"

# ---------------------------------------------------------------------------
# bars and windows
# ---------------------------------------------------------------------------


@register(
    "bars_daily_ohlcv",
    sql(f"""SELECT symbol, date, {_r("open")}, {_r("high")}, {_r("low")}, {_r("close")},
        {_r("volume")}, {_r("vwap")}, trade_count, sector, industry, asset_class FROM prices""",
        "prices"),
)
def bars_daily(spark, sf):
    return rounded(views.prices(spark, sf), DIGITS)


def _full_windows(body: str) -> str:
    """SQL of all indicators without smoothing; the smoothed ones come from recursion."""
    return f"""
    , r AS (SELECT *, close / lag(close, 1) {W} - 1 AS return_1d,
                   close / lag(close, 5) {W} - 1 AS return_5d,
                   close / lag(close, 20) {W} - 1 AS return_20d FROM prices)
    , f AS (SELECT symbol, date, close, volume, sector, asset_class,
        return_1d, return_5d, return_20d,
        {_full("avg", "close", 20)} AS sma_20, {_full("avg", "close", 50)} AS sma_50,
        {_full("avg", "close", 200)} AS sma_200, {_full("stddev_samp", "close", 20)} AS std_20,
        {_full("stddev_samp", "return_1d", 20)} AS volatility_20d,
        {_full("stddev_samp", "return_1d", 5)} AS s5,
        {_full("stddev_samp", "return_1d", 60)} AS s60,
        {_full("avg", "volume", 20)} AS v20,
        {_full("min", "close", 252, 20)} AS low_y, {_full("max", "close", 252, 20)} AS high_y,
        lead(close, 1) {W} / close - 1 AS target_1d_return,
        lead(close, 5) {W} / close - 1 AS target_5d_return,
        ((lead(close, 3) {W} / close - 1) + (lead(close, 5) {W} / close - 1)
          + (lead(close, 10) {W} / close - 1)) / 3 AS target_smooth_return
        FROM r)
    , g AS (SELECT *, sma_20 + 2 * std_20 AS bb_upper, sma_20 - 2 * std_20 AS bb_lower,
        4 * std_20 / (sma_20 + 1e-9) AS bb_width, volume / (v20 + 1e-9) AS volume_ratio,
        (close - low_y) / (high_y - low_y + 1e-9) AS price_position_52w,
        return_5d - return_20d AS momentum_acceleration,
        s5 / (s60 + 1e-9) AS vol_regime_ratio FROM f)
    {body}"""


PLAIN = [
    "sma_20", "sma_50", "sma_200", "bb_upper", "bb_lower", "bb_width", "return_1d", "return_5d",
    "return_20d", "volatility_20d", "volume_ratio", "price_position_52w",
    "momentum_acceleration", "vol_regime_ratio", "target_1d_return", "target_5d_return",
    "target_smooth_return",
]
SMOOTHED = ["rsi_14", "macd", "macd_signal", "macd_hist"]

# the recurrence itself, day by day
_RECURSION = """
    , n AS MATERIALIZED (SELECT symbol, date, close,
             row_number() OVER (PARTITION BY symbol ORDER BY date) AS i,
             close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS d FROM prices)
    , e AS (
        SELECT symbol, date, i, close AS e12, close AS e26, CAST(0 AS DOUBLE) AS macd,
               CAST(0 AS DOUBLE) AS sig, CAST(NULL AS DOUBLE) AS g, CAST(NULL AS DOUBLE) AS l
        FROM n WHERE i = 1
        UNION ALL
        SELECT n.symbol, n.date, n.i,
               e12 + (n.close - e12) * 2 / 13, e26 + (n.close - e26) * 2 / 27,
               (e12 + (n.close - e12) * 2 / 13) - (e26 + (n.close - e26) * 2 / 27),
               sig + (((e12 + (n.close - e12) * 2 / 13) - (e26 + (n.close - e26) * 2 / 27)) - sig)
                   * 2 / 10,
               CASE WHEN g IS NULL THEN greatest(n.d, 0) ELSE g + (greatest(n.d, 0) - g) / 14 END,
               CASE WHEN l IS NULL THEN greatest(-n.d, 0) ELSE l + (greatest(-n.d, 0) - l) / 14 END
        FROM e JOIN n ON n.symbol = e.symbol AND n.i = e.i + 1)
    , s AS (SELECT symbol, date, e12, e26, g, l, 100 - 100 / (1 + g / (l + 1e-9)) AS rsi_14, macd,
                   sig AS macd_signal, macd - sig AS macd_hist FROM e)
"""

for _name, _columns in {
    "w1_sma_full": ["sma_20", "sma_50", "sma_200"],
    "w2_w3_bollinger_full": ["bb_upper", "bb_lower", "bb_width"],
    "w4_returns": ["return_1d", "return_5d", "return_20d"],
    "w5_w16_volatility": ["volatility_20d", "vol_regime_ratio"],
    "w7_w9_targets": ["target_1d_return", "target_5d_return", "target_smooth_return"],
    "w13_w15_volume_position_momentum": [
        "volume_ratio", "price_position_52w", "momentum_acceleration",
    ],
}.items():

    def _indicator_query(spark, sf, columns=tuple(_columns)):
        prices = views.bars(spark, sf)
        out = technical_indicators(prices, "date", views.price_layout(spark, sf))
        return rounded(out.select("symbol", "date", *columns), DIGITS)

    QUERIES[_name] = _indicator_query
    SQL[_name] = sql(
        _full_windows(f"SELECT symbol, date, {', '.join(_r(c) for c in _columns)} FROM g"), "prices"
    )


@register(
    "w10_ema",
    sql(_RECURSION + f"SELECT symbol, date, {_r('e12', 'ema_12')}, {_r('e26', 'ema_26')} FROM s",
        "prices", recursive=True),
)
def ema(spark, sf):
    def compute(rows, parts, order):
        spec = {"ema_12": ("close", 2 / 13), "ema_26": ("close", 2 / 27)}
        rows, blocks = add_blocks(rows, parts, order, layout)
        return ewm_means(rows, spec, parts, order, blocks)

    layout = views.price_layout(spark, sf)
    rows = views.bars(spark, sf).select("symbol", "date", "close")
    out = over_series(rows, compute, back=REACH, layout=layout)
    return rounded(out.select("symbol", "date", "ema_12", "ema_26"), DIGITS)


@register(
    "w11_macd",
    sql(_RECURSION + "SELECT symbol, date, "
        + ", ".join(_r(c) for c in SMOOTHED[1:]) + " FROM s", "prices", recursive=True),
)
def macd(spark, sf):
    out = technical_indicators(views.bars(spark, sf), "date", views.price_layout(spark, sf))
    return rounded(out.select("symbol", "date", *SMOOTHED[1:]), DIGITS)


@register(
    "w12_rsi",
    sql(_RECURSION + f"SELECT symbol, date, {_r('rsi_14')} FROM s", "prices", recursive=True),
)
def rsi(spark, sf):
    out = technical_indicators(views.bars(spark, sf), "date", views.price_layout(spark, sf))
    return rounded(out.select("symbol", "date", "rsi_14"), DIGITS)


@register(
    "w6_relative_strength",
    sql(_full_windows(f"""SELECT symbol, date, {_r("return_1d")},
        {rnd("return_1d - avg(return_1d) OVER (PARTITION BY sector, date)")} AS rel_strength_sector FROM g"""), "prices"),
)
def relative_strength(spark, sf):
    prices = views.prices(spark, sf)
    layout = views.price_layout(spark, sf)
    rows = latest_returns(prices, "date", ["sector"], layout)
    out = with_relative_strength(rows, prices, "date", layout)
    return rounded(out.select("symbol", "date", "return_1d", "rel_strength_sector"), DIGITS)


@register(
    "c5_technical_features",
    sql(_RECURSION + _full_windows(
        "SELECT g.symbol, g.date, g.asset_class, g.sector, round(g.close, 2) AS close, "
        + ", ".join(_r(f"{t}.{c}", c) for t, cs in (("g", PLAIN), ("s", SMOOTHED)) for c in cs)
        + ", " + rnd("g.return_1d - avg(g.return_1d) OVER (PARTITION BY sector, g.date)")
        + " AS rel_strength_sector FROM g JOIN s ON g.symbol = s.symbol AND g.date = s.date"),
        "prices", recursive=True),
)
def technical_features(spark, sf):
    prices = views.prices(spark, sf)
    out = gold.price_features(prices, "date", views.price_layout(spark, sf))
    keep = ["symbol", "date", "asset_class", "sector", "close", *PLAIN, *SMOOTHED]
    return rounded(out.select(*keep, "rel_strength_sector"), DIGITS)


# ---------------------------------------------------------------------------
# macro
# ---------------------------------------------------------------------------

_SERIES = list(macro_ops.MART_SERIES)
_PIVOT = ", ".join(f'max(CASE WHEN series_id = \'{s}\' THEN value END) AS "{s}"' for s in _SERIES)
_FILLED = ", ".join(
    f'last_value("{s}" IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND '
    f'CURRENT ROW) AS "{s}"'
    for s in _SERIES
)
_MACRO_FEATURES = f"""
    , pivoted AS (SELECT date, {_PIVOT} FROM macro GROUP BY date)
    , filled AS (SELECT date, {_FILLED} FROM pivoted)
    , mf AS (SELECT *, "DGS10" - "DGS2" AS yield_curve_slope FROM filled)
"""
_MACRO_OUT = [*_SERIES, "yield_curve_slope"]
_MACRO_ROUND = ", ".join(f'round("{c}", 2) AS "{c}"' for c in _MACRO_OUT)


@register(
    "a4_macro_pivot",
    sql(f""", pivoted AS (SELECT date, {_PIVOT} FROM macro GROUP BY date)
        SELECT date, {', '.join(f'round("{s}", 2) AS "{s}"' for s in _SERIES)} FROM pivoted""",
        "macro"),
)
def macro_pivot(spark, sf):
    return rounded(macro_ops.pivot_series(views.macro(spark, sf), _SERIES), 2)


@register(
    "c6_macro_features", sql(_MACRO_FEATURES + f"SELECT date, {_MACRO_ROUND} FROM mf", "macro")
)
def macro_features(spark, sf):
    return rounded(macro_ops.macro_features(views.macro(spark, sf)), 2)


@register(
    "j2_as_of_macro",
    sql(_MACRO_FEATURES + f"""SELECT p.symbol, p.date, round(p.close, 2) AS close,
        {', '.join(f'round(m."{c}", 2) AS "{c}"' for c in _MACRO_OUT)}
        FROM bars p ASOF LEFT JOIN mf m ON p.date >= m.date""", "bars", "macro"),
)
def as_of_macro(spark, sf):
    left = views.bars(spark, sf).select("symbol", "date", "close")
    out = macro_ops.as_of_join(left, macro_ops.macro_features(views.macro(spark, sf)))
    return rounded(out, {**{c: 2 for c in _MACRO_OUT}, "close": 2})


# the latest print of each series at or before each day with a price; prints of other days
# do not exist
_MART_MACRO = """
    , calendar AS (SELECT DISTINCT date FROM prices)
    , prints AS (SELECT series_id, date, value FROM macro
                 WHERE value IS NOT NULL AND date IN (SELECT date FROM calendar))
    , md AS (SELECT calendar.date, {values}, s{long}.value - s{short}.value AS yield_curve_slope
             FROM calendar {series})
""".format(
    values=", ".join(f"s{i}.value AS {c}" for i, c in enumerate(macro_ops.MART_SERIES.values())),
    long=list(macro_ops.MART_SERIES).index(macro_ops.LONG_RATE),
    short=list(macro_ops.MART_SERIES).index(macro_ops.SHORT_RATE),
    series=" ".join(
        f"ASOF LEFT JOIN (SELECT date, value FROM prints WHERE series_id = '{s}') s{i}"
        f" ON calendar.date >= s{i}.date"
        for i, s in enumerate(macro_ops.MART_SERIES)
    ),
)


@register(
    "c9_macro_daily",
    sql(_MART_MACRO + "SELECT date, " + ", ".join(_r(c) for c in marts.MACRO_COLUMNS)
        + " FROM md", "prices", "macro"),
)
def macro_daily(spark, sf):
    dates = views.trades(spark, sf).select("date")
    return rounded(macro_ops.macro_daily(dates, views.macro(spark, sf)), 2)


@register(
    "w17_forward_fill",
    sql("""SELECT symbol, date, round(last_value(x IGNORE NULLS) OVER (PARTITION BY symbol
        ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS x
        FROM (SELECT symbol, date, CASE WHEN trade_count % 2 = 0 THEN close END AS x FROM bars)""",
        "bars"),
)
def fill_forward(spark, sf):
    sparse = views.bars(spark, sf).select(
        "symbol", "date", F.when(F.col("trade_count") % 2 == 0, F.col("close")).alias("x")
    )
    layout = views.price_layout(spark, sf)
    return rounded(forward_fill(sparse, ["x"], key="symbol", order=["date"], layout=layout), 4)


# ---------------------------------------------------------------------------
# positions and sequences
# ---------------------------------------------------------------------------


@register(
    "w21_global_position",
    sql("""SELECT symbol, date, CAST(row_number() OVER (ORDER BY date, symbol) - 1 AS BIGINT)
        AS pos FROM bars""", "bars"),
)
def position(spark, sf):
    rows = views.trades(spark, sf).select("symbol", "date").distinct()
    return global_position(rows, ["date", "symbol"]).select("symbol", "date", "pos")


@register(
    "w22_sequences",
    sql(""", l AS (SELECT symbol, date, volume AS target, list(close) OVER w AS c,
            list(volume) OVER w AS v FROM bars
            WINDOW w AS (PARTITION BY symbol ORDER BY date
                         ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
        SELECT symbol, date, target, round(list_sum(c), 3) AS sum_close,
            round(c[1], 4) AS oldest_close, round(c[10], 4) AS newest_close,
            list_sum(v) AS sum_volume, CAST(len(c) AS INTEGER) AS length
        FROM l WHERE len(c) = 10""", "bars"),
)
def look_back(spark, sf):
    rows = views.bars(spark, sf).select("symbol", "date", "close", "volume")
    layout = views.price_layout(spark, sf)
    out = sequences(rows, ["close", "volume"], "volume", 10, layout=layout)
    total = lambda i: F.aggregate("sequence", F.lit(0.0), lambda a, s: a + s[i])
    return out.select(
        "symbol", "date", "target",
        F.round(total(0), 3).alias("sum_close"),
        F.round(F.col("sequence")[0][0], 4).alias("oldest_close"),
        F.round(F.col("sequence")[9][0], 4).alias("newest_close"),
        total(1).alias("sum_volume"),
        F.size("sequence").alias("length"),
    )


# ---------------------------------------------------------------------------
# gold features and marts
# ---------------------------------------------------------------------------

# frequent words of the given documents, as the reference lists hardly occur there
POSITIVE_TOKENS = ("the", "of", "for", "it", "les", "un")
NEGATIVE_TOKENS = ("and", "to", "in", "was", "de", "la")


def scored_by_tokens(df):
    return news.with_lexicon_scores(df, "title", POSITIVE_TOKENS, NEGATIVE_TOKENS)


def token_list(tokens) -> str:
    return "[" + ", ".join(f"'{t}'" for t in tokens) + "]"


LEXICON_SQL = f"""
    , tokens AS (SELECT a.*, list_distinct(string_split_regex(lower(title), '\\s+')) AS words
                 FROM articles a)
    , hits AS (SELECT *, len(list_intersect(words, {token_list(POSITIVE_TOKENS)})) AS p,
                      len(list_intersect(words, {token_list(NEGATIVE_TOKENS)})) AS q FROM tokens)
    , mood AS (SELECT *, CASE WHEN p + q = 0 THEN 'Neutral' WHEN p > q THEN 'Positive'
                             ELSE 'Negative' END AS label,
                      CASE WHEN p + q = 0 THEN 1.0 ELSE greatest(p, q) / (p + q) END AS score
               FROM hits)
    , scores AS (SELECT *, CASE WHEN label = 'Positive' THEN score ELSE 0 END AS sentiment_pos,
                        CASE WHEN label = 'Negative' THEN score ELSE 0 END AS sentiment_neg,
                        CASE WHEN label = 'Neutral' THEN score ELSE 0 END AS sentiment_neu
                 FROM mood)
    , daily_news AS (
        SELECT ticker, date, avg(sentiment_pos) AS sentiment_pos, avg(sentiment_neg) AS sentiment_neg,
               avg(sentiment_neu) AS sentiment_neu,
               avg(sentiment_pos - sentiment_neg) AS sentiment_net
        FROM (SELECT *, trim(unnest(string_split(matched_tickers, ','))) AS ticker FROM scores)
        WHERE ticker <> '' GROUP BY ticker, date)
"""


@register(
    "c8_gold_features",
    sql(_RECURSION + _MACRO_FEATURES + LEXICON_SQL + _full_windows(
        "SELECT g.symbol, g.date, g.asset_class,"
        " CASE WHEN g.asset_class = 'equity' THEN g.sector END AS sector,"
        " round(g.close, 2) AS close, "
        + ", ".join(_r(f"{t}.{c}", c) for t, cs in (("g", PLAIN), ("s", SMOOTHED)) for c in cs)
        + """, CASE WHEN g.asset_class = 'equity' THEN floor((g.return_1d - avg(g.return_1d)
             OVER (PARTITION BY g.asset_class, sector, g.date)) * 1e6 + 0.5025) / 1e6 END AS rel_strength_sector, """
        + ", ".join(f'round(m."{c}", 2) AS "{c}"' for c in _MACRO_OUT)
        + ", " + ", ".join(f"{rnd(f'coalesce(d.{c}, 0)')} AS {c}"
                           for c in news.SENTIMENT_COLUMNS)
        + """ FROM g JOIN s ON g.symbol = s.symbol AND g.date = s.date
              ASOF LEFT JOIN mf m ON g.date >= m.date
              LEFT JOIN daily_news d ON g.symbol = d.ticker AND g.date = d.date"""),
        "prices", "macro", "articles", recursive=True),
)
def gold_features(spark, sf):
    out = gold.gold_features(
        views.stocks(spark, sf),
        views.crypto(spark, sf),
        views.macro(spark, sf),
        views.news(spark, sf),
        score=scored_by_tokens,
        layout=views.price_layout(spark, sf),
    )
    keep = ["symbol", "date", "asset_class", "sector", "close", *PLAIN, *SMOOTHED,
            "rel_strength_sector", *_MACRO_OUT, *news.SENTIMENT_COLUMNS]
    return rounded(out.select(*keep), DIGITS)


def in_article(fragment: str) -> str:
    return f"(contains(lower(title), {fragment}) OR contains(lower(description), {fragment}))"


def fragment_count(fragments) -> str:
    """How many of the fragments an article of ``articles`` holds."""
    return f"len(list_filter({token_list(fragments)}, lambda f: coalesce({in_article('f')}, false)))"


# every fragment found in an article pulls its ticker up or down by one; the sign of the sum counts
FRAGMENT_SQL = """
    , pulls (fragment, pull) AS (VALUES {pulls})
    , numbered AS (SELECT row_number() OVER () AS k, * FROM articles WHERE matched_tickers <> '')
    , leaning AS (SELECT k, sign(coalesce(sum(pull), 0)) AS lean
                  FROM numbered LEFT JOIN pulls ON {found} GROUP BY k)
    , named AS (SELECT k, date, unnest(string_split(matched_tickers, ',')) AS ticker FROM numbered)
    , mart_news AS (SELECT trim(ticker) AS symbol, date, avg(lean) AS sentiment_net
                    FROM named JOIN leaning USING (k) GROUP BY trim(ticker), date)
""".format(
    pulls=", ".join(
        f"('{f}', {pull})"
        for fragments, pull in ((news.POSITIVE_FRAGMENTS, 1), (news.NEGATIVE_FRAGMENTS, -1))
        for f in fragments
    ),
    found=in_article("fragment"),
)


def last_n(column: str, n: int) -> str:
    """The up to ``n`` newest entries of a symbol's list at row ``i``."""
    return f"{column}[greatest(i - {n - 1}, 1):i]"


def change(n: int) -> str:
    """Relative change of the close over ``n`` rows of the symbol; none before there are as many."""
    return f"CASE WHEN i > {n} THEN closes[i] / closes[i - {n}] - 1 END"


# each symbol's closes and returns as one list, read by position
MART_SQL = f"""
    , placed AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS i FROM prices)
    , histories AS (SELECT symbol, list(close ORDER BY i) AS closes FROM placed GROUP BY symbol)
    , changes AS (SELECT symbol, closes, list_transform(closes, lambda c, i: {change(1)}) AS gains FROM histories)
    , read AS (SELECT placed.* EXCLUDE (sector, industry), gains,
        if(asset_class = 'crypto', 'Crypto', sector) AS sector,
        if(asset_class = 'crypto', 'Cryptocurrency', industry) AS industry,
        {", ".join(f"list_avg({last_n('closes', n)}) AS sma_{n}" for n in (20, 50, 200))},
        2 * list_stddev_samp({last_n("closes", 20)}) AS band,
        list_stddev_samp({last_n("gains", 20)}) AS volatility_20d,
        {", ".join(f"{change(n)} AS return_{n}d" for n in (1, 5, 20))},
        gains[i + 1] AS target_1d_return, closes[i + 5] / close - 1 AS target_5d_return
        FROM placed JOIN changes USING (symbol))
    , sector_means AS (SELECT sector, date, avg(return_1d) AS sector_return FROM read GROUP BY sector, date)
    , mart AS (SELECT read.*, sma_20 + band AS bb_upper, sma_20 - band AS bb_lower,
        if(sma_20 = 0, 0, 2 * band / sma_20) AS bb_width, return_1d - sector_return AS rel_strength_sector
        FROM read JOIN sector_means USING (sector, date))
"""
_MART_NUMBERS = ["open", "high", "low", "close", "volume", "vwap", *marts.TECHNICAL_COLUMNS]


def mart_from(spark, sf):
    return marts.mart_features(
        marts.stg_stocks(views.stocks(spark, sf)),
        marts.stg_crypto(views.crypto(spark, sf)),
        marts.stg_macro(views.macro(spark, sf)),
        marts.stg_news(views.news(spark, sf)),
        layout=views.price_layout(spark, sf),
    )


@register(
    "c11_mart_features",
    sql(_MART_MACRO + FRAGMENT_SQL + MART_SQL
        + "SELECT t.symbol, t.date, t.trade_count, t.asset_class, t.sector, t.industry, "
        + ", ".join(_r(f"t.{c}", c) for c in _MART_NUMBERS) + ", "
        + ", ".join(_r(f"m.{c}", c) for c in marts.MACRO_COLUMNS)
        + """, floor(coalesce(x.sentiment_net, 0.0) * 1e6 + 0.5025) / 1e6 AS sentiment_net FROM mart t
        LEFT JOIN md m ON t.date = m.date
        LEFT JOIN mart_news x ON t.symbol = x.symbol AND t.date = x.date""",
        "prices", "macro", "articles"),
)
def mart_features(spark, sf):
    return rounded(mart_from(spark, sf), DIGITS)


@register(
    "c12_mart_sector_perf",
    sql(MART_SQL + f"""SELECT sector, date, {rnd("avg(return_1d)")} AS avg_return_1d,
        {rnd("avg(volatility_20d)")} AS avg_volatility_20d, sum(volume) AS total_volume,
        count(DISTINCT symbol) AS active_assets FROM mart GROUP BY sector, date""", "prices"),
)
def mart_sector_perf(spark, sf):
    return rounded(marts.mart_sector_performance(mart_from(spark, sf)), 6)


@register(
    "w1_w5_mart_technicals",
    sql(MART_SQL + "SELECT symbol, date, "
        + ", ".join(_r(c) for c in marts.TECHNICAL_COLUMNS if c != "rel_strength_sector")
        + " FROM mart", "prices"),
)
def partial_windows(spark, sf):
    out = mart_technicals(views.bars(spark, sf), views.price_layout(spark, sf))
    keep = [c for c in marts.TECHNICAL_COLUMNS if c != "rel_strength_sector"]
    return rounded(out.select("symbol", "date", *keep), DIGITS)


@register(
    "c7_news_sentiment",
    sql(LEXICON_SQL + "SELECT ticker, date, "
        + ", ".join(_r(c) for c in news.SENTIMENT_COLUMNS) + " FROM daily_news", "articles"),
)
def daily_news(spark, sf):
    return rounded(news.news_sentiment(views.news(spark, sf), scored_by_tokens), 6)


@register(
    "c10_mart_news_sentiment",
    sql(FRAGMENT_SQL + f"SELECT symbol, date, {_r('sentiment_net')} FROM mart_news", "articles"),
)
def mart_news(spark, sf):
    return rounded(news.mart_news_sentiment(views.news(spark, sf)), 6)
