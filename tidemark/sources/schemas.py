"""Explicit schemas of landed payloads and of the layered tables."""

from __future__ import annotations

_BARS = (
    "symbol string, timestamp string, open double, high double, low double, close double, "
    "volume double, trade_count double, vwap double"
)
_LINEAGE = "ingestion_timestamp string, data_source string"

# landed payloads
BAR_PAYLOAD = _BARS
OBSERVATION_PAYLOAD = (
    "series_id string, observations array<struct<realtime_start: string, realtime_end: string, "
    "date: string, value: string>>"
)
ARTICLE_PAYLOAD = (
    "tickers array<string>, articles array<struct<source: struct<id: string, name: string>, "
    "author: string, title: string, description: string, url: string, publishedAt: string, "
    "content: string>>"
)
TICK = "symbol string, price double, size double, timestamp string, source string"

# layered tables
TABLES: dict[tuple[str, str], str] = {
    ("bronze", "stocks"): f"{_BARS}, {_LINEAGE}, asset_class string",
    ("bronze", "crypto"): f"{_BARS}, {_LINEAGE}, asset_class string",
    ("bronze", "macro"): f"date string, value double, series_id string, series_name string, {_LINEAGE}",
    ("bronze", "news"): (
        "title string, description string, url string, source string, published_at string, "
        f"query_tickers string, matched_tickers string, {_LINEAGE}"
    ),
    ("silver", "stocks"): (
        f"{_BARS.replace('timestamp string', 'timestamp date')}, {_LINEAGE}, "
        "asset_class string, sector string, industry string"
    ),
    ("silver", "crypto"): (
        f"{_BARS.replace('timestamp string', 'timestamp date')}, {_LINEAGE}, asset_class string"
    ),
    ("silver", "macro"): f"date date, value double, series_id string, series_name string, {_LINEAGE}",
    ("silver", "news"): (
        "title string, description string, url string, source string, published_at string, "
        f"query_tickers string, matched_tickers string, {_LINEAGE}"
    ),
    ("gold", "backtest_report"): "date date, portfolio_value double, benchmark_value double",
    ("gold", "recommendations"): (
        "symbol string, predicted_5d_return double, confidence_score double, risk_score string, "
        "explainability string, volatility_20d double, date date"
    ),
    ("gold", "feature_store"): (
        "symbol string, date string, price double, size double, last_updated string, "
        "feature_source string"
    ),
}
