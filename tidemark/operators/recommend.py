"""Ranked recommendations with confidence, risk and the strongest contributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import confidence_score, risk_label
from tidemark.functions.text import contribution_text

COLUMNS = [
    "symbol", "predicted_5d_return", "confidence_score", "risk_score", "explainability",
    "volatility_20d", "date",
]


def latest_slice(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows of the newest date, found first so that the filter reaches the scan."""
    newest = df.agg(F.max(date)).first()[0]
    return df.filter(F.col(date) == F.lit(newest)) if newest is not None else df.limit(0)


def with_contributions(
    df: DataFrame, features: Sequence[str], weights: Sequence[float], out: str = "explainability"
) -> DataFrame:
    """Weight times scaled feature, the two largest of each sign as text."""
    values = F.array(*[F.col(c) * F.lit(float(w)) for c, w in zip(features, weights)])
    return df.withColumn(out, contribution_text(list(features), values))


def assess(scored: DataFrame) -> DataFrame:
    """Confidence against the largest prediction of the slice, and the risk label."""
    largest = scored.agg(F.max(F.abs("predicted_return")).alias("_largest"))
    rows = scored.crossJoin(F.broadcast(largest))  # one row
    return rows.select(
        "symbol",
        F.col("predicted_return").alias("predicted_5d_return"),
        confidence_score("predicted_return", "_largest").alias("confidence_score"),
        risk_label("volatility_20d").alias("risk_score"),
        "explainability",
        "volatility_20d",
        "date",
    )


def buys(assessed: DataFrame, n: int = 5) -> DataFrame:
    return assessed.orderBy(F.col("predicted_5d_return").desc(), "symbol").limit(n)


def sells(assessed: DataFrame, n: int = 5) -> DataFrame:
    return assessed.orderBy(F.col("predicted_5d_return").asc(), "symbol").limit(n)


def recommendations(assessed: DataFrame, n: int = 5) -> DataFrame:
    """Buys, then sells; with few assets one may be in both."""
    return buys(assessed, n).unionByName(sells(assessed, n)).select(*COLUMNS)


def report_lines(assessed: DataFrame, n: int = 5) -> DataFrame:
    """The two ranked tables as formatted lines (at most ``2 n`` rows)."""
    line = F.format_string(
        "| **%s** | %.2f%% | %.1f%% | %s | %s |",
        "symbol",
        F.col("predicted_5d_return") * 100.0,
        "confidence_score",
        "risk_score",
        "explainability",
    )
    parts = [
        side.select(F.lit(name).alias("side"), "date", "predicted_5d_return", line.alias("line"))
        for name, side in (("buy", buys(assessed, n)), ("sell", sells(assessed, n)))
    ]
    return parts[0].unionByName(parts[1])


def write_report(assessed: DataFrame, path: str, n: int = 5) -> None:
    """Markdown text with a heading and both tables; bounded by ``2 n`` lines."""
    rows = report_lines(assessed, n).collect()
    day = rows[0]["date"] if rows else "no data"
    head = [
        "| Symbol | 5-day forecast | Confidence | Risk | Strongest inputs |",
        "| :--- | ---: | ---: | :--- | :--- |",
    ]
    text = [f"# Recommendations for {day}", ""]
    titles = {"buy": "Top buy opportunities (long)", "sell": "Bottom sell opportunities (short)"}
    for side, title in titles.items():
        ordered = sorted(
            (r for r in rows if r["side"] == side),
            key=lambda r: r["predicted_5d_return"],
            reverse=side == "buy",
        )
        text += [f"## {title}", "", *head, *[r["line"] for r in ordered], ""]
    frame = assessed.sparkSession.createDataFrame([("\n".join(text),)], "value string")
    frame.coalesce(1).write.mode("overwrite").text(path)
