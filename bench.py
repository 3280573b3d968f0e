"""Headline queries at one scale: median of three runs after a warm-up, one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from tidemark.checks import market, portfolio, views
from tidemark.functions import text
from tidemark.operators import backtest, metrics, models, recommend
from tidemark.operators.macro import as_of_join, macro_features
from tidemark.operators.split import chronology
from tidemark.operators.technical import mart_technicals, technical_indicators
from tidemark.operators.trees import BY_LEAF
from tidemark.plans import gold, marts, news, overview, silver, training
from tidemark.session import build_session
from tidemark.sources.reference_data import NEWS_GROUPS
from tidemark.streaming import ticks

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def stored(spark, df, folder: str, name: str):
    """Inputs as tables, the state in which the jobs below find them."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="tidemark-bench-")

    stocks = stored(spark, views.stocks(spark, sf), folder, "stocks")
    crypto = stored(spark, views.crypto(spark, sf), folder, "crypto")
    macro = stored(spark, views.macro(spark, sf), folder, "macro")
    articles = stored(spark, views.news(spark, sf), folder, "news")
    bars = stored(spark, views.bars(spark, sf), folder, "bars")
    bronze = bars.withColumn("timestamp", F.date_format("date", "yyyy-MM-dd'T'05:00:00")).drop("date")
    bronze = stored(spark, bronze, folder, "bronze_stocks")

    def mart():
        return marts.mart_features(
            marts.stg_stocks(stocks), marts.stg_crypto(crypto), marts.stg_macro(macro),
            marts.stg_news(articles),
        )

    features = stored(
        spark, technical_indicators(bars, "date").select(*portfolio.KEEP), folder, "features"
    )
    mart_table = stored(spark, mart(), folder, "mart")
    signal = features.filter(F.col("return_20d").isNotNull()).select(
        "date", "symbol", F.col("return_20d").alias("predicted_return"), "return_1d"
    )
    labelled = features.filter(
        F.col("target_5d_return").isNotNull() & F.col("return_20d").isNotNull()
    )

    def recommended():
        newest = recommend.latest_slice(features)
        newest = newest.withColumn("predicted_return", F.col("return_20d"))
        names = portfolio.CONTRIBUTING
        told = recommend.with_contributions(newest, list(names), list(names.values()))
        return recommend.recommendations(recommend.assess(told))

    table = gold.gold_features(stocks, crypto, macro, articles, score=market.scored_by_tokens)
    gold_table = stored(spark, table, folder, "gold_table")
    prepared = models.preprocess(gold_table)
    train = stored(spark, prepared.train, folder, "train")
    late = chronology(train, lambda n: [int(n * 0.85)]).cuts[0]
    flagged = stored(spark, train.withColumn("late", ~late.before()), folder, "flagged")

    def fitted():
        found = models.preprocess(gold_table)
        return models.score(models.fit_ridge(found.train, found.features), found.test, found.features)

    def fit_and_score(fit):
        return lambda: models.score(fit(), prepared.test, models.FEATURES)

    queries = {
        "bars_from_trades": lambda: views.bars(spark, sf),
        "silver_stocks": lambda: silver.silver_stocks(bronze, views.sectors(spark, sf)),
        "technical_indicators": lambda: technical_indicators(bars, "date"),
        "mart_technicals": lambda: mart_technicals(bars),
        "as_of_macro": lambda: as_of_join(bars, macro_features(macro)),
        "news_sentiment": lambda: news.news_sentiment(articles, market.scored_by_tokens),
        "mart_news_sentiment": lambda: news.mart_news_sentiment(articles),
        "gold_features": lambda: gold.gold_features(stocks, crypto, macro, articles),
        "mart_features": mart,
        "mart_sector_perf": lambda: marts.mart_sector_performance(mart_table),
        "evaluate": lambda: metrics.evaluate(labelled, "target_5d_return", "return_20d"),
        "backtest": lambda: backtest.statistics(backtest.backtest(signal)),
        "recommendations": recommended,
        "latest_ticks": lambda: overview.live_ticks(ticks.newest_per_key(ticks.to_items(views.ticks(spark, sf)))),
        "match_tickers": lambda: articles.select(
            text.match_tickers("title", "description", F.array(*[F.lit(t) for t in NEWS_GROUPS[0][1]]))
        ),
        # all 27 inputs of the models
        "prepare_inputs": lambda: models.preprocess(gold_table).rows,
        "ridge_fit_and_score": fitted,
        "ridge_search_30_trials": lambda: models.search_ridge(train, models.FEATURES)[1],
        "model_recommendations": lambda: recommend.recommendations(training.assess_latest(gold_table)),
        "forest_100_trees": fit_and_score(lambda: models.fit_forest(train, models.FEATURES)),
        "boosted_by_level": fit_and_score(lambda: models.fit_boosted(flagged, models.FEATURES, validation="late")),
        "boosted_by_leaf": fit_and_score(lambda: models.fit_boosted(flagged, models.FEATURES, how=BY_LEAF, validation="late")),
    }
    once = {"forest_100_trees", "boosted_by_level", "boosted_by_leaf"}  # long ones run once, without a warm-up
    wanted = sys.argv[1:]
    seconds = {}
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        times = []
        for i in range(1 if name in once else RUNS + 1):
            start = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            if i or name in once:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries, median of runs after one warm-up",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
