"""Boosted trees against a forest, and both against the naive forecast, from rolling origins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import metrics, models
from ..sources.tables import written_once

#: Share of the rows that the first origin has behind it, and of a training set that tells when boosting stops.
FIRST_SHARE, STOP_SHARE = 0.55, 0.15


def cut_dates(df: DataFrame, shares: Sequence[float], date_col: str = "date") -> list[dt.date]:
    """First date of what lies behind each share of the rows, from counts per date: no row is sorted.

    A date is never torn.  There are as many counts as dates; only the cuts reach the driver."""
    counts = df.filter(F.col(date_col).isNotNull()).groupBy(F.col(date_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy(F.lit(0)).orderBy("day")
    placed = counts.select("day", F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"))
    share = F.coalesce("before", F.lit(0)) / F.col("total")
    found = placed.agg(*[F.min(F.when(share >= s, F.col("day"))).alias(f"c{i}") for i, s in enumerate(shares)]).first()
    return [day for day in found if day is not None]


def iterations(model: PipelineModel) -> int:
    """Trees of a fitted model; of boosted ones, up to where the newer rows stopped getting better."""
    return model.stages[-1].getNumTrees


def origins(rows: DataFrame, folds: int) -> list[tuple[dt.date, dt.date | None]]:
    """(first test date, first date behind the test) of every fold, oldest first."""
    step = (1 - FIRST_SHARE) / folds
    cuts = sorted(set(cut_dates(rows, [FIRST_SHARE + n * step for n in range(folds)])))
    return [(cut, cuts[n + 1] if n + 1 < len(cuts) else None) for n, cut in enumerate(cuts)]


def compare_models(rows: DataFrame, folds: int = 3, max_trees: int = 500, forest_trees: int = 500) -> DataFrame:
    """One row per fold and learner: rows, errors, the naive forecast's error on the same rows, trees kept.

    A fold trains on all days before its origin and is judged on the days up to the next one; boosting stops by
    the newest days of the training part, never by the days it is judged on.  Folds and learners go one after another; each fit and each
    judgement is a Spark job over all rows of its days.  The rows are made once for all of them.
    """
    spark = rows.sparkSession
    rows = written_once(models.training_rows_with(rows, ("product_id", "date")))
    out = []
    for fold, (cut, end) in enumerate(origins(rows, folds)):
        train, test = rows.filter(F.col("date") < F.lit(cut)), rows.filter(F.col("date") >= F.lit(cut))
        if end is not None:
            test = test.filter(F.col("date") < F.lit(end))
        stop = cut_dates(train, [1 - STOP_SHARE])
        older, newer = (train.filter(F.col("date") < F.lit(stop[0])), train.filter(F.col("date") >= F.lit(stop[0]))) if stop else (train, train)
        fitted = {"boosted": models.train_demand(older, newer, max_trees=max_trees), "forest": models.train_forest(train, trees=forest_trees)}
        judged = metrics.naive_forecast(train, test)
        naive = metrics.regression_metrics(judged, models.TARGET, "naive_pred").select(F.col("mape").alias("naive_mape"))
        packed = naive.select(F.struct("naive_mape").alias("s")).scalar()
        for learner, model in fitted.items():
            errors = metrics.regression_metrics(models.predict(judged, model), models.TARGET, "prediction").withColumn("s", packed)
            out.append(errors.select(
                F.lit(fold).alias("fold"), F.lit(cut).alias("origin"), F.lit(learner).alias("learner"), "n_rows", "mae", "rmse", "mape",
                F.col("s.naive_mape").alias("naive_mape"), (F.col("mape") < F.col("s.naive_mape")).alias("beats_naive"), F.lit(iterations(model)).alias("trees"),
            ))
    if not out:
        return spark.createDataFrame([], "fold int, origin date, learner string, n_rows long, mae double, rmse double, mape double, naive_mape double, beats_naive boolean, trees int")
    return reduce(DataFrame.unionByName, out)


def compared_importances(spark: SparkSession, fitted: dict[str, PipelineModel]) -> DataFrame:
    """Importance of every feature for every learner, in one table."""
    parts = [models.feature_importance(spark, model).withColumn("learner", F.lit(name)) for name, model in fitted.items()]
    return reduce(DataFrame.unionByName, parts)
