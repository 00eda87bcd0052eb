"""Forecast error metrics and exact distribution figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numeric import finite


def naive_forecast(train: DataFrame, test: DataFrame, target: str = "units_sold") -> DataFrame:
    """Test rows with the product's training mean; the global mean for unseen products."""
    means = train.groupBy("product_id").agg(F.avg(target).alias("naive_pred"))
    overall = train.agg(F.avg(target).alias("m")).scalar()
    return test.join(means, "product_id", "left").withColumn("naive_pred", F.coalesce("naive_pred", overall))


def _pct_error(y: str, yhat: str):
    return F.abs((F.col(y) - F.col(yhat)) / (F.col(y) + 1)) * F.lit(100.0)


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """MAE, RMSE and MAPE (denominator y + 1), one aggregate."""
    error = F.col(y) - F.col(yhat)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(_pct_error(y, yhat)).alias("mape"),
    )


def mape_by_product(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.groupBy("product_id").agg(
        F.avg(_pct_error(y, yhat)).alias("mape"),
        F.min("product_name").alias("product_name"),
        F.count(F.lit(1)).alias("n_test_rows"),
    )


def worst_products(per_product: DataFrame, threshold: float = 30.0, n: int = 15) -> DataFrame:
    return (
        per_product.filter(F.col("mape") > threshold)
        .orderBy(F.col("mape").desc(), "product_id").limit(n)
    )


def counted_values(df: DataFrame, value: str) -> DataFrame:
    """Distinct values ``v`` with their counts ``n``.

    The passes over them share one exchange, so the plan behind ``df`` runs once, when the result is asked for.
    """
    known = df.select(finite(value).alias("v")).filter(F.col("v").isNotNull())
    return known.groupBy("v").agg(F.count(F.lit(1)).alias("n"))


def quantiles_of(values: DataFrame, probs: Sequence[float], cells: int = 256) -> DataFrame:
    """Exact quantiles (linear interpolation) of counted values, as ``q0``, ``q1``, ...

    ``percentile`` would gather every distinct value in one task.  Here a sketch cuts the
    values into about equal cells; the counts of the cells show which few of them hold
    the wanted ranks, and only those are put in order, each in its own task.
    """
    grid = [i / cells for i in range(1, cells)]
    cuts = values.agg(F.percentile_approx("v", grid, 10000).alias("cuts")).scalar()
    placed_in = values.withColumn("cuts", cuts).select(
        "v", "n", F.size(F.filter("cuts", lambda c: c < F.col("v"))).alias("cell")
    )
    whole = Window.partitionBy(F.lit(0))  # at most ``cells`` rows
    per_cell = placed_in.groupBy("cell").agg(F.sum("n").alias("cell_n")).withColumns({
        "before": F.sum("cell_n").over(whole.orderBy("cell")) - F.col("cell_n"),
        "total": F.sum("cell_n").over(whole),
    })

    def ranks(p: float):
        at = (F.col("total") - 1) * F.lit(float(p))
        return at, F.floor(at), F.ceil(at)

    inside = F.lit(False)
    for p in probs:
        _, low, high = ranks(p)
        for rank in (low, high):
            inside = inside | ((rank >= F.col("before")) & (rank < F.col("before") + F.col("cell_n")))
    in_cell = Window.partitionBy("cell").orderBy("v")
    ranked = placed_in.join(per_cell.filter(inside), "cell").withColumn(
        "start", F.col("before") + F.sum("n").over(in_cell) - F.col("n")
    )
    picks = []
    for i, p in enumerate(probs):
        at, low, high = ranks(p)
        for tag, rank in (("lo", low), ("hi", high)):
            hit = (rank >= F.col("start")) & (rank < F.col("start") + F.col("n"))
            picks.append(F.max(F.when(hit, F.col("v"))).alias(f"{tag}{i}"))
        picks.append(F.max(at - low).alias(f"w{i}"))
    row = ranked.agg(*picks)
    return row.select(*[
        (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"w{i}")).alias(f"q{i}")
        for i in range(len(probs))
    ])


def describe_col(df: DataFrame, value: str, above: float = 30.0) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles, maximum, and the rows above a limit."""
    quartiles = quantiles_of(counted_values(df, value), (0.25, 0.5, 0.75)).select(F.struct("q0", "q1", "q2").alias("q")).scalar()
    v = finite(value)
    spread = df.agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.count_if(v > above).alias("n_above"),
    )
    return spread.withColumn("_q", quartiles).select(
        "count", "mean", "std", "min", F.col("_q.q0").alias("p25"), F.col("_q.q1").alias("p50"),
        F.col("_q.q2").alias("p75"), "max", "n_above",
    )


def model_report(
    test: DataFrame, train: DataFrame, y: str = "units_sold", yhat: str = "prediction",
    naive: str = "naive_pred", overfit_points: float = 5.0,
) -> DataFrame:
    """Test, train and naive MAPE with the overfit and beats-naive flags, and the spread of
    the per-product error, in one row."""
    train_mape = train.agg(F.avg(_pct_error(y, yhat)).alias("m")).scalar()
    spread = describe_col(mape_by_product(test, y, yhat), "mape")
    packed = spread.select(F.struct(*spread.columns).alias("s")).scalar()
    scores = test.agg(
        F.avg(_pct_error(y, yhat)).alias("test_mape"), F.avg(_pct_error(y, naive)).alias("naive_mape")
    ).withColumn("train_mape", train_mape).withColumn("_s", packed)
    return scores.select(
        "test_mape", "train_mape", "naive_mape",
        (F.col("test_mape") - F.col("train_mape") > overfit_points).alias("overfit"),
        (F.col("test_mape") < F.col("naive_mape")).alias("beats_naive"),
        (F.col("naive_mape") - F.col("test_mape")).alias("beats_naive_by"),
        F.col("_s.p25").alias("p25"), F.col("_s.p50").alias("p50"), F.col("_s.p75").alias("p75"),
        F.col("_s.max").alias("max"), F.col("_s.n_above").alias("n_above_30"),
    )
