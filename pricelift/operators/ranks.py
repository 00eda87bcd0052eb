"""Exact order statistics per key, whatever the number of rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Accuracy of the sketch that finds the neighbourhood of the middle, and how many times its error that reaches to either side.
ACCURACY, MARGIN = 10_000, 10


def lower_median_by(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """The lower median of a number per key, exact at any size; nulls and NaN do not count.

    A mergeable sketch gives two values of each key between which the middle row lies: its error is 1/ACCURACY of the
    rows, and they stand MARGIN times that away from it.  Then values below them are counted and values between them
    are counted by value, both map-side; only those, one in 500 of a key's different values, are ordered.
    """
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    values = df.select(F.col(key).alias("k"), v.alias("v")).filter(F.col("v").isNotNull())
    reach = MARGIN / ACCURACY
    bounds = values.groupBy(F.col("k").alias("k2")).agg(
        F.percentile_approx("v", F.array(F.lit(0.5 - reach), F.lit(0.5 + reach)), ACCURACY).alias("near"),
        F.floor((F.count(F.lit(1)) + 1) / 2).cast("long").alias("rank"),
    )
    near = values.join(bounds, F.col("k").eqNullSafe(F.col("k2"))).filter(F.col("v") <= F.col("near")[1])
    # everything below the neighbourhood is one group, which comes first
    inside = F.when(F.col("v") >= F.col("near")[0], F.col("v"))
    counted = near.groupBy("k", inside.alias("v")).agg(F.count(F.lit(1)).alias("n"), F.first("rank").alias("rank"))
    end = F.sum("n").over(Window.partitionBy("k").orderBy(F.asc_nulls_first("v")))
    middle = counted.withColumn("end", end).filter((F.col("end") >= F.col("rank")) & (F.col("end") - F.col("n") < F.col("rank")))
    return middle.select(F.col("k").alias(key), F.col("v").alias(alias))
