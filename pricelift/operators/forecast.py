"""Trend projection, seasonal indices and the seasonal factor."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import calendar as cal
from ..functions.numeric import clip, round_to

MIN_HISTORY_ROWS = 10
MODEL_NAME = "trend_seasonal"


def forecast_project(
    recent: DataFrame, prices: DataFrame, start: dt.date, days: int = 30,
    confidence: Column | None = None,
) -> DataFrame:
    """Daily forecast per product from ``features.recent_stats``.

    ``recent`` is product grain; the horizon is exploded from a constant sequence, so
    the rows stay in their partition.  Products with too little history are left out.
    """
    base = recent.filter(F.col("recent_rows") >= MIN_HISTORY_ROWS).join(prices, "product_id", "left")
    df = base.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    df = df.withColumn("forecast_date", F.date_add(F.lit(start), F.col("_i")))
    october = (10,)
    level = (
        F.col("avg_daily") * cal.season_factor("forecast_date", october)
        * (F.lit(1.0) + F.col("trend") * (F.col("_i") / F.lit(float(days))))
    )
    df = df.withColumn("_units", F.greatest(F.lit(0.0), level))
    labels = [c for c in ("product_name", "department", "store_id") if c in prices.columns]
    return df.select(
        "product_id", *labels, "forecast_date",
        cal.day_of_week("forecast_date").alias("day_of_week"),
        cal.is_weekend("forecast_date").alias("is_weekend"),
        F.month("forecast_date").alias("month"),
        cal.festival("forecast_date", october).alias("festival_flag"),
        round_to("_units", 1).alias("predicted_units"),
        round_to(F.greatest(F.lit(0.0), F.col("_units") - F.col("std_daily")), 1).alias("predicted_units_lower"),
        round_to(F.col("_units") + F.col("std_daily"), 1).alias("predicted_units_upper"),
        "recommended_price",
        round_to(F.col("_units") * F.col("recommended_price"), 2).alias("predicted_revenue"),
        (confidence if confidence is not None else F.lit(None)).cast("double").alias("confidence_pct"),
        F.lit(MODEL_NAME).alias("model_used"),
    )


#: Day the trend counts from, and the half width of the band in deviations (80 % of a normal distribution).
TREND_ORIGIN = dt.date(2000, 1, 1)
BAND_DEVIATIONS = 1.2816


def seasonal_index(sales: DataFrame) -> DataFrame:
    """Weekday, month and festival indices, trend and spread per product, as rows (kind, bucket, mean_units, seasonal_index).

    ``all`` is the mean of regular days (of all days, if a product has none); weekday and month indices are means of
    regular days over it, so festival sales do not leak into October and December; the ``festival`` index is the mean of
    festival days over it.  ``trend`` is the least-squares slope in units a day, ``centre`` the mean day it turns about, and ``spread``
    the deviation of units.  Units are first summed to product x weekday x month x festival (168 rows
    at most); each of these counts for its product, weekday, month and festival, and every product is "trained" in the same two
    aggregates.  All steps go by product, so rows that lie by product (``features.lay_out``) are not exchanged again.
    """
    x, u = F.datediff("date", F.lit(TREND_ORIGIN)).cast("long"), F.col("units_sold")
    cells = sales.filter(F.col("date").isNotNull() & u.isNotNull()).groupBy(
        "product_id", F.weekday("date").alias("weekday"), F.month("date").alias("month"), F.col("festival_flag").alias("festival")
    ).agg(
        F.sum(u).alias("units"), F.count(u).alias("rows"), F.sum(x).alias("sx"), F.sum(x * x).alias("sxx"),
        F.sum(x * u).alias("sxy"), F.sum(u * u).alias("syy"),
    )
    regular = F.coalesce("festival", F.lit(0)) == 0
    sums = ("units", "rows", "sx", "sxx", "sxy", "syy")
    none = F.lit(None).cast("int")
    places = [("all", none), *[(k, F.col(k).cast("int")) for k in ("weekday", "month", "festival")]]
    levels = cells.select(
        "product_id", *sums, F.when(regular, F.col("units")).alias("reg_units"), F.when(regular, F.col("rows")).alias("reg_rows"),
        F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), b.alias("bucket")) for k, b in places])),
    ).filter((F.col("kind") != "festival") | (F.col("bucket") == 1)).groupBy("product_id", "kind", "bucket").agg(
        *[F.sum(c).cast("double").alias(c) for c in (*sums, "reg_units", "reg_rows")])
    every, usual = F.try_divide("units", "rows"), F.try_divide("reg_units", "reg_rows")
    n, sx, sy, sxx, sxy, syy = (F.col(c) for c in ("rows", "sx", "units", "sxx", "sxy", "syy"))
    slope = F.coalesce(F.try_divide(n * sxy - sx * sy, n * sxx - sx * sx), F.lit(0.0))
    spread = F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (syy - sy * sy / n) / (n - 1))))

    def row(name: Column, bucket: Column, value: Column) -> Column:
        return F.struct(name.alias("kind"), bucket.alias("bucket"), value.alias("mean_units"))

    of_all = [row(F.lit(k), none, v) for k, v in (("all", F.coalesce(usual, every)), ("trend", slope), ("centre", sx / n), ("spread", spread))]
    rows = (
        F.when(F.col("kind") == "all", F.array(*of_all))
        .when(F.col("kind") == "festival", F.array(row(F.col("kind"), F.col("bucket"), every)))
        .when(usual.isNotNull(), F.array(row(F.col("kind"), F.col("bucket"), usual)))
    )
    tagged = levels.select("product_id", F.inline(rows))
    overall = F.max(F.when(F.col("kind") == "all", F.col("mean_units"))).over(Window.partitionBy("product_id"))
    index = F.when(~F.col("kind").isin("trend", "centre", "spread"), F.try_divide(F.col("mean_units"), overall))
    return tagged.withColumn("seasonal_index", index)


def seasonal_forecast(index: DataFrame, start: dt.date, days: int = 30) -> DataFrame:
    """Expected units per product and day with their band: (level and trend) x weekday x month x festival index.

    The indices of one product are gathered into two maps (7 and 12 entries at most)."""
    entry = F.struct("bucket", "seasonal_index")

    def value(kind: str, column: str = "mean_units") -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    maps = index.groupBy("product_id").agg(
        value("all").alias("level"), value("trend").alias("_slope"), value("centre").alias("_centre"), value("spread").alias("_sd"),
        value("festival", "seasonal_index").alias("_f"),
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "weekday", entry))).alias("_w"),
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "month", entry))).alias("_m"),
    )
    df = maps.withColumn("ds", F.explode(F.sequence(F.lit(start), F.lit(start + dt.timedelta(days=days - 1)))))
    trended = F.col("level") + F.col("_slope") * (F.datediff("ds", F.lit(TREND_ORIGIN)) - F.col("_centre"))
    yhat = F.greatest(F.lit(0.0), (
        trended
        * F.coalesce(F.try_element_at("_w", F.weekday("ds")), F.lit(1.0))
        * F.coalesce(F.try_element_at("_m", F.month("ds")), F.lit(1.0))
        * F.when(cal.festival("ds") == 1, F.coalesce("_f", F.lit(1.0))).otherwise(F.lit(1.0))
    ))
    half = F.lit(BAND_DEVIATIONS) * F.coalesce("_sd", F.lit(0.0))
    return df.select(
        "product_id", "ds", yhat.alias("yhat"), F.greatest(F.lit(0.0), yhat - half).alias("yhat_lower"), (yhat + half).alias("yhat_upper")
    )


def seasonal_factor(forecast: DataFrame) -> DataFrame:
    """First day's forecast over the mean forecast, in [0.5, 2]; 1 when the mean is not positive."""
    means = forecast.groupBy("product_id").agg(
        F.min_by("yhat", "ds").alias("_first"), F.avg("yhat").alias("_mean")
    )
    factor = F.when(F.col("_mean") > 0, F.col("_first") / F.col("_mean")).otherwise(F.lit(1.0))
    return means.select("product_id", clip(factor, 0.5, 2.0).alias("seasonal_factor"))


def ensemble_demand(df: DataFrame, tree: str = "tree_demand", seasonal: str = "mean_yhat") -> DataFrame:
    """60 % tree model, 40 % seasonal model, whole units."""
    mixed = F.lit(0.6) * F.col(tree) + F.lit(0.4) * F.col(seasonal)
    return df.withColumn("ensemble_demand", F.greatest(F.lit(0.0), F.rint(mixed)))
