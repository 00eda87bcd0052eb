"""Derived tables that several registered queries start from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import elasticity as el
from ..operators import features, forecast as fc, metrics, pricing
from ..plans import batch
from ..sources import testdata as td
from ..streaming import events

FORECAST_START = dt.date(2001, 10, 10)
SPLIT_DATE = "2000-06-01"


def weekly(spark: SparkSession, sf: str) -> DataFrame:
    return features.weekly_demand(td.sales_full(spark, sf))


def elasticity(spark: SparkSession, sf: str) -> DataFrame:
    return el.elasticity_table(features.weekly_features(weekly(spark, sf)), td.catalog(spark, sf))


def lerner(spark: SparkSession, sf: str) -> DataFrame:
    return el.lerner_price(elasticity(spark, sf))


def elasticity_raw(spark: SparkSession, sf: str) -> DataFrame:
    pid = F.col("product_id")
    return lerner(spark, sf).withColumns({
        "recommended_optimal_price": F.when(pid % 29 == 0, F.lit(float("inf"))).otherwise(F.col("recommended_optimal_price")),
        "department": F.when(pid % 41 == 0, None).otherwise(F.col("department")),
    })


def stock(spark: SparkSession, sf: str) -> DataFrame:
    names = td.catalog(spark, sf).select(
        "product_id", "product_name", "department", F.col("base_price").alias("current_price"), "cost_price"
    )
    return el.latest_stock(td.sales(spark, sf, by_product=True)).drop("snapshot_date").join(names, "product_id")


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return el.inventory_status(stock(spark, sf))


def optimal(spark: SparkSession, sf: str) -> DataFrame:
    return el.price_grid(lerner(spark, sf), inventory(spark, sf))


def derived(spark: SparkSession, sf: str) -> batch.DerivedTables:
    return batch.derive_tables(td.sales_full(spark, sf), td.catalog_full(spark, sf), FORECAST_START)


def kept(spark: SparkSession, sf: str) -> Callable[[DataFrame], DataFrame]:
    """Writes a table that goes by product and reads it again, in as many parts as the sales of the order lines."""
    rows = td.table(spark, sf, "lineitem").count()
    return lambda df: features.kept_by(df, rows)


def forecast(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf).forecast


def forecast_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast rows with unordered and empty bands and missing flags."""
    pid, units = F.col("product_id"), F.col("predicted_units")
    return forecast(spark, sf).select(
        "product_id", "forecast_date",
        F.when(pid % 6 == 0, None).otherwise(F.col("festival_flag")).alias("festival_flag"),
        F.when(pid % 37 == 0, units + 1).when(pid % 43 == 0, 0.0).otherwise(F.col("predicted_units_lower")).alias("predicted_units_lower"),
        F.when(pid % 43 == 0, 0.0).otherwise(units).alias("predicted_units"),
        F.when(pid % 43 == 0, 0.0).otherwise(F.col("predicted_units_upper")).alias("predicted_units_upper"),
    )


def seasonal_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return fc.seasonal_forecast(fc.seasonal_index(td.sales(spark, sf, by_product=True)), FORECAST_START)


def edge_priced(spark: SparkSession, sf: str) -> DataFrame:
    return pricing.optimize_price(td.lookup_edge(spark, sf))


def edge_results(spark: SparkSession, sf: str) -> DataFrame:
    return pricing.score_prices(edge_priced(spark, sf), keep=("price_elasticity", "price_sensitivity_category"))


def pricing_input(spark: SparkSession, sf: str) -> DataFrame:
    response = elasticity(spark, sf).select(
        "product_id", "price_sensitivity_category", F.col("avg_price_elasticity").alias("price_elasticity")
    )
    return batch.pricing_input(td.sales(spark, sf, by_product=True), td.catalog(spark, sf), response)


def shop_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results of the whole pipeline on sales."""
    return pricing.price_products(pricing_input(spark, sf), keep=("price_elasticity", "price_sensitivity_category"))


def train_and_test(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    sales = td.sales(spark, sf)
    return sales.filter(F.col("date") < SPLIT_DATE), sales.filter(F.col("date") >= SPLIT_DATE)


def with_predictions(train: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with the naive forecast and a fixed stand-in for a model."""
    overall = train.agg(F.avg("units_sold").alias("m")).scalar()
    return metrics.naive_forecast(train, rows).withColumn(
        "prediction", F.lit(0.8) * F.col("naive_pred") + F.lit(0.2) * overall
    )


def windows(spark: SparkSession, sf: str, width: str = "1 hour") -> DataFrame:
    return events.flat_window(events.tumbling_demand(td.price_events(spark, sf), width))


def event_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Lookup that knows two thirds of the products."""
    return td.lookup_edge(spark, sf).filter(F.col("product_id") % 3 != 1)
