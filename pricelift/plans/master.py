"""The wide product x day feature table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features
from ..operators.joins import join_dim, rename_collisions


def build_master(
    sales: DataFrame, catalog: DataFrame, elasticity: DataFrame, optimal: DataFrame, forecast: DataFrame,
    optimal_key: str = "product_id",
) -> DataFrame:
    """76 columns per sales row, from cleaned tables unique per product and day.

    Sales are exchanged on product_id once: the rolling windows, the product total, the
    weekend and festival ratios and every dimension join reuse that partitioning and its
    sort.  A product has one row per day at most, so no task can be overrun.  Joining
    ``optimal`` by product_name is possible but refused when names repeat.  The dimensions grow with the
    products and meet sales where they lie; none is gathered by the driver, whatever the size of its files.
    """
    catalog, elasticity, optimal = (t.hint("merge") for t in (catalog, elasticity, optimal))
    master = features.rolling_features(sales)
    master = features.with_total(master)
    master = features.with_conditional_ratio(master, "is_weekend", "units_sold", "weekend_demand_boost")
    master = features.with_conditional_ratio(
        master, "festival_flag", "units_sold", "festival_demand_multiplier", default=1.0
    )
    master = join_dim(master, catalog, "product_id", "_cat")
    master = join_dim(master, elasticity, "product_id", "_elas")
    master = join_dim(master, optimal, optimal_key, "_opt", require_unique=optimal_key != "product_id")
    master = join_dim(master, features.forecast_summary(forecast).hint("merge"), "product_id")
    return features.business_features(master)


def build_master_busy(
    sales: DataFrame, catalog: DataFrame, elasticity: DataFrame, optimal: DataFrame, forecast: DataFrame,
    order: tuple[str, ...] = ("date", "transaction_id"), busy_rows: int = features.BUSY_ROWS,
) -> DataFrame:
    """The same table from sales with many rows per product and day.

    One product may then hold a third of all rows.  Whole rows of sales are exchanged once: a product with more than
    ``busy_rows`` rows by month, where the windows run with the rows before the month, any other whole.  The product
    tables, joined with each other, are laid out per month for the busy products alone, so no other product's columns are
    copied, and meet sales under the same partitioning.  Tails, totals and months are read from sales apart, a few
    columns each, and combine map-side.  Whether any product is busy is counted first: if none is, there is nothing to split, and sales that
    lie by product are not exchanged at all.
    """
    months = features.busy_months(sales, busy_rows)
    busy = not months.isEmpty()
    chunked = features.with_busy_chunk(sales, months)
    rolled = features.rolled_chunks(chunked, order=order, keep_chunk=True, divided=busy and F.col(features.CHUNK) != features.UNDIVIDED)
    parts = [features.product_figures(sales)]
    taken = [*rolled.columns, *parts[0].columns]
    for table, suffix in ((catalog, "_cat"), (elasticity, "_elas"), (optimal, "_opt"), (features.forecast_summary(forecast), "")):
        parts.append(rename_collisions(taken, table, "product_id", suffix))
        taken += parts[-1].columns
    # the figures have a row for every product in sales, so left joins lose nothing
    product = reduce(lambda left, right: left.join(right.hint("merge"), "product_id", "left"), parts)
    if not busy:
        return features.business_features(rolled.drop(features.CHUNK).join(product.hint("merge"), "product_id", "left"))
    laid_out = product.join(F.broadcast(months), F.col("product_id").eqNullSafe(F.col("_product")), "left")
    by_month = laid_out.withColumn(features.CHUNK, F.coalesce("_month", F.lit(features.UNDIVIDED))).drop("_product", "_month")
    joined = rolled.join(by_month, ["product_id", features.CHUNK], "left").drop(features.CHUNK)
    return features.business_features(joined)
