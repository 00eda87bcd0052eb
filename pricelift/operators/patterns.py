"""Purchase behaviour per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import retail
from ..functions.numeric import ratio, round_to
from .joins import distinct_products


def purchase_patterns(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order counts, reorder rate, cart position, usual hour and day, loyalty and frequency.

    Lines are reduced to one row per product and order first; figures, hours and days are plain sums over these
    rows, combined map-side, with at most 24 hours and 7 days to a product.  Everything else, names
    included, joins at one row per product, so a product with a third of all lines never has its
    lines in one task.
    """
    attributes = orders.select("order_id", "order_dow", "order_hour_of_day", "days_since_prior_order")
    per_order = lines.join(attributes, "order_id", "left").groupBy(
        "product_id", "order_id", "order_dow", "order_hour_of_day", "days_since_prior_order"
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("reordered").alias("_reordered"), F.count("reordered").alias("_r"),
        F.sum("add_to_cart_order").alias("_cart"), F.count("add_to_cart_order").alias("_c"),
    )

    def mean(total: str, n: str) -> Column:
        return ratio(F.sum(total).cast("double"), F.sum(n))

    gap = F.when(F.col("days_since_prior_order").isNotNull(), F.col("_n"))
    stats = per_order.groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("_n").alias("total_units"),
        mean("_reordered", "_r").alias("reorder_rate"),
        mean("_cart", "_c").alias("avg_cart_position"),
        ratio(F.sum(F.col("days_since_prior_order") * gap).cast("double"), F.sum(gap)).alias("avg_days_between_orders"),
    )

    def peak(column: str, alias: str) -> DataFrame:
        """The value on most lines of a product, the smallest on ties."""
        counts = per_order.filter(F.col(column).isNotNull()).groupBy("product_id", column).agg(F.sum("_n").alias("_k"))
        return counts.groupBy("product_id").agg(F.max_by(column, F.struct("_k", -F.col(column))).alias(alias))

    for column, alias in (("order_hour_of_day", "peak_hour"), ("order_dow", "peak_day")):
        stats = stats.join(peak(column, alias), "product_id", "left")
    stats = stats.join(distinct_products(products), "product_id", "left")
    loyalty = round_to(retail.loyalty_index("reorder_rate", "avg_cart_position"), 1)
    return stats.withColumn("loyalty_index", loyalty).withColumns({
        "purchase_frequency": retail.frequency_band("total_orders"),
        "reorder_rate": round_to("reorder_rate", 3),
        "avg_cart_position": round_to("avg_cart_position", 3),
        "avg_days_between_orders": round_to("avg_days_between_orders", 3),
    })
