"""Joins that keep the grain of the left side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_collisions(
    left: DataFrame | Sequence[str], right: DataFrame, on: str, suffix: str
) -> DataFrame:
    """``right`` with the columns that ``left`` also has suffixed; the key keeps its name."""
    names = left.columns if isinstance(left, DataFrame) else left
    taken = set(names) - {on}
    return right.select([F.col(c).alias(c + suffix if c in taken else c) for c in right.columns])


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def join_dim(
    left: DataFrame, dim: DataFrame, on: str, suffix: str = "", require_unique: bool = False
) -> DataFrame:
    """Left join of a dimension.

    No broadcast hint: Catalyst and AQE broadcast a side whose measured size is below
    the threshold, and split skewed partitions of the fact side otherwise.
    ``require_unique`` refuses a key that would fan rows out.
    """
    if require_unique and not repeated_keys(dim, on).isEmpty():
        raise ValueError(f"{on} is not unique on the right side; the join would multiply rows")
    return left.join(rename_collisions(left, dim, on, suffix), on, "left")


def catalog_build(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """Products with the names of their aisle and department; rows without both are dropped."""
    return (
        products.join(aisles, "aisle_id").join(departments, "department_id")
        .select("product_id", "product_name", "aisle_id", "department_id", "aisle", "department")
    )


def orders_in_set(lines: DataFrame, orders: DataFrame, eval_set: str = "train") -> DataFrame:
    """Order lines whose order belongs to the set."""
    wanted = orders.filter(F.col("eval_set") == eval_set).select("order_id")
    return lines.join(wanted, "order_id", "left_semi")


def enrich_lines(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with order attributes and the product name."""
    attributes = orders.select(
        "order_id", "user_id", "order_dow", "order_hour_of_day", "days_since_prior_order"
    )
    return lines.join(attributes, "order_id", "left").join(
        products.select("product_id", "product_name"), "product_id", "left"
    )


def new_products(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """Product ids seen in events but absent from the lookup."""
    return events.select("product_id").distinct().join(
        lookup.select("product_id"), "product_id", "left_anti"
    )


def distinct_products(df: DataFrame) -> DataFrame:
    """One row per product id, with the first name in order."""
    return df.groupBy("product_id").agg(F.min("product_name").alias("product_name"))


def point_lookup(requests: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Recommendation for each requested id; ``found`` is false for an unknown one."""
    marked = recommendations.withColumn("_hit", F.lit(True))
    out = requests.join(marked, "product_id", "left")
    return out.withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")


def fold_back(
    master: DataFrame, log: DataFrame, consumed: DataFrame | None = None
) -> DataFrame:
    """Append logged rows to the master table; columns the log lacks become null.

    Batches listed in ``consumed`` were folded in before and are skipped, which makes
    the step repeatable: nothing has to be deleted from the log.
    """
    fresh = log
    if consumed is not None:
        fresh = log.join(consumed.select("batch_id").distinct(), "batch_id", "left_anti")
    if "batch_id" in fresh.columns and "batch_id" not in master.columns:
        fresh = fresh.drop("batch_id")
    known = set(master.columns)
    fresh = fresh.select([F.col(c) for c in fresh.columns if c in known])
    return master.unionByName(fresh, allowMissingColumns=True)
