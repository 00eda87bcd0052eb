"""The driver's tables seen as retail tables.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
table; only the columns it names are read.  Money is DECIMAL until the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import retail
from ..operators.features import lay_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _price(name: str = "p_retailprice") -> Column:
    return F.col(name).cast("decimal(10,2)")


def _cost() -> Column:
    share = ((F.lit(45) + F.col("p_partkey") % 21) * F.lit(0.01).cast("decimal(4,2)")).cast("decimal(4,2)")
    return (_price() * share).cast("double")


def sales(spark: SparkSession, sf_dir: str, by_product: bool = False) -> DataFrame:
    """Product x day sales, unique on (product_id, date); ``by_product`` lays them out by product, for plans that do so anyway.

    Tasks then have a bounded number of rows.  How many lines there are is read from the ends of the files.

    The group-by combines map-side, so a product with a third of all order lines
    leaves at most one row per day; later per-product windows stay that small.
    """
    lines = table(spark, sf_dir, "lineitem")
    daily = (
        lines.groupBy(F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("q"),
            F.max(F.col("l_discount").cast("decimal(4,2)")).alias("disc"),
            F.max((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")) % 101).alias("inv"),
            F.min("l_orderkey").alias("transaction_id"),
            F.min("l_suppkey").alias("store_id"),
        )
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("department"), _price().alias("price"), _cost().alias("cost_price"),
    )
    if by_product:
        daily = lay_out(daily, lines.count())
    # a packed file of millions of products looks small enough to broadcast, but is not for the driver that unpacks it
    return daily.join(part.hint("merge") if by_product else part, "product_id").select(
        "transaction_id", "product_id", "product_name", "department", "date",
        cal.festival("date").alias("festival_flag"),
        F.col("price").cast("double").alias("base_price"),
        (F.col("disc") * 100).cast("double").alias("discount_pct"),
        (F.col("price") * (F.lit(1).cast("decimal(4,2)") - F.col("disc"))).cast("double").alias("current_price"),
        "cost_price",
        F.col("inv").cast("long").alias("inventory_level"),
        F.least(F.lit(1.0), F.col("inv") / F.lit(100.0)).alias("inventory_ratio"),
        F.col("q").cast("long").alias("units_sold"),
        "store_id",
    )


def sales_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales`` with the calendar, money and hour columns: the 20-column sales table."""
    base = sales(spark, sf_dir, by_product=True)
    return base.select(
        "*",
        cal.day_of_week("date").alias("day_of_week"),
        cal.is_weekend("date").alias("is_weekend"),
        F.month("date").alias("month"),
        (F.lit(8) + F.col("transaction_id") % 13).cast("int").alias("peak_hour"),
        retail.revenue("units_sold", "current_price").alias("revenue"),
        retail.profit("units_sold", "current_price", "cost_price").alias("profit"),
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales`` with the faults that cleaning has to find; dates are text."""
    return sales(spark, sf_dir).select(
        "transaction_id", "product_id", "product_name",
        F.when(F.col("product_id") % 41 == 0, None).otherwise(F.col("department")).alias("department"),
        F.when(F.col("transaction_id") % 31 == 0, "not a date")
        .otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        "current_price",
        F.when(F.col("product_id") % 97 == 0, F.col("base_price") * 1.2)
        .when(F.col("product_id") % 89 == 0, None)
        .otherwise(F.col("cost_price")).alias("cost_price"),
        F.when(F.col("transaction_id") % 53 == 0, F.lit(-1)).otherwise(F.col("units_sold")).alias("units_sold"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("aisle"), F.col("p_type").alias("department"),
        F.col("p_retailprice").alias("base_price"), _cost().alias("cost_price"),
        F.col("p_size").alias("shelf_life_days"),
        F.when(F.col("p_size") <= 14, 1).otherwise(0).alias("is_perishable"),
    )


def catalog_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 11-column catalog."""
    return catalog(spark, sf_dir).select(
        "product_id", "product_name", "aisle", "department", "base_price", "cost_price",
        retail.gross_margin("base_price", "cost_price").alias("gross_margin_pct"),
        "shelf_life_days", "is_perishable",
        F.lit(1).cast("long").alias("store_id"),
        F.lit("2024-01-01").cast("date").alias("created_date"),
    )


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).withColumn(
        "department", F.when(F.col("product_id") % 41 == 0, None).otherwise(F.col("department"))
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product rows that point at an aisle and a department by id."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("long").alias("aisle_id"),
        F.length("p_type").cast("long").alias("department_id"),
    )


def aisles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part").select(F.col("p_brand").alias("aisle")).distinct()
        .select(F.regexp_extract("aisle", r"(\d+)", 1).cast("long").alias("aisle_id"), "aisle")
    )


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One department per type-name length (the first name in order)."""
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.length("p_type").cast("long").alias("department_id"))
        .agg(F.min("p_type").alias("department"))
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.when(F.col("o_orderstatus") == "F", "train").otherwise("prior").alias("eval_set"),
        F.weekday("o_orderdate").alias("order_dow"),
        (F.col("o_orderkey") % 24).cast("int").alias("order_hour_of_day"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order x product rows with a reorder flag.

    A line is a reorder unless it is the user's first of that product.  The first one
    is found by aggregation, so no task has to hold all lines of a busy user.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
        .agg(F.min("l_linenumber").alias("add_to_cart_order"))
    )
    keyed = lines.join(orders(spark, sf_dir).select("order_id", "user_id", "order_date"), "order_id")
    first = keyed.groupBy("user_id", "product_id").agg(
        F.min_by("order_id", F.struct("order_date", "order_id")).alias("first_order_id")
    )
    return keyed.join(first, ["user_id", "product_id"]).select(
        "order_id", "product_id", "add_to_cart_order",
        (F.col("order_id") != F.col("first_order_id")).cast("int").alias("reordered"),
    )


def price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
        .select(
            "event_id", F.col("user_id").alias("product_id"),
            (F.lit(1) + F.col("event_id") % 5).cast("int").alias("units_sold"),
            (F.lit(1.0) + F.col("value")).alias("current_price"),
            ((F.col("event_id") % 101) / F.lit(100.0)).alias("inventory_ratio"),
            F.col("ts").cast("timestamp").alias("event_time"),
        )
    )


def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events as (key, value) text; some are broken, lack an id or a readable time."""
    e = table(spark, sf_dir, "events")
    ident = F.col("event_id")
    body = F.format_string(
        '{"product_id": %s, "units_sold": %d, "current_price": %s, "inventory_ratio": %s, "timestamp": "%s"}',
        F.when(ident % 17 == 0, "null").otherwise(F.col("user_id").cast("string")),
        F.lit(1) + ident % 5,
        (F.lit(1) + ident % 40).cast("string"),
        ((ident % 101) / F.lit(100.0)).cast("string"),
        F.when(ident % 19 == 0, "yesterday").otherwise(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")),
    )
    return e.select(
        ident.cast("string").alias("key"),
        F.when(ident % 23 == 0, F.lit("{broken")).otherwise(body).alias("value"),
    )


def lookup_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product lookup that reaches every pricing branch."""
    pk = F.col("p_partkey")
    cents = F.lit(0.01).cast("decimal(4,2)")
    return table(spark, sf_dir, "part").select(
        pk.alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("department"),
        F.col("p_retailprice").alias("base_price"),
        (_price() * ((F.lit(95) + pk % 8) * cents).cast("decimal(4,2)")).cast("double").alias("current_price"),
        (_price() * ((F.lit(3) + pk % 89) * cents).cast("decimal(4,2)")).cast("double").alias("cost_price"),
        F.when(pk % 13 == 0, None).otherwise(-(pk % 50 + 1) / F.lit(10.0)).cast("double").alias("price_elasticity"),
        F.when(pk % 3 == 0, "Low").when(pk % 3 == 1, "Medium").otherwise("High").alias("price_sensitivity_category"),
        F.when(pk % 5 == 0, "Critical").when(pk % 5 == 1, "Low").otherwise("Normal").alias("stock_urgency_category"),
        F.when((F.col("p_size") < 14) & (pk % 2 == 0), 1).otherwise(0).alias("expiry_risk_flag"),
        (pk % 101).alias("inventory_level"),
        ((pk % 101) / F.lit(100.0)).alias("inventory_ratio"),
        F.when(pk % 53 == 0, 0).otherwise(F.lit(5) + pk % 76).cast("double").alias("baseline_demand"),
    )
