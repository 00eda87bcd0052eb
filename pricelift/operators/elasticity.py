"""Product elasticity, the markup rule, stock status and the price grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import demand, retail
from ..functions.numeric import ratio, round_to

MIN_WEEKS = 3


def elasticity_table(weekly: DataFrame, catalog: DataFrame, min_weeks: int = MIN_WEEKS) -> DataFrame:
    """Median elasticity per product with enough usable weeks; mean demand and profit over
    those weeks only.  A product has at most one row per week, which bounds the median."""
    usable = weekly.filter(F.col("price_elasticity_est").isNotNull())
    stats = (
        usable.groupBy("product_id").agg(
            F.count(F.lit(1)).alias("_weeks"),
            F.median("price_elasticity_est").alias("_median"),
            F.avg("weekly_units_sold").alias("avg_weekly_demand"),
            F.avg("weekly_profit").alias("current_weekly_profit"),
        )
        .filter(F.col("_weeks") >= min_weeks)
    )
    return stats.join(catalog, "product_id").select(
        "product_id", "product_name", "department", "cost_price",
        F.col("base_price").alias("current_base_price"),
        round_to("_median", 3).alias("avg_price_elasticity"),
        retail.sensitivity_class("_median").alias("price_sensitivity_category"),
        "avg_weekly_demand", "current_weekly_profit",
    )


def lerner_price(df: DataFrame) -> DataFrame:
    """Markup rule c / (1 + 1/e) with a 5 % margin floor, and the demand and profit there.

    e = -1 has no finite optimum and gives null; -1 < e gives the floor.
    """
    e = demand.lerner_elasticity("avg_price_elasticity")
    cost, base = F.col("cost_price"), F.col("current_base_price")
    formula = round_to(ratio(cost, F.lit(1.0) + F.lit(1.0) / e), 2)
    price = F.when(formula.isNotNull(), F.greatest(cost * F.lit(demand.MIN_MARKUP), formula))
    priced = df.withColumn("recommended_optimal_price", price)
    at_price = F.floor(demand.power_demand("recommended_optimal_price", base, "avg_weekly_demand", e)).cast("double")
    with_demand = priced.withColumn("predicted_demand_at_optimal", at_price)
    gain = round_to(F.col("predicted_demand_at_optimal") * (F.col("recommended_optimal_price") - cost), 2)
    out = with_demand.withColumns({
        "expected_weekly_profit_at_optimal": gain,
        "current_weekly_profit": round_to("current_weekly_profit", 2),
    })
    improvement = (
        (F.col("expected_weekly_profit_at_optimal") - F.col("current_weekly_profit"))
        / F.greatest(F.lit(1.0), F.col("current_weekly_profit")) * F.lit(100.0)
    )
    return out.select(
        "product_id", "product_name", "department", "cost_price", "current_base_price",
        "avg_price_elasticity", "price_sensitivity_category", "recommended_optimal_price",
        round_to("avg_weekly_demand", 1).alias("avg_weekly_demand"),
        "predicted_demand_at_optimal", "expected_weekly_profit_at_optimal",
        "current_weekly_profit", round_to(improvement, 1).alias("profit_improvement_pct"),
    )


def latest_stock(sales: DataFrame) -> DataFrame:
    """Newest stock level and mean daily sales per product, in one aggregate."""
    return sales.groupBy("product_id").agg(
        F.max_by("inventory_level", "date").alias("current_stock_units"),
        F.avg("units_sold").alias("daily_avg_sales"),
        F.max("date").alias("snapshot_date"),
    )


def inventory_status(stock: DataFrame) -> DataFrame:
    """Days of cover, urgency, advice and reorder figures."""
    units, daily = F.col("current_stock_units"), F.col("daily_avg_sales")
    days = F.when(daily > 0, units / daily).otherwise(F.lit(99.0))
    return (
        stock.withColumn("_days", days)
        .withColumn("stock_urgency", retail.stock_urgency("_days"))
        .withColumns({
            "days_of_stock_remaining": round_to("_days", 1),
            "reorder_point_units": daily * 7,
            "reorder_quantity": daily * 30,
            "needs_reorder": F.when(units <= daily * 7, 1).otherwise(0),
            "pricing_recommendation": retail.stock_advice("stock_urgency"),
            "inventory_value": round_to(units * F.col("current_price"), 2),
        })
        .drop("_days")
    )


def price_grid(elasticity: DataFrame, inventory: DataFrame, n: int = 7) -> DataFrame:
    """Best of ``n`` evenly spaced prices, then the stock adjustment.

    The grid lives in an array per row, so no row is multiplied and nothing shuffles
    beyond the product join.
    """
    df = elasticity.join(inventory.select("product_id", "stock_urgency"), "product_id", "left")
    cost, base = F.col("cost_price"), F.col("current_base_price")
    df = df.withColumns({
        "price_elasticity": demand.lerner_elasticity("avg_price_elasticity"),
        "stock_urgency": F.coalesce("stock_urgency", F.lit("NORMAL")),
        "_low": cost * F.lit(demand.MIN_MARKUP),
        "_high": base * F.lit(demand.MAX_MARKUP),
    })
    low, high = F.col("_low"), F.col("_high")

    def candidate(i):
        step = (high - low) / F.lit(float(n - 1))
        price = F.when(i == n - 1, high).otherwise(low + i.cast("double") * step)
        units = demand.power_demand(price, base, "avg_weekly_demand", "price_elasticity")
        return F.struct((units * (price - cost)).alias("profit"), (-i).alias("rank"), price.alias("price"))

    # highest profit wins, the lowest index on ties
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), candidate))
    df = df.withColumn("_best", best)
    chosen = F.when(F.col("_best.profit") > 0, F.col("_best.price")).otherwise(base)
    adjusted = (
        F.when(F.col("stock_urgency") == "EXCESS", chosen * F.lit(0.85))
        .when(F.col("stock_urgency") == "CRITICAL", chosen * F.lit(1.10))
        .otherwise(chosen)
    )
    df = df.withColumn("recommended_price", round_to(adjusted, 2))
    units = demand.power_demand("recommended_price", base, "avg_weekly_demand", "price_elasticity")
    df = df.withColumn("_units", units).withColumn("_profit", F.col("_units") * (F.col("recommended_price") - cost))
    uplift = F.col("_profit") - F.col("current_weekly_profit")
    return df.select(
        "product_id", "product_name", "department", "cost_price", base.alias("current_price"),
        "price_elasticity", F.col("price_sensitivity_category").alias("price_sensitivity"),
        "stock_urgency", "recommended_price",
        round_to((F.col("recommended_price") - base) / base * F.lit(100.0), 1).alias("price_change_pct"),
        round_to("_units", 1).alias("predicted_weekly_demand"),
        round_to(F.col("_units") * F.col("recommended_price"), 2).alias("predicted_weekly_revenue"),
        round_to("_profit", 2).alias("predicted_weekly_profit"),
        "current_weekly_profit",
        round_to(uplift, 2).alias("profit_uplift"),
        round_to(uplift / F.greatest(F.lit(1.0), F.col("current_weekly_profit")) * F.lit(100.0), 1)
        .alias("profit_uplift_pct"),
        F.format_string("Elasticity %.2f, Stock:%s", round_to("price_elasticity", 2), F.col("stock_urgency"))
        .alias("optimization_reason"),
    )
