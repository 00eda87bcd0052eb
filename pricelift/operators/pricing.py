"""Price recommendation per product: one projection, no shuffle, no UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import demand, retail
from ..functions.numeric import ratio, round_to

RESULT_COLUMNS = (
    "product_id", "product_name", "department", "cost_price", "current_price",
    "recommended_price", "price_change_pct", "predicted_demand", "predicted_profit",
    "current_profit", "profit_uplift", "profit_uplift_pct", "spoilage_savings_estimate",
    "optimization_method", "inventory_ratio", "stock_urgency_category",
)


def _or(df: DataFrame, name: str, default: Column, kind: str | None = None) -> Column:
    """The column where it exists and is not null, the default elsewhere."""
    value = F.coalesce(F.col(name), default) if name in df.columns else default
    return value.cast(kind) if kind else value


def lookup_defaults(lookup: DataFrame) -> DataFrame:
    """Fill what pricing needs, row by row: rows folded in from the stream lack some."""
    out = lookup
    if "price_sensitivity_category" not in out.columns and "price_sensitivity" in out.columns:
        out = out.withColumn("price_sensitivity_category", F.col("price_sensitivity"))
    null_double = F.lit(None).cast("double")
    filled = {
        "base_price": _or(out, "base_price", F.col("current_price")),
        "cost_price": _or(out, "cost_price", F.col("current_price") * F.lit(0.7)),
        "inventory_level": _or(out, "inventory_level", F.lit(0)),
        "inventory_ratio": _or(out, "inventory_ratio", F.lit(0.0)),
        "product_name": _or(out, "product_name", F.concat(F.lit("Product_"), F.col("product_id").cast("string"))),
        "department": _or(out, "department", F.lit("General")),
        "price_sensitivity_category": _or(out, "price_sensitivity_category", F.lit("Medium")),
        "stock_urgency_category": _or(out, "stock_urgency_category", F.lit("Normal")),
        "expiry_risk_flag": _or(out, "expiry_risk_flag", F.lit(0), "int"),
        "price_elasticity": _or(out, "price_elasticity", null_double),
        "baseline_demand": _or(out, "baseline_demand", F.lit(0.0), "double"),
        "seasonal_factor": _or(out, "seasonal_factor", F.lit(1.0), "double"),
    }
    # the two factors of every demand figure, worked out once per row
    level = F.greatest(F.lit(0.0), F.col("baseline_demand")) * F.col("seasonal_factor")
    return out.withColumns(filled).withColumns(
        {"demand_level": level, "clamped_elasticity": demand.clamp_elasticity("price_elasticity")}
    )


def demand_at(price: Column | str) -> Column:
    """Whole units at a price, for a row that went through ``lookup_defaults``."""
    return demand.rounded_demand(price, "base_price", "demand_level", "clamped_elasticity")


def demand_at_price(df: DataFrame, price_col: str, alias: str = "demand") -> DataFrame:
    return df.withColumn(alias, demand_at(price_col))


def optimize_price(lookup: DataFrame) -> DataFrame:
    """Add ``recommended_price`` and ``optimization_method`` to every row."""
    df = lookup_defaults(lookup)
    cost, base, current = F.col("cost_price"), F.col("base_price"), F.col("current_price")
    floor = cost * F.lit(demand.MIN_MARKUP)
    markup = F.greatest(round_to(base * F.lit(1.10), 2), floor)
    low = F.col("price_sensitivity_category") == "Low"
    not_worth_it = (markup - cost) * demand_at(markup) < (current - cost) * demand_at(current)
    expiring = F.col("expiry_risk_flag") == 1

    # least() skips nulls, so the scarcity cap only counts for critical stock
    cap = F.when(F.col("stock_urgency_category") == "Critical", base * F.lit(1.15))
    best = F.least(demand.best_price(cost, base, "clamped_elasticity"), cap)
    best = F.least(F.greatest(best, floor), base * F.lit(demand.MAX_MARKUP))

    # both columns test the inputs, not each other: filters on either stay small when
    # Catalyst pushes them down
    price = (
        F.when(low, F.when(not_worth_it, round_to(current, 2)).otherwise(markup))
        .when(expiring, round_to(F.greatest(cost * F.lit(1.02), base * F.lit(0.75)), 2))
        .otherwise(round_to(best, 2))
    )
    method = (
        F.when(low, F.when(not_worth_it, "inelastic_no_change").otherwise("inelastic_markup"))
        .when(expiring, retail.EXPIRY_METHOD)
        .otherwise("elasticity_optimized")
    )
    return df.withColumns({"recommended_price": price, "optimization_method": method})


def score_prices(priced: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Demand and profit at the recommended and the current price.

    Expiry markdowns rescue stock instead of beating normal sales: their uplift stays
    null and the rescued value is reported instead.
    """
    cost, new, old = F.col("cost_price"), F.col("recommended_price"), F.col("current_price")
    expiry = F.col("optimization_method") == retail.EXPIRY_METHOD
    df = priced.withColumns({"predicted_demand": demand_at("recommended_price"), "_units_now": demand_at("current_price")})
    df = df.withColumns({
        "predicted_profit": round_to((new - cost) * F.col("predicted_demand"), 2),
        "current_profit": round_to((old - cost) * F.col("_units_now"), 2),
        "price_change_pct": F.coalesce(
            round_to((ratio(new, old) - F.lit(1.0)) * F.lit(100.0), 1), F.lit(0.0)
        ),
        "spoilage_savings_estimate": F.when(expiry, round_to(F.col("inventory_level") * new, 2)),
    })
    df = df.withColumn(
        "profit_uplift",
        F.when(~expiry, round_to(F.col("predicted_profit") - F.col("current_profit"), 2)),
    )
    pct = F.coalesce(
        round_to(ratio("profit_uplift", "current_profit") * F.lit(100.0), 1), F.lit(0.0)
    )
    df = df.withColumn("profit_uplift_pct", F.when(~expiry, pct))
    out = df.select(*RESULT_COLUMNS, *keep)
    return settled(out, [c for c in out.columns if c not in COMPUTED])


#: Result columns that pricing works out, or that stand on its decisions.
COMPUTED = frozenset((
    "recommended_price", "optimization_method", "predicted_demand", "predicted_profit", "current_profit",
    "price_change_pct", "spoilage_savings_estimate", "profit_uplift", "profit_uplift_pct",
))


def settled(df: DataFrame, plain: list[str]) -> DataFrame:
    """Have the computed columns worked out once.

    Catalyst pushes a filter below a projection by repeating the projected expression in
    it; for prices that repeats the whole decision per filter, until the code no longer
    compiles.  It does not push filters through the columns of a generator, so computed columns travel in a
    one-element array; ``plain`` columns stay outside, and filters on them reach the scan.
    """
    computed = [c for c in df.columns if c not in plain]
    packed = df.select(*plain, F.inline(F.array(F.struct(*[F.col(c) for c in computed]))))
    return packed.select(*df.columns)


def price_products(lookup: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return score_prices(optimize_price(lookup), keep)


def price_curve(lookup: DataFrame, n: int = 40, low: float = 0.6, high: float = 1.6) -> DataFrame:
    """Demand and profit of every product at ``n`` prices around its base price."""
    df = lookup_defaults(lookup)
    lo, hi = round_to(F.col("base_price") * F.lit(low), 2), round_to(F.col("base_price") * F.lit(high), 2)
    df = df.withColumns({"_lo": lo, "_hi": F.when(lo >= hi, lo + 1.0).otherwise(hi)})
    df = df.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    spacing = (F.col("_hi") - F.col("_lo")) / F.lit(float(n - 1))
    price = F.when(F.col("step") == n - 1, F.col("_hi")).otherwise(F.col("_lo") + F.col("step") * spacing)
    df = df.withColumn("price", price).withColumn("demand", demand_at("price"))
    return df.select(
        "product_id", "step", "price", "demand",
        ((F.col("price") - F.col("cost_price")) * F.col("demand")).alias("profit"),
    )


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of their key; two-level, so one hot key is combined map-side."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
