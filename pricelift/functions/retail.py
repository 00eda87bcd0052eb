"""Inventory, margin and label expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnLike, band, clip, col, ratio, round_to

# Shelf life in days by department keyword, first hit wins.
SHELF_LIFE_DAYS: dict[str, int] = {
    "produce": 7,
    "dairy eggs": 14,
    "bakery": 5,
    "meat seafood": 5,
    "deli": 7,
    "frozen": 365,
    "beverages": 180,
    "snacks": 120,
    "pantry": 365,
    "canned goods": 730,
    "dry goods pasta": 365,
}
DEFAULT_SHELF_LIFE_DAYS = 180
PERISHABLE_DAYS = 14

EXPIRY_METHOD = "expiry_discount"


def inventory_urgency(inventory_ratio: ColumnLike) -> Column:
    return F.lit(1.0) - col(inventory_ratio)


def price_to_cost(price: ColumnLike, cost: ColumnLike) -> Column:
    return ratio(price, cost)


def profit_margin(price: ColumnLike, cost: ColumnLike) -> Column:
    return ratio(col(price) - col(cost), price) * F.lit(100.0)


def gross_margin(base: ColumnLike, cost: ColumnLike) -> Column:
    return round_to(ratio(col(base) - col(cost), base) * F.lit(100.0), 1)


def expiry_risk(perishable: ColumnLike, shelf_life: ColumnLike, days: int = PERISHABLE_DAYS) -> Column:
    return F.when((col(perishable) == 1) & (col(shelf_life) < days), 1).otherwise(0)


STOCK_CATEGORIES = ("Critical", "Low", "Normal")


def stock_category(inventory_ratio: ColumnLike, low: float = 0.2, high: float = 0.7) -> Column:
    r = col(inventory_ratio)
    return F.when(r < low, "Critical").when(r > high, "Low").otherwise("Normal")


def sensitivity_encode(category: ColumnLike) -> Column:
    c = col(category)
    return F.when(c == "High", 3).when(c == "Medium", 2).otherwise(1)


def sensitivity_class(elasticity: ColumnLike) -> Column:
    e = col(elasticity)
    return F.when(e < -1.5, "High").when(e < -0.8, "Medium").otherwise("Low")


def shelf_life(
    department: ColumnLike,
    mapping: Mapping[str, int] = SHELF_LIFE_DAYS,
    default: int = DEFAULT_SHELF_LIFE_DAYS,
) -> Column:
    """Days of the first keyword found inside the lower-cased department."""
    name = F.lower(col(department))
    hits = [F.when(name.contains(keyword), F.lit(days)) for keyword, days in mapping.items()]
    return F.coalesce(*hits, F.lit(default))


def revenue(units: ColumnLike, price: ColumnLike) -> Column:
    return col(units) * col(price)


def profit(units: ColumnLike, price: ColumnLike, cost: ColumnLike) -> Column:
    return col(units) * (col(price) - col(cost))


def revenue_per_unit(total: ColumnLike, units: ColumnLike) -> Column:
    return ratio(total, units)


def low_stock_flag(inventory_ratio: ColumnLike, at: float = 0.30) -> Column:
    return F.when(col(inventory_ratio) < at, 1).otherwise(0)


def loyalty_index(reorder_rate: ColumnLike, cart_position: ColumnLike) -> Column:
    early = clip(F.lit(1.0) - col(cart_position) / F.lit(20.0), 0.0, 1.0)
    return (col(reorder_rate) * F.lit(0.6) + early * F.lit(0.4)) * F.lit(100.0)


def frequency_band(orders: ColumnLike) -> Column:
    return band(orders, (0, 5, 20, 50, float("inf")), ("Rare", "Occasional", "Frequent", "Very Frequent"))


def inventory_health(inventory_ratio: ColumnLike) -> Column:
    return band(inventory_ratio, (-100.0, 0.3, 0.6, 100.0), ("Critical", "Warning", "Healthy"))


def recommendation_label(recommended: ColumnLike, current: ColumnLike) -> Column:
    gap = col(recommended) - col(current)
    return F.when(gap > 0, "Increase").when(gap < 0, "Decrease").otherwise("No Change")


def display_label(name: ColumnLike, product_id: ColumnLike) -> Column:
    return F.concat(col(name), F.lit(" (#"), col(product_id).cast("string"), F.lit(")"))


def is_comparable(method: ColumnLike) -> Column:
    """Expiry markdowns have no comparable profit; a missing method counts as comparable."""
    return ~col(method).eqNullSafe(F.lit(EXPIRY_METHOD))


# Stock cover, in days of mean sales.
def stock_urgency(days: ColumnLike) -> Column:
    d = col(days)
    return (
        F.when(d < 3, "CRITICAL")
        .when(d < 7, "LOW")
        .when(d > 45, "EXCESS")
        .when(d > 30, "HIGH")
        .otherwise("NORMAL")
    )


# Advice text by stock urgency.
STOCK_ADVICE: dict[str, str] = {
    "CRITICAL": "Increase Price - Scarcity",
    "LOW": "Slight Price Increase",
    "EXCESS": "Apply Discount - Clear Stock",
    "HIGH": "Monitor - Consider Discount",
    "NORMAL": "Maintain Current Price",
}


def stock_advice(urgency: ColumnLike) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for level, advice in STOCK_ADVICE.items():
        out = out.when(col(urgency) == level, advice)
    return out
