"""Explicit schemas; nothing is inferred when a table is read."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "date": T.DateType(),
}


def schema_of(spec: str) -> T.StructType:
    """``"a long, b string"`` to a schema of nullable fields."""
    fields = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


CATALOG = schema_of(
    "product_id long, product_name string, aisle string, department string, base_price double,"
    " cost_price double, gross_margin_pct double, shelf_life_days int, is_perishable int,"
    " store_id long, created_date date"
)
SALES = schema_of(
    "transaction_id long, product_id long, product_name string, department string, date date,"
    " day_of_week int, is_weekend int, month int, peak_hour int, festival_flag int,"
    " base_price double, discount_pct double, current_price double, cost_price double,"
    " inventory_level long, inventory_ratio double, units_sold long, revenue double,"
    " profit double, store_id long"
)
ELASTICITY = schema_of(
    "product_id long, product_name string, department string, cost_price double,"
    " current_base_price double, avg_price_elasticity double, price_sensitivity_category string,"
    " recommended_optimal_price double, avg_weekly_demand double,"
    " predicted_demand_at_optimal double, expected_weekly_profit_at_optimal double,"
    " current_weekly_profit double, profit_improvement_pct double"
)
FORECAST = schema_of(
    "product_id long, product_name string, department string, forecast_date date,"
    " day_of_week int, is_weekend int, month int, festival_flag int, predicted_units double,"
    " predicted_units_lower double, predicted_units_upper double, recommended_price double,"
    " predicted_revenue double, confidence_pct double, model_used string, store_id long"
)
OPTIMAL = schema_of(
    "product_id long, product_name string, department string, cost_price double,"
    " current_price double, price_elasticity double, price_sensitivity string,"
    " stock_urgency string, recommended_price double, price_change_pct double,"
    " predicted_weekly_demand double, predicted_weekly_revenue double,"
    " predicted_weekly_profit double, current_weekly_profit double, profit_uplift double,"
    " profit_uplift_pct double, optimization_reason string, optimization_date date"
)
ORDER_EVENT = schema_of(
    "product_id int, units_sold int, current_price double, inventory_ratio double, timestamp string"
)
TRAINING_LOG = schema_of(
    "product_id long, date date, units_sold long, current_price double, cost_price double,"
    " inventory_ratio double, price_to_cost_ratio double, inventory_urgency_score double,"
    " sensitivity_encoded int"
)
EXPLANATION = schema_of(
    "explanation string, confidence_label string, confidence_pct string, reasoning string"
)

TABLES = {
    "catalog": CATALOG, "sales": SALES, "elasticity": ELASTICITY,
    "forecast": FORECAST, "optimal": OPTIMAL,
}
