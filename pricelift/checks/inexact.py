"""Columns whose last digits hang on the order in which doubles are added, by registered query.

Two engines, or two runs of one, may differ there in the last places, so these columns, and only these, are returned in
single precision.  All other numbers come back as they are.
"""

_WINDOW_MEANS = "avg_price avg_inventory"
_LIVE = "current_price inventory_ratio"
_PRICED = "cost_price predicted_demand predicted_profit current_profit profit_uplift profit_uplift_pct recommended_price price_change_pct spoilage_savings_estimate"
_ERRORS = "mae rmse mape"

INEXACT: dict[str, str] = {
    "weekly_demand": "weekly_revenue weekly_profit avg_price avg_discount_pct avg_inventory avg_inventory_ratio",
    "revenue_per_unit": "revenue_per_unit",
    "forecast_summary": "predicted_units_avg predicted_revenue_avg",
    "join_forecast_summary": "predicted_units_avg predicted_revenue_avg",
    "build_master": "demand_volatility predicted_units_avg predicted_revenue_avg",
    "build_master_busy": "demand_volatility predicted_units_avg predicted_revenue_avg",
    "product_lookup": "demand_volatility predicted_units_avg predicted_revenue_avg",
    "product_lookup_levels": "demand_volatility predicted_units_avg predicted_revenue_avg",
    "rolling_7": "demand_volatility",
    "rolling_7_split": "demand_volatility",
    "rolling_7_ranged": "demand_volatility",
    "recent_trend": "std_daily",
    "elasticity_table": "current_weekly_profit",
    "seasonal_factor": "seasonal_factor",
    "elasticity_correlation": "correlation",
    "regression_metrics": _ERRORS,
    "mape_by_product": "mape",
    "top_worst_mape": "mape",
    "mape_distribution": "mean std min p25 p50 p75 max",
    "model_report": "test_mape train_mape naive_mape beats_naive_by p25 p50 p75 max",
    "tumbling_demand": _WINDOW_MEANS,
    "lookup_enrich": _LIVE,
    "new_product_fallback": f"base_price {_LIVE} cost_price price_to_cost_ratio",
    "micro_batch_score": f"{_LIVE} {_PRICED}",
    "training_log": f"{_LIVE} cost_price price_to_cost_ratio",
}
