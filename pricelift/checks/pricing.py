"""Pricing, forecasting and data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import inputs as x
from .base import Check
from .views import rnd, units_at
from ..operators import forecast as fc, pricing, quality, seasonal
from ..plans import batch
from ..sources import testdata as td

_RESULT_NUMBERS = (
    "cost_price current_price recommended_price price_change_pct predicted_demand predicted_profit current_profit"
    " profit_uplift profit_uplift_pct spoilage_savings_estimate inventory_ratio price_elasticity"
)


def _demand(spark, sf):
    ready = pricing.lookup_defaults(td.lookup_edge(spark, sf))
    return pricing.demand_at_price(ready, "current_price").select("product_id", "demand")


def _defaults(spark, sf):
    pid = F.col("product_id")
    thin = td.lookup_edge(spark, sf).select(
        "product_id", "current_price",
        F.when(pid % 4 != 0, F.col("base_price")).alias("base_price"),
        F.when(pid % 5 != 0, F.col("cost_price")).alias("cost_price"),
        F.when(pid % 3 != 0, F.col("inventory_level")).alias("inventory_level"),
    )
    return pricing.lookup_defaults(thin).select("product_id", "base_price", "cost_price", "inventory_level", "product_name", "department")


def _ensemble(spark, sf):
    yhat = x.seasonal_forecast(spark, sf).groupBy("product_id").agg(F.avg("yhat").alias("mean_yhat"))
    tree = td.lookup_edge(spark, sf).select("product_id", F.col("baseline_demand").alias("tree_demand"))
    return fc.ensemble_demand(tree.join(yhat, "product_id")).select("product_id", "ensemble_demand")


def _dirty(spark, sf):
    """Rows that break some rules; one optional column is absent."""
    pid = F.col("product_id")
    return td.sales(spark, sf).select(
        F.when(pid % 71 != 0, pid).alias("product_id"), (F.col("current_price") / F.lit(4.0)).alias("current_price"),
        F.when(pid % 61 == 0, 0.0).otherwise(F.col("cost_price")).alias("cost_price"),
        F.when(pid % 59 == 0, None).otherwise(F.col("inventory_ratio") * F.lit(1.05)).alias("inventory_ratio"),
        F.when(pid % 41 == 0, None).otherwise(F.col("department")).alias("department"),
        F.when(F.col("units_sold") > 60, "Extreme").when(pid % 2 == 0, "High").alias("price_sensitivity_category"),
    )


def _gate(spark, sf):
    """What the gate says of rows that break rules, of those that keep them, and of a table without two columns."""
    dirty = _dirty(spark, sf)
    broken = [F.coalesce(F.expr(r.violated.format(c=c)), F.lit(False)) for r in quality.MASTER_RULES for c in r.columns if c in dirty.columns]
    tables = {"dirty": dirty, "fit": dirty.filter(~reduce(Column.__or__, broken)), "thin": dirty.drop("cost_price", "department")}
    rows = [quality.gate_summary(quality.validate(df)).withColumn("name", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def _missing(spark, sf):
    return quality.validate(_dirty(spark, sf).drop("current_price", "cost_price", "inventory_ratio").withColumnRenamed("department", "dept")).filter("checked_column is null")


CHECKS = [
    Check("department_gains", lambda s, d: batch.department_gains(td.sales_full(s, d), td.catalog(s, d)), """
        select department, cast(sum(cast(profit_uplift as decimal(28,6))) as double) as profit_uplift from shop_results
        where optimization_method <> 'expiry_discount' group by department""", doubles="profit_uplift"),
    Check("demand_at_price", _demand, f"""
        select product_id, {units_at("current_price")} as demand from edge_ready""", doubles="demand"),
    Check("optimize_price", lambda s, d: x.edge_priced(s, d).select("product_id", "recommended_price", "optimization_method"), """
        select product_id, recommended_price, optimization_method from edge_priced""", doubles="recommended_price"),
    Check("score_prices", lambda s, d: x.edge_results(s, d), "select * from edge_results", doubles=_RESULT_NUMBERS),
    Check("price_products", lambda s, d: x.shop_results(s, d), "select * from shop_results", doubles=_RESULT_NUMBERS),
    Check("lookup_defaults", _defaults, """
        select product_id, case when product_id % 4 <> 0 then base_price else current_price end as base_price,
               case when product_id % 5 <> 0 then cost_price else current_price * 0.7 end as cost_price,
               case when product_id % 3 <> 0 then inventory_level else 0 end as inventory_level,
               'Product_' || product_id as product_name, 'General' as department
        from lookup_edge""", doubles="base_price cost_price"),
    Check("price_curve", lambda s, d: pricing.price_curve(td.lookup_edge(s, d)), f"""
        select product_id, step, price, {units_at("price")} as demand, (price - cost_price) * {units_at("price")} as profit
        from (select *, case when step = 39 then hi else lo + step * ((hi - lo) / 39) end as price
              from (select e.*, cast(g.i as integer) as step, {rnd("base_price * 0.6", 2)} as lo, {rnd("base_price * 1.6", 2)} as hi
                    from edge_ready e, range(40) g(i)))""", doubles="price demand profit"),
    Check("forecast_project", x.forecast, """
        select f.*, c.product_name, c.department, cast(null as double) as confidence_pct, 'trend_seasonal' as model_used
        from forecast f left join catalog c on c.product_id = f.product_id""",
          doubles="confidence_pct predicted_units predicted_units_lower predicted_units_upper recommended_price predicted_revenue", dates="forecast_date"),
    Check("train_seasonal", lambda s, d: fc.seasonal_index(td.sales(s, d, by_product=True)), "select * from seasonal_indices",
          doubles="mean_units seasonal_index"),
    Check("seasonal_forecast", lambda s, d: x.seasonal_forecast(s, d), "select product_id, ds, yhat, yhat_lower, yhat_upper from seasonal_days",
          doubles="yhat yhat_lower yhat_upper", dates="ds"),
    Check("seasonal_factor", lambda s, d: fc.seasonal_factor(x.seasonal_forecast(s, d)), """
        select product_id, case when m > 0 then least(2.0, greatest(0.5, f / m)) else 1 end as seasonal_factor
        from (select product_id, arg_min(yhat, ds) as f, avg(yhat) as m from seasonal_days group by product_id)""",
        doubles="seasonal_factor"),
    Check("ensemble_demand", _ensemble, """
        select e.product_id, greatest(cast(0 as double), round_even(0.6 * e.baseline_demand + 0.4 * y.m, 0)) as ensemble_demand
        from lookup_edge e join (select product_id, avg(yhat) as m from seasonal_days group by product_id) y on y.product_id = e.product_id""",
        doubles="ensemble_demand"),
    Check("duplicate_check", lambda s, d: pricing.duplicate_count(td.table(s, d, "lineitem").select("l_partkey"), "l_partkey"), """
        select count(*) - count(distinct l_partkey) as duplicates from lineitem"""),
    Check("validate_master", lambda s, d: quality.validate(_dirty(s, d)), """
        with dirty as (select product_id as pid, current_price / 4 as price, inventory_ratio * 1.05 as ratio, * from sales)
        select 'product_id_not_null' as rule, 'product_id' as checked_column, case when n > 0 then 'failed' else 'passed' end as status, n as failing_rows
        from (select count(*) filter (where pid % 71 = 0) as n from dirty)
        union all select 'price_in_range', 'current_price', case when n > 0 then 'failed' else 'passed' end, n
        from (select count(*) filter (where price < 0.5 or price > 500) as n from dirty)
        union all select 'cost_positive', 'cost_price', case when n > 0 then 'failed' else 'passed' end, n
        from (select count(*) filter (where pid % 61 = 0 or cost_price < 0.01) as n from dirty)
        union all select 'total_units_not_negative', null, 'skipped', null
        union all select 'inventory_ratio_in_range', 'inventory_ratio', case when n > 0 then 'failed' else 'passed' end, n
        from (select count(*) filter (where pid % 59 <> 0 and (ratio < 0 or ratio > 1)) as n from dirty)
        union all select 'sensitivity_known', 'price_sensitivity_category', case when n > 0 then 'failed' else 'passed' end, n
        from (select count(*) filter (where units_sold > 60) as n from dirty)
        union all select 'department_not_null', 'department', case when n > 0 then 'failed' else 'passed' end, n
        from (select count(*) filter (where pid % 41 = 0) as n from dirty)"""),
    Check("validation_gate", _gate, """
        with dirty as (select product_id as pid, current_price / 4 as price, inventory_ratio * 1.05 as ratio, * from sales),
        b as (select pid % 71 = 0 as product, price < 0.5 or price > 500 as price, pid % 61 = 0 or cost_price < 0.01 as cost,
                     pid % 59 <> 0 and (ratio < 0 or ratio > 1) as ratio, units_sold > 60 as kind, pid % 41 = 0 as dept from dirty),
        n as (select 'dirty' as name, cast(count(*) filter (where product) > 0 as int) as a, cast(count(*) filter (where price) > 0 as int) as b,
                     cast(count(*) filter (where cost) > 0 as int) as c, cast(count(*) filter (where ratio) > 0 as int) as d,
                     cast(count(*) filter (where kind) > 0 as int) as e, cast(count(*) filter (where dept) > 0 as int) as f, 0 as gone from b
              union all select 'fit', 0, 0, 0, 0, 0, 0, 0
              union all select 'thin', cast(count(*) filter (where product) > 0 as int), cast(count(*) filter (where price) > 0 as int), 1,
                     cast(count(*) filter (where ratio) > 0 as int), cast(count(*) filter (where kind) > 0 as int), 0, 1 from b)
        select name, case when a + b + c + d + e + f = 0 then 1 else 0 end as passes,
               cast(6 - gone - (a + b + c + d + e + f) as bigint) as n_passed, cast(a + b + c + d + e + f as bigint) as n_failed, cast(1 + gone as bigint) as n_skipped,
               array_to_string(list_filter([case when c = 1 then 'cost_positive' end, case when f = 1 then 'department_not_null' end,
                 case when d = 1 then 'inventory_ratio_in_range' end, case when b = 1 then 'price_in_range' end,
                 case when a = 1 then 'product_id_not_null' end, case when e = 1 then 'sensitivity_known' end], lambda r: r is not null), ',') as failed_rules
        from n"""),
    Check("missing_column_rule", _missing, """
        select rule, cast(null as varchar) as checked_column, status, cast(null as bigint) as failing_rows
        from (values ('price_in_range', 'failed'), ('cost_positive', 'failed'), ('total_units_not_negative', 'skipped'),
                     ('inventory_ratio_in_range', 'skipped'), ('department_not_null', 'skipped')) as v(rule, status)"""),
    Check("clean_optimal", x.optimal, "select * from optimal",
          doubles="cost_price current_price price_elasticity recommended_price price_change_pct predicted_weekly_demand predicted_weekly_revenue"
                  " predicted_weekly_profit current_weekly_profit profit_uplift profit_uplift_pct"),
    Check("train_seasonal_joint", lambda s, d: seasonal.joint_effects(seasonal.joint_seasonal_fit(td.sales(s, d)))),
]
