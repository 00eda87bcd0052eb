"""Sources, cleaning, filters and scalar columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import inputs as x
from .base import Check
from .views import rnd
from ..functions import calendar as cal
from ..functions import retail
from ..operators import clean, features, joins
from ..sources import schemas, tables, testdata as td
from ..streaming import events

BASE_TABLES = ("customer", "lineitem", "orders", "part")


def _audit(spark, sf):
    paths = {name: f"{sf}/{name}.parquet" for name in BASE_TABLES}
    return tables.audit_tables(spark, {**paths, "absent": f"{sf}/absent.parquet"})


def _replay(spark, sf):
    sales = td.sales(spark, sf).select(
        "transaction_id", "product_id",
        F.when(F.col("product_id") % 7 != 0, F.col("product_name")).alias("product_name"),
        F.when(F.col("product_id") % 5 != 0, F.col("units_sold")).alias("units_sold"),
        "current_price",
        F.when(F.col("product_id") % 3 != 0, F.col("inventory_ratio")).alias("inventory_ratio"),
        F.col("date").cast("timestamp").alias("sent"),
    )
    sent = events.replay_events(sales, F.col("sent"))
    schema = (
        "event_type string, transaction_id long, product_id long, product_name string, units_sold long,"
        " current_price double, inventory_ratio double, timestamp string"
    )
    return sent.select("key", F.from_json("value", schema).alias("v")).select("key", "v.*")


def _coerce(spark, sf):
    results = x.edge_results(spark, sf).select(
        "product_id",
        F.when(F.col("product_id") % 11 == 0, "n/a").otherwise(F.col("current_price").cast("string")).alias("current_price"),
        F.when(F.col("product_id") % 7 == 0, None).otherwise(F.col("predicted_demand").cast("string")).alias("predicted_demand"),
        "profit_uplift", "spoilage_savings_estimate",
    )
    return clean.numeric_coerce(results)


def _drop(spark, sf):
    raw = td.sales_raw(spark, sf)
    return clean.drop_incomplete(raw, ["department", "cost_price", "units_sold", "absent"])


def _filtered(spark, sf):
    return clean.filter_results(
        x.edge_results(spark, sf), department="PROMO", search="RED", uplift_range=(-500.0, 50000.0),
        change_range=(-30.0, 60.0), stock="Normal", method="elasticity_optimized",
    ).select("product_id", "product_name", "profit_uplift", "price_change_pct")


def _filtered_default(spark, sf):
    return clean.filter_results(x.edge_results(spark, sf), search="bolt").select("product_id", "optimization_method")


def _backfill(spark, sf):
    absent = x.edge_results(spark, sf).drop("profit_uplift_pct")
    return clean.uplift_pct_backfill(absent).select("product_id", "profit_uplift_pct")


def _row_columns(spark, sf):
    """Every row-level feature of the wide table in one pass over sales and catalog."""
    sales = td.sales(spark, sf)
    catalog = td.catalog(spark, sf).select("product_id", "shelf_life_days", "is_perishable")
    joined = joins.join_dim(sales, catalog, "product_id")
    return features.business_features(joined)


def _one(column, *names):
    return lambda spark, sf: _row_columns(spark, sf).select("product_id", "date", column, *names)


def _edge(**columns):
    return lambda spark, sf: x.edge_results(spark, sf).select("product_id", *[c().alias(n) for n, c in columns.items()])


def _gap(spark, sf):
    sales = td.sales(spark, sf, by_product=True)
    optimal = x.lerner(spark, sf).select("product_id", "recommended_optimal_price")
    return features.price_gap(joins.join_dim(sales, optimal, "product_id")).select("product_id", "date", "competitor_price_gap")


def _sales_cols(**columns):
    return lambda spark, sf: td.sales_full(spark, sf).select("product_id", "date", *[c().alias(n) for n, c in columns.items()])


# grocery department names made from the tables, so that the keyword rule has work to do
_DEPARTMENTS = (
    "case p_partkey % 9 when 0 then 'Fresh Produce' when 1 then 'dairy eggs' when 2 then 'BAKERY' when 3 then 'frozen'"
    " when 4 then 'beverages' when 5 then 'dry goods pasta' when 6 then 'meat seafood' when 7 then 'canned goods' else p_type end"
)


def _shelf(spark, sf):
    parts = td.table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), F.expr(_DEPARTMENTS).alias("department"))
    days = retail.shelf_life("department")
    return parts.select("product_id", days.alias("shelf_life_days"), (days <= 14).cast("int").alias("is_perishable"))


def _orders_per_product(spark, sf):
    counts = td.order_lines(spark, sf).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("product_id", retail.frequency_band("n").alias("purchase_frequency"))


def _read(spark, sf):
    """A table read with a schema of its own: three of its columns, one of them wider."""
    schema = schemas.schema_of("p_partkey long, p_name string, p_retailprice double")
    return tables.read_table(spark, f"{sf}/part.parquet", schema)


def _required(spark, sf):
    """Rows of the required tables, and what is missing of a set with an absent one."""
    paths = {name: f"{sf}/{name}.parquet" for name in BASE_TABLES}
    tables.require_inputs(spark, list(paths.values()))
    counts = [tables.read_table(spark, path).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows")) for name, path in paths.items()]
    try:
        tables.require_inputs(spark, [*paths.values(), f"{sf}/absent.parquet"])
        missing = ""
    except FileNotFoundError as error:
        missing = str(error).rsplit("/", 1)[1]
    return reduce(DataFrame.unionByName, counts).withColumn("missing", F.lit(missing))


def _resolved(spark, sf):
    """Columns found by parts of their names, and their sums and counts."""
    part, orders = td.table(spark, sf, "part"), td.table(spark, sf, "orders")
    found = [
        ("price", part, clean.resolve_column(part, ["price"])), ("key", orders, clean.resolve_column(orders, ["key"], exclude=["order"])),
        ("type", part, clean.resolve_column(part, ["kind", "type"])), ("none", part, clean.resolve_column(part, ["absent"])),
    ]
    rows = [
        df.agg(F.lit(name).alias("wanted"), F.lit(column).cast("string").alias("found"), (F.count(column) if column else F.lit(0)).cast("long").alias("n_values"))
        for name, df, column in found
    ]
    return reduce(DataFrame.unionByName, rows)


CHECKS = [
    Check("read_table", _read, "select cast(p_partkey as bigint) as p_partkey, p_name, cast(p_retailprice as double) as p_retailprice from part", doubles="p_retailprice"),
    Check("require_inputs", _required, """
        select name, n_rows, 'absent.parquet' as missing
        from (select 'customer' as name, count(*) as n_rows from customer union all select 'lineitem', count(*) from lineitem
              union all select 'orders', count(*) from orders union all select 'part', count(*) from part)"""),
    Check("resolve_columns", _resolved, """
        select 'price' as wanted, 'p_retailprice' as found, count(p_retailprice) as n_values from part
        union all select 'key', 'o_custkey', count(o_custkey) from orders
        union all select 'type', 'p_type', count(p_type) from part
        union all select 'none', null, 0"""),
    Check("audit_tables", _audit, """
        select 'customer' as name, 'ok' as status, count(*) as n_rows, cast(5 as bigint) as n_cols,
               'c_custkey, c_name, c_nationkey, c_acctbal' as sample_cols from customer
        union all select 'lineitem', 'ok', count(*), 11, 'l_orderkey, l_partkey, l_suppkey, l_linenumber' from lineitem
        union all select 'orders', 'ok', count(*), 6, 'o_orderkey, o_custkey, o_orderstatus, o_totalprice' from orders
        union all select 'part', 'ok', count(*), 6, 'p_partkey, p_name, p_brand, p_type' from part
        union all select 'absent', 'missing', null, null, null"""),
    Check("replay_events", _replay, """
        select cast(product_id as varchar) as key, 'order' as event_type, transaction_id, product_id,
               case when product_id % 7 <> 0 then product_name else 'Unknown' end as product_name,
               case when product_id % 5 <> 0 then units_sold else 1 end as units_sold, current_price,
               case when product_id % 3 <> 0 then inventory_ratio else cast(1 as double) end as inventory_ratio,
               strftime(date, '%Y-%m-%d') || 'T00:00:00' as timestamp
        from sales""", doubles="current_price inventory_ratio"),
    Check("clean_sales", lambda s, d: clean.clean_sales(td.sales_raw(s, d)), """
        select transaction_id, product_id, product_name, coalesce(department, 'Unknown') as department,
               try_cast(date as date) as date, current_price, cost_price, units_sold,
               try_cast(date as date) as date_only, strftime(try_cast(date as date), '%Y-%m') as year_month
        from sales_raw where units_sold >= 0 and current_price >= cost_price""",
        doubles="current_price cost_price", dates="date date_only"),
    Check("clean_elasticity", lambda s, d: clean.clean_elasticity(x.elasticity_raw(s, d)), """
        select r.product_id, product_name, coalesce(r.department, 'Unknown') as department, cost_price, current_base_price,
               avg_price_elasticity, price_sensitivity_category,
               coalesce(case when isinf(recommended_optimal_price) then null else recommended_optimal_price end, m.med)
                 as recommended_optimal_price,
               avg_weekly_demand, predicted_demand_at_optimal, expected_weekly_profit_at_optimal,
               current_weekly_profit, profit_improvement_pct,
               case price_sensitivity_category when 'High' then 3 when 'Medium' then 2 else 1 end as sensitivity_encoded
        from elasticity_raw r
        left join (select department, quantile_disc(current_base_price, 0.5) as med from elasticity_raw group by department) m
          on m.department = r.department""",
        doubles="cost_price current_base_price avg_price_elasticity recommended_optimal_price avg_weekly_demand"
                " predicted_demand_at_optimal expected_weekly_profit_at_optimal current_weekly_profit profit_improvement_pct"),
    Check("clean_forecast", lambda s, d: clean.clean_forecast(x.forecast_raw(s, d)), """
        select product_id, forecast_date, coalesce(flag, 0) as festival_flag, lower as predicted_units_lower,
               predicted_units, predicted_units_upper
        from (select *, case when product_id % 6 = 0 then null else festival_flag end as flag,
                     case when product_id % 37 = 0 then predicted_units + 1 when product_id % 43 = 0 then 0 else predicted_units_lower end as lower,
                     case when product_id % 43 = 0 then 0 else predicted_units end as mid,
                     case when product_id % 43 = 0 then 0 else predicted_units_upper end as high
              from forecast)
        where lower <= mid and mid <= high and not (lower = 0 and mid = 0 and high = 0)""",
        doubles="predicted_units_lower predicted_units predicted_units_upper", dates="forecast_date"),
    Check("clean_catalog", lambda s, d: clean.clean_catalog(td.catalog_raw(s, d)), """
        select product_id, product_name, aisle, case when product_id % 41 = 0 then 'Unknown' else department end as department,
               base_price, cost_price, shelf_life_days, is_perishable from catalog""", doubles="base_price cost_price"),
    Check("rename_collisions",
          lambda s, d: joins.rename_collisions(td.sales(s, d), td.catalog(s, d), "product_id", "_cat"), """
        select product_id, product_name as product_name_cat, aisle, department as department_cat, base_price as base_price_cat,
               cost_price as cost_price_cat, shelf_life_days, is_perishable from catalog""", doubles="base_price_cat cost_price_cat"),
    Check("drop_incomplete", _drop, """
        select * from sales_raw where department is not null and cost_price is not null and units_sold is not null""",
        doubles="current_price cost_price"),
    Check("numeric_coerce", _coerce, """
        select product_id, case when product_id % 11 <> 0 then current_price end as current_price,
               case when product_id % 7 = 0 then 0 else predicted_demand end as predicted_demand, profit_uplift,
               coalesce(spoilage_savings_estimate, 0) as spoilage_savings_estimate
        from edge_results""", doubles="current_price predicted_demand profit_uplift spoilage_savings_estimate"),
    Check("filter_results", _filtered, """
        select product_id, product_name, profit_uplift, price_change_pct from edge_results
        where department = 'PROMO' and lower(product_name) like '%red%' and optimization_method = 'elasticity_optimized'
          and profit_uplift >= -500 and profit_uplift <= 50000 and price_change_pct >= -30 and price_change_pct <= 60
          and stock_urgency_category = 'Normal'""", doubles="profit_uplift price_change_pct"),
    Check("filter_results_default", _filtered_default, """
        select product_id, optimization_method from edge_results where lower(product_name) like '%bolt%'"""),
    Check("filter_options", lambda s, d: clean.filter_options(x.edge_results(s, d)), """
        select 'department' as field, department as option, cast(null as double) as low, cast(null as double) as high from edge_results group by department
        union all select 'optimization_method', optimization_method, null, null from edge_results group by optimization_method
        union all select 'stock_urgency_category', stock_urgency_category, null, null from edge_results group by stock_urgency_category
        union all select 'profit_uplift', null, min(profit_uplift), max(profit_uplift) from edge_results
        union all select 'price_change_pct', null, min(price_change_pct), max(price_change_pct) from edge_results""",
        doubles="low high"),
    # ---- row-level columns
    Check("inventory_urgency", _one("inventory_urgency_score"), """
        select product_id, date, 1 - inventory_ratio as inventory_urgency_score from sales""",
        doubles="inventory_urgency_score", dates="date"),
    Check("price_to_cost", _one("price_to_cost_ratio"), """
        select product_id, date, current_price / nullif(cost_price, 0) as price_to_cost_ratio from sales""",
        doubles="price_to_cost_ratio", dates="date"),
    Check("profit_margin", _one("profit_margin_pct"), """
        select product_id, date, (current_price - cost_price) / nullif(current_price, 0) * 100 as profit_margin_pct from sales""",
        doubles="profit_margin_pct", dates="date"),
    Check("price_gap", _gap, """
        select s.product_id, s.date, l.recommended_optimal_price - s.current_price as competitor_price_gap
        from sales s left join lerner l on l.product_id = s.product_id""", doubles="competitor_price_gap", dates="date"),
    Check("expiry_risk", _one("expiry_risk_flag"), """
        select s.product_id, s.date, case when c.is_perishable = 1 and c.shelf_life_days < 14 then 1 else 0 end as expiry_risk_flag
        from sales s left join catalog c on c.product_id = s.product_id""", dates="date"),
    Check("stock_category", _one("stock_urgency_category"), """
        select product_id, date, case when inventory_ratio is null then 'Normal' when inventory_ratio < 0.2 then 'Critical'
               when inventory_ratio > 0.7 then 'Low' else 'Normal' end as stock_urgency_category from sales""", dates="date"),
    Check("sensitivity_encode", _edge(sensitivity_encoded=lambda: retail.sensitivity_encode("price_sensitivity_category")), """
        select product_id, case price_sensitivity_category when 'High' then 3 when 'Medium' then 2 when 'Low' then 1 else 1 end
               as sensitivity_encoded from edge_results"""),
    Check("sensitivity_class", _edge(category=lambda: retail.sensitivity_class("price_elasticity")), """
        select product_id, case when price_elasticity < -1.5 then 'High' when price_elasticity < -0.8 then 'Medium' else 'Low' end
               as category from edge_results"""),
    Check("shelf_life_lookup", _shelf, f"""
        select product_id, days as shelf_life_days, case when days <= 14 then 1 else 0 end as is_perishable
        from (select product_id, case when d like '%produce%' then 7 when d like '%dairy eggs%' then 14 when d like '%bakery%' then 5
                when d like '%meat seafood%' then 5 when d like '%deli%' then 7 when d like '%frozen%' then 365
                when d like '%beverages%' then 180 when d like '%snacks%' then 120 when d like '%pantry%' then 365
                when d like '%canned goods%' then 730 when d like '%dry goods pasta%' then 365 else 180 end as days
              from (select p_partkey as product_id, lower({_DEPARTMENTS}) as d from part))"""),
    Check("gross_margin", lambda s, d: td.catalog(s, d).select("product_id", retail.gross_margin("base_price", "cost_price").alias("gross_margin_pct")), f"""
        select product_id, {rnd("(base_price - cost_price) / nullif(base_price, 0) * 100", 1)} as gross_margin_pct from catalog""",
        doubles="gross_margin_pct"),
    Check("calendar_features", lambda s, d: features.calendar_features(td.sales(s, d)).select(
        "product_id", "date", "day_of_week", "is_weekend", "month", "festival_flag"), """
        select product_id, date, cast(isodow(date) - 1 as integer) as day_of_week,
               case when isodow(date) in (6, 7) then 1 else 0 end as is_weekend, cast(month(date) as integer) as month,
               case when month(date) in (10, 12) and day(date) >= 20 then 1 else 0 end as festival_flag
        from sales""", dates="date"),
    Check("season_factor", _sales_cols(season_factor=lambda: cal.season_factor("date")), """
        select product_id, date,
               cast(case when month(date) in (11, 12) then 1.3 when month(date) in (6, 7, 8) then 1.1 else 1 end as double)
             * cast(case when isodow(date) in (6, 7) then 1.35 else 1 end as double)
             * cast(case when month(date) in (10, 12) and day(date) >= 20 then 1.2 else 1 end as double) as season_factor
        from sales""", doubles="season_factor", dates="date"),
    Check("revenue_profit", lambda s, d: td.sales_full(s, d).select("product_id", "date", "revenue", "profit"), """
        select product_id, date, units_sold * current_price as revenue, units_sold * (current_price - cost_price) as profit
        from sales""", doubles="revenue profit", dates="date"),
    Check("revenue_per_unit", lambda s, d: x.weekly(s, d).select(
        "product_id", "year", "week", retail.revenue_per_unit("weekly_revenue", "weekly_units_sold").alias("revenue_per_unit")), """
        select product_id, year, week, weekly_revenue / nullif(weekly_units_sold, 0) as revenue_per_unit from weekly""",
        doubles="revenue_per_unit"),
    Check("low_stock_flag", lambda s, d: td.sales(s, d).select("product_id", "date", retail.low_stock_flag("inventory_ratio").alias("low_stock_flag")), """
        select product_id, date, case when inventory_ratio < 0.3 then 1 else 0 end as low_stock_flag from sales""", dates="date"),
    Check("loyalty_index", lambda s, d: td.order_lines(s, d).select(
        "order_id", "product_id", retail.loyalty_index(F.col("reordered").cast("double"), F.col("add_to_cart_order") * 4).alias("loyalty_index")), """
        select order_id, product_id, (0.6 * reordered + 0.4 * least(1.0, greatest(0.0, 1 - add_to_cart_order * 4 / 20.0))) * 100 as loyalty_index
        from order_lines""", doubles="loyalty_index"),
    Check("frequency_band", _orders_per_product, """
        select product_id, case when n > 0 and n <= 5 then 'Rare' when n > 5 and n <= 20 then 'Occasional'
               when n > 20 and n <= 50 then 'Frequent' when n > 50 then 'Very Frequent' end as purchase_frequency
        from (select product_id, count(*) as n from order_lines group by product_id)"""),
    Check("inventory_health", _edge(inventory_health=lambda: retail.inventory_health("inventory_ratio")), """
        select product_id, case when inventory_ratio > -100 and inventory_ratio <= 0.3 then 'Critical'
               when inventory_ratio > 0.3 and inventory_ratio <= 0.6 then 'Warning'
               when inventory_ratio > 0.6 and inventory_ratio <= 100 then 'Healthy' end as inventory_health from edge_results"""),
    Check("recommendation_label", _edge(recommendation=lambda: retail.recommendation_label("recommended_price", "current_price")), """
        select product_id, case when recommended_price > current_price then 'Increase'
               when recommended_price < current_price then 'Decrease' else 'No Change' end as recommendation from edge_results"""),
    Check("uplift_pct_backfill", _backfill, """
        select product_id, profit_uplift / nullif(current_profit, 0) * 100 as profit_uplift_pct from edge_results""",
        doubles="profit_uplift_pct"),
    Check("display_label", _edge(display_label=lambda: retail.display_label("product_name", "product_id")), """
        select product_id, product_name || ' (#' || product_id || ')' as display_label from edge_results"""),
    Check("comparable_flag", _edge(is_profit_comparable=lambda: retail.is_comparable("optimization_method")), """
        select product_id, case when optimization_method <> 'expiry_discount' then 1 else 0 end as is_profit_comparable
        from edge_results"""),
]
