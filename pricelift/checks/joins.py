"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import inputs as x
from .base import Check
from .views import MASTER_DATES, MASTER_DOUBLES
from ..operators import features, joins
from ..plans import batch
from ..plans.master import build_master, build_master_busy
from ..operators import clean
from ..sources import testdata as td


def _orders(spark, sf):
    return features.days_since_prior(td.orders(spark, sf))


def _fold(spark, sf):
    """Logged rows of three batches, the first of which was folded in before."""
    master = td.sales(spark, sf).select("transaction_id", "product_id", "product_name", "date", "units_sold", "current_price", "cost_price")
    e = td.price_events(spark, sf)
    log = e.select(
        "product_id", F.to_date("event_time").alias("date"), F.col("units_sold").cast("long").alias("units_sold"),
        "current_price", (F.col("current_price") * F.lit(0.7)).alias("cost_price"), (F.col("event_id") % 3).alias("batch_id"),
    )
    consumed = log.select("batch_id").filter(F.col("batch_id") == 0).distinct()
    return joins.fold_back(master, log, consumed)


def _requests(spark, sf):
    asked = td.table(spark, sf, "lineitem").select((F.col("l_partkey") * 2).alias("product_id")).distinct()
    results = x.edge_results(spark, sf).select("product_id", "recommended_price", "optimization_method")
    return joins.point_lookup(asked, results)


def master(spark, sf, build=build_master):
    """The wide table; sales, and what is derived from them for more than one reader, are made once."""
    kept = x.kept(spark, sf)
    sales = kept(td.sales_full(spark, sf))
    t = batch.derive_tables(sales, td.catalog_full(spark, sf), x.FORECAST_START, kept=kept)
    return build(
        clean.clean_sales(sales), clean.clean_catalog(td.catalog_full(spark, sf)),
        kept(clean.clean_elasticity(t.elasticity)), t.optimal, clean.clean_forecast(t.forecast),
    )


def _by_name(spark, sf):
    """Name join with unique names on the right side."""
    per_name = x.optimal(spark, sf).groupBy("product_name").agg(
        F.max("recommended_price").alias("recommended_price"), F.min("department").alias("department")
    )
    sales = td.sales(spark, sf).select("product_id", "date", "product_name", "department")
    return joins.join_dim(sales, per_name, "product_name", "_opt", require_unique=True)


CHECKS = [
    Check("catalog_build", lambda s, d: joins.catalog_build(td.products(s, d), td.aisles(s, d), td.departments(s, d)), """
        select p_partkey as product_id, p_name as product_name, cast(replace(p_brand, 'Brand#', '') as bigint) as aisle_id,
               cast(length(p_type) as bigint) as department_id, p_brand as aisle, d.department
        from part join (select length(p_type) as n, min(p_type) as department from part group by 1) d on d.n = length(p_type)"""),
    Check("join_catalog", lambda s, d: joins.join_dim(
        td.sales(s, d).select("product_id", "date", "product_name", "base_price"), td.catalog(s, d), "product_id", "_cat"), """
        select s.product_id, s.date, s.product_name, s.base_price, c.product_name as product_name_cat, c.aisle, c.department,
               c.base_price as base_price_cat, c.cost_price, c.shelf_life_days, c.is_perishable
        from sales s left join catalog c on c.product_id = s.product_id""",
        doubles="base_price base_price_cat cost_price", dates="date"),
    Check("join_elasticity", lambda s, d: joins.join_dim(
        td.sales(s, d, by_product=True).select("product_id", "date", "cost_price"),
        x.lerner(s, d).select("product_id", "cost_price", "avg_price_elasticity", "price_sensitivity_category"), "product_id", "_elas"), """
        select s.product_id, s.date, s.cost_price, l.cost_price as cost_price_elas, l.avg_price_elasticity, l.price_sensitivity_category
        from sales s left join lerner l on l.product_id = s.product_id""",
        doubles="cost_price cost_price_elas avg_price_elasticity", dates="date"),
    Check("join_optimal_by_name", _by_name, """
        select s.product_id, s.date, s.product_name, s.department, o.recommended_price, o.department as department_opt
        from sales s left join (select product_name, max(recommended_price) as recommended_price, min(department) as department
                                from optimal group by product_name) o on o.product_name = s.product_name""",
        doubles="recommended_price", dates="date"),
    Check("join_forecast_summary", lambda s, d: joins.join_dim(
        td.sales(s, d).select("product_id", "date"), features.forecast_summary(x.forecast(s, d)), "product_id"), """
        select s.product_id, s.date, f.u as predicted_units_avg, f.r as predicted_revenue_avg, cast(null as double) as confidence_pct_avg
        from sales s left join (select product_id, avg(predicted_units) as u, avg(predicted_revenue) as r from forecast group by product_id) f
          on f.product_id = s.product_id""", doubles="predicted_units_avg predicted_revenue_avg confidence_pct_avg", dates="date"),
    Check("join_orders_train", lambda s, d: joins.orders_in_set(td.order_lines(s, d), td.orders(s, d), "train"), """
        select l.order_id, l.product_id, l.add_to_cart_order, l.reordered from order_lines l
        where l.order_id in (select o_orderkey from orders where o_orderstatus = 'F')"""),
    Check("join_orders_products", lambda s, d: joins.enrich_lines(td.order_lines(s, d), _orders(s, d), td.products(s, d)), """
        select l.order_id, l.product_id, l.add_to_cart_order, l.reordered, o.user_id, o.order_dow, o.order_hour_of_day,
               o.days_since_prior_order, p.p_name as product_name
        from order_lines l left join order_gaps o on o.order_id = l.order_id left join part p on p.p_partkey = l.product_id"""),
    Check("new_products", lambda s, d: joins.new_products(td.price_events(s, d), x.event_lookup(s, d)), """
        select distinct e.product_id from price_events e
        where not exists (select 1 from part p where p.p_partkey = e.product_id and p.p_partkey % 3 <> 1)"""),
    Check("point_lookup", _requests, """
        select q.product_id, r.recommended_price, r.optimization_method, case when r.product_id is not null then 1 else 0 end as found
        from (select distinct l_partkey * 2 as product_id from lineitem) q left join edge_results r on r.product_id = q.product_id""",
        doubles="recommended_price"),
    Check("fold_back", _fold, """
        select transaction_id, product_id, product_name, date, units_sold, current_price, cost_price from sales
        union all
        select null, product_id, null, cast(event_time as date), units_sold, current_price, current_price * 0.7
        from price_events where event_id % 3 <> 0""", doubles="current_price cost_price", dates="date"),
    Check("distinct_products", lambda s, d: joins.distinct_products(td.sales(s, d)), """
        select product_id, min(product_name) as product_name from sales group by product_id"""),
    *[Check(key, plan, "select * from master", doubles=MASTER_DOUBLES, dates=MASTER_DATES)
      for key, plan in (("build_master", master), ("build_master_busy", lambda s, d: master(s, d, build_master_busy)))],
]
