"""Aggregates and window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import inputs as x
from .base import Check
from .joins import master
from .views import MASTER_DATES, MASTER_DOUBLES, MASTER_WHOLE, rnd
from ..functions import retail
from ..operators import features, lookup_state, patterns, ranks, reports, split
from ..operators.joins import orders_in_set
from ..sources import testdata as td
from ..sources.tables import written_once


def _lookup(spark, sf):
    return features.product_lookup(master(spark, sf))


def _lookup_levels(spark, sf):
    return features.product_lookup(master(spark, sf), {"stock_urgency_category": retail.STOCK_CATEGORIES})


def _lookup_states(spark, sf):
    """The lookup of the whole sales table from the states of three parts of it, which are written once."""
    # rows of a product lie together, so its values combine before they are exchanged; rows without a date are in the first part
    sales = td.sales(spark, sf, by_product=True).withColumn("stock_urgency_category", retail.stock_category("inventory_ratio")).select(
        "product_id", "product_name", "department", "date", "base_price", "current_price", "cost_price",
        "inventory_level", "inventory_ratio", "units_sold", "stock_urgency_category",
        F.coalesce(F.crc32(F.col("date").cast("string").cast("binary")) % 3, F.lit(0)).cast("int").alias("part"),
    )
    kept = written_once(sales, ("part",))
    return lookup_state.lookup_of(lookup_state.merged(*[lookup_state.partial_state(kept.filter(F.col("part") == n).drop("part")) for n in range(3)]))


def _patterns(spark, sf):
    orders = features.days_since_prior(td.orders(spark, sf))
    lines = orders_in_set(td.order_lines(spark, sf), orders, "train")
    return patterns.purchase_patterns(lines, orders, td.products(spark, sf))


def _split(spark, sf):
    """Train, test and holdout, as the pipeline cuts them."""
    sales = td.sales(spark, sf).select("product_id", "transaction_id", "date", "units_sold")
    kept, held = split.chrono_split(sales, 1 - split.HOLDOUT_FRACTION)
    train, test = split.chrono_split(kept, split.TRAIN_FRACTION)
    tagged = [df.withColumn("part", F.lit(name)) for name, df in (("train", train), ("test", test), ("holdout", held))]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


_WEEK = ("product_id", "year", "week")
_WEEKLY_DOUBLES = (
    "weekly_revenue", "weekly_profit", "avg_price", "min_price", "max_price", "avg_discount_pct", "avg_inventory",
    "avg_inventory_ratio", "ma4_weekly_sales", "price_change_pct", "demand_change_pct",
)
ROLLING_SQL = """
        select product_id, date, avg(units_sold) over w as moving_avg_7day,
               coalesce(stddev_samp(units_sold) over w, 0) as demand_volatility
        from sales window w as (partition by product_id order by date rows between 6 preceding and current row)"""

CHECKS = [
    Check("weekly_demand", lambda s, d: x.weekly(s, d), "select * from weekly",
          doubles="weekly_revenue weekly_profit avg_price min_price max_price avg_discount_pct avg_inventory avg_inventory_ratio"),
    Check("dept_median", lambda s, d: ranks.lower_median_by(td.catalog(s, d), "department", "base_price", "median_price"), """
        select department, quantile_disc(base_price, 0.5) as median_price from catalog group by department""", doubles="median_price"),
    Check("forecast_summary", lambda s, d: features.forecast_summary(x.forecast(s, d)), """
        select product_id, avg(predicted_units) as predicted_units_avg, avg(predicted_revenue) as predicted_revenue_avg,
               cast(null as double) as confidence_pct_avg from forecast group by product_id""",
        doubles="predicted_units_avg predicted_revenue_avg confidence_pct_avg"),
    Check("weekend_boost", lambda s, d: features.conditional_ratio(td.sales_full(s, d), "is_weekend", "units_sold", "weekend_demand_boost"), """
        select product_id, a / case when b = 0 then 1 else b end as weekend_demand_boost
        from (select product_id, avg(units_sold) filter (where is_weekend = 1) as a, avg(units_sold) filter (where is_weekend = 0) as b
              from sales_full group by product_id)""", doubles="weekend_demand_boost"),
    Check("festival_multiplier", lambda s, d: features.conditional_ratio(
        td.sales(s, d), "festival_flag", "units_sold", "festival_demand_multiplier", default=1.0), """
        select product_id, coalesce(a / case when b = 0 then 1 else b end, 1) as festival_demand_multiplier
        from (select product_id, avg(units_sold) filter (where festival_flag = 1) as a, avg(units_sold) filter (where festival_flag = 0) as b
              from sales group by product_id)""", doubles="festival_demand_multiplier"),
    *[Check(key, plan, "select * from master_lookup", doubles=f"{MASTER_DOUBLES} {MASTER_WHOLE}", dates=MASTER_DATES)
      for key, plan in (("product_lookup", _lookup), ("product_lookup_levels", _lookup_levels))],
    Check("lookup_states", _lookup_states, """
        select l.product_id, product_name, department, d.date, base_price, current_price, cost_price, inventory_level,
               inventory_ratio, units_sold, m.stock_urgency_category
        from sales_lookup l join stock_mode m on m.product_id = l.product_id
        join (select product_id, min(date) as date from sales group by product_id) d on d.product_id = l.product_id""",
        doubles="base_price current_price cost_price inventory_level inventory_ratio units_sold", dates="date"),
    Check("purchase_patterns", _patterns, f"""
        with lines as (select l.*, o.order_hour_of_day, o.order_dow, o.days_since_prior_order, p.p_name
                       from order_lines l join order_gaps o on o.order_id = l.order_id and o.eval_set = 'train'
                       left join part p on p.p_partkey = l.product_id),
        hours as (select product_id, order_hour_of_day as v, row_number() over (partition by product_id order by count(*) desc, order_hour_of_day) as rn
                  from lines group by product_id, order_hour_of_day),
        days as (select product_id, order_dow as v, row_number() over (partition by product_id order by count(*) desc, order_dow) as rn
                 from lines group by product_id, order_dow),
        stats as (select product_id, min(p_name) as product_name, count(distinct order_id) as total_orders, count(*) as total_units,
                         avg(reordered) as rr, avg(add_to_cart_order) as cp, avg(days_since_prior_order) as gap from lines group by product_id)
        select s.product_id, s.product_name, s.total_orders, s.total_units, {rnd("rr", 3)} as reorder_rate, {rnd("cp", 3)} as avg_cart_position,
               h.v as peak_hour, d.v as peak_day, {rnd("gap", 3)} as avg_days_between_orders,
               {rnd("(rr * cast(0.6 as double) + least(1.0, greatest(0.0, 1 - cp / 20.0)) * cast(0.4 as double)) * 100", 1)} as loyalty_index,
               case when total_orders <= 5 then 'Rare' when total_orders <= 20 then 'Occasional' when total_orders <= 50 then 'Frequent'
                    when total_orders > 50 then 'Very Frequent' end as purchase_frequency
        from stats s join hours h on h.product_id = s.product_id and h.rn = 1 join days d on d.product_id = s.product_id and d.rn = 1""",
        doubles="reorder_rate avg_cart_position avg_days_between_orders loyalty_index"),
    Check("rolling_7", lambda s, d: features.rolling_features(td.sales(s, d)).select(
        "product_id", "date", "moving_avg_7day", "demand_volatility"), ROLLING_SQL,
        doubles="moving_avg_7day demand_volatility", dates="date"),
    Check("rolling_7_split", lambda s, d: features.rolling_features_split(td.sales(s, d)).select(
        "product_id", "date", "moving_avg_7day", "demand_volatility"), ROLLING_SQL,
        doubles="moving_avg_7day demand_volatility", dates="date"),
    Check("total_units", lambda s, d: features.with_total(td.sales(s, d)).select("product_id", "date", "total_units_sold"), """
        select product_id, date, cast(sum(units_sold) over (partition by product_id) as bigint) as total_units_sold from sales""", dates="date"),
    Check("lags_weekly", lambda s, d: features.lags_weekly(x.weekly(s, d)).select(*_WEEK, "lag1_weekly_sales", "lag2_weekly_sales"), """
        select product_id, year, week, lag1_weekly_sales, lag2_weekly_sales from weekly_lagged"""),
    Check("ma4_weekly", lambda s, d: features.ma4_weekly(x.weekly(s, d)).select(*_WEEK, "ma4_weekly_sales"), """
        select product_id, year, week, ma4_weekly_sales from weekly_lagged""", doubles="ma4_weekly_sales"),
    Check("pct_changes", lambda s, d: features.pct_changes(x.weekly(s, d)).select(*_WEEK, "price_change_pct", "demand_change_pct"), """
        select product_id, year, week, price_change_pct, demand_change_pct from weekly_changes""",
        doubles="price_change_pct demand_change_pct"),
    Check("elasticity_weekly", lambda s, d: features.elasticity_weekly(features.pct_changes(x.weekly(s, d))).select(*_WEEK, "price_elasticity_est"), """
        select product_id, year, week, elasticity_3 as price_elasticity_est from weekly_elastic""", doubles="price_elasticity_est"),
    Check("weekly_features", lambda s, d: features.weekly_features(x.weekly(s, d)), f"""
        select product_id, product_name, department, year, week, weekly_units_sold, festival_days, weekend_days, transaction_days,
               lag1_weekly_sales, lag2_weekly_sales, {", ".join(f"{rnd(c, 2)} as {c}" for c in _WEEKLY_DOUBLES)},
               {rnd("elasticity_3", 2)} as price_elasticity_est, {rnd("weekly_revenue / nullif(weekly_units_sold, 0)", 2)} as revenue_per_unit,
               case when avg_inventory_ratio < 0.3 then 1 else 0 end as low_stock_flag
        from weekly_elastic""", doubles=" ".join((*_WEEKLY_DOUBLES, "price_elasticity_est", "revenue_per_unit"))),
    Check("recent_trend", lambda s, d: features.recent_stats(td.sales(s, d)), "select * from recent_trend_v",
          doubles="avg_daily std_daily last7 prior7 trend"),
    Check("chrono_split", _split, """
        with kept as (select *, row_number() over (order by date, md5(product_id || ':' || transaction_id)) as rn, count(*) over () as n from sales),
        a as (select * from kept where rn <= cast(floor(n * (1 - 0.15::double)) as bigint)),
        b as (select *, count(*) over () as m from a)
        select product_id, transaction_id, date, units_sold,
               case when rn <= cast(floor(m * (0.70::double / 0.85::double)) as bigint) then 'train' else 'test' end as part from b
        union all
        select product_id, transaction_id, date, units_sold, 'holdout' from kept where rn > cast(floor(n * (1 - 0.15::double)) as bigint)""", dates="date"),
    Check("days_since_prior", lambda s, d: features.days_since_prior(td.orders(s, d)), "select * from order_gaps", dates="order_date"),
    Check("elasticity_table", lambda s, d: x.elasticity(s, d), "select * from elasticity",
          doubles="cost_price current_base_price avg_price_elasticity avg_weekly_demand current_weekly_profit"),
    Check("lerner_price", lambda s, d: x.lerner(s, d), "select * from lerner",
          doubles="cost_price current_base_price avg_price_elasticity recommended_optimal_price avg_weekly_demand"
                  " predicted_demand_at_optimal expected_weekly_profit_at_optimal current_weekly_profit profit_improvement_pct"),
    Check("inventory_status", lambda s, d: x.inventory(s, d), "select * from inventory",
          doubles="daily_avg_sales current_price cost_price days_of_stock_remaining reorder_point_units reorder_quantity inventory_value"),
    Check("price_grid", lambda s, d: x.optimal(s, d), "select * from optimal",
          doubles="cost_price current_price price_elasticity recommended_price price_change_pct predicted_weekly_demand predicted_weekly_revenue"
                  " predicted_weekly_profit current_weekly_profit profit_uplift profit_uplift_pct"),
    Check("sample_products", lambda s, d: reports.sample_products(td.catalog(s, d), 500), """
        select * from catalog order by md5(product_id || ':42'), product_id limit 500""", doubles="base_price cost_price"),
]
