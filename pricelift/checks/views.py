"""SQL forms of the retail tables and of the derived tables, stated from the rules.

A query names the views it needs; ``with_views`` puts them in front of it in order.
"""

from __future__ import annotations

import re


def rnd(expr: str, digits: int) -> str:
    """Half-to-even rounding of the scaled double."""
    return f"(round_even(cast({expr} as double) * 1e{digits}, 0) / 1e{digits})"


def mean(expr: str) -> str:
    """Order-independent mean."""
    coarse = f"(round_even(cast({expr} as double) * 16777216e0, 0) / 16777216e0)"
    rest = f"(round_even((cast({expr} as double) - {coarse}) * 4611686018427387904e0, 0) / 4611686018427387904e0)"
    return f"(avg({coarse}) + avg({rest}))"


def units_at(price: str) -> str:
    """Whole units at a price, for a row of a ``*_ready`` view."""
    return (
        f"greatest(cast(0 as double), round_even(case when base_price is null or base_price = 0 then level"
        f" else level * (1 + e * (({price} - base_price) / base_price)) end, 0))"
    )


VIEWS: dict[str, str] = {}

VIEWS["sales"] = """
select d.transaction_id, d.product_id, p.p_name as product_name, p.p_type as department, d.date,
       case when extract(month from d.date) in (10,12) and extract(day from d.date) >= 20 then 1 else 0 end as festival_flag,
       cast(p.p_retailprice as double) as base_price,
       cast(d.disc * 100 as double) as discount_pct,
       cast(cast(p.p_retailprice as decimal(10,2)) * (1 - d.disc) as double) as current_price,
       cast(cast(p.p_retailprice as decimal(10,2)) * cast((45 + p.p_partkey % 21) * 0.01 as decimal(4,2)) as double) as cost_price,
       cast(d.inv as bigint) as inventory_level,
       cast(least(1.0, d.inv / 100.0) as double) as inventory_ratio,
       cast(d.q as bigint) as units_sold, d.store_id
from (select l_partkey as product_id, cast(l_shipdate as date) as date,
             sum(cast(l_quantity as decimal(12,2))) as q,
             max(cast(l_discount as decimal(4,2))) as disc,
             max((l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 101) as inv,
             min(l_orderkey) as transaction_id, min(l_suppkey) as store_id
      from lineitem group by l_partkey, cast(l_shipdate as date)) d
join part p on p.p_partkey = d.product_id
"""
VIEWS["sales_full"] = """
select *, cast(isodow(date) - 1 as integer) as day_of_week,
       case when isodow(date) >= 6 then 1 else 0 end as is_weekend,
       cast(month(date) as integer) as month,
       cast(8 + transaction_id % 13 as integer) as peak_hour,
       units_sold * current_price as revenue,
       units_sold * (current_price - cost_price) as profit
from sales
"""
VIEWS["sales_raw"] = """
select transaction_id, product_id, product_name,
       case when product_id % 41 = 0 then null else department end as department,
       case when transaction_id % 31 = 0 then 'not a date' else strftime(date, '%Y-%m-%d') end as date,
       current_price,
       case when product_id % 97 = 0 then base_price * 1.2 when product_id % 89 = 0 then null else cost_price end as cost_price,
       case when transaction_id % 53 = 0 then -1 else units_sold end as units_sold
from sales
"""
VIEWS["catalog"] = """
select p_partkey as product_id, p_name as product_name, p_brand as aisle, p_type as department,
       p_retailprice as base_price,
       cast(cast(p_retailprice as decimal(10,2)) * cast((45 + p_partkey % 21) * 0.01 as decimal(4,2)) as double) as cost_price,
       p_size as shelf_life_days, case when p_size <= 14 then 1 else 0 end as is_perishable
from part
"""
VIEWS["orders_v"] = """
select o_orderkey as order_id, o_custkey as user_id, cast(o_orderdate as date) as order_date,
       case when o_orderstatus = 'F' then 'train' else 'prior' end as eval_set,
       cast(isodow(o_orderdate) - 1 as integer) as order_dow,
       cast(o_orderkey % 24 as integer) as order_hour_of_day
from orders
"""
VIEWS["order_gaps"] = """
select *, cast(order_date - lag(order_date) over (partition by user_id order by order_date, order_id) as integer)
            as days_since_prior_order
from orders_v
"""
VIEWS["order_lines"] = """
select l.order_id, l.product_id, l.add_to_cart_order,
       case when row_number() over (partition by o.user_id, l.product_id order by o.order_date, o.order_id) > 1
            then 1 else 0 end as reordered
from (select l_orderkey as order_id, l_partkey as product_id, min(l_linenumber) as add_to_cart_order
      from lineitem group by l_orderkey, l_partkey) l
join orders_v o on o.order_id = l.order_id
"""
VIEWS["price_events"] = """
select event_id, user_id as product_id, cast(1 + event_id % 5 as integer) as units_sold,
       1.0 + value as current_price, cast((event_id % 101) / 100.0 as double) as inventory_ratio,
       ts as event_time
from events where event_type = 'purchase'
"""
VIEWS["lookup_edge"] = """
select p_partkey as product_id, p_name as product_name, p_type as department, p_retailprice as base_price,
       cast(cast(p_retailprice as decimal(10,2)) * cast((95 + p_partkey % 8) * 0.01 as decimal(4,2)) as double) as current_price,
       cast(cast(p_retailprice as decimal(10,2)) * cast((3 + p_partkey % 89) * 0.01 as decimal(4,2)) as double) as cost_price,
       cast(case when p_partkey % 13 = 0 then null else -0.1 - (p_partkey % 50) * 0.1 end as double) as price_elasticity,
       case p_partkey % 3 when 0 then 'Low' when 1 then 'Medium' else 'High' end as price_sensitivity_category,
       case p_partkey % 5 when 0 then 'Critical' when 1 then 'Low' else 'Normal' end as stock_urgency_category,
       case when p_size < 14 and p_partkey % 2 = 0 then 1 else 0 end as expiry_risk_flag,
       cast(p_partkey % 101 as bigint) as inventory_level,
       cast((p_partkey % 101) / 100.0 as double) as inventory_ratio,
       cast(case when p_partkey % 53 = 0 then 0 else 5 + p_partkey % 76 end as double) as baseline_demand
from part
"""

# ---- derived tables

VIEWS["weekly"] = """
select product_id, product_name, department,
       cast(extract(isoyear from date) as integer) as year, cast(extract(week from date) as integer) as week,
       cast(sum(units_sold) as bigint) as weekly_units_sold, sum(revenue) as weekly_revenue, sum(profit) as weekly_profit,
       avg(current_price) as avg_price, min(current_price) as min_price, max(current_price) as max_price,
       avg(discount_pct) as avg_discount_pct, avg(inventory_level) as avg_inventory,
       avg(inventory_ratio) as avg_inventory_ratio,
       cast(sum(festival_flag) as bigint) as festival_days, cast(sum(is_weekend) as bigint) as weekend_days,
       count(transaction_id) as transaction_days
from sales_full
group by product_id, product_name, department, extract(isoyear from date), extract(week from date)
"""
VIEWS["weekly_lagged"] = """
select *, lag(weekly_units_sold, 1) over w as lag1_weekly_sales, lag(weekly_units_sold, 2) over w as lag2_weekly_sales,
       lag(avg_price) over w as price_before,
       avg(weekly_units_sold) over (partition by product_id order by year, week rows between 3 preceding and current row)
         as ma4_weekly_sales
from weekly
window w as (partition by product_id order by year, week)
"""
VIEWS["weekly_changes"] = f"""
select *, {rnd("(avg_price - price_before) / nullif(price_before, 0)", 4)} as price_change_pct,
       {rnd("cast(weekly_units_sold - lag1_weekly_sales as double) / nullif(lag1_weekly_sales, 0)", 4)} as demand_change_pct
from weekly_lagged
"""
VIEWS["weekly_elastic"] = f"""
select *, case when x is not null then least(0.0, greatest(-5.0, {rnd("x", 3)})) end as elasticity_3
from (select *, demand_change_pct / nullif(price_change_pct, 0) as x from weekly_changes)
"""
VIEWS["elasticity"] = f"""
select s.product_id, c.product_name, c.department, c.cost_price, c.base_price as current_base_price,
       {rnd("s.med", 3)} as avg_price_elasticity,
       case when s.med < -1.5 then 'High' when s.med < -0.8 then 'Medium' else 'Low' end as price_sensitivity_category,
       s.avg_weekly_demand, s.current_weekly_profit
from (select product_id, median({rnd("elasticity_3", 2)}) as med, avg(weekly_units_sold) as avg_weekly_demand,
             avg({rnd("weekly_profit", 2)}) as current_weekly_profit
      from weekly_elastic where elasticity_3 is not null group by product_id having count(*) >= 3) s
join catalog c on c.product_id = s.product_id
"""
VIEWS["lerner"] = f"""
select product_id, product_name, department, cost_price, current_base_price, avg_price_elasticity,
       price_sensitivity_category, price as recommended_optimal_price,
       {rnd("avg_weekly_demand", 1)} as avg_weekly_demand, units as predicted_demand_at_optimal,
       {rnd("units * (price - cost_price)", 2)} as expected_weekly_profit_at_optimal,
       current_profit as current_weekly_profit,
       {rnd(f"({rnd('units * (price - cost_price)', 2)} - current_profit) / greatest(1.0, current_profit) * 100", 1)} as profit_improvement_pct
from (
  select *, {rnd("current_weekly_profit", 2)} as current_profit,
         cast(case when price is not null
              then floor(greatest(0.0, avg_weekly_demand * pow(price / current_base_price, e))) end as double) as units
  from (
    select *, case when e <> -1 then greatest(cost_price * 1.05, {rnd("cost_price / nullif(1 + 1 / e, 0)", 2)}) end as price
    from (select *, case when avg_price_elasticity < -0.1 then avg_price_elasticity else cast(-1 as double) end as e
          from elasticity)))
"""
VIEWS["elasticity_raw"] = """
select * replace (
  case when product_id % 29 = 0 then cast('inf' as double) else recommended_optimal_price end as recommended_optimal_price,
  case when product_id % 41 = 0 then null else department end as department)
from lerner
"""
VIEWS["stock"] = """
select s.product_id, c.product_name, c.department, s.current_stock_units, s.daily_avg_sales,
       c.base_price as current_price, c.cost_price
from (select product_id, arg_max(inventory_level, date) as current_stock_units, avg(units_sold) as daily_avg_sales
      from sales group by product_id) s
join catalog c on c.product_id = s.product_id
"""
VIEWS["inventory"] = f"""
select product_id, product_name, department, current_stock_units, daily_avg_sales, current_price, cost_price,
       {rnd("days", 1)} as days_of_stock_remaining, daily_avg_sales * 7 as reorder_point_units,
       daily_avg_sales * 30 as reorder_quantity,
       case when current_stock_units <= daily_avg_sales * 7 then 1 else 0 end as needs_reorder,
       urgency as stock_urgency,
       case urgency when 'CRITICAL' then 'Increase Price - Scarcity' when 'LOW' then 'Slight Price Increase'
         when 'EXCESS' then 'Apply Discount - Clear Stock' when 'HIGH' then 'Monitor - Consider Discount'
         else 'Maintain Current Price' end as pricing_recommendation,
       {rnd("current_stock_units * current_price", 2)} as inventory_value
from (select *, case when days < 3 then 'CRITICAL' when days < 7 then 'LOW' when days > 45 then 'EXCESS'
                     when days > 30 then 'HIGH' else 'NORMAL' end as urgency
      from (select *, case when daily_avg_sales > 0 then current_stock_units / daily_avg_sales else 99 end as days from stock))
"""
VIEWS["grid_points"] = """
select l.*, coalesce(i.stock_urgency, 'NORMAL') as stock, g.i,
       case when avg_price_elasticity < -0.1 then avg_price_elasticity else cast(-1 as double) end as e,
       case when g.i = 6 then current_base_price * 1.5
            else l.cost_price * 1.05 + g.i * ((current_base_price * 1.5 - l.cost_price * 1.05) / 6) end as p
from lerner l left join inventory i on i.product_id = l.product_id, range(7) g(i)
"""
VIEWS["optimal"] = f"""
select product_id, product_name, department, cost_price, base as current_price, e as price_elasticity,
       price_sensitivity, stock as stock_urgency, price as recommended_price,
       {rnd("(price - base) / base * 100", 1)} as price_change_pct, {rnd("units", 1)} as predicted_weekly_demand,
       {rnd("units * price", 2)} as predicted_weekly_revenue, {rnd("units * (price - cost_price)", 2)} as predicted_weekly_profit,
       current_weekly_profit, {rnd("units * (price - cost_price) - current_weekly_profit", 2)} as profit_uplift,
       {rnd("(units * (price - cost_price) - current_weekly_profit) / greatest(1.0, current_weekly_profit) * 100", 1)} as profit_uplift_pct,
       printf('Elasticity %.2f, Stock:%s', {rnd("e", 2)}, stock) as optimization_reason
from (
  select *, greatest(0.0, avg_weekly_demand * pow(price / base, e)) as units
  from (
    select *, {rnd("case stock when 'EXCESS' then chosen * 0.85 when 'CRITICAL' then chosen * 1.10 else chosen end", 2)} as price
    from (
      select product_id, any_value(product_name) as product_name, any_value(department) as department,
             any_value(cost_price) as cost_price, any_value(current_base_price) as base, any_value(e) as e,
             any_value(price_sensitivity_category) as price_sensitivity, any_value(stock) as stock,
             any_value(avg_weekly_demand) as avg_weekly_demand, any_value(current_weekly_profit) as current_weekly_profit,
             case when max(pr) > 0 then arg_max(p, row(pr, -i)) else any_value(current_base_price) end as chosen
      from (select *, greatest(0.0, avg_weekly_demand * pow(p / current_base_price, e)) * (p - cost_price) as pr from grid_points)
      group by product_id)))
"""
VIEWS["sales_lookup"] = f"""
select product_id, any_value(product_name) as product_name, any_value(department) as department,
       {mean("base_price")} as base_price, {mean("cost_price")} as cost_price, {mean("current_price")} as current_price,
       {mean("inventory_level")} as inventory_level, {mean("inventory_ratio")} as inventory_ratio,
       {mean("units_sold")} as units_sold
from sales group by product_id
"""
VIEWS["stock_mode"] = """
select product_id, cat as stock_urgency_category
from (select product_id, cat, row_number() over (partition by product_id order by count(*) desc, cat) as rn
      from (select product_id, case when inventory_ratio < 0.2 then 'Critical' when inventory_ratio > 0.7 then 'Low'
                                    else 'Normal' end as cat from sales)
      group by product_id, cat)
where rn = 1
"""
VIEWS["pricing_input"] = """
select l.*, m.stock_urgency_category, l.units_sold as baseline_demand, cast(1 as double) as seasonal_factor,
       case when c.is_perishable = 1 and c.shelf_life_days < 14 then 1 else 0 end as expiry_risk_flag,
       coalesce(x.price_sensitivity_category, 'Medium') as price_sensitivity_category,
       x.avg_price_elasticity as price_elasticity
from sales_lookup l join stock_mode m on m.product_id = l.product_id
left join catalog c on c.product_id = l.product_id
left join lerner x on x.product_id = l.product_id
"""


def pricing_views(source: str, prefix: str, seasonal: str, extra: str = "") -> None:
    """Views ``<prefix>_ready``, ``_priced`` and ``_results`` over a lookup view."""
    VIEWS[f"{prefix}_ready"] = f"""
select *, least(-0.1, greatest(-5.0, coalesce(price_elasticity, -1.0))) as e,
       greatest(0.0, baseline_demand) * {seasonal} as level,
       greatest({rnd("base_price * 1.10", 2)}, cost_price * 1.05) as markup
from {source}
"""
    VIEWS[f"{prefix}_decided"] = f"""
select *,
       case when price_sensitivity_category = 'Low' then
              case when (markup - cost_price) * {units_at("markup")} < (current_price - cost_price) * {units_at("current_price")}
                   then 'inelastic_no_change' else 'inelastic_markup' end
            when expiry_risk_flag = 1 then 'expiry_discount'
            else 'elasticity_optimized' end as optimization_method,
       least(case when cost_price * 1.05 >= base_price * 1.5 then cost_price * 1.05 * 1.2 else base_price * 1.5 end,
             greatest(cost_price * 1.05, (cost_price + base_price * (1 - 1 / e)) / 2)) as peak
from {prefix}_ready
"""
    VIEWS[f"{prefix}_priced"] = f"""
select *,
       case optimization_method
         when 'inelastic_no_change' then {rnd("current_price", 2)}
         when 'inelastic_markup' then markup
         when 'expiry_discount' then {rnd("greatest(cost_price * 1.02, base_price * 0.75)", 2)}
         else {rnd("least(base_price * 1.5, greatest(cost_price * 1.05, case when stock_urgency_category = 'Critical' then least(peak, base_price * 1.15) else peak end))", 2)}
       end as recommended_price
from {prefix}_decided
"""
    VIEWS[f"{prefix}_results"] = f"""
select product_id, product_name, department, cost_price, current_price, recommended_price, price_change_pct,
       predicted_demand, predicted_profit, current_profit,
       case when optimization_method <> 'expiry_discount' then uplift end as profit_uplift,
       case when optimization_method <> 'expiry_discount'
            then case when current_profit = 0 then 0.0 else {rnd("uplift / current_profit * 100", 1)} end end as profit_uplift_pct,
       case when optimization_method = 'expiry_discount' then {rnd("inventory_level * recommended_price", 2)} end as spoilage_savings_estimate,
       optimization_method, inventory_ratio, stock_urgency_category, price_elasticity, price_sensitivity_category{extra}
from (
  select *, {rnd("predicted_profit - current_profit", 2)} as uplift
  from (
    select *, {rnd("(recommended_price - cost_price) * predicted_demand", 2)} as predicted_profit,
           {rnd("(current_price - cost_price) * units_now", 2)} as current_profit,
           case when current_price = 0 then 0.0 else {rnd("(recommended_price / current_price - 1) * 100", 1)} end as price_change_pct
    from (select *, {units_at("recommended_price")} as predicted_demand, {units_at("current_price")} as units_now
          from {prefix}_priced)))
"""


pricing_views("lookup_edge", "edge", "1.0")
pricing_views("pricing_input", "shop", "seasonal_factor")

VIEWS["recent"] = """
select product_id, count(*) as recent_rows, avg(units_sold) as avg_daily, stddev_samp(units_sold) as std_daily,
       avg(units_sold) filter (where rn <= 7) as last7,
       avg(units_sold) filter (where rn <= least(14, n) and rn > least(14, n) - 7) as prior7
from (select product_id, units_sold, row_number() over (partition by product_id order by date desc) as rn,
             count(*) over (partition by product_id) as n from sales)
where rn <= 30 group by product_id
"""
VIEWS["recent_trend_v"] = """
select *, (last7 - prior7) / greatest(avg_daily, 1) as trend from recent
"""
VIEWS["forecast_prices"] = """
select c.product_id, coalesce(o.recommended_price, c.base_price) as recommended_price
from catalog c left join optimal o on o.product_id = c.product_id
"""
VIEWS["forecast"] = f"""
select product_id, d as forecast_date, cast(isodow(d) - 1 as integer) as day_of_week,
       case when isodow(d) >= 6 then 1 else 0 end as is_weekend, cast(month(d) as integer) as month,
       case when month(d) = 10 and day(d) >= 20 then 1 else 0 end as festival_flag,
       {rnd("u", 1)} as predicted_units, {rnd("greatest(0.0, u - std_daily)", 1)} as predicted_units_lower,
       {rnd("u + std_daily", 1)} as predicted_units_upper, recommended_price, {rnd("u * recommended_price", 2)} as predicted_revenue
from (
  select *, greatest(0.0, avg_daily
           * (case when month(d) in (11, 12) then cast(1.3 as double) when month(d) in (6, 7, 8) then cast(1.1 as double) else cast(1 as double) end
            * case when isodow(d) >= 6 then cast(1.35 as double) else cast(1 as double) end
            * case when month(d) = 10 and day(d) >= 20 then cast(1.2 as double) else cast(1 as double) end)
           * (1 + trend * (i / cast(30 as double)))) as u
  from (select r.*, p.recommended_price, g.i, cast(date '2001-10-10' + cast(g.i as integer) as date) as d
        from recent_trend_v r left join forecast_prices p on p.product_id = r.product_id, range(30) g(i)
        where r.recent_rows >= 10))
"""
#: Columns of the wide table by kind, in no order; the lookup takes the mean of numbers and the mode of the others.
MASTER_DOUBLES = (
    "base_price discount_pct current_price cost_price inventory_ratio revenue profit moving_avg_7day demand_volatility weekend_demand_boost"
    " festival_demand_multiplier base_price_cat cost_price_cat gross_margin_pct cost_price_elas current_base_price avg_price_elasticity"
    " recommended_optimal_price avg_weekly_demand predicted_demand_at_optimal expected_weekly_profit_at_optimal current_weekly_profit"
    " profit_improvement_pct cost_price_opt current_price_opt price_elasticity recommended_price price_change_pct predicted_weekly_demand"
    " predicted_weekly_revenue predicted_weekly_profit current_weekly_profit_opt profit_uplift profit_uplift_pct predicted_units_avg"
    " predicted_revenue_avg confidence_pct_avg inventory_urgency_score price_to_cost_ratio profit_margin_pct competitor_price_gap"
)
MASTER_WHOLE = (
    "transaction_id festival_flag inventory_level units_sold store_id day_of_week is_weekend month peak_hour total_units_sold shelf_life_days"
    " is_perishable store_id_cat sensitivity_encoded expiry_risk_flag"
)
MASTER_DATES = "date date_only created_date optimization_date"
MASTER_TEXTS = (
    "product_name department product_name_cat aisle department_cat product_name_elas department_elas price_sensitivity_category"
    " product_name_opt department_opt price_sensitivity stock_urgency optimization_reason"
)
VIEWS["master"] = f"""
select s.*, s.date as date_only, strftime(s.date, '%Y-%m') as year_month,
       avg(s.units_sold) over w as moving_avg_7day, coalesce(stddev_samp(s.units_sold) over w, 0) as demand_volatility,
       cast(sum(s.units_sold) over (partition by s.product_id) as bigint) as total_units_sold,
       b.wk / case when b.wd = 0 then 1 else b.wd end as weekend_demand_boost,
       coalesce(b.fe / case when b.nf = 0 then 1 else b.nf end, 1) as festival_demand_multiplier,
       c.product_name as product_name_cat, c.aisle, c.department as department_cat, c.base_price as base_price_cat, c.cost_price as cost_price_cat,
       {rnd("(c.base_price - c.cost_price) / nullif(c.base_price, 0) * 100", 1)} as gross_margin_pct, c.shelf_life_days, c.is_perishable,
       case when c.product_id is not null then cast(1 as bigint) end as store_id_cat,
       case when c.product_id is not null then date '2024-01-01' end as created_date,
       l.product_name as product_name_elas, l.department as department_elas, l.cost_price as cost_price_elas, l.current_base_price,
       l.avg_price_elasticity, l.price_sensitivity_category, coalesce(l.recommended_optimal_price, m.med) as recommended_optimal_price,
       l.avg_weekly_demand, l.predicted_demand_at_optimal, l.expected_weekly_profit_at_optimal, l.current_weekly_profit, l.profit_improvement_pct,
       case when l.product_id is not null then case l.price_sensitivity_category when 'High' then 3 when 'Medium' then 2 else 1 end end as sensitivity_encoded,
       o.product_name as product_name_opt, o.department as department_opt, o.cost_price as cost_price_opt, o.current_price as current_price_opt,
       o.price_elasticity, o.price_sensitivity, o.stock_urgency, o.recommended_price, o.price_change_pct, o.predicted_weekly_demand,
       o.predicted_weekly_revenue, o.predicted_weekly_profit, o.current_weekly_profit as current_weekly_profit_opt, o.profit_uplift, o.profit_uplift_pct,
       o.optimization_reason, case when o.product_id is not null then date '2001-10-10' end as optimization_date,
       f.u as predicted_units_avg, f.r as predicted_revenue_avg, cast(null as double) as confidence_pct_avg,
       1 - s.inventory_ratio as inventory_urgency_score, s.current_price / nullif(s.cost_price, 0) as price_to_cost_ratio,
       case when c.is_perishable = 1 and c.shelf_life_days < 14 then 1 else 0 end as expiry_risk_flag,
       (s.current_price - s.cost_price) / nullif(s.current_price, 0) * 100 as profit_margin_pct,
       case when s.inventory_ratio < 0.2 then 'Critical' when s.inventory_ratio > 0.7 then 'Low' else 'Normal' end as stock_urgency_category,
       coalesce(l.recommended_optimal_price, m.med) - s.current_price as competitor_price_gap
from sales_full s
left join catalog c on c.product_id = s.product_id
left join lerner l on l.product_id = s.product_id
left join (select department, quantile_disc(current_base_price, 0.5) as med from lerner group by department) m on m.department = l.department
left join optimal o on o.product_id = s.product_id
left join (select product_id, avg(predicted_units) as u, avg(predicted_revenue) as r from forecast
           where predicted_units_lower <= predicted_units and predicted_units <= predicted_units_upper
             and not (predicted_units_lower = 0 and predicted_units = 0 and predicted_units_upper = 0)
           group by product_id) f on f.product_id = s.product_id
left join (select product_id, avg(units_sold) filter (where is_weekend = 1) as wk, avg(units_sold) filter (where is_weekend = 0) as wd,
                  avg(units_sold) filter (where festival_flag = 1) as fe, avg(units_sold) filter (where festival_flag = 0) as nf
           from sales_full group by product_id) b on b.product_id = s.product_id
window w as (partition by s.product_id order by s.date rows between 6 preceding and current row)
"""
# a product has one row per date, so all its dates are as frequent and the first one wins; texts depend on the product
VIEWS["master_lookup"] = f"""
select a.*, y.year_month, k.stock_urgency_category
from (select product_id, {", ".join(f"{mean(c)} as {c}" for c in MASTER_DOUBLES.split())}, {", ".join(f"avg({c}) as {c}" for c in MASTER_WHOLE.split())},
             {", ".join(f"min({c}) as {c}" for c in (MASTER_DATES + " " + MASTER_TEXTS).split())} from master group by product_id) a
join (select product_id, year_month, row_number() over (partition by product_id order by count(*) desc, year_month) as rn from master group by product_id, year_month) y
  on y.product_id = a.product_id and y.rn = 1
join (select product_id, stock_urgency_category, row_number() over (partition by product_id order by count(*) desc, stock_urgency_category) as rn
      from master group by product_id, stock_urgency_category) k on k.product_id = a.product_id and k.rn = 1
"""
VIEWS["seasonal_levels"] = """
select product_id, case when grouping(wd) = 0 then 'weekday' when grouping(mo) = 0 then 'month' when grouping(f) = 0 then 'festival' else 'all' end as kind,
       coalesce(wd, mo, f) as bucket, cast(sum(u) as double) / count(*) as every, cast(sum(u) filter (where f = 0) as double) / count(*) filter (where f = 0) as usual,
       cast(count(*) as double) as n, cast(sum(x) as double) as sx, cast(sum(u) as double) as sy, cast(sum(x * x) as double) as sxx,
       cast(sum(x * u) as double) as sxy, cast(sum(u * u) as double) as syy
from (select product_id, units_sold as u, festival_flag as f, date_diff('day', date '2000-01-01', date) as x,
             cast(isodow(date) - 1 as integer) as wd, cast(month(date) as integer) as mo from sales where date is not null)
group by grouping sets ((product_id), (product_id, wd), (product_id, mo), (product_id, f))
"""
VIEWS["seasonal_rows"] = """
select product_id, kind, bucket, usual as mean_units from seasonal_levels where kind in ('weekday', 'month') and usual is not null
union all select product_id, kind, bucket, every from seasonal_levels where kind = 'festival' and bucket = 1
union all select product_id, 'all', null, coalesce(usual, every) from seasonal_levels where kind = 'all'
union all select product_id, 'trend', null, coalesce((n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0), 0) from seasonal_levels where kind = 'all'
union all select product_id, 'centre', null, sx / n from seasonal_levels where kind = 'all'
union all select product_id, 'spread', null, case when n > 1 then sqrt(greatest(0, (syy - sy * sy / n) / (n - 1))) end from seasonal_levels where kind = 'all'
"""
VIEWS["seasonal_indices"] = """
select l.*, case when l.kind not in ('trend', 'centre', 'spread') then l.mean_units / nullif(a.mean_units, 0) end as seasonal_index
from seasonal_rows l join seasonal_rows a on a.product_id = l.product_id and a.kind = 'all'
"""
VIEWS["seasonal_days"] = """
select product_id, ds, yhat, greatest(0, yhat - half) as yhat_lower, yhat + half as yhat_upper from (
  select a.product_id, g.ds, cast(1.2816 as double) * coalesce(s.mean_units, 0) as half,
         greatest(0, (a.mean_units + t.mean_units * (date_diff('day', date '2000-01-01', g.ds) - c.mean_units))
                  * coalesce(w.seasonal_index, 1) * coalesce(m.seasonal_index, 1)
                  * case when month(g.ds) in (10, 12) and day(g.ds) >= 20 then coalesce(f.seasonal_index, 1) else 1 end) as yhat
  from seasonal_indices a
  join (select cast(d as date) as ds from range(timestamp '2001-10-10', timestamp '2001-11-09', interval 1 day) t(d)) g on true
  join seasonal_indices t on t.product_id = a.product_id and t.kind = 'trend'
  join seasonal_indices c on c.product_id = a.product_id and c.kind = 'centre'
  join seasonal_indices s on s.product_id = a.product_id and s.kind = 'spread'
  left join seasonal_indices f on f.product_id = a.product_id and f.kind = 'festival'
  left join seasonal_indices w on w.product_id = a.product_id and w.kind = 'weekday' and w.bucket = isodow(g.ds) - 1
  left join seasonal_indices m on m.product_id = a.product_id and m.kind = 'month' and m.bucket = month(g.ds)
  where a.kind = 'all')
"""
# training rows lie before the date, test rows after it
VIEWS["predictions"] = """
select t.product_id, t.product_name, t.date, t.units_sold, coalesce(m.mu, g.mu) as naive_pred,
       0.8 * coalesce(m.mu, g.mu) + 0.2 * g.mu as prediction
from sales t
left join (select product_id, avg(units_sold) as mu from sales where date < date '2000-06-01' group by product_id) m
  on m.product_id = t.product_id
cross join (select avg(units_sold) as mu from sales where date < date '2000-06-01') g
"""
VIEWS["product_errors"] = """
select product_id, avg(abs((units_sold - prediction) / (units_sold + 1)) * 100) as mape,
       min(product_name) as product_name, count(*) as n_test_rows
from predictions where date >= date '2000-06-01' group by product_id
"""
VIEWS["windows"] = """
select epoch(time_bucket(interval 1 hour, event_time)) as t0, product_id, cast(sum(units_sold) as bigint) as window_units,
       avg(current_price) as avg_price, avg(inventory_ratio) as avg_inventory, count(*) as orders
from price_events group by all
"""

# the live row behind each window: the lookup row, or the fallback for unknown products
VIEWS["live"] = """
select w.t0, w.product_id, w.window_units, w.avg_price, w.avg_inventory, l.product_id is null as is_new,
       coalesce(l.product_name, 'Unknown_Product_' || w.product_id) as product_name,
       coalesce(l.department, 'Unclassified') as department, coalesce(l.base_price, w.avg_price) as base_price,
       w.avg_price as current_price,
       coalesce(l.cost_price, round_even(w.avg_price * 0.7::double * 1e2, 0) / 1e2) as cost_price,
       coalesce(l.stock_urgency_category, 'Unknown') as stock_urgency_category,
       case when l.product_id is null then -1.0::double else l.price_elasticity end as price_elasticity,
       coalesce(l.price_sensitivity_category, 'Medium') as price_sensitivity_category,
       coalesce(l.expiry_risk_flag, 0) as expiry_risk_flag, coalesce(l.inventory_level, 0) as inventory_level,
       w.avg_inventory as inventory_ratio, coalesce(l.baseline_demand, cast(w.window_units as double)) as baseline_demand
from windows w left join (select * from lookup_edge where product_id % 3 <> 1) l on l.product_id = w.product_id
"""
pricing_views("live", "live", "1.0", extra=", t0, is_new")


def with_views(sql: str) -> str:
    """The query with every view it needs, directly or not, in front of it."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                needed.add(name)
                todo.append(body)
    if not needed:
        return sql
    if sql.lstrip().startswith("with "):
        sql = f"select * from (\n{sql}\n) as q"
    # views are defined before they are used, so definition order is a valid order
    parts = [f"{name} as ({VIEWS[name].strip()})" for name in VIEWS if name in needed]
    return "with " + ",\n".join(parts) + "\n" + sql
