"""Figures over the results table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import inputs as x
from .base import Check
from .views import mean
from ..operators import reports

_GOOD = "edge_results where optimization_method <> 'expiry_discount'"
_EXPIRY = "edge_results where optimization_method = 'expiry_discount'"
STOCK_LEVELS = ("Critical", "Low", "Normal")


def _r(build):
    return lambda spark, sf: build(x.edge_results(spark, sf))


# replies written from the rows: fenced, plain, incomplete, broken, an array and none at all
def _replies(results):
    pid = F.col("product_id")
    body = F.format_string(
        '{"explanation": "Move %s", "confidence_label": "High", "confidence_pct": %d, "reasoning": "stock"}',
        F.col("optimization_method"), pid % 101,
    )
    reply = (
        F.when(pid % 7 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(pid % 7 == 1, body)
        .when(pid % 7 == 2, F.lit('  {"explanation": "only this", "reasoning": "  "} '))
        .when(pid % 7 == 3, F.lit("The price should rise. "))
        .when(pid % 7 == 4, F.lit('{"explanation": "cut off'))
        .when(pid % 7 == 5, F.lit('{"confidence_pct": 12.9, "confidence_label": "Low"}'))
    )
    return results.select("product_id", reply.alias("reply"), F.lit("fallback text").alias("fallback"))


CHECKS = [
    Check("kpi_totals", _r(reports.kpi_totals), f"""
        select coalesce(cast(sum(cast(profit_uplift as decimal(28,6))) filter (where optimization_method <> 'expiry_discount') as double), 0) as total_uplift,
               {mean("case when optimization_method <> 'expiry_discount' then profit_uplift_pct end")} as mean_uplift_pct,
               count(*) filter (where optimization_method <> 'expiry_discount') as comparable_rows, count(*) as n_rows,
               {mean('price_change_pct')} as mean_price_change_pct, count(*) filter (where price_change_pct > 0) as price_increases,
               count(*) filter (where price_change_pct < 0) as price_cuts,
               coalesce(cast(sum(cast(spoilage_savings_estimate as decimal(28,6))) filter (where optimization_method = 'expiry_discount') as double), 0) as spoilage_total,
               count(*) filter (where stock_urgency_category = 'Critical') as critical_rows
        from edge_results""", doubles="total_uplift mean_uplift_pct mean_price_change_pct spoilage_total"),
    Check("top_department", _r(reports.top_department), f"""
        select department, u as department_uplift, u / t * 100 as share_pct
        from (select department, u, cast(sum(cast(u as decimal(28,6))) over () as double) as t, row_number() over (order by u desc, department) as rn
              from (select department, cast(sum(cast(profit_uplift as decimal(28,6))) as double) as u from {_GOOD} group by department))
        where rn = 1 and t > 0 and u > 0""", doubles="department_uplift share_pct"),
    Check("uplift_by_method", _r(lambda r: reports.uplift_by(r, "optimization_method", total=True)), f"""
        select coalesce(optimization_method, 'Total') as optimization_method, cast(sum(cast(profit_uplift as decimal(28,6))) as double) as profit_uplift
        from {_GOOD} group by rollup (optimization_method)""", doubles="profit_uplift"),
    Check("uplift_by_department", _r(lambda r: reports.uplift_by(r, "department").orderBy(F.col("profit_uplift").desc())), f"""
        select department, cast(sum(cast(profit_uplift as decimal(28,6))) as double) as profit_uplift from {_GOOD} group by department order by 2 desc""", doubles="profit_uplift"),
    Check("uplift_by_dept_method", _r(lambda r: reports.uplift_by(r, "department", "optimization_method")), f"""
        select department, optimization_method, cast(sum(cast(profit_uplift as decimal(28,6))) as double) as profit_uplift from {_GOOD} group by all""", doubles="profit_uplift"),
    Check("method_counts", _r(lambda r: reports.value_counts(r, "optimization_method")), """
        select optimization_method, count(*) as n_rows, count(*) / cast(sum(count(*)) over () as double) * 100 as share_pct
        from edge_results group by optimization_method""", doubles="share_pct"),
    Check("urgency_crosstab", _r(lambda r: reports.crosstab(r, "department", "stock_urgency_category", STOCK_LEVELS)), """
        select department, count(*) filter (where stock_urgency_category = 'Critical') as "Critical",
               count(*) filter (where stock_urgency_category = 'Low') as "Low",
               count(*) filter (where stock_urgency_category = 'Normal') as "Normal" from edge_results group by department"""),
    Check("elasticity_correlation", _r(reports.elasticity_correlation), f"""
        select count(*) as n_rows, corr(price_elasticity, profit_uplift) as correlation
        from (select * from {_GOOD}) where price_elasticity is not null and profit_uplift is not null""", doubles="correlation"),
    Check("catalog_summary", _r(reports.catalog_summary), """
        select count(*) as n_rows, count(distinct department) as n_departments, count(distinct optimization_method) as n_methods
        from edge_results"""),
    Check("sort_results", _r(reports.sort_results), """
        select product_id, product_name, department, current_price, recommended_price, price_change_pct, predicted_demand, profit_uplift,
               optimization_method, stock_urgency_category from edge_results order by profit_uplift desc nulls last, product_id""",
        doubles="current_price recommended_price price_change_pct predicted_demand profit_uplift"),
    Check("top_spoilage", _r(reports.top_spoilage), f"""
        select product_id, product_name, current_price, recommended_price, spoilage_savings_estimate from {_EXPIRY}
        order by spoilage_savings_estimate desc, product_id limit 15""", doubles="current_price recommended_price spoilage_savings_estimate"),
    Check("expiry_table", _r(reports.expiry_table), f"""
        select product_id, product_name, current_price, recommended_price, spoilage_savings_estimate from {_EXPIRY}
        order by spoilage_savings_estimate desc, product_id""", doubles="current_price recommended_price spoilage_savings_estimate"),
    Check("first_rows", _r(reports.first_rows), """
        select product_id, product_name, recommended_price, profit_uplift from edge_results order by product_id limit 10""",
        doubles="recommended_price profit_uplift"),
    Check("scatter_points", _r(reports.scatter_points), f"""
        select product_id, product_name, department, price_change_pct, profit_uplift, current_price, recommended_price,
               greatest(current_profit, 1) as bubble_size from {_GOOD}""",
        doubles="price_change_pct profit_uplift current_price recommended_price bubble_size"),
    Check("rule_explanation", _r(reports.rule_explanation), """
        select product_id,
               printf('New price $%.2f (%+.1f%%): ', recommended_price, price_change_pct)
                 || case when profit_uplift is null then 'clears stock ahead of its expiry date.' else printf('adds an estimated $%.2f a week.', profit_uplift) end as explanation,
               'Unavailable' as confidence_label, cast(null as integer) as confidence_pct,
               'Rule-based summary; no analyst explanation was available.' as reasoning
        from edge_results"""),
    Check("explanation_prompt", _r(reports.explanation_prompt), """
        select product_id,
          'Explain this retail price to a manager. Answer only with JSON holding explanation, confidence_label (High, Medium or Low), confidence_pct (0-100) and reasoning.'
          || chr(10) || 'product=' || product_name || chr(10) || 'department=' || department
          || chr(10) || printf('current=$%.2f', current_price) || chr(10) || printf('recommended=$%.2f', recommended_price)
          || chr(10) || printf('change=%+.1f%%', price_change_pct) || chr(10) || 'sensitivity=' || price_sensitivity_category
          || chr(10) || 'stock=' || stock_urgency_category || chr(10)
          || case when profit_uplift is null then 'uplift=not comparable, expiry markdown' else printf('uplift=$%.2f', profit_uplift) end as prompt
        from edge_results"""),
    Check("parse_explanation", _r(lambda r: reports.parse_explanation(_replies(r))), """
        select product_id,
               case product_id % 7 when 2 then 'only this' when 3 then 'The price should rise.' when 4 then '{"explanation": "cut off'
                 when 5 then 'fallback text' when 6 then 'fallback text' else 'Move ' || optimization_method end as explanation,
               case product_id % 7 when 2 then 'Medium' when 3 then 'Unavailable' when 4 then 'Unavailable' when 5 then 'Low'
                 when 6 then 'Unavailable' else 'High' end as confidence_label,
               case product_id % 7 when 2 then null when 3 then null when 4 then null when 5 then 12 when 6 then null
                 else cast(product_id % 101 as integer) end as confidence_pct,
               case product_id % 7 when 2 then 'No specific reasoning was returned.' when 3 then 'The reply could not be read as structured data.'
                 when 4 then 'The reply could not be read as structured data.' when 5 then 'No specific reasoning was returned.'
                 when 6 then 'Rule-based summary; no analyst explanation was available.' else 'stock' end as reasoning
        from edge_results"""),
]
