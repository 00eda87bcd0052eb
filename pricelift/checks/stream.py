"""The streaming transformations, run in batch on the same rows."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from . import inputs as x
from .base import Check
from ..operators import reports
from ..session import ensure_checkpoint_dir
from ..sources import testdata as td
from ..streaming import events, keyed, late, scoring


def _epoch(df, *names):
    return df.withColumns({n: F.unix_timestamp(n) for n in names})


def _parsed(spark, sf):
    parsed = events.parse_events(td.event_json(spark, sf))
    return _epoch(parsed.select("product_id", "units_sold", "current_price", "inventory_ratio", "event_time"), "event_time")


def _fallback(spark, sf):
    rows = scoring.with_fallback(scoring.lookup_enrich(x.windows(spark, sf), x.event_lookup(spark, sf)))
    return _epoch(rows.select(
        "window_start", "product_id", "is_new_product", "product_name", "department", "base_price", "current_price", "cost_price",
        "price_to_cost_ratio", "inventory_ratio", "price_elasticity", "stock_urgency_category", "units_sold", "baseline_demand",
    ), "window_start")


def _scored(spark, sf):
    rows = scoring.score_windows(x.windows(spark, sf), x.event_lookup(spark, sf))
    return _epoch(rows.drop("window_end"), "window_start")


def _log(spark, sf):
    rows = scoring.score_windows(x.windows(spark, sf), x.event_lookup(spark, sf), keep=scoring.TRAINING_INPUTS)
    return _epoch(scoring.training_rows(rows).drop("window_end"), "window_start")


def _revisions(spark, sf):
    """Each window written twice by different batches; the newer batch must win."""
    w = x.windows(spark, sf).select("window_start", "window_end", "product_id", "window_units")
    early = w.select("*", (F.col("product_id") % 4).alias("batch_id")).withColumn("window_units", F.col("window_units") - 1)
    late = w.select("*", (F.lit(4) + F.col("product_id") % 3).alias("batch_id"))
    return _epoch(scoring.latest_revision(early.unionByName(late)).drop("window_end"), "window_start")


def _keyed(spark, sf):
    """Windows written by three batches, the last of which revises half of them, to a sink with one row per key."""
    sink = keyed.KeyedSink(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/keyed-{uuid.uuid4().hex}", buckets=2)
    w = x.windows(spark, sf).select("window_start", "window_end", "product_id", "window_units")
    late = F.col("product_id") % 2 == 0
    early = w.withColumn("window_units", F.when(late, F.col("window_units") - 1).otherwise(F.col("window_units")))
    first = F.col("product_id") % 3 == 0
    for batch, rows in enumerate((early.filter(first), early.filter(~first), w.filter(late))):
        sink.upsert(rows, keyed.version_name("run", batch))
    sink.vacuum()
    return _epoch(sink.read().drop("window_end"), "window_start")


def _late(spark, sf):
    """Windows of a stream that saw nine events in ten."""
    e = td.price_events(spark, sf)
    fields = F.struct("product_id", "units_sold", "current_price", "inventory_ratio", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    written = events.flat_window(events.tumbling_demand(e.filter(F.col("event_id") % 10 != 0), "1 hour"))
    found = late.late_windows(e.select(F.to_json(fields).alias("value")), written, None, "2100-01-01 00:00:00", "1 hour")
    return _epoch(found.drop("window_end", "avg_price", "avg_inventory"), "window_start")


CHECKS = [
    Check("update_output", _keyed, "select cast(t0 as bigint) as window_start, product_id, window_units from windows"),
    Check("watermark_late", _late, """
        select cast(epoch(time_bucket(interval 1 hour, event_time)) as bigint) as window_start, product_id, cast(sum(units_sold) as bigint) as window_units,
               count(*) as orders, count(*) filter (where event_id % 10 = 0) as late_orders,
               cast(coalesce(sum(units_sold) filter (where event_id % 10 = 0), 0) as bigint) as late_units
        from price_events group by 1, 2 having count(*) filter (where event_id % 10 = 0) > 0"""),
    Check("parse_events", _parsed, """
        select cast(user_id as integer) as product_id, cast(1 + event_id % 5 as integer) as units_sold,
               cast(1 + event_id % 40 as double) as current_price, cast((event_id % 101) / 100.0 as double) as inventory_ratio,
               cast(floor(epoch(ts)) as bigint) as event_time
        from events where event_id % 17 <> 0 and event_id % 19 <> 0 and event_id % 23 <> 0""", doubles="current_price inventory_ratio"),
    Check("tumbling_demand", lambda s, d: _epoch(x.windows(s, d).drop("window_end"), "window_start"), """
        select cast(t0 as bigint) as window_start, product_id, window_units, avg_price, avg_inventory, orders from windows""",
        doubles="avg_price avg_inventory"),
    Check("lookup_enrich", lambda s, d: _epoch(scoring.lookup_enrich(x.windows(s, d), td.lookup_edge(s, d)).select(
        "window_start", "product_id", "product_name", "base_price", "current_price", "units_sold", "inventory_ratio", "is_new_product"), "window_start"), """
        select cast(t0 as bigint) as window_start, w.product_id, l.product_name, l.base_price, w.avg_price as current_price,
               w.window_units as units_sold, w.avg_inventory as inventory_ratio, case when l.product_id is null then 1 else 0 end as is_new_product
        from windows w left join lookup_edge l on l.product_id = w.product_id""", doubles="base_price current_price inventory_ratio"),
    Check("new_product_fallback", _fallback, """
        select cast(t0 as bigint) as window_start, product_id, case when is_new then 1 else 0 end as is_new_product, product_name, department,
               base_price, current_price, cost_price,
               case when is_new then case when cost_price = 0 then 1 else round_even(current_price / cost_price * 1e2, 0) / 1e2 end end as price_to_cost_ratio,
               inventory_ratio, price_elasticity, stock_urgency_category, window_units as units_sold, baseline_demand from live""",
        doubles="base_price current_price cost_price price_to_cost_ratio inventory_ratio price_elasticity baseline_demand"),
    Check("micro_batch_score", _scored, """
        select * exclude (price_elasticity, price_sensitivity_category, t0, is_new), cast(t0 as bigint) as window_start,
               case when is_new then 1 else 0 end as is_new_product from live_results""",
        doubles="cost_price current_price recommended_price price_change_pct predicted_demand predicted_profit current_profit"
                " profit_uplift profit_uplift_pct spoilage_savings_estimate inventory_ratio"),
    Check("training_log", _log, """
        select cast(t0 as bigint) as window_start, product_id, cast(to_timestamp(t0) as date) as date, window_units as units_sold, current_price,
               cost_price, inventory_ratio,
               case when is_new then case when cost_price = 0 then 1 else round_even(current_price / cost_price * 1e2, 0) / 1e2 end
                    else coalesce(current_price / nullif(cost_price, 0), 0) end as price_to_cost_ratio,
               case when is_new then 0.5 else 0 end as inventory_urgency_score, case when is_new then 1.0 else 0 end as sensitivity_encoded
        from live""",
        doubles="current_price cost_price inventory_ratio price_to_cost_ratio inventory_urgency_score sensitivity_encoded", dates="date"),
    Check("latest_revision", _revisions, """
        select cast(t0 as bigint) as window_start, product_id, window_units, 4 + product_id % 3 as batch_id from windows"""),
    Check("freshness_status", lambda s, d: _epoch(reports.freshness_status(
        td.price_events(s, d), dt.datetime(2024, 1, 31, 0, 0, 0)), "last_event"), """
        select cast(floor(epoch(m)) as bigint) as last_event, cast(epoch(timestamp '2024-01-31 00:00:00') - floor(epoch(m)) as bigint) as age_seconds,
               case when m is null then 'Offline' when epoch(timestamp '2024-01-31 00:00:00') - floor(epoch(m)) <= 120 then 'Live' else 'Idle' end as status
        from (select max(event_time) as m from price_events)"""),
]
