"""Headline queries against the plain forms they replace.  Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
``queries`` holds the median of the warm runs; ``plain_forms`` the same work done the way a
straight port would do it, for comparison.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.window import Window  # noqa: E402

from pricelift.checks import inputs as x  # noqa: E402
from pricelift.operators import clean, elasticity, features, forecast, joins, metrics, patterns, pricing, quality, reports, split  # noqa: E402
from pricelift.plans import batch  # noqa: E402
from pricelift.plans.master import build_master  # noqa: E402
from pricelift.session import build_session  # noqa: E402
from pricelift.sources import testdata as td  # noqa: E402
from pricelift.streaming import events, scoring  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    work()
    took = []
    for _ in range(RUNS):
        start = time.perf_counter()
        work()
        took.append(time.perf_counter() - start)
    return round(statistics.median(took), 3)


def four_ratio_joins(sales):
    """Weekend and festival ratios as four filtered aggregates and four joins."""
    out = sales.select("product_id").distinct()
    for flag, tag in (("is_weekend", "w"), ("festival_flag", "f")):
        for level in (1, 0):
            part = sales.filter(F.col(flag) == level).groupBy("product_id").agg(F.avg("units_sold").alias(f"{tag}{level}"))
            out = out.join(part, "product_id", "left")
    return out


def seven_scans(master):
    for rule in quality.MASTER_RULES:
        column = next((c for c in rule.columns if c in master.columns), None)
        if column:
            master.filter(rule.violated.format(c=column)).count()


def global_rank_split(sales):
    w = Window.orderBy("date", "product_id")
    ranked = sales.withColumn("rn", F.row_number().over(w))
    cut = int(sales.count() * 0.85)
    run(ranked.filter(F.col("rn") <= cut))
    run(ranked.filter(F.col("rn") > cut))


def solver_loop(lookup):
    """One bounded search per product on the driver, as a per-row program does it."""
    for row in lookup.toPandas().itertuples():
        e = min(-0.1, max(-5.0, row.price_elasticity if row.price_elasticity == row.price_elasticity else -1.0))
        lo, hi = row.cost_price * 1.05, row.base_price * 1.5
        for _ in range(40):
            a, b = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
            fa = (a - row.cost_price) * (1 + e * (a - row.base_price) / row.base_price)
            fb = (b - row.cost_price) * (1 + e * (b - row.base_price) / row.base_price)
            lo, hi = (a, hi) if fa < fb else (lo, b)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": str(max(8, int(CPUS))), "spark.log.level": "ERROR",
    })
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")

    def stored(name, df):
        path = f"{work}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    sales = stored("sales", td.sales_full(spark, SF_DIR))
    catalog = stored("catalog", td.catalog_full(spark, SF_DIR))
    tables = batch.derive_tables(sales, catalog, x.FORECAST_START)
    weekly = stored("weekly", tables.weekly)
    elastic = stored("elasticity", tables.elasticity)
    inventory = stored("inventory", tables.inventory)
    optimal = stored("optimal", tables.optimal)
    projected = stored("forecast", tables.forecast)
    lookup = stored("lookup", td.lookup_edge(spark, SF_DIR))
    results = stored("results", pricing.price_products(lookup, keep=("price_elasticity",)))
    orders = stored("orders", features.days_since_prior(td.orders(spark, SF_DIR)))
    lines = stored("lines", td.order_lines(spark, SF_DIR))
    products = td.products(spark, SF_DIR)
    raw_events = stored("events", td.event_json(spark, SF_DIR).repartition(int(CPUS)))

    def master():
        return build_master(
            clean.clean_sales(sales), clean.clean_catalog(catalog), clean.clean_elasticity(elastic), optimal,
            clean.clean_forecast(projected),
        )

    wide = stored("master", master())
    keys = ("product_id", "transaction_id")

    def split_twice():
        for part in split.chrono_split(sales, 0.85, keys):
            run(part)

    def windows():
        return events.flat_window(events.tumbling_demand(events.parse_events(raw_events), "10 seconds"))

    def errors():
        train, test = (sales.filter(F.col("date") < x.SPLIT_DATE), sales.filter(F.col("date") >= x.SPLIT_DATE))
        per_product = metrics.mape_by_product(x.with_predictions(train, test), "units_sold", "prediction")
        run(metrics.describe_col(per_product, "mape"))

    work_list = {
        "department_gains": lambda: run(batch.department_gains(sales, catalog)),
        "clean_sales": lambda: run(clean.clean_sales(sales)),
        "build_master": lambda: run(master()),
        "rolling_7": lambda: run(features.rolling_features(sales)),
        "weekly_features": lambda: run(features.weekly_features(features.weekly_demand(sales))),
        "elasticity_table": lambda: run(elasticity.lerner_price(elasticity.elasticity_table(weekly, catalog))),
        "price_grid": lambda: run(elasticity.price_grid(elastic, inventory)),
        "product_lookup": lambda: run(features.product_lookup(wide)),
        "price_products": lambda: run(pricing.price_products(lookup)),
        "price_curve": lambda: run(pricing.price_curve(lookup)),
        "recent_trend": lambda: run(features.recent_stats(sales)),
        "forecast_project": lambda: run(forecast.forecast_project(features.recent_stats(sales), optimal.select("product_id", "recommended_price"), x.FORECAST_START)),
        "train_seasonal": lambda: run(forecast.seasonal_index(sales)),
        "purchase_patterns": lambda: run(patterns.purchase_patterns(joins.orders_in_set(lines, orders), orders, products)),
        "days_since_prior": lambda: run(features.days_since_prior(td.orders(spark, SF_DIR))),
        "conditional_ratios": lambda: run(features.product_figures(sales)),
        "validate_master": lambda: run(quality.validate(wide)),
        "chrono_split": split_twice,
        "kpi_totals": lambda: run(reports.kpi_totals(results)),
        "score_event_windows": lambda: run(scoring.score_windows(windows(), lookup)),
        "mape_distribution": errors,
    }
    plain = {
        "conditional_ratios": lambda: run(four_ratio_joins(sales)),
        "validate_master": lambda: seven_scans(wide),
        "chrono_split": lambda: global_rank_split(sales),
        "price_products": lambda: solver_loop(lookup),
    }
    only = set(sys.argv[1:])
    queries = {name: timed(f) for name, f in work_list.items() if not only or name in only}
    plain_forms = {name: timed(f) for name, f in plain.items() if not only or name in only}
    print(json.dumps({
        "metric": "sum of median warm seconds over headline queries", "value": round(sum(queries.values()), 3),
        "unit": "sec", "queries": queries, "plain_forms": plain_forms, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS), "rows": {"sales": sales.count(), "products": catalog.count()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
