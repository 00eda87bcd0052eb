"""Batch pipelines: derived tables, pricing, and the nightly run over written tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import retail
from ..operators import clean, elasticity, features, forecast, lookup_state, models, pricing, quality, reports, split
from ..operators.joins import fold_back, join_dim
from ..streaming.scoring import closed_windows
from ..sources.publish import folder, touch, write_audited
from ..sources.tables import path_exists, read_table, require_inputs, write_table
from .master import build_master


@dataclass(frozen=True)
class DerivedTables:
    weekly: DataFrame
    elasticity: DataFrame
    inventory: DataFrame
    optimal: DataFrame
    forecast: DataFrame


def derive_tables(
    sales: DataFrame, catalog: DataFrame, forecast_start: dt.date, forecast_days: int = 30,
    snapshot: dt.date | None = None, kept: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DerivedTables:
    """Weekly demand, elasticity, inventory status, price grid and forecast from sales.

    The catalog grows with the products: its joins, with tables that lie by product already, never go through the driver.
    ``kept`` may write what several of the tables are made from, elasticity and price grid, and read it again.
    """
    catalog = catalog.hint("merge")
    weekly = features.weekly_features(features.weekly_demand(sales))
    elastic = kept(elasticity.lerner_price(elasticity.elasticity_table(weekly, catalog)))
    stock = elasticity.latest_stock(sales).join(
        catalog.select("product_id", "product_name", "department", F.col("base_price").alias("current_price"), "cost_price"),
        "product_id",
    )
    inventory = elasticity.inventory_status(stock)
    when = F.lit(snapshot or forecast_start).cast("date")
    optimal = kept(elasticity.price_grid(elastic, inventory.hint("merge")).withColumn("optimization_date", when))
    prices = catalog.select("product_id", "product_name", "department", "base_price").join(
        optimal.select("product_id", F.col("recommended_price").alias("_optimal")), "product_id", "left"
    ).select(
        "product_id", "product_name", "department",
        F.coalesce("_optimal", "base_price").alias("recommended_price"),
    )
    recent = features.recent_stats(sales)
    projected = forecast.forecast_project(recent, prices.hint("merge"), forecast_start, forecast_days)
    return DerivedTables(weekly, elastic, inventory, optimal, projected)


def lookup_with_demand(
    master: DataFrame, model: PipelineModel | None = None, seasonal: DataFrame | None = None
) -> DataFrame:
    """Product lookup with ``baseline_demand`` and ``seasonal_factor``.

    Without a model the baseline is the product's mean daily units.
    """
    lookup = pricing.lookup_defaults(features.product_lookup(master)).drop("baseline_demand", "seasonal_factor")
    if model is None:
        lookup = lookup.withColumn("baseline_demand", F.col("units_sold").cast("double"))
    else:
        lookup = models.predict_baseline(lookup, model)
    if seasonal is None:
        return lookup.withColumn("seasonal_factor", F.lit(1.0))
    return join_dim(lookup, seasonal, "product_id")


def pricing_input(sales: DataFrame, catalog: DataFrame, response: DataFrame) -> DataFrame:
    """The columns of the wide table that pricing needs, without the rest of it.

    ``response`` holds product_id, price_sensitivity_category and price_elasticity.
    Sales collapse first; the joins then run on one row per product, and names come from
    the catalog instead of being looked for in every sale.
    """
    rows = sales.select(
        "product_id", "base_price", "cost_price", "current_price", "inventory_level",
        "inventory_ratio", "units_sold",
        retail.stock_category("inventory_ratio").alias("stock_urgency_category"),
    )
    lookup = features.product_lookup(rows, {"stock_urgency_category": retail.STOCK_CATEGORIES})
    names = catalog.select("product_id", "product_name", "department", "shelf_life_days", "is_perishable")
    lookup = join_dim(join_dim(lookup, names, "product_id"), response, "product_id")
    return lookup.withColumns({
        "expiry_risk_flag": retail.expiry_risk("is_perishable", "shelf_life_days"),
        "baseline_demand": F.col("units_sold").cast("double"),
    })


def department_gains(sales: DataFrame, catalog: DataFrame) -> DataFrame:
    """Which departments gain most from repricing: sales -> weekly -> elasticity -> price."""
    weekly = features.weekly_features(features.weekly_demand(sales))
    response = elasticity.elasticity_table(weekly, catalog).select(
        "product_id", "price_sensitivity_category", F.col("avg_price_elasticity").alias("price_elasticity")
    )
    results = pricing.price_products(pricing_input(sales, catalog, response))
    return reports.uplift_by(results, "department")


# ---------------------------------------------------------------- runs over written tables

RAW_TABLES = ("sales", "catalog", "elasticity", "optimal", "forecast")


def clean_and_merge(
    spark: SparkSession, raw: dict[str, str], out: str, rules: tuple[quality.Rule, ...] = quality.MASTER_RULES
) -> DataFrame:
    """Clean the raw tables, build the wide table, write it by month and publish it if it keeps the rules.

    The rules are counted by the pass that writes.  If one is broken ``ValidationFailed`` is raised and the
    table that stood in ``out`` before is still there.
    """
    require_inputs(spark, [raw[name] for name in RAW_TABLES])
    tables = {name: read_table(spark, raw[name]) for name in RAW_TABLES}
    master = build_master(
        clean.clean_sales(tables["sales"]), clean.clean_catalog(tables["catalog"]),
        clean.clean_elasticity(tables["elasticity"]), tables["optimal"],
        clean.clean_forecast(tables["forecast"]),
    )
    write_audited(master, out, rules, partition_by=["year_month"])
    return spark.read.parquet(out)


def hold_out(spark: SparkSession, master: DataFrame, kept: str, held: str, fraction: float = 1 - split.HOLDOUT_FRACTION) -> None:
    """Write the oldest rows and the held-out newest ones; refuses to split twice."""
    if path_exists(spark, held):
        raise FileExistsError(f"{held} exists: the table was split before")
    older, newer = split.chrono_split(master, fraction)
    write_table(older, kept, partition_by=["year_month"], mode="error")
    write_table(newer, held, partition_by=["year_month"], mode="error")


def retrain_and_price(
    master: DataFrame, model_path: str, results_path: str, forecast_start: dt.date,
    max_trees: int = 500, rules: tuple[quality.Rule, ...] = quality.MASTER_RULES,
) -> DataFrame:
    """Gate, train, seasonal factors, price every product, write."""
    quality.assert_valid(quality.validate(master, rules))
    train, test = split.chrono_split(master, split.TRAIN_FRACTION)
    model = models.train_demand(train, test, max_trees=max_trees)
    model.write().overwrite().save(model_path)
    index = forecast.seasonal_index(master)
    seasonal = forecast.seasonal_factor(forecast.seasonal_forecast(index, forecast_start))
    results = pricing.price_products(lookup_with_demand(master, model, seasonal), keep=("price_elasticity",))
    write_table(results, results_path)
    return master.sparkSession.read.parquet(results_path)


#: Empty file in a folded table whose name ends with the end of the last window folded in; readers pass over it.
FOLD_MARK = "_folded_until_"


def folded_until(spark: SparkSession, path: str) -> str | None:
    """Up to which instant the stream's windows are in a master table; None if none were folded in."""
    fs, target = folder(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    marks = [name.removeprefix(FOLD_MARK) for name in names if name.startswith(FOLD_MARK)]
    return max(dt.datetime.strptime(m, "%Y%m%dT%H%M%S") for m in marks).isoformat(sep=" ") if marks else None


def begin_lookup_state(master: DataFrame, state: str) -> None:
    """Store the lookup state of a whole (written) master table; nightly folds add to it."""
    lookup_state.write_state(lookup_state.partial_state(master), state, "0")


def fold_part(since: str | None) -> str:
    """Name of the state of the fold that began at an instant; names sort by it, behind that of the whole table."""
    return "1" if since is None else "2" + "".join(c for c in since if c.isdigit())


def current_lookup(spark: SparkSession, state: str, schema: T.StructType) -> DataFrame:
    """The product lookup of the master and all windows folded in since, from the stored states only."""
    return lookup_state.lookup_of(lookup_state.read_state(spark, state, schema))


def nightly_fold(
    spark: SparkSession, master_path: str, log: DataFrame, out: str, until: dt.datetime,
    rules: tuple[quality.Rule, ...] = (), state: str | None = None,
) -> DataFrame:
    """Fold the windows that closed up to ``until`` into the master and write it to a new place.

    The table that is read says up to where windows are in it, the table that is written says so in turn.  A fold
    that is run twice, or again after a failure, reads the same table and so gives the same rows; a fold of the
    written table takes only later windows.  ``until`` (whole seconds, UTC) must lie behind the watermark of the stream.
    The mark is in the folder before it is published, so no table is ever seen that holds windows and does not say so.

    ``state`` is a folder begun by ``begin_lookup_state``: the state of the folded windows alone is added there, before the
    table is published and under a name that says where the fold began, so that a fold that is run again replaces it.
    """
    if out.rstrip("/") == master_path.rstrip("/"):
        raise ValueError("a table cannot be folded onto itself")
    until = until.replace(microsecond=0)
    since = folded_until(spark, master_path)
    final = closed_windows(log, since, until.isoformat(sep=" "))
    folded = fold_back(spark.read.parquet(master_path), final)
    folded = folded.withColumn("year_month", F.coalesce("year_month", F.date_format("date", "yyyy-MM")))
    if state is not None:
        fresh = fold_back(spark.read.parquet(master_path).filter(F.lit(False)), final)
        fresh = fresh.withColumn("year_month", F.coalesce("year_month", F.date_format("date", "yyyy-MM")))
        lookup_state.write_state(lookup_state.partial_state(fresh), state, fold_part(since))
    write_audited(
        folded, out, rules, partition_by=["year_month"],
        finish=lambda staged: touch(spark, f"{staged}/{FOLD_MARK}{until:%Y%m%dT%H%M%S}"),
    )
    return spark.read.parquet(out)
