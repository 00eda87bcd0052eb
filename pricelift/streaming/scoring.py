"""Pricing of windowed events against the product lookup."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio, round_to
from ..operators import models, pricing

WINDOW_KEY = ("window_start", "window_end", "product_id")


def lookup_enrich(windows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Lookup row of each window's product, with live price, units and inventory.

    Stream-static left join; Catalyst broadcasts the lookup when its size allows it.
    """
    live = {"current_price": "avg_price", "units_sold": "window_units", "inventory_ratio": "avg_inventory"}
    static = [c for c in lookup.columns if c not in live and c != "product_id"]
    known = lookup.select("product_id", *static, F.lit(True).alias("_known"))
    joined = windows.join(known, "product_id", "left")
    return joined.withColumns({new: F.col(old) for new, old in live.items()}).withColumn(
        "is_new_product", F.col("_known").isNull()
    ).drop("_known")


def with_fallback(enriched: DataFrame) -> DataFrame:
    """Rough profile for products the lookup does not know; known rows are left alone."""
    new = F.col("is_new_product")
    price = F.coalesce("avg_price", F.lit(0.0))
    cost = round_to(price * F.lit(0.7), 2)
    profile = {
        "product_name": F.concat(F.lit("Unknown_Product_"), F.col("product_id").cast("string")),
        "department": F.lit("Unclassified"),
        "current_price": price,
        "base_price": price,
        "cost_price": cost,
        "price_to_cost_ratio": F.coalesce(round_to(ratio(price, cost), 2), F.lit(1.0)),
        "inventory_ratio": F.coalesce("avg_inventory", F.lit(0.5)),
        "inventory_urgency_score": F.lit(0.5),
        "sensitivity_encoded": F.lit(1),
        "price_elasticity": F.lit(-1.0),
        "units_sold": F.coalesce("window_units", F.lit(0)),
        "inventory_level": F.lit(0),
        "stock_urgency_category": F.lit("Unknown"),
        "price_sensitivity_category": F.lit("Medium"),
        "expiry_risk_flag": F.lit(0),
        "baseline_demand": F.coalesce("window_units", F.lit(0)).cast("double"),
        "seasonal_factor": F.lit(1.0),
    }
    filled = {}
    for name, value in profile.items():
        if name in enriched.columns:
            filled[name] = F.when(new, value).otherwise(F.col(name))
        else:
            filled[name] = F.when(new, value)
    return enriched.withColumns(filled)


def live_rows(windows: DataFrame, lookup: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    rows = with_fallback(lookup_enrich(windows, lookup))
    if model is not None:
        rows = models.predict_baseline(rows.drop("baseline_demand"), model)
    return rows


def score_windows(
    windows: DataFrame, lookup: DataFrame, model: PipelineModel | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Price every window row: one join and one projection, nothing on the driver."""
    rows = live_rows(windows, lookup, model)
    return pricing.price_products(rows, keep=("window_start", "window_end", "is_new_product", *keep))


TRAINING_INPUTS = ("units_sold", "price_to_cost_ratio", "inventory_urgency_score", "sensitivity_encoded")


def training_rows(scored: DataFrame) -> DataFrame:
    """The nine training columns of scored rows, dated by the window, with the window key."""
    derived = ratio("current_price", "cost_price")
    return scored.select(
        "window_start", "window_end", "product_id",
        F.to_date("window_start").alias("date"),
        F.col("units_sold").cast("long").alias("units_sold"),
        "current_price", "cost_price", "inventory_ratio",
        F.coalesce("price_to_cost_ratio", derived, F.lit(0.0)).alias("price_to_cost_ratio"),
        F.coalesce("inventory_urgency_score", F.lit(0.0)).alias("inventory_urgency_score"),
        F.coalesce(F.col("sensitivity_encoded").cast("double"), F.lit(0.0)).alias("sensitivity_encoded"),
    )


def latest_revision(rows: DataFrame, key: tuple[str, ...] = WINDOW_KEY) -> DataFrame:
    """One row per window and product: the revision from the newest batch of the newest run.

    An aggregate, not a window function, so revisions are dropped before the shuffle.
    """
    packed = F.struct(*[F.col(c) for c in rows.columns if c not in key])
    revision = F.struct(*[c for c in ("run", "batch_id") if c in rows.columns])
    newest = rows.groupBy(*key).agg(F.max_by(packed, revision).alias("_row"))
    return newest.select(*key, "_row.*")


def closed_windows(log: DataFrame, since: str | None, until: str) -> DataFrame:
    """Final training rows of the windows that ended in (since, until].

    ``until`` must lie behind the stream's watermark; such windows are never revised, so
    each one is taken by exactly one run.
    """
    end = F.col("window_end")
    ready = end <= F.lit(until).cast("timestamp")
    if since is not None:
        ready = ready & (end > F.lit(since).cast("timestamp"))
    return latest_revision(log.filter(ready)).drop("window_start", "window_end", "batch_id", "run")
