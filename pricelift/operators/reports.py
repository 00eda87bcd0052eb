"""Figures and tables over the results: totals, breakdowns, top lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import retail, text
from ..functions.numeric import exact_sum, stable_mean


def _comparable(results: DataFrame) -> DataFrame:
    return results.filter(retail.is_comparable("optimization_method"))


def _expiry(results: DataFrame) -> DataFrame:
    return results.filter(~retail.is_comparable("optimization_method"))


def kpi_totals(results: DataFrame) -> DataFrame:
    """All headline figures in one aggregate over one scan."""
    same = retail.is_comparable("optimization_method")
    change = F.col("price_change_pct")
    return results.agg(
        F.coalesce(exact_sum(F.when(same, F.col("profit_uplift"))), F.lit(0.0)).alias("total_uplift"),
        stable_mean(F.when(same, F.col("profit_uplift_pct"))).alias("mean_uplift_pct"),
        F.count_if(same).alias("comparable_rows"),
        F.count(F.lit(1)).alias("n_rows"),
        stable_mean(change).alias("mean_price_change_pct"),
        F.count_if(change > 0).alias("price_increases"),
        F.count_if(change < 0).alias("price_cuts"),
        F.coalesce(exact_sum(F.when(~same, F.col("spoilage_savings_estimate"))), F.lit(0.0)).alias("spoilage_total"),
        F.count_if(F.col("stock_urgency_category") == "Critical").alias("critical_rows"),
    )


def uplift_by(results: DataFrame, *keys: str, total: bool = False) -> DataFrame:
    """Uplift of the comparable rows by the keys; ``total`` adds a grand-total row."""
    rows = _comparable(results)
    uplift = exact_sum("profit_uplift").alias("profit_uplift")
    if not total:
        return rows.groupBy(*keys).agg(uplift)
    rolled = rows.rollup(*keys).agg(uplift, F.grouping_id().alias("_level"))
    grand = 2 ** len(keys) - 1
    kept = rolled.filter(F.col("_level").isin(0, grand))
    labels = [F.when(F.col("_level") == grand, F.lit("Total")).otherwise(F.col(k)).alias(k) for k in keys]
    return kept.select(*labels, "profit_uplift")


def top_department(results: DataFrame) -> DataFrame:
    """Best department and its share of the total; nothing unless both are positive."""
    best = uplift_by(results, "department").filter(F.col("profit_uplift").isNotNull()).agg(
        exact_sum("profit_uplift").alias("_total"),
        F.max("profit_uplift").alias("department_uplift"),
        F.min_by("department", F.struct(-F.col("profit_uplift"), F.col("department"))).alias("department"),
    )
    return best.filter((F.col("_total") > 0) & (F.col("department_uplift") > 0)).select(
        "department", "department_uplift",
        (F.col("department_uplift") / F.col("_total") * F.lit(100.0)).alias("share_pct"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value; the total is a scalar subquery, not a window."""
    total = df.agg(F.count(column).alias("n")).scalar()
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("share_pct", F.col("n_rows") / total * F.lit(100.0))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``rows`` x ``columns``, 0 where absent; given values avoid a distinct job."""
    known = df.filter(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return known.groupBy(rows).pivot(columns, list(values)).count().na.fill(0)


def elasticity_correlation(results: DataFrame) -> DataFrame:
    both = _comparable(results).na.drop(subset=["price_elasticity", "profit_uplift"])
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.corr("price_elasticity", "profit_uplift").alias("correlation"),
    )


def catalog_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("department").alias("n_departments"),
        F.count_distinct("optimization_method").alias("n_methods"),
    )


TABLE_COLUMNS = (
    "product_id", "product_name", "department", "current_price", "recommended_price",
    "price_change_pct", "predicted_demand", "profit_uplift", "optimization_method",
    "stock_urgency_category",
)


def sort_results(results: DataFrame) -> DataFrame:
    """The product table, best uplift first and rows without one last (a range-partitioned sort)."""
    shown = [c for c in TABLE_COLUMNS if c in results.columns]
    return results.select(*shown).orderBy(F.col("profit_uplift").desc_nulls_last(), "product_id")


EXPIRY_COLUMNS = (
    "product_id", "product_name", "current_price", "recommended_price", "spoilage_savings_estimate",
)


def expiry_table(results: DataFrame) -> DataFrame:
    shown = _expiry(results).select(*EXPIRY_COLUMNS)
    return shown.orderBy(F.col("spoilage_savings_estimate").desc_nulls_last(), "product_id")


def top_spoilage(results: DataFrame, n: int = 15) -> DataFrame:
    """Each task keeps its own n best, so only n rows per task reach the last step."""
    known = _expiry(results).filter(F.col("spoilage_savings_estimate").isNotNull())
    return known.select(*EXPIRY_COLUMNS).orderBy(
        F.col("spoilage_savings_estimate").desc(), "product_id"
    ).limit(n)


def first_rows(results: DataFrame, n: int = 10, key: str = "product_id") -> DataFrame:
    shown = results.select(key, "product_name", "recommended_price", "profit_uplift")
    return shown.orderBy(key).limit(n)


def scatter_points(results: DataFrame) -> DataFrame:
    return _comparable(results).select(
        "product_id", "product_name", "department", "price_change_pct", "profit_uplift",
        "current_price", "recommended_price",
        F.greatest(F.col("current_profit"), F.lit(1.0)).alias("bubble_size"),
    )


def sample_products(catalog: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` products in the order of a seeded digest: the same sample on every run."""
    ticket = F.md5(F.concat(F.col("product_id").cast("string"), F.lit(f":{seed}")).cast("binary"))
    return catalog.withColumn("_ticket", ticket).orderBy("_ticket", "product_id").limit(n).drop("_ticket")


def rule_explanation(results: DataFrame) -> DataFrame:
    """Rule-based explanation of every recommendation, with the fixed confidence fields."""
    return results.select(
        "product_id",
        text.rule_sentence("price_change_pct", "profit_uplift", "recommended_price").alias("explanation"),
        F.lit(text.UNAVAILABLE).alias("confidence_label"),
        F.lit(None).cast("int").alias("confidence_pct"),
        F.lit(text.RULE_REASONING).alias("reasoning"),
    )


def explanation_prompt(results: DataFrame) -> DataFrame:
    sensitivity = (
        F.col("price_sensitivity_category") if "price_sensitivity_category" in results.columns
        else F.lit("Medium")
    )
    return results.select("product_id", text.prompt_text(
        "product_name", "department", "current_price", "recommended_price", "price_change_pct",
        sensitivity, "stock_urgency_category", "profit_uplift",
    ).alias("prompt"))


def parse_explanation(replies: DataFrame, column: str = "reply") -> DataFrame:
    """Read explanation replies.

    The JSON object may stand in other text, such as code fences; fields missing from it get their default; a
    reply without one is shown as it came.  A null reply falls back to ``explanation`` of
    ``rule_explanation`` when the input carries it as ``fallback``.
    """
    body = text.json_object(column)
    fields = "explanation string, confidence_label string, confidence_pct string, reasoning string, _bad string"
    parsed = replies.withColumn(
        "_j", F.from_json(body, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    )
    usable = body.isNotNull() & F.col("_j").isNotNull() & F.col("_j._bad").isNull()
    raw = text.stripped(column)
    fallback = F.col("fallback") if "fallback" in replies.columns else F.lit(None).cast("string")

    def filled(name):
        trimmed = F.trim(F.col(f"_j.{name}"))
        return F.when(trimmed != "", trimmed)

    percent = F.floor(F.col("_j.confidence_pct").try_cast("double"))
    out = parsed.withColumn("_ok", F.coalesce(usable, F.lit(False)))
    kept = [c for c in replies.columns if c not in (column, "fallback")]
    return out.select(
        *kept,
        F.when(F.col("_ok"), F.coalesce(filled("explanation"), fallback))
        .otherwise(F.coalesce(raw, fallback)).alias("explanation"),
        F.when(F.col("_ok"), F.coalesce(F.col("_j.confidence_label"), F.lit("Medium")))
        .otherwise(text.UNAVAILABLE).alias("confidence_label"),
        F.when(F.col("_ok"), percent.try_cast("int")).alias("confidence_pct"),
        F.when(F.col("_ok"), F.coalesce(filled("reasoning"), F.lit(text.NO_REASONING)))
        .when(F.col(column).isNull(), F.lit(text.RULE_REASONING))
        .otherwise(text.UNPARSED_REASONING).alias("reasoning"),
    )


def freshness_status(
    results: DataFrame, now: dt.datetime, time_col: str = "event_time", idle_seconds: int = 120
) -> DataFrame:
    """Live, Idle or Offline, from the newest event time against a given instant (UTC)."""
    newest = results.agg(F.max(time_col).cast("timestamp").alias("last_event"))
    instant = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    age = F.unix_timestamp(instant) - F.unix_timestamp("last_event")
    status = F.when(age.isNull(), "Offline").when(age <= idle_seconds, "Live").otherwise("Idle")
    return newest.select("last_event", age.alias("age_seconds"), status.alias("status"))
