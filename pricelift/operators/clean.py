"""Cleaning of the raw tables, and filters on the results table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import retail
from ..functions.numeric import finite
from .ranks import lower_median_by

UNKNOWN = "Unknown"


def resolve_column(df: DataFrame, tokens: Sequence[str], exclude: Sequence[str] = ()) -> str | None:
    """First column whose name holds one of the tokens; looks at the schema only."""
    for name in df.columns:
        lowered = name.lower()
        if any(t in lowered for t in tokens) and not any(t in lowered for t in exclude):
            return name
    return None


def as_date(df: DataFrame, name: str) -> Column:
    """Text to date with unreadable text as null; dates pass through."""
    if isinstance(df.schema[name].dataType, T.DateType):
        return F.col(name)
    return F.expr(f"try_cast(`{name}` as date)")


def clean_sales(df: DataFrame) -> DataFrame:
    """Drop negative units and prices below cost (unknown values too), fill the department,
    read the date and add ``date_only`` and ``year_month``."""
    kept = df.filter((F.col("units_sold") >= 0) & (F.col("current_price") >= F.col("cost_price")))
    dated = kept.na.fill({"department": UNKNOWN}).withColumn("date", as_date(kept, "date"))
    return dated.withColumns(
        {"date_only": F.col("date"), "year_month": F.date_format("date", "yyyy-MM")}
    )


def clean_elasticity(df: DataFrame, price_col: str = "current_base_price") -> DataFrame:
    """Infinite optimal prices become the department's median price, infinite
    sensitivities 0; the category gets its ordinal."""
    out = df
    if "recommended_optimal_price" in df.columns:
        medians = lower_median_by(df, "department", price_col, "_median_price")
        price = F.col("recommended_optimal_price")
        infinite = price.isin(float("inf"), float("-inf"))
        out = (
            out.join(medians, "department", "left")
            .withColumn(
                "recommended_optimal_price",
                F.coalesce(F.when(~infinite, price), F.col("_median_price")),
            )
            .select(*df.columns)
        )
    sensitivity = resolve_column(df, ["sensitivity"], exclude=["category"])
    if sensitivity is not None and isinstance(df.schema[sensitivity].dataType, T.FractionalType):
        value = F.col(sensitivity)
        out = out.withColumn(
            sensitivity, F.when(value.isin(float("inf"), float("-inf")), F.lit(0.0)).otherwise(value)
        )
    if "department" in df.columns:
        out = out.na.fill({"department": UNKNOWN})
    category = resolve_column(df, ["category"])
    if category is not None:
        out = out.withColumn("sensitivity_encoded", retail.sensitivity_encode(category))
    return out


def clean_forecast(
    df: DataFrame, low: str = "predicted_units_lower", mid: str = "predicted_units",
    high: str = "predicted_units_upper", date_col: str = "forecast_date",
) -> DataFrame:
    """Keep ordered, non-empty bands; a missing festival flag counts as 0."""
    ordered = (F.col(low) <= F.col(mid)) & (F.col(mid) <= F.col(high))
    all_zero = (F.col(low) == 0) & (F.col(mid) == 0) & (F.col(high) == 0)
    out = df.filter(ordered & ~all_zero).withColumn(date_col, as_date(df, date_col))
    if "festival_flag" in df.columns:
        out = out.withColumn(
            "festival_flag", F.coalesce(F.col("festival_flag").try_cast("int"), F.lit(0))
        )
    return out


def clean_catalog(df: DataFrame) -> DataFrame:
    return df.na.fill({"department": UNKNOWN}) if "department" in df.columns else df


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows complete in every listed column that exists; NaN counts as missing."""
    return df.na.drop(subset=[c for c in columns if c in df.columns])


RESULT_NUMBERS = (
    "current_price", "recommended_price", "profit_uplift", "current_profit", "predicted_profit",
    "price_change_pct", "predicted_demand", "inventory_ratio", "cost_price",
    "profit_uplift_pct", "spoilage_savings_estimate",
)
ZERO_WHEN_MISSING = ("inventory_ratio", "predicted_demand", "spoilage_savings_estimate")


def numeric_coerce(
    df: DataFrame, columns: Iterable[str] = RESULT_NUMBERS, zero: Iterable[str] = ZERO_WHEN_MISSING
) -> DataFrame:
    """Text to double, unreadable to null.  Only the listed columns turn null into 0: a
    missing uplift means "not comparable" and has to stay missing."""
    zeroed = set(zero)
    casts: dict[str, Column] = {}
    for name in columns:
        if name in df.columns:
            value = F.trim(F.col(name)) if isinstance(df.schema[name].dataType, T.StringType) else F.col(name)
            value = value.try_cast("double")
            value = F.when(~F.isnan(value), value)
            casts[name] = F.coalesce(value, F.lit(0.0)) if name in zeroed else value
    return df.withColumns(casts)


def uplift_pct_backfill(df: DataFrame) -> DataFrame:
    """Recompute ``profit_uplift_pct`` when the column is absent or has no value at all.

    "No value at all" is a scalar subquery on one column, so the call stays lazy.
    """
    computed = F.try_divide(F.col("profit_uplift"), F.col("current_profit")) * F.lit(100.0)
    if "profit_uplift_pct" not in df.columns:
        return df.withColumn("profit_uplift_pct", computed)
    present = df.agg(F.count(finite("profit_uplift_pct")).alias("n")).scalar()
    return df.withColumn(
        "profit_uplift_pct", F.when(present == 0, computed).otherwise(F.col("profit_uplift_pct"))
    )


def load_results(df: DataFrame) -> DataFrame:
    """Results table with numbers read and every display label added."""
    named = df.toDF(*[c.strip() for c in df.columns])
    return with_labels(uplift_pct_backfill(numeric_coerce(named)))


def with_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "display_label": retail.display_label("product_name", "product_id"),
        "price_difference": F.col("recommended_price") - F.col("current_price"),
        "recommendation": retail.recommendation_label("recommended_price", "current_price"),
        "inventory_health": retail.inventory_health("inventory_ratio"),
        "is_profit_comparable": retail.is_comparable("optimization_method"),
    })


def filter_results(
    df: DataFrame,
    department: str | None = None,
    search: str | None = None,
    method: str | None = None,
    uplift_range: tuple[float, float] | None = None,
    change_range: tuple[float, float] | None = None,
    stock: str | None = None,
) -> DataFrame:
    """Optional filters of the product explorer.  A range is only applied when given, so
    expiry rows (no uplift) stay in the default view."""
    out = df
    if department is not None:
        out = out.filter(F.col("department") == department)
    if search:
        out = out.filter(F.lower("product_name").contains(search.lower()))
    if method is not None:
        out = out.filter(F.col("optimization_method") == method)
    if uplift_range is not None:
        out = out.filter(F.col("profit_uplift").between(*uplift_range))
    if change_range is not None:
        out = out.filter(F.col("price_change_pct").between(*change_range))
    if stock is not None:
        out = out.filter(F.col("stock_urgency_category") == stock)
    return out


def filter_options(df: DataFrame) -> DataFrame:
    """Choices for the filters as rows (field, option, low, high).

    Distinct values come out as rows, not as one array, so a large department list
    is never held in one cell.  A range whose ends coincide is widened by one.
    """
    fields = ("department", "optimization_method", "stock_urgency_category")
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("option")) for f in fields
    ]))
    options = (
        df.select(pairs.alias("o")).select("o.field", "o.option")
        .filter(F.col("option").isNotNull()).distinct()
        .select("field", "option", F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))
    )
    bounds = df.agg(
        F.min("profit_uplift").alias("u0"), F.max("profit_uplift").alias("u1"),
        F.min("price_change_pct").alias("c0"), F.max("price_change_pct").alias("c1"),
    ).select(F.explode(F.array(
        F.struct(F.lit("profit_uplift").alias("field"), F.col("u0").alias("low"), F.col("u1").alias("high")),
        F.struct(F.lit("price_change_pct").alias("field"), F.col("c0").alias("low"), F.col("c1").alias("high")),
    )).alias("r")).select(
        "r.field", F.lit(None).cast("string").alias("option"), "r.low",
        F.when(F.col("r.low") == F.col("r.high"), F.col("r.low") + 1.0).otherwise(F.col("r.high")).alias("high"),
    )
    return options.unionByName(bounds)


