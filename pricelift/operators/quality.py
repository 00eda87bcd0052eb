"""Data-quality rules: every rule in one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``columns``: first one present is tested.  ``violated`` is SQL with ``{c}`` for it.

    A rule whose column is absent fails when ``required``, else it is skipped.
    """

    name: str
    columns: tuple[str, ...]
    violated: str
    required: bool = False


# A null makes a range test unknown, so it does not count as a violation.
MASTER_RULES: tuple[Rule, ...] = (
    Rule("product_id_not_null", ("product_id",), "{c} is null", True),
    Rule("price_in_range", ("current_price", "current_base_price"), "{c} < 0.50D or {c} > 500.00D", True),
    Rule("cost_positive", ("cost_price",), "{c} < 0.01D", True),
    Rule("total_units_not_negative", ("total_units_sold",), "{c} < 0"),
    Rule("inventory_ratio_in_range", ("inventory_ratio",), "{c} < 0.0D or {c} > 1.0D"),
    Rule("sensitivity_known", ("price_sensitivity_category",), "{c} not in ('High', 'Medium', 'Low')"),
    Rule("department_not_null", ("department",), "{c} is null"),
)


class ValidationFailed(ValueError):
    """Raised by the gate with every failed rule in its message."""


def _tested(columns: Sequence[str], rule: Rule) -> str | None:
    """The column a rule looks at, if the table has one."""
    return next((c for c in rule.columns if c in columns), None)


def rule_counts(columns: Sequence[str], rules: Sequence[Rule] = MASTER_RULES) -> list[Column]:
    """Aggregates: n_rows, and r0, r1, ... the failing rows of every rule whose column is there."""
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for i, rule in enumerate(rules):
        found = _tested(columns, rule)
        if found is not None:
            counts.append(F.count(F.when(F.expr(rule.violated.format(c=f"`{found}`")), 1)).alias(f"r{i}"))
    return counts


REPORT = "rule string, checked_column string, status string, failing_rows long"


def report_of(spark: SparkSession, counts: Mapping[str, int], columns: Sequence[str], rules: Sequence[Rule] = MASTER_RULES) -> DataFrame:
    """The report on counts that were taken before."""
    rows = []
    for i, rule in enumerate(rules):
        found, failing = _tested(columns, rule), counts.get(f"r{i}")
        status = ("failed" if rule.required else "skipped") if found is None else "failed" if failing else "passed"
        rows.append((rule.name, found, status, failing))
    return spark.createDataFrame(rows, REPORT)


def validate(df: DataFrame, rules: Sequence[Rule] = MASTER_RULES) -> DataFrame:
    """Report (rule, column, status, failing_rows), one row per rule, from one aggregate."""
    counts = df.agg(*rule_counts(df.columns, rules))

    def report_row(i: int, rule: Rule):
        found = _tested(df.columns, rule)
        if found is None:
            failing, status = F.lit(None).cast("long"), F.lit("failed" if rule.required else "skipped")
        else:
            failing = F.col(f"r{i}")
            status = F.when(failing > 0, "failed").otherwise("passed")
        return F.struct(
            F.lit(rule.name).alias("rule"), F.lit(found).cast("string").alias("checked_column"),
            status.alias("status"), failing.alias("failing_rows"),
        )

    rows = F.array(*[report_row(i, r) for i, r in enumerate(rules)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def assert_valid(report: DataFrame) -> None:
    """Stop the pipeline if any rule failed; the report has one row per rule."""
    failed = report.filter(F.col("status") == "failed").collect()
    if failed:
        detail = "; ".join(f"{r.rule} ({r.checked_column or 'column missing'}): {r.failing_rows}" for r in failed)
        raise ValidationFailed(f"{len(failed)} rule(s) failed: {detail}")


def gate_summary(report: DataFrame) -> DataFrame:
    """Whether the gate lets a table pass: one row with the number of rules by outcome and the failed ones by name."""
    def by(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    failed = F.array_join(F.sort_array(F.collect_list(F.when(F.col("status") == "failed", F.col("rule")))), ",")
    return report.agg((by("failed") == 0).alias("passes"), by("passed").alias("n_passed"), by("failed").alias("n_failed"), by("skipped").alias("n_skipped"), failed.alias("failed_rules"))
