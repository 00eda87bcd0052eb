"""Ranges of rows, the served layout and the channel for bad records."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from . import inputs as x
from .base import Check
from .features import ROLLING_SQL
from ..operators import features, joins
from ..session import ensure_checkpoint_dir
from ..sources import quarantine, schemas, served, testdata as td


def _shared(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _served(spark, sf):
    """Requests answered from a bucketed table."""
    results = x.edge_results(spark, sf).select("product_id", "recommended_price", "optimization_method")
    name = f"served_{uuid.uuid4().hex}"
    served.write_served(results, name, buckets=8, path=_shared(spark, "served"))
    asked = td.table(spark, sf, "lineitem").select((F.col("l_partkey") * 2).alias("product_id")).distinct()
    return joins.point_lookup(asked, spark.table(name))


def _write_lines(lines, schema, path):
    """The lines as they are, every file beginning with the names of its columns; each task writes its own file."""
    # a separator that no line has, so that a line is one value and stays unquoted
    lines.select(F.col("line").alias(",".join(schema.names))).write.options(header=True, sep="\u0001").csv(path)


def _checked(spark, sf):
    """Sales as text lines, some torn and some with a word for a number: what is read, and what is turned away."""
    fields = [F.col(c).cast("string") for c in ("product_id", "date", "units_sold", "current_price")]
    wrong = [*fields[:2], F.lit("many"), fields[3]]
    lines = td.sales(spark, sf).select(
        F.when(F.col("product_id") % 17 == 0, F.concat_ws(",", *fields[:2]))
        .when(F.col("product_id") % 13 == 0, F.concat_ws(",", *wrong)).otherwise(F.concat_ws(",", *fields)).alias("line"))
    path, schema = _shared(spark, "lines"), schemas.schema_of("product_id long, date date, units_sold long, current_price double")
    _write_lines(lines, schema, path)
    checked = quarantine.read_checked(spark, path, schema)
    counts = quarantine.rejected_counts(quarantine.rejected(checked)).groupBy("column").agg(F.sum("n_records").alias("n_records"))
    read = quarantine.accepted(checked).agg(F.lit("").alias("column"), F.count(F.lit(1)).alias("n_records"))
    return counts.unionByName(read).withColumnRenamed("column", "at_fault")


CHECKS = [
    Check("rolling_7_ranged", lambda s, d: features.rolling_features_ranged(td.sales(s, d)).select(
        "product_id", "date", "moving_avg_7day", "demand_volatility"), ROLLING_SQL,
        doubles="moving_avg_7day demand_volatility", dates="date"),
    Check("point_lookup_served", _served, """
        select q.product_id, r.recommended_price, r.optimization_method, case when r.product_id is not null then 1 else 0 end as found
        from (select distinct l_partkey * 2 as product_id from lineitem) q left join edge_results r on r.product_id = q.product_id""",
        doubles="recommended_price"),
    Check("read_checked", _checked, """
        select at_fault, cast(count(*) as bigint) as n_records
        from (select case when product_id % 17 = 0 then 'record' when product_id % 13 = 0 then 'units_sold' else '' end as at_fault from sales)
        group by at_fault"""),
]
