"""Queries that read their rows several times make them once and read what was written."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle import connect, difference
from pricelift.checks import joins
from pricelift.checks.registry import all_checks
from pricelift.operators import features, models
from pricelift.plans.master import build_master_busy
from pricelift.sources import testdata as td
from pricelift.sources.tables import written_once


@pytest.mark.parametrize("key", ["predict_baseline", "baseline_demand"])
def test_the_lookup_reads_the_rows_that_the_model_was_trained_on(spark, small, key):
    """The sales were made a second time for the lookup."""
    files = all_checks()[key].run(spark, small).inputFiles()
    assert files and all("/rows-" in f for f in files)


def test_states_read_the_sales_that_were_written(spark, small):
    """The sales were made anew for every part and counted column."""
    files = all_checks()["lookup_states"].run(spark, small).inputFiles()
    assert files and all("/rows-" in f for f in files)


def test_rows_without_a_date_are_in_a_part(spark, small, tmp_path):
    """They were in none of the three parts."""
    for name in os.listdir(small):
        if name != "lineitem.parquet":
            os.symlink(f"{small}/{name}", tmp_path / name)
    duckdb.connect().execute(
        f"copy (select * replace (case when l_partkey % 3 > 0 or l_linenumber > 1 then l_shipdate end as l_shipdate) from '{small}/lineitem.parquet')"
        f" to '{tmp_path}/lineitem.parquet' (format parquet)")
    assert td.sales(spark, str(tmp_path)).filter("date is null").count() > 0
    check, con = all_checks()["lookup_states"], connect(str(tmp_path))
    assert difference(check.run(spark, str(tmp_path)), con, check.oracle()) is None
    con.close()


def test_written_rows_are_the_same_and_read_by_column_and_part(spark):
    df = spark.range(100).select("id", (F.col("id") % 7 / 0.0001).alias("v"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("t"), (F.col("id") % 2).alias("part"))
    kept = written_once(df, ("part",))
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.collect())) and kept.schema.names == df.schema.names
    plan = kept.filter("part = 1").select("v")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<v:double>" in plan and "PartitionFilters: [isnotnull(part" in plan


def test_bins_of_features_with_few_more_and_many_values(spark):
    """Up to 32 values are cut between, more at quantiles; none at all is one bin."""
    df = spark.range(20_000).select(
        (F.col("id") % 3).alias("few"), (F.col("id") % 50).cast("double").alias("more"), (F.col("id") * 0.5).alias("many"), F.lit(None).cast("double").alias("none"))
    names = ("few", "more", "many", "none")
    shares = [i / models.BINS for i in range(1, models.BINS)]
    want = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in ("more", "many")]).first()
    got = dict(zip(names, models.thresholds(df, names), strict=True))
    ends = (-math.inf, math.inf)
    assert got["few"] == [ends[0], 0.5, 1.5, ends[1]] and got["none"] == [ends[0], 0.0, ends[1]]
    assert got["more"] == [ends[0], *sorted(set(want.more)), ends[1]] and got["many"] == [ends[0], *sorted(set(want.many)), ends[1]]


@pytest.mark.parametrize("key", ["product_lookup", "product_lookup_levels", "build_master", "build_master_busy"])
@pytest.mark.parametrize("many", [False, True])
def test_the_wide_table_is_made_from_sales_that_were_written(spark, small, monkeypatch, key, many):
    """Sales were made anew for each of the tables that are derived from them, and all of these twice for the lookup."""
    if many:
        monkeypatch.setattr(features, "ROWS_PER_TASK", 300)
        monkeypatch.setattr(features, "MANY_ROWS", 1000)
    check, con = all_checks()[key], connect(small)
    got = check.run(spark, small)
    assert not [f for f in got.inputFiles() if f.endswith("lineitem.parquet")] and any("/rows" in f for f in got.inputFiles())
    assert difference(got, con, check.oracle()) is None
    con.close()


def test_many_rows_are_read_by_product_where_they_lie(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 70).alias("product_id"), F.col("id").alias("v"))
    monkeypatch.setattr(features, "ROWS_PER_TASK", 300)
    for many in (False, True):
        monkeypatch.setattr(features, "MANY_ROWS", 1000 if many else 10_000)
        kept = features.kept_by(features.lay_out(df, 3000), 3000)
        sums = kept.groupBy("product_id").agg(F.sum("v"))
        assert ("Exchange" in sums._jdf.queryExecution().executedPlan().toString()) is not many
        assert sorted(kept.collect()) == sorted(df.collect()) and kept.schema.names == df.schema.names
        assert not many or len(kept.inputFiles()) <= 10


def test_no_busy_product_no_exchange_of_sales(spark, small, monkeypatch):
    """Whole rows of sales were exchanged by product and month, though no product is split, and joined with rows that none carries over."""
    monkeypatch.setattr(features, "ROWS_PER_TASK", 300)
    monkeypatch.setattr(features, "MANY_ROWS", 1000)
    plan = joins.master(spark, small, build_master_busy)._jdf.queryExecution().executedPlan().toString()
    assert "_halo" not in plan and "Union" not in plan and not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "transaction_id" in line]
    # the catalog alone is exchanged, and once
    assert plan.count("Exchange hashpartitioning") <= 3
    split = joins.master(spark, small, lambda *tables: build_master_busy(*tables, busy_rows=35))
    assert "_halo" in split._jdf.queryExecution().executedPlan().toString() and split.columns == joins.master(spark, small, build_master_busy).columns
