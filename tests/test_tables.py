"""Readers, writers, the audit, and the pipelines over written tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelift.checks import inputs
from pricelift.operators import models, quality
from pricelift.plans import batch
from pricelift.sources import schemas, tables
from pricelift.sources import testdata as td


def test_csv_with_infinity_keeps_its_type(spark, tmp_path):
    (tmp_path / "e.csv").write_text("product_id,price\n1,inf\n2,-inf\n3,2.5\n4,\n")
    schema = schemas.schema_of("product_id long, price double")
    got = {r.product_id: r.price for r in tables.read_table(spark, str(tmp_path / "e.csv"), schema, "csv").collect()}
    assert got == {1: float("inf"), 2: float("-inf"), 3: 2.5, 4: None}


def test_csv_needs_a_schema(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path), fmt="csv")


def test_require_inputs(spark, tmp_path):
    (tmp_path / "there").mkdir()
    tables.require_inputs(spark, [str(tmp_path / "there")])
    with pytest.raises(FileNotFoundError, match="gone"):
        tables.require_inputs(spark, [str(tmp_path / "there"), str(tmp_path / "gone")])


def test_write_table_partitions_and_round_trip(spark, tmp_path):
    df = spark.range(100).withColumn("year_month", F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string"))).repartition(4)
    out = str(tmp_path / "t")
    tables.write_table(df, out, partition_by=["year_month"])
    back = spark.read.parquet(out)
    # one file per small partition, not one per task and partition
    assert back.count() == 100 and len(list((tmp_path / "t").glob("year_month=*/*.parquet"))) == 3
    pruned = back.filter("year_month = '2024-02'")
    assert "PartitionFilters: [isnotnull(year_month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_export_as_csv(spark, small, tmp_path):
    filtered = inputs.edge_results(spark, small).filter("department = 'PROMO'").select("product_id", "recommended_price")
    tables.write_table(filtered, str(tmp_path / "out"), fmt="csv")
    back = tables.read_table(spark, str(tmp_path / "out"), schemas.schema_of("product_id long, recommended_price double"), "csv")
    assert sorted(back.collect()) == sorted(filtered.collect())


def test_audit_reports_missing(spark, small):
    got = {r["name"]: r for r in tables.audit_tables(spark, {"part": f"{small}/part.parquet", "no": f"{small}/no"}).collect()}
    assert got["no"].status == "missing" and got["no"].n_rows is None
    assert got["part"].n_rows == spark.read.parquet(f"{small}/part.parquet").count() and got["part"].n_cols == 6


@pytest.fixture(scope="module")
def raw(spark, small, tmp_path_factory):
    """The five raw tables, written."""
    root = tmp_path_factory.mktemp("raw")
    sales, catalog = td.sales_full(spark, small), td.catalog_full(spark, small)
    derived = batch.derive_tables(sales, catalog, inputs.FORECAST_START)
    frames = {"sales": sales, "catalog": catalog, "elasticity": derived.elasticity, "optimal": derived.optimal, "forecast": derived.forecast}
    paths = {}
    for name, df in frames.items():
        paths[name] = str(root / name)
        df.write.parquet(paths[name])
    return paths


def test_derived_tables_have_the_published_columns(spark, raw):
    for name, schema in schemas.TABLES.items():
        if name != "forecast":
            assert set(schema.names) == set(spark.read.parquet(raw[name]).columns), name
    assert set(schemas.FORECAST.names) - {"store_id"} == set(spark.read.parquet(raw["forecast"]).columns)


def test_pipeline_from_raw_tables_to_results(spark, raw, tmp_path):
    with pytest.raises(quality.ValidationFailed):  # prices of the test tables exceed the retail range
        batch.clean_and_merge(spark, raw, str(tmp_path / "gated"))
    rules = tuple(r for r in quality.MASTER_RULES if r.name not in ("price_in_range", "sensitivity_known"))
    master = batch.clean_and_merge(spark, raw, str(tmp_path / "master"), rules)
    assert len(master.columns) == 76
    kept, held = str(tmp_path / "kept"), str(tmp_path / "held")
    batch.hold_out(spark, master, kept, held)
    n = master.count()
    assert spark.read.parquet(kept).count() == int(n * 0.85)
    assert spark.read.parquet(kept).count() + spark.read.parquet(held).count() == n
    with pytest.raises(FileExistsError):
        batch.hold_out(spark, master, kept, held)
    history = spark.read.parquet(kept)
    with pytest.raises(quality.ValidationFailed):  # prices of the test tables exceed the retail range
        batch.retrain_and_price(history, str(tmp_path / "m"), str(tmp_path / "r"), dt.date(2001, 11, 5), max_trees=3)
    results = batch.retrain_and_price(history, str(tmp_path / "m"), str(tmp_path / "r"), dt.date(2001, 11, 5), 3, rules)
    assert results.count() == history.select("product_id").distinct().count()
    assert results.filter("recommended_price is null").count() == 0
    day = dt.datetime(2001, 12, 1)
    windows = [(1, day, day + dt.timedelta(seconds=10 * n), day.date(), 3 + n, 5.0, 0) for n in (1, 2)]
    log = spark.createDataFrame(windows, "product_id long, window_start timestamp, window_end timestamp, date date, units_sold long, current_price double, batch_id long")
    once = batch.nightly_fold(spark, kept, log, str(tmp_path / "folded"), day + dt.timedelta(seconds=10))
    again = batch.nightly_fold(spark, kept, log, str(tmp_path / "again"), day + dt.timedelta(seconds=10))
    assert once.count() == again.count() == history.count() + 1
    assert once.filter("year_month = '2001-12'").count() >= 1
    later = batch.nightly_fold(spark, str(tmp_path / "folded"), log, str(tmp_path / "later"), day + dt.timedelta(seconds=30))
    assert later.count() == history.count() + 2
    with pytest.raises(ValueError, match="itself"):
        batch.nightly_fold(spark, kept, log, kept + "/", day)


def test_trees_beat_a_constant_on_a_known_signal(spark, tmp_path):
    df = spark.range(3000).select(
        (F.rand(1) * 10).alias("current_price"), (F.rand(2) * 5).alias("cost_price"), F.rand(3).alias("inventory_ratio"),
        F.lit(2.0).alias("price_to_cost_ratio"), F.rand(4).alias("inventory_urgency_score"), (F.col("id") % 3 + 1).cast("int").alias("sensitivity_encoded"),
        F.col("id"),
    ).withColumn("units_sold", F.lit(60.0) - F.col("current_price") * 4 + F.col("sensitivity_encoded") * 3)
    train, test = df.filter("id < 2400"), df.filter("id >= 2400")
    constant = train.agg(F.avg("units_sold")).first()[0]
    baseline = test.agg(F.avg(F.abs(F.col("units_sold") - constant))).first()[0]
    model = models.train_demand(train, test, max_trees=60, depth=4, rate=0.1)
    model.write().overwrite().save(str(tmp_path / "m"))
    error = models.predict(test, type(model).load(str(tmp_path / "m"))).agg(F.avg(F.abs(F.col("units_sold") - F.col("prediction")))).first()[0]
    assert error < baseline / 4
    forest = models.train_forest(train, trees=10)
    assert models.predict(test, forest).agg(F.avg(F.abs(F.col("units_sold") - F.col("prediction")))).first()[0] < baseline / 2
    shares = models.feature_importance(spark, model).collect()
    assert shares[0].feature == "current_price" and shares[0].dominant
    assert sum(r.importance for r in shares) == pytest.approx(1.0)
    # scored at base price: the current price must not matter, and it comes back unchanged
    lookup = test.select("*", F.lit(5.0).alias("base_price"), F.col("id").alias("product_id")).drop("inventory_ratio")
    same = models.predict_baseline(lookup, model)
    moved = models.predict_baseline(lookup.withColumn("current_price", F.col("current_price") * 2), model)
    pairs = same.join(moved.select("product_id", F.col("baseline_demand").alias("b2"), F.col("current_price").alias("p2")), "product_id")
    assert pairs.filter("abs(baseline_demand - b2) > 1e-9 or abs(current_price * 2 - p2) > 1e-9").count() == 0
