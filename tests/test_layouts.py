"""Rolling windows over ranges of rows, the served layout and the channel for bad records."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelift.operators import features
from pricelift.sources import quarantine, schemas, served


def busy_sales(spark, n=60_000):
    """One product with all its rows in one month, one day of it and undated rows with a large share; some small products."""
    day = F.when(F.col("id") % 3 == 0, F.lit(14)).otherwise((F.col("id") % 28).cast("int"))
    date = F.when(F.col("id") % 5 != 0, F.date_add(F.lit("2024-05-01").cast("date"), day))
    product = F.when(F.col("id") % 50 == 0, F.col("id") % 700 + 10).otherwise(F.lit(1))
    return spark.range(n).select(product.alias("product_id"), date.alias("date"), F.col("id").alias("transaction_id"), (F.xxhash64("id") % 50).alias("units_sold"))


def test_ranges_spread_a_busy_month(spark):
    sales = busy_sales(spark)
    cut = features.with_ranges(sales, segments=12)
    sizes = [r["count"] for r in cut.groupBy(features.CHUNK).count().collect()]
    assert cut.filter("product_id = 1").select(features.CHUNK).distinct().count() >= 10
    assert max(sizes) < 2.5 * sales.count() / 12


@pytest.mark.parametrize("segments", [1, 12, 400])
def test_ranged_windows_equal_plain_ones(spark, segments):
    sales = busy_sales(spark, 6_000)
    w = Window.partitionBy("product_id").orderBy("date", "transaction_id").rowsBetween(-6, 0)
    plain = sales.select("transaction_id", F.round(F.avg("units_sold").over(w), 9).alias("m"), F.round(F.coalesce(F.stddev_samp("units_sold").over(w), F.lit(0.0)), 6).alias("s"))
    ranged = features.rolling_features_ranged(sales, segments=segments)
    assert set(ranged.columns) == {*sales.columns, "moving_avg_7day", "demand_volatility"}
    got = ranged.select("transaction_id", F.round("moving_avg_7day", 9), F.round("demand_volatility", 6))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    assert features.rolling_features_ranged(sales.limit(0)).count() == 0


def test_lookup_reads_one_bucket(spark, tmp_path):
    df = spark.range(2_000).select(F.col("id").alias("product_id"), (F.col("id") * 2).alias("price"))
    df = df.unionByName(spark.createDataFrame([(None, 5)], "product_id long, price long"))
    name = f"served_{uuid.uuid4().hex}"
    served.write_served(df, name, buckets=16, path=str(tmp_path / "t"))
    one = served.lookup_served(spark, name, [77])
    assert [tuple(r) for r in one.collect()] == [(77, 154)]
    # the plan names the buckets where the planner keeps the bucketed scan; it reads the same files where it does not
    setting = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    assert "SelectedBucketsCount: 1 out of 16" in served.lookup_served(spark, name, [77])._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(setting, before)
    assert one.rdd.getNumPartitions() == 1
    assert sorted(r.product_id for r in served.lookup_served(spark, name, [3, None, 9, 99_999]).collect()) == [3, 9]
    assert spark.table(name).count() == 2_001
    asked = spark.range(500).select(F.col("id").alias("product_id"))
    joined = asked.hint("merge").join(spark.table(name), "product_id")
    assert joined.count() == 500
    # only the asking side is exchanged
    assert joined._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 1
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(product_id") <= 1
    spark.sql(f"drop table {name}")


def test_bad_records_of_csv(spark, tmp_path):
    schema = schemas.schema_of("product_id long, date date, units_sold long, price double")
    source = tmp_path / "in"
    source.mkdir()
    head = "product_id,date,units_sold,price\n"
    (source / "a.csv").write_text(head + "1,2024-01-01,3,1.5\n2,2024-01-02,many,1.5\n3,2024-01\n4,,,inf\n")
    (source / "b.csv").write_text(head + "5,yesterday,x,2\n6,2024-01-03,7,2.5,extra\n7,2024-01-04,8,0.5\n")
    (source / "c.csv").write_text(head)
    checked = quarantine.read_checked(spark, str(source), schema)
    good = {tuple(r) for r in quarantine.accepted(checked).collect()}
    assert good == {(1, datetime.date(2024, 1, 1), 3, 1.5), (4, None, None, float("inf")), (7, datetime.date(2024, 1, 4), 8, 0.5)}
    # a query of one column turns the same records away
    assert sorted(r[0] for r in quarantine.accepted(checked).select("product_id").collect()) == [1, 4, 7]
    for _ in range(2):
        counts = quarantine.land_table(spark, str(source), schema, str(tmp_path / "out"), str(tmp_path / "bad"))
        got = {(r.source_file.rsplit("/", 1)[1], r["column"]): r.n_records for r in counts.collect()}
        assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert got[("a.csv", "units_sold")] == 1 and got[("b.csv", "date")] == 1 and got[("b.csv", "units_sold")] == 1
    assert got[("b.csv", "record")] == 1 and sum(n for (name, _), n in got.items() if name == "a.csv") == 2
    records = [r.record for r in spark.read.parquet(str(tmp_path / "bad")).collect()]
    assert sorted(records) == ["2,2024-01-02,many,1.5", "3,2024-01", "5,yesterday,x,2", "6,2024-01-03,7,2.5,extra"]


def test_bad_records_of_json(spark, tmp_path):
    schema = schemas.schema_of("product_id long, price double")
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text('{"product_id": 1, "price": 2.5}\n{"product_id": "one", "price": 2.5}\n{"product_id": 3, "pri\n{"price": null}\n')
    checked = quarantine.read_checked(spark, str(source), schema, "json")
    assert {tuple(r) for r in quarantine.accepted(checked).collect()} == {(1, 2.5), (None, None)}
    assert sorted(tuple(r.bad_columns) for r in quarantine.rejected(checked).collect()) == [("product_id",), ("record",)]
    with pytest.raises(ValueError):
        quarantine.read_checked(spark, str(source), schema, "parquet")


def test_lines_are_written_by_every_task_each_file_with_its_header(spark, tmp_path):
    """The lines arrive whole and unquoted, and no single task writes them all."""
    from pricelift.checks import layouts
    from pricelift.sources import schemas

    schema = schemas.schema_of("product_id long, date date, units_sold long, current_price double")
    lines = spark.range(4000).repartition(4).select(F.concat_ws(",", F.col("id"), F.lit("2024-01-01"), F.when(F.col("id") % 5 == 0, "many").otherwise("3"), F.lit("1.5")).alias("line"))
    layouts._write_lines(lines, schema, str(tmp_path / "lines"))
    files = [p.read_text().splitlines() for p in (tmp_path / "lines").glob("*.csv")]
    assert len(files) == 4 and {f[0] for f in files} == {",".join(schema.names)}
    assert sorted(line for f in files for line in f[1:]) == sorted(r.line for r in lines.collect())
    checked = quarantine.read_checked(spark, str(tmp_path / "lines"), schema)
    assert (quarantine.accepted(checked).count(), quarantine.rejected(checked).count()) == (3200, 800)
