"""Write-audit-publish, crashes between its steps, and compaction run twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelift.operators import quality
from pricelift.plans import batch
from pricelift.sources import publish
from pricelift.streaming import job

RULES = (
    quality.Rule("price_in_range", ("price",), "{c} < 0 or {c} > 100", True),
    quality.Rule("name_known", ("name", "title"), "{c} is null", True),
    quality.Rule("extra", ("absent",), "{c} < 0"),
)


def good(spark, n=50):
    return spark.range(n).select("id", (F.col("id") * 1.0).alias("price"), F.lit("x").alias("title"), F.concat(F.lit("2024-0"), (F.col("id") % 2 + 1).cast("string")).alias("year_month"))


def folders(tmp_path):
    return sorted(p.name for p in tmp_path.iterdir())


def test_a_table_that_breaks_a_rule_leaves_the_old_one(spark, tmp_path):
    out = str(tmp_path / "master")
    report = publish.write_audited(good(spark), out, RULES, ["year_month"])
    assert {(r.rule, r.checked_column, r.status, r.failing_rows) for r in report.collect()} == {
        ("price_in_range", "price", "passed", 0), ("name_known", "title", "passed", 0), ("extra", None, "skipped", None)}
    bad = good(spark, 80).withColumn("price", F.when(F.col("id") < 3, F.lit(-1.0)).otherwise(F.col("price")))
    with pytest.raises(quality.ValidationFailed, match="price_in_range .price.: 3"):
        publish.write_audited(bad, out, RULES, ["year_month"])
    assert spark.read.parquet(out).count() == 50 and folders(tmp_path) == ["master"]
    with pytest.raises(quality.ValidationFailed, match="column missing"):
        publish.write_audited(good(spark).drop("title"), out, RULES)
    assert publish.read_published(spark, out).count() == 50
    publish.write_audited(good(spark, 60), out, RULES, ["year_month"])
    assert spark.read.parquet(out).count() == 60 and folders(tmp_path) == ["master"]


def test_rules_are_counted_by_the_pass_that_writes(spark, tmp_path):
    source = str(tmp_path / "in")
    good(spark).write.parquet(source)
    table = spark.read.parquet(source)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audit", "audit")
    try:
        publish.write_audited(table, str(tmp_path / "out"), RULES, ["year_month"])
        jobs = tracker.getJobIdsForGroup("audit")
        stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    # the scan, the exchange behind it and the write; the report of three rows is local
    assert len(stages) <= 4
    same = quality.validate(good(spark), RULES)
    assert sorted(map(tuple, same.collect()), key=str) == sorted(map(tuple, quality.report_of(spark, {"n_rows": 50, "r0": 0, "r1": 0}, good(spark).columns, RULES).collect()), key=str)


def test_a_crash_between_the_moves_loses_no_table(spark, tmp_path):
    out = tmp_path / "t"
    publish.write_audited(good(spark, 10), str(out))
    # the old table has stepped aside, the new one is not there yet
    out.rename(tmp_path / ("t" + publish.PREVIOUS))
    assert publish.read_published(spark, str(out)).count() == 10
    publish.settle(spark, str(out))
    assert spark.read.parquet(str(out)).count() == 10
    out.rename(tmp_path / ("t" + publish.PREVIOUS))
    publish.write_audited(good(spark, 20), str(out))
    assert spark.read.parquet(str(out)).count() == 20 and folders(tmp_path) == ["t"]
    # both are there: the older one was about to be deleted
    good(spark, 5).write.parquet(str(tmp_path / ("t" + publish.PREVIOUS)))
    publish.settle(spark, str(out))
    assert spark.read.parquet(str(out)).count() == 20 and folders(tmp_path) == ["t"]


def log_of(spark, day, windows):
    rows = [(p, day + dt.timedelta(seconds=s), day + dt.timedelta(seconds=s + 10), (day + dt.timedelta(seconds=s)).date(), u, 5.0, b) for p, s, u, b in windows]
    return spark.createDataFrame(rows, "product_id long, window_start timestamp, window_end timestamp, date date, units_sold long, current_price double, batch_id long")


def test_a_fold_that_stops_before_its_mark_is_not_published(spark, tmp_path, monkeypatch):
    day = dt.datetime(2024, 3, 1)
    master = str(tmp_path / "master")
    spark.createDataFrame([(1, dt.date(2024, 2, 28), 3, "2024-02")], "product_id long, date date, units_sold long, year_month string").write.parquet(master)
    log = log_of(spark, day, [(1, 0, 4, 0), (2, 30, 5, 0)])
    out = str(tmp_path / "folded")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(batch, "touch", crash)
        with pytest.raises(RuntimeError, match="lost"):
            batch.nightly_fold(spark, master, log, out, day + dt.timedelta(seconds=20))
    assert not (tmp_path / "folded").exists()
    folded = batch.nightly_fold(spark, master, log, out, day + dt.timedelta(seconds=20))
    assert folded.count() == 2 and batch.folded_until(spark, out) == "2024-03-01 00:00:20"
    # the same fold again replaces its table; the next one takes later windows only
    assert batch.nightly_fold(spark, master, log, out, day + dt.timedelta(seconds=20)).count() == 2
    assert batch.nightly_fold(spark, out, log, str(tmp_path / "next"), day + dt.timedelta(seconds=60)).count() == 3
    rule = quality.Rule("units", ("units_sold",), "{c} > 4", True)
    with pytest.raises(quality.ValidationFailed):
        batch.nightly_fold(spark, master, log, out, day + dt.timedelta(seconds=60), (rule,))
    assert spark.read.parquet(out).count() == 2


def test_compaction_can_be_run_twice(spark, tmp_path):
    day = dt.datetime(2024, 3, 1, 23, 59, 40)
    log = log_of(spark, day, [(1, 0, 1, 0), (1, 0, 4, 1), (2, 5, 2, 0), (1, 15, 6, 0), (2, 40, 7, 1), (3, 120, 9, 2)])
    out = str(tmp_path / "final")
    at = lambda s: str(day + dt.timedelta(seconds=s))
    got = lambda: sorted((r.product_id, r.units_sold, str(r.date)) for r in spark.read.parquet(out).collect())
    job.compact_batches(log, out, None, at(15))
    first = [(1, 4, "2024-03-01"), (2, 2, "2024-03-01")]
    assert got() == first
    job.compact_batches(log, out, None, at(15))
    assert got() == first
    # a window of the first date that closed later joins the earlier ones
    second = sorted([*first, (1, 6, "2024-03-01"), (2, 7, "2024-03-02")])
    for _ in range(2):
        job.compact_batches(log, out, at(15), at(60))
        assert got() == second
    job.compact_batches(log, out, at(60), at(200))
    assert got() == sorted([*second, (3, 9, "2024-03-02")])
