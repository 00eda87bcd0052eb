"""The product lookup from merged states equals the one from the whole table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelift.operators import features, lookup_state
from pricelift.plans import batch
from pricelift.sources import testdata as td

DAY = dt.datetime(2024, 3, 1)


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def master_of(spark, small):
    sales = td.sales(spark, small).select("product_id", "product_name", "department", "date", "units_sold", "current_price", "cost_price", "inventory_ratio")
    odd = sales.withColumns({
        "department": F.when(F.col("product_id") % 7 != 0, F.col("department")),
        "current_price": F.when(F.col("product_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("current_price") / 3),
        "cheap": F.when(F.col("product_id") % 3 != 0, F.col("cost_price") < 500), "year_month": F.date_format("date", "yyyy-MM"),
    })
    return odd.select("product_id", "product_name", "department", "date", "units_sold", "current_price", "cost_price", "inventory_ratio", "cheap", "year_month")


def log_of(spark, small):
    sales = td.sales(spark, small).limit(400).select(
        "product_id", (F.monotonically_increasing_id() % 300).alias("s"), F.col("units_sold"), "current_price", "cost_price", "inventory_ratio")
    start = F.timestamp_seconds(F.lit(int(DAY.replace(tzinfo=dt.timezone.utc).timestamp())) + F.col("s"))
    windows = sales.groupBy("product_id", "s").agg(*[F.max(c).alias(c) for c in ("units_sold", "current_price", "cost_price", "inventory_ratio")])
    return windows.select("product_id", start.alias("window_start"), (start + F.expr("interval 10 seconds")).alias("window_end"), F.to_date(start).alias("date"),
                          "units_sold", "current_price", "cost_price", "inventory_ratio", F.lit(0).alias("batch_id")).persist()


def test_states_merge_to_the_lookup_of_the_whole(spark, small):
    master = master_of(spark, small).persist()
    parts = [lookup_state.partial_state(master.filter(F.crc32(F.col("date").cast("string").cast("binary")) % 3 == n)) for n in range(3)]
    whole = rows_of(features.product_lookup(master))
    assert rows_of(lookup_state.lookup_of(lookup_state.merged(*parts))) == whole
    assert rows_of(lookup_state.lookup_of(lookup_state.merged(parts[2], lookup_state.merged(parts[1], parts[0])))) == whole
    assert lookup_state.lookup_of(lookup_state.partial_state(master.limit(0))).count() == 0


def test_three_folds_equal_a_full_recompute_and_read_the_new_windows_only(spark, small, tmp_path):
    state, paths = str(tmp_path / "state"), [str(tmp_path / f"m{n}") for n in range(4)]
    master_of(spark, small).write.partitionBy("year_month").parquet(paths[0])
    log = log_of(spark, small)
    schema = spark.read.parquet(paths[0]).schema
    batch.begin_lookup_state(spark.read.parquet(paths[0]), state)
    for n, seconds in enumerate((60, 150, 400)):
        until = DAY + dt.timedelta(seconds=seconds)
        batch.nightly_fold(spark, paths[n], log, paths[n + 1], until, state=state)
        if n == 1:  # a fold that is run again, with a later end, replaces its state
            batch.nightly_fold(spark, paths[n], log, paths[n + 1], until + dt.timedelta(seconds=20), state=state)
    folded = spark.read.parquet(paths[3])
    assert folded.count() == spark.read.parquet(paths[0]).count() + log.count()
    whole = rows_of(features.product_lookup(folded))
    assert rows_of(batch.current_lookup(spark, state, schema)) == whole
    assert lookup_state.parts_of(spark, state) == ["0", "1", "220240301000100", "220240301000250"]
    # the state of a fold is made from the log alone, and the lookup from states alone
    fresh = lookup_state.partial_state(batch.fold_back(spark.read.parquet(paths[0]).filter(F.lit(False)), log))
    assert not fresh.figures.inputFiles() and not fresh.values.inputFiles()
    assert all(f"{state}/" in f for f in batch.current_lookup(spark, state, schema).inputFiles())
    lookup_state.compact_state(spark, state, schema)
    assert lookup_state.parts_of(spark, state) == ["220240301000250.all"] and rows_of(batch.current_lookup(spark, state, schema)) == whole
    lookup_state.compact_state(spark, state, schema)
    # a part written before the compacted one is in it already
    lookup_state.write_state(lookup_state.partial_state(folded), state, "1")
    assert rows_of(batch.current_lookup(spark, state, schema)) == whole
    with pytest.raises(FileNotFoundError):
        lookup_state.read_state(spark, str(tmp_path / "none"), schema)
