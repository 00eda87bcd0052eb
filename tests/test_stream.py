"""Streaming runs over a folder of event files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pricelift.operators import joins
from pricelift.sources import testdata as td
from pricelift.streaming import events, job, scoring

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def event(product, seconds, units=1, price=5.0, ratio=0.5):
    return {"product_id": product, "units_sold": units, "current_price": price, "inventory_ratio": ratio,
            "timestamp": (T0 + dt.timedelta(seconds=seconds)).isoformat()}


def put(folder, name, items):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(i) if isinstance(i, dict) else i for i in items]
    (folder / f".{name}").write_text("\n".join(lines))
    (folder / f".{name}").rename(folder / name)


@pytest.fixture
def setup(spark, small, tmp_path):
    lookup = td.lookup_edge(spark, small).filter("product_id < 5").withColumn("price_to_cost_ratio", F.lit(2.0))
    job.publish_lookup(lookup, str(tmp_path / "lookup"), 1)
    paths = job.StreamPaths(*(str(tmp_path / n) for n in ("features", "results", "log", "checkpoint")))
    source = job.LookupSource(spark, str(tmp_path / "lookup"), min_interval=0)

    def run_all():
        raw = events.stream_source(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger="1")
        windows = events.tumbling_demand(events.parse_events(raw), "10 seconds", watermark="15 seconds")
        query = job.start_pricing(windows, source, paths, trigger_seconds=None)
        query.awaitTermination(120)
        assert query.exception() is None

    return tmp_path, paths, source, run_all, lookup


def as_dict(df, *columns):
    return {(r.window_start, r.product_id): tuple(r[c] for c in columns) for r in df.collect()}


def test_stream_equals_batch(spark, setup):
    tmp, paths, _, run_all, lookup = setup
    first = [event(1, 0, 2), event(1, 3, 4, 7.0), event(2, 11), event(99, 12, 3, 8.0), "{broken", event(None, 1), {"product_id": 1, "timestamp": "soon"}]
    second = [event(1, 5, 10, 6.0), event(3, 25, 1)]
    put(tmp / "in", "a.json", first)
    put(tmp / "in", "b.json", second)
    run_all()
    live = scoring.latest_revision(job.read_batches(spark, paths.results))
    good = [e for e in first + second if isinstance(e, dict) and e["product_id"] and e["timestamp"] != "soon"]
    rows = spark.createDataFrame([(json.dumps(e),) for e in good], "value string")
    windows = events.flat_window(events.tumbling_demand(events.parse_events(rows), "10 seconds"))
    batch = scoring.score_windows(windows, lookup)
    columns = ("recommended_price", "predicted_demand", "optimization_method", "is_new_product", "current_price", "product_name")
    assert as_dict(live, *columns) == as_dict(batch, *columns)
    assert {r.product_id for r in live.filter("is_new_product").collect()} == {99}
    # window 0 of product 1 was written by two batches; the last one holds all 16 units
    features = job.read_batches(spark, paths.features).filter("product_id = 1")
    assert features.count() == 2
    assert scoring.latest_revision(features).first().window_units == 16


def test_late_rows_within_the_watermark_count_and_older_ones_do_not(spark, setup):
    tmp, paths, _, run_all, _ = setup
    put(tmp / "in", "a.json", [event(1, 0, 1), event(2, 100, 1)])
    put(tmp / "in", "b.json", [event(3, 101, 1)])
    put(tmp / "in", "c.json", [event(2, 92, 5), event(1, 2, 7)])  # late rows are judged by the watermark of the batch before
    run_all()
    units = as_dict(scoring.latest_revision(job.read_batches(spark, paths.features)), "window_units")
    by = {(int((k[0] - T0).total_seconds()), k[1]): v[0] for k, v in units.items()}
    assert by[(0, 1)] == 1      # 2 s is far behind the watermark of 85 s: dropped
    assert by[(90, 2)] == 5     # 92 s is later than 85 s: kept


def test_restart_goes_on_from_the_checkpoint(spark, setup):
    tmp, paths, _, run_all, _ = setup
    put(tmp / "in", "a.json", [event(1, 0, 2)])
    run_all()
    put(tmp / "in", "b.json", [event(1, 1, 3)])
    run_all()
    latest = scoring.latest_revision(job.read_batches(spark, paths.features))
    assert [r.window_units for r in latest.collect()] == [5]


def test_a_lost_checkpoint_keeps_history(spark, setup):
    tmp, paths, source, run_all, _ = setup
    put(tmp / "in", "a.json", [event(1, 0, 2)])
    run_all()
    before = job.read_batches(spark, paths.features).count()
    (tmp / "checkpoint").rename(tmp / "lost")
    put(tmp / "in", "b.json", [event(2, 30, 3)])
    run_all()
    rows = job.read_batches(spark, paths.features)
    assert rows.select("run").distinct().count() == 2 and rows.count() >= 2 * before
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == job.STATE_STORE
    assert {r.product_id: r.window_units for r in scoring.latest_revision(rows).collect()} == {1: 2, 2: 3}


def test_a_repeated_batch_replaces_itself(spark, setup):
    tmp, paths, source, _, _ = setup
    rows = spark.createDataFrame([(json.dumps(event(1, 0, 2)),)], "value string")
    windows = events.tumbling_demand(events.parse_events(rows), "10 seconds")
    write = job.make_batch_writer(source, paths)
    write(windows, 4)
    write(windows, 4)
    write(windows.limit(0), 5)
    for path in (paths.features, paths.results, paths.training_log):
        got = job.read_batches(spark, path)
        assert got.count() == 1 and got.first().batch_id == 4


def test_training_log_folds_closed_windows_once(spark, setup):
    tmp, paths, _, run_all, _ = setup
    put(tmp / "in", "a.json", [event(1, 0, 2), event(1, 61, 1)])
    put(tmp / "in", "b.json", [event(1, 63, 4)])
    run_all()
    log = job.read_batches(spark, paths.training_log)
    assert log.count() == 3
    cut = str(T0 + dt.timedelta(seconds=30))
    end = str(T0 + dt.timedelta(seconds=90))
    early, late = scoring.closed_windows(log, None, cut), scoring.closed_windows(log, cut, end)
    assert [r.units_sold for r in early.collect()] == [2] and [r.units_sold for r in late.collect()] == [5]
    assert early.columns == ["product_id", "date", "units_sold", "current_price", "cost_price", "inventory_ratio",
                             "price_to_cost_ratio", "inventory_urgency_score", "sensitivity_encoded"]
    assert early.first().date == dt.date(2024, 1, 1)
    master = spark.createDataFrame([(9, "tea", 1)], "product_id long, product_name string, units_sold long")
    assert joins.fold_back(joins.fold_back(master, early), late).count() == 3


def test_lookup_refresh(spark, small, tmp_path):
    clock = {"now": 0.0}
    lookup = td.lookup_edge(spark, small).filter("product_id < 3")
    job.publish_lookup(lookup, str(tmp_path), 1)
    source = job.LookupSource(spark, str(tmp_path), min_interval=60, clock=lambda: clock["now"])
    assert source.current()[0].count() == 3 and source.version == 1
    job.publish_lookup(td.lookup_edge(spark, small).filter("product_id < 7"), str(tmp_path), 2)
    clock["now"] = 59.0
    assert source.current()[0].count() == 3          # not looked for yet
    clock["now"] = 60.0
    assert source.current()[0].count() == 7 and source.version == 2
    with pytest.raises(FileNotFoundError):
        (tmp_path / "x" / "lookups").mkdir(parents=True)
        job.LookupSource(spark, str(tmp_path / "x")).current()


def test_replayed_holdout_can_be_parsed_again(spark, small):
    holdout = td.sales(spark, small).select("transaction_id", "product_id", "product_name", "units_sold", "current_price", "inventory_ratio")
    sent = events.replay_events(holdout, T0)
    parsed = events.parse_events(sent)
    assert parsed.count() == holdout.count()
    assert parsed.agg(F.sum("units_sold")).first()[0] == holdout.agg(F.sum("units_sold")).first()[0]
    assert parsed.select("event_time").distinct().collect()[0][0] == T0


def test_replay_defaults(spark):
    thin = spark.createDataFrame([(7, 2.5)], "product_id long, current_price double")
    got = json.loads(events.replay_events(thin, T0).first().value)
    assert (got["units_sold"], got["inventory_ratio"], got["product_name"]) == (1, 1.0, "Unknown")
    total = spark.createDataFrame([(7, 2.5, 12)], "product_id long, current_price double, total_units_sold long")
    assert json.loads(events.replay_events(total, T0).first().value)["units_sold"] == 12
