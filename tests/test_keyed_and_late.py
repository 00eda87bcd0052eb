"""The keyed sink, and the account and repair of late events."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from pricelift.sources import testdata as td
from pricelift.streaming import events, job, keyed, late, scoring

T0 = dt.datetime(2024, 1, 1, 23, 59, 30)


def window_rows(spark, rows):
    data = [(p, T0 + dt.timedelta(seconds=s), T0 + dt.timedelta(seconds=s + 10), v) for p, s, v in rows]
    return spark.createDataFrame(data, "product_id long, window_start timestamp, window_end timestamp, v long")


def stored(sink, **limits):
    return sorted((r.product_id, int((r.window_start - T0).total_seconds()), r.v) for r in sink.read(**limits).collect())


def test_keyed_sink_holds_one_row_per_key(spark, tmp_path):
    sink = keyed.KeyedSink(spark, str(tmp_path / "k"), buckets=4)
    with pytest.raises(FileNotFoundError):
        sink.read()
    truth = {}
    for batch in range(5):
        rows = [(p, s, 100 * batch + p) for p in range(batch, 40, 2 + batch) for s in (0, 10, 60)[: 1 + batch % 3]]
        sink.upsert(window_rows(spark, rows), keyed.version_name("run1", batch))
        truth |= {(p, s): v for p, s, v in rows}
        assert stored(sink) == sorted((p, s, v) for (p, s), v in truth.items())
    before = stored(sink)
    # the same batch again replaces itself; an older run again does not win over newer ones
    sink.upsert(window_rows(spark, rows), keyed.version_name("run1", 4))
    assert stored(sink) == before
    assert stored(sink, dates=["2024-01-02"]) == [r for r in before if r[1] == 60]
    assert sink.read(["2024-01-02"]).columns == ["product_id", "window_start", "window_end", "v"]
    gone = sink.vacuum()
    assert gone > 0 and stored(sink) == before and all(len(v) == 1 for v in sink.versions().values())
    # one row per key on disk
    assert spark.read.parquet(str(tmp_path / "k")).count() == len(before)
    sink.upsert(window_rows(spark, []), keyed.version_name("run1", 9))
    assert stored(sink) == before
    # a batch touches the buckets of its products only
    held = {p: v[-1] for p, v in sink.versions().items()}
    sink.upsert(window_rows(spark, [(1, 0, 7)]), keyed.version_name("run2", 0))
    assert sum(v[-1] != held[p] for p, v in sink.versions().items()) == 1
    assert (1, 0, 7) in stored(sink)


def test_a_batch_that_was_cut_off_is_run_again(spark, tmp_path):
    sink = keyed.KeyedSink(spark, str(tmp_path / "k"), buckets=2)
    sink.upsert(window_rows(spark, [(p, 0, 1) for p in range(10)]), "a-0")
    sink.upsert(window_rows(spark, [(p, 0, 2) for p in range(5)]), "a-1")
    # a part of the batch did not arrive: readers still see its older version
    part, found = sorted(sink.versions().items())[0]
    lost = tmp_path / "k" / f"date={part[0]}" / f"bucket={part[1]}" / f"version={found[-1]}"
    lost.rename(tmp_path / "lost")
    assert len(stored(sink)) == 10
    sink.upsert(window_rows(spark, [(p, 0, 2) for p in range(5)]), "a-1")
    assert stored(sink) == [(p, 0, 2 if p < 5 else 1) for p in range(10)]


def event(product, seconds, units=1, price=5.0):
    return {"product_id": product, "units_sold": units, "current_price": price, "inventory_ratio": 0.5,
            "timestamp": (T0 + dt.timedelta(seconds=seconds)).isoformat()}


def put(folder, name, items):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("\n".join(json.dumps(i) for i in items))
    (folder / f".{name}").rename(folder / name)


def test_late_events_show_in_the_account_and_in_the_repaired_window(spark, small, tmp_path):
    lookup = td.lookup_edge(spark, small).filter("product_id < 5").withColumn("price_to_cost_ratio", F.lit(2.0))
    job.publish_lookup(lookup, str(tmp_path / "lookup"), 1)
    paths = job.StreamPaths(*(str(tmp_path / n) for n in ("features", "results", "log", "checkpoint", "current")))
    source = job.LookupSource(spark, str(tmp_path / "lookup"), min_interval=0)
    batches = [[event(1, 0, 1), event(2, 100, 1)], [event(3, 101, 1)], [event(1, 2, 7, 9.0), event(4, 3, 2), event(2, 103, 1)], [event(3, 200)]]
    for n, items in enumerate(batches):
        put(tmp_path / "in", f"{n}.json", items)
        os.utime(tmp_path / "in" / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))  # files are read in the order of their times
    listener = late.LateRows()
    spark.streams.addListener(listener)
    try:
        raw = events.stream_source(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger="1")
        windows = events.tumbling_demand(events.parse_events(raw), "10 seconds", watermark="15 seconds")
        query = job.start_pricing(windows, source, paths, trigger_seconds=None)
        query.awaitTermination(120)
        assert query.exception() is None
        for _ in range(100):
            if listener.dropped >= 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.dropped == 2 and [r.dropped for r in listener.account(spark).collect()] == [2]
    sink = keyed.KeyedSink(spark, paths.current)
    by_key = lambda: {(r.product_id, int((r.window_start - T0).total_seconds())): r for r in sink.read().collect()}
    before = by_key()
    # one row per window and product, though window 100 of product 2 was priced twice
    assert set(before) == {(1, 0), (2, 100), (3, 100), (3, 200)}
    archive = spark.read.text(str(tmp_path / "in"))
    until = str(T0 + dt.timedelta(seconds=60))
    account = {r.product_id: (r.late_orders, r.late_units) for r in job.repair_late(archive, source, paths, None, until).collect()}
    assert account == {1: (1, 7), 4: (1, 2)}
    features = {(r.product_id, int((r.window_start - T0).total_seconds())): r for r in scoring.latest_revision(job.read_batches(spark, paths.features)).collect()}
    assert features[1, 0].window_units == 8 and features[1, 0].orders == 2 and features[4, 0].window_units == 2
    after = by_key()
    assert after[1, 0].current_price == 7.0 and before[1, 0].current_price == 5.0
    assert set(after) == {*before, (4, 0)} and {k: v for k, v in after.items() if k[1]} == {k: v for k, v in before.items() if k[1]}
    # all windows now equal those of a batch run, and a second repair finds nothing
    truth = events.flat_window(events.tumbling_demand(events.parse_events(archive), "10 seconds"))
    expected = {(r.product_id, int((r.window_start - T0).total_seconds())): r.recommended_price for r in scoring.score_windows(truth, lookup).collect()}
    assert {k: r.recommended_price for k, r in after.items()} == expected
    assert job.repair_late(archive, source, paths, None, until).count() == 0
