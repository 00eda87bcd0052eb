"""The running stream: micro-batch writers, lookup refresh and start-up."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .events import flat_window
from .keyed import KeyedSink, version_name
from .late import late_windows, repair_run
from .scoring import TRAINING_INPUTS, closed_windows, score_windows, training_rows
from ..operators.pricing import RESULT_COLUMNS
from ..sources.publish import folder as folder_of

# RocksDB keeps window state off the JVM heap, so the number of products may grow; ``start_pricing`` sets it.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Run of batches that are written without a checkpoint of their own.
NO_RUN = "run0"


def batch_folder(path: str, batch_id: int, run: str) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int, run: str = NO_RUN) -> None:
    """Write one micro-batch into its own folder of its run.

    A batch that is run again after a failure replaces what it wrote the first time, and
    nothing that another run wrote.  The rebalance keeps the number of files in step with the size of the batch."""
    df.hint("rebalance").write.mode("overwrite").parquet(batch_folder(path, batch_id, run))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All written batches with their ``run`` and ``batch_id``; later runs have larger names."""
    return spark.read.parquet(path)


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint folder belongs to.

    It is the name of an empty file there, made at the first start.  With a new checkpoint batch numbers begin at 0
    again; a run of its own keeps them from replacing what was written before."""
    fs, folder = folder_of(spark, f"{checkpoint}/pricing")
    if fs.exists(folder):
        names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
        if names:
            return names[0]
    run = f"run{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}x{uuid.uuid4().hex[:8]}"
    fs, target = folder_of(spark, f"{checkpoint}/pricing/{run}")
    fs.create(target).close()
    return run


def compact_batches(log: DataFrame, out: str, since: str | None, until: str) -> None:
    """Write the final rows of the windows that ended in (since, until] below their date, in few files.

    ``log`` holds ``date``.  Every date that such a window has is written anew as a whole, with its earlier windows,
    and replaces what stood there: a span that is compacted twice, or again after a failure, gives the same rows.
    Readers of one date open that date only."""
    span = F.col("window_end") <= F.lit(until).cast("timestamp")
    if since is not None:
        span = span & (F.col("window_end") > F.lit(since).cast("timestamp"))
    dates = log.filter(span).select("date").distinct()
    whole = closed_windows(log.join(dates, "date", "left_semi"), None, until)
    whole.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(out)


def publish_lookup(lookup: DataFrame, path: str, version: int, model: PipelineModel | None = None) -> None:
    """Write a lookup (and its model) as a new version; running readers keep the old one."""
    if model is not None:
        model.write().overwrite().save(f"{path}/models/version={version}")
    lookup.write.mode("error").parquet(f"{path}/lookups/version={version}")


class LookupSource:
    """Newest published lookup, looked for at most every ``min_interval`` seconds."""

    def __init__(
        self, spark: SparkSession, path: str, min_interval: float = 60.0,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self._spark, self._path = spark, path
        self._interval, self._clock = min_interval, clock
        self._checked: float | None = None
        self._version: int | None = None
        self._current: tuple[DataFrame, PipelineModel | None] | None = None

    def _newest(self) -> int:
        jvm = self._spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self._path}/lookups")
        fs = folder.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
        versions = []
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("version=") and fs.exists(done):
                versions.append(int(name.split("=", 1)[1]))
        if not versions:
            raise FileNotFoundError(f"no lookup published under {self._path}")
        return max(versions)

    @property
    def version(self) -> int | None:
        return self._version

    def current(self) -> tuple[DataFrame, PipelineModel | None]:
        now = self._clock()
        if self._current is not None and now - self._checked < self._interval:
            return self._current
        self._checked = now
        newest = self._newest()
        if newest != self._version:
            lookup = self._spark.read.parquet(f"{self._path}/lookups/version={newest}")
            self._current = (lookup, self._model(newest))
            self._version = newest
        return self._current

    def _model(self, version: int) -> PipelineModel | None:
        jvm = self._spark.sparkContext._jvm
        path = f"{self._path}/models/version={version}"
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
        return PipelineModel.load(path) if fs.exists(target) else None


@dataclass(frozen=True)
class StreamPaths:
    features: str
    results: str
    training_log: str
    checkpoint: str
    #: Where one row per window and product is kept, beside the revisions; nowhere if None.
    current: str | None = None


def write_scored(flat: DataFrame, lookup: DataFrame, model: PipelineModel | None, paths: StreamPaths, batch_id: int, run: str) -> None:
    """Price window rows and write the results, the training log and, if it is kept, the current row of each window."""
    scored = score_windows(flat, lookup, model, keep=TRAINING_INPUTS).persist()
    try:
        results = scored.select("window_start", "window_end", *RESULT_COLUMNS, "is_new_product")
        write_batch(results, paths.results, batch_id, run)
        write_batch(training_rows(scored), paths.training_log, batch_id, run)
        if paths.current is not None:
            # from what was written: the rows of the stream are not worked out once more
            written = flat.sparkSession.read.parquet(batch_folder(paths.results, batch_id, run))
            KeyedSink(flat.sparkSession, paths.current).upsert(written, version_name(run, batch_id))
    finally:
        scored.unpersist()


def repair_late(raw: DataFrame, lookups: LookupSource, paths: StreamPaths, since: str | None, until: str, run: str | None = None) -> DataFrame:
    """Reprice the windows that ended in (since, until] and lack late events; returns the account of them.

    The repaired windows are written as batch 0 of a run of repairs, whose rows are newer than any of the stream.  Windows
    that need nothing are not written again, so a second repair of a span is empty.
    """
    spark, run = raw.sparkSession, run or repair_run()
    found = late_windows(raw, read_batches(spark, paths.features), since, until)
    # written first: the account and the new rows must be of one reading of both sides
    account = f"{paths.features}_late/run={run}"
    found.write.mode("overwrite").parquet(account)
    late = spark.read.parquet(account)
    if not late.isEmpty():
        flat = late.drop("late_orders", "late_units")
        lookup, model = lookups.current()
        write_batch(flat, paths.features, 0, run)
        write_scored(flat, lookup, model, paths, 0, run)
    return late


def make_batch_writer(lookups: LookupSource, paths: StreamPaths, run: str = NO_RUN) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: window rows in; features, results and log out."""

    def write(windows: DataFrame, batch_id: int) -> None:
        flat = flat_window(windows).persist()
        try:
            if flat.isEmpty():
                return
            lookup, model = lookups.current()
            write_batch(flat, paths.features, batch_id, run)
            write_scored(flat, lookup, model, paths, batch_id, run)
        finally:
            flat.unpersist()

    return write


def start_pricing(
    windows: DataFrame, lookups: LookupSource, paths: StreamPaths, trigger_seconds: int | None = 10
) -> StreamingQuery:
    """Start the pricing stream in update mode, with its state in RocksDB.  ``trigger_seconds=None`` works off what is
    there and stops."""
    spark = windows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = (
        windows.writeStream.outputMode("update")
        .foreachBatch(make_batch_writer(lookups, paths, run_of(spark, paths.checkpoint)))
        .option("checkpointLocation", paths.checkpoint)
    )
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()
