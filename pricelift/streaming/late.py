"""An account of events that came behind the watermark, and the repair of the windows they belong to."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .events import flat_window, parse_events, tumbling_demand
from .scoring import WINDOW_KEY, latest_revision


class LateRows(StreamingQueryListener):
    """Counts what the watermark dropped, batch by batch, for one query or for all of a session.

    The engine drops rows behind its partial aggregate, so a figure counts (window, product) groups a task, not
    events; it says that and when something was late.  ``late_windows`` tells exactly which events.
    """

    def __init__(self, query_id: str | None = None):
        self._id, self._lock = query_id, threading.Lock()
        self._batches: dict[tuple[str, int], tuple[str | None, int]] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if self._id is not None and str(progress.id) != self._id:
            return
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        with self._lock:
            # a batch without data may report again under the same number
            key = str(progress.runId), progress.batchId
            before = self._batches.get(key, (None, 0))[1]
            self._batches[key] = progress.eventTime.get("watermark"), max(before, dropped)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    @property
    def dropped(self) -> int:
        with self._lock:
            return sum(n for _, n in self._batches.values())

    def account(self, spark: SparkSession) -> DataFrame:
        """run_id, batch_id, watermark, dropped of the batches that dropped something."""
        with self._lock:
            rows = [(run, batch, mark, n) for (run, batch), (mark, n) in sorted(self._batches.items()) if n]
        return spark.createDataFrame(rows, "run_id string, batch_id long, watermark string, dropped long")


def late_windows(raw: DataFrame, written: DataFrame, since: str | None, until: str, width: str = "10 seconds") -> DataFrame:
    """Windows that ended in (since, until] and of which the stream lacks events, with what they hold in truth.

    ``raw``: all events as they arrived (the archive of the topic), with a ``value`` column; ``written``: the
    stream's feature rows.  ``until`` must lie behind the watermark.  Columns of ``flat_window`` plus ``late_orders``
    and ``late_units``.  Both sides combine per window and product before they meet; the time limits reach both scans.
    """
    low = F.lit(since).cast("timestamp") if since is not None else None
    high = F.lit(until).cast("timestamp")
    events = parse_events(raw)
    near = F.col("event_time") < high
    if low is not None:
        near = near & (F.col("event_time") >= low - F.expr(f"interval {width}"))
    end = F.col("window_end") <= high
    if low is not None:
        end = end & (F.col("window_end") > low)
    truth = flat_window(tumbling_demand(events.filter(near), width)).filter(end)
    had = latest_revision(written.filter(end)).select(*WINDOW_KEY, F.col("orders").alias("_orders"), F.col("window_units").alias("_units"))
    joined = truth.join(had, list(WINDOW_KEY), "left")
    late = F.col("orders") - F.coalesce("_orders", F.lit(0))
    units = F.coalesce("window_units", F.lit(0)) - F.coalesce("_units", F.lit(0))
    return joined.withColumns({"late_orders": late, "late_units": units}).filter("late_orders > 0").drop("_orders", "_units")


def repair_run() -> str:
    """Name of a run of repairs: it sorts behind those of the stream, so its rows are the newest of their windows."""
    return f"s{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}repair"
