"""Session settings the library relies on. Nothing runs at import."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# UTC keeps event windows and ISO weeks the same on every cluster.  AQE sizes the
# shuffles and splits skewed join partitions at run time.
SETTINGS = {
    # the call site of every column would be recorded, some milliseconds each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "pricelift", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Put the UTC setting on a session somebody else made."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    ``spark.checkpoint.dir`` wins, then the folder the application already has.  A local master without either
    gets a temporary one; any other master is refused, as its machines share no folder we know of.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
        return shared
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-ckpt-"))
    return context.getCheckpointDir()
