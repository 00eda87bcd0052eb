"""Write-audit-publish: a table is written aside, checked by counts of the same pass, and moved into place."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators import quality
from .tables import write_table

#: Ends of the names of a table that is being written, and of the one it is about to replace.
STAGING, PREVIOUS = ".staging-", ".previous"


def folder(spark: SparkSession, path: str):
    """The file system of a path and the path, as Hadoop objects."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, target = folder(spark, path)
    fs.create(target).close()


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = folder(spark, old)
    if not fs.rename(source, folder(spark, new)[1]):
        raise OSError(f"{old} could not be moved to {new}")


def settle(spark: SparkSession, out: str) -> None:
    """Put right what a crash between the two moves of ``publish`` left: the older table comes back, or goes for good."""
    fs, live = folder(spark, out)
    _, previous = folder(spark, out + PREVIOUS)
    if fs.exists(previous):
        if fs.exists(live):
            fs.delete(previous, True)
        else:
            _rename(spark, out + PREVIOUS, out)


def publish(spark: SparkSession, staged: str, out: str) -> None:
    """Put a complete folder in the place of another.

    Two moves, no copy: the old table steps aside, the new one takes its place, and the old one is deleted
    last.  After a crash between the moves ``read_published`` still finds the old table and ``settle`` puts it back.
    """
    settle(spark, out)
    fs, live = folder(spark, out)
    if fs.exists(live):
        _rename(spark, out, out + PREVIOUS)
    _rename(spark, staged, out)
    fs.delete(folder(spark, out + PREVIOUS)[1], True)


def read_published(spark: SparkSession, out: str) -> DataFrame:
    """The table in place, or the one before it if a crash left none there."""
    fs, live = folder(spark, out)
    return spark.read.parquet(out if fs.exists(live) else out + PREVIOUS)


def write_audited(
    df: DataFrame, out: str, rules: Sequence[quality.Rule] = (), partition_by: Sequence[str] = (),
    finish: Callable[[str], None] | None = None,
) -> DataFrame:
    """Write a table, and publish it only if it keeps the rules; returns the report.

    The rules are counted by the pass that writes, behind the exchange of the write: its tasks are those of the
    last stage, which count once however often an earlier stage runs again.  A table that breaks a rule is
    deleted, ``ValidationFailed`` is raised, and what stood in the place before is left alone.  ``finish`` gets
    the folder that is about to be published, for marks that belong to it.
    """
    spark = df.sparkSession
    staged = f"{out.rstrip('/')}{STAGING}{uuid.uuid4().hex}"
    seen = Observation("audit")
    write_table(df, staged, partition_by, "error", observed=(seen, quality.rule_counts(df.columns, rules)))
    report = quality.report_of(spark, seen.get, df.columns, rules)
    try:
        quality.assert_valid(report)
    except quality.ValidationFailed:
        fs, target = folder(spark, staged)
        fs.delete(target, True)
        raise
    if finish is not None:
        finish(staged)
    publish(spark, staged, out.rstrip("/"))
    return report
