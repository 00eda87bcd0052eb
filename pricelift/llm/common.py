"""Helpers shared by the corpus operators: shared scratch tables and code for the workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of the corpus contracts: runs of anything but space, tab and the line controls.
WORD = r"[^\x20\x09-\x0D]+"

#: Entries of a memo in a worker before it becomes the old one.
MEMO = 200_000

#: Longer texts are worked out each time, so that a memo stays small.
LONGEST_KEY = 64

_SHIPPED: set[str] = set()
_LOCAL_SCRATCH: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Where the setting is absent a local master gets one temporary folder per application;
    any other master is refused, since no other folder is known to be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = context.applicationId
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="run-llm-")
        root = _LOCAL_SCRATCH[app]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written to the shared folder and read back: the lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application, and bound their Arrow batches."""
    context = spark.sparkContext
    # texts may be long: the usual 10,000 of them at a time are too many for a small executor
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    bundle = os.path.join(tempfile.mkdtemp(prefix="run-ship-"), "corpus_code.zip")
    with zipfile.ZipFile(bundle, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(bundle)
    _SHIPPED.add(context.applicationId)


def ascii_lower(column):
    """Lower-case A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Memo(dict):
    """A dictionary that fills itself.  When it is full it becomes the old one, which is asked before
    a value is made anew, so that frequent keys stay; the old one before is forgotten.
    """

    def __init__(self, make, most: int = MEMO):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        if not isinstance(key, str) or len(key) <= LONGEST_KEY:
            self[key] = value
        return value
