"""Batch readers and writers, and the audit of a set of tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

CSV_OPTIONS = {
    "header": "true", "positiveInf": "inf", "negativeInf": "-inf", "nanValue": "nan",
    "mode": "PERMISSIVE",
}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system that owns the path (local, HDFS or an object store)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(target))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Read one table.  CSV needs a schema, because guessing types costs a second scan
    and turns a column holding ``inf`` into text."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs an explicit schema")
        reader = reader.options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
    fmt: str = "parquet", observed: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Write from every task; the number of files follows the data, never one forced file.

    A partitioned write first rebalances by the partition columns: otherwise every task
    would leave a small file in every partition.  AQE splits a partition that holds much
    of the data and merges small ones.  ``observed`` takes aggregates of the rows in the same pass.
    """
    spread = df.hint("rebalance", *partition_by) if partition_by else df
    if observed is not None:
        spread = spread.observe(observed[0], *observed[1])
    writer = spread.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def written_once(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``df``, made once and written below the shared checkpoint folder.

    A checkpoint is read whole, in as many tasks as made it; of these files a later reading takes only the columns and parts that
    it names, in tasks as large as the session wants them.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, key: str, parts: int) -> DataFrame:
    """The rows of ``df``, made once and written below the shared checkpoint folder in ``parts`` buckets of ``key``.

    What goes by the key reads them without an exchange, a bucket a task.  The table is known to this session alone.
    """
    spark = df.sparkSession
    name = f"rows_{uuid.uuid4().hex}"
    df.write.bucketBy(parts, key).option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name)
    return spark.table(name)


def require_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    missing = [path for path in paths if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))


def audit_frame(name: str, df: DataFrame) -> DataFrame:
    """Row count, column count and first four columns of one table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("name"), F.lit("ok").alias("status"), "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.lit(", ".join(df.columns[:4])).alias("sample_cols"),
    )


def audit_tables(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet",
    schemas: Mapping[str, T.StructType] | None = None,
) -> DataFrame:
    """One row per dataset.  A missing path is a row with status ``missing``."""
    empty = T.StructType([
        T.StructField("name", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("n_rows", T.LongType()), T.StructField("n_cols", T.LongType()),
        T.StructField("sample_cols", T.StringType()),
    ])
    parts = [spark.createDataFrame([], empty)]
    for name, path in paths.items():
        if path_exists(spark, path):
            parts.append(audit_frame(name, read_table(spark, path, (schemas or {}).get(name), fmt)))
        else:
            parts.append(spark.createDataFrame([(name, "missing", None, None, None)], empty))
    return reduce(DataFrame.unionByName, parts)
