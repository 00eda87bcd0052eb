"""A layout for lookups by key: bucketed, sorted Parquet with Bloom filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_served(
    df: DataFrame, name: str, buckets: int, key: str = "product_id", path: str | None = None, keys_in_bucket: int = 100_000,
) -> None:
    """Write df as a table with one sorted file per bucket of the key.

    A filter on the key reads one bucket, of it the row groups whose range and Bloom filter admit the value; a join on
    the key needs no exchange of this side.  ``keys_in_bucket`` sizes the Bloom filters.  Rows without a key
    are kept, all in one bucket.  The table lies in the warehouse, or at ``path``.
    """
    writer = (
        df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(keys_in_bucket))
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def lookup_served(spark: SparkSession, name: str, keys: Sequence[int], key: str = "product_id") -> DataFrame:
    """Rows of the asked keys; unknown and null keys give none.  Only the buckets of the keys are read."""
    return spark.table(name).filter(F.col(key).isin([k for k in keys if k is not None]))
