"""Jump consistent hashing: a key and the number of shards give the shard, without a ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Multiplier of the generator in the published algorithm (Lamping and Veach, 2014): a fixed value.
JUMP_MULTIPLIER = 2862933555777941757

#: Pieces a shard is numbered in.  A piece holds 1/4096 of a shard, and only pieces x shards counts
#: are gathered, however many rows there are.
SLOT_PIECES = 4096

#: Copies of a row that are written out from one list.
STRETCH = 10_000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every 64-bit key.  All keys that have not settled take one jump a round."""
    state = keys.astype(np.uint64).copy()
    at = np.full(len(state), -1, dtype=np.int64)
    jump = np.zeros(len(state), dtype=np.int64)
    open_ = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(open_):
            at[open_] = jump[open_]
            state[open_] = state[open_] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
            draw = (state[open_] >> np.uint64(33)).astype(np.float64) + 1.0
            jump[open_] = ((at[open_] + 1).astype(np.float64) * (2147483648.0 / draw)).astype(np.int64)
            open_ = open_[jump[open_] < shards]
    return at


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a long key as a column; a null key counts as key 0."""

    @F.pandas_udf("int")
    def settle(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64), shards).astype(np.int32))

    return settle(F.coalesce(key.cast("long"), F.lit(0)))


def slot_piece(key: Column, checksum: Column, pieces: int) -> Column:
    """Piece of a shard a row is numbered in: checksums of its key and its text, so no arithmetic of keys fills one piece."""
    return F.pmod(F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0)) + checksum, F.lit(pieces))


def shard_documents(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", pieces: int = SLOT_PIECES) -> DataFrame:
    """Every row with its shard, its slot there, and its shard when one more is appended.

    Slots are gapless from 0 in each shard.  Equal rows are counted first, map-side, and take as many slots side by
    side; different rows are numbered inside a piece of the shard and start behind the rows of the pieces before it, so
    no task sees a whole shard, and many copies of one row are one row until they are written out, one after another.

    A null text has no bytes and checksum 0; a null key counts as key 0 for the shard.  An empty table gives no rows.
    Other columns are not carried over.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    read = docs.select(F.col(key).cast("long").alias("doc_id"), (F.octet_length(body).cast("long") + 8).alias("size"), F.crc32(body).alias("text_crc32"))
    counted = read.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    placed = counted.select(
        "*", slot_piece(F.col("doc_id"), F.col("text_crc32"), pieces).alias("piece"),
        jump_shard(F.col("doc_id"), shards).alias("shard"), jump_shard(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )
    inside = Window.partitionBy("shard", "piece").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("end", F.sum("n").over(inside))
    # 24 x 4096 sums at most
    counts = numbered.groupBy("shard", "piece").agg(F.max("end").alias("rows"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "piece", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    joined = numbered.join(starts, ["shard", "piece"])
    first = F.col("start") + F.col("end") - F.col("n")
    named = joined.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "grown_shard", first.alias("first"), (first + F.col("n") - 1).alias("last"))
    # written out by stretches, so that no list is as long as the copies of a row are many
    runs = named.select("*", F.explode(F.sequence("first", "last", F.lit(STRETCH).cast("long"))).alias("from_"))
    slots = F.explode(F.sequence("from_", F.least(F.col("from_") + STRETCH - 1, F.col("last")))).alias("slot")
    return runs.select("doc_id", "size", "text_crc32", "law", "shard", slots, "grown_shard")
