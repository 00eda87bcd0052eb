"""Chronological split without a global sort."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir

HOLDOUT_FRACTION = 0.15
TRAIN_FRACTION = 0.70 / 0.85


@dataclass(frozen=True)
class SplitPoint:
    """Last (date, digest) of the older part; ``date`` is None when that part is empty."""

    date: dt.date | None
    digest: str | None


def row_digest(keys: Sequence[str]) -> Column:
    """Order inside one date: a digest of the key, spread evenly whatever the key's skew."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def _holding(counts: DataFrame, order: str, rank: int) -> tuple[object, int]:
    """Group that holds the rank-th row of ordered group counts, and the rows before it.

    ``counts`` is small by construction: one row per date, 65,536 digest cells,
    or the keys of one such cell."""
    w = Window.partitionBy(F.lit(0)).orderBy(order)
    running = counts.withColumn("_end", F.sum("n").over(w))
    row = running.filter((F.col("_end") >= rank) & (F.col("_end") - F.col("n") < rank)).first()
    return row[order], row["_end"] - row["n"]


def split_point(
    df: DataFrame, fraction: float, keys: Sequence[str], date_col: str = "date"
) -> SplitPoint:
    """Where to cut so that the older part has int(rows x fraction) rows.

    Rows are ordered by (date, digest of the key).  One pass counts them per date and digest prefix (65,536 prefixes
    a date at most); that small table, written to the cluster's shared folder, gives the date and the prefix of the cut, and a
    second pass looks at the keys of this one prefix only.  No task sorts a whole date, even one that holds a third of all rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    digest = row_digest(keys)
    counts = (
        df.filter(F.col(date_col).isNotNull()).groupBy(F.col(date_col).alias("_day"), F.substring(digest, 1, 4).alias("cell"))
        .agg(F.count(F.lit(1)).alias("n")).checkpoint()
    )
    dates = counts.groupBy("_day").agg(F.sum("n").alias("n"))
    total = dates.agg(F.sum("n")).first()[0] or 0
    rank = int(total * fraction)
    if rank <= 0:
        return SplitPoint(None, None)
    day, before = _holding(dates, "_day", rank)
    rank -= before
    prefix, before = _holding(counts.filter(F.col("_day") == F.lit(day)), "cell", rank)
    inside = df.filter((F.col(date_col) == F.lit(day)) & digest.startswith(prefix)).groupBy(digest.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    return SplitPoint(day, _holding(inside, "cell", rank - before)[0])


def split_at(
    df: DataFrame, point: SplitPoint, keys: Sequence[str], date_col: str = "date"
) -> tuple[DataFrame, DataFrame]:
    """Older and newer part.  The cut is a literal, so the date test reaches the scan.

    Rows with the same complete key are copies and stay on one side."""
    if point.date is None:
        return df.filter(F.lit(False)), df.filter(F.col(date_col).isNotNull())
    day = F.col(date_col)
    at_cut = row_digest(keys) <= F.lit(point.digest)
    older = (day < F.lit(point.date)) | ((day == F.lit(point.date)) & at_cut)
    newer = (day > F.lit(point.date)) | ((day == F.lit(point.date)) & ~at_cut)
    return df.filter(older), df.filter(newer)


def chrono_split(
    df: DataFrame, fraction: float, keys: Sequence[str] = ("product_id", "transaction_id"),
    date_col: str = "date",
) -> tuple[DataFrame, DataFrame]:
    """Oldest ``fraction`` of the rows, and the rest.  Rows without a date are in neither."""
    return split_at(df, split_point(df, fraction, keys, date_col), keys, date_col)
