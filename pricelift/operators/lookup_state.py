"""The product lookup kept up to date from what is new: mergeable states instead of a new pass over the whole table.

A state holds, per product, the sums and counts behind every mean (on the grids on which addition of doubles is exact, so
the order of merging does not matter) and, per product, column and value, how often the value occurs.  The
state of a table is the merged state of its parts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import grid_parts
from ..sources.publish import folder

#: Ends the name of a part that holds all parts before it.
COMPACTED = ".all"


@dataclass(frozen=True)
class LookupState:
    """``figures``: product_id and, per number c, n_c and the sums s_c and f_c; ``values``: product_id, field, value, n."""

    figures: DataFrame
    values: DataFrame
    schema: T.StructType


def _numbers(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name != "product_id" and isinstance(f.dataType, T.NumericType)]


def _others(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name != "product_id" and not isinstance(f.dataType, T.NumericType)]


def _parts(field: T.StructField) -> tuple[Column, Column]:
    """What is summed of a number: whole numbers as they are, others on a coarse and on a fine grid."""
    if isinstance(field.dataType, T.IntegralType):
        return F.col(field.name).cast("double"), F.lit(0.0)
    return grid_parts(field.name)


def partial_state(rows: DataFrame) -> LookupState:
    """The state of some rows of the wide table, which should be a written one: columns with text, dates or flags are
    counted by value, one scan of two columns each."""
    sums = []
    for f in _numbers(rows.schema):
        coarse, fine = _parts(f)
        sums += [F.count(coarse).alias(f"n_{f.name}"), F.sum(coarse).alias(f"s_{f.name}"), F.sum(fine).alias(f"f_{f.name}")]
    figures = rows.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), *sums)
    # one aggregate a column: each combines map-side, and no row is copied once for every column
    counted = [
        rows.filter(F.col(f.name).isNotNull()).groupBy("product_id", F.col(f.name).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .select("product_id", F.lit(f.name).alias("field"), "value", "n")
        for f in _others(rows.schema)
    ]
    none = rows.sparkSession.createDataFrame([], "product_id long, field string, value string, n long")
    return LookupState(figures, reduce(DataFrame.unionByName, counted, none.select(F.col("product_id").cast(rows.schema["product_id"].dataType), "field", "value", "n")), rows.schema)


def merged(*states: LookupState) -> LookupState:
    """The state of all rows that the states were made of."""
    figures = reduce(DataFrame.unionByName, [s.figures for s in states])
    names = [c for c in figures.columns if c != "product_id"]
    values = reduce(DataFrame.unionByName, [s.values for s in states])
    return LookupState(
        figures.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in names]),
        values.groupBy("product_id", "field", "value").agg(F.sum("n").alias("n")), states[0].schema,
    )


def lookup_of(state: LookupState) -> DataFrame:
    """One row per product, as ``features.product_lookup`` gives it: means, and the most frequent value (the smallest on ties)."""
    means = []
    for f in _numbers(state.schema):
        n = F.col(f"n_{f.name}")
        means.append((F.try_divide(F.col(f"s_{f.name}"), n) + F.try_divide(F.col(f"f_{f.name}"), n)).alias(f.name))
    out = state.figures.select("product_id", *means)
    others = _others(state.schema)
    if others:
        own = {f.name: F.col("value").cast(f.dataType) for f in others}
        modes = [
            F.min_by(F.when(F.col("field") == f.name, own[f.name]), F.when(F.col("field") == f.name, F.struct(-F.col("n"), own[f.name]))).alias(f.name)
            for f in others
        ]
        best = state.values.groupBy(F.col("product_id").alias("_product")).agg(*modes)
        out = out.join(best, F.col("product_id").eqNullSafe(F.col("_product")), "left").drop("_product")
    return out.select(*state.schema.names)


def write_state(state: LookupState, path: str, part: str) -> None:
    """Store the state of one part of the table under its name; the same part written again replaces itself."""
    state.figures.hint("rebalance").write.mode("overwrite").parquet(f"{path}/figures/part={part}")
    # the order in which a state is complete: its second table is written last
    state.values.hint("rebalance").write.mode("overwrite").parquet(f"{path}/values/part={part}")


def parts_of(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete parts, in order; parts before a compacted one are in it and do not count."""
    fs, values = folder(spark, f"{path}/values")
    if not fs.exists(values):
        return []
    names = sorted(s.getPath().getName().removeprefix("part=") for s in fs.listStatus(values))
    done = [n for n in names if fs.exists(folder(spark, f"{path}/values/part={n}/_SUCCESS")[1])]
    compacted = [n for n in done if n.endswith(COMPACTED)]
    return [n for n in done if not compacted or n >= compacted[-1]]


def read_state(spark: SparkSession, path: str, schema: T.StructType) -> LookupState:
    """The merged state of all stored parts, a few rows a product each."""
    parts = parts_of(spark, path)
    if not parts:
        raise FileNotFoundError(f"no state under {path}")
    figures, values = ([f"{path}/{kind}/part={p}" for p in parts] for kind in ("figures", "values"))
    return merged(LookupState(spark.read.parquet(*figures), spark.read.parquet(*values), schema))


def compact_state(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Merge all parts into one, named after the last of them.  Once it is complete the others do not count, so a
    crash before they are deleted changes nothing."""
    old = parts_of(spark, path)
    if len(old) < 2:
        return
    write_state(read_state(spark, path, schema), path, old[-1] + COMPACTED)
    for name in old:
        for kind in ("values", "figures"):
            fs, target = folder(spark, f"{path}/{kind}/part={name}")
            fs.delete(target, True)
