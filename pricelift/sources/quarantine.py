"""A channel for records of text files that do not fit their schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import CSV_OPTIONS, write_table

RECORD, FILE, BAD = "_corrupt_record", "source_file", "bad_columns"
#: What is named bad where every value fits, but the record has too few or too many of them.
WHOLE = "record"


def _options(fmt: str) -> dict[str, str]:
    if fmt == "csv":
        # a reader that parses the asked columns only would not see a bad value in another one
        return {**CSV_OPTIONS, "columnNameOfCorruptRecord": RECORD, "columnPruning": "false"}
    if fmt == "json":
        return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    raise ValueError(f"{fmt} files carry their types; records are checked in csv and json only")


def _texts_of(schema: T.StructType, fmt: str) -> Column:
    """The values of a bad record as text."""
    texts = ", ".join(f"`{field.name}` string" for field in schema)
    return F.from_csv(RECORD, texts) if fmt == "csv" else F.from_json(RECORD, texts)


def read_checked(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Every record: the columns of the schema, its text where it does not fit, its file, and the columns at fault (an empty list where it fits).

    A value that cannot be read as its type is at fault; a torn or overlong record whose values fit is at fault as a whole.
    An empty value is null and fits.  Empty files give no rows.
    """
    with_record = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType(), True)])
    read = spark.read.format(fmt).options(**_options(fmt)).schema(with_record).load(path)
    texts = read.withColumns({FILE: F.col("_metadata.file_path"), "_texts": _texts_of(schema, fmt)})
    unread = [
        F.when(F.col(f"`{field.name}`").isNull() & F.col(f"_texts.`{field.name}`").isNotNull(), F.lit(field.name))
        for field in schema
    ]
    named = F.array_compact(F.array(*unread))
    none = F.array().cast("array<string>")
    at_fault = F.when(F.size(named) > 0, named).when(F.col(RECORD).isNotNull(), F.array(F.lit(WHOLE))).otherwise(none)
    return texts.withColumn(BAD, at_fault).drop("_texts")


def accepted(checked: DataFrame) -> DataFrame:
    """The records that fit, with the columns of their schema.

    The filter mentions every column: the scan of a later query of one column would else read that one
    alone and let records pass that are bad in another.
    """
    return checked.filter(F.size(BAD) == 0).drop(RECORD, FILE, BAD)


def rejected(checked: DataFrame) -> DataFrame:
    """File, text and columns at fault of the records that do not fit."""
    return checked.filter(F.size(BAD) > 0).select(FILE, F.col(RECORD).alias("record"), BAD)


def rejected_counts(turned_away: DataFrame) -> DataFrame:
    """Records turned away per file and column; one that is bad in two columns counts for both."""
    return turned_away.select(FILE, F.explode(BAD).alias("column")).groupBy(FILE, "column").agg(F.count(F.lit(1)).alias("n_records"))


def land_table(
    spark: SparkSession, path: str, schema: T.StructType, out: str, quarantine: str, fmt: str = "csv",
) -> DataFrame:
    """Write what fits to ``out`` and the rest to ``quarantine``; returns the counts of the latter, read from there.

    Both are overwritten, so a repeated run leaves the same two tables.
    """
    checked = read_checked(spark, path, schema, fmt)
    write_table(accepted(checked), out)
    write_table(rejected(checked), quarantine)
    return rejected_counts(spark.read.parquet(quarantine))
