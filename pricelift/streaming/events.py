"""Order events: source, text format, windows.  The same functions serve batch and stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schemas import ORDER_EVENT

VALUE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def stream_source(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Streaming rows with a ``value`` column.  Kafka starts at the latest offset unless told
    otherwise, and stops when events have aged out of the topic; ``failOnDataLoss="false"`` goes
    on without them.  File formats take a folder."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.options(**{"startingOffsets": "latest", "failOnDataLoss": "true"})
    else:
        reader = reader.schema(VALUE_SCHEMA)
    reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def replay_events(holdout: DataFrame, sent_at: dt.datetime | Column | None = None) -> DataFrame:
    """Held-out rows as (key, value) JSON order events, ready for any sink.

    ``sent_at`` is the event time; by default the moment of the query.
    """
    def either(*names: str, default: Column) -> Column:
        present = [F.col(n) for n in names if n in holdout.columns]
        return F.coalesce(*present, default)

    if sent_at is None:
        sent = F.current_timestamp()
    else:
        sent = sent_at if isinstance(sent_at, Column) else F.lit(sent_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    event = F.struct(
        F.lit("order").alias("event_type"),
        either("transaction_id", default=F.unix_timestamp(sent)).cast("long").alias("transaction_id"),
        F.col("product_id").cast("long").alias("product_id"),
        either("product_name", default=F.lit("Unknown")).alias("product_name"),
        either("units_sold", "total_units_sold", default=F.lit(1)).cast("long").alias("units_sold"),
        F.col("current_price").cast("double").alias("current_price"),
        either("inventory_ratio", default=F.lit(1.0)).cast("double").alias("inventory_ratio"),
        F.date_format(sent, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )
    return holdout.select(
        F.col("product_id").cast("string").alias("key"), F.to_json(event).alias("value")
    )


def parse_events(raw: DataFrame, schema: T.StructType = ORDER_EVENT) -> DataFrame:
    """JSON text or bytes to typed events.  Broken JSON, a missing product or an unreadable
    time drops the event."""
    fields = F.from_json(F.col("value").cast("string"), schema)
    data = raw.select(fields.alias("data")).select("data.*").filter(F.col("product_id").isNotNull())
    return data.withColumn("event_time", F.try_to_timestamp("timestamp")).filter(
        F.col("event_time").isNotNull()
    )


def tumbling_demand(
    events: DataFrame, width: str = "10 seconds", watermark: str | None = None
) -> DataFrame:
    """Units, mean price, mean inventory and order count per window and product.

    The aggregate combines before the shuffle, so a product with most of the events
    sends one row per task and window.
    """
    timed = events.withWatermark("event_time", watermark) if watermark else events
    return timed.groupBy(F.window("event_time", width), "product_id").agg(
        F.sum("units_sold").alias("window_units"),
        F.avg("current_price").alias("avg_price"),
        F.avg("inventory_ratio").alias("avg_inventory"),
        F.count(F.lit(1)).alias("orders"),
    )


def flat_window(windows: DataFrame) -> DataFrame:
    rest = [c for c in windows.columns if c != "window"]
    return windows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )
