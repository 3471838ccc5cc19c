"""Window metrics over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: What a window measures.
MEASURES = {"event_count": F.count, "fraud_count": F.sum, "total_amount": F.sum}


def window_metrics(rows: DataFrame, kind: str, size: str, slide: str | None = None, time: str = "event_time") -> DataFrame:
    """Counts, frauds, amount and fraud rate for each window; the same plan for a batch and a stream."""
    inputs = {"event_count": F.lit(1), "fraud_count": F.col("is_fraud").cast("long"), "total_amount": F.col("amount")}
    measured = [f(inputs[name]).alias(name) for name, f in MEASURES.items()]
    bounds = [F.col(f"window.{side}").alias(f"window_{side}") for side in ("start", "end")]
    rate = F.coalesce(F.try_divide("fraud_count", "event_count"), F.lit(0.0)).alias("fraud_rate")
    return rows.groupBy(F.window(time, size, slide or size)).agg(*measured).select(F.lit(kind).alias("window_type"), *bounds, *MEASURES, rate)


def tumbling(rows: DataFrame, seconds: int = 300) -> DataFrame:
    return window_metrics(rows, "tumbling", f"{seconds} seconds")


def sliding(rows: DataFrame, seconds: int = 600, slide: int = 300) -> DataFrame:
    """Sliding windows from the slide of the first event on; earlier ones that overlap it are left out."""
    first = rows.agg(F.min("event_time").alias("first"))
    done = window_metrics(rows, "sliding", f"{seconds} seconds", f"{slide} seconds")
    floor = F.timestamp_seconds(F.floor(F.unix_timestamp("first") / slide) * slide)
    return done.crossJoin(F.broadcast(first)).where(F.col("window_start") >= floor).drop("first")  # one row


def payloads(metrics: DataFrame) -> DataFrame:
    key = F.concat_ws(":", "window_type", F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss"))
    return metrics.select(key.alias("key"), F.to_json(F.struct(*metrics.columns)).alias("value"))
