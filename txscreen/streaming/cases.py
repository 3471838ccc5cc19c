"""Controlled inputs: triplets that fit, lack a side, contradict, or have no transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: (case, which sides it has, the dead letter that it leaves).
CASES = (
    ("clean_integration", "tsr", None),
    ("missing_sender_state", "tr", "missing_sender_state"),
    ("missing_receiver_state", "ts", "missing_receiver_state"),
    ("semantic_mismatch", "tsr", "semantic_key_mismatch"),
    ("orphan_sender_state", "s", "orphan_sender_state"),
    ("orphan_receiver_state", "r", "orphan_receiver_state"),
)
#: Minutes after the cases at which filler rows move the watermark on.
FILLERS = (60, 120, 180)


def events(spark: SparkSession, run: str) -> DataFrame:
    """(case, sides, error, event_id, step): the cases and the fillers."""
    rows = [(n, sides, error, f"{run}-{n}", 10) for n, sides, error in CASES] + [(f"filler_{m}", "tsr", None, f"{run}-filler-{m}", 10 + m) for m in FILLERS]
    return spark.createDataFrame(rows, "case STRING, sides STRING, error STRING, event_id STRING, step INT")


def expected(spark: SparkSession, run: str) -> DataFrame:
    """(case, source_key, error) of the dead letters to come."""
    rows = events(spark, run).where("error IS NOT NULL")
    key = F.when(F.col("sides") == "s", F.concat("event_id", F.lit(":sender"))).when(F.col("sides") == "r", F.concat("event_id", F.lit(":receiver"))).otherwise(F.col("event_id"))
    return rows.select("case", key.alias("source_key"), "error")


def feeds(spark: SparkSession, run: str, base_epoch: int = 1_767_225_600) -> dict[str, DataFrame]:
    """The three feeds as envelopes."""
    rows = events(spark, run)
    when = F.date_format(F.timestamp_seconds(F.lit(base_epoch) + F.col("step") * 60), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    source = F.when(F.col("sides").isin("s", "r"), F.concat("event_id", F.lit("-missing"))).otherwise(F.col("event_id"))
    dest = F.when(F.col("case") == "semantic_mismatch", "C2-MISMATCH").otherwise("C2")
    made = {
        "transactions": ("t", F.struct("event_id", when.alias("event_time"), when.alias("producer_ts"), "step", F.lit("TRANSFER").alias("type"), F.lit(1000.0).alias("amount"), F.lit("C1").alias("nameOrig"), F.lit("C2").alias("nameDest"), F.lit(0).alias("isFraud"), F.lit(1).alias("schema_version"))),
        "sender_state": ("s", F.struct(F.concat("event_id", F.lit(":sender")).alias("event_id"), source.alias("source_event_id"), when.alias("event_time"), "step", F.lit("C1").alias("nameOrig"), F.lit(5000.0).alias("oldbalanceOrg"), F.lit(4000.0).alias("newbalanceOrig"))),
        "receiver_state": ("r", F.struct(F.concat("event_id", F.lit(":receiver")).alias("event_id"), source.alias("source_event_id"), when.alias("event_time"), "step", dest.alias("nameDest"), F.lit(0.0).alias("oldbalanceDest"), F.lit(1000.0).alias("newbalanceDest"))),
    }
    return {n: rows.where(F.contains("sides", F.lit(side))).select(F.col("event_id").alias("kafka_key"), F.to_json(body).alias("raw_value"), F.current_timestamp().alias("kafka_timestamp"), F.lit(0).alias("partition"), F.col("step").cast("long").alias("offset"), F.lit(n).alias("source_topic")) for n, (side, body) in made.items()}
