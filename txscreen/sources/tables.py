"""Batch sources: the transaction ledger, logical CSV feeds, stored day partitions."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ScreenConfig

LEDGER_DDL = "step STRING, type STRING, amount STRING, nameOrig STRING, oldbalanceOrg STRING, newbalanceOrig STRING, nameDest STRING, oldbalanceDest STRING, newbalanceDest STRING, isFraud STRING, corrupt STRING"
FEEDS = {
    "transactions": "event_id STRING, event_time STRING, producer_ts STRING, step INT, type STRING, amount DOUBLE, nameOrig STRING, nameDest STRING, isFraud INT, schema_version INT",
    "sender_state": "event_id STRING, source_event_id STRING, event_time STRING, step INT, nameOrig STRING, oldbalanceOrg DOUBLE, newbalanceOrig DOUBLE",
    "receiver_state": "event_id STRING, source_event_id STRING, event_time STRING, step INT, nameDest STRING, oldbalanceDest DOUBLE, newbalanceDest DOUBLE",
}


def read_ledger_csv(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """The raw ledger as text columns: ids hash the text, so it is typed later. Broken lines keep their text in `corrupt`."""
    rows = spark.read.schema(LEDGER_DDL).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="corrupt").csv(path)
    return rows.limit(limit) if limit is not None else rows


def read_feed_csv(spark: SparkSession, path: str, feed: str) -> DataFrame:
    return spark.read.schema(FEEDS[feed]).option("header", True).csv(path)


PREDICTIONS_DDL = "event_ts TIMESTAMP, event_id STRING, account_id STRING, name_dest STRING, txn_type STRING, amount DOUBLE, risk_score DOUBLE, severity STRING, ml_score DOUBLE, ml_model_version STRING, is_alert STRING, alert_id STRING, actual_label STRING"
REVIEWS_DDL = "alert_id STRING, event_id STRING, review_status STRING, review_label STRING, reviewer STRING, notes STRING, reviewed_at TIMESTAMP"
REFERENCE_DDL = "event_id STRING, step INT, txn_type STRING, amount DOUBLE, risk_score DOUBLE, severity STRING, ml_score DOUBLE, is_alert BOOLEAN, label_is_fraud INT"


def read_report_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report's input with one of the schemas above."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All of a topic so far, in the columns of an envelope."""
    rows = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("endingOffsets", "latest").load()
    return rows.select(F.col("key").cast("string").alias("kafka_key"), F.col("value").cast("string").alias("raw_value"), F.col("timestamp").alias("kafka_timestamp"), "partition", "offset", F.lit(topic).alias("source_topic"))


def event_time(step: Column, cfg: ScreenConfig = ScreenConfig()) -> Column:
    return F.timestamp_seconds(F.lit(cfg.base_epoch) + step.cast("long") * cfg.step_seconds)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger(spark: SparkSession, sf_dir: str, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """The `events` table as transactions; seq breaks ties of the same instant, t is event time in seconds."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    kind = F.create_map(*[F.lit(x) for p in (("purchase", "TRANSFER"), ("click", "CASH_OUT"), ("signup", "CASH_IN"), ("view", "PAYMENT"), ("error", "DEBIT")) for x in p])
    amount, old = F.round(F.col("value") * 1000, 2), (i * 7919 % 300) * 1000.0
    rows = e.select(
        i, i.alias("seq"), F.floor(i / 60).cast("int").alias("step"), F.try_element_at(kind, F.col("event_type")).alias("txn_type"), amount.alias("amount"),
        F.concat(F.lit("C"), (F.col("user_id") % 200).cast("string")).alias("name_orig"),
        F.when(i % 5 == 0, F.concat(F.lit("M"), (i % 50).cast("string"))).otherwise(F.concat(F.lit("C"), ((F.col("user_id") * 7 + i) % 200).cast("string"))).alias("name_dest"),
        old.alias("oldbalance_org"), ((i * 104729 % 200) * 1000.0).alias("oldbalance_dest"),
    )
    rows = rows.withColumn("newbalance_org", F.when(F.col("txn_type") == "CASH_IN", F.col("oldbalance_org") + F.col("amount")).otherwise(F.greatest(F.col("oldbalance_org") - F.col("amount"), F.lit(0.0))))
    rows = rows.withColumn("newbalance_dest", F.when(i % 11 == 0, F.col("oldbalance_dest")).otherwise(F.col("oldbalance_dest") + F.col("amount")))
    rows = rows.withColumn("is_fraud", (F.col("txn_type").isin("TRANSFER", "CASH_OUT") & (i % 17 == 0)).cast("int"))
    t = F.lit(cfg.base_epoch) + F.col("step").cast("long") * cfg.step_seconds
    return rows.withColumn("t", t).withColumn("event_time", F.timestamp_seconds("t")).withColumn("schema_version", F.lit(1))


def recent_days(stored: DataFrame, days: int, per_day: int | None = None, lookback: int = 400, day: str = "day_bucket", newest: str = "event_ts", key: str = "event_id") -> DataFrame:
    """The latest `days` day partitions of a stored table, at most `lookback` days back from the latest, with the newest `per_day` rows of each."""
    latest = stored.select(F.max(day).alias("latest"))
    # one row for each of a few days
    chosen = stored.select(day).distinct().crossJoin(F.broadcast(latest)).where(F.datediff("latest", day) <= lookback).orderBy(F.desc(day)).limit(days).select(day)
    rows = stored.join(F.broadcast(chosen), day, "left_semi")
    return rows if per_day is None else newest_of_each_day(rows, per_day, day, newest, key)


def stored_days(spark: SparkSession, path: str, day: str = "day_bucket") -> list[str]:
    """The days of a stored table, newest first, from the names of its folders: no row is read."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = set()
    for pattern in (f"{path}/{day}=*", f"{path}/batch=*/{day}=*"):
        found |= {x.getPath().getName().removeprefix(f"{day}=") for x in files.globStatus(place(pattern)) or []}
    return sorted((d for d in found if re.fullmatch(r"\d{4}-\d{2}-\d{2}", d)), reverse=True)


def read_recent_days(spark: SparkSession, path: str, days: int, per_day: int | None = None, lookback: int = 400, day: str = "day_bucket", newest: str = "event_ts", key: str = "event_id") -> DataFrame | None:
    """recent_days() of a stored table, which reads the files of the chosen days only; None without a day."""
    found = stored_days(spark, path, day)
    if not found:
        return None
    least = (date.fromisoformat(found[0]) - timedelta(days=lookback)).isoformat()
    chosen = [d for d in found if d >= least][:days]
    rows = spark.read.parquet(path).where(F.col(day).isin([date.fromisoformat(d) for d in chosen]))
    return rows if per_day is None else newest_of_each_day(rows, per_day, day, newest, key)


def newest_of_each_day(rows: DataFrame, per_day: int, day: str = "day_bucket", newest: str = "event_ts", key: str = "event_id") -> DataFrame:
    order = Window.partitionBy(day).orderBy(F.desc(newest), key)
    return rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_day).drop("_r")


def latest_reviews(log: DataFrame) -> DataFrame:
    """An append-only review log as one row for each alert, the last review."""
    order = Window.partitionBy("alert_id").orderBy(F.desc("reviewed_at"), F.desc("review_label"))
    return log.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")
