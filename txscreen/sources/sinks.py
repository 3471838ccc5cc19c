"""Stored tables, topics and reports as Spark writes. A batch of a stream replaces its own output if it is run again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import exists
from ..operators.decode import account_states, alert_payloads, predictions, wire_feeds

#: The tables and what they are partitioned by.
LAYOUT = {
    "transactions_by_day": ("day_bucket",), "model_predictions_by_day": ("day_bucket",), "alerts_by_account": ("alert_date",), "account_state_by_account": ("day_bucket",), "metrics_by_window": ("window_type", "window_bucket"),
    "processed_stream_batches": ("query_name",), "benchmark_stage_timings_by_run": ("benchmark_run_id",), "alert_reviews": (), "published_alerts": ("run_id",),
}


def own_folder(path: str, batch: str | None) -> str:
    """A folder of a write's own: concurrent writes into one folder delete each other's files. A batch has the same one each time."""
    return f"{path}/batch={batch if batch is not None else uuid.uuid4().hex}"


def write_table(rows: DataFrame, root: str, name: str, batch: str | None = None) -> None:
    """Adds rows in a folder of their own; with a batch name they replace what that batch wrote before."""
    rows.write.mode("overwrite").partitionBy(*LAYOUT.get(name, ())).parquet(own_folder(f"{root}/{name}", batch))


def transactions(scored: DataFrame) -> DataFrame:
    return scored.select(F.to_date("event_time").alias("day_bucket"), F.col("event_time").alias("event_ts"), F.col("event_id").cast("string").alias("event_id"), "txn_type", "amount", "name_orig", "name_dest", "oldbalance_org", "newbalance_org", "oldbalance_dest", "newbalance_dest", "is_fraud", "risk_score")


def alerts(scored: DataFrame) -> DataFrame:
    p = predictions(scored).where("is_alert")
    return p.select("account_id", F.col("day_bucket").alias("alert_date"), F.col("event_ts").alias("alert_ts"), "alert_id", "event_id", "name_dest", "txn_type", "amount", "risk_score", "severity", "ml_score", "triggered_rules")


def write_scored(scored: DataFrame, root: str, batch: str | None = None, version: str = "rules") -> None:
    """The four tables of a scored batch. Persist `scored` before: every table reads it."""
    write_table(transactions(scored), root, "transactions_by_day", batch)
    write_table(predictions(scored, version), root, "model_predictions_by_day", batch)
    write_table(alerts(scored), root, "alerts_by_account", batch)
    states = account_states(scored).withColumn("day_bucket", F.to_date("event_time"))
    write_table(states, root, "account_state_by_account", batch)


def write_metrics(metrics: DataFrame, root: str, batch: str | None = None) -> None:
    write_table(metrics.withColumn("window_bucket", F.to_date("window_start")), root, "metrics_by_window", batch)


def write_feeds(tx: DataFrame, out: str, form: str = "csv") -> dict[str, int]:
    """The ledger as three feeds under `out`; how many rows each has, counted in what was written.

    An Observation would spare the second read, but a session that has used one can't ship Spark ML
    models with a training summary to its tasks any more (its observation manager isn't serializable).
    """
    counts = {}
    for name, rows in wire_feeds(tx).items():
        rows.write.mode("overwrite").option("header", True).format(form).save(f"{out}/{name}")
        counts[name] = tx.sparkSession.read.option("header", True).schema(rows.schema).format(form).load(f"{out}/{name}").count()
    return counts


def publish(rows: DataFrame, servers: str | None = None, path: str | None = None, batch: str | None = None) -> None:
    """(key, value, topic) to a broker, or to a folder of JSON files in its place, where a batch replaces what it wrote before."""
    if servers:
        rows.write.format("kafka").option("kafka.bootstrap.servers", servers).options(**{"kafka.acks": "all", "kafka.enable.idempotence": "true"}).save()
    else:
        rows.write.mode("overwrite").partitionBy("topic").json(own_folder(path, batch))


def unpublished(alerts_: DataFrame, published: DataFrame) -> DataFrame:
    """Alerts of (run_id, event_id) that aren't published yet, each once."""
    return alerts_.dropDuplicates(["run_id", "event_id"]).join(published.select("run_id", "event_id"), ["run_id", "event_id"], "left_anti")


def once_within(alerts_: DataFrame, at: str, hours: int = 24) -> DataFrame:
    """A stream of alerts of (run_id, event_id) without those that came in the `hours` before by the time `at`.

    Spark keeps a key until the watermark passes its time plus the watermark's delay, and the watermark is the latest
    time less the delay: with half the hours as the delay a key goes when `hours` have passed. The keys are in the
    stream's state store; with RocksDB a batch touches those of its own rows only.
    """
    return alerts_.withWatermark(at, f"{hours * 30} minutes").dropDuplicatesWithinWatermark(["run_id", "event_id"])


def stage_timings(rows: DataFrame, seen_at, persisted_at) -> DataFrame:
    from ..functions.scalars import run_id

    run = run_id(F.col("event_id").cast("string"))
    return rows.where(run.isNotNull()).select(run.alias("benchmark_run_id"), "event_id", seen_at.alias("spark_seen_at"), persisted_at.alias("persisted_at"))


def write_report(one_row: DataFrame, path: str) -> None:
    one_row.coalesce(1).write.mode("overwrite").json(path)


#: Columns that exports show with two decimals.
MONEY = ("amount", "oldbalance_org", "newbalance_org", "oldbalance_dest", "newbalance_dest")
#: The ledger's columns as the CSV has them.
LEDGER_NAMES = {"step": "step", "txn_type": "type", "amount": "amount", "name_orig": "nameOrig", "oldbalance_org": "oldbalanceOrg", "newbalance_org": "newbalanceOrig", "name_dest": "nameDest", "oldbalance_dest": "oldbalanceDest", "newbalance_dest": "newbalanceDest", "is_fraud": "isFraud"}


def export_test_set(rows: DataFrame, path: str) -> None:
    """All rows of a test split as a ledger CSV, written by as many tasks as the rows have partitions."""
    money = {c: F.format_string("%.2f", F.col(c)) for c in MONEY}
    rows.withColumns(money).select(*[F.col(c).alias(n) for c, n in LEDGER_NAMES.items()]).write.mode("overwrite").option("header", True).csv(path)


def export_features(rows: DataFrame, names: list[str], path: str, limit: int = 20_000) -> None:
    """The first rows in time order; amounts and balances with two decimals."""
    money = {c: F.format_string("%.2f", F.col(c)) for c in MONEY if c in names}
    rows.orderBy("t", "seq").limit(limit).withColumns(money).select(*names).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
