"""The analyst's view: alerts with reviews, queues, and counts over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import primary_rule


def with_reviews(alerts: DataFrame, reviews: DataFrame) -> DataFrame:
    """Alerts with the status, label, reviewer and notes of their review, or new, unlabeled and blanks."""
    r = reviews.select(F.col("alert_id").alias("_a"), *[F.col(c).alias(f"_{c}") for c in ("review_status", "review_label", "reviewer", "notes")])
    rows = alerts.join(r, alerts["alert_id"] == F.col("_a"), "left")
    default = {"review_status": "new", "review_label": "unlabeled", "reviewer": "", "notes": ""}
    rows = rows.withColumns({c: F.coalesce(f"_{c}", F.lit(v)) for c, v in default.items()}).drop("_a", *[f"_{c}" for c in default])
    return rows.withColumn("primary_rule", primary_rule(F.col("triggered_rules")))


def unreviewed(queue: DataFrame) -> DataFrame:
    return queue.where("review_status = 'new'")


def review_queue(queue: DataFrame, statuses: tuple[str, ...] = (), severities: tuple[str, ...] = (), labels: tuple[str, ...] = ()) -> DataFrame:
    """Filtered by what is given, severity ascending, then risk and time descending."""
    for column, values in (("review_status", statuses), ("severity", severities), ("review_label", labels)):
        if values:
            queue = queue.where(F.col(column).isin(*values))
    return queue.orderBy("severity", F.desc("risk_score"), F.desc("event_ts"), "alert_id")


def newest(alerts: DataFrame, n: int, severities: tuple[str, ...] = ()) -> DataFrame:
    rows = alerts.where(F.col("severity").isin(*severities)) if severities else alerts
    return rows.orderBy(F.desc("event_ts"), "alert_id").limit(n)


def recent_cases(queue: DataFrame, selected: str, n: int = 100) -> DataFrame:
    return newest(queue, n).withColumn("selected", F.col("alert_id") == selected)


def hot_alerts(alerts: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return alerts.where(F.col("event_ts") >= now - F.make_interval(hours=F.lit(hours)))


def alert_kpis(alerts: DataFrame) -> DataFrame:
    high = F.count_if(F.col("severity") == "high")
    return alerts.agg(F.count(F.lit(1)).alias("total_alerts"), high.alias("high_alerts"), F.coalesce(F.try_divide(high, F.count(F.lit(1))), F.lit(0.0)).alias("high_share"), F.coalesce(F.avg("risk_score"), F.lit(0.0)).alias("mean_risk"), F.coalesce(F.sum("amount"), F.lit(0.0)).alias("at_risk_amount"))


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    rows = alerts.select(F.explode_outer(F.when(F.size("triggered_rules") > 0, F.col("triggered_rules"))).alias("rule"), "amount")
    return rows.groupBy(F.coalesce("rule", F.lit("ml_only")).alias("rule")).agg(F.count(F.lit(1)).alias("alerts"), F.sum("amount").alias("amount"))


def top_rules(alerts: DataFrame, n: int = 10) -> DataFrame:
    return alerts_by_rule(alerts).orderBy(F.desc("alerts"), F.desc("amount"), "rule").limit(n)


def mix(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("alerts"), F.sum("amount").alias("amount"))


def queue_kpis(queue: DataFrame) -> DataFrame:
    status, label = F.col("review_status"), F.col("review_label")
    return queue.agg(
        F.count_if(status.isin("new", "in_review")).alias("open"), F.count_if(label == "confirmed_fraud").alias("confirmed"), F.count_if(label == "false_positive").alias("false_positive"),
        F.count_if(status == "escalated").alias("escalated"), F.count_if(status == "new").alias("new"),
    )


def status_label(severity: Column) -> Column:
    return F.when(severity == "high", "critical").when(severity == "medium", "warning").otherwise("info")


def long_metrics(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, metric, value): a wide table of numbers as a long one."""
    return rows.select(*keys, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(keys, values, "metric", "value")
