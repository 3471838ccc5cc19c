"""Latency, resource and load reports, and synthetic load, as Spark jobs over event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import load_family, trigger_label
from ..plans.running import running_totals

QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def latency_summary(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """(by, min, mean, p50, p95, p99, max) with linear interpolation; zeros over no values.

    Quantiles come from running totals over counted values, so no group's values are held in one task.
    """
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("_none"))
    rows = rows.select(*by, key.alias("_k"), F.col(value).cast("double").alias("_v"))
    v = F.col("_v")
    sums = rows.groupBy("_k", *by).agg(F.min(v).alias("min"), F.avg(v).alias("mean"), F.max(v).alias("max")) if by else rows.agg(F.min(v).alias("min"), F.avg(v).alias("mean"), F.max(v).alias("max")).withColumn("_k", key)
    steps = running_totals(rows.where("_v IS NOT NULL").groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("n")), "_v", ["n"], within="_k")
    sizes = steps.groupBy("_k").agg(F.max("run_n").alias("_all"))
    placed = steps.join(sizes, "_k")
    at = lambda q, side: F.min(F.when(F.col("run_n") > side(q * (F.col("_all") - 1)), v))
    ends = placed.groupBy("_k").agg(F.max("_all").alias("_all"), *[at(q, f).alias(f"_{n}_{i}") for n, q in QUANTILES.items() for i, f in enumerate((F.floor, F.ceil))])
    part = lambda q: q * (F.col("_all") - 1) - F.floor(q * (F.col("_all") - 1))
    quantiles = ends.select("_k", *[(F.col(f"_{n}_0") + part(q) * (F.col(f"_{n}_1") - F.col(f"_{n}_0"))).alias(n) for n, q in QUANTILES.items()])
    done = sums.join(quantiles, "_k", "left").select(*by, "min", "mean", *QUANTILES, "max")
    return done.na.fill(0.0, ["min", "mean", *QUANTILES, "max"])


def ms_between(begin: str, end: str) -> Column:
    return (F.unix_micros(end) - F.unix_micros(begin)) / 1000.0


def stage_latencies(published: DataFrame, timings: DataFrame, timeout_s: int = 120) -> DataFrame:
    """published (run, profile, event_id, published_at) with timings (run, event_id, spark_seen_at, persisted_at): a row each, with times in ms and timed_out."""
    t = timings.select(F.col("run").alias("_r"), F.col("event_id").alias("_e"), "spark_seen_at", "persisted_at")
    rows = published.join(t, (published["run"] == F.col("_r")) & (published["event_id"] == F.col("_e")), "left").drop("_r", "_e")
    late = F.coalesce(ms_between("published_at", "persisted_at") > timeout_s * 1000.0, F.lit(True))
    return rows.withColumns({"to_spark_ms": ms_between("published_at", "spark_seen_at"), "to_store_ms": ms_between("spark_seen_at", "persisted_at"), "total_ms": ms_between("published_at", "persisted_at"), "timed_out": late})


def profile_summary(rows: DataFrame) -> DataFrame:
    """(profile, events, succeeded, timed_out, success_rate) of stage_latencies()."""
    n, ok = F.count(F.lit(1)), F.count_if(~F.col("timed_out"))
    return rows.groupBy("profile").agg(n.alias("events"), ok.alias("succeeded"), F.count_if("timed_out").alias("timed_out"), (ok / n).alias("success_rate"))


def resource_summary(samples: DataFrame) -> DataFrame:
    """(name, samples, averages, maxima, and what counters grew by from first to last, 0 at least)."""
    grew = lambda c: F.greatest(F.lit(0.0), F.max_by(c, "captured_at") - F.min_by(c, "captured_at"))
    return samples.groupBy("name").agg(
        F.count(F.lit(1)).alias("samples"), F.avg("cpu_percent").alias("cpu_avg"), F.max("cpu_percent").alias("cpu_max"), F.avg("memory_used_bytes").alias("memory_avg"), F.max("memory_used_bytes").alias("memory_max"),
        grew("network_rx_bytes").alias("network_rx"), grew("network_tx_bytes").alias("network_tx"), grew("block_read_bytes").alias("block_read"), grew("block_write_bytes").alias("block_write"),
    )


def comparison(points: DataFrame, rates: list[int]) -> DataFrame:
    """points (file_name, rate, p95): the p95 of each trigger and family by rate."""
    rows = points.select(trigger_label(F.col("file_name")).alias("trigger"), load_family(F.col("file_name")).alias("family"), "rate", "p95")
    return rows.groupBy("trigger", "family").pivot("rate", rates).agg(F.first("p95"))


def amplify(seed: DataFrame, n: int, order: str = "seq", per_task: int = 1 << 16) -> DataFrame:
    """n events from a ledger: the seed over and over, each with a new id, a later time and suffixed names.

    The seed is numbered in its order: counts of ranges of `order` first, then each range by itself.
    """
    rows = seed.withColumn("_b", F.floor(F.col(order) / per_task))
    sizes = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    m = seed.count()
    if not m:
        return seed.limit(0)
    base = sizes.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    numbered = rows.join(base, "_b").withColumn("_i", F.col("_base") + F.row_number().over(Window.partitionBy("_b").orderBy(order)) - 1).drop("_b", "_base")
    return cloned(seed.sparkSession, numbered, n, m)


def cloned(spark: SparkSession, numbered: DataFrame, n: int, m: int) -> DataFrame:
    """numbered: a seed of m rows with `_i` from 0 to m - 1."""
    slots = spark.range(n).select(F.col("id").alias("_k"), (F.col("id") % m).alias("_i"), F.floor(F.col("id") / m).cast("int").alias("_o"))
    rows = slots.join(numbered, "_i")
    name = lambda c: F.concat(c, F.lit("_"), (F.col("_k") % 1000).cast("string"))
    new_id = F.sha1(F.concat_ws(":", F.col("event_id").cast("string"), F.col("_k").cast("string"), F.col("_o").cast("string"), F.col("_k").cast("string")))
    return rows.withColumns({"event_id": new_id, "step": F.col("step") + F.col("_o"), "event_time": F.timestamp_seconds(F.unix_seconds("event_time") + F.col("_k")), "t": F.unix_seconds("event_time") + F.col("_k"), "seq": F.col("_k"), "name_orig": name("name_orig"), "name_dest": name("name_dest")}).drop("_i", "_o", "_k")


def smoke_summary(scored: DataFrame, windows: DataFrame, alerts: int = 10, first: int = 5) -> DataFrame:
    """One row: how many events and alerts, the first alerts and the first windows."""
    counts = scored.agg(F.count(F.lit(1)).alias("events"), F.count_if("is_alert").alias("alerts"))
    some = scored.where("is_alert").orderBy("t", "seq").limit(alerts).agg(F.array_sort(F.collect_list(F.struct("t", "seq", "event_id", "risk_score", "severity"))).alias("first_alerts"))
    early = windows.orderBy("window_start").limit(first).agg(F.array_sort(F.collect_list(F.struct("window_start", "event_count", "fraud_count"))).alias("first_windows"))
    return counts.crossJoin(F.broadcast(some)).crossJoin(F.broadcast(early))  # one row each


def load_rows(spark: SparkSession, n: int) -> DataFrame:
    """n transfers of one shape for load tests."""
    i = F.col("id")
    return spark.range(n).select(F.concat(F.lit("load-"), i.cast("string")).alias("event_id"), i.alias("seq"), (i % 1440).cast("int").alias("step"), F.lit("TRANSFER").alias("txn_type"), F.lit(1000.0).alias("amount"), F.concat(F.lit("C"), (i % 10_000).cast("string")).alias("name_orig"), F.concat(F.lit("C"), ((i + 1) % 10_000).cast("string")).alias("name_dest"))
