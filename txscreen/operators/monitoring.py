"""Labels, rolling performance, drift and retraining reasons over stored predictions."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import settle
from ..functions.scalars import alert_flag, label_of
from ..plans.running import running_totals

KS_DRIFT, TVD_DRIFT = 0.2, 0.1
NUMERIC, CATEGORICAL = ("amount", "risk_score", "ml_score"), ("txn_type", "severity", "is_alert")
# fixed values: the retraining policy
POLICY = {"amount_ks_stat_threshold": 0.2, "feature_drift_ratio_threshold": 0.3, "precision_7d_min": 0.8, "recall_7d_min": 0.7, "f1_7d_min": 0.75, "label_coverage_min": 0.5, "alert_rate_change_threshold": 0.1, "minimum_labeled_rows_7d": 25.0, "require_minimum_sample_for_trigger": 1.0}


def labeled(predictions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Predictions with the label that holds: the actual one, else the review's."""
    subset = reviews.select(F.col("alert_id").alias("_a"), F.col("event_id").alias("_e"), "review_status", "review_label", "reviewed_at")
    rows = predictions.join(subset, (predictions["alert_id"] == F.col("_a")) & (predictions["event_id"] == F.col("_e")), "left").drop("_a", "_e")
    actual, review = label_of(F.col("actual_label")), label_of(F.col("review_label"))
    source = F.when(actual.isNotNull(), "actual_label").when(review.isNotNull(), "review_label").otherwise("unlabeled")
    return rows.withColumns({"predicted_positive": alert_flag(F.col("is_alert")), "effective_label": F.coalesce(actual, review), "label_source": source, "evaluation_ts": F.coalesce("reviewed_at", "event_ts")})


CONFUSION = ("labeled_rows", "tp", "fp", "tn", "fn")


def confusion(predicted: Column, label: Column) -> list[Column]:
    """Aggregates: labeled_rows, tp, fp, tn, fn."""
    hit = lambda p, v: F.count(F.when((predicted == p) & (label == v), 1))
    return [F.count(label).alias("labeled_rows"), hit(True, "fraud").alias("tp"), hit(True, "legit").alias("fp"), hit(False, "legit").alias("tn"), hit(False, "fraud").alias("fn")]


def rates(counts: DataFrame) -> DataFrame:
    """Adds precision, recall, f1 and false_positive_rate, null on a zero denominator, to 6 places."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    p, r = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    f1 = F.when(p + r > 0, F.try_divide(2 * p * r, p + r))
    return counts.withColumns({"precision": F.round(p, 6), "recall": F.round(r, 6), "f1": F.round(f1, 6), "false_positive_rate": F.round(F.try_divide(fp, fp + tn), 6)})


def binary_metrics(rows: DataFrame) -> DataFrame:
    return rates(rows.agg(*confusion(F.col("predicted_positive"), F.col("effective_label"))))


def rolling_metrics(rows: DataFrame, days: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    """binary_metrics() of the last days before the latest evaluation, the first instant included.

    One aggregate of conditional counts holds all spans; no row is repeated. A span without a row has no result.
    """
    anchor = rows.agg(F.max("evaluation_ts").alias("anchor"))
    begin = lambda n: F.col("anchor") - F.make_interval(days=F.lit(n))

    def span(n: int) -> list[Column]:
        inside = F.col("evaluation_ts") >= begin(n)
        counts = confusion(F.when(inside, F.col("predicted_positive")), F.when(inside, F.col("effective_label")))
        return [F.count_if(inside).alias(f"{n}_rows"), *[c.alias(f"{n}_{k}") for c, k in zip(counts, CONFUSION, strict=True)]]

    wide = rows.crossJoin(F.broadcast(anchor)).groupBy("anchor").agg(*[c for n in days for c in span(n)])  # one row
    each = [F.struct(F.lit(n).alias("days"), begin(n).alias("window_start"), F.col("anchor").alias("window_end"), F.col(f"{n}_rows").alias("n"), *[F.col(f"{n}_{k}").alias(k) for k in CONFUSION]) for n in days]
    return rates(wide.select(F.inline(F.array(*each))).where("n > 0").drop("n"))


def performance_summary(rows: DataFrame) -> DataFrame:
    """One row: coverage, labels by source, and warnings."""
    n, known = F.count(F.lit(1)), F.count("effective_label")
    negatives = F.count(F.when(~F.col("predicted_positive") & F.col("effective_label").isNotNull(), 1))
    done = rows.agg(n.alias("prediction_rows"), known.alias("labeled_rows"), negatives.alias("_neg"), *[F.count(F.when(F.col("label_source") == s, 1)).alias(f"from_{s}") for s in ("actual_label", "review_label", "unlabeled")])
    warn = F.array_compact(F.array(F.when(F.col("labeled_rows") == 0, "no_labels"), F.when((F.col("labeled_rows") > 0) & (F.col("_neg") == 0), "no_labeled_negatives")))
    return done.withColumn("label_coverage", F.coalesce(F.round(F.try_divide("labeled_rows", "prediction_rows"), 6), F.lit(0.0))).withColumn("warnings", warn).drop("_neg")


def numeric_summary(rows: DataFrame, columns: tuple[str, ...] = NUMERIC) -> DataFrame:
    """(feature, mean, std of the population, min, max), one job for all columns."""
    tall = rows.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    return tall.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))


def category_mix(rows: DataFrame, columns: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """(feature, category, share)."""
    tall = rows.select([F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in columns]).unpivot([], list(columns), "feature", "category")
    counts = tall.groupBy("feature", "category").count()
    total = counts.groupBy("feature").agg(F.sum("count").alias("total"))
    return counts.join(total, "feature").select("feature", "category", (F.col("count") / F.col("total")).alias("share"))


def reference_rates(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """One row: rows, the share of alerts and the share of frauds."""
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.avg(F.col("is_alert").cast("int")), F.lit(0.0)).alias("alert_rate"), F.coalesce(F.avg(F.col(label)), F.lit(0.0)).alias("label_rate"))


def reference_dataset(tx: DataFrame, n: int | None = None, order: str = "seq") -> DataFrame:
    """The first n rows of a ledger scored as if nothing had come before: the baseline of drift reports."""
    from . import decode, rules

    rows = tx.orderBy(order).limit(n) if n is not None else tx
    done = rules.score(decode.without_history(rows))
    return done.select("event_id", "step", "txn_type", "amount", "risk_score", "severity", "ml_score", "is_alert", F.col("is_fraud").alias("label_is_fraud"))


def ks_p_value(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """The asymptotic two-sided p-value: 2 sum (-1)^(k-1) exp(-2 k^2 z^2) with z = d sqrt(n m / (n + m))."""
    z = d * F.sqrt(n * m / (n + m))
    total = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda a, k: a + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * z * z))
    return F.when(z <= 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * total)))


#: Rows of the larger side up to which p-values are exact; beyond, they are asymptotic.
EXACT_ROWS = 10_000


def _ks_tail(d: float, n: int, m: int) -> float:
    """P(D >= d): of the monotone paths over an n x m lattice, the share that leaves the band |i / n - j / m| < d.

    Of the paths to the point (i, j), a share i / (i + j) comes from (i - 1, j) and the rest from (i, j - 1), so the share
    that has stayed inside is built diagonal by diagonal. All values are shares of the paths to their own point, so none
    gets too small for a double, however many rows there are; a diagonal has the points of the band only.
    """
    common = math.gcd(n, m)
    up, right = m // common, n // common
    most = round(d * n * up)
    if most <= 0:
        return 1.0
    share, low = np.ones(1), 0
    for k in range(1, n + m + 1):
        # |i up - (k - i) right| < most
        first, last = max(0, k - m, (k * right - most) // (up + right) + 1), min(n, k, -((-k * right - most) // (up + right)) - 1)
        if first > last:
            return 1.0
        i = np.arange(first, last + 1)
        known = np.zeros(last - first + 2)  # of i - 1 from first - 1 on
        a, b = max(low, first - 1), min(low + len(share), last + 1)
        known[a - first + 1 : b - first + 1] = share[a - low : b - low]
        share, low = known[:-1] * (i / k) + known[1:] * (1 - i / k), first
    return float(min(1.0, max(0.0, 1.0 - share[-1])))


def exact_ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """The exact two-sided p-value, null beyond EXACT_ROWS; for the few rows of a report."""

    def run(ds: pd.Series, ns: pd.Series, ms: pd.Series) -> pd.Series:
        return pd.Series([_ks_tail(a, int(b), int(c)) if max(b, c) <= EXACT_ROWS else None for a, b, c in zip(ds, ns, ms, strict=True)], dtype="float64")

    return F.pandas_udf(run, "double")(d, n, m)


def numeric_drift(reference: DataFrame, serving: DataFrame, columns: tuple[str, ...] = NUMERIC) -> DataFrame:
    """A row for each column: the two-sample KS statistic and its p-value, means and their difference.

    All columns go through one plan, as rows of (feature, value). Values of either side are counted
    first; the counts are settled, since the running totals read them more than once.
    """

    def side(rows: DataFrame, r: int) -> DataFrame:
        tall = rows.select([F.col(c).try_cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "v")
        return tall.where("v IS NOT NULL AND NOT isnan(v)").withColumn("r", F.lit(r)).withColumn("s", F.lit(1 - r))

    counted = settle(side(reference, 1).union(side(serving, 0)).groupBy("feature", "v").agg(F.sum("r").alias("r"), F.sum("s").alias("s")))
    totals = counted.groupBy("feature").agg(F.sum("r").alias("n"), F.sum("s").alias("m"), F.try_divide(F.sum(F.col("v") * F.col("r")), F.sum("r")).alias("mr"), F.try_divide(F.sum(F.col("v") * F.col("s")), F.sum("s")).alias("ms"))
    steps = running_totals(counted, "v", ["r", "s"], within="feature")
    # one row for each column
    gap = steps.join(F.broadcast(totals.select("feature", "n", "m")), "feature").groupBy("feature").agg(F.max(F.abs(F.col("run_r") / F.col("n") - F.col("run_s") / F.col("m"))).alias("d"))
    done = totals.join(F.broadcast(gap), "feature").where("n > 0 AND m > 0")
    sizes = F.col("d"), F.col("n").cast("double"), F.col("m").cast("double")
    p = F.when(F.greatest("n", "m") <= EXACT_ROWS, exact_ks_p_value(*sizes)).otherwise(ks_p_value(*sizes))
    return done.select(
        "feature", F.round("d", 6).alias("ks_statistic"), F.round(p, 6).alias("ks_pvalue"),
        F.round("mr", 6).alias("reference_mean"), F.round("ms", 6).alias("serving_mean"), F.round(F.col("ms") - F.col("mr"), 6).alias("mean_delta"), (F.col("d") >= KS_DRIFT).alias("drift_detected"),
    )


def category_distributions(reference: DataFrame, serving: DataFrame, columns: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """(feature, category, reference, serving); categories of one side only have share 0 on the other."""
    r, s = category_mix(reference, columns).withColumnRenamed("share", "reference"), category_mix(serving, columns).withColumnRenamed("share", "serving")
    return r.join(s, ["feature", "category"], "fullouter").na.fill(0.0, ["reference", "serving"])


def categorical_drift(reference: DataFrame, serving: DataFrame, columns: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """(feature, total_variation_distance, drift_detected)."""
    d = category_distributions(reference, serving, columns).groupBy("feature").agg((0.5 * F.sum(F.abs(F.col("reference") - F.col("serving")))).alias("d"))
    return d.select("feature", F.round("d", 6).alias("total_variation_distance"), (F.col("d") >= TVD_DRIFT).alias("drift_detected"))


def drift_table(reference: DataFrame, serving: DataFrame) -> DataFrame:
    """A row for each monitored feature: metric, observed value, whether it drifts."""
    numeric = numeric_drift(reference, serving)
    rows = numeric.select("feature", F.lit("ks_statistic").alias("metric"), F.coalesce("ks_statistic", "mean_delta").alias("observed"), "drift_detected")
    return rows.unionByName(categorical_drift(reference, serving).select("feature", F.lit("total_variation_distance").alias("metric"), F.col("total_variation_distance").alias("observed"), "drift_detected"))


def retraining_observations(drift: DataFrame, alert_shares: DataFrame, coverage: DataFrame, week: DataFrame) -> DataFrame:
    """(type, observed): what the policy looks at. alert_shares: (reference, serving); coverage: (label_coverage); week: one row of rolling_metrics()."""
    d = drift.agg(F.try_divide(F.count_if("drift_detected"), F.greatest(F.count(F.lit(1)), F.lit(1))).alias("drift_ratio"), F.max(F.when((F.col("feature") == "amount") & (F.col("metric") == "ks_statistic"), F.col("observed"))).alias("amount_drift"))
    a = alert_shares.agg(F.abs(F.coalesce(F.max("serving"), F.lit(0.0)) - F.coalesce(F.max("reference"), F.lit(0.0))).alias("alert_rate_change"))
    c = coverage.agg(F.coalesce(F.max("label_coverage"), F.lit(0.0)).alias("label_coverage"))
    w = week.agg(F.max("precision").alias("precision_7d"), F.max("recall").alias("recall_7d"), F.max("f1").alias("f1_7d"), F.coalesce(F.max("labeled_rows"), F.lit(0)).cast("double").alias("rows_7d"))
    one = reduce(lambda x, y: x.crossJoin(F.broadcast(y)), (d, a, c, w))  # one row each
    return one.unpivot(["rows_7d"], ["drift_ratio", "amount_drift", "alert_rate_change", "label_coverage", "precision_7d", "recall_7d", "f1_7d"], "type", "observed")


def retraining_reasons(spark: SparkSession, observations: DataFrame, policy: dict[str, float] = POLICY) -> DataFrame:
    """(type, observed, threshold) of the checks that ask for retraining."""
    checks = [("drift_ratio", "feature_drift_ratio_threshold", ">="), ("amount_drift", "amount_ks_stat_threshold", ">="), ("alert_rate_change", "alert_rate_change_threshold", ">="), ("label_coverage", "label_coverage_min", "<"), ("precision_7d", "precision_7d_min", "<"), ("recall_7d", "recall_7d_min", "<"), ("f1_7d", "f1_7d_min", "<")]
    rules = spark.createDataFrame([(t, float(policy[p]), op, t.endswith("_7d")) for t, p, op in checks], "type string, threshold double, op string, sampled boolean")
    enough = ~F.col("sampled") | F.lit(not policy["require_minimum_sample_for_trigger"]) | (F.col("rows_7d") >= policy["minimum_labeled_rows_7d"])
    fails = F.when(F.col("op") == ">=", F.col("observed") >= F.col("threshold")).otherwise(F.col("observed") < F.col("threshold"))
    return observations.join(F.broadcast(rules), "type").where(F.col("observed").isNotNull() & enough & fails).select("type", F.round("observed", 6).alias("observed"), "threshold")  # seven rows


def retraining_decision(reasons: DataFrame) -> DataFrame:
    """One row: retrain_required, reason_count and the reasons in order of their type."""
    return reasons.agg((F.count(F.lit(1)) > 0).alias("retrain_required"), F.count(F.lit(1)).alias("reason_count"), F.sort_array(F.collect_list(F.struct("type", "observed", "threshold"))).alias("reasons"))
