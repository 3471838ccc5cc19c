"""The registered queries of the screening library, over the ledger that the `events` table stands for."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TYPES, ScreenConfig
from ..durable import keep, remove, settle
from ..functions import scalars as S
from ..operators import decode as D
from ..operators import history as H
from ..operators import integrate as J
from ..operators import metrics as M
from ..operators import monitoring as N
from ..operators import reports as P
from ..operators import review as V
from ..operators import rules as R
from ..operators import training as T
from ..sources.tables import FEEDS, latest_reviews, ledger, table
from .oracle import WIDE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r2(c: str | Column) -> Column:
    return F.round(c, 2)


def r6(c: str | Column) -> Column:
    return F.round(c, 6)


def scored(spark: SparkSession, d: str, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    return R.score(H.with_history(ledger(spark, d), cfg), cfg)


def stored(spark: SparkSession, d: str) -> DataFrame:
    return D.predictions(scored(spark, d))


def reviews(rows: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """An hour after each alert whose id divides by 3, a review that knows the label."""
    truth = ledger(spark, d).select(F.col("event_id").cast("string").alias("_e"), "is_fraud")
    some = rows.where(F.col("is_alert") & (F.col("event_id").cast("long") % 3 == 0)).join(truth, F.col("event_id") == F.col("_e"))
    label = F.when(F.col("is_fraud") == 1, "confirmed_fraud").otherwise("false_positive")
    status = F.when(F.col("event_id").cast("long") % 2 == 0, "closed").otherwise("escalated")
    log = some.select("alert_id", "event_id", status.alias("review_status"), label.alias("review_label"), F.lit("analyst").alias("reviewer"), F.lit("").alias("notes"), (F.col("event_ts") + F.make_interval(hours=F.lit(1))).alias("reviewed_at"))
    return latest_reviews(log)


def once(spark: SparkSession, d: str) -> DataFrame:
    """The stored predictions, scored once for all that a query asks of them."""
    return settle(stored(spark, d))


def labeled(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    rows = once(spark, d) if rows is None else rows
    return settle(N.labeled(rows, reviews(rows, spark, d)))


def halves(spark: SparkSession, d: str, rows: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    rows = once(spark, d) if rows is None else rows
    even = F.col("event_id").cast("long") % 2 == 0
    return rows.where(even), rows.where(~even)


def with_score(spark: SparkSession, d: str) -> DataFrame:
    """The ledger with the share of balances that an amount takes, in steps of 1/10000, as score."""
    part = S.share_of(F.col("amount"), F.col("oldbalance_org") + F.col("oldbalance_dest"))
    return ledger(spark, d).withColumn("score", F.floor(part * 10_000) / 10_000)


# --- history and rules


@query
def sender_velocity(spark: SparkSession, d: str) -> DataFrame:
    return H.sender_history(ledger(spark, d)).select("event_id", F.col("sender_recent_txn_count").cast("long").alias("sender_recent_txn_count"), r2("sender_recent_total_amount").alias("sender_recent_total_amount"), F.col("velocity_transactions_1h").cast("long").alias("velocity_transactions_1h"))


@query
def receiver_velocity(spark: SparkSession, d: str) -> DataFrame:
    return H.receiver_history(ledger(spark, d)).select("event_id", F.col("receiver_recent_txn_count").cast("long").alias("receiver_recent_txn_count"), r2("receiver_recent_total_amount").alias("receiver_recent_total_amount"))


@query
def time_since_last(spark: SparkSession, d: str) -> DataFrame:
    return H.sender_history(ledger(spark, d)).select("event_id", "time_since_last_purchase")


def fired(spark: SparkSession, d: str, rule: str, *columns: str | Column, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    return scored(spark, d, cfg).where(F.array_contains("triggered_rules", rule)).select("event_id", *columns)


@query
def fan_out_burst(spark: SparkSession, d: str) -> DataFrame:
    return fired(spark, d, "sender_fan_out_burst", F.col("fan_out_receivers").cast("long").alias("receivers"), r2(F.col("sender_recent_total_amount") + F.col("amount")).alias("total"))


@query
def fan_in_burst(spark: SparkSession, d: str) -> DataFrame:
    return fired(spark, d, "receiver_fan_in_burst", F.col("fan_in_senders").cast("long").alias("senders"), r2(F.col("receiver_recent_total_amount") + F.col("amount")).alias("total"))


@query
def structured_split(spark: SparkSession, d: str) -> DataFrame:
    return fired(spark, d, "structured_split_transfer", F.col("split_count").cast("long").alias("transfers"), r2("split_amount").alias("total"), cfg=WIDE)


@query
def new_counterparty(spark: SparkSession, d: str) -> DataFrame:
    return H.counterparty_history(ledger(spark, d)).where("is_new_counterparty = 1").select("event_id", "name_orig", "name_dest", "amount")


@query
def cashout_chain(spark: SparkSession, d: str) -> DataFrame:
    return fired(spark, d, "cashout_after_inbound_chain", r2("inbound_total").alias("inbound_total"), F.round("inbound_to_cashout_ratio", 6).alias("ratio"))


@query
def account_drain(spark: SparkSession, d: str) -> DataFrame:
    return fired(spark, d, "account_drain_near_zero", "name_orig", "amount", "oldbalance_org")


@query
def risk_score(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).select("event_id", F.array_join("triggered_rules", ",").alias("rules"), "risk_score", "severity", "is_alert")


@query
def alerts_by_severity(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).where("is_alert").groupBy("severity").agg(F.count(F.lit(1)).alias("alerts"), r2(F.sum("amount")).alias("amount"))


@query
def alerts_by_rule(spark: SparkSession, d: str) -> DataFrame:
    return V.alerts_by_rule(scored(spark, d).where("is_alert")).withColumn("amount", r2("amount"))


RULE_TYPES = (*R.STATE_FIELDS, "amount_threshold", "watchlist_update", "unknown_rule")


def rule_log(spark: SparkSession, d: str) -> DataFrame:
    """The events as rule messages: the id is the offset, the value sets every third field."""
    i, v = F.col("event_id"), F.round("value", 2)
    names = sorted({f for x in R.STATE_FIELDS.values() for f in x})
    fields = [F.when((i + k) % 3 == 0, v).alias(f) for k, f in enumerate(names)]
    kinds = F.array(*map(F.lit, RULE_TYPES))
    return table(spark, d, "events").select(i.alias("offset"), F.concat(F.lit(" "), F.upper(F.element_at(kinds, (i % len(RULE_TYPES) + 1).cast("int")))).alias("rule_type"), F.when(i % 4 < 2, "transfer").otherwise("cash_out").alias("txn_type"), F.concat(F.lit("C"), F.col("user_id")).alias("account_id"), F.when(i % 7 < 3, "remove").when(i % 7 < 6, "add").alias("operation"), *fields)


@query
def rule_state_fold(spark: SparkSession, d: str) -> DataFrame:
    state = R.fold_rules(rule_log(spark, d))
    return state.select([F.col(c).cast("double").alias(c) for c in state.columns]).unpivot([], state.columns, "setting", "value")


@query
def watchlist_state(spark: SparkSession, d: str) -> DataFrame:
    return R.fold_watchlist(rule_log(spark, d))


@query
def watchlist_hits(spark: SparkSession, d: str) -> DataFrame:
    rows = R.flag_watchlist(ledger(spark, d), R.fold_watchlist(rule_log(spark, d)))
    return rows.groupBy("on_watchlist").agg(F.count(F.lit(1)).alias("events"))


# --- features


@query
def static_features(spark: SparkSession, d: str) -> DataFrame:
    return ledger(spark, d).select("event_id", *[(F.floor(c * 1e6) / 1e6).alias(n) if "ratio" in n else (r2(c) if "delta" in n or "discrepancy" in n else c.cast("long")).alias(n) for n, c in S.static_features().items()])


@query
def hash_attributes(spark: SparkSession, d: str) -> DataFrame:
    return ledger(spark, d).select("name_orig").distinct().withColumns(S.hash_attributes(F.col("name_orig")))


def ledger_text(spark: SparkSession, d: str) -> DataFrame:
    """The ledger as text, amounts in whole cents."""
    cents = lambda c: F.round(F.col(c) * 100).cast("long").cast("string")
    return ledger(spark, d).select("seq", F.col("step").cast("string").alias("step"), F.col("txn_type").alias("type"), cents("amount").alias("amount"), F.col("name_orig").alias("nameOrig"), cents("oldbalance_org").alias("oldbalanceOrg"), cents("newbalance_org").alias("newbalanceOrig"), F.col("name_dest").alias("nameDest"), cents("oldbalance_dest").alias("oldbalanceDest"), cents("newbalance_dest").alias("newbalanceDest"), F.col("is_fraud").cast("string").alias("isFraud"))


@query
def event_id_sha1(spark: SparkSession, d: str) -> DataFrame:
    return ledger_text(spark, d).select("seq", D.ledger_event_id().alias("event_id"))


@query
def typed_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Ledger text with a broken field in every 11th and 13th row, typed."""
    rows = ledger_text(spark, d)
    rows = rows.withColumn("amount", F.when(F.col("seq") % 11 == 0, "n/a").otherwise(F.col("amount"))).withColumn("isFraud", F.when(F.col("seq") % 13 == 0, "").otherwise(F.col("isFraud")))
    return D.type_ledger(rows).groupBy(F.coalesce("error", F.lit("valid")).alias("error")).agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("step").cast("long")).alias("steps"))


# --- decoding and integration


def raw_messages(spark: SparkSession, d: str) -> DataFrame:
    """The transaction feed as envelopes, with a defect of its own for ids 0 to 6 modulo 20."""
    tx = D.wire_feeds(ledger(spark, d))["transactions"].withColumn("i", F.col("event_id").cast("long"))
    k = F.col("i") % 20
    broken = tx.withColumns({
        "nameOrig": F.when(k != 1, F.col("nameOrig")), "event_time": F.when(k == 2, "soon").otherwise(F.col("event_time")), "event_id": F.when(k == 3, "  ").otherwise(F.col("event_id")),
        "step": F.when(k == 4, -1).otherwise(F.col("step")), "amount": F.when(k == 5, -1.0).otherwise(F.col("amount")),
    })
    names = [c for c in tx.columns if c != "i"]
    text = F.to_json(F.struct(*names))
    text = F.when(k == 0, F.concat(F.lit("{"), text)).when(k == 6, F.regexp_replace(text, '"amount":[^,]*', '"amount":NaN')).otherwise(text)
    return broken.select(F.col("i").cast("string").alias("kafka_key"), text.alias("raw_value"), F.timestamp_seconds("i").alias("kafka_timestamp"), (F.col("i") % 6).cast("int").alias("partition"), F.col("i").alias("offset"), F.lit("transactions").alias("source_topic"))


def decoded(spark: SparkSession, d: str) -> DataFrame:
    return D.decode(raw_messages(spark, d), FEEDS["transactions"], D.REQUIRED["transactions"], ("event_time", "producer_ts"))


@query
def decode_errors(spark: SparkSession, d: str) -> DataFrame:
    return decoded(spark, d).groupBy(F.coalesce("error", F.lit("valid")).alias("error")).agg(F.count(F.lit(1)).alias("events"), F.sum("offset").alias("offsets"))


@query
def decode_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    return D.dead_letters(decoded(spark, d)).select("key", F.get_json_object("value", "$.error").alias("error"), F.get_json_object("value", "$.source_key").alias("source_key"))


def feeds(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Typed feeds of the ledger with states that are missing, late, renamed or of no transaction."""
    made = D.wire_feeds(ledger(spark, d))
    tx, s, r = (made[n].withColumn("event_time", F.try_to_timestamp("event_time")) for n in ("transactions", "sender_state", "receiver_state"))
    i = F.col("source_event_id").cast("long")
    shift = F.when(i % 29 == 0, 30).when(i % 31 == 0, 31).otherwise(0)
    s = s.where(i % 13 != 0).withColumn("event_time", F.timestamp_seconds(F.unix_seconds("event_time") + shift)).withColumn("source_event_id", F.when(i % 23 == 0, F.concat("source_event_id", F.lit("-missing"))).otherwise(F.col("source_event_id")))
    r = r.where(i % 17 != 0).withColumn("nameDest", F.when(i % 19 == 0, F.concat("nameDest", F.lit("-MISMATCH"))).otherwise(F.col("nameDest")))
    return tx.withColumn("producer_ts", F.try_to_timestamp("producer_ts")), s, r


@query
def integrate_triplets(spark: SparkSession, d: str) -> DataFrame:
    done = J.integrated(J.classified(*feeds(spark, d)))
    return done.select(F.col("event_id").cast("long").alias("event_id"), F.unix_seconds("event_time").alias("t"), "txn_type", "amount", "name_orig", "name_dest", "oldbalance_org", "newbalance_dest", "is_fraud")


@query
def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    return J.all_join_errors(*feeds(spark, d)).select("source_topic", "source_key", "error")


@query
def strict_matches(spark: SparkSession, d: str) -> DataFrame:
    return J.strict_match(*feeds(spark, d)).groupBy(F.coalesce("reason", F.lit("match")).alias("reason")).agg(F.count(F.lit(1)).alias("events"))


@query
def triplet_errors(spark: SparkSession, d: str) -> DataFrame:
    return J.triplet_errors(*feeds(spark, d))


@query
def account_states(spark: SparkSession, d: str) -> DataFrame:
    rows = D.account_states(ledger(spark, d))
    return rows.groupBy("account_id", "role").agg(F.count(F.lit(1)).alias("updates"), r2(F.sum(F.col("balance_after") - F.col("balance_before"))).alias("change"))


@query
def request_errors(spark: SparkSession, d: str) -> DataFrame:
    """Rows as scoring requests with broken fields, and what a score without history says of the others."""
    i = F.col("event_id")
    # a fixed amount: the negative of 0 breaks no limit
    rows = ledger(spark, d).withColumn("amount", F.when(i % 41 == 0, -1.0).otherwise(F.col("amount"))).withColumn("name_dest", F.when(i % 43 == 0, " ").otherwise(F.col("name_dest")))
    done = R.score(D.without_history(D.score_requests(rows)))
    return done.groupBy(F.coalesce("error", F.lit("valid")).alias("error")).agg(F.count(F.lit(1)).alias("events"), F.count_if("is_alert").alias("alerts"))


# --- window metrics


@query
def tumbling_metrics(spark: SparkSession, d: str) -> DataFrame:
    return M.tumbling(ledger(spark, d)).select(F.unix_seconds("window_start").alias("start_s"), "event_count", "fraud_count", r2("total_amount").alias("total_amount"), r6("fraud_rate").alias("fraud_rate"))


@query
def sliding_metrics(spark: SparkSession, d: str) -> DataFrame:
    return M.sliding(ledger(spark, d)).select(F.unix_seconds("window_start").alias("start_s"), "event_count", "fraud_count", r2("total_amount").alias("total_amount"), r6("fraud_rate").alias("fraud_rate"))


# --- monitoring


@query
def confusion_metrics(spark: SparkSession, d: str) -> DataFrame:
    return N.binary_metrics(labeled(spark, d))


@query
def rolling_performance(spark: SparkSession, d: str) -> DataFrame:
    return N.rolling_metrics(labeled(spark, d)).select("days", F.unix_seconds("window_end").alias("end_s"), "labeled_rows", "tp", "fp", "tn", "fn", "precision", "recall", "f1", "false_positive_rate")


@query
def label_sources(spark: SparkSession, d: str) -> DataFrame:
    return N.performance_summary(labeled(spark, d)).withColumn("warnings", F.array_join("warnings", ","))


@query
def numeric_drift_ks(spark: SparkSession, d: str) -> DataFrame:
    return N.numeric_drift(*halves(spark, d), ("amount", "risk_score"))


@query
def categorical_drift_tvd(spark: SparkSession, d: str) -> DataFrame:
    return N.categorical_drift(*halves(spark, d))


@query
def category_distributions(spark: SparkSession, d: str) -> DataFrame:
    return N.category_distributions(*halves(spark, d)).select("feature", "category", r6("reference").alias("reference"), r6("serving").alias("serving"))


@query
def reference_summary(spark: SparkSession, d: str) -> DataFrame:
    return N.numeric_summary(halves(spark, d)[0]).select("feature", *[r6(c).alias(c) for c in ("mean", "std", "min", "max")])


@query
def reference_rates(spark: SparkSession, d: str) -> DataFrame:
    return N.reference_rates(scored(spark, d)).select("rows", r6("alert_rate").alias("alert_rate"), r6("label_rate").alias("label_rate"))


@query
def reference_dataset(spark: SparkSession, d: str) -> DataFrame:
    return N.reference_dataset(ledger(spark, d)).select("event_id", "severity", "risk_score", "is_alert", "label_is_fraud")


@query
def drift_table(spark: SparkSession, d: str) -> DataFrame:
    return N.drift_table(*halves(spark, d))


@query
def retraining_reasons(spark: SparkSession, d: str) -> DataFrame:
    scored_once = once(spark, d)
    a, b = halves(spark, d, scored_once)
    shares = N.category_distributions(a, b, ("is_alert",)).where("category = 'true'")
    rows = labeled(spark, d, scored_once)
    week = N.rolling_metrics(rows, (7,))
    return N.retraining_reasons(spark, N.retraining_observations(N.drift_table(a, b), shares, N.performance_summary(rows), week))


# --- review


def queue(spark: SparkSession, d: str) -> DataFrame:
    rows = once(spark, d)
    return V.with_reviews(rows.where("is_alert"), reviews(rows, spark, d))


@query
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    return V.review_queue(queue(spark, d), severities=("high", "medium")).select("alert_id", "severity", "risk_score", "review_status", "review_label", "primary_rule")


@query
def unreviewed_alerts(spark: SparkSession, d: str) -> DataFrame:
    return V.unreviewed(queue(spark, d)).groupBy("primary_rule").agg(F.count(F.lit(1)).alias("alerts"))


@query
def review_status_mix(spark: SparkSession, d: str) -> DataFrame:
    return V.mix(queue(spark, d), "review_status").withColumn("amount", r2("amount"))


@query
def review_label_mix(spark: SparkSession, d: str) -> DataFrame:
    return V.mix(queue(spark, d), "review_label").withColumn("amount", r2("amount"))


@query
def hot_alerts(spark: SparkSession, d: str) -> DataFrame:
    """The alerts of the hour before the latest event, with the label of their severity."""
    rows = once(spark, d)
    latest = rows.agg(F.max("event_ts").alias("latest"))
    near = V.hot_alerts(rows.where("is_alert").crossJoin(F.broadcast(latest)), F.col("latest"), 1)  # one row
    return near.select("alert_id", "severity", V.status_label(F.col("severity")).alias("label"))


@query
def alert_messages(spark: SparkSession, d: str) -> DataFrame:
    """The payloads of all alerts, read back."""
    sent = D.alert_payloads(stored(spark, d))
    return sent.select("key", *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("event_id", "account_id", "severity", "actual_label")])


@query
def metric_messages(spark: SparkSession, d: str) -> DataFrame:
    """The payloads of the tumbling windows, read back."""
    sent = M.payloads(M.tumbling(ledger(spark, d)))
    return sent.select("key", *[F.get_json_object("value", f"$.{c}").cast("long").alias(c) for c in ("event_count", "fraud_count")])


@query
def queue_kpis(spark: SparkSession, d: str) -> DataFrame:
    return V.queue_kpis(queue(spark, d))


@query
def alert_kpis(spark: SparkSession, d: str) -> DataFrame:
    k = V.alert_kpis(stored(spark, d).where("is_alert"))
    return k.select("total_alerts", "high_alerts", *[r6(c).alias(c) for c in ("high_share", "mean_risk")], r2("at_risk_amount").alias("at_risk_amount"))


@query
def top_rules(spark: SparkSession, d: str) -> DataFrame:
    return V.top_rules(stored(spark, d).where("is_alert"), 3).withColumn("amount", r2("amount"))


@query
def type_mix(spark: SparkSession, d: str) -> DataFrame:
    return V.mix(stored(spark, d).where("is_alert"), "txn_type").withColumn("amount", r2("amount"))


@query
def recent_cases(spark: SparkSession, d: str) -> DataFrame:
    return V.recent_cases(queue(spark, d), "alert:1").select("alert_id", F.unix_seconds("event_ts").alias("t"), "selected")


@query
def unpivot_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = M.tumbling(ledger(spark, d), 3600).withColumn("start_s", F.unix_seconds("window_start"))
    return V.long_metrics(m, ["start_s"], ["event_count", "fraud_count", "total_amount"]).withColumn("value", r2("value"))


# --- training


@query
def eda_type_fraud(spark: SparkSession, d: str) -> DataFrame:
    return T.profile_types(ledger(spark, d)).withColumn("mean_amount", F.round("mean_amount", 4))


@query
def eda_by_class(spark: SparkSession, d: str) -> DataFrame:
    return T.profile_classes(ledger(spark, d)).withColumns({"mean_amount": F.round("mean_amount", 4), "share": r6("share"), "imbalance": r6("imbalance")})


@query
def step_profile(spark: SparkSession, d: str) -> DataFrame:
    return T.step_profile(ledger(spark, d)).select("step", F.col("count").alias("events"))


@query
def fraud_listing(spark: SparkSession, d: str) -> DataFrame:
    return T.fraud_rows(ledger(spark, d)).select("event_id", "step", "txn_type", "amount")


CORRELATED = ["amount", "oldbalance_org", "newbalance_org", "oldbalance_dest", "is_fraud"]


@query
def feature_correlation(spark: SparkSession, d: str) -> DataFrame:
    return T.correlations(ledger(spark, d), CORRELATED).withColumn("value", r6("value"))


@query
def business_cost(spark: SparkSession, d: str) -> DataFrame:
    return T.business_cost(scored(spark, d), F.col("is_alert"))


@query
def cost_threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return T.cheapest_threshold(T.by_score(with_score(spark, d)))


@query
def f1_threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return T.best_f1(T.by_score(with_score(spark, d))).select("threshold", *[r6(c).alias(c) for c in ("f1", "precision", "recall")])


@query
def average_precision(spark: SparkSession, d: str) -> DataFrame:
    return T.average_precision(T.by_score(with_score(spark, d))).select(r6("average_precision").alias("average_precision"), r6("auc_roc").alias("auc_roc"))


@query
def pr_curve(spark: SparkSession, d: str) -> DataFrame:
    return T.curve_points(T.by_score(with_score(spark, d))).select("threshold", *[r6(c).alias(c) for c in ("precision", "recall", "false_positive_rate")])


@query
def class_report(spark: SparkSession, d: str) -> DataFrame:
    rows = with_score(spark, d)
    return T.class_report(rows, F.col("score") >= 0.5).select("label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return T.stratified_split(ledger(spark, d)).select("event_id", "is_fraud", "split")


@query
def balanced_sample(spark: SparkSession, d: str) -> DataFrame:
    return T.balanced_sample(ledger(spark, d)).select("event_id", "is_fraud", "place")


@query
def amount_histogram(spark: SparkSession, d: str) -> DataFrame:
    return T.amount_histogram(ledger(spark, d))


def numeric_features(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    return S.feature_table(H.with_history(ledger(spark, d)))


@query
def feature_table(spark: SparkSession, d: str) -> DataFrame:
    """Sums over the feature table, a row for each feature."""
    rows, names = numeric_features(spark, d)
    sums = rows.agg(*[F.sum(F.col(n).cast("double")).alias(n) for n in names])
    return sums.unpivot([], names, "feature", "total").withColumn("total", F.round("total", 1))


#: What the rules read besides features.
RULE_INPUTS = ("txn_type", "fan_out_receivers", "fan_in_senders", "split_count", "split_amount", "inbound_total")


@contextmanager
def modelled(spark: SparkSession, d: str, *others: str, parts: tuple[str, ...] = ("train", "validation", "test"), alike: tuple[str, ...] = ()) -> Iterator[tuple[list[DataFrame], list[str]]]:
    """(rows of each part, names of the features): features, label, event_id and other columns, without the id in the train rows.

    History runs once, into one table with a partition for each part, which goes with the models. alike: columns that order
    the rows of a file, and see dealt(); a model is faster on rows that are like those before them.
    """
    rows, names = numeric_features(spark, d)
    bounds = settle(T.split_bounds(ledger(spark, d)))
    split = T.with_split(rows, bounds).where(F.col("split").isin(*parts))
    split = split.select(*names, "is_fraud", "event_id", "split", *others).sortWithinPartitions("split", *alike)
    table, path = keep(split, "features", "split")
    train, *rest = (table.where(F.col("split") == p).drop("split") for p in parts)
    train = T.dealt(train.select(*names, "is_fraud", "event_id"), alike=alike)
    try:
        yield [train, *rest], names
    finally:
        train.unpersist()
        remove(spark, path)


@query
def model_scores(spark: SparkSession, d: str) -> DataFrame:
    """A logistic regression trained on the train split, its scores combined with the rules on the test split."""
    with modelled(spark, d, *RULE_INPUTS, parts=("train", "test")) as ((train, test), names):
        model = T.fit(T.class_weights(train), names)
        return settle(R.score(T.predict(model, test), ml=F.col("score")).select("event_id", "is_fraud", "ml_score", "risk_score", "severity", "is_alert"))


#: Features that order the train rows of the compared models: the type decides most, and many others follow the amount.
ALIKE = (*(f"type_{t}" for t in TYPES), "amount")


def compared(spark: SparkSession, d: str, kinds: dict[str, dict] | None = None) -> DataFrame:
    """A linear model, a forest and boosted trees: trained, tuned by cost on validation rows, measured on test rows, and which one is selected.

    Two models are fitted at a time, so that one's tasks fill the cores that the other leaves idle between its passes, and rows are held for two at most.
    Weights and preparation of the train rows are the same for all, so they are made once.
    """
    kinds = dict.fromkeys(T.ESTIMATORS, {}) if kinds is None else kinds
    with modelled(spark, d, alike=ALIKE) as ((train, *rest), names), ThreadPoolExecutor(2) as pool:
        train = T.class_weights(train)
        before = T.preparation(train, names)
        measured = inheritable_thread_target(spark)(lambda kind: settle(T.train_and_tune(train, *rest, names, kind, before, **kinds[kind])[1]))
        done = {kind: pool.submit(measured, kind) for kind in sorted(kinds, key=T.LONGEST_FIRST.index)}
        records = reduce(DataFrame.unionByName, (done[kind].result() for kind in kinds))
    chosen = T.select_model(records).select(F.col("model").alias("_model"))
    return records.crossJoin(F.broadcast(chosen)).withColumn("selected", F.col("model") == F.col("_model")).drop("_model")  # one row


@query
def model_comparison(spark: SparkSession, d: str) -> DataFrame:
    return compared(spark, d)


@query
def feature_importances(spark: SparkSession, d: str) -> DataFrame:
    """The features that a forest trained on the train split uses most."""
    with modelled(spark, d, parts=("train",)) as ((train,), names):
        return T.top_importances(spark, T.fit(T.class_weights(train), names, "rf", numTrees=20, maxDepth=8), names)


@query
def smote_rows(spark: SparkSession, d: str) -> DataFrame:
    names = ["amount", "oldbalance_org", "newbalance_org", "oldbalance_dest", "newbalance_dest"]
    return T.oversample(ledger(spark, d), names)


# --- load and latency


@query
def smoke_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = P.smoke_summary(scored(spark, d), M.tumbling(ledger(spark, d)))
    ids = F.array_join(F.transform("first_alerts", lambda a: a["event_id"].cast("string")), ",")
    return rows.select("events", "alerts", ids.alias("first_alerts"), F.array_join(F.transform("first_windows", lambda w: w["event_count"].cast("string")), ",").alias("first_windows"))


def tracked(spark: SparkSession, d: str) -> DataFrame:
    """Each event as a tracked message: seen and stored after times that its id sets; every 50th never is."""
    i = F.col("event_id")
    rows = table(spark, d, "events").select(F.lit("r1").alias("run"), F.concat(F.lit("p"), (i % 3).cast("string")).alias("profile"), i, F.timestamp_seconds(i).alias("published_at"))
    seen = F.timestamp_millis(i * 1000 + i * 37 % 1000)
    timings = rows.where(i % 50 != 0).select("run", "event_id", seen.alias("spark_seen_at"), F.timestamp_millis(i * 1000 + i * 37 % 1000 + i * 91 % 3000).alias("persisted_at"))
    return P.stage_latencies(rows, timings)


@query
def latency_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return P.latency_summary(tracked(spark, d), "total_ms", "profile").select("profile", *[F.round(c, 4).alias(c) for c in ("min", "mean", "p50", "p95", "p99", "max")])


@query
def latency_profiles(spark: SparkSession, d: str) -> DataFrame:
    return P.profile_summary(tracked(spark, d)).withColumn("success_rate", r6("success_rate"))


@query
def resource_summary(spark: SparkSession, d: str) -> DataFrame:
    i, v = F.col("event_id"), F.col("value")
    samples = table(spark, d, "events").select(F.timestamp_seconds(i).alias("captured_at"), F.concat(F.lit("svc"), (F.col("user_id") % 5).cast("string")).alias("name"), v.alias("cpu_percent"), S.size_of(F.concat(F.floor(v).cast("string"), F.lit("MiB"))).alias("memory_used_bytes"), (i * 3.0).alias("network_rx_bytes"), (i * 2.0).alias("network_tx_bytes"), (i % 100 * 1.0).alias("block_read_bytes"), (-1.0 * i).alias("block_write_bytes"))
    done = P.resource_summary(samples)
    return done.select("name", "samples", *[F.round(c, 4).alias(c) for c in done.columns[2:]])


@query
def trigger_rate_pivot(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    name = F.when(i % 4 == 0, "trigger-2s-high.json").when(i % 4 == 1, "low-load-20s.json").when(i % 4 == 2, "extreme-20s.json").otherwise("benchmark-results.json")
    points = table(spark, d, "events").groupBy(name.alias("file_name"), F.element_at(F.array(F.lit(50), F.lit(200), F.lit(500)), (i % 3 + 1).cast("int")).alias("rate")).agg(F.max("value").alias("p95"))
    done = P.comparison(points, [50, 200, 500])
    return done.select("trigger", "family", *[F.col(str(c)).alias(f"rate_{c}") for c in (50, 200, 500)])


@query
def amplified_events(spark: SparkSession, d: str) -> DataFrame:
    seed = ledger(spark, d)
    rows = P.amplify(seed, 2 * seed.count() + 7)
    return rows.select("seq", "event_id", "step", F.unix_seconds("event_time").alias("t"), "name_orig", "name_dest", "amount")


@query
def load_profile(spark: SparkSession, d: str) -> DataFrame:
    """What scoring and windows make of an amplified ledger."""
    seed = ledger(spark, d)
    rows = P.amplify(seed, 2 * seed.count())
    alerts = R.score(H.with_history(rows)).agg(F.count(F.lit(1)).alias("events"), F.count_if("is_alert").alias("alerts"))
    windows = M.tumbling(rows).agg(F.count(F.lit(1)).alias("tumbling")).crossJoin(M.sliding(rows).agg(F.count(F.lit(1)).alias("sliding")))  # one row each
    return alerts.crossJoin(F.broadcast(windows))
