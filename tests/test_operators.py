"""Decoding, integration, monitoring, training and report operators on hand-made rows."""

import json
import math
import re

import pytest
from pyspark.sql import functions as F

from txscreen.functions import scalars as S
from txscreen.operators import decode as D
from txscreen.operators import metrics as M
from txscreen.operators import monitoring as N
from txscreen.operators import reports as P
from txscreen.operators import review as V
from txscreen.operators import rules as R
from txscreen.operators import training as T
from txscreen.plans.running import running_totals
from txscreen.sources import sinks, tables

LEDGER = [("1", "TRANSFER", "100.5", "C1", "500", "399.5", "C2", "0", "100.5", "0"), ("2", "PAYMENT", "x", "C1", "1", "1", "M2", "0", "0", "0")]
NAMES = ["step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud"]


def test_ledger_rows_are_typed_or_rejected(spark):
    good, bad = D.type_ledger(spark.createDataFrame(LEDGER, NAMES)).collect()
    assert good.error is None and good.amount == 100.5 and good.event_time.isoformat() == "2026-01-01T00:01:00"
    import hashlib

    assert good.event_id == hashlib.sha1("|".join(LEDGER[0]).encode()).hexdigest()
    assert bad.error == "bad_amount"


def test_csv_round_trip_of_the_feeds(spark, tmp_path):
    tx = D.type_ledger(spark.createDataFrame(LEDGER[:1], NAMES))
    assert sinks.write_feeds(tx, str(tmp_path)) == {"transactions": 1, "sender_state": 1, "receiver_state": 1}
    back = tables.read_feed_csv(spark, f"{tmp_path}/sender_state", "sender_state").first()
    assert back.newbalanceOrig == 399.5 and back.source_event_id + ":sender" == back.event_id


def test_ledger_csv_limit(spark, tmp_path):
    spark.createDataFrame(LEDGER, NAMES).coalesce(1).write.option("header", True).csv(f"{tmp_path}/l")
    assert tables.read_ledger_csv(spark, f"{tmp_path}/l").count() == 2 and tables.read_ledger_csv(spark, f"{tmp_path}/l", 1).count() == 1


def test_watchlist_and_rule_fold(spark):
    log = spark.createDataFrame([(1, "watchlist_update", "C100", "add"), (2, "watchlist_update", "C100", "remove"), (3, " Watchlist_Update ", "C200", None), (4, "watchlist_update", " ", "add")], "offset long, rule_type string, account_id string, operation string")
    assert [r.account_id for r in R.fold_watchlist(log).collect()] == ["C200"]
    fields = sorted({f for x in R.STATE_FIELDS.values() for f in x})
    empty = log.select("offset", "rule_type", F.lit(None).cast("string").alias("txn_type"), *[F.lit(None).cast("double").alias(f) for f in fields])
    assert R.overlay(R.fold_rules(empty)) == R.ScreenConfig()
    assert R.default_rules(spark).count() == 6




def test_label_and_flag_words(spark):
    rows = spark.createDataFrame([(" Fraud ", "TRUE"), ("not_fraud", "no"), ("?", None)], "l string, a string")
    got = rows.select(S.label_of(F.col("l")), S.alert_flag(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [("fraud", True), ("legit", False), (None, False)]


def test_size_run_and_file_names(spark):
    rows = spark.createDataFrame([("12.5MiB", "bench:r1:e:1", "x-trigger-2s-high.json"), ("3%", "e1", "low-load-20s.json"), ("?", "bench:r1", "extreme.json")], "s string, i string, f string")
    got = [tuple(r) for r in rows.select(S.size_of(F.col("s")), S.run_id(F.col("i")), S.trigger_label(F.col("f")), S.load_family(F.col("f"))).collect()]
    assert got == [(12.5 * 2**20, "r1", "2s trigger", "high-load"), (3.0, None, "20s trigger", "low-load"), (None, None, "unknown", "extreme")]


def test_ks_extremes(spark):
    frame = lambda v: spark.createDataFrame([(float(x),) for x in v], "v double")
    apart, same = N.numeric_drift(frame([1, 2, 3]), frame([4, 5, 6]), ("v",)).first(), N.numeric_drift(frame([1, 2, 3]), frame([1, 2, 3]), ("v",)).first()
    assert apart.ks_statistic == 1.0 and apart.drift_detected and same.ks_statistic == 0.0 and not same.drift_detected
    assert N.numeric_drift(frame([]), frame([1]), ("v",)).count() == 0


def test_tvd_of_disjoint_categories(spark):
    a, b = spark.createDataFrame([("a",)], "c string"), spark.createDataFrame([("b",)], "c string")
    assert N.categorical_drift(a, b, ("c",)).first().total_variation_distance == 1.0


def test_retraining_needs_a_sample(spark):
    obs = spark.createDataFrame([("precision_7d", 0.1, 3.0), ("recall_7d", 0.9, 50.0), ("label_coverage", 0.4, 3.0)], "type string, observed double, rows_7d double")
    assert [r.type for r in N.retraining_reasons(spark, obs).collect()] == ["label_coverage"]
    assert N.retraining_decision(N.retraining_reasons(spark, obs)).first().retrain_required


def test_running_totals_match_a_loop(spark):
    rows = spark.createDataFrame([(float(i * 7 % 1000), i) for i in range(1000)], "s double, n int")
    got = {r.s: r.run_n for r in running_totals(rows, "s", ["n"], descending=True).collect()}
    total = 0
    for s, n in sorted(((float(i * 7 % 1000), i) for i in range(1000)), reverse=True):
        total += n
        assert got[s] == total


def test_thresholds_with_tied_scores(spark):
    rows = spark.createDataFrame([(0.5, 1, 100.0), (0.5, 0, 50.0), (0.5, 0, 10.0)], "score double, is_fraud int, amount double")
    best = T.cheapest_threshold(T.by_score(rows)).first()
    assert best.threshold == 0.5 and best.cost == 10.0 and best.evaluated_thresholds == 2
    none = T.cheapest_threshold(T.by_score(rows.withColumn("amount", F.lit(1.0)))).first()
    assert none.threshold is None and none.cost == 1.0


def test_train_save_load(spark, data, tmp_path):
    rows, names = S.feature_table(__import__("txscreen.operators.history", fromlist=["x"]).with_history(tables.ledger(spark, data)))
    assert len(names) == 43
    train = T.class_weights(rows.where("seq < 600")).persist()
    model = T.fit(train, names, "rf")
    T.save_model(model, str(tmp_path / "m"), names, 0.5)
    again, order, threshold = T.load_model(spark, str(tmp_path / "m"))
    assert order == names and threshold == 0.5
    rest = rows.where("seq >= 600")
    assert T.predict(model, rest).agg(F.sum("score")).first()[0] == pytest.approx(T.predict(again, rest).agg(F.sum("score")).first()[0])
    assert T.top_importances(spark, model, names, 5).count() == 5
    assert T.evaluate(T.predict(model, rest), 0.5).first().auc_roc > 0.5


def test_model_selection_breaks_ties_by_area(spark):
    rows = spark.createDataFrame([("a", 5.0, 0.8), ("b", 5.0, 0.9), ("c", 6.0, 1.0)], "model string, validation_cost double, validation_auc_pr double")
    assert T.select_model(rows).first().model == "b"


def test_latency_of_nothing_is_zero(spark):
    row = P.latency_summary(spark.createDataFrame([], "v double"), "v").first()
    assert row.p95 == 0.0 and row.mean == 0.0


def test_sliding_windows_start_at_the_first_event(spark):
    rows = spark.createDataFrame([(60, 1.0, 0), (120, 1.0, 0), (180, 1.0, 1)], "s long, amount double, is_fraud int").withColumn("event_time", F.timestamp_seconds("s"))
    got = M.sliding(rows, 180, 60).orderBy("window_start").collect()
    assert got[0].event_count == 3 and len(got) == 3


def test_stored_days_are_bounded(spark):
    rows = spark.createDataFrame([(f"2026-01-{d:02d}", d * 100 + k, k) for d in range(1, 6) for k in range(4)], "d string, event_ts long, event_id long").withColumn("day_bucket", F.to_date("d"))
    got = tables.recent_days(rows, 2, 3)
    assert got.count() == 6 and {r.d for r in got.collect()} == {"2026-01-05", "2026-01-04"}


def test_recent_days_come_from_folder_names(spark, tmp_path):
    for b in range(3):
        rows = spark.range(1, 8).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int") + b).alias("day_bucket"), (F.col("id") * 10 + b).alias("event_ts"), F.col("id").alias("event_id"))
        sinks.write_table(rows, str(tmp_path), "transactions_by_day", str(b))
    path = f"{tmp_path}/transactions_by_day"
    assert tables.stored_days(spark, path)[:2] == ["2026-01-10", "2026-01-09"] and len(tables.stored_days(spark, path)) == 9
    got = tables.read_recent_days(spark, path, 2)
    want = tables.recent_days(spark.read.parquet(path), 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect())) and got.count() == 3
    # the scan has the folders of the two days only: the last batch's both, the one before its last
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day_bucket#\d+ IN", plan)
    assert tables.read_recent_days(spark, path, 5, 1).count() == 5 and tables.read_recent_days(spark, f"{tmp_path}/none", 5) is None


@pytest.mark.parametrize(("n", "m"), [(1, 1), (2, 3), (4, 4), (7, 5), (6, 9)])
def test_exact_ks_tails_match_all_orders(n, m):
    """The share of all orders of n and m values whose statistic is d or more."""
    from itertools import combinations

    from txscreen.operators.monitoring import _ks_tail

    seen = []
    for own in combinations(range(n + m), n):
        i = j = 0
        d, own = 0.0, set(own)
        for k in range(n + m):
            i, j = (i + 1, j) if k in own else (i, j + 1)
            d = max(d, abs(i / n - j / m))
        seen.append(d)
    for d in sorted(set(seen)):
        assert _ks_tail(d, n, m) == pytest.approx(sum(x >= d - 1e-9 for x in seen) / len(seen), abs=1e-12)


def test_exact_ks_tails_of_larger_samples(spark):
    from txscreen.operators.monitoring import _ks_tail

    # equal sizes have a closed form, by reflections
    for n in (20, 50, 1000):
        for h in (1, 2, n // 5, n // 2, n):
            want = 2 * sum((-1) ** (k - 1) * math.exp(2 * math.lgamma(n + 1) - math.lgamma(n - k * h + 1) - math.lgamma(n + k * h + 1)) for k in range(1, n // h + 1))
            assert _ks_tail(h / n, n, n) == pytest.approx(want, abs=1e-9)
    # known values of the two-sided test
    assert _ks_tail(1.0, 3, 3) == pytest.approx(0.1) and _ks_tail(1.0, 5, 5) == pytest.approx(2 / math.comb(10, 5))
    frame = lambda v: spark.createDataFrame([(float(x),) for x in v], "v double")
    assert N.numeric_drift(frame([1, 2, 3]), frame([4, 5, 6]), ("v",)).first().ks_pvalue == 0.1


@pytest.mark.parametrize("n", [5000, 10_000])
def test_exact_ks_tails_up_to_the_limit(n):
    from txscreen.operators.monitoring import _ks_tail

    for h in (n // 100, 120, n // 20):
        want = 2 * sum((-1) ** (k - 1) * math.exp(2 * math.lgamma(n + 1) - math.lgamma(n - k * h + 1) - math.lgamma(n + k * h + 1)) for k in range(1, n // h + 1))
        assert _ks_tail(h / n, n, n) == pytest.approx(want, abs=1e-9)
    # one row less on one side changes little
    assert _ks_tail(120 / n, n, n - 1) == pytest.approx(_ks_tail(120 / n, n, n), abs=2e-2)


def test_alerts_are_published_once(spark):
    rows, done = spark.createDataFrame([("r", "1"), ("r", "1"), ("r", "2")], "run_id string, event_id string"), spark.createDataFrame([("r", "2")], "run_id string, event_id string")
    assert [r.event_id for r in sinks.unpublished(rows, done).collect()] == ["1"]


def test_dead_letter_key_and_value(spark):
    raw = spark.createDataFrame([(None, "{", None, None, 7, "transactions")], "kafka_key string, raw_value string, kafka_timestamp timestamp, partition int, offset long, source_topic string")
    letter = D.dead_letters(D.decode(raw, tables.FEEDS["transactions"], D.REQUIRED["transactions"])).first()
    assert letter.key == "transactions:null:na:7" and json.loads(letter.value)["error"] == "json_parse_error"


def test_reviews_default_and_status(spark):
    alerts = spark.createDataFrame([("a1", ["r"], "high"), ("a2", [], "low")], "alert_id string, triggered_rules array<string>, severity string")
    none = spark.createDataFrame([], "alert_id string, review_status string, review_label string, reviewer string, notes string")
    got = V.with_reviews(alerts, none).orderBy("alert_id").collect()
    assert [(r.review_status, r.review_label, r.primary_rule) for r in got] == [("new", "unlabeled", "r"), ("new", "unlabeled", "ml_only")]


def test_reports_are_written(spark, tmp_path):
    sinks.write_report(spark.createDataFrame([(1, "x")], "a int, b string"), f"{tmp_path}/r")
    assert spark.read.json(f"{tmp_path}/r").first().b == "x"


def test_oversampling_of_many_equal_rows(spark):
    rows = spark.range(6000).select(F.col("id").alias("event_id"), (F.col("id") < 300).cast("int").alias("is_fraud"), F.when(F.col("id") < 299, 1.0).otherwise(9.0).alias("amount"))
    got = T.oversample(rows, ["amount"]).groupBy("is_fraud").agg(F.count(F.lit(1)).alias("n"), F.min("amount").alias("lo"), F.max("amount").alias("hi"))
    assert {r.is_fraud: (r.n, r.lo >= 1.0, r.hi <= 9.0) for r in got.collect()} == {0: (5700, True, True), 1: (570, True, True)}


def test_quantiles_of_groups(spark):
    rows = spark.createDataFrame([("a", float(x)) for x in (5, 1, 1, 9)] + [("b", None)], "g string, v double")
    got = {r.g: r for r in P.latency_summary(rows, "v", "g").collect()}
    assert (got["a"].p50, got["a"].max, got["b"].p50) == (3.0, 9.0, 0.0) and abs(got["a"].p95 - 8.4) < 1e-9
    assert P.latency_summary(rows, "v").first().p50 == 3.0
    assert P.latency_summary(rows.where("false"), "v").first().p99 == 0.0
