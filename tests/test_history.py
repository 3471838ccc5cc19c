"""History features against a plain loop over the rows in order, ties included."""

import random

import pytest
from pyspark.sql import functions as F

from txscreen.config import INBOUND, OUTBOUND, ScreenConfig
from txscreen.operators.history import sender_history, with_history
from txscreen.operators.rules import score
from txscreen.streaming.pipeline import score_batch

CFG = ScreenConfig()
DDL = "event_id long, seq long, t long, step int, txn_type string, amount double, name_orig string, name_dest string, oldbalance_org double, newbalance_org double, oldbalance_dest double, newbalance_dest double, is_fraud int"


def made(n: int, seed: int) -> list[tuple]:
    r = random.Random(seed)
    rows, t = [], 0
    for i in range(n):
        t += r.choice([0, 0, 60, 300, 900, 901])
        a, b = f"C{r.randrange(4)}", f"C{r.randrange(5)}"
        rows.append((i, i, t, t // 60, r.choice(["TRANSFER", "CASH_OUT", "CASH_IN", "PAYMENT", "DEBIT"]), float(r.randrange(1, 30)) * 10_000, a, b, float(r.randrange(0, 30)) * 10_000, float(r.choice([0, 500, 5000])), 0.0, 0.0, 0))
    return rows


def looped(rows: list[tuple]) -> dict[int, tuple]:
    out, past = {}, []
    for x in rows:
        i, _, t, _, kind, amount, a, b, *_ = x
        near = lambda key, at, s: [p for p in past if p[at] == key and p[2] >= t - s]  # noqa: E731, B023
        sent, got, credit = near(a, 6, 900), near(b, 7, 900), [p for p in near(a, 7, 1800) if p[4] in INBOUND]
        earlier = [p[2] for p in near(a, 6, 3600) if p[2] < t]
        band = [p for p in sent if p[4] == "TRANSFER" and 40_000 <= p[5] <= 90_000]
        in_band = kind == "TRANSFER" and 40_000 <= amount <= 90_000
        out[i] = (
            len(sent) if kind in OUTBOUND else 0, round(sum(p[5] for p in sent), 2) if kind in OUTBOUND else 0.0, len({p[7] for p in sent} | {b}) if kind in OUTBOUND else 0, len(near(a, 6, 3600)), float(t - max(earlier)) if earlier else 86_400.0,
            len(band) + 1 if in_band else 0, len(got) if kind in INBOUND else 0, len({p[6] for p in got} | {a}) if kind in INBOUND else 0, int(kind == "TRANSFER" and not any(p[6] == a and p[7] == b for p in past)),
            round(amount / sum(p[5] for p in credit), 6) if kind == "CASH_OUT" and credit else 0.0,
        )
        past.append(x)
    return out


COLUMNS = ["sender_recent_txn_count", "sender_recent_total_amount", "fan_out_receivers", "velocity_transactions_1h", "time_since_last_purchase", "split_count", "receiver_recent_txn_count", "fan_in_senders", "is_new_counterparty", "inbound_to_cashout_ratio"]


@pytest.mark.parametrize("seed", [1, 2])
def test_history_is_what_a_loop_sees(spark, seed):
    rows = made(200, seed)
    shuffled = rows[:]
    random.Random(0).shuffle(shuffled)
    got = with_history(spark.createDataFrame(shuffled, DDL).repartition(3)).select("event_id", *COLUMNS).collect()
    want = looped(rows)
    assert len(got) == len(rows)
    for r in got:
        assert tuple(round(v, 6) if isinstance(v, float) else v for v in r[1:]) == want[r.event_id], r


def test_a_batch_after_its_history_scores_as_one_run(spark):
    rows = made(150, 5)
    every = score(with_history(spark.createDataFrame(rows, DDL)))
    first, second = spark.createDataFrame(rows[:90], DDL), spark.createDataFrame(rows[90:], DDL)
    last = score_batch(second, first, first.select("name_orig", "name_dest"))
    pick = lambda df: sorted(map(tuple, df.where(F.col("event_id") >= 90).select("event_id", F.array_join("triggered_rules", ","), "risk_score").collect()))
    assert pick(every) == pick(last)


def test_empty_input(spark):
    assert score(with_history(spark.createDataFrame([], DDL))).count() == 0


def row(i, t, kind, amount, a, b, old=0.0, new=0.0):
    return (i, i, t, t // 60, kind, float(amount), a, b, float(old), float(new), 0.0, 0.0, 0)


def rules_of(spark, rows, cfg=CFG):
    return {r.event_id: r for r in score(with_history(spark.createDataFrame(rows, DDL), cfg), cfg).collect()}


def test_drain(spark):
    r = rules_of(spark, [row(1, 60, "TRANSFER", 260_000, "A", "B", 300_000, 100), row(2, 60, "TRANSFER", 260_000, "D", "E", 40_000, 100), row(3, 60, "PAYMENT", 260_000, "F", "G", 300_000, 100)])
    assert "account_drain_near_zero" in r[1].triggered_rules and "account_drain_near_zero" not in r[2].triggered_rules and not r[3].triggered_rules


def test_fan_out_and_structuring(spark):
    cfg = ScreenConfig(fan_out_seconds=600, fan_out_amount=200_000.0, split_amount=220_000.0)
    rows = [row(i, 60 * i, "TRANSFER", a, "C1", f"C{i + 1}") for i, a in ((1, 60_000), (2, 55_000), (3, 50_000), (4, 70_000))]
    last = rules_of(spark, rows, cfg)[4]
    assert {"sender_fan_out_burst", "structured_split_transfer"} <= set(last.triggered_rules) and last.risk_score == pytest.approx(0.285)


def test_fan_in(spark):
    cfg = ScreenConfig(fan_in_seconds=600, fan_in_amount=200_000.0)
    rows = [row(i, 60 * i, "TRANSFER", a, f"S{i}", "C9") for i, a in ((1, 70_000), (2, 80_000), (3, 90_000))]
    assert "receiver_fan_in_burst" in rules_of(spark, rows, cfg)[3].triggered_rules


def test_cash_out_chain_and_window_edge(spark):
    near = rules_of(spark, [row(1, 60, "TRANSFER", 120_000, "X", "C1"), row(2, 1860, "CASH_OUT", 100_000, "C1", "Y")])
    far = rules_of(spark, [row(1, 60, "TRANSFER", 120_000, "X", "C1"), row(2, 1861, "CASH_OUT", 100_000, "C1", "Y")])
    assert "cashout_after_inbound_chain" in near[2].triggered_rules and "cashout_after_inbound_chain" not in far[2].triggered_rules


def test_a_transfer_to_oneself_is_no_credit_of_itself(spark):
    r = rules_of(spark, [row(1, 60, "CASH_OUT", 100_000, "C1", "C1"), row(2, 60, "TRANSFER", 100_000, "C1", "C1"), row(3, 60, "CASH_OUT", 90_000, "C1", "Z")])
    assert r[1].inbound_total == 0 and r[3].inbound_total == 100_000


def test_many_rows_of_one_account_in_one_instant(spark):
    n = 100_000
    i = F.col("id")
    rows = spark.range(n).select(i.alias("event_id"), i.alias("seq"), F.lit(600).cast("long").alias("t"), F.lit(10).alias("step"), F.lit("TRANSFER").alias("txn_type"), F.lit(1.0).alias("amount"), F.lit("C1").alias("name_orig"), F.concat(F.lit("M"), i % 5000).alias("name_dest"), *[F.lit(0.0).alias(c) for c in ("oldbalance_org", "newbalance_org", "oldbalance_dest", "newbalance_dest")], F.lit(0).alias("is_fraud"))
    got = with_history(rows).agg(F.max("fan_out_receivers"), F.max("sender_recent_txn_count"), F.count_if(F.col("fan_out_receivers") == F.least(F.col("event_id") + 1, F.lit(5000)))).first()
    assert tuple(got) == (5000, n - 1, n)


def test_a_hot_account_over_two_hours(spark):
    """Each window reaches an eighth of all rows; sums that are added up anew for each instant would take minutes."""
    import time

    n, i = 300_000, F.col("id")
    rows = spark.range(n).select(i.alias("event_id"), i.alias("seq"), (i * 7200 / n).cast("long").alias("t"), F.lit("TRANSFER").alias("txn_type"), (i % 1000 / 100.0).alias("amount"), F.lit("C1").alias("name_orig"), F.concat(F.lit("M"), i % 5000).alias("name_dest"))
    began = time.monotonic()
    got = sender_history(rows).agg(F.max("sender_recent_txn_count"), F.max("fan_out_receivers"), F.max("sender_recent_total_amount"), F.max("velocity_transactions_1h")).first()
    took = time.monotonic() - began
    per = n / 7200
    assert abs(got[0] - 901 * per) < 2 * per and got[1] == 5000 and abs(got[2] - got[0] * 4.995) < 5000 and abs(got[3] - 3601 * per) < 2 * per
    assert took < 60


def test_history_takes_three_shuffles(spark, data):
    from txscreen.sources.tables import ledger

    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = with_history(ledger(spark, data))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    # by account, by receiver, and the pairs' minima; the join with them may add two where they are too many to broadcast
    assert plan.count("Exchange hashpartitioning") <= 5


def test_amounts_that_are_no_numbers_count_as_nothing(spark):
    rows = [row(1, 60, "TRANSFER", 10, "A", "B"), row(2, 61, "TRANSFER", float("nan"), "A", "B"), row(3, 62, "TRANSFER", float("inf"), "A", "B"), row(4, 63, "TRANSFER", 0.1, "A", "B")]
    got = with_history(spark.createDataFrame(rows, DDL)).where("event_id = 4").first()
    assert got.sender_recent_total_amount == 10.0 and got.sender_recent_txn_count == 3
