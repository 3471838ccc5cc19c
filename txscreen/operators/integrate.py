"""Transactions with both account states: joins within a time tolerance, and what doesn't fit.

Dead-letter precedence: a transaction without its sender state is only that, whatever else is
missing; states are orphans if no transaction has their id at a fitting time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE_S = 30


def _within(a: Column, b: Column, seconds: int) -> Column:
    tolerance = F.expr(f"INTERVAL {seconds} SECONDS")  # a literal: the watermark of a join needs one
    return (b >= a - tolerance) & (b <= a + tolerance)


def sides(tx: DataFrame, sender: DataFrame, receiver: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decoded feeds with a prefix for each side, only the columns that the join needs."""
    t = tx.select(F.col("event_id").alias("tx_event_id"), F.col("event_time").alias("tx_time"), "producer_ts", F.col("step").alias("tx_step"), F.col("type").alias("txn_type"), "amount", F.col("nameOrig").alias("name_orig"), F.col("nameDest").alias("name_dest"), F.col("isFraud").alias("is_fraud"), "schema_version")
    s = sender.select(F.col("event_id").alias("s_event_id"), F.col("source_event_id").alias("s_source"), F.col("event_time").alias("s_time"), F.col("step").alias("s_step"), F.col("nameOrig").alias("s_name"), F.col("oldbalanceOrg").alias("oldbalance_org"), F.col("newbalanceOrig").alias("newbalance_org"))
    r = receiver.select(F.col("event_id").alias("r_event_id"), F.col("source_event_id").alias("r_source"), F.col("event_time").alias("r_time"), F.col("step").alias("r_step"), F.col("nameDest").alias("r_name"), F.col("oldbalanceDest").alias("oldbalance_dest"), F.col("newbalanceDest").alias("newbalance_dest"))
    return t, s, r


def classified(tx: DataFrame, sender: DataFrame, receiver: DataFrame, seconds: int = TOLERANCE_S) -> DataFrame:
    """tx left-joined with both states, and `status`: integrated or the reason why not. One plan, also for streams.

    The receiver join asks for a sender, so that a row that misses both is missing_sender_state once.
    """
    t, s, r = sides(tx, sender, receiver)
    both = t.join(s, (t["tx_event_id"] == s["s_source"]) & _within(t["tx_time"], s["s_time"], seconds), "leftOuter")
    both = both.join(r, (F.col("tx_event_id") == F.col("r_source")) & _within(F.col("tx_time"), F.col("r_time"), seconds) & F.col("s_event_id").isNotNull(), "leftOuter")
    fits = (F.col("tx_step") == F.col("s_step")) & (F.col("name_orig") == F.col("s_name")) & (F.col("tx_step") == F.col("r_step")) & (F.col("name_dest") == F.col("r_name"))
    status = F.when(F.col("s_event_id").isNull(), "missing_sender_state").when(F.col("r_event_id").isNull(), "missing_receiver_state").when(fits, "integrated").otherwise("semantic_key_mismatch")
    return both.withColumn("status", status).drop("s_time", "r_time")  # a stream has one event time


def integrated(rows: DataFrame) -> DataFrame:
    """The 14 columns of an integrated transaction."""
    return rows.where("status = 'integrated'").select(F.col("tx_event_id").alias("event_id"), F.col("tx_time").alias("event_time"), "producer_ts", F.col("tx_step").alias("step"), "txn_type", "amount", "name_orig", "oldbalance_org", "newbalance_org", "name_dest", "oldbalance_dest", "newbalance_dest", "is_fraud", "schema_version")


def join_errors(rows: DataFrame) -> DataFrame:
    """(source_topic, source_key, error, raw_value) of the classified rows that don't integrate."""
    topic = F.when(F.col("status") == "semantic_key_mismatch", "integrated_join").otherwise("transactions")
    return rows.where("status <> 'integrated'").select(topic.alias("source_topic"), F.col("tx_event_id").alias("source_key"), F.col("status").alias("error"), F.to_json(F.struct("tx_event_id", "tx_step", "name_orig", "name_dest", "amount")).alias("raw_value"))


def orphans(state: DataFrame, tx: DataFrame, role: str, seconds: int = TOLERANCE_S, streaming: bool = False) -> DataFrame:
    """States that no transaction asks for. A stream has no anti join, so it takes the outer join's null rows."""
    own = state.select(F.col("event_id").alias("o_event_id"), F.col("source_event_id").alias("o_source"), F.col("event_time").alias("o_time"), F.col("step").alias("o_step"))
    t = tx.select(F.col("event_id").alias("t_event_id"), F.col("event_time").alias("t_time"))
    fits = (own["o_source"] == t["t_event_id"]) & _within(t["t_time"], own["o_time"], seconds)
    left = own.join(t, fits, "leftOuter").where("t_event_id IS NULL") if streaming else own.join(t, fits, "left_anti")
    return left.select(F.lit(f"{role}_state").alias("source_topic"), F.col("o_event_id").alias("source_key"), F.lit(f"orphan_{role}_state").alias("error"), F.to_json(F.struct("o_event_id", "o_source", "o_step")).alias("raw_value"))


def all_join_errors(tx: DataFrame, sender: DataFrame, receiver: DataFrame, seconds: int = TOLERANCE_S) -> DataFrame:
    return join_errors(classified(tx, sender, receiver, seconds)).unionByName(orphans(sender, tx, "sender", seconds)).unionByName(orphans(receiver, tx, "receiver", seconds))


def strict_match(tx: DataFrame, sender: DataFrame, receiver: DataFrame) -> DataFrame:
    """Equal ids, times, steps and names on all sides; `reason` says what differs first, null where nothing does."""
    t, s, r = sides(tx, sender, receiver)
    rows = t.join(s, t["tx_event_id"] == s["s_source"]).join(r, t["tx_event_id"] == r["r_source"])
    differs = [("event_time", (F.col("tx_time") != F.col("s_time")) | (F.col("tx_time") != F.col("r_time"))), ("step", (F.col("tx_step") != F.col("s_step")) | (F.col("tx_step") != F.col("r_step"))), ("nameOrig", F.col("name_orig") != F.col("s_name")), ("nameDest", F.col("name_dest") != F.col("r_name"))]
    return rows.withColumn("reason", F.coalesce(*[F.when(c, F.lit(f"{n}_mismatch")) for n, c in differs]))


def triplet_errors(tx: DataFrame, sender: DataFrame, receiver: DataFrame) -> DataFrame:
    """(event_id, in_tx, in_sender, in_receiver) of the ids that aren't in all three feeds."""
    mark = lambda rows, key, name: rows.groupBy(F.col(key).alias("event_id")).agg(F.count(F.lit(1)).alias(name))
    every = mark(tx, "event_id", "in_tx").join(mark(sender, "source_event_id", "in_sender"), "event_id", "fullouter").join(mark(receiver, "source_event_id", "in_receiver"), "event_id", "fullouter")
    every = every.na.fill(0, ["in_tx", "in_sender", "in_receiver"])
    return every.where("NOT (in_tx = in_sender AND in_tx = in_receiver)")


def expected_letters(expected: DataFrame, seen: DataFrame) -> DataFrame:
    """expected (case, source_key, error) with ok: whether a dead letter (source_key, error) was seen."""
    found = seen.select("source_key", "error").distinct().withColumn("_seen", F.lit(True))
    return expected.join(found, ["source_key", "error"], "left").withColumn("ok", F.coalesce("_seen", F.lit(False))).drop("_seen")
