"""From raw messages and ledger text to typed rows, with a reason for each row that fails."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ScreenConfig
from ..functions.scalars import utc
from ..sources.tables import event_time

ENVELOPE = ("kafka_key", "raw_value", "kafka_timestamp", "partition", "offset", "source_topic")
REQUIRED = {
    "transactions": ("event_id", "event_time", "step", "type", "amount", "nameOrig", "nameDest", "isFraud", "schema_version"),
    "sender_state": ("event_id", "source_event_id", "event_time", "step", "nameOrig", "oldbalanceOrg", "newbalanceOrig"),
    "receiver_state": ("event_id", "source_event_id", "event_time", "step", "nameDest", "oldbalanceDest", "newbalanceDest"),
}


def any_null(names: tuple[str, ...], prefix: str = "") -> Column:
    return reduce(lambda a, b: a | b, (F.col(prefix + n).isNull() for n in names), F.lit(False))


def decode(raw: DataFrame, schema: str, required: tuple[str, ...], timestamps: tuple[str, ...] = ("event_time",)) -> DataFrame:
    """raw: ENVELOPE columns. Adds the fields of schema and `error`, null for a valid row.

    A row has one error, the first of json_parse_error, missing_required_fields, invalid_timestamp,
    data_quality_violation (blank id, negative step, amount below 0 or not a number).
    """
    names = T.StructType.fromDDL(schema).fieldNames()
    parsed = raw.withColumn("_p", F.from_json("raw_value", f"{schema}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    rows = parsed.select(*raw.columns, *[F.col(f"_p.{n}").alias(n) for n in names], (F.col("_p").isNull() | F.col("_p._corrupt").isNotNull()).alias("_bad"))
    rows = rows.withColumns({f"_t_{c}": utc(F.col(c)) for c in timestamps})
    late = reduce(lambda a, b: a | b, (F.col(c).isNotNull() & F.col(f"_t_{c}").isNull() for c in timestamps), F.lit(False))
    wrong = F.trim("event_id") == ""
    if "step" in names:
        wrong = wrong | (F.col("step") < 0)
    if "amount" in names:
        wrong = wrong | (F.col("amount") < 0) | F.isnan("amount")
    error = F.when(F.col("_bad"), "json_parse_error").when(any_null(required), "missing_required_fields").when(late, "invalid_timestamp").when(F.coalesce(wrong, F.lit(False)), "data_quality_violation")
    rows = rows.withColumn("error", error).withColumns({c: F.col(f"_t_{c}") for c in timestamps})
    return rows.drop("_bad", *[f"_t_{c}" for c in timestamps])


def dead_letters(rows: DataFrame) -> DataFrame:
    """(key, value) of the rows that decode() found an error in."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("na"))
    key = F.concat_ws(":", "source_topic", F.coalesce("kafka_key", F.lit("null")), part("partition"), part("offset"))
    value = F.to_json(F.struct("source_topic", F.col("kafka_key").alias("source_key"), "partition", "offset", "error", F.col("raw_value"), F.current_timestamp().alias("observed_at")))
    return rows.where("error IS NOT NULL").select(key.alias("key"), value.alias("value"))


def join_dead_letters(rows: DataFrame) -> DataFrame:
    """(key, value) of integration errors: (source_topic, source_key, error, raw_value)."""
    key = F.concat_ws(":", "source_topic", F.coalesce("source_key", F.lit("null")), "error")
    none = F.lit(None)
    value = F.to_json(F.struct("source_topic", "source_key", none.cast("int").alias("partition"), none.cast("long").alias("offset"), "error", "raw_value", F.current_timestamp().alias("observed_at")))
    return rows.select(key.alias("key"), value.alias("value"))


_LEDGER = ("step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud")


def ledger_event_id() -> Column:
    """SHA-1 over the raw text of a ledger row."""
    return F.sha1(F.concat_ws("|", *[F.trim(F.coalesce(c, F.lit(""))) for c in _LEDGER]))


def type_ledger(rows: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Text rows of the ledger to typed transactions; `error` names the first field that isn't a number."""
    numbers = {"step": "int", "amount": "double", "oldbalanceOrg": "double", "newbalanceOrig": "double", "oldbalanceDest": "double", "newbalanceDest": "double", "isFraud": "int"}
    typed = {c: F.trim(c).try_cast(k) for c, k in numbers.items()}
    error = F.coalesce(*[F.when(v.isNull(), F.lit(f"bad_{c}")) for c, v in typed.items()])
    step = typed["step"]
    return rows.select(
        ledger_event_id().alias("event_id"), step.alias("step"), event_time(step, cfg).alias("event_time"), event_time(step, cfg).alias("producer_ts"), F.col("type").alias("txn_type"),
        typed["amount"].alias("amount"), F.col("nameOrig").alias("name_orig"), F.col("nameDest").alias("name_dest"), typed["oldbalanceOrg"].alias("oldbalance_org"), typed["newbalanceOrig"].alias("newbalance_org"),
        typed["oldbalanceDest"].alias("oldbalance_dest"), typed["newbalanceDest"].alias("newbalance_dest"), typed["isFraud"].alias("is_fraud"), F.lit(1).alias("schema_version"), error.alias("error"),
    )


def account_states(tx: DataFrame) -> DataFrame:
    """A sender row and a receiver row for each transaction."""
    i = F.col("event_id").cast("string")
    side = lambda role, name, before, after: F.struct(F.concat(i, F.lit(f":{role}")).alias("event_id"), i.alias("source_event_id"), F.col(name).alias("account_id"), F.lit(role).alias("role"), "step", F.col(before).alias("balance_before"), F.col(after).alias("balance_after"), "event_time")
    both = F.array(side("sender", "name_orig", "oldbalance_org", "newbalance_org"), side("receiver", "name_dest", "oldbalance_dest", "newbalance_dest"))
    return tx.select(F.explode(both).alias("s")).select("s.*")


def wire_feeds(tx: DataFrame) -> dict[str, DataFrame]:
    """The three logical feeds of integrated rows, in the columns and names of the wire."""
    i, when = F.col("event_id").cast("string"), F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    common = [when.alias("event_time"), F.col("step")]
    return {
        "transactions": tx.select(i.alias("event_id"), common[0], when.alias("producer_ts"), "step", F.col("txn_type").alias("type"), "amount", F.col("name_orig").alias("nameOrig"), F.col("name_dest").alias("nameDest"), F.col("is_fraud").alias("isFraud"), F.lit(1).alias("schema_version")),
        "sender_state": tx.select(F.concat(i, F.lit(":sender")).alias("event_id"), i.alias("source_event_id"), *common, F.col("name_orig").alias("nameOrig"), F.col("oldbalance_org").alias("oldbalanceOrg"), F.col("newbalance_org").alias("newbalanceOrig")),
        "receiver_state": tx.select(F.concat(i, F.lit(":receiver")).alias("event_id"), i.alias("source_event_id"), *common, F.col("name_dest").alias("nameDest"), F.col("oldbalance_dest").alias("oldbalanceDest"), F.col("newbalance_dest").alias("newbalanceDest")),
    }


def messages(rows: DataFrame, topic: str, key: str = "event_id") -> DataFrame:
    """Rows as JSON messages with a key, ready for a topic or a file of envelopes."""
    return rows.select(F.col(key).alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"), F.lit(topic).alias("topic"))


def back_typed(rows: DataFrame) -> DataFrame:
    """An integrated payload with its defaults: producer_ts is event_time, schema_version is 1."""
    return rows.withColumn("producer_ts", F.coalesce("producer_ts", "event_time")).withColumn("schema_version", F.coalesce("schema_version", F.lit(1)))


def predictions(scored: DataFrame, version: str = "rules") -> DataFrame:
    """Scored rows as stored predictions; alert_id only for alerts, actual_label unknown."""
    i = F.col("event_id").cast("string")
    return scored.select(
        F.to_date("event_time").alias("day_bucket"), F.col("event_time").alias("event_ts"), i.alias("event_id"), F.col("name_orig").alias("account_id"), "name_dest", "txn_type", "amount",
        "risk_score", "severity", "ml_score", F.lit(version).alias("ml_model_version"), "triggered_rules", "is_alert", F.when(F.col("is_alert"), F.concat(F.lit("alert:"), i)).alias("alert_id"), F.lit(None).cast("string").alias("actual_label"),
    )


def alert_payloads(stored: DataFrame) -> DataFrame:
    names = [c for c in stored.columns if c != "actual_label"]
    return stored.where("is_alert").select(F.col("alert_id").alias("key"), F.to_json(F.struct(*names)).alias("value"))


def score_requests(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Checks and completes rows for batch scoring; `error` names the first broken limit."""
    bad = [
        ("step", (F.col("step") < 0) | F.col("step").isNull()), ("amount", (F.col("amount") < 0) | F.isnan("amount") | F.col("amount").isNull()), ("is_fraud", ~F.coalesce(F.col("is_fraud"), F.lit(0)).between(0, 1)),
        ("schema_version", F.coalesce(F.col("schema_version"), F.lit(1)) < 1), ("name_orig", F.coalesce(F.trim("name_orig"), F.lit("")) == ""), ("name_dest", F.coalesce(F.trim("name_dest"), F.lit("")) == ""),
    ]
    error = F.coalesce(*[F.when(c, F.lit(f"invalid_{n}")) for n, c in bad])
    made = F.sha1(F.concat_ws("|", *[F.col(c).cast("string") for c in ("step", "txn_type", "amount", "name_orig", "oldbalance_org", "newbalance_org", "name_dest", "oldbalance_dest", "newbalance_dest", "is_fraud")]))
    return rows.withColumn("error", error).withColumn("event_time", F.coalesce("event_time", now if now is not None else F.current_timestamp())).withColumn("event_id", F.coalesce(F.col("event_id").cast("string"), made))


def without_history(rows: DataFrame) -> DataFrame:
    """Rows as if nothing had come before: the history columns of a stateless score."""
    zero = dict.fromkeys(("sender_recent_txn_count", "receiver_recent_txn_count", "velocity_transactions_1h", "split_count", "inbound_count"), F.lit(0))
    zero |= dict.fromkeys(("sender_recent_total_amount", "receiver_recent_total_amount", "split_amount", "inbound_total", "inbound_to_cashout_ratio"), F.lit(0.0))
    one = {"fan_out_receivers": F.lit(1), "fan_in_senders": F.lit(1), "is_new_counterparty": (F.col("txn_type") == "TRANSFER").cast("int"), "time_since_last_purchase": F.lit(86_400.0)}
    return rows.withColumns(zero | one)
