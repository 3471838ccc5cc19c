"""Row-local features and small text functions as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TYPES, ScreenConfig

# fixed values: the transaction types of the balance features, and the derived attributes by place
DEBITS = ("TRANSFER", "CASH_OUT", "PAYMENT", "DEBIT")
CREDITS = ("TRANSFER", "CASH_IN")
BROWSERS = ("chrome", "safari", "firefox", "edge")
DEVICES = ("desktop", "mobile", "tablet")
COUNTRIES = ("US", "VN", "SG", "PH", "TH")
FRAUD_LABELS = ("fraud", "confirmed_fraud", "positive", "1", "true")
LEGIT_LABELS = ("legit", "false_positive", "negative", "0", "false", "not_fraud")
UNITS = {"b": 1, "kb": 1e3, "mb": 1e6, "gb": 1e9, "tb": 1e12, "kib": 2**10, "mib": 2**20, "gib": 2**30, "tib": 2**40}


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def share_of(amount: Column, balance: Column) -> Column:
    """amount / balance, 1 at most; without a balance 1 if there is an amount, else 0."""
    return F.when(balance <= 0, F.when(amount > 0, 1.0).otherwise(0.0)).otherwise(F.least(amount / balance, F.lit(1.0)))


def hash_bucket(text: Column, divisor: int, modulus: int) -> Column:
    """(md5 as a 128-bit integer // divisor) % modulus, from its four 32-bit words: no wide integer is needed."""
    whole = divisor * modulus
    rest = reduce(lambda r, k: (r * (1 << 32) + F.conv(F.substring(F.md5(text), 8 * k + 1, 8), 16, 10).cast("long")) % whole, range(4), F.lit(0).cast("long"))
    return F.floor(rest / divisor).cast("int")


def hash_attributes(name: Column) -> dict[str, Column]:
    pick = lambda values, divisor: F.element_at(F.array(*map(F.lit, values)), hash_bucket(name, divisor, len(values)) + 1)
    return {"browser": pick(BROWSERS, 1), "device_type": pick(DEVICES, 4), "country": pick(COUNTRIES, 12)}


def static_features(cfg: ScreenConfig = ScreenConfig()) -> dict[str, Column]:
    kind, amount = F.col("txn_type"), F.col("amount")
    old, new, old_dest, new_dest = (F.col(c) for c in ("oldbalance_org", "newbalance_org", "oldbalance_dest", "newbalance_dest"))
    debit, credit = kind.isin(*DEBITS), kind.isin(*CREDITS)
    hour = F.pmod(F.col("step"), F.lit(24))
    sent, received = F.round(old - amount - new, 2), F.round(old_dest + amount - new_dest, 2)
    return {
        "sender_balance_delta": F.round(old - new, 2), "receiver_balance_delta": F.round(new_dest - old_dest, 2),
        "sender_balance_inconsistent": flag(debit & (F.abs(sent) > cfg.balance_tolerance)), "receiver_balance_inconsistent": flag(credit & (F.abs(received) > cfg.balance_tolerance)),
        "sender_depletion_ratio": share_of(amount, old), "amount_to_balance_ratio": share_of(amount, old + old_dest),
        "is_zero_balance_after": flag(debit & (new == 0)), "is_same_sender_receiver": flag(F.col("name_orig") == F.col("name_dest")),
        "dest_is_merchant": flag(F.col("name_dest").startswith("M")), "hour_of_day": hour, "is_night": flag((hour >= 22) | (hour <= 6)),
        "sender_balance_discrepancy": F.when(debit, sent).otherwise(0.0), "receiver_balance_discrepancy": F.when(credit, received).otherwise(0.0),
    }


def leaky_flags(label: str = "is_fraud", event_id: str = "event_id") -> dict[str, Column]:
    """Synthetic risk flags that read the label. Never part of the default vector; for comparison only."""
    fraud, text = F.col(label) == 1, F.col(event_id).cast("string")
    at = lambda divisor, yes, no: flag(hash_bucket(text, divisor, 100) < F.when(fraud, yes).otherwise(no))
    tries = F.when(fraud, hash_bucket(text, 1, 4)).otherwise(flag(hash_bucket(text, 1, 100) < 5))
    return {"new_device_flag": at(1, 40, 5), "shipping_billing_mismatch": at(100, 30, 2), "ip_billing_country_mismatch": at(10_000, 25, 3), "failed_payment_attempts_24h": tries}


HISTORY_FEATURES = ("sender_recent_txn_count", "sender_recent_total_amount", "receiver_recent_txn_count", "receiver_recent_total_amount", "is_new_counterparty", "inbound_to_cashout_ratio", "velocity_transactions_1h", "time_since_last_purchase")


def one_hots() -> dict[str, Column]:
    """A column of 0 or 1 for each value of the categories, in a fixed order; unknown values are all 0."""
    out = {f"type_{v}": flag(F.col("txn_type") == v) for v in TYPES}
    for column, values in (("browser", BROWSERS), ("device_type", DEVICES), ("country", COUNTRIES)):
        out |= {f"{column}_{v}": flag(F.col(column) == v) for v in values}
    return out


def feature_table(rows: DataFrame, with_leaks: bool = False) -> tuple[DataFrame, list[str]]:
    """Rows with history to the numeric features of a model, and the names of those in vector order."""
    done = rows.withColumns(static_features()).withColumns(hash_attributes(F.col("name_orig")))
    defaults = {c: F.coalesce(F.col(c).cast("double"), F.lit(86_400.0 if c == "time_since_last_purchase" else 0.0)) for c in HISTORY_FEATURES}
    done = done.withColumns(defaults).withColumns(one_hots())
    names = ["amount", "oldbalance_org", "newbalance_org", "oldbalance_dest", "newbalance_dest", *static_features(), *HISTORY_FEATURES]
    if with_leaks:
        done = done.withColumns(leaky_flags())
        names += list(leaky_flags())
    return done, [*names, *one_hots()]


def label_of(text: Column) -> Column:
    """fraud, legit or null."""
    t = F.lower(F.trim(text.cast("string")))
    return F.when(t.isin(*FRAUD_LABELS), "fraud").when(t.isin(*LEGIT_LABELS), "legit")


def alert_flag(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def primary_rule(rules: Column) -> Column:
    return F.coalesce(F.get(rules, F.lit(0)), F.lit("ml_only"))


def run_id(event_id: Column) -> Column:
    """The run of an id `bench:<run>:<id>`, else null."""
    parts = F.split(event_id, ":", 3)
    return F.when((F.get(parts, F.lit(0)) == "bench") & (F.size(parts) == 3), F.get(parts, F.lit(1)))


def utc(text: Column) -> Column:
    """ISO text with an offset or Z to a timestamp, null where it is none."""
    return F.try_to_timestamp(text)


def size_of(text: Column) -> Column:
    """`12.5MiB` or `3%` to a number; null where it is none."""
    number = F.regexp_extract(text, r"^\s*([0-9.]+)\s*([A-Za-z%]*)\s*$", 1).try_cast("double")
    unit = F.lower(F.regexp_extract(text, r"^\s*([0-9.]+)\s*([A-Za-z%]*)\s*$", 2))
    factor = F.create_map(*[F.lit(x) for k, v in {**UNITS, "": 1, "%": 1}.items() for x in (k, float(v))])
    return number * F.try_element_at(factor, unit)


def load_family(file_name: Column) -> Column:
    low = F.lower(file_name)
    has = lambda text: F.contains(low, F.lit(text))
    return F.when(has("low-load"), "low-load").when(has("high-load") | has("trigger-2s-high"), "high-load").when(has("extreme"), "extreme").otherwise("other")


def trigger_label(file_name: Column) -> Column:
    return F.when(F.contains(file_name, F.lit("trigger-2s")), "2s trigger").when(F.contains(file_name, F.lit("20s")), "20s trigger").otherwise("unknown")
