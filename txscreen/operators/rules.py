"""Rules, risk and alerts as columns; rule state folded from a changelog."""

from __future__ import annotations

from dataclasses import fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import INBOUND, OUTBOUND, RULES, ScreenConfig


def fired(cfg: ScreenConfig = ScreenConfig()) -> dict[str, Column]:
    """For each rule, whether a row with history fires it."""
    kind, amount, old = F.col("txn_type"), F.col("amount"), F.col("oldbalance_org")
    drained = kind.isin(*OUTBOUND) & (old >= cfg.drain_floor) & (old > 0) & (F.try_divide(amount, old) >= cfg.drain_ratio) & (F.col("newbalance_org") <= cfg.drain_near_zero)
    out = kind.isin(*OUTBOUND) & (F.col("fan_out_receivers") >= cfg.fan_out_receivers) & (F.round(F.col("sender_recent_total_amount") + amount, 2) >= cfg.fan_out_amount)
    into = kind.isin(*INBOUND) & (F.col("fan_in_senders") >= cfg.fan_in_senders) & (F.round(F.col("receiver_recent_total_amount") + amount, 2) >= cfg.fan_in_amount)
    split = (F.col("split_count") >= cfg.split_count) & (F.round("split_amount", 2) >= cfg.split_amount)
    new = (F.col("is_new_counterparty") == 1) & (amount >= cfg.counterparty_amount)
    chain = (kind == "CASH_OUT") & (F.col("inbound_total") > 0) & (F.col("inbound_to_cashout_ratio") >= cfg.chain_ratio)
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in zip(RULES, (drained, out, into, split, new, chain), strict=True)}


def weights(cfg: ScreenConfig) -> dict[str, float]:
    return dict(zip(RULES, (cfg.drain_weight, cfg.fan_out_weight, cfg.fan_in_weight, cfg.split_weight, cfg.counterparty_weight, cfg.chain_weight), strict=True))


def score(rows: DataFrame, cfg: ScreenConfig = ScreenConfig(), ml: Column | None = None, ml_threshold: float | None = None) -> DataFrame:
    """Adds triggered_rules, rule_score, ml_score, risk_score, severity and is_alert to rows with history.

    ml is an unrounded probability. It is compared as it is and rounded in the output only.
    """
    hit, w = fired(cfg), weights(cfg)
    clear = F.lit(1.0)
    for name in RULES:
        clear = clear * F.when(hit[name], 1 - w[name]).otherwise(1.0)
    names = F.array_compact(F.array(*[F.when(hit[n], F.lit(n)) for n in RULES]))
    p = F.lit(0.0) if ml is None else F.coalesce(ml, F.lit(0.0))
    rows = rows.withColumn("triggered_rules", names).withColumn("rule_score", 1 - clear).withColumn("_ml", p)
    risk = F.least(cfg.rule_share * F.col("rule_score") + cfg.model_share * F.col("_ml"), F.lit(1.0))
    rows = rows.withColumn("_risk", risk)
    severity = F.when(F.col("_risk") >= cfg.high_from, "high").when(F.col("_risk") >= cfg.medium_from, "medium").otherwise("low")
    limit = cfg.model_threshold if ml_threshold is None else ml_threshold
    alert = (F.size("triggered_rules") > 0) | (F.col("_ml") >= limit)
    return rows.withColumn("severity", severity).withColumn("is_alert", alert).withColumn("ml_score", F.round("_ml", 4)).withColumn("risk_score", F.round("_risk", 4)).drop("_ml", "_risk")


#: The fields that a rule type can set, by the name of the field in a message.
STATE_FIELDS = {
    "account_drain_threshold": {"min_balance_floor": "drain_floor", "ratio_threshold": "drain_ratio", "near_zero_balance": "drain_near_zero", "weight": "drain_weight"},
    "fan_out_threshold": {"window_seconds": "fan_out_seconds", "distinct_receiver_threshold": "fan_out_receivers", "total_amount_threshold": "fan_out_amount", "weight": "fan_out_weight"},
    "fan_in_threshold": {"window_seconds": "fan_in_seconds", "distinct_sender_threshold": "fan_in_senders", "total_amount_threshold": "fan_in_amount", "weight": "fan_in_weight"},
    "structuring_threshold": {"window_seconds": "split_seconds", "count_threshold": "split_count", "min_amount": "split_low", "max_amount": "split_high", "total_amount_threshold": "split_amount", "weight": "split_weight"},
    "new_counterparty_threshold": {"amount_threshold": "counterparty_amount", "weight": "counterparty_weight"},
    "cashout_after_inbound_threshold": {"window_seconds": "chain_seconds", "ratio_threshold": "chain_ratio", "weight": "chain_weight"},
    "velocity_threshold": {"threshold": "rapid_amount", "count_threshold": "rapid_count"},
}
_WHOLE = {f.name for f in fields(ScreenConfig) if f.type == "int"}


def fold_rules(log: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """One row: each setting as the last message that has it says, else its default.

    log: (offset, rule_type, txn_type and the fields of STATE_FIELDS). Unknown types are ignored. Fields may
    be text: where a message has a field of its type that is no number, the whole state is the defaults.
    """
    number = lambda f: F.col(f).try_cast("double")
    bad = F.lit(False)
    for rule, names in [*STATE_FIELDS.items(), ("amount_threshold", ("threshold",))]:
        broken = [F.col(f).isNotNull() & number(f).isNull() for f in names if f in log.columns]
        bad = bad | ((F.lower(F.trim("rule_type")) == rule) & reduce(lambda a, b: a | b, broken, F.lit(False)))
    whole = F.coalesce(~F.bool_or(bad), F.lit(True))
    kind, at = F.lower(F.trim("rule_type")), F.col("offset")
    out = []
    for rule, names in STATE_FIELDS.items():
        for field, setting in names.items():
            said = (kind == rule) & F.col(field).isNotNull()
            default = F.lit(getattr(cfg, setting))
            last = F.when(whole, F.max_by(F.when(said, number(field)), F.when(said, at)))
            out.append(F.coalesce(last.cast("int" if setting in _WHOLE else "double"), default).alias(setting))
    for txn, setting in (("TRANSFER", "transfer_amount"), ("CASH_OUT", "cash_out_amount")):
        said = (kind == "amount_threshold") & (F.upper("txn_type") == txn)
        value = F.coalesce(number("threshold"), F.lit(cfg.transfer_amount))
        out.append(F.coalesce(F.when(whole, F.max_by(F.when(said, value), F.when(said, at))), F.lit(getattr(cfg, setting))).alias(setting))
    return log.agg(*out)


def fold_watchlist(log: DataFrame) -> DataFrame:
    """(account_id): accounts whose last operation isn't remove."""
    rows = log.where((F.lower(F.trim("rule_type")) == "watchlist_update") & (F.trim("account_id") != ""))
    last = rows.groupBy(F.trim("account_id").alias("account_id")).agg(F.max_by(F.lower(F.trim(F.coalesce("operation", F.lit("add")))), "offset").alias("op"))
    return last.where("op <> 'remove'").select("account_id")


def overlay(state: DataFrame | None, cfg: ScreenConfig = ScreenConfig()) -> ScreenConfig:
    """The settings that one folded row says; its values become literals of the plan. No state: the defaults."""
    row = state.first() if state is not None else None
    return cfg if row is None else replace(cfg, **{k: v for k, v in row.asDict().items() if v is not None})


def flag_watchlist(rows: DataFrame, watchlist: DataFrame, account: str = "name_orig") -> DataFrame:
    """Adds on_watchlist; it is reported and never scored."""
    listed = watchlist.select(F.col("account_id").alias("_listed")).distinct()
    return rows.join(listed, rows[account] == F.col("_listed"), "left").withColumn("on_watchlist", F.col("_listed").isNotNull()).drop("_listed")


def default_rules(spark: SparkSession, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """The rule set as changelog rows: rule_id, rule_type, severity and a map of settings."""
    severity = ("high", "medium", "medium", "high", "medium", "medium")
    kinds = list(STATE_FIELDS)[:6]
    rows = [(f"{name}_v1", k, s, {f: float(getattr(cfg, c)) for f, c in STATE_FIELDS[k].items()}) for name, k, s in zip(RULES, kinds, severity, strict=True)]
    return spark.createDataFrame(rows, "rule_id string, rule_type string, severity string, settings map<string,double>")
