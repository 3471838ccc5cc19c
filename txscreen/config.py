"""Settings of the screening rules and of event time."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ScreenConfig:
    # fixed values: the defaults that screening results depend on
    base_epoch: int = 1_767_225_600  # 2026-01-01T00:00:00Z
    step_seconds: int = 60
    balance_tolerance: float = 1.0
    transfer_amount: float = 200_000.0
    cash_out_amount: float = 200_000.0
    rapid_amount: float = 300_000.0
    rapid_count: int = 3
    drain_floor: float = 50_000.0
    drain_ratio: float = 0.8
    drain_near_zero: float = 1_000.0
    drain_weight: float = 0.35
    fan_out_seconds: int = 900
    fan_out_receivers: int = 3
    fan_out_amount: float = 250_000.0
    fan_out_weight: float = 0.25
    fan_in_seconds: int = 900
    fan_in_senders: int = 3
    fan_in_amount: float = 250_000.0
    fan_in_weight: float = 0.25
    split_seconds: int = 900
    split_count: int = 4
    split_low: float = 40_000.0
    split_high: float = 90_000.0
    split_amount: float = 250_000.0
    split_weight: float = 0.30
    counterparty_amount: float = 150_000.0
    counterparty_weight: float = 0.15
    chain_seconds: int = 1_800
    chain_ratio: float = 0.8
    chain_weight: float = 0.40
    velocity_seconds: int = 3_600
    no_history_seconds: float = 86_400.0
    rule_share: float = 0.6
    model_share: float = 0.4
    high_from: float = 0.65
    medium_from: float = 0.35
    model_threshold: float = 0.85


OUTBOUND = ("TRANSFER", "CASH_OUT")
INBOUND = ("TRANSFER", "CASH_IN")
TYPES = ("TRANSFER", "CASH_OUT", "CASH_IN", "PAYMENT", "DEBIT")
#: Names of the rules, in the order in which a row lists them.
RULES = (
    "account_drain_near_zero",
    "sender_fan_out_burst",
    "receiver_fan_in_burst",
    "structured_split_transfer",
    "new_counterparty_large_transfer",
    "cashout_after_inbound_chain",
)
