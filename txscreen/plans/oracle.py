"""SQL over the same tables, for a database to check the registered queries with."""

from __future__ import annotations

from ..config import RULES, ScreenConfig
from ..functions.scalars import BROWSERS, COUNTRIES, CREDITS, DEBITS, DEVICES, TYPES
from ..operators.monitoring import EXACT_ROWS, POLICY
from ..operators.rules import STATE_FIELDS

C = ScreenConfig()
#: The wider structuring band of the query.
WIDE = ScreenConfig(split_low=10_000.0, split_high=150_000.0, split_count=3, split_amount=100_000.0)

TX = f"""tx0 AS (
  SELECT event_id, CAST(event_id // 60 AS INTEGER) AS step,
    CASE event_type WHEN 'purchase' THEN 'TRANSFER' WHEN 'click' THEN 'CASH_OUT' WHEN 'signup' THEN 'CASH_IN' WHEN 'view' THEN 'PAYMENT' WHEN 'error' THEN 'DEBIT' END AS txn_type,
    round(value * 1000, 2) AS amount, 'C' || (user_id % 200) AS name_orig,
    CASE WHEN event_id % 5 = 0 THEN 'M' || (event_id % 50) ELSE 'C' || ((user_id * 7 + event_id) % 200) END AS name_dest,
    CAST((event_id * 7919) % 300 AS DOUBLE) * 1000 AS oldbalance_org, CAST((event_id * 104729) % 200 AS DOUBLE) * 1000 AS oldbalance_dest
  FROM events),
tx AS (
  SELECT *, {C.base_epoch} + step * 60 AS t,
    CASE WHEN txn_type = 'CASH_IN' THEN oldbalance_org + amount ELSE greatest(oldbalance_org - amount, 0.0) END AS newbalance_org,
    CASE WHEN event_id % 11 = 0 THEN oldbalance_dest ELSE oldbalance_dest + amount END AS newbalance_dest,
    CAST(txn_type IN ('TRANSFER', 'CASH_OUT') AND event_id % 17 = 0 AS INTEGER) AS is_fraud
  FROM tx0)"""

_BEFORE = "(b.t < a.t OR (b.t = a.t AND b.event_id < a.event_id))"


#: The ledger twice over, as the load has it.
_LOAD = TX.replace("\ntx AS (", "\nseed AS (") + """,
numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i FROM seed), all_ AS (SELECT count(*) AS m FROM seed), k AS (SELECT unnest(range((SELECT 2 * m FROM all_))) AS k),
tx AS (SELECT k.k AS event_id, CAST(step + k.k // m AS INTEGER) AS step, txn_type, amount, name_orig || '_' || (k.k % 1000) AS name_orig, name_dest || '_' || (k.k % 1000) AS name_dest, oldbalance_org, oldbalance_dest, t + k.k AS t, newbalance_org, newbalance_dest, is_fraud
  FROM all_, k JOIN numbered ON numbered.i = k.k % (SELECT m FROM all_))"""


def history(cfg: ScreenConfig = C, tx: str = TX) -> str:
    """History by joins of the ledger with itself: what is before a row, tie by tie."""
    band = f"BETWEEN {cfg.split_low} AND {cfg.split_high}"
    near = f"b.t >= a.t - {cfg.fan_out_seconds}"
    split = f"b.txn_type = 'TRANSFER' AND b.amount {band} AND b.t >= a.t - {cfg.split_seconds}"
    return f"""{tx},
snd AS (SELECT a.event_id, count(b.event_id) FILTER (WHERE {near}) AS n900, coalesce(sum(b.amount) FILTER (WHERE {near}), 0) AS s900, count(b.event_id) AS n3600,
    max(b.t) FILTER (WHERE b.t < a.t) AS last_t, count(DISTINCT b.name_dest) FILTER (WHERE {near} AND b.name_dest <> a.name_dest) + 1 AS receivers,
    count(b.event_id) FILTER (WHERE {split}) + 1 AS split_n, coalesce(sum(b.amount) FILTER (WHERE {split}), 0) + any_value(a.amount) AS split_s
  FROM tx a LEFT JOIN tx b ON a.name_orig = b.name_orig AND b.t >= a.t - {cfg.velocity_seconds} AND {_BEFORE} GROUP BY a.event_id),
rcv AS (SELECT a.event_id, count(b.event_id) AS n, coalesce(sum(b.amount), 0) AS s, count(DISTINCT b.name_orig) FILTER (WHERE b.name_orig <> a.name_orig) + 1 AS senders
  FROM tx a LEFT JOIN tx b ON a.name_dest = b.name_dest AND b.t >= a.t - {cfg.fan_in_seconds} AND {_BEFORE} GROUP BY a.event_id),
inb AS (SELECT a.event_id, coalesce(sum(b.amount), 0) AS s
  FROM tx a LEFT JOIN tx b ON a.name_orig = b.name_dest AND b.txn_type IN ('TRANSFER', 'CASH_IN') AND b.t >= a.t - {cfg.chain_seconds} AND {_BEFORE} GROUP BY a.event_id),
pair AS (SELECT event_id, row_number() OVER (PARTITION BY name_orig, name_dest ORDER BY t, event_id) AS r FROM tx),
hist AS (SELECT tx.*, txn_type IN ('TRANSFER', 'CASH_OUT') AS outbound, txn_type IN ('TRANSFER', 'CASH_IN') AS inbound, txn_type = 'TRANSFER' AND amount {band} AS banded,
    snd.n900, snd.s900, snd.n3600, snd.last_t, snd.receivers, snd.split_n, snd.split_s, rcv.n AS rcv_n, rcv.s AS rcv_s, rcv.senders, inb.s AS inb_s, txn_type = 'TRANSFER' AND pair.r = 1 AS is_new
  FROM tx JOIN snd USING (event_id) JOIN rcv USING (event_id) JOIN inb USING (event_id) JOIN pair USING (event_id))"""


def scored(cfg: ScreenConfig = C, tx: str = TX) -> str:
    flags = ", ".join(f"CASE WHEN f{i} THEN '{n}' END" for i, n in enumerate(RULES))
    w = (cfg.drain_weight, cfg.fan_out_weight, cfg.fan_in_weight, cfg.split_weight, cfg.counterparty_weight, cfg.chain_weight)
    clear = " * ".join(f"CASE WHEN f{i} THEN CAST({1 - x!r} AS DOUBLE) ELSE 1.0 END" for i, x in enumerate(w))
    return f"""{history(cfg, tx)},
flags AS (SELECT *,
    outbound AND oldbalance_org >= {cfg.drain_floor} AND amount / nullif(oldbalance_org, 0) >= {cfg.drain_ratio} AND newbalance_org <= {cfg.drain_near_zero} AS f0,
    outbound AND receivers >= {cfg.fan_out_receivers} AND round(s900 + amount, 2) >= {cfg.fan_out_amount} AS f1,
    inbound AND senders >= {cfg.fan_in_senders} AND round(rcv_s + amount, 2) >= {cfg.fan_in_amount} AS f2,
    banded AND split_n >= {cfg.split_count} AND round(split_s, 2) >= {cfg.split_amount} AS f3,
    is_new AND amount >= {cfg.counterparty_amount} AS f4,
    txn_type = 'CASH_OUT' AND inb_s > 0 AND amount / nullif(inb_s, 0) >= {cfg.chain_ratio} AS f5 FROM hist),
risked AS (SELECT *, list_filter([{flags}], lambda x: x IS NOT NULL) AS rules, least({cfg.rule_share} * (1 - CAST({clear} AS DOUBLE)), 1.0) AS risk FROM flags),
scored AS (SELECT *, round(CAST(risk AS DOUBLE), 4) AS risk_score, CASE WHEN risk >= {cfg.high_from} THEN 'high' WHEN risk >= {cfg.medium_from} THEN 'medium' ELSE 'low' END AS severity, len(rules) > 0 AS is_alert FROM risked),
alerts AS (SELECT *, 'alert:' || event_id AS alert_id, coalesce(rules[1], 'ml_only') AS primary_rule,
    CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'closed' ELSE 'escalated' END ELSE 'new' END AS review_status,
    CASE WHEN event_id % 3 = 0 THEN CASE WHEN is_fraud = 1 THEN 'confirmed_fraud' ELSE 'false_positive' END ELSE 'unlabeled' END AS review_label FROM scored WHERE is_alert)"""


_LABELED = f"""{scored()},
labeled AS (SELECT *, CASE WHEN is_alert AND event_id % 3 = 0 THEN CASE WHEN is_fraud = 1 THEN 'fraud' ELSE 'legit' END END AS label, t + CASE WHEN is_alert AND event_id % 3 = 0 THEN 3600 ELSE 0 END AS eval_t FROM scored)"""
_CONFUSION = """count(label) AS labeled_rows, count(*) FILTER (is_alert AND label = 'fraud') AS tp, count(*) FILTER (is_alert AND label = 'legit') AS fp,
  count(*) FILTER (NOT is_alert AND label = 'legit') AS tn, count(*) FILTER (NOT is_alert AND label = 'fraud') AS fn"""
_RATES = """round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
  round(CASE WHEN tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0) > 0 THEN 2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / (tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0)) END, 6) AS f1,
  round(fp / nullif(fp + tn, 0), 6) AS false_positive_rate"""

_SCORE = f"""{TX},
ws AS (SELECT *, floor((CASE WHEN oldbalance_org + oldbalance_dest <= 0 THEN CASE WHEN amount > 0 THEN 1.0 ELSE 0.0 END ELSE least(amount / nullif(oldbalance_org + oldbalance_dest, 0), 1.0) END) * 10000) / 10000 AS score FROM tx),
grp AS (SELECT score, count(*) AS n, count(*) FILTER (is_fraud = 1) AS pos, count(*) FILTER (is_fraud = 0) AS neg, coalesce(sum(amount) FILTER (is_fraud = 1), 0) AS amount FROM ws GROUP BY score),
run AS (SELECT *, sum(n) OVER w AS rn, sum(pos) OVER w AS rp, sum(neg) OVER w AS rneg, sum(amount) OVER w AS ra, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn, sum(amount) OVER () AS ta FROM grp WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def _ks(column: str) -> str:
    # the exact p-value is a sum of binomials where both sides have equally many rows, as the two halves have
    return f"""SELECT '{column}' AS feature, round(d, 6) AS ks_statistic,
  round(CASE WHEN greatest(n, m) <= {EXACT_ROWS} AND n = m THEN CASE WHEN round(d * n) = 0 THEN 1.0 ELSE least(1.0, 2 * list_sum(list_transform(range(1, CAST(n // round(d * n) AS BIGINT) + 1), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(2 * lgamma(n + 1) - lgamma(n - k * round(d * n) + 1) - lgamma(n + k * round(d * n) + 1))))) END
    WHEN z <= 0.04 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * z * z))))) END, 6) AS ks_pvalue,
  round(mr, 6) AS reference_mean, round(ms, 6) AS serving_mean, round(ms - mr, 6) AS mean_delta, d >= 0.2 AS drift_detected
FROM (SELECT *, d * sqrt(n * m / (n + m)) AS z FROM (
  SELECT max(abs(cr / n - cs / m)) AS d, any_value(n) AS n, any_value(m) AS m, any_value(mr) AS mr, any_value(ms) AS ms FROM (
    SELECT sum(r) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS cr, sum(s) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS cs, CAST(sum(r) OVER () AS DOUBLE) AS n, CAST(sum(s) OVER () AS DOUBLE) AS m, sum(r * v) OVER () / sum(r) OVER () AS mr, sum(s * v) OVER () / sum(s) OVER () AS ms
    FROM (SELECT CAST({column} AS DOUBLE) AS v, count(*) FILTER (event_id % 2 = 0) AS r, count(*) FILTER (event_id % 2 = 1) AS s FROM scored2 GROUP BY 1))))"""


_HALVES = f"{scored()}, scored2 AS (SELECT *, 0.0 AS ml_score FROM scored)"
_MIX = """mixed AS (SELECT feature, category, count(*) FILTER (event_id % 2 = 0) / CAST(any_value(n0) AS DOUBLE) AS reference, count(*) FILTER (event_id % 2 = 1) / CAST(any_value(n1) AS DOUBLE) AS serving FROM (
  SELECT event_id, unnest(['txn_type', 'severity', 'is_alert']) AS feature, unnest([txn_type, severity, CAST(is_alert AS VARCHAR)]) AS category FROM scored2),
  (SELECT count(*) FILTER (event_id % 2 = 0) AS n0, count(*) FILTER (event_id % 2 = 1) AS n1 FROM scored2) GROUP BY feature, category)"""
_DRIFT = f"""{_HALVES}, {_MIX}, ks AS ({" UNION ALL ".join(_ks(c) for c in ("amount", "risk_score", "ml_score"))}),
tvd AS (SELECT feature, 0.5 * sum(abs(reference - serving)) AS d FROM mixed GROUP BY feature),
drift AS (SELECT feature, 'ks_statistic' AS metric, ks_statistic AS observed, drift_detected FROM ks UNION ALL SELECT feature, 'total_variation_distance', round(d, 6), d >= 0.1 FROM tvd)"""

_STATIC = f"""CAST(txn_type IN {DEBITS} AS INTEGER) AS debit, CAST(txn_type IN {CREDITS} AS INTEGER) AS credit, round(oldbalance_org - amount - newbalance_org, 2) AS sent, round(oldbalance_dest + amount - newbalance_dest, 2) AS received, step % 24 AS h"""


def _share(amount: str, balance: str) -> str:
    return f"CASE WHEN {balance} <= 0 THEN CASE WHEN {amount} > 0 THEN 1.0 ELSE 0.0 END ELSE least({amount} / nullif({balance}, 0), 1.0) END"


_FEATURES = f"""SELECT event_id, round(oldbalance_org - newbalance_org, 2) AS sender_balance_delta, round(newbalance_dest - oldbalance_dest, 2) AS receiver_balance_delta,
  CAST(debit = 1 AND abs(sent) > 1.0 AS BIGINT) AS sender_balance_inconsistent, CAST(credit = 1 AND abs(received) > 1.0 AS BIGINT) AS receiver_balance_inconsistent,
  floor(({_share("amount", "oldbalance_org")}) * 1e6) / 1e6 AS sender_depletion_ratio, floor(({_share("amount", "(oldbalance_org + oldbalance_dest)")}) * 1e6) / 1e6 AS amount_to_balance_ratio,
  CAST(debit = 1 AND newbalance_org = 0 AS BIGINT) AS is_zero_balance_after, CAST(name_orig = name_dest AS BIGINT) AS is_same_sender_receiver, CAST(name_dest LIKE 'M%' AS BIGINT) AS dest_is_merchant,
  CAST(h AS BIGINT) AS hour_of_day, CAST(h >= 22 OR h <= 6 AS BIGINT) AS is_night, CASE WHEN debit = 1 THEN sent ELSE 0.0 END AS sender_balance_discrepancy, CASE WHEN credit = 1 THEN received ELSE 0.0 END AS receiver_balance_discrepancy
FROM (SELECT *, {_STATIC} FROM {{source}})"""


def _pick(values: tuple[str, ...], divisor: int) -> str:
    """The md5 as a big-endian number, folded from four words."""
    rest = "0"
    for k in range(4):
        rest = f"(({rest} * 4294967296 + CAST('0x' || substr(md5(name_orig), {8 * k + 1}, 8) AS BIGINT)) % {divisor * len(values)})"
    return f"[{', '.join(repr(v) for v in values)}][CAST({rest} // {divisor} AS INTEGER) + 1]"


def _fold() -> str:
    names = sorted({f for x in STATE_FIELDS.values() for f in x})
    kinds = [*STATE_FIELDS, "amount_threshold", "watchlist_update", "unknown_rule"]
    fields = ", ".join(f"CASE WHEN (event_id + {k}) % 3 = 0 THEN round(value, 2) END AS {f}" for k, f in enumerate(names))
    return f"""log AS (SELECT event_id AS off, [{", ".join(repr(k) for k in kinds)}][CAST(event_id % {len(kinds)} AS INTEGER) + 1] AS kind, CASE WHEN event_id % 4 < 2 THEN 'TRANSFER' ELSE 'CASH_OUT' END AS txn, 'C' || user_id AS account_id,
  CASE WHEN event_id % 7 < 3 THEN 'remove' WHEN event_id % 7 < 6 THEN 'add' END AS operation, {fields} FROM events)"""


def _state() -> str:
    rows = []
    for kind, names in STATE_FIELDS.items():
        for f, setting in names.items():
            whole = isinstance(getattr(C, setting), int)
            value = f"arg_max({f}, off) FILTER (kind = '{kind}' AND {f} IS NOT NULL)"
            rows.append(f"SELECT '{setting}' AS setting, CAST(coalesce({f'trunc({value})' if whole else value}, {getattr(C, setting)}) AS DOUBLE) AS value FROM log")
    for txn, setting in (("TRANSFER", "transfer_amount"), ("CASH_OUT", "cash_out_amount")):
        rows.append(f"SELECT '{setting}', CAST(coalesce(arg_max(coalesce(threshold, {C.transfer_amount}), off) FILTER (kind = 'amount_threshold' AND txn = '{txn}'), {getattr(C, setting)}) AS DOUBLE) FROM log")
    return f"WITH {_fold()} " + " UNION ALL ".join(rows)


_WATCH = f"{_fold()}, watch AS (SELECT account_id FROM (SELECT account_id, arg_max(coalesce(operation, 'add'), off) AS op FROM log WHERE kind = 'watchlist_update' GROUP BY account_id) WHERE op <> 'remove')"


def _windows(size: int, slide: int) -> str:
    return f"""wm AS (SELECT start_s, count(*) AS event_count, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, sum(amount) AS total_amount FROM (
  SELECT tx.*, unnest(range(t // {slide} * {slide} - {size - slide}, t // {slide} * {slide} + 1, {slide})) AS start_s FROM tx) WHERE start_s >= (SELECT min(t) // {slide} * {slide} FROM tx) GROUP BY start_s)"""


_WIRE = f"""{TX},
s AS (SELECT event_id, step, name_orig, t + CASE WHEN event_id % 29 = 0 THEN 30 WHEN event_id % 31 = 0 THEN 31 ELSE 0 END AS st, CASE WHEN event_id % 23 = 0 THEN event_id || '-missing' ELSE CAST(event_id AS VARCHAR) END AS source FROM tx WHERE event_id % 13 <> 0),
r AS (SELECT event_id, step, CASE WHEN event_id % 19 = 0 THEN name_dest || '-MISMATCH' ELSE name_dest END AS name_dest, t AS rt, CAST(event_id AS VARCHAR) AS source FROM tx WHERE event_id % 17 <> 0),
cls AS (SELECT tx.*, CASE WHEN s.event_id IS NULL THEN 'missing_sender_state' WHEN r.event_id IS NULL THEN 'missing_receiver_state' WHEN r.name_dest = tx.name_dest AND s.name_orig = tx.name_orig THEN 'integrated' ELSE 'semantic_key_mismatch' END AS status
  FROM tx LEFT JOIN s ON s.source = CAST(tx.event_id AS VARCHAR) AND abs(st - t) <= 30 LEFT JOIN r ON r.source = CAST(tx.event_id AS VARCHAR) AND abs(rt - t) <= 30)"""
_DECODE = """CASE event_id % 20 WHEN 0 THEN 'json_parse_error' WHEN 1 THEN 'missing_required_fields' WHEN 2 THEN 'invalid_timestamp' WHEN 3 THEN 'data_quality_violation' WHEN 4 THEN 'data_quality_violation' WHEN 5 THEN 'data_quality_violation' WHEN 6 THEN 'data_quality_violation' END"""
_TRACKED = "trk AS (SELECT event_id, 'p' || (event_id % 3) AS profile, CASE WHEN event_id % 50 <> 0 THEN CAST(event_id * 37 % 1000 + event_id * 91 % 3000 AS DOUBLE) END AS ms FROM events)"
_CENTS = "CAST(round({} * 100) AS BIGINT)"
_TYPED = "CASE WHEN event_id % 11 = 0 THEN 'bad_amount' WHEN event_id % 13 = 0 THEN 'bad_isFraud' ELSE 'valid' END"


def _feature_totals() -> str:
    static = [c for c in ("sender_balance_delta", "receiver_balance_delta", "sender_balance_inconsistent", "receiver_balance_inconsistent", "sender_depletion_ratio", "amount_to_balance_ratio", "is_zero_balance_after", "is_same_sender_receiver", "dest_is_merchant", "hour_of_day", "is_night", "sender_balance_discrepancy", "receiver_balance_discrepancy")]
    exact = {"sender_depletion_ratio": _share("amount", "oldbalance_org"), "amount_to_balance_ratio": _share("amount", "(oldbalance_org + oldbalance_dest)")}
    sums = {c: exact.get(c, f"fx.{c}") for c in ("amount", "oldbalance_org", "newbalance_org", "oldbalance_dest", "newbalance_dest")}
    sums = {c: c for c in sums} | {c: exact.get(c, f"fx.{c}") for c in static}
    sums |= {"sender_recent_txn_count": "CASE WHEN outbound THEN n900 ELSE 0 END", "sender_recent_total_amount": "CASE WHEN outbound THEN s900 ELSE 0 END", "receiver_recent_txn_count": "CASE WHEN inbound THEN rcv_n ELSE 0 END", "receiver_recent_total_amount": "CASE WHEN inbound THEN rcv_s ELSE 0 END"}
    sums |= {"is_new_counterparty": "CAST(is_new AS INTEGER)", "inbound_to_cashout_ratio": "CASE WHEN txn_type = 'CASH_OUT' AND inb_s > 0 THEN amount / inb_s ELSE 0 END", "velocity_transactions_1h": "n3600", "time_since_last_purchase": f"coalesce(t - last_t, {C.no_history_seconds})"}
    sums |= {f"type_{v}": f"CAST(txn_type = '{v}' AS INTEGER)" for v in TYPES}
    for column, values, divisor in (("browser", BROWSERS, 1), ("device_type", DEVICES, 4), ("country", COUNTRIES, 12)):
        sums |= {f"{column}_{v}": f"CAST({_pick(values, divisor)} = '{v}' AS INTEGER)" for v in values}
    body = " UNION ALL ".join(f"SELECT '{n}' AS feature, round(CAST(sum({e}) AS DOUBLE), 1) AS total FROM hist JOIN fx USING (event_id)" for n, e in sums.items())
    return f"WITH {history()}, fx AS MATERIALIZED ({_FEATURES.format(source='tx')}) {body}"


SQL: dict[str, str] = {
    "sender_velocity": f"WITH {history()} SELECT event_id, CASE WHEN outbound THEN n900 ELSE 0 END AS sender_recent_txn_count, CASE WHEN outbound THEN round(s900, 2) ELSE 0.0 END AS sender_recent_total_amount, n3600 AS velocity_transactions_1h FROM hist",
    "receiver_velocity": f"WITH {history()} SELECT event_id, CASE WHEN inbound THEN rcv_n ELSE 0 END AS receiver_recent_txn_count, CASE WHEN inbound THEN round(rcv_s, 2) ELSE 0.0 END AS receiver_recent_total_amount FROM hist",
    "time_since_last": f"WITH {history()} SELECT event_id, CAST(coalesce(t - last_t, {C.no_history_seconds}) AS DOUBLE) AS time_since_last_purchase FROM hist",
    "fan_out_burst": f"WITH {scored()} SELECT event_id, receivers, round(s900 + amount, 2) AS total FROM scored WHERE f1",
    "fan_in_burst": f"WITH {scored()} SELECT event_id, senders, round(rcv_s + amount, 2) AS total FROM scored WHERE f2",
    "structured_split": f"WITH {scored(WIDE)} SELECT event_id, split_n AS transfers, round(split_s, 2) AS total FROM scored WHERE f3",
    "new_counterparty": f"WITH {history()} SELECT event_id, name_orig, name_dest, amount FROM hist WHERE is_new",
    "cashout_chain": f"WITH {scored()} SELECT event_id, round(inb_s, 2) AS inbound_total, round(amount / inb_s, 6) AS ratio FROM scored WHERE f5",
    "account_drain": f"WITH {scored()} SELECT event_id, name_orig, amount, oldbalance_org FROM scored WHERE f0",
    "risk_score": f"WITH {scored()} SELECT event_id, array_to_string(rules, ',') AS rules, risk_score, severity, is_alert FROM scored",
    "alerts_by_severity": f"WITH {scored()} SELECT severity, count(*) AS alerts, round(sum(amount), 2) AS amount FROM alerts GROUP BY severity",
    "alerts_by_rule": f"WITH {scored()} SELECT rule, count(*) AS alerts, round(sum(amount), 2) AS amount FROM (SELECT unnest(rules) AS rule, amount FROM alerts) GROUP BY rule",
    "rule_state_fold": _state(),
    "watchlist_state": f"WITH {_WATCH} SELECT account_id FROM watch",
    "watchlist_hits": f"WITH {TX}, {_WATCH} SELECT name_orig IN (SELECT account_id FROM watch) AS on_watchlist, count(*) AS events FROM tx GROUP BY 1",
    "static_features": f"WITH {TX} {_FEATURES.format(source='tx')}",
    "hash_attributes": f"WITH {TX} SELECT DISTINCT name_orig, {_pick(BROWSERS, 1)} AS browser, {_pick(DEVICES, 4)} AS device_type, {_pick(COUNTRIES, 12)} AS country FROM tx",
    "event_id_sha1": f"WITH {TX} SELECT event_id AS seq, sha1(concat_ws('|', step, txn_type, {_CENTS.format('amount')}, name_orig, {_CENTS.format('oldbalance_org')}, {_CENTS.format('newbalance_org')}, name_dest, {_CENTS.format('oldbalance_dest')}, {_CENTS.format('newbalance_dest')}, is_fraud)) AS event_id FROM tx",
    "typed_ledger": f"WITH {TX} SELECT {_TYPED} AS error, count(*) AS events, CAST(sum(step) AS BIGINT) AS steps FROM tx GROUP BY 1",
    "decode_errors": f"SELECT coalesce({_DECODE}, 'valid') AS error, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS offsets FROM events GROUP BY 1",
    "decode_dead_letters": f"SELECT 'transactions:' || event_id || ':' || (event_id % 6) || ':' || event_id AS key, {_DECODE} AS error, CAST(event_id AS VARCHAR) AS source_key FROM events WHERE event_id % 20 <= 6",
    "integrate_triplets": f"WITH {_WIRE} SELECT event_id, t, txn_type, amount, name_orig, name_dest, oldbalance_org, newbalance_dest, is_fraud FROM cls WHERE status = 'integrated'",
    "dead_letters": f"""WITH {_WIRE} SELECT CASE WHEN status = 'semantic_key_mismatch' THEN 'integrated_join' ELSE 'transactions' END AS source_topic, CAST(event_id AS VARCHAR) AS source_key, status AS error FROM cls WHERE status <> 'integrated'
UNION ALL SELECT 'sender_state', event_id || ':sender', 'orphan_sender_state' FROM s WHERE NOT EXISTS (SELECT 1 FROM tx WHERE CAST(tx.event_id AS VARCHAR) = s.source AND abs(st - t) <= 30)
UNION ALL SELECT 'receiver_state', event_id || ':receiver', 'orphan_receiver_state' FROM r WHERE NOT EXISTS (SELECT 1 FROM tx WHERE CAST(tx.event_id AS VARCHAR) = r.source AND abs(rt - t) <= 30)""",
    "strict_matches": f"WITH {_WIRE} SELECT CASE WHEN st <> t THEN 'event_time_mismatch' WHEN r.name_dest <> tx.name_dest THEN 'nameDest_mismatch' ELSE 'match' END AS reason, count(*) AS events FROM tx JOIN s ON s.source = CAST(tx.event_id AS VARCHAR) JOIN r ON r.source = CAST(tx.event_id AS VARCHAR) GROUP BY 1",
    "triplet_errors": f"""WITH {_WIRE} SELECT id AS event_id, CAST(sum(a) AS BIGINT) AS in_tx, CAST(sum(b) AS BIGINT) AS in_sender, CAST(sum(c) AS BIGINT) AS in_receiver FROM (
  SELECT CAST(event_id AS VARCHAR) AS id, 1 AS a, 0 AS b, 0 AS c FROM tx UNION ALL SELECT source, 0, 1, 0 FROM s UNION ALL SELECT source, 0, 0, 1 FROM r) GROUP BY id HAVING NOT (sum(a) = sum(b) AND sum(a) = sum(c))""",
    "account_states": f"""WITH {TX} SELECT account_id, role, count(*) AS updates, round(sum(c), 2) AS change FROM (
  SELECT name_orig AS account_id, 'sender' AS role, newbalance_org - oldbalance_org AS c FROM tx UNION ALL SELECT name_dest, 'receiver', newbalance_dest - oldbalance_dest FROM tx) GROUP BY 1, 2""",
    "request_errors": f"""WITH {TX} SELECT error, count(*) AS events, count(*) FILTER (
    (txn_type IN ('TRANSFER', 'CASH_OUT') AND oldbalance_org >= {C.drain_floor} AND a / nullif(oldbalance_org, 0) >= {C.drain_ratio} AND newbalance_org <= {C.drain_near_zero}) OR (txn_type = 'TRANSFER' AND a >= {C.counterparty_amount})) AS alerts
  FROM (SELECT *, CASE WHEN event_id % 41 = 0 THEN 'invalid_amount' WHEN event_id % 43 = 0 THEN 'invalid_name_dest' ELSE 'valid' END AS error, CASE WHEN event_id % 41 = 0 THEN -amount ELSE amount END AS a FROM tx) GROUP BY error""",
    "tumbling_metrics": f"WITH {TX}, {_windows(300, 300)} SELECT start_s, event_count, fraud_count, round(total_amount, 2) AS total_amount, round(fraud_count / event_count, 6) AS fraud_rate FROM wm",
    "sliding_metrics": f"WITH {TX}, {_windows(600, 300)} SELECT start_s, event_count, fraud_count, round(total_amount, 2) AS total_amount, round(fraud_count / event_count, 6) AS fraud_rate FROM wm",
    "confusion_metrics": f"WITH {_LABELED}, c AS (SELECT {_CONFUSION} FROM labeled) SELECT labeled_rows, tp, fp, tn, fn, {_RATES} FROM c",
    "rolling_performance": f"WITH {_LABELED}, c AS (SELECT days, end_s, {_CONFUSION} FROM labeled, (SELECT unnest([1, 7, 30]) AS days), (SELECT max(eval_t) AS end_s FROM labeled) WHERE eval_t >= end_s - days * 86400 GROUP BY days, end_s) SELECT days, end_s, labeled_rows, tp, fp, tn, fn, {_RATES} FROM c",
    "label_sources": f"WITH {_LABELED} SELECT count(*) AS prediction_rows, count(label) AS labeled_rows, CAST(0 AS BIGINT) AS from_actual_label, count(label) AS from_review_label, count(*) - count(label) AS from_unlabeled, round(count(label) / count(*), 6) AS label_coverage, CASE WHEN count(label) = 0 THEN 'no_labels' WHEN count(*) FILTER (NOT is_alert AND label IS NOT NULL) = 0 THEN 'no_labeled_negatives' ELSE '' END AS warnings FROM labeled",
    "numeric_drift_ks": f"WITH {_HALVES} {_ks('amount')} UNION ALL {_ks('risk_score')}",
    "categorical_drift_tvd": f"WITH {_HALVES}, {_MIX} SELECT feature, round(0.5 * sum(abs(reference - serving)), 6) AS total_variation_distance, 0.5 * sum(abs(reference - serving)) >= 0.1 AS drift_detected FROM mixed GROUP BY feature",
    "category_distributions": f"WITH {_HALVES}, {_MIX} SELECT feature, category, round(reference, 6) AS reference, round(serving, 6) AS serving FROM mixed",
    "reference_summary": f"WITH {_HALVES} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM scored2 WHERE event_id % 2 = 0" for c in ("amount", "risk_score", "ml_score")),
    "reference_rates": f"WITH {scored()} SELECT count(*) AS rows, round(avg(CAST(is_alert AS INTEGER)), 6) AS alert_rate, round(avg(is_fraud), 6) AS label_rate FROM scored",
    "reference_dataset": f"""WITH {TX}, f AS (SELECT *, txn_type IN ('TRANSFER', 'CASH_OUT') AND oldbalance_org >= {C.drain_floor} AND amount / nullif(oldbalance_org, 0) >= {C.drain_ratio} AND newbalance_org <= {C.drain_near_zero} AS f0, txn_type = 'TRANSFER' AND amount >= {C.counterparty_amount} AS f4 FROM tx),
r AS (SELECT *, {C.rule_share} * (1 - (CASE WHEN f0 THEN CAST({1 - C.drain_weight!r} AS DOUBLE) ELSE 1.0 END) * (CASE WHEN f4 THEN CAST({1 - C.counterparty_weight!r} AS DOUBLE) ELSE 1.0 END)) AS risk FROM f)
SELECT event_id, CASE WHEN risk >= {C.high_from} THEN 'high' WHEN risk >= {C.medium_from} THEN 'medium' ELSE 'low' END AS severity, round(CAST(risk AS DOUBLE), 4) AS risk_score, coalesce(f0, false) OR f4 AS is_alert, is_fraud AS label_is_fraud FROM r""",
    "smoke_summary": f"""WITH {scored()}, {_windows(300, 300)} SELECT (SELECT count(*) FROM scored) AS events, (SELECT count(*) FROM alerts) AS alerts, (SELECT string_agg(event_id, ',' ORDER BY t, event_id) FROM (SELECT event_id, t FROM alerts ORDER BY t, event_id LIMIT 10)) AS first_alerts, (SELECT string_agg(event_count, ',' ORDER BY start_s) FROM (SELECT * FROM wm ORDER BY start_s LIMIT 5)) AS first_windows""",
    "drift_table": f"WITH {_DRIFT} SELECT * FROM drift",
    "retraining_reasons": f"""WITH {_DRIFT}, labeled AS (SELECT *, CASE WHEN is_alert AND event_id % 3 = 0 THEN CASE WHEN is_fraud = 1 THEN 'fraud' ELSE 'legit' END END AS label, t + CASE WHEN is_alert AND event_id % 3 = 0 THEN 3600 ELSE 0 END AS eval_t FROM scored),
c AS (SELECT {_CONFUSION} FROM labeled WHERE eval_t >= (SELECT max(eval_t) FROM labeled) - 7 * 86400), w AS (SELECT labeled_rows, {_RATES} FROM c),
obs AS (SELECT 'drift_ratio' AS type, (SELECT count(*) FILTER (drift_detected) / count(*) FROM drift) AS observed, '>=' AS op, CAST({POLICY["feature_drift_ratio_threshold"]} AS DOUBLE) AS threshold
  UNION ALL SELECT 'amount_drift', (SELECT observed FROM drift WHERE feature = 'amount'), '>=', {POLICY["amount_ks_stat_threshold"]}
  UNION ALL SELECT 'alert_rate_change', (SELECT abs(serving - reference) FROM mixed WHERE feature = 'is_alert' AND category = 'true'), '>=', {POLICY["alert_rate_change_threshold"]}
  UNION ALL SELECT 'label_coverage', (SELECT round(count(label) / count(*), 6) FROM labeled), '<', {POLICY["label_coverage_min"]}
  UNION ALL SELECT 'precision_7d', (SELECT precision FROM w WHERE labeled_rows >= {POLICY["minimum_labeled_rows_7d"]}), '<', {POLICY["precision_7d_min"]}
  UNION ALL SELECT 'recall_7d', (SELECT recall FROM w WHERE labeled_rows >= {POLICY["minimum_labeled_rows_7d"]}), '<', {POLICY["recall_7d_min"]}
  UNION ALL SELECT 'f1_7d', (SELECT f1 FROM w WHERE labeled_rows >= {POLICY["minimum_labeled_rows_7d"]}), '<', {POLICY["f1_7d_min"]})
SELECT type, round(observed, 6) AS observed, threshold FROM obs WHERE CASE WHEN op = '>=' THEN observed >= threshold ELSE observed < threshold END""",
    "review_queue": f"WITH {scored()} SELECT alert_id, severity, risk_score, review_status, review_label, primary_rule FROM alerts WHERE severity IN ('high', 'medium')",
    "unreviewed_alerts": f"WITH {scored()} SELECT primary_rule, count(*) AS alerts FROM alerts WHERE review_status = 'new' GROUP BY 1",
    "queue_kpis": f"WITH {scored()} SELECT count(*) FILTER (review_status IN ('new', 'in_review')) AS open, count(*) FILTER (review_label = 'confirmed_fraud') AS confirmed, count(*) FILTER (review_label = 'false_positive') AS false_positive, count(*) FILTER (review_status = 'escalated') AS escalated, count(*) FILTER (review_status = 'new') AS new FROM alerts",
    "alert_kpis": f"WITH {scored()} SELECT count(*) AS total_alerts, count(*) FILTER (severity = 'high') AS high_alerts, round(count(*) FILTER (severity = 'high') / count(*), 6) AS high_share, round(avg(risk_score), 6) AS mean_risk, round(sum(amount), 2) AS at_risk_amount FROM alerts",
    "top_rules": f"WITH {scored()} SELECT rule, count(*) AS alerts, round(sum(amount), 2) AS amount FROM (SELECT unnest(rules) AS rule, amount FROM alerts) GROUP BY rule ORDER BY 2 DESC, 3 DESC, 1 LIMIT 3",
    "type_mix": f"WITH {scored()} SELECT txn_type, count(*) AS alerts, round(sum(amount), 2) AS amount FROM alerts GROUP BY 1",
    "recent_cases": f"WITH {scored()} SELECT alert_id, t, alert_id = 'alert:1' AS selected FROM alerts ORDER BY t DESC, alert_id LIMIT 100",
    "unpivot_metrics": f"WITH {TX}, {_windows(3600, 3600)} SELECT start_s, unnest(['event_count', 'fraud_count', 'total_amount']) AS metric, unnest([round(CAST(event_count AS DOUBLE), 2), round(CAST(fraud_count AS DOUBLE), 2), round(total_amount, 2)]) AS value FROM wm",
    "eda_type_fraud": f"WITH {TX} SELECT txn_type, count(*) AS events, CAST(sum(is_fraud) AS BIGINT) AS frauds, min(amount) AS min_amount, max(amount) AS max_amount, round(avg(amount), 4) AS mean_amount FROM tx GROUP BY 1",
    "eda_by_class": f"WITH {TX}, c AS (SELECT is_fraud, count(*) AS events, min(amount) AS min_amount, max(amount) AS max_amount, round(avg(amount), 4) AS mean_amount FROM tx GROUP BY 1) SELECT is_fraud, events, round(events / sum(events) OVER (), 6) AS share, round(max(events) OVER () / events, 6) AS imbalance, min_amount, max_amount, mean_amount FROM c",
    "review_status_mix": f"WITH {scored()} SELECT review_status, count(*) AS alerts, round(sum(amount), 2) AS amount FROM alerts GROUP BY 1",
    "review_label_mix": f"WITH {scored()} SELECT review_label, count(*) AS alerts, round(sum(amount), 2) AS amount FROM alerts GROUP BY 1",
    "hot_alerts": f"WITH {scored()} SELECT alert_id, severity, CASE severity WHEN 'high' THEN 'critical' WHEN 'medium' THEN 'warning' ELSE 'info' END AS label FROM alerts WHERE t >= (SELECT max(t) FROM tx) - 3600",
    "alert_messages": f"WITH {scored()} SELECT alert_id AS key, CAST(event_id AS VARCHAR) AS event_id, name_orig AS account_id, severity, CAST(NULL AS VARCHAR) AS actual_label FROM alerts",
    "metric_messages": f"WITH {TX}, {_windows(300, 300)} SELECT 'tumbling:' || strftime(make_timestamp(CAST(start_s AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') AS key, event_count, fraud_count FROM wm",
    "step_profile": f"WITH {TX} SELECT step, count(*) AS events FROM tx GROUP BY 1",
    "fraud_listing": f"WITH {TX} SELECT event_id, step, txn_type, amount FROM tx WHERE is_fraud = 1",
    "feature_correlation": f"WITH {TX} " + " UNION ALL ".join(f"SELECT '{a}' AS row, '{b}' AS column, round(corr({a}, {b}), 6) AS value FROM tx" for a in ("amount", "oldbalance_org", "newbalance_org", "oldbalance_dest", "is_fraud") for b in ("amount", "oldbalance_org", "newbalance_org", "oldbalance_dest", "is_fraud")),
    "business_cost": f"""WITH {scored()}, b AS (SELECT coalesce(sum(amount) FILTER (is_fraud = 1 AND NOT is_alert), 0) AS missed, count(*) FILTER (is_fraud = 0 AND is_alert) AS fp, count(*) FILTER (is_fraud = 1 AND NOT is_alert) AS fn, coalesce(sum(amount) FILTER (is_fraud = 1), 0) AS base FROM scored)
SELECT round(missed + 5.0 * fp, 2) AS business_cost, round(missed, 2) AS missed_fraud_cost, round(CAST(5.0 * fp AS DOUBLE), 2) AS false_alarm_total_cost, round(base, 2) AS no_model_baseline_cost, round(base - missed - 5.0 * fp, 2) AS net_cost_savings, round((base - missed - 5.0 * fp) / nullif(base, 0), 4) AS savings_rate, fp AS false_positives, fn AS false_negatives FROM b""",
    "cost_threshold_sweep": f"WITH {_SCORE}, c AS (SELECT score AS threshold, round(ta - ra + 5.0 * rneg, 2) AS cost FROM run UNION ALL SELECT NULL, round(any_value(ta), 2) FROM run) SELECT (SELECT threshold FROM c ORDER BY cost, coalesce(threshold, 1e308) DESC LIMIT 1) AS threshold, min(cost) AS cost, count(*) AS evaluated_thresholds FROM c",
    "f1_threshold_sweep": f"WITH {_SCORE}, c AS (SELECT score, rp / rn AS p, rp / tp AS r, 2 * (rp / rn) * (rp / tp) / (rp / rn + rp / tp + 1e-8) AS f FROM run) SELECT score AS threshold, round(f, 6) AS f1, round(p, 6) AS precision, round(r, 6) AS recall FROM c ORDER BY round(f, 12) DESC, score LIMIT 1",
    "average_precision": f"WITH {_SCORE} SELECT round(sum(pos / tp * rp / rn), 6) AS average_precision, round(sum(neg * (rp - pos / 2)) / any_value(CAST(tp AS DOUBLE) * tn), 6) AS auc_roc FROM run",
    "pr_curve": f"WITH {_SCORE} SELECT score AS threshold, round(rp / rn, 6) AS precision, round(rp / tp, 6) AS recall, round(rneg / tn, 6) AS false_positive_rate FROM run",
    "class_report": f"""WITH {_SCORE}, c AS (SELECT l, count(*) FILTER (is_fraud = l AND CAST(score >= 0.5 AS INTEGER) = l) AS tp, count(*) FILTER (CAST(score >= 0.5 AS INTEGER) = l) AS pred, count(*) FILTER (is_fraud = l) AS support FROM ws, (SELECT unnest([0, 1]) AS l) GROUP BY l),
m AS (SELECT CAST(l AS VARCHAR) AS label, coalesce(tp / nullif(pred, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r, support FROM c), f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM m)
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM f UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
    "stratified_split": f"""WITH {TX}, r AS (SELECT event_id, is_fraud, (row_number() OVER (PARTITION BY is_fraud ORDER BY substr(md5('42:' || event_id), 1, 15), event_id) - 1) / CAST(count(*) OVER (PARTITION BY is_fraud) AS DOUBLE) AS q FROM tx)
SELECT event_id, is_fraud, CASE WHEN q < 0.6 THEN 'train' WHEN q < CAST(0.6 AS DOUBLE) + CAST(0.2 AS DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM r""",
    "balanced_sample": f"""WITH {TX}, r AS (SELECT event_id, is_fraud, CAST('0x' || substr(md5('42:' || event_id), 1, 15) AS BIGINT) AS place FROM tx)
SELECT * FROM r WHERE is_fraud = 1 UNION ALL SELECT * FROM (SELECT * FROM r WHERE is_fraud = 0 ORDER BY place, event_id LIMIT (SELECT count(*) FROM r WHERE is_fraud = 1))""",
    "amount_histogram": f"""WITH {TX}, e AS (SELECT is_fraud, min(amount) AS lo, max(amount) AS hi FROM tx GROUP BY 1),
c AS (SELECT is_fraud, CAST(CASE WHEN hi > lo THEN least(floor((amount - lo) / (hi - lo) * 50) + 1, 50) ELSE 1 END AS INTEGER) AS bin, count(*) AS n FROM tx JOIN e USING (is_fraud) GROUP BY 1, 2)
SELECT is_fraud, bin, coalesce(n, 0) AS n FROM (SELECT is_fraud, CAST(unnest(range(1, 51)) AS INTEGER) AS bin FROM e) LEFT JOIN c USING (is_fraud, bin)""",
    "feature_table": _feature_totals(),
    "amplified_events": f"""WITH {TX}, n AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS m FROM tx), k AS (SELECT unnest(range((SELECT 2 * count(*) + 7 FROM tx))) AS k, (SELECT count(*) FROM tx) AS m)
SELECT k.k AS seq, sha1(concat_ws(':', n.event_id, k.k, k.k // k.m, k.k)) AS event_id, CAST(n.step + k.k // k.m AS INTEGER) AS step, n.t + k.k AS t, n.name_orig || '_' || (k.k % 1000) AS name_orig, n.name_dest || '_' || (k.k % 1000) AS name_dest, n.amount FROM k JOIN n ON n.i = k.k % k.m""",
    "load_profile": f"WITH {scored(tx=_LOAD)}, {_windows(300, 300)}, {_windows(600, 300).replace('wm AS', 'slid AS', 1)} SELECT (SELECT count(*) FROM scored) AS events, (SELECT count(*) FROM alerts) AS alerts, (SELECT count(*) FROM wm) AS tumbling, (SELECT count(*) FROM slid) AS sliding",
    "latency_percentiles": f"WITH {_TRACKED} SELECT profile, round(min(ms), 4) AS min, round(avg(ms), 4) AS mean, round(quantile_cont(ms, 0.5), 4) AS p50, round(quantile_cont(ms, 0.95), 4) AS p95, round(quantile_cont(ms, 0.99), 4) AS p99, round(max(ms), 4) AS max FROM trk GROUP BY 1",
    "latency_profiles": f"WITH {_TRACKED} SELECT profile, count(*) AS events, count(ms) AS succeeded, count(*) - count(ms) AS timed_out, round(count(ms) / count(*), 6) AS success_rate FROM trk GROUP BY 1",
    "resource_summary": """SELECT 'svc' || (user_id % 5) AS name, count(*) AS samples, round(avg(value), 4) AS cpu_avg, round(max(value), 4) AS cpu_max, round(avg(floor(value) * 1048576), 4) AS memory_avg, round(max(floor(value) * 1048576), 4) AS memory_max,
  CAST((max(event_id) - min(event_id)) * 3 AS DOUBLE) AS network_rx, CAST((max(event_id) - min(event_id)) * 2 AS DOUBLE) AS network_tx, CAST(greatest(0, max(event_id) % 100 - min(event_id) % 100) AS DOUBLE) AS block_read, CAST(0 AS DOUBLE) AS block_write FROM events GROUP BY 1""",
    "trigger_rate_pivot": """SELECT CASE event_id % 4 WHEN 0 THEN '2s trigger' WHEN 3 THEN 'unknown' ELSE '20s trigger' END AS trigger, CASE event_id % 4 WHEN 0 THEN 'high-load' WHEN 1 THEN 'low-load' WHEN 2 THEN 'extreme' ELSE 'other' END AS family,
  max(value) FILTER (event_id % 3 = 0) AS rate_50, max(value) FILTER (event_id % 3 = 1) AS rate_200, max(value) FILTER (event_id % 3 = 2) AS rate_500 FROM events GROUP BY 1, 2""",
}
