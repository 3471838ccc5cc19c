"""Features from an account's earlier transactions, exact among rows of the same instant.

The history of a row is what its key did before: at an earlier instant within the window, or at the
same instant with a smaller seq. In the order (t, seq) that is all rows before it less those from before the
reach, so a sum over the history is the difference of two growing sums: Spark keeps both as running values,
and the work for each row is the same however many rows a window holds. A sliding frame would add up its
rows anew for each instant. Amounts are summed as decimals, so that differences are exact.

A key's rows are cut into slices of time of SPAN longest windows, and the rows of a slice's last window also
visit the next slice as context. A window then sorts little more than a slice of one key, never its whole
life, which splits an account that holds a large part of all rows over as many tasks as it has slices.

Rows are shuffled once for what their sender did and received, once for what their receiver got, and the
first rows of pairs are minima, combined before a shuffle, that the rows meet by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import INBOUND, OUTBOUND, ScreenConfig

#: Longest windows that a slice of time has.
SPAN = 4
#: Amounts within a sum.
MONEY = "decimal(28,4)"


def sliced(rows: DataFrame, seconds: int, span: int = SPAN) -> DataFrame:
    """Adds slice and own: each row stands in its slice, and the last `seconds` of a slice in the next one too, as context with own = false."""
    length = seconds * span
    at = F.floor(F.col("t") / length)
    near = F.col("t") >= (at + 1) * length - seconds
    own, context = F.struct(at.alias("slice"), F.lit(True).alias("own")), F.struct((at + 1).alias("slice"), F.lit(False).alias("own"))
    return rows.select("*", F.inline(F.when(near, F.array(own, context)).otherwise(F.array(own))))


def money(c: str | Column) -> Column:
    """An amount as a decimal; what is no finite number counts as nothing."""
    return (F.col(c) if isinstance(c, str) else c).try_cast(MONEY)


class Line:
    """A key's rows in the order (t, ...), and growing frames of them: all before a row, and all from before a reach."""

    def __init__(self, key: str, *order: str) -> None:
        self.key, self.order = (key, "slice"), order
        line = Window.partitionBy(*self.key)
        self.by_row, self.by_time = line.orderBy("t", *order), line.orderBy("t")
        #: All rows before a row.
        self.before = self.by_row.rowsBetween(Window.unboundedPreceding, -1)
        self._past: dict[int, WindowSpec] = {}

    def dealt(self, rows: DataFrame, seconds: int) -> DataFrame:
        """rows in slices, shuffled once for all that follows."""
        return sliced(rows, seconds).repartition(*self.key)

    def past(self, seconds: int) -> WindowSpec:
        """The rows of all instants more than `seconds` ago."""
        if seconds not in self._past:
            self._past[seconds] = self.by_time.rangeBetween(Window.unboundedPreceding, -seconds - 1)
        return self._past[seconds]

    def total(self, value: Column, seconds: int) -> Column:
        """The sum of a value over the history."""
        value = F.sum(value)
        return F.coalesce(value.over(self.before), F.lit(0)) - F.coalesce(value.over(self.past(seconds)), F.lit(0))

    def marked(self, rows: DataFrame, value: str, seconds: int, which: Column | None = None) -> DataFrame:
        """Adds whether the row's value was there within the last `seconds`, and whether it comes again within them; only for the rows `which`."""
        w = Window.partitionBy(*self.key, value).orderBy("t", *self.order)
        again = lambda c: F.coalesce((c <= seconds) & (F.lit(True) if which is None else which), F.lit(False))
        return rows.withColumns({"_repeats": again(F.col("t") - F.lag("t").over(w)), "_repeated": again(F.lead("t").over(w) - F.col("t"))})

    def distinct(self, seconds: int, count: Column) -> Column:
        """For marked rows, how many values the history and the row itself have; count: the rows of both. No set is built.

        Of the rows in reach, those whose value came before in reach don't count. Such a pair of neighbours
        lies within `seconds`, so of all pairs that end by now only those that begin before the reach
        are out of it, and every pair that begins there has ended.
        """
        ended = F.count_if("_repeats").over(self.by_row.rowsBetween(Window.unboundedPreceding, 0))
        return (count - ended + F.count_if("_repeated").over(self.past(seconds))).cast("int")


def _account_history(tx: DataFrame, cfg: ScreenConfig, credited: bool) -> DataFrame:
    """tx with what the sender did before and, if credited, what it received: both by the account, in one shuffle.

    A credit is a row of role 1 on the account that it goes to. It sorts behind the row that it is of, so a
    transfer to oneself is no history of itself.
    """
    rows = tx.withColumns({"account": F.col("name_orig"), "credit": F.lit(None).cast("double"), "role": F.lit(0)})
    reach = max(cfg.velocity_seconds, cfg.fan_out_seconds, cfg.split_seconds)
    if credited:
        kept = [F.col(c) if c in ("t", "seq") else F.lit(None).cast(tx.schema[c].dataType).alias(c) for c in tx.columns]
        rows = rows.unionByName(tx.where(F.col("txn_type").isin(*INBOUND)).select(*kept, F.col("name_dest").alias("account"), F.col("amount").alias("credit"), F.lit(1).alias("role")))
        reach = max(reach, cfg.chain_seconds)
    line, own = Line("account", "seq", "role"), F.col("role") == 0
    rows = line.marked(line.dealt(rows, reach), "name_dest", cfg.fan_out_seconds, own)
    amount, one, band = money("amount"), F.when(own, 1), own & in_band(cfg)
    recent = line.total(one, cfg.fan_out_seconds)
    sums = {
        "_n": recent, "_sum": line.total(amount, cfg.fan_out_seconds), "_hour": line.total(one, cfg.velocity_seconds), "_values": line.distinct(cfg.fan_out_seconds, recent + 1),
        "_band": line.total(F.when(band, 1), cfg.split_seconds), "_banded": line.total(F.when(band, amount), cfg.split_seconds), "_last": F.max(F.when(own, F.col("t"))).over(line.past(0)),
    }
    if credited:
        sums |= {"_credits": line.total(F.when(~own, 1), cfg.chain_seconds), "_credited": line.total(money("credit"), cfg.chain_seconds)}
    return rows.withColumns(sums).where("own AND role = 0")


def in_band(cfg: ScreenConfig) -> Column:
    return F.coalesce((F.col("txn_type") == "TRANSFER") & F.col("amount").between(cfg.split_low, cfg.split_high), F.lit(False))


def _sender_columns(cfg: ScreenConfig) -> list[Column]:
    outbound, gap = F.col("txn_type").isin(*OUTBOUND), F.col("t") - F.col("_last")
    return [
        F.when(outbound, F.col("_n")).otherwise(0).alias("sender_recent_txn_count"),
        F.when(outbound, F.col("_sum").cast("double")).otherwise(0.0).alias("sender_recent_total_amount"),
        F.when(outbound, F.col("_values")).otherwise(0).alias("fan_out_receivers"),
        F.col("_hour").alias("velocity_transactions_1h"),
        F.coalesce(F.when(gap <= cfg.velocity_seconds, gap.cast("double")), F.lit(cfg.no_history_seconds)).alias("time_since_last_purchase"),
        F.when(in_band(cfg), F.col("_band") + 1).otherwise(0).alias("split_count"),
        F.when(in_band(cfg), (F.col("_banded") + money("amount")).cast("double")).otherwise(0.0).alias("split_amount"),
    ]


def _credit_columns() -> list[Column]:
    out, total = F.col("txn_type") == "CASH_OUT", F.col("_credited").cast("double")
    return [
        F.when(out, total).otherwise(0.0).alias("inbound_total"), F.when(out, F.col("_credits")).otherwise(0).alias("inbound_count"),
        F.when(out & (total > 0), F.col("amount") / total).otherwise(0.0).alias("inbound_to_cashout_ratio"),
    ]


def sender_history(tx: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Velocity, fan-out and structuring inputs of each row; one shuffle on (account, slice)."""
    return _account_history(tx, cfg, credited=False).select(*tx.columns, *_sender_columns(cfg))


def inbound_history(tx: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Credits that the sender of a cash-out received before; one shuffle on (account, slice)."""
    return _account_history(tx, cfg, credited=True).select(*tx.columns, *_credit_columns())


def account_history(tx: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """sender_history() and inbound_history() in one shuffle."""
    return _account_history(tx, cfg, credited=True).select(*tx.columns, *_sender_columns(cfg), *_credit_columns())


def receiver_history(tx: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Fan-in inputs of each row; one shuffle on (name_dest, slice)."""
    line, inbound = Line("name_dest", "seq"), F.col("txn_type").isin(*INBOUND)
    rows = line.marked(line.dealt(tx, cfg.fan_in_seconds), "name_orig", cfg.fan_in_seconds)
    recent = line.total(F.lit(1), cfg.fan_in_seconds)
    rows = rows.withColumns({"_n": recent, "_sum": line.total(money("amount"), cfg.fan_in_seconds), "_values": line.distinct(cfg.fan_in_seconds, recent + 1)})
    return rows.where("own").select(
        *tx.columns,
        F.when(inbound, F.col("_n")).otherwise(0).alias("receiver_recent_txn_count"),
        F.when(inbound, F.col("_sum").cast("double")).otherwise(0.0).alias("receiver_recent_total_amount"),
        F.when(inbound, F.col("_values")).otherwise(0).alias("fan_in_senders"),
    )


def first_of_pairs(tx: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(name_orig, name_dest, _first): the first (t, seq) of each pair; without the pairs of known."""
    first = tx.groupBy("name_orig", "name_dest").agg(F.min(F.struct("t", "seq")).alias("_first"))
    return first if known is None else first.join(known.select("name_orig", "name_dest").distinct(), ["name_orig", "name_dest"], "left_anti")


def counterparty_history(tx: DataFrame, known: DataFrame | None = None, base: DataFrame | None = None) -> DataFrame:
    """is_new_counterparty: a transfer that is the first row of its (sender, receiver) pair, of whatever type.

    First rows are minima, combined before the shuffle. known: pairs (name_orig, name_dest) from before.
    base: the rows of tx without what was added to them, so that the minima need none of it.
    """
    rows = tx.join(first_of_pairs(tx if base is None else base, known), ["name_orig", "name_dest"], "left")
    new = (F.col("txn_type") == "TRANSFER") & F.coalesce(F.struct("t", "seq") == F.col("_first"), F.lit(False))
    return rows.select(*tx.columns, new.cast("int").alias("is_new_counterparty"))


def with_history(tx: DataFrame, cfg: ScreenConfig = ScreenConfig(), known: DataFrame | None = None) -> DataFrame:
    return counterparty_history(receiver_history(account_history(tx, cfg), cfg), known, tx)
