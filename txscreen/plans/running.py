"""Running totals over a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..durable import settle


def running_totals(rows: DataFrame, by: str, sums: list[str], descending: bool = False, within: str | None = None) -> DataFrame:
    """rows, distinct in `by` (and `within`), with `run_<c>` for each c of sums: the total of c up to and with the row.

    A range partitioning cuts the order into as many buckets as the session has shuffle partitions, so the
    share of a task is the user's to set. A bucket's rows are summed in a task of their own; what the buckets
    before it hold comes from one row for each bucket. The cut is settled: both parts must see the same one.
    """
    order, key = F.desc if descending else F.asc, within or "_all"
    own = rows if within else rows.withColumn(key, F.lit(0))
    placed = settle(own.repartitionByRange(key, order(by)).withColumn("_bucket", F.spark_partition_id()))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(key, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    bases = totals.select(key, "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in sums])
    inside = Window.partitionBy(key, "_bucket").orderBy(order(by)).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"_l_{c}") for c in sums])
    # one row for each bucket; with groups there may be many, and the rows are dealt by both columns already
    joined = local.join(bases if within else F.broadcast(bases), [key, "_bucket"])
    return joined.select(*rows.columns, *[(F.col(f"_b_{c}") + F.col(f"_l_{c}")).alias(f"run_{c}") for c in sums])
