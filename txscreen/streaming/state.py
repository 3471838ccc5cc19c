"""What scoring remembers between batches: log-structured tables in the root's folder.

A table is a set of immutable segments that a manifest names. A batch adds a small segment (a delta); when
FAN deltas have come, the next batch merges them, and what is older than the table keeps is dropped. A manifest
is a file that is created only if its number is free, and the next one deletes what it no longer names, so a
reader sees whole tables and a crash leaves at most files that nobody names. A batch merges only what earlier
batches added, which are finished by then: a batch that runs again replaces its own delta and reads the same past.

* History: the rows themselves, by hour. Windows read the hours that they reach; repeated ids are found
  in the hours of their own times. Hours that no window reaches any more become one segment each, and go after
  KEEP_SECONDS.
* Pairs: (sender, receiver) pairs with their last use. The merged segment is dealt over buckets of the sender
  and a batch reads only the buckets of its own senders. A sender's pairs are forgotten when
  it did nothing for PAIRS_SECONDS.

So the folders and the rows that a batch reads depend on the traffic within the windows, not on the life of the stream.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..durable import create_once, names, read_text, remove

FAN, HOUR = 16, 3600
KEEP_SECONDS, PAIRS_SECONDS = 86_400, 30 * 86_400
#: Rows of a bucket of merged pairs, about.
BUCKET_ROWS = 50_000


class Manifest:
    """The segments of a table: dicts with path, low and high (times), and what else the table notes."""

    def __init__(self, path: str) -> None:
        self.path = path

    def load(self, spark: SparkSession) -> dict:
        last = max(names(spark, f"{self.path}/manifest"), default=None, key=lambda n: int(n[2:12]) if n.startswith("v-") else -1)
        return json.loads(read_text(spark, f"{self.path}/manifest/{last}")) if last else {"version": -1, "segments": [], "unused": []}

    def commit(self, spark: SparkSession, old: dict, segments: list[dict]) -> dict:
        kept = {s["path"] for s in segments}
        new = {"version": old["version"] + 1, "segments": segments, "unused": sorted({s["path"] for s in old["segments"]} - kept)}
        if not create_once(spark, f"{self.path}/manifest/v-{new['version']:010d}.json", json.dumps(new)):
            raise RuntimeError(f"another query has written version {new['version']} of {self.path}")
        # what the version before had dropped is read by nobody any more
        for path in old["unused"]:
            whole = "/".join(path.split("/")[:2])
            remove(spark, f"{self.path}/{path if any(k.startswith(f'{whole}/') for k in kept) else whole}")
        remove(spark, f"{self.path}/manifest/v-{old['version'] - 1:010d}.json")
        return new


class Table:
    def __init__(self, root: str, name: str, schema: StructType, fan: int = FAN) -> None:
        self.path, self.schema, self.fan = f"{root}/{name}", schema, fan
        self.manifest = Manifest(self.path)
        #: The folders of the last read.
        self.folders: list[str] = []

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        self.folders = paths
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p in paths])

    def _write(self, rows: DataFrame, by: str | None = None) -> str:
        path = f"data/{uuid.uuid4().hex}"
        writer = rows.write.partitionBy(by) if by else rows.write
        writer.parquet(f"{self.path}/{path}")
        return path

    def segments(self, spark: SparkSession, batch: int | None = None) -> list[dict]:
        """All segments but the delta of `batch`."""
        return [s for s in self.manifest.load(spark)["segments"] if batch is None or s.get("batch") != batch]

    def add(self, rows: DataFrame, batch: int, low: int, high: int) -> None:
        """A batch's delta, in place of what the batch added before; low and high: its first and last time."""
        spark, old = rows.sparkSession, self.manifest.load(rows.sparkSession)
        path = self._write(rows.select(*self.schema.names))
        self.manifest.commit(spark, old, [*[s for s in old["segments"] if s.get("batch") != batch], {"path": path, "low": low, "high": high, "batch": batch}])

    def _deltas(self, segments: list[dict], before: int) -> list[dict]:
        return [s for s in segments if "batch" in s and s["batch"] < before]


class History(Table):
    """Rows with t, by hour."""

    def __init__(self, root: str, schema: StructType, reach: int, keep: int = KEEP_SECONDS, fan: int = FAN) -> None:
        super().__init__(root, "history", schema, fan)
        self.reach, self.keep = reach, keep

    def since(self, spark: SparkSession, low: int, high: int | None = None, batch: int | None = None) -> DataFrame:
        """The rows from `low` to `high`, of all batches but `batch`."""
        near = [s["path"] for s in self.segments(spark, batch) if s["high"] >= low and (high is None or s["low"] <= high)]
        rows = self._read(spark, near).where(F.col("t") >= low)
        return rows if high is None else rows.where(F.col("t") <= high)

    def compact(self, spark: SparkSession, before: int, now: int) -> None:
        """Merges the deltas of batches below `before`, and hours that windows have left, and drops what is too old."""
        old = self.manifest.load(spark)
        deltas = self._deltas(old["segments"], before)
        if len(deltas) < self.fan:
            return
        rest = [s for s in old["segments"] if s not in deltas and s["high"] >= now - self.keep]
        path = self._write(self._read(spark, [s["path"] for s in deltas]).withColumn("hour", F.floor(F.col("t") / HOUR)), "hour")
        for name in names(spark, f"{self.path}/{path}"):
            if name.startswith("hour="):
                hour = int(name.removeprefix("hour="))
                rest.append({"path": f"{path}/{name}", "low": hour * HOUR, "high": hour * HOUR + HOUR - 1, "hour": hour})
        hours = {s["hour"] for s in rest if "hour" in s}
        for hour in sorted(hours):
            parts = [s for s in rest if s.get("hour") == hour]
            if len(parts) >= self.fan or (len(parts) > 1 and (hour + 1) * HOUR <= now - self.reach):
                merged = self._write(self._read(spark, [s["path"] for s in parts]).coalesce(1 + len(parts) // 4))
                rest = [s for s in rest if s not in parts] + [{"path": merged, "low": hour * HOUR, "high": hour * HOUR + HOUR - 1, "hour": hour}]
        self.manifest.commit(spark, old, [s for s in rest if s["high"] >= now - self.keep])


PAIR_SCHEMA = StructType().add("name_orig", "string").add("name_dest", "string").add("t", "long")


class Pairs(Table):
    """(name_orig, name_dest, t): pairs with their last use. A row without a receiver says that the sender began anew at t."""

    def __init__(self, root: str, keep: int = PAIRS_SECONDS, fan: int = FAN, bucket_rows: int = BUCKET_ROWS) -> None:
        super().__init__(root, "pairs", PAIR_SCHEMA, fan)
        self.keep, self.bucket_rows = keep, bucket_rows

    @staticmethod
    def _bucket(buckets: int):
        return F.pmod(F.xxhash64("name_orig"), F.lit(buckets))

    def known(self, rows: DataFrame, batch: int) -> tuple[DataFrame, DataFrame]:
        """(the pairs of rows that were there before, rows of this table for senders that begin anew); rows: (name_orig, name_dest, t)."""
        spark = rows.sparkSession
        senders = rows.groupBy("name_orig").agg(F.min("t").alias("_from"))
        paths = []
        for s in self.segments(spark, batch):
            if "buckets" in s:
                # as many numbers as there are buckets at most
                own = [r[0] for r in senders.select(self._bucket(s["buckets"])).distinct().collect()]
                had = set(s["filled"])
                paths += [f"{s['path']}/bucket={b}" for b in sorted(own) if b in had]
            else:
                paths.append(s["path"])
        mine = self._read(spark, paths).join(senders, "name_orig")
        state = mine.groupBy("name_orig").agg(F.max("t").alias("_last"), F.max(F.when(F.col("name_dest").isNull(), F.col("t"))).alias("_anew"), F.first("_from").alias("_from"))
        alive = F.col("_from") - F.col("_last") <= self.keep
        fresh = F.col("t") >= F.coalesce("_anew", F.col("t"))
        living = mine.drop("_from").join(state.where(alive), "name_orig").where(fresh & F.col("name_dest").isNotNull())
        return living.select("name_orig", "name_dest").distinct(), state.where(~alive).select("name_orig", F.lit(None).cast("string").alias("name_dest"), F.col("_from").alias("t"))

    def remember(self, rows: DataFrame, anew: DataFrame, batch: int, low: int, high: int) -> None:
        pairs = rows.groupBy("name_orig", "name_dest").agg(F.max("t").alias("t"))
        self.add(pairs.unionByName(anew), batch, low, high)

    def compact(self, spark: SparkSession, before: int, now: int) -> None:
        """Merges FAN deltas into one segment, and FAN of those with all earlier pairs into the dealt one, without what is forgotten."""
        old = self.manifest.load(spark)
        deltas = self._deltas(old["segments"], before)
        if len(deltas) < self.fan:
            return
        rest = [s for s in old["segments"] if s not in deltas]
        some = [s for s in rest if "batch" not in s and "buckets" not in s]
        low, high = min(s["low"] for s in deltas), max(s["high"] for s in deltas)
        if len(some) + 1 < self.fan:
            merged = self._read(spark, [s["path"] for s in deltas]).groupBy("name_orig", "name_dest").agg(F.max("t").alias("t"))
            self.manifest.commit(spark, old, [*rest, {"path": self._write(merged), "low": low, "high": high}])
            return
        whole = [s for s in rest if "buckets" in s]
        paths = [s["path"] for s in deltas + some] + [f"{s['path']}/bucket={b}" for s in whole for b in s["filled"]]
        rows = self._read(spark, paths).groupBy("name_orig", "name_dest").agg(F.max("t").alias("t"))
        state = rows.groupBy("name_orig").agg(F.max("t").alias("_last"), F.max(F.when(F.col("name_dest").isNull(), F.col("t"))).alias("_anew"))
        rows = rows.join(state.where(F.col("_last") >= now - self.keep), "name_orig").where(F.col("name_dest").isNotNull() & (F.col("t") >= F.coalesce("_anew", F.col("t"))))
        rows = rows.select(*PAIR_SCHEMA.names).persist()
        buckets = max(1, -(-rows.count() // self.bucket_rows))
        dealt = rows.withColumn("bucket", self._bucket(buckets)).repartition("bucket").sortWithinPartitions("bucket", "name_orig", "name_dest")
        path = self._write(dealt, "bucket")
        rows.unpersist()
        filled = [int(n.removeprefix("bucket=")) for n in names(spark, f"{self.path}/{path}") if n.startswith("bucket=")]
        low = reduce(min, (s["low"] for s in deltas + some + whole))
        self.manifest.commit(spark, old, [s for s in rest if s not in some and s not in whole] + [{"path": path, "low": low, "high": high, "buckets": buckets, "filled": filled}])
