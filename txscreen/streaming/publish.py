"""Publishing a stored ledger as three feeds at a rate, up to a number of events, as a streaming query.

The clock is a source that admits so many numbers in each trigger; number i stands for the ledger's i-th event. The
ledger is numbered once, in the order (t, seq), and stored in blocks of numbers, so a trigger reads the blocks of its
own numbers only. The checkpoint remembers the last number: a publisher that is started again goes on there.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..durable import exists
from ..operators.decode import messages, wire_feeds
from ..plans.running import running_totals
from .ledger import Batches

#: Events of a stored block.
BLOCK = 10_000
TOPICS = {"transactions": "event_id", "sender_state": "source_event_id", "receiver_state": "source_event_id"}


def store_numbered(tx: DataFrame, path: str, block: int = BLOCK) -> None:
    """tx with its number in the order (t, seq) from 0, in folders of `block` numbers."""
    spot = F.struct("t", "seq", "event_id")
    numbered = running_totals(tx.withColumn("_spot", spot).withColumn("_one", F.lit(1).cast("long")), "_spot", ["_one"])
    rows = numbered.withColumn("number", F.col("run__one") - 1).drop("_spot", "_one", "run__one")
    rows.withColumn("block", F.floor(F.col("number") / block)).repartitionByRange("number").write.partitionBy("block").parquet(path)


class Publisher:
    """Publishes `rate` events in each `every` seconds, each as a message to three topics, until `most` events or the ledger's end."""

    def __init__(self, tx: DataFrame, root: str, publish: Callable[[DataFrame, str], None], rate: int, most: int | None = None, every: float = 1.0, name: str = "publish_ledger", block: int = BLOCK) -> None:
        self.spark, self.root, self.publish, self.rate, self.every, self.name, self.block = tx.sparkSession, root, publish, rate, every, name, block
        self.path, self.finished = f"{root}/numbered", threading.Event()
        if not exists(self.spark, f"{self.path}/_SUCCESS"):
            store_numbered(tx, self.path, block)
        self.schema = self.spark.read.parquet(self.path).schema
        there = self.spark.read.schema(self.schema).parquet(self.path).agg(F.count(F.lit(1))).first()[0]
        self.end = there if most is None else min(most, there)
        if not self.end:
            self.finished.set()

    def _act(self, batch: DataFrame, n: int) -> None:
        low, high = batch.agg(F.min("value"), F.max("value")).first()
        if low < self.end:
            numbers = F.col("number").between(low, min(high, self.end - 1))
            blocks = F.col("block").between(low // self.block, high // self.block)
            events = self.spark.read.schema(self.schema).parquet(self.path).where(blocks & numbers)
            feeds = wire_feeds(events)
            sent = None
            for topic, key in TOPICS.items():
                part = messages(feeds[topic], topic, key)
                sent = part if sent is None else sent.unionByName(part)
            self.publish(sent, str(n))
        if high + 1 >= self.end:
            self.finished.set()

    def start(self) -> StreamingQuery:
        clock = self.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", self.rate).option("numPartitions", 1).load()
        writer = clock.writeStream.foreachBatch(Batches(self.root, self.name).each(self._act)).option("checkpointLocation", f"{self.root}/checkpoints/{self.name}").queryName(self.name)
        return writer.trigger(processingTime=f"{self.every} seconds").start()

    def run(self, timeout: float | None = None) -> bool:
        """Publishes until the end; False if it took more than `timeout` seconds."""
        if self.finished.is_set():
            return True
        query = self.start()
        waited = 0.0
        while not self.finished.wait(0.2):
            waited += 0.2
            if query.exception() is not None:
                raise query.exception()
            if timeout is not None and waited > timeout:
                break
        query.stop()
        return self.finished.is_set()
