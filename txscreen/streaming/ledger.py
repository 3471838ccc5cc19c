"""The ledger of finished batches, one for each query of a root.

A finished batch is a small file that the store creates only if there is none, so marks of several queries and
processes never meet in one write. Once EVERY batches are finished in a row, a mark of how far all are done stands
for their files: whether a batch is done is one look-up and one list of a folder with a file or two, after
however many batches. A mark is written before the files that it stands for go, and looked for after them.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from ..durable import create_once, exists, names, remove

EVERY = 64


class Batches:
    def __init__(self, root: str, name: str, every: int = EVERY) -> None:
        self.path, self.every = f"{root}/processed_stream_batches/query_name={name}", every

    def _file(self, batch: int) -> str:
        return f"{self.path}/batch-{batch:012d}.json"

    def upto(self, spark: SparkSession) -> int:
        """The last batch up to which all are finished and compacted, -1 before the first."""
        return max((int(n.removeprefix("upto-")) for n in names(spark, f"{self.path}/_upto") if n.startswith("upto-")), default=-1)

    def done(self, spark: SparkSession, batch: int) -> bool:
        return exists(spark, self._file(batch)) or batch <= self.upto(spark)

    def mark(self, spark: SparkSession, batch: int) -> bool:
        """Marks a batch as finished; False if it was."""
        if batch <= self.upto(spark):
            return False
        made = create_once(spark, self._file(batch), json.dumps({"batch_id": batch, "processed_at": datetime.now(UTC).isoformat()}))
        if batch % self.every == self.every - 1:
            self.compact(spark)
        return made

    def compact(self, spark: SparkSession) -> None:
        marked = {int(n[6:18]) for n in names(spark, self.path) if n.startswith("batch-") and n.endswith(".json")}
        low = high = self.upto(spark)
        while high + 1 in marked:
            high += 1
        if high > low:
            create_once(spark, f"{self.path}/_upto/upto-{high}", "")
        for n in marked:
            if n <= high:
                remove(spark, self._file(n))
        for n in names(spark, f"{self.path}/_upto"):
            if n.startswith("upto-") and int(n.removeprefix("upto-")) < high:
                remove(spark, f"{self.path}/_upto/{n}")

    def each(self, act: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """act for a batch that isn't empty and isn't finished yet; an empty one is finished at once.

        The batch is persisted: each run of its plan would read the sources and go through the state stores again.
        """

        def run(rows: DataFrame, batch: int) -> None:
            spark = rows.sparkSession
            if self.done(spark, batch):
                return
            rows.persist()
            try:
                if not rows.isEmpty():
                    act(rows, batch)
            finally:
                rows.unpersist()
            self.mark(spark, batch)

        return run
