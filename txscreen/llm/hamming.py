"""Exact top-k search in Hamming space by incremental multi-index hashing.

A code has any number of bits in 64-bit words, cut into S segments of 16. If two codes differ by less
than S * (r + 1) bits, some segment differs by r bits or fewer. A search looks up, for r = 0, 1, ..., all
segment values at exactly r flips from the query's, verifies each code found once, and stops when the
k-th best verified distance is below S * (r + 1): then no unseen code can be as near, not even at the
same distance, so ties are complete too.

The index is dealt over blocks of bounded size by a hash of the code, the queries over chunks. A task
has one block, with a sorted list for each segment, and streams one chunk past it. Each query leaves
at most k rows of a block, which a ranking over the query's own rows merges. Of the rows that share a code
only those of its k + 1 smallest ids, k of each, can be in a result, and no more are kept.

Codes here are the signs of a vector of any length, and only codes of equal length are compared; a
null or empty vector or one with a null component has no code and is neither indexed nor searched for;
NaN counts as positive, as Spark orders it. Repeated rows count each. A query never finds rows with its
own id. Queries with fewer than k other rows get them all; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, slices, table

BITS, WORD = 16, 64
K, QUERY_EVERY = 10, 20
#: Codes that a task holds, queries that it streams at most, and those below which they aren't cut for more tasks.
BLOCK_ROWS, CHUNK_ROWS, LEAST_ROWS = 1 << 20, 1 << 16, 1 << 8


def sign_code(vector: Column | str) -> Column:
    """(bits, words): bit i % 64 of word i / 64 is set where component i is 0 or more; null without a code."""

    def word(part: Column) -> Column:
        bits = F.transform(part, lambda x, i: F.when(x >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))

    vector = F.col(vector) if isinstance(vector, str) else vector
    begins = F.sequence(F.lit(1), F.size(vector), F.lit(WORD))
    whole = (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull())
    return F.when(whole, F.struct(F.size(vector).alias("bits"), F.transform(begins, lambda i: word(F.slice(vector, i, WORD))).alias("words")))


def _flips(r: int) -> np.ndarray:
    return np.array([sum(1 << i for i in c) for c in combinations(range(BITS), r)], np.int64)


class Block:
    """An index over codes of one length: for each segment the rows sorted by its value, and where each value begins."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, bits: int) -> None:
        """codes: (row, word), unsigned."""
        self.ids, self.codes, self.segments = ids, codes, -(-bits // BITS)
        self.rows, self.at = [], []
        for s in range(self.segments):
            value = self._value(self.codes, s)
            rows = np.argsort(value, kind="stable").astype(np.int32)
            self.rows.append(rows)
            self.at.append(np.searchsorted(value[rows], np.arange((1 << BITS) + 1)).astype(np.int64))
        self.flips = [_flips(0)]

    @staticmethod
    def _value(codes: np.ndarray, s: int) -> np.ndarray:
        word, shift = divmod(s * BITS, WORD)
        return ((codes[:, word] >> np.uint64(shift)) & np.uint64((1 << BITS) - 1)).astype(np.int64)

    def search(self, query_id: int, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest rows, ties by id; never the query's own id."""
        seen = np.zeros(0, np.int64)
        dist = np.zeros(0, np.int64)
        for r in range(BITS + 1):
            if len(self.flips) <= r:
                self.flips.append(_flips(r))
            found = []
            for s in range(self.segments):
                values = int(self._value(code[None, :], s)[0]) ^ self.flips[r]
                begin, size = self.at[s][values], self.at[s][values + 1] - self.at[s][values]
                begin, size = begin[size > 0], size[size > 0]
                if len(size):
                    places = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
                    found.append(self.rows[s][places])
            if found:
                rows = np.setdiff1d(np.concatenate(found).astype(np.int64), seen)
                rows = rows[self.ids[rows] != query_id]
                seen, dist = np.concatenate([seen, rows]), np.concatenate([dist, np.bitwise_count(self.codes[rows] ^ code).sum(axis=1, dtype=np.int64)])
                best = np.lexsort((self.ids[seen], dist))[:k]
                if len(best) == k and dist[best[-1]] < self.segments * (r + 1):
                    return self.ids[seen[best]], dist[best]
        best = np.lexsort((self.ids[seen], dist))[:k]
        return self.ids[seen[best]], dist[best]


def _search(k: int):
    names = ["query_id", "query_row", "id", "distance"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, index = None, {}, {}
        for b in slices(batches):
            out: list[tuple] = []
            for key, is_query, row, i, bits, words in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if key != block:
                    block, held, index = key, {}, {}
                if not is_query:
                    ids, codes = held.setdefault(bits, ([], []))
                    ids.append(i)
                    codes.append(np.array(words, np.int64).tobytes())
                    continue
                if bits not in index and bits in held:
                    ids, codes = held.pop(bits)
                    index[bits] = Block(np.array(ids, np.int64), np.frombuffer(b"".join(codes), np.uint64).reshape(len(ids), -1), bits)
                if bits in index:
                    found, dist = index[bits].search(i, np.array(words, np.int64).view(np.uint64), k)
                    out += [(i, row, int(x), int(d)) for x, d in zip(found, dist, strict=True)]
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in columns], names)

    return run


def nearest_codes(index: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """index, queries: (id, code as of sign_code()). (query_id, rank, id, distance), ranks from 1, ordered by distance and id."""
    spark = index.sparkSession
    known = index.where(F.col("code").isNotNull() & F.col("id").isNotNull()).select("id", "code.bits", "code.words")
    asked = queries.where(F.col("code").isNotNull() & F.col("id").isNotNull()).select("id", "code.bits", "code.words")
    blocks = max(1, -(-known.count() // BLOCK_ROWS))
    n = asked.count()
    chunks = max(1, -(-n // CHUNK_ROWS), min(partitions(spark), -(-n // LEAST_ROWS)))
    same = Window.partitionBy("bits", "words").orderBy("id")
    own = Window.partitionBy("bits", "words", "id").orderBy(F.lit(0))
    few = known.withColumn("r", F.dense_rank().over(same)).where(F.col("r") <= k + 1).withColumn("c", F.row_number().over(own)).where(F.col("c") <= k)
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    pair = lambda block, chunk: (block * chunks + chunk).cast("int").alias("block")
    rows = few.withColumn("chunk", every(chunks)).select(pair(F.pmod(F.xxhash64("bits", "words"), F.lit(blocks)), F.col("chunk")), F.lit(0).alias("is_query"), F.lit(0).cast("long").alias("row"), "id", "bits", "words")
    # a query has its row number before it goes to every block
    asked = asked.withColumn("row", F.monotonically_increasing_id()).withColumn("b", every(blocks))
    asked = asked.select(pair(F.col("b"), F.pmod(F.xxhash64("row"), F.lit(chunks))), F.lit(1).alias("is_query"), "row", "id", "bits", "words")
    dealt = rows.unionByName(asked).repartitionById(blocks * chunks, F.col("block")).sortWithinPartitions("block", "is_query")
    found = dealt.mapInArrow(_search(k), "query_id long, query_row long, id long, distance long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy("distance", "id"))
    return found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def op9_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), sign_code(F.col("embedding")).alias("code"))
    return nearest_codes(codes, codes.where(F.col("id") % QUERY_EVERY == 0)).select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


SQL = f"""
WITH codes AS (
  SELECT vec_id, list_sum(list_transform(range(len(embedding)), lambda i: CASE WHEN embedding[i + 1] >= 0 THEN CAST(1 AS HUGEINT) << CAST(i AS INTEGER) ELSE 0 END))::HUGEINT AS code
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(bit_count(xor(q.code, c.code)) AS BIGINT) AS distance
  FROM codes q JOIN codes c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0
)
SELECT query_id, CAST(rank AS BIGINT) AS rank, vec_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs) WHERE rank <= {K}
"""
