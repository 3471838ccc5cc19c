"""Near-dedup of embeddings: random-hyperplane hashing, exact cosine verification, connected components.

Equal vectors are one class. A class is hashed by the signs of its products with random hyperplanes,
BITS of them for each of several tables; classes with equal bits in a table meet in a bucket, where
the cosine of every two is computed in double precision. The number of tables follows from the bits:
as many as find a pair right at the threshold with probability RECALL.

Buckets are sorted runs that a task works through in blocks of BLOCK vectors. A larger bucket is
dealt by a second hash into blocks, and each pair of blocks is a task of its own, so no bucket is ever
held whole. A pair that several tables find counts in the first of them, which both sides can tell
from their own bits. Only a count for each vector and the edges of a spanning forest leave a task;
pairs are never sent.

Defined cases: a null or empty vector, one with a null or non-finite component and a zero vector
link with nothing and keep their rows; vectors of different lengths don't link; repeated rows and
ids are vectors of their own; a null vec_id names no component unless all of its vectors have none;
an empty table gives no rows; labels and other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table
from .components import components
from .simhash import _Forest

THRESHOLD, RECALL, SEED = 0.9, 0.9995, 42
#: Bits of a table: the binary logarithm of the classes less BUCKET_LOG; MOST_BITS, what a key has room for, is reached at 2^37 classes.
BUCKET_LOG, LEAST_BITS, MOST_BITS = 5, 4, 32
BLOCK = 2048


def bits_and_tables(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(2, n))) - BUCKET_LOG))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(raw: list[bytes]) -> np.ndarray:
    """Vectors of one length, scaled by a power of two, so that no square leaves the range."""
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _signatures(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    planes = np.random.default_rng([SEED, x.shape[1]]).standard_normal((x.shape[1], bits * tables))
    signs = ((x @ planes) >= 0).reshape(len(x), tables, bits)
    return (signs @ (1 << np.arange(bits))).astype("<u4")


def _emit(bits: int, tables: int):
    """(node, weight, vector bytes) to a row for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                raw = part.column("vector").to_pylist()
                size = np.array([len(v) for v in raw])
                for d in np.unique(size).tolist():
                    own = np.flatnonzero(size == d)
                    sig = _signatures(_unit([raw[i] for i in own]), bits, tables)
                    take = pa.array(np.repeat(own, tables))
                    t = np.tile(np.arange(tables, dtype=np.int64), len(own))
                    bucket = (np.int64(d) << 44) | (t << 32) | sig.reshape(-1).astype(np.int64)
                    signature = pa.array([s.tobytes() for s in sig], pa.binary()).take(pa.array(np.repeat(np.arange(len(own)), tables)))
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(t.astype(np.int32)), part.column("node").take(take), part.column("weight").take(take), signature, part.column("vector").take(take)], ["bucket", "t", "node", "weight", "signature", "vector"])

    return run


class _Rows:
    """Rows of one bucket as arrays."""

    def __init__(self, rows: list[dict]) -> None:
        self.node = np.array([r["node"] for r in rows], np.int64)
        self.weight = np.array([r["weight"] for r in rows], np.int64)
        self.x = _unit([r["vector"] for r in rows])
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.sig = np.frombuffer(b"".join(r["signature"] for r in rows), "<u4").reshape(len(rows), -1)
        self.side = np.array([r["side"] for r in rows], np.int32)


def _compare(rows: _Rows, t: int, crossed: bool, threshold: float, count: dict[int, int], forest: _Forest, edges: list[tuple[int, int]]) -> None:
    """Links among rows, or with crossed only between side 0 and side 1."""
    n = len(rows.node)
    for i in range(0, n, BLOCK):
        a = slice(i, i + BLOCK)
        for j in range(i, n, BLOCK):
            b = slice(j, j + BLOCK)
            near = (rows.x[a] @ rows.x[b].T) / (rows.norm[a][:, None] * rows.norm[b][None, :]) >= threshold
            if crossed:
                near &= rows.side[a][:, None] != rows.side[b][None, :]
            if i == j:
                near = np.triu(near, 1)
            p, q = np.nonzero(near)
            p, q = p + i, q + j
            if t and len(p):
                first = np.concatenate([~(rows.sig[p[k : k + 65536], :t] == rows.sig[q[k : k + 65536], :t]).any(axis=1) for k in range(0, len(p), 65536)])
                p, q = p[first], q[first]
            if not len(p):
                continue
            links = np.bincount(p, rows.weight[q], n) + np.bincount(q, rows.weight[p], n)
            for k in np.flatnonzero(links).tolist():
                node = int(rows.node[k])
                count[node] = count.get(node, 0) + int(links[k])
            # one edge for each row and partner block is enough to look at: the others of a row join through it
            one, at = np.unique(p, return_index=True)
            todo = np.concatenate([at, np.unique(q, return_index=True)[1]])
            pairs = zip(rows.node[p[todo]].tolist(), rows.node[q[todo]].tolist(), strict=True)
            edges += [(x, y) for x, y in pairs if forest.union(x, y)]
            left = _across(rows, p, q, forest)
            edges += left


def _across(rows: _Rows, p: np.ndarray, q: np.ndarray, forest: _Forest) -> list[tuple[int, int]]:
    """Edges for the links whose ends are still apart."""
    root = np.array([forest.find(x) for x in rows.node.tolist()], np.int64)
    apart = np.flatnonzero(root[p] != root[q])
    return [(x, y) for x, y in zip(rows.node[p[apart]].tolist(), rows.node[q[apart]].tolist(), strict=True) if forest.union(x, y)]


_OUT = "kind int, a long, b long, bucket long, t int, weight long, signature binary, vector binary"
_NAMES = ["kind", "a", "b", "bucket", "t", "weight", "signature", "vector"]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]


def _verify(threshold: float, most: int | None):
    """Sorted buckets to (0, node, links), (1, node, node) edges, and (2, rows) of buckets of over `most` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        over = None

        def batch(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[]] * len(_NAMES)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _TYPES, strict=True)], _NAMES)

        def spilled() -> list[tuple]:
            out = [(2, r["node"], None, r["bucket"], r["t"], r["weight"], r["signature"], r["vector"]) for r in rows]
            rows.clear()
            return out

        def done() -> list[tuple]:
            count: dict[int, int] = {}
            edges: list[tuple[int, int]] = []
            if len(rows) > 1:
                _compare(_Rows(rows), rows[0]["t"], rows[0]["crossed"], threshold, count, _Forest(), edges)
            rows.clear()
            return [(0, n, c, *[None] * 5) for n, c in count.items()] + [(1, a, b, *[None] * 5) for a, b in edges]

        for b in batches:
            out: list[tuple] = []
            for part in (b.slice(at, 512) for at in range(0, b.num_rows, 512)):
                for r in part.to_pylist():
                    if rows and r["bucket"] != rows[0]["bucket"]:
                        out += done()
                    if over is not None and r["bucket"] != over:
                        over = None
                    rows.append(r)
                    if over is not None or (most and len(rows) > most):
                        over = r["bucket"]
                        out += spilled()
            yield batch(out)
        yield batch(done())

    return run


def link_vectors(classes: DataFrame, threshold: float = THRESHOLD, most: int = 4 * BLOCK) -> DataFrame:
    """classes: (node, weight, vector as little-endian doubles), settled, one row for each node.

    (kind, a, b): kind 0: node a has b links, a weight each; kind 1: an edge of a spanning forest.
    """
    bits, tables = bits_and_tables(classes.count(), threshold)
    buckets = classes.select("node", "weight", "vector").mapInArrow(_emit(bits, tables), "bucket long, t int, node long, weight long, signature binary, vector binary")
    plain = buckets.select("bucket", "t", "node", "weight", "signature", "vector", F.lit(0).alias("side"), F.lit(False).alias("crossed"))
    found = settle(plain.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(_verify(threshold, most), _OUT))
    # the rest of a bucket: what came before it went over is kept too, so a large bucket is here as a whole
    large = found.where("kind = 2").select("bucket", "t", F.col("a").alias("node"), "weight", "signature", "vector")
    blocks = large.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("n"))
    own = large.join(blocks, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")))
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    pairs = pairs.select(F.xxhash64("bucket", low, high).alias("bucket"), "t", "node", "weight", "signature", "vector", (F.col("own") == high).cast("int").alias("side"), (low != high).alias("crossed"))
    rest = pairs.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(_verify(threshold, None), _OUT)
    return settle(found.where("kind < 2").select("kind", "a", "b").union(rest.select("kind", "a", "b")))


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = [np.array(x, "<f8").tobytes() for x in b.column("v").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("weight"), pa.array(v, pa.binary())], ["node", "weight", "vector"])


def near_duplicate_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each vector."""
    own = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    # -0.0 and 0.0 are equal components
    own = own.withColumn("v", F.when(usable(F.col("v")), F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))))
    # a class is a vector, not a hash of it; its number is a row number that the checkpoint fixes
    groups = own.where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first_id"))
    numbered = settle(groups.select(F.monotonically_increasing_id().alias("node"), "v", "weight", "first_id"))
    sizes = numbered.select("node", "weight", "first_id")
    members = own.where("v is not null").join(numbered.select("v", "node"), "v").select("vec_id", "node")
    classes = settle(numbered.select("node", "weight", "v").mapInArrow(_bytes, "node long, weight long, vector binary"))
    found = link_vectors(classes, threshold)
    links = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    groups = components(found.where("kind = 1").select("a", "b"))
    named = sizes.join(groups, "node", "left").join(links, "node", "left").select("node", "weight", "first_id", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    named = settle(named)
    first = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    per = named.join(first, "component").select("node", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id")
    alone = own.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = members.join(per, "node").select("vec_id", "n_links", "component_id").union(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
