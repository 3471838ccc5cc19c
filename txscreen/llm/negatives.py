"""Hard negatives by best-first search of an STR-packed R-tree.

Vectors are whole numbers here (256 times a component, rounded down), so inner products are exact. The
tree's root level is Spark's: rows are range-partitioned by (length, label, slab of one coordinate,
another coordinate, id) into blocks of bounded size, and a table of one bounding box a block is the root.
A block is packed by Sort-Tile-Recursive within each label, over the coordinates that spread most in it,
into leaves of LEAF rows, and FAN of them make a node above. Leaves are stored as binary rows in
the shared folder once; every search reads them.

A box and a query give an interval of inner products, coordinate by coordinate. A search has a window of
scores for each of its asks. It takes nodes from a queue, best bound first (a bound above the window counts
as its end); boxes whose interval misses the window are never queued, and the search ends at a box whose
bound is strictly below the k-th score so far. A box that could only tie with it is read unless all its
ids are larger. Boxes say which labels they have, so a search for the own label, or for all others, skips the rest.

A search over blocks has two rounds: each ask first visits the block with the best bound; the k-th scores
found there go with it to the other blocks, of which the root leaves out those that can't beat them. A
task has one block and streams asks past it; at most k rows of an ask and window leave a block. The root
level goes to the tasks that pick blocks only where its counted size is below ROOT_BYTES; beyond
that, asks go to all blocks and each block's own root prunes them. The coordinates of the slabs come
from a sample of SAMPLE_ROWS rows; they decide how well boxes prune, never what is found.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part;
only vectors of equal length are compared; rows of the anchor's own id are never found for it; rows equal in id, label
and vector count each as a result and ask once as an anchor; an anchor without positives, or a
positive without negatives, has no rows; an empty table gives none; other columns are ignored. Scores beyond 64 bits wrap.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, settle, slices, table

SCALE, RELABEL_EVERY, LABELS, ANCHOR_EVERY = 256, 7, 10, 100
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
LEAF, FAN, TILE_AXES = 256, 16, 3
#: Bytes of a block, about; and rows below which a block isn't cut for more tasks.
BLOCK_BYTES, LEAST_ROWS = 32 << 20, 1 << 11
SAMPLE_ROWS, ROOT_BYTES = 4096, 32 << 20
LEAVES = "block int, dim int, n int, label_low long, label_high long, low binary, high binary, ids binary, labels binary, copies binary, cells binary"
FOUND = "ask long, v long, w int, id long, score long"


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, q, n): the rows that take part, equal ones as one with their number."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    part = rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)))
    q = F.transform(x, lambda v: F.floor(v * SCALE))
    return part.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), q.alias("q")).groupBy("id", "label", "q").agg(F.count(F.lit(1)).cast("int").alias("n"))


def _tiles(x: np.ndarray, rows: np.ndarray, axes: list[int]) -> Iterator[np.ndarray]:
    """Sort-Tile-Recursive: rows cut into leaves, in slabs along one axis after the other."""
    if len(rows) <= LEAF:
        yield rows
        return
    leaves = -(-len(rows) // LEAF)
    if axes:
        rows = rows[np.argsort(x[rows, axes[0]], kind="stable")]
    slabs = int(np.ceil(leaves ** (1 / len(axes)))) if len(axes) > 1 else leaves
    size = -(-leaves // slabs) * LEAF
    for at in range(0, len(rows), size):
        yield from _tiles(x, rows[at : at + size], axes[1:])


def _pack(block: int, groups: dict[int, list[tuple]]) -> Iterator[tuple]:
    for dim, parts in groups.items():
        ids, labels, copies = (np.concatenate([p[i] for p in parts]) for i in range(3))
        x = np.concatenate([p[3] for p in parts])
        order = np.lexsort((ids, labels))
        edges = np.flatnonzero(np.diff(labels[order])) + 1
        runs = np.split(order, edges)
        small = [r for r in runs if len(r) < LEAF]
        # labels with few rows share leaves
        for run in [r for r in runs if len(r) >= LEAF] + ([np.concatenate(small)] if small else []):
            spread = x[run].astype(np.float64).var(axis=0) if dim else np.zeros(0)
            axes = [int(a) for a in np.argsort(-spread, kind="stable")[:TILE_AXES]]
            for leaf in _tiles(x, run, axes):
                cells, own = x[leaf], labels[leaf]
                low, high = cells.min(axis=0), cells.max(axis=0)
                yield block, dim, len(leaf), int(own.min()), int(own.max()), low.tobytes(), high.tobytes(), ids[leaf].tobytes(), own.tobytes(), copies[leaf].tobytes(), _narrow(cells).tobytes()


def _narrow(cells: np.ndarray) -> np.ndarray:
    """The same numbers in the fewest bytes that hold them: their width is the binary's length by their number."""
    most = max(abs(int(cells.min(initial=0))), abs(int(cells.max(initial=0))))
    return cells.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def pack(rows: DataFrame) -> DataFrame:
    """whole_vectors(), settled, as stored leaves."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(8 * F.size("q") + 24), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.bytes // BLOCK_BYTES), min(partitions(rows.sparkSession), -(-size.n // LEAST_ROWS)))
    sample = rows.orderBy(F.xxhash64("id", "label"), "id").limit(SAMPLE_ROWS).select("q").collect()
    longest = max((len(r.q) for r in sample), default=0)
    x = np.array([[float(v) for v in r.q] for r in sample if len(r.q) == longest], np.float64)
    axes = [int(a) for a in np.argsort(-x.var(axis=0), kind="stable")[:2]] if longest else []
    cell = lambda a: F.coalesce(F.get("q", F.lit(a)), F.lit(0).cast("long"))
    slab, second = F.lit(0), F.lit(0)
    if len(axes) == 2:
        cuts = [float(v) for v in np.unique(np.quantile(x[:, axes[0]], np.linspace(0, 1, int(np.ceil(blocks**0.5)) + 1)[1:-1]))]
        slab = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < cell(axes[0]))) if cuts else F.lit(0)
        second = cell(axes[1])
    dealt = rows.withColumns({"dim": F.size("q"), "slab": slab, "second": second}).repartitionByRange(blocks, "dim", "label", "slab", "second", "id").select("id", "label", "n", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        groups: dict[int, list[tuple]] = {}
        for b in batches:
            ids, labels, copies = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            q = b.column(3)
            sizes, values = np.diff(q.offsets.to_numpy()), q.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                cells = values[(ends[at][:, None] + np.arange(dim)[None, :])] if dim else np.zeros((len(at), 0), np.int64)
                groups.setdefault(int(dim), []).append((ids[at], labels[at], copies[at], cells))
        for leaf in _pack(TaskContext.get().partitionId(), groups):
            yield pa.RecordBatch.from_pydict({name: [v] for name, v in zip(_LEAF_SCHEMA.names, leaf, strict=True)}, _LEAF_SCHEMA)

    return settle(dealt.mapInArrow(run, LEAVES))


_LEAF_SCHEMA = pa.schema([("block", pa.int32()), ("dim", pa.int32()), ("n", pa.int32()), ("label_low", pa.int64()), ("label_high", pa.int64()), *[(c, pa.binary()) for c in ("low", "high", "ids", "labels", "copies", "cells")]])


def _most(*arrays: np.ndarray) -> int:
    return max(abs(int(f(initial=0))) for a in arrays for f in (a.min, a.max))


class Tree:
    """A block's leaves of one length with the nodes above them; a node is a run of nodes of the level below."""

    def __init__(self, leaves: list[tuple]) -> None:
        """leaves: (n, label_low, label_high, low, high, ids, labels, copies, cells)."""
        low, high = (np.stack([np.frombuffer(x[i], np.int64) for x in leaves]) for i in (3, 4))
        self.most, dim = _most(low, high), low.shape[1]
        self.rows = []
        for n, _, _, _, _, ids, labels, copies, cells in leaves:
            width = len(cells) // (n * dim) if dim else 8
            x = np.frombuffer(cells, {2: np.int16, 4: np.int32, 8: np.int64}[width]).reshape(n, dim)
            self.rows.append((np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), np.frombuffer(copies, np.int64), x))
        first = np.array([int(r[0].min()) for r in self.rows], np.int64)
        level = (low, high, np.array([x[1] for x in leaves], np.int64), np.array([x[2] for x in leaves], np.int64), first)
        self.levels = [level]
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), FAN)
            level = tuple((np.minimum if i in (0, 2, 4) else np.maximum).reduceat(a, starts, axis=0) for i, a in enumerate(level))
            self.levels.append(level)

    def search(self, ask: int, label: int, q: np.ndarray, windows: list[tuple], k: int, same: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """windows: (w, low, high, kth, kth_id). (w, ids, scores) of the k best rows, or fewer, that beat the k-th."""
        # float64 where all sums are exact in it, as it multiplies much faster
        kind = np.float64 if self.most * _most(q) * max(1, len(q)) < 1 << 52 else np.int64
        q = q.astype(kind)
        up, down, known = np.maximum(q, 0), np.minimum(q, 0), {}

        def scores(leaf: int) -> np.ndarray:
            if leaf not in known:
                known[leaf] = (self.rows[leaf][3].astype(kind) @ q).astype(np.int64)
            return known[leaf]

        def bounds(level: int, at: int, past: int) -> tuple:
            if (level, at) not in known:
                lo, hi, least, most, first = (a[at:past] for a in self.levels[level])
                lo, hi = lo.astype(kind), hi.astype(kind)
                fits = (least <= label) & (label <= most) if same else ~((least == label) & (most == label))
                known[level, at] = (lo @ up + hi @ down).astype(np.int64), (hi @ up + lo @ down).astype(np.int64), fits, first
            return known[level, at]

        for w, low, high, kth, kth_id in windows:
            ids, values, copies = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            queue: list[tuple[int, int, int]] = []

            def push(level: int, at: int, past: int) -> None:
                least, most, fits, first = bounds(level, at, past)
                best = np.minimum(most, high)
                take = fits & (most >= low) & (least <= high)
                if kth is not None:
                    take &= (best > kth) | ((best == kth) & (first < kth_id))
                for i in np.flatnonzero(take):
                    heapq.heappush(queue, (-int(best[i]), level, at + int(i)))

            push(len(self.levels) - 1, 0, 1)
            while queue:
                bound, level, node = heapq.heappop(queue)
                if kth is not None and -bound < kth:
                    break
                if level:
                    push(level - 1, node * FAN, min(len(self.levels[level - 1][0]), node * FAN + FAN))
                    continue
                own_ids, own_labels, own_copies, _ = self.rows[node]
                s = scores(node)
                take = (s >= low) & (s <= high) & ((own_labels == label) if same else (own_labels != label)) & (own_ids != ask)
                if kth is not None:
                    take &= (s > kth) | ((s == kth) & (own_ids < kth_id))
                if not take.any():
                    continue
                ids, values, copies = (np.concatenate(p) for p in ((ids, own_ids[take]), (values, s[take]), (copies, own_copies[take])))
                order = np.lexsort((ids, -values))
                ahead = np.cumsum(copies[order]) - copies[order]
                order = order[ahead < k]
                ids, values, copies = ids[order], values[order], copies[order]
                if copies.sum() >= k:
                    kth, kth_id = int(values[-1]), int(ids[-1])
            if len(ids):
                times = np.minimum(copies, k)
                yield w, np.repeat(ids, times)[:k], np.repeat(values, times)[:k]


def _search(k: int, same: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, trees = None, {}, {}
        for b in slices(batches, 64):
            out: list[tuple[np.ndarray, ...]] = []
            for row in b.to_pylist():
                if row["block"] != block:
                    block, held, trees = row["block"], {}, {}
                if row["ask"] is None:
                    held.setdefault(row["dim"], []).append(tuple(row[c] for c in _LEAF_SCHEMA.names[2:]))
                    continue
                if row["dim"] not in trees and row["dim"] in held:
                    trees[row["dim"]] = Tree(held.pop(row["dim"]))
                if row["dim"] in trees:
                    windows = [(w["w"], w["low"], w["high"], w["kth"], w["kth_id"]) for w in row["windows"]]
                    for w, ids, values in trees[row["dim"]].search(row["ask"], row["ask_label"], np.array(row["q"], np.int64), windows, k, same):
                        out.append((np.full(len(ids), row["ask"], np.int64), np.full(len(ids), row["v"], np.int64), np.full(len(ids), w, np.int32), ids, values))
            kinds = (np.int64, np.int64, np.int32, np.int64, np.int64)
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, t) for t in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["ask", "v", "w", "id", "score"])

    return run


class Root:
    """The table of block boxes, read by the tasks that pick an ask's blocks."""

    def __init__(self, leaves: DataFrame, limit: int = ROOT_BYTES) -> None:
        self.leaves, self.boxes = leaves, None
        size = leaves.select("block", "dim").distinct().agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("dim") * 16 + 64), F.lit(0)).alias("bytes"), F.coalesce(F.max("block"), F.lit(0)).alias("last")).first()
        self.parts = size.last + 1
        if size.n and size.bytes <= limit:

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                own: dict[tuple[int, int], list] = {}
                for b in slices(batches, 64):
                    for r in b.to_pylist():
                        low, high, key = np.frombuffer(r["low"], np.int64), np.frombuffer(r["high"], np.int64), (r["block"], r["dim"])
                        had = own.get(key, [low, high, r["label_low"], r["label_high"]])
                        own[key] = [np.minimum(low, had[0]), np.maximum(high, had[1]), min(had[2], r["label_low"]), max(had[3], r["label_high"])]
                names, rows = ["block", "dim", "low", "high", "label_low", "label_high"], [(b, d, lo.tobytes(), hi.tobytes(), x, y) for (b, d), (lo, hi, x, y) in own.items()]
                yield pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(names)}, _BOX_SCHEMA)

            found = leaves.select("block", "dim", "low", "high", "label_low", "label_high").mapInArrow(run, "block int, dim int, low binary, high binary, label_low long, label_high long")
            # of a counted size below the limit: a row for each block, which is in one partition
            merged: dict[tuple[int, int], tuple] = {}
            for r in found.collect():
                low, high = np.frombuffer(r.low, np.int64), np.frombuffer(r.high, np.int64)
                _, _, lo, hi, x, y = merged.get((r.block, r.dim), (0, 0, low, high, r.label_low, r.label_high))
                merged[r.block, r.dim] = (r.block, r.dim, np.minimum(lo, low), np.maximum(hi, high), min(x, r.label_low), max(y, r.label_high))
            self.boxes = list(merged.values())

    def asked(self, asks: DataFrame, same: bool, first: bool) -> DataFrame:
        """asks with the blocks that each goes to: the one with the best bound (first), or all others that can beat what is known."""
        if self.boxes is None:
            every = self.leaves.select("block", "dim").distinct()
            own = asks.withColumn("dim", F.size("q"))
            return own.where("false").withColumn("block", F.lit(0)) if first else own.join(every, "dim")
        by_dim: dict[int, tuple] = {}
        for dim in {b[1] for b in self.boxes}:
            rows = [b for b in self.boxes if b[1] == dim]
            by_dim[dim] = (np.array([b[0] for b in rows], np.int32), np.stack([b[2] for b in rows]), np.stack([b[3] for b in rows]), np.array([b[4] for b in rows]), np.array([b[5] for b in rows]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 256):
                rows, blocks = [], []
                for i, r in enumerate(b.select(["label", "q", "windows"]).to_pylist()):
                    if len(r["q"]) not in by_dim:
                        continue
                    at, low, high, least, most = by_dim[len(r["q"])]
                    q = np.array(r["q"], np.int64)
                    up, down = np.maximum(q, 0), np.minimum(q, 0)
                    top, bottom = high @ up + low @ down, low @ up + high @ down
                    fits = (least <= r["label"]) & (r["label"] <= most) if same else ~((least == r["label"]) & (most == r["label"]))
                    best = int(np.lexsort((at, -np.where(fits, top, np.iinfo(np.int64).min)))[0])
                    if first:
                        chosen = [best] if fits[best] else []
                    else:
                        useful = np.zeros(len(at), bool)
                        for w in r["windows"]:
                            can = (top >= w["low"]) & (bottom <= w["high"])
                            useful |= can if w["kth"] is None else can & (np.minimum(top, w["high"]) >= w["kth"])
                        useful &= fits
                        useful[best] = False
                        chosen = np.flatnonzero(useful).tolist()
                    rows += [i] * len(chosen)
                    blocks += [int(at[c]) for c in chosen]
                yield pa.RecordBatch.from_arrays([*b.take(pa.array(rows, pa.int64())).columns, pa.array(blocks, pa.int32())], [*b.schema.names, "block"])

        picked = asks.mapInArrow(run, f"{_ddl(asks)}, block int")
        return picked.withColumn("dim", F.size("q"))


_BOX_SCHEMA = pa.schema([("block", pa.int32()), ("dim", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("label_low", pa.int64()), ("label_high", pa.int64())])
WINDOW = "struct<w:int,low:bigint,high:bigint,kth:bigint,kth_id:bigint>"


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)


def _visit(root: Root, asked: DataFrame, k: int, same: bool) -> DataFrame:
    """asked: asks with block and dim. (ask, w, id, score) of each block visited."""
    names = _LEAF_SCHEMA.names
    none = {"ask": "long", "v": "long", "ask_label": "long", "q": "array<bigint>", "windows": f"array<{WINDOW}>"}
    leaves = root.leaves.select(*names, *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    asks = asked.select(*[F.col(c) if c in ("block", "dim") else F.lit(None).cast(root.leaves.schema[c].dataType).alias(c) for c in names], F.col("id").alias("ask"), "v", F.col("label").alias("ask_label"), "q", "windows")
    # a partition for each block, in which leaves stand before asks
    dealt = leaves.unionByName(asks).repartitionById(root.parts, F.col("block")).sortWithinPartitions("block", F.asc_nulls_first("ask"))
    return settle(dealt.mapInArrow(_search(k, same), FOUND))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("ask", "v", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(root: Root, asks: DataFrame, k: int, same: bool) -> DataFrame:
    """asks: (id, v, label, q, windows of (w, low, high)). (ask, v, w, rank, id, score): the k best rows of the ask's label, or of all others, in each window."""
    bare = F.transform("windows", lambda w: F.struct(w["w"].alias("w"), w["low"].alias("low"), w["high"].alias("high"), F.lit(None).cast("long").alias("kth"), F.lit(None).cast("long").alias("kth_id")))
    asks = asks.select("id", "v", "label", "q", bare.alias("windows"))
    near = _visit(root, root.asked(asks, same, first=True), k, same)
    # the k-th of an ask's first block, where it has k
    last = _best(near, k).where(F.col("rank") == k).groupBy("ask", F.col("v").alias("_v")).agg(F.map_from_entries(F.collect_list(F.struct("w", F.struct("score", "id")))).alias("last"))
    had = F.transform("windows", lambda w: F.struct(w["w"].alias("w"), w["low"].alias("low"), w["high"].alias("high"), F.try_element_at("last", w["w"])["score"].alias("kth"), F.try_element_at("last", w["w"])["id"].alias("kth_id")))
    informed = asks.join(last, (F.col("id") == F.col("ask")) & (F.col("v") == F.col("_v")), "left").select("id", "v", "label", "q", had.alias("windows"))
    rest = _visit(root, root.asked(informed, same, first=False), k, same)
    return _best(near.unionByName(rest), k).select("ask", "v", "w", "rank", "id", "score")


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, root_bytes: int = ROOT_BYTES) -> DataFrame:
    """rows: whole_vectors(). (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows for which `anchors` holds. Negatives have low to high hundredths of their positive's score.
    An id that stands with several labels or vectors asks as each of them.
    """
    rows = settle(rows)
    root = Root(pack(rows), root_bytes)
    ends = np.iinfo(np.int64)
    # an id may stand with several labels or vectors: v tells them apart
    asks = rows.where(anchors).select("id", F.xxhash64("label", "q").alias("v"), "label", "q")
    wide = F.array(F.struct(F.lit(0).alias("w"), F.lit(int(ends.min)).alias("low"), F.lit(int(ends.max)).alias("high")))
    found = settle(search(root, asks.withColumn("windows", wide), positives, same=True))
    # decimals, as hundredfold scores may leave 64 bits
    part = lambda share: F.col("score").cast("decimal(20,0)") * F.lit(share).cast("decimal(10,0)") / F.lit(100).cast("decimal(3,0)")
    bounds = F.struct(F.col("rank").alias("w"), F.ceil(part(low)).cast("long").alias("low"), F.floor(part(high)).cast("long").alias("high"))
    windows = found.groupBy("ask", F.col("v").alias("_v")).agg(F.sort_array(F.collect_list(bounds)).alias("windows"))  # as many as positives
    own = asks.join(windows, (F.col("id") == F.col("ask")) & (F.col("v") == F.col("_v"))).select("id", "v", "label", "q", F.filter("windows", lambda w: w["low"] <= w["high"]).alias("windows"))
    bad = search(root, own, negatives, same=False).select("ask", F.col("v").alias("_v"), "w", F.col("rank").alias("r"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    good = found.select(F.col("ask").alias("anchor_id"), "v", F.col("rank").alias("p"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = good.join(bad, (F.col("anchor_id") == F.col("ask")) & (F.col("v") == F.col("_v")) & (F.col("p") == F.col("w")))
    return joined.select("anchor_id", "positive_id", F.col("r").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = whole_vectors(table(spark, sf_dir, "embeddings").withColumn("label", moved))
    return hard_negatives(rows, F.col("id") % ANCHOR_EVERY == 0)


SQL = f"""
WITH rows_ AS (
  SELECT vec_id AS id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ r ON a.id <> r.id WHERE a.id % {ANCHOR_EVERY} = 0
),
good AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
)
SELECT g.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY g.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM good g JOIN pairs p ON p.anchor_id = g.anchor_id AND NOT p.same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
