"""Exact k nearest neighbours of all rows of a table among themselves, by a pivot-partitioned join.

Pivots are rows with the lowest hashes; each row belongs to the cell of its nearest pivot. A query first visits as many of
the cells nearest to it as hold k rows; the k-th distance found there bounds what else can matter: a cell is
visited next only if the triangle inequality lets one of its rows be as near, from the distances to both pivots
and from the least and the greatest distance of the cell's rows to their pivot. A cell with more than
BLOCK_ROWS rows is dealt over blocks, and a query visits each of them, so no task holds a whole hot cell.

Equal rows are one position: a position asks once, and of its rows only the k + 1 with the smallest ids can
be a neighbour of anything, so a position with a third of all rows costs no more than others. Pivots
and a row for each cell go to the tasks; there are MOST_PIVOTS at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..durable import settle

#: Rows that a pivot stands for, pivots at most, rows of a block.
CELL_ROWS, MOST_PIVOTS, BLOCK_ROWS = 500, 4096, 2000
#: Parts of a position whose smallest ids are found apart first.
_PARTS = 64
#: Distances this much larger, in proportion, are no proof that a cell is too far.
_SLACK = 1e-9


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The distance of each row of x to each row of y."""
    return np.sqrt(np.stack([((y - r) ** 2).sum(axis=1) for r in x])) if len(x) else np.zeros((0, len(y)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class _Cells:
    """What tasks know of all cells: pivots, sizes and radii."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots = pivots
        self.rows = np.zeros(len(pivots), np.int64)
        self.least, self.most = np.full(len(pivots), np.inf), np.zeros(len(pivots))
        self.between = _distances(pivots, pivots)

    @property
    def blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.rows // BLOCK_ROWS))

    @property
    def base(self) -> np.ndarray:
        """The number of each cell's first block."""
        return np.concatenate([[0], np.cumsum(self.blocks)[:-1]])

    def first(self, to: np.ndarray, wanted: int) -> np.ndarray:
        """The nearest cells that have `wanted` rows together."""
        order = np.argsort(to, kind="stable")
        past = int(np.searchsorted(np.cumsum(self.rows[order]), wanted)) + 1
        return order[:past]

    def near(self, to: np.ndarray, limit: float) -> np.ndarray:
        """The cells that can have a row within `limit`; to: the distances to all pivots."""
        own = int(to.argmin())
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(self.between[own] > 0, (to**2 - to[own] ** 2) / (2 * self.between[own]), 0.0)
        bound = np.maximum(np.maximum(plane, to - self.most), self.least - to)
        return np.flatnonzero((self.rows > 0) & (bound <= limit + _SLACK * (1 + limit + to)))


def _search(k: int, dim: int):
    def best(held: tuple, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, x = held
        d = np.sqrt(((x - q) ** 2).sum(axis=1))
        if len(d) > 4 * k:
            cut = np.partition(d, k - 1)[k - 1]
            keep = np.flatnonzero(d <= cut)
        else:
            keep = np.arange(len(d))
        order = keep[np.lexsort((ids[keep], d[keep]))][:k]
        return ids[order], d[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, held = None, [], None
        for b in batches:
            blocks, asks, x = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False).astype(bool), _matrix(b.column(3), dim)
            ids = np.array(b.column(2).to_pylist())
            edges = np.flatnonzero(np.diff(blocks) != 0) + 1
            who, found, far = [], [], []
            for at, past in zip([0, *edges], [*edges, len(blocks)], strict=True):
                if past == at:
                    continue
                if blocks[at] != block:
                    block, parts, held = blocks[at], [], None
                first = at + int(np.argmax(asks[at:past])) if asks[at:past].any() else past
                if first > at:
                    parts.append((ids[at:first], x[at:first]))
                if first < past and parts and held is None:
                    held = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                for i in range(first, past) if held is not None else ():
                    near, d = best(held, x[i])
                    who += [ids[i]] * len(near)
                    found.append(near)
                    far.append(d)
            near = np.concatenate(found).tolist() if found else []
            kind = b.schema.field(2).type
            yield pa.RecordBatch.from_arrays([pa.array([w.item() for w in who], kind), pa.array(near, kind), pa.array(np.concatenate(far) if far else np.zeros(0))], ["a", "b", "d"])

    return run


def nearest(points: DataFrame, k: int) -> DataFrame:
    """points: (a, s): ids, each once, and vectors of one length. (a, b, d, r): the k nearest other rows of each, ranked from 1 by (d, b).

    Rows of fewer than k others get them all. NaN is not supported: such vectors must not come.
    """
    points = settle(points.select("a", "s"))
    kind = points.schema["a"].dataType.simpleString()
    n, dim = points.agg(F.count(F.lit(1)), F.max(F.size("s"))).first()
    if not n:
        return points.select("a", F.col("a").alias("b"), F.lit(0.0).alias("d"), F.lit(0).alias("r"))
    part = F.pmod(F.xxhash64("a"), F.lit(_PARTS))
    smallest = lambda rows, *by: rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("a"))).where(F.col("_r") <= k + 1).drop("_r")
    targets = smallest(smallest(points.withColumn("_p", part), "s", "_p").drop("_p"), "s")
    asks = points.groupBy("s").agg(F.min("a").alias("a")).select("a", "s")
    wanted = min(MOST_PIVOTS, max(1, -(-n // CELL_ROWS)))
    # MOST_PIVOTS rows at most
    chosen = asks.orderBy(F.xxhash64("s"), "a").limit(wanted).collect()
    cells = _Cells(np.array([r.s for r in chosen], np.float64).reshape(-1, dim))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            to = _distances(_matrix(b.column(1), dim), cells.pivots)
            own = to.argmin(axis=1) if len(to) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int64)), pa.array(to[np.arange(len(to)), own])], ["a", "s", "cell", "to"])

    placed = settle(targets.select("a", "s").mapInArrow(place, f"a {kind}, s array<double>, cell long, to double"))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("to").alias("least"), F.max("to").alias("most")).collect():  # a row for each pivot
        cells.rows[r.cell], cells.least[r.cell], cells.most[r.cell] = r.n, r.least, r.most
    numbers = points.sparkSession.createDataFrame([(i, int(c), int(b)) for i, (c, b) in enumerate(zip(cells.blocks, cells.base, strict=True))], "cell long, _blocks long, _base long")
    block = F.col("_base") + F.pmod(F.xxhash64("a"), F.col("_blocks"))
    held = settle(placed.join(F.broadcast(numbers), "cell").select(block.alias("block"), F.lit(0).alias("ask"), "a", "s"))  # a row for each pivot
    count = int(cells.blocks.sum())

    def blocks_of(first: bool):
        base, blocks = cells.base, cells.blocks

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                limits = b.column(2).to_numpy(zero_copy_only=False) if not first else None
                to = _distances(_matrix(b.column(1), dim), cells.pivots)
                rows, out = [], []
                for i in range(b.num_rows):
                    opened = cells.first(to[i], k + 1)
                    if first:
                        at = opened
                    else:
                        limit = limits[i] if limits[i] is not None and limits[i] == limits[i] else np.inf
                        at = np.setdiff1d(cells.near(to[i], limit), opened)
                    for c in at:
                        own = range(base[c], base[c] + blocks[c])
                        rows += [i] * len(own)
                        out += own
                taken = b.select(["a", "s"]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(np.ones(len(out), np.int32)), taken.column(0), taken.column(1)], ["block", "ask", "a", "s"])

        return run

    def visit(asked: DataFrame, first: bool) -> DataFrame:
        to = asked.mapInArrow(blocks_of(first), f"block long, ask int, a {kind}, s array<double>")
        dealt = held.unionByName(to).repartition(min(count, 4096), "block").sortWithinPartitions("block", "ask")
        return settle(dealt.mapInArrow(_search(k + 1, dim), f"a {kind}, b {kind}, d double"))

    def ranked(found: DataFrame, most: int) -> DataFrame:
        return found.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy("d", "b"))).where(F.col("r") <= most)

    near = visit(asks, True)
    limits = ranked(near, k + 1).where(F.col("r") == k + 1).select(F.col("a").alias("_a"), F.col("d").alias("limit"))
    rest = visit(asks.join(limits, F.col("a") == F.col("_a"), "left").select("a", "s", "limit"), False)
    lists = ranked(near.unionByName(rest), k + 1)
    # each row has the list of its position, without itself
    own = points.join(asks.select("s", F.col("a").alias("_q")), "s").select("a", "_q")
    pairs = own.join(lists.withColumnRenamed("a", "_q").drop("r"), "_q").where(F.col("a") != F.col("b"))
    return ranked(pairs.select("a", "b", "d"), k)
