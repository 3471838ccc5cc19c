"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txscreen.operators import neighbours as K


def brute(ids, x, k):
    out = {}
    for i in range(len(ids)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[ids[i]] = [(ids[j], d[j]) for j in order]
    return out


def joined(spark, ids, x, k):
    rows = spark.createDataFrame([(i if isinstance(i, str) else int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)], f"a {'string' if isinstance(ids[0], str) else 'long'}, s array<double>")
    out = {i: [] for i in ids}
    for r in K.nearest(rows, k).orderBy("a", "r").collect():
        out[r.a].append((r.b, r.d))
    return out


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_all_neighbours_are_found(spark, spread):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(12, 5))[draw.integers(0, 12, 5000)] + draw.normal(size=(5000, 5)) * spread
    ids = np.arange(5000) * 7 % 5003
    assert joined(spark, ids, x, 5) == brute(ids, x, 5)


def test_ties_hot_positions_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "CELL_ROWS", 40)
    monkeypatch.setattr(K, "BLOCK_ROWS", 30)
    draw = np.random.default_rng(9)
    x = np.concatenate([np.ones((700, 2)), draw.integers(0, 6, (800, 2)), [[1e6, 0.0]]])
    ids = draw.permutation(len(x))
    assert joined(spark, ids, x, 5) == brute(ids, x, 5)
    names = [f"e{i}" for i in range(4)]
    assert joined(spark, names, np.arange(4.0)[:, None], 5) == brute(np.array(names), np.arange(4.0)[:, None], 5)
    assert K.nearest(spark.createDataFrame([], "a long, s array<double>"), 5).count() == 0
    assert K.nearest(spark.createDataFrame([(1, [0.0])], "a long, s array<double>"), 5).count() == 0


def test_far_cells_are_not_visited():
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(50, 3)) * 20
    cells, x = K._Cells(centres), np.repeat(centres, 40, axis=0) + draw.normal(size=(2000, 3)) * 0.1
    to = K._distances(x, centres)
    own = to.argmin(axis=1)
    for c in range(50):
        mine = to[own == c, c]
        cells.rows[c], cells.least[c], cells.most[c] = len(mine), mine.min(initial=np.inf), mine.max(initial=0)
    visits = [len(cells.near(t, 0.5)) for t in to]
    assert np.mean(visits) < 2


def test_oversampled_rows_lie_between_neighbours(spark):
    from txscreen.operators import training as T

    draw = np.random.default_rng(3)
    few = draw.normal(size=(60, 2))
    rows = spark.createDataFrame([(i, 1, float(a), float(b)) for i, (a, b) in enumerate(few)] + [(100 + i, 0, 0.0, 0.0) for i in range(3000)], "event_id long, is_fraud int, u double, v double")
    made = np.array([(r.u, r.v) for r in T.oversample(rows, ["u", "v"]).where("is_fraud = 1").collect()])
    assert len(made) == 300
    scaled = (few - few.mean(axis=0)) / few.std(axis=0, ddof=1)
    lines = [(few[i], few[j]) for i in range(60) for j in np.argsort(((scaled - scaled[i]) ** 2).sum(axis=1))[1:6]]
    for p in made:
        off = min(abs((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])) / (np.hypot(*(b - a)) + 1e-12) for a, b in lines)
        assert off < 1e-9 or (np.abs(few - p).sum(axis=1) < 1e-9).any()
