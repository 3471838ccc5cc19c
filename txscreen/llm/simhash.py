"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprint: a 64-bit majority vote over the XXH64 (seed 42) of a text's 3-word shingles. Documents
with equal fingerprints are one node; nodes link at RADIUS differing bits or fewer.

Candidate search. The 64 bits are three segments of 22, 21 and 21 bits, each read as a word of the
perfect binary Golay code of length 23. The decoder maps a word to the index of the one codeword
within distance 3. The fuzzy keys of a word are the indices of all words within one bit of it, one
key or six: words within two bits of each other share a key. With three errors or fewer

* either some segment has none and the next one (in a cycle) has two at most: key = the first
  segment as it is and a fuzzy key of the next one, for each of the three segments;
* or each segment has exactly one: key = an index for each segment. One side of the pair takes the
  fuzzy keys of the second segment and the plain indices of the others, the other side the reverse.

So every pair within RADIUS meets under a key of 33 bits or more, and no cap is needed for that.
Rows are sorted by key and runs of equal keys are verified where they stand. A long run is reduced
to stars around pivots, whose groups are compared only where the triangle inequality allows a link,
and stops comparing two groups once they are connected. A run of over RUN_ROWS nodes is split into
blocks, and each pair of blocks is verified in a task of its own. Only spanning edges leave a task,
never all pairs of a group.

Defined cases: a null or blank text has fingerprint zero and links as any other; repeated rows and
repeated ids are rows of their own with the same result; a null doc_id never names a component unless
all of its documents have none; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release_memory, settle, table
from .components import components

SHINGLE, RADIUS = 3, 3
#: (shift, bits) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Runs up to this length are compared row by row with their followers; longer ones by pivots.
SHORT_RUN = 24
#: Nodes of one key that a task holds at once.
RUN_ROWS = 1 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_HASHES = 1 << 16


def fingerprint(text: str | None) -> int:
    """bytes.split() cuts at the blanks 0x20 and 0x09 to 0x0D and nothing else."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _HASHES):
        part = words[at : min(n, at + _HASHES) + SHINGLE - 1]
        h = [digest(b" ".join(s), 42) for s in zip(*(part[i:] for i in range(SHINGLE)), strict=False)] if len(words) >= SHINGLE else [digest(b" ".join(words), 42)]
        ones += np.unpackbits(np.array(h, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprint_column(text: str = "text"):
    """The fingerprint of a text column as a signed long."""

    @F.pandas_udf("long")
    def run(series: pd.Series) -> pd.Series:
        out = pd.Series(np.array([fingerprint(t) for t in series], np.uint64).astype(np.int64))
        release_memory()
        return out

    return run(F.col(text).cast("string"))


_decoder: np.ndarray | None = None


def golay_decoder() -> np.ndarray:
    """The codeword index of each 23-bit word. Codeword m is m times the generator polynomial."""
    global _decoder
    if _decoder is None:
        g = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
        m = np.arange(4096, dtype=np.int64)
        words = np.zeros(4096, np.int64)
        for i in range(12):
            words ^= np.where((m >> i) & 1, g << i, 0)
        bit = [1 << i for i in range(23)]
        errors = [0, *bit, *(a | b for i, a in enumerate(bit) for b in bit[:i]), *(a | b | c for i, a in enumerate(bit) for j, b in enumerate(bit[:i]) for c in bit[:j])]
        made = np.full(1 << 23, 0xFFFF, np.uint16)
        for e in errors:
            made[words ^ e] = m
        _decoder = made
    return _decoder


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    return [((fp >> np.uint64(s)) & np.uint64((1 << b) - 1)).astype(np.int64) for s, b in SEGMENTS]


def _fuzzy(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for each fuzzy key of each word."""
    flips = np.array([0, *(1 << i for i in range(bits))], np.int64)
    found = np.sort(golay_decoder()[words[:, None] ^ flips].astype(np.int64), axis=1)
    first = np.ones(found.shape, bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, at = np.nonzero(first)
    return rows, found[rows, at]


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for all keys of all fingerprints."""
    seg, code = _segments(fp), []
    fuzzy = [_fuzzy(w, b) for w, (_, b) in zip(seg, SEGMENTS, strict=True)]
    code = [golay_decoder()[w].astype(np.int64) for w in seg]
    rows, keys = [], []
    for i in range(3):
        r, k = fuzzy[(i + 1) % 3]
        rows.append(r)
        keys.append(((i + 1) << 40) | (seg[i][r] << 12) | k)
    r, k = fuzzy[1]
    rows.append(r)
    keys.append((code[0][r] << 24) | (k << 12) | code[2][r])
    # each fuzzy key of the first segment with each of the third
    (r0, k0), (r2, k2) = fuzzy[0], fuzzy[2]
    n0, n2 = np.bincount(r0, minlength=len(fp)), np.bincount(r2, minlength=len(fp))
    begin2 = np.cumsum(n2) - n2
    left = np.repeat(np.arange(len(r0)), n2[r0])
    within = np.arange(len(left)) - np.repeat(np.cumsum(n2[r0]) - n2[r0], n2[r0])
    right = begin2[r0[left]] + within
    rows.append(r0[left])
    keys.append((k0[left] << 24) | (code[1][r0[left]] << 12) | k2[right])
    return np.concatenate(rows), np.concatenate(keys)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows, keys = fuzzy_keys(fp.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(fp[rows], pa.int64())], ["key", "fp"])


class _Forest:
    """Union-find that tells which unions joined two sets."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _near(a: np.ndarray, b: np.ndarray, most: int = RADIUS) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= most


def _one_link(a: np.ndarray, b: np.ndarray, rows: int = 1024) -> tuple[int, int] | None:
    """A link between the two sets, if there is one, found in squares of `rows`."""
    for i in range(0, len(a), rows):
        for j in range(0, len(b), rows):
            x, y = np.nonzero(_near(a[i : i + rows, None], b[None, j : j + rows]))
            if len(x):
                return int(a[i + x[0]]), int(b[j + y[0]])
    return None


def dense_edges(fp: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what links of a run connect."""
    left, groups, edges = np.unique(fp), [], []
    while len(left):
        near = _near(left, left[0])
        groups.append(left[near])
        edges += [(int(left[0]), int(x)) for x in left[near][1:]]
        left = left[~near]
    pivots, sets = np.array([g[0] for g in groups], np.uint64), _Forest()
    for i, own in enumerate(groups):
        for j in (np.flatnonzero(_near(pivots[i + 1 :], pivots[i], 3 * RADIUS)) + i + 1).tolist():
            if sets.find(i) == sets.find(j):
                continue
            link = _one_link(own, groups[j])
            if link:
                sets.union(i, j)
                edges.append(link)
    return edges


def _link(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted (key, fp) to (kind, a, b): kind 0 an edge, kind 1 a node b of a key a with over `most` nodes."""

    def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "a", "b"])

    def edges_of(keys: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(at, len(keys)))
        pairs: list[tuple[int, int]] = []
        for i in np.flatnonzero(size > SHORT_RUN).tolist():
            pairs += dense_edges(fp[at[i] : at[i] + size[i]])
        keep = np.repeat((size > 1) & (size <= SHORT_RUN), size)
        k, f = keys[keep], fp[keep]
        for d in range(1, SHORT_RUN):
            i = np.flatnonzero(k[d:] == k[:-d])
            if not len(i):
                break
            i = i[_near(f[i], f[i + d]) & (f[i] != f[i + d])]
            pairs += zip(f[i].tolist(), f[i + d].tolist(), strict=True)
        sets = _Forest()
        pairs = [p for p in dict.fromkeys(pairs) if sets.union(*p)]
        if pairs:
            a = np.array(pairs, np.uint64)
            yield out(0, a[:, 0].copy(), a[:, 1].copy())

    keys, fp, over = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
    for b in batches:
        keys = np.concatenate([keys, b.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([fp, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(keys):
            continue
        if over is not None or (keys[0] == keys[-1] and len(keys) > most):
            over = keys[0] if over is None else over
            n = int(np.searchsorted(keys, over, "right"))
            yield out(1, keys[:n], fp[:n])
            keys, fp = keys[n:], fp[n:]
            if not len(keys):
                continue
            over = None
        last = int(np.searchsorted(keys, keys[-1], "left"))
        if last:
            yield from edges_of(keys[:last], fp[:last])
            keys, fp = keys[last:], fp[last:]
    if len(keys):
        if over is not None:
            yield out(1, keys, fp)
        else:
            yield from edges_of(keys, fp)


def _linked(rows: DataFrame, most: int) -> DataFrame:
    dealt = rows.repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(lambda it: _link(it, most), "kind int, a long, b long")


def fingerprint_edges(nodes: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """nodes: (fp), distinct. (a, b): edges that connect all fingerprints that links connect."""
    found = settle(_linked(nodes.mapInArrow(_emit_keys, "key long, fp long"), run_rows))
    # what had more nodes than a task holds: blocks of half that size, each pair of blocks by itself
    over = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    blocks = over.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 2.0 / run_rows).cast("long").alias("n"))
    own = over.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")))
    paired = own.select("key", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other"))
    paired = paired.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp")
    rest = _linked(paired, 1 << 62)
    return found.where("kind = 0").select("a", "b").union(rest.where("kind = 0").select("a", "b"))


def near_duplicates(prints: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """prints: (doc_id, fp). (fp, component, component_id), one row for each fingerprint."""
    nodes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")))
    groups = components(fingerprint_edges(nodes.select("fp"), run_rows))
    named = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_doc", F.coalesce("component", "fp").alias("component"))
    first = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    return named.join(first, "component").select("fp", "component", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prints = settle(docs.select(F.col("doc_id").cast("long"), fingerprint_column().alias("fp")))
    found = near_duplicates(prints)
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
