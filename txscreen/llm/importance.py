"""Resampling of documents by importance weights towards a target text, with bit-sliced counts.

Features are runs of 1 to GRAMS words, hashed to BUCKETS buckets. One pass counts the buckets of the
corpus and of the target; the logarithm of their ratio is a bucket's gain, a signed integer. The second
pass turns a document's counts into bit planes (plane j has bit b where bit j of the count of bucket b
is set) and ANDs each with the planes of the positive and the negative gains: the population counts, times
2 to the sum of both planes' numbers, add up to the exact sum of the document's gains. Scores are weights plus
Gumbel noise from a hash of the document's id, so the highest scores are a draw without replacement in
proportion to the weights, and reruns agree.

A task holds some megabytes of text, its bucket counts and one set of gain planes, whatever its share
of the input. What leaves a counting task is one number for each bucket. Ranks come from a histogram of
scores, summed in range partitions; only documents at or above the score of the last drawn one are
sorted, each score's in a group of its own, so equal texts are spread by their noise.

Defined cases: a null text has no words; a document without features has weight 0; a null doc_id hashes
as the empty text and comes after all others among ties; repeated rows are documents of their own and
share their weight; without target texts all gains still exist (counts of 0); an empty table gives no
rows; other columns are ignored. Words are cut in bytes: all bytes from 0x80 are parts of words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.running import running_totals
from .common import release_memory, settle, table, text_slices

BUCKETS, GRAMS, SCALE, SEED = 10_000, 1, 1000, 2024
LEAST_WORDS, SHARE = 20, 10
#: Documents whose planes are made at once.
PLANE_ROWS = 32
_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Small letters for A-Z, a blank for each byte that is part of no word.
_TABLE = bytes((lambda c: c if c in _WORD else 0x20)(b + 0x20 if 0x41 <= b <= 0x5A else b) for b in range(256))


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and the number of the text that each is of."""
    clean = pa.array([b"" if t is None else t.translate(_TABLE) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())
    cut = pc.split_pattern(clean, pattern=b" ")
    words, doc = cut.flatten(), pc.list_parent_indices(cut).to_numpy(zero_copy_only=False)
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), doc[full.to_numpy(zero_copy_only=False)]


def features(texts: pa.Array, grams: int = GRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of each feature."""
    words, doc = _words(texts)
    docs, found = [], []
    for n in range(1, grams + 1):
        if len(words) < n:
            break
        runs = words if n == 1 else pc.binary_join_element_wise(*[words.slice(i, len(words) - n + 1) for i in range(n)], b" ")
        inside = doc[: len(doc) - n + 1] == doc[n - 1 :]
        coded = runs.dictionary_encode()
        hashes = np.fromiter((zlib.crc32(w.as_buffer()) % buckets for w in coded.dictionary), np.int64, len(coded.dictionary))
        found.append(hashes[coded.indices.to_numpy()][inside])
        docs.append(doc[: len(doc) - n + 1][inside])
    return (np.concatenate(docs), np.concatenate(found)) if docs else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def bucket_counts(texts: DataFrame, text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of the buckets that have features; a task sends one number for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in text_slices(batches, 0):
            total += np.bincount(features(b.column(0), grams, buckets)[1], minlength=buckets)
        (at,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])
        release_memory()

    return texts.select(F.col(text).cast("string")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """A gain for each bucket, from bucket_counts() of both."""
    spark = corpus.sparkSession
    every = spark.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    both = settle(both)
    total = both.agg(F.sum("s").cast("double").alias("_s"), F.sum("t").cast("double").alias("_t"))
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    gain = F.floor(SCALE * F.log((t + 1) * (F.col("_s") + buckets) / ((s + 1) * (F.col("_t") + buckets))))
    # one row for each bucket, however large the corpus
    rows = both.crossJoin(F.broadcast(total)).select("bucket", gain.alias("g")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.g
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    spare = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, spare)])).view(np.uint64)


class GainPlanes:
    """The bit planes of the positive and of the negative gains."""

    def __init__(self, gain: np.ndarray) -> None:
        size = np.abs(gain)
        self.depth = max(1, int(size.max(initial=0)).bit_length())
        planes = np.stack([(size >> i) & 1 for i in range(self.depth)]).astype(bool)
        self.more, self.less = _packed(planes & (gain > 0)), _packed(planes & (gain < 0))

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """counts: (document, bucket). The sum of gains of each document."""
        out = np.zeros(len(counts), np.int64)
        for j in range(int(counts.max(initial=0)).bit_length()):
            plane = _packed(((counts >> j) & 1).astype(bool))
            for i in range(self.depth):
                more = np.bitwise_count(plane & self.more[i]).sum(axis=1, dtype=np.int64)
                less = np.bitwise_count(plane & self.less[i]).sum(axis=1, dtype=np.int64)
                out += (more - less) << (i + j)
        return out


def document_weights(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", grams: int = GRAMS) -> DataFrame:
    """(doc_id, n_words, n_features, weight), a row for each document."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = GainPlanes(gain)
        for b in text_slices(batches, 1):
            doc, bucket = features(b.column(1), grams, buckets)
            order = np.argsort(doc, kind="stable")
            doc, bucket = doc[order], bucket[order]
            n = np.bincount(doc, minlength=b.num_rows)
            words = n if grams == 1 else np.bincount(_words(b.column(1))[1], minlength=b.num_rows)
            ends, total = np.concatenate([[0], np.cumsum(n)]), np.zeros(b.num_rows, np.int64)
            for at in range(0, b.num_rows, PLANE_ROWS):
                past = min(b.num_rows, at + PLANE_ROWS)
                own = slice(ends[at], ends[past])
                counts = np.bincount((doc[own] - at) * buckets + bucket[own], minlength=(past - at) * buckets).reshape(-1, buckets)
                total[at:past] = planes.sums(counts)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x.astype(np.int64)) for x in (words, n, weight))], ["doc_id", "n_words", "n_features", "weight"])
        release_memory()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """A document's Gumbel noise in whole parts of SCALE."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(text, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked_draw(scored: DataFrame, share: int = SHARE, least: int = LEAST_WORDS) -> DataFrame:
    """scored: (doc_id, n_words, score, ...), settled. Adds rank: the place of the drawn ones, null for all others.

    Drawn are the share, in hundredths, of the documents with at least `least` words.
    """
    part = scored.where(F.col("n_words") >= least)
    levels = settle(running_totals(part.groupBy("score").agg(F.count(F.lit(1)).alias("n")), "score", ["n"], descending=True))
    most = (levels.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) * share // 100
    last = levels.where(F.col("run_n") - F.col("n") < most).agg(F.min("score")).first()[0]
    none = F.lit(None).cast("long")
    if last is None:
        return scored.withColumn("rank", none)
    near = F.coalesce((F.col("n_words") >= least) & (F.col("score") >= last), F.lit(False))
    before = levels.where(F.col("score") >= last).select("score", (F.col("run_n") - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id")))
    rank = F.col("before") + own
    high = scored.where(near).join(before, "score").withColumn("rank", F.when(rank <= most, rank))
    return scored.where(~near).withColumn("rank", none).unionByName(high.drop("before"))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS, share: int = SHARE, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of each document; target: a table with the column `text`."""
    gain = gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, text, grams, buckets), buckets)
    scored = settle(document_weights(docs, gain, doc_id, text, grams).withColumn("score", F.col("weight") + noise(seed=seed)))
    return ranked_draw(scored, share, least)


def drawn_documents(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **settings) -> DataFrame:
    """The documents that resample() draws, with all their columns."""
    ids = resample(docs, target, doc_id, **settings).where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn"))
    return docs.join(ids, F.col(doc_id).cast("long").eqNullSafe(F.col("_drawn")), "left_semi")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")
