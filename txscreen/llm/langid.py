"""Language identification with a bit-sliced Bloom filter of n-grams.

One filter answers for all languages: each of its places holds a mask with one bit for each
language, an n-gram has HASHES places, and the AND of their masks is the set of languages that
contain it. A text's n-grams are looked up in that way and each language's bit is counted. The
share of false answers of a language is known from how full its bit-slice is; a count is corrected
for it, and the language with the largest corrected share of the text's n-grams is the prediction.

A language contains an n-gram if the n-gram is frequent there: at least MIN_SHARE of the rate of the
language where it is most frequent, and at least MIN_RATE of the language's n-grams, of which there can't
be more than 1 / MIN_RATE. The filter is fitted on a bounded sample: the LANG_DOCS labelled documents of each
language with the lowest hashes of their ids (all rows of the last of these ids). It has as many places as
keep the rate of false answers at FALSE_RATE. Every document is then predicted from its whole text.

An n-gram is N characters of the lower-cased text in which every run of other characters than
letters is one blank, with a blank at either end.

Defined cases: a null text, or one without letters, is `und` with score 0; a text none of whose
n-grams is known gets the language with the most n-grams in the sample, with score 0; ties go to the
smallest language name; a null doc_id counts as the empty text in the fold; without any labelled
document every prediction is `und`; repeated rows get the same result; other columns are ignored by
the prediction and kept by predict().
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SLICE_ROWS, release_memory, settle, table, text_slices

N, HASHES, FALSE_RATE = 4, 3, 0.005
LANG_DOCS, MIN_COUNT, MIN_RATE, MIN_SHARE = 1000, 3, 2.0**-19, 0.25
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def grams(texts: list[str | None], most_chars: int = 1 << 18) -> Iterator[tuple[int, np.ndarray]]:
    """(position in texts, hashes of n-grams); a long text comes in several parts that share no n-gram."""
    letter = _is_letter()
    for i, text in enumerate(texts):
        tail = np.array([32], np.uint32)
        for at in range(0, len(text or ""), most_chars):
            c = np.frombuffer(text[at : at + most_chars].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            c = np.concatenate([tail, np.where(letter[c], c, 32).astype(np.uint32)])
            if at + most_chars >= len(text):
                c = np.append(c, np.uint32(32))
            c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))]
            if len(c) >= N:
                h = np.zeros(len(c) - N + 1, np.uint64)
                for k in range(N):
                    h = h * np.uint64(0x100000001B3) + c[k : len(c) - N + 1 + k]
                h ^= h >> np.uint64(29)
                h *= np.uint64(0xBF58476D1CE4E5B9)
                h ^= h >> np.uint64(32)
                yield i, h
            tail = c[-(N - 1) :]


def has_letter(texts: list[str | None]) -> np.ndarray:
    return np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)


def _places(h: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    """Double hashing; slots is a power of two."""
    step = (h >> np.uint64(33)) | np.uint64(1)
    for k in range(HASHES):
        yield ((h + np.uint64(k) * step) & np.uint64(slots - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: (words, slots): word w has the bits of languages 64w to 64w + 63.
    masks: np.ndarray
    #: Of each language, the share of unknown n-grams that its bit-slice contains.
    false_rate: np.ndarray
    fallback: int

    def shares(self, texts: list[str | None]) -> np.ndarray:
        """(text, language): the corrected share of the text's n-grams that the language contains."""
        out, seen = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for i, h in grams(texts):
            places = list(_places(h, self.masks.shape[1]))
            for w, mask in enumerate(self.masks):
                found = mask[places[0]]
                for p in places[1:]:
                    found = found & mask[p]
                for b in range(min(64, len(self.languages) - 64 * w)):
                    out[i, 64 * w + b] += np.count_nonzero(found & mask.dtype.type(1 << b))
            seen[i] += len(h)
        raw = out / np.maximum(seen, 1)[:, None]
        return np.clip((raw - self.false_rate) / (1 - self.false_rate), 0, 1) * (seen > 0)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, coverage): score is the best language's part of all shares, coverage its share."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        share = self.shares(texts)
        known, best, total = has_letter(texts), share.argmax(axis=1), share.sum(axis=1)
        best = np.where(total > 0, best, self.fallback)
        top = share[np.arange(len(texts)), best] * known
        score = np.where(known & (total > 0), top / np.where(total > 0, total, 1), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], score, top


def build(counts: DataFrame) -> Model:
    """counts: (lang, gram, n) of the sample. What comes to the driver is a row for each language and the filter's places."""
    spark = counts.sparkSession
    counts = settle(counts)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    names = sorted((r.lang, r.total) for r in totals.collect())
    if not names:
        return Model([], np.zeros((1, 64), np.uint8), np.zeros(0), 0)
    languages = [name for name, _ in names]
    places = spark.createDataFrame([(name, total, i) for i, (name, total) in enumerate(names)], "lang string, total long, i int")
    rates = counts.join(places, "lang").select("i", "gram", (F.col("n") / F.col("total")).alias("rate")).where(F.col("rate") >= MIN_RATE)
    top = rates.groupBy("gram").agg(F.max("rate").alias("top"))
    kept = settle(rates.join(top, "gram").where(F.col("rate") >= MIN_SHARE * F.col("top")).select("i", "gram"))
    most = kept.groupBy("i").count().agg(F.max("count")).first()[0]
    slots = slots_for(most)
    # as in _places(); the low bits are enough, and don't overflow
    low = lambda c: c.bitwiseAND(F.lit(slots - 1).cast("long"))
    step = F.shiftrightunsigned("gram", 33).bitwiseOR(F.lit(1).cast("long"))
    slot = F.explode(F.array(*[low(low(F.col("gram")) + F.lit(k).cast("long") * low(step)) for k in range(HASHES)]))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("i") % 64)
    found = kept.select(F.floor(F.col("i") / 64).cast("int").alias("word"), slot.alias("slot"), bit.alias("bit")).groupBy("word", "slot").agg(F.bit_or("bit").alias("mask")).toArrow()
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    masks = np.zeros((-(-len(languages) // 64), slots), kind)
    masks[found["word"].to_numpy(), found["slot"].to_numpy()] = found["mask"].to_numpy().view(np.uint64).astype(kind)
    filled = np.array([np.count_nonzero(masks[i // 64] & kind(1 << (i % 64))) / slots for i in range(len(languages))])
    return Model(languages, masks, filled**HASHES, max(range(len(names)), key=lambda i: (names[i][1], -i)))


def slots_for(grams: int) -> int:
    """Places, a power of two, at which a language of so many n-grams has FALSE_RATE or less."""
    least = -HASHES * max(1, grams) / math.log(1 - FALSE_RATE ** (1 / HASHES))
    return 1 << max(6, math.ceil(math.log2(least)))


def train(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fits on rows with a label: LANG_DOCS documents of each language, those with the lowest hashes of their ids."""
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    # about twice the wanted rows of each language pass a cut on their hash, whatever the language's size
    rows = rows.withColumn("place", F.shiftright(F.xxhash64("id"), 1).cast("double") / float(1 << 63) + 0.5)
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    near = rows.select("id", "lang", "place").join(F.broadcast(sizes), "lang").where(F.col("place") < F.lit(2.0 * LANG_DOCS) / F.col("n"))  # one row for each language
    order = Window.partitionBy("lang").orderBy("place", "id")
    last = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= LANG_DOCS).groupBy("lang").agg(F.max("place").alias("last"))
    # one row for each language
    sample = rows.join(F.broadcast(last), "lang").where(F.col("place") <= F.col("last"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 0):
            texts, langs = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), object)
            own: dict[str, list[np.ndarray]] = {}
            for i, h in grams(texts):
                own.setdefault(langs[i], []).append(h)
            for name, parts in own.items():
                g, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n, pa.int64())], ["lang", "gram", "n"])
        release_memory()

    counts = sample.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return build(counts.where(F.col("n") >= MIN_COUNT))


def predict(docs: DataFrame, model: Model, text: str = "text", to: str = "lang_id") -> DataFrame:
    """docs with a struct (lang_pred, score, coverage). The model goes out once for each executor."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, coverage double")
    def run(series: pd.Series) -> pd.DataFrame:
        parts = [held.value.predict(list(series[at : at + SLICE_ROWS])) for at in range(0, len(series), SLICE_ROWS)]
        release_memory()
        name = [n for p in parts for n in p[0]]
        score, coverage = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in (1, 2))
        return pd.DataFrame({"lang_pred": name, "score": score, "coverage": coverage})

    return docs.withColumn(to, run(F.col(text).cast("string")))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_id.lang_pred", "lang_id.score", "lang_id.coverage")
