"""Token-id files: one zstandard frame for each document, a shared dictionary, and an offset index.

A token set is a folder of two Parquet tables that Spark writes and reads, so it can be in any store:

* ``blocks``: (shard, block, first_doc, last_doc, dictionary_sha256, doc_ids, lengths, counts, starts,
  data). data is the documents' frames one after another; lengths are the frames' bytes, counts the
  documents' ids, starts the ids of the shard before each. Document ids ascend over shards, blocks and
  positions, so the statistics of first_doc and last_doc lead a reader to the one block that holds
  a document, and the lengths to the one frame.
* ``dictionary``: (sha256, kind, data), the dictionary that every frame needs, and how it was made.

The dictionary is trained on the serialized ids of a bounded, documented sample (SAMPLE_DOCS documents
with the lowest hash of their id, SAMPLE_IDS ids of each); every document is encoded and written whole.
Shards are ranges of doc_id. Their bounds come from the doc_id column alone, so texts are read once
and only compressed frames are shuffled.

Defined cases: a null text is the empty text, which has its end id only; a null doc_id comes first;
rows that share a doc_id stand next to each other, ordered by their frames within a shard, and are all
kept (an id with more rows than a shard is dealt over several); an empty table gives an empty set; the
string of a special token is that token, as the library has it. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Vocabulary, load_json
from .common import fresh_path, partitions, slices, table, text_slices

#: Bounds of the dictionary and of the sample that it is trained on.
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_IDS = 64 * 1024, 1000, 2048
#: A block is closed at the document that fills it.
BLOCK_BYTES = 1 << 20
LEVEL = 1
#: Bytes below which the library takes nothing for a dictionary.
LEAST_CONTENT = 8


def train_dictionary(docs: DataFrame, vocabulary: Vocabulary, end_id: int) -> tuple[bytes, str]:
    """docs: (doc_id, text). The dictionary and its kind.

    It is `trained` where the library can; a sample that is too small for that is the dictionary itself (`content`), as
    far as it has room; only a table without rows has none (`none`).
    """
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    end = _end(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with vocabulary.encoder() as encoder:
            for b in text_slices(batches, 1):
                cut = [(x + end)[: 4 * SAMPLE_IDS] for x in encoder.encode(b.column(1)).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cut, pa.binary())], ["doc_id", "ids"])

    # the broadcast side has SAMPLE_DOCS ids at most
    sample = docs.join(F.broadcast(chosen), "doc_id", "left_semi").mapInArrow(run, "doc_id long, ids binary").orderBy(F.xxhash64("doc_id"), "doc_id", "ids").limit(SAMPLE_DOCS)
    parts = [bytes(r.ids) for r in sample.select("ids").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes(), "trained"
    except zstandard.ZstdError:
        content = b"".join(parts)[-DICTIONARY_BYTES:]
        return (content, "content") if len(content) >= LEAST_CONTENT else (b"", "none")


def _end(end_id: int) -> bytes:
    return np.array([end_id], "<u4").tobytes()


def _compress(vocabulary: Vocabulary, end_id: int, dictionary: bytes, bounds: list[int]):
    """(doc_id, text) to (shard, doc_id, n, frame).

    Shard i holds ids above bounds[i - 1] up to bounds[i]. An id that stands in `bounds` several times fills
    as many shards, and its rows are dealt over them in the order in which a task reads them.
    """
    end, edges = _end(end_id), np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        read = 0
        with vocabulary.encoder() as encoder:
            for b in text_slices(batches, 1):
                frames, n = [], []
                for x in encoder.encode(b.column(1)).to_pylist():
                    frames.append(zip_.compress(x + end))
                    n.append(len(x) // 4 + 1)
                ids = b.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
                first, past = np.searchsorted(edges, ids), np.searchsorted(edges, ids, "right")
                shard = first + (read + np.arange(len(ids))) % np.maximum(past - first, 1)
                read += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), b.column(0), pa.array(n, pa.int64()), pa.array(frames, pa.binary())], ["shard", "doc_id", "n", "frame"])

    return run


#: Where a null doc_id stands.
_NULL_ID = int(np.iinfo(np.int64).min)


_BLOCKS = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("dictionary_sha256", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("data", pa.binary())])
_BLOCKS_DDL = "shard int, block long, first_doc long, last_doc long, dictionary_sha256 string, doc_ids array<bigint>, lengths array<bigint>, counts array<bigint>, starts array<bigint>, data binary"


def _pack(digest: str):
    """Frames in order to blocks; the state is one open block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, size, start = None, 0, 0, 0
        docs: list[int | None] = []
        counts: list[int] = []
        starts: list[int] = []
        frames: list[bytes] = []

        def close() -> pa.RecordBatch:
            known = [d for d in docs if d is not None]
            row = [shard, block, min(known, default=None), max(known, default=None), digest, list(docs), [len(f) for f in frames], list(counts), list(starts), b"".join(frames)]
            for x in (docs, counts, starts, frames):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCKS, strict=True)], schema=_BLOCKS)

        for b in slices(batches):
            for s, doc, n, frame in zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "n", "frame")), strict=True):
                if docs and (s != shard or size >= BLOCK_BYTES):
                    yield close()
                    block, size = (block + 1, 0) if s == shard else (0, 0)
                if s != shard:
                    shard, block, size, start = s, 0, 0, 0
                docs.append(doc)
                counts.append(n)
                starts.append(start)
                frames.append(frame)
                size += len(frame)
                start += n
        if docs:
            yield close()

    return run


def write_token_set(docs: DataFrame, path: str, definition: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", shards: int | None = None, special_as_text: bool = False) -> None:
    """special_as_text: whether the strings of special tokens in a text are ordinary text; by default they are the tokens, as in the library."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    shards = shards or partitions(spark)
    vocabulary = Vocabulary(spark, definition, special_as_text)
    dictionary, kind = train_dictionary(rows, vocabulary, end_id)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, kind, bytearray(dictionary))], "sha256 string, kind string, data binary").write.mode("overwrite").parquet(f"{path}/dictionary")
    # at most `shards` bounds come to the driver
    place = F.coalesce("doc_id", F.lit(_NULL_ID))
    bounds = rows.agg(F.percentile_approx(place, [i / shards for i in range(1, shards)], 10_000).alias("b")).first().b if shards > 1 else []
    frames = rows.mapInArrow(_compress(vocabulary, end_id, dictionary, sorted(bounds or [])), "shard int, doc_id long, n long, frame binary")
    dealt = frames.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "doc_id", "frame")
    dealt.mapInArrow(_pack(digest), _BLOCKS_DDL).write.mode("overwrite").parquet(f"{path}/blocks")


def _unpack(dictionary: bytes, digest: str, want: frozenset[int] | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for b in slices(batches, 1):
            for row in b.to_pylist():
                if row["dictionary_sha256"] != digest:
                    raise ValueError("the block needs another dictionary")
                at, out = 0, []
                for doc, length, n, start in zip(row["doc_ids"], row["lengths"], row["counts"], row["starts"], strict=True):
                    if want is None or doc in want:
                        out.append((doc, row["shard"], start, n, unzip.decompress(row["data"][at : at + length], max_output_size=4 * n)))
                    at += length
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "shard", "start", "n_tokens", "ids"])

    return run


def _dictionary(spark: SparkSession, path: str) -> tuple[bytes, str]:
    d = spark.read.parquet(f"{path}/dictionary").first()
    return bytes(d.data), d.sha256


def read_token_set(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, shard, start within the shard, n_tokens, ids as little-endian unsigned 32-bit integers)."""
    return spark.read.parquet(f"{path}/blocks").mapInArrow(_unpack(*_dictionary(spark, path)), "doc_id long, shard int, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """As read_token_set() for one document: opens the blocks whose range holds it and decompresses its frame only."""
    blocks = spark.read.parquet(f"{path}/blocks").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    return blocks.mapInArrow(_unpack(*_dictionary(spark, path), frozenset([doc_id])), "doc_id long, shard int, start long, n_tokens long, ids binary")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, base): the ids of all shards before, one row for each shard, from the index columns alone."""
    from pyspark.sql import Window

    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum(total).alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document, read from the files."""
    unpack = _unpack(*_dictionary(spark, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in unpack(batches):
            crc = [zlib.crc32(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(crc, pa.int64())], ["doc_id", "shard", "start", "n_tokens", "ids_crc32"])

    rows = spark.read.parquet(f"{path}/blocks").mapInArrow(run, "doc_id long, shard int, start long, n_tokens long, ids_crc32 long")
    # one row for each shard, as many as the writer's partitions
    return rows.join(F.broadcast(shard_starts(spark, path)), "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_path(spark, "tokens")
    write_token_set(table(spark, sf_dir, "documents"), path, load_json(public_tokenizers.path("byte_bpe_50k.json")))
    return token_digests(spark, path)
