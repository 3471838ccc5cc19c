"""Byte-level BPE encoding and decoding over Arrow batches.

The `tokenizers` library does the merging. A text is first cut before each single blank that an
alphanumeric character follows: the pre-tokenizer pattern always begins a new piece there, so the
chunks can be encoded one by one. Arrow cuts a slice of texts, finds its distinct chunks and puts their
ids back in order; only the distinct chunks are looked up in the task's bounded memo or encoded.
Chunks are never shortened; a text without blanks is one chunk. A text with the string of an added
token that the library would cut out is encoded whole by the library.

Ids leave a batch as little-endian unsigned 32-bit integers. Offsets come from the byte lengths of
the tokens: the byte-to-character map counts the bytes that don't continue a character, so a token
that begins or ends inside a character covers the whole of that character. Decoding maps the
characters of each token back to bytes by the inverse of the byte table and joins the bytes before
it reads UTF-8, so characters that were split over tokens come back whole.

Defined cases: a null text is the empty text and has no ids; rows that repeat are encoded alike;
other columns are kept as they are, and a column of the input with the name of a result column is
replaced.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import sys
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from .common import release_memory, table, text_slices

#: Bytes that a task remembers chunks with, and the characters of the longest one worth remembering.
MEMO_BYTES, MEMO_CHARS = 64 << 20, 40
#: Bytes that an entry takes besides the characters and the ids, about.
_ENTRY = 180


def byte_table() -> dict[int, str]:
    """The character that stands for each byte: printable Latin-1 as itself, the rest from U+0100 on, in order."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: byte_table() for bytes read as Latin-1, and what stands for a blank.
_BYTES = byte_table()
_BLANK = _BYTES[32]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """A Tokenizer that merges as ranks say: always the adjacent pair whose joined bytes rank lowest.

    Every way to split a token into two tokens is a merge, in the order of the tokens' ranks.
    """
    chars = byte_table()
    name = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = []
    for t in sorted(ranks, key=ranks.get):
        merges += [(name[t[:i]], name[t[i:]]) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    tok = Tokenizer(models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok


def load_json(path: str) -> str:
    """A tokenizer file's content; executors get it from the driver, so that only the driver needs the path."""
    with open(path, encoding="utf-8") as f:
        return f.read()


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are written as the machine's unsigned 32-bit integers, which must be little-endian")


#: Pieces that no other reading of the pre-tokenizer pattern is possible for: runs of Latin letters, of digits and of
#: marks other than the apostrophe, each with a blank before it or not, and a line end before one of them.
_PIECE = re.compile(r" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+| ?[0-9]+| ?[!-&(-/:-@\[-`{-~]+|\n(?=[ ]?[^\s])")


class Encoder:
    """A Tokenizer with a memo of chunks.

    A key that begins with a blank stands for the rest of itself, any other key for a blank and itself:
    chunks that follow a blank need no new string. The memo has two generations of MEMO_BYTES / 2 bytes;
    when the young one is full it becomes the old one and what wasn't seen since goes.
    """

    def __init__(self, definition: str, special_as_text: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = special_as_text
        #: Strings that the library cuts out of a text before it looks for pieces.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (special_as_text and t.special)]
        self.forget()

    def forget(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def _library(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 4096):
            for e in self.tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False):
                yield array("I", e.ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """The ids of one piece in the characters of the byte table; it needs no pre-tokenizer."""
        return array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()

    def _resolve(self, keys: list[str]) -> list[bytes]:
        """The ids of each of these distinct keys."""
        young, old, one, find = self.young, self.old, self._piece, _PIECE.findall
        out = list(map(young.get, keys))
        other, new = [], {}

        def known(key: str) -> bytes | None:
            ids = new.get(key)
            if ids is None:
                ids = young.get(key)
                if ids is None:
                    ids = old.get(key)
                    if ids is not None:
                        new[key] = ids
            return ids

        for i in [i for i, ids in enumerate(out) if ids is None]:
            key = keys[i]
            ids = new.get(key)
            if ids is None:
                ids = old.get(key)
                if ids is None:
                    if key.isalpha() and key.isascii():
                        ids = one(_BLANK + key)
                    else:
                        pieces = find(said := key[1:] if key[0] == " " else " " + key)
                        if sum(map(len, pieces)) < len(said):
                            other.append(i)
                            continue
                        if len(pieces) > 1:
                            # the chunk itself isn't remembered, its pieces are
                            parts = []
                            for p in pieces:
                                part = p[1:] if p[0] == " " and p[1].isalnum() else " " + p
                                found = known(part)
                                if found is None:
                                    found = new[part] = one(p.translate(_BYTES) if p.isascii() else p.encode().decode("latin-1").translate(_BYTES))
                                parts.append(found)
                            out[i] = b"".join(parts)
                            continue
                        ids = one(said.encode().decode("latin-1").translate(_BYTES))
                new[key] = ids
            out[i] = ids
        for i, ids in zip(other, self._library([k[1:] if k[0] == " " else " " + k for k in map(keys.__getitem__, other)]), strict=True):
            out[i] = new[keys[i]] = ids
        self._keep(new)
        return out

    def _keep(self, new: dict[str, bytes]) -> None:
        for key, ids in new.items():
            if len(key) <= MEMO_CHARS:
                self.young[key] = ids
                self.size += len(key) + len(ids) + _ENTRY
                if self.size > MEMO_BYTES // 2:
                    self.young, self.old, self.size = {}, self.young, 0

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each text as little-endian unsigned 32-bit integers, one binary value a text."""
        texts = texts.cast(pa.string()).fill_null("")
        found = [pc.match_substring(texts, t) for t in self.added]
        whole = np.flatnonzero(reduce(pc.or_, found).to_numpy(zero_copy_only=False)) if found else np.zeros(0, np.int64)
        if not len(whole):
            return self._encode_chunks(texts)
        # the library itself cuts at added tokens
        rest = np.setdiff1d(np.arange(len(texts)), whole)
        own = pa.array(list(self._library(texts.take(pa.array(whole)).to_pylist())), pa.binary())
        both = pa.concat_arrays([own, self._encode_chunks(texts.take(pa.array(rest)))])
        return both.take(pa.array(np.argsort(np.concatenate([whole, rest]))))

    def _encode_chunks(self, texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.binary())
        split = pc.split_pattern(texts, " ")
        first = split.offsets.to_numpy().astype(np.int64)  # of each text, and the end
        first, parts = first - first[0], split.flatten().dictionary_encode()
        names, part = parts.dictionary.to_numpy(zero_copy_only=False).tolist(), parts.indices.to_numpy()
        # a chunk begins with a text, and at each part that begins with an alphanumeric character
        begins = np.fromiter((n[:1].isalnum() for n in names), bool, len(names))[part]
        begins[first[:-1]] = True
        at = np.flatnonzero(begins)
        size = np.diff(np.append(at, len(part)))
        of_text = np.searchsorted(at, first)  # the first chunk of each text
        leads = np.zeros(len(at), bool)
        leads[of_text[:-1]] = True
        plain = (size == 1) & ~leads
        key = part[at].astype(np.int64)
        made: dict[str, int] = {}
        for c in np.flatnonzero(~plain).tolist():
            said = " ".join([names[p] for p in part[at[c] : at[c] + size[c]].tolist()])
            key[c] = len(names) + made.setdefault(" " + said if leads[c] else "  " + said, len(made))
        used = np.zeros(len(names), bool)
        used[key[plain]] = True
        used = np.flatnonzero(used)
        place = np.concatenate([np.zeros(len(names), np.int64), np.arange(len(made)) + len(used)])
        place[used] = np.arange(len(used))
        ids = pa.array(self._resolve([names[u] for u in used.tolist()] + list(made)), pa.binary()).take(pa.array(place[key]))
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int32)[: len(ids) + 1][of_text]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.tobytes()), data])


class Decoder:
    """The bytes of each id, by the inverse of the byte table."""

    def __init__(self, definition: str | Tokenizer) -> None:
        back = {c: b for b, c in byte_table().items()}
        tokenizer = Tokenizer.from_str(definition) if isinstance(definition, str) else definition
        vocab = tokenizer.get_vocab(with_added_tokens=True)
        tokens: list[bytes] = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            tokens[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.tokens = pa.array(tokens, pa.binary())
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return _joined(self.tokens, ids)

    def offsets(self, ids: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        """Characters [begin, end) that each token covers, and how many tokens begin or end inside a character."""
        ends = np.cumsum(self.lengths[ids]) if len(ids) else np.zeros(0, np.int64)
        begins = ends - self.lengths[ids]
        starts = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(starts)])  # characters that begin before each byte
        first = np.append(starts, True)
        inside = ~first[begins] | ~first[ends]
        return before[begins] - ~first[begins], before[ends], int(inside.sum())


def _joined(values: pa.Array, at: np.ndarray) -> bytes:
    """The values at these places, one after another."""
    if not len(at):
        return b""
    taken = values.take(pa.array(at))
    ends = np.frombuffer(taken.buffers()[1], np.int32)
    return taken.buffers()[2].to_pybytes()[ends[0] : ends[len(at)]] if taken.buffers()[2] is not None else b""


class Vocabulary:
    """A tokenizer definition for tasks: sent once as a broadcast, built once by each worker, which holds the last one.

    With special_as_text the strings of special tokens in a text are ordinary text; without, they are
    the special tokens, as the library has it by default.
    """

    _held: tuple[str, Encoder | None, Decoder | None] = ("", None, None)

    def __init__(self, spark: SparkSession, definition: str, special_as_text: bool) -> None:
        self.key = hashlib.sha256(f"{special_as_text} {definition}".encode()).hexdigest()
        self.sent, self.special_as_text = spark.sparkContext.broadcast(definition), special_as_text

    def _own(self) -> tuple[Encoder | None, Decoder | None]:
        if Vocabulary._held[0] != self.key:
            Vocabulary._held = (self.key, None, None)
        return Vocabulary._held[1:]

    @contextmanager
    def encoder(self) -> Iterator[Encoder]:
        """The worker's encoder; its memo goes with the task."""
        encoder, decoder = self._own()
        encoder = encoder or Encoder(self.sent.value, self.special_as_text)
        Vocabulary._held = (self.key, encoder, decoder)
        try:
            yield encoder
        finally:
            encoder.forget()
            release_memory()

    def decoder(self) -> Decoder:
        encoder, decoder = self._own()
        decoder = decoder or Decoder(encoder.tokenizer if encoder else self.sent.value)
        Vocabulary._held = (self.key, encoder, decoder)
        return decoder


def encode(docs: DataFrame, definition: str, text: str = "text", ids: str = "ids", offsets: str | None = None, special_as_text: bool = True) -> DataFrame:
    """docs with a column of ids, and with `offsets` also an array of (begin, end) characters for each id."""
    vocabulary = Vocabulary(docs.sparkSession, definition, special_as_text)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with vocabulary.encoder() as encoder:
            decoder = vocabulary.decoder() if offsets else None
            for s in series:
                texts = [x or "" for x in s]
                encoded = [np.frombuffer(x, "<u4") for x in encoder.encode(pa.array(texts, pa.string())).to_pylist()]
                out = {"ids": [x.astype(np.int32) for x in encoded]}
                if offsets:
                    spans = [decoder.offsets(i, t.encode()) for i, t in zip(encoded, texts, strict=True)]
                    out |= {"b": [x[0].astype(np.int32) for x in spans], "e": [x[1].astype(np.int32) for x in spans]}
                yield pd.DataFrame(out)

    schema = "ids array<int>" + (", b array<int>, e array<int>" if offsets else "")
    kind = F.pandas_udf(run, schema)
    done = docs.withColumn(ids, kind(F.col(text).cast("string")))
    if offsets:
        done = done.withColumn(offsets, F.arrays_zip(F.col(f"{ids}.b").alias("begin"), F.col(f"{ids}.e").alias("end")))
    return done.withColumn(ids, F.col(f"{ids}.ids"))


def decode(rows: DataFrame, definition: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """rows with the decoded bytes of their ids; null ids are no ids."""
    vocabulary = Vocabulary(rows.sparkSession, definition, True)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = vocabulary.decoder()
        for s in series:
            yield pd.Series([decoder.decode(np.asarray(x if x is not None else [], np.int64)) for x in s])

    return rows.withColumn(text, F.pandas_udf(run, "binary")(F.col(ids)))


#: Bytes of text that are encoded, decoded and compared at once.
DIGEST_BYTES = 4 << 20
_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split long, round_trip boolean"


def encoding_digests(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: what encode() and decode() give, reduced where the batch stands.

    n_split counts the tokens that begin or end inside a character; round_trip says that the decoded
    bytes are the text and that the offsets end at its last character.
    """

    vocabulary = Vocabulary(docs.sparkSession, definition, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with vocabulary.encoder() as encoder:
            decoder = vocabulary.decoder()
            decimal = pa.array([f"{i} ".encode() for i in range(len(decoder.tokens))], pa.binary())
            for b in text_slices(batches, 1, DIGEST_BYTES):
                texts = b.column(1).cast(pa.binary()).fill_null(b"")
                n, of_ids, of_text, split, same = [], [], [], [], []
                for source, raw in zip(texts.to_pylist(), encoder.encode(b.column(1)).to_pylist(), strict=True):
                    ids = np.frombuffer(raw, "<u4").astype(np.int64)
                    back = decoder.decode(ids)
                    _, ends, inside = decoder.offsets(ids, source)
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(_joined(decimal, ids)[:-1]).hexdigest())
                    of_text.append(hashlib.sha256(back).hexdigest())
                    split.append(inside)
                    same.append(back == source and (int(ends[-1]) if len(ends) else 0) == len(source.decode()))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string()), pa.array(split, pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split", "round_trip"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _DIGEST)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"), public_ranks())


def public_ranks(path: str | None = None) -> str:
    """The definition of the tokenizer whose ranks stand in `path`."""
    import public_tokenizers

    return tokenizer_from_ranks(read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN).to_str()

