"""Blocked Bloom filters as DataFrames: a row for each block, so a filter may be larger than any one machine.

A block has WORDS words of 64 bits and a key sets one bit in each word of the one block that it hashes to. A
look-up is an equal join on the block and WORDS bit tests, all in generated code. At BITS_PER_KEY about three
keys in a thousand that were never added pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, BITS_PER_KEY = 8, 12
#: What a row of a filter counts as where its size is checked.
BLOCK_BYTES = 8 * WORDS + 64


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // (64 * WORDS)))


def block_of(blocks: int, *key: str | Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), *key), F.lit(blocks))


def _bits(*key: str | Column) -> list[Column]:
    """For each word the one bit of a key."""
    h, one = F.xxhash64(F.lit(2), *key), F.lit(1).cast("long")
    place = lambda i: F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
    return [F.call_function("shiftleft", one, place(i)) for i in range(WORDS)]


def bloom_filter(keys: DataFrame, blocks: int, *key: str, block: str = "block", words: str = "words") -> DataFrame:
    """(block, words) of the keys in columns `key`; blocks without a key have no row."""
    made = keys.groupBy(block_of(blocks, *key).alias(block)).agg(*[F.bit_or(b).alias(f"_w{i}") for i, b in enumerate(_bits(*key))])
    return made.select(block, F.array(*[f"_w{i}" for i in range(WORDS)]).alias(words))


def may_contain(words: str | Column, *key: str | Column) -> Column:
    """Whether a block's words have all bits of a key: true for each key that was added."""
    words = F.col(words) if isinstance(words, str) else words
    return reduce(lambda a, b: a & b, (F.get(words, F.lit(i)).bitwiseAND(b) == b for i, b in enumerate(_bits(*key))))
