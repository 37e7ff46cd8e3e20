"""A blocked Bloom filter as a table, by DataFrame expressions alone.

A block is eight 64-bit words; a key sets one bit in each word of its block. Words of a block
are made by a grouped bitwise OR (combined before the shuffle). A filter has ``MAX_BLOCKS``
blocks at most, so it can be broadcast however many keys it holds; one that is too full lets
more false positives through, so an exact join has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 16  # 4 MB of bits


def _block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit_of(key: Column, word: int) -> Column:
    """The one bit that a key sets in a word of its block."""
    at = F.shiftright(F.xxhash64(key, F.lit("bloom")), 6 * word).bitwiseAND(63).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def blocks_for(keys: int, most: int = MAX_BLOCKS) -> int:
    """A power of two that gives each key ``BITS_PER_KEY`` bits, up to ``most`` blocks."""
    wanted = max(keys, 1) * BITS_PER_KEY // (64 * WORDS) + 1
    return min(1 << (wanted - 1).bit_length(), most)


def bloom_filter(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """The filter of a column's values that aren't null, as a table: block, w0 .. w7."""
    key = F.col(column)
    bits = keys.where(key.isNotNull()).select(
        _block_of(key, blocks).alias("bloom_block"), *[_bit_of(key, i).alias(f"b{i}") for i in range(WORDS)]
    )
    return bits.groupBy("bloom_block").agg(*[F.bit_or(f"b{i}").alias(f"bloom_w{i}") for i in range(WORDS)])


def with_maybe(rows: DataFrame, column: str, keys: DataFrame, key_column: str, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``rows`` with ``maybe``: whether the filter of ``keys`` passes the value in ``column``."""
    blocks = blocks_for(keys.count(), max_blocks)
    bloom = F.broadcast(bloom_filter(keys, key_column, blocks))  # at most MAX_BLOCKS rows
    names = [f"bloom_w{i}" for i in range(WORDS)]
    passed = F.lit(True)
    for i, name in enumerate(names):
        passed = passed & (F.col(name).bitwiseAND(_bit_of(F.col(column), i)) != 0)
    found = rows.withColumn("bloom_block", _block_of(F.col(column), blocks)).join(bloom, "bloom_block", "left")
    return found.withColumn("maybe", F.coalesce(passed, F.lit(False))).drop("bloom_block", *names)


def bloom_semi_join(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` whose value in ``column`` is among those of ``keys`` (same column name). The
    filter keeps most other rows out of the shuffle of the exact join."""
    keys = keys.select(column).distinct()
    return with_maybe(rows, column, keys, column).where("maybe").drop("maybe").join(keys, column, "left_semi")
