"""Semi-join reduction: rows that cannot find a partner are left out before they are shuffled.

The keys that are wanted set bits in a table of fixed size, two for each key.  The table is one
row, made map-side first, which every task receives; a row of the large side stays only if both
bits of its key are set.  A row that is wanted always stays.  One that is not stays with the
chance that other keys set both bits: (keys x 2 / bits) squared, 1 in 400 at 40 bits a key.  With
more keys than bits the table fills up and everything stays, as without it; results never depend
on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the number of bits: 2^22 bits are 0.5 MB, sent once to every executor.
LOG_BITS = 22
_WORD = 6


def _places(key: Column, log_bits: int) -> list[Column]:
    """Two bit numbers of a key, from both halves of its hash."""
    hashed = F.xxhash64(key)
    mask = F.lit((1 << log_bits) - 1).cast("bigint")
    return [hashed.bitwiseAND(mask), F.shiftrightunsigned(hashed, 32).bitwiseAND(mask)]


def key_table(keys: DataFrame, key: str, log_bits: int = LOG_BITS) -> DataFrame:
    """One row with the bit table (``words``) of the keys; NULL keys set nothing."""
    spark = keys.sparkSession
    place = F.explode(F.array(*_places(F.col(key), log_bits))).alias("place")
    at = F.col("place").bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at)
    found = keys.filter(F.col(key).isNotNull()).select(place).select(
        F.shiftright("place", _WORD).alias("word"), bit.alias("bits")
    )
    # every word once, so that the table has no holes
    empty = spark.range(0, 1 << (log_bits - _WORD), 1, 1).select(
        F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    words = found.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return words.agg(in_order["bits"].alias("words"))


def may_have(words: Column, key: Column, log_bits: int = LOG_BITS) -> Column:
    """Whether both bits of a key are set; NULL keys have no partner."""
    tests = []
    for place in _places(key, log_bits):
        word = F.get(words, F.shiftright(place, _WORD).cast("int"))
        tests.append(F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return key.isNotNull() & tests[0] & tests[1]


def reduced(df: DataFrame, key: str, keys: DataFrame, log_bits: int = LOG_BITS) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``keys`` (a column of the same name and type)."""
    return df.filter(may_have(key_table(keys, key, log_bits).scalar(), F.col(key), log_bits))
