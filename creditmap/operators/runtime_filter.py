"""A runtime filter on a fact's join key (F-17, J-13, J-15).

The keys a dimension has selected are hashed into a bit set of fixed size.  It is the result of a scalar subquery, so Spark
computes it once and tests it right above the fact's scan: rows that cannot
join are gone before any shuffle, whatever join strategy follows.  The join
itself stays, so the result never depends on the filter; with more keys than
the bits were meant for it only lets more rows pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter; of other keys that share passes that is set, 5 % at 100,000 keys.
BITS = 1 << 21


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_bits(keys: DataFrame, key: str, bits: int = BITS) -> Column:
    """Scalar subquery: the bit set of ``keys[key]`` as an array of longs."""
    every = keys.sparkSession.range(0, bits // 64, 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    at = _place(F.col(key), bits)
    held = keys.where(F.col(key).isNotNull()).select(F.shiftright(at, 6).alias("word"), _bit(at).alias("bits")).unionByName(every)
    words = held.groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))  # bits / 64 rows
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"])).scalar()


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))


def keep_possible(fact: DataFrame, column: str, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The rows of ``fact`` whose ``column`` may be among ``keys[key]``: all that are, and few others."""
    at = _place(F.col(column), bits)
    word = F.get(key_bits(keys, key, bits), F.shiftright(at, 6).cast("int"))
    return fact.where(F.col(column).isNotNull() & (word.bitwiseAND(_bit(at)) != 0))
