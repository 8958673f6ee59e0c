"""Join keys that spread: NULL keys and heavy hitters.

``spread_key`` turns a key into one that joins the same rows but deals NULL
keys, which join nothing, over many values; it is one column, so the exchange of
a shuffle join is on it.

``heavy_hitter_join`` finds the frequent keys of the left side with a mergeable
sketch (Misra-Gries counters of bounded size), deals their rows to ``ways``
salts and repeats their few rows of the right side once per salt.  Rows and
multiplicities are those of the plain join, whatever the sketch finds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most keys that can be heavy: each has over 1 / HEAVY of the rows.
HEAVY = 128


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread_key(key: Column, row: Column, ways: int) -> Column:
    """``key`` with a mark before it; NULL becomes one of ``ways`` texts that no key equals.

    ``row`` is a hash of the row.  The other side uses :func:`marked_key`."""
    return F.coalesce(marked_key(key), F.concat(F.lit("n"), F.pmod(row, F.lit(ways)).cast("string")))


def marked_key(key: Column) -> Column:
    return F.concat(F.lit("k"), key)


def heavy_keys(df: DataFrame, key: str, most: int = HEAVY) -> DataFrame:
    """(key) of at most ``most`` keys, those with more than 1 / ``most`` of the rows among them."""
    top = df.where(F.col(key).isNotNull()).agg(F.count("*").alias("n"), F.expr(f"approx_top_k({key}, {most}, {8 * most})").alias("top"))
    return top.select("n", F.explode("top").alias("x")).where(F.col("x.count") * most > F.col("n")).select(F.col("x.item").alias(key))


def heavy_hitter_join(left: DataFrame, right: DataFrame, key: str, condition: Column | None = None, how: str = "left",
                      ways: int | None = None) -> DataFrame:
    """``left`` joined (inner or left) with ``right`` on the string column ``key`` of both and ``condition``;
    the key comes from the left side."""
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    dealt = partitions(left)
    ways = ways or dealt
    heavy = F.broadcast(heavy_keys(left, key).select(F.col(key).alias("__hot")))  # at most HEAVY rows
    row = F.xxhash64(*[F.col(c) for c in left.columns])
    l = left.join(heavy, F.col(key) == F.col("__hot"), "left")  # noqa: E741
    salt = F.when(F.col("__hot").isNotNull(), F.pmod(row, F.lit(ways))).otherwise(F.lit(0))
    l = l.withColumn("__lk", F.concat_ws(":", salt.cast("string"), spread_key(F.col(key), row, ways))).drop("__hot")  # noqa: E741
    r = right.withColumnRenamed(key, "__rkey").join(heavy, F.col("__rkey") == F.col("__hot"), "left")
    salts = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    r = r.withColumn("__salt", F.explode(salts)).withColumn(
        "__rk", F.concat_ws(":", F.col("__salt").cast("string"), marked_key(F.col("__rkey")))).where(F.col("__rkey").isNotNull())
    on = F.col("__lk") == F.col("__rk")
    # By number: few bytes may join to very many rows, so tasks are not put together by bytes.
    l, r = l.repartition(dealt, "__lk"), r.drop("__hot", "__salt", "__rkey").repartition(dealt, "__rk")  # noqa: E741
    return l.join(r, on if condition is None else on & condition, how).drop("__lk", "__rk")
