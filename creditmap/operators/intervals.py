"""Equality-plus-range joins (J-08, J-10).

Every range predicate in the scripts comes with an equality; both joins add a
bucket of time to it, so one hot key spreads over many tasks and no row holds
all intervals of a key.

* ``effective_dated_left``: an interval index has one row per interval and
  month that it covers; a fact row probes the month it lies in.
* ``overlap_join``: two intervals overlap exactly if one starts inside the
  other, so a pair is found in the bucket in which the later of the two starts,
  and nowhere else.  Intervals of up to ``SHORT`` years lie in year buckets,
  longer ones in decades; a start is looked up in both.

Months, years and decades are clamped to ``FIRST_YEAR`` .. ``LAST_YEAR`` on both sides:
results stay exact, an open-ended interval has a bounded number of rows, and
times outside meet in the outermost bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import col, same_text
from .skew import marked_key, partitions, spread_key

FIRST_YEAR, LAST_YEAR = 1990, 2040
SHORT = 5


def _clamped(bucket: Column, first: int, last: int) -> Column:
    return F.when(bucket < first, first).when(bucket > last, last).otherwise(bucket)


def _year(at) -> Column:
    return _clamped(F.year(col(at)), FIRST_YEAR, LAST_YEAR)


def _month(at) -> Column:
    return _clamped(F.year(col(at)) * 12 + F.month(col(at)), FIRST_YEAR * 12, LAST_YEAR * 12)


def _each(bucket, start, end) -> Column:
    """The buckets of an interval; none if it is empty or has a NULL end."""
    lo, hi = bucket(start), bucket(end)
    return F.explode(F.when(lo <= hi, F.sequence(lo, hi)))


def _decade(at) -> Column:
    return F.floor(_year(at) / 10).cast("int")  # three digits, so none is a year


def _buckets(start, end) -> Column:
    """The years of a short interval, the decades of a longer one."""
    lo, hi = _year(start), _year(end)
    return F.explode(F.when(lo > hi, None).when(hi - lo <= SHORT, F.sequence(lo, hi)).otherwise(F.sequence(_decade(start), _decade(end))))


def _looked_up(start) -> Column:
    return F.explode(F.array(_year(start), _decade(start)))


def interval_index(ref: DataFrame, key: str, start: str, end: str, keep: dict[str, str]) -> DataFrame:
    """(__rk, __month, __from, __to, kept columns): a row per interval and month."""
    return ref.select(marked_key(same_text(key)).alias("__rk"), _each(_month, start, end).alias("__month"),
                      F.col(start).alias("__from"), F.col(end).alias("__to"), *[F.col(c).alias(a) for c, a in keep.items()])


def effective_dated_left(df: DataFrame, ref: DataFrame, key: str, at: str, ref_key: str, ref_from: str, ref_to: str,
                         keep: dict[str, str], only_when: Column | None = None) -> DataFrame:
    """LEFT JOIN ref ON key AND ref_from <= at AND ref_to >= at (closed, at the
    grain of ``at``); rows that fail ``only_when`` match none.  Overlapping
    intervals fan out (bag)."""
    index = interval_index(ref, ref_key, ref_from, ref_to, keep)
    own = same_text(key) if only_when is None else F.when(only_when, same_text(key))
    rows = df.withColumn("__lk", spread_key(own, F.xxhash64(*[F.col(c) for c in df.columns]), partitions(df))).withColumn("__at", _month(at))
    cond = (F.col("__lk") == F.col("__rk")) & (F.col("__at") == F.col("__month")) & (F.col("__from") <= F.col(at)) & (F.col("__to") >= F.col(at))
    return rows.join(index, cond, "left").drop("__lk", "__at", "__rk", "__month", "__from", "__to")


def disjoint_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The union of the closed intervals of ``keys`` as intervals of which no two share a point."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    until = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.where(F.col(start) <= F.col(end)).select(*keys, start, end, F.coalesce((F.col(start) > until).cast("int"), F.lit(1)).alias("__new"))
    return rows.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "__run").agg(
        F.min(start).alias(start), F.max(end).alias(end)).drop("__run")


def overlap_join(left: DataFrame, right: DataFrame, key: str, l_start: str, l_end: str,
                 r_start: str, r_end: str) -> DataFrame:
    """INNER JOIN on key AND r_start <= l_end AND l_start <= r_end (closed).

    ``left`` and ``right`` must name their interval columns differently."""
    l = left.withColumn("__lk", same_text(key))  # noqa: E741
    r = right.withColumnRenamed(key, "__k").withColumn("__rk", same_text("__k")).drop("__k")
    both = (F.col("__lk") == F.col("__rk")) & (F.col("__at") == F.col("__in")) & (F.col(r_start) <= F.col(l_end)) & (F.col(l_start) <= F.col(r_end))
    from_left = l.withColumn("__at", _looked_up(l_start)).join(
        r.withColumn("__in", _buckets(r_start, r_end)), both & (F.col(l_start) >= F.col(r_start)))
    from_right = l.withColumn("__in", _buckets(l_start, l_end)).join(
        r.withColumn("__at", _looked_up(r_start)), both & (F.col(l_start) < F.col(r_start)))
    return from_left.unionByName(from_right).drop("__lk", "__rk", "__at", "__in")
