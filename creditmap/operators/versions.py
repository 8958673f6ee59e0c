"""Versioned (type-2) dimension operators.

* ``hop_to_current``  - from any version's surrogate id to every current
  version with the same business key (J-02).
* ``hop_as_of``       - from a business key to the versions in force on a
  date, both ends closed, at day grain (J-03).
* ``collapse_versions`` - hull interval [min created, max terminated] per
  key (G-07); gaps between versions are bridged, as in the reference.

All are bag operators: a business key with two current versions yields
two rows and one with none yields none.  Nothing is de-duplicated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import col, day_of, same_text


def hop_to_current(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    sk: str,
    bk: str,
    keep: dict[str, str],
    active_col: str = "Active_Record_Ind",
    active_flag: str = "Y",
) -> DataFrame:
    """Attach columns of the current versions of the row ``df[on]`` points at.

    ``df[on]`` holds a surrogate id ``dim[sk]`` of any version; the current
    versions share ``dim[bk]``.  ``keep`` maps current-version columns to
    output names.
    """
    current = current_versions(dim, sk, bk, keep, active_col, active_flag).withColumnRenamed(sk, "__sk")
    return df.join(current, F.col(on) == F.col("__sk")).drop("__sk")


def business_key(dim: DataFrame, c: str) -> Column:
    """A key column as joins compare it (Q-16)."""
    return same_text(c) if isinstance(dim.schema[c].dataType, T.StringType) else F.col(c)


def current_versions(dim: DataFrame, sk: str, bk: str, keep: dict[str, str], active_col: str = "Active_Record_Ind",
                     active_flag: str = "Y") -> DataFrame:
    """(``sk`` of any version, ``keep`` of each current version with the same
    ``bk``): built on the dimension alone, so a fact needs one join (R-4)."""
    version = dim.select(F.col(sk), business_key(dim, bk).alias("__bk"))
    current = dim.where(same_text(active_col) == F.lit(active_flag)).select(
        business_key(dim, bk).alias("__bk"), *[F.col(c).alias(a) for c, a in keep.items()]
    )
    return version.join(current, "__bk").drop("__bk")


def hop_as_of(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    bk: str,
    day: str,
    keep: dict[str, str],
    lo: str = "Rec_Created_Date",
    hi: str = "Rec_Term_Date",
    where: Column | None = None,
) -> DataFrame:
    """Attach the versions of ``dim`` whose business key equals ``df[on]``
    and that are in force on ``df[day]`` (a DATE column)."""
    d = dim if where is None else dim.where(where)
    versions = d.select(
        business_key(dim, bk).alias("__bk"),
        day_of(lo).alias("__lo"),
        day_of(hi).alias("__hi"),
        *[F.col(c).alias(a) for c, a in keep.items()],
    )
    cond = (business_key(df, on) == F.col("__bk")) & (F.col("__lo") <= F.col(day)) & (F.col("__hi") >= F.col(day))
    return df.join(versions, cond).drop("__bk", "__lo", "__hi")


def collapse_versions(df: DataFrame, keys: list, lo: str = "Rec_Created_Date", hi: str = "Rec_Term_Date",
                      start: str = "Start_Date", end: str = "End_Date") -> DataFrame:
    """``CAST(MIN(lo) AS date), CAST(MAX(hi) AS date)`` per key (G-07)."""
    return df.groupBy(*[col(k) for k in keys]).agg(
        F.min(lo).cast("date").alias(start), F.max(hi).cast("date").alias(end)
    )
