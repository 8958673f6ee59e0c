"""Exact distinct counts as state that is stored and merged (G-01).

The ids of a group are bits: a row per (group, bucket of 32,768 ids) holds a
bitmap of 4 KB, so a state of dense surrogate ids takes an eighth of a byte per
id.  States of days, files or tasks are merged by OR, in any order and more than
once, and the count is read from the merged bitmaps: the same as COUNT(DISTINCT)
over all rows, without keeping them.  NULL ids count as in SQL: not at all, so a
group of NULL ids only has no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, IDS = "__bucket", "__ids"


def distinct_state(rows: DataFrame, keys: list[str], id_: str) -> DataFrame:
    """(keys, bucket, bitmap) of the ids of each group."""
    own = rows.where(F.col(id_).isNotNull())
    return own.groupBy(*keys, F.bitmap_bucket_number(id_).alias(BUCKET)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias(IDS))


def merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state of several, one after the other in ``states``."""
    return states.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(IDS).alias(IDS))


def counted(state: DataFrame, keys: list[str], as_: str) -> DataFrame:
    """(keys, number of distinct ids) of a merged state."""
    return state.groupBy(*keys).agg(F.sum(F.bitmap_count(IDS)).alias(as_))
