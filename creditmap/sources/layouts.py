"""Stored layouts of the large facts.

* ``write_by_day`` (S-01): a folder per reporting day.  ``operators.snapshot``
  takes the latest day from the folder names and reads that folder alone.
* ``write_bucketed`` (S-07, S-08, J-01): both sides of the position-to-holding
  join bucketed and sorted by holding id, so the join moves no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.snapshot import DAY


def write_by_day(df: DataFrame, path: str, ts_col: str, mode: str = "overwrite") -> None:
    """Write ``df`` with a DATE partition ``DAY`` of ``ts_col``; a NULL time has a folder of its own.

    Rows of a day are brought together first (a large day is split), so a day has few files."""
    (df.withColumn(DAY, F.col(ts_col).cast("date")).hint("rebalance", DAY)
        .write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(DAY).parquet(path))


def read_by_day(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the columns of ``like`` and ``DAY``."""
    return spark.read.schema(f"{_ddl(like)}, {DAY} date").parquet(path)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


#: File bytes of all tables that one bucket is to hold, and the bounds of the number of buckets.
BUCKET_BYTES, FEWEST_BUCKETS, MOST_BUCKETS = 16 << 20, 8, 1 << 14


def buckets_for(tables: Iterable[DataFrame], each: int = BUCKET_BYTES) -> int:
    """Number of buckets for stored ``tables`` that are joined bucket by bucket: a power of two that grows
    with their files, so that a task's rows do not."""
    held = sum(int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables)
    return min(MOST_BUCKETS, max(FEWEST_BUCKETS, 1 << (max(1, held // each) - 1).bit_length()))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` buckets by ``key``, each sorted; two tables with the same number
    join on their keys without an exchange.  Rows are dealt by bucket first, so a bucket is one file."""
    (df.repartition(buckets, key).sortWithinPartitions(key)
        .write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)
