"""Session settings the plans rely on.

``tune`` sets runtime SQL options on an existing session (safe to call on
a cluster session): adaptive execution with partition coalescing and skew
splitting, and an explicit runtime broadcast threshold.
``freed_shuffles`` bounds the disk that steps written one after another take.
``local_session`` builds the local session used by tests and the bench.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Runtime broadcast switch uses measured shuffle sizes, so it is checked.  A relation takes a multiple of
    # them on the driver, and a plan has dozens of joins: both sides are shuffled already, so larger ones stay
    # with the executors.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "8m",
}

#: Spark removes the shuffle files of a query as soon as it has run.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside go at its end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "creditmap",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
