"""Token counts from an exact length histogram.

Every whole text is encoded once with a byte-level vocabulary and only its
length is kept; documents are aggregated by length.  Suffix sums over the
distinct lengths then answer, for every context limit, how many documents and
tokens there are, which share is longer, how many tokens remain when each
document is cut at the limit, and any quantile.

The suffix sums have two levels, so no task gets the whole histogram: within
spans of ``span`` lengths, and over the spans (their number is the longest
length / ``span``).  NULL text has length 0; repeated rows count each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_ENCODINGS: dict[tuple[str, str], tiktoken.Encoding] = {}


def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    if (path, pattern) not in _ENCODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("from-file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path, pattern]


def encoded_lengths(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(length) of every row; text that looks like a special token is ordinary text."""
    def run(batches):
        encode = _encoding(path, pattern).encode_ordinary
        for batch in batches:
            texts = batch.column(0)
            yield pa.RecordBatch.from_arrays([pa.array([len(encode(t.as_py() or "")) for t in texts], pa.int64())], names=["length"])

    return docs.select("text").mapInArrow(run, "length long")


def histogram(lengths: DataFrame, span: int = 1024) -> DataFrame:
    """One row per distinct length L: ``docs`` of that length, ``docs_to`` and
    ``tokens_to`` of lengths up to L, ``docs_over`` and ``tokens_over`` of
    longer ones, ``tokens_cut`` (total if each is cut at L), ``share_to``
    (the quantile that L is)."""
    counts = lengths.groupBy("length").agg(F.count("*").alias("docs")).withColumn("span", F.expr(f"length div {span}"))
    spans = counts.groupBy("span").agg(F.sum("docs").alias("d"), F.sum(F.expr("docs * length")).alias("t"))
    later = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = spans.select("span", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_after"),
                         F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    longer = Window.partitionBy("span").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    return (counts.join(spans, "span")
            .withColumn("docs_over", F.coalesce(F.sum("docs").over(longer), F.lit(0)) + F.col("d_after"))
            .withColumn("tokens_over", F.coalesce(F.sum(F.expr("docs * length")).over(longer), F.lit(0)) + F.col("t_after"))
            .select("length", "docs", (F.col("d_all") - F.col("docs_over")).alias("docs_to"), (F.col("t_all") - F.col("tokens_over")).alias("tokens_to"),
                    "docs_over", "tokens_over", F.expr("t_all - tokens_over + length * docs_over").alias("tokens_cut"),
                    ((F.col("d_all") - F.col("docs_over")) / F.col("d_all")).alias("share_to")))


def at_limits(found: DataFrame, limits: DataFrame) -> DataFrame:
    """(limit, tokens_cut) for any limits (column ``limit``): the row of the
    greatest length that the limit allows, moved on to the limit."""
    below = limits.join(found, F.col("length") <= F.col("limit"), "left").groupBy("limit").agg(F.max(F.struct("length", "tokens_cut", "docs_over")).alias("x"))
    every = F.broadcast(found.agg(F.sum("docs").alias("all")))
    return below.crossJoin(every).select("limit", F.coalesce(F.col("x.tokens_cut") + (F.col("limit") - F.col("x.length")) * F.col("x.docs_over"), F.col("limit") * F.col("all")).alias("tokens_cut"))


def quantile(found: DataFrame, share: float) -> DataFrame:
    """(length): the least length that holds at least ``share`` of the documents."""
    return found.where(F.col("share_to") >= share).agg(F.min("length").alias("length"))
