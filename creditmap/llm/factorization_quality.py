"""Quality classifier: a factorisation machine.

Features of a whole text: its words, hashed into ``buckets`` (counts scaled to
length 1), and one-hot bins of structure statistics (lengths, shares of kinds of
characters, repetition, lines) and of the metadata column ``n_chars``.  The
score is the logistic function of

    w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

so all pairwise interactions cost time linear in the features.

The model is fitted on at most ``sample`` labelled texts of either quality
(lowest hashes of doc_id; each class weighted back to its share of the labels),
dealt to ``shards`` groups: every round each group makes ``epochs`` passes of
AdaGrad from the common parameters, and the groups' parameters are averaged.
The parameters have a fixed size.  Scoring covers every whole text.

NULL or empty text has no words and the bins of zero; NULL ``n_chars`` (or no
such column) has a bin of its own.  Rows repeating a doc_id are scored each for
itself; labels that repeat or contradict count each; NULL labels teach nothing.
Without labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmap.llm.common import crc_remainder, lower_ascii, span_hashes, stored, text_blocks, word_spans

_SHARES = 9  # statistics that are shares
_SIZES = 5  # statistics that are sizes
_BINS = 16


@dataclass(frozen=True)
class Machine:
    buckets: int = 1 << 16
    factors: int = 6
    sample: int = 4_000
    shards: int = 8
    rounds: int = 3
    epochs: int = 3
    rate: float = 0.1
    decay: float = 1e-4
    modulus: int = 4  # crc32 remainders of doc_ids; the held-out one teaches nothing
    held_out: int = 2

    @property
    def features(self) -> int:
        return self.buckets + (_SHARES + _SIZES) * _BINS


def _kinds() -> np.ndarray:
    """Of each byte: letter, upper case, digit, blank, line feed, punctuation, not ASCII."""
    b = np.arange(256)
    upper, lower = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122)
    digit, blank, wide = (b >= 48) & (b <= 57), (b >= 9) & (b <= 32), b >= 128
    return np.array([upper | lower | wide, upper, digit, blank, b == 10, ~(upper | lower | digit | wide) & (b > 32), wide])


_KINDS = _kinds()


def features(batch: pa.RecordBatch, how: Machine) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, row, feature and value of each non-zero entry), by row."""
    n_chars = batch.column(batch.schema.get_field_index("n_chars")).to_pylist()
    for first, end, data, offsets in text_blocks(batch, "text"):
        rows = end - first
        size = np.diff(offsets)
        kinds = []
        for kind in _KINDS:
            total = np.append(0, np.cumsum(kind[data]))
            kinds.append(total[offsets[1:]] - total[offsets[:-1]])
        letters, upper, digits, blanks, lines, marks, wide = kinds
        low = lower_ascii(data)
        starts, ends, before = word_spans(low, offsets)
        of = np.repeat(np.arange(rows), np.diff(before))
        bucket = (span_hashes(low, starts, ends) % np.uint64(how.buckets)).astype(np.int64)
        marked = np.append(0, np.cumsum(_KINDS[5][data]))
        inner = (marked[np.maximum(ends - 1, starts)] - marked[starts]) > 0  # marks before the last character of a word
        keys, count = np.unique(of * how.buckets + bucket, return_counts=True)
        row, word = keys // how.buckets, keys % how.buckets
        words = np.bincount(of, minlength=rows)
        distinct = np.bincount(row, minlength=rows)
        norm = np.sqrt(np.bincount(row, count.astype(float) ** 2, rows))
        often = np.zeros(rows, np.int64)
        np.maximum.at(often, row, count)
        same = np.bincount(of[1:], bucket[1:] == bucket[:-1], rows) if len(of) else np.zeros(rows)
        some = np.maximum(words, 1)
        shares = [upper / np.maximum(letters, 1), digits / np.maximum(size, 1), marks / np.maximum(size, 1), blanks / np.maximum(size, 1),
                  wide / np.maximum(size, 1), 1 - distinct / some, often / some, np.bincount(of, inner, rows) / some, same / some]
        given = np.array([-1 if x is None else x for x in n_chars[first:end]], float)
        sizes = [np.log2(size + 1), np.log2(words + 1), 2 * (size - blanks) / some, np.log2(lines + 1) * 2, np.where(given < 0, 0, np.log2(np.maximum(given, 0) + 1))]
        bins = [np.where(s <= 0, 0, 1 + np.clip(np.log2(np.maximum(s, 1e-9)) * 2 + _BINS - 2, 0, _BINS - 2)) for s in shares] + [np.clip(s, 0, _BINS - 1) for s in sizes]
        statistics = np.stack([how.buckets + k * _BINS + b.astype(np.int64) for k, b in enumerate(bins)], axis=1)
        row = np.concatenate([row, np.repeat(np.arange(rows), statistics.shape[1])])
        feature = np.concatenate([word, statistics.ravel()])
        value = np.concatenate([count / norm[keys // how.buckets], np.full(statistics.size, 0.5)])
        order = np.argsort(row, kind="stable")
        yield first, end, row[order], feature[order], value[order]


def margins(row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int, bias: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(margin of each row, sums of v x by row, v x by entry); every row has entries."""
    at = np.searchsorted(row, np.arange(rows))
    vx = v[feature] * value[:, None].astype(np.float32)
    sums = np.add.reduceat(vx, at, axis=0)
    squares = np.add.reduceat((vx * vx).sum(1), at)
    return bias + np.add.reduceat(w[feature] * value, at) + 0.5 * ((sums * sums).sum(1) - squares), sums, vx


def _start(how: Machine) -> np.ndarray:
    """Parameters in one array: a row per feature (weight, factors), the last holds the bias."""
    out = np.zeros((how.features + 1, 1 + how.factors), np.float32)
    out[:-1, 1:] = np.random.default_rng(7).normal(0, 0.05, (how.features, how.factors))
    return out


def _train(how: Machine, start):
    """A shard's passes of AdaGrad; its parameters and weight."""
    def run(table: pa.Table) -> pa.Table:
        theta = start.value.copy()
        spent = np.full_like(theta, 1e-3)
        rng = np.random.default_rng(11)
        y, weight = (table.column(c).to_numpy() for c in ("y", "weight"))
        feature, value = ([np.asarray(x) for x in table.column(c).to_pylist()] for c in ("feature", "value"))
        for _ in range(how.epochs):
            order = rng.permutation(len(y))
            for lo in range(0, len(order), 32):
                some = order[lo : lo + 32]
                f, x = np.concatenate([feature[k] for k in some]).astype(np.int64), np.concatenate([value[k] for k in some])
                row = np.repeat(np.arange(len(some)), [len(feature[k]) for k in some])
                margin, sums, vx = margins(row, f, x, len(some), theta[-1, 0], theta[:, 0], theta[:, 1:])
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[some]) * weight[some] / len(some)
                distinct, at = np.unique(f, return_inverse=True)
                slope = np.column_stack([x, x[:, None] * (sums[row] - vx)]) * error[row][:, None]
                total = np.zeros((len(distinct), theta.shape[1]))
                np.add.at(total, at, slope)
                total += how.decay * theta[distinct]
                spent[distinct] += total**2
                theta[distinct] -= how.rate * total / np.sqrt(spent[distinct])
                spent[-1, 0] += error.sum() ** 2
                theta[-1, 0] -= how.rate * error.sum() / np.sqrt(spent[-1, 0])
        return pa.table({"theta": pa.array([theta.tobytes()], pa.binary()), "n": pa.array([float(weight.sum())])})
    return run


def _sampled(docs: DataFrame, labels: DataFrame, how: Machine) -> DataFrame:
    """(shard, y, weight, feature, value) of the texts that the model is fitted on."""
    crc = crc_remainder(F.col("doc_id"), how.modulus)
    labels = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("y"))
              .where(F.col("y").isin(0, 1) & (crc != how.held_out)))
    classes = {y: n for y, n in labels.groupBy("y").count().collect()}  # two rows at most
    kept = labels.limit(0).withColumn("weight", F.lit(0.0))
    for y, n in classes.items():
        some = labels.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.sample)
        kept = kept.unionByName(some.withColumn("weight", F.lit(len(classes) * n / min(n, how.sample) / sum(m / min(m, how.sample) for m in classes.values()))))

    def extract(batches):
        for batch in batches:
            marks = [batch.column(batch.schema.get_field_index(c)) for c in ("shard", "y", "weight")]
            for first, end, row, feature, value in features(batch, how):
                cuts = np.searchsorted(row, np.arange(end - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(m.slice(first, end - first) for m in marks), pa.ListArray.from_arrays(cuts, pa.array(feature.astype(np.int32))),
                                                  pa.ListArray.from_arrays(cuts, pa.array(value))], names=["shard", "y", "weight", "feature", "value"])

    rows = docs.join(F.broadcast(kept), "doc_id").withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(how.shards)).cast("int"))  # at most 2 * how.sample labels
    return stored(rows.select("text", "n_chars", "shard", "y", "weight").mapInArrow(extract, "shard int, y int, weight double, feature array<int>, value array<double>"), "sample")


def _prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_chars)"""
    given = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", given.alias("n_chars"))


def _fitted(docs: DataFrame, labels: DataFrame, how: Machine):
    """The parameters, broadcast (their size is fixed)."""
    spark = docs.sparkSession
    sample = _sampled(docs, labels, how)
    theta = _start(how)
    for _ in range(how.rounds):
        start = spark.sparkContext.broadcast(theta)
        found = sample.groupBy("shard").applyInArrow(_train(how, start), "theta binary, n double").collect()  # how.shards rows of fixed size
        if not found:
            theta[:] = 0
            break
        theta = sum(np.frombuffer(x["theta"], np.float32).reshape(theta.shape) * x["n"] for x in found) / sum(x["n"] for x in found)
        theta = theta.astype(np.float32)
    return spark.sparkContext.broadcast(theta)


def _scores(batch: pa.RecordBatch, theta: np.ndarray, how: Machine) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, score of each row)."""
    for first, end, row, feature, value in features(batch, how):
        margin, _, _ = margins(row, feature, value, end - first, theta[-1, 0], theta[:, 0], theta[:, 1:])
        yield first, end, 1 / (1 + np.exp(-np.clip(margin.astype(float), -30, 30)))


def score(docs: DataFrame, labels: DataFrame, how: Machine = Machine()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``
    (doc_id, text and, if there is one, n_chars); labels: (doc_id, quality)."""
    docs = _prepared(docs)
    model = _fitted(docs, labels, how)

    def scored(batches):
        for batch in batches:
            for first, end, p in _scores(batch, model.value, how):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(p)], names=["doc_id", "score"])

    crc = crc_remainder(F.col("doc_id"), how.modulus)
    return (docs.mapInArrow(scored, "doc_id long, score double")
            .select("doc_id", (crc == how.held_out).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")))


def accepted(docs: DataFrame, labels: DataFrame, least: float, how: Machine = Machine()) -> DataFrame:
    """The rows of ``docs`` with a score of ``least`` or more, decided as they pass: no row needs an id."""
    model = _fitted(_prepared(docs), labels, how)

    def run(batches):
        for batch in batches:
            for first, end, p in _scores(batch, model.value, how):
                yield batch.slice(first, end - first).filter(pa.array(p >= least))

    return docs.mapInArrow(run, docs.schema)
