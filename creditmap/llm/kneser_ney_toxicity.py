"""Toxicity from class-conditional Kneser-Ney models.

The expressions are words, spelled in bytes.  For each class (toxic, ordinary)
a model of order ``order`` predicts a symbol from those before it in the word:

    p(w | h) = max(c(h w) - D, 0) / c(h) + D n(h) / c(h) * shared(w | h')

``c`` counts the class's labelled texts, ``n(h)`` its distinct continuations,
and ``shared`` is one Kneser-Ney model of continuation counts of both classes
together, so a rare expression gets much the same probability in both.  An
n-gram that neither class has is backed off while scoring: ``shared`` is the
same in both, so its ratio is that of what the context leaves, D n(h) / c(h) of
each class (1 where the class lacks the context).

An expression lies inside one word of letters: no n-gram crosses a blank or a
digit, so ordinary words that are toxic only in sequence give no evidence.

A word's toxic and ordinary log-likelihoods are compared, in sum and per
symbol; a document is described by the comparison of all its symbols, its
strongest word, and what its strong words add up to.  A logistic function of
these, fitted on at most ``sample`` labelled texts of either class whose words
were counted apart (fold b scored by the model of fold a), gives the score.

All labelled training texts are counted, in Spark (they meet their labels in a
merge join at every size; only that moves texts); the model that reaches the
tasks holds the exact ratio of every counted n-gram, so it grows with the
distinct n-grams of the labelled texts.

NULL or empty text has the score of a text without words.  Rows repeating a
doc_id are scored each for itself; labels that repeat or contradict count each;
NULL labels teach nothing.  Without labels of both classes every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmap.llm.common import crc_remainder, stored, text_blocks
from creditmap.llm.grams import found, sums_by, word_grams

_DISCOUNT = 0.75
_FEATURES = 6


@dataclass(frozen=True)
class Toxicity:
    order: int = 5
    sample: int = 3_000  # texts of a class that the logistic function is fitted on
    strong: tuple[float, ...] = (1.0, 4.0)  # log-likelihood ratios from which words add up
    modulus: int = 3  # crc32 remainders of doc_ids; the held-out one teaches nothing
    held_out: int = 1


def _count(how: Toxicity):
    """(gram, class, fold, count) of the texts of a task."""
    def run(batches):
        kept = np.empty(0, np.uint64), np.empty(0, np.int64)

        def merged(parts):
            keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

        for batch in batches:
            marks = np.array([(x or 0) << 1 | (y or 0) for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], np.uint64)
            parts = [kept]
            for row, end, data, offsets in text_blocks(batch, "text"):
                grams, word, of = word_grams(data, offsets, how.order)
                keys, n = np.unique(grams | marks[row:end][of][word] << np.uint64(60), return_counts=True)
                parts.append((keys, n))
            kept = merged(parts)
        for lo in range(0, len(kept[0]), 10_000):
            keys, n = (x[lo : lo + 10_000] for x in kept)
            yield pa.RecordBatch.from_arrays([pa.array((keys & np.uint64((1 << 60) - 1)).astype(np.int64)), pa.array((keys >> np.uint64(61)).astype(np.int32)),
                                              pa.array((keys >> np.uint64(60) & np.uint64(1)).astype(np.int32)), pa.array(n)], names=["gram", "toxic", "fold", "n"])
    return run


def _shorter(gram: Column) -> Column:
    """The n-gram without its oldest symbol."""
    symbols = F.floor((F.length(F.hex(gram)) + 1) / 2).cast("int")
    return gram.bitwiseAND(F.element_at(F.array(*(F.lit((1 << 8 * k) - 1).cast("bigint") for k in range(8))), symbols))


def _shared(grams: DataFrame, order: int) -> DataFrame:
    """(gram, shared): probabilities by continuation counts, for the n-grams
    that are shorter by one symbol than those of ``grams``."""
    level = grams.select(_shorter(F.col("gram")).alias("gram")).where("gram > 0").groupBy("gram").agg(F.count("*").alias("n"))
    context = Window.partitionBy(F.shiftrightunsigned("gram", 8))  # a context has at most 256 symbols after it
    own = level.select("gram", (F.greatest(F.col("n") - _DISCOUNT, F.lit(0.0)) / F.sum("n").over(context)).alias("p"),
                       (F.count("*").over(context) * _DISCOUNT / F.sum("n").over(context)).alias("left"))
    if order == 1:
        return own.select("gram", (F.col("p") + F.col("left") / 256).alias("shared"))
    below = _shared(level, order - 1).withColumnRenamed("gram", "short")
    return (own.withColumn("short", _shorter(F.col("gram"))).join(below, "short", "left")  # one symbol has nothing shorter
            .select("gram", (F.col("p") + F.col("left") * F.coalesce("shared", F.lit(1 / 256))).alias("shared")))


def ratios(counts: DataFrame, how: Toxicity) -> DataFrame:
    """(gram, n, r_a, r, k_a, k_b): log p(toxic model) - log p(ordinary model) of
    each counted n-gram, by fold 0 only and by both folds; k_: the same of a
    symbol that neither class has after the n-gram's context."""
    wide = counts.groupBy("gram").agg(F.sum("n").alias("n"), *(
        F.sum(F.when((F.col("toxic") == c) & F.col("fold").isin(f), F.col("n")).otherwise(0)).alias(f"{name}{c}")
        for name, f in (("a", [0]), ("b", [0, 1])) for c in (0, 1)))
    wide = stored(wide, "grams")
    shared = _shared(wide.select("gram"), how.order - 1).withColumnRenamed("gram", "short")
    context = Window.partitionBy(F.shiftrightunsigned("gram", 8))

    def p(c: str) -> tuple[Column, Column]:
        """Of the symbol; what the context leaves to the shared model."""
        total = F.sum(c).over(context)
        kinds = F.sum((F.col(c) > 0).cast("int")).over(context)
        left = F.when(total > 0, _DISCOUNT * kinds / total).otherwise(F.lit(1.0))
        return F.when(total > 0, F.greatest(F.col(c) - _DISCOUNT, F.lit(0.0)) / total).otherwise(F.lit(0.0)) + left * F.col("shared"), left

    joined = wide.withColumn("short", _shorter(F.col("gram"))).join(shared, "short")
    return joined.select("gram", "n", *((F.log(p(f"{m}1")[0]) - F.log(p(f"{m}0")[0])).alias(f"r_{m}") for m in "ab"),
                         *((F.log(p(f"{m}1")[1]) - F.log(p(f"{m}0")[1])).alias(f"k_{m}") for m in "ab"))


@dataclass(frozen=True)
class Ratios:
    """Log-likelihood ratios of the counted n-grams and, for others, of their
    contexts; keys ascend."""

    grams: np.ndarray
    seen: np.ndarray
    contexts: np.ndarray
    unseen: np.ndarray

    def of(self, grams: np.ndarray) -> np.ndarray:
        """An n-gram that was not counted backs off to the shared model, which
        both classes have; what differs is what its context leaves to it."""
        distinct, at = np.unique(grams, return_inverse=True)
        out = np.zeros(len(distinct), np.float32)
        for keys, values, wanted in ((self.contexts, self.unseen, distinct >> np.uint64(8)), (self.grams, self.seen, distinct)):
            here, place = found(keys, wanted)
            out[here] = values[place]
        return out[at]


def describe(batch: pa.RecordBatch, model: Ratios, how: Toxicity) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, features of each row)."""
    for row, end, data, offsets in text_blocks(batch, "text"):
        rows = end - row
        out = np.zeros((rows, _FEATURES))
        grams, word, of = word_grams(data, offsets, how.order)
        if len(of):
            ratio = model.of(grams)
            by_word, symbols = sums_by(word, ratio, len(of)), np.bincount(word, minlength=len(of))
            words, length = np.bincount(of, minlength=rows), np.maximum(sums_by(of, symbols, rows), 1)
            some = np.flatnonzero(words)
            first = np.searchsorted(of, some)
            out[:, 0] = sums_by(of, by_word, rows) / length
            out[some, 1] = np.maximum.reduceat(by_word, first)
            out[some, 2] = np.maximum.reduceat(by_word / symbols, first)
            out[:, 3] = np.log1p(words)
            for k, strong in enumerate(how.strong):
                out[:, 4 + k] = np.log1p(sums_by(of, np.maximum(by_word - strong, 0), rows))
        yield row, end, out


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method: (means, scales, weights with the intercept last)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w)), z.T @ (weight * (y - p)) - 1e-2 * w)
        w += np.clip(step, -2, 2)
    return mean, scale, w


def score(docs: DataFrame, labels: DataFrame, how: Toxicity = Toxicity()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; labels: (doc_id, toxic)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    crc = crc_remainder(F.col("doc_id"), how.modulus)
    labels = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("toxic").isin(0, 1) & (crc != how.held_out)))
    train = docs.where(crc != how.held_out).join(labels.hint("merge"), "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))
    train = stored(train, "labelled")
    counts = train.select("text", "toxic", "fold").mapInArrow(_count(how), "gram long, toxic int, fold int, n long")
    learned = ratios(counts, how).withColumns({c: F.col(c).cast("float") for c in ("r_a", "r_b", "k_a", "k_b")}).drop("n").toArrow()
    grams = learned.column("gram").to_numpy()
    order = np.argsort(grams)
    grams = grams[order].astype(np.uint64)
    contexts, first = np.unique(grams >> np.uint64(8), return_index=True)
    apart, whole = (spark.sparkContext.broadcast(Ratios(grams, learned.column(f"r_{m}").to_numpy()[order], contexts, learned.column(f"k_{m}").to_numpy()[order][first])) for m in "ab")
    del learned

    order = F.xxhash64("doc_id", F.lit(1))
    apart_rows = train.where("fold = 1")
    classes = {c: n for c, n in apart_rows.groupBy("toxic").count().collect()}  # two rows at most
    kept = [apart_rows.where(F.col("toxic") == c).select("doc_id", "toxic").orderBy(order).limit(how.sample) for c in (0, 1)]
    sample = apart_rows.join(F.broadcast(kept[0].unionByName(kept[1]).select("doc_id").distinct()), "doc_id", "left_semi")  # bounded by 2 * how.sample

    def described(batches):
        for batch in batches:
            for row, end, x in describe(batch, apart.value, how):
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(row, end - row), *(pa.array(c) for c in x.T)], names=["toxic", *"abcdef"])

    fitted = sample.select("text", "toxic").mapInArrow(described, "toxic int, a double, b double, c double, d double, e double, f double").toArrow()
    y = fitted.column("toxic").to_numpy()
    model = None
    if 0 < y.sum() < len(y):
        weight = np.array([classes[c] / max(1, (y == c).sum()) for c in (0, 1)])[y]  # each class has its share of the labels
        model = _fit(np.column_stack([fitted.column(c).to_numpy() for c in "abcdef"]), y, weight / weight.mean())

    def scored(batches):
        for batch in batches:
            for row, end, x in describe(batch, whole.value, how):
                if model is None:
                    p = np.zeros(end - row)
                else:
                    mean, scale, w = model
                    p = 1 / (1 + np.exp(-np.clip((x - mean) / scale @ w[:-1] + w[-1], -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(p)], names=["doc_id", "score"])

    return (docs.mapInArrow(scored, "doc_id long, score double")
            .select("doc_id", (crc == how.held_out).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")))
