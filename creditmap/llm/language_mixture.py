"""Language identification by mixture inference.

Per language, byte n-grams inside words are counted over all training texts;
a word's likelihood in a language is the product over its symbols of

    p(w | h) = (c(h w) + beta / 256) / (c(h) + beta)

A document is a mixture: expectation-maximisation estimates the proportions of
its languages from its words' likelihoods, until the log-likelihood is within
``tolerance`` of its maximum.  The set of languages is selected by penalised
likelihood: the likeliest language alone and the 2, 3, ... languages of greatest
proportion, up to all learned ones, compete, each further language costing
``penalty`` * log(words).  A set is left out, or its fit ended, only where a
bound of its likelihood shows that it cannot win.  The prediction is the
language of greatest proportion in the selected set, the score that proportion.

The model that reaches the tasks holds the exact count of every (n-gram,
language) and (context, language) of the training texts, about 16 bytes each:
it grows with the distinct n-grams of the input and nothing in it is merged or
left out.  The number of languages is that of distinct labels.

NULL text, or text without a letter, is ``und`` with score 0.  NULL languages
teach nothing; without any learned language every row is ``und``.  Rows
repeating a doc_id are predicted each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmap.llm.common import crc_remainder, text_blocks
from creditmap.llm.grams import found, tallied, word_grams

_A_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Languages:
    order: int = 4
    beta: float = 2.0
    tolerance: float = 0.01  # of a document's log-likelihood, where expectation-maximisation ends
    penalty: float = 2.0
    modulus: int = 4  # crc32 remainders of doc_ids; the held-out one teaches nothing
    held_out: int = 2


def _count(how: Languages, names: list[str]):
    """(gram, language, count) of a task."""
    def run(batches):
        number = {name: k for k, name in enumerate(names)}

        def parts():
            for batch in batches:
                of_row = np.array([number[x] for x in batch.column(1).to_pylist()], np.uint64)
                for row, end, data, offsets in text_blocks(batch, "text"):
                    grams, word, of = word_grams(data, offsets, how.order)
                    if len(of):
                        yield np.unique(grams * np.uint64(len(names)) + of_row[row:end][of][word], return_counts=True)

        for keys, n in tallied(parts()):
            for lo in range(0, len(keys), 10_000):
                at = keys[lo : lo + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array((at // np.uint64(len(names))).astype(np.int64)), pa.array((at % np.uint64(len(names))).astype(np.int32)),
                                                  pa.array(n[lo : lo + 10_000])], names=["gram", "language", "n"])
    return run


@dataclass(frozen=True)
class Counts:
    """Logarithms of smoothed counts by (key, language): those of ``keys[i]``
    are at ``starts[i]`` to ``starts[i + 1]``, others are ``unseen``."""

    keys: np.ndarray
    starts: np.ndarray
    language: np.ndarray
    value: np.ndarray
    unseen: float

    @classmethod
    def of(cls, key: np.ndarray, language: np.ndarray, n: np.ndarray, more: float) -> Counts:
        """Of distinct pairs in ascending order."""
        keys, starts = np.unique(key, return_index=True)
        return cls(keys, np.append(starts, len(key)), language, np.log(n + more).astype(np.float32), float(np.log(more)))

    def rows(self, wanted: np.ndarray, languages: int) -> np.ndarray:
        out = np.full((len(wanted), languages), self.unseen, np.float32)
        here, at = found(self.keys, wanted)
        n = self.starts[at + 1] - self.starts[at]
        pair = np.repeat(self.starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out[np.repeat(here, n), self.language[pair]] = self.value[pair]
        return out


def learned(train: DataFrame, names: list[str], how: Languages) -> tuple[Counts, Counts]:
    """Counts of every n-gram and every context in ``train`` (text, lang)."""
    counted = train.mapInArrow(_count(how, names), "gram long, language int, n long").groupBy("gram", "language").agg(F.sum("n").alias("n")).toArrow()
    gram, language, n = (counted.column(c).to_numpy() for c in ("gram", "language", "n"))
    order = np.lexsort((language, gram))
    gram, language, n = gram[order].astype(np.uint64), language[order], n[order]
    pairs, at = np.unique((gram >> np.uint64(8)) * np.uint64(len(names)) + language.astype(np.uint64), return_inverse=True)
    contexts = pairs // np.uint64(len(names)), (pairs % np.uint64(len(names))).astype(np.int32), np.bincount(at, n, len(pairs))
    return Counts.of(gram, language, n, how.beta / 256), Counts.of(*contexts, how.beta)


def symbol_likelihoods(grams: np.ndarray, model: tuple[Counts, Counts], languages: int) -> np.ndarray:
    """log p(w | h) of each symbol in each language."""
    distinct, at = np.unique(grams, return_inverse=True)
    context, of = np.unique(distinct >> np.uint64(8), return_inverse=True)
    return (model[0].rows(distinct, languages) - model[1].rows(context, languages)[of])[at]


def _fit(p: np.ndarray, starts: np.ndarray, words: np.ndarray, share: np.ndarray, least: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(proportions, log-likelihood, bound) for rows of ``words`` words that
    begin at ``starts``; a language of share 0 stays out.

    The log-likelihood is concave in the proportions, so its maximum is at most
    words * log(greatest slope) above the present value; that is the bound.  A
    row is done when the bound is within ``tolerance``, or not above ``least``."""
    shares, value, bound = share.copy(), np.empty(len(words)), np.empty(len(words))
    live = np.arange(len(words))
    while len(live):
        total = np.einsum("ij,ij->i", p, np.repeat(share, words, axis=0))
        slope = np.add.reduceat(p / total[:, None], starts, axis=0) / words[:, None]
        fitted = np.add.reduceat(np.log(total), starts)
        gap = words * np.log(np.maximum(np.where(share > 0, slope, 0).max(1), 1))
        shares[live], value[live], bound[live] = share, fitted, fitted + gap
        go = (gap > tolerance) & (fitted + gap > least)
        share = np.where(share > 0, np.maximum(share * slope, 1e-30), 0)
        if not go.all():
            p, live, share, words, least = p[np.repeat(go, words)], live[go], share[go], words[go], least[go]
            starts = np.cumsum(words) - words
    return shares, value, bound


def mixture(likelihood: np.ndarray, row: np.ndarray, rows: int, how: Languages) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, selected set) of each row from its words' log-likelihoods;
    ``row``: ascending row of each word."""
    likelihood = likelihood.astype(np.float64)
    languages = likelihood.shape[1]
    count = np.bincount(row, minlength=rows)
    some = np.flatnonzero(count)  # rows that have words
    words = count[some]
    starts = np.cumsum(words) - words
    cost = how.penalty * np.log(np.maximum(words, 2))

    def fit(at, allowed, share, least):
        """``_fit`` of the rows ``at`` with the languages ``allowed``."""
        inside = np.zeros(len(some), bool)
        inside[at] = True
        n, x = words[at], likelihood[np.repeat(inside, words)]
        if not allowed.all():
            x = np.where(np.repeat(allowed, n, axis=0), x, -np.inf)
        top, start = x.max(1), np.cumsum(n) - n
        base = np.add.reduceat(top, start)
        shares, value, bound = _fit(np.exp(x - top[:, None]), start, n, share, least - base, how.tolerance)
        return shares, value + base, bound + base

    alone = np.add.reduceat(likelihood, starts, axis=0)
    chosen = np.arange(languages) == alone.argmax(1)[:, None]
    shares, best = chosen.astype(np.float64), alone.max(1)
    full, _, bound = fit(np.arange(len(some)), np.ones((len(some), languages), bool), np.full((len(some), languages), 1 / languages), best + cost)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
    rivals = np.arange(len(some))
    for k in range(2, languages + 1):
        rivals = rivals[bound[rivals] > best[rivals] + (k - 1) * cost[rivals]]  # no larger set of the others can win
        if not len(rivals):
            break
        allowed, least = rank[rivals] < k, best[rivals] + (k - 1) * cost[rivals]
        start = np.where(allowed, full[rivals] + 1e-3, 0)
        share, value, _ = fit(rivals, allowed, start / start.sum(1, keepdims=True), least)
        better = value > least
        best[rivals] = np.where(better, value - (k - 1) * cost[rivals], best[rivals])
        chosen[rivals] = np.where(better[:, None], allowed, chosen[rivals])
        shares[rivals] = np.where(better[:, None], share, shares[rivals])
    out, sets = np.full((rows, languages), 1 / languages), np.zeros((rows, languages), bool)
    out[some], sets[some] = shares, chosen
    return out, sets


def _lettered(batch: pa.RecordBatch, row: int, end: int, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row has a letter."""
    low = data | 32
    some = np.append(0, np.cumsum((low >= 97) & (low <= 122)))
    found = some[offsets[1:]] > some[offsets[:-1]]
    at = batch.schema.get_field_index("text")
    for k in np.flatnonzero(~found):
        found[k] = bool(_A_LETTER.search(batch.column(at)[row + int(k)].as_py() or ""))
    return found


def _fitted(docs: DataFrame, how: Languages) -> tuple[list[str], Broadcast]:
    """The languages in ``docs`` and the model of its training texts."""
    train = docs.where((crc_remainder(F.col("doc_id"), how.modulus) != how.held_out) & F.col("lang").isNotNull()).select("text", "lang")
    names = sorted(x[0] for x in train.select("lang").distinct().toLocalIterator())
    return names, docs.sparkSession.sparkContext.broadcast(learned(train, names, how) if names else None)


def _predicted(batch: pa.RecordBatch, names: list[str], counts: tuple[Counts, Counts] | None, how: Languages) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, whether there is a letter, proportions, selected set)."""
    for row, end, data, offsets in text_blocks(batch, "text"):
        rows = end - row
        grams, word, of = word_grams(data, offsets, how.order)
        known = _lettered(batch, row, end, data, offsets) if names else np.zeros(rows, bool)
        share, chosen = np.ones((rows, max(1, len(names)))), np.zeros((rows, max(1, len(names))), bool)
        if names and len(of):
            symbols = symbol_likelihoods(grams, counts, len(names))
            words = np.add.reduceat(symbols, np.searchsorted(word, np.arange(len(of))), axis=0)
            share, chosen = mixture(words, of, rows, how)
        yield row, end, known, share, chosen


def identify(docs: DataFrame, how: Languages = Languages()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, langs: the selected set) for every row of ``docs`` (doc_id, text, lang)."""
    names, model = _fitted(docs, how)

    def predicted(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, known, share, chosen in _predicted(batch, names, model.value, how):
                best = share.argmax(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array([names[b] if k else "und" for b, k in zip(best, known)], pa.string()),
                     pa.array(np.where(known, share[np.arange(end - row), best], 0.0)),
                     pa.array([[names[c] for c in np.flatnonzero(x)] if k else [] for x, k in zip(chosen, known)], pa.list_(pa.string()))],
                    names=["doc_id", "lang_pred", "score", "langs"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    crc = crc_remainder(F.col("doc_id"), how.modulus)
    return (rows.mapInArrow(predicted, "doc_id long, lang_pred string, score double, langs array<string>")
            .select("doc_id", (crc == how.held_out).alias("held_out"), "lang_pred", "score", "langs"))


def accepted(docs: DataFrame, least: float, how: Languages = Languages()) -> DataFrame:
    """The rows of ``docs`` whose main language has a share of ``least`` or more, decided as they pass."""
    names, model = _fitted(docs, how)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, known, share, _ in _predicted(batch, names, model.value, how):
                yield batch.slice(row, end - row).filter(pa.array(known & (share.max(1) >= least)))

    return docs.mapInArrow(run, docs.schema)
