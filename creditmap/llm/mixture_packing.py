"""Mixture-controlled packing by deficit round-robin over source queues.

The documents of a source, each its ids and one end id, are one queue of
tokens.  The round-robin has one round per window of ``capacity`` tokens; in
round r the deficit counter of queue s grows by its quantum, ``weight_s /
rounds`` of its tokens' share, and the queue sends whole multiples of
``quantum`` tokens as its counter allows; what is left of the counter is
carried to the next round.  After r rounds queue s has sent

    sent(s, r) = quantum * floor(T_s * r / (rounds * quantum) + phase_s),   T_s at the end,

so the counters at any round are known without the rounds before it: every
partition computes the pieces of its own documents, and deficits carry over
windows and partitions alike.  ``phase_s`` (a golden-ratio sequence) staggers
the queues.  The turns, one after the other, are one line of tokens that is cut
every ``capacity`` tokens; what is left at its end is cut at powers of two, so
no sequence needs padding.  Each window deviates from the target proportions by
at most about one quantum per queue.

Target proportions are those of the tokens, so that every queue ends with the
last window and each token is used once.  A source with less than 1 /
``lanes`` of all tokens (owed less than a token per window at 4096) shares one
of ``lanes`` queues with others, by hash: there are at most 2 * ``lanes``
queues, whatever the number of sources.

Rows: NULL text is an empty document (one end id); NULL sources are a queue;
rows that repeat a doc_id are packed each for itself, a NULL doc_id stays NULL;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditmap.llm.batch_bpe import encoded_blocks
from creditmap.llm.common import stored

_GOLDEN = 0.6180339887498949


@dataclass(frozen=True)
class Mixture:
    capacity: int = 2048
    end_id: int = 1
    quantum: int = 64  # tokens that a queue sends at once, a source's last ones may be fewer
    lanes: int = 1024


class Schedule:
    """The line of turns for queues of ``totals`` tokens."""

    def __init__(self, totals: np.ndarray, how: Mixture):
        self.how, self.totals = how, np.asarray(totals, np.int64)
        self.tokens = int(self.totals.sum())
        self.rounds = max(1, -(-self.tokens // how.capacity))
        #: credit of each queue before the first round, of 0 to 1 quantum in units of 1 / rounds token
        self.phase = (np.arange(1, len(self.totals) + 1) * _GOLDEN % 1 * self.rounds).astype(np.int64) * how.quantum
        self.whole, self.rest = self.totals // self.rounds, self.totals % self.rounds

    def sent(self, queues, rounds) -> np.ndarray:
        """Tokens that the queues have sent after so many rounds."""
        r, q = np.asarray(rounds, np.int64), self.how.quantum
        # T_s * r / rounds by parts, as products of two large numbers do not fit in 64 bits
        rest = self.rest[queues]
        high, left = np.divmod(rest * (r >> 16), self.rounds)
        credit = self.whole[queues] * r + (high << 16) + ((left << 16) + rest * (r & 0xFFFF) + self.phase[queues]) // self.rounds
        return np.where(r >= self.rounds, self.totals[queues], np.minimum(credit // q * q, self.totals[queues]) * (r > 0))

    def round_of(self, queue: int, tokens: np.ndarray) -> np.ndarray:
        """The rounds in which the queue sends these tokens (places in it)."""
        q, r = self.how.quantum, self.rounds
        share = r / max(1, int(self.totals[queue]))
        out = np.ceil((tokens // q + 1) * (q * share) - self.phase[queue] / r * share).astype(np.int64) - 1
        out = np.clip(out, 0, r - 1)  # at most a few rounds off, by the rounding of floating numbers
        while (off := (out < r - 1) & (self.sent(queue, out + 1) <= tokens)).any():
            out += off
        while (off := self.sent(queue, out) > tokens).any():
            out -= off
        return out

    def line(self, queue: int, rounds: np.ndarray) -> np.ndarray:
        """The places on the line at which the queue's turns of these rounds begin."""
        own, index = np.unique(rounds, return_inverse=True)
        out = np.empty(len(own), np.int64)
        every = np.arange(len(self.totals))[None, :]
        step = max(1, (1 << 18) // max(1, len(self.totals)))
        for i in range(0, len(own), step):
            r = own[i : i + step, None]
            before = self.sent(every, r)
            out[i : i + step] = before.sum(1) + (self.sent(every[:, :queue], r + 1) - before[:, :queue]).sum(1)
        return out[index]

    def turns(self, queue: int, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, place in the queue, place on the line, length) of the turns of documents that are
        ``sizes`` tokens of the queue from ``first`` on."""
        q = self.how.quantum
        units = (first + sizes - 1) // q - first // q + 1
        doc = np.repeat(np.arange(len(first)), units)
        unit = np.arange(len(doc)) - np.repeat(np.cumsum(units) - units, units) + np.repeat(first // q, units)
        start = np.maximum(unit * q, first[doc])
        own = self.round_of(queue, start)
        begins = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])))
        doc, start, own = doc[begins], start[begins], own[begins]
        end = np.where(np.append(doc[1:] == doc[:-1], False), np.append(start[1:], 0), (first + sizes)[doc])
        return doc, start, self.line(queue, own) + start - self.sent(queue, own), end - start

    def pieces(self, queue: int, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, start, length, sequence, offset) of the pieces of documents that are ``sizes``
        tokens of the queue from ``first`` on."""
        capacity = self.how.capacity
        doc, start, place, length = self.turns(queue, first, sizes)
        joined = np.append(True, (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + length[:-1]))
        begins = np.flatnonzero(joined)  # turns that follow each other on the line are one
        doc, start, place, length = doc[begins], start[begins], place[begins], np.add.reduceat(length, begins)
        windows = (place + length - 1) // capacity - place // capacity + 1
        of = np.repeat(np.arange(len(doc)), windows)
        number = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows) + (place // capacity)[of]
        low = np.maximum(place[of], number * capacity)
        high = np.minimum((place + length)[of], (number + 1) * capacity)
        base = number * capacity
        tail = self.tokens % capacity
        if tail and (number == self.rounds - 1).any():  # the last tokens go to sequences of powers of two, largest first
            parts = [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]
            edges = (self.rounds - 1) * capacity + np.cumsum([0, *parts])
            last = np.flatnonzero(number == self.rounds - 1)
            times = np.searchsorted(edges, high[last], "left") - np.searchsorted(edges, low[last], "right") + 1
            keep = np.ones(len(of), np.int64)
            keep[last] = times
            again = np.repeat(np.arange(len(of)), keep)
            nth = np.arange(len(again)) - np.repeat(np.cumsum(keep) - keep, keep)
            of, number, low, high, base = of[again], number[again], low[again], high[again], base[again]
            in_tail = np.flatnonzero(number == self.rounds - 1)
            part = np.searchsorted(edges, low[in_tail], "right") - 1 + nth[in_tail]
            low[in_tail] = np.maximum(low[in_tail], edges[part])
            high[in_tail] = np.minimum(high[in_tail], edges[part + 1])
            base[in_tail], number[in_tail] = edges[part], self.rounds - 1 + part
        return doc[of], start[of] + low - place[of] - first[doc[of]], high - low, number, low - base


def _encoded(path: str, how: Mixture):
    """Rows (source, doc_id, ids as unsigned 16- or 32-bit numbers, their count, tokens of the source
    before it in the chunk); a chunk is what one task encodes."""
    def run(batches):
        chunk, sent = TaskContext.get().partitionId(), {}
        for part, ids in encoded_blocks(batches, path):
            doc_ids, sources = (part.column(part.schema.get_field_index(c)) for c in ("doc_id", "source"))
            lengths, before, packed = [], [], []
            for source, own in zip(sources.to_pylist(), ids):
                n = len(own) + 1
                before.append(sent.get(source, 0))
                sent[source] = before[-1] + n
                lengths.append(n)
                own = np.append(own, np.uint32(how.end_id))
                packed.append(own.astype("<u2" if own.max() < 1 << 16 else "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(ids), pa.int64()), sources, doc_ids, pa.array(lengths, pa.int64()), pa.array(before, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["chunk", "source", "doc_id", "doc_tokens", "before", "ids"])
    return run


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _placed(schedule):
    def run(batches):
        own: Schedule = schedule.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
                queues, first, sizes = (column[c].to_numpy().astype(np.int64) for c in ("queue", "first", "doc_tokens"))
                found = []
                for queue in np.unique(queues).tolist():
                    mine = np.flatnonzero(queues == queue)
                    doc, *rest = own.pieces(queue, first[mine], sizes[mine])
                    found.append((mine[doc], *rest))
                doc, start, length, sequence, offset = (np.concatenate(x) for x in zip(*found))
                ids = [memoryview(np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4").astype("<u4")).cast("B") for x, n in zip(column["ids"].to_pylist(), sizes.tolist())]
                crc = [zlib.crc32(ids[d][4 * a : 4 * (a + n)]) for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([column["doc_id"].take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length, crc, sizes[doc], sequence, offset))],
                                                 names=[x.split()[0] for x in _PIECES.split(", ")])
    return run


def _queues(encoded: DataFrame, how: Mixture) -> DataFrame:
    """(source, lane): large sources have a lane each, the others share lanes by hash."""
    totals = encoded.groupBy("source").agg(F.sum("doc_tokens").alias("tokens"))
    whole = F.broadcast(totals.agg(F.sum("tokens").alias("whole")))  # one row
    large = F.col("tokens") * how.lanes >= F.col("whole")  # true for at most ``lanes`` sources
    name = F.when(large, F.struct(F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("part"), F.col("source").alias("name")))
    shared = F.struct(F.lit(1).alias("kind"), F.pmod(F.xxhash64("source"), F.lit(how.lanes)).alias("part"), F.lit(None).cast("string").alias("name"))
    return totals.crossJoin(whole).select("source", "tokens", F.coalesce(name, shared).alias("lane"))


def pack_documents(docs: DataFrame, path: str, how: Mixture = Mixture()) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of the pieces of every document."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    encoded = stored(docs.mapInArrow(_encoded(path, how), "chunk long, source string, doc_id long, doc_tokens long, before long, ids binary"), "encoded")
    queues = stored(_queues(encoded, how), "queues")
    lanes = queues.groupBy("lane").agg(F.sum("tokens").alias("tokens")).orderBy("lane").collect()  # at most 2 * lanes rows
    if not lanes:
        return spark.createDataFrame([], _PIECES)
    schedule = spark.sparkContext.broadcast(Schedule(np.array([x["tokens"] for x in lanes], np.int64), how))
    number = spark.createDataFrame([(*x["lane"], k) for k, x in enumerate(lanes)], "kind int, part long, name string, queue int")
    same = [queues["lane"][c].eqNullSafe(number[c]) for c in ("kind", "part", "name")]
    named = queues.join(F.broadcast(number), same[0] & same[1] & same[2]).select("source", "queue")

    # where each chunk's documents of a source begin in their queue: one row per (chunk, source)
    sums = encoded.groupBy("chunk", "source").agg(F.sum("doc_tokens").alias("tokens"))
    sums = sums.join(named, sums["source"].eqNullSafe(named["source"])).select(sums["chunk"], sums["source"], "queue", "tokens")
    line = Window.partitionBy("queue").orderBy("chunk", "source")
    bases = stored(sums.select("chunk", "source", "queue", (F.sum("tokens").over(line) - F.col("tokens")).alias("base")), "bases")
    there = (encoded["chunk"] == bases["chunk"]) & encoded["source"].eqNullSafe(bases["source"])
    rows = encoded.join(bases, there).select("doc_id", "queue", (F.col("base") + F.col("before")).alias("first"), "doc_tokens", "ids")
    return rows.mapInArrow(_placed(schedule), _PIECES)
