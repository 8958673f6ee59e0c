"""Best-fit packing with hierarchical residual merging.

Every task packs the items of its partition best-fit in order of decreasing
length and emits the bins that are nearly full (at most ``slack`` tokens
free).  The other bins go on as items: round after round they are dealt to
fewer tasks (at most ``items`` a task) and packed best-fit again, until one
task holds the rest or a round hardly merges anything; what is left then is
emitted as it is.  A bin holds at most ``capacity`` items, so a row is bounded;
each round is written to the shared folder.

A document is its ids and one end id; only one longer than the capacity is
cut, into pieces of the capacity and a rest.  NULL text is an empty document
(one end id).  Rows that repeat a doc_id are packed each for itself; a NULL
doc_id stays NULL; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmap.llm.batch_bpe import encoded_blocks
from creditmap.llm.common import stored

_PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
_BIN = "done boolean, sequence_id long, size int, pieces array<struct<doc_id: bigint, piece: int, length: bigint, ids_crc32: bigint, offset: bigint>>"


@dataclass(frozen=True)
class Packing:
    capacity: int = 4096
    end_id: int = 1
    slack: int = 8  # free tokens of a bin that counts as full
    items: int = 16_384  # that a task packs at once
    least_gain: float = 0.02  # share of bins that a round must save to be followed by another


def pieces(docs: DataFrame, path: str, how: Packing = Packing()) -> DataFrame:
    """(doc_id, piece, length, ids_crc32) of the pieces of every whole text."""
    end = np.array([how.end_id], "<u4").tobytes()
    step = 4 * how.capacity

    def run(batches):
        for part, ids in encoded_blocks(batches, path):
            doc_ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
            rows = []
            for doc_id, own in zip(doc_ids, ids):
                own = own.astype("<u4").tobytes() + end
                rows += [(doc_id, k, len(x) // 4, zlib.crc32(x)) for k in range(-(-len(own) // step)) for x in (own[k * step : (k + 1) * step],)]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                             names=["doc_id", "piece", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, length long, ids_crc32 long")


class _OpenBins:
    """Bins by free space; ``free`` has a bit for each space that some bin has."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_space: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.free = 0

    def put(self, size: int, item: list) -> tuple[int, list]:
        """Add the item to the fullest bin that has room, or to a new one; the bin's size and items."""
        fitting = self.free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            own = self.by_space[space].pop()
            if not self.by_space[space]:
                self.free &= ~(1 << space)
            own += item
        else:
            space, own = self.capacity, item
        return self.capacity - space + size, own

    def keep(self, size: int, items: list) -> None:
        space = self.capacity - size
        self.by_space[space].append(items)
        self.free |= 1 << space

    def drain(self) -> list[tuple[int, list]]:
        out = [(self.capacity - space, own) for space, bins in enumerate(self.by_space) for own in bins]
        self.by_space, self.free = [[] for _ in range(self.capacity + 1)], 0
        return out


def best_fit(items: list[tuple[int, list]], how: Packing) -> tuple[list[tuple[int, list]], list[tuple[int, list]]]:
    """(nearly full bins, other bins) of best-fit by decreasing size."""
    full, bins = [], _OpenBins(how.capacity)
    for size, item in sorted(items, key=lambda x: -x[0]):
        size, own = bins.put(size, list(item))
        if size >= how.capacity - how.slack:
            full.append((size, own))
        else:
            bins.keep(size, own)
    return full, bins.drain()


def _packed(how: Packing, level: int, last: bool):
    def run(batches):
        partition, made, waiting = TaskContext.get().partitionId(), 0, []

        def rows(bins: list[tuple[int, list]], done: bool) -> Iterator[pa.RecordBatch]:
            nonlocal made
            for lo in range(0, len(bins), 1024):
                numbers, sizes, members = [], [], []
                for size, own in bins[lo : lo + 1024]:
                    numbers.append(level << 56 | partition << 32 | made)
                    made += 1
                    sizes.append(size)
                    at = 0
                    placed = []
                    for doc_id, piece, length, crc in own:
                        placed.append({"doc_id": doc_id, "piece": piece, "length": length, "ids_crc32": crc, "offset": at})
                        at += length
                    members.append(placed)
                yield pa.RecordBatch.from_arrays([pa.array([done] * len(sizes)), pa.array(numbers, pa.int64()), pa.array(sizes, pa.int32()), pa.array(members, pa.list_(_PIECE))],
                                                 names=["done", "sequence_id", "size", "pieces"])

        for batch in batches:
            for own in batch.column(batch.schema.get_field_index("pieces")).to_pylist():
                own = [(x["doc_id"], x["piece"], x["length"], x["ids_crc32"]) for x in own]
                waiting.append((sum(x[2] for x in own), own))
            if len(waiting) >= how.items:  # the bins that are not full wait for the next items
                full, waiting = best_fit(waiting, how)
                yield from rows(full, True)
                if len(waiting) >= how.items // 2:
                    yield from rows(waiting, last)
                    waiting = []
        full, waiting = best_fit(waiting, how)
        yield from rows(full, True)
        yield from rows(waiting, last)
    return run


def pack(items: DataFrame, how: Packing = Packing()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for rows as of :func:`pieces`."""
    left = items.select(F.array(F.struct("doc_id", "piece", "length", "ids_crc32", F.lit(0).cast("bigint").alias("offset"))).alias("pieces"))
    n, level, last, done = None, 0, False, []
    while True:
        now = stored(left.mapInArrow(_packed(how, level, last), _BIN), "bins")
        done.append(now.where("done"))
        if last:
            break
        left = now.where("NOT done").select("pieces")
        rest = left.count()
        if not rest:
            break
        last = rest <= how.items or n is not None and rest > n * (1 - how.least_gain)
        n, level = rest, level + 1
        left = left.repartition(-(-rest // how.items))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return (found.select("sequence_id", F.inline("pieces"))
            .select("doc_id", "piece", (F.col("piece").cast("bigint") * how.capacity).alias("start"), "length", "ids_crc32", "sequence_id", "offset"))


def pack_documents(docs: DataFrame, path: str, how: Packing = Packing()) -> DataFrame:
    """Tokenise and pack every document; the pieces are written once, before packing."""
    return pack(stored(pieces(docs, path, how), "pieces"), how)
