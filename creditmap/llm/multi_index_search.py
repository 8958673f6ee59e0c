"""Exact top-k search of binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension (positive or not).  A code is cut
into segments of ``bits``; every code stands in one bucket per segment, packed
into chunks of at most ``chunk`` codes.  In round r each query visits, in every
segment, the buckets at Hamming distance r from its own segment, verifies the
codes there and keeps its ``k`` nearest.  After round r every code within
``segments * (r + 1) - 1`` has been met (one of its segments differs in at most
r bits), so a query whose kth distance is within that is done; the others go on.
After the last radius every bucket has been visited.

Queries are the rows whose id is divisible by ``every``; all rows are searched.
A row is not its own neighbour.  Neighbours rank by distance, then id; a query
with fewer than k others gets them all.  A NULL vector or id is left out, a
NULL or missing dimension is a zero bit, repeated rows with equal id and code
are one row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmap.llm.common import stored


@dataclass(frozen=True)
class Search:
    k: int = 10
    every: int = 100
    bits: int = 11
    chunk: int = 512


def codes(vectors: DataFrame) -> tuple[DataFrame, int]:
    """((vec_id, code: binary of packed bits), bits of a code)."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0

    def pack(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, max(8, -(-width // 8) * 8)), np.uint8)
            for k, x in enumerate(batch.column(1).to_pylist()):
                out[k, : len(x)] = [v is not None and v > 0 for v in x]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in np.packbits(out, axis=1)], pa.binary())], names=["vec_id", "code"])

    return rows.mapInArrow(pack, "vec_id long, code binary").distinct(), width


def _bits(code: np.ndarray, width: int) -> np.ndarray:
    return np.unpackbits(code, axis=1)[:, :width]


def _segments(width: int, how: Search) -> list[tuple[int, int]]:
    n = max(1, -(-width // how.bits))
    cuts = [width * k // n for k in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def _values(bits: np.ndarray, lo: int, hi: int) -> np.ndarray:
    return bits[:, lo:hi].astype(np.int64) @ (1 << np.arange(hi - lo, dtype=np.int64))


def _placed(width: int, how: Search):
    """(segment, value, vec_id, code) of every code."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column(1).to_pylist()
            bits = _bits(np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), width)
            for segment, (lo, hi) in enumerate(_segments(width, how)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(raw), segment, np.int32)), pa.array(_values(bits, lo, hi)), batch.column(0), batch.column(1)],
                                                 names=["segment", "value", "vec_id", "code"])
    return run


def _probes(width: int, radius: int, how: Search):
    """(segment, value, query, code) of the buckets at this radius."""
    def run(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            if not raw:
                continue
            bits = _bits(np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), width)
            for segment, (lo, hi) in enumerate(_segments(width, how)):
                flips = np.array([sum(1 << j for j in c) for c in combinations(range(hi - lo), radius)], np.int64)
                if len(flips):
                    value = (_values(bits, lo, hi)[:, None] ^ flips[None, :]).ravel()
                    at = pa.array(np.repeat(np.arange(len(raw)), len(flips)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), segment, np.int32)), pa.array(value), batch.column(0).take(at), batch.column(1).take(at)],
                                                     names=["segment", "value", "query", "code"])
    return run


def _verify(how: Search):
    """The k nearest of each query among the chunks of a batch: (query, near: [(distance, vec_id)])."""
    def run(batches):
        for batch in batches:
            best: dict[tuple[int, bytes], list] = {}
            for query, code, ids, packed in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("query", "code", "ids", "codes"))):
                query, code, ids = query.as_py(), code.as_py(), np.array(ids.as_py())
                own = np.frombuffer(code, np.uint8)
                others = np.frombuffer(packed.as_py(), np.uint8).reshape(len(ids), -1)
                distance = np.bitwise_count(others ^ own).sum(1).astype(np.int64)
                order = np.lexsort((ids, distance))
                near = [(int(distance[j]), int(ids[j])) for j in order[: how.k + 1] if ids[j] != query]
                best[query, code] = sorted({*best.get((query, code), ()), *near})[: how.k]
            if best:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q for q, _ in best], pa.int64()), pa.array([c for _, c in best], pa.binary()),
                     pa.array([[{"distance": d, "vec_id": v} for d, v in x] for x in best.values()], pa.list_(pa.struct([("distance", pa.int64()), ("vec_id", pa.int64())])))],
                    names=["query", "code", "near"])
    return run


def top_k(vectors: DataFrame, how: Search = Search()) -> DataFrame:
    """(query, rank, vec_id, distance): the k nearest of each query."""
    found, width = codes(vectors)
    found = stored(found, "codes")
    segments = len(_segments(width, how))
    buckets = found.mapInArrow(_placed(width, how), "segment int, value long, vec_id long, code binary")
    chunks = (buckets.groupBy("segment", "value").agg(F.count("*").alias("n")).select("segment", "value", F.ceil(F.col("n") / how.chunk).alias("parts")))
    packed = (buckets.join(chunks, ["segment", "value"]).withColumn("part", F.expr("pmod(xxhash64(vec_id, code), parts)"))
              .groupBy("segment", "value", "part").agg(F.array_sort(F.collect_list(F.struct("vec_id", "code"))).alias("m"))
              .select("segment", "value", F.col("m.vec_id").alias("ids"), F.expr("aggregate(m, X'', (x, y) -> concat(x, y.code))").alias("codes")))
    packed = stored(packed, "buckets")

    active = stored(found.where(F.col("vec_id") % how.every == 0).select(F.col("vec_id").alias("query"), "code"), "queries")
    near = "array<struct<distance: bigint, vec_id: bigint>>"
    state = active.withColumn("near", F.array().cast(near))
    done = []
    longest = max([hi - lo for lo, hi in _segments(width, how)], default=0)
    for radius in range(longest + 1):
        hits = (state.select("query", "code").mapInArrow(_probes(width, radius, how), "segment int, value long, query long, code binary")
                .join(packed, ["segment", "value"]).select("query", "code", "ids", "codes").mapInArrow(_verify(how), f"query long, code binary, near {near}"))
        every = state.unionByName(hits).select("query", "code", F.explode_outer("near").alias("x"))
        state = (every.groupBy("query", "code").agg(F.collect_set("x").alias("x"))
                 .select("query", "code", F.slice(F.array_sort("x"), 1, how.k).alias("near")))
        state = stored(state.withColumn("done", (F.size("near") >= how.k) & (F.element_at("near", -1)["distance"] <= segments * (radius + 1) - 1)), "queries")
        done.append(state.where("done").drop("done"))
        state = state.where("NOT done OR done IS NULL").drop("done")
        if state.isEmpty():
            break
    else:
        done.append(state)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("query", F.posexplode("near").alias("at", "x")).select("query", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.distance").alias("distance"))
