"""Hard negatives by L2AP-style threshold joins.

Anchors are a stated share of the rows.  Rows are dealt to blocks of bounded
size, by ranges of (label, hash), so a label of any size is spread; a block of anchors meets a block of rows through the rows' inverted
index.  Dimensions come in one global order, largest second moment first.  A
dimension's posting list omits the rows whose norm over this and all later
dimensions, times the anchors' norm, stays below the block's least threshold:
what such a row would still add can't lift a pair over it.  Partial scores are
accumulated list by list; a pair is pruned when its partial score plus the
product of the remaining norms is below its anchor's threshold; the others are
scored exactly, in whole numbers.

Thresholds are lowered until the windows fill: a join that finds ``k`` rows at
or above an anchor's threshold has its best k, and only anchors with fewer go
on with the next lower one, the last of which admits all that the window does.

* positives: the best ``positives`` other rows of the anchor's label;
* negatives: for each positive the best ``negatives`` rows of another label
  whose score lies in the window ``low`` to ``high`` per cent of the positive's.

Rows with a NULL id, label or vector, or a NULL or non-finite component, take
no part.  Vectors of different lengths meet in the dimensions that both have.
Repeated ids are rows of their own, a row of the anchor's own id is never its
positive; ties go to the smaller id, then label.  Scores are exact while sums
of products stay below 2 ** 53.  An empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditmap.llm.common import stored


_MOST = 1 << 62


@dataclass(frozen=True)
class Mining:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50  # window of a negative's score, per cent of the positive's
    high: int = 95
    rows: int = 2048  # of a block
    anchors: int = 1024
    step: int = 8  # dimensions between two prunings
    likeness: tuple[float, ...] = (0.6, 0.3, 0.0)  # thresholds of positives, in products of the anchor's and the largest norm
    levels: tuple[float, ...] = (0.9, 0.75)  # thresholds of negatives, by the positive's score


def quantised(embeddings: DataFrame, how: Mining = Mining()) -> DataFrame:
    """(id, label, v) of the rows that take part; v is floor(scale * x)."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return (embeddings.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(~bad)
            .select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"),
                    F.transform(x, lambda c: F.floor(c * how.scale).cast("double")).alias("v")))


def _order(rows: DataFrame) -> list[int]:
    """The dimensions, largest sum of squares first."""
    sums = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.sum(F.col("x") * F.col("x")).alias("s"))
    return [x["d"] for x in sums.orderBy(F.desc("s"), "d").collect()]  # one row a dimension


def _matrix(column: pa.Array, order: list[int]) -> np.ndarray:
    out = np.zeros((len(column), len(order)))
    for k, own in enumerate(column.to_pylist()):
        out[k, : len(own)] = own
    return out[:, order]


def _packed(order: list[int], names: dict[str, str], size: int):
    """Rows of a block each: about ``size`` rows of the (sorted) task as binary columns."""
    def run(batches):
        partition, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                column = {name: part.column(k) for k, name in enumerate(part.schema.names)}
                v = _matrix(column["v"], order)
                kind = next((c for c in ("<i2", "<i4") if not len(v) or np.abs(v).max() < np.iinfo(c).max), "<f8")
                labels = np.unique(column["label"].to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition << 32 | made]), pa.array([labels.tolist()], pa.list_(pa.int64())), pa.array([float(_norms(v)[:, 0].max())]),
                     *(pa.array([column[c].cast(pa.int64()).to_numpy().tobytes()], pa.binary()) for c in names), pa.array([v.astype(kind).tobytes()], pa.binary()), pa.array([kind])],
                    names=["block", "labels", "norm", *names.values(), "v", "kind"])
                made += 1
    return run


def _blocks(rows: DataFrame, order: list[int], names: dict[str, str], size: int, key: str, name: str) -> DataFrame:
    """``rows`` in blocks that hold few labels each: ranges of (label, hash of ``key``), so a label of any size is spread."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = F.xxhash64(key)
    dealt = rows.repartitionByRange(parts, "label", place).sortWithinPartitions("label", place).select(*names, "v", *([] if "label" in names else ["label"]))
    kinds = ", ".join(f"{c} binary" for c in names.values())
    return stored(dealt.mapInArrow(_packed(order, names, size), f"block long, labels array<long>, norm double, {kinds}, v binary, kind string"), name)


def _norms(x: np.ndarray) -> np.ndarray:
    """Of each row, the norm of the dimensions from each one on."""
    return np.sqrt(np.append(np.cumsum((x * x)[:, ::-1], 1)[:, ::-1], np.zeros((len(x), 1)), 1))


def _meet(q: np.ndarray, y: np.ndarray, least: np.ndarray, open_: np.ndarray, how: Mining) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs that ``open_`` allows with a score of at least the anchor's ``least``."""
    dims = q.shape[1]
    q_norm, y_norm = _norms(q), _norms(y)
    slack = 1e-6 * (1 + q_norm[:, :1] * y_norm[None, :, 0])  # bounds are floating numbers, scores are whole ones
    partial = np.zeros(open_.shape)
    for lo in range(0, dims, how.step):
        hi = min(lo + how.step, dims)
        # the posting lists of these dimensions omit rows that can't lift any anchor's pair over its threshold
        listed = np.flatnonzero((y_norm[:, lo, None] * q_norm[None, :, lo] + partial.T >= least[None, :] - slack.T).any(1) & open_.any(0))
        rows = np.flatnonzero(open_.any(1))
        if not len(listed) or not len(rows):
            return (np.empty(0, np.int64),) * 3
        partial[np.ix_(rows, listed)] += q[rows, lo:hi] @ y[listed, lo:hi].T
        left = np.zeros(open_.shape, bool)
        at = np.ix_(rows, listed)
        left[at] = open_[at] & (partial[at] + q_norm[rows, hi][:, None] * y_norm[listed, hi][None, :] >= least[rows, None] - slack[at])
        open_ = left
    a, b = np.nonzero(open_)
    score = np.rint(partial[a, b]).astype(np.int64)  # sums of whole numbers: exact
    keep = score >= least[a]
    return a[keep], b[keep], score[keep]


def _top(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, label: np.ndarray, k: int) -> np.ndarray:
    """The places of each anchor's k best."""
    order = np.lexsort((label, ids, -score, anchor))
    first = np.flatnonzero(np.append(True, anchor[order][1:] != anchor[order][:-1])) if len(order) else np.empty(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k]


def _joined(how: Mining, k: int, same: bool, dims: int):
    """The best k rows of a block for each window of a block of anchors: with the anchor's label, or with
    another; at least ``t`` and at most ``cap``."""
    def run(batches):
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                get = lambda c: np.frombuffer(column[c][i].as_py(), np.int64)  # noqa: E731, B023
                vectors = lambda c, kind: np.frombuffer(column[c][i].as_py(), column[kind][i].as_py()).astype(np.float64).reshape(-1, dims)  # noqa: E731, B023
                window, row, t, cap = get("a_key"), get("a_row"), get("t"), get("cap")
                _, at, of = np.unique(row, return_index=True, return_inverse=True)  # windows of one anchor share its scores
                least = np.full(len(at), np.iinfo(np.int64).max)
                np.minimum.at(least, of, t)
                a_id, a_label, ids, label = get("a_id")[at], get("a_label")[at], get("id"), get("label")
                alike = a_label[:, None] == label[None, :]
                open_ = alike & (a_id[:, None] != ids[None, :]) if same else ~alike
                a, b, score = _meet(vectors("a_v", "a_kind")[at], vectors("v", "kind"), least, open_, how)
                windows = np.argsort(of, kind="stable")
                first = np.searchsorted(of[windows], np.arange(len(at) + 1))
                times = np.diff(first)[a]
                pair = np.repeat(np.arange(len(a)), times)
                w = windows[np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times) + first[a][pair]]
                keep = (score[pair] >= t[w]) & (score[pair] <= cap[w])
                w, b, score = w[keep], b[pair][keep], score[pair][keep]
                best = _top(w, score, ids[b], label[b], k)
                if len(best):
                    w, b, score = w[best], b[best], score[best]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (window[w], ids[b], label[b], score)], names=["a_key", "id", "label", "score"])
    return run


def _search(anchors: DataFrame, blocks: DataFrame, how: Mining, k: int, same: bool, order: list[int], levels: list[str]) -> DataFrame:
    """(a_key, id, label, score, rank) of the best k rows for the windows ``anchors`` (a_key, a_row, a_id, label,
    v, cap, ...); ``levels`` are SQL expressions over them, the thresholds from high to low."""
    names = {"a_key": "a_key", "a_row": "a_row", "a_id": "a_id", "label": "a_label", "t": "t", "cap": "cap"}
    held = blocks.select(F.col("block").alias("to"), F.col("labels").alias("has"), F.col("norm").alias("norm_to"))
    done, left = [], anchors
    for level, threshold in enumerate(levels):
        asked = _blocks(left.withColumn("t", F.expr(threshold).cast("bigint")), order, names, how.anchors, "a_row", "asked")
        asked = asked.withColumnsRenamed({"v": "a_v", "kind": "a_kind", "block": "a_block", "labels": "a_labels", "norm": "a_norm"})
        if same:  # blocks that share a label
            one = asked.select("a_block", F.explode("a_labels").alias("l"))
            route = one.join(held.select("to", F.explode("has").alias("m")), F.col("l") == F.col("m")).select("a_block", "to").distinct()
        else:  # the stated anchors against all rows: numbers of blocks, not rows
            route = asked.select("a_block", "a_labels").crossJoin(held.select("to", "has")).where("size(array_union(a_labels, has)) > 1").select("a_block", "to")
        met = asked.join(stored(route, "route"), "a_block").join(blocks, F.col("to") == F.col("block")).repartition("a_block", "to")
        met = stored(met.mapInArrow(_joined(how, k, same, len(order)), "a_key long, id long, label long, score long"), "met")
        best = Window.partitionBy("a_key").orderBy(F.desc("score"), "id", "label")
        met = stored(met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "best")
        if level == len(levels) - 1:
            done.append(met)
            break
        full = met.where(F.col("rank") == k).select("a_key")
        done.append(met.join(full, "a_key", "left_semi"))
        left = stored(left.join(full, "a_key", "left_anti"), "left")
        if left.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def mine(rows: DataFrame, anchors: DataFrame, how: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (id, label, v);
    ``anchors`` holds the anchors among them."""
    rows = stored(rows.select("id", "label", "v"), "vectors")
    order = _order(rows)
    empty = rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not order:
        return empty
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    norm = rows.agg(F.sqrt(F.max(square))).first()[0]
    keyed = anchors.select(F.monotonically_increasing_id().alias("a_row"), F.col("id").alias("a_id"), "label", "v", F.sqrt(square).alias("a_norm"),
                           F.lit(_MOST).alias("cap"))
    keyed = stored(keyed.withColumn("a_key", F.col("a_row")), "anchors")
    blocks = _blocks(rows, order, {"id": "id", "label": "label"}, how.rows, "id", "blocks")
    positives = _search(keyed, blocks, how, how.positives, True, order, [f"floor({c!r} * a_norm * {norm!r})" for c in how.likeness] + [str(-_MOST)])
    own = keyed.select(F.col("a_key").alias("k"), "a_row", "a_id", F.col("label").alias("a_label"), "v")
    windows = positives.where("score >= 0").select("a_key", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("nth"))
    windows = windows.join(own, F.col("a_key") == F.col("k")).select(
        (F.col("a_key") * how.positives + F.col("nth") - 1).alias("a_key"), "a_row", "a_id", F.col("a_label").alias("label"), "v", "positive_id", "positive_score",
        F.expr(f"positive_score * {how.high} div 100").alias("cap"))
    windows = stored(windows, "windows")
    lowest = f"(positive_score * {how.low} + 99) div 100"
    negatives = _search(windows, blocks, how, how.negatives, False, order, [f"greatest({lowest}, floor(positive_score * {c!r}))" for c in how.levels] + [lowest])
    named = windows.select(F.col("a_key").alias("k"), F.col("a_id").alias("anchor_id"), "positive_id", "positive_score")
    return negatives.join(named, F.col("a_key") == F.col("k")).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine_embeddings(embeddings: DataFrame, every: int = 50, relabel: int = 7, labels: int = 10, how: Mining = Mining()) -> DataFrame:
    """:func:`mine` with the rows whose id ``every`` divides as anchors, after the label of the ids that
    ``relabel`` divides went up by one modulo ``labels``."""
    rows = quantised(embeddings, how)
    rows = stored(rows.withColumn("label", F.when(F.col("id") % relabel == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))), "quantised")
    return mine(rows, rows.where(F.col("id") % every == 0), how)
