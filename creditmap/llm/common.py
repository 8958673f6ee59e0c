"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmap.session import freed_shuffles

#: Bytes of text that one vectorised step works on.
BLOCK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir of the session.

    Where neither the setting nor a checkpoint folder exists, a local session
    (tests) gets a temporary folder; on a cluster no folder of one machine would
    do, and this raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.getCheckpointDir():
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="creditmap-llm-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/creditmap-llm"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends in
    files that survive the loss of an executor, so its shuffle files go."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove the files of :func:`stored` tables that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; NULL ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def text_blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of runs of rows of about
    ``limit`` bytes.  NULL text is empty; a longer text is a run of its own."""
    texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
    buffers = texts.buffers()
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and len(buffers[2]) else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective avalanche of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse mod 2 ** 64 for i < n."""
    if len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + BLOCK_BYTES // 2)
        if size > 16 * BLOCK_BYTES:  # a very long text: not kept
            return _geometric(_BASE, size), _geometric(pow(_BASE, -1, 2**64), size)
        _POWERS[:] = [_geometric(_BASE, size), _geometric(pow(_BASE, -1, 2**64), size)]
    return _POWERS[0], _POWERS[1]


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``, equal for equal bytes."""
    powers, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[: len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row) of the words between ASCII blanks;
    a word never crosses a row."""
    inside = ~_SPACE[data]
    before = np.empty(len(data) + 1, bool)  # position i continues a word of i - 1
    before[0] = False
    before[1:] = inside
    before[offsets] = False
    edge = np.append(inside, False)
    starts = np.flatnonzero(edge & ~before)
    stop = np.append(~inside, True)
    stop[offsets] = True
    previous = np.zeros(len(data) + 1, bool)
    previous[1:] = inside
    ends = np.flatnonzero(stop & previous)
    return starts, ends, np.searchsorted(starts, offsets)
