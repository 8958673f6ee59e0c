"""Merkle manifest of a dataset: leaves, roots and inclusion proofs.

A row is a leaf: SHA-256 of its columns, each ``-`` if NULL, else byte count,
``:`` and value.  In each group (source) the leaves ascend by their order
column; runs of three nodes become their parent until one is left, the group's
subroot; the subroots, ordered by group (NULL first, bytewise), give the root in
the same way.

Ranks come from one range partitioning of the light leaf rows and the row
counts of its parts, so a group of any size is spread.  Seven levels at a time
are computed in blocks of 3 ** 7 aligned nodes: the node of a level sits on its
first leaf's row, so its siblings are lag and lead columns at the level's fixed
offsets, masked by the node's slot and the length of its run, and first-child
rows hash parents.  The last first-child row at or before a row holds its
ancestor's siblings.  A block's root is one row of the next seven levels; paths
above come back by one join on the block.

Rows: the columns are cast to text, numbers in decimals; NULL order values come
first, ties go by leaf, equal rows have equal proofs up to their place; the
empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmap.llm.common import stored

FAN, LEVELS = 3, 7
BLOCK = FAN**LEVELS


@dataclass(frozen=True)
class Manifest:
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")
    group: str = "source"
    order: str = "doc_id"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(columns: list[Column]) -> Column:
    """The leaf of a row with these columns."""
    own = []
    for c in columns:
        text = c.cast("string")
        own.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*own))


def ranked(rows: DataFrame, group: Column, order: list[Column]) -> DataFrame:
    """``rows`` with ``grp`` and, in each group, ``pos`` (from 0) by ``order`` and the group's row count ``n``.

    Rows of one group and order are told apart by their place in ``rows``, which must be a stored table."""
    keyed = rows.withColumn("grp", group).withColumn("tie", F.pmod(F.monotonically_increasing_id(), F.lit(4096)))
    names = []
    for k, c in enumerate([*order, F.col("tie")]):
        names.append(f"by{k}")
        keyed = keyed.withColumn(f"by{k}", c)
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = keyed.repartitionByRange(parts, "grp", *(F.col(c).asc_nulls_first() for c in names))
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "ranked")
    sums = dealt.groupBy("part", "grp").agg(F.count("*").alias("k"))  # about one row a part, and one a group
    line = Window.partitionBy("grp").orderBy("part")
    sums = stored(sums.select(F.col("part").alias("p"), F.col("grp").alias("g"), (F.sum("k").over(line) - F.col("k")).alias("base"),
                              F.sum("k").over(Window.partitionBy("grp")).alias("n")), "counts")
    inside = F.row_number().over(Window.partitionBy("part", "grp").orderBy(*(F.col(c).asc_nulls_first() for c in names))) - 1
    own = dealt.withColumn("inside", inside.cast("bigint")).join(sums, (F.col("part") == F.col("p")) & (F.col("grp") == F.col("g")))
    return own.withColumn("pos", F.col("base") + F.col("inside")).drop("part", "p", "g", "base", "inside", "tie", *names)


def _climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (grp, pos, n, node): the rows with ``block`` and ``path``, the siblings on the way to the block's
    root, as (left, right) digests by level; and the block roots as rows (grp, pos, n, node)."""
    rows = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
    line = Window.partitionBy("grp", "block").orderBy("pos")
    up = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("d0", F.col("node"))
    path = []
    for k in range(LEVELS):
        step, own = FAN**k, f"d{k}"
        count = f"((n + {step - 1}) div {step})"  # nodes of the level
        at = f"(pos div {step})"
        slot, run = f"({at} % {FAN})", f"least({FAN}, {count} - {at} div {FAN} * {FAN})"
        beside = {f"l{j}": F.lag(own, j * step).over(line) for j in range(1, FAN)} | {f"r{j}": F.lead(own, j * step).over(line) for j in range(1, FAN)}
        rows = rows.withColumns(beside)
        left = ", ".join(f"if({slot} >= {j}, l{j}, '')" for j in range(FAN - 1, 0, -1))
        right = ", ".join(f"if({slot} + {j} < {run}, r{j}, '')" for j in range(1, FAN))
        here = f"pos % {step} = 0"  # the row holds a node of this level
        rows = rows.withColumns({
            f"s{k}": F.expr(f"CASE WHEN {here} AND {count} > 1 THEN struct(concat({left}) AS l, concat({right}) AS r) END"),
            f"d{k + 1}": F.expr(f"CASE WHEN {here} AND {slot} = 0 THEN if({count} > 1, sha2(cast(concat({own}, {right}) AS binary), 256), {own}) END"),
        }).drop(*beside)
        path.append(F.last(f"s{k}", ignorenulls=True).over(up).alias(f"s{k}"))
    kept = [F.col(c) for c in nodes.columns]
    roots = rows.where(f"pos % {BLOCK} = 0").select("grp", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col(f"d{LEVELS}").alias("node"))
    found = rows.select(*kept, "block", *path)
    steps = F.filter(F.array(*(f"s{k}" for k in range(LEVELS))), lambda s: s.isNotNull())
    return found.select(*kept, "block", steps.alias("path")), roots


_NO_PATH = "CAST(array() AS array<struct<l: string, r: string>>)"


def _paths(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From stored (grp, pos, n, node, ...): its rows with ``block`` and the ``path`` to the block's root; and
    (grp, block, above, root), the path from there to the group's root."""
    found, roots = _climb(nodes)
    roots = stored(roots, "blocks")
    if not nodes.where(F.col("n") > BLOCK).limit(1).count():
        return found, roots.select("grp", F.col("pos").alias("block"), F.expr(_NO_PATH).alias("above"), F.col("node").alias("root"))
    more, top = _paths(roots)
    joined = more.withColumnRenamed("block", "own").join(top.withColumnsRenamed({"grp": "g", "block": "b"}), (F.col("grp") == F.col("g")) & (F.col("own") == F.col("b")))
    return found, stored(joined.select("grp", F.col("pos").alias("block"), F.concat("path", "above").alias("above"), "root"), "above")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, s: digest(F.concat(s["l"], node, s["r"])))


def manifest(rows: DataFrame, how: Manifest = Manifest(), keep: tuple[str, ...] = (), also: dict[str, Column] | None = None) -> DataFrame:
    """Per row of ``rows``: the columns ``keep`` and ``also`` (expressions over the row), leaf, subroot, root
    and ``path``, the (left, right) siblings of each level from the leaf to the root."""
    also = also or {}
    own = [f"keep_{c}" for c in (*keep, *also)]
    light = rows.select(*(F.col(c).alias(f"keep_{c}") for c in keep), *(e.alias(f"keep_{c}") for c, e in also.items()),
                        F.coalesce(F.concat(F.lit("+"), F.col(how.group).cast("string")), F.lit("")).alias("named"),  # NULL first, bytewise
                        F.col(how.order).alias("place"), leaf([F.col(c) for c in how.columns]).alias("node"))
    leaves = ranked(stored(light, "leaves"), F.col("named"), [F.col("place"), F.col("node")])
    found, above = _paths(stored(leaves.select(*own, "grp", "pos", "n", "node"), "nodes"))

    subroots = stored(above.where("block = 0").select(F.col("grp").alias("name"), F.col("root").alias("node")), "subroots")
    placed = ranked(subroots, F.lit(""), [F.col("name")])
    named, top = _paths(stored(placed.select("name", "grp", "pos", "n", "node"), "nodes"))
    top = named.join(top.withColumnsRenamed({"grp": "g", "block": "b"}), (F.col("grp") == F.col("g")) & (F.col("block") == F.col("b")))
    top = stored(top.select("name", F.concat("path", "above").alias("over"), F.col("root").alias("top")), "tops")
    above = above.join(top, F.col("grp") == F.col("name"))  # one row a block
    above = stored(above.select(F.col("grp").alias("g"), F.col("block").alias("b"), F.concat("above", "over").alias("above"), "root", "top"), "above")
    found = found.join(above, (F.col("grp") == F.col("g")) & (F.col("block") == F.col("b")))
    return found.select(*(F.col(f"keep_{c}").alias(c) for c in (*keep, *also)), F.col("node").alias("leaf"), F.col("root").alias("subroot"), F.col("top").alias("root"), F.concat("path", "above").alias("path"))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""))


def verified_documents(docs: DataFrame) -> DataFrame:
    """Every document with its leaf, roots, proof digest and the root folded from its text without line feeds,
    where 2 divides crc32(doc_id), else from its leaf."""
    how = Manifest()
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("source", "lang")), F.col("n_chars").cast("bigint").alias("n_chars"), F.col("text").cast("string").alias("text"))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(docs, how, ("doc_id",), {"now": leaf([*(F.col(c) for c in how.columns[:-1]), text])})
    found = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded(F.col("now"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
