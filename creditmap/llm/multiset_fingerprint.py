"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph is a line with a non-blank character.  Its wide vector has

* two counters: 1, and its number of word pairs;
* ``EXACT`` entries: 40-bit hashes of the whole paragraph;
* 120 small entries: for each pair of neighbouring words (the last word pairs
  with nothing), one bit of two 60-bit hashes, counted.

A document's fingerprint is the sum of its paragraphs' vectors, entries modulo
powers of two (two 30-bit entries share one 60-bit number: more than any text
has pairs).  It does not
depend on the order of paragraphs, equal multisets have equal fingerprints, and
a paragraph is inserted or deleted by adding or subtracting its vector
(``combine``).  The counted bits are a random projection of the word-pair
counts, so the cosine of two documents is read from two fingerprints
(``likeness``, 0 to 1; standard error about 0.09).

Only DataFrame functions are used.  A document's text is shuffled once, to a
block of neighbouring ids; the next document is found inside the block, or is
the first of the next block that has rows.  Blocks are put in order by a range
partitioning, of which only the edges meet in one task.  A block of very many
rows (NULL or repeated ids) is split by id and by the first bytes of the texts.
NULL text is empty and has the zero fingerprint; two empty texts have likeness 1,
an empty and another 0.  Rows with one doc_id follow one another by text; NULL
ids come first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmap.llm.common import stored

EXACT = 3
_HEAD = 2 + EXACT
_LANES = 30
_MASK = 1 | 1 << 30
#: Moduli of the entries as powers of two: counters, exact entries, packed small entries.
_BITS = [40] * _HEAD + [60] * (2 * _LANES)
_SHIFT = 10  # ids of a block: 2 ** 10
LARGE = 1 << 14  # rows from which a block is split


def _word_pairs(paragraph: Column) -> Column:
    words = F.filter(F.split(paragraph, r"\s+"), lambda w: w != "")
    return F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda w, after: F.xxhash64(w, after))


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``f``: array<long>, for each row (keys, text) with a
    paragraph; the keys identify a row.  Partial sums meet by the keys."""
    exact = [F.xxhash64(F.lit(k), F.col("p")).bitwiseAND(F.lit((1 << 40) - 1)).alias(f"x{k}") for k in range(EXACT)]
    paragraphs = (texts.select(*keys, F.explode(F.split("text", "\n")).alias("p")).where(F.col("p").rlike(r"\S"))
                  .select(*keys, *exact, _word_pairs(F.col("p")).alias("pairs"))  # what a pair carries does not grow with its paragraph
                  .select(*keys, *(f"x{k}" for k in range(EXACT)), F.posexplode("pairs").alias("place", "h")))
    first = F.col("place") == 0
    hashed = paragraphs.select(*keys, F.when(first, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("c0"),
                               *(F.when(first, F.col(f"x{k}")).otherwise(F.lit(0).cast("bigint")).alias(f"c{1 + k}") for k in range(EXACT)),
                               F.lit(1).cast("bigint").alias(f"c{1 + EXACT}"), "h", F.xxhash64("h").alias("g"))
    bits = [F.sum(F.shiftright(h, i).bitwiseAND(F.lit(_MASK))) for h in ("h", "g") for i in range(_LANES)]
    sums = [F.sum(f"c{k}") for k in (0, 1 + EXACT, *range(1, 1 + EXACT))] + bits
    found = hashed.groupBy(*keys).agg(*(s.alias(f"s{k}") for k, s in enumerate(sums)))
    return found.select(*keys, F.array(*(F.col(f"s{k}").bitwiseAND(F.lit((1 << _BITS[k]) - 1)) for k in range(len(sums)))).alias("f"))


def zero() -> Column:
    return F.array_repeat(F.lit(0).cast("bigint"), len(_BITS))


def combine(x: Column, y: Column, sign: int = 1) -> Column:
    """The fingerprint of the union (or, with sign -1, of x without y)."""
    moduli = F.array(*(F.lit(1 << b).cast("bigint") for b in _BITS))
    return F.zip_with(F.zip_with(x, y, lambda a, b: a + sign * b), moduli, lambda s, m: F.pmod(s, m))


def as_text(f: Column) -> Column:
    return F.lower(F.array_join(F.transform(f, lambda x, i: F.lpad(F.hex(x), 15, "0")), ""))


def _projection(f: Column) -> Column:
    """The signed entries: twice the count of set bits less the pairs counted."""
    def field(x: Column, k: int) -> Column:
        return (2 * F.shiftright(x, 30 * k).bitwiseAND(F.lit((1 << 30) - 1)) - F.element_at(f, 2)).cast("double")

    return F.flatten(F.transform(F.slice(f, 1 + _HEAD, 2 * _LANES), lambda x: F.array(*(field(x, k) for k in range(2)))))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def likeness(fx: Column, fy: Column) -> Column:
    """0 to 1 from two fingerprints."""
    x, y = _projection(fx), _projection(fy)
    cosine = _dot(x, y) / F.sqrt(F.greatest(_dot(x, x) * _dot(y, y), F.lit(1e-9)))
    return (F.when(fx == fy, F.lit(1.0)).when((F.element_at(fx, 1) == 0) | (F.element_at(fy, 1) == 0), F.lit(0.0))
            .otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0))))


#: A block of rows: ids by their upper bits and, in large blocks only, a part of it.
BLOCK = ["block", "inner"]


def _following(blocks: DataFrame) -> DataFrame:
    """(BLOCK, next_block, next_inner) in ascending order, the last followed by the first: found
    within ranges of blocks; one task sees the first block of each range, no more."""
    parts = max(1, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = stored(blocks.repartitionByRange(parts, *BLOCK).withColumn("part", F.spark_partition_id()), "blocks")
    over = Window.orderBy("part")
    pair = F.struct(*BLOCK)
    edges = ranged.groupBy("part").agg(F.min(pair).alias("first"))  # at most ``parts`` rows
    edges = edges.select("part", F.coalesce(F.lead("first").over(over), F.min("first").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    within = Window.partitionBy("part").orderBy(*BLOCK)
    found = ranged.withColumn("lead", F.lead(pair).over(within)).join(F.broadcast(edges), "part").select(*BLOCK, F.coalesce("lead", "after").alias("n"))
    return found.select(*BLOCK, F.col("n.block").alias("next_block"), F.col("n.inner").alias("next_inner"))


def with_next(docs: DataFrame) -> DataFrame:
    """(BLOCK, at, doc_id, text, next, last): the rows by ascending doc_id in
    blocks, with the next row's text; ``last``: it is in another block."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    wide = F.coalesce(F.shiftright("doc_id", _SHIFT), F.lit(-(1 << 54)))
    large = stored(rows.select(wide.alias("wide")).groupBy("wide").count().where(F.col("count") > LARGE).select(F.col("wide").alias("large")), "large")
    rows = rows.withColumn("wide", wide).join(large, F.col("wide") == F.col("large"), "left")  # rows / LARGE at most, none as a rule
    start = F.conv(F.hex(F.substring(F.concat(F.col("text").cast("binary"), F.lit(b"\0\0\0")), 1, 3)), 16, 10).cast("bigint")
    place = F.coalesce(F.col("doc_id").bitwiseAND(F.lit((1 << _SHIFT) - 1)), F.lit(0).cast("bigint"))
    inner = F.when(F.col("large").isNotNull(), F.shiftleft(place, 24) + start).otherwise(F.lit(-1).cast("bigint"))
    rows = rows.select(F.col("wide").alias("block"), inner.alias("inner"), "doc_id", "text")
    order = Window.partitionBy(*BLOCK).orderBy("doc_id", "text")
    rows = rows.withColumn("at", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))
    firsts = rows.where("at = 1").select(F.col("block").alias("next_block"), F.col("inner").alias("next_inner"), F.col("text").alias("beyond"))
    beyond = _following(rows.select(*BLOCK).distinct()).join(firsts, ["next_block", "next_inner"]).select(*BLOCK, "beyond")
    return (rows.join(beyond, BLOCK)
            .select(*BLOCK, "at", "doc_id", "text", F.coalesce("next", "beyond").alias("next"), F.col("next").isNull().alias("last")))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next): each text, and the text whose last half is
    replaced by as much of the next document's beginning."""
    n = F.length("text")
    rows = with_next(docs).withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - length(text) div 2)"), F.expr("substring(next, 1, cast(length(text) div 2 as int))")))
    variants = rows.select(*BLOCK, "at", F.explode(F.filter(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")),
        F.struct(F.when(F.col("last"), F.lit(2)).alias("kind"), F.when(F.col("last"), F.col("next")).alias("text"))), lambda v: v["kind"].isNotNull())).alias("v"))
    found = fingerprints(variants.select(*BLOCK, "at", F.col("v.kind").alias("kind"), F.col("v.text").alias("text")), [*BLOCK, "at", "kind"])
    by_kind = found.groupBy(*BLOCK, "at").agg(*(F.max(F.when(F.col("kind") == k, F.col("f"))).alias(f"f{k}") for k in range(3)))
    facts = rows.select(*BLOCK, "at", "doc_id", n.cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "last")
    order = Window.partitionBy(*BLOCK).orderBy("at")
    every = (facts.join(by_kind, [*BLOCK, "at"], "left")
             .withColumns({f"f{k}": F.coalesce(f"f{k}", zero()) for k in range(3)})
             .withColumn("fn", F.when(F.col("last"), F.col("f2")).otherwise(F.lead("f0").over(order))))
    return every.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("f0")).alias("fingerprint"), as_text(F.col("f1")).alias("edited_fingerprint"),
        likeness(F.col("f0"), F.col("f1")).alias("near_edited"), likeness(F.col("f0"), F.col("fn")).alias("near_next"))
