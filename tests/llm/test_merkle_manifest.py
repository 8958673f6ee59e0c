import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from creditmap.llm import merkle_manifest
from tests.llm.conftest import ODD

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, pos long, grp string, node int, l0 string, keep_doc_id int"


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    own = [row[0], row[3], row[2], row[4], text]
    return hashed(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in own))


def tree(nodes):
    """(root, the siblings left and right of each node by level)"""
    paths, held = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, kept = [], []
        for lo in range(0, len(nodes), 3):
            run = nodes[lo : lo + 3]
            for j in range(len(run)):
                for i in held[lo + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(hashed(*run))
            kept.append([i for own in held[lo : lo + 3] for i in own])
        nodes, held = up, kept
    return nodes[0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = own, *tree([leaf(r, r[1]) for r in own])
    root, above = tree([trees[s][1] for s in order])
    out = []
    for s, over in zip(order, above):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths):
            path = path + over
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            node = leaf(r, r[1].replace("\n", "") if tampered else r[1])
            for a, b in path:
                node = hashed(a, node, b)
            out.append((str(r[0]), leaf(r, r[1]), subroot, root, hashed(*(a + b for a, b in path)), node, node == root))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


def build(spark, rows):
    return spark.createDataFrame([(*r, 1, "g", 2, "l", 3) for r in rows], COLUMNS).repartition(3)


ROWS = ([(i, f"line {i}\nmore é\n" if i % 2 else f"line {i}", "en" if i % 5 else None, "hot", i) for i in range(40)]
        + [(100 + i, "x\ny", None, f"s{i}", None) for i in range(5)] + [(None, None, None, None, None), (7, "", "en", "", 0), (7, "", "en", "", 0), (8, "é" * 100_000, "de", "Ä", 1)]
        + [(i, t, lang, "odd", None) for i, t, lang in ODD])


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_equals_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    monkeypatch.setattr(merkle_manifest, "BLOCK", 3**levels)
    assert got(merkle_manifest.verified_documents(build(spark, ROWS))) == expected(ROWS)


def test_single_leaf_and_empty_table(spark):
    one = [(3, "a\nb", "en", "s", 3)]
    assert got(merkle_manifest.verified_documents(build(spark, one))) == expected(one)
    assert merkle_manifest.verified_documents(build(spark, one).where("false")).count() == 0


def test_manifest_of_other_columns(spark):
    rows = spark.range(50).select(F.col("id").alias("key"), (F.col("id") % 2).alias("part"), F.lit(None).cast("string").alias("note"))
    how = merkle_manifest.Manifest(("key", "note"), "part", "key")
    found = merkle_manifest.manifest(rows, how, ("key",))
    assert found.where(merkle_manifest.folded(F.col("leaf"), F.col("path")) == F.col("root")).count() == 50
    assert found.select("root").distinct().count() == 1 and found.select("subroot").distinct().count() == 2
