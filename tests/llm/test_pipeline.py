import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from creditmap.llm import factorization_quality, language_mixture
from creditmap.llm.common import stored, table
from creditmap.llm.jaccard_join import Similarity
from tests.llm.conftest import ODD
from tests.llm.test_bpe_and_packing import LIBRARY, checked
from tests.llm.test_jaccard_join import brute_force

SF = "/root/testdata/sf0.001"


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_and_run_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    kept = [docs]
    for name, stage in pipeline.STAGES[:-1]:
        kept.append(stored(stage(spark, kept[-1], SF), name))
        assert kept[-1].columns == docs.columns and ids(kept[-1]) <= ids(kept[-2])
    score = {r.doc_id: r.score for r in factorization_quality.score(docs, table(spark, SF, "labels")).collect()}
    assert ids(kept[1]) == {i for i, s in score.items() if s >= pipeline.LEAST_QUALITY} and 0 < len(ids(kept[1])) < docs.count()
    found = {r.doc_id: r for r in language_mixture.identify(kept[1]).collect()}
    assert ids(kept[2]) == {i for i, r in found.items() if r.lang_pred != "und" and r.score >= pipeline.LEAST_LANGUAGE}
    groups = brute_force([(r.doc_id, r.text) for r in kept[2].collect()], Similarity(5, 4, 5))
    assert ids(kept[3]) == {c for _, _, c in groups}
    packed = pipeline.STAGES[-1][1](spark, kept[3], SF).collect()
    own = {}
    for r in packed:
        own[r.doc_id] = own.get(r.doc_id, 0) + r.length
    assert own == {r.doc_id: len(LIBRARY.encode(r.text, add_special_tokens=False).ids) + 1 for r in kept[3].collect()}
    assert checked(packed, 4096) <= 1.1 * sum(own.values()) / 4096 + 1
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    again = pipeline.run(spark, SF).collect()
    assert key(again) == key(packed)
    checked(again, 4096)


def test_labels_of_the_tables_are_kept_clean(spark):
    """Of the texts that are labelled good, the first stage loses hardly any."""
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    good = {r.doc_id: r.quality for r in labels.collect()}
    left = ids(pipeline.quality(spark, docs, "/root/testdata/sf0.01"))
    assert np.mean([i in left for i, q in good.items() if q]) > 0.97
    assert np.mean([i in left for i, q in good.items() if not q]) < 0.2


def test_odd_rows_and_empty_tables(spark, documents):
    for rows in (ODD, []):
        docs = documents(rows)
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert ids(out) <= {r[0] for r in rows}, name
        packed = pipeline.packing(spark, docs, SF).collect()
        lengths = sorted(len(LIBRARY.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
        assert sum(r.length for r in packed) == sum(lengths) and sum(r.piece == 0 for r in packed) == len(rows)


def test_only_rows_that_link_go(spark, documents):
    """Rows without doc_id, and different texts of one doc_id, are documents of their own."""
    left = pipeline.near_copies(spark, documents(ODD), SF).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in left))) == sorted(map(str, {(i, t) for i, t, _ in ODD}))
    same = "one text that several rows share word for word"
    rows = [(None, same, "en"), (9, same, "en"), (9, same, "en"), (4, same + " or nearly", "de"), (7, "", "en"), (7, "", "en"), (None, "  ", "en"), (3, "short", "en"), (None, "short", "en")]
    left = pipeline.near_copies(spark, documents(rows), SF).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in left))) == sorted(map(str, [(9, same), (4, same + " or nearly"), (7, ""), (7, ""), (None, "  "), (3, "short")]))


def test_decisions_need_no_doc_id(spark):
    """With every doc_id NULL the first two stages keep the rows that they keep by the scores."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    score = {r.doc_id: r.score for r in factorization_quality.score(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    bare = docs.withColumn("doc_id", F.lit(None).cast("bigint")).unionByName(docs)
    left = sorted(str(r.text) for r in pipeline.quality(spark, bare, SF).where("doc_id IS NULL").collect())
    assert left == sorted(str(texts[i]) for i, s in score.items() if s >= pipeline.LEAST_QUALITY)
