import random
from hashlib import sha256

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from creditmap.llm import chat_format as chat
from creditmap.llm import length_histogram as lengths
from creditmap.llm import multi_index_search as search
from creditmap.llm import multiset_fingerprint as prints
from creditmap.llm import queries
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"
PARTS = "conv_id long, turn long, role string, parts array<struct<type:string,text:string,ref:string,tokens:int>>, said string, at int"


def test_visitor_placeholders_and_reading_back(spark):
    part = lambda kind, text=None, ref=None, tokens=None: (kind, text, ref, tokens)
    rows = [
        (1, 0, "user", [part("text", "see <|image:0|> "), part("image", ref="a.png", tokens=3), part("text", "and"), part("audio", ref="b.wav")], "x", 1),
        (1, 1, "assistant", [part("text", "<\\ ok <|end|>\n<|start|>user<|sep|>")], "x", 1),
        (1, 2, "user", [part("document", ref="c.pdf", tokens=2), part(None, "odd")], "x", 1),
        (1, 3, "assistant", [part("text", "")], "x", 1),
        (2, None, None, None, "x", 1), (2, 0, "assistant", [part("text", None)], "x", 1),
        (None, 1, "assistant", [part("text", "lost 🙂")], "x", 1),
    ]
    found = chat.read_chats(chat.format_chats(spark.createDataFrame(rows, PARTS))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in found.collect()}
    assert len(got) == 3
    one = got[1]
    assert one.formatted == ("<|start|>user<|sep|>see <\\|image:0|> <|image:0|><|image:0|><|image:0|>and<|audio:1|><|end|>\n"
                             "<|start|>assistant<|sep|><\\\\ ok <\\|end|>\n<\\|start|>user<\\|sep|><|end|>\n"
                             "<|start|>user<|sep|><|document:2|><|document:2|><|:3|><|end|>\n<|start|>assistant<|sep|><|end|>\n")
    assert [(a.k, a.type, a.ref, a.tokens) for a in one.attachments] == [(0, "image", "a.png", 3), (1, "audio", "b.wav", 1), (2, "document", "c.pdf", 2), (3, None, None, 1)]
    assert one.attachment_tokens == 7
    assert [t.role for t in one.turns] == ["user", "assistant", "user", "assistant"]
    assert one.turns[1].text == "<\\ ok <|end|>\n<|start|>user<|sep|>" and one.loss == one.turns[1].text
    assert [one.formatted[s.start : s.start + s.length] for s in one.loss_spans] == ["<\\\\ ok <\\|end|>\n<\\|start|>user<\\|sep|>", ""]
    assert [(t.role, t.text) for t in got[2].turns] == [("", ""), ("assistant", "")] and got[None].loss == "lost 🙂"
    assert chat.format_chats(spark.createDataFrame([], PARTS)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    expected = sorted(map(str, found.fetchall()))
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(str(tuple(r[c] for c in columns)) for r in df.collect()) == expected


@pytest.mark.parametrize("rows", [[], [
    (1, 0, "user", "</s>[INST] <|end|> <\\ " * 60_000), (1, 1, "assistant", "é🙂<" * 100_000), (2, 0, "user", "twice"), (2, 0, "user", "twice"),
    (2, 1, "assistant", "ok"), (2, 1, "assistant", "ok"), (2, 2, None, None), (None, 3, "assistant", ""), (3, 0, "assistant", None)]])
def test_chat_query_on_long_repeated_and_no_rows(spark, rows, tmp_path):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    name = "op5_chat_format"
    found = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    expected = sorted(map(str, found.fetchall()))
    assert sorted(str(tuple(r[c] for c in columns)) for r in queries.QUERIES[name](spark, str(tmp_path)).collect()) == expected


def test_histogram_against_brute_force(spark, documents):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = lengths._encoding(path, public_tokenizers.PATTERN)
    assert isinstance(encoding, tiktoken.Encoding)
    rows = ODD + [(100 + i, "word " * (i % 7) + "<|endoftext|>", "en") for i in range(40)]
    own = [len(encoding.encode_ordinary(t or "")) for _, t, _ in rows]
    found = lengths.histogram(lengths.encoded_lengths(documents(rows), path, public_tokenizers.PATTERN), span=4).cache()
    got = {r.length: r for r in found.collect()}
    assert sorted(got) == sorted(set(own))
    for n, r in got.items():
        assert (r.docs, r.docs_to, r.docs_over) == (own.count(n), sum(x <= n for x in own), sum(x > n for x in own))
        assert (r.tokens_to, r.tokens_over, r.tokens_cut) == (sum(x for x in own if x <= n), sum(x for x in own if x > n), sum(min(x, n) for x in own))
        assert r.share_to == pytest.approx(sum(x <= n for x in own) / len(own))
    limits = [0, 1, 3, 5, 100, 10**6]
    cut = {r.limit: r.tokens_cut for r in lengths.at_limits(found, spark.createDataFrame([(x,) for x in limits], "limit long")).collect()}
    assert cut == {x: sum(min(y, x) for y in own) for x in limits}
    assert lengths.quantile(found, 0.5).first()["length"] == sorted(own)[-(-len(own) // 2) - 1]
    assert lengths.histogram(lengths.encoded_lengths(documents([]), path, public_tokenizers.PATTERN)).count() == 0


def fingerprint(spark, *texts):
    found = prints.fingerprints(spark.createDataFrame(list(enumerate(texts)), "k int, text string"), ["k"]).collect()
    own = {r.k: tuple(r.f) for r in found}
    return [own.get(k, (0,) * len(prints._BITS)) for k in range(len(texts))]


def test_sums_are_homomorphic_and_unordered(spark):
    a, b, c, both, twice, blank = fingerprint(spark, "one two\nthree four five", "three four five\n\n  \none two", "six seven", "six seven\none two\nthree four five", "six seven\nsix seven", " \n")
    assert a == b and len({a, c, both, twice}) == 4 and set(blank) == {0}
    rows = spark.createDataFrame([(list(a), list(c), list(both), list(twice))], "a array<long>, c array<long>, both array<long>, twice array<long>")
    r = rows.select(prints.combine(F.col("a"), F.col("c")), prints.combine(F.col("both"), F.col("c"), -1), prints.combine(F.col("c"), F.col("c")), prints.combine(F.col("c"), F.col("both"), -1).alias("under")).first()
    assert tuple(r[0]) == both and tuple(r[1]) == a and tuple(r[2]) == twice
    assert tuple(rows.select(prints.combine(F.array(*map(F.lit, r["under"])), F.col("a"))).first()[0]) == (0,) * len(a)


def test_edited_texts_follow_the_next_document(spark, documents):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = [(i, "\n".join(" ".join(word() for _ in range(12)) for _ in range(9)), "en") for i in (-5000, -3, 0, 1, 2, 1023, 1024, 5000, 3_000_000)]
    rows += [(7, rows[0][1], "en"), (8, rows[0][1], "en"), (9, None, "en"), (10, "", None), (11, "é🙂x", "en")]
    got = {r.doc_id: r for r in prints.edited_fingerprints(documents(rows)).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for k, (i, text, _) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == sha256(edited.encode()).hexdigest(), i
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[7].fingerprint == got[8].fingerprint == got[-5000].fingerprint and got[7].near_next == 1
    plain = [got[i] for i in (-5000, -3, 0, 1, 1023, 1024, 5000)]
    assert np.mean([r.near_edited for r in plain]) > 0.35 and np.mean([r.near_next for r in plain]) < 0.2
    assert got[9].near_edited == got[9].near_next == 1 and got[10].near_next == 0
    assert got[3_000_000].near_edited > got[3_000_000].near_next
    assert prints.edited_fingerprints(documents([])).count() == 0
    assert prints.edited_fingerprints(documents(ODD)).count() == len(ODD)


def test_hashed_ids_and_split_blocks(spark, documents, monkeypatch):
    """Ids far apart, and blocks of very many rows (NULL and repeated ids) that are split."""
    monkeypatch.setattr(prints, "LARGE", 2)
    rng = random.Random(5)
    some = lambda: "".join(rng.choice("abé 🙂\n") for _ in range(rng.randint(0, 12)))
    rows = [(rng.randrange(-(2**62), 2**62), some(), "en") for _ in range(60)] + [(None, some(), "en") for _ in range(40)]
    rows += [(i, some(), "en") for i in (5, 6, 6, 6, 7, 1030) for _ in range(6)]
    got = sorted((r.n_chars, r.edited_sha256, str(r.doc_id)) for r in prints.edited_fingerprints(documents(rows).repartition(4)).collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expected = []
    for k, (i, text, _) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        expected.append((len(text), sha256((text[: len(text) - len(text) // 2] + after[: len(text) // 2]).encode()).hexdigest(), str(i)))
    assert got == sorted(expected)


def likenesses(spark, pairs):
    found = fingerprint(spark, *(t for pair in pairs for t in pair))
    rows = spark.createDataFrame([(k, list(found[2 * k]), list(found[2 * k + 1])) for k in range(len(pairs))], "k int, x array<long>, y array<long>")
    return [r[0] for r in rows.orderBy("k").select(prints.likeness(F.col("x"), F.col("y"))).collect()]


def test_likeness_is_near_the_cosine_of_word_pairs(spark):
    from collections import Counter

    rng = random.Random(2)
    word = lambda: rng.choice("abcdefghijklmnopqrst") + rng.choice("abcde")
    pairs = []
    for share in (0.0, 0.2, 0.4, 0.6, 0.8, 0.95) * 5:
        x = [[word() for _ in range(8)] for _ in range(40)]
        y = [line if rng.random() < share else [word() for _ in range(8)] for line in x]
        pairs.append(tuple("\n".join(map(" ".join, z)) for z in (x, y)))

    def cosine(x, y):
        a, b = (Counter(p for line in t.split("\n") for w in [line.split()] for p in zip(w, [*w[1:], None])) for t in (x, y))
        return sum(n * b[p] for p, n in a.items()) / (sum(n * n for n in a.values()) * sum(n * n for n in b.values())) ** 0.5

    errors = [got - cosine(x, y) for got, (x, y) in zip(likenesses(spark, pairs), pairs)]
    assert max(map(abs, errors)) < 0.35 and np.mean(np.abs(errors)) < 0.1


def test_counters_of_very_long_texts_do_not_wrap(spark):
    few, many = "a b\n" * 1000, "a b\n" * ((1 << 21) + 3)
    assert likenesses(spark, [(few, many)])[0] > 0.999
    assert abs(likenesses(spark, [(few + "c d\n" * 1000, many)])[0] - 0.7) < 0.25  # cosine 1 / sqrt(2)


def test_one_line_of_a_million_words(spark):
    """What a pair carries does not grow with its paragraph."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(50_000)}" for _ in range(1_000_000)]
    x, y = " ".join(words), " ".join(words[:-1])
    assert likenesses(spark, [(x, y)])[0] > 0.99


VECTORS = "vec_id long, embedding array<float>, label int, code string, query long"


def nearest(rows, how):
    code = {(i, tuple(v is not None and v > 0 for v in x)) for i, x in rows if i is not None and x is not None}
    width = max((len(c) for _, c in code), default=0)
    code = {(i, c + (False,) * (width - len(c))) for i, c in code}
    out = []
    for i, c in code:
        if i % how.every == 0:
            near = sorted({(sum(a != b for a, b in zip(c, d)), j) for j, d in code if j != i})[: how.k]
            out += [(i, rank + 1, j, d) for rank, (d, j) in enumerate(near)]
    return sorted(out)


def test_search_is_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(v) for v in rng.normal(size=40)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]  # a hot code, ties
    rows += [(50, None), (None, rows[1][1]), (60, [1.0, None]), (70, []), rows[3]]
    rows = [r for r in rows if r[0] not in (50, 60, 70) or r[1] is None or len(r[1]) < 40]
    df = spark.createDataFrame([(i, x, 1, "c", 2) for i, x in rows], VECTORS)
    for how in (search.Search(k=5, every=20, bits=8, chunk=7),):
        assert sorted(map(tuple, search.top_k(df, how).collect())) == nearest(rows, how)
    few = spark.createDataFrame([(0, [1.0, -1.0], 1, "c", 2), (1, [1.0, 1.0], 1, "c", 2)], VECTORS)
    assert [tuple(r) for r in search.top_k(few).collect()] == [(0, 1, 1, 1)]
    assert search.top_k(spark.createDataFrame([], VECTORS)).count() == 0
