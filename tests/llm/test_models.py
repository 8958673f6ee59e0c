import random
import zlib

import numpy as np
import pytest

from creditmap.llm import factorization_quality as quality
from creditmap.llm import kneser_ney_toxicity as toxicity
from creditmap.llm import language_mixture as language
from creditmap.llm.common import table
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"


def remainder(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


def made(n=900, seed=4):
    """Texts of three made languages; bad ones have symbols, toxic ones words of one stem."""
    rng = random.Random(seed)
    syllables = {"aa": ["ba", "lo", "mi", "te"], "bb": ["schu", "gra", "ken", "ost"], "cc": ["ção", "êt", "un", "vel"]}
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice([*syllables])
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 120))]
        toxic, good = rng.random() < 0.25, rng.random() < 0.7
        if toxic:
            words[rng.randrange(len(words))] = "zorq" + rng.choice(syllables[lang]) + rng.choice(syllables[lang])
        if not good:
            words = [w + "&%$" if rng.random() < 0.5 else w for w in words]
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def corpus(spark, documents):
    rows, labels = made()
    return documents(rows + [(20_000 + (i or 0), t, lang) for i, t, lang in ODD]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("model, label, modulus, held", [(quality, "quality", 4, 2), (toxicity, "toxic", 3, 1)])
def test_scores_held_out_texts(corpus, model, label, modulus, held):
    docs, labels = corpus
    truth = {r.doc_id: r[label] for r in labels.collect()}
    found = model.score(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (remainder(r.doc_id, modulus) == held) for r in found)
    out = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(out) > 100
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in out]) > 0.93


def test_held_out_labels_teach_nothing(spark, corpus):
    docs, labels = corpus
    some = docs.where("doc_id < 300")
    from pyspark.sql import functions as F

    for model, label, modulus, held in ((quality, "quality", 4, 2), (toxicity, "toxic", 3, 1)):
        wrong = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == held, 1 - F.col(label)).otherwise(F.col(label)))
        a, b = ({r.doc_id: r.score for r in model.score(some, x).collect()} for x in (labels, wrong))
        assert a.keys() == b.keys() and max(abs(a[i] - b[i]) for i in a) < 1e-6


def test_no_labels_and_empty_tables(spark, documents, corpus):
    docs, labels = corpus
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    for model in (quality, toxicity):
        assert model.score(documents([]), labels).count() == 0
    assert quality.score(docs.drop("n_chars"), none).count() == docs.count()


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    w, v = rng.normal(size=7), rng.normal(size=(7, 3))
    feature, value = np.array([1, 4, 6, 0, 2]), rng.normal(size=5)
    row = np.array([0, 0, 0, 1, 1])
    got, _, _ = quality.margins(row, feature, value, 2, 0.3, w, v.astype(np.float32))
    for r in (0, 1):
        at = np.flatnonzero(row == r)
        pairs = sum(v[feature[i]] @ v[feature[j]] * value[i] * value[j] for k, i in enumerate(at) for j in at[:k])
        assert got[r] == pytest.approx(0.3 + w[feature[at]] @ value[at] + pairs, abs=1e-4)


def test_kneser_ney_ratios_by_hand(spark):
    how = toxicity.Toxicity(order=2)
    a, b, start = 97, 98, 1
    gram = lambda h, w: h << 8 | w
    counts = spark.createDataFrame([(gram(start, a), 1, 0, 4), (gram(start, b), 1, 1, 1), (gram(start, a), 0, 0, 1), (gram(start, b), 0, 1, 3), (gram(a, b), 0, 1, 2)],
                                   "gram long, toxic int, fold int, n long")
    got = {r.gram: (r.r_a, r.r_b) for r in toxicity.ratios(counts, how).collect()}
    d = 0.75
    shared = {w: (max(n - d, 0) + d * 2 / 256) / 3 for w, n in ((a, 1), (b, 2))}  # continuation counts of both classes
    p = lambda c, w, kinds, total: (max(c - d, 0) + d * kinds * shared[w]) / total
    assert got[gram(start, a)][1] == pytest.approx(np.log(p(4, a, 2, 5) / p(1, a, 2, 4)))
    assert got[gram(start, b)][1] == pytest.approx(np.log(p(1, b, 2, 5) / p(3, b, 2, 4)))
    assert got[gram(start, a)][0] == pytest.approx(np.log(p(4, a, 1, 4) / p(1, a, 1, 1)))
    assert got[gram(a, b)] == pytest.approx((0, np.log(shared[b] / p(2, b, 1, 2))))


def test_languages(spark, documents, corpus):
    docs, _ = corpus
    truth = {r.doc_id: r.lang for r in docs.where("doc_id < 10000").collect()}
    found = {r.doc_id: r for r in language.identify(docs).where("doc_id < 10000").collect()}
    assert all(r.held_out == (remainder(i, 4) == 2) for i, r in found.items())
    assert np.mean([found[i].lang_pred == lang for i, lang in truth.items() if found[i].held_out]) > 0.98
    rows, _ = made()
    halves = {lang: " ".join(t for _, t, x in rows if x == lang)[:4000] for lang in ("aa", "bb", "cc")}
    mixed = language.identify(documents(rows + [(5000, halves["aa"] + " " + halves["cc"], None), (5001, halves["bb"], None), (5002, "123 %% !", "aa"), (5003, "— “ ”", None)] + [(6000 + (i or 0), t, None) for i, t, _ in ODD]))
    got = {r.doc_id: r for r in mixed.where("doc_id >= 5000").collect()}
    assert got[5000].langs == ["aa", "cc"] and 0.3 < got[5000].score < 0.7
    assert got[5001].langs == ["bb"] and got[5001].lang_pred == "bb" and got[5001].score > 0.95
    assert [got[i].lang_pred for i in (5002, 5003, 6001, 6002, 6003)] == ["und"] * 5 and got[6001].score == 0
    assert {r.lang_pred for r in language.identify(documents([(i, t, None) for i, t, _ in ODD])).collect()} == {"und"}
    assert language.identify(documents([])).count() == 0


def test_mixture_finds_proportions():
    rng = np.random.default_rng(3)
    ll = rng.normal(-8, 1, (400, 3))
    ll[:280, 0] += 6
    ll[280:, 2] += 6
    share, chosen = language.mixture(ll, np.zeros(400, int), 1, language.Languages())
    assert chosen.tolist() == [[True, False, True]] and share[0] == pytest.approx([0.7, 0, 0.3], abs=0.03)


def test_given_tables(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = [r for r in quality.score(docs, labels).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in found]) > 0.93
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    found = [r for r in language.identify(docs).collect() if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in found]) > 0.97


def test_language_ngrams_are_not_merged(spark, documents):
    """Languages that differ only in which letters follow each other, with more n-grams than a table of folded bytes keeps apart."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {lang: ["".join(rng.choice(letters) for _ in range(9)) for _ in range(3000)] for lang in ("aa", "bb")}
    rows = [(k * 1000 + i, " ".join(words[lang][i * 30 : i * 30 + 30]), lang) for k, lang in enumerate(words) for i in range(100)]
    docs = documents(rows)
    train = docs.select("text", "lang")
    grams, contexts = language.learned(train, ["aa", "bb"], language.Languages())
    exact = {}
    for _, text, lang in rows:
        for word in text.split():
            symbols = bytes([1]) + word.encode() + bytes([2])
            for i in range(1, len(symbols)):
                at = int.from_bytes(symbols[max(0, i - 3) : i + 1], "big")
                exact[at, lang] = exact.get((at, lang), 0) + 1
    got = {(int(g), ["aa", "bb"][grams.language[k]]): round(float(np.exp(grams.value[k])) - 2 / 256) for i, g in enumerate(grams.keys) for k in range(grams.starts[i], grams.starts[i + 1])}
    assert got == exact and len(contexts.keys) == len({g >> 8 for g, _ in exact})
    singles = [(10_000 + k * 10_000 + i, words[lang][i], None) for k, lang in enumerate(words) for i in range(0, 3000, 10)]
    found = {r.doc_id: r.lang_pred for r in language.identify(documents(rows + singles)).collect()}
    # a quarter of the rows is held out; a word that was learned is told from one that was not
    known = [(i, ("aa", "bb")[i >= 20_000]) for i, _, _ in singles if remainder((i % 10_000) // 30 + 1000 * (i >= 20_000), 4) != 2]
    assert len(known) > 300 and np.mean([found[i] == lang for i, lang in known]) > 0.99


def _parts(counts, ahead, seed=6):
    """Log-likelihoods of words of one document, ``counts`` of each language."""
    rng = np.random.default_rng(seed)
    ll = rng.normal(-8, 1, (sum(counts), len(counts)))
    ll[np.arange(len(ll)), np.repeat(np.arange(len(counts)), counts)] += ahead
    return ll


def test_mixture_takes_as_many_languages_as_there_are():
    ll = _parts([300, 200, 150, 0, 100, 50], 5)
    share, chosen = language.mixture(ll, np.zeros(800, int), 1, language.Languages())
    assert chosen.tolist() == [[True, True, True, False, True, True]]
    assert share[0] == pytest.approx(np.array([300, 200, 150, 0, 100, 50]) / 800, abs=0.03) and share[0].sum() == pytest.approx(1)


def test_mixture_keeps_a_small_share_of_a_long_text():
    ll = _parts([19_900, 100, 0], 7)  # half of one percent
    share, chosen = language.mixture(ll, np.zeros(20_000, int), 1, language.Languages())
    assert chosen.tolist() == [[True, True, False]] and share[0, 1] == pytest.approx(0.005, abs=0.002)


def test_mixture_is_fitted_to_its_maximum():
    how = language.Languages()
    rng = np.random.default_rng(8)
    rows, row = 40, np.repeat(np.arange(40), rng.integers(1, 400, 40))
    ll = rng.normal(-8, 1, (len(row), 4))
    ll[np.arange(len(row)), (rng.random(len(row)) ** (1 + row % 3) * 4).astype(int)] += 1 + row % 4
    share, chosen = language.mixture(ll, row, rows, how)
    for r in range(rows):
        words = ll[row == r]

        def best(allowed):
            pi = np.where(allowed, 1 / sum(allowed), 0)
            for _ in range(3000):
                joint = np.exp(words) * pi
                pi = (joint / joint.sum(1, keepdims=True)).mean(0)
            return np.log((np.exp(words) * pi).sum(1)).sum(), pi

        cost = how.penalty * np.log(max(len(words), 2))
        full = best([True] * 4)[1]
        sets = [np.arange(4) == words.sum(0).argmax()] + [np.argsort(np.argsort(-full)) < k for k in (2, 3, 4)]
        values = [best(s)[0] - (s.sum() - 1) * cost for s in sets]
        got = np.log((np.exp(words) * share[r]).sum(1)).sum() - (chosen[r].sum() - 1) * cost
        assert got == pytest.approx(max(values), abs=2 * how.tolerance)


def test_toxicity_ratios_are_not_merged():
    """As many n-grams as a table of 2 ** 22 folded slots can't keep apart."""
    letters = np.arange(97, 123, dtype=np.uint64)
    grams = np.zeros(1, np.uint64)
    for _ in range(4):
        grams = (grams[:, None] << np.uint64(8) | letters).ravel()
    grams = np.sort(np.concatenate([grams | np.uint64(k) << np.uint64(32) for k in (105, 106)]))
    seen = np.arange(len(grams)).astype(np.float32)
    model = toxicity.Ratios(grams, seen, np.empty(0, np.uint64), np.empty(0, np.float32))
    some = np.random.default_rng(1).integers(0, len(grams), 50_000)
    assert np.array_equal(model.of(grams[some]), seen[some])
    assert not model.of(np.array([5, 1 << 50], np.uint64)).any()


def test_unseen_spellings_back_off(spark):
    how = toxicity.Toxicity(order=2)
    a, b, c, start = 97, 98, 99, 1
    gram = lambda h, w: h << 8 | w
    counts = spark.createDataFrame([(gram(start, a), 1, 0, 4), (gram(start, b), 1, 1, 1), (gram(start, a), 0, 0, 1), (gram(start, b), 0, 1, 3), (gram(a, b), 0, 1, 2)],
                                   "gram long, toxic int, fold int, n long")
    rows = {r.gram: r for r in toxicity.ratios(counts, how).collect()}
    left = lambda kinds, total: 0.75 * kinds / total
    assert rows[gram(start, a)].k_b == rows[gram(start, b)].k_b == pytest.approx(np.log(left(2, 5) / left(2, 4)))
    assert rows[gram(start, b)].k_a == pytest.approx(np.log(left(1, 4) / left(1, 1)))
    assert rows[gram(start, b)].r_a == pytest.approx(np.log(left(1, 4) / left(1, 1)))  # only fold 1 has it
    assert rows[gram(a, b)].k_b == pytest.approx(np.log(1 / left(1, 2)))
    model = toxicity.Ratios(np.array([gram(start, a)], np.uint64), np.array([2.0]), np.array([start], np.uint64), np.array([0.5]))
    assert model.of(np.array([gram(start, a), gram(start, c), gram(b, c)], np.uint64)).tolist() == [2.0, 0.5, 0.0]


def test_given_tables_toxicity(spark):
    """Held-out labels; expressions inside words are all that the model sees."""
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    found = [r for r in toxicity.score(docs, labels).collect() if r.held_out and r.doc_id in truth]
    score, toxic = np.array([r.score for r in found]), np.array([truth[r.doc_id] for r in found]) == 1
    assert np.mean([(score[toxic][:, None] > score[~toxic]).mean()]) > 0.93
    assert (score[~toxic] >= 0.7).mean() < 0.02 and (score[toxic] >= 0.7).mean() > 0.5
