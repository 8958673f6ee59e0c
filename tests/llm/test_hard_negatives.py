import math
import random

import numpy as np
import pytest

from creditmap.llm import hard_negatives
from creditmap.llm.hard_negatives import Mining, mine_embeddings

COLUMNS = "vec_id long, embedding array<float>, label int, id int, v string, block string, t int, cap string"


def expected(rows, how=Mining()):
    own = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, label, v in own:
        if i % 50:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in own if j != i]
        for s, j, _ in sorted(x for x in scores if x[2] == label)[:5]:
            fit = sorted(x for x in scores if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:3]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(fit)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def build(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", "y", 2, "z") for i, v, label in rows], COLUMNS).repartition(3)


def vectors(n, dims, hot=False, seed=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(10)]
    return [(i, [c + rng.gauss(0, 0.1) for c in centres[label]], label) for i in range(n) for label in (0 if hot and rng.random() < 0.5 else rng.randint(0, 9),)]


@pytest.mark.parametrize("how", [Mining(), Mining(rows=16, anchors=4, step=3)])
def test_equals_brute_force(spark, how):
    rows = vectors(600, 16, hot=True)
    rows += [(10_050, [0.0] * 16, 1), (10_100, [-1.0] * 16, 2), (10_151, [-1.0] * 16, 2), (10_152, [1.0] * 16, 2)]  # scores of zero and below
    assert got(mine_embeddings(build(spark, rows), how=how)) == expected(rows)


def test_odd_rows(spark):
    rows = vectors(120, 8, seed=2) + [(None, [0.1] * 8, 1), (200, None, 1), (250, [0.1] * 8, None), (300, [0.1, None, *[0.1] * 6], 1), (350, [float("nan")] * 8, 1),
                                      (400, [float("inf")] * 8, 1), (450, [0.5, 0.5], 3), (451, [], 3), (500, [0.2] * 8, 4), *[(500 + k, [0.2] * 8, 4) for k in range(1, 9)], (510, [0.15] * 8, 5), (511, [0.15] * 8, 5)]
    assert got(mine_embeddings(build(spark, rows), how=Mining(rows=16, anchors=4))) == expected(rows)
    assert mine_embeddings(build(spark, rows).where("false")).count() == 0
    assert mine_embeddings(build(spark, [(200, None, 1)])).count() == 0


def test_lists_omit_rows_below_the_bound():
    rng = np.random.default_rng(5)
    q, y = rng.integers(-50, 50, (7, 32)).astype(float), rng.integers(-50, 50, (300, 32)).astype(float)
    y[:250] //= 25
    exact = q @ y.T
    least = np.sort(exact, 1)[:, -4].astype(np.int64)
    a, b, score = hard_negatives._meet(q, y, least, np.ones(exact.shape, bool), Mining())
    assert sorted(zip(a, b)) == sorted(zip(*np.nonzero(exact >= least[:, None]))) and (score == exact[a, b]).all()
