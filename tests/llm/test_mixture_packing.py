import random
import zlib

import numpy as np
import pytest

from creditmap.llm.batch_bpe import BatchEncoder
from creditmap.llm.mixture_packing import Mixture, Schedule, pack_documents
from tests.llm.conftest import ODD
from tests.llm.test_bpe_and_packing import LIBRARY, PATH, strange


def test_batch_encoder_equals_the_library():
    own = BatchEncoder(PATH)
    texts = [*strange(), "", None, "x'sa 's 'says ''s o'clock's 'll 'lll 'RE'", "ab" * 64 + " " + "ab" * 65, "~!@'s'", "aaaa aaaaa " * 30]
    assert [x.tolist() for x in own.encode(texts)] == [LIBRARY.encode(x or "", add_special_tokens=False).ids for x in texts]
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh") for _ in range(1_000_000))
    assert own.encode([long])[0].tolist() == LIBRARY.encode(long, add_special_tokens=False).ids


def sequences(pieces, tokens, capacity):
    """Checks gapless sequences, all full but for powers of two at the end; their pieces."""
    own = {}
    for p in pieces:
        own.setdefault(p[0], []).append(p[1:])
    sizes = []
    for k in sorted(own):
        at = 0
        for offset, length, *_ in sorted(own[k]):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    assert sum(sizes) == tokens
    rest = [n for n in sizes if n != capacity]
    assert all(n & (n - 1) == 0 for n in rest) and sorted(set(rest), reverse=True) == rest and sum(rest) < capacity
    return own


@pytest.mark.parametrize("totals, capacity, quantum", [
    ([360_000] + [32_000] * 20, 2048, 64), ([5], 2048, 64), ([2048], 2048, 64), ([1, 1, 1], 2048, 64),
    ([100_000, 3, 1, 700], 2048, 64), ([random.Random(1).randint(1, 3000) for _ in range(300)], 2048, 64), ([64_000, 32_000, 100], 128, 16)])
def test_schedule_deals_every_token_once_in_proportion(totals, capacity, quantum):
    rng, s = random.Random(4), Schedule(np.array(totals), Mixture(capacity=capacity, quantum=quantum))
    pieces = []
    for queue, total in enumerate(totals):
        sizes = []
        while sum(sizes) < total:
            sizes.append(min(total - sum(sizes), rng.choice([1, 5, 100, 3000, 20000])))
        first = np.cumsum([0, *sizes[:-1]])
        got = {}
        for doc, start, length, sequence, offset in zip(*(x.tolist() for x in s.pieces(queue, first, np.array(sizes)))):
            assert start == got.get(doc, 0)
            got[doc] = start + length
            pieces.append((sequence, offset, length, queue))
        assert [got[d] for d in range(len(sizes))] == sizes
    own = sequences(pieces, sum(totals), capacity)
    owed = np.array(totals) / sum(totals) * capacity
    for k in range(sum(totals) // capacity):  # every window has the target proportions, but for about a quantum
        has = np.zeros(len(totals))
        for _, length, queue in own[k]:
            has[queue] += length
        assert np.abs(has - owed).max() < 2 * quantum


def test_counters_do_not_overflow():
    s = Schedule(np.array([10**13] * 3 + [10**9]), Mixture())
    for queue in (0, 3):
        for r in (1, 12_345_678, s.rounds // 3, s.rounds - 1):
            exact = (int(s.totals[queue]) * r + int(s.phase[queue])) // s.rounds // 64 * 64
            assert int(s.sent(queue, r)) == min(exact, int(s.totals[queue]))


def rows_of(spark, n, source):
    rng = random.Random(7)
    words = ["a", "river", "unthinkable", "zq", "9", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 40, 400]))), source(i)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), rows


def check(docs, rows, how):
    found = pack_documents(docs, PATH, how).collect()
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    total = sum(len(x) for xs in texts.values() for x in xs)
    sequences([(r.sequence_id, r.offset, r.length) for r in found], total, how.capacity)
    of = {}
    for r in found:
        of.setdefault(r.doc_id, []).append(r)
    assert of.keys() == texts.keys()
    for i, ids in texts.items():
        assert sum(r.length for r in of[i]) == sum(map(len, ids))
        assert {r.doc_tokens for r in of[i]} == set(map(len, ids))
        assert all(any(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in ids) for r in of[i])


def test_packs_every_token_of_odd_rows(documents):
    check(documents(ODD), ODD, Mixture())
    assert pack_documents(documents([]), PATH).count() == 0


def test_hot_null_and_many_small_sources(spark):
    docs, rows = rows_of(spark, 400, lambda i: None if i % 3 == 0 else "hot" if i % 3 == 1 else f"s{i}")
    check(docs, rows, Mixture(lanes=4))
