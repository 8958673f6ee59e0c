import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from creditmap.llm import residual_packing as packing
from creditmap.llm.bpe_trie import TrieEncoder, encode_decode, encode_decode_digests
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()


def strange(n=1500, seed=5):
    rng = random.Random(seed)
    out = ["a<|endoftext|>b <|startoftext|>", "<|EndOfText|>", "don't CAN'T we'll 123 4½ ²", "ΣΑΣ ὈΔΥΣΣΕΎΣ xİy ẞ Ǆ ﬁ", "\x1c\x1d a\x85b\xa0c　d", "é́ ạ̈ 가", "🙂🙃👩‍👩‍👧", "\x00\x7f", "a" * 3000]
    for letters in ("abcdefghijklmnopqrstuvwxyzéüñ' !?.0123456789ABCΣß日本\n\t", "abn "):
        out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(n)]
    out += ["".join(chr(rng.choice([rng.randint(0, 0x2FFF), rng.randint(32, 126)])) for _ in range(30)) for _ in range(n)]
    return out


def test_encoder_equals_the_library_and_stays_bounded():
    texts = strange()
    expected = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    for nodes in (1_500_000, 200):  # a small bound drops the trie again and again
        trie = TrieEncoder(PATH, max_nodes=nodes)
        got = [np.frombuffer(x, "<u4").tolist() for lo in range(0, len(texts), 50) for x in trie.encode_batch(texts[lo : lo + 50])]
        assert got == expected
    assert all(trie.decode(x) == LIBRARY.decode(x, skip_special_tokens=False) for x in expected)


def test_one_word_of_a_million_letters():
    """Memory and time are linear in a word: its prefixes keep a token and a node each, not their ids."""
    import tracemalloc

    rng = random.Random(6)
    word = "".join(rng.choice("abcdefgh") for _ in range(1_000_000))
    trie = TrieEncoder(PATH)
    list(trie.encode_batch([word[:1000]]))
    tracemalloc.start()
    found = next(trie.encode_batch([word]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.frombuffer(found, "<u4").tolist() == LIBRARY.encode(word, add_special_tokens=False).ids
    assert peak < 150e6 and len(trie.last) < 10_000  # and the trie keeps the word's first letters only


def test_operator_and_digests(documents):
    docs = documents(ODD)
    rows = encode_decode(docs, PATH).collect()
    expected = sorted((i is None, i or 0, LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t, _ in ODD)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in rows) == expected
    assert all(r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False) and r.n_tokens == len(r.ids) for r in rows)
    digest = lambda s: sha256(s.encode()).hexdigest()
    assert sorted(map(str, encode_decode_digests(docs, PATH).collect())) == sorted(
        str(type(r)) and f"Row(doc_id={r.doc_id!r}, n_tokens={r.n_tokens}, ids_sha256={digest(' '.join(map(str, r.ids)))!r}, decoded_sha256={digest(r.decoded)!r})" for r in rows)
    assert encode_decode(documents([]), PATH).count() == 0


def checked(rows, capacity):
    """Sequences are gapless and not longer than the capacity; their number."""
    own = {}
    for r in rows:
        own.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in own.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(own)


def test_packs_whole_documents(documents):
    rows = packing.pack_documents(documents(ODD), PATH).collect()
    checked(rows, 4096)
    expected = []
    for i, t, _ in ODD:
        ids = np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        expected += [(str(i), k, 4096 * k, len(x), zlib.crc32(x.tobytes())) for k in range(-(-len(ids) // 4096)) for x in (ids[4096 * k : 4096 * (k + 1)],)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    assert packing.pack_documents(documents([]), PATH).count() == 0


def test_rounds_merge_what_single_tasks_leave(spark):
    rng = random.Random(2)
    lengths = [rng.choice([rng.randint(1, 200), rng.randint(400, 1900), rng.randint(2000, 4096)]) for _ in range(3000)]
    items = spark.createDataFrame([(i, 0, n, 0) for i, n in enumerate(lengths)], "doc_id long, piece int, length long, ids_crc32 long").repartition(16)
    how = packing.Packing(items=64)
    rows = packing.pack(items, how).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths))
    assert checked(rows, 4096) <= 1.08 * sum(lengths) / 4096 + 1


def test_best_fit_prefers_the_fullest_bin():
    full, rest = packing.best_fit([(6, ["a"]), (5, ["b"]), (4, ["c"]), (3, ["d"])], packing.Packing(capacity=10, slack=0))
    assert sorted(sorted(x) for _, x in full) == [["a", "c"]] and rest == [(8, ["b", "d"])]
