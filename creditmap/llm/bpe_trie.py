"""BPE encoding and decoding by prefix-sharing trie traversal.

The symbols of a word are its bytes, the last one marked as word end.  The
encoding of a prefix is the encoding of a shorter prefix plus one last token,
and a token may follow another exactly if the two alone encode to themselves.
So a trie of the distinct words holds, per node, the last token of that prefix
and the node before that token; a depth-first walk computes each shared prefix
once, and a word's ids are read off by walking back from its end.

A task keeps one trie and one table of finished words for all its texts and
drops both when ``max_nodes`` is passed; the part of a word after ``_DEEP``
bytes is a path of its own that goes with the word, so memory is bounded by
``max_nodes`` and, at a few bytes a letter, the longest word.  Nothing is
shuffled.  Encoding equals the tokenizers library for a model of this kind
(NFC, lower case, the split pattern below, byte symbols, word-end suffix, no
ids added); decoding joins the tokens by blanks, as that library does for a
file without decoder.  NULL text is empty; an empty text has no ids.
"""

from __future__ import annotations

import gc
import json
import math
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, pre_tokenizers

from creditmap.llm.word_split import PIECES, byte_characters, gathered, simple, split

_SHORT = (2, 1)
#: Bytes of a word that share the trie with other words.
_DEEP = 256
#: Bytes of text that are split into words at once.
_BLOCK = 1 << 22


class TrieEncoder:
    """Encodes texts for one tokenizer file."""

    def __init__(self, path: str, max_nodes: int = 800_000):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.max_nodes = max_nodes
        suffix = model["end_of_word_suffix"] or ""
        vocabulary: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self._specials = f"({'|'.join(map(regex.escape, self.special))})"
        self.tokens = {i: t for t, i in (vocabulary | self.special).items()}
        self._library = Tokenizer.from_file(path)
        self._split = pre_tokenizers.Split(Regex(PIECES.pattern), "removed", invert=True)
        marks = byte_characters()
        #: of each token its bytes, by whether it ends a word
        self.inside = {bytes([b]): vocabulary[c] for b, c in enumerate(marks)}
        self.ending = {bytes([b]): vocabulary[c + suffix] for b, c in enumerate(marks)}
        raw = {i: (x, table) for table in (self.inside, self.ending) for x, i in table.items()}
        #: the piece at a token's right or left edge before each of its own merges, and the rank that ends it
        self.right: dict[int, list[tuple[int, float]]] = {i: [(i, math.inf)] for i in raw}
        self.left: dict[int, list[tuple[int, float]]] = {i: [(i, math.inf)] for i in raw}
        self.rank: dict[tuple[int, int], int] = {}
        pairs = [tuple(vocabulary[x] for x in (m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        for rank, (a, b) in enumerate(pairs):
            whole = vocabulary[self.tokens[a] + self.tokens[b]]
            if whole in raw or a not in raw or b not in raw or a in self.ending.values():
                raise ValueError("each token needs one merge, of earlier tokens")
            self.rank[a, b] = rank
            raw[whole] = raw[a][0] + raw[b][0], raw[b][1]
            self.right[whole] = [(whole, math.inf), (b, rank), *self.right[b][1:]]
            self.left[whole] = [(whole, math.inf), (a, rank), *self.left[a][1:]]
        whole_of = dict(enumerate(pairs))
        for rank, (a, b) in whole_of.items():  # a token that its own bytes do not encode to is never used
            whole = vocabulary[self.tokens[a] + self.tokens[b]]
            text, table = raw[whole]
            if table.get(text) is None and not self._merge_across(a, b, rank):
                table[text] = whole
        #: by the last three bytes of a token: the lengths that such tokens have, longest first
        self.lengths: dict[bool, dict[bytes, list[int]]] = {}
        for ends, table in ((False, self.inside), (True, self.ending)):
            own: dict[bytes, set[int]] = {}
            for text in table:
                if len(text) > 2:
                    own.setdefault(text[-3:], set()).add(len(text))
            self.lengths[ends] = {k: [*sorted(v, reverse=True), *_SHORT] for k, v in own.items()}
        self.clear()

    def _merge_across(self, a: int, b: int, limit: float) -> bool:
        """Whether a merge of rank under ``limit`` joins pieces of a and of b.

        Merges go by rank, so a piece lives until the rank that ends it; at
        equal rank the merge further left goes first."""
        for x, x_ends in self.right[a]:
            for y, y_ends in self.left[b]:
                rank = self.rank.get((x, y))
                if rank is not None and rank < x_ends and rank <= y_ends and rank < limit:
                    return True
        return False

    def clear(self) -> None:
        self.children: dict[int, int] = {}  # 256 * node + byte: node
        self.last = array("i", [-1])  # of each node, the last token of its prefix
        self.prior = array("i", [0])  # and the node before that token
        self.follows: dict[int, bool] = {}
        self.known: dict[bytes, bytes] = {}  # the ids of finished words

    def encode_words(self, words: set[bytes]) -> None:
        """Insert the words into the trie, walking its new part depth-first."""
        children, last, prior, follows, known = self.children, self.last, self.prior, self.follows, self.known
        across = self._merge_across
        inside, inside_lengths, ending, ending_lengths = self.inside, self.lengths[False], self.ending, self.lengths[True]

        def resolve(word: bytes, end: int, table: dict[bytes, int], lengths: dict[bytes, list[int]]) -> tuple[int, int]:
            """(last token of the word's first ``end`` bytes, node before it); ``path``: nodes of its prefixes."""
            for length in lengths.get(word[end - 3 : end] if end > 2 else b"", _SHORT):
                if length <= end:
                    token = table.get(word[end - length : end])
                    if token is not None:
                        node = path[end - length]
                        previous = last[node]
                        if previous < 0:
                            return token, node
                        key = previous << 20 | token
                        fits = follows.get(key)
                        if fits is None:
                            fits = follows[key] = not across(previous, token, math.inf)
                        if fits:
                            return token, node
            raise ValueError(f"no token ends {word[:end]!r}")

        path, walked = array("i", [0]), b""
        for word in sorted(words):  # visits the trie depth-first
            shared, most = 0, min(len(walked), len(word) - 1)
            while shared < most and walked[shared] == word[shared]:
                shared += 1
            del path[shared + 1 :]
            node, deep = path[-1], min(len(word) - 1, _DEEP)
            for depth in range(shared, deep):
                key = node << 8 | word[depth]
                node = children.get(key)
                if node is None:
                    token, before = resolve(word, depth + 1, inside, inside_lengths)
                    node = children[key] = len(last)
                    last.append(token)
                    prior.append(before)
                path.append(node)
            nodes = len(last)
            for depth in range(deep, len(word) - 1):  # a path of its own
                token, before = resolve(word, depth + 1, inside, inside_lengths)
                path.append(len(last))
                last.append(token)
                prior.append(before)
            token, node = resolve(word, len(word), ending, ending_lengths)
            ids = array("I", [token])
            while node:
                ids.append(last[node])
                node = prior[node]
            ids.reverse()
            known[word] = ids.tobytes()
            if len(word) - 1 > _DEEP:
                del last[nodes:], prior[nodes:], path[deep + 1 :]
            walked = word[: min(len(word) - 1, _DEEP)]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        if len(self.last) + len(self.known) + len(self.follows) > self.max_nodes:
            self.clear()
        gc.disable()  # no cycles are made here, and its passes would walk over all these objects
        self.encode_words({w for w in words if w not in self.known})
        gc.enable()
        return [*map(self.known.__getitem__, words)]

    def _simple(self, texts: list[str]) -> list[bytes]:
        words, index, ends = split(texts)
        ids = self._ids(words.to_pylist())
        at = np.append(0, np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))) // 4
        return [x.tobytes() for x in gathered(np.frombuffer(b"".join(ids), "<u4"), at, index, ends)]

    def _other(self, text: str) -> bytes:
        """Text that ``split`` does not cover: special tokens stand alone, words come from the library."""
        out = []
        for part in regex.split(self._specials, text) if "<|" in text else [text]:
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                chunks = self._library.normalizer.normalize_str(part).split(" ")
                words = [x[0].encode() for c in chunks if c for x in self._split.pre_tokenize_str(c)]
                held = [*dict.fromkeys(words)]
                of = dict(zip(held, self._ids(held)))
                out += map(of.__getitem__, words)
        return b"".join(out)

    def encode_batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = [b""] * len(texts)
        held: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            if text and not simple(text):
                out[k] = self._other(text)
            elif text:
                held.append(k)
                size += len(text)
            if size >= _BLOCK:
                for i, ids in zip(held, self._simple([texts[i] for i in held])):
                    out[i] = ids
                held, size = [], 0
        if held:
            for i, ids in zip(held, self._simple([texts[i] for i in held])):
                out[i] = ids
        yield from out

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(path)
    return _ENCODERS[path]


def encoded_rows(batches: Iterator[pa.RecordBatch], path: str, column: str = "text", rows: int = 1024) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the ids of each row."""
    trie = encoder(path)
    for batch in batches:
        at = batch.schema.get_field_index(column)
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            yield part, list(trie.encode_batch(part.column(at).to_pylist()))
    trie.clear()  # the worker may serve other stages next


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every whole text of ``docs``."""
    def run(batches):
        trie = encoder(path)
        for part, ids in encoded_rows(batches, path):
            numbers = [np.frombuffer(x, "<u4").tolist() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")).cast(pa.int64()), pa.array([len(x) for x in numbers], pa.int64()),
                 pa.array(numbers, pa.list_(pa.int64())), pa.array([trie.decode(x) for x in numbers], pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<long>, decoded string")


def encode_decode_digests(docs: DataFrame, path: str) -> DataFrame:
    """As :func:`encode_decode`, with SHA-256 digests for the ids (decimal,
    joined by one blank) and the decoded text, taken in the same task."""
    from hashlib import sha256

    def run(batches):
        trie = encoder(path)
        text_of = [str(i) for i in range(max(trie.tokens) + 1)]
        token_of = [trie.tokens.get(i, "") for i in range(max(trie.tokens) + 1)]
        for part, ids in encoded_rows(batches, path):
            counts, of_ids, of_text = [], [], []
            for x in ids:
                numbers = np.frombuffer(x, "<u4").tolist()
                counts.append(len(numbers))
                of_ids.append(sha256(" ".join(map(text_of.__getitem__, numbers)).encode()).hexdigest())
                of_text.append(sha256(" ".join(map(token_of.__getitem__, numbers)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
