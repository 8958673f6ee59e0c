"""Token ids of whole Arrow columns at once, for the packing operators.

A block of texts is split into words by array operations, its distinct words
are found by Arrow, and those are merged together: each pass applies, in every
word, the merge of lowest rank at all its places.  Nothing is kept from block
to block, so memory is bounded by the block.  Ids equal the tokenizers library
for a word-end BPE file (see ``bpe_trie``); texts that the array rules do not
cover and words longer than ``_LONG`` bytes go through that library.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from creditmap.llm.word_split import byte_characters, gathered, simple, split

#: Bytes of text worked on at once (a longer text is a block of its own), and of a word that is merged here.
_BLOCK, _LONG = 1 << 22, 128
_NONE = np.int64(1) << 40


class BatchEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        vocabulary: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        marks = byte_characters()
        self._inside = np.array([vocabulary[c] for c in marks], np.int64)
        self._ending = np.array([vocabulary[c + suffix] for c in marks], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._whole = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        made = np.full(max(vocabulary.values()) + 1, -1, np.int64)
        made[self._whole] = np.arange(len(pairs))
        if len(np.unique(self._whole)) < len(pairs) or (made[keys >> 32] >= np.arange(len(pairs))).any() or (made[keys & 0xFFFFFFFF] >= np.arange(len(pairs))).any():
            raise ValueError("each token needs one merge, of earlier tokens")  # else merges at several places at once could differ
        # the pair of each merge, at a slot of an open hash table
        self._bits = max(8, (8 * len(keys)).bit_length())
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._ranks = np.full(1 << self._bits, _NONE, np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self._keys[slot] < 0
            place, first = np.unique(slot[free], return_index=True)
            mine = left[free][first]
            self._keys[place], self._ranks[place] = keys[mine], mine
            rest = ~np.isin(left, mine)
            left, slot = left[rest], (slot[rest] + 1) & (len(self._keys) - 1)
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair of tokens; _NONE if there is none."""
        keys = first << 32 | second
        slot = self._slot(keys)
        there = self._keys[slot]
        out = np.where(there == keys, self._ranks[slot], _NONE)
        again = np.flatnonzero((there != keys) & (there >= 0))
        while len(again):
            slot[again] = (slot[again] + 1) & (len(self._keys) - 1)
            there = self._keys[slot[again]]
            out[again] = np.where(there == keys[again], self._ranks[slot[again]], _NONE)
            again = again[(there != keys[again]) & (there >= 0)]
        return out

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each word's ids) of words, their bytes from one offset to the next."""
        n = len(offsets) - 1
        sizes = np.diff(offsets)
        long = np.flatnonzero(sizes > _LONG)
        tokens = self._inside[data]
        tokens[offsets[1:] - 1] = self._ending[data[offsets[1:] - 1]]
        word = np.repeat(np.arange(n), sizes)
        if len(long):
            keep = np.ones(n, bool)
            keep[long] = False
            tokens, word = tokens[keep[word]], word[keep[word]]
        same = np.append(word[1:] == word[:-1], False) if len(word) else np.empty(0, bool)
        rank = np.full(len(tokens), _NONE, np.int64)
        at = np.flatnonzero(same)
        rank[at] = self._rank(tokens[at], tokens[at + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(tokens):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            counts = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            live = least < _NONE
            if not live.all():
                open_ = np.repeat(live, counts)
                done.append((word[~open_], tokens[~open_]))
                tokens, word, rank = tokens[open_], word[open_], rank[open_]
                least, counts = least[live], counts[live]
                if not len(tokens):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, counts))
            touching = np.append(False, hit[1:] == hit[:-1] + 1)  # a run of equal tokens is merged from its left, pair by pair
            if touching.any():
                run = np.maximum.accumulate(np.where(touching, 0, np.arange(len(hit))))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            tokens[hit] = self._whole[rank[hit]]
            keep = np.ones(len(tokens), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            hit = place[hit]
            tokens, word = tokens[keep], word[keep]
            rank = rank[keep]
            touched = np.zeros(len(tokens) + 1, bool)
            touched[hit] = touched[hit - 1] = True  # place -1 is the spare last one
            changed = np.flatnonzero(touched[:-1])
            rank[changed] = _NONE
            changed = changed[changed < len(tokens) - 1]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed] = self._rank(tokens[changed], tokens[changed + 1])
        for k in long.tolist():
            found = self._library.encode(data[offsets[k] : offsets[k + 1]].tobytes().decode(), add_special_tokens=False).ids
            done.append((np.full(len(found), k), np.array(found, np.int64)))
        if not done:
            return np.empty(0, np.uint32), np.zeros(n + 1, np.int64)
        of, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(of, kind="stable")
        return ids[order].astype(np.uint32), np.append(0, np.cumsum(np.bincount(of, minlength=n)))

    def _simple(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts that ``split`` covers."""
        own, index, ends = split(texts)
        distinct = np.frombuffer(own.buffers()[1], np.int64)[: len(own) + 1] if len(own) else np.zeros(1, np.int64)
        data = np.frombuffer(own.buffers()[2], np.uint8)[: distinct[-1]] if len(own) else np.empty(0, np.uint8)
        return gathered(*self.words(data, distinct), index, ends)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit numbers; NULL is empty."""
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        held, size = [], 0

        def flush():
            for k, ids in zip(held, self._simple([texts[k] for k in held])):
                out[k] = ids

        for k, text in enumerate(texts):
            if not text:
                continue
            if not simple(text):
                out[k] = np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)
                continue
            held.append(k)
            size += len(text)
            if size >= _BLOCK:
                flush()
                held, size = [], 0
        if held:
            flush()
        return out


_ENCODERS: dict[str, BatchEncoder] = {}


def encoder(path: str) -> BatchEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BatchEncoder(path)
    return _ENCODERS[path]


def encoded_blocks(batches: Iterator[pa.RecordBatch], path: str, column: str = "text", most: int = _BLOCK) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches, about ``most`` bytes of text each, with the ids of each row."""
    own = encoder(path)
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + most, "right")))
            yield batch.slice(lo, hi - lo), own.encode(texts.slice(lo, hi - lo).to_pylist())
            lo = hi
