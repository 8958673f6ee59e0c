"""Byte n-grams inside words, for the language and toxicity models."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from creditmap.llm.common import lower_ascii

START, END = 1, 2  # symbols before and after a word
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram per symbol, its word, row of each word) of runs of letters.

    The symbols of a word are its bytes (A-Z lower-cased) and END.  The n-gram
    of a symbol has it in the lowest byte and above it up to ``order - 1``
    symbols before it, the first of a word preceded by START; its context is
    the n-gram shifted by 8 bits."""
    rows = len(offsets) - 1
    ends = offsets[1:] + np.arange(rows)  # of each row, in the bytes with one blank after each row
    text = np.full(len(data) + rows + 1, 32, np.uint8)
    place = np.ones(len(data) + rows, bool)
    place[ends] = False
    text[1:][place] = lower_ascii(data)
    letter = _LETTER[text]
    first = letter[1:] & ~letter[:-1]
    at = np.flatnonzero(letter[1:] | letter[:-1]) + 1  # letters, and what follows a word
    starts = np.flatnonzero(first) + 1
    word = np.searchsorted(starts, at, "right") - 1
    inside = at - starts[word]  # symbols of the word before this one
    grams = np.where(letter[at], text[at], END).astype(np.uint64)
    for back in range(1, order):
        symbol = np.where(inside >= back, text[np.maximum(at - back, 0)], np.where(inside == back - 1, START, 0))
        grams |= symbol.astype(np.uint64) << np.uint64(8 * back)
    return grams, word, np.searchsorted(ends + 1, starts, "right")


def sums_by(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(index, values, n)


def tallied(parts: Iterable[tuple[np.ndarray, np.ndarray]], most: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of all ``parts``; a key comes once, or again whenever
    more than ``most`` distinct ones were held."""
    held, size = [], 0

    def merged():
        keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > 2 * most:
            held = [merged()]
            size = len(held[0][0])
            if size > most:
                yield held.pop()
                size = 0
    if held:
        yield merged()


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``wanted``, places in the ascending ``keys``) of equal values."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    here = np.flatnonzero(keys[at] == wanted)
    return here, at[here]
