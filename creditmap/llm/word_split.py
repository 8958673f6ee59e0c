"""The words that a word-end BPE file's pre-tokenizer finds, for blocks of texts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import regex

# Fixed value of the tokenizer file's pre-tokenizer.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Text of which Python's lower() and the rules below give what the tokenizers library gives; its characters keep their number in lower().
SIMPLE = re.compile(r"[\t-\r\x20-\x7e\xa0-įı-ɏ]*")
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


def _classes() -> np.ndarray:
    """The class of each character up to U+024F (SIMPLE has no other)."""
    out = np.full(0x250, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}"), (_DIGIT, r"\p{N}"), (_SPACE, r"\s")):
        out[[c for c in range(0x250) if regex.fullmatch(pattern, chr(c))]] = kind
    return out


_CLASS = _classes()


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


def simple(text: str) -> bool:
    """Whether :func:`split` covers the text (special tokens hold ``<|``)."""
    return "<|" not in text and SIMPLE.fullmatch(text) is not None


def split(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words as bytes, the words of all texts as places in them, end of each text's words)
    of texts that :func:`simple` holds for."""
    lower = ("\n".join(texts) + "\n").lower()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    chars = np.frombuffer(lower.encode("utf-32-le"), np.uint32)
    kind = _CLASS[chars]
    before = np.append(np.uint8(_SPACE), kind[:-1])
    start = (kind != _SPACE) & ((kind != before) | (kind == _DIGIT))
    tick = np.flatnonzero((chars == 39) & (before != _OTHER))
    if len(tick):
        after = np.append(chars, np.zeros(2, np.uint32))
        a, b = after[tick + 1], after[tick + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        start[tick[one | two] + 1] = False
        for some, size in ((one, 2), (two, 3)):
            end = tick[some] + size
            start[end[kind[end] == _LETTER]] = True  # the block ends with a blank
    inside = kind != _SPACE
    utf8 = np.frombuffer(lower.encode(), np.uint8)
    width = 1 + (chars > 0x7F)
    words = np.flatnonzero(start)
    byte_at = np.append(0, np.cumsum(np.where(inside, width, 0)))
    offsets = np.append(byte_at[words], byte_at[-1]).astype(np.int64)
    data = np.ascontiguousarray(utf8[np.repeat(inside, width)])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(words, np.cumsum(sizes), "left")


def gathered(ids: np.ndarray, at: np.ndarray, index: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Of each text the ids of its words, word w having ids[at[w]:at[w + 1]]."""
    counts = np.diff(at)[index]
    first = np.append(0, np.cumsum(counts))
    flat = ids[np.arange(first[-1]) + np.repeat(at[index] - first[:-1], counts)]
    return np.split(flat, first[ends][:-1])
