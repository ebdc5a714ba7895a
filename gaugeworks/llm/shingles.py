"""Word shingles of many texts as 64-bit hashes, without a step per word.

Words are what ASCII white space leaves; A-Z count as a-z. A word's hash is a polynomial
over random values of its bytes, taken from prefix sums; a shingle's hash mixes those of
its words in order. Equal shingles have equal hashes; two different ones share a hash
with a chance of about 2^-63.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np

WORDS = 5
_SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of text handled at a time; a longer text is handled alone.
_BLOCK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C17)  # 3 modulo 4, so that it minus 1 has a single factor 2


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256)
    lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    return mix(lower.astype(np.uint64) * _ODD + np.uint64(1)), np.isin(codes, list(_SPACES))


_VALUE, _IS_SPACE = _byte_values()
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, from 0 to n - 1."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, _BLOCK + (1 << 16))
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        _powers = tuple(np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)]) for base in (_ODD, inverse))
    return _powers


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where those of each text begin, with the end."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    up, down = _power_tables(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * up[: len(data)])])
    inside = np.concatenate([[False], ~_IS_SPACE[data], [False]])
    steps = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = steps[0::2], steps[1::2]
    word = mix((sums[stops] - sums[starts]) * down[starts])
    text_starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return word, np.searchsorted(starts, text_starts)


def _block(texts: list[bytes], words: int) -> list[np.ndarray]:
    word, bounds = _words(texts)
    n = max(len(word) - words + 1, 0)
    rolled = np.full(n, np.uint64(words))
    for i in range(words):
        rolled = mix(rolled * _ODD + word[i : i + n])
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if high - low >= words:
            out.append(np.unique(rolled[low : high - words + 1]))
        elif high > low:
            one = np.full(1, np.uint64(high - low))
            for w in word[low:high]:
                one = mix(one * _ODD + w)
            out.append(one)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Per text its distinct shingles, ascending. Fewer words than that count as one shingle, none as no shingle."""
    return [s for block in _blocks(texts) for s in _quiet(_block, block, words)]


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Per text the hashes of its words in order; A-Z count as a-z."""
    out = []
    for block in _blocks(texts):
        word, bounds = _quiet(_words, block)
        out += [word[low:high] for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return out


def _quiet(function: Callable, *arguments: object) -> Any:
    with np.errstate(over="ignore"):
        return function(*arguments)


def _blocks(texts: list[str | None]) -> Iterator[list[bytes]]:
    block, held = [], 0
    for text in texts:
        raw = (text or "").encode("utf-8")
        if block and held + len(raw) > _BLOCK:
            yield block
            block, held = [], 0
        block.append(raw)
        held += len(raw)
    if block:
        yield block


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    with np.errstate(over="ignore"):
        place = np.arange(1, len(shingles) + 1, dtype=np.uint64) * _ODD
        return int(mix(np.array([mix(shingles + place).sum(dtype=np.uint64) + np.uint64(len(shingles))])).astype(np.int64)[0])
