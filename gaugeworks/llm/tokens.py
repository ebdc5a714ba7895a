"""Exact encoders over public tokenizer files, with a cache of what was met before.

Both vocabularies are read from the tokenizer file a caller names. Encoders are built
once per Python worker and kept there; what they remember is bounded in bytes.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from itertools import compress

import numpy as np
import regex
import tiktoken
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

#: How a byte-level vocabulary writes the 256 bytes: printable ones as themselves, the others from 256 on.
_PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
_OTHERS = [b for b in range(256) if b not in set(_PRINTABLE)]
BYTE_SIGN = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(_OTHERS)}
SIGN_BYTE = {sign: b for b, sign in BYTE_SIGN.items()}

#: Fixed value: the split pattern of the byte-level vocabulary.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: the split pattern of the word-end vocabulary, over lower-cased text.
WORD_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: The same with line ends, which part the chunks of one call.
CHUNKS_PATTERN = regex.compile(WORD_PATTERN.pattern + r"|\n")

#: White space for Python, but not for the split patterns.
_ODD_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")


def _sign_bytes(token: str) -> bytes:
    return bytes(SIGN_BYTE[c] for c in token)


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> tiktoken.Encoding:
    """Byte-level vocabulary as a rank encoder. Special strings in a text become their ids."""
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    special = {x["content"]: x["id"] for x in parsed["added_tokens"]}
    ranks = {_sign_bytes(t): i for t, i in parsed["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=4)
def byte_bpe_bytes(path: str) -> tuple[bytes, ...]:
    """The bytes of every id."""
    encoder = byte_bpe(path)
    return tuple(encoder.decode_single_token_bytes(i) for i in range(encoder.n_vocab))


#: Longer chunks, in characters, are not remembered: words are shorter, and texts without blanks would fill the memory.
LONG_CHUNK = 64
#: Bytes that remembered chunks may take in a worker, by estimate, for ids and for counts; a job uses one of them.
MEMORY = 120 << 20
_ENTRY = 220  # of a remembered chunk and its ids or count, besides their characters and bytes


class _Memory:
    """Chunks and their values; when they have taken ``size`` bytes, the memory starts anew."""

    def __init__(self, size: int):
        self.size, self.held = size, 0
        self.known: dict[str, bytes | int] = {}

    def keep(self, values: dict[str, bytes | int]) -> None:
        self.known.update(values)
        self.held += _ENTRY * len(values) + sum(map(len, values))
        self.held += sum([len(v) for v in values.values() if isinstance(v, bytes)])

    def shed(self) -> None:
        if self.held > self.size:
            self.known, self.held = {}, 0


@dataclass(frozen=True)
class Proof:
    """What the library was seen to do: characters that it splits as the pattern here does, and entries that encode alone as one id."""

    plain: frozenset[str]
    whole: dict[str, bytes]


class WordBpe:
    """Word-end vocabulary: ids or their number, chunk by chunk.

    A pre-token never holds white space and the split pattern looks at nothing outside
    a match, so a text's ids are those of its white-space-separated chunks in order.
    Chunks of ordinary length are remembered in ``memory`` bytes; a new one
    is split into pre-tokens, which are merged by rank. Where only numbers of ids are
    asked for, a pre-token that is a *whole token* counts as one without merging.

    Whole tokens are proved, not assumed: every vocabulary entry that ends a word is
    encoded alone by the library and kept if just its own id comes back. The proof is made
    once, on the driver, and handed to the workers.

    Chunks with characters outside the proved alphabet, texts with special strings and
    texts with separators on which Python and the library differ go to the library
    whole, so they are right by definition.
    """

    def __init__(self, path: str, proof: Proof | None = None, memory: int = MEMORY):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self._ids, self._counts = _Memory(memory), _Memory(memory)
        self._merge_ranks = self._word_end_ranks()
        self._ends = np.zeros(self._merge_ranks.n_vocab, bool)
        self._ends[[i for t, i in self.library.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True
        self._line_end = self._merge_ranks.encode_single_token(b"\n ")
        self._plain = proof.plain if proof else self._proved_alphabet()
        self.whole = proof.whole if proof else self._whole_tokens()

    def _word_end_ranks(self) -> tiktoken.Encoding:
        """The merges by rank, with a space for the end of a word: no pre-token holds one.

        Ids of merged entries rise in the order of the merges, so they are the ranks.
        The space itself is never left over, as every sign has an entry that ends a word.
        """
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        ranks = {b" ": max(vocabulary.values()) + len(self.special) + 1}
        for token, i in vocabulary.items():
            if token not in self.special:
                ends = token.endswith("</w>")
                ranks[_sign_bytes(token[:-4]) + b" " if ends else _sign_bytes(token)] = i
        return tiktoken.Encoding("word_bpe", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def _proved_alphabet(self) -> frozenset[str]:
        """Characters below U+0250 that the library normalizes and splits as the pattern here does.

        A character counts if the library gives the same ids as this class's own way
        for it alone and between letters, digits and signs.
        """
        plain = set()
        for code in range(33, 0x250):
            sign = chr(code)
            if sign.isspace() or sign in _ODD_SPACES:
                continue
            probes = (sign, f"a{sign}b", f"1{sign}2", f"!{sign}?", f"{sign}{sign}", f"'{sign}")
            if all(self._merged(p) == self._library(p) for p in probes):
                plain.add(sign)
        return frozenset(plain)

    def _whole_tokens(self) -> dict[str, bytes]:
        """Pre-token to id, for every vocabulary entry that the library encodes alone as itself."""
        entries = []
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            if token.endswith("</w>"):
                try:
                    text = _sign_bytes(token[:-4]).decode("utf-8")
                except (UnicodeDecodeError, KeyError):
                    continue
                if text and self._plain.issuperset(text) and WORD_PATTERN.findall(text.lower()) == [text]:
                    entries.append((text, i))
        found = self.library.encode_batch_fast([t for t, _ in entries], add_special_tokens=False)
        return {t: struct.pack("<I", i) for (t, i), e in zip(entries, found, strict=True) if e.ids == [i]}

    def _library(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merge(self, pretoken: str) -> bytes:
        ids = self._merge_ranks.encode_ordinary(pretoken + " ")
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merged(self, chunk: str) -> bytes:
        return b"".join(self._merge(p) for p in WORD_PATTERN.findall(chunk.lower()))

    def _values(self, chunks: set[str], counted: bool) -> dict[str, bytes | int]:
        """Ids of the chunks, or only how many.

        Proved chunks are split and merged in one go, with a line end after each: it is a
        pre-token of its own that no chunk holds.
        """
        plain = self._plain
        if plain.issuperset(set("".join(chunks))):
            proved, found = list(chunks), {}
        else:
            proved, found = [], {}
            for chunk in chunks:
                if plain.issuperset(chunk):
                    proved.append(chunk)
                else:
                    ids = self._library(chunk)
                    found[chunk] = len(ids) // 4 if counted else ids
        if not proved:
            return found
        pretokens = CHUNKS_PATTERN.findall("\n".join(proved).lower() + "\n")
        if counted:
            # Whole tokens count one, line ends none, only the rest is merged.
            ends = np.fromiter(map("\n".__eq__, pretokens), bool, len(pretokens))
            rest = ~(np.fromiter(map(self.whole.__contains__, pretokens), bool, len(pretokens)) | ends)
            sizes = np.ones(len(pretokens), np.int64)
            sizes[ends] = 0
            sizes[rest] = self._sizes(list(compress(pretokens, rest.tolist())))
            found.update(zip(proved, np.diff(np.cumsum(sizes)[ends], prepend=0).tolist(), strict=True))
        else:
            ids = self._merge_ranks.encode_to_numpy(" ".join(pretokens) + " ").astype("<u4")
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(ids == self._line_end)).tolist()
            starts = [0, *[end + 4 for end in ends]]
            found.update({c: raw[i:j] for c, i, j in zip(proved, starts, ends)})
        return found

    def _sizes(self, pretokens: list[str]) -> np.ndarray:
        """Per pre-token the number of its ids; all are merged together."""
        if not pretokens:
            return np.zeros(0, np.int64)
        ids = self._merge_ranks.encode_to_numpy(" ".join(pretokens) + " ")
        return np.diff(np.flatnonzero(self._ends[ids]) + 1, prepend=0)

    def _each(self, texts: list[str | None], counted: bool) -> list:
        memory, add = (self._counts, sum) if counted else (self._ids, b"".join)
        out: list = [0 if counted else b""] * len(texts)
        split: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if text and (any(s in text for s in self.special) or any(s in text for s in _ODD_SPACES)):
                ids = self._library(text)
                out[i] = len(ids) // 4 if counted else ids
            elif text:
                split[i] = text.split()
        found = self._values(set().union(*split.values()).difference(memory.known), counted)
        once = {chunk: found.pop(chunk) for chunk in [c for c in found if len(c) > LONG_CHUNK]}
        memory.keep(found)
        known = memory.known
        for i, chunks in split.items():
            out[i] = add([once[c] if c in once else known[c] for c in chunks]) if once else add(map(known.__getitem__, chunks))
        memory.shed()
        return out

    def ids_of(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers; null and empty give none."""
        return self._each(texts, counted=False)

    def counts_of(self, texts: list[str | None]) -> list[int]:
        """Per text the number of its ids, added up without making them."""
        return self._each(texts, counted=True)


_workers: dict[str, WordBpe] = {}


def word_bpe(path: str, proof: Proof | None = None) -> WordBpe:
    """This process's encoder of a tokenizer file."""
    if path not in _workers:
        _workers[path] = WordBpe(path, proof)
    return _workers[path]


def shared_word_bpe(spark: SparkSession, path: str) -> Callable[[], WordBpe]:
    """For tasks: gives the worker's encoder, with the proof made here. What is sent follows the vocabulary alone, about 2 MB."""
    encoder = word_bpe(path)
    proof = spark.sparkContext.broadcast(Proof(encoder._plain, encoder.whole))
    return lambda: word_bpe(path, proof.value)
