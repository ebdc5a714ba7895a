"""BPE round trip, token counts and packing against the libraries and brute force."""

import hashlib
import itertools
import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gaugeworks.llm import bpe, counts, packing
from gaugeworks.llm.tokens import LONG_CHUNK, WordBpe, word_bpe
from tests.llm.conftest import BYTE_BPE, LONG, ROWS, WORD_BPE

PARTS = ["the", "'s", "'re", " ", "  ", "\n", "<|endoftext|>", "<|endof", "é", "日本", "a" * 30, "!!!", "123", "x'll", "　", "😀", " " * 20, "zqxj", "İ", "\x1c", "ǰ"]


def _random_texts(n: int) -> list[str]:
    rnd = random.Random(7)
    texts = []
    for k in range(n):
        if k % 2:
            texts.append("".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))))
        else:
            texts.append("".join(rnd.choice("abcdefg hé'!<|") for _ in range(rnd.randint(0, 300))))
    return texts


@pytest.mark.parametrize("leaf", [5, 40])
def test_tree_concatenation_equals_whole_encoding(leaf):
    library = Tokenizer.from_file(BYTE_BPE)
    for text in _random_texts(400):
        parts = [bpe._encoded(t, BYTE_BPE) for t in bpe.leaves(text, leaf)]
        whole = bpe.encode_in_tree(parts, BYTE_BPE)
        assert whole.ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(whole.ids, BYTE_BPE).decode() == library.decode(whole.ids.tolist(), skip_special_tokens=False) == text


@pytest.mark.parametrize("long", [bpe.LONG, 50])
def test_round_trip(odd, empty, long):
    library = Tokenizer.from_file(BYTE_BPE)

    def wanted(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    found = bpe.round_trip(odd, BYTE_BPE, long=long, leaf=64).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((i, *wanted(t))) for i, t in ROWS)
    nothing = bpe.round_trip(empty, BYTE_BPE, long=long)
    assert nothing.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and nothing.count() == 0


def test_word_ids_equal_the_library():
    encoder, texts = word_bpe(WORD_BPE), [*_random_texts(600), LONG, "the cat's 1st tryCATCH", "Ünïcödé naïve"]
    found = encoder.ids_of(texts)
    for text, ids in zip(texts, found, strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == encoder.library.encode(text, add_special_tokens=False).ids


def test_whole_tokens_encode_alone():
    encoder = word_bpe(WORD_BPE)
    for text, ids in itertools.islice(encoder.whole.items(), 0, None, 500):
        assert encoder.library.encode(text, add_special_tokens=False).ids == [struct.unpack("<I", ids)[0]]


def test_counts(odd, empty):
    library = Tokenizer.from_file(WORD_BPE)
    found = counts.token_counts(odd, WORD_BPE, limit=100).collect()
    wanted = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t in ROWS]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))
    assert counts.token_counts(empty, WORD_BPE).count() == 0


def test_pieces_cut_only_long_documents(odd):
    library = Tokenizer.from_file(WORD_BPE)
    found = sorted(map(repr, map(tuple, packing.pieces(odd, WORD_BPE, capacity=64).collect())))
    wanted = []
    for i, t in ROWS:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            wanted.append(repr((i, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))))
    assert found == sorted(wanted)


def _fewest_bins(sizes, capacity):
    best = len(sizes)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= sizes[k]}.values():
            place(k + 1, [r - sizes[k] * (i == j) for i, r in enumerate(rooms)])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best


def test_bounds_hold_and_bins_are_valid():
    rnd = np.random.default_rng(3)
    for _ in range(150):
        sizes = np.sort(rnd.integers(1, 21, rnd.integers(1, 9)))[::-1]
        bins, offsets = packing.best_fit_decreasing(sizes, 20)
        fewest = _fewest_bins(sizes.tolist(), 20)
        assert packing.lower_bound(sizes, 20) <= fewest <= bins.max() + 1
        for b in range(bins.max() + 1):
            own = np.argsort(offsets[bins == b])
            assert offsets[bins == b][own].tolist() == [0, *np.cumsum(sizes[bins == b][own])[:-1]]
            assert sizes[bins == b].sum() <= 20


@pytest.mark.parametrize("bucket_rows", [20, 100_000])
def test_pack_keeps_every_piece_once(spark, bucket_rows):
    rnd = random.Random(1)
    rows = [(i // 2, i % 2, rnd.choice([64, 40, 33, 31, 24, 8, 3, 1])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    found = packing.pack(df, capacity=64, bucket_rows=bucket_rows).toPandas()
    assert sorted(found[["doc_id", "piece", "length"]].itertuples(index=False, name=None)) == sorted(rows)
    for _, held in found.sort_values("offset").groupby("sequence_id"):
        assert held["offset"].tolist() == [0, *held["length"].cumsum()[:-1]] and held["length"].sum() <= 64
    least = packing.lower_bound(np.array([r[2] for r in rows]), 64)
    assert least <= found["sequence_id"].nunique() <= least + (1 if bucket_rows > 300 else 6)


def test_pack_of_nothing(empty):
    assert packing.pack(packing.pieces(empty, WORD_BPE)).count() == 0


def _resident_mb():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * 4096 / 1e6


def test_long_chunks_do_not_fill_the_memory():
    """20,000 chunks of 8,000 characters without a blank, all distinct."""
    rnd = np.random.default_rng(1)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)
    encoder = word_bpe(WORD_BPE)
    draw = lambda: rnd.choice(letters, 8000).tobytes().decode()
    encoder.ids_of([draw() for _ in range(50)])
    before = _resident_mb()
    for _ in range(400):
        encoder.counts_of([draw() for _ in range(50)])
    assert _resident_mb() - before < 100
    assert not any(len(c) > LONG_CHUNK for c in encoder._counts.known)


def test_what_is_remembered_is_bounded_and_right():
    small, library = WordBpe(WORD_BPE, memory=60_000), Tokenizer.from_file(WORD_BPE)
    texts = [" ".join(f"w{(i * 7919) % 1700}x{i % 13}" for i in range(k, k + 60)) for k in range(0, 6000, 45)] + _random_texts(60)
    for k in range(0, len(texts), 7):
        part = texts[k : k + 7]
        wanted = [library.encode(t, add_special_tokens=False).ids for t in part]
        assert [list(struct.unpack(f"<{len(ids) // 4}I", ids)) for ids in small.ids_of(part)] == wanted
        assert small.counts_of(part) == [len(ids) for ids in wanted]
    for memory in (small._ids, small._counts):
        assert len(memory.known) < 500


def _bins(rows):
    return {b: sorted(r["length"] for r in rows if r["sequence_id"] == b) for b in {r["sequence_id"] for r in rows}}


def test_one_bucket_is_certified(spark):
    df = spark.createDataFrame([(None, 0, x, "clash", 7) for x in [6, 5, 4, 3, 2]], "doc_id long, piece int, length long, sequence_id string, offset int")
    found = packing.pack(df, capacity=10).collect()
    assert all(r["certified"] for r in found) and sorted(_bins(found).values()) == [[2, 3, 5], [4, 6]]
    # Two bins would do (5 3 2, 4 3 3), but best fit takes three.
    gap = packing.pack(spark.createDataFrame([(x,) for x in [5, 4, 3, 3, 3, 2]], "length long"), capacity=10).collect()
    assert len(_bins(gap)) == 3 and [r["certified"] for r in gap if r["length"] == 5] == [False]


def test_exchange_closes_gaps(spark):
    """Each bucket alone leaves a gap; documents exchanged between buckets fill it."""
    rnd = random.Random(3)
    rows = [(i, rnd.choice([700, 650, 400, 350, 300, 250, 90, 20])) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, length long")
    alone = packing.pack(df, capacity=1000, bucket_rows=10**6).collect()
    dealt = packing.pack(df, capacity=1000, bucket_rows=150).collect()
    assert sorted((r["doc_id"], r["length"]) for r in dealt) == rows
    least = packing.lower_bound(np.array([r[1] for r in rows]), 1000)
    # 27 buckets, each with a bin that is not full, would need as many more.
    assert least == len(_bins(alone)) and len(_bins(dealt)) <= least + 4
    assert sum(r["certified"] for r in dealt) > 0.9 * len(rows)
