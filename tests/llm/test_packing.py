"""Pieces against the tokenizer itself, and the plan of sequences."""

import zlib
from collections import Counter, defaultdict
from random import Random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tempestry.llm import packing
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TRICKY = st.sampled_from(
    ["Hello", ",", ".", "WORLD", "'ll", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", " ", "\n", "\x1c", "\x85", " ", "é", "é",
     "J̌", "İ", "Σ", "ß", "ẞ", "ſ", "ﬁ", "3", "½", "한", "ا", "\U0001f600", "́", "|", "a", "Z", "ʰ", "ª", "ⅷ", "Ǆ"]
)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@given(st.lists(TRICKY, max_size=12).map("".join))
@settings(deadline=None, max_examples=600)
def test_words_encode_like_their_text(text):
    encode = test_words_encode_like_their_text.encoder
    assert np.frombuffer(encode.of(text.encode()), "<u4").tolist() == ids_of(text)


test_words_encode_like_their_text.encoder = packing.Encoder(PATH)


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 3)
    encode = packing.Encoder(PATH)
    for text in ("one two three four.", "four five one", "Six. one"):
        assert np.frombuffer(encode.of(text.encode()), "<u4").tolist() == ids_of(text)


def check_runs(counts, capacity):
    bins, ranks = defaultdict(list), defaultdict(list)
    for length, first, number, sequence, offset in packing.runs(counts, capacity):
        ranks[length] += range(first, first + number)
        for i in range(number):
            bins[sequence + i].append((offset, length))
    assert {n: len(r) for n, r in ranks.items()} == {n: k for n, k in counts.items() if k}
    assert all(r == list(range(len(r))) for r in ranks.values())
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in held) <= 2
    return len(bins)


@given(st.dictionaries(st.integers(1, 30), st.integers(0, 50)))
@settings(deadline=None, max_examples=300)
def test_runs_are_valid_and_near_the_bound(counts):
    used = check_runs(counts, 30)
    total = sum(n * k for n, k in counts.items())
    assert used <= 11 / 9 * max(-(-total // 30), sum(k for n, k in counts.items() if n > 15)) + 12


def test_runs_of_many_pieces():
    r = Random(3)
    counts = Counter(min(4096, 1 + int(r.expovariate(1 / 900))) for _ in range(50_000))
    assert check_runs(counts, 4096) <= 1.001 * sum(n * k for n, k in counts.items()) / 4096 + 1
    big = packing.runs({n: 10**9 for n in range(1, 4097)})
    assert len(big) < 100_000


@pytest.mark.parametrize("capacity", [16, 4096])
def test_pack(documents, capacity):
    rows = [(r[0], r[1]) for r in ODD] + [(50 + i, " ".join(f"word{j}" for j in range(i % 7))) for i in range(80)]
    got = packing.pack(documents(rows).repartition(4), PATH, capacity=capacity).collect()
    want = Counter()
    for doc, text in rows:
        ids = np.array([*ids_of(text), 1], "<u4")
        for k, start in enumerate(range(0, len(ids), capacity)):
            piece = ids[start : start + capacity]
            want[(doc, k, start, len(piece), zlib.crc32(piece.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity


def test_empty_table(documents):
    assert packing.pack(documents(ODD).limit(0), PATH).count() == 0
