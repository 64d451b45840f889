"""Words, hashes and filters that the operators share."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tempestry.llm import common, twice
from tempestry.llm.dedup_substrings import COVER, PERIOD, anchor_places


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(1, 20))
@settings(deadline=None)
def test_windows_hash_alike_just_when_their_words_are_alike(words, width):
    hashes = common.window_hashes(common.word_hashes(b" ".join(words)), width)
    windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    assert len(hashes) == len(windows)
    assert len(set(hashes.tolist())) == len(set(windows))
    assert len(set(zip(hashes.tolist(), windows))) == len(set(windows))


@given(st.lists(st.sampled_from([b"a", b"\xc3\xa9", b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b"\x00", b"\x1c", b"bc"]), max_size=40).map(b"".join))
@settings(deadline=None, max_examples=300)
def test_word_hashes_follow_the_words(text):
    whole = common.word_hashes(text)
    assert whole.tolist() == [common.word_hashes(w)[0] for w in text.split()]
    before, common.PART_BYTES = common.PART_BYTES, 3
    try:
        assert common.word_hashes(text).tolist() == whole.tolist()
    finally:
        common.PART_BYTES = before


def test_different_words_have_different_hashes():
    words = [b"%d" % i for i in range(100_000)] + [b"\x00" * i for i in range(1, 50)] + [b"a" * i for i in range(1, 50)]
    assert len(set(common.word_hashes(b" ".join(words)).tolist())) == len(words)


@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from([b"a", b"B", b"cc", b" ", b"\n", b"\t"]), max_size=12).map(b"".join)), max_size=8), st.integers(1, 4))
@settings(deadline=None)
def test_texts_hashed_together_are_as_hashed_alone(texts, width):
    for lower in (False, True):
        found = list(common.hashed_texts(texts, width, lower))
        assert [t for t, _, _ in found] == [t or b"" for t in texts]
        for text, hashes, windows in found:
            alone = common.word_hashes(text.lower() if lower else text)
            assert hashes.tolist() == alone.tolist() and windows.tolist() == common.window_hashes(alone, width).tolist()


def test_seeds_are_independent():
    words = [b"%d" % i for i in range(50_000)] + [b"a" * i for i in range(1, 200)]
    one, two = (common.word_hashes(b" ".join(words), seed) for seed in (0, 5))
    assert len(set(one.tolist()) | set(two.tolist())) == 2 * len(words)
    assert abs(np.bitwise_count(one ^ two).mean() - 32) < 0.2


def test_covered():
    assert common.covered(np.array([1, 2]), 2, 6).tolist() == [False, True, True, True, False, False]


def test_cover_gives_every_pair_of_positions_a_shared_shift():
    for i in range(PERIOD):
        for j in range(PERIOD):
            assert any((i + s) % PERIOD in COVER and (j + s) % PERIOD in COVER for s in range(PERIOD))


def test_every_passage_holds_an_anchor():
    for n in (35, 36, 60, 100):
        places = set(anchor_places(n).tolist())
        assert all(any(s + d in places for d in range(PERIOD)) for s in range(n - 34))


def test_filters_hold_all_repeated_hashes_and_few_others(spark, monkeypatch):
    number = 20_000
    rows = spark.range(number).selectExpr("xxhash64(id) AS hash").repartition(5)
    again = spark.range(0, number, 10).selectExpr("xxhash64(id) AS hash")
    known = np.array([r.hash for r in again.collect()]).view(np.uint64)
    others = np.array([r.hash for r in rows.exceptAll(again).collect()]).view(np.uint64)
    found = twice.seen_twice(rows.unionByName(again), number, "test")
    assert found.may_repeat(known).all() and found.may_repeat(others).mean() < 0.1
    monkeypatch.setattr(twice, "MOST_FILTER_BYTES", 2000)
    assert twice.seen_twice(rows.unionByName(again), number, "test") is None


def test_repeats_are_all_rows_of_repeated_hashes_and_few_others(spark, monkeypatch):
    """One hash of a third of all rows, among others."""
    monkeypatch.setattr(twice, "SLICE_HASHES", 500)
    ids = spark.range(30_000).repartition(6)
    hashes = ids.selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN xxhash64(id div 100) ELSE xxhash64(-id) END AS hash", "id AS key")

    def run(batches):
        for batch in batches:
            yield twice.told(batch.column("hash").to_numpy().view(np.uint64), batch.column("key").to_numpy())

    found = {(r.hash, r.key) for r in twice.repeats(hashes.mapInArrow(run, twice.KEYED), "test").collect()}
    held = [(r.hash, r.key) for r in hashes.collect()]
    counts = {}
    for value, _ in held:
        counts[value] = counts.get(value, 0) + 1
    several = {row for row in held if counts[row[0]] > 1}
    assert len(several) > 10_000 and several <= found <= set(held) and len(found - several) < 0.02 * len(held)


def test_folded_keeps_what_a_filter_holds():
    bits = np.zeros(1 << 12, np.uint8)
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 50, dtype=np.uint64)
    twice._put(bits, hashes)
    small = twice.folded(bits)
    assert len(small) < len(bits) and twice._has(small, hashes).all()


def test_repeated_within_holds_all_repeated_hashes_and_few_others():
    r = np.random.default_rng(3)
    for number, step in ((0, 10), (1, 10), (5, 1), (30_000, 1000), (30_000, 100_000)):
        hashes = r.integers(0, 1 << 63, number, dtype=np.uint64)
        hashes = np.concatenate([hashes, hashes[::7], hashes[:: number or 1]])
        r.shuffle(hashes)
        _, place, count = np.unique(hashes, return_inverse=True, return_counts=True)
        found = twice.repeated_within(hashes, step)
        assert found[count[place] > 1].all() and found[count[place] == 1].mean() < 0.01 if number > 9 else found[count[place] > 1].all()
