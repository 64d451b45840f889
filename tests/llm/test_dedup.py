"""Exact, line and substring dedup and near duplicates, against brute force."""

from collections import Counter, defaultdict
from hashlib import sha256
from random import Random

import pytest

from tempestry.llm import dedup_exact, dedup_lines, dedup_substrings, near_dups, twice
from tempestry.llm.common import known_apart
from tempestry.llm.graph import components
from tests.llm.conftest import ODD


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def corpus(seed, number=120, vocabulary=400):
    """Texts with copies, near copies, shared lines and shared passages."""
    r = Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}"
    lines = [" ".join(f"L{i}{word()}" for _ in range(12)) for i in range(4)]
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(number):
        text = "\n".join(" ".join(word() for _ in range(r.randrange(1, 30))) for _ in range(r.randrange(1, 8)))
        if texts and r.random() < 0.15:
            text = r.choice(texts)
        elif texts and r.random() < 0.3:
            words = r.choice(texts).split(" ")
            for _ in range(r.randrange(3)):
                words[r.randrange(len(words))] = word()
            text = " ".join(words)
        if r.random() < 0.3:
            text += "\n  " + r.choice(lines).upper() + " \t"
        if r.random() < 0.2:
            start = r.randrange(26)
            text += " " + " ".join(passage[start : start + r.choice([34, 35, 36, 50])])
        texts.append(text)
    return list(enumerate(texts))


ROWS = ODD + [(i + 100, t) for i, t in corpus(3)]


def test_exact(documents):
    def norm(text):
        return dedup_text.sub(" ", text or "")

    import re

    dedup_text = re.compile(r"[\x20\x09-\x0D]+")
    got = dedup_exact.exact_duplicates(documents(ROWS).repartition(5), fan_in=2).collect()
    groups = defaultdict(list)
    for doc, text in ((r[0], r[1]) for r in ROWS):
        groups[norm(text)].append(doc)
    want = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, keep, len(ids), sha256(text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_rounds():
    assert dedup_exact.rounds(1) == dedup_exact.rounds(16) == [16]
    assert dedup_exact.rounds(17) == dedup_exact.rounds(256) == [16, 256]
    for parts in (1000, 100_000, 3_000_000):
        widths = dedup_exact.rounds(parts)
        assert len(widths) == 2 and widths[-1] >= parts
    assert dedup_exact.rounds(5, 2) == [3, 9]


def test_exact_merges_sorted_runs(documents):
    """Each round sorts and merges: one sorted aggregate before its shuffle and one behind it."""
    plan = dedup_exact.exact_duplicates(documents(ROWS).repartition(20))._jdf.queryExecution().executedPlan().toString()
    merges = [line for line in plan.splitlines() if "SortAggregate(key=[node" in line]
    assert len(merges) == 2 * (1 + len(dedup_exact.rounds(20))) and "Python" not in plan and "Arrow" not in plan


def test_exact_keeps_texts_of_one_digest_apart(documents, monkeypatch):
    """With digests that many texts share, length and second hash still tell texts apart in every round."""
    from pyspark.sql import functions as F

    rows = [(r[0], r[1]) for r in ROWS if r[0] is not None]
    real = F.sha2
    monkeypatch.setattr(dedup_exact.F, "sha2", lambda text, bits: F.lpad(F.pmod(F.xxhash64(text), F.lit(3)).cast("string"), 64, "0"))
    try:
        got = dedup_exact.exact_duplicates(documents(rows).repartition(5), fan_in=2).collect()
    finally:
        monkeypatch.setattr(dedup_exact.F, "sha2", real)
    want = dedup_exact.exact_duplicates(documents(rows)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == Counter((r.doc_id, r.keep_id, r.group_size) for r in want)


def brute_lines(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = defaultdict(list)
    for doc, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= 40:
                holders[k].append(doc)
    last = {k: max(d for d in docs if d is not None) for k, docs in holders.items() if len(docs) >= 5}
    out = Counter()
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [line for line in lines if last.get(key(line), doc) == doc]
        out[(doc, len(lines), len(lines) - len(stay), "\n".join(stay))] += 1
    return out


def test_lines(documents, monkeypatch):
    """In one batch per task and in small ones, with small slices; the lines of a text are hashed once at any size."""
    rows = [(r[0], r[1]) for r in ROWS]
    want = brute_lines(rows)
    assert sum(k[2] for k in want) > 10
    for batch, slices in ((None, twice.SLICE_HASHES), ("20", 10)):
        df = documents(ROWS).repartition(4)
        conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
        calls, lines = [], dedup_lines._lines
        monkeypatch.setattr(dedup_lines, "_lines", lambda shortest: calls.append(shortest) or lines(shortest))
        monkeypatch.setattr(twice, "SLICE_HASHES", slices)
        df.sparkSession.conf.set(conf, batch) if batch else None
        try:
            got = dedup_lines.drop_repeated_lines(df).collect()
        finally:
            df.sparkSession.conf.unset(conf)
            monkeypatch.undo()
        assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got) == want
        assert len(calls) == 1


def test_lines_keep_other_columns(documents):
    df = documents(ROWS)
    got = dedup_lines.without_repeated_lines(df)
    assert got.columns == df.columns and got.drop("text").exceptAll(df.drop("text")).count() == 0


def brute_substrings(rows):
    texts = [(doc, words_of(text)) for doc, text in rows]
    counts = Counter(tuple(w[i : i + 35]) for _, w in texts for i in range(len(w) - 34))
    out = Counter()
    for doc, w in texts:
        gone = set()
        for i in range(len(w) - 34):
            if counts[tuple(w[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        out[(doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))] += 1
    return out


@pytest.mark.parametrize("most", [twice.MOST_FILTER_BYTES, 1000])
def test_substrings(documents, monkeypatch, most):
    monkeypatch.setattr(twice, "MOST_FILTER_BYTES", most)
    rows = [r for r in ROWS if r[0] not in (7, 8)] + [(8, "x y " * 60), (7, " ".join(f"q{i}" for i in range(3000)) + " x")]
    got = dedup_substrings.without_repeats(documents(rows).repartition(4)).collect()
    want = brute_substrings([(r[0], r[1]) for r in rows])
    assert sum(k[2] for k in want) > 300
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want


def brute_components(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = words_of((text or "").translate(lower))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                label[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)].append(doc)
    return Counter(
        (doc, len(sets[i]), min(least[find(i)], default=None) if sets[i] else doc) for i, (doc, _) in enumerate(rows)
    )


@pytest.mark.parametrize("most,group,queries", [(twice.MOST_FILTER_BYTES, 64, 256), (3000, 2, 1)])
def test_near_duplicates(documents, monkeypatch, most, group, queries):
    monkeypatch.setattr(twice, "MOST_FILTER_BYTES", most)
    monkeypatch.setattr(near_dups, "GROUP", group)
    monkeypatch.setattr(near_dups, "TEAM", group)
    monkeypatch.setattr(near_dups, "QUERIES", queries)
    r = Random(5)
    base = [f"b{i}" for i in range(90)]
    rows = [(x[0], x[1]) for x in ROWS]
    for i in range(60):  # a chain of near copies, and copies of one with few changes
        base[r.randrange(90)] = f"c{i}"
        rows.append((1000 + i, " ".join(base)))
    rows += [(2000 + i, " ".join([*base[: r.randrange(60, 90)], *(f"d{i}" for _ in range(3))])) for i in range(40)]
    got = near_dups.similar_documents(documents(rows).repartition(4)).collect()
    want = brute_components(rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def thue_morse(size, first="a", second="b"):
    """A word that polynomial hashes modulo a power of two cannot tell from its complement."""
    return "".join(second if i.bit_count() % 2 else first for i in range(size))


TWINS = [(thue_morse(n), thue_morse(n, "b", "a")) for n in (1024, 4096)]


def test_long_words_of_regular_patterns_are_different(documents):
    rows = []
    for k, twins in enumerate(TWINS):
        rows += [(10 * k + j, " ".join([*(f"s{k}x{i}" for i in range(34)), word])) for j, word in enumerate(twins)]
        rows += [(10 * k + 5 + j, word) for j, word in enumerate(twins)]
        # Passages of two words in the same pattern.
        rows += [(10 * k + 7 + j, " ".join(("u v" if c == "a" else "v u") + f"{k}" for c in word[:64])) for j, word in enumerate(twins)]
    df = documents(rows)
    got = dedup_substrings.without_repeats(df).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_substrings(rows)
    assert all(r.n_removed == 0 for r in got if r.doc_id % 10 < 5)
    got = near_dups.similar_documents(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)


def test_texts_with_one_key_are_told_apart(documents, monkeypatch):
    from pyspark.sql import functions as F

    rows = [(r[0], r[1]) for r in ROWS if r[0] not in (7, 8)]
    monkeypatch.setattr(dedup_substrings, "text_key", lambda text: F.pmod(F.xxhash64(text), F.lit(20)))
    got = dedup_substrings.without_repeats(documents(rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_substrings(rows)


def test_known_apart(spark):
    rows = spark.createDataFrame([(1, 5, 1), (1, 5, 1), (2, 6, 1), (2, 7, 1), (2, 7, 1), (3, 8, 1), (3, 8, 2)], "key long, a long, b int")
    apart, counts = known_apart(rows, "key", ["a", "b"], "test")
    found = apart.collect()
    assert len({(r.key, r.a, r.b) for r in found}) == len({(r.a, r.b) for r in found}) == len({r.key for r in found}) == 5
    assert sorted(r.copies for r in counts.collect()) == [2, 2]
    same, counts = known_apart(rows.where("key = 1"), "key", ["a", "b"], "test")
    assert same.columns == rows.columns and [tuple(r) for r in counts.collect()] == [(1, 2)]


def test_one_of_each(documents):
    df = documents(ROWS)
    got = near_dups.one_of_each(df)
    assert got.columns == df.columns
    want = {(d, c) for d, _, c in brute_components([(r[0], r[1]) for r in ROWS]) if d is not None and d == c}
    assert {r.doc_id for r in got.collect() if r.doc_id is not None} == {d for d, _ in want}


def test_bounds_are_necessary():
    r = Random(1)
    for _ in range(2000):
        n = r.randrange(1, 60)
        a = set(range(n))
        b = {x if r.random() < 0.9 else x + 1000 for x in a} | {2000 + i for i in range(r.randrange(0, n // 4 + 1))}
        if 100 * len(a & b) < 75 * len(a | b):
            continue
        order = list(a | b)
        r.shuffle(order)
        place = {x: i for i, x in enumerate(order)}
        front = [sorted(s, key=place.get)[: near_dups.prefix_length(len(s))] for s in (a, b)]
        assert all(len(set(front[0]) & set(front[1])) >= near_dups.prefix_shared(len(s)) for s in (a, b))
        assert all(len(a & b) >= near_dups.least_shared(len(s)) for s in (a, b))


def test_components(spark):
    r = Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(20)] + [(5, 5), (7, 6)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {x.node: x.label for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_empty_tables(documents):
    none = documents(ODD).limit(0)
    assert dedup_exact.exact_duplicates(none).count() == 0
    assert dedup_lines.drop_repeated_lines(none).count() == 0
    assert dedup_substrings.without_repeats(none).count() == 0
    assert near_dups.similar_documents(none).count() == 0
