"""Targets by water filling, and the sample that meets them."""

from collections import defaultdict
from random import Random

import pytest

from tempestry.llm import mixing
from tests.llm.conftest import ODD


def brute_targets(sizes, weights=(3, 1, 2), budget=1.5):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), budget * sum(sizes.values())
    while free:
        unit = rest / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] >= 2 * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        rest -= sum(2 * sizes[s] for s in over)
        free -= over
    return target


def corpus(seed=1, number=1500):
    r = Random(seed)
    rows = []
    for i in range(number):
        source = r.choice(["a", "b", "b", "b", "b", "ä", "Z", None, "zz"])
        rows.append((i, " ".join("w" * r.randrange(1, 400) for _ in range(r.choice([0, 3, 60, 90, 200]))), "en", source))
    return rows + [(5, "one word and a repeated id", "en", "a"), (None, "no id " * 30, "en", "b"), (None, None, "en", "empty"), (9999, "x", "en", "single")]


def test_mix_meets_its_targets(documents):
    rows = corpus()
    got = mixing.mix(documents(rows).repartition(3))
    found = got.collect()
    assert len(found) == len(rows)
    of = {(r[0], len((r[1] or "").split())): r[3] for r in rows}
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in found:
        source = of[(r.doc_id, r.size)]
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
        largest[source] = max(largest[source], r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    want = brute_targets(sizes)
    for source in sizes:
        assert target[source] == pytest.approx(want[source])
        assert abs(taken[source] - want[source]) <= largest[source] / 2 + 1e-6
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, mixing.mix(documents(rows).repartition(7)).collect()), key=str)


def test_seeds_differ_and_short_documents_are_rarer(documents):
    rows = [(i, "w " * (10 if i % 2 else 60), "en", "bulk") for i in range(3000)] + [(10_000, "w " * 90_000, "en", "a")]
    first, second = (mixing.mix(documents(rows), seed) for seed in ("x", "y"))
    assert first.exceptAll(second).count() > 0
    bulk = first.where("doc_id < 10000").groupBy("size").agg({"taken": "sum", "*": "count"}).collect()
    rate = {r.size: r["sum(taken)"] / r.size / r["count(1)"] for r in bulk}
    assert rate[10] < rate[60]


def test_mixed_repeats_rows(documents):
    df = documents(corpus(2))
    out = mixing.mixed(df)
    assert out.columns == df.columns
    counts = {(r.doc_id, r.taken // r.size) for r in mixing.mix(df).collect() if r.size and r.doc_id != 5 and r.doc_id}
    rows = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(rows.get(doc, 0) == copies for doc, copies in counts)


def test_odd_documents(documents):
    got = mixing.mix(documents(ODD)).collect()
    assert len(got) == len(ODD)
    assert mixing.mix(documents(ODD).limit(0)).count() == 0
    empty = mixing.mix(documents([(1, None), (2, "")])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in empty] == [(0, 0, 0.0, 0)] * 2


def test_documents_without_id_are_sampled_one_by_one(documents):
    """Their share taken follows the odds of their class and not their size."""
    r = Random(8)
    rows = [(None, f"{i} " + "w " * (60 + r.randrange(200)), "en", "b") for i in range(900)]
    rows += [(i, "w " * 90, "en", "b") for i in range(300)] + [(5000, "w " * 120_000, "en", "a")]
    got = [x for x in mixing.mix(documents(rows)).collect() if x.doc_id is None]
    rate = lambda some: sum(x.taken / x.size for x in some) / len(some)
    short, long = ([x for x in got if (x.size < 160) == side] for side in (True, False))
    assert len(got) == 900 and 0 < rate(got) < 2 and abs(rate(short) - rate(long)) < 0.12
    assert {x.taken // x.size for x in short} == {x.taken // x.size for x in long} and len({x.taken // x.size for x in short}) == 2
    again = mixing.mix(documents(rows).repartition(5))
    assert sorted((x.size, x.taken) for x in again.where("doc_id IS NULL").collect()) == sorted((x.size, x.taken) for x in got)
