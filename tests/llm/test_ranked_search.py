"""Ranked search by K2-treaps, against all documents scored by the definition."""

import re
from collections import Counter
from math import floor, log
from random import Random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tempestry.llm import ranked_search as rs
from tests.llm.conftest import ODD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=20):
    counted = [(d, Counter(terms_of(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    number, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    out = Counter()
    for item, text in {(i, t) for i, t in items}:
        asked = Counter(terms_of(text))
        scored = []
        for doc, c in counted:
            m = 75 + 25 * c.total() * number // total
            score = 0
            for term, times in asked.items():
                if tf := c.get(term):
                    w = floor(1000 * log((2 * number + 2) / (2 * df[term] + 1)))
                    score += times * w * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scored)[:best], 1):
            out[(item, rank, None if none else doc, -score)] += 1
    return out


def corpus(seed, number):
    r = Random(seed)
    word = lambda: f"W{int(r.paretovariate(0.6)) % 900}é"
    docs = [(i, " ".join(word() for _ in range(r.randrange(1, 60)))) for i in range(number)]
    docs += [(number + i, docs[i % 7][1]) for i in range(60)]  # copies, so that scores tie
    r.shuffle(docs)
    return docs


def item_table(spark, items):
    return spark.createDataFrame([(*i, "x", 1, 2) for i in items], "item_id long, text string, term string, item long, rank int")


@pytest.mark.parametrize("terms,docs,opened,most", [(rs.BLOCK_TERMS, rs.BLOCK_DOCS, rs.OPENED, rs.MOST_TERMS), (400, 9, 2, 30)])
def test_equals_the_definition(spark, documents, monkeypatch, terms, docs, opened, most):
    for name, value in (("BLOCK_TERMS", terms), ("BLOCK_DOCS", docs), ("OPENED", opened), ("MOST_TERMS", most)):
        monkeypatch.setattr(rs, name, value)
    rows = [(r[0], r[1]) for r in ODD] + [(d + 100, t) for d, t in corpus(2, 250)]
    r = Random(9)
    items = [(i, " ".join(r.choice(rows[20:])[1].split()[:12])) for i in range(25)]
    items += [(1, items[1][1]), (70, None), (71, " .,- "), (72, "nowhere to be found"), (73, rows[40][1]), (None, rows[41][1]), (74, "W1É w1é 😀 naïve")]
    found = rs.rank_documents(documents(rows).repartition(3), item_table(spark, items))
    got = Counter(tuple(x) for x in found.select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute(rows, items)


def test_empty_tables(spark, documents):
    items = item_table(spark, [(1, "a b")])
    assert rs.rank_documents(documents(ODD).limit(0), items).count() == 0
    assert rs.rank_documents(documents(ODD[:3]), items).count() == 0
    assert rs.rank_documents(documents(ODD), items.limit(0)).count() == 0


@given(st.text(alphabet=st.sampled_from(list("aZ09 -_éÉ[`{\x00\x7f\x80 ß😀")), max_size=40))
@settings(deadline=None, max_examples=300)
def test_terms(text):
    found = rs.term_hashes(text.encode())
    assert found.tolist() == [rs.word_hashes(t.encode())[0] for t in terms_of(text)]


@given(st.integers(1, 6), st.lists(st.tuples(st.integers(0, 63), st.integers(0, 63), st.integers(1, 1 << 19)), max_size=80))
@settings(deadline=None)
def test_treap_holds_cells_and_maxima(bits, cells):
    size = 1 << bits
    held = {(r % size, c % size): v for r, c, v in cells}
    rows, columns, impacts = (np.array(x, np.int64) for x in (zip(*[(r, c, v) for (r, c), v in held.items()]) if held else ([], [], [])))
    built = rs.build_treap(rows, columns, impacts, bits)
    levels = rs.loaded(rs.stored(built))
    assert len(levels) == bits + 1
    for one, two in zip(built, levels):
        assert one.largest.tolist() == two.largest.tolist() and one.mask.tolist() == two.mask.tolist()
    for depth, level in enumerate(levels):
        side = bits - depth
        largest = {}
        for (r, c), v in held.items():
            key = (r >> side, c >> side)
            largest[key] = max(largest.get(key, 0), v)
        assert sorted(level.largest.tolist()) == sorted(largest.values())


def test_search_opens_few_ranges(monkeypatch):
    """One document that holds rare terms is found without opening most of the others."""
    r = np.random.default_rng(1)
    docs = [(i, r.integers(0, 1 << 62, 30, dtype=np.uint64)) for i in range(4096)]
    block = rs.build_block(docs, len(docs), sum(len(h) for _, h in docs))
    names = np.frombuffer(block["terms"], "<u8")
    levels = rs.loaded(zip(block["masks"], block["drops"]))
    rows = np.flatnonzero(np.isin(names, docs[77][1][:10]))
    opened = []
    concatenate = np.concatenate
    monkeypatch.setattr(rs, "OPENED", 4)
    monkeypatch.setattr(rs.np, "concatenate", lambda parts, *a: opened.append(sum(map(len, parts))) or concatenate(parts, *a))
    found = rs.best_documents(levels, rows, np.full(len(rows), 5), np.arange(4096), best=1)
    assert [f[1] for f in found] == [77] and len(opened) < 1500
