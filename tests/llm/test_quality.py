"""Base measures against brute force, exact bounds, and the risk of learned cut-offs."""

from collections import Counter
from math import comb
from random import Random

import numpy as np
import pytest

from tempestry.llm import quality
from tests.llm.conftest import ODD


def brute(text):
    words = [w.decode() for w in (text or "").encode().split()]
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def texts():
    r = Random(4)
    for i in range(60):
        yield "".join(r.choice(["a", "bb ", "é", "#", "\n", " ", "\t", "x y z ", "\x1c", " "]) for _ in range(r.randrange(200)))
    yield "one two three four five six seven eight " * 3
    yield "same line\nsame line\n same line\n\n\n"


def test_features():
    for text in [t for _, t, *_ in ODD if t is None or len(t) < 1000] + list(texts()):
        assert quality._features(None if text is None else text.encode()) == brute(text)


@pytest.mark.parametrize("trials", [1, 7, 40, 333])
def test_binomial_tail_is_exact(trials):
    for rate in (0.001, 0.03, 0.4):
        for errors in range(0, trials + 1, max(1, trials // 9)):
            want = sum(comb(trials, k) * rate**k * (1 - rate) ** (trials - k) for k in range(errors + 1))
            assert abs(quality.binomial_tail(errors, trials, rate) - want) < 1e-9


def test_most_errors_is_the_largest_that_shows_the_rate():
    for trials in (5, 300, 5000):
        k = quality.most_errors(trials, 0.02, 0.01)
        assert k < 0 or quality.binomial_tail(k, trials, 0.02) <= 0.01
        assert quality.binomial_tail(k + 1, trials, 0.02) > 0.01


def labelled(documents, spark, seed, number=6000, flip=0.0):
    """Good prose and junk full of symbols, in two languages; ``flip`` of the labels are wrong."""
    r = Random(seed)
    rows, labels = [], []
    for i in range(number):
        good = r.random() < 0.8
        words = [f"word{r.randrange(900)}" for _ in range(30 + r.randrange(20))]
        if not good:
            words = [w + r.choice(["###", "$$$", "&&&"]) for w in words]
        rows.append((i, " ".join(words), r.choice(["en", "de"]), "s"))
        labels.append((i, int(good != (r.random() < flip)), 0))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_junk_goes_and_good_documents_stay(documents, spark):
    docs, labels = labelled(documents, spark, 1)
    got = quality.judge(docs, labels).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    count = {(r.quality, r.kept): r["count"] for r in got}
    assert count.get((1, False), 0) <= quality.RISK * sum(v for k, v in count.items() if k[0] == 1)
    assert count.get((0, True), 0) == 0 and count[(0, False)] > 500
    kept = quality.kept(docs, labels)
    assert kept.columns == docs.columns and kept.count() == count[(1, True)]


def test_the_risk_holds_in_simulations(spark):
    """Two strata of many simulated tables in which good and bad scores overlap: how often any rejects more than the risk."""
    r = np.random.default_rng(5)
    tables, names = 120, [name for name, _ in quality.RULES]
    rows, limits = [], {}
    for table in range(tables):
        for stratum in range(2):
            number = 700
            good = r.random(number) < 0.7
            # Each rule's score of good rows is uniform below 0.9, so its true rate of false rejection is known.
            scores = np.where(good[:, None], 0.9 * r.random((number, 4)), 0.75 + 0.25 * r.random((number, 4)))
            rows += [(f"{table}-{stratum}", bool(g), k % 2, *map(float, s)) for k, (g, s) in enumerate(zip(good, scores))]
    schema = "stratum string, good boolean, half int, " + ", ".join(f"{n} double" for n in names)
    # Each simulated table has two strata, hence the error of each.
    found = quality.cutoffs(spark.createDataFrame(rows, schema), quality.RISK, quality.ERROR / 2 * 2 * tables).collect()
    for row in found:
        limits.setdefault(row.stratum, []).append(row.cutoff)
    rate = {s: 1 - np.prod([min(1.0, c / 0.9) for c in cuts]) for s, cuts in limits.items()}
    broken = {s.split("-")[0] for s, false in rate.items() if false > quality.RISK}
    assert len(limits) > tables and len(broken) <= quality.ERROR * tables + 3 * (tables * quality.ERROR) ** 0.5


def test_no_cutoff_without_evidence(documents, spark):
    docs, labels = labelled(documents, spark, 2, number=250)
    assert quality.judge(docs, labels).where("not kept").count() == 0
    # Labels that say nothing about the text cannot show that a cut-off is safe.
    docs, labels = labelled(documents, spark, 3, flip=0.5)
    judged = quality.judge(docs, labels).join(labels, "doc_id").where("quality = 1")
    assert judged.where("not kept").count() <= quality.RISK * judged.count()


def test_odd_documents(documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.judge(documents(ODD), none).collect()
    assert len(got) == len(ODD)
    for r in got:
        if r.doc_id in (1, 2, 3, 4, 5, 6, 10, None):
            assert r.base_failed and not r.kept
        if r.doc_id in (7, 8):
            assert r.n_words >= 60_000
    assert quality.judge(documents(ODD).limit(0), none).count() == 0
