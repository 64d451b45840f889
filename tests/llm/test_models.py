"""The fitted rules of op1 and the pair models of op4 against plain Python."""

import re
from collections import Counter, defaultdict
from math import log
from random import Random

import xxhash

import corpus_pipeline
from tempestry.llm import quality, secrets
from tempestry.llm.common import table
from tests.llm.test_quality import brute as measures
from tests.llm.test_secrets import brute as base_spans

GRID = [round((k / 24) ** 2, 4) for k in range(1, 24)]
RATES = {
    "symbols": lambda n, chars, symbols, lines: symbols / max(symbols + n, 1),
    "lines": lambda n, chars, symbols, lines: lines / (lines + 5.0),
    "long_words": lambda n, chars, symbols, lines: chars / (chars + 10.0 * max(n, 1)),
    "short_words": lambda n, chars, symbols, lines: n / max(n + 0.25 * chars, 1),
}


def plain_verdicts(docs, labels):
    """(doc_id, kept) of (doc_id, text, stratum) rows, and the cut-offs, by counting in dictionaries."""
    judged = defaultdict(list)
    for doc, q in labels:
        if doc is not None and q is not None:
            judged[doc].append(q)
    rows = []
    for doc, text, stratum in docs:
        n, chars, symbols, lines, repeated = measures(text)
        fails = n < 20 or 100 * repeated > 30 * n
        rows.append((doc, text, stratum, fails, {k: f(n, chars, symbols, lines) for k, f in RATES.items()}))
    holdout = {}
    for doc, text, stratum, fails, scores in rows:
        if not fails and judged.get(doc):
            good = max(judged[doc]) > 0
            holdout[stratum, text] = (good or holdout.get((stratum, text), (False,))[0], scores)
    strata = {stratum for stratum, _ in holdout}
    cuts = {}
    for stratum in strata:
        halves = [], []
        for (of, text), row in holdout.items():
            if of == stratum:
                halves[xxhash.xxh64_intdigest((text or "").encode(), 42) % 2].append(row)
        trials = sum(good for good, _ in halves[1])
        # P(X <= k) term by term; the largest k at which it is at most alpha.
        allowed, term, total = -1, 0.97**trials, 0.0
        while (total := total + term) <= 0.05 / len(strata):
            allowed += 1
            term *= (trials - allowed) / (allowed + 1) * 0.03 / 0.97
        cut, passed = dict.fromkeys(RATES, 2.0), None
        above = lambda scores, cut: any(scores[r] > cut[r] for r in RATES)
        while True:
            steps = []
            for k, rule in enumerate(RATES):
                for place in [g for g in GRID if g < cut[rule]]:
                    rows_more = [good for good, scores in halves[0] if not above(scores, cut) and scores[rule] > place]
                    lost, caught = sum(rows_more), len(rows_more) - sum(rows_more)
                    if caught > lost:
                        steps.append((-caught / (lost + 0.5), lost, k, -place, rule))
            if not steps:
                break
            *_, place, rule = min(steps)
            cut = cut | {rule: -place}
            if sum(good for good, scores in halves[1] if above(scores, cut)) > allowed:
                break
            passed = cut
        cuts |= {(stratum, rule): c for rule, c in (passed or {}).items() if c < 2}
    kept = [
        (doc, not fails and not any(scores[r] > cuts.get((stratum, r), 2) for r in RATES)) for doc, _, stratum, fails, scores in rows
    ]
    return Counter(kept), cuts


def test_fitted_rules_equal_plain_python(documents, spark):
    """Each rule has junk of its own, that no other rule sees."""
    r = Random(11)
    word = lambda k: "".join(r.choices("abcdefghijklmnop", k=k))
    junk = {
        "symbols": lambda: " ".join(r.choice("#$&") + word(3) + r.choice("*%") for _ in range(40)),
        "lines": lambda: "\n".join(f"{word(5)} {word(4)} {word(5)}\nsame line" for _ in range(14)),
        "long_words": lambda: " ".join(word(r.randrange(15, 25)) for _ in range(40)),
        "short_words": lambda: " ".join(word(1) + word(r.randrange(2)) for _ in range(40)),
    }
    rows, labels = [], []
    for i in range(4000):
        good = r.random() < 0.6
        text = " ".join(word(r.randrange(4, 7)) for _ in range(40)) if good else junk[r.choice(sorted(junk))]()
        rows.append((i, text, r.choice(["en", "de"]), "s"))
        # Some labels are wrong, some are missing.
        if r.random() < 0.9:
            labels.append((i, int(good != (r.random() < 0.001)), 0))
    docs, labels = documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want, cuts = plain_verdicts(
        [(r.doc_id, r.text, r.lang) for r in docs.collect()], [(r.doc_id, r.quality) for r in labels.collect()]
    )
    assert set(cuts) == {(s, rule) for s in ("en", "de") for rule in RATES}
    assert Counter((r.doc_id, r.kept) for r in quality.judge(docs, labels).collect()) == want
    assert Counter((r.doc_id, True) for r in quality.kept(docs, labels).collect()) == Counter({k: n for k, n in want.items() if k[1]})


def test_first_stage_equals_plain_python(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    want, _ = plain_verdicts(
        [(r.doc_id, r.text, r.lang) for r in docs.collect()], [(r.doc_id, r.quality) for r in labels.collect()]
    )
    got = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir).collect()
    assert Counter((r.doc_id, True) for r in got) == Counter({k: n for k, n in want.items() if k[1]})


def test_every_language_gets_cutoffs(spark):
    """At a tenth of the scale, where the smallest language has some 320 good labels."""
    docs, labels = (table(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    judged = quality.judge(docs, labels).where("NOT base_failed")
    rejected = {r.stratum: r["count"] for r in judged.where("NOT kept").groupBy("stratum").count().collect()}
    assert {"en", "de", "es", "fr"} <= set(rejected)
    good = judged.join(labels.where("quality = 1"), "doc_id").groupBy("stratum").agg({"*": "count"}).collect()
    lost = judged.where("NOT kept").join(labels.where("quality = 1"), "doc_id").groupBy("stratum").agg({"*": "count"}).collect()
    lost = {r.stratum: r["count(1)"] for r in lost}
    assert all(lost.get(r.stratum, 0) <= quality.RISK * r["count(1)"] for r in good)


def test_pair_models_and_random_spans_equal_plain_python(spark, sf_dir, documents):
    r = Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [(x.doc_id, x.text or "") for x in table(spark, sf_dir, "documents").collect()]
    texts = [(i, t + "".join(f" {''.join(r.choices(letters, k=k))} some_{t[:9]}_identifier" for k in (20, 44))) for i, t in texts]
    docs = documents(texts)
    counts = [Counter(), Counter()]
    for label, value in secrets.training_strings(docs).collect():
        counts[label].update(zip(value, value[1:]))
    kind = lambda c: "A" if c.isupper() else "a" if c.islower() else "0" if c.isdigit() else c
    score = {}
    for a in secrets.ALPHABET:
        ordinary, random = ({b: c[a, b] + 0.5 for b in secrets.ALPHABET} for c in counts)
        for b in secrets.ALPHABET:
            alike = [x for x in secrets.ALPHABET if kind(x) == kind(b)]
            o = 0.8 * ordinary[b] + 0.2 * sum(ordinary[x] for x in alike) / len(alike)
            score[a, b] = round(1000 * (log(random[b] / sum(random.values())) - log(o / sum(ordinary.values()))))
    want, seen = Counter(), 0
    for doc, text in texts:
        found = base_spans(text)
        covered = {i for start, _, _, end in found for i in range(start, end)}
        free = "".join(" " if i in covered else c for i, c in enumerate(text))
        runs = [m for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", free) if sum(score[p] for p in zip(m[0], m[0][1:])) >= 5000]
        seen += len(runs)
        spans = sorted(found + [(m.start(), 3, "random", m.end()) for m in runs])
        want[doc, ",".join(f"{name}:{start}:{end}" for start, _, name, end in spans)] += 1
    assert seen > len(texts)
    assert Counter((x.doc_id, x.spans) for x in secrets.scan(docs).collect()) == want
