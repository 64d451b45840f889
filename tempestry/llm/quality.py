"""Quality rules whose cut-offs reject few good documents, as shown on labelled holdouts."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tempestry.llm.common import FEW_ROWS, covered, null_safe_join, saved, share, window_hashes

#: Base rules: fewest words, and most percent of words in repeated windows of WINDOW words.
FEWEST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"

#: Risk: at most this part of the good documents of a stratum is rejected by the learned rules
#: together, in all strata at once with probability 1 - ERROR.
RISK, ERROR = 0.03, 0.05

#: The learned rules, each a badness of a document that is scaled to 0..1: (name, SQL over the base columns). A
#: document is rejected above the rule's cut-off, which is one of GRID, finer where most scores are small.
RULES = (
    ("symbols", "n_symbols / greatest(n_symbols + n_words, 1)"),
    ("lines", "n_dup_lines / (n_dup_lines + 5.0)"),
    ("long_words", "word_chars / (word_chars + 10.0 * greatest(n_words, 1))"),
    ("short_words", "n_words / greatest(n_words + 0.25 * word_chars, 1)"),
)

GRID = tuple(round((k / 24) ** 2, 4) for k in range(1, 24))

_FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _words_repeated(words: list[bytes]) -> int:
    """Words that lie in a window of WINDOW words found twice or more."""
    if len(words) <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    # Each distinct word gets a random-looking number of its own, so windows collide only by their 64-bit hash.
    ids = np.fromiter((known.setdefault(w, len(known) + 1) for w in words), np.uint64, len(words))
    windows = window_hashes(ids * np.uint64(0xC2B2AE3D27D4EB4F), WINDOW)
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[place] > 1)
    return int(covered(starts, WINDOW, len(words)).sum()) if len(starts) else 0


def _features(text: bytes | None) -> tuple[int, int, int, int, int]:
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _words_repeated(words),
    )


def _feature_columns(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(map(_features, texts), columns=[x.split()[0] for x in _FEATURES.split(", ")])


def features(text: Column) -> Column:
    """Struct of the base columns; null text has no words."""
    return pandas_udf(_feature_columns, _FEATURES)(text.cast("binary"))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < FEWEST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def binomial_tail(errors: int, trials: int, rate: float) -> float:
    """P(X <= errors) for X ~ Binomial(trials, rate), by the incomplete beta function."""
    if errors >= trials:
        return 1.0
    a, b, x = trials - errors, errors + 1.0, 1 - rate
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1 - front * _fraction(b, a, 1 - x) / b


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated by modified Lentz steps."""
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    out = d
    for m in range(1, 10_000):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + top * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + top / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return out


def most_errors(trials: int, rate: float, alpha: float) -> int:
    """The largest number of errors in ``trials`` that still shows a rate of at most ``rate`` at level ``alpha``.

    This is the exact (Clopper-Pearson) bound turned round: the upper bound of
    the rate is at most ``rate`` just when P(X <= errors) at ``rate`` is at
    most ``alpha``. -1: not even 0 errors show it.
    """
    low, high = -1, trials
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if binomial_tail(middle, trials, rate) <= alpha else (low, middle)
    return low


def tightened(levels: np.ndarray, good: np.ndarray, bad: np.ndarray) -> Iterator[np.ndarray]:
    """Cut-offs of all rules, by places in GRID, each set stricter than the one before.

    ``levels`` has for each kind of row how many cut-offs each rule's score is
    above, and the other two how many rows of it are good and bad. The next
    step lowers that one cut-off, to that place, which rejects most more bad rows for each more good one
    (counted from a half on), and more bad than good ones. Of equal steps the one of fewer good
    rows, the first rule and the more lenient place is taken.
    """
    places = np.full(levels.shape[1], len(GRID))
    rejected = np.zeros(len(levels), bool)
    while True:
        best, step = None, None
        for rule in range(len(places)):
            for place in range(int(places[rule]) - 1, -1, -1):
                more = ~rejected & (levels[:, rule] > place)
                lost, caught = int(good[more].sum()), int(bad[more].sum())
                value = (Fraction(2 * caught, 2 * lost + 1), -lost)
                if caught > lost and (best is None or value > best):
                    best, step = value, (rule, place)
        if step is None:
            return
        places[step[0]] = step[1]
        rejected = (levels > places).any(axis=1)
        yield places.copy()


def cutoffs(holdout: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stratum, rule, cutoff`` from rows of ``stratum, good, half`` and a score column per rule.

    In each stratum one half of the rows (``half`` 0) proposes a sequence of
    ever stricter cut-offs (``tightened``), and the other half tests it: a step passes if its rejected good rows,
    by all rules together, are so few that the exact bound of their rate is at most ``risk``. Steps are
    tested in their order up to the first that fails, which needs no correction as the sequence was fixed before;
    the last one passed is taken. Strata share the allowed error evenly
    (Bonferroni). A rule without a cut-off has no row here.

    What a stratum's task sees is a count for each combination of cut-offs passed, so it is bounded by the
    grid and not by the rows.
    """
    names = [name for name, _ in RULES]

    def level(name: str) -> Column:
        """How many cut-offs the rule's score is above."""
        return sum((F.col(name) > c).cast("int") for c in GRID).alias(f"level_{name}")

    counts = holdout.groupBy("stratum", "half", *map(level, names)).agg(
        F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")
    )
    strata = holdout.select("stratum").distinct().count()
    alpha = error / max(1, strata)

    def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([f"level_{n}" for n in names])
        tuning, test = (rows[rows["half"] == half] for half in (0, 1))
        levels = lambda df: df[[f"level_{n}" for n in names]].to_numpy()
        good, tested = test["good"].to_numpy(), levels(test)
        allowed = most_errors(int(good.sum()), risk, alpha)
        chosen = None
        for places in tightened(levels(tuning), tuning["good"].to_numpy(), tuning["bad"].to_numpy()):
            if good[(tested > places).any(axis=1)].sum() > allowed:
                break
            chosen = places
        found = [] if chosen is None else [(*key, n, GRID[p]) for n, p in zip(names, chosen) if p < len(GRID)]
        return pd.DataFrame(found, columns=["stratum", "rule", "cutoff"])

    return counts.groupBy("stratum").applyInPandas(choose, "stratum string, rule string, cutoff double")


def _scores(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.expr(f"CAST({sql} AS DOUBLE)") for name, sql in RULES})


def _flat(cut: DataFrame) -> DataFrame:
    """One row per stratum with a column of cut-offs per rule."""
    return cut.groupBy("stratum").agg(
        *(F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"cut_{name}") for name, _ in RULES)
    )


def fit(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Cut-offs, one row per stratum, from the rows of ``docs`` that ``labels`` (``doc_id, quality``) judge.

    ``docs`` has ``doc_id, stratum, check`` and the base columns. A row is bad at
    quality 0 and good otherwise; rows that fail a base rule or have no quality are left
    out. Rows of one stratum with equal texts (``check``, a hash) count once, since copies
    are no independent trials; the hash also deals them to the two halves.
    """
    judged = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    base = [x.split()[0] for x in _FEATURES.split(", ")]
    holdout = (
        docs.where(~F.col("base_failed"))
        .join(judged, "doc_id")
        .groupBy("stratum", "check", *base)
        .agg((F.max("quality") > 0).alias("good"))
        .withColumn("half", F.pmod("check", F.lit(2)).cast("int"))
    )
    return saved(_flat(cutoffs(_scores(holdout), risk, error)), "quality-cutoffs")


def _judged(df: DataFrame, cut: DataFrame) -> DataFrame:
    """``df`` with ``kept``: passes the base rules and is above no cut-off of its stratum."""
    joined = null_safe_join(_scores(df), share(cut, FEW_ROWS), ["stratum"], "left")
    above = F.lit(False)
    for name, _ in RULES:
        above = above | F.coalesce(F.col(name) > F.col(f"cut_{name}"), F.lit(False))
    names = [name for name, _ in RULES] + [f"cut_{name}" for name, _ in RULES]
    return joined.withColumn("kept", ~F.col("base_failed") & ~above).drop(*names)


def _measured(docs: DataFrame, carry: list[Column], stratum_col: str, id_col: str, text_col: str) -> DataFrame:
    base = [x.split()[0] for x in _FEATURES.split(", ")]
    rows = docs.select(
        *carry,
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(stratum_col).cast("string").alias("stratum"),
        F.xxhash64(F.col(text_col)).alias("check"),
        features(F.col(text_col)).alias("measured"),
    ).select("*", *(f"measured.{c}" for c in base))
    return rows.drop("measured").withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))


def judge(
    docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Base columns and verdict of every document.

    Returns ``doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept``, one row per input row. Null and empty
    texts have no words and fail. A null stratum is a stratum of its own; one
    without a certified cut-off rejects by the base rules only. Null ids have
    no labels. Repeated rows get the same verdict. Empty tables give no rows,
    and without labels the base rules decide. Further columns are ignored.
    """
    measured = saved(_measured(docs, [], stratum_col, id_col, text_col), "quality")
    return _judged(measured, fit(measured, labels)).drop("check")


def kept(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns.

    The texts are measured a second time here, which needs no disk for a copy of them.
    """
    cut = fit(saved(_measured(docs, [], stratum_col, id_col, text_col), "quality"), labels)
    row = F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")
    return _judged(_measured(docs, [row], stratum_col, id_col, text_col), cut).where("kept").select("row.*")
