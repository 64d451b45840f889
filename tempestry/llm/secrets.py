"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

DataFrame functions only; a training run collects one table of character pairs.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of the base kinds in listed order (fixed values): name, pattern, group that is the
#: secret, and fewest characters of that group.
KINDS = (
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    # A match of either is a whole run, or the rest of one, so asking for its length in the pattern
    # finds the same spans as dropping shorter matches would.
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)

#: Characters of the models, and strings that are scored: runs of at least this many of them.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SHORTEST_RUN = 20
#: Ordinary strings of the training sample are runs of at least this many characters of the alphabet, of which it
#: takes so many, and strings made of so many words of a document.
SHORTEST_ORDINARY, MOST_OF_RUN, MADE_OF_WORDS = 8, 64, 12
#: Documents of the training sample, in expectation (all of a smaller table).
SAMPLE_DOCS = 20_000
#: Count added to each pair, and the log-likelihood ratio from which a string is a secret.
SMOOTHING, THRESHOLD = 0.5, 5.0
#: Share of the ordinary model that knows only the classes of the next character: capitals, small letters, digits, and
#: each other sign. It bounds what letters that the corpus never has side by side say for a secret.
BACK_OFF = 0.2
CLASSES = tuple("A" if c.isupper() else "a" if c.islower() else "0" if c.isdigit() else c for c in ALPHABET)

SPAN = "struct<start:int,rank:int,kind:string,end:int>"


def _spans(text: Column, kind: str, rank: int, pattern: str, group: int = 0, fewest: int = 1) -> Column:
    """Spans of a pattern's leftmost matches, in code points, without those of too few characters.

    The text between the matches, which a split gives, and the matches
    themselves have the lengths that add up to the positions.
    """
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    secret = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.size(whole)), F.length).alias("gap"),
        F.transform(whole, F.length).alias("whole"),
        F.transform(secret, F.length).alias("secret"),
    )
    none = F.array().cast(f"array<{SPAN}>")

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + part["whole"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))
        found = F.when(part["secret"] >= fewest, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    found = F.aggregate(parts, start, add, lambda state: state["found"])
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind."""
    return {
        kind: _spans(text, kind, rank, pattern, group, fewest)
        for rank, (kind, pattern, group, fewest) in enumerate(KINDS)
    }


def ordinary_strings(text: Column, seed: Column) -> Column:
    """Strings made as people and programs make them, of a text's first words and a hash.

    Names in snake, kebab and camel case and in capitals, paths, numbered names, dates,
    numbers, and rulers: a corpus may have few of them, and a prose corpus none.
    """
    words = F.transform(F.slice(F.regexp_extract_all(text, F.lit("[A-Za-z]{2,}"), F.lit(0)), 1, MADE_OF_WORDS), F.lower)
    join = lambda by: F.array_join(words, by)
    seps = F.array(*map(F.lit, "_-/="))
    numbered = F.transform(
        words,
        lambda w, i: F.concat(w, F.pmod(F.xxhash64(w, seed), F.pow(F.lit(10), 1 + i % 4).cast("long")), F.get(seps, i % 4)),
    )
    # Up to 2033, at any second.
    time = F.timestamp_seconds(F.pmod(seed, F.lit(2_000_000_000)))
    dates = [F.date_format(time, f) for f in ("yyyy-MM-dd-HH-mm-ss-SSS", "yyyy/MM/dd/HH", "yyyyMMddHHmmss", "yyyy_MM_dd")]
    numbers = [
        F.pmod(seed, F.lit(10**18)).cast("string"),
        F.lpad(F.pmod(seed, F.lit(1000)).cast("string"), SHORTEST_RUN, "0"),
    ]
    any_place = (F.pmod(seed, F.lit(len(ALPHABET))) + 1).cast("int")
    ruled = [F.repeat(F.lit(c), F.lit(SHORTEST_RUN // len(c))) for c in ("=", "-", "_", "+", "/", "+----", "-=")]
    return F.array(
        join("_"),
        join("-"),
        F.concat(F.lit("/"), join("/")),
        F.array_join(F.transform(words, F.initcap), ""),
        F.upper(join("_")),
        F.array_join(numbered, ""),
        *dates,
        *numbers,
        *ruled,
        F.repeat(F.substring(F.lit(ALPHABET), any_place, F.lit(1)), F.lit(SHORTEST_RUN)),
    )


def in_sample(hash64: Column, total: int) -> Column:
    """Whether a 64-bit hash is in the share that ``SAMPLE_DOCS`` is of all rows; of the full range, as a share may be tiny."""
    if total <= SAMPLE_DOCS:
        return F.lit(True)
    return hash64 < F.lit(-(2**63) + 2**64 * SAMPLE_DOCS // total).cast("long")


def training_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``label, value``: random strings (1) and ordinary identifiers (0) of a sample of the documents.

    The sample takes a document if the hash of its id and text is in the share of
    all hashes that ``SAMPLE_DOCS`` is of all documents. Random strings are what the base patterns find,
    in its own letters and in capitals, and Base64 digests of the documents
    in both alphabets and without padding, which are random by construction.
    Ordinary ones are the runs of the alphabet outside those patterns, and
    the strings of ``ordinary_strings``, ordinary by construction.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sample = docs.where(in_sample(F.xxhash64(F.col(id_col), text), docs.count())).select(text.alias("text"))
    # The sample is bounded and may lie in few files, so its rows are dealt out to all cores.
    sample = sample.repartition(docs.sparkSession.sparkContext.defaultParallelism)

    def found_by(pattern: str, group: int, fewest: int) -> Column:
        return F.filter(F.regexp_extract_all("text", F.lit(pattern), F.lit(group)), lambda value: F.length(value) >= fewest)

    random = [found_by(pattern, group, fewest) for _, pattern, group, fewest in KINDS]
    # Spark ends a line of Base64 after 76 characters.
    base64 = lambda bits: F.translate(F.base64(F.unhex(F.sha2("text", bits))), "\r\n", "")
    digests = [F.rtrim(base64(bits), F.lit("=")) for bits in (256, 512)]
    made = F.array(*digests, *(F.translate(d, "+/", "-_") for d in digests))
    found = F.concat(*random)
    stripped = F.regexp_replace("text", "|".join(pattern for _, pattern, _, _ in KINDS), " ")
    run = rf"[A-Za-z0-9+/_=-]{{{SHORTEST_ORDINARY},}}"
    runs = F.transform(F.regexp_extract_all("stripped", F.lit(run), F.lit(0)), lambda v: F.substring(v, 1, MOST_OF_RUN))
    ordinary = F.concat(runs, ordinary_strings(F.col("stripped"), F.xxhash64("text")))
    labelled = sample.withColumn("stripped", stripped).select(
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("label"), F.concat(found, F.transform(found, F.upper), made).alias("values")),
                F.struct(F.lit(0).alias("label"), ordinary.alias("values")),
            )
        ).alias("s")
    )
    return labelled.select("s.label", F.explode("s.values").alias("value"))


def pair_scores(strings: DataFrame) -> list[int]:
    """Thousandths of the log-likelihood ratio of each pair of characters, random to ordinary.

    Entry ``a * len(ALPHABET) + b`` is that of character b after a, by first-order Markov
    models with smoothed counts, the ordinary one with a share of ``BACK_OFF`` spread
    evenly over each class. The counts collected are at most two for each pair.
    Raises if a class has no pairs, as no score would then mean anything.
    """
    size = len(ALPHABET)
    chars = strings.where(F.length("value") > 1).withColumn("chars", F.split("value", ""))
    # A character past the end is null, and so is its pair.
    pair = F.zip_with("chars", F.slice("chars", 2, F.length("value")), lambda a, b: F.concat(a, b))
    pairs = chars.select("label", F.explode(pair).alias("pair"))
    inside = F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$")
    counted = pairs.where(inside).groupBy("label", "pair").count().collect()
    if missing := {0, 1} - {row.label for row in counted}:
        raise ValueError(f"no training strings of class {sorted(missing)} (0 ordinary, 1 random)")
    counts = [[SMOOTHING] * (size * size) for _ in range(2)]
    for row in counted:
        a, b = (ALPHABET.index(c) for c in row.pair)
        counts[row.label][a * size + b] += row["count"]
    out = []
    for a in range(size):
        ordinary, random = (c[a * size : (a + 1) * size] for c in counts)
        even = {k: sum(o for o, c in zip(ordinary, CLASSES) if c == k) / CLASSES.count(k) for k in CLASSES}
        for o, r, k in zip(ordinary, random, CLASSES):
            smooth = (1 - BACK_OFF) * o + BACK_OFF * even[k]
            out.append(round(1000 * (log(r / sum(random)) - log(smooth / sum(ordinary)))))
    return out


def random_score(value: Column, scores: list[int]) -> Column:
    """Sum of the pair scores of a string over ``ALPHABET``, in thousandths.

    The characters are split once and carried one by one, so time grows with
    the length, and the sum is a long, as an embedded file may be one run.
    """
    table = F.split(F.lit(",".join(map(str, scores))), ",").cast("array<int>")

    def add(state: Column, char: Column) -> Column:
        code = F.position(char, F.lit(ALPHABET))
        score = F.when(state["last"] > 0, F.element_at(table, (state["last"] - 1) * len(ALPHABET) + code)).otherwise(0)
        return F.struct(code.alias("last"), (state["total"] + score).alias("total"))

    start = F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("total"))
    chars = F.filter(F.split(value, ""), lambda char: char != "")
    return F.aggregate(chars, start, add, lambda state: state["total"])


def _outside(run: Column, base: Column) -> Column:
    """Stretches of a run outside the base spans, which are in order, without those shorter than ``SHORTEST_RUN``."""
    inside = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    none = F.array().cast(f"array<{SPAN}>")

    def with_stretch(state: Column, end: Column) -> Column:
        span = F.struct(state["at"].alias("start"), run["rank"].alias("rank"), run["kind"].alias("kind"), end.alias("end"))
        return F.when(end - state["at"] >= SHORTEST_RUN, F.concat(state["found"], F.array(span))).otherwise(state["found"])

    def cut(state: Column, b: Column) -> Column:
        return F.struct(F.greatest(state["at"], b["end"]).alias("at"), with_stretch(state, b["start"]).alias("found"))

    start = F.struct(run["start"].alias("at"), none.alias("found"))
    return F.aggregate(inside, start, cut, lambda state: with_stretch(state, run["end"]))


def find_secrets(docs: DataFrame, scores: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of secrets of every document.

    Returns ``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` and
    ``found``, all spans as structs of code points (end exclusive), ordered by
    start and then kind. ``spans`` joins them as ``kind:start:end``;
    ``base_sha256`` digests those of the base kinds alone. Of kind ``random``
    are the stretches of runs of the alphabet outside all base spans that have
    ``SHORTEST_RUN`` characters and that the models (``pair_scores``) call random.

    Null and empty texts have no spans. Repeated rows give equal results, null ids stay null, an empty
    table gives no rows, and further columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    kinds = base_spans(F.col("text"))
    run = rf"[A-Za-z0-9+/_=-]{{{SHORTEST_RUN},}}"
    rows = rows.withColumns(kinds).withColumn("run", _spans(F.col("text"), "random", len(KINDS), run))
    rows = rows.withColumn("base", F.array_sort(F.concat(*kinds)))

    def random(span: Column) -> Column:
        value = F.substring(F.col("text"), span["start"] + 1, span["end"] - span["start"])
        return random_score(value, scores) >= int(THRESHOLD * 1000)

    free = F.flatten(F.transform("run", lambda run: _outside(run, F.col("base"))))
    found = F.when(F.size("run") > 0, F.array_sort(F.concat("base", F.filter(free, random)))).otherwise(F.col("base"))
    rows = rows.withColumn("found", found)

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return rows.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in kinds),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("found").alias("spans"),
        "found",
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``find_secrets`` with models trained on a sample of the same documents."""
    if docs.isEmpty():
        return find_secrets(docs, [0] * len(ALPHABET) ** 2, id_col, text_col)
    return find_secrets(docs, pair_scores(training_strings(docs, id_col, text_col)), id_col, text_col)
