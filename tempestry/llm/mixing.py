"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempestry.llm.common import FEW_ROWS, null_safe_join, saved, share, uniform, word_count

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Size of the mix as a multiple of all sizes, and most copies of a document.
BUDGET = 1.5
MOST_COPIES = 2
#: Documents of fewer words get this part of the weight of longer ones.
SHORT_WORDS, SHORT_WEIGHT = 50, 0.5
#: Steps of the histogram of ranks in which the cut of a source is found.
STEPS = 4096
SEED = "mix"


def filled(df: DataFrame, group: list[str], weight: str, cap: str, total: Column, out: str) -> DataFrame:
    """Share ``total`` among the rows of each group by weight, none above its cap.

    What a capped row cannot take goes to the others by weight until no row is
    above its cap. The rows that end at their cap are those with the smallest
    cap per weight, so one running sum finds them: a row is capped if, with
    all rows before it at their caps, its part of the rest is above its own.
    """
    order = [F.col(cap) / F.col(weight), F.col("_tie")]
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    rest = F.col("_total") - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weights = F.sum(weight).over(whole) - F.coalesce(F.sum(weight).over(before), F.lit(0.0))
    level = (
        df.withColumn("_total", total)
        .withColumn("_rest", rest)
        .withColumn("_weights", weights)
        .withColumn("_part", F.col("_rest") / F.col("_weights") * F.col(weight))
        .withColumn("_free", F.col("_part") < F.col(cap))
    )
    # The first row that is not capped sets the share of a unit of weight for all after it.
    free = F.when(F.col("_free"), F.struct(*order, (F.col("_rest") / F.col("_weights")).alias("_unit")))
    unit = F.min(free).over(whole)["_unit"]
    capped = F.col(cap).cast("double")
    return (
        level.withColumn("_unit", unit)
        .withColumn(out, F.when(F.col("_unit").isNull(), capped).otherwise(F.least(capped, F.col("_unit") * F.col(weight))))
        .drop("_total", "_rest", "_weights", "_part", "_free", "_unit")
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """``source, source_size, target`` of each source, from rows of ``source, size``.

    One row per source from here on; the windows over all sources see these
    rows only.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    known = (
        sources.withColumn("_tie", place)
        .withColumn("_weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.col("_tie") % len(weights) + 1))
        .withColumn("_cap", F.col("source_size") * MOST_COPIES)
    )
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(budget))
    return filled(known, [], "_weight", "_cap", total, "target").select("source", "source_size", "target")


def plan(sizes: DataFrame, seed: str = SEED) -> DataFrame:
    """Per source and weight class: certain copies, inclusion probability, and the last document sampled.

    ``sizes`` has ``doc_id, source, size, mark`` of all documents and is read four times, so save it first.
    Returns ``source, source_size, target, light, certain, odds, cut``.
    """
    classes = sizes.withColumn("light", _light()).groupBy("source", "light").agg(F.sum("size").alias("words"))
    classes = (
        null_safe_join(classes, share(targets(sizes), FEW_ROWS), ["source"])
        .where("words > 0")
        .withColumn("_weight", F.col("words") * F.when(F.col("light"), SHORT_WEIGHT).otherwise(1.0))
        .withColumn("_cap", F.col("words") * MOST_COPIES)
        .withColumn("_tie", F.col("light").cast("int"))
    )
    classes = filled(classes, ["source"], "_weight", "_cap", F.col("target"), "share")
    expected = F.floor(F.col("share") / F.col("words") * 1e9 + 0.5) / 1e9
    fraction = expected - F.floor(expected)
    classes = saved(
        classes.withColumn("certain", F.floor(expected).cast("long"))
        .withColumn("odds", fraction / (1 - fraction))
        .select("source", "light", "words", "source_size", "target", "certain", "odds"),
        "mix-classes",
    )
    rest = classes.groupBy("source").agg((F.max("target") - F.sum(F.col("certain") * F.col("words"))).alias("rest"))
    drawn = share(classes.where("odds > 0").select("source", "light", "odds"), FEW_ROWS)
    ranked = (
        null_safe_join(sizes.withColumn("light", _light()), drawn, ["source", "light"])
        .withColumn("rank", _rank(seed))
        .withColumn("step", F.floor(F.col("rank") / (F.col("rank") + 1) * STEPS))
    )
    # Words before each step of a source's ranks: the cut lies in one step, and only its documents are sorted.
    steps = ranked.groupBy("source", "step").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    steps = null_safe_join(steps, share(rest, FEW_ROWS), ["source"])
    steps = steps.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
    step = share(saved(steps.select("source", "step", "before", "rest"), "mix-steps"), FEW_ROWS)
    inside = null_safe_join(ranked, step, ["source", "step"])
    running = Window.partitionBy("source").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, 0)
    # A document belongs to the sample if that brings the words nearer to the rest.
    reached = F.col("before") + F.sum("size").over(running) - F.col("size") / 2
    cuts = saved(
        inside.withColumn("taken", reached <= F.col("rest"))
        .withColumn("key", _key())
        .groupBy("source")
        .agg(F.max(F.when(F.col("taken"), F.col("key"))).alias("last"), F.min("key").alias("next"))
        .select("source", F.col("last").isNotNull().alias("closed"), F.coalesce("last", "next").alias("cut")),
        "mix-cuts",
    )
    return null_safe_join(classes.drop("words"), cuts, ["source"], "left")


def _light() -> Column:
    return F.col("size") < SHORT_WORDS


def _rank(seed: str) -> Column:
    """Pareto rank: the odds of a uniform number over the odds of inclusion; the smallest are sampled.

    The number follows from the id, and for a row without id from its text.
    """
    u = uniform(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), "mark")), seed)
    return u / (1 - u) / F.col("odds")


def _order() -> list[Column]:
    """Columns that order the documents of a source; a null id sorts as 0."""
    return [F.col("rank"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("size"), F.coalesce("mark", F.lit("")).alias("mark")]


def _key() -> Column:
    return F.struct(*_order())


def copies(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs``, of ``doc_id, source, size, mark`` and any others, with ``copies`` and the numbers of its source."""
    sizes = saved(docs.select("doc_id", "source", "size", "mark"), "mix-sizes")
    classes = saved(plan(sizes, seed), "mix-plan")
    sources = saved(targets(sizes), "mix-targets")
    known = null_safe_join(docs.withColumn("light", _light()), share(sources, FEW_ROWS), ["source"], "left")
    classes = classes.select("source", "light", "certain", "odds", "closed", "cut")
    known = null_safe_join(known, share(classes, FEW_ROWS), ["source", "light"], "left").withColumn(
        "rank", F.when(F.col("odds") > 0, _rank(seed))
    )
    inside = F.when(F.col("closed"), _key() <= F.col("cut")).otherwise(_key() < F.col("cut"))
    # Without a cut, all documents of the source that can be drawn fit into its target.
    sampled = (F.col("odds") > 0) & F.coalesce(inside, F.lit(True))
    return known.withColumn(
        "copies", F.coalesce("certain", F.lit(0)) + F.coalesce(sampled.cast("long"), F.lit(0))
    ).drop("light", "certain", "odds", "closed", "cut", "rank")


def prepared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows as a struct beside the columns that the sampling needs, so that no name can clash.

    ``mark`` is a digest of the text for rows without id, and null for others.
    """
    return docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.when(F.col(id_col).isNull(), F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("mark"),
    )


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """What the mix takes of each document: ``doc_id, size, source_size, target, taken``.

    The size of a document is its number of words. Sources in the order of
    their names, null last, weigh ``WEIGHTS`` in turn and share ``BUDGET``
    times all words, none more than ``MOST_COPIES`` times its own; the excess
    goes to the others by weight. Within a source, expected copies follow the
    weight of a document's class (short ones weigh less) under the same cap.
    Whole copies are certain. For the fraction left, each document gets its
    Pareto rank, and the smallest ranks are sampled until the words of the
    source come nearest to its target: fixed size, unequal probabilities.

    Everything follows from ``doc_id`` and ``seed``, so reruns agree. Rows
    that share id, size and source are taken or left together; of rows
    without id those that share text and source, as their rank follows from the text. Null text and
    texts without words have size 0 and are taken 0 words.
    An empty table gives no rows; further columns are ignored.
    """
    known = copies(prepared(docs).drop("row"), seed)
    return known.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, with its own columns."""
    repeated = copies(prepared(docs), seed).where("copies > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
