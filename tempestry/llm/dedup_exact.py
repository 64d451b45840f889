"""Exact duplicates by merging sorted runs of digests in a tree."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempestry.llm.common import BLANK_RUN, saved

#: Fewest runs that one node of the tree merges.
FAN_IN = 16


def normalised(text: Column) -> Column:
    """The text with each run of white space as one blank; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_RUN, " ")


def _merge(runs: DataFrame, node: Column) -> DataFrame:
    """One round: the runs that ``node`` puts together, one row per digest with its smallest identifier.

    This is a multiway merge as Spark does it: as the smallest identifier is
    a struct, the aggregate sorts by (node, digest) and passes over the sorted rows once, in each task before
    the shuffle, which makes the run, and behind it, which merges the pieces of the runs that
    meet there. A node is spread over tasks by digest, so no task holds a whole run.
    Digest, length and second hash are compared in every round, so rows that share a digest alone stay apart.
    """
    return (
        runs.withColumn("node", node)
        .groupBy("node", "digest", "length", "check")
        .agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
    )


def rounds(parts: int, fan_in: int = FAN_IN) -> list[int]:
    """How many of the first runs a node of each round holds, up to all ``parts``.

    Each round costs a shuffle of what is left, so the nodes of many runs are
    wider: the square root of their number, which makes two rounds at any size. The first one ends the copies that lie near
    each other, which is where crawls have most of them, before rows travel to their last place.
    """
    width = max(fan_in, isqrt(max(parts - 1, 0)) + 1)
    out = [width]
    while out[-1] < parts:
        out.append(out[-1] * width)
    return out


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN
) -> DataFrame:
    """Which row of each set of equal texts stays.

    Texts are equal when they are identical after each run of white space has
    become one blank. They are compared by SHA-256, length and a second hash
    together, which also verifies each identifier kept at every level.

    Every input partition makes one run, sorted by digest: a row per digest with the smallest
    identifier, so a large group of copies shrinks where it is read. Rounds
    (``rounds``) then merge the runs of neighbouring partitions until one
    is left, which stays spread over tasks by digest.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``. Null text counts as empty. A null id counts as larger than
    any other, so ``keep_id`` is null only where a group has no other id. Of
    rows repeated with one id and text, one is kept. Further columns of the
    input are ignored, an empty table gives no rows.
    """
    text = normalised(F.col(text_col))
    rows = saved(
        docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).select(
            "id",
            F.monotonically_increasing_id().alias("row"),
            F.spark_partition_id().alias("part"),
            F.unhex(F.sha2(F.col("text"), 256)).alias("digest"),
            F.length("text").alias("length"),
            F.xxhash64("text").alias("check"),
        ),
        "digests",
    )
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    runs = _merge(rows.select("part", "digest", "length", "check", first.alias("first"), F.lit(1).alias("copies")), F.col("part"))
    parts = (rows.agg(F.max("part")).first()[0] or 0) + 1
    for width in rounds(parts, fan_in):
        runs = _merge(runs, F.floor(F.col("node") / width) * width)
    keep = runs.select("digest", "length", "check", "first", "copies")
    return rows.join(keep, ["digest", "length", "check"]).select(
        F.col("id").alias("doc_id"),
        F.col("first.id").alias("keep_id"),
        F.col("copies").cast("long").alias("group_size"),
        (F.col("first.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
