"""Repeated lines, found with two Bloom filters: hashes seen once, and hashes seen twice."""

from __future__ import annotations

from collections.abc import Iterator
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tempestry.llm.common import FEW_ROWS, null_safe_join, parts_of, saved, share, values
from tempestry.llm.twice import kinds, repeats

#: Shortest key, in code points, and fewest documents of a line that is removed.
SHORTEST, FEWEST_DOCS = 40, 5


def line_keys(text: bytes | None) -> list[bytes]:
    """The key of each line: stripped of white space at both ends, A-Z in lower case."""
    return [line.strip().lower() for line in (text or b"").split(b"\n")]


def long_enough(key: bytes, shortest: int = SHORTEST) -> bool:
    return len(key) >= shortest and len(key.decode("utf-8", "replace")) >= shortest


def _digests(text: bytes | None, shortest: int) -> set[bytes]:
    """128-bit digests of the distinct long keys."""
    return {xxhash.xxh3_128_digest(key) for key in set(line_keys(text)) if long_enough(key, shortest)}


_LINES = "hash long, rest long, doc_id long, check long, kind int"


def _lines(shortest: int):
    """Batches of (doc_id, check, text) to rows of each distinct key of a text (``twice.kinds``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, 10_000):
            found: list[bytes] = []
            rows: list[int] = []
            for row, text in enumerate(values(batch.column("text"))):
                digests = _digests(text, shortest)
                found.extend(digests)
                rows.extend([row] * len(digests))
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            which, kind = kinds(halves[:, 0])
            take = pa.array(np.asarray(rows, np.int64)[which])
            columns = [pa.array(halves[which, 0]), pa.array(halves[which, 1])]
            columns += [batch.column(c).take(take) for c in ("doc_id", "check")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kind)], [c.split()[0] for c in _LINES.split(", ")])

    return run


def suspects(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``hash, rest, doc_id, check`` of each line key that more than one row of ``docs`` may hold.

    Every key seen twice is here, with a few others. The texts are read once, whatever their number.
    """
    return repeats(docs.select("doc_id", "check", "text").mapInArrow(_lines(shortest), _LINES), "line-digests")


def _without(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    """Each text without the lines whose key has one of the digests, and how many those are."""
    out = []
    for text, drop in zip(texts, drops):
        if text is None or drop is None:
            out.append((None, 0))
            continue
        gone = {pack("<qq", d["hash"], d["rest"]) for d in drop}
        lines = text.split(b"\n")
        stay = [
            line
            for line, key in zip(lines, line_keys(text))
            if not (long_enough(key, 1) and xxhash.xxh3_128_digest(key) in gone)
        ]
        out.append((b"\n".join(stay), len(lines) - len(stay)))
    return pd.DataFrame(out, columns=["kept_text", "n_dropped"])


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    fewest_docs: int = FEWEST_DOCS,
) -> DataFrame:
    """Remove lines that many documents hold from all but the last of them.

    Returns ``row`` (the input row), ``doc_id, n_lines, n_dropped, kept_text``.
    A text is split at line feeds; a key of at least ``shortest`` code points
    that at least ``fewest_docs`` rows hold loses its lines in all rows but
    those of the largest id among them. Keys are compared by 128-bit digests.

    Lines meet as rows of numbers in slices, where two filters find the suspects; only
    these are confirmed, by an aggregate of their digests that also
    finds the largest id, and a join brings that back to each
    document. The texts are read twice and shuffled once, to meet their lists.

    Null or empty text is one empty line and stays so. A null id is smaller
    than any other; if all holders have none, all keep the line. Rows with one
    id and text count as a document each and get the same result. An empty
    table gives no rows, and further columns can have any name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("check"),
        text.alias("text"),
    )
    slim = rows.select("doc_id", "check", F.col("text").cast("binary").alias("text"))
    seen = suspects(slim, shortest)
    confirmed = (
        seen.groupBy("hash", "rest")
        .agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
        .where(F.col("docs") >= fewest_docs)
        .select("hash", "rest", "last")
    )
    # Read back, so that a line of very many documents is a partition that Spark can split for the join.
    confirmed = share(saved(confirmed, "repeated-lines"), FEW_ROWS)
    drops = (
        seen.join(confirmed, ["hash", "rest"])
        .where(~F.col("doc_id").eqNullSafe(F.col("last")))
        .groupBy("doc_id", "check")
        .agg(F.collect_set(F.struct("hash", "rest")).alias("drops"))
    )
    joined = null_safe_join(rows, drops, ["doc_id", "check"], "left")
    changed = F.when(F.col("drops").isNotNull(), F.col("text").cast("binary"))
    result = pandas_udf(_without, "kept_text binary, n_dropped long")(changed, F.col("drops"))
    return joined.withColumn("result", result).select(
        "row",
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.col("result.n_dropped").alias("n_dropped"),
        F.coalesce(F.col("result.kept_text").cast("string"), F.col("text")).alias("kept_text"),
    )


def without_repeated_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines gone from their texts; all other columns as they were."""
    result = drop_repeated_lines(docs, text_col=text_col)
    return result.select(
        *(F.col("kept_text" if c == text_col else f"row.`{c}`").alias(c) for c in docs.columns)
    )
