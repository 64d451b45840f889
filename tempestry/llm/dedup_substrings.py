"""Passages that occur more than once, found at the positions of a difference cover."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import tee

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tempestry.llm.common import (
    BLANK_RUN,
    covered,
    hashed_texts,
    known_apart,
    parts_of,
    saved,
    values,
    window_hashes,
    word_count,
    word_hashes,
)
from tempestry.llm.twice import KEYED, Filters, emitted, repeats, seen_twice, told

#: Words of a passage that is removed if it occurs again.
PASSAGE = 35
#: Any two positions have a shift below PERIOD that takes both to a position in COVER modulo PERIOD,
#: as each number below 13 is a difference of two of these modulo 13.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: A second multiplier and a second seed of words, so that a passage is known by two independent hashes of 64 bits.
SECOND, SECOND_SEED = np.uint64(0xA0761D6478BD642F), 0x2545F4914F6CDD1D
#: Words of the texts that one part of a task holds at once.
PART_WORDS = 2_000_000


def anchor_places(n_words: int, passage: int = PASSAGE) -> np.ndarray:
    """Positions of a text's anchors: windows of ``passage - PERIOD + 1`` words that begin in the cover."""
    last = n_words - (passage - PERIOD + 1)
    places = np.add.outer(np.arange(0, max(0, last + 1), PERIOD), np.array(COVER)).ravel()
    return places[places <= last]


@dataclass
class _Text:
    """A text with the hashes of its words, and its anchors: their places and hashes.

    ``listed`` has the anchors that may be repeated, if the batch says so.
    """

    key: int
    text: bytes
    hashes: np.ndarray
    places: np.ndarray
    anchors: np.ndarray
    listed: np.ndarray | None


def _texts_once(batches: Iterator[pa.RecordBatch], passage: int) -> Iterator[list[_Text]]:
    """The texts that are long enough, one repeated in the partition only once, PART_WORDS at a time."""
    seen: set[int] = set()

    def new() -> Iterator[tuple[int, bytes, np.ndarray | None]]:
        for batch in parts_of(batches):
            listed = batch.column("anchors") if "anchors" in batch.schema.names else [None] * batch.num_rows
            for key, text, some in zip(values(batch.column("key")), values(batch.column("text")), listed):
                if key not in seen:
                    seen.add(key)
                    yield key, text, None if some is None else some.values.to_numpy().view(np.uint64)

    keys, again = tee(new())
    out, words = [], 0
    width = passage - PERIOD + 1
    for (key, _, listed), (text, hashes, windows) in zip(keys, hashed_texts((text for _, text, _ in again), width)):
        if len(hashes) >= passage:
            places = anchor_places(len(hashes), passage)
            out.append(_Text(key, text, hashes, places, windows[places], listed))
            words += len(hashes)
        if words >= PART_WORDS:
            yield out
            out, words = [], 0
    yield out


def _anchor_hashes(passage: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts_once(batches, passage):
            yield emitted(np.concatenate([np.empty(0, np.uint64), *(t.anchors for t in texts)]))

    return run


def _keyed_anchors(passage: int):
    """Batches of texts to rows of each of their anchors (``twice.KEYED``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts_once(batches, passage):
            keys = np.repeat(np.array([t.key for t in texts], np.int64), [len(t.anchors) for t in texts])
            yield told(np.concatenate([np.empty(0, np.uint64), *(t.anchors for t in texts)]), keys)

    return run


_FOUND = "first long, second long, key long, begin int, end int"


def _candidates(filters: Filters | None, passage: int):
    """Passages that hold an anchor which may occur again, by the filters or else by the list beside the text.

    A passage found twice in a batch is confirmed: its words are returned as spans
    of their texts, without hashes, and one row of its hashes alone tells other tasks.
    All others are rows of both hashes, text and span.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts_once(batches, passage):
            if filters is None:
                hit = np.concatenate([np.empty(0, bool), *(np.isin(t.anchors, t.listed) for t in texts)])
            else:
                hit = filters.may_repeat(np.concatenate([np.empty(0, np.uint64), *(t.anchors for t in texts)]))
            at = 0
            columns: list[list[np.ndarray]] = [[np.empty(0, t)] for t in (np.uint64, np.uint64, np.int64, np.int64)]
            for k, text in enumerate(texts):
                here, hashes = text.places[hit[at : at + len(text.places)]], text.hashes
                at += len(text.places)
                if not len(here):
                    continue
                # A passage holds the anchor if it begins at most PERIOD - 1 words before it.
                inside = covered(here, PERIOD, len(hashes) + PERIOD)[PERIOD - 1 :]
                starts = np.flatnonzero(inside[: len(hashes) - passage + 1])
                columns[0].append(window_hashes(hashes, passage)[starts])
                columns[1].append(window_hashes(word_hashes(text.text, SECOND_SEED), passage, SECOND)[starts])
                columns[2].append(np.full(len(starts), k))
                columns[3].append(starts)
            first, second, owner, place = (np.concatenate(column) for column in columns)
            keys = np.array([t.key for t in texts], np.int64)
            order = np.lexsort((second, first))
            alike = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
            twice = np.zeros(len(order), bool)
            twice[order[1:][alike]] = True
            twice[order[:-1][alike]] = True
            marks = order[np.flatnonzero(np.concatenate([alike, [False]]) & ~np.concatenate([[False], alike]))[: len(order)]]
            once = np.flatnonzero(~twice)
            yield from _found(first[once], second[once], keys[owner[once]], place[once], None)
            yield from _found(first[marks], second[marks], None, None, None)
            begins, ends = merged(owner[twice], place[twice], passage)
            yield from _found(None, None, keys[begins[0]], begins[1], ends)

    return run


def _found(*columns: np.ndarray | None, most: int = 100_000) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("first", pa.int64()), ("second", pa.int64()), ("key", pa.int64()), ("begin", pa.int32()), ("end", pa.int32())])
    number = next(len(c) for c in columns if c is not None)
    for at in range(0, number, most):
        size = min(most, number - at)
        arrays = [
            pa.nulls(size, f.type) if c is None else pa.array(c[at : at + size].view(np.int64)).cast(f.type)
            for c, f in zip(columns, schema)
        ]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def merged(texts: np.ndarray, places: np.ndarray, passage: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Spans that passages at sorted places of their texts cover: ((text, begin), end)."""
    if not len(texts):
        return (texts, places), places
    new = np.flatnonzero((np.diff(texts) != 0) | (np.diff(places) > passage)) + 1
    heads, tails = np.concatenate([[0], new]), np.concatenate([new - 1, [len(texts) - 1]])
    return (texts[heads], places[heads]), places[tails] + passage


def _spans(found: pd.Series) -> pd.Series:
    """Spans that touch or overlap as one; (begin, end) of each, one after the other."""

    def join(pairs) -> list[int]:
        out: list[int] = []
        for pair in sorted((p["begin"], p["end"]) for p in pairs):
            if out and pair[0] <= out[-1]:
                out[-1] = max(out[-1], pair[1])
            else:
                out += pair
        return out

    return found.map(join)


def words_joined(text: Column) -> Column:
    """The words of a text with one blank between two; empty for null."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_RUN, " "))


def text_key(text: Column) -> Column:
    """64 bits of a text; texts that share them by chance are told apart by ``known_apart``."""
    return F.xxhash64(text)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of words in passages of PASSAGE words that occur more than once in the table.

    Returns ``row`` (the input row), ``doc_id, n_words, text`` (empty for null)
    and ``spans``: begin and end of each span, one after the other, in words.
    Spans do not touch.

    Two equal passages have anchors at the same shift in both, since some
    shift below PERIOD takes both to positions of the cover. So only anchors
    are hashed and shuffled, 4 for 13 words; filters of the repeated ones go
    back to the texts, where an anchor found again is extended to all
    passages around it. Where the filters are too large to be broadcast, the anchors meet them instead, and the
    lists of those repeated are joined to the texts. The candidates are confirmed by their 128-bit
    hashes: within a batch at once, which keeps a passage of very many texts
    from being shuffled, the others by counting them over all tasks. A text that occurs twice as a whole is one
    span, and stands for its copies elsewhere; copies are known by two hashes and their length.

    Null and blank texts have no words, and shorter ones than a passage no
    spans. Rows repeated are copies of each other. Null ids stay null, an empty table gives no
    rows, further columns can have any name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        text_key(text).alias("key"),
        F.xxhash64(F.lit(SECOND_SEED), text).alias("check"),
        F.octet_length(text).alias("bytes"),
    )
    rows, copied = known_apart(rows, "key", ["check", "bytes"], "copied-texts")
    slim = rows.select("key", F.col("text").cast("binary").alias("text"))
    number = (docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0) // 6 * len(COVER) // PERIOD
    filters = seen_twice(slim.mapInArrow(_anchor_hashes(PASSAGE), "hash long"), number, "anchor-filters")
    if filters is None:
        repeated = repeats(slim.mapInArrow(_keyed_anchors(PASSAGE), KEYED), "anchors")
        listed = repeated.groupBy("key").agg(F.collect_set("hash").alias("anchors"))
        # One of the rows of each text; a text of very many rows leaves each task as one.
        passages = saved(slim.dropDuplicates(["key"]).join(listed, "key").mapInArrow(_candidates(None, PASSAGE), _FOUND), "passages")
    else:
        passages = saved(slim.mapInArrow(_candidates(filters, PASSAGE), _FOUND), "passages")
        filters.release()
    here = passages.where("first IS NULL").select("key", "begin", "end")
    rest = passages.where("first IS NOT NULL")
    others = F.count("*").over(Window.partitionBy("first", "second"))
    again = rest.withColumn("held", others).where("held > 1 AND key IS NOT NULL")
    again = again.select("key", "begin", (F.col("begin") + PASSAGE).alias("end"))
    spans = pandas_udf(_spans, "array<int>")("found")
    parts = (
        here.unionByName(again)
        .groupBy("key")
        .agg(F.collect_set(F.struct("begin", "end")).alias("found"))
        .select("key", spans.alias("spans"))
    )
    everything = F.array(F.lit(0), F.lit(2**31 - 1))
    whole = copied.select("key", everything.alias("spans"))
    spans = whole.unionByName(parts.join(copied, "key", "left_anti"))
    known = rows.join(spans, "key", "left").withColumn("n_words", word_count(F.col("text")))
    inside = F.transform("spans", lambda place: F.least(place, F.col("n_words").cast("int")))
    held = F.col("spans").isNotNull() & (F.col("n_words") >= PASSAGE)
    return known.select(
        "row", "doc_id", "n_words", "text", F.when(held, inside).otherwise(F.array().cast("array<int>")).alias("spans")
    )


def _kept(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, cut in zip(texts, spans):
        if text is None:
            out.append(None)
            continue
        parts, at = text.split(), 0
        kept: list[bytes] = []
        for begin, end in zip(cut[::2], cut[1::2]):
            kept += parts[at:begin]
            at = end
        out.append(b" ".join(kept + parts[at:]))
    return pd.Series(out)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, n_words, n_removed, kept_text``: every text without its repeated passages.

    The words that are kept are joined by one blank. See ``repeated_spans`` for what is repeated.
    """
    found = repeated_spans(docs, id_col, text_col)
    removed = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size("spans"), F.lit(1)), F.lit(2)),
        F.lit(0),
        lambda total, i: total + F.coalesce(F.try_element_at("spans", i + 1) - F.try_element_at("spans", i), F.lit(0)),
    )
    touched = F.size("spans") > 0
    kept = pandas_udf(_kept, "binary")(F.when(touched, F.col("text").cast("binary")), F.when(touched, F.col("spans")))
    return found.select(
        "row",
        "doc_id",
        "n_words",
        removed.cast("long").alias("n_removed"),
        F.coalesce(kept.cast("string"), words_joined(F.col("text"))).alias("kept_text"),
    )
