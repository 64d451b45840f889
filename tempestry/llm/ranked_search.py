"""Ranked lexical search over a grid of terms and documents that is kept as K2-treaps."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempestry.llm.common import FEW_ROWS, parts_of, saved, share, signed, values, word_hashes

#: Documents returned for an item.
BEST = 20
#: A block of the index ends with the document that reaches so many terms, repeats included, or so many documents.
BLOCK_TERMS, BLOCK_DOCS = 1_500_000, 1 << 15
#: Document ranges that a search opens at once.
OPENED = 256
#: Terms of items that are sent to the executors at once, some 30 bytes each; more items take another pass.
MOST_TERMS = 1_000_000
#: Salts over which the best documents of an item are first gathered.
SALTS = 64
#: Values of the score (fixed): impacts are parts of a million, and a document's length is smoothed by a quarter.
IMPACT_TOP, TF_FACTOR, LENGTH_FACTOR, LENGTH_PERCENT = 1_000_000_000, 1000, 12, 25

_SET_BITS = np.array([k.bit_count() for k in range(16)], np.uint8)
#: A blank for every byte below 128 that is neither a digit nor a letter, a-z for A-Z.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def term_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of a text's terms in order: runs of digits, letters and all characters from U+0080 on, A-Z in lower case."""
    return word_hashes((text or b"").translate(_FOLD))


def length_part(n_terms, docs: int, terms: int):
    """How much a document's length counts: 75 plus 25 times its length over the mean, rounded down."""
    return 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n_terms * docs) // max(terms, 1)


def impact(tf, part):
    """What ``tf`` occurrences are worth in a document with such a length part."""
    return (IMPACT_TOP * tf) // (TF_FACTOR * tf + LENGTH_FACTOR * part)


# The treap -------------------------------------------------------------------------------------------------------------


@dataclass
class Level:
    """The cells of one size that hold anything, children of one parent together: which of its quarters hold
    something, the largest impact in it, and where its children begin one level below."""

    mask: np.ndarray
    largest: np.ndarray
    first: np.ndarray


def _interleaved(rows: np.ndarray, columns: np.ndarray, bits: int) -> np.ndarray:
    """One number per cell whose pairs of bits are its quarters from the whole grid down."""
    out = np.zeros(len(rows), np.uint64)
    for k in range(bits):
        out |= ((rows >> np.uint64(k)) & np.uint64(1)) << np.uint64(2 * k + 1)
        out |= ((columns >> np.uint64(k)) & np.uint64(1)) << np.uint64(2 * k)
    return out


def build_treap(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, bits: int) -> list[Level]:
    """Levels from the whole grid of 2 ** bits rows and columns to single cells."""
    cells = _interleaved(rows.astype(np.uint64), columns.astype(np.uint64), bits)
    order = np.argsort(cells, kind="stable")
    cells, largest = cells[order], impacts[order].astype(np.uint32)
    levels = [Level(np.empty(0, np.uint8), largest, np.empty(0, np.int32))]
    for _ in range(bits):
        parents, quarters = cells >> np.uint64(2), (np.uint8(1) << (cells & np.uint64(3)).astype(np.uint8))
        begins = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]])) if len(cells) else np.empty(0, np.int64)
        mask = np.bitwise_or.reduceat(quarters, begins) if len(begins) else np.empty(0, np.uint8)
        largest = np.maximum.reduceat(largest, begins) if len(begins) else largest
        levels.append(Level(mask, largest, begins.astype(np.int32)))
        cells = parents[begins]
    return levels[::-1]


def stored(levels: list[Level]) -> list[tuple[bytes, bytes]]:
    """The levels as compressed bytes: masks, and by how much each cell's largest impact is below its parent's."""
    out = []
    above = None
    for k, level in enumerate(levels):
        if above is None:
            drop = level.largest
        else:
            drop = np.repeat(above.largest, _SET_BITS[above.mask]) - level.largest
        # Bytes of one place together, so that the many zeros do.
        planes = np.ascontiguousarray(drop.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        out.append((zlib.compress(level.mask.tobytes(), 1), zlib.compress(planes.tobytes(), 1)))
        above = level
    return out


def loaded(parts: Iterable[tuple[bytes, bytes]]) -> list[Level]:
    """The levels out of their stored bytes."""
    levels: list[Level] = []
    for masks, drops in parts:
        mask = np.frombuffer(zlib.decompress(masks), np.uint8)
        drop = np.ascontiguousarray(np.frombuffer(zlib.decompress(drops), np.uint8).reshape(4, -1).T).view("<u4").ravel()
        if levels:
            drop = np.repeat(levels[-1].largest, _SET_BITS[levels[-1].mask]) - drop
        children = _SET_BITS[mask].astype(np.int32)
        levels.append(Level(mask, drop, np.cumsum(children, dtype=np.int32) - children))
    return levels


def best_documents(
    levels: list[Level], rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, best: int = BEST, floor: tuple[int, int] = (0, 0)
) -> list[tuple[int, int, int]]:
    """(score, id, column) of the best documents of one block for one item, highest first, equal ones by id.

    ``rows`` and ``weights`` are those of the item's terms, ``ids`` the
    documents' in ascending order. A range of documents has one cell for each
    term: the square of the range's size that holds the term's row. The sum
    of weight times largest impact of these cells bounds the score of every document in the range. The
    ranges of highest bounds are opened first, all terms at once: each
    becomes its two halves, with the cell of the half's size on each term's path. A
    range of one document has its score. Ranges that cannot come before
    ``floor`` (score, id of the worst of the best documents so far) are dropped.
    """
    if not len(rows) or not len(levels[0].largest):
        return []
    bits, terms = len(levels) - 1, len(rows)
    rows, weights = rows.astype(np.int64), weights.astype(np.int64)
    found: list[tuple[int, int, int]] = []
    # Open ranges by their level: bounds, places, and the cell of each term (-1: nothing there).
    start = np.zeros((1, terms), np.int32)
    bound = np.array([(levels[0].largest[0].astype(np.int64) * weights).sum()])
    waiting: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {0: (bound, np.zeros(1, np.int64), start)}

    def open_still(bound: np.ndarray, first: np.ndarray) -> np.ndarray:
        return (bound > floor[0]) | (bound == floor[0]) & (ids[first] < floor[1])

    while waiting:
        # The level whose best range has the highest bound; the deeper of equal ones.
        depth = max(waiting, key=lambda d: (waiting[d][0].max(), d))
        bounds, places, cells = waiting.pop(depth)
        if len(bounds) > OPENED:
            order = np.argpartition(-bounds, OPENED)
            now, later = order[:OPENED], order[OPENED:]
            waiting[depth] = bounds[later], places[later], cells[later]
            bounds, places, cells = bounds[now], places[now], cells[now]
        keep = open_still(bounds, places << (bits - depth))
        if depth in waiting and not keep.any():
            # The best ranges of the level are behind the floor, and so are the others.
            left, first = waiting[depth], waiting[depth][1] << (bits - depth)
            if not open_still(left[0], first).any():
                del waiting[depth]
        if not keep.any():
            continue
        places, cells = places[keep], cells[keep]
        level, below = levels[depth], levels[depth + 1] if depth < bits else None
        if below is None:
            scores = bounds[keep]
            found += zip(scores.tolist(), ids[places].tolist(), places.tolist())
            found.sort(key=lambda r: (-r[0], r[1]))
            del found[best:]
            if len(found) == best:
                worst = found[-1][:2]
                if worst[0] > floor[0] or worst[0] == floor[0] and worst[1] < floor[1]:
                    floor = worst
            continue
        half = ((rows >> (bits - depth - 1)) & 1).astype(np.uint8) * 2
        mask = np.where(cells >= 0, level.mask[cells], 0).astype(np.uint8)
        first = level.first[cells]
        for side in (0, 1):
            place = places * 2 + side
            inside = place << (bits - depth - 1) < len(ids)
            if not inside.any():
                continue
            quarter = half + np.uint8(side)
            there = (mask[inside] >> quarter) & 1
            child = first[inside] + _SET_BITS[mask[inside] & ((np.uint8(1) << quarter) - np.uint8(1))]
            child = np.where(there == 1, child, -1).astype(np.int32)
            value = np.where(there == 1, below.largest[child], 0).astype(np.int64)
            bound = value @ weights
            place = place[inside]
            keep = (bound > 0) & open_still(bound, place << (bits - depth - 1))
            if keep.any():
                more = bound[keep], place[keep], child[keep]
                have = waiting.get(depth + 1)
                waiting[depth + 1] = tuple(map(np.concatenate, zip(have, more))) if have else more
    return found


# The index -------------------------------------------------------------------------------------------------------------

_TOTALS = "docs long, terms long"
_BLOCK = "n_docs long, n_terms long, ids binary, terms binary, held binary, masks array<binary>, drops array<binary>"
_BLOCK_SCHEMA = pa.schema(
    {"n_docs": pa.int64(), "n_terms": pa.int64()}
    | {k: pa.binary() for k in ("ids", "terms", "held")}
    | {k: pa.list_(pa.binary()) for k in ("masks", "drops")}
)
#: Stands for a null identifier in a block, so that it sorts last.
NO_ID = (1 << 63) - 1


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in parts_of(batches):
        for text in values(batch.column("text")):
            if text:
                codes = np.frombuffer((b" " + text).translate(_FOLD), np.uint8) != 32
                number = int(np.count_nonzero(codes[1:] & ~codes[:-1]))
                docs, terms = docs + (number > 0), terms + number
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], ["docs", "terms"])


def build_block(held: list[tuple[int, np.ndarray]], docs: int, terms: int) -> dict:
    """One row of the index out of (id, term hashes) of its documents."""
    held = sorted(held, key=lambda d: d[0])
    sizes = np.array([len(h) for _, h in held], np.int64)
    hashes = np.concatenate([h for _, h in held])
    names, term = np.unique(hashes, return_inverse=True)
    cells, tf = np.unique(term.astype(np.int64) * len(held) + np.repeat(np.arange(len(held)), sizes), return_counts=True)
    term, column = cells // len(held), cells % len(held)
    number = np.bincount(term, minlength=len(names))
    # Terms of most documents first: what is frequent and what is rare lie apart, which keeps large cells empty.
    rank = np.empty(len(names), np.int64)
    by_number = np.lexsort((names, -number))
    rank[by_number] = np.arange(len(names))
    impacts = impact(tf.astype(np.int64), length_part(sizes, docs, terms)[column])
    bits = max(int(max(len(names), len(held)) - 1).bit_length(), 1)
    parts = stored(build_treap(rank[term], column, impacts, bits))
    return {
        "n_docs": len(held),
        "n_terms": int(sizes.sum()),
        "ids": np.array([i for i, _ in held], "<i8").tobytes(),
        "terms": names[by_number].astype("<u8").tobytes(),
        "held": number[by_number].astype("<u4").tobytes(),
        "masks": [m for m, _ in parts],
        "drops": [d for _, d in parts],
    }


def _blocks(docs: int, terms: int) -> Callable:
    """Batches of (doc_id, text) to rows of the index. Documents without terms are in no block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for batch in parts_of(batches):
            for doc, text in zip(values(batch.column("doc_id")), values(batch.column("text"))):
                hashes = term_hashes(text)
                if len(hashes):
                    held.append((NO_ID if doc is None else doc, hashes))
                    size += len(hashes)
                if size >= BLOCK_TERMS or len(held) >= BLOCK_DOCS:
                    yield pa.RecordBatch.from_pylist([build_block(held, docs, terms)], _BLOCK_SCHEMA)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist([build_block(held, docs, terms)], _BLOCK_SCHEMA)

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents: a row per block of documents, written to the shared folder.

    A first pass counts documents and terms, as impacts need the mean length;
    the second one makes, of each block, the terms with the number of documents that hold them and the
    treap of impacts. Nothing is shuffled.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    totals = slim.select("text").mapInArrow(_count_terms, _TOTALS).agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    return saved(slim.mapInArrow(_blocks(totals.docs or 0, totals.terms or 0), _BLOCK), "search-index")


# Searching -------------------------------------------------------------------------------------------------------------


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, item_id, term, times`` of different rows of ``items``; ``item`` is a hash of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, 200):
            item, item_id, term, times = [], [], [], []
            for key, number, text in zip(*(batch.column(c).to_pylist() for c in ("item", "item_id", "text"))):
                found, counts = np.unique(term_hashes(text), return_counts=True)
                item += [key] * len(found)
                item_id += [number] * len(found)
                term += signed(found).tolist()
                times += counts.tolist()
            columns = [pa.array(c, pa.int64()) for c in (item, item_id, term, times)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "term", "times"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text")).distinct()
    rows = rows.select(F.xxhash64("item_id", F.coalesce("text", F.lit(b""))).alias("item"), "item_id", "text")
    return rows.mapInArrow(run, "item long, item_id long, term long, times long")


def _held(terms: Broadcast) -> Callable:
    """Blocks to a row per term asked for: in how many of the block's documents it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, held in zip(batch.column("terms").to_pylist(), batch.column("held").to_pylist()):
                here = np.flatnonzero(np.isin(np.frombuffer(names, "<u8"), terms.value))
                columns = signed(np.frombuffer(names, "<u8")[here]), np.frombuffer(held, "<u4")[here].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["term", "held"])

    return run


def _search(items: Broadcast, best: int) -> Callable:
    """Blocks to the best documents of each item in them, of which those of one task must be better than before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, int, int]]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch.column(name)[row].as_py() for name in ("ids", "terms", "masks", "drops")}
                ids, names = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["terms"], "<u8")
                levels = loaded(zip(block["masks"], block["drops"]))
                order = np.argsort(names)
                sorted_names = names[order]
                for item, (terms, weights) in items.value.items():
                    place = np.minimum(np.searchsorted(sorted_names, terms), len(names) - 1)
                    here = sorted_names[place] == terms
                    known = held.setdefault(item, [])
                    floor = known[-1][:2] if len(known) == best else (0, 0)
                    found = best_documents(levels, order[place[here]], weights[here], ids, best, floor)
                    if found:
                        known += found
                        known.sort(key=lambda r: (-r[0], r[1]))
                        del known[best:]
        rows = [(item, doc, score) for item, known in held.items() for score, doc, _ in known]
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return run


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's best documents by an index.

    A term weighs floor(1000 ln((2N + 2) / (2 df + 1))); the score sums weight times impact over the item's
    terms, repeats included. Documents of score 0 are not returned, and equal scores rank by ascending id.

    The terms' frequencies come from the blocks' lists; weights then go to all
    executors with the items, at most MOST_TERMS terms at once, and each task
    searches the treaps of its blocks, best first. What it sends on is at most
    ``best`` rows per item, which are gathered in two steps.

    Items without terms find nothing; a row of ``items`` that is repeated is
    searched once, rows of one id and other texts are ranked apart. Documents without id come after all others of
    their score. Null and empty texts have no terms. Empty tables give no rows; further columns are ignored.
    """
    spark = index.sparkSession
    asked = saved(item_terms(items, id_col, text_col), "search-terms")
    numbers = asked.groupBy("item").agg(F.count("*").alias("terms"))
    # Items are dealt to passes by the running number of their terms.
    before = F.sum("terms").over(Window.orderBy("item").rowsBetween(Window.unboundedPreceding, -1))
    passes = saved(numbers.withColumn("pass", F.floor(F.coalesce(before, F.lit(0)) / MOST_TERMS)).select("item", "pass"), "search-passes")
    n_docs = index.agg(F.sum("n_docs")).first()[0] or 0
    out = spark.createDataFrame([], "item long, doc_id long, score long")
    for number in range((passes.agg(F.max("pass")).first()[0] or 0) + 1):
        here = asked.join(share(passes.where(F.col("pass") == number).select("item"), FEW_ROWS), "item")
        terms = here.select("term").distinct().toPandas()["term"].to_numpy(np.int64).view(np.uint64)
        wanted = spark.sparkContext.broadcast(np.sort(terms))
        df = index.select("terms", "held").mapInArrow(_held(wanted), "term long, held long").groupBy("term").agg(F.sum("held").alias("df"))
        weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long") * F.col("times")
        weighted = here.join(saved(df, "term-frequencies"), "term").select("item", "term", weight.alias("weight"))
        rows = weighted.where("weight > 0").toPandas()
        groups = {
            int(item): (group["term"].to_numpy(np.int64).view(np.uint64), group["weight"].to_numpy(np.int64))
            for item, group in rows.groupby("item")
        }
        shared = spark.sparkContext.broadcast(groups)
        columns = index.select("ids", "terms", "masks", "drops")
        found = saved(columns.mapInArrow(_search(shared, best), "item long, doc_id long, score long"), "search-results")
        shared.unpersist()
        wanted.unpersist()
        out = out.unionByName(found)
    order = [F.desc("score"), F.asc("doc_id")]
    salted = out.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= best)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= best)
    names = share(asked.select("item", "item_id").distinct(), FEW_ROWS)
    doc = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), doc.alias("doc_id"), "score")


def rank_documents(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """The best of all ``docs`` for each of ``items``; see ``search``."""
    return search(build_index(docs), items, best=best)
