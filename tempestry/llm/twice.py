"""Hashes seen at least twice, by two Bloom filters: one of hashes seen once, one of those seen again.

Filters of a bounded size are broadcast to the rows (``seen_twice``). Beyond
that size the rows go to the filters (``repeats``), so that no work grows faster than the data.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempestry.llm.common import mixed, saved, signed

#: Hashes for one pair of filters, and the bits of each of its filters (32 for each hash).
SLICE_HASHES, SLICE_BITS = 250_000, 1 << 23
PROBES = 4
#: Most of its bits that a filter of repeated hashes has set: one in 4000 other hashes passes at 1/8.
FILL = 1 / 8
#: Most bytes of filters that are broadcast.
MOST_FILTER_BYTES = 64 << 20
#: What a row of a hash and its owner says: the hash has to be looked for elsewhere; it is one of several in its
#: batch and so repeated for sure; or it only tells the others that there are such.
ASKED, SURE, MARK = 0, 1, 2
KEYED = "hash long, key long, kind int"


def emitted(hashes: np.ndarray) -> pa.RecordBatch:
    """The different ones of some hashes, those found twice or more with a second row."""
    different, counts = np.unique(hashes, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate([different, different[counts > 1]])))], ["hash"])


def kinds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch's hashes: which hash each is of, and its kind.

    Hashes found several times in the batch are repeated for sure, so their rows need not meet those of other
    tasks; one mark stands for them there, however many they are.
    """
    _, first, place, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    marks = first[count > 1]
    which = np.concatenate([np.arange(len(hashes)), marks])
    return which, np.concatenate([np.where(count[place] > 1, SURE, ASKED), np.full(len(marks), MARK)]).astype(np.int32)


def told(hashes: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """Rows of KEYED of a batch's hashes and their owners."""
    which, kind = kinds(hashes)
    return pa.RecordBatch.from_arrays([pa.array(signed(hashes[which])), pa.array(keys[which]), pa.array(kind)], ["hash", "key", "kind"])


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bits of each hash in a filter, one row per probe. Halving a filter keeps them modulo its size."""
    second = mixed(hashes) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        return (mixed(hashes + np.uint64(1)) + steps * second) & np.uint64(bits - 1)


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    places = _places(hashes, len(bits) * 8)
    return ((bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _put(bits: np.ndarray, hashes: np.ndarray) -> None:
    places = _places(hashes, len(bits) * 8).ravel()
    np.bitwise_or.at(bits, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))


def folded(bits: np.ndarray, fill: float = FILL) -> np.ndarray:
    """The filter halved as long as at most ``fill`` of its bits would be set."""
    while len(bits) > 64:
        half = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
        if np.bitwise_count(half).sum() > len(half) * 8 * fill:
            break
        bits = half
    return bits


def _slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((hashes >> np.uint64(1)) % np.uint64(slices)).astype(np.int64)


def _slice_column(slices: int) -> Column:
    return F.shiftrightunsigned("hash", 1) % slices


def _seen_again(slices: int, fill: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(SLICE_BITS // 8, np.uint8))
        again: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(SLICE_BITS // 8, np.uint8))
        for batch in batches:
            hashes, counts = np.unique(batch.column(0).to_numpy().view(np.uint64), return_counts=True)
            part = _slice_of(hashes, slices)
            for s in np.unique(part):
                here = hashes[part == s]
                repeated = here[(counts[part == s] > 1) | _has(once[s], here)]
                _put(once[s], here)
                if len(repeated):
                    _put(again[s], repeated)
        for s, bits in again.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int64()), pa.array([folded(bits, fill).tobytes()], pa.binary())], ["slice", "bits"]
            )

    return run


def repeated_within(hashes: np.ndarray, step: int = 100_000) -> np.ndarray:
    """Which of some hashes two filters hold as seen twice: every repeated one, and few others.

    The hashes pass the filter of those seen once in steps, and what it holds already goes to the filter of those seen again.
    """
    once, again = (np.zeros(max(64, 4 << max(1, len(hashes)).bit_length()), np.uint8) for _ in range(2))
    for at in range(0, len(hashes), step):
        here, counts = np.unique(hashes[at : at + step], return_counts=True)
        repeated = here[(counts > 1) | _has(once, here)]
        _put(once, here)
        if len(repeated):
            _put(again, repeated)
    return _has(again, hashes) if len(hashes) else np.zeros(0, bool)


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A slice's rows to those asked for whose hash its two filters may have seen twice."""
    held = list(batches)
    if held:
        hashes = np.concatenate([b.column("hash").to_numpy() for b in held]).view(np.uint64)
        suspect, at = repeated_within(hashes), 0
        for batch in held:
            keep = suspect[at : at + batch.num_rows] & (batch.column("kind").to_numpy() == ASKED)
            at += batch.num_rows
            yield batch.filter(pa.array(keep))


def repeats(rows: DataFrame, label: str) -> DataFrame:
    """The rows whose hash may be that of several rows: every such row, and a few others.

    ``rows`` has ``hash`` and ``kind`` (``kinds``) beside other columns. They are written once and dealt out by
    hash to slices of bounded size, each with its own two filters. A hash that
    very many rows have is in most batches several times, and these rows stay where they are.
    """
    rows = saved(rows, label)
    slices = max(16, rows.count() // SLICE_HASHES + 1)
    asked = rows.where(F.col("kind") != SURE).repartition(slices, _slice_column(slices)).mapInArrow(_suspects, rows.schema)
    return rows.where(F.col("kind") == SURE).unionByName(saved(asked, f"{label}-suspected")).drop("kind")


class Filters:
    """The filters of hashes seen twice, of all slices of the hash space."""

    def __init__(self, bits: Broadcast, slices: int) -> None:
        self.bits, self.slices = bits, slices

    def may_repeat(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes the filters hold."""
        part, hit = _slice_of(hashes, self.slices), np.zeros(len(hashes), bool)
        for s in np.unique(part):
            if (bits := self.bits.value.get(int(s))) is not None:
                hit[part == s] = _has(np.frombuffer(bits, np.uint8), hashes[part == s])
        return hit

    def release(self) -> None:
        """Free the executors' copies. Call it when what needs them is written."""
        self.bits.unpersist()


def seen_twice(hashes: DataFrame, number: int, label: str, fill: float = FILL) -> Filters | None:
    """Filters that hold every hash with two rows or more, and few others.

    ``hashes`` has one column ``hash`` of about ``number`` rows, for which the
    caller combines rows before the shuffle (``emitted``). They are dealt out
    to slices of the hash space, each with a pair of filters of fixed size
    through which its hashes stream. The filter of the repeated ones is folded
    to what its contents need. None if they take more than ``MOST_FILTER_BYTES`` together: then take ``repeats``.
    """
    slices = max(16, number // SLICE_HASHES + 1)
    filters = saved(
        hashes.repartition(slices, _slice_column(slices)).mapInArrow(_seen_again(slices, fill), "slice long, bits binary"), label
    )
    if (filters.agg(F.sum(F.length("bits"))).first()[0] or 0) > MOST_FILTER_BYTES:
        return None
    bits = {r.slice: bytes(r.bits) for r in filters.collect()}
    return Filters(hashes.sparkSession.sparkContext.broadcast(bits), slices)
