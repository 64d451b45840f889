"""Pack tokenized documents into few sequences: large pieces are matched in pairs, small ones best-fit the gaps."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from struct import pack as pack_numbers
from threading import Timer
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempestry.llm.common import batches_of, parts_of, saved, values

CAPACITY = 4096
#: The id that ends a document (fixed value).
END = 1
#: Words whose ids a worker remembers, some 200 bytes each. It begins anew when several times as many were not.
REMEMBERED_WORDS = 400_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
_PIECES = pa.schema(
    {
        "doc_id": pa.int64(),
        "piece": pa.int32(),
        "start": pa.int64(),
        "length": pa.int64(),
        "ids_crc32": pa.int64(),
        "part": pa.int32(),
        "place": pa.int64(),
    }
)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: its own if it is shown, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(others)}


_LETTERS = _byte_letters()


#: Marks at the end of a word, of all ASCII ones but the apostrophe.
_MARKS = re.compile(rb"[!-&(-/:-@\[-`{-~]+(?![^\x20\x09-\x0D])")
_LETTER = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")


def _apart(found: re.Match) -> bytes:
    """The marks with a blank before them, if they follow a letter or digit surely (A-Z, 0-9, U+00C0 to U+00FF)."""
    text, at = found.string, found.start()
    if at and (
        text[at - 1] in _LETTER or at > 1 and text[at - 2] == 0xC3 and 0x80 <= text[at - 1] <= 0xBF and text[at - 1] not in (0x97, 0xB7)
    ):
        return b" " + found[0]
    return found[0]


class Encoder(dict):
    """Ids of texts by a tokenizer that never joins characters across ASCII white space.

    So a text's ids are those of its words, one after the other, and a word is
    encoded once and remembered. Ids are kept as little-endian bytes, 4 each.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.refused = 0

    def __missing__(self, word: bytes) -> bytes:
        ids = self._ids(word)
        ids = pack_numbers(f"<{len(ids)}I", *ids)
        if len(self) < REMEMBERED_WORDS:
            self[word] = ids
        else:
            self.refused += 1
        return ids

    def _ids(self, word: bytes) -> list[int]:
        text = word.decode("utf-8", "replace")
        # The tokenizer neither changes nor splits letters in lower case and normal form.
        if text.isalpha() and text == text.lower() and is_normalized("NFC", text):
            return [t.id for t in self.model.tokenize(word.decode("latin-1").translate(_LETTERS))]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def of(self, text: bytes | None) -> bytes:
        """The ids of a text, without the id that ends it."""
        text = text or b""
        if b"<|" not in text:  # the beginning of a special token
            text = _MARKS.sub(_apart, text)
            # The tokenizer lowers letters itself, but after joining them to marks of U+0300 to U+033F.
            if b"\xcc" not in text:
                text = text.lower()
        ids = b"".join(map(self.__getitem__, text.split()))
        if self.refused > 4 * REMEMBERED_WORDS:
            self.clear()
            self.refused = 0
        return ids


_encoders: dict[str, Encoder] = {}
#: Seconds after its last task in which a worker forgets its words.
FORGET_AFTER = 2.0
_forget: Timer | None = None


@contextmanager
def _encoder(tokenizer: str) -> Iterator[Encoder]:
    """The worker's encoder: its words last from task to task, but not while the worker waits for other work."""
    global _forget
    if _forget is not None:
        _forget.cancel()
    encoder = _encoders.pop(tokenizer, None) or Encoder(tokenizer)
    try:
        yield encoder
    finally:
        _encoders[tokenizer] = encoder
        _forget = Timer(FORGET_AFTER, _encoders.clear)
        _forget.daemon = True
        _forget.start()


def _cut(tokenizer: str, capacity: int, end: int):
    """Batches of (doc_id, text, part) to pieces, each with its place among its partition's pieces of its length."""
    last = np.array([end], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        places: Counter = Counter()
        with _encoder(tokenizer) as encode:
            for batch in parts_of(batches):
                ids, parts, texts = (values(batch.column(n)) for n in ("doc_id", "part", "text"))
                for doc, part, text in zip(ids, parts, texts):
                    encoded = encode.of(text) + last
                    for number, start in enumerate(range(0, len(encoded), 4 * capacity)):
                        piece = encoded[start : start + 4 * capacity]
                        length = len(piece) // 4
                        yield doc, number, start // 4, length, zlib.crc32(piece), part, places[length]
                        places[length] += 1

    return lambda batches: batches_of(pieces(batches), _PIECES, 10_000)


def runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first, how many, first sequence, offset).

    ``counts`` has the number of pieces of each length, so at most ``capacity``
    entries; the plan's size follows from their number and not from that of the
    pieces. Pieces ``first, first + 1, ...`` of a length go to the sequences
    ``first sequence, first sequence + 1, ...``, all at one offset.

    Pieces above a third of the capacity come first, longest first. Each takes
    as its partner the longest other one that fits, so at most two of them
    share a sequence. Shorter ones follow, longest first, each into the
    smallest gap that holds it, or into new sequences if none does.
    """
    left, taken = dict(counts), Counter()
    out: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: ranges (first sequence, how many)
    order: list[int] = []  # gaps with ranges, ascending
    sequences = 0

    def put(length: int, number: int, first: int, offset: int) -> None:
        out.append((length, taken[length], number, first, offset))
        taken[length] += number
        left[length] -= number

    def leave(gap: int, first: int, number: int) -> None:
        if gap and number:
            if not gaps[gap]:
                insort(order, gap)
            gaps[gap].append((first, number))

    large = sorted(n for n, k in counts.items() if 3 * n > capacity and k > 0)
    for length in reversed(large):
        while left[length]:
            number, mate = left[length], None
            at = bisect_left(large, capacity - length + 1) - 1
            while at >= 0:
                other = large[at]
                if left[other] > (other == length):
                    mate = other
                    break
                del large[at]
                at -= 1
            if mate is None:
                put(length, number, sequences, 0)
                leave(capacity - length, sequences, number)
            elif mate == length:
                number = number // 2
                put(length, number, sequences, 0)
                put(length, number, sequences, length)
                leave(capacity - 2 * length, sequences, number)
            else:
                number = min(number, left[mate])
                put(length, number, sequences, 0)
                put(mate, number, sequences, length)
                leave(capacity - length - mate, sequences, number)
            sequences += number
    for length in sorted((n for n, k in counts.items() if 3 * n <= capacity and k > 0), reverse=True):
        while left[length]:
            at = bisect_left(order, length)
            if at == len(order):
                number = -(-left[length] // (capacity // length))
                leave(capacity, sequences, number)
                sequences += number
                continue
            gap = order[at]
            first, size = gaps[gap].pop()
            if not gaps[gap]:
                del order[at]
            number = min(size, left[length])
            put(length, number, first, capacity - gap)
            leave(gap - length, first, number)
            leave(gap, first + number, size - number)
    return out


def _placed(plan: list[tuple[int, int, int, int, int]]):
    """Batches of pieces with their rank among those of their length, to sequence and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, tuple[np.ndarray, ...]] = {}
        found = defaultdict(list)
        for length, *rest in plan.value:
            found[length].append(rest)
        for length, rest in found.items():
            by_length[length] = tuple(np.array(column) for column in zip(*rest))
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                here = lengths == length
                firsts, _, sequences, offsets = by_length[int(length)]
                at = np.searchsorted(firsts, ranks[here], "right") - 1
                sequence[here] = sequences[at] + ranks[here] - firsts[at]
                offset[here] = offsets[at]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return run


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """Every document's pieces and their places in sequences of at most ``capacity`` tokens.

    A document is the ids of its text and then ``end``; only longer ones are
    cut, into pieces of ``capacity`` tokens and a last one. Returns ``doc_id,
    piece, start, length, ids_crc32, sequence_id, offset``.

    A plan needs only the number of pieces of each length: these few counts are
    collected, and the plan (see ``runs``) is broadcast; both are bounded by
    the capacity. A piece's rank among those of its length is the number of
    them in earlier partitions plus its place in its own, so no length, however
    frequent, is gathered in one task.

    Null text is empty: one piece, of the id ``end``. Rows repeated with one id
    are documents of their own. An empty table gives no rows; null ids stay
    null; further columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.spark_partition_id().alias("part")
    )
    cut = texts.mapInArrow(_cut(tokenizer, capacity, end), PIECES)
    pieces = saved(cut, "pieces")
    held = pieces.groupBy("length", "part").agg(F.count("*").alias("held"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = saved(held.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0))), "piece-counts")
    counts = {r.length: r.held for r in before.groupBy("length").agg(F.sum("held").alias("held")).collect()}
    plan = spark.sparkContext.broadcast(runs(counts, capacity))
    ranked = pieces.join(before.select("length", "part", "before"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("before")).alias("rank")
    )
    return ranked.mapInArrow(
        _placed(plan), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
