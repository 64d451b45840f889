"""Helpers of the operators: reading and saving tables, words and their hashes."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempestry.session import scratch_path

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` and ``bytes.strip()`` use the same six.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BLANK_RUN = r"[\x20\x09-\x0D]+"

#: An odd multiplier for hashes of windows, and one for their last mix (fixed values).
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Bytes at which a batch for the Python workers ends, the setting for it, and Spark's own value.
BATCH_BYTES, _BATCH_BYTES, _BATCH_DEFAULT = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: Settings with which the workers' allocators keep little of what was freed.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(16 << 20),
}
#: Most rows of a table that is broadcast, each of a few numbers and a name.
FEW_ROWS = 50_000


def reachable(spark: SparkSession) -> None:
    """Let the Python workers find this package where it lies outside their working folder, and bound Arrow batches.

    On a cluster the package is shipped with ``--py-files``, and the path changes nothing. Batches
    that Spark sends to the workers are ended by BATCH_BYTES, unless the session sets a size itself, and the
    workers give memory back that they no longer need.
    """
    if spark.conf.get(_BATCH_BYTES, None) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders written by ``saved`` within the innermost ``tidied``.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read back.

    Cuts the lineage with files that outlive executors, and fixes values such
    as partition ids that a second run of the plan could number anew. The
    files stay until ``tidied`` or the owner of the shared folder removes them.
    """
    path = scratch_path(df.sparkSession, label)
    if (written := _written.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Remove, when the block ends, the tables that operators saved inside.

    Results are lazy and may read these tables, so write a result inside the block, to a place of its own::

        with tidied(spark):
            near_dups.similar_documents(docs).write.parquet(path)
    """
    token = _written.set([])
    try:
        yield
    finally:
        folders = _written.get() or []
        _written.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for folder in folders:
            path = hadoop.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 that follows from the key alone; null counts as a key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def known_apart(df: DataFrame, key: str, more: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with different ``key`` where rows of one 64-bit key differ in ``more``, and the counts of all repeated keys.

    ``more`` are further hashes or sizes of what ``key`` stands for. The second table has ``key, copies`` of each
    key with two rows or more. Rows of equal ``key`` and ``more`` keep one key; such clashes are about one
    pair of keys among six billion different ones, so as a rule none is there and the join is left out.
    """
    other = F.struct(*more)
    counts = saved(
        df.groupBy(key).agg(F.count("*").alias("copies"), F.min(other).alias("low"), F.max(other).alias("high")).where("copies > 1"),
        label,
    )
    clash = counts.where(F.col("low") != F.col("high")).select(key)
    if clash.isEmpty():
        return df, counts.select(key, "copies")
    marked = df.join(share(clash.withColumn("_clash", F.lit(True)), FEW_ROWS), key, "left")
    apart = marked.withColumn(key, F.when(F.col("_clash"), F.xxhash64(key, *more)).otherwise(F.col(key))).drop("_clash")
    return apart, apart.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def share(df: DataFrame, most_rows: int) -> DataFrame:
    """``df``, with the hint to broadcast it if it has few rows.

    The rows are counted, so only a table of known size is sent to all
    executors; a larger one is joined by a shuffle.
    """
    return F.broadcast(df) if df.count() <= most_rows else df


_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS.encode())] = True
#: The low bytes of a number of eight that belong to a word of 0 to 8 bytes.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longest words, in bytes, that are hashed together with others.
LANES = 64
#: Bytes of a text that are hashed at once.
PART_BYTES = 1 << 20


def word_hashes(text: bytes, seed: int = 0) -> np.ndarray:
    """64-bit hashes of a text's words in order, the same in every process.

    Words are taken eight bytes at a time, each time mixed into the hash by a
    one-to-one function, so different words of one length up to eight bytes
    never collide. Words above LANES bytes get their XXH3. Hashes by two
    seeds are independent.
    """
    parts, at = [], 0
    while at < len(text):
        end = at + PART_BYTES
        if end < len(text):
            # Cut after a blank, or else behind the word that has none.
            cut = max(text.rfind(b, at, end) for b in map(bytes, zip(BLANKS.encode())))
            if cut < 0:
                following = [p for p in (text.find(b, end) for b in map(bytes, zip(BLANKS.encode()))) if p >= 0]
                cut = min(following, default=len(text))
            end = cut + 1
        parts.append(_part_hashes(text[at:end], seed)[0])
        at = end
    return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.empty(0, np.uint64)


def hashed_texts(texts: Iterable[bytes | None], width: int, lower: bool = False) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Each text, the hashes of its words, and those of every ``width`` consecutive words of it.

    Texts are hashed PART_BYTES at a time, as one array operation costs more to begin than a short text to
    hash; longer ones come alone. Null is empty. ``lower`` hashes A-Z as small letters.
    """
    held: list[bytes] = []
    size = 0

    def done() -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
        joined = b"\n".join(held)
        hashes, starts = _part_hashes(joined.lower() if lower else joined, 0)
        ends = np.cumsum([len(t) + 1 for t in held])
        bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
        windows = window_hashes(hashes, width)
        for text, a, b in zip(held, bounds[:-1].tolist(), bounds[1:].tolist()):
            yield text, hashes[a:b], windows[a : max(a, b - width + 1)]

    for text in texts:
        text = text or b""
        if held and size + len(text) > PART_BYTES:
            yield from done()
            held, size = [], 0
        if len(text) > PART_BYTES:
            hashes = word_hashes(text.lower() if lower else text)
            yield text, hashes, window_hashes(hashes, width)
        else:
            held.append(text)
            size += len(text)
    if held:
        yield from done()


def _part_hashes(text: bytes, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, and where the words begin."""
    codes = np.frombuffer(text, np.uint8)
    inside = np.empty(len(codes) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_BLANK[codes], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eights = np.ndarray(len(text) + 1, "<u8", text + bytes(8), strides=(1,))
    with np.errstate(over="ignore"):
        out = mixed((eights[starts] & _LOW[np.minimum(sizes, 8)]) + mixed(np.array([seed], np.uint64)))
        out = mixed(out ^ sizes.astype(np.uint64) * STEP)
        for at in range(8, LANES, 8):
            more = np.flatnonzero((sizes > at) & (sizes <= LANES))
            if not len(more):
                break
            out[more] = mixed(out[more] ^ (eights[starts[more] + at] & _LOW[np.minimum(sizes[more] - at, 8)]))
    for k in np.flatnonzero(sizes > LANES):
        out[k] = xxhash.xxh3_64_intdigest(text[starts[k] : starts[k] + sizes[k]], seed)
    return out, starts


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    values = (values ^ (values >> np.uint64(32))) * MIX
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(32))


def window_hashes(hashes: np.ndarray, width: int, step: np.uint64 = STEP) -> np.ndarray:
    """A hash of every ``width`` consecutive words; empty if there are fewer words.

    Built by doubling: the hash of 2k words is made of two hashes of k words.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, have, power = np.zeros(n, np.uint64), 0, np.uint64(1)
    part, length, scale = hashes, 1, step
    with np.errstate(over="ignore"):
        while True:
            if width & length:
                out += part[have : have + n] * power
                have += length
                power *= scale
            if length * 2 > width:
                return mixed(out)
            part = part[:-length] + part[length:] * scale
            length, scale = length * 2, scale * scale


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n positions lie in a window of ``width`` that begins at one of ``starts``."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return np.cumsum(edges[:n]) > 0


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's long."""
    return values.astype(np.uint64, copy=False).view(np.int64)


def values(column: pa.Array) -> Iterator:
    """The values of an Arrow column one by one, so that long texts are not all copied at once."""
    return (value.as_py() for value in column)


def parts_of(batches: Iterable[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows``. Memory that a task no longer needs is given back at its end."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def batches_of(rows: Iterable[tuple], schema: pa.Schema, most: int = 1000, most_chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``most`` rows, ended early by the row that reaches ``most_chars`` of text."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(column, field.type) for column, field in zip(zip(*held), schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if len(held) >= most or size >= most_chars:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the keys of ``left`` are kept."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_right_{k}"]) for k in keys]
    return left.join(right, on, how).drop(*(f"_right_{k}" for k in keys))
