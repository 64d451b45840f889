"""Whiten embeddings by a covariance that comes from variances alone, of single dimensions and of sums of two."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempestry.llm.common import parts_of, saved

#: A vector's entry becomes floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Components returned, and the part of the largest eigenvalue below which a component counts as none.
COMPONENTS, NOTHING = 16, 1e-12
#: Dimensions up to which the sums of all pairs of dimensions (some 8 million) may be collected.
MOST_DIMENSIONS = 4096
#: Rows whose squares are summed at once, and the bits of the lower half of a number: (2 ** 26) ** 2 * 2048 < 2 ** 63.
ROWS, HALF = 2048, 26
#: Entries, and the number of vectors times the range of entries, stay below these.
MOST_ENTRY, MOST_RANGE = 1 << 31, 1 << 51


def scaled(vector: Column) -> Column:
    """A vector as longs; null for one that is null, empty, or holds a null or non-finite entry."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    odd = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(odd, F.lit(False))
    return F.when(fine, F.transform(entries, lambda c: (F.floor(c * SCALE) + OFFSET).cast("long")))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _totals(dims: int) -> Callable:
    """Batches of vectors to a row per dimension: how many, their sum, the smallest and the largest entry of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, sums, least, most = 0, np.zeros(dims, object), 1 << 63, -1 << 63
        for batch in parts_of(batches):
            x = _matrix(batch, dims)
            if len(x):
                least, most = min(least, int(x.min())), max(most, int(x.max()))
                number += len(x)
                sums = sums + (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        if number:
            rows = [{"dim": i, "total": str(v), "n": number, "least": least, "most": most} for i, v in enumerate(sums)]
            yield pa.RecordBatch.from_pylist(rows, _TOTALS)

    return run


_TOTALS = pa.schema({"dim": pa.int32(), "total": pa.string(), "n": pa.int64(), "least": pa.int64(), "most": pa.int64()})


def _square_sums(values: np.ndarray) -> np.ndarray:
    """Exact sums of squares of each column, as Python's integers; entries are below 2 ** 52 by amount."""
    total = np.zeros(values.shape[1], object)
    for at in range(0, len(values), ROWS):
        some = np.abs(values[at : at + ROWS])
        high, low = some >> HALF, some & ((1 << HALF) - 1)
        parts = [np.einsum("ij,ij->j", a, b).astype(object) for a, b in ((high, high), (high, low), (low, low))]
        total = total + parts[0] * (1 << 2 * HALF) + parts[1] * (1 << HALF + 1) + parts[2]
    return total


def _squares(dims: int, n: int, sums: np.ndarray) -> Callable:
    """Batches of vectors to rows (i, j, total): sums of squares of centred dimension i, or of the sum of i and j > i."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(dims - i, object) for i in range(dims)]
        for batch in parts_of(batches):
            x = _matrix(batch, dims)
            for at in range(0, len(x), ROWS):
                z = np.ascontiguousarray((x[at : at + ROWS] * n - sums).T)
                for i in range(dims):
                    pairs = z[i:] + z[i]
                    pairs[0] = z[i]
                    totals[i] = totals[i] + _square_sums(pairs.T)
        for i, row in enumerate(totals):
            columns = [np.full(len(row), i), np.arange(i, dims), [str(v) for v in row]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string()))], ["i", "j", "total"]
            )

    return run


def covariance(variances: dict[tuple[int, int], int], dims: int, n: int) -> np.ndarray:
    """The covariance matrix out of sums of squares, rounded once from exact fractions.

    ``variances[i, i]`` belongs to dimension i and ``variances[i, j]`` to the
    sum of two; var(a + b) = var(a) + var(b) + 2 cov(a, b). Values were scaled by n.
    """
    out = np.zeros((dims, dims))
    for (i, j), total in variances.items():
        shared = total if i == j else Fraction(total - variances[i, i] - variances[j, j], 2)
        out[i, j] = out[j, i] = float(Fraction(shared, n**3))
    return out


class Whitening:
    """A fitted model: the number of different vectors, their sums, the components, and how well they whiten."""

    def __init__(self, dims: int, n: int, sums: np.ndarray, components: np.ndarray, values: np.ndarray, trace: float) -> None:
        self.dims, self.n, self.sums = dims, n, sums
        self.components, self.values, self.explained = components, values, values / trace if trace else values
        self.identity_error = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x * self.n - self.sums

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ self.components / np.sqrt(self.values)


def _measured(model: Whitening) -> Callable:
    """Batches of vectors to rows (a, b, value): sums of products of whitened values, and of these alone (b = -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in parts_of(batches):
            y = model.project(_matrix(batch, model.dims))
            sums += y.sum(axis=0)
            products += y.T @ y
        place = np.arange(k)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([place, np.repeat(place, k)]), pa.int32()),
                pa.array(np.concatenate([np.full(k, -1), np.tile(place, k)]), pa.int32()),
                pa.array(np.concatenate([sums, products.ravel()])),
            ],
            ["a", "b", "value"],
        )

    return run


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``vec_id, x`` of the rows that have a vector, and its dimensions."""
    rows = df.select(F.col(id_col).alias("vec_id"), scaled(F.col(vector_col)).alias("x")).where("x IS NOT NULL")
    rows = saved(rows, "vectors")
    sizes = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return rows, sizes.dims if sizes else 0


def fit(vectors: DataFrame, dims: int, most: int = COMPONENTS) -> Whitening | None:
    """The model of different vectors ``x`` (arrays of ``dims`` longs); None without any component.

    1. Their number and the sums of all dimensions.
    2. Each task sums, exactly, the squares of the centred values of each dimension and
       of the sum of each two dimensions. Tasks' sums are added up by pair.
    3. Differences of these give all covariances, whose eigenvectors are the components.
    4. One more pass measures the covariance of the whitened values.

    What reaches the driver is a number per pair of dimensions, for at most MOST_DIMENSIONS.
    """
    if dims > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {dims} dimensions have more pairs of dimensions than the driver takes")
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    totals = vectors.mapInArrow(_totals(dims), "dim int, total string, n long, least long, most long")
    rows = totals.groupBy("dim").agg(exact, F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    rows = sorted(rows.collect())
    if not rows:
        return None
    sums, n = np.array([int(r.total) for r in rows], object), rows[0].n
    least, most_entry = rows[0].least, rows[0].most
    if max(-least, most_entry) > MOST_ENTRY or 2 * n * max(-least, most_entry) >= 1 << 63 or n * (most_entry - least) > MOST_RANGE:
        raise ValueError("the entries are too large for exact sums of squares in longs")
    sums = sums.astype(np.int64)
    pairs = vectors.mapInArrow(_squares(dims, n, sums), "i int, j int, total string")
    pairs = pairs.groupBy("i", "j").agg(exact).collect()
    cov = covariance({(r.i, r.j): int(r.total) for r in pairs}, dims, n)
    values, components = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > NOTHING * max(values.max(), 0.0)]
    if not len(order):
        return None
    model = Whitening(dims, n, sums, components[:, order], values[order], float(np.trace(cov)))
    k = len(order)
    total, products = np.zeros(k), np.zeros((k, k))
    measured = vectors.mapInArrow(_measured(model), "a int, b int, value double")
    for row in measured.groupBy("a", "b").agg(F.sum("value").alias("value")).collect():
        if row.b < 0:
            total[row.a] = row.value
        else:
            products[row.a, row.b] = row.value
    whitened = products / n - np.outer(total / n, total / n)
    model.identity_error = float(np.abs(whitened - np.eye(k)).max())
    return model


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whitened(model: Whitening) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in parts_of(batches):
            x = _matrix(batch, model.dims)
            rows = len(x)
            z = model.centred(x)
            # Where a sum of squares may leave a long it is summed as Python's integers.
            near = np.square(z.astype(float)).sum(axis=1) < 2.0**62
            deviation = np.einsum("ij,ij->i", z, z).astype(object)
            for r in np.flatnonzero(~near):
                exact = sum(int(v) ** 2 for v in z[r])
                deviation[r] = exact if exact < 1 << 63 else None
            take = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(take)),
                    pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                    pa.array(np.full(rows * k, model.n), pa.int64()),
                    pa.array(deviation.tolist(), pa.int64()).take(pa.array(take)),
                    pa.array(model.project(x).ravel(), pa.float64()),
                    pa.array(np.tile(model.explained, rows), pa.float64()),
                    pa.array(np.full(rows * k, model.identity_error), pa.float64()),
                ],
                [c.split()[0] for c in _OUT.split(", ")],
            )

    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Each vector along up to ``components`` principal components, in units of their standard deviations.

    Returns ``vec_id, component, n, deviation, whitened, explained,
    identity_error``, a row per vector and component. Entries become
    floor(64 c) + 1000000; the model is fitted to each different vector once
    (``fit``), and then applied to all rows.

    Rows whose vector is null, empty, or holds null or non-finite entries are
    left out, as are vectors of another length than most have. Null ids stay
    null, repeated rows get equal results. Components without variance are
    left out, so equal vectors, a single one and an empty table give no rows.
    A deviation beyond a long is null; entries too large for exact sums raise
    an error. Further columns are ignored.
    """
    rows, dims = _vectors(df, id_col, vector_col)
    rows = rows.where(F.size("x") == dims)
    # Copies combine in the task that reads them, before the shuffle.
    different = saved(rows.select("x").distinct(), "different-vectors") if dims else rows.select("x").limit(0)
    model = fit(different, dims, components) if dims else None
    if model is None:
        return df.sparkSession.createDataFrame([], _OUT)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(_whitened(model), _OUT)
