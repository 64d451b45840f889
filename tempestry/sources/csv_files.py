"""[S1, S2, S3] Yearly gzip CSV files with a header line."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempestry.schemas import LOAD_YEAR, MONTH_KEY, REVISION, Dataset

# --- fixed value: how the published files are named; a revision tag and .csv.gz follow ---
FILE_NAME = "StormEvents_{kind}-ftp_v1.0_d{year}"
# --- end of fixed value ---

#: column of rows that do not fit their header
_BAD = "_bad"
#: compressed bytes of a file that make one piece, see :func:`deal_out`
PIECE_BYTES = 32 * 1024 * 1024


#: what to do with rows that do not fit their header
BAD_ROWS = ("error", "null")


def _columns(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The header's columns, from the first line."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(paths).columns


def _scan(spark: SparkSession, paths: str | list[str], multiline: bool) -> DataFrame:
    """All columns as text, and the whole row in ``_bad`` where it does not fit the header.

    Such a row has fewer or more fields than the header, or a quote that is
    never closed, behind which the rest of the file would be one field.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*_columns(spark, paths), _BAD]])
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)
        # Pruned columns are not counted, so that a short row would pass.
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", _BAD)
        .schema(schema)
        .csv(paths)
    )


def read_csv(
    spark: SparkSession, paths: str | list[str], dataset: Dataset, *, multiline: bool = True, bad_rows: str = "error"
) -> DataFrame:
    """The dataset's raw columns as text, nothing inferred.

    ``multiline`` lets quoted fields hold line ends. It makes one task read a
    whole file, as gzip does anyway; for large uncompressed files without such
    fields turn it off, so that they are split, and a quote that is never
    closed ends with its line. Columns are found by header name, and every
    file's header is checked against the first one's.

    A row that does not fit its header stops the job with a message that shows
    how it begins; ``bad_rows="null"`` keeps what fits, the rest is null. See :func:`csv_rejects`.
    """
    if bad_rows not in BAD_ROWS:
        raise ValueError(f"bad_rows must be one of {BAD_ROWS}, not {bad_rows!r}")
    lines = _scan(spark, paths, multiline)
    if bad_rows == "error":
        message = F.concat(F.lit("row does not fit the header: "), F.left(F.col(_BAD), F.lit(200)))
        first = dataset.raw_columns[0]
        checked = F.when(F.col(_BAD).isNotNull(), F.raise_error(message).cast("string")).otherwise(F.col(first))
        lines = lines.withColumn(first, checked)
    return lines.select(*dataset.raw_columns)


def csv_rejects(spark: SparkSession, paths: str | list[str], *, multiline: bool = True) -> DataFrame:
    """Per file, the rows that do not fit its header: ``file, rows, bad_rows``."""
    lines = _scan(spark, paths, multiline)
    # Spark refuses to read the column of bad rows alone, hence the one beside it.
    bad = F.when(F.col(_BAD).isNotNull(), F.coalesce(F.col(f"`{lines.columns[0]}`"), F.lit("")))
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(bad).alias("bad_rows")
    )


def _name_pattern(dataset: Dataset, year: str) -> str:
    return FILE_NAME.replace(".", "[.]").format(kind=dataset.file_kind, year=year)


def _year_of(path: Column, dataset: Dataset) -> Column:
    return F.regexp_extract(path, _name_pattern(dataset, r"([0-9]+)"), 1).cast("int")


def _revision_of(path: Column, dataset: Dataset) -> Column:
    """What follows the year in a file's name, up to the first point; null if nothing does."""
    found = F.regexp_extract(path, _name_pattern(dataset, "[0-9]+") + "_?([^./]*)", 1)
    return F.when(found != "", found)


@dataclass(frozen=True)
class YearFile:
    year: int
    path: str
    size: int


def year_files(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    years: Iterable[int],
    layout: str = "{name}",
    revision: str | None = None,
) -> list[YearFile]:
    """[S2] One file per year, else a year would load twice.

    Where a year has several revisions, ``revision`` chooses the ``"first"`` or
    the ``"latest"`` by name; without a choice that is an error. A name may
    stand for a file or for a folder of part files, and ``layout`` says how it
    begins below ``root``. Only the listing is read, not the content; its
    entries pass the driver, what is collected is one per year. A year
    without any file raises ``PATH_NOT_FOUND``.
    """
    if revision not in (None, "first", "latest"):
        raise ValueError(f"revision must be 'first' or 'latest', not {revision!r}")
    names = [FILE_NAME.format(kind=dataset.file_kind, year=year) for year in years]
    if not names:
        raise ValueError("no year to read")
    listing = spark.read.format("binaryFile").load([f"{root}/{layout.format(name=name)}*" for name in names])
    entry = F.regexp_extract("path", f"^(.*/[^/]*{_name_pattern(dataset, '[0-9]+')}[^/]*)", 1)
    entries = listing.groupBy(entry.alias("path")).agg(F.sum("length").alias("size"))
    file = F.struct("path", "size")
    found = (
        entries.groupBy(_year_of(F.col("path"), dataset).alias("year"))
        .agg(F.min(file).alias("first"), F.max(file).alias("latest"))
        .orderBy("year")
        .collect()
    )
    several = [row for row in found if row.first != row.latest]
    if several and revision is None:
        names = "; ".join(f"{row.year}: {row.first.path} to {row.latest.path}" for row in several)
        raise ValueError(f"choose a revision, as several match: {names}")
    return [YearFile(row.year, *(row.latest if revision == "latest" else row.first)) for row in found]


def read_year_files(
    spark: SparkSession,
    files: Iterable[YearFile],
    dataset: Dataset,
    *,
    multiline: bool = True,
    same_header: bool = True,
    bad_rows: str = "error",
) -> DataFrame:
    """[S1, K8] All ``files`` in one job, with the file's year as ``load_year`` and its ``revision``.

    The year comes from the file name: dates in the rows can be missing or a
    century off. Files whose headers differ are an error; with ``same_header``
    off, each is read by its own header.
    """
    paths = [file.path for file in files]
    groups = [paths] if same_header else [[path] for path in paths]
    scans = [
        read_csv(spark, group, dataset, multiline=multiline, bad_rows=bad_rows).withColumns(
            {
                REVISION: _revision_of(F.col("_metadata.file_path"), dataset),
                LOAD_YEAR: _year_of(F.col("_metadata.file_path"), dataset),
            }
        )
        for group in groups
    ]
    return reduce(DataFrame.unionByName, scans)


def deal_out(
    rows: DataFrame, files: Iterable[YearFile], piece_bytes: int = PIECE_BYTES, month: Column | None = None
) -> DataFrame:
    """Spread the rows of each year over as many pieces as the size of its file asks for.

    ``month`` is dealt by too and kept as ``month_key``: the rows then are laid
    out for the loaded tables, and a month has a twelfth of the pieces.

    A gzip file is read by one task, and all its rows are in that task's
    shuffle output, which adaptive execution cannot split. Dealt out in turn,
    a file with a third of all rows is typed and written by many tasks, while
    a small one stays one piece. ``rows`` must come straight from the scan: a
    retried task then reads and deals the same rows in the same order.
    """
    parts = piece_bytes if month is None else 12 * piece_bytes
    pieces = F.create_map(*(F.lit(n) for file in files for n in (file.year, -(-file.size // parts) or 1)))
    dealt = rows.withColumn("_piece", F.pmod(F.monotonically_increasing_id(), pieces[F.col(LOAD_YEAR)]))
    if month is None:
        return dealt.hint("rebalance", LOAD_YEAR, "_piece").drop("_piece")
    return dealt.withColumn(MONTH_KEY, month).hint("rebalance", LOAD_YEAR, MONTH_KEY, "_piece").drop("_piece")
