"""[P1, P2] Raw text columns to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempestry.functions import parsing
from tempestry.schemas import EVENTS, FATALITIES, LOAD_YEAR, MONTH_KEY, REVISION, Dataset


def clean(
    raw: DataFrame,
    dataset: Dataset,
    *,
    date_format: str | None = None,
    century_from: str | None = None,
    on_bad: str = "null",
    single_precision: bool = False,
) -> DataFrame:
    """Select, rename and type the columns of ``dataset``; one narrow projection.

    ``date_format`` replaces the dataset's pattern. ``century_from`` names a
    column with the year of the file, see :func:`parsing.in_century_of`.
    ``on_bad="error"`` stops the job at damage text that is no amount. The
    file's year and revision are kept where the input has them.
    """
    if on_bad not in ("null", "error"):
        raise ValueError(f"on_bad must be 'null' or 'error', not {on_bad!r}")

    def instant(text: Column) -> Column:
        return date_of(text, dataset, date_format, century_from)

    convert = {
        "text": lambda text: text.cast("string"),
        "whole": parsing.whole_number,
        "dollars": parsing.damage_or_error if on_bad == "error" else parsing.damage_dollars,
        "real": lambda text: parsing.real_number(text, single_precision),
        "instant": instant,
    }
    kept = [c for c in (REVISION, LOAD_YEAR, MONTH_KEY) if c in raw.columns]
    return raw.select(*(convert[kind](F.col(source)).alias(name) for source, name, kind in dataset.fields), *kept)


def date_of(text: Column, dataset: Dataset, date_format: str | None = None, century_from: str | None = None) -> Column:
    """A date column of ``dataset``, as :func:`clean` reads it."""
    value = parsing.instant(text, date_format or dataset.date_format)
    return parsing.in_century_of(value, F.col(century_from)) if century_from else value


def clean_events(raw: DataFrame, **options) -> DataFrame:
    """[P1]"""
    return clean(raw, EVENTS, **options)


def clean_fatalities(raw: DataFrame, **options) -> DataFrame:
    """[P2]"""
    return clean(raw, FATALITIES, **options)


def cell_rejects(raw: DataFrame, dataset: Dataset, date_format: str | None = None) -> DataFrame:
    """Per date and number column, the number of cells with text that did not parse; one pass."""
    pattern = date_format or dataset.date_format
    typed = {
        "whole": parsing.whole_number,
        "real": parsing.real_number,
        "instant": lambda text: parsing.instant(text, pattern),
        "dollars": parsing.damage_dollars,
    }
    columns = [source for source, _, kind in dataset.fields if kind in typed]
    kinds = {source: kind for source, _, kind in dataset.fields}
    bad = {c: (parsing.strip(F.col(c)) != "") & typed[kinds[c]](F.col(c)).isNull() for c in columns}
    counts = raw.agg(*(F.count_if(bad[c]).alias(c) for c in columns))
    return counts.unpivot([], columns, "column", "failures")


def damage_rejects(raw: DataFrame) -> DataFrame:
    """Per damage column, the number of cells with text that is no amount; one pass."""
    columns = [source for source, _, kind in EVENTS.fields if kind == "dollars"]
    counts = raw.agg(*(F.count_if(parsing.damage_is_bad(F.col(c))).alias(c) for c in columns))
    return counts.unpivot([], columns, "column", "failures")
