"""[P5, P6] Staged rows with calendar columns and decoded codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.functions import calendar, codes
from tempestry.schemas import FACT_EVENT_COLUMNS, FACT_FATALITY_COLUMNS


def fact_events(staged: DataFrame, fix_year_month: bool = False) -> DataFrame:
    """[P5] Adds month, year and year-month label of the start.

    The label joins the year of the start with the month of the end, which
    downstream users rely on; ``fix_year_month`` takes the start for both.
    """
    start, end = F.col("event_start_date"), F.col("event_end_date")
    return staged.withColumns(
        {
            "event_start_month": calendar.month_number(start),
            "event_start_year": calendar.year_number(start),
            "event_start_year_month": calendar.year_month_label(start, start if fix_year_month else end),
        }
    ).select(*FACT_EVENT_COLUMNS)


def fact_fatalities(staged: DataFrame) -> DataFrame:
    """[P6] Adds month, year and label, decodes type and sex, drops the age."""
    date = F.col("fatality_date")
    return staged.withColumns(
        {
            "fatality_type": codes.decode(F.col("fatality_type"), codes.FATALITY_TYPES),
            "fatality_sex": codes.decode(F.col("fatality_sex"), codes.SEXES),
            "fatality_month": calendar.month_number(date),
            "fatality_year": calendar.year_number(date),
            "fatality_year_month": calendar.year_month_label(date, date),
        }
    ).select(*FACT_FATALITY_COLUMNS)
