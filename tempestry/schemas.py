"""The two datasets: raw columns, typed columns, and where each value comes from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column names, their order, formats and file name parts ---

#: kind of a field -> Spark type of the cleaned column
FIELD_TYPES = {
    "text": T.StringType(),
    "whole": T.LongType(),
    "dollars": T.LongType(),
    "real": T.DoubleType(),
    "instant": T.TimestampType(),
}

EVENT_FIELDS = (
    ("EVENT_ID", "event_id", "text"),
    ("STATE", "state", "text"),
    ("EVENT_TYPE", "event_type", "text"),
    ("BEGIN_DATE_TIME", "event_start_date", "instant"),
    ("END_DATE_TIME", "event_end_date", "instant"),
    ("INJURIES_DIRECT", "injuries_direct", "whole"),
    ("INJURIES_INDIRECT", "injuries_indirect", "whole"),
    ("DEATHS_DIRECT", "deaths_direct", "whole"),
    ("DEATHS_INDIRECT", "deaths_indirect", "whole"),
    ("DAMAGE_PROPERTY", "damage_property", "dollars"),
    ("DAMAGE_CROPS", "damage_crops", "dollars"),
    ("SOURCE", "source", "text"),
    ("MAGNITUDE", "magnitude", "real"),
    ("MAGNITUDE_TYPE", "magnitude_type", "text"),
)

FATALITY_FIELDS = (
    ("FATALITY_ID", "fatality_id", "text"),
    ("EVENT_ID", "event_id", "text"),
    ("FATALITY_TYPE", "fatality_type", "text"),
    ("FATALITY_DATE", "fatality_date", "instant"),
    ("FATALITY_AGE", "fatality_age", "whole"),
    ("FATALITY_SEX", "fatality_sex", "text"),
    ("FATALITY_LOCATION", "fatality_location", "text"),
)

EVENT_DATE_FORMAT = "d-MMM-yy HH:mm:ss"
FATALITY_DATE_FORMAT = "dd/MM/yyyy HH:mm:ss"

FACT_EVENT_COLUMNS = (
    "event_id", "state", "event_type",
    "event_start_date", "event_start_month", "event_start_year", "event_start_year_month", "event_end_date",
    "injuries_direct", "injuries_indirect", "deaths_direct", "deaths_indirect",
    "damage_property", "damage_crops", "source", "magnitude", "magnitude_type",
)

FACT_FATALITY_COLUMNS = (
    "fatality_id", "event_id", "fatality_type",
    "fatality_date", "fatality_month", "fatality_year", "fatality_year_month",
    "fatality_sex", "fatality_location",
)

# --- end of fixed values ---

#: year of the file a row came from; first partition level of the loaded tables
LOAD_YEAR = "load_year"
#: revision tag of the file a row came from; later revisions sort after earlier ones
REVISION = "revision"
#: ``yyyy-MM`` of the dataset's date column; second partition level
MONTH_KEY = "month_key"


@dataclass(frozen=True)
class Dataset:
    """One of the two yearly files and the table it is loaded into."""

    name: str
    file_kind: str
    key: str
    date: str
    date_format: str
    fields: tuple[tuple[str, str, str], ...]

    @property
    def raw_columns(self) -> list[str]:
        return [raw for raw, _, _ in self.fields]

    @property
    def columns(self) -> list[str]:
        return [name for _, name, _ in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, FIELD_TYPES[kind]) for _, name, kind in self.fields])

    @property
    def table_schema(self) -> T.StructType:
        """The cleaned columns, the file's revision and the two partition columns."""
        return T.StructType(
            self.schema.fields
            + [T.StructField(REVISION, T.StringType()), T.StructField(LOAD_YEAR, T.IntegerType()), T.StructField(MONTH_KEY, T.StringType())]
        )


EVENTS = Dataset("events", "details", "event_id", "event_start_date", EVENT_DATE_FORMAT, EVENT_FIELDS)
FATALITIES = Dataset(
    "fatalities", "fatalities", "fatality_id", "fatality_date", FATALITY_DATE_FORMAT, FATALITY_FIELDS
)
DATASETS = {d.name: d for d in (EVENTS, FATALITIES)}
