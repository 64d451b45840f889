"""[A1-A4, J1, O1-O3] The four summary tables.

Each aggregates on the map side first, so a group that holds a third of the
rows reaches the shuffle as one row per task. The final sorts order results
of a few thousand rows at most (years x types) for presentation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.functions import codes


def costliest_events(events: DataFrame) -> DataFrame:
    """[A1, C12] Damage per start year and event type, undated events included.

    A row without one of its two amounts adds nothing, as its sum is null.
    """
    damage = F.col("damage_crops") + F.col("damage_property")
    return events.groupBy("event_start_year", "event_type").agg(F.sum(damage).alias("cost"))


def fatalities_by_month(fatalities: DataFrame) -> DataFrame:
    """[A2, F2, O1] Fatalities per year and month, undated ones left out."""
    dated = fatalities.filter(F.col("fatality_month").isNotNull())
    counts = dated.groupBy("fatality_year", "fatality_month").agg(F.count(F.lit(1)).alias("fatality_count"))
    return counts.orderBy("fatality_year", "fatality_month")


def fatalities_by_sex(fatalities: DataFrame) -> DataFrame:
    """[A3, F3, O2] Fatalities per year and sex, undated ones left out."""
    dated = fatalities.filter(F.col("fatality_year").isNotNull())
    counts = dated.groupBy("fatality_year", "fatality_sex").agg(F.count(F.lit(1)).alias("fatality_count"))
    return counts.orderBy("fatality_year")


def fatality_type_by_event_type(
    events: DataFrame, fatalities: DataFrame, labels: Sequence[str] = codes.TYPE_LABELS
) -> DataFrame:
    """[J1, A4, O3] Fatalities per start year, event type and fatality type.

    Fatalities are counted per event id before the join, one column for each of
    ``labels``, which are all that :func:`codes.decode` gives; another one
    stops the job. This changes no sum, but an
    event with a third of all fatalities reaches the shuffle as one row per
    map task and the join as a single row, and as the count is by event id
    alone, the join needs no further shuffle of it. Fatalities without id
    count 0 but keep their group; rows without event id take no part.
    """
    label = F.col("fatality_type")
    known = F.when(label.isin(*labels), label).otherwise(F.raise_error(F.concat(F.lit("not a decoded type: "), label)))
    per_event = (
        fatalities.filter(F.col("event_id").isNotNull())
        .select("event_id", "fatality_id", known.alias("_label"))
        .groupBy("event_id")
        .agg(
            *(F.count_if(F.col("_label") == text).alias(f"rows_{text}") for text in labels),
            *(F.count(F.when(F.col("_label") == text, F.col("fatality_id"))).alias(text) for text in labels),
        )
    )
    joined = events.select("event_id", "event_start_year", "event_type").join(per_event, "event_id")
    totals = joined.groupBy("event_start_year", "event_type").agg(
        *(F.sum(c).alias(c) for c in per_event.columns if c != "event_id")
    )
    one_per_label = F.inline(
        F.array(
            *(
                F.struct(
                    F.lit(text).alias("fatality_type"),
                    F.col(text).alias("fatality_count"),
                    F.col(f"rows_{text}").alias("_rows"),
                )
                for text in labels
            )
        )
    )
    counts = totals.select("event_start_year", "event_type", one_per_label).filter("_rows > 0").drop("_rows")
    return counts.orderBy("event_type")
