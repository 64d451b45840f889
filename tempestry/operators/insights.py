"""[D1-D4] The questions asked of the marts. Input is a mart: years x types x a few labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _best(df: DataFrame, per: list[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*per).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def top_fatality_type(type_by_event: DataFrame) -> DataFrame:
    """[D1] Most common fatality type per year and event type."""
    return _best(type_by_event, ["event_start_year", "event_type"], [F.desc("fatality_count"), F.asc("fatality_type")])


def fatality_balance(type_by_event: DataFrame) -> DataFrame:
    """[D1] Share of each fatality type within its year and event type, in percent."""
    return _share(type_by_event, ["event_start_year", "event_type"])


def peak_month(by_month: DataFrame) -> DataFrame:
    """[D2] Month with the most fatalities of each year."""
    return _best(by_month, ["fatality_year"], [F.desc("fatality_count"), F.asc("fatality_month")])


def top_cost(costliest: DataFrame, k: int = 10) -> DataFrame:
    """[D3] The ``k`` costliest pairs of year and event type, undated events left out."""
    dated = costliest.filter(F.col("event_start_year").isNotNull())
    return dated.orderBy(F.desc("cost"), "event_type", "event_start_year").limit(k)


def cost_rank(costliest: DataFrame) -> DataFrame:
    """[D3] Event types of each year ranked by cost, the costliest first."""
    order = Window.partitionBy("event_start_year").orderBy(F.desc_nulls_last("cost"), F.asc_nulls_first("event_type"))
    dated = costliest.filter(F.col("event_start_year").isNotNull())
    return dated.withColumn("cost_rank", F.row_number().over(order).cast("bigint"))


def sex_share(by_sex: DataFrame) -> DataFrame:
    """[D4] Share of each sex in the fatalities of a year, in percent."""
    return _share(by_sex, ["fatality_year"])


def _share(counts: DataFrame, per: list[str]) -> DataFrame:
    total = F.sum("fatality_count").over(Window.partitionBy(*per))
    return counts.withColumn("share", F.round(F.lit(100.0) * F.col("fatality_count") / total, 1))
