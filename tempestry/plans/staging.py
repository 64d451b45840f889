"""[W1, W2, K6, K8] Staged tables kept up to date: after a load only keys of the years it changed are staged again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempestry.operators import dedup
from tempestry.schemas import LOAD_YEAR, REVISION, Dataset
from tempestry.session import scratch_path
from tempestry.sources import versions

#: stands for the null key in joins; a row whose key is this text is only looked at once more than needed
_NO_KEY = "\x00"
_KEY = "_key"
#: one in so many keys is looked up first, see :func:`all_shared`
PROBE = 64


def staged_schema(dataset: Dataset) -> T.StructType:
    """The staged columns and the year of the file of the row that was kept."""
    return T.StructType([*dataset.schema.fields, T.StructField(LOAD_YEAR, T.IntegerType())])


def read_staged(spark: SparkSession, staged_root: str, dataset: Dataset, at: versions.Version | None = None) -> DataFrame:
    """The staged table, equal to :func:`dedup.stage` of the loaded version it was made from."""
    return versions.read(spark, staged_root, staged_schema(dataset), at).select(*dataset.columns)


def _first(rows: DataFrame, dataset: Dataset, latest_load_wins: bool) -> DataFrame:
    """One row per key with its year, which decides last among equal rows."""
    order = [F.desc_nulls_last(REVISION)] if latest_load_wins else []
    columns = [*dataset.columns, *([REVISION] if latest_load_wins else []), LOAD_YEAR]
    return dedup.first_per_key(rows.select(*columns), dataset.key, order).select(*dataset.columns, LOAD_YEAR)


def _key(dataset: Dataset) -> Column:
    return F.coalesce(F.col(dataset.key), F.lit(_NO_KEY)).alias(_KEY)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_keys(others: DataFrame, keys: DataFrame, dataset: Dataset) -> DataFrame:
    """Keys of ``keys`` that rows of other years have too, with those years.

    Of the other years only the key column is read. The comparison holds for
    every key; it marks the keys as a filter for Spark, which then builds a
    Bloom filter of them at run time and drops most rows in the scan, before the shuffle.
    """
    few = keys.filter(F.col(_KEY) >= "")
    return others.select(_key(dataset), LOAD_YEAR).join(few, _KEY, "left_semi").distinct()


def all_shared(others: DataFrame, keys: DataFrame, dataset: Dataset, years: set[str]) -> bool:
    """Whether the keys of one slice, of :data:`PROBE`, already occur in every one of the other ``years``.

    If so, :func:`shared_keys` of all keys would name these years too; if not, only that one can tell.
    """
    part = keys.filter(F.pmod(F.xxhash64(_KEY), F.lit(PROBE)) == 0).distinct()
    among = others.filter(F.pmod(F.xxhash64(_key(dataset)), F.lit(PROBE)) == 0)
    found = shared_keys(among, part, dataset).select(LOAD_YEAR).distinct().collect()
    return {versions.year_folder(row[LOAD_YEAR]) for row in found} == years


def refresh(
    spark: SparkSession, loaded_root: str, staged_root: str, dataset: Dataset, latest_load_wins: bool = False
) -> list[str]:
    """Bring the staged table up to the newest loaded version; returns the year folders written anew.

    A key's staged row can only change if a changed year holds a row of it now,
    or held the one that was kept. These keys are looked up in the key column of all other
    years. They are staged again from the changed years, and from those other years that
    share keys with them; of the staged table, the folders of
    both are replaced at once. The first run, and one with another ``latest_load_wins``, stage everything.
    So does one where changed years and those that share keys are all years: every folder is written anew then,
    and one pass over the loaded rows takes the place of looking up each key and of three joins and shuffles of whole rows.
    """
    at = versions.current(spark, loaded_root)
    if at is None:
        raise ValueError(f"there is no table at {loaded_root}")
    base = versions.current(spark, staged_root)
    notes = {"loaded": [list(part) for part in at.parts], "latest_load_wins": latest_load_wins}

    def stage_all() -> set[str]:
        rows = versions.read_by_year(spark, loaded_root, dataset.table_schema, at)
        load = versions.write_load(spark, _first(rows, dataset, latest_load_wins), staged_root, [LOAD_YEAR])
        versions.publish_after(spark, staged_root, base, load, notes)
        return {folder for _, folder in load}

    if base is None or base.notes.get("latest_load_wins") != latest_load_wins:
        return sorted(stage_all())
    before = versions.Version(0, tuple((load, folder) for load, folder in base.notes["loaded"]))
    changed = set(versions.changed_years(before, at))
    if not changed:
        return []

    def loaded(folders: set[str]) -> DataFrame:
        some = versions.Version(at.number, tuple(p for p in at.parts if p[1] in folders))
        return versions.read(spark, loaded_root, dataset.table_schema, some)

    def staged(folders: set[str]) -> DataFrame:
        some = versions.Version(base.number, tuple(p for p in base.parts if p[1] in folders))
        return versions.read(spark, staged_root, staged_schema(dataset), some)

    now = loaded(changed)
    changed_keys = now.select(_key(dataset)).union(staged(changed).select(_key(dataset)))
    other_years = {folder for _, folder in at.parts} - changed
    if not other_years or all_shared(loaded(other_years), changed_keys, dataset, other_years):
        stage_all()
        return sorted(changed | other_years)
    keys = _written(changed_keys.distinct(), "changed_keys")
    shared = _written(shared_keys(loaded(other_years), keys, dataset), "shared_keys")
    years = {versions.year_folder(row[LOAD_YEAR]) for row in shared.select(LOAD_YEAR).distinct().collect()}
    again, kept = now, staged(years)
    if years:
        again_keys = shared.select(_KEY).distinct()
        found = loaded(years).withColumn(_KEY, _key(dataset)).join(again_keys, _KEY, "left_semi").drop(_KEY)
        again = now.unionByName(found)
        kept = kept.withColumn(_KEY, _key(dataset)).join(again_keys, _KEY, "left_anti").drop(_KEY)
    rows = _first(again, dataset, latest_load_wins).unionByName(kept)
    load = versions.write_load(spark, rows.hint("rebalance", LOAD_YEAR), staged_root, [LOAD_YEAR])
    touched = changed | years
    versions.publish_after(spark, staged_root, base, [p for p in base.parts if p[1] not in touched] + load, notes)
    return sorted(touched)
