"""SQL for DuckDB that gives the registered queries' results.

Values are computed from the typed driver tables by arithmetic, not parsed
from text, so an error in the parsing expressions shows as a difference. Each
relation is a CTE that names the ones it reads; :func:`_query` puts those it
needs in front of a select.
"""

from __future__ import annotations

import re

from tempestry.schemas import EVENTS, FATALITIES, Dataset

# The columns of the facts are fixed values: names and order as in schemas.py.
_RELATIONS = {
    "loaded_orders": """
        select o_orderkey as k, o_orderdate as d, o_orderpriority as p, o_orderstatus as st, rl,
               n_name || case when o_orderkey % 50 = 1 then ', "the ' || chr(10) || 'state" of' else '' end as nm,
               o_orderdate + to_days(cast(o_orderkey % 45 as integer)) as e
        from orders
        join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey
        join (values (0), (1)) as copies(rl) on rl = 0 or o_orderkey % 10 = 0""",
    "typed_events": """
        select
          case when k % 997 <> 0 then cast(k as varchar) end as event_id,
          nm as state,
          p as event_type,
          case when k % 97 <> 0 then d + to_years(case when year(d) < 2000 then 100 else 0 end) end as event_start_date,
          e + to_years(case when year(e) < 2000 then 100 else 0 end) as event_end_date,
          cast(k % 4 as bigint) as injuries_direct,
          case when k % 11 <> 0 then cast(k % 3 as bigint) end as injuries_indirect,
          case when k % 13 <> 0 then cast(k % 2 as bigint) end as deaths_direct,
          case when k % 17 <> 0 then cast(k % 5 as bigint) end as deaths_indirect,
          case when k % 101 <> 0 then cast(case k % 5 when 2 then k % 1000 * 1000 + 250
              when 3 then k % 100 * 1000000 + 500000 when 4 then k % 7 * 1000000000 else 0 end as bigint)
              end as damage_property,
          cast(case k % 3 when 0 then k % 500 when 1 then k % 50 * 1000 else 0 end as bigint) as damage_crops,
          case when rl = 1 then 'Reload' else st end as source,
          case when k % 6 <> 0 then cast(k % 80 as double) + 0.5 end as magnitude,
          case k % 4 when 0 then 'EG' when 1 then 'MG' when 2 then 'ES' else 'MS' end as magnitude_type,
          cast(year(d) as bigint) as load_year
        from loaded_orders""",
    "line_fatalities": """
        select
          l_orderkey || '-' || l_linenumber as fatality_id,
          cast(l_orderkey as varchar) as event_id,
          case l_returnflag when 'A' then 'D' when 'N' then 'I' else 'R' end as fatality_type,
          l_linenumber as linenumber,
          l_shipdate as shipdate,
          case when l_partkey % 9 <> 0 then cast(l_quantity as bigint) end as fatality_age,
          case when l_linestatus = 'F' then 'F' when l_suppkey % 10 <> 0 then 'M' end as fatality_sex,
          case when l_partkey % 30 = 0 then '"Out' || chr(10) || 'side", there' when l_partkey % 3 = 0 then 'Outside'
               when l_partkey % 3 = 1 then 'Vehicle' end as fatality_location
        from lineitem""",
    "typed_fatalities": """
        select fatality_id, event_id, fatality_type,
               case when linenumber <> 7 then shipdate
                    when day(shipdate) <= 12
                    then make_timestamp(year(shipdate), day(shipdate), month(shipdate), 0, 0, 0) end as fatality_date,
               fatality_age, fatality_sex, fatality_location,
               cast(year(shipdate) as bigint) as load_year
        from line_fatalities""",
    "stg_events": """
        select * exclude (load_year) from typed_events
        qualify row_number() over (partition by event_id order by
          EVENT_ORDER) = 1""",
    "stg_fatalities": """
        select * exclude (load_year) from typed_fatalities
        qualify row_number() over (partition by fatality_id order by
          FATALITY_ORDER) = 1""",
    "fact_events": """
        select event_id, state, event_type, event_start_date,
               cast(month(event_start_date) as bigint) as event_start_month,
               cast(year(event_start_date) as bigint) as event_start_year,
               year(event_start_date) || '-' || month(event_end_date) as event_start_year_month,
               event_end_date, injuries_direct, injuries_indirect, deaths_direct, deaths_indirect,
               damage_property, damage_crops, source, magnitude, magnitude_type
        from stg_events""",
    "fact_fatalities": """
        select fatality_id, event_id,
               case fatality_type when 'I' then 'Indirect' when 'D' then 'Direct' else 'Unknown' end as fatality_type,
               fatality_date,
               cast(month(fatality_date) as bigint) as fatality_month,
               cast(year(fatality_date) as bigint) as fatality_year,
               year(fatality_date) || '-' || month(fatality_date) as fatality_year_month,
               case fatality_sex when 'M' then 'Male' when 'F' then 'Female' else 'Unknown' end as fatality_sex,
               fatality_location
        from stg_fatalities""",
    "costliest": """
        select event_start_year, event_type, cast(sum(damage_crops + damage_property) as bigint) as cost
        from fact_events group by all""",
    "by_month": """
        select fatality_year, fatality_month, count(*) as fatality_count
        from fact_fatalities where fatality_date is not null group by all""",
    "by_sex": """
        select fatality_year, fatality_sex, count(*) as fatality_count
        from fact_fatalities where fatality_date is not null group by all""",
    "type_by_event": """
        select event_start_year, event_type, fatality_type, count(fatality_id) as fatality_count
        from fact_events join fact_fatalities using (event_id) group by all""",
    "loaded_duplicates": """
        select event_id, count(*) as n from typed_events where event_id is not null
        group by event_id having count(*) > 1""",
    "orphans": """
        select event_id, count(*) as n from stg_fatalities
        where event_id is not null
          and not exists (select 1 from stg_events where stg_events.event_id = stg_fatalities.event_id)
        group by event_id""",
}


def _needed(sql: str) -> list[str]:
    """The relations ``sql`` reads, directly or through others, in order of definition."""
    found = {name for name in _RELATIONS if re.search(rf"\b{name}\b", sql)}
    for name in tuple(found):
        found.update(_needed(_RELATIONS[name]))
    return [name for name in _RELATIONS if name in found]


def _order(dataset: Dataset) -> str:
    """Every column but the key, nulls first."""
    return ", ".join(f"{c} nulls first" for c in dataset.columns if c != dataset.key)


def _query(sql: str) -> str:
    ctes = ",\n".join(f"{name} as ({_RELATIONS[name]})" for name in _needed(sql))
    whole = f"with {ctes}\n{sql}" if ctes else sql
    return whole.replace("EVENT_ORDER", _order(EVENTS)).replace("FATALITY_ORDER", _order(FATALITIES))


_RAW_EVENTS = """
    select
      case when k % 997 <> 0 then cast(k as varchar) end as "EVENT_ID",
      nm as "STATE",
      p as "EVENT_TYPE",
      case when k % 97 = 0 then 'not a date' else upper(strftime(d, '%d-%b-%y %H:%M:%S')) end as "BEGIN_DATE_TIME",
      upper(strftime(e, '%-d-%b-%y %H:%M:%S')) as "END_DATE_TIME",
      cast(k % 4 as varchar) as "INJURIES_DIRECT",
      case when k % 11 <> 0 then (k % 3) || '.7' end as "INJURIES_INDIRECT",
      case when k % 13 = 0 then 'x' else cast(k % 2 as varchar) end as "DEATHS_DIRECT",
      case when k % 17 <> 0 then cast(k % 5 as varchar) end as "DEATHS_INDIRECT",
      case when k % 101 = 0 then '?' else case k % 5 when 1 then ' ' when 2 then (k % 1000) || '.25K'
          when 3 then ' ' || (k % 100) || '.5m ' when 4 then (k % 7) || 'B' end end as "DAMAGE_PROPERTY",
      case k % 3 when 0 then cast(k % 500 as varchar) when 1 then (k % 50) || '.00K' end as "DAMAGE_CROPS",
      case when rl = 1 then 'Reload' else st end as "SOURCE",
      case when k % 6 <> 0 then (k % 80) || '.5' end as "MAGNITUDE",
      case k % 4 when 0 then 'EG' when 1 then 'MG' when 2 then 'ES' else 'MS' end as "MAGNITUDE_TYPE"
    from loaded_orders"""

_RAW_FATALITIES = """
    select
      l_orderkey || '-' || l_linenumber as "FATALITY_ID",
      cast(l_orderkey as varchar) as "EVENT_ID",
      case l_returnflag when 'A' then 'D' when 'N' then 'I' else 'R' end as "FATALITY_TYPE",
      case when l_linenumber = 7 then strftime(l_shipdate, '%m/%d/%Y %H:%M:%S')
           else strftime(l_shipdate, '%d/%m/%Y %H:%M:%S') end as "FATALITY_DATE",
      case when l_partkey % 9 <> 0 then cast(cast(l_quantity as integer) as varchar) end as "FATALITY_AGE",
      case when l_linestatus = 'F' then 'F' when l_suppkey % 10 <> 0 then 'M' end as "FATALITY_SEX",
      case when l_partkey % 30 = 0 then '"Out' || chr(10) || 'side", there' when l_partkey % 3 = 0 then 'Outside'
           when l_partkey % 3 = 1 then 'Vehicle' end as "FATALITY_LOCATION"
    from lineitem"""

# Orders as lines of files; a file's 30th line may have a quote that is never closed.
_BROKEN = """
    select *, o_orderkey % 7 = 0 or o_orderkey % 11 = 0 or (file % 5 = 0 and place = 30) as bad
    from (select o_orderkey, o_orderkey % 50 as file,
                 row_number() over (partition by o_orderkey % 50 order by o_orderkey) as place from orders)"""

_NO_REVISION = "cast(null as varchar) as revision"
_EVENT_MONTH = f"select *, {_NO_REVISION}, strftime(event_start_date, '%Y-%m') as month_key from typed_events"
_FATALITY_MONTH = f"select *, {_NO_REVISION}, strftime(fatality_date, '%Y-%m') as month_key from typed_fatalities"


def _failures(check: str, table: str, column: str, count: str) -> str:
    return (
        f"select '{check}' as \"check\", '{table}' as \"table\", '{column}' as \"column\", "
        f"cast(({count}) as bigint) as failures"
    )


def _unique(table: str, relation: str, key: str) -> str:
    return _failures(
        "unique", table, key,
        f"select count(*) from (select {key} from {relation} where {key} is not null "
        f"group by {key} having count(*) > 1)",
    )


def _not_null(table: str, column: str) -> str:
    return _failures("not_null", table, column, f"select count(*) from {table} where {column} is null")


def _accepted(column: str, values: str) -> str:
    return _failures(
        "accepted_values", "stg_fatalities", column,
        f"select count(distinct {column}) from stg_fatalities where {column} not in ({values})",
    )


_STAGED_UNIQUE = [_unique("stg_events", "stg_events", "event_id"),
                  _unique("stg_fatalities", "stg_fatalities", "fatality_id")]
_LOADED_UNIQUE = [_unique("loaded_events", "typed_events", "event_id"),
                  _unique("loaded_fatalities", "typed_fatalities", "fatality_id")]
_NOT_NULL = [_not_null("stg_events", "event_id"), _not_null("stg_events", "event_start_date"),
             _not_null("stg_fatalities", "fatality_id"), _not_null("stg_fatalities", "fatality_date")]
_RELATIONSHIPS = [_failures("relationships", "stg_fatalities", "event_id", "select coalesce(sum(n), 0) from orphans")]
_ACCEPTED = [_accepted("fatality_type", "'I', 'D'"), _accepted("fatality_sex", "'M', 'F'")]


def _all(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


_SQL = {
    "csv_scan": _RAW_EVENTS,
    "csv_scan_fatalities": _RAW_FATALITIES,
    "csv_rejects": f"""
        select cast(count(*) as bigint) as rows, cast(count(*) filter (bad) as bigint) as bad_rows from ({_BROKEN})""",
    "csv_rejects_multiline": f"""
        select cast(count(*) as bigint) as rows, cast(count(*) filter (bad) as bigint) as bad_rows
        from ({_BROKEN}) where file % 5 <> 0 or place <= 30""",
    "year_select": "select *, 'c20250101' as revision from typed_events where source <> 'Reload'",
    "year_select_latest": """
        select *, 'c20250201' as revision from typed_events where source = 'Reload'
        union all
        select * replace ('N' || event_id as event_id), 'c20250201' from typed_events
        where source = 'Reload' and cast(event_id as bigint) % 100 = 0""",
    "parse_damage": """
        select event_id, source, damage_property, damage_property is null as damage_property_bad,
               damage_crops, false as damage_crops_bad
        from typed_events""",
    "damage_rejects": """
        select 'DAMAGE_PROPERTY' as "column", count(*) as failures from typed_events where damage_property is null
        union all select 'DAMAGE_CROPS', count(*) from typed_events where damage_crops is null""",
    "cell_rejects": """
        select 'BEGIN_DATE_TIME' as "column", count(*) filter (event_start_date is null) as failures from typed_events
        union all select 'END_DATE_TIME', 0
        union all select 'INJURIES_DIRECT', 0
        union all select 'INJURIES_INDIRECT', 0
        union all select 'DEATHS_DIRECT', count(*) filter (deaths_direct is null) from typed_events
        union all select 'DEATHS_INDIRECT', 0
        union all select 'DAMAGE_PROPERTY', count(*) filter (damage_property is null) from typed_events
        union all select 'DAMAGE_CROPS', 0
        union all select 'MAGNITUDE', 0
        union all select 'FATALITY_DATE', count(*) filter (fatality_date is null) from typed_fatalities
        union all select 'FATALITY_AGE', 0""",
    "clean_events": "select * exclude (load_year) from typed_events",
    "clean_events_own_century": """
        select * exclude (load_year) replace (
          case when year(event_start_date) >= 2050 then event_start_date - to_years(100) else event_start_date end
            as event_start_date,
          case when year(event_end_date) >= 2050 then event_end_date - to_years(100) else event_end_date end
            as event_end_date)
        from typed_events""",
    "clean_fatalities": "select * exclude (load_year) from typed_fatalities",
    "clean_fatalities_month_first": """
        select fatality_id, event_id, fatality_type,
               case when linenumber = 7 then shipdate
                    when day(shipdate) <= 12
                    then make_timestamp(year(shipdate), day(shipdate), month(shipdate), 0, 0, 0) end as fatality_date,
               fatality_age, fatality_sex, fatality_location
        from line_fatalities""",
    "parquet_roundtrip": "select * exclude (load_year) from typed_events",
    "parquet_roundtrip_fatalities": "select * exclude (load_year) from typed_fatalities",
    "load_append": f"{_EVENT_MONTH} union all {_EVENT_MONTH}",
    "load_append_fatalities": f"{_FATALITY_MONTH} union all {_FATALITY_MONTH}",
    "load_replace_year": _EVENT_MONTH,
    "load_replace_year_fatalities": _FATALITY_MONTH,
    "load_from_files": f"select * replace ('c20250101' as revision) from ({_EVENT_MONTH}) where source <> 'Reload'",
    "table_by_month": f"""
        select month_key, count(*) as n, max(fatality_date) as last_date from ({_FATALITY_MONTH}) group by month_key""",
    "table_between": f"""
        select * exclude (load_year) from ({_FATALITY_MONTH})
        where fatality_date >= timestamp '1996-02-10' and fatality_date < timestamp '1997-11-06'""",
    "external_table": "select * from typed_events",
    "external_table_fatalities": "select * from typed_fatalities",
    "load_sql": f"""
        select * from ({_EVENT_MONTH})
        union all select * from ({_EVENT_MONTH}) where load_year = (select min(load_year) from typed_events)""",
    "load_sql_fatalities": f"""
        select * from ({_FATALITY_MONTH})
        union all select * from ({_FATALITY_MONTH}) where load_year = (select min(load_year) from typed_fatalities)""",
    "catalog_table": "select load_year, count(*) as n from typed_fatalities group by load_year",
    "stg_events": "select * from stg_events",
    "stg_events_latest_load": """
        select * exclude (load_year, revision) from (
          select *, 1 as revision from typed_events
          union all
          select * replace (9000::bigint as damage_crops), 2 from typed_events where cast(event_id as bigint) % 4 = 0
          union all
          select * replace ('N' || event_id as event_id), 2 from typed_events where cast(event_id as bigint) % 1000 = 0)
        qualify row_number() over (partition by event_id order by revision desc,
          EVENT_ORDER) = 1""",
    "stg_fatalities_latest_load": """
        select * exclude (load_year, revision) from (
          select *, 1 as revision from typed_fatalities
          union all
          select * replace (99::bigint as fatality_age), 2 from typed_fatalities where cast(event_id as bigint) % 4 = 0)
        qualify row_number() over (partition by fatality_id order by revision desc,
          FATALITY_ORDER) = 1""",
    "stg_fatalities": "select * from stg_fatalities",
    "fact_events": "select * from fact_events",
    "fact_events_start_month": """
        select * replace (event_start_year || '-' || event_start_month as event_start_year_month) from fact_events""",
    "fact_fatalities": "select * from fact_fatalities",
    "costliest_events": "select * from costliest",
    "fatalities_by_month": "select * from by_month",
    "fatalities_by_sex": "select * from by_sex",
    "fatality_type_by_event_type": "select * from type_by_event",
    "mart_rebuild": "select * from costliest",
    "mart_bucketed": "select * from type_by_event",
    "facts_by_date": """
        select * from fact_events
        where event_start_date >= timestamp '2096-02-10' and event_start_date < timestamp '2097-11-06'""",
    "stg_events_incremental": "select * from stg_events",
    "stg_fatalities_incremental": "select * from stg_fatalities",
    "stg_events_view": "select * from stg_events",
    "stg_fatalities_view": "select * from stg_fatalities",
    "yearly_backfill": "select * from type_by_event",
    "top_fatality_type": """
        select * from type_by_event
        qualify row_number() over (partition by event_start_year, event_type
                                   order by fatality_count desc, fatality_type) = 1""",
    "fatality_balance": """
        select *, round(100.0::double * fatality_count
                        / sum(fatality_count) over (partition by event_start_year, event_type), 1) as share
        from type_by_event""",
    "peak_month": """
        select * from by_month
        qualify row_number() over (partition by fatality_year order by fatality_count desc, fatality_month) = 1""",
    "top_cost": """
        select * from costliest where event_start_year is not null
        order by cost desc, event_type, event_start_year limit 10""",
    "cost_rank": """
        select *, row_number() over (partition by event_start_year
                                     order by cost desc nulls last, event_type nulls first) as cost_rank
        from costliest where event_start_year is not null""",
    "sex_share": """
        select *, round(100.0::double * fatality_count / sum(fatality_count) over (partition by fatality_year), 1)
                  as share
        from by_sex""",
    "dq_unique": _all(_LOADED_UNIQUE + _STAGED_UNIQUE),
    "dq_not_null": _all(_NOT_NULL),
    "dq_relationships": _all(_RELATIONSHIPS),
    "dq_accepted_values": _all(_ACCEPTED),
    "dq_duplicate_keys": "select * from loaded_duplicates",
    "dq_orphan_keys": "select * from orphans",
    "dq_unexpected_values": """
        select fatality_type as value, count(*) as n from stg_fatalities
        where fatality_type not in ('I', 'D') group by fatality_type""",
    "dq_report": "select *, 'warn' as severity from ("
    + _all(_STAGED_UNIQUE + _NOT_NULL + _RELATIONSHIPS + _ACCEPTED)
    + ")",
}

ORACLES = {name: _query(sql) for name, sql in _SQL.items()}
