"""Storm-shaped raw inputs out of the order tables, for queries, tests and the bench.

Events come from ``orders`` with the customer's nation as the state, every
tenth order a second time as a reload. Fatalities come from ``lineitem``. All
columns are text in the formats of the yearly files, with blanks, bad values,
null keys and duplicates among them. Whole tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempestry.schemas import DATASETS, EVENTS, FATALITIES, LOAD_YEAR
from tempestry.sources.csv_files import FILE_NAME

_EVENT_TEXT = {
    "EVENT_ID": "if(k % 997 = 0, null, cast(k as string))",
    "STATE": """if(k % 50 = 1, concat(n_name, ', "the ', char(10), 'state" of'), n_name)""",
    "EVENT_TYPE": "o_orderpriority",
    "BEGIN_DATE_TIME": "if(k % 97 = 0, 'not a date', upper(date_format(d, 'dd-MMM-yy HH:mm:ss')))",
    "END_DATE_TIME": "upper(date_format(d + make_dt_interval(cast(k % 45 as int)), 'd-MMM-yy HH:mm:ss'))",
    "INJURIES_DIRECT": "cast(k % 4 as string)",
    "INJURIES_INDIRECT": "if(k % 11 = 0, '', concat(k % 3, '.7'))",
    "DEATHS_DIRECT": "if(k % 13 = 0, 'x', cast(k % 2 as string))",
    "DEATHS_INDIRECT": "if(k % 17 = 0, null, cast(k % 5 as string))",
    "DAMAGE_PROPERTY": """
        case when k % 101 = 0 then '?' when k % 5 = 0 then null when k % 5 = 1 then ' '
             when k % 5 = 2 then concat(k % 1000, '.25K') when k % 5 = 3 then concat(' ', k % 100, '.5m ')
             else concat(k % 7, 'B') end""",
    "DAMAGE_CROPS": """
        case k % 3 when 0 then cast(k % 500 as string) when 1 then concat(k % 50, '.00K') else '' end""",
    "SOURCE": "if(reload = 1, 'Reload', o_orderstatus)",
    "MAGNITUDE": "if(k % 6 = 0, null, concat(k % 80, '.5'))",
    "MAGNITUDE_TYPE": "element_at(array('EG', 'MG', 'ES', 'MS'), cast(k % 4 as int) + 1)",
}

_FATALITY_TEXT = {
    "FATALITY_ID": "concat(l_orderkey, '-', l_linenumber)",
    "EVENT_ID": "cast(l_orderkey as string)",
    "FATALITY_TYPE": "case l_returnflag when 'A' then 'D' when 'N' then 'I' else 'R' end",
    "FATALITY_DATE": """
        if(l_linenumber = 7, date_format(l_shipdate, 'MM/dd/yyyy HH:mm:ss'),
                             date_format(l_shipdate, 'dd/MM/yyyy HH:mm:ss'))""",
    "FATALITY_AGE": "if(l_partkey % 9 = 0, '', cast(cast(l_quantity as int) as string))",
    "FATALITY_SEX": "case when l_linestatus = 'F' then 'F' when l_suppkey % 10 = 0 then null else 'M' end",
    "FATALITY_LOCATION": """
        case when l_partkey % 30 = 0 then concat('"Out', char(10), 'side", there') when l_partkey % 3 = 0 then 'Outside'
             when l_partkey % 3 = 1 then 'Vehicle' end""",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str, with_year: bool = False) -> DataFrame:
    """Events as text; ``with_year`` adds the year of the file a row would come from.

    The reload copies are made by an explode after the joins, so the tables
    are scanned and joined once.
    """
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    copies = joined.selectExpr(
        "o_orderkey as k",
        "o_orderdate as d",
        "o_orderpriority",
        "o_orderstatus",
        "n_name",
        "explode(if(o_orderkey % 10 = 0, array(0, 1), array(0))) as reload",
    )
    year = [F.year("d").alias(LOAD_YEAR)] if with_year else []
    return copies.select(*(F.expr(_EVENT_TEXT[c]).alias(c) for c in EVENTS.raw_columns), *year)


def raw_fatalities(spark: SparkSession, sf_dir: str, with_year: bool = False) -> DataFrame:
    """Fatalities as text; ``with_year`` as in :func:`raw_events`."""
    lines = _table(spark, sf_dir, "lineitem")
    year = [F.year("l_shipdate").alias(LOAD_YEAR)] if with_year else []
    return lines.select(*(F.expr(_FATALITY_TEXT[c]).alias(c) for c in FATALITIES.raw_columns), *year)


def raw(spark: SparkSession, sf_dir: str, dataset: str, with_year: bool = False) -> DataFrame:
    return {"events": raw_events, "fatalities": raw_fatalities}[dataset](spark, sf_dir, with_year)


def correction(rows: DataFrame, dataset: str) -> DataFrame:
    """A later load of the same files: other values for every fourth id, and new events."""
    number = "try_cast(EVENT_ID as bigint)"
    again = rows.filter(f"{number} % 4 = 0")
    if dataset == "fatalities":
        return again.withColumn("FATALITY_AGE", F.lit("99"))
    new = rows.filter(f"{number} % 1000 = 0").withColumn("EVENT_ID", F.concat(F.lit("N"), "EVENT_ID"))
    return again.withColumn("DAMAGE_CROPS", F.lit("9K")).unionByName(new)


#: files that :func:`write_broken_csv` writes, and the row of every fifth file whose quote is never closed
BROKEN_FILES, OPEN_ROW = 50, 30


def write_broken_csv(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    """Event lines out of the orders, in files by key, and the files' folders.

    Some lines have too few or too many fields, and one line of every fifth file has a quote that is never closed.
    """
    header = ",".join(EVENTS.raw_columns)
    fields = len(EVENTS.raw_columns)
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % BROKEN_FILES).alias("file"))
    place = F.row_number().over(Window.partitionBy("file").orderBy("o_orderkey"))
    line = F.expr(
        f"""concat(if(file % 5 = 0 and place = {OPEN_ROW}, '"', ''),
                   case when o_orderkey % 7 = 0 then concat(o_orderkey, ',short,row')
                        when o_orderkey % 11 = 0 then concat(o_orderkey, repeat(',x', {fields}))
                        else concat(o_orderkey, repeat(',x', {fields - 1})) end)"""
    )
    # The window leaves each file's lines in one task and in their order.
    lines = orders.withColumn("place", place).select(line.alias(header), "file")
    # A separator and a quote that no line holds leave the lines as they are.
    lines.write.partitionBy("file").option("header", True).option("sep", "\x01").option("quote", "\x02").csv(path)
    files = [row.file for row in orders.select("file").distinct().collect()]
    return [f"{path}/file={file}" for file in sorted(files)]


#: where :func:`write_year_files` puts a file's parts, for the readers' ``layout``
FOLDER_LAYOUT = "file={name}"


def _write_csv(df: DataFrame, path: str, folder_column: str | None = None) -> None:
    """Gzip CSV with header, texts as they are: blanks kept, quotes doubled."""
    writer = df.write.option("header", True).option("compression", "gzip").option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    (writer.mode("append").partitionBy(folder_column) if folder_column else writer).csv(path)


def write_csv(spark: SparkSession, sf_dir: str, dataset: str, path: str) -> None:
    """The whole dataset as a folder of gzip CSV files."""
    _write_csv(raw(spark, sf_dir, dataset), path)


def write_year_files(spark: SparkSession, sf_dir: str, dataset: str, root: str) -> None:
    """One folder per file name and year below ``root``.

    The reloads of events, and one new event for every tenth of them, are a
    later revision of their year.
    """
    spec = DATASETS[dataset]
    rows = raw(spark, sf_dir, dataset, with_year=True)
    if spec is EVENTS:
        new = rows.filter("SOURCE = 'Reload' and try_cast(EVENT_ID as bigint) % 100 = 0")
        rows = rows.unionByName(new.withColumn("EVENT_ID", F.concat(F.lit("N"), "EVENT_ID")))
    year = F.col(LOAD_YEAR).cast("string")
    stem = F.concat(F.lit(FILE_NAME.format(kind=spec.file_kind, year="")), year)
    revision = F.when(F.col("SOURCE") == "Reload", "_c20250201").otherwise("_c20250101") if spec is EVENTS else F.lit(
        "_c20250101"
    )
    named = rows.withColumn("file", F.concat(stem, revision, F.lit(".csv.gz"))).drop(LOAD_YEAR)
    _write_csv(named.hint("rebalance", "file"), root, "file")


def years_of(spark: SparkSession, sf_dir: str, dataset: str) -> list[int]:
    """First to last year of the dataset's files."""
    table, column = {"events": ("orders", "o_orderdate"), "fatalities": ("lineitem", "l_shipdate")}[dataset]
    span = _table(spark, sf_dir, table).agg(F.min(F.year(column)).alias("first"), F.max(F.year(column)).alias("last"))
    first, last = span.first()
    return list(range(first, last + 1))
