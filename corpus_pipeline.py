"""A training corpus from raw documents: quality, line dedup, near duplicates, source mix, packing.

Each stage takes and returns documents; what it returns is written as Parquet
and read again as the input of the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempestry.llm import dedup_lines, mixing, near_dups, packing, quality
from tempestry.llm.common import reachable, table, tidied
from tempestry.llm.registered import TOKENIZER
from tempestry.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and blank texts go, as do all of fewer than 20 words. Rows without id or language are judged as others.
    """
    reachable(spark)
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many of them share; ``n_chars`` follows the text.

    A null text would become an empty one; rows without id lose a shared line if one with an id holds it too. All rows stay.
    """
    reachable(spark)
    return dedup_lines.without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents, the one with the smallest id.

    Rows that share an id and a text stay once. Rows without id all stay, equal texts once; so do texts without words.
    """
    reachable(spark)
    return near_dups.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice, the rows one after the other.

    A null source is a source. Rows without id are sampled by their texts, and those without words are not taken.
    """
    reachable(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences; each copy of a document has pieces of its own.

    Null ids stay null, and a text without tokens is one piece, of the end mark alone.
    """
    reachable(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The rows depend on learned cut-offs and on near duplicates, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, from ``documents``.

    What a stage saves on its way is removed when its result is written; the results of all stages stay.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        with tidied(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
