"""From raw documents to token files, in stages that each write Parquet and read it again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rangeloom.llm.common import release, table, trim
from rangeloom.llm.decontaminate import remove_contaminated
from rangeloom.llm.jaccard_join import keep_one_of_each
from rangeloom.llm.language_id import keep_identified
from rangeloom.llm.mixing import mix_sources
from rangeloom.llm.queries import tokens
from rangeloom.plans.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without letters go."""
    return keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no phrase of the benchmark."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_sources(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder; per document what was read back from them."""
    return tokens(spark, docs)


STAGES = [
    ("language ID", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("token output", write_token_files),
]

#: The stages' results depend on a model and a tokenizer, which SQL has not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a table in the shared folder."""
    folder = scratch_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        # Else the driver holds what every stage left behind: results, models, shuffles' records.
        trim()
        release(spark)
    return docs
