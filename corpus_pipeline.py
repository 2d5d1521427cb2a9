"""From raw documents to packed sequences: five stages, each written and read again.

Quality rules reject documents, near-duplicates leave one document of each group, secrets
are replaced in the texts, sources are mixed to their target weights (documents are emitted
again or not at all), and what is left is packed into sequences. All but the last stage
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from poiloom.llm import mixing, near_dups, packing, quality, secrets
from poiloom.llm.common import drop_tables, new_path, table_mark
from poiloom.llm.queries import table, tokenizer_path

#: SQL has no such hashes, tokens and programs: the stages are tested against brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.first_of_class(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", keep_quality),
    ("near-duplicates", keep_one_of_each),
    ("secrets", redact_secrets),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole documents table.

    When a stage is written, the tables that it kept for itself and the stage before are deleted.
    """
    docs, mark = table(spark, sf_dir, "documents"), table_mark()
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        drop_tables(spark, mark, keep=[path])
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
