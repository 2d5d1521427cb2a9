"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="poiloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def by_shuffle(df: DataFrame) -> DataFrame:
    """df as a side of a join by sorting, never broadcast: for sides that grow with the input.

    Spark takes a side for as large as its files, which are small beside their rows (compressed,
    and a row may be exploded into many), so it may send more than fits through the driver.
    """
    return df.hint("merge")


def materialized(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read again, which cuts its lineage."""
    path = f"{shared_dir(df.sparkSession)}/poiloom/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
