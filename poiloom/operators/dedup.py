"""Exact duplicates by key, and the rows that a step dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiloom.sources.tables import by_shuffle


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def deduplicate(df: DataFrame, subset: Sequence[str], keep: str = "first", order: str = "row_id") -> DataFrame:
    """One row for each value of subset, nulls being equal: the first, last or any one by order, or none of several.

    Only keys and row numbers are aggregated, map-side first, so a key that most rows share
    is no heavy group; the survivors are found by a semi join on the row number.
    """
    require(df, *subset)
    if keep not in ("first", "last", "any", "none"):
        raise ValueError(f"unknown keep policy {keep!r}")
    if keep == "any":
        return df.dropDuplicates(list(subset))
    pick = F.max(order) if keep == "last" else F.min(order)
    groups = df.groupBy(*subset).agg(pick.alias("_kept"), F.count(F.lit(1)).alias("_n"))
    if keep == "none":
        groups = groups.where("_n = 1")
    return df.join(by_shuffle(groups.select(F.col("_kept").alias(order))), order, "left_semi").select(*df.columns)


def exact_drops(before: DataFrame, after: DataFrame, order: str = "row_id") -> DataFrame:
    """Rows of before whose row number isn't in after."""
    return before.join(after.select(order), order, "left_anti").select(*before.columns)


def legacy_drops(before: DataFrame, after: DataFrame, id_column: str | None = None) -> DataFrame:
    """Rows of before without an equal row in after, on the id or on all common columns but row_id.

    Nulls are never equal here, so a surviving row with a null counts as dropped.
    """
    keys = [id_column] if id_column else [c for c in before.columns if c in after.columns and c != "row_id"]
    return before.join(after.select(*keys), keys, "left_anti").select(*before.columns)


def report_drops(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of before without an equal name and place in after; nulls are never equal."""
    name = "name" if "name" in before.columns else "name_normalized"
    keys = [c for c in (name, "latitude", "longitude", "id", "place_id") if c in before.columns and c in after.columns]
    return before.join(after.select(*keys), keys, "left_anti").select(*before.columns) if keys else before.limit(0)


def top_dropped(dropped: DataFrame, name: str = "name", most: int = 5) -> DataFrame:
    """The most frequent names among dropped rows: name, freq; ties by name."""
    return dropped.groupBy(name).agg(F.count(F.lit(1)).alias("freq")).orderBy(F.desc("freq"), F.asc_nulls_last(name)).limit(most)


def with_group_count(df: DataFrame, key: Column, alias: str) -> DataFrame:
    """df with the number of rows that have its key; null without a key. Counted map-side, then joined."""
    own = df.withColumn("_group", key)
    counts = own.where("_group is not null").groupBy("_group").agg(F.count(F.lit(1)).alias(alias))
    return own.join(counts, "_group", "left").select(*df.columns, alias)
