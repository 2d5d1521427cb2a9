"""The cleaning steps. Each one gives every input row a drop reason or none; survivors and drops follow from it."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiloom.functions import text as T
from poiloom.functions.fuzzy import name_words, score_bound, token_set_score
from poiloom.functions.geo import haversine
from poiloom.functions.hours import DAYS, night_only, weekly_hours
from poiloom.operators.dedup import deduplicate, require, with_group_count
from poiloom.operators.spatial import radius_pairs, suppressed, tile
from poiloom.sources.packs import GLOBAL_KEYWORDS, KEEP_WORDS
from poiloom.sources.tables import by_shuffle, materialized


@dataclass(frozen=True)
class StepResult:
    """All input rows with drop_reason (null: kept); track is the column that audits search."""

    rows: DataFrame
    track: str = "name"

    @property
    def kept(self) -> DataFrame:
        return self.rows.where("drop_reason is null").drop("drop_reason")

    @property
    def dropped(self) -> DataFrame:
        return self.rows.where("drop_reason is not null")


def reasons(*cases: tuple[Column, str | Column]) -> Column:
    """The reason of the first case that holds."""
    return F.coalesce(*[F.when(m, r if isinstance(r, Column) else F.lit(r)) for m, r in cases]).alias("drop_reason")


def normalize_names(df: DataFrame, exact: bool = True) -> DataFrame:
    """name, name_normalized, then the other columns. Names that aren't strings stay as they are."""
    require(df, "name")
    kind = df.schema["name"].dataType.simpleString()
    new = T.normalized_name(F.col("name"), exact) if kind == "string" else F.col("name")
    rest = [c for c in df.columns if c not in ("name", "name_normalized")]
    return df.select("name", new.alias("name_normalized"), *rest)


def normalize_and_dedup(df: DataFrame, keep: str = "first", exact: bool = True) -> StepResult:
    """Normal names; of rows with the same name and place one is kept."""
    named = normalize_names(df, exact)
    require(named, "name_normalized", "latitude", "longitude")
    kept = deduplicate(named, ["name_normalized", "latitude", "longitude"], keep).select("row_id", F.lit(True).alias("_kept"))
    marked = named.join(by_shuffle(kept), "row_id", "left")
    return StepResult(marked.select(*named.columns, F.when(F.col("_kept").isNull(), F.lit("Exact_Duplicate")).alias("drop_reason")), "name_normalized")


def source_flag(df: DataFrame, strict: bool = False) -> Column:
    """Whether the source marks the row as a chain; strict: only the text "True" counts."""
    if "identified_as_chain" not in df.columns:
        return F.lit(False)
    value = F.coalesce(F.col("identified_as_chain").cast("string"), F.lit(""))
    return value == "True" if strict else F.lower(value) == "true"


def remove_chains(df: DataFrame, patterns: Sequence[str], filter_duplicates: bool = False, max_appearances: int = 4, strict_flag: bool = False) -> StepResult:
    """Chains by pattern, names that appear too often (if asked for), rows the source marks."""
    require(df, "name_normalized")
    key = T.filter_key(F.col("name_normalized"))
    counted = with_group_count(df, key, "_times") if filter_duplicates else df.withColumn("_times", F.lit(0).cast("long"))
    why = reasons(
        (T.matches(key, T.any_pattern(patterns)), "1_Regex_Chain"),
        (F.coalesce(F.col("_times") > max_appearances, F.lit(False)), f"2_Too_Many_Duplicates_(>{max_appearances})"),
        (source_flag(df, strict_flag), "3_Flagged_As_Chain_In_Source"),
    )
    return StepResult(counted.withColumn("drop_reason", why).drop("_times"), "name_normalized")


def geo_dedup(df: DataFrame, radius_m: float = 50, scope: str = "name") -> StepResult:
    """Of the ids of a name that have another row of it within the radius, only the first by row stays.

    scope "name": one for each name wherever its rows lie; "cluster": one for each row that
    no kept row of its name is near. Rows that share a removed id go with it, rows without
    coordinates too; null ids are never removed.
    """
    require(df, "name", "latitude", "longitude", "dataplor_id")
    points = df.where("latitude is not null and longitude is not null").select("row_id", "dataplor_id", "latitude", "longitude", T.spatial_name(F.col("name")).alias("_name"))
    # rows of equal name and place are near each other: their first row stands for them, and no pairs of copies are formed
    place = ["_name", "latitude", "longitude"]
    heads = points.groupBy(*place).agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("_rows"))
    pairs = radius_pairs(heads, radius_m, "_name", carry=("latitude", "longitude"))
    if scope == "cluster":
        tiles = pairs.select("i", "j", tile(F.col("latitude_j"), F.col("longitude_j"), radius_m).alias("tile_j"))
        # of a place all rows but the first are suppressed: by it, or by what suppresses it
        others = points.join(by_shuffle(heads.select("row_id")), "row_id", "left_anti").select("dataplor_id")
        gone = points.join(by_shuffle(suppressed(tiles).withColumnRenamed("id", "row_id")), "row_id", "left_semi").select("dataplor_id").unionByName(others)
    elif scope == "name":
        near = heads.where("_rows > 1").select("row_id").unionByName(pairs.select(F.explode(F.array("i", "j")).alias("row_id"))).distinct()
        near = heads.join(by_shuffle(near), "row_id", "left_semi").select(*[F.col(c).alias(f"_near{c}") for c in place])
        same = F.col("_name").eqNullSafe(F.col("_near_name")) & (F.col("latitude") == F.col("_nearlatitude")) & (F.col("longitude") == F.col("_nearlongitude"))
        ids = points.join(by_shuffle(near), same, "left_semi").groupBy("_name", "dataplor_id").agg(F.min("row_id").alias("_first"))
        # of each name its earliest row, by one more aggregate instead of a window over hot names
        first = ids.groupBy("_name").agg(F.min("_first").alias("_lead"))
        gone = ids.join(first, ids["_name"].eqNullSafe(first["_name"])).where("_first > _lead").select("dataplor_id")
    else:
        raise ValueError(f"unknown scope {scope!r}")
    marked = df.join(gone.where("dataplor_id is not null").distinct().withColumn("_gone", F.lit(True)), "dataplor_id", "left")
    return StepResult(marked.select(*df.columns, reasons((F.col("_gone").isNotNull(), f"Geo_Spatial_Duplicate_(<{radius_m:g}m)"))))


def hours_failed(min_hours: float = 20, night_start: float = 19) -> Column:
    """Open at night only, hours unknown, or too few a week; never null."""
    days = [F.col(f"{d}_hours") for d in DAYS]
    total, night = weekly_hours(days), night_only(days, night_start)
    return F.coalesce(night, F.lit(False)) | total.isNull() | F.coalesce(total < min_hours, F.lit(False))


def global_keyword(name: str = "name", keywords: Sequence[str] = GLOBAL_KEYWORDS) -> Column:
    """Whether a keyword stands literally in the name; backslashes count as such."""
    return T.matches(T.keyword_name(F.col(name)), T.trie_pattern(sorted({k.lower() for k in keywords}))) if keywords else F.lit(False)


def fuzzy_edges(points: DataFrame, dist_m: float = 100, thresh: float = 80) -> DataFrame:
    """Edges (i, j, tile_j) of points (row_id, latitude, longitude, _name) that are near and alike. Equal points must be put together before."""
    worded = points.withColumn("_words", name_words("_name"))
    pairs = radius_pairs(worded, dist_m, carry=("_name", "_words", "latitude", "longitude"))
    # most pairs can't reach the threshold by the lengths of their words alone: they never reach Python
    close = pairs.where(score_bound(F.col("_words_i"), F.col("_words_j")) >= thresh - 1e-6)
    return close.where(token_set_score("_name_i", "_name_j") >= thresh).select("i", "j", tile(F.col("latitude_j"), F.col("longitude_j"), dist_m).alias("tile_j"))


def hours_and_fuzzy(df: DataFrame, min_hours: float = 20, night_start: float = 19, fuzzy_thresh: float = 80, dist_m: float = 100, keywords: Sequence[str] = GLOBAL_KEYWORDS) -> StepResult:
    """Global keywords, opening hours, then places near an earlier kept one with a like name."""
    require(df, "name", "latitude", "longitude", *[f"{d}_hours" for d in DAYS])
    first = reasons((global_keyword(keywords=keywords), "1_Global_Keywords"), (hours_failed(min_hours, night_start), "2_Hours_Filter"))
    judged = materialized(df.withColumn("drop_reason", first), "hours")
    name = T.keyword_name(F.col("name"))
    points = judged.where("drop_reason is null and latitude is not null and longitude is not null").select("row_id", "latitude", "longitude", name.alias("_name")).where("_name is not null")
    # rows of equal name and place: what the first of them suppresses or is suppressed by holds for all,
    # so the others go (unless the name has no word, which is like nothing) and no pairs of copies are formed
    heads = points.groupBy("_name", "latitude", "longitude").agg(F.min("row_id").alias("row_id"))
    copies = points.where(F.length(F.regexp_replace("_name", T.BLANKS, "")) > 0).join(by_shuffle(heads.select("row_id")), "row_id", "left_anti").select("row_id")
    gone = suppressed(fuzzy_edges(heads, dist_m, fuzzy_thresh)).select(F.col("id").alias("row_id")).unionByName(copies).withColumn("_gone", F.lit(True))
    marked = judged.join(by_shuffle(gone), "row_id", "left")
    return StepResult(marked.select(*df.columns, F.coalesce("drop_reason", F.when(F.col("_gone").isNotNull(), F.lit("3_Fuzzy_Dedup"))).alias("drop_reason")))


def final_keywords(df: DataFrame, keywords: Sequence[str], keep_words: Sequence[str] = KEEP_WORDS) -> StepResult:
    """Names that match the blacklist, hold one of its keywords literally, and no protecting word."""
    require(df, "name")
    if not keywords:
        logging.warning("the blacklist is empty: no name is excluded")
        return StepResult(df.withColumn("drop_reason", F.lit(None).cast("string")))
    variants = T.keyword_variants(keywords)
    name = F.col("name")
    word = T.first_keyword(name, variants)
    listed = T.matches(name, T.keyword_pattern(variants))
    safe = T.matches(name, T.FLAGS + "|".join(map(T.re.escape, keep_words))) if keep_words else F.lit(False)
    found = df.withColumn("_word", word)
    hit = F.col("_word").isNotNull() & listed & ~safe
    return StepResult(found.withColumn("drop_reason", reasons((hit, F.concat(F.lit("1_Final_Regex_Keyword_("), F.col("_word"), F.lit(")"))))).drop("_word"))


def crowded_property(df: DataFrame, threshold: int = 4, radius_m: float = 100.0) -> StepResult:
    """Points near the centre of a property that has threshold of them or more; unchanged if a column is missing.

    Properties are summed up map-side and joined, so one that holds many rows isn't gathered in a task.
    """
    if missing := [c for c in ("parent_location", "latitude", "longitude") if c not in df.columns]:
        logging.warning("crowded properties are not looked for, as columns are missing: %s", missing)
        return StepResult(df.withColumn("drop_reason", F.lit(None).cast("string")))
    valid = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    own = df.where("parent_location is not null")
    centres = own.groupBy(F.col("parent_location").alias("_parent")).agg(F.sum(valid.cast("long")).alias("_valid"), F.avg("latitude").alias("_lat"), F.avg("longitude").alias("_lon")).where(F.col("_valid") >= threshold)
    near = df.join(centres, df["parent_location"] == F.col("_parent"), "left")
    dense = F.coalesce(haversine(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon")) <= radius_m, F.lit(False))
    placed = near.withColumn("_dense", dense)
    crowded = placed.where("_dense").groupBy(F.col("_parent").alias("_crowd")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= threshold)
    marked = placed.join(crowded, F.col("_parent") == F.col("_crowd"), "left")
    return StepResult(marked.select(*df.columns, reasons((F.col("_dense") & F.col("_crowd").isNotNull(), f"Crowded_Property_(>={threshold})"))))
