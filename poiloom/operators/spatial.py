"""Joins by distance, and suppression of near points in row order."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiloom.functions.geo import cell, cells_around, haversine
from poiloom.sources.tables import by_shuffle, materialized

#: A tile is so many radii wide.
TILE = 50


def radius_pairs(points: DataFrame, radius_m: float, same: str | None = None, order: str = "row_id", carry: Sequence[str] = ()) -> DataFrame:
    """Pairs (i, j, distance) of rows i < j by order within the radius; same: a column that must be equal (nulls are).

    points: order, latitude, longitude, same and carry. Every point lies in one grid cell, and
    its partner looks for it in the cells around, so the join is one on equal cells (and
    names). The looking side has up to nine rows for each point, so no side is broadcast. Of each column c in carry the pairs have c_i and c_j.
    """
    names = [] if same is None else [same]
    lat, lon = F.col("latitude"), F.col("longitude")

    def side(k: str, at: Column) -> DataFrame:
        return points.select(F.col(order).alias(k), lat.alias(f"lat_{k}"), lon.alias(f"lon_{k}"), *[F.col(n).alias(f"same_{k}") for n in names], *[F.col(c).alias(f"{c}_{k}") for c in carry], at.alias(f"cell_{k}"))

    left, right = side("i", cell(lat, lon, radius_m)), side("j", F.explode(cells_around(lat, lon, radius_m)))
    on = (F.col("cell_i.band") == F.col("cell_j.band")) & (F.col("cell_i.column") == F.col("cell_j.column"))
    if same is not None:
        on = on & F.col("same_i").eqNullSafe(F.col("same_j"))
    pairs = left.join(by_shuffle(right), on).where("i < j").withColumn("distance", haversine(F.col("lat_i"), F.col("lon_i"), F.col("lat_j"), F.col("lon_j")))
    return pairs.where(F.col("distance") <= radius_m).select("i", "j", "distance", *(["same_i"] if same is not None else []), *[f"{c}_{k}" for c in carry for k in "ij"])


def tile(lat: Column, lon: Column, radius_m: float) -> Column:
    """The tile of a point: pairs within the radius mostly lie in one tile."""
    at = cell(lat, lon, radius_m * TILE)
    return F.xxhash64(at["band"], at["column"])


def suppressed(edges: DataFrame) -> DataFrame:
    """Rows (id) that a kept earlier row suppresses, in row order. edges: i suppresses j if i is kept, i < j.

    edges may have tile_i and tile_j (whole numbers). All edges into the rows of a tile are in
    one task, which decides them in row order as far as it knows what the edges come from;
    what needs rows of other tasks is left to the next round, which knows their decisions.
    The earliest undecided row is decided in every round, so rounds end; there are about as
    many as the tiles that the longest chain of decisions passes.
    """
    spark = edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = edges if "tile_j" in edges.columns else edges.withColumn("tile_j", F.xxhash64("j"))
    part = F.pmod("tile_j", F.lit(parts)).cast("int").alias("part")
    every = materialized(own.select("i", "j", part).distinct(), "edges")
    # a row that no edge leads to is kept
    heads = every.select("i").distinct().join(every.select(F.col("j").alias("i")).distinct(), "i", "left_anti").withColumn("kept_i", F.lit(True))
    open_ = materialized(every.join(heads, "i", "left").select("i", "j", "part", "kept_i"), "edges")
    kind = every.schema["j"].dataType.simpleString()

    def decide(batches):
        into: dict = {}
        for batch in batches:
            for i, j, kept in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "kept_i")), strict=True):
                into.setdefault(j, []).append((i, kept))
        known: dict = {}
        for j in sorted(into):
            states = [known.get(i) if kept is None else kept for i, kept in into[j]]
            if any(states):
                known[j] = False
            elif None not in states:
                known[j] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(known), pa.int64()), pa.array(list(known.values()), pa.bool_())], names=["id", "kept"])

    gone = None
    while not open_.isEmpty():
        decided = materialized(open_.repartitionById(parts, F.col("part")).mapInArrow(decide, "id long, kept boolean"), "decided")
        now = decided.where("not kept").select(F.col("id").cast(kind).alias("id"))
        gone = now if gone is None else gone.unionByName(now)
        left = open_.join(decided.select(F.col("id").alias("j")), "j", "left_anti")
        told = left.join(decided.select(F.col("id").alias("i"), "kept"), "i", "left")
        open_ = materialized(told.select("i", "j", "part", F.coalesce("kept_i", "kept").alias("kept_i")), "edges")
    return gone if gone is not None else every.select(F.col("j").alias("id"))
