"""Geospatial operators G1-G11 (group centroids, distances, dispersion,
reference-place bands, best-candidate selection)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import ColumnOrName, col, round_half_up
from ..functions.geo import haversine_km, planar_distance
from .joins import attach_scalars, null_safe_join


def centroids(df: DataFrame, keys: Sequence[str], lat: str = "lat", lon: str = "lon",
              scale: int | None = None) -> DataFrame:
    """G1: mean latitude / longitude per group."""
    la, lo = F.avg(lat), F.avg(lon)
    if scale is not None:
        la, lo = round_half_up(la, scale), round_half_up(lo, scale)
    return df.groupBy(*keys).agg(la.alias(f"{lat}_centroid"), lo.alias(f"{lon}_centroid"))


def distance_to_centroid(df: DataFrame, keys: Sequence[str], lat: str = "lat", lon: str = "lon",
                         out: str = "dist_km") -> DataFrame:
    """Each member's great-circle distance to its group centroid (the
    centroid is an aggregate joined back, not a window)."""
    j = null_safe_join(df, centroids(df, keys, lat, lon), keys)
    return j.withColumn(out, haversine_km(lat, lon, f"{lat}_centroid", f"{lon}_centroid"))


def dispersion(df: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str], lat: str = "lat",
               lon: str = "lon", scale: int = 2) -> DataFrame:
    """Mean distance to the centroid at the child level, then its mean
    at the parent level (two aggregates)."""
    d = distance_to_centroid(df, child_keys, lat, lon)
    child = d.groupBy(*child_keys).agg(F.avg("dist_km").alias("mean_dist_km"), F.count(F.lit(1)).alias("n_members"))
    parent = child.groupBy(*parent_keys).agg(
        round_half_up(F.avg("mean_dist_km"), scale).alias("mean_child_dispersion_km"),
        F.count(F.lit(1)).alias("n_children"))
    return parent


def distance_to_reference(df: DataFrame, ref: DataFrame, lat: str = "lat", lon: str = "lon",
                          ref_lat: str = "ref_lat", ref_lon: str = "ref_lon", out: str = "dist_km") -> DataFrame:
    """Distance of every row to a one-row reference place (broadcast)."""
    r = ref.select(F.col(ref_lat).alias("__rlat"), F.col(ref_lon).alias("__rlon"))
    return attach_scalars(df, r).withColumn(out, haversine_km(lat, lon, "__rlat", "__rlon")).drop("__rlat", "__rlon")


def most_central(df: DataFrame, keys: Sequence[str], member: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The member nearest to its group centroid (ties by member)."""
    d = distance_to_centroid(df, keys, lat, lon)
    o = F.struct(F.col("dist_km").alias("a"), F.col(member).alias("b"))
    return d.groupBy(*keys).agg(F.min_by(F.col(member), o).alias("central_member"),
                                F.min("dist_km").alias("central_dist_km"))


def location_score(df: DataFrame, x: str, y: str, out: str = "location_score") -> DataFrame:
    """Planar distance to the overall centroid, min-max scaled and
    inverted (near the centre = 1)."""
    d = attach_scalars(df, df.agg(F.avg(x).alias("__cx"), F.avg(y).alias("__cy")))
    d = d.withColumn("__d", planar_distance(x, y, "__cx", "__cy"))
    d = attach_scalars(d, d.agg(F.min("__d").alias("__lo"), F.max("__d").alias("__hi")))
    rng = F.col("__hi") - F.col("__lo")
    score = F.lit(1.0) - F.try_divide(F.col("__d") - F.col("__lo"), F.when(rng != 0, rng))
    return d.withColumn(out, score).drop("__cx", "__cy", "__d", "__lo", "__hi")


# Place types that earn the settlement bonus.
SETTLEMENT_TYPES = ("city", "town", "village", "hamlet", "municipality")


def best_candidate(cands: DataFrame, entity: str, importance: str = "importance", place_type: str = "place_type",
                   place_rank: str = "place_rank", tiebreak: str = "candidate_id",
                   bonus: float = 1.0, types: Sequence[str] = SETTLEMENT_TYPES) -> DataFrame:
    """Per entity the candidate with the highest (importance + bonus if
    a settlement type, place rank); ties to the smallest ``tiebreak``."""
    score = F.coalesce(F.col(importance).cast("double"), F.lit(0.0)) + F.when(
        F.lower(F.col(place_type)).isin(list(types)), F.lit(bonus)).otherwise(F.lit(0.0))
    rank = F.coalesce(F.col(place_rank).cast("int"), F.lit(0))
    row = F.struct(*[F.col(c) for c in cands.columns], score.alias("score"))
    o = F.struct((-score).alias("a"), (-rank).alias("b"), F.col(tiebreak).alias("c"))
    return cands.groupBy(F.col(entity).alias("__e")).agg(F.min_by(row, o).alias("__r")).select("__r.*")


def best_candidate_tiered(cands: DataFrame, entity: str, tiers: Sequence[Column], position: str) -> DataFrame:
    """First candidate satisfying the earliest tier (e.g. province
    match, then settlement type, then anything), ties by ``position``."""
    tier = None
    for i, t in enumerate(tiers):
        tier = F.when(t, F.lit(i)) if tier is None else tier.when(t, F.lit(i))
    tier = tier.otherwise(F.lit(len(tiers)))
    row = F.struct(*[F.col(c) for c in cands.columns], tier.alias("tier"))
    o = F.struct(tier.alias("a"), F.col(position).alias("b"))
    return cands.groupBy(F.col(entity).alias("__e")).agg(F.min_by(row, o).alias("__r")).select("__r.*")


def best_by_max(cands: DataFrame, entity: str, metric: str, tiebreak: str) -> DataFrame:
    """Candidate with the largest metric (e.g. population)."""
    row = F.struct(*[F.col(c) for c in cands.columns])
    o = F.struct(F.col(metric).alias("a"), (-F.col(tiebreak)).alias("b"))
    return cands.groupBy(F.col(entity).alias("__e")).agg(F.max_by(row, o).alias("__r")).select("__r.*")


def resolve_first_hit(variants: DataFrame, hits: DataFrame, entity: str, variant_pos: str, query: str,
                      pass_col: str = "pass", first_pass_max_pos: int | None = None) -> DataFrame:
    """Per entity, the first query variant (by position) that has a
    hit. ``hits`` holds (query, result columns...). Entities with no hit
    keep null results. ``pass_col`` tags 'pass1' when the winning variant's
    position is within the first pass, else 'pass2'."""
    j = variants.join(hits, query, "inner")
    res_cols = [c for c in hits.columns if c != query]
    row = F.struct(F.col(query), F.col(variant_pos), *[F.col(c) for c in res_cols])
    best = j.groupBy(entity).agg(F.min_by(row, F.col(variant_pos)).alias("__r"))
    best = best.select(entity, "__r.*")
    ents = variants.select(entity).distinct()
    out = ents.join(best, entity, "left")
    if first_pass_max_pos is not None:
        out = out.withColumn(pass_col, F.when(F.col(variant_pos) <= first_pass_max_pos, "pass1")
                             .when(F.col(variant_pos).isNotNull(), "pass2"))
    return out


def match_boxes(points: DataFrame, boxes: DataFrame, box_id: str = "box_id", lat: str = "lat", lon: str = "lon",
                cell: float = 1.0, how: str = "inner") -> DataFrame:
    """F5 for many boxes in a table (box_id, lat_min, lat_max, lon_min,
    lon_max): every point with the id of each closed box that holds it.

    A grid of ``cell`` degrees is the index: a box is exploded to the cells it
    touches, points meet boxes of their own cell by an equi-join, and the
    exact test decides. A box and a point share one cell at most, so no pair
    comes twice. Points with a null coordinate and boxes with a null side or
    a lower side above the upper one match nothing. ``how="left_semi"`` keeps
    the points that are in any box, ``"left_anti"`` those in none, ``"left"``
    all points. A cell with very many points is one join key; Spark splits
    such a partition on the points' side (AQE skew join).
    """
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    sides = ["lat_min", "lat_max", "lon_min", "lon_max"]
    good = boxes.select(F.col(box_id).alias(box_id), *sides).filter("lat_min <= lat_max AND lon_min <= lon_max")
    rows = good.withColumn("__cy", F.explode(F.sequence(at("lat_min"), at("lat_max"))))
    rows = rows.withColumn("__cx", F.explode(F.sequence(at("lon_min"), at("lon_max"))))
    cols = points.columns
    p = points.withColumn("__py", at(lat)).withColumn("__px", at(lon)).alias("p")
    b = rows.alias("b")
    inside = (F.col(f"p.{lat}").between(F.col("b.lat_min"), F.col("b.lat_max")) & F.col(f"p.{lon}").between(F.col("b.lon_min"), F.col("b.lon_max")))
    joined = p.join(b, (F.col("p.__py") == F.col("b.__cy")) & (F.col("p.__px") == F.col("b.__cx")) & inside, how)
    keep = [F.col(f"p.`{c}`") for c in cols]
    return joined.select(*keep) if how in ("left_semi", "left_anti") else joined.select(*keep, F.col(f"b.{box_id}"))
