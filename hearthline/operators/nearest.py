"""Nearest store of each tier for every listing, exact, without a cross join.

Stores are points of the unit sphere, where the straight distance of two points
grows with their distance on the ground and boxes know neither poles nor a date
line. The stores of a tier are cut into shards of bounded size along a
space-filling curve. The distinct places of the listings meet the shard whose
box is nearest, then every other shard whose box is not farther than the
nearest store found; with one shard there is no other.

Inside a shard places and stores meet in a tree of boxes that is made on the
fly: a box of places keeps the stores that can be nearest to one of its points,
those no farther from it than the least distance that covers it, and is halved
until few comparisons are left. So dense areas are refined further than empty
ones, and neither many stores nor many places at one spot ever multiply.

The listings are joined once, with the result of their place; they are neither
duplicated nor regrouped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline import schema as S
from hearthline.functions.geo import EARTH_RADIUS_MILES, haversine_miles, missing
from hearthline.functions.text import concat_label
from hearthline.session import ensure_checkpoints

#: Stores of a shard, about, and shards of a tier at most.
SHARD, MOST_SHARDS = 1 << 15, 1024
#: Places that one task compares with a shard, about.
CHUNK = 1 << 16
#: Comparisons that are made at once when a box is no longer halved.
DENSE = 1 << 15
# Bits of each coordinate in a place on the curve.
_CURVE_BITS = 20
# Straight distances on the unit sphere are kept up to this much beyond a bound,
# above any rounding error and above the distances that count as ties.
_MARGIN = 1e-11
# Distances that agree to this many decimals of a mile are ties.
_TIE_DECIMALS = 9


def _on_sphere(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    lat, lon = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)


def _near_far(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest straight distance between points and boxes."""
    near = np.maximum(np.maximum(low - points, points - high), 0)
    far = np.maximum(np.abs(points - low), np.abs(points - high))
    return np.sqrt((near**2).sum(axis=-1)), np.sqrt((far**2).sum(axis=-1))


def _miles(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    lat1, lon1, lat2, lon2 = (np.radians(v) for v in (lat1, lon1, lat2, lon2))
    chord = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_MILES * np.arcsin(np.sqrt(np.minimum(chord, 1)))


def nearest_of(place_lat: np.ndarray, place_lon: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """For each place the first of the stores that are nearest to it."""
    places, stores = _on_sphere(place_lat, place_lon), _on_sphere(lat, lon)
    best = np.zeros(len(places), np.int64)
    boxes = [(np.arange(len(places)), np.arange(len(stores)))]
    while boxes:
        inside, able = boxes.pop()
        low, high = places[inside].min(axis=0), places[inside].max(axis=0)
        near, far = _near_far(stores[able], low, high)
        able = able[near <= far.min() + _MARGIN]
        if len(inside) > 1 and len(inside) * len(able) > DENSE and (low < high).any():
            axis = int(np.argmax(high - low))
            along = places[inside, axis]
            # The mean lies between both ends, so no half is empty.
            left = along <= min(along.mean(), np.nextafter(high[axis], -2))
            boxes += [(inside[left], able), (inside[~left], able)]
            continue
        step = max(1, DENSE // len(able))
        for some in np.split(inside, range(step, len(inside), step)):
            miles = _miles(place_lat[some][:, None], place_lon[some][:, None], lat[able], lon[able])
            best[some] = able[np.argmin(np.round(miles, _TIE_DECIMALS), axis=1)]
    return best


def _store_points(stores: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """One row per tier and place, with its place on the curve; of stores at one place the first one wins."""
    usable = stores.filter(F.col("tier").isin(*tiers) & ~missing(F.col("lat")) & ~missing(F.col("lng")))
    first = F.min(F.struct("store_order", concat_label(F.col("name"), F.col("address")).alias("label"))).alias("first")
    points = usable.groupBy("tier", F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng")).agg(first)

    x, y = F.pmod(F.col("lng") + 180.0, F.lit(360.0)) / 360.0, (F.col("lat") + 90.0) / 180.0
    cells = {name: F.floor(share * (1 << _CURVE_BITS)) for name, share in (("_x", x), ("_y", y))}
    placed = points.select("tier", "lat", "lng", "first.*").withColumns(cells)
    # Bits of both coordinates in turn.
    bits = [f"shiftleft(shiftright({c}, {k}) & 1, {2 * k + side})" for k in range(_CURVE_BITS) for side, c in enumerate(cells)]
    return placed.withColumn("curve", F.expr(" | ".join(bits))).drop(*cells)


def _sharded(points: DataFrame, size: int) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """Points with their shard, and for each tier the shards' boxes (low, high); a bounded number of them."""
    counts = {r["tier"]: r["count"] for r in points.groupBy("tier").count().collect()}
    shards = {tier: min(MOST_SHARDS, math.ceil(n / size)) for tier, n in counts.items()}
    shares = [k / max(shards.values(), default=1) for k in range(1, max(shards.values(), default=1))]
    shard = F.lit(0)
    if shares:
        # Where a shard ends on the curve, by a sketch: how even shards are matters little.
        cuts = {r[0]: r[1] for r in points.groupBy("tier").agg(F.percentile_approx("curve", shares, 20_000)).collect()}
        for tier, ends in cuts.items():
            ends = sorted({ends[k * len(ends) // shards[tier]] for k in range(1, shards[tier])})
            place = F.size(F.filter(F.lit(ends), lambda end: end <= F.col("curve"))) if ends else F.lit(0)
            shard = F.when(F.col("tier") == tier, place).otherwise(shard)
    sharded = points.withColumn("shard", shard.cast("int"))
    lat, lon = F.radians("lat"), F.radians("lng")
    axes = (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))
    ends = [f(axis).alias(f"{name}{k}") for k, axis in enumerate(axes) for name, f in (("low", F.min), ("high", F.max))]
    boxes: dict[str, list] = {}
    for row in sharded.groupBy("tier", "shard").agg(*ends).collect():
        low_high = [[row[f"{name}{k}"] for k in range(3)] for name in ("low", "high")]
        boxes.setdefault(row["tier"], []).append((row["shard"], low_high))
    # Outward, as the JVM's sines may differ in the last place.
    grown = np.array([[-_MARGIN], [_MARGIN]])
    return sharded, {tier: (np.array([n for n, _ in found]), np.array([b for _, b in found]) + grown) for tier, found in boxes.items()}


_AT = ["tier", "p_lat", "p_lon", "shard"]
_AT_SCHEMA = "tier string, p_lat double, p_lon double, shard int"


def _route(boxes: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places to the shard with the nearest box, or, where a distance is known, to the others within it."""
    for batch in batches:
        lat, lon = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("p_lat", "p_lon"))
        points = _on_sphere(lat, lon)
        for tier, (shards, box) in boxes.items():
            rows = np.arange(len(lat))
            if "tier" in batch.schema.names:
                rows = np.flatnonzero(np.array(batch.column("tier").to_pylist(), object) == tier)
            if not len(rows):
                continue
            step = max(1, (1 << 20) // len(shards))
            for some in np.split(rows, range(step, len(rows), step)):
                near, _ = _near_far(points[some][:, None], box[:, 0], box[:, 1])
                if "tier" in batch.schema.names:
                    miles = batch.column("distance").to_numpy(zero_copy_only=False)[some]
                    reach = 2 * np.sin(np.minimum(miles / (2 * EARTH_RADIUS_MILES), np.pi / 2)) + _MARGIN
                    been = batch.column("shard").to_numpy(zero_copy_only=False)[some]
                    which, to = np.nonzero((near <= reach[:, None]) & (shards != been[:, None]))
                else:
                    which, to = np.arange(len(some)), np.argmin(near, axis=1)
                at = some[which]
                columns = [pa.array([tier] * len(at), pa.string()), pa.array(lat[at]), pa.array(lon[at]), pa.array(shards[to], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=_AT)


def _meet(places: pa.Table, stores: pa.Table) -> pa.Table:
    """The nearest store of the shard for each place."""
    at = places.select(_AT)
    if not (places.num_rows and stores.num_rows):
        rows = stores.slice(0, 0)
        at = at.slice(0, 0)
    else:
        # In the order that decides between equally near ones.
        stores = stores.sort_by([("store_order", "ascending"), ("label", "ascending")])
        lat, lon = (stores.column(c).to_numpy() for c in ("lat", "lng"))
        best = nearest_of(at.column("p_lat").to_numpy(), at.column("p_lon").to_numpy(), lat, lon)
        rows = stores.take(pa.array(best))
    for name in ("lat", "lng", "store_order", "label"):
        at = at.append_column(name, rows.column(name))
    return at


def _searched(places: DataFrame, sharded: DataFrame) -> DataFrame:
    """Places with the nearest store of their shard; crowded shards are met in chunks of places."""
    chunks = places.groupBy("tier", "shard").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("p_lat", "p_lon"), F.col("chunks")).cast("int").alias("chunk")
    left = places.join(chunks, ["tier", "shard"]).select(*_AT, chunk)
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    right = sharded.join(chunks, ["tier", "shard"]).select("tier", "shard", "lat", "lng", "store_order", "label", every)
    kept = sharded.select("lat", "lng", "store_order", "label").schema
    shape = T.StructType([*T.StructType.fromDDL(_AT_SCHEMA).fields, *kept.fields])
    keys = ["tier", "shard", "chunk"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_meet, shape)
    return met.withColumn("distance", haversine_miles(F.col("p_lat"), F.col("p_lon"), F.col("lat"), F.col("lng")))


def _with_best(listings: DataFrame, stores: DataFrame, lat: str, lon: str, tiers: Sequence[str], shard: int) -> DataFrame:
    """Listings plus one struct column ``_best_<tier>`` per tier."""
    ensure_checkpoints(listings.sparkSession)
    sharded, boxes = _sharded(_store_points(stores, tiers).checkpoint(), shard)
    own = [F.col(f"`{c}`") for c in listings.columns]
    known = ~missing(F.col(lat)) & ~missing(F.col(lon))

    # Only distinct places travel, as two numbers each.
    place = [F.col(lat).cast("double").alias("p_lat"), F.col(lon).cast("double").alias("p_lon")]
    places = listings.filter(known).select(*place).distinct()
    first = places.mapInArrow(lambda rows: _route(boxes, rows), _AT_SCHEMA)
    found = _searched(first, sharded).checkpoint()
    others = found.select(*_AT, "distance").mapInArrow(lambda rows: _route(boxes, rows), _AT_SCHEMA)
    every = found.unionByName(_searched(others, sharded))
    ranked = F.struct(F.round("distance", _TIE_DECIMALS).alias("rank"), "store_order", "distance", "label")
    results = every.groupBy("p_lat", "p_lon").agg(*[F.min(F.when(F.col("tier") == t, ranked)).alias(f"_best_{t}") for t in tiers])

    # Rows without coordinates match no place; they are spread over made-up
    # ones instead of meeting in one task on a null key.
    spread = 1000.0 + F.pmod(F.xxhash64(*own), F.lit(4096))
    keyed = listings.withColumns({"_lat": F.when(known, F.col(lat)).otherwise(spread), "_lon": F.when(known, F.col(lon)).otherwise(spread)})
    joined = keyed.join(results, [F.col("_lat") == F.col("p_lat"), F.col("_lon") == F.col("p_lon")], "left")
    return joined.select(*own, *[f"_best_{t}" for t in tiers])


def nearest_store_wide(
    listings: DataFrame,
    stores: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    tiers: Sequence[str] = tuple(S.TIERS),
    shard: int = SHARD,
) -> DataFrame:
    """Every listing with distance and label of the nearest store per tier.

    ``stores`` has tier, store_order, name, address, lat, lng. Among equally
    near stores the smaller store_order wins. Without coordinates the distance
    is null and the label ``N/A``; a tier without stores gives nulls.
    Latitudes must lie in -90..90; longitudes may use any turn.
    """
    best = _with_best(listings, stores, lat, lon, tiers, shard)
    unplaced = missing(F.col(lat)) | missing(F.col(lon))
    columns: list[Column] = [F.col(f"`{c}`") for c in listings.columns]
    for t in tiers:
        columns.append(F.when(~unplaced, F.col(f"_best_{t}.distance")).alias(S.distance_column(t)))
        label = F.when(unplaced, F.lit(S.STORE_MISSING)).otherwise(F.col(f"_best_{t}.label"))
        columns.append(label.alias(S.store_column(t)))
    return best.select(*columns)


def nearest_store(
    listings: DataFrame,
    stores: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    tiers: Sequence[str] = tuple(S.TIERS),
    shard: int = SHARD,
) -> DataFrame:
    """The same in long form: one row per listing and tier."""
    wide = nearest_store_wide(listings, stores, lat, lon, tiers, shard)
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("tier"),
                F.col(S.distance_column(t)).alias("distance"),
                F.col(S.store_column(t)).alias("store"),
            )
            for t in tiers
        ]
    )
    return wide.select(*[F.col(f"`{c}`") for c in listings.columns], F.inline_outer(rows))


def nearest_argmin(df: DataFrame, group: Sequence[str], value: str, tiebreak: str, payload: Sequence[str]) -> DataFrame:
    """Row with the least value per group; the smaller tiebreak wins ties.

    Partial minima are taken before the shuffle, so a hot group sends one row
    per task.
    """
    least = F.min(F.struct(value, tiebreak, *payload)).alias("_least")
    return df.groupBy(*group).agg(least).select(*group, "_least.*")
