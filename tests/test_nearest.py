from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions import geo as G
from hearthline.operators import nearest as N


def miles(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = (np.radians(np.asarray(v, dtype=float)) for v in (lat1, lon1, lat2, lon2))
    a = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * 0.621371192 * np.arcsin(np.sqrt(np.minimum(a, 1)))


def brute(homes, stores, tiers):
    out = {}
    for key, lat, lon in homes:
        for tier in tiers:
            own = [s for s in stores if s[0] == tier and s[4] is not None and s[5] is not None]
            if lat is None or lon is None or math.isnan(lat) or math.isnan(lon):
                out[key, tier] = (None, "N/A")
            elif not own:
                out[key, tier] = (None, None)
            else:
                d = miles(lat, lon, [s[4] for s in own], [s[5] for s in own])
                best = min(range(len(own)), key=lambda i: (round(float(d[i]), 9), own[i][1]))
                out[key, tier] = (float(d[best]), f"{own[best][2]} - {own[best][3]}")
    return out


def check(spark, homes, stores, tiers=("a", "b"), **limits):
    left = spark.createDataFrame(homes, "id int, latitude double, longitude double")
    right = spark.createDataFrame(stores, S.STORES)
    rows = N.nearest_store(left, right, tiers=list(tiers), **limits).collect()
    expected = brute(homes, stores, tiers)
    assert len(rows) == len(homes) * len(tiers)
    for row in rows:
        distance, label = expected[row["id"], row["tier"]]
        assert row["store"] == label, row
        if distance is None:
            assert row["distance"] is None
        else:
            assert row["distance"] == pytest.approx(distance, abs=1e-9)


def world(rng, count, lat=(-90, 90), lon=(-180, 180)):
    return rng.uniform(*lat, count), rng.uniform(*lon, count)


def homes_at(lat, lon):
    return [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon, strict=True))]


def stores_at(lat, lon, tiers=("a", "b")):
    return [
        (tiers[i % len(tiers)], i, f"S{i}", f"A{i}", float(a), float(b))
        for i, (a, b) in enumerate(zip(lat, lon, strict=True))
    ]


LIMITS = [dict(), dict(shard=40), dict(shard=3)]


@pytest.mark.parametrize("limits", LIMITS[:2])
def test_whole_earth(spark, limits):
    rng = np.random.default_rng(1)
    homes = homes_at(*world(rng, 150)) + [(900, 90.0, 0.0), (901, -90.0, 12.0), (902, 0.0, 180.0), (903, 0.0, -180.0)]
    check(spark, homes, stores_at(*world(rng, 300)), **limits)


@pytest.mark.parametrize("limits", LIMITS[1:2])
def test_across_the_date_line_and_near_the_pole(spark, limits):
    rng = np.random.default_rng(2)
    lon = (rng.uniform(179, 181, 120) + 180) % 360 - 180
    homes = homes_at(rng.uniform(-1, 1, 60), lon[:60])
    homes += [(100 + i, a, b) for i, a, b in homes_at(rng.uniform(88, 90, 40), rng.uniform(-180, 180, 40))]
    store_lat = np.concatenate([rng.uniform(-1, 1, 60), rng.uniform(87, 90, 60)])
    store_lon = np.concatenate([lon[60:], rng.uniform(-180, 180, 60)])
    check(spark, homes, stores_at(store_lat, store_lon), **limits)


@pytest.mark.parametrize("limits", LIMITS)
def test_hot_spots_on_both_sides(spark, limits):
    """A third of the homes at one door, a third of the stores in one block."""
    rng = np.random.default_rng(3)
    lat, lon = rng.uniform(33.9, 34.1, 200), rng.uniform(-118.5, -118.3, 200)
    lat[:70], lon[:70] = 34.0, -118.4
    store_lat, store_lon = rng.uniform(33.9, 34.1, 240), rng.uniform(-118.5, -118.3, 240)
    store_lat[:80] = 34.05 + rng.uniform(0, 1e-4, 80)
    store_lon[:80] = -118.35 + rng.uniform(0, 1e-4, 80)
    check(spark, homes_at(lat, lon), stores_at(store_lat, store_lon), **limits)


def test_crowds_at_one_spot(spark):
    rng = np.random.default_rng(4)
    homes = homes_at(34.0 + rng.uniform(0, 1e-6, 30), -118.4 + rng.uniform(0, 1e-6, 30))
    homes += [(100 + i, a, b) for i, a, b in homes_at(rng.uniform(33, 35, 20), rng.uniform(-119, -118, 20))]
    crowd = stores_at(34.0 + rng.uniform(0, 1e-6, 60), -118.4 + rng.uniform(0, 1e-6, 60))
    far = [("a", 500, "far", "x", 34.5, -118.9)]
    check(spark, homes, crowd + far, shard=7)


def test_ring_of_equal_distances(spark):
    """All stores as far from the home as each other: nothing can be pruned."""
    angles = np.linspace(0, 2 * np.pi, 40, endpoint=False)
    check(spark, [(1, 0.0, 0.0)], stores_at(np.sin(angles), np.cos(angles)), shard=7)


@pytest.mark.parametrize("limits", LIMITS[::2])
def test_ties_missing_coordinates_and_empty_tier(spark, limits):
    nan = float("nan")
    homes = [(1, 34.0, -118.0), (2, None, -118.0), (3, 34.0, None), (4, None, None), (5, nan, 1.0), (6, 34.0, -118.0)]
    stores = [
        ("a", 7, "late", "x", 34.1, -118.0),
        ("a", 3, "early", "x", 34.1, -118.0),
        ("a", 1, "lost", "x", None, -118.0),
        ("c", 1, "other", "x", 34.0, -118.0),
    ]
    check(spark, homes, stores, **limits)


def test_no_stores_at_all(spark):
    check(spark, [(1, 34.0, -118.0), (2, None, None)], [("c", 1, "other", "x", 34.0, -118.0)])


def test_boxes_leave_few_comparisons(monkeypatch):
    """Many places and many stores, at one spot and spread out, with ties."""
    monkeypatch.setattr(N, "DENSE", 64)
    rng = np.random.default_rng(6)
    lat, lon = np.round(world(rng, 400), 0)
    s_lat, s_lon = np.round(world(rng, 300), 0)
    lat[:100], lon[:100] = 12.0, 34.0
    s_lat[:80], s_lon[:80] = 12.5 + rng.uniform(0, 1e-6, 80), 34.0
    got = N.nearest_of(lat, lon, s_lat, s_lon)
    want = [int(np.argmin(np.round(miles(a, b, s_lat, s_lon), 9))) for a, b in zip(lat, lon, strict=True)]
    assert got.tolist() == want


def test_wide_form_keeps_other_columns(spark):
    homes = spark.createDataFrame([(1, "x", 34.0, -118.0)], "`id` int, `w/d.in unit` string, latitude double, longitude double")
    stores = spark.createDataFrame([("budget", 1, "S", "A", 34.0, -118.0)], S.STORES)
    wide = N.nearest_store_wide(homes, stores)
    assert wide.columns == homes.columns + S.NEAREST_COLUMNS
    assert wide.first()["w/d.in unit"] == "x"


def test_haversine_properties(spark):
    rng = np.random.default_rng(5)
    lat, lon = world(rng, 100)
    rows = [(float(a), float(b), float(c), float(d)) for a, b, c, d in zip(lat, lon, lat[::-1], lon[::-1], strict=True)]
    rows += [(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    c = F.col
    got = frame.select(
        G.haversine_miles(c("a"), c("b"), c("c"), c("d")).alias("there"),
        G.haversine_miles(c("c"), c("d"), c("a"), c("b")).alias("back"),
        G.haversine_miles(c("a"), c("b"), c("a"), c("b")).alias("self"),
    ).toPandas()
    assert np.allclose(got["there"], got["back"])
    assert (got["self"] == 0).all()
    assert np.allclose(got["there"], miles(*np.array(rows).T))


def test_haversine_check_value_and_nulls(spark):
    frame = spark.createDataFrame([(34.0315, -118.461, 34.0259, -118.4965), (None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    got = [r[0] for r in frame.select(G.haversine_miles(*[F.col(x) for x in "abcd"])).collect()]
    assert got[0] == pytest.approx(2.069286, abs=1e-6)
    assert got[1] is None


def test_map_coordinates_and_scale(spark):
    frame = spark.createDataFrame([(0.0, 180.0, 1500.0), (34.0, -118.5, 6000.0), (None, None, None)], "lat double, lon double, price double")
    got = frame.select(
        G.web_mercator(F.col("lat"), F.col("lon")).alias("at"),
        G.normalize(F.col("price")).alias("shade"),
        G.normalize(F.col("price"), clip=True).alias("clipped"),
    ).collect()
    assert got[0]["at"]["x"] == pytest.approx(20037508.342789, abs=1e-5)
    assert got[0]["at"]["y"] == pytest.approx(0, abs=1e-6)
    assert [r["shade"] for r in got] == [0.0, pytest.approx(9 / 7), None]
    assert [r["clipped"] for r in got] == [0.0, 1.0, None]
