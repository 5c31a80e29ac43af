import math
import random

from pyspark.sql import functions as F

from phenolith.functions import geo
from phenolith.operators import elevation as EL
from phenolith.operators import grouping as G
from phenolith.operators import weather as W


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def test_golden_box(spark):
    f32 = lambda c: F.col(c).cast("float").cast("double")
    rows = spark.createDataFrame([("g", 35.160975, 39.058534, -81.120388, -77.025851)], "g string, south double, north double, west double, east double")
    extents = rows.select("g", *[f32(c).alias(c) for c in ("south", "north", "west", "east")])
    for extra, east, west, north, south in (
            (0.0, -75.7065721, -82.0484663, 39.4868029, 34.3943273), (100.0, -74.5857196, -83.1693187, 40.3874328, 33.4927875)):
        box = G.geodesic_box(extents, extra).first()
        for name, value in (("east", east), ("west", west), ("north", north), ("south", south)):
            assert abs(box[f"box_{name}"] - value) < 1e-5


def test_box_of_one_point(spark):
    one = spark.createDataFrame([("g", 40.0, 40.0, -80.0, -80.0)], "g string, south double, north double, west double, east double")
    box = G.geodesic_box(one, 100.0).first()
    assert abs(box["radius_km"] - 100) < 1e-9 and 40.89 < box["box_north"] < 40.91


def test_pairs_equal_brute_force(spark):
    rnd = random.Random(4)
    points = [(rnd.uniform(-89.5, 89.5), rnd.uniform(-180, 180)) for _ in range(150)]
    points += [(10.0, 179.95), (10.0, -179.95), (-5.0, 180.0), (89.6, 10.0), (-89.9, -170.0), (60.0, -0.01)]
    stations = [(p[0] + rnd.uniform(-0.8, 0.8), p[1] + rnd.uniform(-1, 1)) for p in points]
    stations = [(round(max(min(a, 89.99), -89.99), 4), round((b + 180) % 360 - 180, 4)) for a, b in stations]
    want = {(p, f"{s[0]:.6f}|{s[1]:.6f}") for p in points for s in stations if km(*p, *s) <= 100}
    assert len(want) > 100
    pdf = spark.createDataFrame(points, "latitude double, longitude double")
    sdf = spark.createDataFrame(stations, "lat double, lon double")
    for cell in (0.5, 1.0, 3.0):
        got = [((r[0], r[1]), r[2]) for r in W.stations_within_radius(pdf, sdf, cell=cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_fill_elevation(spark):
    rows = spark.createDataFrame(
        [("a", 10.0, 20.0, None), ("b", 10.0, 20.0, 7), ("c", 11.0, 20.0, None), ("d", -0.000002, 3.0, None)],
        "example_id string, latitude double, longitude double, elevation long")
    lookup = spark.createDataFrame(
        [(2, 10.000009, 20.0, 222), (1, 10.0, 19.999991, 111), (0, 10.00002, 20.0, 1), (3, 0.000003, 3.000001, 55)],
        "position long, latitude double, longitude double, elevation long")
    got = {r["example_id"]: r["elevation"] for r in EL.fill_elevation(rows, lookup).collect()}
    assert got == {"a": 111, "b": 7, "d": 55}


def test_haversine(spark):
    df = spark.createDataFrame([(40.0, -80.0, 41.0, -79.0)], "a double, b double, c double, d double")
    assert abs(df.select(geo.haversine_km("a", "b", "c", "d")).first()[0] - km(40, -80, 41, -79)) < 1e-9
