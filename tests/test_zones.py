import numpy as np
from pyspark.sql import functions as F

from roadsight.operators import clustering, zones
from roadsight.queries import fact

from .conftest import SF01

SCHEMA = "Latitude double, Longitude double"


def _cost(points, centres):
    x, c = np.array(points), np.array(centres)
    return ((x[:, None, :] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_far_groups_are_the_zones(spark):
    rows = [(10.0 * g + i % 7 / 1000, 100.0 - 15 * g + i % 11 / 1000) for g in range(5) for i in range(40)]
    rows += [(0.0, 100.0)] * 300                                       # a hot place
    df = spark.createDataFrame(rows, SCHEMA)
    centres = zones.fit(df)
    want = sorted(tuple(np.floor(np.array([r for r in rows if round(r[0] / 10) == g]).mean(axis=0) * 1e6)) for g in range(5))
    assert np.abs(np.array(centres) - np.array(want)).max() <= 1
    got = zones.zone_points(df, centres).groupBy("cluster").agg(F.min("Latitude").alias("lo"), F.count("*").alias("n")).orderBy("cluster").collect()
    assert [(r.cluster, round(r.lo / 10), r.n) for r in got] == [(g, g, 340 if g == 0 else 40) for g in range(5)]


def test_no_worse_than_the_library_and_the_same_in_any_order(spark):
    df = fact(spark, SF01)
    points = [tuple(r) for r in df.select("Latitude", "Longitude").dropna().collect()]
    mine = zones.fit(df)
    theirs = [(r.Latitude, r.Longitude) for r in clustering.kmeans_centers(spark, df).collect()]
    assert _cost(points, np.array(mine) / zones.UNIT) <= 1.02 * _cost(points, theirs)
    assert zones.fit(df.repartition(7, F.rand(3))) == mine


def test_few_points_few_places_and_points_without_coordinates(spark):
    twenty = spark.createDataFrame([(13.0 + i / 100, 80.0) for i in range(20)] + [(None, 80.0), (float("nan"), 1.0)] * 5, SCHEMA)
    assert zones.fit(twenty) is None
    assert {r.cluster for r in zones.zone_points(twenty, None).collect()} == {-1} and zones.zone_points(twenty, None).count() == 20
    assert zones.zone_centers(spark, None).count() == 0
    three = spark.createDataFrame([(float(i % 3), 5.0) for i in range(30)], SCHEMA)
    centres = zones.fit(three)
    assert centres == [(0, 5_000_000), (1_000_000, 5_000_000), (2_000_000, 5_000_000)]
    assert zones.zone_centers(spark, centres).count() == 3
    assert zones.fit(three.limit(0)) is None
