"""Hotspot zones: exact K-Means over the places, all starts at once.

Places are whole millionths of a degree with the number of violations at each,
so sums, means (rounded down) and squared distances are integers and a fit does
not depend on how rows are partitioned.  A start begins at a place drawn by its
hash, and goes on with the place of the greatest D^2 x weight x draw, where D is
the distance to the nearest centre so far and the draw is a hash of start, step
and place: far places and busy ones are likely, as in k-means++, and the same
run gives the same seeds.  A round is one aggregate for all starts, whose tasks
hand on starts x k rows; it ends when no centre of any start moves, or after
``ROUNDS``.  The start of the least cost wins.

Scale: points are folded into distinct places first; only starts x k centres are
on the driver and in the plan; assignment is a projection.

Defined cases: points with a null or NaN coordinate are left out; with at most
``MIN_POINTS`` points there are no zones (every point is in zone -1); fewer
distinct places than zones give fewer zones; zones are numbered by centre.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .clustering import CENTER_SCHEMA, K, MIN_POINTS, SEED, STARTS

UNIT = 1e6
ROUNDS = 40


def _unit(c: str) -> Column:
    return F.floor(F.col(c) * F.lit(UNIT) + F.lit(0.5))


def _points(fact: DataFrame) -> DataFrame:
    lat, lon = F.col("Latitude"), F.col("Longitude")
    return fact.select("Latitude", "Longitude").where(lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon))


def _squared(a: Column, o: Column, centre: Column) -> Column:
    return (a - centre["a"]) * (a - centre["a"]) + (o - centre["o"]) * (o - centre["o"])


def _literal(centres: list[list[tuple[int, int]]]) -> Column:
    """starts x centres as a constant of the plan."""
    return F.array(*[F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(o).cast("long").alias("o")) for a, o in start]) for start in centres])


def _nearest(a: Column, o: Column, centres: Column) -> Column:
    """(d, n): squared distance and number of the nearest centre, the smaller of equals."""
    return F.array_min(F.transform(centres, lambda c, n: F.struct(_squared(a, o, c).alias("d"), n.alias("n"))))


def _draw(start: Column, step: int, a: str = "a", o: str = "o") -> Column:
    return F.sha2(F.concat_ws(":", start + SEED, F.lit(step), a, o), 256)


def _seeds(places: DataFrame, k: int, starts: int) -> list[list[tuple[int, int]]]:
    place, every = F.struct("a", "o"), F.explode(F.sequence(F.lit(0), F.lit(starts - 1)))
    first = (places.withColumn("s", every).groupBy("s").agg(F.min(F.struct(_draw(F.col("s"), 0).alias("h"), "a", "o")).alias("m")))
    chosen = {r["s"]: [(r["m"]["a"], r["m"]["o"])] for r in first.collect()}
    centres = [chosen[s] for s in range(starts)]
    for step in range(1, k):
        # each start's nearest centre so far, then its place of the greatest weighted draw
        near = F.transform(_literal(centres), lambda c: _nearest(F.col("a"), F.col("o"), c)["d"])
        drawn = places.select("a", "o", "w", F.posexplode(near).alias("s", "d")).where("d > 0")
        luck = F.conv(F.substring(_draw(F.col("s"), step), 1, 4), 16, 10).cast("decimal(10,0)") + 1
        key = (F.col("d").cast("decimal(20,0)") * luck).cast("decimal(26,0)") * F.col("w").cast("decimal(12,0)")
        best = drawn.groupBy("s").agg(F.max(F.struct(key.cast("decimal(38,0)").alias("key"), (-F.col("a")).alias("a"), (-F.col("o")).alias("o"))).alias("m"))
        for r in best.collect():
            centres[r["s"]] = centres[r["s"]] + [(-r["m"]["a"], -r["m"]["o"])]
    return centres


def fit(fact: DataFrame, k: int = K, starts: int = STARTS, rounds: int = ROUNDS) -> list[tuple[int, int]] | None:
    """The centres of the best start in units, in their order; None with too few points."""
    pts = _points(fact)
    if pts.limit(MIN_POINTS + 1).count() <= MIN_POINTS:
        return None
    places = materialize(pts.groupBy(_unit("Latitude").alias("a"), _unit("Longitude").alias("o")).agg(F.count(F.lit(1)).alias("w")))
    centres = _seeds(places, k, starts)
    wide = lambda c: F.sum((F.col(c).cast("decimal(19,0)") * F.col("w").cast("decimal(18,0)")).cast("decimal(38,0)"))

    def pass_over() -> list:
        near = F.transform(_literal(centres), lambda c: _nearest(F.col("a"), F.col("o"), c))
        each = places.select("a", "o", "w", F.posexplode(near).alias("s", "m")).select("a", "o", "w", "s", "m.n", "m.d")
        return each.groupBy("s", "n").agg(wide("a").alias("a"), wide("o").alias("o"), F.sum("w").alias("w"), wide("d").alias("d")).collect()

    for _ in range(rounds):
        moved = [list(c) for c in centres]
        for r in pass_over():
            moved[r["s"]][r["n"]] = (int(r["a"]) // r["w"], int(r["o"]) // r["w"])
        if moved == centres:
            break
        centres = moved
    cost = dict.fromkeys(range(starts), 0)
    for r in pass_over():
        cost[r["s"]] += int(r["d"])
    return sorted(centres[min(cost, key=lambda s: (cost[s], s))])


def zone_points(fact: DataFrame, centres: list[tuple[int, int]] | None) -> DataFrame:
    """Every point with its zone."""
    pts = _points(fact)
    if centres is None:
        return pts.withColumn("cluster", F.lit(-1))
    at = pts.withColumn("a", _unit("Latitude")).withColumn("o", _unit("Longitude"))
    return at.select("Latitude", "Longitude", _nearest(F.col("a"), F.col("o"), _literal([centres])[0])["n"].cast("int").alias("cluster"))


def zone_centers(spark: SparkSession, centres: list[tuple[int, int]] | None) -> DataFrame:
    """(cluster, Latitude, Longitude) of each zone."""
    return spark.createDataFrame([(n, a / UNIT, o / UNIT) for n, (a, o) in enumerate(centres or [])], CENTER_SCHEMA)
