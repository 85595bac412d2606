"""K-Means hotspot zones on (Latitude, Longitude) with pyspark.ml.

Points at the same coordinates are pre-aggregated into one weighted point
(violations repeat at fixed camera positions), so the iterative fit runs over
distinct locations; the objective and the cost equal the unweighted fit over
all rows.  Best of ``starts`` seeds by training cost.  Assignment is a
map-only ``model.transform`` over all points (centres travel with the model).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Clusters, base seed, number of starts, and the minimum number
# of points (exclusive) needed to fit.
K = 5
SEED = 42
STARTS = 10
MIN_POINTS = 20
MAX_ITER = 300
PARALLEL_STARTS = 10
POINTS_PER_TASK = 200_000

CENTER_SCHEMA = T.StructType([
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("Latitude", T.DoubleType(), False),
    T.StructField("Longitude", T.DoubleType(), False),
])


def _points(fact: DataFrame) -> DataFrame:
    return fact.select("Latitude", "Longitude").dropna()


def fit_zones(fact: DataFrame, k: int = K, seed: int = SEED, starts: int = STARTS):
    """Return (model, id remap) or None when there are too few points."""
    pts = _points(fact)
    if pts.limit(MIN_POINTS + 1).count() <= MIN_POINTS:
        return None
    asm = VectorAssembler(inputCols=["Latitude", "Longitude"], outputCol="features")
    weighted = asm.transform(pts.groupBy("Latitude", "Longitude")
                             .agg(F.count(F.lit(1)).cast("double").alias("weight")))
    weighted = weighted.persist(StorageLevel.MEMORY_AND_DISK)
    # Size the iteration's partitions by the distinct locations (each k-means
    # step is one job over them): a few points -> one task, millions -> many.
    n_distinct = weighted.count()
    weighted = weighted.coalesce(max(1, -(-n_distinct // POINTS_PER_TASK)))

    def fit(i: int):
        model = KMeans(k=k, seed=seed + i, maxIter=MAX_ITER, weightCol="weight",
                       featuresCol="features", predictionCol="_pred").fit(weighted)
        return model.summary.trainingCost, i, model

    try:
        # The starts are independent jobs: submit them concurrently.
        with ThreadPoolExecutor(max_workers=min(starts, PARALLEL_STARTS)) as pool:
            fits = list(pool.map(fit, range(starts)))
    finally:
        weighted.unpersist()
    model = min(fits, key=lambda f: (f[0], f[1]))[2]
    # Cluster ids are arbitrary: renumber by centre (lat, lon) for determinism.
    centers = [tuple(float(v) for v in c) for c in model.clusterCenters()]
    order = sorted(range(len(centers)), key=lambda i: centers[i])
    remap = [0] * len(centers)
    for new, old in enumerate(order):
        remap[old] = new
    return model, remap, [centers[i] for i in order]


def kmeans_clusters(fact: DataFrame, fitted=None) -> DataFrame:
    """Every non-null point with its zone id (-1 for all when too few)."""
    fitted = fitted if fitted is not None else fit_zones(fact)
    pts = _points(fact)
    if fitted is None:
        return pts.withColumn("cluster", F.lit(-1))
    model, remap, _ = fitted
    asm = VectorAssembler(inputCols=["Latitude", "Longitude"], outputCol="features")
    lut = F.array(*[F.lit(v) for v in remap])
    return (model.transform(asm.transform(pts))
            .select("Latitude", "Longitude",
                    F.element_at(lut, F.col("_pred") + 1).cast("int").alias("cluster")))


def kmeans_centers(spark: SparkSession, fact: DataFrame, fitted=None) -> DataFrame:
    """k rows (cluster, Latitude, Longitude); empty when too few points."""
    fitted = fitted if fitted is not None else fit_zones(fact)
    rows = [] if fitted is None else [(i, c[0], c[1]) for i, c in enumerate(fitted[2])]
    return spark.createDataFrame(rows, CENTER_SCHEMA)
