"""The violation log numbered as the stream writes it, exactly once.

A ``foreachBatch`` sink.  A micro-batch's violations get the numbers that follow
those their camera and session have given out in earlier batches; within the
batch the order is the log's (frame, detection, wrong way first).  Rows and
counters of a batch go to folders of an attempt of their own; the batch exists
from the moment its manifest is committed (see ``sources.versions``), and the
manifest's version is the batch id.

* A batch that died before its manifest is done again from the same counters:
  its first attempt is named nowhere.
* A batch that is delivered again after its manifest (the stream died between
  the sink and its own commit) is left as it is.

So ids neither repeat nor skip.  Counters are one row per session and camera of
the batch; every ``SNAPSHOT``-th batch writes all of them, and reading starts at
the last such batch, so the work of a batch does not grow with the stream's age.

The numbers equal those of the batch job if each camera's violations come in the
order of its frames, as a camera that is read while it records delivers them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tracking as trk
from ..sources.versions import all_manifests, commit, current_version
from .tracker import LATE_ROWS

SNAPSHOT = 64
MANIFEST = "attempt string, snapshot boolean"
LOG_SCHEMA = ("Violation_ID string, Timestamp timestamp_ntz, Latitude double, Longitude double, Violation_Type string, "
              "Vehicle_Type string, Severity int, camera_id int, track_id long, session_id long")
_TOTALS = "session_id long, camera_id int, total long"


def _attempts(spark: SparkSession, root: str, upto: int) -> list:
    rows = [r for r in all_manifests(spark, root, MANIFEST) if r["version"] <= upto]
    return sorted(rows, key=lambda r: r["version"])


def totals_before(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """(session_id, camera_id, total): numbers given out before a batch."""
    rows = _attempts(spark, root, batch_id)      # versions 1 .. batch_id are the batches before
    start = max((i for i, r in enumerate(rows) if r["snapshot"]), default=0)
    paths = [f"{root}/totals/{r['attempt']}" for r in rows[start:]]
    if not paths:
        return spark.createDataFrame([], _TOTALS)
    return spark.read.schema(_TOTALS).parquet(*paths).groupBy("session_id", "camera_id").agg(F.max("total").alias("total"))


def number_batch(hits: DataFrame, batch_id: int, root: str) -> bool:
    """Number one micro-batch's violations into the log at ``root``; False if
    the batch was committed before and nothing is done."""
    spark = hits.sparkSession
    if current_version(spark, root) > batch_id:
        # the detector's state has to be computed and committed all the same
        hits.write.format("noop").mode("overwrite").save()
        return False
    attempt = f"{batch_id}-{uuid.uuid4().hex[:12]}"
    kept = hits.persist()       # read for the rows, the late counts and the counters
    try:
        before = totals_before(spark, root, batch_id)
        new = kept.where(F.col("Violation_Type") != LATE_ROWS)
        trk.number_violations(new, before).write.parquet(f"{root}/rows/{attempt}")
        (kept.where(F.col("Violation_Type") == LATE_ROWS).groupBy(*trk.KEYS).agg(F.sum("step_no").alias("rows"))
         .write.parquet(f"{root}/late/{attempt}"))
        whole = batch_id % SNAPSHOT == 0
        fresh = new.groupBy("session_id", "camera_id").agg(F.count(F.lit(1)).alias("n"))
        totals = (before.join(fresh, ["session_id", "camera_id"], "full" if whole else "right")
                  .select("session_id", "camera_id", (F.coalesce("total", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("total")))
        totals.write.parquet(f"{root}/totals/{attempt}")
    finally:
        kept.unpersist()
    commit(spark, root, batch_id + 1, [(attempt, whole)], MANIFEST)
    return True


def write_numbered(violations: DataFrame, root: str, checkpoint_dir: str, available_now: bool = True):
    """Start the sink over a stream of hits (``violation_stream``)."""
    w = (violations.writeStream.foreachBatch(lambda df, i: number_batch(df, i, root))
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


def _read(spark: SparkSession, root: str, part: str, schema: str) -> DataFrame:
    paths = [f"{root}/{part}/{r['attempt']}" for r in _attempts(spark, root, current_version(spark, root))]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def numbered_log(spark: SparkSession, root: str) -> DataFrame:
    """The log of all committed batches."""
    return _read(spark, root, "rows", LOG_SCHEMA)


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    return (_read(spark, root, "late", "session_id long, camera_id int, track_id long, rows long")
            .groupBy(*trk.KEYS).agg(F.sum("rows").alias("rows")))
