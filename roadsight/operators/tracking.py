"""Detections -> steps -> smoothed speed and direction -> violations.

The original walks frames in order and keeps per-track state in dicts.  Here
the same rules are window functions over each track, ordered by
(frame_idx, det_idx):

* sightings: vehicle classes only, joined to their camera, projected to the
  top-down plane;
* step: the previous *sighting* gives dx, dy, dt; a sighting with
  dt <= 0.0001 (or the first one) is not a step but still becomes the previous
  position of the next sighting;
* speed: hypotenuse x 0.012 m/unit / dt x 3.6; EMA (alpha 0.3, start 0) over
  the steps as a running-sum window (a block sees at least 127 earlier steps;
  anything older weighs < 1.5e-20);
* direction: net dy over the last 15 steps; wrong way when
  net x flow sign < -20 units;
* first hit per (track, kind) only; ids numbered per camera and session in
  detection order, wrong way before speeding within one detection.

A session is one recording of one camera: track ids, settings, the id counter
and the clock start anew with it.  Detections and the camera table may carry a
``session_id`` (0 where there is none), and the camera table a
``session_start``.

No task ever holds a whole track: tracks are cut into frame chunks (lag seeded
from the previous chunk's last sighting) and step blocks (with a 127-step
halo), see ``sequence``.  There is one plan for tracks of any length.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import METRES_PER_UNIT, bottom_center_x, project
from ..functions.severity import severity_score
from ..schema import KIND_SPEEDING, KIND_WRONG_WAY
from ..session import materialize
from .calibration import positions
from .selection import vehicle_only
from .sequence import BUCKET, exact_positions, exclusive_prefix, with_halo_blocks

# Tracking rules.
EMA_ALPHA = 0.3
DIR_WINDOW = 15            # steps in the direction sum
WRONG_WAY_UNITS = 20.0     # top-down units (not metres), threshold of the net dy
DT_MIN = 0.0001            # seconds; smaller steps are skipped
KMH_PER_MPS = 3.6
WRONG_WAY_SEVERITY = 5

# Engine parameters (ours).
EMA_HISTORY = 128          # steps of context a block carries; 0.7**128 ~ 1.5e-20
CHUNK_FRAMES = 4096        # least frames per lag / ranking chunk of a track
BLOCK_STEPS = 1536         # steps per EMA / direction block of a track
EMA_MAX_INDEX = 1800       # largest row index of the running-sum EMA (0.7**-1800 ~ 1e279)
MAX_BROADCAST_CAMERAS = 200_000   # ~40 bytes a row: well under 10 MB
# Violation time = session start + media time (the original used the wall
# clock at processing time, which no replay can reproduce).
SESSION_START = _dt.datetime(2024, 1, 1, 0, 0, 0)

KEYS = ["session_id", "camera_id", "track_id"]


def _order() -> list[Column]:
    return [F.col("frame_idx"), F.col("det_idx")]


def with_session(df: DataFrame) -> DataFrame:
    """``df`` with a non-null ``session_id``: 0 where it has none."""
    own = F.coalesce(F.col("session_id").cast("long"), F.lit(0)) if "session_id" in df.columns else F.lit(0)
    return df.withColumn("session_id", own.cast("long"))


def _camera_side(cameras: DataFrame, check_size: bool, session_start: _dt.datetime) -> DataFrame:
    # A text literal cast to timestamp_ntz: independent of any time zone.
    default = F.lit(session_start.isoformat(sep=" ")).cast("timestamp_ntz")
    start = (F.coalesce(F.col("session_start").cast("timestamp_ntz"), default)
             if "session_start" in cameras.columns else default)
    keys = ["session_id"] if "session_id" in cameras.columns else []
    more = ["session_end"] if "session_end" in cameras.columns else []
    cams = cameras.select(*keys, "camera_id", "latitude", "longitude", "speed_limit_kmh",
                          "flow_positive_y", start.alias("session_start"), *more)
    # The camera table is a dimension; broadcast it only behind a checked size,
    # else leave the join to AQE / sort-merge.
    if not check_size or cams.count() <= MAX_BROADCAST_CAMERAS:
        return F.broadcast(cams)
    return cams


def vehicle_detections(det: DataFrame) -> DataFrame:
    """Vehicle classes with usable keys, filtered before any exchange."""
    return vehicle_only(det).where(F.col("camera_id").isNotNull()
                                   & F.col("track_id").isNotNull()
                                   & F.col("frame_idx").isNotNull())


def camera_enriched(det: DataFrame, cameras: DataFrame, check_size: bool = True,
                    session_start: _dt.datetime = SESSION_START) -> DataFrame:
    """Vehicle detections with their camera's settings: those of the session
    where the camera table has sessions, else one setting per camera."""
    cams = _camera_side(cameras, check_size, session_start)
    on = ["session_id", "camera_id"] if "session_id" in cams.columns else ["camera_id"]
    return with_session(vehicle_detections(det)).join(cams, on)


def sightings(det: DataFrame, cameras: DataFrame,
              session_start: _dt.datetime = SESSION_START, calibration: DataFrame | None = None) -> DataFrame:
    """Enriched vehicle detections with the bottom-centre pixel and (tx, ty),
    by the road's fixed map or each camera's own (see ``calibration``; a
    sighting of a camera without a map has no position and is left out)."""
    e = camera_enriched(det, cameras, session_start=session_start)
    bx = bottom_center_x(F.col("x1"), F.col("x2"))
    e = e.withColumn("bx", bx).withColumn("by", F.col("y2"))
    if calibration is None:
        tx, ty = project(F.col("bx").cast("double"), F.col("by").cast("double"))
        e = e.withColumn("tx", tx).withColumn("ty", ty)
    else:
        e = positions(e, calibration).where(F.col("tx").isNotNull() & F.col("ty").isNotNull())
    return (e.withColumn("flow_sign", F.when(F.col("flow_positive_y"), F.lit(1.0))
                        .otherwise(F.lit(-1.0))))


def steps(s: DataFrame, chunk_frames: int | None = None) -> DataFrame:
    """One row per step with dx, dy, dt, dist_m, raw_kmh and its exact 1-based
    ``step_no`` within the track.

    Pass 1 is a single window inside (track, frame chunk): the lag of every
    row but the chunk's first, and a running count of those inner steps.  A
    per-chunk summary built from only the first and last row of each chunk
    (a hash aggregate over <= 2 rows per chunk) gives each chunk its seed (the
    previous chunk's last sighting), whether its first row is a step, and the
    number of steps before it.  Pass 1, with the columns that follow, and the
    summary's result are checkpointed: the detections are scanned once, and
    pass 1 twice, for the summary and for the join with it.
    """
    width = chunk_frames or CHUNK_FRAMES
    b = s.drop("x1", "x2", "y2", "bx", "by", "flow_positive_y").withColumn(BUCKET, F.floor(F.col("frame_idx") / F.lit(width)))
    w = Window.partitionBy(*KEYS, BUCKET).orderBy(*_order())
    pos = F.struct(F.col("tx").alias("x"), F.col("ty").alias("y"), F.col("t_sec").alias("t"))
    inner_step = (F.col("t_sec") - F.col("_prev.t")) > F.lit(DT_MIN)
    p1 = (b.withColumn("_prev", F.lag(pos).over(w))
          .withColumn("_first", F.col("_prev").isNull())
          .withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
          .withColumn("_inner", F.coalesce(inner_step, F.lit(False)))
          .withColumn("_rin", F.sum(F.col("_inner").cast("long")).over(
              w.rowsBetween(Window.unboundedPreceding, 0))))
    p1 = materialize(p1)
    ends = p1.where(F.col("_first") | F.col("_last")).groupBy(*KEYS, BUCKET).agg(
        F.max(F.when(F.col("_first"), F.col("t_sec"))).alias("_t0"),
        F.max(F.when(F.col("_last"), F.col("tx"))).alias("_lx"),
        F.max(F.when(F.col("_last"), F.col("ty"))).alias("_ly"),
        F.max(F.when(F.col("_last"), F.col("t_sec"))).alias("_lt"),
        F.max(F.when(F.col("_last"), F.col("_rin"))).alias("_nin"))
    per_chunk = materialize(_chunk_seeds(ends.withColumnRenamed("_lx", "x").withColumnRenamed("_ly", "y").withColumnRenamed("_lt", "t")))
    j = p1.join(per_chunk, [*KEYS, BUCKET])
    prev = F.when(F.col("_first"), F.col("_seed")).otherwise(F.col("_prev"))
    is_step = F.when(F.col("_first"), F.col("_fstep")).otherwise(F.col("_inner"))
    step_no = F.when(F.col("_first"), F.col("_off") + 1).otherwise(
        F.col("_off") + F.col("_fstep").cast("long") + F.col("_rin"))
    j = (j.withColumn("_p", prev).where(is_step)
         .withColumn("step_no", step_no)
         .withColumn("dt", F.col("t_sec") - F.col("_p.t"))
         .withColumn("dx", F.col("tx") - F.col("_p.x"))
         .withColumn("dy", F.col("ty") - F.col("_p.y")))
    dist_units = F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
    return (j.withColumn("dist_m", dist_units * F.lit(METRES_PER_UNIT))
            .withColumn("raw_kmh", F.col("dist_m") / F.col("dt") * F.lit(KMH_PER_MPS))
            .drop("_prev", "_first", "_last", "_inner", "_rin", "_seed", "_fstep", "_off",
                  "_p", BUCKET))


def _chunk_seeds(ends: DataFrame, fanout: int = 4096) -> DataFrame:
    """Per chunk the last sighting before it (``_seed``), whether its first
    sighting is a step (``_fstep``) and the steps before it (``_off``).

    Both scans run together in two levels, so no task orders a whole track's
    chunks: inside groups of ``fanout`` consecutive chunks, then over one row
    a group, whose result goes back to the group's chunks."""
    super_, pos = "_sup", F.struct("x", "y", "t")
    inside = Window.partitionBy(*KEYS, super_).orderBy(BUCKET)
    far = lambda t, of: F.coalesce((F.col(t) - F.col(of)["t"]) > F.lit(DT_MIN), F.lit(False))
    d = (ends.withColumn(super_, F.floor(F.col(BUCKET) / F.lit(fanout)))
         .withColumn("_local", F.lag(pos).over(inside))
         .withColumn("_head", F.lag(BUCKET).over(inside).isNull())
         .withColumn("_tail", F.lead(BUCKET).over(inside).isNull())
         .withColumn("_near", ~F.col("_head") & far("_t0", "_local"))
         .withColumn("_n", F.col("_nin") + F.col("_near").cast("long"))
         .withColumn("_lp", F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    over = Window.partitionBy(*KEYS).orderBy(super_)
    groups = (d.groupBy(*KEYS, super_).agg(F.max(F.when(F.col("_head"), F.col("_t0"))).alias("_h0"), F.sum("_n").alias("_sn"),
                                           *[F.max(F.when(F.col("_tail"), F.col(c))).alias(c) for c in ("x", "y", "t")])
              .withColumn("_carry", F.lag(pos).over(over))
              .withColumn("_hstep", far("_h0", "_carry"))
              .withColumn("_so", F.coalesce(F.sum(F.col("_sn") + F.col("_hstep").cast("long")).over(
                  over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select(*KEYS, super_, "_carry", "_hstep", "_so"))
    before = F.col("_so") + F.col("_lp") + F.when(~F.col("_head"), F.col("_hstep").cast("long")).otherwise(F.lit(0))
    return d.join(groups, [*KEYS, super_]).select(
        *KEYS, BUCKET, F.coalesce("_local", "_carry").alias("_seed"),
        F.when(F.col("_head"), F.col("_hstep")).otherwise(F.col("_near")).alias("_fstep"), before.cast("long").alias("_off"))


def ema_running(x: Column, r: Column, w: Window) -> Column:
    """EMA (start 0) of ``x`` at row index ``r`` (0-based) of window ``w``.

    s_r = 0.3 x_r + 0.7 s_(r-1) unrolls to 0.7^r * sum_(i<=r) 0.3 * 0.7^(-i) * x_i:
    an incremental running-sum frame (O(1) per row) instead of re-folding a
    128-long list per row.  Speeds are >= 0, so the sum has no
    cancellation (relative error ~ r * 1e-16).  Callers keep r below
    ``EMA_MAX_INDEX`` so 0.7^(-r) stays finite.
    """
    decay = F.lit(1 - EMA_ALPHA)
    term = F.lit(EMA_ALPHA) * F.pow(decay, -r) * x
    running = F.sum(term).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return F.pow(decay, r) * running


def smoothed(st: DataFrame, with_flag: bool = False) -> DataFrame:
    """Adds smooth_kmh, net_dy, is_wrong_way, is_speeding to every step (and
    ``wrong_so_far`` when asked: a running max inside the block plus a carry
    from a per-block summary, joined back on the block partitioning)."""
    halo = EMA_HISTORY - 1
    blk = with_halo_blocks(st, "step_no", halo=halo, block_rows=BLOCK_STEPS)
    w = Window.partitionBy(*KEYS, "_blk").orderBy("step_no")
    # Row index inside the block partition: block 0 starts at step 1, later
    # blocks start with their 127 context steps.
    start = F.when(F.col("_blk") == 0, F.lit(1)).otherwise(
        F.col("_blk") * F.lit(BLOCK_STEPS) + F.lit(1 - halo))
    r = (F.col("step_no") - start).cast("double")
    out = (blk.withColumn("smooth_kmh", ema_running(F.col("raw_kmh"), r, w))
           .withColumn("net_dy", F.sum("dy").over(w.rowsBetween(-(DIR_WINDOW - 1), 0)))
           .where(~F.col("_ctx")).drop("_ctx"))
    out = (out.withColumn("is_wrong_way",
                          F.col("net_dy") * F.col("flow_sign") < F.lit(-WRONG_WAY_UNITS))
           .withColumn("is_speeding", F.col("smooth_kmh") > F.col("speed_limit_kmh")))
    if not with_flag:
        return out.drop("_blk")
    wrong = F.col("is_wrong_way").cast("int")
    out = materialize(out.withColumn("_wb", F.max(wrong).over(
        w.rowsBetween(Window.unboundedPreceding, 0))))
    per_block = out.groupBy(*KEYS, "_blk").agg(F.max(wrong).alias("_bw"))
    carry = exclusive_prefix(per_block, KEYS, "_blk", "_bw", "_carry").select(*KEYS, "_blk", "_carry")
    return (out.join(carry, [*KEYS, "_blk"])
            .withColumn("wrong_so_far", (F.col("_wb") > 0) | (F.col("_carry") > 0))
            .drop("_blk", "_wb", "_carry"))


def track_states(det: DataFrame, cameras: DataFrame, with_flag: bool = False,
                 session_start: _dt.datetime = SESSION_START, calibration: DataFrame | None = None) -> DataFrame:
    """Steps with smoothed speed and direction; ``with_flag`` adds
    ``wrong_so_far``.  Pass 1 of the steps runs when this is called."""
    return smoothed(steps(sightings(det, cameras, session_start, calibration)), with_flag)


_HIT_FIELDS = ["step_no", "frame_idx", "det_idx", "t_sec", "class_name", "smooth_kmh",
               "latitude", "longitude", "speed_limit_kmh", "session_start"]


def first_hits(sm: DataFrame) -> DataFrame:
    """Per track: the first wrong-way step and the first speeding step (null
    when none).  A plain aggregate: map-side partial min_by, skew-safe."""
    hit = F.struct(*[F.col(c) for c in _HIT_FIELDS])
    return sm.groupBy(*KEYS).agg(
        F.min_by(hit, F.when(F.col("is_wrong_way"), F.col("step_no"))).alias("w"),
        F.min_by(hit, F.when(F.col("is_speeding"), F.col("step_no"))).alias("v"))


def _hits_of_kind(hits: DataFrame, which: str, kind: str) -> DataFrame:
    h = F.col(which)
    sev = (F.lit(WRONG_WAY_SEVERITY) if kind == KIND_WRONG_WAY
           else severity_score(h["smooth_kmh"], h["speed_limit_kmh"]))
    return hits.where(h.isNotNull()).select(
        *KEYS, F.lit(kind).alias("Violation_Type"),
        *[h[c].alias(c) for c in _HIT_FIELDS], sev.cast("int").alias("Severity"))


def wrong_way_violations(sm: DataFrame) -> DataFrame:
    return _hits_of_kind(first_hits(sm), "w", KIND_WRONG_WAY)


def speeding_violations(sm: DataFrame) -> DataFrame:
    return _hits_of_kind(first_hits(sm), "v", KIND_SPEEDING)


def violation_events(sm: DataFrame) -> DataFrame:
    """Both kinds, one row per (track, kind) hit, from a single aggregate."""
    hits = first_hits(sm)
    sev_v = severity_score(F.col("v.smooth_kmh"), F.col("v.speed_limit_kmh"))
    both = F.array(
        F.when(F.col("w").isNotNull(), F.struct(F.lit(KIND_WRONG_WAY).alias("kind"),
                                                F.col("w").alias("h"),
                                                F.lit(WRONG_WAY_SEVERITY).alias("sev"))),
        F.when(F.col("v").isNotNull(), F.struct(F.lit(KIND_SPEEDING).alias("kind"),
                                                F.col("v").alias("h"),
                                                sev_v.alias("sev"))))
    ex = hits.select(*KEYS, F.explode(both).alias("e")).where(F.col("e").isNotNull())
    return ex.select(*KEYS, F.col("e.kind").alias("Violation_Type"),
                     *[F.col(f"e.h.{c}").alias(c) for c in _HIT_FIELDS],
                     F.col("e.sev").cast("int").alias("Severity"))


def number_violations(ev: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The log rows: one shared counter per camera and session in detection
    order (wrong way first within a detection), ``W0001`` / ``V0002`` ids
    (padded, never cut), time = session start + whole seconds of media time.

    The rows are dealt out by range of their order and kept, so a camera with
    very many violations is many ranges; a row's number is its rank within its
    range plus the rows of its camera in earlier ranges.  ``before`` (session_id,
    camera_id, total) says how many numbers a camera has given out already.
    """
    kind_rank = F.when(F.col("Violation_Type") == F.lit(KIND_WRONG_WAY), F.lit(0)).otherwise(F.lit(1))
    order = ["frame_idx", "det_idx", "_kr"]
    parts = int(ev.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # kept first: dealing by range samples its input, which is the whole tracking
    kept = materialize(with_session(ev).withColumn("_kr", kind_rank))
    ranged = materialize(kept.repartitionByRange(parts, "session_id", "camera_id", *order)
                         .withColumn("_range", F.spark_partition_id()))
    numbered = exact_positions(ranged, ["session_id", "camera_id"], [F.col(c) for c in order],
                               F.col("_range"), "_seq", two_level=True)
    if before is not None:
        numbered = (numbered.join(before, ["session_id", "camera_id"], "left")
                    .withColumn("_seq", F.col("_seq") + F.coalesce("total", F.lit(0))))
    prefix = F.when(F.col("_kr") == 0, F.lit("W")).otherwise(F.lit("V"))
    ts = F.col("session_start") + F.make_dt_interval(secs=F.floor(F.col("t_sec")).cast("decimal(18,6)"))
    return numbered.select(
        F.format_string("%s%04d", prefix, F.col("_seq")).alias("Violation_ID"),
        ts.alias("Timestamp"),
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        F.col("Violation_Type"),
        F.col("class_name").alias("Vehicle_Type"),
        F.col("Severity"),
        F.col("camera_id"), F.col("track_id"), F.col("session_id"))


def violation_log(det: DataFrame, cameras: DataFrame,
                  session_start: _dt.datetime = SESSION_START, calibration: DataFrame | None = None) -> DataFrame:
    return number_violations(violation_events(track_states(det, cameras, session_start=session_start, calibration=calibration)))


def annotated(sm: DataFrame) -> DataFrame:
    """Per step (of ``track_states(..., with_flag=True)``): red flag (wrong way
    logged so far, or over the limit now) and the overlay label."""
    label = F.concat(F.format_string("ID %d: %.1f km/h", F.col("track_id"), F.col("smooth_kmh")),
                     F.when(F.col("wrong_so_far"), F.lit(" (WRONG)")).otherwise(F.lit("")))
    return (sm.withColumn("flag", F.col("wrong_so_far") | F.col("is_speeding"))
            .withColumn("label", label))
