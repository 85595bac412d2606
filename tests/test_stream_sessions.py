import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from roadsight.operators import tracking as trk
from roadsight.schema import SESSION_CAMERA_SCHEMA, SESSION_DETECTION_SCHEMA
from roadsight.sources.versions import current_version
from roadsight.streaming import numbering, sessions
from roadsight.streaming.tracker import LATE_ROWS, stream_log, violation_stream

START = dt.datetime(2024, 5, 1, 8)


def _cameras(spark):
    rows = [(c, 13.0 + c, 80.0, 5.0, True, s, START + dt.timedelta(days=s)) for s in (0, 1) for c in (0, 1)]
    return spark.createDataFrame(rows, SESSION_CAMERA_SCHEMA)


def _detections(spark, frames=60, tracks=6):
    rows = []
    for s in (0, 1):
        for t in range(tracks):
            for f in range(t, frames, 1 + t % 2):
                y = 200 + f * (3 + t) if t % 3 else 900 - f * 9
                rows.append((t % 2, t, f, f / 25.0, t, "car" if t else "bus", 900, 1000 + t, y, s))
    return spark.createDataFrame(rows, SESSION_DETECTION_SCHEMA)


def _paths(tmp_path):
    return [str(tmp_path / x) for x in ("src", "sink", "ckpt")]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_state_is_gone_after_the_recordings_and_hits_equal_batch(spark, tmp_path):
    src, sink, ckpt = _paths(tmp_path)
    det, cams = _detections(spark), _cameras(spark)
    det.repartition(3, *trk.KEYS).write.parquet(src)
    query = sessions.start(spark, src, sink, ckpt, cams.withColumn("session_end", F.col("session_start") + F.expr("INTERVAL 1 HOUR")), grace_seconds=0.5)
    assert sessions.run_until_forgotten(query, 120)
    assert sessions.held_tracks(spark, ckpt).count() == 0
    assert _rows(sessions.held_tracks(spark, ckpt, 0)) == _rows(det.select(*trk.KEYS).distinct())
    assert _rows(stream_log(spark, sink)) == _rows(trk.violation_log(det, cams))


def _run_for_a_while(query):
    """Until two micro-batches after the start are done."""
    first, end = None, time.monotonic() + 60
    while time.monotonic() < end and query.isActive:
        p = query.lastProgress
        first = p["batchId"] if p and first is None else first
        if first is not None and p["batchId"] >= first + 1:
            break
        time.sleep(0.2)
    query.stop()


def test_state_stays_while_the_recording_goes_on(spark, tmp_path):
    src, sink, ckpt = _paths(tmp_path)
    det, cams = _detections(spark), _cameras(spark)
    ends = cams.withColumn("session_end", F.when(F.col("session_id") == 1, F.lit("2199-01-01 00:00:00").cast("timestamp_ntz"))
                           .otherwise(F.col("session_start")))
    for cut in ("frame_idx < 25", "frame_idx >= 25"):        # a restart in between continues from the state
        det.where(cut).repartition(3, *trk.KEYS).write.mode("append").parquet(src)
        _run_for_a_while(sessions.start(spark, src, sink, ckpt, ends, grace_seconds=3600))
    assert sessions.held_tracks(spark, ckpt).count() == det.select(*trk.KEYS).distinct().count()
    assert _rows(stream_log(spark, sink)) == _rows(trk.violation_log(det, cams))


def test_provider_setting_comes_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError), sessions.rocksdb(spark):
        raise ValueError
    assert spark.conf.get(name, None) == before


def _stream(spark, src, cams):
    reader = spark.readStream.schema(SESSION_DETECTION_SCHEMA).option("maxFilesPerTrigger", 64)
    return violation_stream(reader.parquet(src), cams)


def test_ids_survive_a_batch_that_dies_and_one_that_comes_again(spark, tmp_path, monkeypatch):
    src, root, ckpt = _paths(tmp_path)
    det, cams = _detections(spark), _cameras(spark)
    for i, cut in enumerate(("frame_idx < 20", "frame_idx >= 20 and frame_idx < 40", "frame_idx >= 40")):
        det.where(cut).repartition(2, *trk.KEYS).write.mode("append").parquet(src)
        if i == 1:      # dies with its rows written and its manifest not
            def die(*_):
                raise RuntimeError("died before the manifest")
            with monkeypatch.context() as m:
                m.setattr(numbering, "commit", die)
                with pytest.raises(Exception, match="died before the manifest"):
                    numbering.write_numbered(_stream(spark, src, cams), root, ckpt)
            assert current_version(spark, root) == 1
        numbering.write_numbered(_stream(spark, src, cams), root, ckpt)
    for f in ("2", ".2.crc"):
        (tmp_path / "ckpt" / "commits" / f).unlink()         # the stream dies after its sink: the batch comes again
    numbering.write_numbered(_stream(spark, src, cams), root, ckpt)
    assert current_version(spark, root) == 3
    assert _rows(numbering.numbered_log(spark, root)) == _rows(trk.violation_log(det, cams))


@pytest.mark.parametrize("snapshot", [1, 2, 64])
def test_counters_go_on_over_many_batches(spark, tmp_path, monkeypatch, snapshot):
    monkeypatch.setattr(numbering, "SNAPSHOT", snapshot)
    root, cams = str(tmp_path / "log"), _cameras(spark)
    sm = trk.track_states(_detections(spark), cams)
    hits = trk.violation_events(sm).select("*")
    late = hits.limit(1).withColumn("Violation_Type", F.lit(LATE_ROWS)).withColumn("step_no", F.lit(3).cast("long"))
    cuts = [hits.where("camera_id = 0 and frame_idx < 5"), hits.where("false"), hits.where("camera_id = 1").unionByName(late),
            hits.where("camera_id = 0 and frame_idx >= 5")]
    for i, cut in enumerate(cuts):
        assert numbering.number_batch(cut, i, root)
        assert not numbering.number_batch(cut, i, root)
    assert _rows(numbering.numbered_log(spark, root)) == _rows(trk.number_violations(hits))
    assert numbering.late_rows(spark, root).first().rows == 3
