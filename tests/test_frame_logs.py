import json

import pytest
from pyspark.sql import functions as F

from roadsight.sources import frame_logs as fl


def _line(frame, boxes, **more):
    return json.dumps({"frame": frame, "boxes": boxes, **more})


def _box(i, cls="car", x1=10.9, y2=40.7, **more):
    return {"id": i, "cls": cls, "xyxy": [x1, 5.0, 30.2, y2], **more}


def _log(path, head, lines, end="\n"):
    path.write_text("\n".join([json.dumps(head), *lines]) + end)


@pytest.fixture()
def source(spark):
    fl.register(spark)
    return lambda path, **opt: spark.read.format("framelog").options(**opt).load(str(path))


def test_frames_offsets_and_frames_without_boxes(source, tmp_path):
    _log(tmp_path / "a.log", {"camera_id": 3, "session_id": 9, "fps": 50, "first_frame": 100},
         [_line(0, [_box(1), _box(2, "bus", n=7)], msec=2000.5), "", _line(1, None), _line(2, []), _line(3, [{"cls": "car", "xyxy": [1, 2, 3, 4], "id": None}]),
          _line(4, [_box(1)])])
    _log(tmp_path / "b.log", {"camera_id": 4, "fps": 0}, [_line(25, [_box(5, x1=-3.7)])], end="")      # no newline at the end
    (tmp_path / "_hidden.log").write_text("not a log")
    rows = sorted(map(tuple, source(tmp_path).collect()))
    assert rows == [(3, 1, 100, 2.0005, 0, "car", 10, 30, 40, 9), (3, 1, 104, 104 / 50, 0, "car", 10, 30, 40, 9),
                    (3, 2, 100, 2.0005, 7, "bus", 10, 30, 40, 9), (4, 5, 25, 1.0, 0, "car", -3, 30, 40, 0)]


def test_any_split_reads_every_line_once(source, tmp_path):
    _log(tmp_path / "a.log", {"camera_id": 1}, [_line(f, [_box(t, cls="é" * (f % 40)) for t in range(f % 3)]) for f in range(200)])
    want = sorted(map(tuple, source(tmp_path).collect()))
    assert len(want) == sum(f % 3 for f in range(200))
    for split in (97, 1000, 4096):
        assert sorted(map(tuple, source(tmp_path, splitBytes=str(split)).collect())) == want


def test_empty_folder_missing_folder_and_bad_lines(source, tmp_path):
    (tmp_path / "none").mkdir()
    assert source(tmp_path / "none").collect() == []
    with pytest.raises(Exception):
        source(tmp_path / "absent").collect()
    (tmp_path / "bad").mkdir()
    _log(tmp_path / "bad" / "a.log", {"camera_id": 1}, [_line(0, [_box(1)]), '{"frame": 1, "boxes": [{"id"', _line(2, [_box(2)])])
    with pytest.raises(Exception, match="bad line at byte"):
        source(tmp_path / "bad").collect()
    assert sorted(r.frame_idx for r in source(tmp_path / "bad", badLines="skip").collect()) == [0, 2]


def test_stream_follows_growing_logs_and_keeps_its_place(spark, tmp_path):
    fl.register(spark)
    src, out, ckpt = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()

    def run(**opt):
        q = (spark.readStream.format("framelog").options(**opt).load(str(src)).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()

    _log(src / "a.log", {"camera_id": 1}, [_line(f, [_box(1)]) for f in range(5)] + ['{"frame": 5, "bo'], end="")    # a line being written
    run()
    assert spark.read.parquet(out).count() == 5
    with (src / "a.log").open("a") as f:
        f.write('xes": []}\n' + "".join(_line(k, [_box(1)]) + "\n" for k in range(6, 9)))
    _log(src / "b.log", {"camera_id": 2, "first_frame": 50}, [_line(f, [_box(1), _box(2)]) for f in range(4)])
    run()
    run()                                                                     # nothing new
    got = spark.read.parquet(out).groupBy("camera_id").agg(F.count("*").alias("n"), F.countDistinct("frame_idx", "track_id").alias("d"))
    assert {tuple(r) for r in got.collect()} == {(1, 8, 8), (2, 8, 8)}


def test_a_line_longer_than_the_bound_still_comes(tmp_path):
    _log(tmp_path / "a.log", {"camera_id": 1}, [_line(0, [_box(t) for t in range(100)]), _line(1, [_box(1)])])
    reader = fl.FrameLogStreamReader({"path": str(tmp_path), "maxBytesPerTrigger": "100"})
    reader.initialOffset()
    seen = [sum(reader.latestOffset()["bytes"].values()) for _ in range(4)]
    assert seen == sorted(seen) and seen[-1] == sum(fl.list_logs(str(tmp_path)).values())


def test_a_micro_batch_is_bounded(tmp_path):
    for name in "abc":
        _log(tmp_path / f"{name}.log", {"camera_id": 1}, [_line(f, [_box(1)]) for f in range(50)])
    reader = fl.FrameLogStreamReader({"path": str(tmp_path), "maxBytesPerTrigger": "1500"})
    sizes, before = fl.list_logs(str(tmp_path)), reader.initialOffset()["bytes"]
    for _ in range(40):
        now = reader.latestOffset()["bytes"]
        read = sum(now.values()) - sum(before.values())
        assert 0 < read <= 1500 or now == sizes
        if now == sizes:
            break
        before = now
    assert now == sizes


class _Counted:
    """A log in memory that counts the bytes read and how often."""

    def __init__(self, data):
        self.data, self.at, self.read_bytes = data, 0, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        out = self.data[self.at:self.at + n]
        self.at, self.read_bytes = self.at + len(out), self.read_bytes + len(out)
        return out


def test_ranges_inside_a_long_line_do_not_read_it_to_its_end():
    step, long = 1 << 20, b"x" * (40 << 20)
    data = b"head\n" + long + b"\nlast\n"
    seen, total = [], 0
    for start in range(0, len(data), step):
        f = _Counted(data)
        seen += fl._lines(f, start, min(start + step, len(data)))
        total += f.read_bytes
    assert [(at, len(line)) for at, line in seen] == [(0, 4), (5, len(long)), (len(long) + 6, 4)]
    assert total < 5 * len(data)


@pytest.mark.parametrize("end", [b"", b"\n"])
def test_ranges_of_any_size_give_every_line_once(end):
    data = b"\n".join([b"a", b"", b"bb" * 9, b"", b"ccc", b"d" * 30]) + end
    want = [(at, line) for at, line in zip([0, 2, 3, 22, 23, 27], data.split(b"\n"))]
    for size in range(1, len(data) + 1):
        assert [x for s in range(0, len(data), size) for x in fl._lines(_Counted(data), s, min(s + size, len(data)))] == want


def test_available_now_takes_all_there_is_after_a_restart(spark, tmp_path):
    fl.register(spark)
    src, out, ckpt = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    for part in range(3):
        for name in "abc":
            _log(src / f"{name}{part}.log", {"camera_id": 1, "first_frame": 50 * part}, [_line(f, [_box(1)]) for f in range(50)])
        (spark.readStream.format("framelog").option("maxBytesPerTrigger", "1500").load(str(src)).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
        assert spark.read.parquet(out).count() == 150 * (part + 1)
