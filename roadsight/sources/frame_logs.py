"""Per-frame box logs as a Spark data source, for batch and for streams.

A log is a text file of one recording of one camera, or of a part of it.  Its
first line is a JSON object: ``camera_id``, and if given ``session_id`` (0),
``fps`` (25) and ``first_frame`` (0), the recording's frame at which the part
begins.  Every other line is one frame, in order: a JSON object with ``frame``
(counted from the part's beginning), ``msec`` (media time; from the frame and
fps where the container tells none) and ``boxes``, a list of objects with ``id``
(track), ``cls``, ``xyxy`` and, if given, ``n`` (the detection's number, else
its place in the frame).  Frames without boxes, with ``boxes`` null, with boxes
that have no ids, and frames where the tracker failed (an empty line) give no
rows, as the original skips them.

    register(spark)
    spark.read.format("framelog").load("logs/")
    spark.readStream.format("framelog").load("logs/")

*Batch.*  A log is cut into byte ranges of ``splitBytes`` (64 MB); a line belongs
to the range it begins in, so one long recording is read by many tasks.

*Stream.*  The offset says how many bytes of each log were read, up to the end of
a line, so a log that is still being written is followed, and a restarted query
goes on where its checkpoint says; a log that did not grow costs its name in
the offset, so keep finished recordings elsewhere.  A micro-batch takes at most
``maxBytesPerTrigger`` (256 MB) more than the one before, and the first after a
restart what there is.

Files are opened by pyarrow in the tasks: any file system it knows will do.
Malformed lines fail the query with the log's name and the byte; ``badLines`` =
``skip`` leaves them out instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = ("camera_id int, track_id long, frame_idx int, t_sec double, det_idx long, class_name string, x1 int, x2 int, y2 int, session_id long")
_ARROW = pa.schema([("camera_id", pa.int32()), ("track_id", pa.int64()), ("frame_idx", pa.int32()), ("t_sec", pa.float64()), ("det_idx", pa.int64()),
                    ("class_name", pa.string()), ("x1", pa.int32()), ("x2", pa.int32()), ("y2", pa.int32()), ("session_id", pa.int64())])
SPLIT_BYTES, BATCH_BYTES, BATCH_ROWS = 64 << 20, 256 << 20, 8192
DEFAULT_FPS = 25.0      # fixed value: where the container tells none


@dataclass
class LogRange(InputPartition):
    """Bytes of a log; lines that begin in them."""
    path: str
    start: int
    end: int


def _files(uri: str):
    from pyarrow import fs
    if "://" in uri and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    path = uri.removeprefix("file:")
    return fs.LocalFileSystem(), "/" + path.lstrip("/") if path.startswith("//") else path


def list_logs(path: str) -> dict[str, int]:
    """The logs of a folder (or one log) and their sizes, by name."""
    from pyarrow import fs
    files, root = _files(path)
    info = files.get_file_info(root)
    if info.type == fs.FileType.File:
        return {info.path: info.size}
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = files.get_file_info(fs.FileSelector(root, recursive=True))
    return {f.path: f.size for f in sorted(found, key=lambda f: f.path)
            if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))}


def whole_lines(files, path: str, size: int) -> int:
    """Where the last whole line of a log ends."""
    with files.open_input_file(path) as f:
        end = size
        while end > 0:
            start = max(0, end - 65536)
            at = f.read_at(end - start, start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


def next_line(files, path: str, start: int, size: int) -> int:
    """Where the line that begins at ``start`` ends; ``start`` if it doesn't."""
    with files.open_input_file(path) as f:
        for at in range(start, size, 1 << 20):
            found = f.read_at(min(1 << 20, size - at), at).find(b"\n")
            if found >= 0:
                return at + found + 1
    return start


def _lines(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(byte, line) of the lines that begin in [start, end), each byte handled
    once however long a line is."""
    at, rest = max(0, start - 1), []
    f.seek(at)
    skip = start > 0        # the line that holds the byte before belongs to the range before
    while at < end:         # past the end no line begins here, nor does one after a line that is left out
        chunk = f.read(1 << 20)
        if not chunk:
            if rest and not skip:
                yield at, b"".join(rest)
            return
        *lines, tail = chunk.split(b"\n")
        for line in lines:
            line, rest = b"".join([*rest, line]), []
            if skip:
                skip = False
            elif at < end:
                yield at, line
            else:
                return
            at += len(line) + 1
        if skip:
            at += len(tail)
        elif tail:
            rest.append(tail)


def _frame_rows(head: dict, frame: dict) -> list[tuple]:
    boxes = frame.get("boxes")
    if not boxes or any(b.get("id") is None for b in boxes):
        return []
    first, fps = int(head.get("first_frame") or 0), float(head.get("fps") or 0)
    fps = fps if fps > 0 else DEFAULT_FPS
    index = first + int(frame["frame"])
    t = frame["msec"] / 1000.0 if frame.get("msec") is not None else index / fps
    session = int(head.get("session_id") or 0)
    return [(int(head["camera_id"]), int(b["id"]), index, t, int(b.get("n", k)), b.get("cls"),
             int(b["xyxy"][0]), int(b["xyxy"][2]), int(b["xyxy"][3]), session) for k, b in enumerate(boxes)]


def read_range(root: str, part: LogRange, skip_bad: bool) -> Iterator[pa.RecordBatch]:
    files, _ = _files(root)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    with files.open_input_file(part.path) as f:
        head, rows = json.loads(next(_lines(f, 0, 1), (0, b"{}"))[1] or b"{}"), []
        for at, line in _lines(f, part.start, part.end):
            if at == 0 or not line.strip():
                continue
            try:
                rows += _frame_rows(head, json.loads(line))
            except (ValueError, KeyError, TypeError, IndexError, AttributeError) as e:
                if not skip_bad:
                    raise ValueError(f"{part.path}: bad line at byte {at}: {e}") from e
            if len(rows) >= BATCH_ROWS:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)


class _Options:
    def __init__(self, options: dict) -> None:
        if not options.get("path"):
            raise ValueError("framelog needs a path")
        self.root = options["path"]
        self.split = int(options.get("splitBytes") or SPLIT_BYTES)
        self.most = int(options.get("maxBytesPerTrigger") or BATCH_BYTES)
        self.skip_bad = options.get("badLines") == "skip"

    def ranges(self, path: str, start: int, end: int) -> list[LogRange]:
        return [LogRange(path, s, min(s + self.split, end)) for s in range(start, end, self.split)]


class FrameLogReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = _Options(options)

    def partitions(self) -> list[LogRange]:
        parts = [r for path, size in list_logs(self.options.root).items() for r in self.options.ranges(path, 0, size)]
        return parts or [LogRange("", 0, 0)]

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        return read_range(self.options.root, partition, self.options.skip_bad) if partition.path else iter(())


class FrameLogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.options = _Options(options)
        self.told: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        self.told = self.told or {}
        return {"bytes": {}}

    def latestOffset(self) -> dict:
        files, _ = _files(self.options.root)
        now, before = {}, self.told
        left = self.options.most if before is not None else None
        for path, size in list_logs(self.options.root).items():
            had = (before or {}).get(path, 0)
            end = whole_lines(files, path, size if left is None else min(size, had + left)) if size > had else had
            if end <= had < size and left == self.options.most:
                end = next_line(files, path, had, size)    # longer than the bound
            end = max(end, had)
            if left is not None:
                left = max(0, left - (end - had))
            now[path] = end
        self.told = now
        return {"bytes": now}

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        # a restart plans its last batch again: that is no answer to go on from with a
        # bound, for ``availableNow`` asks for the latest offset once and ends there
        return [r for path, e in end["bytes"].items() for r in self.options.ranges(path, start["bytes"].get(path, 0), e)]

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        return read_range(self.options.root, partition, self.options.skip_bad)

    def commit(self, end: dict) -> None:
        pass


class FrameLogDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "framelog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FrameLogReader:
        return FrameLogReader(self.options)

    def streamReader(self, schema) -> FrameLogStreamReader:
        return FrameLogStreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FrameLogDataSource)
