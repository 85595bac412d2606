"""Command line for spark-submit: the batch jobs end to end.

    python -m roadsight.cli ingest  --csv traffic.csv --fact out/fact
    python -m roadsight.cli marts   --fact out/fact --out out/marts
    python -m roadsight.cli rollup  --fact out/fact --out out/rollup
    python -m roadsight.cli zones   --fact out/fact --out out/zones
    python -m roadsight.cli detect  --detections dets/ --cameras cams/ --log out/log.csv
    python -m roadsight.cli stream  --detections dets/ --cameras cams/ --sink out/stream \
                                    --checkpoint ckpt/stream
    python -m roadsight.cli stream-log --sink out/stream --log out/log.csv

Inputs and outputs are paths Spark can read (local, HDFS, object stores).
Detections and cameras are Parquet with the schemas in ``roadsight.schema``.
"""

from __future__ import annotations

import argparse
import datetime as _dt

from .operators import clustering
from .operators import tracking as trk
from .operators.clean import clean_violations
from .plans import rollup
from .plans.marts import run_mart_job
from .session import get_session
from .sources.csv_source import read_violations_csv
from .sources.exports import append_log
from .sources.fact_store import read_fact, write_fact
from .streaming.tracker import MAX_FILES_PER_TRIGGER, run_violation_stream, stream_log


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="roadsight")
    p.add_argument("--master", default=None, help="leave unset under spark-submit")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest", help="CSV -> cleaned fact (Parquet by date)")
    a.add_argument("--csv", required=True)
    a.add_argument("--fact", required=True)
    a = sub.add_parser("marts", help="cleaned fact -> the ten marts")
    a.add_argument("--fact", required=True)
    a.add_argument("--out", required=True)
    a = sub.add_parser("rollup", help="bring the dashboard's roll-up up to the fact")
    a.add_argument("--fact", required=True)
    a.add_argument("--out", required=True)
    a = sub.add_parser("zones", help="cleaned fact -> K-Means points and centres")
    a.add_argument("--fact", required=True)
    a.add_argument("--out", required=True)
    for name in ("detect", "stream"):
        a = sub.add_parser(name, help="detections -> violations")
        a.add_argument("--detections", required=True)
        a.add_argument("--cameras", required=True)
        if name == "detect":
            a.add_argument("--log", required=True)
            a.add_argument("--session-start", type=_dt.datetime.fromisoformat, default=trk.SESSION_START,
                           help="start of recordings whose camera table names none")
        else:
            a.add_argument("--sink", required=True)
            a.add_argument("--checkpoint", required=True)
            a.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES_PER_TRIGGER)
            a.add_argument("--idle-seconds", type=float, default=None,
                           help="forget a track that got no rows for so long (default: never)")
    a = sub.add_parser("stream-log", help="stream sink -> numbered log")
    a.add_argument("--sink", required=True)
    a.add_argument("--log", required=True)
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = get_session("roadsight-" + args.cmd, master=args.master)
    if args.cmd == "ingest":
        write_fact(clean_violations(read_violations_csv(spark, args.csv)), args.fact)
    elif args.cmd == "marts":
        run_mart_job(spark, read_fact(spark, args.fact), args.out)
    elif args.cmd == "rollup":
        rollup.refresh(spark, args.fact, args.out)
    elif args.cmd == "zones":
        fact = read_fact(spark, args.fact)
        fitted = clustering.fit_zones(fact)
        clustering.kmeans_clusters(fact, fitted).write.mode("overwrite").parquet(
            args.out.rstrip("/") + "/points")
        clustering.kmeans_centers(spark, fact, fitted).write.mode("overwrite").parquet(
            args.out.rstrip("/") + "/centers")
    elif args.cmd == "detect":
        det, cams = spark.read.parquet(args.detections), spark.read.parquet(args.cameras)
        append_log(trk.violation_log(det, cams, args.session_start), args.log)
    elif args.cmd == "stream":
        run_violation_stream(spark, args.detections, args.sink, args.checkpoint,
                             spark.read.parquet(args.cameras),
                             max_files_per_trigger=args.max_files_per_trigger,
                             idle_seconds=args.idle_seconds)
    elif args.cmd == "stream-log":
        append_log(stream_log(spark, args.sink), args.log)


if __name__ == "__main__":
    main()
