from roadsight import cli
from roadsight.plans import rollup
from roadsight.sources import fixtures
from roadsight.sources.csv_source import write_violations_csv
from roadsight.sources.mart_store import MART_PATHS, load_all

from .conftest import SF001


def test_batch_jobs_end_to_end(spark, tmp_path):
    csv, fact, marts = (str(tmp_path / n) for n in ("csv", "fact", "marts"))
    write_violations_csv(fixtures.violations(spark, SF001), csv)
    cli.main(["ingest", "--csv", csv, "--fact", fact])
    cli.main(["marts", "--fact", fact, "--out", marts])
    loaded = load_all(spark, marts)
    assert all(df is not None for df in loaded.values())
    assert loaded["type"].groupBy().sum("total_violations").first()[0] == 1000
    for rel in MART_PATHS.values():
        assert (tmp_path / "marts" / rel).exists()
    cli.main(["rollup", "--fact", fact, "--out", str(tmp_path / "rollup")])
    assert rollup.dashboard(spark, str(tmp_path / "rollup"))["kpis"].first().total_violations == 1000


def test_detect_job_appends_log(spark, tmp_path):
    dets, cams, log = (str(tmp_path / n) for n in ("dets", "cams", "log"))
    fixtures.detections(spark, SF001).write.parquet(dets)
    fixtures.fixture_cameras(spark).write.parquet(cams)
    cli.main(["detect", "--detections", dets, "--cameras", cams, "--log", log])
    cli.main(["detect", "--detections", dets, "--cameras", cams, "--log", log])
    once = spark.read.option("header", True).csv(log).count()
    assert once > 0 and once % 2 == 0      # two appends of the same batch
