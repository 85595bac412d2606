from roadsight.session import checkpoint_root, cluster_sizing, scratch_path


def test_checkpoint_folder_comes_from_the_session(spark):
    root = checkpoint_root(spark)
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert conf and conf.rstrip("/").endswith(root.split("://")[-1].rstrip("/").split("/")[-1])
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_cluster_sizing_bounds():
    tb100 = cluster_sizing(100 * 10**12, total_cores=8000)
    assert int(tb100["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))   # 256 MB each, no cap
    small = cluster_sizing(10**9, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16_000      # two waves of cores
    assert small["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
