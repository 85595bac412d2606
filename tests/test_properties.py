"""Property tests: the split operators equal their plain forms."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadsight.operators.sequence import exact_positions, with_halo_blocks

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 500)), min_size=1, max_size=300),
       st.integers(1, 40))
def test_exact_positions_equal_row_number(spark, rows, width):
    # key 0 is made hot: it gets every row a second time with a shifted order value
    rows = rows + [(0, v + 1000) for _, v in rows]
    data = [(k, v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, v int, i int")
    order = [F.col("v"), F.col("i")]
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    for two_level in (False, True):
        got = exact_positions(df, ["k"], order, F.floor(F.col("v") / F.lit(width)), "pos",
                              two_level=two_level)
        assert sorted(map(tuple, got.select("k", "i", "pos").collect())) == \
            sorted(map(tuple, want.select("k", "i", "pos").collect()))


@SETTINGS
@given(st.integers(1, 400), st.integers(3, 9), st.integers(1, 5))
def test_halo_blocks_give_the_same_frames(spark, n, block, halo_):
    halo = min(halo_, block - 1)
    df = spark.range(1, n + 1).select(F.lit(1).alias("k"), F.col("id").alias("pos"),
                                      (F.col("id") * 7 % 11).cast("double").alias("x"))
    frame = lambda w: F.sum("x").over(w.rowsBetween(-halo, 0))
    b = with_halo_blocks(df, "pos", halo, block)
    got = (b.withColumn("s", frame(Window.partitionBy("k", "_blk").orderBy("pos")))
           .where(~F.col("_ctx")).select("pos", "s"))
    want = df.withColumn("s", frame(Window.partitionBy("k").orderBy("pos"))).select("pos", "s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60), st.integers(-5, 5)),
                min_size=1, max_size=120, unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 5))
def test_two_level_scans_equal_plain_windows(spark, rows, fanout):
    from roadsight.operators.sequence import exclusive_prefix, previous_values
    df = spark.createDataFrame(rows, "k int, c long, v long")
    got = exclusive_prefix(previous_values(df, ["k"], "c", ["v"], "prev", fanout),
                           ["k"], "c", "v", "off", fanout)
    w = Window.partitionBy("k").orderBy("c")
    want = (df.withColumn("prev", F.lag(F.struct(F.col("v").alias("v"))).over(w))
            .withColumn("off", F.coalesce(F.sum("v").over(
                w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")))
    key = lambda r: (r.k, r.c, r.v, None if r.prev is None else r.prev.v, r.off)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
