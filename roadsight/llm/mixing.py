"""Mixing sources to target weights by a multivariate-hypergeometric splitting
tree.  DataFrame functions only.

*Targets.*  A document's size is its number of words.  Sources in code-point
order (null last) weigh 1, 2, 3, 1, ... and share the size of the whole corpus;
a target stops at ``MAX_REPEATS`` times its source's size and the excess is
shared out again by weight, which comes to one level: every source gets its
weight times that level or its limit, whichever is less.

*Blocks.*  A source's documents are put in a fixed random order (md5 of the
seed and the id) and cut into blocks of about equal mass.  A target of k whole
passes and a rest is met by k times all blocks and the first documents of the
order, up to the rest, to half a document.  That makes an exact quota of
blocks for each source.

*Tree.*  The shards are the leaves of a binary tree.  A node splits its quotas
between its children by a multivariate-hypergeometric draw: half the node's
blocks go left, each block alike.  The draw goes through the sources, one block
after the other, with the chance that the blocks still to place give it; the
numbers come from a hash of seed, node, source and block.  A leaf takes the
next blocks of each source, so shards hold disjoint blocks, and orders its
documents by a hash of its own.

*Scale.*  Cumulative sizes come from sums per (source, bucket of the order),
prefix sums over those in two levels, and a window within one bucket, so a
source with a third of all rows is many small groups.  The tree works on one
number per source and node, at most ``MOST_BLOCKS`` blocks in all (blocks grow
with the corpus beyond that).

Defined cases: a null or empty text has size 0 and takes no words; a null
source is one source, the last; a null doc_id is ordered as the text "null";
repeated rows are separate documents; an empty table gives no rows; a corpus
without words has targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import exclusive_prefix
from .tables import read_table, stored

MAX_REPEATS = 3
SEED = "mix"
BUCKET_ROWS = 256
BLOCK_MASS = 1 << 16
MOST_BLOCKS = 1 << 20
BLOCKS_PER_SHARD = 16
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _order(id_col: str) -> Column:
    """48 random bits of an id."""
    digest = F.md5(F.concat(F.lit(f"{SEED}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, sno, source_size, n_docs, target) from rows (source, size).
    The windows here go over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = per.withColumn("sno", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.col("sno") % 3 + 1).withColumn("cap", F.col("source_size") * MAX_REPEATS)
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "sno")
    before, all_rows = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(all_rows)
    level = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    ranked = ranked.withColumn("level", level).withColumn("free", F.col("ratio") > F.col("level"))
    reached = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("free"), F.col("weight") * reached).otherwise(F.col("cap").cast("double"))
    return ranked.select("source", F.col("sno").cast("long").alias("sno"), "source_size", "n_docs", target.alias("target"))


def _plan(docs: DataFrame, payload: list[str], id_col: str, text_col: str, source_col: str) -> DataFrame | None:
    """Every row with its size, source_size, target, place in its source's
    order (``at``: documents and words before it), block and number of copies."""
    rows = docs.select(F.struct(*[docs[c] for c in payload]).alias("row"), docs[source_col].alias("source"),
                       word_count(docs[text_col]).alias("size"), docs[id_col].cast("long").alias("id"))
    rows = rows.withColumn("u", _order("id"))
    sources = stored(source_targets(rows.select("source", "size")), "mix-sources")
    total = sources.agg(F.sum(F.col("source_size") + F.col("n_docs"))).first()[0]
    if total is None:
        return None
    block_mass = max(BLOCK_MASS, -(-int(total) // MOST_BLOCKS))
    bits = F.least(F.lit(40.0), F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("n_docs") / BUCKET_ROWS)).cast("double")))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.select(F.col("source").alias("of"), "sno", "source_size", "target", bits.alias("bits"), full.alias("full"))
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("bucket", F.floor(F.col("u") / F.pow(F.lit(2.0), 48 - F.col("bits"))))
    sums = rows.groupBy("sno", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    starts = exclusive_prefix(exclusive_prefix(sums, ["sno"], "bucket", "words", "words_before"),
                              ["sno"], "bucket", "rows", "rows_before")
    starts = stored(starts.select(F.col("sno").alias("s"), F.col("bucket").alias("b"), "words_before", "rows_before"), "mix-buckets")
    placed = rows.join(starts, (F.col("sno") == F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    within = (Window.partitionBy("sno", "bucket").orderBy("u", "id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    words = F.col("words_before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    count = F.col("rows_before") + F.coalesce(F.count("*").over(within), F.lit(0))
    placed = placed.withColumn("words_at", words).withColumn("at", words + count)
    rest = F.col("target") - F.col("full") * F.col("source_size")
    extra = F.col("words_at") + F.col("size") / 2 <= rest
    return placed.select("row", "source", "id", "size", "source_size", "target", "sno", "at", "full",
                         (F.col("full") + F.when(extra, 1).otherwise(0)).alias("copies"),
                         F.floor(F.col("at") / F.lit(block_mass)).alias("block"))


def split_quotas(quotas: DataFrame, levels: int) -> DataFrame:
    """(node, sno, quota): the quotas (sno, quota) split between the leaves of
    a tree ``levels`` deep, all leaves of a node's half as large, to one block."""
    root = quotas.filter("quota > 0").groupBy().agg(F.sort_array(F.collect_list(F.struct("sno", "quota"))).alias("q"))
    nodes = root.select(F.lit(1).cast("long").alias("node"), "q")
    take = """aggregate(if(x.quota > 0, sequence(1L, x.quota), cast(array() as array<bigint>)),
                named_struct('n', a.n, 'm', a.m, 'k', 0L),
                (b, j) -> if(pmod(xxhash64('{seed}', node, x.sno, j), 1073741824L) / 1073741824D * b.n < b.m,
                             named_struct('n', b.n - 1, 'm', b.m - 1, 'k', b.k + 1),
                             named_struct('n', b.n - 1, 'm', b.m, 'k', b.k)), b -> b.k)""".format(seed=SEED)
    draw = f"""aggregate(q, named_struct('n', total, 'm', total div 2, 'out', cast(array() as array<bigint>)),
                (a, x) -> transform(array({take}), k -> named_struct('n', a.n - x.quota, 'm', a.m - k,
                                                                     'out', concat(a.out, array(k))))[0], a -> a.out)"""
    for _ in range(levels):
        nodes = nodes.withColumn("total", F.expr("aggregate(q, 0L, (s, x) -> s + x.quota)")).withColumn("left", F.expr(draw))
        nodes = nodes.select(F.explode(F.expr("""array(
            named_struct('node', 2 * node, 'q', filter(zip_with(q, left, (x, k) -> named_struct('sno', x.sno, 'quota', k)), x -> x.quota > 0)),
            named_struct('node', 2 * node + 1, 'q', filter(zip_with(q, left, (x, k) -> named_struct('sno', x.sno, 'quota', x.quota - k)), x -> x.quota > 0)))
            """)).alias("c")).select("c.node", "c.q")
    leaves = nodes.select((F.col("node") - F.lit(1 << levels)).alias("shard"), F.explode("q").alias("x"))
    return leaves.select("shard", "x.sno", "x.quota")


def mix(docs: DataFrame, payload: list[str], id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame | None:
    """One row per drawn copy, and one with a null shard per document not
    drawn: ``row`` (struct of the payload columns), size, source_size, target,
    sno and at (which name the document), pass, shard and ``key``, the hash
    that orders a shard.  None if there are no documents."""
    plan = _plan(docs, payload, id_col, text_col, source_col)
    if plan is None:
        return None
    quotas = plan.groupBy("sno", "full").agg(
        (F.max("block") + 1).alias("blocks"),
        F.coalesce(F.max(F.when(F.col("copies") > F.col("full"), F.col("block"))) + 1, F.lit(0)).alias("part"))
    quotas = stored(quotas.select("sno", "blocks", (F.col("full") * F.col("blocks") + F.col("part")).cast("long").alias("quota")),
                    "mix-quotas")
    drawn = quotas.agg(F.sum("quota")).first()[0] or 0
    levels = max(0, (-(-int(drawn) // BLOCKS_PER_SHARD) - 1).bit_length())
    leaves = stored(split_quotas(quotas.select("sno", "quota"), levels), "mix-leaves")
    upto = F.sum("quota").over(Window.partitionBy("sno").orderBy("shard"))
    places = leaves.withColumn("upto", upto).select(
        F.col("sno").alias("s"), "shard", F.explode(F.sequence(F.col("upto") - F.col("quota"), F.col("upto") - 1)).alias("j"))
    places = stored(places, "mix-places")
    copies = plan.join(quotas.select(F.col("sno").alias("q_sno"), "blocks"), F.col("sno") == F.col("q_sno"))
    copies = copies.withColumn("pass", F.explode_outer(F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1))))
    copies = copies.withColumn("place", F.col("pass") * F.col("blocks") + F.col("block"))
    out = copies.join(places, (F.col("sno") == F.col("s")) & (F.col("place") == F.col("j")), "left")
    return out.select("row", "size", "source_size", "target", "sno", "at", "pass", "shard",
                      F.xxhash64(F.lit(SEED), "shard", "sno", "at", "pass").alias("key"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: ``docs`` rows, repeated or left out as drawn, a shard to
    a partition range and each shard in its own random order."""
    drawn = mix(docs, docs.columns, id_col, text_col, source_col)
    if drawn is None:
        return docs
    drawn = drawn.filter("shard is not null").select("row", "shard", "key")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return drawn.repartition(parts, "shard").sortWithinPartitions("shard", "key").select("row.*")


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    """Query: doc_id, size, source_size, target and taken (words) of every document."""
    docs = read_table(spark, sf_dir, "documents")
    drawn = mix(docs, ["doc_id"])
    if drawn is None:
        return spark.createDataFrame([], "doc_id long, size long, source_size long, target double, taken long")
    per = drawn.groupBy("sno", "at").agg(F.first("row.doc_id").alias("doc_id"), F.first("size").alias("size"),
                                         F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                                         F.count("shard").alias("n"))
    return per.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n")).alias("taken"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sno
      FROM d GROUP BY source),
w AS (SELECT *, sno % 3 + 1 AS weight, source_size * 3 AS cap, (source_size * 3) / (sno % 3 + 1)::DOUBLE AS ratio FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER b, 0))::DOUBLE
                / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
      FROM w WINDOW b AS (ORDER BY ratio, sno ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             CASE WHEN ratio > level THEN weight * (SELECT max(level) FROM l WHERE ratio > level) ELSE cap::DOUBLE END AS target
      FROM l),
p AS (SELECT d.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS passes,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id NULLS FIRST, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_at
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (passes + CASE WHEN words_at + size / 2.0 <= target - passes * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
