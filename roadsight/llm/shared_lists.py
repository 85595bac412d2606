"""Hard negatives through anchor-clustered shared lists (MAXIMUS-style).

*Lists.*  Anchors are clustered by direction.  An inner product of an anchor u
of a cluster and a candidate i is at most |u| |i| cos(max(0, a - b)), where a
is the candidate's angle to the cluster's centre and b the largest angle of a
member to it.  So |i| cos(max(0, a - b)) orders the candidates for all members
at once: for each cluster they are sorted by it once, descending.

*Walks.*  Every member walks its cluster's list, a stretch at a time, with exact
integer scores.  A walk ends, certified, when |u| times the next bound is below
what the member still needs: for positives its 5th best score of its label so
far, for negatives the least over its positives of the 10th best score inside
the positive's window so far, or of the window's lower end while there are
fewer.  Bounds are raised beyond their rounding error, so nothing is lost.

*Scale.*  Candidates lie in blocks of at most ``BLOCK`` rows and anchors in groups
of at most ``GROUP``, both dealt by range of (length, label, row), so a label
of any size is many blocks.  A group goes to the blocks that hold its labels
for positives, then to those that hold others for negatives; a task holds one
group and one block, whose lists are sorted there, once for each cluster and
kind of candidate.  A block hands on at most 5 positives an anchor and 10
negatives a positive.  Anchors are dealt to groups by centres fitted on at most
``SAMPLE`` anchors; clusters are made inside a group, from all its members.

Defined cases: rows with a null id, label or vector, null or non-finite
components, or a label that is no integer take no part; scores are between
vectors of one length; rows that repeat an id are rows of their own (an anchor
leaves out its own row, not its id), told apart among equal scores in any
order; a positive of score 0 has the negatives of score 0, one below 0 none;
vectors without components or of zeros score 0; components beyond the range of
``vectors`` are set to its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bit_sliced_topk import INTEGER_VECTORS
from .tables import read_table, small_batches, stored
from .vectors import BLOCK, LEAST, cut_blocks, matrix, numbered, packed, pieces, quantised

EVERY, SHIFTED, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
#: The window in hundredths of the positive's score.
LOWER, UPPER = 30, 90
GROUP, SAMPLE, MEMBERS = 1 << 10, 1 << 12, 16
STRETCH = 1 << 10


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and unit vectors (zero for zero)."""
    x = x.astype(np.float64)
    norm = np.sqrt((x ** 2).sum(axis=1))
    return norm, x / np.where(norm > 0, norm, 1.0)[:, None]


def _spherical(unit: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """Unit centres of at most k clusters by direction."""
    centres = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
    for _ in range(rounds):
        near = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        norm = np.sqrt((sums ** 2).sum(axis=1))
        centres = np.where(norm[:, None] > 0, sums / np.where(norm > 0, norm, 1.0)[:, None], centres)
    return centres


def exact_scores(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where these are exact."""
    most = float(np.abs(u).max(initial=0)) * float(np.abs(v).max(initial=0)) * u.shape[1]
    if most < 2.0 ** 53:
        return (u.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return u @ v.T


class SharedList:
    """A block's candidates in the order of their bound for one cluster."""

    def __init__(self, members: np.ndarray, c: np.ndarray, lengths: np.ndarray, units: np.ndarray) -> None:
        self.members = members
        norm, unit = _directions(members)
        centre = unit.sum(axis=0)
        size = np.sqrt((centre ** 2).sum())
        if size > 0:
            centre = centre / size
            spread = np.arccos(np.clip(unit[norm > 0] @ centre, -1.0, 1.0)).max(initial=0.0)
            away = np.arccos(np.clip(units @ centre, -1.0, 1.0)) - spread - 1e-6
            bound = lengths * np.cos(np.maximum(away, 0.0))
        else:       # no direction: the bound of any
            bound = lengths.copy()
        self.order = np.argsort(-bound, kind="stable")
        self.norm = norm * (1 + 1e-9)
        # a bound is a length times a cosine: rounding is relative to the length
        self.bound = bound[self.order] + 1e-9 * lengths.max(initial=0.0)
        self.c = c[self.order]

    def stretches(self, need: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(members still walking, positions in the block, scores); ``need`` is
        what a score must reach to matter, raised by the caller on the way."""
        walking, size = np.arange(len(self.members)), 64
        at = 0
        while at < len(self.order):
            walking = walking[self.norm[walking] * self.bound[at] >= need[walking]]
            if not len(walking):
                return
            yield walking, self.order[at:at + size], exact_scores(self.members[walking], self.c[at:at + size])
            at, size = at + size, min(2 * size, STRETCH)


def _best(score: np.ndarray, ids: np.ndarray, rids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((rids, ids, -score))[:k]


NONE = np.iinfo(np.int64).min


def walk_positives(lst: SharedList, own: np.ndarray, ids: np.ndarray, rids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per member the positions and scores of its k best candidates, itself (row ``own``) left out."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in own]
    need = np.full(len(own), NONE, dtype=np.float64)
    for walking, at, score in lst.stretches(need):
        for m, s in zip(walking, score):
            hit = np.flatnonzero((s >= need[m]) & (rids[at] != own[m]))
            if len(hit):
                pos, val = np.concatenate([found[m][0], at[hit]]), np.concatenate([found[m][1], s[hit]])
                keep = _best(val, ids[pos], rids[pos], k)
                found[m] = pos[keep], val[keep]
                if len(keep) == k:
                    need[m] = float(val[keep[-1]])
    return found


def walk_negatives(lst: SharedList, windows: list[np.ndarray], ids: np.ndarray, rids: np.ndarray, k: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Per member and window (lowest, highest score) the positions and scores
    of its k best candidates inside the window."""
    found = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in w] for w in windows]
    floors = [[int(lo) if lo <= hi else None for lo, hi in w] for w in windows]
    least = lambda m: min((f for f in floors[m] if f is not None), default=np.inf)
    need = np.array([float(least(m)) for m in range(len(windows))])
    for walking, at, score in lst.stretches(need):
        for m, s in zip(walking, score):
            near = np.flatnonzero(s >= need[m])
            if not len(near):
                continue
            for j, (_, hi) in enumerate(windows[m]):
                if floors[m][j] is None:
                    continue
                hit = near[(s[near] >= floors[m][j]) & (s[near] <= hi)]
                if len(hit):
                    pos, val = np.concatenate([found[m][j][0], at[hit]]), np.concatenate([found[m][j][1], s[hit]])
                    keep = _best(val, ids[pos], rids[pos], k)
                    found[m][j] = pos[keep], val[keep]
                    if len(keep) == k:
                        floors[m][j] = int(val[keep[-1]])
            need[m] = float(least(m))
    return found


# -- blocks and groups --

def _by_direction(anchors: DataFrame, n: int) -> DataFrame:
    """``anchors`` with a column ``course``: the nearest of about ``n`` centres
    fitted on at most ``SAMPLE`` of them (of the sample's first length)."""
    drawn = anchors.select("c", "dim", F.xxhash64("c").alias("h")).orderBy("h", "c").limit(SAMPLE).toArrow()
    dims = drawn["dim"].to_numpy()
    if n < 2 or not len(dims):
        return anchors.withColumn("course", F.lit(0))
    dim = int(dims[0])
    centres = _spherical(_directions(matrix(drawn["c"].combine_chunks().filter(pa.array(dims == dim)), dim))[1], min(n, SAMPLE // 16))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            course = np.zeros(b.num_rows, dtype=np.int32)
            known = np.flatnonzero(b.column("dim").to_numpy() == dim)
            if len(known):
                course[known] = (_directions(matrix(b.column("c").take(pa.array(known)), dim))[1] @ centres.T).argmax(axis=1)
            yield b.append_column("course", pa.array(course))

    return anchors.mapInArrow(run, anchors.withColumn("course", F.lit(0)).schema)


_BLOB = "dim int, labels array<long>, ids array<long>, rids array<long>, label array<long>, c binary"


def _blob(dim: int, t: pa.Table) -> Iterator[pa.RecordBatch]:
    label, whole = t["label"].to_numpy(), pa.list_(pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([np.unique(label)], whole), pa.array([t["vec_id"].to_numpy()], whole), pa.array([t["rid"].to_numpy()], whole),
         pa.array([label], whole), packed(matrix(t["c"].combine_chunks(), dim), np.int32)], ["dim", "labels", "ids", "rids", "label", "c"])


def _blocks(rows: DataFrame, keys: list[str], n: int, size: int, name: str) -> DataFrame:
    dealt = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return stored(dealt.mapInArrow(cut_blocks(size, ["vec_id", "rid", "label", "c"], _blob), _BLOB).withColumn("no", F.monotonically_increasing_id()), name)


def _open(rb: pa.RecordBatch, i: int, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, rids, labels and integers of the block or group in row ``i``."""
    ids, rids, label = (rb.column(prefix + x)[i].values.to_numpy() for x in ("ids", "rids", "label"))
    c = np.frombuffer(rb.column(prefix + "c")[i].as_py(), np.int32).reshape(len(ids), rb.column("dim")[i].as_py())
    return ids, rids, label, c.astype(np.int64)


def _clusters(label: np.ndarray, c: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(label, members): the anchors of a group by label and direction."""
    for k in np.unique(label):
        of = np.flatnonzero(label == k)
        unit = _directions(c[of])[1]
        near = (unit @ _spherical(unit, -(-len(of) // MEMBERS)).T).argmax(axis=1)
        for j in np.unique(near):
            yield int(k), of[near == j]


def _positives(k: int):
    names = ["a_rid", "anchor_id", "p_rid", "positive_id", "positive_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in range(rb.num_rows):
                a_ids, a_rids, a_label, a = _open(rb, i, "a_")
                ids, rids, label, c = _open(rb, i)
                out = []
                for k_, members in _clusters(a_label, a):
                    of = np.flatnonzero(label == k_)
                    if not len(of):
                        continue
                    lst = SharedList(a[members], c[of], *_directions(c[of]))
                    for m, (at, s) in zip(members, walk_positives(lst, a_rids[members], ids[of], rids[of], k)):
                        out.append((np.full(len(at), a_rids[m]), np.full(len(at), a_ids[m]), rids[of][at], ids[of][at], s))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names)
    return run


def _negatives(k: int, lower: int, upper: int):
    names = ["a_rid", "anchor_id", "p_rid", "positive_id", "positive_score", "n_rid", "negative_id", "negative_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in range(rb.num_rows):
                a_ids, a_rids, a_label, a = _open(rb, i, "a_")
                ids, rids, label, c = _open(rb, i)
                of_anchor: dict[int, list[tuple[int, int, int]]] = {}
                for p in rb.column("positives")[i].as_py():
                    of_anchor.setdefault(p["a_rid"], []).append((p["p_rid"], p["positive_id"], p["positive_score"]))
                out = []
                for k_, members in _clusters(a_label, a):
                    of = np.flatnonzero(label != k_)
                    if not len(of):
                        continue
                    lst = SharedList(a[members], c[of], *_directions(c[of]))
                    pos = [of_anchor.get(int(a_rids[m]), []) for m in members]
                    # least and greatest integer inside the window
                    windows = [np.array([(-(-lower * s // 100), upper * s // 100) for _, _, s in p], dtype=object).reshape(-1, 2) for p in pos]
                    for m, ps, got in zip(members, pos, walk_negatives(lst, windows, ids[of], rids[of], k)):
                        for (p_rid, p_id, s), (at, val) in zip(ps, got):
                            n = len(at)
                            out.append((np.full(n, a_rids[m]), np.full(n, a_ids[m]), np.full(n, p_rid), np.full(n, p_id), np.full(n, s),
                                        rids[of][at], ids[of][at], val))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)], names)
    return run


def hard_negatives(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   every: int = EVERY, shifted: int = SHIFTED, labels: int = LABELS, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, lower: int = LOWER, upper: int = UPPER, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    of the anchors, the rows whose id is divisible by ``every``.  Where an id
    is divisible by ``shifted`` its label first becomes (label + 1) % ``labels``."""
    spark = table.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small_batches(spark)
    rows = quantised(table, id_col, vector_col, label_col)
    moved = F.when(F.col("vec_id") % shifted == 0, F.try_add("label", F.lit(1)) % labels).otherwise(F.col("label"))
    rows = numbered(rows.withColumn("label", moved).filter("label is not null"), "quantised-vectors")
    anchors = rows.filter(F.col("vec_id") % every == 0)
    n_anchors = anchors.count()
    candidates = _blocks(rows, ["dim", "label", "rid"], pieces(rows.count(), block, LEAST, parts), block, "candidate-blocks")
    groups = _blocks(_by_direction(anchors, -(-n_anchors // group)), ["dim", "label", "course", "rid"],
                     pieces(n_anchors, group, MEMBERS, parts), group, "anchor-groups")
    g = groups.select("dim", "labels", F.col("no").alias("a_no"), *[F.col(x).alias("a_" + x) for x in ("ids", "rids", "label", "c")])

    def meet(which: DataFrame, left: DataFrame) -> DataFrame:
        """Groups and blocks of the pairs (a_no, no), blocks moved once."""
        sent = left.join(which, "a_no")
        return candidates.drop("labels").repartition(parts, "no").join(sent.drop("dim").repartition(parts, "no"), "no")

    # which groups go to which blocks: numbers only, dealt by block
    salt = F.pmod(F.xxhash64("no"), F.lit(parts)).cast("int")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    of_block = candidates.select("no", "dim", salt.alias("s"), F.explode("labels").alias("l"))
    of_group = g.select("a_no", "dim", F.explode("labels").alias("l")).withColumn("s", every_salt)
    same = of_block.join(of_group, ["dim", "l", "s"]).select("a_no", "no").distinct()
    order = Window.partitionBy("a_rid").orderBy(F.desc("positive_score"), "positive_id", "p_rid")
    best = meet(same, g.drop("labels")).mapInArrow(_positives(positives), "a_rid long, anchor_id long, p_rid long, positive_id long, positive_score long")
    chosen = stored(best.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= positives).drop("r"), "positives")
    # every pair but those where block and group are of one and the same label
    only = lambda of: F.when(F.size(of) == 1, F.col(of)[0])
    meta = candidates.select("no", "dim", salt.alias("s"), only("labels").alias("only"))
    other = (meta.join(g.select("a_no", "dim", only("labels").alias("a_only")).withColumn("s", every_salt), ["dim", "s"])
             .filter(F.col("only").isNull() | F.col("a_only").isNull() | (F.col("only") != F.col("a_only"))).select("a_no", "no"))
    member = g.select("a_no", F.explode("a_rids").alias("a_rid"))
    of_groups = (member.join(chosen, "a_rid").groupBy("a_no")
                 .agg(F.collect_list(F.struct("a_rid", "p_rid", "positive_id", "positive_score")).alias("positives")))
    found = meet(other, g.drop("labels").join(of_groups, "a_no")).mapInArrow(
        _negatives(negatives, lower, upper), "a_rid long, anchor_id long, p_rid long, positive_id long, positive_score long, "
                                             "n_rid long, negative_id long, negative_score long")
    order = Window.partitionBy("a_rid", "p_rid").orderBy(F.desc("negative_score"), "negative_id", "n_rid")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op12_shared_lists(spark, sf_dir: str) -> DataFrame:
    """Query: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score over ``embeddings``."""
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


OP12_SQL = f"""
WITH {INTEGER_VECTORS},
r AS (SELECT vec_id, rid, dim, c, CASE WHEN vec_id % {SHIFTED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label FROM rows_ WHERE label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, a.rid AS a_rid, a.label = b.label AS same, b.vec_id, b.rid, coalesce(list_dot_product(a.c, b.c), 0)::BIGINT AS score
  FROM r a JOIN r b ON a.dim = b.dim AND a.rid <> b.rid WHERE a.vec_id % {EVERY} = 0),
positive AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a_rid ORDER BY score DESC, vec_id, rid) AS n FROM scored WHERE same) s WHERE n <= {POSITIVES}),
negative AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a_rid, p.rid ORDER BY s.score DESC, s.vec_id, s.rid) AS rank
  FROM positive p JOIN scored s ON s.a_rid = p.a_rid AND NOT s.same
  WHERE {LOWER} * p.score <= 100 * s.score AND 100 * s.score <= {UPPER} * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= {NEGATIVES}
"""
