"""Embedding near-duplicates by product quantisation.

*Index.*  Distinct vectors, scaled to length 1, are put into the inverted list
of their nearest coarse centre; the residual is cut into ``SUBSPACES`` parts,
each coded by the nearest of up to ``CODES`` entries of its codebook.  Centres
and codebooks are fitted by k-means on a bounded sample (``SAMPLE`` vectors in
hash order); every vector is indexed.

*Search.*  Every vector is also a query.  Cosine >= c means a distance of at
most r = sqrt(2 - 2c).  A list can only hold such a neighbour if the query lies
within r of the boundary between its own centre's cell and the list's, that is
(|q - x|^2 - |q - own|^2) / (2 |x - own|) <= r: those are the sufficient
probes, and no link is lost by leaving out the others.  In a list, a table of
the query's squared distances to every code entry of every subspace gives the
asymmetric distance to each member by look-ups; a member is a candidate if that
distance is at most r plus the member's own quantisation error, which again
loses nothing.  Candidates are reranked by the exact cosine in double
precision.

*Scale.*  Equal vectors are one row with a count.  Lists are per label, and are
cut into pieces of at most ``PIECE`` members and ``PIECE`` queries, so that a hot
list is many small groups.  Groups hand on, for each vector, the number of
linked vectors and one edge of a spanning forest, never all pairs.

Defined cases: a null label, a null or empty vector, a zero vector and one with
null or non-finite components link with nothing; components of any finite size
do; vectors of another length than the model's are compared exactly, among
themselves; rows that repeat a vec_id are one vertex: all of them, those that
link with nothing included, get the links and the component of any, and n_links
counts distinct other vec_ids; a null vec_id links with nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import read_table, stored

MIN_COSINE = 0.98
SAMPLE = 1 << 14
CELLS = 1 << 10
SUBSPACES = 8
CODES = 64
PIECE = 2048
ROUNDS = 8
#: Distances are compared with this slack, far above their rounding.
SLACK = 1e-6


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from k of the points."""
    k = min(k, len(x))
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(1)[:, None] - 2.0 * x @ y.T + (y ** 2).sum(1)[None, :], 0.0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_squared(x[i:i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)] or [np.zeros(0, int)])


@dataclass
class Quantiser:
    centres: np.ndarray                 # cells x dimension
    codebooks: list[np.ndarray]         # per subspace: codes x its dimensions
    cuts: list[int]                     # where subspaces begin and end

    @classmethod
    def fit(cls, x: np.ndarray, cells: int, seed: int = 1) -> Quantiser:
        centres = _kmeans(x, cells, seed)
        residual = x - centres[_nearest(x, centres)]
        cuts = [round(i * x.shape[1] / SUBSPACES) for i in range(SUBSPACES + 1)]
        return cls(centres, [_kmeans(residual[:, a:b], CODES, seed + i + 1) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))], cuts)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and quantisation error of each vector."""
        cell = _nearest(x, self.centres)
        residual = x - self.centres[cell]
        codes = np.stack([_nearest(residual[:, a:b], book) for book, a, b in zip(self.codebooks, self.cuts, self.cuts[1:])], axis=1)
        rebuilt = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.codebooks)], axis=1)
        return cell, codes.astype(np.uint8), np.sqrt(((residual - rebuilt) ** 2).sum(1))

    def probes(self, x: np.ndarray, cell: np.ndarray, radius: float) -> list[np.ndarray]:
        """The lists that can hold a vector within ``radius`` of each query."""
        d = _squared(x, self.centres)
        apart = 2.0 * np.sqrt(_squared(self.centres[cell], self.centres))
        reach = d - d[np.arange(len(x)), cell][:, None] <= radius * apart + SLACK
        reach[np.arange(len(x)), cell] = True
        return [np.flatnonzero(row) for row in reach]

    def distances(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances by table look-up, queries x members of a list."""
        residual, total = queries - self.centres[cell], np.zeros((len(queries), len(codes)))
        for i, (book, a, b) in enumerate(zip(self.codebooks, self.cuts, self.cuts[1:])):
            total += _squared(residual[:, a:b], book)[:, codes[:, i]]
        return np.sqrt(total)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1:
    exact, and no square over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x ** 2).sum(1))[:, None]


def _links(q: pd.DataFrame, m: pd.DataFrame, cell: int, model: Quantiser | None, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, member) linked, the query itself left out."""
    x, y = _scaled(_matrix(q["q_v"])), _scaled(_matrix(m["v"]))
    xu = _unit(x)
    out = []
    for s in range(0, len(x), 512):
        if model is None or cell < 0:
            near = np.ones((len(xu[s:s + 512]), len(y)), dtype=bool)
        else:
            codes = np.frombuffer(b"".join(m["codes"]), np.uint8).reshape(len(m), -1)
            reach = np.sqrt(2 - 2 * min_cosine) + m["error"].to_numpy()[None, :] + SLACK
            near = model.distances(xu[s:s + 512], cell, codes) <= reach
        near &= q["q_rep"].to_numpy()[s:s + 512, None] != m["rep"].to_numpy()[None, :]
        i, j = np.nonzero(near)
        a, b = x[s + i], y[j]
        cosine = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
        hit = cosine >= min_cosine
        out.append((s + i[hit], j[hit]))
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def _roots(i: np.ndarray, j: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Per vertex the smallest name it reaches over the edges (i, j)."""
    low = names.copy()
    while True:
        edge = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, edge)
        np.minimum.at(new, j, edge)
        if (new == low).all():
            return low
        low = new


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    min_cosine: float = MIN_COSINE, sample: int = SAMPLE, piece: int = PIECE) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links (other vectors, by vec_id,
    linked directly), component_id, kept."""
    spark = table.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col("v")
    rows = table.select(table[id_col].cast("long").alias("vec_id"), table[label_col].cast("string").alias("label"),
                        table[vector_col].cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    # equal vectors of a label: one representative, named by its smallest vec_id
    good = rows.filter("sound")
    alike = good.select("label", "v", "vec_id").distinct()
    reps = stored(alike.groupBy("label", "v").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
                  .withColumn("rep", F.monotonically_increasing_id()), "vectors")
    n = reps.count()
    # ids of several different vectors, and the vectors that have such ids
    several = stored(alike.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1").select("vec_id"), "repeated-ids")
    shared = stored(alike.join(several, "vec_id").join(reps, ["label", "v"]).select("vec_id", "rep"), "shared-ids")
    reps = reps.join(shared.select("rep").distinct().withColumn("many", F.lit(True)), "rep", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    reps = reps.select("label", "v", "low", "copies", "many", "rep")

    dims = reps.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    model, dim = None, -1
    if dims is not None:
        dim = dims["dim"]
        chosen = (reps.filter(F.size("v") == dim).select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(sample).select("v").toArrow())
        model = Quantiser.fit(_unit(np.array(chosen["v"].to_pylist())), max(1, min(CELLS, int(np.sqrt(n)))))
    radius = float(np.sqrt(2 - 2 * min_cosine)) + SLACK

    def place(frames):
        for f in frames:
            # vectors the model doesn't know: a list for each length
            sizes = f["v"].map(len).to_numpy()
            cell, error = -sizes, np.zeros(len(f))
            codes, probes = [b""] * len(f), [[-int(k)] for k in sizes]
            known = np.flatnonzero(sizes == dim)
            if len(known):
                x = _unit(_matrix(f["v"].iloc[known]))
                cell[known], coded, error[known] = model.encode(x)
                for k, c, p in zip(known, coded, model.probes(x, cell[known], radius)):
                    codes[k], probes[k] = c.tobytes(), p.tolist()
            yield f.assign(cell=cell, codes=pd.Series(codes, index=f.index, dtype=object), error=error,
                           probes=pd.Series(probes, index=f.index, dtype=object))

    placed = reps.mapInPandas(place, "label string, v array<double>, low long, copies long, many boolean, rep long, "
                                     "cell int, codes binary, error double, probes array<int>")
    placed = stored(placed, "inverted-lists")
    # pieces of each list, by its members and by its queries
    members = placed.groupBy("label", "cell").agg(F.count("*").alias("m"))
    queries = placed.select("label", F.explode("probes").alias("cell")).groupBy("label", "cell").agg(F.count("*").alias("q"))
    cut = members.join(queries, ["label", "cell"]).select(
        "label", "cell", F.ceil(F.col("m") / piece).cast("int").alias("mp"), F.ceil(F.col("q") / piece).cast("int").alias("qp"))
    cut = stored(cut, "list-pieces")
    part = lambda of, salt: F.pmod(F.xxhash64(F.lit(salt), "rep"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    home = (placed.join(cut, ["label", "cell"]).withColumn("mi", part("mp", 1))
            .select("label", "cell", "mi", every("qp").alias("qi"), "rep", "copies", "many", "v", "codes", "error"))
    asks = (placed.drop("cell").withColumn("cell", F.explode("probes")).join(cut, ["label", "cell"]).withColumn("qi", part("qp", 2))
            .select("label", "cell", every("mp").alias("mi"), "qi", "rep", "many", "v"))
    asks = asks.toDF("q_label", "q_cell", "q_mi", "q_qi", "q_rep", "q_many", "q_v")
    key, q_key = ["label", "cell", "mi", "qi"], ["q_label", "q_cell", "q_mi", "q_qi"]

    def compare(k, m: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("rep", "links", "root", "other")})
        if not len(m) or not len(q):
            return empty
        i, j = _links(q, m, int(k[1]), model, min_cosine)
        if not len(i):
            return empty
        names = np.concatenate([q["q_rep"].to_numpy(), m["rep"].to_numpy()])
        # pairs with a vector of shared ids are told one by one, others counted
        told = q["q_many"].to_numpy()[i] | m["many"].to_numpy()[j]
        links = np.bincount(i[~told], weights=m["copies"].to_numpy()[j[~told]], minlength=len(names)).astype(np.int64)
        root = _roots(i, len(q) + j, names)
        touched = np.unique(np.concatenate([i, len(q) + j]))
        nobody = np.full(len(touched), -1)
        return pd.concat([pd.DataFrame({"rep": names[touched], "links": links[touched], "root": root[touched], "other": nobody}),
                          pd.DataFrame({"rep": names[i[told]], "links": 0, "root": names[i[told]], "other": names[len(q) + j[told]]})])

    found = (home.repartition(parts, *key).groupBy(*key).cogroup(asks.repartition(parts, *q_key).groupBy(*q_key))
             .applyInPandas(compare, "rep long, links long, root long, other long"))
    found = stored(found, "vector-links")
    ids = stored(alike.join(reps.select("label", "v", "rep"), ["label", "v"]).select("vec_id", "rep"), "vector-ids")
    # an id of several vectors is one vertex: its vectors hang on the first of them
    ties = shared.join(shared.groupBy("vec_id").agg(F.min("rep").alias("first")), "vec_id").select(F.col("rep").alias("a"), F.col("first").alias("b"))
    comps = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(ties))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = stored(reps.select("low", "copies", "many", "rep")
                   .join(comps.withColumnRenamed("id", "rep"), "rep", "left").join(links, "rep", "left")
                   .select("rep", "low", "many", F.coalesce("component", "rep").alias("component"),
                           (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-components")
    least = named.groupBy(F.col("component").alias("of")).agg(F.min("low").alias("component_id"))
    # a second key, which the grouping doesn't have: a component or an id of
    # very many rows is dealt for the join itself, and can be split
    named = named.join(least, (F.col("component") == F.col("of")) & (F.xxhash64("component") == F.xxhash64("of")))
    of_id = ids.join(named.select("rep", "many", "n_links", "component_id"), "rep")
    if not shared.isEmpty():
        of_id = _distinct_links(of_id, ids, found.filter("other >= 0"))
    per_id = of_id.select(F.col("vec_id").alias("id_"), "n_links", "component_id").dropDuplicates(["id_"])
    out = rows.join(per_id, (F.col("vec_id") == F.col("id_")) & (F.xxhash64("vec_id") == F.xxhash64("id_")), "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id"),
                      (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"))


def _distinct_links(of_id: DataFrame, ids: DataFrame, told: DataFrame) -> DataFrame:
    """``of_id`` with the links that were told one by one: distinct other ids,
    over all vectors of an id that is on such a vector."""
    pairs = told.select("rep", "other").distinct()
    reached = pairs.join(ids.select(F.col("rep").alias("other"), F.col("vec_id").alias("near")), "other")
    # a vector of single ids: what it counted and the distinct ids of its told links
    plain = of_id.filter(~F.col("many"))
    more = reached.join(plain.select("rep").distinct(), "rep").groupBy("rep").agg(F.count_distinct("near").alias("more"))
    plain = plain.join(more, "rep", "left").withColumn("n_links", F.col("n_links") + F.coalesce("more", F.lit(0))).drop("more")
    # a vector with a shared id told all its links, and its own ids are linked too
    many = of_id.filter("many")
    own = ids.select("rep", F.col("vec_id").alias("near"))
    near = (many.select("vec_id", "rep").join(reached.select("rep", "near").unionByName(own), "rep")
            .filter("near != vec_id").groupBy("vec_id").agg(F.count_distinct("near").alias("n_links")))
    many = many.drop("n_links", "rep").distinct().join(near, "vec_id", "left").withColumn("rep", F.lit(-1).cast("long"))
    return plain.unionByName(many.withColumn("n_links", F.coalesce("n_links", F.lit(0))).select(plain.columns))


def op2_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: vec_id, n_links, component_id, kept for every row of ``embeddings``."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


OP2_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
  SELECT * FROM v
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
    AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {MIN_COSINE}),
reach(id, near) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.near),
component AS (SELECT id, min(near) AS component_id FROM reach GROUP BY id),
number AS (SELECT a AS id, count(DISTINCT b) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN component c ON c.id = v.vec_id LEFT JOIN number m ON m.id = v.vec_id
"""
