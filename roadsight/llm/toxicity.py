"""Toxicity: maximum-scoring segments over token log-odds.

*Model.*  A token is a lower-cased word; its features are the word itself and
its beginnings of 4 to 6 bytes (stems, for languages that build words from
them), hashed into ``BUCKETS`` buckets.  A
feature's weight is its log-odds ratio between toxic and clean labelled texts
under an informative Dirichlet prior in proportion to the feature's share of
all the texts, less ``CAUTION`` standard errors, so that rare features don't
speak, and less ``MARGIN``, so that the wording of an ordinary text drifts
downwards even where toxic texts favour its language or subject; a token scores
as its strongest feature does, within ``SCORE_RANGE``.  A feature counts once a
text, and a text once however many copies of it are labelled.

*Passages.*  A linear scan finds all maximal-scoring segments of the scores.
In clean texts the number of segments scoring s or more in n tokens is about
K n exp(-lambda s); lambda and K are fitted on clean texts.  A text's segments
are aggregated by the sum statistic of that extreme-value law over its r best
segments, at the most significant r, and its minus log p-value is turned into
a probability by a logistic curve.

*Training.*  The model is fitted on a bounded sample of labelled rows:
``max_rows`` (30,000) of those whose crc32 of the id leaves 0 or 2 modulo 3, in hash
order.  Weights for calibrating on one of the two folds come from the other,
the final weights from both.  Nothing but the text enters a score.  The counts,
two per bucket and fold, are all that reaches the driver.

*Scale.*  The sample's ids are broadcast (``max_rows`` pairs at most), the
texts are read where they lie: no text is shuffled.  The weights are a fixed
table of ``BUCKETS`` floats.

Defined cases: a null or empty text has no segments and gets the score of no
evidence; labels that are null are ignored, repeated labels of a document count
as toxic if any is; without labels of both kinds every score is the share of
toxic labels (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import read_table
from .text import RollingHash, as_bytes, joined_words

BUCKETS = 1 << 20
STEMS = (4, 5, 6)
PRIOR_SHARE = 0.1         # weight of the prior, as a share of each side's tokens
CAUTION = 1.5
MARGIN = 1.0
SCORE_RANGE = (-1.0, 6.0)
MAX_ROWS = 30_000
THRESHOLD = 0.7


def held_out(id_col: Column) -> Column:
    """Rows that never train: crc32 of the decimal id leaves 1 modulo 3."""
    return F.coalesce(_fold(id_col) == 1, F.lit(False))


def _fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("long").cast("string").cast("binary")) % 3


class Features:
    """Hashed features of a text: a row for each word, holding the word itself
    and its beginnings of ``STEMS`` bytes; a word shorter than a stem repeats
    itself there."""

    def __init__(self, data: bytes) -> None:
        joined, starts, ends = joined_words(data.lower())
        rolling, mask = RollingHash(joined), np.uint64(BUCKETS - 1)
        whole = rolling.of(starts, ends)
        rows = [whole ^ np.uint64(1)]       # a word and an equal stem are different features
        for size in STEMS:
            stem = rolling.of(starts, np.minimum(starts + size, ends))
            rows.append(np.where(ends - starts >= size, stem, rows[0]))
        self.ids = (np.stack(rows) & mask).astype(np.int64)
        self.words = len(starts)


def token_scores(f: Features, weights: np.ndarray) -> np.ndarray:
    return np.clip(weights[f.ids].max(axis=0), *SCORE_RANGE).astype(np.float64)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal-scoring segments, by one pass over
    the positive runs: a run joins the latest stretch that starts lower and
    whose total it raises, else stands by itself."""
    positive = scores > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], positive, [False])).astype(np.int8)))
    total = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[tuple[int, int, float, float]] = []      # start, end, total before, total at its end
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        new = (a, b, float(total[a]), float(total[b]))
        while stack:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j -= 1
            if j < 0 or stack[j][3] >= new[3]:
                break
            new = (stack[j][0], new[1], stack[j][2], new[3])
            del stack[j:]
        stack.append(new)
    return [(a, b, r - l) for a, b, l, r in stack]


@dataclass
class Model:
    weights: np.ndarray
    decay: float = 1.0          # lambda
    density: float = 1.0        # K
    slope: float = 0.0
    offset: float = 0.0

    def segments(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        f = Features(as_bytes(text))
        return maximal_segments(token_scores(f, self.weights)), f.words

    def evidence(self, segment_scores: list[float], n: int) -> float:
        """Minus the log p-value of the most significant number of segments."""
        best, total = 0.0, 0.0
        for r, s in enumerate(sorted(segment_scores, reverse=True), 1):
            total += self.decay * s - np.log(self.density * max(n, 1))
            if total <= r:
                break
            best = max(best, total - (r - 1) * np.log(total) + lgamma(r + 1) + lgamma(r))
        return best

    def score(self, text: str | None) -> float:
        segments, n = self.segments(text)
        return self.probability(self.evidence([s for *_, s in segments], n))

    def probability(self, evidence: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * evidence + self.offset, -500, 500))))


def _log_odds(clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    nt, nc = toxic.sum(), clean.sum()
    share = (clean + toxic) / max(nt + nc, 1)
    at, ac = PRIOR_SHARE * nt, PRIOR_SHARE * nc
    yt, yc = toxic + at * share, clean + ac * share
    seen = (clean + toxic) > 0
    out = np.full(len(clean), SCORE_RANGE[0], dtype=np.float32)
    yt, yc = yt[seen], yc[seen]
    delta = np.log(yt / (nt + at - yt)) - np.log(yc / (nc + ac - yc))
    out[seen] = delta - CAUTION * np.sqrt(1 / yt + 1 / yc) - MARGIN
    return out


def _counts(texts: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Feature counts by (fold, toxic) over rows (text, toxic, fold), as the
    sums of one table of at most BUCKETS rows a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, BUCKETS), dtype=np.int64)
        for b in batches:
            for text, toxic, fold in zip(*b.columns):
                f = Features(as_bytes(text.as_py()))
                row = sums[2 * (fold.as_py() == 2) + toxic.as_py()]
                row[np.unique(f.ids)] += 1
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(s[at]) for s in sums]], ["bucket", "n0", "n1", "n2", "n3"])

    sums = (texts.mapInArrow(run, "bucket long, n0 long, n1 long, n2 long, n3 long")
            .groupBy("bucket").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(4)]).toArrow())
    out = {}
    for i in range(4):
        dense = np.zeros(BUCKETS)
        dense[sums["bucket"].to_numpy()] = sums[f"n{i}"].to_numpy()
        out[(0, 2)[i // 2], i % 2] = dense
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a light ridge."""
    a, b = 0.0, 0.0
    X = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        g = X.T @ (p - y) + 1e-3 * np.array([a, b])
        h = (X * (p * (1 - p))[:, None]).T @ X + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(a, 0.0), b


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit the model; ``docs`` (doc_id, text), ``labels`` (doc_id, toxic)."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter(F.col("label_id").isNotNull() & F.col("toxic").isin(0, 1) & (_fold(F.col("label_id")) != 1))
              .groupBy("label_id").agg(F.max("toxic").alias("toxic")))
    sample = marked.orderBy(F.xxhash64("label_id"), "label_id").limit(max_rows)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
             .select("text", "toxic", _fold(F.col("label_id")).cast("int").alias("fold"), F.xxhash64("text").alias("h"), "label_id"))
    first = texts.groupBy("h").agg(F.min("label_id").alias("label_id")).select("label_id")   # max_rows at most
    texts = texts.join(F.broadcast(first), "label_id").select("text", "toxic", "fold")
    n = _counts(texts)
    sizes = {kind: sum(n[fold, kind].sum() for fold in (0, 2)) for kind in (0, 1)}
    if not sizes[0] or not sizes[1]:
        # nothing to tell apart: the share of toxic rows, never quite 0 or 1 if there are any
        seen = texts.agg(F.avg("toxic")).first()[0]
        share = 0.0 if seen is None else float(seen)
        return Model(np.full(BUCKETS, SCORE_RANGE[0], np.float32), offset=float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    other = {fold: _log_odds(n[2 - fold, 0], n[2 - fold, 1]) for fold in (0, 2)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = {fold: Model(w) for fold, w in other.items()}
        for b in batches:
            rows = []
            for text, toxic, fold in zip(*b.columns):
                segments, size = models[fold.as_py()].segments(text.as_py())
                rows.append((toxic.as_py(), size, [s for *_, s in segments]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows) if rows else ([], [], []), (pa.int32(), pa.int64(), pa.list_(pa.float64())))], ["toxic", "n", "scores"])

    seen = texts.mapInArrow(run, "toxic int, n long, scores array<double>").toArrow()
    toxic = seen["toxic"].to_numpy()
    rows = list(zip(toxic.tolist(), seen["n"].to_pylist(), seen["scores"].to_pylist()))
    clean_scores = [s for t, _, x in rows if not t for s in x]
    tokens = sum(n for t, n, _ in rows if not t)
    # Poisson clumping: segments of clean texts have exponential excesses; a pseudo-segment keeps both finite
    model = Model(_log_odds(n[0, 0] + n[2, 0], n[0, 1] + n[2, 1]),
                  decay=(len(clean_scores) + 1) / (sum(clean_scores) + 1), density=(len(clean_scores) + 1) / (tokens + 1))
    x = np.array([model.evidence(s, size) for _, size, s in rows])
    model.slope, model.offset = _logistic(x, toxic.astype(float))
    return model


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted and the passages (token start, end, score) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    schema = "doc_id long, score double, predicted int, passages array<struct<start:int,end:int,score:double>>"
    passage = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, spans = [], []
            for text in b.column(1):
                segments, n = model.segments(text.as_py())
                scores.append(model.probability(model.evidence([s for *_, s in segments], n)))
                edge = np.log(model.density * max(n, 1)) / model.decay      # one such segment expected
                spans.append([{"start": s, "end": e, "score": v} for s, e, v in segments if v > edge])
            got = np.array(scores)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got), pa.array((got >= threshold).astype(np.int32)),
                                              pa.array(spans, pa.list_(passage))], ["doc_id", "score", "predicted", "passages"])

    return rows.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` less the rows whose text scores ``threshold`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col))
            yield b.filter(pa.array([model.score(t.as_py()) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Query: doc_id, held_out, score, predicted for every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score_documents(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
                         F.size("passages").alias("n_passages"))
