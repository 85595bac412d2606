"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

*Marked words.*  A text is given its leading space and cut before every run of
spaces; a piece with a space has it at its front, so no piece spans a cut and
each marked word is encoded by itself.  Characters that no longer piece holds
stand alone and part a word further.

*Shared prefixes.*  The distinct marked words of a batch are sorted, which
lays them out as a trie read depth first: a word shares its first nodes with
the word before it.  A stack keeps the forward state of every node on the
current path, so only the nodes below the common prefix are computed.

*Forward scores.*  A node holds the best total score of its prefix and the ids of
the path that has it, found from the nodes before it by the scores of the pieces
that end there.  A unigram model's scores are those of its file.  A BPE model's
file has the order of its merges in their place; merges are learnt by falling
frequency, so a piece's score is the logarithm of the frequency that Zipf's law
gives its rank (less a constant), -ln(rank).  The path and its score are
``best_ids`` and ``best_score``.

*Merges.*  A BPE model's own ids, those of the library, are not the best sum of
any scores and are returned beside that path: here a node holds the last piece of
its prefix's encoding.  By the order of merges, the encoding of a prefix that ends
at a piece boundary is the beginning of the whole encoding, and pieces follow one
another exactly if merging the two of them alone leaves both; so a prefix's last
piece is the one that may follow the last piece before it.  A unigram model's ids
are its best path.  A character without a piece is spelled in byte pieces, or is
the unknown piece if the model has none.

*Decoding.*  The ids of every text are decoded, and ``exact`` says whether that
gives the text.

*Scale.*  A projection: texts are encoded where they lie.  A batch holds the
nodes of one path, its distinct words, and at most ``MEMO`` words of the task's
earlier batches.  The model file is read once on the driver and travels with the task.

Defined cases: null encodes to null, an empty text to no ids; ids decode to the
text exactly, but for U+2581, which the format does not tell from a space (it
decodes as one); ids that are control or out of range decode to nothing;
repeated rows encode alike.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import read_table

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MEMO = 1 << 19
#: Pairs of pieces whose merging is remembered; most words need few.
PAIRS = 1 << 19
#: Nodes down to this depth hold all ids of their prefix.
DEEP = 64
#: Characters of text whose words are sorted together.
PORTION = 1 << 22


@dataclass
class Vocabulary:
    """What a model file says: pieces, scores and kinds."""
    pieces: list[str]
    scores: list[float]
    kinds: list[str]        # normal, byte, control, unknown
    unigram: bool

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models are supported")
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only models that keep their text and add a leading space are supported")
        names = {2: "unknown", 3: "control", 6: "byte"}
        return cls([p.piece for p in model.pieces], [p.score for p in model.pieces],
                   [names.get(p.type, "normal") for p in model.pieces], model.trainer_spec.model_type == 1)

    def with_scores(self) -> Vocabulary:
        """A unigram model of the same pieces (see "Forward scores")."""
        if self.unigram:
            return self
        normal = sorted((i for i, k in enumerate(self.kinds) if k == "normal"), key=lambda i: (-self.scores[i], i))
        rank = {i: n for n, i in enumerate(normal, 1)}
        return replace(self, scores=[-math.log(rank[i]) if i in rank else 0.0 for i in range(len(self.pieces))], unigram=True)


class Node(NamedTuple):
    """The beginning of a piece that a prefix ends with."""
    text: str
    following: dict[str, Node]
    #: (piece, length, ids, known predecessors, score), longest first
    pieces: tuple


class Units(NamedTuple):
    """Texts as codes of their distinct units, and where each text's codes end."""
    words: list[str]
    codes: np.ndarray
    ends: np.ndarray


class Encoded(NamedTuple):
    """The ids of texts behind one another, and where each text's end."""
    ids: np.ndarray
    ends: np.ndarray


def _spread(spelled: tuple[bytes, ...], units: Units) -> Encoded:
    """The ids of texts from those of their distinct units."""
    sizes = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
    starts, n = np.cumsum(sizes) - sizes, sizes[units.codes]
    upto = np.concatenate(([0], np.cumsum(n)))
    place = np.repeat(starts[units.codes] - upto[:-1], n) + np.arange(upto[-1])
    return Encoded(np.frombuffer(b"".join(spelled), np.int32)[place], upto[units.ends])


@dataclass
class Codec:
    vocabulary: Vocabulary
    #: Is the best path by forward scores found beside a BPE model's merges?
    best: bool = False
    memo: dict[str, tuple[bytes, bytes]] = field(default_factory=dict)
    older: dict[str, tuple[bytes, bytes]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        self.id_of = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == "normal"}
        self.spelled = {p: np.int32(i).tobytes() for p, i in self.id_of.items()}
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == "byte"}
        self.unknown = v.kinds.index("unknown")
        self.longest = max(map(len, self.id_of))
        joins = "".join(map(re.escape, sorted({c for p in self.id_of if len(p) > 1 for c in p if c != MARK})))
        # a run of marks with what follows, a run of joining characters, or a character that stands alone
        self.cutter = re.compile(f"{MARK}+[{joins}]*|[{joins}]+|(?s:.)")
        self.follows: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.beginnings = {p[:k] for p in self.id_of for k in range(1, len(p) + 1)}
        self.root, self.nodes = Node("", {}, ()), {}
        self.scores = v.with_scores().scores
        self.unknown_score = min(self.scores) - 10.0
        self.piece_bytes = [bytes([int(p[3:5], 16)]) if k == "byte" else p.encode() if k == "normal"
                            else " ⁇ ".encode() if k == "unknown" else b"" for p, k in zip(v.pieces, v.kinds)]
        self.spelling = pa.array(self.piece_bytes, pa.large_binary())
        # a character without a piece counts once, with the first of its bytes
        self.id_score = np.array([s if k == "normal" else self.unknown_score if k == "unknown" or k == "byte" and int(p[3:5], 16) & 0xC0 != 0x80
                                  else 0.0 for p, k, s in zip(v.pieces, v.kinds, self.scores)])

    # -- the forward pass over one path of the trie --

    def _spell(self, char: str) -> bytes:
        """Ids of a character without a piece."""
        ids = [self.byte_id[b] for b in char.encode("utf-8", "surrogatepass")] if self.byte_id else [self.unknown]
        return np.array(ids, dtype=np.int32).tobytes()

    def merged(self, word: str) -> list[str]:
        """Pieces of a short string by the merges themselves: the best-scored,
        leftmost adjacent pair first."""
        parts, score, id_of = list(word), self.vocabulary.scores, self.id_of
        while True:
            best = None
            for k in range(len(parts) - 1):
                i = id_of.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or score[i] > best[0]):
                    best = (score[i], k)
            if best is None:
                return parts
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def _pairs_of(self, piece: str) -> dict[str, bool]:
        """Which last pieces ``piece`` may follow, as far as they are known."""
        if piece not in self.follows:
            self.follows[piece] = {}
        return self.follows[piece]

    def _may_follow(self, left: str, piece: str) -> bool:
        self.pairs += 1
        if self.pairs > PAIRS:
            self.pairs = 0
            for known in self.follows.values():
                known.clear()
        found = self.merged(left + piece) == ([left, piece] if left else [piece])
        self.follows[piece][left] = found
        return found

    def _step(self, node: Node, char: str) -> Node:
        """The node for the longest end of ``node``'s string and ``char`` that
        begins a piece, with the pieces that end there, longest first."""
        text = node.text + char
        while len(text) > 1 and text not in self.beginnings:
            text = text[1:]
        if text not in self.nodes:
            ends = [text[k:] for k in range(len(text)) if text[k:] in self.id_of or k == len(text) - 1]
            self.nodes[text] = Node(text, {}, tuple(
                (p, len(p), self.spelled.get(p) or self._spell(p), self._pairs_of(p),
                 self.scores[self.id_of[p]] if p in self.id_of else self.unknown_score) for p in ends))
        node.following[char] = self.nodes[text]
        return self.nodes[text]

    def encode_sorted(self, words: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """(ids by merges, ids of the best path) of ascending, distinct words,
        depth first; one is empty where it is not asked for.  The stacks hold,
        for every prefix on the path, its node among the pieces' beginnings, its
        last piece, its ids so far (see ``DEEP``), and likewise for the best
        path, with its total score."""
        merging = not self.vocabulary.unigram
        scoring = self.best or not merging
        nodes, last, ids, size_of, path, total, before = [self.root], [""], [b""], [0], [b""], [0.0], ""
        for word in words:
            shared = 0
            for x, y in zip(word, before):
                if x != y:
                    break
                shared += 1
            for stack in (nodes, last, ids, size_of, path, total):
                del stack[shared + 1:]
            node, end = nodes[-1], shared
            for char in word[shared:]:
                node = node.following.get(char) or self._step(node, char)
                end += 1
                nodes.append(node)
                if scoring:
                    best = -math.inf
                    for _, n, spelled, _, score in node.pieces:
                        score += total[end - n]
                        if score >= best:      # of equals the shorter one
                            best, size, code = score, n, spelled
                    total.append(best)
                    size_of.append(size)
                    path.append(path[end - size] + code if end <= DEEP else code)
                if merging:
                    for piece, size, code, known, _ in node.pieces:
                        left = last[end - size]
                        follows = known.get(left)
                        if follows is None:
                            follows = self._may_follow(left, piece)
                        if follows:
                            break
                    last.append(piece)
                    ids.append(ids[end - size] + code if end <= DEEP else code)
            before = word
            if end <= DEEP:
                yield ids[-1] if merging else b"", path[-1] if scoring else b""
            else:
                yield (self._unwound(ids, end, lambda at: len(last[at])) if merging else b"",
                       self._unwound(path, end, size_of.__getitem__) if scoring else b"")

    @staticmethod
    def _unwound(ids: list[bytes], end: int, size: Callable[[int], int]) -> bytes:
        """The ids of a deep node; those below ``DEEP`` hold their last piece only."""
        rest = []
        while end > DEEP:
            rest.append(ids[end])
            end -= size(end)
        return b"".join([ids[end], *reversed(rest)])

    # -- texts --

    def units(self, text: str) -> list[str]:
        """The marked words of a text, parted at characters that stand alone."""
        return self.cutter.findall((MARK + text).replace(" ", MARK)) if text else []

    def cut(self, texts: list[str | None]) -> Units:
        """The units of all texts, each distinct one once."""
        found = [self.units(t or "") for t in texts]
        coded = pa.array(list(chain.from_iterable(found)), pa.large_string()).dictionary_encode()
        return Units(coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.cumsum([0, *map(len, found)]))

    def ids_of(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids of distinct units, by merges and of the best path, as native
        32-bit integers."""
        missing = [w for w in words if w not in self.memo]
        if len(self.memo) + len(missing) > MEMO // 2:      # the younger half becomes the older one
            self.older, self.memo = self.memo, {}
            missing = words
        memo, older = self.memo, self.older
        memo.update((w, older[w]) for w in missing if w in older)
        new = sorted(w for w in missing if w not in older)
        memo.update(zip(new, self.encode_sorted(new)))
        return [memo[w] for w in words]

    def encode_units(self, units: Units) -> tuple[Encoded, Encoded | None]:
        """The model's ids of texts, and those of the best path if asked for."""
        by_merges, best = zip(*self.ids_of(units.words)) if units.words else ((), ())
        path = _spread(best, units) if self.best or self.vocabulary.unigram else None
        return (path if self.vocabulary.unigram else _spread(by_merges, units)), path

    def encode_all(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of each text as native 32-bit integers."""
        ids, ends = self.encode_units(self.cut(texts))[0]
        return [None if t is None else ids[a:b].tobytes() for t, a, b in zip(texts, ends, ends[1:])]

    def decode_all(self, encoded: Encoded) -> list[str]:
        """The texts that texts' ids decode to; an absent one to the empty text."""
        taken = self.spelling.take(pa.array(encoded.ids))
        if not len(taken):
            return [""] * (len(encoded.ends) - 1)
        _, offsets, data = taken.buffers()
        at, data = np.frombuffer(offsets, np.int64)[taken.offset:][encoded.ends].tolist(), memoryview(data or b"")
        return [str(data[a:b], "utf-8", "replace").replace(MARK, " ").removeprefix(" ") for a, b in zip(at, at[1:])]

    def scores_of(self, encoded: Encoded) -> np.ndarray:
        """The total scores of texts' ids."""
        starts, ends = encoded.ends[:-1], encoded.ends[1:]
        out, filled = np.zeros(len(starts)), ends > starts
        if filled.any():
            out[filled] = np.add.reduceat(self.id_score[encoded.ids], starts[filled])
        return out

    def decodes_to(self, text: str | None) -> bool:
        """Do the ids of a text decode to it?"""
        return text is None or self.decode_all(self.encode_units(self.cut([text]))[0]) == [text]

    def forget_words(self) -> None:
        """Give back the memory of a task's words; pairs of pieces stay."""
        self.memo, self.older = {}, {}

    def encode(self, text: str | None) -> list[int] | None:
        ids = self.encode_all([text])[0]
        return None if ids is None else np.frombuffer(ids, np.int32).tolist()

    def decode(self, ids: np.ndarray | None) -> str | None:
        if ids is None:
            return None
        known = ids[(ids >= 0) & (ids < len(self.piece_bytes))]
        data = b"".join(map(self.piece_bytes.__getitem__, known.tolist()))
        text = data.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


#: One codec a worker and model, so that pairs of pieces are kept from task to task.
_CODECS: dict[int, Codec] = {}


def _codec(vocabulary: Vocabulary, best: bool = False) -> Codec:
    key = hash((tuple(vocabulary.pieces), tuple(vocabulary.scores), vocabulary.unigram, best))
    if key not in _CODECS:
        _CODECS[key] = Codec(vocabulary, best)
    return _CODECS[key]


def _portions(texts: pa.Array) -> Iterator[list[str | None]]:
    held, size = [], 0
    for t in texts:
        held.append(t.as_py())
        size += len(held[-1] or "")
        if size > PORTION:
            yield held
            held, size = [], 0
    if held:
        yield held


def _id_lists(encoded: Encoded, absent: np.ndarray) -> pa.Array:
    offsets = pa.array(encoded.ends.astype(np.int32), mask=np.append(absent, False))
    return pa.ListArray.from_arrays(offsets, pa.array(encoded.ids))


def encode(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), model_path: str = MODEL_PATH,
           best: bool = False) -> DataFrame:
    """The ``keep`` columns, ids (array<int>) and ``exact``, whether the ids
    decode to the text, for every row; with ``best`` also ``best_ids`` and
    ``best_score``, the best path by forward scores."""
    vocabulary = Vocabulary.from_file(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, best)
        for b in batches:
            at = 0
            for texts in _portions(b.column(0)):
                units, absent = codec.cut(texts), np.array([t is None for t in texts])
                found, path = codec.encode_units(units)
                exact = [t is None or t == back for t, back in zip(texts, codec.decode_all(found))]
                kept = b.slice(at, len(texts)).columns[1:]
                columns = dict(zip(keep, kept)) | {"ids": _id_lists(found, absent), "exact": pa.array(exact)}
                if best:
                    columns |= {"best_ids": _id_lists(path, absent), "best_score": pa.array(codec.scores_of(path), mask=absent)}
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])
                at += len(texts)
        codec.forget_words()

    rows = docs.select(docs[text_col].alias("__text"), *[docs[c] for c in keep])
    ids = T.ArrayType(T.IntegerType())
    more = [T.StructField("best_ids", ids), T.StructField("best_score", T.DoubleType())] if best else []
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("ids", ids), T.StructField("exact", T.BooleanType()), *more])
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, ids_col: str = "ids", model_path: str = MODEL_PATH) -> DataFrame:
    """``encoded`` with a column ``text`` decoded from its ids in place of them."""
    vocabulary = Vocabulary.from_file(model_path)

    @F.pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        codec = _codec(vocabulary)
        return ids.map(lambda x: None if x is None else codec.decode(np.asarray(x, dtype=np.int64)))

    return encoded.withColumn("text", text_of(ids_col)).drop(ids_col)


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Query: doc_id, n_ids, exact and ids of every document, with the best path
    by forward scores and its score."""
    found = encode(read_table(spark, sf_dir, "documents"), best=True)
    return found.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), "exact", "ids", "best_ids", "best_score")
