"""SentencePiece encoding and decoding by a weighted finite-state transducer
(operator 6).

A model file is compiled to three machines over characters: the normaliser
(prefix blank, blanks to their mark), the pieces (every piece reads its
characters and writes its id; a character without a piece writes its bytes'
ids, or the unknown id), and, for models of merges, an acceptor over
neighbouring pieces.  The composition with an input is walked position by
position, and the path of least weight (tropical semiring: weights add along a
path, the minimum is taken over paths) gives the ids.

Models of scores (unigram) weigh a piece by its negative log-probability.  For
models of merges (BPE) the acceptor gives a pair of neighbours weight 0 if
merging their joint characters by the model's rules yields just these two
pieces, else infinity.  A sequence whose every neighbouring pair passes is the
merge result of the whole text: merges never cross a place that no merge
crosses between its two pieces alone.  So exactly one path is finite.

No piece holds a blank mark behind another character (checked when compiling;
else the text is one input), so texts are composed word by word, and words met
before are looked up.  Documents aren't shuffled; a task holds one model and a
bounded table of words.

Defined results: null texts have null ids, empty ones no ids; texts are
decoded back exactly but for a literal U+2581, which decodes to a blank;
repeated rows are encoded alike; an empty table gives an empty result; other
columns pass through, of a clashing name the result's stays.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relevo.llm.common import map_columns, table

NAME = "op6_sentencepiece"
ORACLE_SQL = None
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Words, and pairs of pieces, that a task remembers.
KNOWN_WORDS, KNOWN_PAIRS = 400_000, 1_000_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2
_OUTSIDE = object()


class Transducer:
    """A compiled model.  ``pieces``: (text, score, type) in the order of ids."""

    def __init__(self, pieces: list, merges: bool, byte_fallback: bool, prefix: bool, unknown: int = 0):
        self.ids, self.score, self.byte_ids = {}, {}, {}
        self.surface: list[bytes] = []
        for i, (text, score, kind) in enumerate(pieces):
            if kind in (_NORMAL, _USER, _UNUSED):
                self.ids[text], self.score[text] = i, score
                self.surface.append(text.replace(BLANK, " ").encode())
            elif kind == _BYTE:
                value = int(text[3:-1], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            else:
                self.surface.append(b"" if kind == _CONTROL else " ⁇ ".encode())
        self.merges, self.byte_fallback, self.prefix, self.unknown = merges, byte_fallback, prefix, unknown
        self.own = {p: p for p in self.ids}
        self.longest = max(map(len, self.ids), default=1)
        #: Weight of every piece, and None for the other beginnings of pieces.
        self.arcs = {p[:n]: None for p in self.ids for n in range(1, len(p) + 1)} | {p: -s for p, s in self.score.items()}
        self.penalty = 10.0 - min(self.score.values(), default=0.0)  # of an unknown character
        split = all(BLANK not in p.lstrip(BLANK) for p in self.ids)
        lone = not any("\n" in p for p in self.ids)
        self.word = re.compile((r"\n+|" if lone else "") + (rf"{BLANK}+[^{BLANK}{chr(10) if lone else ''}]*|[^{BLANK}{chr(10) if lone else ''}]+" if split else r"(?s:.+)"))
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple, bool] = {}

    def __getstate__(self):
        return {**self.__dict__, "words": {}, "pairs": {}}

    @classmethod
    def read(cls, path: str) -> Transducer:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or train.treat_whitespace_as_suffix or train.model_type not in (_UNIGRAM, _BPE):
            raise ValueError("only models with the identity normaliser and pieces by score or by merges are supported")
        return cls([(p.piece, p.score, p.type) for p in model.pieces], train.model_type == _BPE, train.byte_fallback, norm.add_dummy_prefix, train.unk_id)

    def normalise(self, text: str) -> str:
        return (BLANK if self.prefix and text else "") + text.replace(" ", BLANK)

    def merged(self, symbols: list[str]) -> list[str]:
        """Neighbours joined while any joint piece exists: the best score
        first, then the leftmost."""
        symbols, score = list(symbols), self.score
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def pair_passes(self, a: str, b: str) -> bool:
        """Whether merging leaves the place between two pieces uncrossed."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            # the pieces' own strings, which all pairs share
            known = self.pairs[self.own.get(a, a), self.own.get(b, b)] = self.merged([*a, *b]) == [a, b]
        return known

    def shortest_path(self, word: str) -> list[str]:
        """Pieces (or single characters without a piece) of least weight."""
        return self._finite_path(word) if self.merges else self._least_path(word)

    def _finite_path(self, word: str) -> list[str]:
        """The one path of weight 0 through the composed machine, depth first
        with the longest piece ahead.  A place that once was left without a
        way on is never entered again: only one path of weight 0 leads to it,
        whichever piece came last."""
        n, ids, pairs, longest = len(word), self.ids, self.pairs.get, self.longest
        out: list[str] = []
        dead: set[int] = set()
        at, before, end = 0, None, min(n, longest)
        while at < n:
            while end > at:
                if end not in dead:
                    piece = word[at:end]
                    if (piece in ids or end == at + 1) and (before is None or pairs((before, piece)) or self.pair_passes(before, piece)):
                        break
                end -= 1
            if end > at:
                out.append(piece)
                at, before = end, piece
                end = min(n, at + longest)
            else:
                dead.add(at)
                end = at - 1  # a shorter piece at the place before
                at -= len(out.pop())
                before = out[-1] if out else None
        return out

    def _least_path(self, word: str) -> list[str]:
        """Viterbi search from the left."""
        n, arcs, penalty = len(word), self.arcs.get, self.penalty
        weight: list = [None] * (n + 1)
        last: list = [None] * (n + 1)
        weight[0] = 0.0
        for i in range(n):
            if weight[i] is None:
                continue
            for j in range(i + 1, n + 1):
                piece = word[i:j]
                arc = arcs(piece, _OUTSIDE)
                if arc is None and j > i + 1:
                    continue  # only the beginning of pieces
                if arc is _OUTSIDE and j > i + 1:
                    break
                w = weight[i] + (penalty if arc is None or arc is _OUTSIDE else arc)
                if weight[j] is None or w < weight[j]:
                    weight[j], last[j] = w, piece
        out, at = [], n
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _word(self, word: str) -> bytes:
        out: list[int] = []
        for piece in self.shortest_path(word):
            if piece in self.ids:
                out.append(self.ids[piece])
            elif self.byte_fallback:
                out += [self.byte_ids[b] for b in piece.encode()]
            elif not out or out[-1] != self.unknown:  # a run of unknowns is one
                out.append(self.unknown)
        packed = np.array(out, np.int32).tobytes()
        if len(self.words) >= KNOWN_WORDS:
            self.words.clear()
        if len(word) <= 64:
            self.words[word] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        get, make = self.words.get, self._word
        parts = [get(w) or make(w) for w in self.word.findall(self.normalise(text))]
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids) -> str:
        surface = self.surface
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def encode_documents(docs: DataFrame, model: str = MODEL, check: bool = True) -> DataFrame:
    """The documents with ``ids`` and ``n_tokens``, and with ``check`` also
    ``round_trip``: whether the decoded ids give the text back."""
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast(Transducer.read(model))
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("round_trip", T.BooleanType())] if check else []

    def compute(texts):
        fst = held.value
        ids = [None if t is None else fst.encode(t) for t in texts]
        out = [pa.array(ids, pa.list_(pa.int32())), [0 if x is None else len(x) for x in ids]]
        if check:
            out.append([None if x is None else fst.decode(x.tolist()) == t.replace(BLANK, " ") for t, x in zip(texts, ids, strict=True)])
        return out

    return map_columns(docs, ["text"], fields, compute)


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """The rows with ``text`` decoded from ``ids``."""
    held = encoded.sparkSession.sparkContext.broadcast(Transducer.read(model))
    return map_columns(encoded, ["ids"], [T.StructField("text", T.StringType())], lambda ids: [[None if x is None else held.value.decode(x) for x in ids]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_tokens", "ids", F.coalesce("round_trip", F.lit(True)).alias("round_trip"))
