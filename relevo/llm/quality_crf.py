"""Document quality by a linear-chain conditional random field (operator 7).

Every line of a document is good or bad.  A line's features are shares of its
own characters and words and those of its neighbours; the chain's two states
are tied by learned transition weights.  Forward-backward gives each line's
probability of being good, and the document's score is their mean weighted by
the lines' lengths in bytes.

Training lines carry their document's label.  The fit runs over a bounded
sample of labelled documents (``sample_documents``, chosen by a hash of the
id, the same on every run; whole ones in that order, until ``sample_lines``
lines a document on average are used up, the last one whole, too), whose
features Spark computes; the model is a few dozen numbers.  Scoring is one
pass over the documents without a shuffle.

Defined results: null texts, empty texts and texts of blank lines have no
lines and get the sample's share of good documents; with no usable label at
all every document gets 0.5; labels other than 0 and 1 and null ids are not
learned from; repeated rows are scored alike; an empty table gives an empty
result; other columns pass through, of a clashing name the result's stays.
"""

from __future__ import annotations

from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relevo.llm.common import crc_fold, map_columns, table, utf8
from relevo.session import materialize

NAME = "op7_quality_classifier"
ORACLE_SQL = None
FOLDS, HELD_OUT = 3, 1
SAMPLE_DOCUMENTS = 6000
SAMPLE_LINES = 400
THRESHOLD = 0.5
#: Bytes of a line whose words are held at once.
PIECE = 1 << 20

_UPPER, _LOWER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_STOPS, _SPACE = b".,;:?'\"-()", b" \t\r\x0b\x0c"
_PLAIN = _UPPER + _LOWER + _DIGIT + _STOPS + _SPACE + b"!|" + bytes(range(128, 256))
OWN, SHARED = 11, 7  # features of a line, and those taken from its neighbours
WIDTH = OWN + SHARED


def _line_features(line: bytes) -> tuple:
    n = len(line)

    def share(chars: bytes) -> float:
        return (n - len(line.translate(None, chars))) / n

    upper, lower = share(_UPPER), share(_LOWER)
    words = same = kinds = 0
    last = None
    for at in range(0, n, PIECE):
        ws = line[at : at + PIECE].split()
        if ws:
            words += len(ws)
            same += sum(map(eq, ws, ws[1:])) + (ws[0] == last)
            kinds += len(set(ws))
            last = ws[-1]
    return (
        1 - share(_PLAIN),
        line.count(b"|") / n,
        line.count(b"!") / n,
        upper / (upper + lower) if upper + lower else 0.0,
        share(_DIGIT),
        same / words if words else 0.0,
        1 - kinds / words if words else 0.0,
        share(_STOPS),
        np.log1p(n) / 10,
        min(n / words, 100) / 20 if words else 5.0,
        1.0,
    )


def document_lines(text: str | None) -> list[bytes]:
    """Lines with any visible byte."""
    return [x for x in utf8(text).split(b"\n") if x.strip()]


def chain_features(lines: list[bytes]) -> np.ndarray:
    """A row for each line: its own features, then the neighbours' mean."""
    own = np.array([_line_features(x) for x in lines]).reshape(-1, OWN)
    near = np.zeros((len(lines), SHARED))
    if len(lines) > 1:
        count = np.full((len(lines), 1), 2.0)
        count[[0, -1]] = 1
        near[1:] += own[:-1, :SHARED]
        near[:-1] += own[1:, :SHARED]
        near /= count
    return np.hstack([own, near])


class Chains:
    """Documents of different lengths, walked line by line all at once."""

    def __init__(self, lengths):
        lengths = np.asarray(lengths, np.int64)
        order = np.argsort(-lengths, kind="stable")
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order] if len(lengths) else lengths
        alive = lengths[order]
        self.rows = []  # at each line number, the rows of the documents that have it
        t = 0
        n = len(alive)
        while n and alive[0] > t:
            n = int(np.searchsorted(-alive, -t, side="left"))
            self.rows.append(starts[:n] + t)
            t += 1
        self.first = starts[: len(self.rows[0])] if self.rows else starts[:0]

    def marginals(self, odds: np.ndarray, move: np.ndarray, pairs: bool = False):
        """P(good) of every line from the lines' log-odds and the 2x2 log
        weights of neighbouring states; with ``pairs`` also the expected
        transition counts and the log-partition of all documents together."""
        emit = np.stack([np.ones_like(odds), np.exp(np.clip(odds, -30, 30))], axis=1)
        step = np.exp(move)
        fwd, bwd = np.empty_like(emit), np.ones_like(emit)
        log_z, prev = 0.0, None
        for rows in self.rows:
            a = emit[rows] if prev is None else emit[rows] * (fwd[rows - 1] @ step)
            z = a.sum(axis=1, keepdims=True)
            fwd[rows] = a / z
            log_z += np.log(z).sum()
            prev = rows
        counts = np.zeros((2, 2))
        for rows in reversed(self.rows[1:]):
            b = emit[rows] * bwd[rows]
            if pairs:
                joint = fwd[rows - 1][:, :, None] * step * b[:, None, :]
                counts += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back = b @ step.T
            bwd[rows - 1] = back / back.sum(axis=1, keepdims=True)
        post = fwd * bwd
        good = post[:, 1] / post.sum(axis=1)
        return (good, counts, log_z) if pairs else good


class LineModel:
    """Weights of the features, of the transitions, and the prior share."""

    def __init__(self, scale=None, weights=None, move=None, prior=0.5):
        self.scale = np.ones(WIDTH) if scale is None else scale
        self.weights = np.zeros(WIDTH) if weights is None else weights
        self.move = np.zeros((2, 2)) if move is None else move
        self.prior = prior

    @classmethod
    def fit(cls, documents: list[tuple[np.ndarray, int]], rounds: int = 150, rate: float = 0.15, ridge: float = 1e-4):
        """Full-batch Adam along two parts of the likelihood's gradient, each
        with a scale of its own, so the steps follow no single likelihood: the
        features' part is a mean over documents, whose lines share a
        document's weight, and the transitions' part is a mean over pairs of
        neighbouring lines.  The same input gives the same model."""
        prior = float(np.mean([y for _, y in documents])) if documents else 0.5
        documents = [d for d in documents if len(d[0])]
        if not documents:
            return cls(prior=prior)
        x = np.concatenate([f for f, _ in documents])
        lengths = [len(f) for f, _ in documents]
        y = np.repeat([float(label) for _, label in documents], lengths)
        per_line = np.repeat([1 / n for n in lengths], lengths)  # documents count alike
        scale = np.maximum(x.std(axis=0), 1e-3)
        scale[OWN - 1] = 1.0
        x = x / scale
        chains = Chains(lengths)
        same = np.zeros((2, 2))
        for f, label in documents:
            same[label, label] += len(f) - 1
        theta, m, v = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
        pairs_total = max(same.sum(), 1.0)
        for i in range(1, rounds + 1):
            good, counts, _ = chains.marginals(x @ theta[:WIDTH], theta[WIDTH:].reshape(2, 2), pairs=True)
            grad = np.concatenate([((y - good) * per_line) @ x / len(documents), ((same - counts) / pairs_total).ravel()]) - ridge * theta
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            theta = theta + rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
        return cls(scale, theta[:WIDTH], theta[WIDTH:].reshape(2, 2), prior)

    def scores(self, texts: list) -> list[float]:
        lines = [document_lines(t) for t in texts]
        lengths = [len(x) for x in lines]
        out = np.full(len(texts), self.prior)
        if any(lengths):
            x = np.concatenate([chain_features(ls) for ls in lines if ls]) / self.scale
            good = Chains(lengths).marginals(x @ self.weights, self.move)
            weight = np.array([len(x) for ls in lines for x in ls], float)
            doc = np.repeat(np.arange(len(texts)), lengths)
            some = np.asarray(lengths) > 0
            total = np.bincount(doc, weight * good, len(texts))
            out[some] = total[some] / np.bincount(doc, weight, len(texts))[some]
        return np.clip(out, 0, 1).tolist()


def fit_quality(docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, sample_lines: int = SAMPLE_LINES) -> LineModel:
    """A model from labelled rows whose crc fold isn't the held-out one."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter((crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("quality").isin(0, 1))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_documents)
    texts = materialize(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "quality-sample")
    # whole documents in the sample's order, until sample_lines a document on average are used
    sizes = texts.groupBy("doc_id").agg(F.sum(F.greatest(F.size(F.split("text", "\n")), F.lit(0))).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    room, taken = sample_documents * sample_lines, []
    for r in sizes:
        if room <= 0:
            break
        room -= r["n"] or 0
        taken.append(r["doc_id"])
    if len(taken) < len(sizes):
        texts = texts.filter(F.col("doc_id").isin(taken))

    def compute(texts):
        return [[chain_features(document_lines(t)).astype("<f8").tobytes() for t in texts]]

    rows = map_columns(texts, ["text"], [T.StructField("x", T.BinaryType())], compute).select("doc_id", "quality", "x").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["quality"], bytes(r["x"])))
    return LineModel.fit([(np.frombuffer(r["x"], "<f8").reshape(-1, WIDTH), r["quality"]) for r in rows])


def score_quality(docs: DataFrame, model: LineModel) -> DataFrame:
    """The documents with ``score`` (probability of good quality)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return map_columns(docs, ["text"], [T.StructField("score", T.DoubleType())], lambda texts: [held.value.scores(texts)])


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with their own columns."""
    judged = map_columns(docs, ["text"], [T.StructField("_quality_score", T.DoubleType())], _scorer(docs, labels))
    return judged.filter(F.col("_quality_score") >= threshold).select(*docs.columns)


def _scorer(docs: DataFrame, labels: DataFrame):
    held = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels))
    return lambda texts: [held.value.scores(texts)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
