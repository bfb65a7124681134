"""Toxicity by a weighted lexicon (operator 2).

Texts are folded (case, accents, look-alike letters of other scripts, digits
and signs used for letters) to a small alphabet in which every other character
is a blank.  Lexicon entries, word beginnings and whole words with weights,
are matched in one Aho-Corasick pass; matches inside an exception phrase don't
count.  The sum of the weights, by itself and per length, goes through a
logistic curve.

The lexicon is learned: over a bounded sample of labelled documents
(``sample_documents``, chosen by a hash of the id; of near copies, which share
their least shingle hash, one) Spark counts, for every word and word
beginning, the toxic and the other documents that hold it and its occurrences
there; the weights are the log-odds of the occurrences.  Words that merely stand beside insults are left out: entries are
taken in order of the evidence they have in toxic documents that fewer than
``cover`` entries explain so far.  Exception phrases are an entry's word with
the one before or after it, where the sample shows the phrase in clean
documents only.
Scoring is one pass over the documents without a shuffle.

Defined results: null and empty texts have no matches and get the score of a
document without matches; labels other than 0 and 1 and null ids are not
learned from; without any usable label all scores are 0; repeated rows are
scored alike; an empty table gives an empty result; other columns pass
through, of a clashing name the result's stays.
"""

from __future__ import annotations

import bisect
import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relevo.llm.common import crc_fold, map_columns, table
from relevo.session import materialize

NAME = "op2_toxicity"
ORACLE_SQL = None
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Labelled documents that the lexicon and the curve are learned from.
SAMPLE_DOCUMENTS = 20_000
#: Lengths of word beginnings; an entry's fewest toxic documents, least
#: log-odds and least log-likelihood ratio; candidates kept (the strongest).
STEMS = (4, 5, 6, 7, 8, 9, 10)
LEAST_DOCUMENTS, LEAST_ODDS, LEAST_RATIO, CANDIDATES = 3, 2.0, 24.0, 20_000
#: Entries that a toxic document may be explained by before it lends no more
#: evidence.
COVER = 3
#: Occurrences of a word in one document that are evidence.
REPEATS = 3

# Letters of other scripts that look like Latin ones, and digits
# and signs written for letters.  "l" and "1" stand for "i" as well.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ł": "i", "ø": "o", "đ": "d", "ħ": "h", "ß": "ss", "æ": "ae", "œ": "oe",
    "l": "i", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
}


class _Folding(dict):
    """str.translate table that works out a character when it first meets it."""

    def __missing__(self, code: int) -> str:
        out = ""
        for c in unicodedata.normalize("NFKD", chr(code)).lower():
            for d in unicodedata.normalize("NFKD", c):
                if not unicodedata.combining(d):
                    d = _LOOKALIKES.get(d, d)
                    out += d if d.isalnum() else " "
        self[code] = out
        return out


_FOLDING = _Folding()


def fold(text: str | None) -> str:
    """The folded text with a blank at either end."""
    return f" {(text or '').translate(_FOLDING)} "


def terms(text: str | None) -> Counter:
    """How often each folded word (blank at both ends) and word beginning
    (blank before) occurs; a word repeated on and on counts ``REPEATS`` times."""
    out: Counter = Counter()
    for w, n in Counter(fold(text).split()).items():
        n = min(n, REPEATS)
        out[f" {w} "] += n
        for k in STEMS:
            if k > len(w):
                break
            out[f" {w[:k]}"] += n
    return out


class Lexicon:
    def __init__(self, weights: dict[str, float], exceptions=(), curve=None):
        self.weights, self.exceptions = dict(weights), sorted(exceptions)
        self.curve = curve  # of features(), for the logistic function; None: score 0
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def matches(self, folded: str):
        """(start, end, entry) of entries outside exception phrases."""
        import ahocorasick

        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for w in self.weights:
                self._automaton.add_word(w, (w, False))
            for w in self.exceptions:
                self._automaton.add_word(w, (w, True))
            if len(self._automaton):
                self._automaton.make_automaton()
        if not len(self._automaton):
            return []
        found, spared = [], []
        for last, (w, exempt) in self._automaton.iter(folded):
            (spared if exempt else found).append((last + 1 - len(w), last + 1, w))
        if spared:
            found = [(a, b, w) for a, b, w in found if not any(s <= a and b <= e for s, e, _ in spared)]
        return found

    def features(self, text: str | None) -> list[float]:
        """One, the summed weight by itself and per length of text (each
        occurrence of a word counts once, with its heaviest entry)."""
        folded = fold(text)
        best: dict[int, float] = {}
        for start, _, w in self.matches(folded):
            best[start] = max(best.get(start, 0.0), self.weights[w])
        total = sum(best.values())
        return [1.0, math.log1p(total), math.log1p(1000 * total / len(folded))]

    def scores(self, texts: list) -> list[float]:
        if self.curve is None:
            return [0.0] * len(texts)
        z = np.array([self.features(t) for t in texts]).reshape(-1, 3) @ self.curve
        return (1 / (1 + np.exp(-np.clip(z, -40, 40)))).tolist()


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) / len(y) - ridge * w)
    return w


def _counts(texts: DataFrame) -> DataFrame:
    """``term, bad, good, bad_n, good_n``: documents of either label that hold
    a term, and its occurrences there.  Each task counts a batch before
    anything is shuffled."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            docs, hits = (Counter(), Counter()), (Counter(), Counter())
            for t, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                own = terms(t)
                docs[y].update(own.keys())
                hits[y].update(own)
            keys = list(docs[0].keys() | docs[1].keys())
            for i in range(0, len(keys), 50_000):
                part = keys[i : i + 50_000]
                sums = {n: pa.array([c[k] for k in part], pa.int64()) for n, c in (("bad", docs[1]), ("good", docs[0]), ("bad_n", hits[1]), ("good_n", hits[0]))}
                yield pa.RecordBatch.from_pydict({"term": pa.array(part, pa.string()), **sums})

    return texts.mapInArrow(run, "term string, bad long, good long, bad_n long, good_n long").groupBy("term").agg(*(F.sum(c).alias(c) for c in ("bad", "good", "bad_n", "good_n")))


def _ratio(bad: float, good: float, bads: float, goods: float) -> float:
    """Log-likelihood ratio of a term's counts against an even spread."""
    expect = (bad + good) * bads / (bads + goods)
    if bad <= expect:
        return 0.0
    rest = (bad + good) - expect
    return 2 * (bad * math.log(bad / expect) + (good * math.log(good / rest) if good else 0.0))


def choose_entries(counts: dict, documents: list[list[str]], bad_size: float, good_size: float, cover: int = COVER) -> dict[str, float]:
    """Terms with enough evidence, and their odds: their occurrences (``counts``: term to
    ``bad``, ``bad_n``, ``good_n``, ``odds``) against the length of either kind of text,
    for the share of the toxic ``documents`` (candidate terms of each) that
    isn't explained yet."""
    holders: dict[str, set[int]] = {}
    for d, own in enumerate(documents):
        for t in own:
            holders.setdefault(t, set()).add(d)
    left, chosen = dict.fromkeys(range(len(documents)), 0), {}

    def rank(t):
        c = counts[t]
        return (_ratio(c["bad_n"] * len(holders[t]) / c["bad"], c["good_n"], bad_size, good_size), -len(t), t)

    queue = sorted(((rank(t), t) for t in holders))
    while queue:
        was, t = queue.pop()
        if was[0] < LEAST_RATIO:
            break
        now = rank(t)
        if queue and now < queue[-1][0]:  # its evidence shrank since
            bisect.insort(queue, (now, t))
            continue
        if now[0] < LEAST_RATIO or len(holders[t]) < LEAST_DOCUMENTS:
            continue
        odds = counts[t]["odds"]
        if any(chosen.get(t[:n], -9.0) > odds - 1.5 for n in range(2, len(t))):
            continue  # a shorter beginning of the same words does as well
        chosen[t] = odds
        for d in list(holders[t]):
            left[d] += 1
            if left[d] >= cover:
                for other in documents[d]:
                    holders[other].discard(d)
    return chosen


def _least_shingle(text: str | None) -> int:
    words = fold(text).split()
    return min((zlib.crc32(" ".join(words[i : i + 4]).encode()) for i in range(max(1, len(words) - 3))), default=0)


def learn_lexicon(docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, exceptions=()) -> Lexicon:
    """A lexicon from labelled rows whose crc fold isn't the held-out one;
    ``exceptions``: further exception phrases."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter((crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("toxic").isin(0, 1))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_documents)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    texts = map_columns(texts, ["text"], [T.StructField("shingle", T.LongType())], lambda ts: [[_least_shingle(t) for t in ts]])
    texts = texts.groupBy("shingle").agg(F.min(F.struct("doc_id", "text", "toxic")).alias("one")).select("one.text", "one.toxic")
    texts = materialize(texts, "toxicity-sample")
    n = {r["toxic"]: r for r in texts.groupBy("toxic").agg(F.sum(F.length("text")).alias("size")).collect()}
    if not n:
        return Lexicon({})
    bad_size, good_size = ((n[y]["size"] or 0) + 1 if y in n else 1 for y in (1, 0))
    odds = F.log((F.col("bad_n") + 0.5) / bad_size) - F.log((F.col("good_n") + 0.5) / good_size)
    strong = _counts(texts).filter(F.col("bad") >= LEAST_DOCUMENTS).select("term", "bad", "bad_n", "good_n", odds.alias("odds")).filter(F.col("odds") >= LEAST_ODDS)
    candidates = {r["term"]: r for r in strong.orderBy(F.desc("odds"), "term").limit(CANDIDATES).collect()}
    held = broadcast(frozenset(candidates))
    own = map_columns(texts.filter("toxic = 1"), ["text"], [T.StructField("own", T.ArrayType(T.StringType()))], lambda ts: [[sorted(terms(t).keys() & held.value) for t in ts]])
    weights = choose_entries(candidates, sorted(r["own"] for r in own.select("own").collect()), bad_size, good_size)
    held1 = broadcast(Lexicon(weights, {fold(x) for x in exceptions}))

    def phrases(batch_texts):
        out = []
        for t in batch_texts:
            folded, found = fold(t), set()
            for start, end, _ in held1.value.matches(folded):
                stop = folded.find(" ", max(end - 1, start + 1))
                before, after = folded.rfind(" ", 0, start), folded.find(" ", stop + 1)
                found |= {p for p in (folded[before : stop + 1] if before >= 0 else "", folded[start : after + 1] if after > 0 else "") if len(p.split()) == 2}
            out.append(sorted(found))
        return [out]

    seen = map_columns(texts, ["text"], [T.StructField("phrase", T.ArrayType(T.StringType()))], phrases)
    spared = (
        seen.select("toxic", F.explode("phrase").alias("phrase")).groupBy("phrase").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
        .filter((F.col("bad") == 0) & (F.col("n") >= LEAST_DOCUMENTS)).orderBy(F.desc("n"), "phrase").limit(CANDIDATES)
    )
    lexicon = Lexicon(weights, {fold(x) for x in exceptions} | {r["phrase"] for r in spared.collect()})
    held2 = broadcast(lexicon)
    rows = map_columns(texts, ["text"], [T.StructField("x", T.ArrayType(T.DoubleType()))], lambda ts: [[held2.value.features(t) for t in ts]]).select("x", "toxic").collect()
    rows = sorted((r["x"], r["toxic"]) for r in rows)
    lexicon.curve = _curve(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float))
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents with ``score`` (probability of being toxic)."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)
    return map_columns(docs, ["text"], [T.StructField("score", T.DoubleType())], lambda texts: [held.value.scores(texts)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, learn_lexicon(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
