"""Benchmark decontamination by an FM-index of every training shard (operator 8).

A shard is one Arrow batch of documents in a task.  Its words become symbols of
the benchmark's vocabulary; a word the benchmark doesn't hold can be part of no
occurrence, so only stretches of benchmark words that are long enough enter the
index, with a separator after each.  All benchmark windows are searched
backwards through the wavelet ranks, their occurrences located by sampled
suffix positions, and the words they cover merged into spans.  Documents are
not shuffled.

The benchmark goes to the tasks in blocks of at most ``block_bytes``: their
number follows the benchmark's size, and each block is a bounded broadcast.
With several blocks the documents pass through one after the other.

A window is 10 consecutive words of an item; an item of fewer words, but not
none, is one window.  Words: A-Z lower-cased, then runs of ASCII digits and
letters and of all characters from U+0080 on.

Defined results: null and empty texts have no words, no spans and no items;
items without words never occur; an item without an id marks words but isn't
listed; items of the same text are all listed; an empty table on either side
gives no spans; other columns pass through, and of a clashing name the
result's column stays.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relevo.llm.common import map_columns, packed, ranges, table, unpacked, utf8
from relevo.llm.fm_index import FMIndex

NAME = "op8_decontamination"
WINDOW = 10
BLOCK_BYTES = 32 << 20
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def pieces(data: bytes, size: int = PIECE):
    """Slices of about ``size`` bytes that part no word."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + size)
        end = gap.end() if gap else len(data)
        yield data[at:end]
        at = end


def words(text: str | None):
    for piece in pieces(utf8(text).translate(_LOWER)):
        yield from _WORD.findall(piece)


class Phrases:
    """Windows of one block of the benchmark: vocabulary, distinct windows by
    length, and the items of each window."""

    def __init__(self, rows, window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple, set] = defaultdict(set)
        for item, text in rows:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in words(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found[tuple(ids[i : i + window])].add(item)
        by_length = defaultdict(list)
        for w in found:
            by_length[len(w)].append(w)
        self.groups = [(np.array(ws, np.int64), [sorted(str(x) for x in found[w] if x is not None) for w in ws]) for _, ws in sorted(by_length.items())]
        self.shortest = min(by_length, default=0)


def _stretches(text: str | None, phrases: Phrases) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Number of words, symbols, and the long enough stretches [start, end)."""
    get, parts = phrases.vocabulary.get, []
    for piece in pieces(utf8(text).translate(_LOWER)):
        parts.append(np.array([get(w, 0) for w in _WORD.findall(piece)], np.int64))
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
    start, end = edge[::2], edge[1::2]
    long = end - start >= max(1, phrases.shortest)
    return len(ids), ids, start[long], end[long]


def search_shard(texts: list, phrases: Phrases) -> tuple[list, list, list]:
    """(n_words, spans, items) of every text of a shard."""
    n_words, symbols, doc_of, word_of = [], [], [], []
    for d, text in enumerate(texts):
        n, ids, start, end = _stretches(text, phrases)
        n_words.append(n)
        for a, b in zip(start, end, strict=True):
            symbols += [ids[a:b], [1]]
            doc_of.append(np.full(b - a + 1, d))
            word_of.append(np.arange(a, b + 1))
    spans, items = [[] for _ in texts], [set() for _ in texts]
    if symbols and phrases.groups:
        seq, doc_of, word_of = np.concatenate(symbols), np.concatenate(doc_of), np.concatenate(word_of)
        index = FMIndex(seq)
        depth = np.zeros(len(seq) + 1, np.int64)
        for patterns, owners in phrases.groups:
            which = np.flatnonzero((patterns < index.sigma).all(axis=1))
            low, high = index.search(patterns[which])
            times = high - low
            at = index.locate(ranges(low, times))
            np.add.at(depth, at, 1)
            np.add.at(depth, at + patterns.shape[1], -1)
            pairs = np.unique(doc_of[at] * len(patterns) + np.repeat(which, times))
            for d, w in zip(pairs // len(patterns), pairs % len(patterns), strict=True):
                items[d].update(owners[w])
        hit = np.flatnonzero(np.cumsum(depth[:-1]) > 0)
        if len(hit):
            cut = np.flatnonzero((np.diff(doc_of[hit]) != 0) | (np.diff(word_of[hit]) != 1)) + 1
            for first, last in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(hit)]]) - 1, strict=True):
                spans[doc_of[hit[first]]].append((int(word_of[hit[first]]), int(word_of[hit[last]]) + 1))
    return n_words, spans, [sorted(x) for x in items]


def merge_spans(spans: list) -> list:
    out: list = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with ``n_words``, ``spans`` ([start, end) in words, merged,
    in order) and ``items`` (ids of the items with occurring windows)."""
    spark = docs.sparkSession
    bench = benchmark.select("item_id", "text")
    total = bench.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = math.ceil(total / block_bytes) or 1
    out = docs
    for b in range(blocks):
        # rows of one block: about block_bytes of text, spread by a hash
        rows = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        phrases = spark.sparkContext.broadcast(Phrases([tuple(r) for r in rows], window))

        def first(texts, phrases=phrases):
            return search_shard(texts, phrases.value)

        def further(texts, spans, items, phrases=phrases):
            n, more, own = search_shard(texts, phrases.value)
            merged = [merge_spans([(x["start"], x["end"]) for x in old] + new) for old, new in zip(spans, more, strict=True)]
            return n, merged, [sorted({*old, *new}) for old, new in zip(items, own, strict=True)]

        out = map_columns(out, ["text"], _FIELDS, first) if b == 0 else map_columns(out, ["text", "spans", "items"], _FIELDS, further)
    return out


def cut_spans(text: str, spans: list) -> str:
    """The text without its hit words (and what stands between them)."""
    data = utf8(text)
    low, kept, at, n = data.translate(_LOWER), [], 0, 0
    todo = iter(spans)
    span = next(todo, None)
    for m in _WORD.finditer(low):
        if span is None:
            break
        if n == span["start"]:
            kept.append(data[at : m.start()])
        n += 1
        if n == span["end"]:
            at, span = m.end(), next(todo, None)
    return b"".join([*kept, data[at:]]).decode("utf-8", "replace")


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with hit words cut out of their texts; a document that is
    left without any word goes.  ``n_chars``, where present, follows the text."""
    found = find_contamination(packed(docs), benchmark, window)
    left = map_columns(
        found,
        ["text", "spans"],
        [T.StructField("text", T.StringType())],
        lambda texts, spans: [[cut_spans(t, s) if s else t for t, s in zip(texts, spans, strict=True)]],
    )
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    left = left.filter((F.size("spans") == 0) | (hit < F.col("n_words")))
    changed = {}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("rest.n_chars"))
    return left.select(*unpacked(docs.columns, **changed))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, w[i + 1 : i + n] AS win, n FROM (
    SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(greatest(len(w) - {WINDOW}, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, w[i + 1 : i + n] AS win, i, n FROM (
    SELECT r, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hits AS MATERIALIZED (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win),
covered AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
its AS (SELECT r, count(*)::BIGINT AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN its USING (r)
"""
