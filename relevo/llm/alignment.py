"""Alignment of two tokenizers' tokens with corpus-wide pair counts by external
spill counting (operator 11).

Every text is encoded by a byte-level tokenizer (A) and a SentencePiece model
(B).  Where tokens of both end at the same byte a group ends; two tokens whose
bytes overlap are linked.  Each stretch between neighbouring ends of either
kind is one link, so links are as many as distinct ends.

A task turns some megabytes of text into a run: pair-document records (pair,
document, times) in order of the B side, then the A side, as zstd blocks that
stay where they are written, and the pairs' totals, radix-partitioned by their
B id, as zstd blocks that travel.  Tasks merge the totals of up to ``FAN`` runs
of a radix at a time by a heap over the heads of their blocks, in as many
levels as it takes; in side-major order every B id's maximum is at hand when
its pairs end.  The counts then go back to the runs, slice by slice, where the
records turn them into sums for each document.  No task holds more than ``FAN``
runs' blocks of one radix, and a frequent pair is one number a run.

Both tokenizers treat the text between two blanks alone (before a blank or a
line break that stands between other characters, A's words and B's merges
end), so chunks met before are looked up.

Defined results: texts that are null or empty, or that either side's joined
bytes don't give back (a literal U+2581), have no tokens: zeros and an empty
digest; repeated rows and null ids are documents of their own; an empty table
gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relevo.llm.common import ranges, table
from relevo.llm.word_cache import Loaded, slices
from relevo.session import materialize

NAME = "op11_token_alignment"
ORACLE_SQL = None
#: Radix partitions (of B ids), runs merged at a time, pairs of a block, and
#: characters of a run.
RADIX, FAN, BLOCK, RUN_CHARS = 64, 64, 8192, 4_000_000
#: Chunks and links that a Python worker remembers.
KNOWN_CHUNKS, KNOWN_LINKS = 400_000, 6_000_000
BLANK = "▁"
_CHUNK = re.compile(r"[ \n]\S+(?=[ \n]\S|\Z)|(?s:.+?)(?<=\S)(?=[ \n]\S)|(?s:.+)")
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write a byte as the Latin-1 character of the
    same number where that is visible, the others as characters from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers, and the aligned chunks met before: chunk number k has
    the numbers ``counts[k]``, the text ``groups[k]`` and the links from
    ``first[k]`` on in ``links`` (B id * 65536 + A id)."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte = byte_of_character()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if is_byte else p.replace(BLANK, " ").encode() for p, is_byte in pieces]
        if any("\n" in p or BLANK in p.lstrip(BLANK) for p, _ in pieces):
            raise ValueError("a piece crosses a blank or a line break: texts can't be cut there")
        self.a_size, self.b_size = (np.array([*map(len, x)], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(len(self.b_bytes))]
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.bad: set[int] = set()  # chunks that some side doesn't give back
        self.counts, self.first, self.links = array("q"), array("q", [0]), array("I")
        self.met = np.zeros(0, np.int64)  # how often since the last time room was made

    def make_room(self) -> None:
        """Forget the chunks met least: once, or more often if these leave
        more than half of the room."""
        met = np.zeros(len(self.groups), np.int64)
        met[: len(self.met)] = self.met
        length = np.diff(np.frombuffer(self.first, np.int64))
        most = np.sort(met)[::-1][: KNOWN_CHUNKS // 2]
        keep = np.flatnonzero(met > max(1, int(most[-1])))
        if length[keep].sum() > KNOWN_LINKS // 2:
            keep = keep[:0]
        first, counts, links, groups, chunks, bad = self.first, self.counts, self.links, self.groups, sorted(self.index, key=self.index.get), self.bad
        self.reset()
        self.bad = {i for i, k in enumerate(keep.tolist()) if k in bad}
        self.index = {chunks[k]: i for i, k in enumerate(keep.tolist())}
        self.groups = [groups[k] for k in keep.tolist()]
        self.counts.frombytes(np.frombuffer(counts, np.int64).reshape(-1, 4)[keep].tobytes())
        begin = np.frombuffer(first, np.int64)[keep]
        self.links.frombytes(np.frombuffer(links, np.uint32)[ranges(begin, length[keep])].tobytes())
        self.first.frombytes(np.cumsum(length[keep]).tobytes())

    def tokens(self, chunks: list[str]) -> tuple[list, list]:
        """Ids of both sides; a chunk begins with a blank or a line break."""
        a = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        # the model adds the blank itself; before a line break it is not ours
        b = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return a, [x if c[0] == " " else x[1:] for c, x in zip(chunks, b, strict=True)]

    def add(self, chunks: list[str]) -> None:
        a, b = self.tokens(chunks)
        data = [c.encode() for c in chunks]
        a_join, b_join = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        if any(b"".join(map(f, (i for own in ids for i in own))) != b"".join(data) for f, ids in ((a_join, a), (b_join, b))):
            good = [b"".join(map(a_join, x)) == d == b"".join(map(b_join, y)) for x, y, d in zip(a, b, data, strict=True)]
            for c in [c for c, fits in zip(chunks, good, strict=True) if not fits]:
                self.bad.add(len(self.groups))
                self.index[c] = len(self.groups)
                self.groups.append("")
                self.counts.extend((0, 0, 0, 0))
                self.first.append(len(self.links))
            chunks, a, b, data = ([x for x, fits in zip(own, good, strict=True) if fits] for own in (chunks, a, b, data))
            if not chunks:
                return
        n_a, n_b = (np.array([*map(len, own)], np.int64) for own in (a, b))
        flat_a, flat_b = (np.fromiter((i for x in own for i in x), np.int64, int(n.sum())) for own, n in ((a, n_a), (b, n_b)))
        # ends of the tokens in all chunks' joined bytes; every one is a link's end
        end_a, end_b = np.cumsum(self.a_size[flat_a]), np.cumsum(self.b_size[flat_b])
        chunk_end = np.cumsum([*map(len, data)])
        ends, both = np.union1d(end_a, end_b), np.intersect1d(end_a, end_b, assume_unique=True)
        links = flat_b[np.searchsorted(end_b, ends)] << 16 | flat_a[np.searchsorted(end_a, ends)]
        link_end, group_end = (np.searchsorted(x, chunk_end, "right") for x in (ends, both))
        counts = np.stack([n_a, n_b, np.diff(group_end, prepend=0), np.diff(link_end, prepend=0)], 1)
        a_text, b_text = [self.a_text[i] for i in flat_a.tolist()], [self.b_text[i] for i in flat_b.tolist()]
        a_cut, b_cut = ([0, *(np.searchsorted(x, both) + 1).tolist()] for x in (end_a, end_b))
        parts = [",".join(a_text[i:j]) + "|" + ",".join(b_text[k:m]) for i, j, k, m in zip(a_cut, a_cut[1:], b_cut, b_cut[1:], strict=False)]
        base, cuts = len(self.groups), [0, *group_end.tolist()]
        self.index.update(zip(chunks, range(base, base + len(chunks)), strict=True))
        self.groups += [";".join(parts[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
        self.counts.frombytes(counts.astype(np.int64).tobytes())
        self.first.frombytes((link_end + len(self.links)).astype(np.int64).tobytes())
        self.links.frombytes(links.astype(np.uint32).tobytes())

    def numbered(self, texts: list[str | None]) -> list[list[int]]:
        """Chunk numbers of every text (none for null and empty ones)."""
        if len(self.groups) > KNOWN_CHUNKS or len(self.links) > KNOWN_LINKS:
            self.make_room()
        chunks = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        known = self.index
        new = list({c for own in chunks for c in own if c not in known})
        if new:
            self.add(new)
        return [[known[c] for c in own] for own in chunks]


def pack_blocks(*columns: np.ndarray) -> bytes:
    """Columns of equal length as zstd blocks, each behind its length; the
    first column rises and is written as differences."""
    import zstandard

    press, out = zstandard.ZstdCompressor(level=3), []
    for at in range(0, len(columns[0]), BLOCK):
        parts = [c[at : at + BLOCK] for c in columns]
        parts[0] = np.diff(parts[0], prepend=0)
        data = press.compress(b"".join([p.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for p in parts]))
        out += [len(data).to_bytes(4, "little"), len(parts[0]).to_bytes(4, "little"), data]
    return b"".join(out)


def unpack_blocks(data: bytes, columns: int):
    """The blocks again, one at a time."""
    import zstandard

    open_, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        size, n = int.from_bytes(data[at : at + 4], "little"), int.from_bytes(data[at + 4 : at + 8], "little")
        plain = np.frombuffer(open_.decompress(data[at + 8 : at + 8 + size], max_output_size=8 * n * columns), np.uint8)
        parts = [np.ascontiguousarray(p.reshape(8, n).T).view("<i8").ravel() for p in np.split(plain, columns)]
        yield np.cumsum(parts[0]), *parts[1:]
        at += 8 + size


def whole(data: bytes, columns: int) -> list[np.ndarray]:
    """All blocks joined."""
    blocks = list(unpack_blocks(data, columns))
    return [np.concatenate(c) for c in zip(*blocks, strict=True)] if blocks else [np.zeros(0, np.int64)] * columns


def radix_order(pairs: np.ndarray, radix: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of sorted pairs by radix of the B id, and where each
    radix begins."""
    part = (pairs >> 16) % radix
    return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=radix))])


def make_run(aligner: Aligner, texts: list[str | None], radix: int = RADIX) -> tuple[dict, bytes, list]:
    """(numbers of every document, records, [(radix, totals)]) of some texts."""
    own = aligner.numbered(texts)
    groups = aligner.groups
    if aligner.bad:
        own = [codes if aligner.bad.isdisjoint(codes) else [] for codes in own]
    codes = np.fromiter((k for x in own for k in x), np.int64)
    met = np.bincount(codes, minlength=len(groups))
    met[: len(aligner.met)] += aligner.met
    aligner.met = met
    doc = np.repeat(np.arange(len(own)), [len(x) for x in own])
    counts = np.frombuffer(aligner.counts, np.int64).reshape(-1, 4)
    first, links = np.frombuffer(aligner.first, np.int64), np.frombuffer(aligner.links, np.uint32)
    totals = np.zeros((len(own), 4), np.int64)
    np.add.at(totals, doc, counts[codes])
    length = first[codes + 1] - first[codes]
    key = links[ranges(first[codes], length)].astype(np.int64) << 32 | np.repeat(doc, length)
    record, times = np.unique(key, return_counts=True)
    pair, own_doc = record >> 32, record & 0xFFFFFFFF
    head = np.flatnonzero(np.diff(pair, prepend=-1))
    pairs = pair[head]
    sums = np.add.reduceat(times, head) if len(head) else times
    numbers = {n: totals[:, k].tolist() for k, n in enumerate(_NUMBERS)}
    numbers["groups_sha256"] = [hashlib.sha256(";".join([groups[k] for k in x]).encode()).hexdigest() if x else "" for x in own]
    order, begin = radix_order(pairs, radix)
    parts = [(r, pack_blocks(pairs[order[a:b]], sums[order[a:b]])) for r, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)) if a < b]
    return numbers, pack_blocks(pair, own_doc, times), parts


def merge_runs(runs: list[bytes]):
    """Sorted (pairs, totals) of several runs: a heap holds the head of every
    run's next block; what lies before all heads is summed and given out."""
    sources = [unpack_blocks(r, 2) for r in runs]
    heap = []

    def pull(k: int) -> None:
        block = next(sources[k], None)
        if block is not None:
            heapq.heappush(heap, (int(block[0][0]), k, block))

    for k in range(len(sources)):
        pull(k)
    held_pairs, held_sums = [], []
    while heap:
        _, k, (pairs, sums) = heapq.heappop(heap)
        held_pairs.append(pairs)
        held_sums.append(sums)
        pull(k)
        if heap and len(held_pairs) < len(runs):
            continue
        pairs, at = np.unique(np.concatenate(held_pairs), return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, at, np.concatenate(held_sums))
        done = int(np.searchsorted(pairs, heap[0][0])) if heap else len(pairs)
        if done:
            yield pairs[:done], sums[:done]
        held_pairs, held_sums = ([pairs[done:]], [sums[done:]]) if done < len(pairs) else ([], [])


def _merged(runs: list[bytes]) -> list[np.ndarray]:
    blocks = list(merge_runs(runs))
    return [np.concatenate(c) for c in zip(*blocks, strict=True)]


def _merge_group(key, group):
    import pyarrow as pa

    pairs, sums = _merged([x.as_py() for x in group.column("totals")])
    return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "slice": pa.array([key[1].as_py()], pa.int64()), "totals": pa.array([pack_blocks(pairs, sums)], pa.binary())})


def mark_best(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id (pairs sorted)."""
    b = pairs >> 16
    head = np.flatnonzero(np.diff(b, prepend=-1))
    return counts == np.repeat(np.maximum.reduceat(counts, head), np.diff(np.append(head, len(b))))


def _give_back(key, runs, counted):
    """Counts and best marks of the pairs of every run of a slice."""
    import pyarrow as pa

    pairs, counts = whole(counted.column("totals")[0].as_py(), 2)
    best = mark_best(pairs, counts)
    out = []
    for data in runs.column("totals"):
        at = np.searchsorted(pairs, whole(data.as_py(), 2)[0])
        out.append(pack_blocks(np.arange(len(at)), counts[at], best[at].astype(np.int64)))
    return pa.table({"run": runs.column("run").cast(pa.int64()), "radix": runs.column("radix").cast(pa.int32()), "counts": pa.array(out, pa.binary())})


def _finisher(radix: int, names: list[str], types: list):
    """Sums for the documents of a run."""
    import pyarrow as pa

    def finish(key, run, back):
        pair, doc, times = whole(run.column("records")[0].as_py(), 3)
        head = np.flatnonzero(np.diff(pair, prepend=-1))
        order, begin = radix_order(pair[head], radix)
        counts, best = np.zeros(len(head), np.int64), np.zeros(len(head), np.int64)
        for r, data in zip(back.column("radix").to_pylist(), back.column("counts").to_pylist(), strict=True):
            places = order[begin[r] : begin[r + 1]]
            _, counts[places], best[places] = whole(data, 3)
        of_record = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(pair))))
        docs = run.column("docs").combine_chunks().flatten()
        sums = np.zeros((2, len(docs)), np.int64)
        np.add.at(sums[0], doc, times * best[of_record])
        np.add.at(sums[1], doc, times * counts[of_record])
        cols = [docs.field(n) for n in names[:-2]] + [pa.array(sums[0]), pa.array(sums[1])]
        return pa.table([c.cast(t) for c, t in zip(cols, types, strict=True)], names=names)

    return finish


def default_models() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def make_runs(docs: DataFrame, models: tuple[str, str] | None = None, radix: int = RADIX) -> DataFrame:
    """``run, docs, records, parts`` (radix and totals) of the documents; a map
    that shuffles nothing."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    a_path, b_path = models or default_models()
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        held = docs.sparkSession.sparkContext.broadcast(Loaded(Aligner, a.read(), b.read()))
    doc = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(n, T.LongType()) for n in _NUMBERS), T.StructField("groups_sha256", T.StringType())])
    part = T.StructType([T.StructField("radix", T.IntegerType()), T.StructField("totals", T.BinaryType())])
    schema = T.StructType([T.StructField("run", T.LongType()), T.StructField("docs", T.ArrayType(doc)), T.StructField("records", T.BinaryType()), T.StructField("parts", T.ArrayType(part))])
    arrow = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        aligner, number = held.value.get(), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for low, high in slices([len(t or "") for t in texts], RUN_CHARS):
                numbers, records, parts = make_run(aligner, texts[low:high], radix)
                rows = [{"doc_id": i, **dict(zip(numbers, v, strict=True))} for i, v in zip(ids[low:high], zip(*numbers.values(), strict=True), strict=True)]
                made = [[number], [rows], [records], [[{"radix": r, "totals": t} for r, t in parts]]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, arrow, strict=True)], names=schema.names)
                number += 1

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def count_pairs(totals: DataFrame, slices_: int, fan: int = FAN) -> DataFrame:
    """``radix, slice, totals``: one row for each radix, all runs merged."""
    schema = "radix int, slice long, totals binary"
    merged = totals.select("radix", "slice", "totals")
    while True:
        merged = materialize(merged.groupBy("radix", "slice").applyInArrow(_merge_group, schema), "merged")
        if slices_ == 1:
            return merged
        slices_ = -(-slices_ // fan)
        merged = merged.withColumn("slice", F.pmod("slice", F.lit(slices_)))


def pair_counts(runs: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame, int]:
    """(totals of every run by radix and slice, counts by radix, slices)."""
    parts = -(-runs.count() // fan) or 1
    totals = runs.select("run", F.pmod(F.xxhash64("run"), F.lit(parts)).alias("slice"), F.explode("parts").alias("p")).select("run", "slice", "p.radix", "p.totals")
    return totals, count_pairs(totals, parts, fan), parts


def align_documents(docs: DataFrame, models: tuple[str, str] | None = None, radix: int = RADIX, fan: int = FAN) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best,
    count_sum`` of every document."""
    from pyspark.sql.pandas.types import to_arrow_type

    runs = materialize(make_runs(docs, models, radix), "runs")
    totals, counted, parts = pair_counts(runs, fan)
    every = counted.select("radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("slice"), "totals")
    back = totals.groupBy("radix", "slice").cogroup(every.groupBy("radix", "slice")).applyInArrow(_quiet(_give_back), "run long, radix int, counts binary")
    doc = runs.schema["docs"].dataType.elementType
    schema = T.StructType([*doc.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    finish = _finisher(radix, schema.names, [to_arrow_type(f.dataType) for f in schema.fields])
    return runs.select("run", "docs", "records").groupBy("run").cogroup(back.groupBy("run")).applyInArrow(finish, schema)


def _quiet(give_back):
    """A slice may hold no run of some radix."""
    import pyarrow as pa

    none = pa.table({"run": pa.array([], pa.int64()), "radix": pa.array([], pa.int32()), "counts": pa.array([], pa.binary())})
    return lambda key, runs, counted: give_back(key, runs, counted) if runs.num_rows else none


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents")).select("doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256")
