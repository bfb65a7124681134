"""Best-fit packing of documents into sequences of bounded length by
bound-certified repacking (operator 13).

Every document is encoded whole (with an end id); one longer than a sequence is
cut into pieces of the sequence's length and a rest.  The pieces, five numbers
each, are dealt at random over partitions of about ``PARTITION_PIECES``.  A
partition packs its own by best-fit decreasing and certifies the number of its
sequences by lower bounds from dual feasible functions.  A partition that
reaches its bound is done, but for its emptiest sequence, as the bound is
rounded up once a partition.  A partition with a gap keeps its full sequences.
What is left of all partitions is dealt anew, so the documents change places
among them, and packed again, until one partition holds all that is left or a
round saves no sequence any more.

Dual feasible functions: the share of the length, 1 for lengths above C - a and
0 for those below a (all a), and the staircases of k steps after these.

Defined results: null and empty texts are a piece of the end id alone; repeated
rows and null ids are documents of their own; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read, so further columns can't clash.
Which documents meet depends on the rows' places in the input only.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relevo.llm.common import ranges, table
from relevo.llm.word_cache import Loaded, slices
from relevo.session import materialize

NAME = "op13_best_fit_packing"
ORACLE_SQL = None
CAPACITY, END_ID = 2048, 0
PARTITION_PIECES = 32_768
#: Steps of the staircases among the dual feasible functions.
STAIRS = 60
#: Words that a Python worker remembers.
KNOWN_WORDS = 400_000
#: Plain letters and signs (no apostrophe): the tokenizer parts them wherever
#: they meet, as it parts words at blanks.
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"


class WordEncoder:
    """Encodes texts word by word; word number k of those met before has the
    ids from ``first[k]`` to ``first[k + 1]``."""

    def __init__(self, json_text: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json_text)
        vocabulary = self.tokenizer.get_vocab()
        #: whether an id ends a run of letters or signs
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def add(self, words: list[str], plain: np.ndarray) -> None:
        """``plain``: the word is one run of letters or of signs.  These are
        encoded as one text, which their last ids cut again."""
        one = [w for w, p in zip(words, plain, strict=True) if p]
        rest = [w for w, p in zip(words, plain, strict=True) if not p]
        ids = np.array(self.tokenizer.encode(" ".join(one), add_special_tokens=False).ids if one else [], np.uint32)
        length = np.diff(np.flatnonzero(self.ends[ids]) + 1, prepend=0)
        if len(length) != len(one):
            raise ValueError("the tokenizer has no mark at the end of a word")
        more = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        self.known.update(zip(one + rest, range(len(self.first) - 1, len(self.first) - 1 + len(words)), strict=True))
        self.ids = np.concatenate([self.ids, ids, *(np.array(x, np.uint32) for x in more)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate([length, [len(x) for x in more]]).astype(np.int64))])

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text begins and the last ends) of an
        Arrow array of texts without nulls."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.first) > KNOWN_WORDS:
            self.reset()
        parted = pc.replace_substring_regex(pc.ascii_lower(texts), pattern=f"([{_LETTERS}])([{_SIGNS}])", replacement=r"\1 \2")
        words = pc.split_pattern_regex(parted, pattern=r"[ \t\n\r]+")
        coded = words.flatten().dictionary_encode()
        met = coded.dictionary.to_pylist()
        get = self.known.get
        number = np.array([get(w, -1) for w in met], np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            unknown = coded.dictionary.take(pa.array(new))
            plain = pc.match_substring_regex(unknown, f"^(?:[{_LETTERS}]+|[{_SIGNS}]+)$").to_numpy(zero_copy_only=False)
            unknown = unknown.to_pylist()
            self.add(unknown, plain)
            number[new] = [self.known[w] for w in unknown]
        number = number[coded.indices.to_numpy()]
        length = self.first[number + 1] - self.first[number]
        begin = np.concatenate([[0], np.cumsum(length)])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return self.ids[ranges(self.first[number], length)], begin


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every
    piece.  A map over the documents; nothing is shuffled."""
    import pyarrow as pa
    import pyarrow.compute as pc

    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(Loaded(WordEncoder, f.read()))
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity
    id_type = docs.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", id_type), *(T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32"))]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if with_ids else []

    def run(batches):
        encoder = held.value.get()
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for low, high in slices(pc.binary_length(texts).to_pylist()):
                encoded, begin = encoder.encode(texts.slice(low, high - low))
                data, begin = encoded.astype("<u4").tobytes(), (4 * begin).tolist()
                row, piece, length, crc, ids = [], [], [], [], []
                for r in range(high - low):
                    own = data[begin[r] : begin[r + 1]] + end
                    for k, at in enumerate(range(0, len(own), step)):
                        cut = own[at : at + step]
                        row.append(low + r)
                        piece.append(k)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        if with_ids:
                            ids.append(np.frombuffer(cut, "<u4").astype(np.int32))
                number = np.array(piece, np.int64)
                cols = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number), pa.array(number * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(fields))


def lower_bound(lengths, capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs at least: the best of the dual
    feasible functions, in whole numbers."""
    counts = np.bincount(np.asarray(lengths, np.int64), minlength=capacity + 1)
    x = np.arange(capacity + 1, dtype=np.int64)
    least = np.arange(0, capacity // 2 + 1)  # a; a = 0 leaves all lengths as they are
    up_to = np.cumsum(counts)
    large = up_to[-1] - up_to[capacity - least]

    def between(values):
        """Sum over the lengths from a to C - a, for every a."""
        mass = np.concatenate([[0], np.cumsum(counts * values)])
        return mass[capacity - least + 1] - mass[least]

    best = int((large + -(-between(x) // capacity)).max())
    for k in range(2, STAIRS + 1):
        stairs = np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity)  # in parts of k * C
        best = max(best, int((large + -(-between(stairs) // (k * capacity))).max()))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of every length and the free places of the
    sequences.  A set bit of ``open_`` says that some sequence has that much
    free, so the tightest fit is its lowest bit from the length on."""
    which, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = open_ >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_free[room].pop()
            if not by_free[room]:
                open_ ^= 1 << room
        else:
            b, room = len(free), capacity
            free.append(capacity)
        which[i], offset[i] = b, capacity - room
        room -= n
        free[b] = room
        if room:
            by_free[room].append(b)
            open_ |= 1 << room
    return which, offset, np.array(free, np.int64)


def pack_partition(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset, whether it goes on to the next round) of a
    partition's pieces."""
    which, offset, free = best_fit_decreasing(lengths, capacity)
    goes = np.zeros(len(free), bool)
    if len(free) == lower_bound(lengths, capacity):  # certified
        goes[int(free.argmax())] = bool(free.max())
    else:
        goes = free > 0
    return which, offset, goes[which]


def _packer(names: list[str], capacity: int, number: int, last: bool):
    """The packing of one partition of a round, for ``applyInArrow``."""
    import pyarrow as pa

    def one(key, group):
        group = group.take(pa.array(np.argsort(group.column("_at").to_numpy(), kind="stable")))
        which, offset, goes = pack_partition(group.column("length").to_numpy(), capacity)
        cols = [group.column(c) for c in names[:-3]]
        cols += [pa.array(which + (number << 56) + (key[0].as_py() << 24)), pa.array(offset), pa.array(goes & (not last))]
        return pa.table(cols, names=names)

    return one


def pack(pieces: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """Rows with a ``length`` of 1 to ``capacity`` and their ``sequence_id``
    and ``offset``.  Rounds are written to the shared folder; the driver sees
    counts only."""
    columns = pieces.columns
    left = materialize(pieces.withColumn("_at", F.monotonically_increasing_id()), "pieces")
    schema = T.StructType([*left.schema.fields, *(T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")), T.StructField("_goes", T.BooleanType())])
    n, sequences, number, done = left.count(), None, 0, []
    while n:
        parts = -(-n // partition_pieces)
        dealt = left.withColumn("_part", F.pmod(F.xxhash64(F.lit(number), "_at"), F.lit(parts)))
        packed = materialize(dealt.groupBy("_part").applyInArrow(_packer(schema.names, capacity, number, parts == 1), schema), "packed")
        begins = F.col("offset") == 0
        made, n, goes_on = packed.agg(F.count_if(begins), F.count_if("_goes"), F.count_if(begins & F.col("_goes"))).first()
        if sequences is not None and made >= sequences:  # nothing saved: the round before stands
            done.append(before)
            break
        done.append(packed.filter("NOT _goes"))
        before, sequences, number = packed.filter("_goes"), goes_on, number + 1
        left = before.drop("sequence_id", "offset", "_goes")
    if not done:
        done = [left.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    return reduce(DataFrame.unionByName, [d.select(*columns, "sequence_id", "offset") for d in done])


def bound_of(pieces: DataFrame, capacity: int = CAPACITY) -> int:
    """The bound for a whole table: only its counts by length (at most
    ``capacity``) reach the driver."""
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    return lower_bound(np.repeat(np.array(list(counts), np.int64), list(counts.values())), capacity) if counts else 0


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place."""
    return pack(encode_pieces(docs, tokenizer, capacity, end_id, with_ids), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
