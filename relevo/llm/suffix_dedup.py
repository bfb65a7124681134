"""Exact removal of repeated 50-byte strings by hash-compared suffix sorting
(operator 4).

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document of a smaller id.  The strings (windows) of the whole table are far
too many to sort, so they are first narrowed down without losing any:

1. Documents are dealt to shards by a hash.  A window's key is the least hash
   of its ``GRAM``-byte substrings; equal windows have equal keys, and some 15
   neighbouring windows share one.  Each shard sends the tags of its distinct
   keys to buckets, which answer with one bit for each: held by other shards
   too, or not.
2. For the keys that are shared, a shard sends the stretches of text under
   them (windows of one key that stand together), each distinct one once with
   its least document, to the buckets of the keys.  A key held by very many
   shards sends its windows one by one, dealt by their own hash, so that no
   bucket grows with a passage that is everywhere.
3. A bucket sorts the windows of the keys that have several different
   stretches: a mergesort whose comparisons find the common extension of two
   suffixes by binary search over prefix polynomial hashes.  Neighbours that
   the hashes call equal are verified byte by byte.  Each window gets the least
   document that holds it, and the shards get one bit for each window they sent.
4. Shards mark the covered bytes and cut them out.

All three visits of the documents read one shuffle of them.

Defined results: null texts are empty; texts below 50 bytes lose nothing but
lend nothing either; null ids count as the least; rows of one id don't remove
each other's bytes; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.llm.common import mix64, ranges, table

NAME = "op4_suffix_dedup"
ORACLE_SQL = None
LENGTH, GRAM = 50, 20
#: Text bytes of a shard, and of the text that a bucket answers for.
SHARD_BYTES, BUCKET_BYTES = 2 << 20, 3 << 20
#: Window starts that are hashed at once, windows of a stretch at most,
#: windows that are sorted at once.
PIECE, RUN, SORTED = 1 << 19, 64, 1 << 18
#: Shards that make a key one that is everywhere.
EVERYWHERE = 256

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


class Hashes:
    """Prefix polynomial hashes of a byte array, modulo 2**64."""

    _up = _down = np.zeros(0, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Hashes._up) < n:
            Hashes._up, Hashes._down = _powers(_BASE, n), _powers(_INVERSE, n)
        self.prefix = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * Hashes._up[: n - 1], out=self.prefix[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * Hashes._down[start]

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all substrings of a size."""
        n = max(0, len(self.prefix) - size)
        return (self.prefix[size : size + n] - self.prefix[:n]) * Hashes._down[:n]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, n = 1, len(x) - width + 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n])


class Shard:
    """Documents in the order of their ids, and the stretches of their
    windows: ``start`` in the joined bytes, ``count`` of windows, ``doc``
    (place in the order) and ``key``."""

    def __init__(self, ids: list, texts: list):
        ids = [-(1 << 63) if i is None else i for i in ids]
        texts = [t or b"" for t in texts]
        self.order = sorted(range(len(ids)), key=lambda k: (ids[k], texts[k]))
        self.ids = np.array([ids[k] for k in self.order], np.int64)
        sizes = np.array([len(texts[k]) for k in self.order], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.bytes = b"".join(texts[k] for k in self.order)
        self.data = np.frombuffer(self.bytes, np.uint8)
        found: list = []
        for a in range(0, max(0, len(self.data) - LENGTH + 1), PIECE):
            part = self.data[a : a + PIECE + LENGTH - 1]
            keys = _sliding_min(mix64(Hashes(part).grams(GRAM)), LENGTH - GRAM + 1)
            cut = np.ones(len(keys), bool)
            np.not_equal(keys[1:], keys[:-1], out=cut[1:])
            lo, hi = np.searchsorted(self.bounds, [a, a + len(keys)])
            cut[self.bounds[lo:hi] - a] = True
            first = np.flatnonzero(cut)
            count = np.diff(np.append(first, len(keys)))
            if count.max() > RUN:  # the same key on and on: parts of RUN windows
                parts = -(-count // RUN)
                at = ranges(np.zeros(len(parts), np.int64), parts)
                first, count = np.repeat(first, parts) + at * RUN, np.minimum(RUN, np.repeat(count, parts) - at * RUN)
            # windows that leave their document are the last ones of a stretch
            docs = np.searchsorted(self.bounds, first + a, side="right") - 1
            count = np.minimum(count, self.bounds[docs + 1] - (first + a + LENGTH - 1))
            keep = count > 0
            found.append((first[keep] + a, count[keep], docs[keep], keys[first[keep]]))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
        self.start, self.count, self.doc, self.key = cols
        self.tag, self.bucket_hash = _tag(self.key)

    def pairs(self, buckets: int) -> np.ndarray:
        """Bucket and tag of every stretch."""
        return (self.bucket_hash % np.uint64(buckets) << np.uint64(32)) | self.tag

    def tags(self, buckets: int) -> np.ndarray:
        """Sorted distinct pairs of bucket and tag."""
        pairs = np.sort(self.pairs(buckets))
        return pairs[_heads(pairs)]

    def stretches(self, buckets: int, replies: pa.Table) -> Stretches:
        """The stretches to compare with other documents."""
        pairs = self.pairs(buckets)
        shared, everywhere = np.zeros(len(pairs), bool), np.zeros(len(pairs), bool)
        order = np.argsort(pairs)
        p = pairs[order]
        head = _heads(p)
        times = np.diff(np.append(head, len(p)))
        told = np.zeros((2, len(head)), bool)  # of each distinct pair, as the buckets were asked
        for out, column in zip(told, ("bits", "more"), strict=True):
            _read_bits(out, replies, column, *_by_bucket(p[head]))
        if len(p):  # keys of several documents of this shard
            d = self.ids[self.doc[order]]
            told[0] |= np.maximum.reduceat(d, head) > np.minimum.reduceat(d, head)
        shared[order], everywhere[order] = np.repeat(told[0], times), np.repeat(told[1], times)
        hashes = Hashes(self.data)
        k, e = np.flatnonzero(shared & ~everywhere), np.flatnonzero(shared & everywhere)
        # windows of a key that is everywhere stand alone, dealt by their own hash
        single = ranges(self.start[e], self.count[e])
        tag, pick = _tag(hashes.of(single, LENGTH))
        start = np.concatenate([self.start[k], single])
        size = np.concatenate([self.count[k] + LENGTH - 1, np.full(len(single), LENGTH, np.int64)])
        doc = self.ids[np.concatenate([self.doc[k], np.repeat(self.doc[e], self.count[e])])]
        pairs = np.concatenate([pairs[k], (pick % np.uint64(buckets) << np.uint64(32)) | tag])
        return Stretches(self.data, hashes, start, size, doc, pairs)

    def cut(self, buckets: int, replies: pa.Table, answers: pa.Table) -> tuple[list, list]:
        """Removed spans and kept bytes of each document, in the table's order."""
        s = self.stretches(buckets, replies)
        flags = np.zeros(int(s.windows.sum()), bool)
        bucket, low, high = s.by_bucket()
        _read_bits(flags, answers, "bits", bucket, s.offset[low], np.append(s.offset, len(flags))[high])
        n = len(self.data) + 1
        # a smaller document of this shard has the whole stretch
        later = s.doc > s.least[s.unique]
        begins, ends = [s.start[later]], [s.start[later] + s.size[later]]
        first = np.flatnonzero(~later)
        windows = s.windows[s.unique[first]]
        at = ranges(s.start[first], windows)[flags[ranges(s.offset[s.unique[first]], windows)]]
        begins.append(at), ends.append(at + LENGTH)
        depth = np.bincount(np.concatenate(begins), minlength=n) - np.bincount(np.concatenate(ends), minlength=n)
        covered = np.cumsum(depth[:-1]) > 0
        spans: list = [[] for _ in self.order]
        kept: list = [b""] * len(self.order)
        for k, row in enumerate(self.order):
            a, b = self.bounds[k], self.bounds[k + 1]
            own = covered[a:b]
            if own.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))).reshape(-1, 2)
                spans[row] = [{"start": int(x), "end": int(y)} for x, y in edge]
                kept[row] = self.data[a:b][~own].tobytes()
            else:
                kept[row] = self.bytes[a:b]
        return spans, kept


class Stretches:
    """Pieces of a byte array (``start, size, doc`` and ``pairs``: bucket and
    tag), and the distinct ones among them: ``unique`` tells each piece's, and
    ``first`` (a piece), ``least`` document, ``windows`` and ``offset`` of the
    first window describe them, in the order of their pairs."""

    def __init__(self, data, hashes, start, size, doc, pairs):
        self.data, self.start, self.size, self.doc, self.pairs = data, start, size, doc, pairs
        name = mix64(pairs ^ mix64(hashes.of(start, size) + size.astype(np.uint64)))
        _, first, same = np.unique(name, return_index=True, return_inverse=True)
        rep = first[same]
        wrong = ~_equal(data, start, size, start[rep], size[rep]) | (pairs != pairs[rep])
        if wrong.any():  # equal hashes of different bytes: pieces of their own
            rep = np.where(wrong, np.arange(len(rep)), rep)
            first, same = np.unique(rep, return_inverse=True)
        order = np.argsort(pairs[first], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.first, self.unique = first[order], place[same]
        self.least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.unique, doc)
        self.windows = size[self.first] - LENGTH + 1
        self.offset = np.cumsum(self.windows) - self.windows

    def by_bucket(self):
        """(buckets, lows, highs): the distinct pieces of each bucket."""
        return _by_bucket(self.pairs[self.first])


def _heads(x: np.ndarray) -> np.ndarray:
    """Places where a run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _by_bucket(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, lows, highs) of sorted pairs."""
    bucket = (pairs >> np.uint64(32)).astype(np.int64)
    low = _heads(bucket)
    return bucket[low], low, np.append(low, len(bucket))[1:]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of an array's parts, which end at ``ends``, a row each."""
    data, ends = np.ascontiguousarray(data), np.concatenate([[0], ends]) * data.itemsize
    if ends[-1] > np.iinfo(np.int32).max:
        return pa.array([data.view(np.uint8)[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _joined(column: pa.ChunkedArray, kind=np.uint8) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in all rows of a binary column, and how many each row has."""
    sizes = pc.binary_length(column).to_numpy().astype(np.int64)
    parts = []
    for c in column.chunks:
        width = np.int64 if pa.types.is_large_binary(c.type) else np.int32
        edges = np.frombuffer(c.buffers()[1], width)[c.offset : c.offset + len(c) + 1] if len(c) else [0]
        if edges[0] < edges[-1]:
            parts.append(np.frombuffer(c.buffers()[2], np.uint8)[edges[0] : edges[-1]])
    data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return data.view(kind), sizes // np.dtype(kind).itemsize


def _packed(flags: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Flags as bits, ``counts`` of them a row; a row begins with a byte."""
    size = -(-counts // 8)
    ends = np.cumsum(size)
    bits = np.zeros(8 * int(size.sum()), bool)
    bits[ranges(8 * (ends - size), counts)] = flags
    return _binary(np.packbits(bits), ends)


def _read_bits(out: np.ndarray, replies: pa.Table, column: str, bucket: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    """Set the flags of each bucket's places (low to high) by its reply; an
    empty one sets none."""
    data, sizes = _joined(replies.column(column))
    at = np.searchsorted(bucket, replies.column("bucket").to_numpy())
    counts = np.where(sizes > 0, high[at] - low[at], 0)
    out[ranges(low[at], counts)] = np.unpackbits(data)[ranges(8 * (np.cumsum(sizes) - sizes), counts)]


def _equal(data: np.ndarray, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, piece: int = 1 << 16) -> np.ndarray:
    """Whether two pieces hold the same bytes, pair by pair."""
    out = n == m
    todo = np.flatnonzero(out & (a != b))
    for i in range(0, len(todo), piece):
        k = todo[i : i + piece]
        differ = data[ranges(a[k], n[k])] != data[ranges(b[k], n[k])]
        head = np.cumsum(n[k]) - n[k]
        out[k] = ~np.logical_or.reduceat(differ, head)
    return out


def _tag(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32 bits that name a key in its bucket, and a number that picks it."""
    x = mix64(key + np.uint64(0xD1B54A32D192ED03))
    return x & np.uint64(0xFFFFFFFF), x >> np.uint64(32)


def common_extension(hashes: Hashes, a: np.ndarray, b: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Length of the common beginning, up to ``most``, of the suffixes at a
    and b, by binary search over their hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), most)
    while True:
        todo = low < high
        if not todo.any():
            return low
        mid = (low + high + 1) // 2
        same = hashes.of(a, mid) == hashes.of(b, mid)
        low, high = np.where(todo & same, mid, low), np.where(todo & ~same, mid - 1, high)


def sort_windows(data: np.ndarray, hashes: Hashes, start: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of windows (their places in the arrays) by group, then by their
    bytes: bottom-up mergesort of all groups at once."""
    n = len(start)
    order = np.argsort(group, kind="stable")
    g = group[order]
    head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    size = np.diff(np.append(head, n))
    base, size = np.repeat(head, size), np.repeat(size, size)
    offset = np.arange(n) - base
    # the first eight bytes decide most comparisons, and the hash of all bytes
    # those of equal windows
    lead, whole = _words(data)[start].byteswap(), hashes.of(start, LENGTH)

    def before(x, y, equal_too):
        """Whether window x sorts before y (or is equal)."""
        less = lead[x] < lead[y]
        tie = np.flatnonzero(lead[x] == lead[y])
        if len(tie):
            x, y = x[tie], y[tie]
            less[tie] = equal_too[tie]
            k = np.flatnonzero(whole[x] != whole[y])
            a, b = start[x[k]], start[y[k]]
            at = np.minimum(common_extension(hashes, a, b), LENGTH - 1)
            less[tie[k]] = data[a + at] < data[b + at]
        return less

    width = 1
    while width < (size.max() if n else 0):
        run = offset // width
        sib = run ^ 1
        low = np.minimum(sib * width, size) + base
        high = np.minimum(sib * width + width, size) + base
        begin = low.copy()
        right = (run & 1).astype(bool)
        todo = np.flatnonzero(low < high)
        while len(todo):
            mid = (low[todo] + high[todo]) // 2
            # count of the sibling's windows that stand before this one
            ahead = before(order[mid], order[todo], right[todo])
            low[todo[ahead]], high[todo[~ahead]] = mid[ahead] + 1, mid[~ahead]
            todo = todo[low[todo] < high[todo]]
        place = base + np.minimum(run, sib) * width + offset % width + (low - begin)
        merged = np.empty_like(order)
        merged[place] = order
        order = merged
        width *= 2
    return order


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number."""
    return np.ndarray(max(0, len(data) - 7), "<u8", np.ascontiguousarray(data), strides=(1,))


def _repeated(x: np.ndarray) -> np.ndarray:
    """Whether a value is there more than once."""
    order = np.argsort(x)
    y = x[order]
    same = y[1:] == y[:-1]
    out = np.zeros(len(x), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def least_documents(data: np.ndarray, hashes: Hashes, start: np.ndarray, size: np.ndarray, doc: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """For every window of distinct stretches (in the order of their tags),
    the least of the documents of the stretches that hold it, within a tag."""
    counts, words = size - LENGTH + 1, _words(data)
    out: list = [np.zeros(0, np.int64)]
    # whole tags, about SORTED windows at once
    edge = np.flatnonzero(np.concatenate([[True], tag[1:] != tag[:-1]])) if len(tag) else np.zeros(0, np.int64)
    ahead = np.cumsum(counts) - counts
    lo = 0
    while lo < len(tag):
        wanted = np.searchsorted(ahead, ahead[lo] + SORTED)
        after = edge[np.searchsorted(edge, max(wanted, lo + 1)) :]
        hi = int(after[0]) if len(after) else len(tag)
        part = slice(lo, hi)
        every = ranges(start[part], counts[part])
        owner = np.repeat(np.arange(lo, hi), counts[part])
        found = doc[owner]
        # equal windows have equal hashes: one whose hash is alone has no equal
        again = np.flatnonzero(_repeated(mix64(tag[owner].astype(np.uint64)) ^ hashes.of(every, LENGTH)))
        at, group, least = every[again], tag[owner[again]], found[again]
        order = sort_windows(data, hashes, at, group)
        a, b = at[order[:-1]], at[order[1:]]
        same = (group[order[:-1]] == group[order[1:]]) & (hashes.of(a, LENGTH) == hashes.of(b, LENGTH))
        a, b, wrong = a[same], b[same], False
        for offset in (*range(0, LENGTH - 8, 8), LENGTH - 8):  # what the hashes call equal, eight bytes at a time
            wrong = wrong or bool((words[a + offset] != words[b + offset]).any())
        if wrong:
            keys = [(g, data[w : w + LENGTH].tobytes()) for g, w in zip(group.tolist(), at.tolist(), strict=True)]
            exact: dict = {}
            for key, d in zip(keys, least.tolist(), strict=True):
                exact[key] = min(d, exact.get(key, d))
            least = np.array([exact[key] for key in keys], np.int64)
        elif len(order):
            head = np.flatnonzero(np.concatenate([[True], ~same]))
            run_least = np.minimum.reduceat(least[order], head)
            least[order] = np.repeat(run_least, np.diff(np.append(head, len(order))))
        found[again] = least
        out.append(found)
        lo = hi
    return np.concatenate(out)


def _table(schema, **columns) -> pa.Table:
    cast = lambda v, t: v.cast(t) if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, t)
    return pa.table({n: cast(v, t) for (n, t), v in zip(schema, columns.values(), strict=True)})


_TAGS = [("bucket", pa.int64()), ("shard", pa.int64()), ("tags", pa.binary())]
_SENT = [("bucket", pa.int64()), ("shard", pa.int64()), ("tags", pa.binary()), ("docs", pa.binary()), ("sizes", pa.binary()), ("text", pa.binary())]
_REPLY = [("shard", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("bits", pa.binary()), ("more", pa.binary())]
_CUT = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]


def _shard(t: pa.Table) -> Shard:
    return Shard(t.column("doc_id").to_pylist(), t.column("text").cast(pa.binary()).to_pylist())


def _replies(t: pa.Table, kind: int) -> pa.Table:
    return t.filter(pc.equal(t.column("kind"), kind))


def _send_tags(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        pairs = _shard(t).tags(buckets)
        bucket, _, high = _by_bucket(pairs)
        return _table(_TAGS, bucket=bucket, shard=[t.column("shard")[0].as_py()] * len(bucket), tags=_binary(pairs.astype(np.uint32), high))

    return run


def _answer_tags(t: pa.Table) -> pa.Table:
    tags, counts = _joined(t.column("tags"), np.uint32)
    order = np.argsort(tags)
    head = _heads(tags[order])
    times = np.empty(len(tags), np.int64)
    times[order] = np.repeat(np.diff(np.append(head, len(tags))), np.diff(np.append(head, len(tags))))
    many, row = times > EVERYWHERE, np.repeat(np.arange(len(counts)), counts)
    several = np.bincount(row[many], minlength=len(counts)) > 0
    more = _packed(many[several[row]], np.where(several, counts, 0))
    return _table(_REPLY, shard=t.column("shard"), bucket=t.column("bucket"), kind=[1] * len(counts), bits=_packed(times > 1, counts), more=more)


def _send_stretches(buckets: int):
    def run(t: pa.Table, replies: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _table(_SENT, bucket=[], shard=[], tags=[], docs=[], sizes=[], text=[])
        s = _shard(t).stretches(buckets, _replies(replies, 1))
        size = s.size[s.first]
        bucket, _, high = s.by_bucket()
        return _table(
            _SENT,
            bucket=bucket,
            shard=[t.column("shard")[0].as_py()] * len(bucket),
            tags=_binary(s.pairs[s.first].astype(np.uint32), high),
            docs=_binary(s.least, high),
            sizes=_binary(size.astype(np.int32), high),
            text=_binary(s.data[ranges(s.start[s.first], size)], np.concatenate([[0], np.cumsum(size)])[high]),
        )

    return run


def _answer_stretches(t: pa.Table) -> pa.Table:
    data, _ = _joined(t.column("text"))
    tag, _ = _joined(t.column("tags"), np.uint32)
    doc, counts = _joined(t.column("docs"), np.int64)
    size = _joined(t.column("sizes"), np.int32)[0].astype(np.int64)
    start, hashes = np.cumsum(size) - size, Hashes(data)
    s = Stretches(data, hashes, start, size, doc, tag.astype(np.uint64))
    own = s.pairs[s.first]
    # tags of several different stretches: their windows are sorted
    head = _heads(own)
    several = np.repeat(np.diff(np.append(head, len(own))) > 1, np.diff(np.append(head, len(own))))
    least = np.repeat(s.least, s.windows)
    k = np.flatnonzero(several)
    least[ranges(s.offset[k], s.windows[k])] = least_documents(data, hashes, start[s.first[k]], size[s.first[k]], s.least[k], own[k])
    windows = s.windows[s.unique]
    flags = least[ranges(s.offset[s.unique], windows)] < np.repeat(doc, windows)
    ends = np.concatenate([[0], np.cumsum(windows)])[np.cumsum(counts)]
    bits = _packed(flags, np.diff(ends, prepend=0))
    return _table(_REPLY, shard=t.column("shard"), bucket=t.column("bucket"), kind=[2] * len(counts), bits=bits, more=[b""] * len(counts))


def _cut_shards(buckets: int):
    def run(t: pa.Table, replies: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _table(_CUT, doc_id=[], n_bytes=[], spans=[], kept=[])
        spans, kept = _shard(t).cut(buckets, _replies(replies, 1), _replies(replies, 2))
        sizes = [k_len + sum(s["end"] - s["start"] for s in ss) for k_len, ss in zip(map(len, kept), spans, strict=True)]
        return _table(_CUT, doc_id=t.column("doc_id").to_pylist(), n_bytes=sizes, spans=spans, kept=kept)

    return run


def cut_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row: the removed spans (in
    bytes, [start, end)) and the remaining bytes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, buckets = math.ceil(total / shard_bytes) or 1, math.ceil(total / bucket_bytes) or 1
    own = docs.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards))).repartition("shard")
    reply = "shard long, bucket long, kind int, bits binary, more binary"
    tags = own.groupBy("shard").applyInArrow(_send_tags(buckets), "bucket long, shard long, tags binary")
    first = tags.groupBy("bucket").applyInArrow(_answer_tags, reply)
    sent = own.groupBy("shard").cogroup(first.groupBy("shard")).applyInArrow(_send_stretches(buckets), "bucket long, shard long, tags binary, docs binary, sizes binary, text binary")
    second = sent.groupBy("bucket").applyInArrow(_answer_stretches, reply)
    answers = first.unionByName(second)
    return own.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_cut_shards(buckets), "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cut_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
