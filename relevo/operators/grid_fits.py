"""Logistic regressions, binary or multinomial, of all (collection, hash size,
fold, regularisation) cells at once.

The training rows are written once as blocks of a collection's sparse rows.  A
round goes through the blocks and gives, by one aggregate, loss and gradient of
every cell at the point that cell asks for; a row counts for the cells that did
not leave its fold out.  A block of a short hash size is unpacked to a matrix,
so that a product gives the margins of all its cells.  The points move on the driver, which holds what the
library's own fits hold there: some twenty vectors a cell, and those of a bounded
number of cells at a time.  Rounds are as many as the slowest cell needs, not as
many as there are cells.

Objective, standardisation and steps (orthant-wise limited-memory quasi-Newton)
are those of ``pyspark.ml.classification.LogisticRegression``, so a cell stops
where the library's fit of that cell does (``tests/test_grid_fits.py``).
"""

from __future__ import annotations

from collections.abc import Generator, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.operators.joins import attach_small
from relevo.session import materialize

#: Entries of a block, which is what a task holds unpacked at a time.
BLOCK_ENTRIES = 1 << 17
#: Hash sizes up to this one are unpacked, and the numbers of a matrix at most.
DENSE, MATRIX_NUMBERS = 1000, 1 << 21
#: Numbers in the sums that a group adds up, but for one cell's.
GROUP_NUMBERS = 1 << 15
#: Numbers in the points of the cells that are fitted at a time.
POINT_NUMBERS = 5 << 19
#: Steps that the quasi-Newton directions remember, and the stopping tolerance.
MEMORY, TOLERANCE = 10, 1e-6

_BLOCK = "collection_id string, num_features int, label binary, fold binary, starts binary, idx binary, tf binary, cols binary, col_starts binary, col_rows binary, col_tf binary"
_SUMS = "collection_id string, num_features int, cell int, head binary, sums binary"


def blocks(hashed: DataFrame, sizes: Sequence[int], tasks: int, deals: DataFrame) -> DataFrame:
    """Rows of ``hashed`` (``collection_id, label, fold, row, tf_<size>``) as
    blocks, by row and by index.  ``deals``: into how many parts
    (``collection_id, parts``) a collection's rows are dealt over the tasks."""
    import pyarrow as pa

    vectors = [F.unwrap_udt(f"tf_{n}")[field].alias(f"{field}_{n}") for n in sizes for field in ("indices", "values")]
    dealt = attach_small(hashed, deals, "collection_id").withColumn("_part", F.pmod(F.xxhash64("row"), "parts"))
    rows = dealt.repartition(tasks, "collection_id", "_part").sortWithinPartitions("collection_id")
    names = [field.split()[0] for field in _BLOCK.split(", ")]

    def run(batches):
        for batch in batches:
            for cid in batch.column("collection_id").unique().to_pylist():
                at = np.flatnonzero(np.array(batch.column("collection_id").to_pylist(), object) == cid)
                own = batch.take(pa.array(at))
                label, fold = own.column("label").to_numpy(), own.column("fold").to_numpy().astype(np.int32)
                for n in sizes:
                    found = own.column(f"indices_{n}")
                    idx, starts = found.flatten().to_numpy(), found.offsets.to_numpy().astype(np.int64)
                    tf, starts = own.column(f"values_{n}").flatten().to_numpy(), starts - starts[0]
                    cut = np.diff(starts[:-1] // BLOCK_ENTRIES, prepend=-1) != 0
                    if n <= DENSE:
                        cut[:: MATRIX_NUMBERS // n] = True
                    cuts = np.flatnonzero(cut).tolist()
                    for low, high in zip(cuts, [*cuts[1:], len(at)], strict=True):
                        i, v, s = idx[starts[low] : starts[high]], tf[starts[low] : starts[high]], starts[low : high + 1] - starts[low]
                        order = np.argsort(i, kind="stable")
                        cols, col_starts = np.unique(i[order], return_index=True)
                        col_rows = np.repeat(np.arange(high - low, dtype=np.int32), np.diff(s))[order]
                        arrays = [label[low:high].astype(np.float64), fold[low:high], s, i.astype(np.int32), v.astype(np.float32)]
                        if n <= DENSE:  # these are unpacked, not gone through by index
                            cols, col_starts, col_rows, order = cols[:0], col_starts[:0], col_rows[:0], order[:0]
                        arrays += [cols.astype(np.int32), col_starts.astype(np.int64), col_rows, v[order].astype(np.float32)]
                        yield pa.RecordBatch.from_arrays([pa.array([cid]), pa.array([n], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)], names=names)

    return materialize(rows.select("collection_id", "label", "fold", *vectors).mapInArrow(run, _BLOCK), "blocks")


def _summed(blocks_: DataFrame, of_block) -> DataFrame:
    """Sums by (collection, hash size, cell) of what ``of_block(row)`` yields:
    (cell, head numbers, (indices, numbers)); tasks sum their own first."""
    import pyarrow as pa

    names = [field.split()[0] for field in _SUMS.split(", ")]

    def table(found: dict):
        columns = [[k[j] for k in found] for j in range(3)]
        cols = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())]
        cols += [pa.array([v[j].tobytes() for v in found.values()], pa.binary()) for j in (0, 1)]
        return pa.RecordBatch.from_arrays(cols, names=names)

    def own(batches):
        found: dict = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("collection_id", "num_features")}
                row |= {c: np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in _KINDS.items()}
                for cell, head, (idx, numbers) in of_block(row):
                    key = row["collection_id"], row["num_features"], cell
                    if key not in found:
                        found[key] = np.zeros(len(head)), np.zeros((row["num_features"], *numbers.shape[1:]))
                    found[key][0][:] += head
                    found[key][1][idx] += numbers  # an index comes once a block
        if found:
            yield table(found)

    def total(key, group):
        found: dict = {}
        for cell, head, sums in zip(*(group.column(c) for c in names[2:]), strict=True):
            numbers = [np.frombuffer(x.as_buffer()) for x in (head, sums)]
            k = key[0].as_py(), key[1].as_py(), cell.as_py()
            found[k] = [a + b for a, b in zip(found[k], numbers, strict=True)] if k in found else numbers
        return pa.Table.from_batches([table(found)])

    # short vectors of several cells share a group, long ones have their own
    several = F.floor(F.col("cell") * F.col("num_features") / F.lit(GROUP_NUMBERS))
    return blocks_.mapInArrow(own, _SUMS).groupBy("collection_id", "num_features", several).applyInArrow(total, _SUMS)


_KINDS = {"label": np.float64, "fold": np.int32, "starts": np.int64, "idx": np.int32, "tf": np.float32, "cols": np.int32, "col_starts": np.int64, "col_rows": np.int32, "col_tf": np.float32}


def _numbers(df: DataFrame) -> Iterable[tuple]:
    """((collection, hash size, cell), head, sums) of every row."""
    for batch in df.toArrow().to_batches():
        for cid, n, cell, head, sums in zip(*(batch.column(c) for c in range(5)), strict=True):
            yield (cid.as_py(), n.as_py(), cell.as_py()), np.frombuffer(head.as_buffer()), np.frombuffer(sums.as_buffer())


def _of_units(blocks_: DataFrame, units: Iterable[tuple[str, int]]) -> DataFrame:
    """The blocks of the collections and hash sizes of ``units``."""
    cids, sizes = ({u[j] for u in units} for j in (0, 1))
    return blocks_.filter(F.col("collection_id").isin(sorted(cids)) & F.col("num_features").isin(sorted(sizes)))


def _statistics(blocks_: DataFrame) -> DataFrame:
    """Cell: a fold; sums: rows with the index, its frequencies and their
    squares."""

    def of_block(b):
        dense = _unpacked(b)
        for fold in np.unique(b["fold"]).tolist():
            if dense is not None:
                own = dense[b["fold"] == fold]
                yield fold, np.zeros(0), (slice(None), np.stack([(own != 0).sum(axis=0), own.sum(axis=0), (own * own).sum(axis=0)], axis=1))
                continue
            here = (b["fold"] == fold)[b["col_rows"]]
            tf = np.where(here, b["col_tf"], 0).astype(np.float64)
            sums = np.add.reduceat(np.stack([here.astype(np.float64), tf, tf * tf], axis=1), b["col_starts"], axis=0) if len(tf) else np.zeros((0, 3))
            yield fold, np.zeros(0), (b["cols"], sums)

    return _summed(blocks_, of_block)


def _unpacked(b: dict) -> np.ndarray | None:
    """The rows of a block as a matrix, if it isn't to be gone through by index."""
    if len(b["cols"]) or not len(b["idx"]):
        return None
    out = np.zeros((len(b["label"]), b["num_features"]))
    out[np.repeat(np.arange(len(out)), np.diff(b["starts"])), b["idx"]] = b["tf"]
    return out


def _sums_of_parts(at: np.ndarray, numbers: np.ndarray, factors: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of ``numbers[at] * factors`` over the parts that begin there."""
    out = np.empty((len(begins), numbers.shape[1]))
    for j in range(numbers.shape[1]):
        out[:, j] = np.add.reduceat(np.ascontiguousarray(numbers[:, j]).take(at) * factors, begins)
    return out


def _gradients(blocks_: DataFrame, points: dict, multinomial: bool = False) -> list[tuple]:
    """Loss, sums of the residuals and raw gradient of every asked cell, by
    class.  ``points``: by (collection, hash size) the cells, the folds they
    leave out, their offsets (cell, class) and their weights (index, cell,
    class); a class that a cell doesn't know is offset by minus infinity."""
    held = blocks_.sparkSession.sparkContext.broadcast(points)

    def of_block(b):
        asked = held.value.get((b["collection_id"], b["num_features"]))
        if asked is None:
            return
        cells, folds, offsets, weights = asked
        flat, dense, begins = weights.reshape(len(weights), -1), _unpacked(b), b["starts"][:-1]
        if dense is not None:
            margin = dense @ flat
        else:
            # few indices weigh anything, and only their entries count
            margin, here = np.zeros((len(begins), flat.shape[1])), np.flatnonzero((flat != 0).any(axis=1)[b["idx"]])
            row = np.repeat(np.arange(len(begins)), np.diff(b["starts"]))[here]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            if len(first):
                margin[row[first]] = _sums_of_parts(b["idx"][here], flat, b["tf"][here].astype(np.float64), first)
        margin = margin.reshape(-1, *offsets.shape) + offsets
        counts = b["fold"][:, None] != folds
        if multinomial:
            own = np.arange(offsets.shape[1]) == b["label"].astype(np.int64)[:, None]
            top = margin.max(axis=2, keepdims=True)
            powers = np.exp(margin - top)
            total = powers.sum(axis=2, keepdims=True)
            loss = (np.log(total) + top)[:, :, 0] - np.where(own[:, None, :], margin, 0.0).sum(axis=2)
            residual = np.where(counts[:, :, None], powers / total - own[:, None, :], 0.0)
        else:
            label = b["label"][:, None]
            loss = np.logaddexp(0.0, np.where(label > 0, -margin[:, :, 0], margin[:, :, 0]))
            with np.errstate(over="ignore"):
                residual = np.where(counts[:, :, None], 1.0 / (1.0 + np.exp(-margin)) - label[:, :, None], 0.0)
        loss = np.where(counts, loss, 0.0).sum(axis=0)
        sums, across = residual.sum(axis=0), residual.reshape(len(begins), -1)
        cols, raw = b["cols"], np.zeros((0, flat.shape[1]))
        if dense is not None:
            cols, raw = slice(None), dense.T @ across
        elif len(cols):
            raw = _sums_of_parts(b["col_rows"], across, b["col_tf"].astype(np.float64), b["col_starts"])
        raw = raw.reshape(-1, *offsets.shape)
        for k, cell in enumerate(cells):
            yield cell, np.append(loss[k], sums[k]), (cols, raw[:, k])

    try:
        return list(_numbers(_summed(_of_units(blocks_, points), of_block)))
    finally:
        held.destroy()


@dataclass
class _Part:
    """Training part of a cell: its rows less those of a fold.  ``classes``:
    rows of each class; ``active``: indices whose values differ; ``scale``:
    inverse document frequency over deviation; ``mean``: of the scaled values."""

    n: int
    classes: np.ndarray
    idf: np.ndarray
    active: np.ndarray
    scale: np.ndarray
    mean: np.ndarray


def _part(sums: dict[int, np.ndarray], counts: dict[int, dict], fold: int, size: int) -> _Part:
    rest = [f for f in counts if f != fold]
    classes = np.bincount([int(c) for f in rest for c in counts[f]], [m for f in rest for m in counts[f].values()])
    n = int(classes.sum())
    df, tf, squares = sum((sums[f] for f in rest if f in sums), np.zeros((size, 3))).T
    idf = np.log((n + 1.0) / (df + 1.0))
    variance = idf * idf * (n * squares - tf * tf) / (n * max(n - 1.0, 1.0))
    active = np.flatnonzero(variance > 0)
    scale = idf[active] / np.sqrt(variance[active])
    return _Part(n, classes, idf, active, scale, scale * tf[active] / n)


def _start(p: _Part, multinomial: bool) -> np.ndarray:
    """A cell's first point (class, active index and intercept at the end): the
    classes as often as they are there."""
    logs = np.log1p(p.classes) if multinomial else np.log(p.classes[1:] / p.classes[0])
    start = np.zeros((len(logs), len(p.active) + 1))
    start[:, -1] = logs - logs.mean() if multinomial else logs
    return start


class _SearchError(Exception):
    pass


def _direction(grad: np.ndarray, steps: list, changes: list) -> np.ndarray:
    """The two loops of the limited-memory quasi-Newton method; the newest
    step is first."""
    d, a = grad.copy(), []
    for s, y in zip(steps, changes, strict=True):
        a.append((s @ d) / (s @ y))
        d -= a[-1] * y
    if steps:
        curvature = steps[0] @ changes[0]
        if not curvature >= 0 or np.isnan(a).any():
            raise _SearchError
        d *= curvature / (changes[0] @ changes[0])
    for s, y, k in zip(steps[::-1], changes[::-1], a[::-1], strict=True):
        d += (k - (y @ d) / (s @ y)) * s
    return -d


def minimise(x: np.ndarray, l1: np.ndarray, max_iter: int, tolerance: float = TOLERANCE) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Orthant-wise quasi-Newton descent of f(x) + sum(l1 * abs(x)): yields the
    points where it needs f and its gradient, returns the last one."""

    def adjusted(x, value, grad):
        still = np.sign(grad) * np.maximum(np.abs(grad) - l1, 0.0)
        return value + float(np.abs(l1 * x).sum()), np.where(l1 == 0, grad, np.where(x == 0, still, grad + np.sign(x) * l1))

    value, grad = yield x
    value1, grad1 = adjusted(x, value, grad)
    first, seen, steps, changes, failed, it = value1, [value1], [], [], False, 0
    while it < max_iter:
        if len(seen) > 1 and abs(value1 - max(seen)) <= tolerance * abs(first):
            break
        if np.linalg.norm(grad1) <= max(tolerance * abs(value1), 1e-8):
            break
        try:
            with np.errstate(all="ignore"):
                d = _direction(grad1, steps, changes)
            d = np.where(d * grad1 < 0, d, 0.0)
            orthant = np.where(x != 0, np.sign(x), np.sign(-grad1))
            slope, shrink = float(grad1 @ d), 0.1 if it < 1 else 0.5
            alpha, tries = (0.05 / np.linalg.norm(grad), 1) if it < 1 else (1.0, 0)
            while True:
                x2 = x + alpha * d
                x2 = np.where(np.sign(x2) == orthant, x2, 0.0)
                value2, grad2 = yield x2
                value3, grad3 = adjusted(x2, value2, grad2)
                slope2 = float(grad3 @ d)
                # as in the library, the first step is not held against its own
                # value but against the one before without its penalty
                if (value3 if tries else value) > value1 + alpha * slope * 1e-4:
                    alpha *= shrink
                elif slope2 < 0.9 * slope:
                    alpha *= 2.1
                elif slope2 > -0.9 * slope:
                    alpha *= shrink
                else:
                    break
                if tries >= 20 or not 1e-10 <= alpha <= 1e10:
                    raise _SearchError
                tries += 1
        except _SearchError:
            if failed:
                break
            failed, steps, changes = True, [], []
            continue
        failed = False
        steps, changes = [x2 - x, *steps][:MEMORY], [grad2 - grad, *changes][:MEMORY]
        x, value, grad, value1, grad1, it = x2, value2, grad2, value3, grad3, it + 1
        seen = [*seen, value1][-20:]
    return x


def fit_cells(blocks_: DataFrame, counts: dict[str, dict[int, dict]], usable: dict[str, list[int]], sizes: Sequence[int], regs: Sequence[float], elastic_net: float, max_iter: int, multinomial: bool = False):
    """Yields ``(collection, hash size, fold, number of the regularisation,
    idf, intercepts, coefficients by class)`` of every cell; a binary one has
    those of its positive class.  ``counts``: rows by collection, fold and class
    (0.0, 1.0, ..)."""
    widest = {cid: max(int(c) for own in counts[cid].values() for c in own) + 1 if multinomial else 1 for cid in usable}
    units = [(cid, n) for cid in sorted(usable) for n in sizes if usable[cid]]
    batch: list[tuple[str, int]] = []
    numbers = 0
    for unit in units:
        width = unit[1] * len(usable[unit[0]]) * len(regs) * widest[unit[0]]
        if batch and numbers + width > POINT_NUMBERS:
            yield from _fit_batch(blocks_, batch, counts, usable, regs, elastic_net, max_iter, multinomial)
            batch, numbers = [], 0
        batch.append(unit)
        numbers += width
    if batch:
        yield from _fit_batch(blocks_, batch, counts, usable, regs, elastic_net, max_iter, multinomial)


def _fit_batch(blocks_, batch, counts, usable, regs, elastic_net, max_iter, multinomial):
    sums: dict[tuple, dict[int, np.ndarray]] = {u: {} for u in batch}
    for (cid, n, fold), _, numbers in _numbers(_statistics(_of_units(blocks_, batch))):
        if (cid, n) in sums:
            sums[cid, n][fold] = numbers.reshape(n, 3)
    parts = {(cid, n, f): _part(sums[cid, n], counts[cid], f, n) for cid, n in batch for f in usable[cid]}
    del sums
    cells, asked, ended = {}, {}, {}
    for (cid, n, f), p in parts.items():
        for k, _ in enumerate(regs):
            start = _start(p, multinomial)
            l1 = np.full(start.shape, elastic_net * regs[k])
            l1[:, -1] = 0.0
            key = cid, n, f, k
            cells[key] = minimise(start.ravel(), l1.ravel(), max_iter)
            asked[key] = next(cells[key])

    def by_class(key, x):
        """(weights of the scaled values, offsets) of a point, by class."""
        p = parts[key[:3]]
        x = x.reshape(-1, len(p.active) + 1)
        return x[:, :-1], x[:, -1] - x[:, :-1] @ p.mean

    while asked:
        points: dict = {}
        for key, x in asked.items():
            points.setdefault(key[:2], []).append((key, *by_class(key, x)))
        packed = {}
        for (cid, n), own in points.items():
            width = max(len(o[2]) for o in own)
            offsets, weights = np.full((len(own), width), -np.inf), np.zeros((n, len(own), width))
            for c, (key, values, offset) in enumerate(own):
                p = parts[key[:3]]
                offsets[c, : len(offset)] = offset
                weights[p.active, c, : len(offset)] = (p.scale * values).T
            packed[cid, n] = [o[0][2] * len(regs) + o[0][3] for o in own], np.array([o[0][2] for o in own]), offsets, weights
        for (cid, n, cell), head, raw in _gradients(blocks_, packed, multinomial):
            key = (cid, n, *divmod(cell, len(regs)))
            p, l2 = parts[key[:3]], (1.0 - elastic_net) * regs[key[3]]
            values, offset = by_class(key, asked[key])
            residuals = head[1 : 1 + len(offset)]
            raw = raw.reshape(n, -1)[p.active, : len(offset)].T
            grad = np.column_stack([(p.scale * raw - residuals[:, None] * p.mean) / p.n + l2 * values, residuals / p.n])
            try:
                asked[key] = cells[key].send((head[0] / p.n + 0.5 * l2 * float((values * values).sum()), grad.ravel()))
            except StopIteration as end:
                ended[key] = end.value
                del asked[key]
    for key, x in ended.items():
        p, (values, intercepts) = parts[key[:3]], by_class(key, x)
        weights = np.zeros((len(values), key[1]))
        weights[:, p.active] = values * p.scale / p.idf[p.active]
        yield *key, p.idf, intercepts - intercepts.mean() if multinomial else intercepts, weights
