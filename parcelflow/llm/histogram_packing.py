"""Packing of token sequences by non-negative least squares on the length histogram.

Documents are tokenised in the task that reads them and packed there in blocks
of about ``BLOCK_TOKENS`` ids, so nothing is shuffled, broadcast or collected.
A block is packed so:

1. Documents over the capacity give full sequences; the rest of each is an item.
2. For windows of 256, 1,024 and 4,096 tokens: item lengths are counted in 64
   classes. The combinations of up to four classes that fill the window are
   the columns of a matrix; non-negative least squares (Lawson and Hanson, 1974)
   finds how often each is to be repeated so that the histogram is met best.
   The counts are rounded and carried out with real items, each class by its
   longest item left and the last place by the longest that still fits. What a
   window holds is one item of the next, larger one. (After Krell et al., 2021;
   windows in steps keep the combinations shallow for short documents too.)
3. Residual items, and the shortest ones (2 % of the tokens, held back until
   now), are packed greedily with the windows, best fit decreasing.
4. Documents may be cut freely, so the emptiest sequences are taken apart again
   and fill the gaps of the others; the few tokens then left are cut into
   sequences whose sizes are powers of two, which need no padding.

So every sequence is full, or a power of two long, and a document is cut only
where it is too long or fills a gap.

Defined results: null and empty texts are the end id alone; repeated rows are
packed as often as they occur; null ids are kept; an empty table gives an empty
result; extra columns are left out. ``sequence_id`` depends on the partitioning
of the input: the partition's number and a running number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .packing import best_fit
from .tokens import piece_tokenizer, tokenizer_path
from .worker import trim

CAPACITY, END_ID = 4096, 2
#: Ids packed together (4 bytes each); a longer document is a block of its own.
BLOCK_TOKENS = 8 << 20
CLASSES, DEPTH = 64, 4
#: Share of the tokens, in the shortest items, kept for the greedy step.
RESERVE = 0.02

PLACED = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]


# ---- combinations and repeat counts ---------------------------------------------

@lru_cache(maxsize=4)
def combinations(classes: int = CLASSES, depth: int = DEPTH) -> tuple[tuple[int, ...], ...]:
    """All multisets of up to ``depth`` classes (1 to ``classes``) that add up
    to ``classes``, each in falling order."""
    def parts(left: int, most: int, places: int):
        if left == 0:
            yield ()
        elif places:
            for c in range(min(left, most), -(-left // places) - 1, -1):
                for more in parts(left - c, c, places - 1):
                    yield (c, *more)

    return tuple(parts(classes, classes, depth))


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 that makes ||a x - b|| least, by the active-set method; ``rounds``
    bounds the columns taken in (three times the rows, if not given)."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds or 3 * len(b) + 10):
        w = a.T @ (b - a @ x)
        w[passive] = -np.inf
        k = int(w.argmax()) if n else 0
        if not n or w[k] <= tolerance:
            break
        passive[k] = True
        while True:
            at = np.flatnonzero(passive)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            step = (x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)).min()
            x[at] += step * (z - x[at])
            gone = at[(x[at] <= tolerance) & low]
            if not len(gone):
                gone = at[low][[int(x[at][low].argmin())]]
            x[gone], passive[gone] = 0, False
            if not passive.any():
                break
    return x


def repeats(sizes: np.ndarray, window: int, classes: int = CLASSES, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of classes for items of these sizes and how often each is repeated."""
    unit = window // classes
    hist = np.bincount(-(-sizes // unit), minlength=classes + 1)[:classes + 1]
    there = [c for c in combinations(classes, depth) if all(hist[k] for k in c)]
    if not there:
        return []
    a = np.zeros((classes, len(there)))
    for j, c in enumerate(there):
        for k in c:
            a[k - 1, j] += 1
    x = nnls(a, hist[1:].astype(float))
    return [(c, int(v)) for c, v in zip(there, np.rint(x)) if v > 0]


# ---- one block --------------------------------------------------------------------

class _Shelf:
    """Items by their exact size, with the largest size up to a limit at hand."""

    def __init__(self, sizes: list[int]):
        self.at: dict[int, list[int]] = {}
        self.has = 0                                 # bit s is set when there is an item of size s
        for k, s in enumerate(sizes):
            self.put(k, s)

    def put(self, item: int, size: int) -> None:
        self.at.setdefault(size, []).append(item)
        self.has |= 1 << size

    def take(self, most: int, over: int = 0) -> tuple[int, int] | None:
        """(item, size) of the largest item of size ``over`` < size <= ``most``."""
        size = (self.has & ((2 << most) - 1)).bit_length() - 1
        if size <= over:
            return None
        items = self.at[size]
        item = items.pop()
        if not items:
            self.has ^= 1 << size
        return item, size


def pack_items(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Items of sizes 1 to ``capacity`` as whole sequences: lists of items."""
    held: list[list[int]] = [[k] for k in range(len(sizes))]
    size = sizes.tolist()
    # The shortest items, up to RESERVE of all tokens, wait for the gaps that the windows leave.
    order = np.argsort(sizes, kind="stable")
    back = order[:int((np.cumsum(sizes[order]) <= RESERVE * sizes.sum()).sum())]
    shelf = _Shelf([])
    for k in order[len(back):].tolist():
        shelf.put(k, size[k])
    for window in (w for w in (capacity // 16, capacity // 4, capacity) if w >= CLASSES):
        unit, blocks = window // CLASSES, []
        left = np.array([s for s, items in shelf.at.items() if s <= window for _ in items], np.int64)
        for combination, times in repeats(left, window):
            for _ in range(times):
                taken, room = [], window
                for k, c in enumerate(combination):
                    last = k == len(combination) - 1
                    got = shelf.take(room if last else min(room, c * unit), 0 if last else (c - 1) * unit)
                    if got is None:
                        break
                    taken.append(got)
                    room -= got[1]
                if len(taken) < len(combination):     # a class ran out: the others go back
                    for item, s in taken:
                        shelf.put(item, s)
                    break
                blocks.append(([p for item, _ in taken for p in held[item]], window - room))
        for members, s in blocks:
            held.append(members)
            size.append(s)
            shelf.put(len(held) - 1, s)
    rest = [(k, s) for s, items in shelf.at.items() for k in items] + [(k, size[k]) for k in back.tolist()]
    if not rest:
        return []
    bins, _, fill = best_fit(np.array([s for _, s in rest], np.int64), capacity)
    out: list[list[int]] = [[] for _ in fill]
    for (k, _), b in zip(rest, bins.tolist()):
        out[b] += held[k]
    return out


def powers(n: int) -> list[int]:
    """Powers of two that add up to ``n``, falling."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents of these lengths: document, start, length, sequence, offset."""
    full = lengths // capacity
    doc = np.repeat(np.arange(len(lengths)), full)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)) * capacity
    pieces = [(doc, start, np.full(len(doc), capacity), np.arange(len(doc)), np.zeros(len(doc), np.int64))]
    number = len(doc)
    # Items are the rests.
    owner = np.flatnonzero(lengths % capacity)
    size, begin = (lengths % capacity)[owner], (full * capacity)[owner]
    sequences = pack_items(size, capacity)
    fill = np.array([int(size[s].sum()) for s in sequences], np.int64)
    order = np.argsort(-fill, kind="stable")
    gap = np.cumsum(capacity - fill[order])
    rest = fill.sum() - np.cumsum(fill[order])
    kept = int((gap <= rest).sum())                      # as many of the fullest as the others can fill
    whole = [np.array(sequences[k], np.int64) for k in order[:kept]]
    count = np.array([len(w) for w in whole], np.int64)
    item = np.concatenate(whole) if kept else np.zeros(0, np.int64)
    of = np.repeat(np.arange(kept), count)
    run = np.cumsum(size[item]) - size[item]
    first = np.repeat(np.cumsum(count) - count, count)
    pieces.append((owner[item], begin[item], size[item], number + of, run - run[first] if len(item) else run))
    # The others, laid end to end, are cut at the ends of the gaps and of the last sequences.
    loose = np.array([k for s in order[kept:] for k in sequences[s]], np.int64)
    total = int(size[loose].sum())
    gaps = (capacity - fill[order[:kept]]).tolist()
    over = total - sum(gaps)
    tail = [capacity] * (over // capacity) + powers(over % capacity)
    room = np.array(gaps + tail, np.int64)
    base = np.concatenate([fill[order[:kept]], np.zeros(len(tail), np.int64)]).astype(np.int64)
    to = np.concatenate([[0], np.cumsum(room)]).astype(np.int64)
    src = np.concatenate([[0], np.cumsum(size[loose])]).astype(np.int64)
    edge = np.union1d(to, src)
    a, n = edge[:-1], np.diff(edge)
    i, s = np.searchsorted(src, a, "right") - 1, np.searchsorted(to, a, "right") - 1
    pieces.append((owner[loose[i]], begin[loose[i]] + a - src[i], n, number + s, base[s] + a - to[s]))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*pieces))


# ---- over all documents --------------------------------------------------------------

def _packer(path: str, capacity: int, end_id: int, block_tokens: int, id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), *PLACED])

    def block(ids: list[pa.Array], tokens: list[np.ndarray], lengths: list[np.ndarray], part: int, number: int) -> tuple[pa.RecordBatch, int]:
        n, raw = np.concatenate(lengths), memoryview(np.concatenate(tokens)).cast("B")
        doc, start, length, seq, offset = place(n, capacity)
        order = np.lexsort((start, doc))
        doc, start, length, seq, offset = (x[order] for x in (doc, start, length, seq, offset))
        at = 4 * ((np.cumsum(n) - n)[doc] + start)
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
        used = int(seq.max()) + 1
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids).take(pa.array(doc)).cast(id_type), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[doc]),
                                           pa.array((part << 40) + number + seq), pa.array(offset)], schema=schema), number + used

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        t = piece_tokenizer(path)
        ids, tokens, lengths, number, held = [], [], [], 0, 0
        for batch in batches:
            for first, found, bounds in t.slices(batch.column(1), end_id):
                n = np.diff(bounds)
                ids.append(batch.column(0).slice(first, len(n)))
                tokens.append(np.ascontiguousarray(found))
                lengths.append(n)
                held += len(found)
                if held >= block_tokens:
                    out, number = block(ids, tokens, lengths, part, number)
                    ids, tokens, lengths, held = [], [], [], 0
                    yield out
        if lengths:
            yield block(ids, tokens, lengths, part, number)[0]
        trim()

    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per piece: the document's id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset. ``capacity`` is a power of two."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    out = src.mapInArrow(_packer(path, capacity, end_id, block_tokens, id_type), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("doc_id", id_col)


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens, padding tokens (none where a sequence's size is a power of two)."""
    by = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.expr("n & (n - 1)") == 0, 0).otherwise(capacity - F.col("n"))
    return by.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(pad).alias("padding"))


# ---- registered query ----------------------------------------------------------------

def op12_nnls_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
