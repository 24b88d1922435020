"""Best-fit packing of token sequences, certified by dual feasible functions.

Documents are tokenised; only those longer than the capacity are cut. The
pieces are dealt over partitions of bounded size, each packed by best-fit
decreasing. Dual feasible functions over a partition's size histogram give a
lower bound on its bins: a partition that meets it is certified optimal. While
the total exceeds the bound over all pieces, the unfilled bins of partitions
with a gap give up their pieces, which are dealt anew over as few partitions as
hold them and packed again; a rerun is kept only when it saves bins (``MIN_SAVING``). When no
gap is left to close, the certified partitions' unfilled bins (about one a
partition) are joined with them in the same way. It ends when no rerun is kept.

Every piece carries its group's certificate: ``part_bins`` used and
``part_bound`` needed. A full bin that stays behind in an exchange is a group of
its own, of one bin and bound one.

Defined results: null and empty texts are the end id alone; repeated rows are
packed as often as they occur; an empty table gives an empty result. Extra
columns are ignored; working columns start with ``_b_``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .tokens import piece_tokenizer, tokenizer_path
from .worker import trim

CAPACITY = 4096
END_ID = 1
#: Pieces dealt to one partition, on average; bounds what one task packs.
PIECES_PER_PART = 50_000    # far below 2^20, which sequence numbers keep for a part's bins
#: Share of the bins given up that a rerun must save to be kept (one bin at least).
MIN_SAVING = 0.001

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ---- pieces -----------------------------------------------------------------

def _cutter(path: str, capacity: int, end_id: int):
    import zlib

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = piece_tokenizer(path)
        for batch in batches:
            for first, ids, bounds in t.slices(batch.column(1), end_id):
                n = np.diff(bounds)
                parts = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(n[doc] - start, capacity)
                raw, at = memoryview(ids.tobytes()), 4 * (bounds[doc] + start)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], schema=schema)
        trim()

    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document of (doc_id, text)."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInArrow(_cutter(path, capacity, end_id), PIECES)


# ---- packing of one partition -----------------------------------------------

def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that items need at least; ``counts[s]`` items have size s.

    The maximum over two families of dual feasible functions: f_l drops sizes
    below l and rounds those above capacity - l up to a whole bin; u_k rounds
    s * (k + 1) / capacity down to whole k-ths of a bin, unless it is whole.
    """
    s = np.arange(capacity + 1, dtype=np.int64)
    c = counts.astype(np.int64)
    if not c.sum():
        return 0
    mass = np.concatenate([[0], np.cumsum(c * s)])       # mass[i]: total size of items below i
    many = np.concatenate([[0], np.cumsum(c)])
    low = np.arange(1, capacity // 2 + 1)
    best = int((mass[capacity - low + 1] - mass[low] + capacity * (many[-1] - many[capacity - low + 1])).max())
    best = -(-max(best, int(mass[-1])) // capacity)
    for k in range(1, 21):
        whole = (s * (k + 1)) % capacity == 0
        u = np.where(whole, s * k, (s * (k + 1)) // capacity * capacity)   # of k * capacity
        best = max(best, -(-int((c * u).sum()) // (k * capacity)))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each size, and the bins' fill."""
    order = np.argsort(-sizes, kind="stable")
    bins_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    has, fill = 0, []                                    # has: bit r is set when a bin has room r
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        fits = has >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1      # the smallest room that holds s
            b = room[r].pop()
            if not room[r]:
                has ^= 1 << r
        else:
            r, b = capacity, len(fill)
            fill.append(0)
        bins_of[i], offset[i] = b, fill[b]
        fill[b] += s
        left = r - s
        if left:
            if not room[left]:
                has |= 1 << left
            room[left].append(b)
    return bins_of, offset, np.array(fill, np.int64)


def _pack_part(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "_b_row"], ascending=[False, True, True, True], kind="stable")
        sizes = pdf["length"].to_numpy()
        b, off, fill = best_fit(sizes, capacity)
        bound = lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)
        return pdf.assign(_b_bin=b, offset=off, _b_fill=fill[b], _b_bins=len(fill), _b_bound=bound)

    return run


# ---- over all partitions ----------------------------------------------------

def _packed(rows: DataFrame, n: int, capacity: int, number: int, pieces_per_part: int) -> DataFrame:
    """Deal ``rows`` over partitions by their row number and pack each."""
    parts = max(1, -(-n // pieces_per_part))
    cols = [*(c.split()[0] for c in PIECES.split(", ")), "_b_row"]
    dealt = rows.select(*cols, F.pmod(F.xxhash64("_b_row", F.lit(number)), F.lit(parts)).cast("int").alias("_b_part"))
    schema = f"{PIECES}, _b_row long, _b_part int, _b_bin long, offset long, _b_fill long, _b_bins long, _b_bound long"
    out = dealt.groupBy("_b_part").applyInPandas(_pack_part(capacity), schema)
    return stored(out.withColumn("_b_round", F.lit(number)), "packing-round")


#: What the groups of a round have given up so far: nothing, the unfilled bins of those with a gap, all unfilled bins.
WHOLE, GAVE_GAPS, GAVE_ALL = 0, 1, 2


def _gap() -> Column:
    return F.col("_b_bins") > F.col("_b_bound")


def _bins() -> Column:
    return F.sum(F.when(F.col("offset") == 0, 1).otherwise(0))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _gives(t: DataFrame, state: int, capacity: int, wide: bool) -> DataFrame:
    """Rows of a round in bins that the next exchange takes."""
    asked = {WHOLE: F.lit(True) if wide else _gap(), GAVE_GAPS: ~_gap() if wide else F.lit(False), GAVE_ALL: F.lit(False)}[state]
    return t.where(asked & (F.col("_b_fill") < capacity))


def _stays(t: DataFrame, state: int, capacity: int) -> DataFrame:
    """Rows of a round that no exchange took, with their group's certificate."""
    gave = {WHOLE: F.lit(False), GAVE_GAPS: _gap(), GAVE_ALL: F.lit(True)}[state]
    one = F.lit(1).cast("long")
    return t.where(~gave | (F.col("_b_fill") == capacity)).withColumns({c: F.when(gave, one).otherwise(F.col(c)) for c in ("_b_bins", "_b_bound")})


def pack(parts: DataFrame, capacity: int = CAPACITY, pieces_per_part: int = PIECES_PER_PART) -> DataFrame:
    """Pieces with sequence_id, offset, part_bins and part_bound."""
    rows = stored(parts.withColumn("_b_row", F.monotonically_increasing_id()), "packing-pieces")
    sizes = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}   # one entry per size, at most the capacity
    n = sum(sizes.values())
    counts = np.zeros(capacity + 1, np.int64)
    for s, c in sizes.items():
        counts[s] = c
    bound = lower_bound(counts, capacity)
    rounds, state = [_packed(rows, n, capacity, 0, pieces_per_part)], [WHOLE]
    total = rounds[0].agg(_bins()).first()[0] or 0
    wide = False
    while total > bound:
        loose = _union([_gives(t, s, capacity, wide) for t, s in zip(rounds, state)])
        group = F.struct("_b_round", "_b_part")
        m, old, low, high = loose.agg(F.count("*"), _bins(), F.min(group), F.max(group)).first()
        again, saved = None, 0
        if m and low != high:                            # one partition alone has nobody to exchange with
            again = _packed(loose, m, capacity, len(rounds), pieces_per_part)
            saved = old - again.agg(_bins()).first()[0]
        if saved >= max(1, MIN_SAVING * (old or 0)):
            state = [GAVE_ALL if wide else max(s, GAVE_GAPS) for s in state] + [WHOLE]
            rounds, total = [*rounds, again], total - saved
        elif wide:
            break
        else:
            wide = True                                  # no gap is left to close
    kept = _union([_stays(t, s, capacity) for t, s in zip(rounds, state)])
    sequence = F.col("_b_round").cast("long") * (1 << 51) + F.col("_b_part").cast("long") * (1 << 20) + F.col("_b_bin")
    return kept.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset",
                       F.col("_b_bins").alias("part_bins"), F.col("_b_bound").alias("part_bound"))


# ---- registered query and pipeline stage ------------------------------------

def op9_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents"), tokenizer_path()))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every piece of the kept documents and its place."""
    return pack(pieces(docs, tokenizer_path()))
