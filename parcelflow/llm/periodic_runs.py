"""Periodic runs of words, by an online sparse dynamic program over lag diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), at least ``MIN_WORDS`` and ``MIN_TURNS * q`` long, that no
neighbouring word extends keeping period q.

The dynamic program has a cell (i, q) where word i equals word i - q, with the
length of the match that ends there; a cell adds one to the cell before it on
its diagonal q. Only sparse cells are visited. For a run of period q the match
on diagonal q is at least 2q and 16 long (with the defaults), so diagonals
start at words whose gram of k words (16 <= k, q <= k < 2q) occurred before,
for k = 16, 32, 64 and so on. Of the earlier occurrences only the last one is
a cell: inside a run of smallest period q a gram of k >= q words can't come
back sooner than after q words (else the run had a smaller period), so the
last occurrence lies exactly q back at every place of the run, and the diagonal
never breaks inside it. A diagonal that ends is emitted at once when its
stretch is long enough and maximal. So a text of n words costs O(n log n) a
level, also where one word fills it; there are log(n) levels, and a level looks
only at grams whose halves were repeated.

All texts of a slice are worked on together in NumPy; grams are 64-bit hashes,
mixed with the number of the text. One text is held by one task (about 100
bytes a word), nothing is shuffled.

Defined results: null and blank texts have no words and no runs; their
collapsed text is empty; repeated rows are judged alike; extra columns are left
out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import table, words
from .worker import trim

MIN_WORDS, MIN_TURNS = 24, 3
#: Bytes of text worked on at once.
SLICE_BYTES = 1 << 20

RUNS = "array<struct<start:long,length:long,period:long>>"


# ---- runs of word numbers -----------------------------------------------------

def _shortest_match(min_words: int, min_turns: int) -> int:
    """Words that the diagonal of any run matches at least."""
    return min(max(min_words - q, (min_turns - 1) * q) for q in range(1, min_words + 1))


def runs_of(word: np.ndarray, doc: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS, min_turns: int = MIN_TURNS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of all texts of a slice: text, start (within the text), length, period.

    ``word`` are hashes of the words, ``doc`` the text of each, ``bounds`` the
    first word of each text. In order of text, start and period.
    """
    if min_turns < 3:
        raise ValueError("runs of less than three turns have no gram at least as long as their period")
    n = len(word)
    width = _shortest_match(min_words, min_turns)
    found = []
    # Hashes of grams of ``width`` words, by doubling; grams across two texts are never looked at.
    gram, k = W.mix(word + doc.astype(np.uint64) * np.uint64(W.MIX[1])), 1
    while 2 * k <= width and len(gram) > k:
        gram, k = _joined(gram, k), 2 * k
    if k < width and len(gram) > width - k:
        gram = _joined(gram, width - k)
    least, k = 1, width
    at = np.arange(max(n - k + 1, 0))
    last = bounds[1:][doc] if n else bounds[:0]            # end of each word's text
    at = at[at + k <= last[at]]
    while len(at):
        # The last earlier occurrence of each gram, by a stable sort of the hashes.
        order = np.argsort(gram[at], kind="stable")
        h = gram[at][order]
        same = h[1:] == h[:-1]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:][same]] = (at[order[1:]] - at[order[:-1]])[same]
        # Cells whose lag belongs to this level; a diagonal is a chain of neighbouring cells of one lag.
        cell = np.flatnonzero((lag >= least) & (lag <= k))
        if len(cell):
            i, q = at[cell], lag[cell]
            begins = np.concatenate([[True], (i[1:] != i[:-1] + 1) | (q[1:] != q[:-1])])
            first = np.flatnonzero(begins)
            end = np.concatenate([first[1:], [len(cell)]]) - 1
            q = q[first]
            start, stop = i[first] - q, i[end] + k
            found.append(_maximal(word, last, start, stop, q, bounds[doc[start]], min_words, min_turns))
        # Longer grams repeat only where both halves do.
        again = np.zeros(len(gram) + k, bool)
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        again[at[twice]] = True
        at = at[twice]
        at = at[(at + 2 * k <= last[at]) & again[np.minimum(at + k, len(again) - 1)]]
        if len(gram) <= k:
            break
        gram, least, k = _joined(gram, k), k + 1, 2 * k
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return doc[start], start - bounds[doc[start]], length, period


def _joined(gram: np.ndarray, k: int) -> np.ndarray:
    """Hash of each gram followed by the one ``k`` words on."""
    return W.mix(gram[:-k] * np.uint64(W.BASE) + gram[k:])


def _maximal(word, last, start, stop, q, low, min_words, min_turns):
    """Of the stretches [start, stop) those that are long enough and that no neighbour extends."""
    long = stop - start >= np.maximum(min_words, min_turns * q)
    start, stop, q, low = start[long], stop[long], q[long], low[long]
    before = np.maximum(start - 1, 0)
    after = np.minimum(stop, len(word) - 1)
    left = (start > low) & (word[before] == word[before + q])
    right = (stop < last[start]) & (word[after] == word[after - q])
    keep = ~left & ~right
    return start[keep], (stop - start)[keep], q[keep]


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that any run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) > 0


# ---- over all documents ---------------------------------------------------------

def _finder(id_type: pa.DataType, min_words: int, min_turns: int):
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in W.slices(batch.column(1), W.NOT_SPACE, W.SAME, SLICE_BYTES):
                doc, start, length, period = runs_of(w.hash, w.doc, w.bounds, min_words, min_turns)
                cut = np.searchsorted(doc, np.arange(w.n_docs + 1))
                texts, found = [], []
                raw = memoryview(w.data)
                begin, end = w.start, w.end
                for k in range(w.n_docs):
                    a, b = w.bounds[k], w.bounds[k + 1]
                    mine = list(zip(*(x[cut[k]:cut[k + 1]].tolist() for x in (start, length, period))))
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in mine])
                    keep = slice(a, b) if not mine else a + np.flatnonzero(~dropped(b - a, mine))
                    texts.append(b" ".join([raw[x:y] for x, y in zip(begin[keep].tolist(), end[keep].tolist())]))
                ids = batch.column(0).slice(w.first, w.n_docs).cast(id_type)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, run_type), pa.array(texts, pa.binary()).view(pa.string()), pa.array(np.diff(w.bounds))],
                                                 names=["id", "runs", "collapsed", "n_words"])
        trim()

    return run


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_turns: int = MIN_TURNS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``runs`` in order of start and period,
    the ``collapsed`` text (words joined by one space, every run cut to its
    first period) and ``n_words``."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    out = src.mapInArrow(_finder(id_type, min_words, min_turns), f"id {kind}, runs {RUNS}, collapsed string, n_words long")
    return out.select(F.col("id").alias(id_col), "runs", "collapsed", "n_words")


def strongest(runs: Column) -> Column:
    """The run of greatest exact length / period, the first of equal ones; null without runs."""
    more = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), more)


# ---- registered query -------------------------------------------------------------

def _with_planted(docs: DataFrame) -> DataFrame:
    """The contract's input: texts of one id in ten repeat a part of theirs to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce((h % 10 == 0), F.lit(False))
    d = docs.select("doc_id", "text", h.alias("h"), chosen.alias("chosen"))
    d = d.withColumn("w", F.when(F.col("chosen"), words(F.col("text"))))
    d = d.withColumn("n", F.size("w").cast("long")).withColumn("g", F.floor(F.col("h") / 10).cast("long"))
    d = d.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    d = d.withColumn("p", (F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)) + 1).cast("long"))
    turns = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int")), turns))
    whole = F.slice(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), cycle), F.lit(1), F.col("n").cast("int"))
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_planted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = strongest(F.col("runs"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    d = found.select("doc_id", "runs", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                     F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return d.select("doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
