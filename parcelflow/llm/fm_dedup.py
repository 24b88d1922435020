"""Repeated passages by compressed FM-indexes over shards.

A passage of ``WINDOW`` words that occurs twice must be found wherever its two
places are, yet no shard may hold the corpus. So text is routed by content:
every window of ``WINDOW`` words belongs to the smallest hash among its runs of
``GRAM`` words (its anchor). Equal windows have the same anchor at the same
distance, so they meet in one shard. Neighbouring windows mostly share an anchor
and travel together as one segment of words, about a window longer than their
number. Anchors that occur once in the corpus hold no repeated window; they are
counted first, as bare hashes, and dropped, which leaves the repeated parts.

Equal segments are then merged, with their number of places, before the shards
are formed. In each shard an FM-index is built over the distinct segments: the
suffix order of their words, the Burrows-Wheeler transform, and a wavelet tree
of bit vectors with block counts for its ranks. The segments are streamed
against it from right to left, all at once: backward search finds how far back
the words that end at a place occur elsewhere too (matching statistics), which
decides all windows inside that stretch; the search then goes on at the next
undecided window. With the merged places this gives the windows found twice or
more, and the intervals of words they cover.

An anchor under very many distinct segments (a common phrase) is not left to one
shard: beyond ``HOT`` places its windows travel one by one, routed by their own
hash, so its load spreads while equal windows still meet.

Defined results: null and empty texts have no words and lose none; texts with
fewer than ``WINDOW`` words lose none; repeated rows are copies of each other;
extra columns are carried through; an empty table gives an empty result.
Working columns start with ``_f_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import release, stored, table
from .worker import drop

WINDOW = 35
#: Words of an anchor; longer ones recur less by chance, shorter ones make longer segments.
GRAM = 12
#: Places of one anchor beyond which its windows are routed one by one.
HOT = 1000
#: Words of distinct segments in one shard, about.
SHARD_WORDS = 1 << 20


# ---- segments ---------------------------------------------------------------

def anchors(words: W.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor place: (text, first window's first word
    in the text, number of windows, anchor hash)."""
    g, at = W.windows(words, gram)
    none = np.zeros(0, np.int64)
    span = window - gram + 1                      # grams of a window
    if len(g) < span:
        return none, none, none, np.zeros(0, np.uint64)
    # Leftmost smallest gram of every ``span`` consecutive ones, by doubling.
    low, arg, size = g, np.arange(len(g)), 1
    while size < span:
        step = min(size, span - size)
        take = low[step:] < low[:-step]
        low, arg = np.where(take, low[step:], low[:-step]), np.where(take, arg[step:], arg[:-step])
        size += step
    doc = words.doc[at]
    ok = np.flatnonzero(doc[:len(arg)] == doc[span - 1:span - 1 + len(arg)])
    if not len(ok):
        return none, none, none, np.zeros(0, np.uint64)
    place = arg[ok]
    new = np.ones(len(ok), bool)
    new[1:] = (place[1:] != place[:-1]) | (ok[1:] != ok[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(ok)))
    d = doc[ok[first]]
    return d, at[ok[first]] - words.bounds[d], count, g[place[first]]


def _runs(window: int, gram: int):
    schema = pa.schema([("_f_row", pa.int64()), ("first", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        for batch in batches:
            for w in W.slices(batch.column(1), W.NOT_SPACE, W.SAME):
                d, first, n, a = anchors(w, window, gram)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(w.first + d)), pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(a.view(np.int64))], schema=schema)

    return run, "_f_row long, first int, n int, anchor long"


def _route(words: np.ndarray) -> int:
    """Where a window of its own goes: a hash of its words in order."""
    return int(W.mix(np.add.reduce(W.mix(words + (np.arange(len(words), dtype=np.uint64) << np.uint64(32))), keepdims=True)).view(np.int64)[0])


def _cutter(window: int):
    """Word hashes (32 bits; a window has 35 of them) of the runs of each text;
    a hot run window by window."""
    schema = pa.schema([("_f_row", pa.int64()), ("first", pa.int32()), ("route", pa.int64()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        for batch in batches:
            runs = batch.column(2).to_pylist()
            for w in W.slices(batch.column(1), W.NOT_SPACE, W.SAME):
                rows, firsts, routes, segments = [], [], [], []
                ids = batch.column(0).slice(w.first, w.n_docs).to_pylist()
                for k in range(w.n_docs):
                    h = (w.hash[w.bounds[k]:w.bounds[k + 1]] >> np.uint64(32)).astype(np.uint32)
                    for r in runs[w.first + k]:
                        parts = [(r["first"], r["n"])] if not r["hot"] else [(r["first"] + x, 1) for x in range(r["n"])]
                        for first, n in parts:
                            s = h[first:first + n + window - 1]
                            rows.append(ids[k])
                            firsts.append(first)
                            routes.append(_route(s) if r["hot"] else r["anchor"])
                            segments.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(firsts, pa.int32()), pa.array(routes, pa.int64()), pa.array(segments, pa.binary())], schema=schema)

    return run, "_f_row long, first int, route long, words binary"


# ---- FM-index ---------------------------------------------------------------

def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by
    prefix doubling. Searches for at most that many symbols need no more."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    size = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:max(n - size, 0)] = rank[size:] + 1
        key = (rank << 32) | second
        order = np.argsort(key)
        k = key[order]
        fresh = np.concatenate([[0], np.cumsum(k[1:] != k[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        size *= 2
        if fresh[-1] == n - 1 or size >= depth:
            return order


class WaveletTree:
    """Ranks of symbols in a sequence, by one bit vector a level (packed bits
    and a count before every 64) in the order of a stable sort by the bits
    above."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.n, self.levels = len(seq), max(1, int(n_symbols - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        cur = seq.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (cur >> level) & 1
            pad = np.zeros(-(-(self.n + 1) // 64) * 64, np.uint8)
            pad[:self.n] = bit
            word = np.packbits(pad, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(word).astype(np.int64)
            self.bits.append(word)
            self.before.append(np.concatenate([[0], np.cumsum(ones)])[:-1].astype(np.int32))
            self.zeros.append(int(self.n - bit.sum()))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.bits[level][word] & mask)

    def starts(self, n_symbols: int) -> np.ndarray:
        """Where each symbol's block begins below the last level."""
        start, symbol = np.zeros(n_symbols, np.int64), np.arange(n_symbols)
        for k in range(self.levels):
            s = self._ones(k, start).astype(np.int64)
            start = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + s, start - s)
        return start

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place of ``at`` followed down the levels of ``symbol``; less the
        symbol's block start it is the symbol's count before ``at``."""
        for k in range(self.levels):
            ones = self._ones(k, at)
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at


class FMIndex:
    """Backward search over segments, each closed by symbol 0."""

    def __init__(self, segments: list[np.ndarray]):
        flat = np.concatenate(segments)
        self.vocabulary, codes = np.unique(flat, return_inverse=True)
        size = np.array([len(s) for s in segments])
        self.end = np.cumsum(size + 1) - 1                              # place of each segment's closing 0
        text = np.zeros(int(self.end[-1]) + 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[self.end] = False
        text[inside] = codes + 1
        self.text, self.size = text, size
        order = suffix_order(text, int(size.max()) + 1)
        counts = np.bincount(text, minlength=len(self.vocabulary) + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.tree = WaveletTree(text[order - 1], len(self.vocabulary) + 1)
        # first[c] plus the symbol's count before a place, in one number.
        self.shift = self.first[:-1] - self.tree.starts(len(self.vocabulary) + 1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with ``symbol`` and what [low, high) begin with."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        move = self.shift[symbol]
        return both[:len(symbol)] + move, both[len(symbol):] + move

    def repeated_windows(self, width: int) -> np.ndarray:
        """For every place of the text, whether a window of ``width`` words
        begins there that also begins elsewhere.

        Each segment has its last undecided window. From that window's end the
        match is extended to the left until it is the only one (or the segment
        begins). A match of ``width`` words or more settles all windows in it. The word
        that ended the match then gets a short test: if it and the few words
        after it are unique, so is every window around them.
        """
        base = self.end - self.size                       # first word of each segment
        again = np.zeros(len(self.text), np.int8)
        seg = np.arange(len(self.size))
        left = self.size - width                          # last undecided window of each segment
        stop = left + width - 1                           # last word of the running match
        at, testing, short = stop.copy(), np.zeros(len(seg), bool), 8
        low, high = self.first[self.text[base + at]], self.first[self.text[base + at] + 1]
        floor = np.zeros(len(seg), np.int64)              # the match is not extended beyond it
        while len(seg):
            single = high - low <= 1
            over = single | (at <= floor)
            if not over.all():
                g = np.flatnonzero(~over)
                low[g], high[g] = self.extend(self.text[base[seg[g]] + at[g] - 1], low[g], high[g])
                at[g] -= 1
            d = np.flatnonzero(over)
            if not len(d):
                continue
            begin = np.where(single[d], at[d] + 1, at[d])  # first word of the match that occurs elsewhere
            test = testing[d]
            full = ~test & (stop[d] - begin + 1 >= width)
            f = d[full]
            np.add.at(again, base[seg[f]] + begin[full], 1)
            again_end = base[seg[f]] + left[f] + 1
            np.subtract.at(again, again_end, 1)
            new_left = np.where(full, begin - 1, left[d] - 1)
            # A test that was unique rules out the windows around [floor, stop].
            new_left = np.where(test, np.where(single[d], np.minimum(left[d], stop[d] - width), left[d]), new_left)
            # After a match that ended early, test the word that ended it with the few after it.
            tip = begin - 1
            want = ~test & single[d] & (new_left >= 0) & (tip + short - 1 < stop[d]) & (tip - new_left < width)
            left[d] = new_left
            testing[d] = want
            stop[d] = np.where(want, tip + short - 1, new_left + width - 1)
            floor[d] = np.where(want, tip, 0)
            at[d] = stop[d]
            live = left >= 0
            if not live.all():
                seg, left, stop, at, testing, low, high, floor = (x[live] for x in (seg, left, stop, at, testing, low, high, floor))
                d = np.cumsum(live)[d[live[d]]] - 1
            c = self.text[base[seg[d]] + at[d]]
            low[d], high[d] = self.first[c], self.first[c + 1]
        return np.cumsum(again) > 0


def repeated_runs(segments: list[np.ndarray], places: np.ndarray, width: int) -> list[list[tuple[int, int]]]:
    """For each distinct segment with its number of places: the runs (first
    window, number of windows) whose windows occur twice or more."""
    index = FMIndex(segments)
    again = index.repeated_windows(width)
    for k in np.flatnonzero(places > 1):
        again[index.end[k] - index.size[k]:index.end[k] - width + 1] = True
    edge = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(index.end, first, side="right")
    out: list[list[tuple[int, int]]] = [[] for _ in segments]
    for k, a, b in zip(owner.tolist(), first.tolist(), last.tolist()):
        out[k].append((a - int(index.end[k] - index.size[k]), b - a))
    return out


def _search(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        drop()
        runs = repeated_runs([np.frombuffer(x, np.uint32) for x in pdf["words"]], pdf["places"].to_numpy(), width)
        keep = [k for k, r in enumerate(runs) if r]
        return pd.DataFrame({"route": pdf["route"].to_numpy()[keep], "segment": pdf["segment"].to_numpy()[keep], "found": [[{"o": a, "n": n} for a, n in runs[k]] for k in keep]})

    return run


# ---- over all documents -----------------------------------------------------

def repeated_intervals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(_f_row, covered): the word ranges [from, to) of each row of
    (_f_row, text) that windows occurring twice or more cover, unmerged."""
    spark = docs.sparkSession
    run, schema = _runs(window, gram)
    runs = stored(docs.select("_f_row", "text").mapInArrow(run, schema), "fm-runs")
    twice = runs.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1")
    left = runs.join(twice, "anchor").select("_f_row", "first", "n", "anchor", (F.col("c") > hot).alias("hot"))
    by_row = stored(left.groupBy("_f_row").agg(F.collect_list(F.struct("first", "n", "anchor", "hot")).alias("runs")), "fm-candidates")
    del twice, left
    release(spark)
    cut, schema = _cutter(window)
    segments = stored(docs.select("_f_row", "text").join(by_row, "_f_row").select("_f_row", "text", "runs").mapInArrow(cut, schema)
                      .withColumn("segment", F.xxhash64("words", "route")), "fm-segments")
    release(spark)
    total = segments.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = max(1, -(-total // (4 * shard_words)))
    distinct = segments.groupBy("route", "segment").agg(F.first("words").alias("words"), F.count("*").alias("places"))
    found = (distinct.withColumn("_f_shard", F.pmod(F.xxhash64("route"), F.lit(shards))).groupBy("_f_shard")
             .applyInPandas(_search(window), "route long, segment long, found array<struct<o:int,n:int>>"))
    found = stored(found, "fm-found")
    del distinct
    release(spark)
    hits = segments.select("_f_row", "first", "route", "segment").join(found, ["route", "segment"]).select("_f_row", "first", F.explode("found").alias("f"))
    return hits.select("_f_row", F.struct((F.col("first") + F.col("f.o")).alias("a"), (F.col("first") + F.col("f.o") + F.col("f.n") + (window - 1)).alias("b")).alias("r"))


def _strip():
    """Words left of each text, and their digest."""
    import hashlib

    schema = pa.schema([("_f_row", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept, digest = [], [], [], []
            for t, ranges in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                w = (t or b"").split()
                n.append(len(w))
                if ranges:
                    live = np.ones(len(w), bool)
                    for r in ranges:
                        live[r["a"]:r["b"]] = False
                    w = [w[k] for k in np.flatnonzero(live)]
                gone.append(n[-1] - len(w))
                text = b" ".join(w)
                kept.append(text.decode("utf-8"))
                digest.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, f.type) for x, f in zip((n, gone, kept, digest), list(schema)[1:])]], schema=schema)

    return run, "_f_row long, n_words long, n_removed long, kept string, kept_sha256 string"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT,
                   shard_words: int = SHARD_WORDS, columns: tuple = ("n_words", "n_removed", "kept", "kept_sha256")) -> DataFrame:
    """Documents with the words left when every word in a repeated window goes.

    Where the ids are unique whole numbers they name the rows; else the rows
    are numbered in a stored copy.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col), F.col(text).alias("text"))
    named = dict(rows.dtypes)[id_col] in ("bigint", "int") and rows.groupBy(id_col).count().where(F.col(id_col).isNull() | (F.col("count") > 1)).isEmpty()
    rows = rows.withColumn("_f_row", F.col(id_col).cast("long")) if named else stored(rows.withColumn("_f_row", F.monotonically_increasing_id()), "fm-documents")
    covered = repeated_intervals(rows, window, gram, hot, shard_words)
    ranges = stored(covered.groupBy("_f_row").agg(F.collect_list("r").alias("_f_ranges")), "fm-ranges")
    del covered
    release(spark)
    run, schema = _strip()
    done = rows.join(ranges, "_f_row", "left").select("_f_row", "text", "_f_ranges").mapInArrow(run, schema)
    if named:
        return done.select(F.col("_f_row").cast(dict(docs.dtypes)[id_col]).alias(id_col), *columns)
    return done.select("_f_row", *columns).join(rows.select("_f_row", id_col), "_f_row").select(id_col, *columns)


# ---- registered query -------------------------------------------------------

def op8_fm_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), columns=("n_words", "n_removed", "kept_sha256"))
