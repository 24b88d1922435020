"""Token ids in Re-Pair compressed files with random access.

Documents are tokenised, ordered by id over range partitions and cut into
shards of about ``SHARD_TOKENS`` ids. Each shard is compressed on its own by
Re-Pair: the most frequent pair of neighbouring ids becomes a new symbol, again
and again, until no pair is frequent enough to pay. A round replaces many pairs
at once, the more frequent first where two overlap, so every step is a pass of
NumPy over the places that may have changed. The first ``CHOOSY_ROUNDS`` rounds
take the ``PAIRS_PER_ROUND`` most frequent pairs, the others all that are left.

File format: one Parquet row per shard, in ascending order of the documents:

==============  =============================================================
shard, part     number within the range partition, and that partition
n_tokens        ids of the shard
first_symbol    number of the first nonterminal (ids are below it)
rules           uint32 pairs: what nonterminal ``first_symbol + k`` stands for
lengths         uint32: how many ids each nonterminal expands to
sequence        the compressed symbols, ``width`` bytes each
doc_ids         int64 ids of the documents, in order
doc_starts      int64: first id of each document in the shard, and the end
==============  =============================================================

``lengths`` make any run of ids decodable without the rest (``read_range``).

Defined results: null and empty texts are the end id alone; repeated rows are
written as often as they occur, a null id before all others; an empty table
gives no file rows and an empty result. Extra columns are ignored; working
columns start with ``_g_``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table
from .tokens import piece_tokenizer, tokenizer_path

END_ID = 1
SHARD_TOKENS = 1 << 21
#: Pairs replaced by each of the first rounds, so that the most frequent come first; the later rounds take all.
CHOOSY_ROUNDS, PAIRS_PER_ROUND = 3, 16384
#: A pair is replaced when it occurs so often; a rule costs three numbers.
MIN_COUNT = 4
FIRST_SYMBOL = 1 << 16

FILE = ("_g_part int, shard int, n_tokens long, first_symbol long, rules binary, lengths binary, width int, sequence binary, "
        "doc_ids array<long>, doc_starts array<long>")


# ---- Re-Pair of one shard ---------------------------------------------------

def _frequent(first: np.ndarray, second: np.ndarray, at: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (first, second) that occur ``min_count`` times or more, most
    frequent first, as ``first << 32 | second``, with the places ``at`` where
    one stands and the pair's rank there.

    Pairs are counted exactly: sorted together with their places, in one number
    where the three fit in 64 bits.
    """
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    symbol, place = (np.uint64(int(x).bit_length()) for x in (max(first.max(), second.max()), at.max()))
    code = first.astype(np.uint64)
    code <<= symbol
    code |= second
    if 2 * symbol + place <= 64:
        code <<= place
        code |= at.astype(np.uint64)
        code.sort()
        at = (code & np.uint64((1 << int(place)) - 1)).astype(np.int64)
        code >>= place
    else:
        order = np.argsort(code)
        at, code = at[order], code[order]
    start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    count = np.diff(start, append=len(code))
    enough = count >= min_count
    pair, often = code[start[enough]], count[enough]
    order = np.argsort(-often, kind="stable")          # of equal counts the smaller pair
    rank = np.empty(len(pair), np.int32)
    rank[order] = np.arange(len(pair), dtype=np.int32)
    pair = pair[order]
    return pair >> symbol << np.uint64(32) | pair & np.uint64((1 << int(symbol)) - 1), at[np.flatnonzero(np.repeat(enough, count))], np.repeat(rank, often)


def compress(ids: np.ndarray, rounds: int | None = None, limit: int = PAIRS_PER_ROUND, min_count: int = MIN_COUNT,
             first_symbol: int = FIRST_SYMBOL) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, rules, lengths) of a shard's ids.

    Goes on until no pair occurs ``min_count`` times (without overlaps), where
    Re-Pair ends, too; ``rounds`` bounds it for callers who want less. The first
    ``CHOOSY_ROUNDS`` rounds take the ``limit`` most frequent pairs, the later
    ones all that are frequent enough.

    A pair's count only falls unless it holds a new symbol. So after the first
    round only places next to new symbols and those of frequent pairs not
    replaced yet are counted (``live``).
    """
    if len(ids) and int(ids.max()) >= first_symbol:
        raise ValueError("an id is not below the first nonterminal")
    seq = np.array(ids, np.uint32)
    rules: list[np.ndarray] = []
    length = [np.ones(first_symbol, np.uint32)]
    n_symbols, live, k = first_symbol, np.arange(max(len(seq) - 1, 0)), 0
    while len(live) and (rounds is None or k < rounds):
        first, second = (seq[:-1], seq[1:]) if len(live) == len(seq) - 1 else (seq[live], seq[live + 1])
        equal = np.flatnonzero(first == second)
        twins = live[equal]
        over = equal[_overlapping(seq, twins)]
        if len(over):
            free = np.ones(len(live), bool)
            free[over] = False
            free = np.flatnonzero(free)
            pairs, place, rank = _frequent(first[free], second[free], live[free], min_count)
        else:
            pairs, place, rank = _frequent(first, second, live, min_count)
        if not len(pairs):
            break
        rank_at = np.full(len(seq), -1, np.int32)
        rank_at[place] = rank
        look = rank_at >= 0
        at = np.flatnonzero(look & (rank_at < limit) if k < CHOOSY_ROUNDS else look)
        at, of = _disjoint(at, rank_at[at])
        # A pair that overlaps with more frequent ones and is left with too few places waits.
        kept = np.bincount(of, minlength=len(pairs)) >= min_count
        stays = np.flatnonzero(kept[of])
        at, of = at[stays], of[stays]
        new = (n_symbols - 1 + np.cumsum(kept)).astype(np.uint32)
        pairs = pairs[kept]
        left, right = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        seq[at] = new[of]
        here = np.ones(len(seq), bool)
        here[at + 1] = False
        # Places still to look at: frequent pairs that stay, and both sides of a new symbol.
        look[at[1:] - 1 if len(at) and at[0] == 0 else at - 1] = True
        # Overlapping occurrences of a pair of equal ids were not counted; they may count from now on.
        look[twins] = True
        left_over = np.flatnonzero(here)
        seq, look = seq[left_over], look[left_over]
        live = np.flatnonzero(look[:-1])
        rules.append(np.stack([left, right], 1).astype(np.uint32))
        every = np.concatenate(length)
        length = [every, every[left] + every[right]]
        n_symbols, k = n_symbols + len(pairs), k + 1
    table_ = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return seq, table_, np.concatenate(length)[first_symbol:]


def _overlapping(seq: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of the ``place``s of pairs of equal ids, ascending, the indexes of those
    that overlap the one before, which counts: in a run of m equal ids the
    first, third, ... place counts."""
    if not len(place):
        return np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], np.diff(place) != 1]) | np.concatenate([[True], seq[place[1:]] != seq[place[:-1]]]))
    nth = np.arange(len(place)) - np.repeat(start, np.diff(start, append=len(place)))
    return np.flatnonzero(nth % 2 == 1)


def _disjoint(at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences that do not overlap, of ascending ones: of neighbours the
    more frequent pair wins; within a run of equal rank every second one, from
    the left.

    An occurrence that no neighbour beats stays and its neighbours go, so each
    turn looks at the undecided ones only. The smallest rank of a row of
    neighbours is never beaten, so every turn decides some.
    """
    stays, todo, todo_rank = np.zeros(len(at), bool), np.arange(len(at)), rank
    place = at
    while len(todo):
        touch = place[1:] == place[:-1] + 1
        same = touch & (todo_rank[1:] == todo_rank[:-1])
        less = todo_rank[:-1] < todo_rank[1:]
        lost = np.zeros(len(todo), bool)
        lost[1:] = touch & less
        lost[:-1] |= touch & ~less & ~same
        again = np.flatnonzero(same) + 1
        if len(again):
            # Which of its run of equal rank a place is: every second one is lost.
            start = again - 1
            opens = np.concatenate([[True], np.diff(again) != 1])
            first = start[opens][np.cumsum(opens) - 1]
            lost[again[(again - first) % 2 == 1]] = True
        stays[todo[np.flatnonzero(~lost)]] = True
        # Neighbours of one that stays go.
        open_ = lost.copy()
        open_[1:] &= lost[:-1] | ~touch
        open_[:-1] &= lost[1:] | ~touch
        rest = np.flatnonzero(open_)
        todo, place, todo_rank = todo[rest], place[rest], todo_rank[rest]
    kept = np.flatnonzero(stays)
    return at[kept], rank[kept]


def expand(seq: np.ndarray, rules: np.ndarray, first_symbol: int = FIRST_SYMBOL) -> np.ndarray:
    """The ids of a run of symbols: nonterminals are replaced by their pairs
    until none is left."""
    seq = seq.astype(np.uint32)
    while True:
        big = seq >= first_symbol
        if not big.any():
            return seq
        width = 1 + big.astype(np.int64)
        end = np.cumsum(width)
        out = np.empty(int(end[-1]), np.uint32)
        pair = rules[seq[big] - first_symbol]
        out[(end - width)[~big]] = seq[~big]
        out[(end - 2)[big]], out[(end - 1)[big]] = pair[:, 0], pair[:, 1]
        seq = out


def expand_all(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_symbol: int = FIRST_SYMBOL) -> np.ndarray:
    """The ids of a whole shard: every symbol's ids stand once in a pool, and
    one gather puts them in the sequence's order."""
    n = np.concatenate([np.ones(first_symbol, np.int32), lengths.astype(np.int32)])
    start = np.concatenate([[0], np.cumsum(n, dtype=np.int64)[:-1]]).astype(np.int32)
    pool = np.concatenate([np.arange(first_symbol, dtype=np.uint32), expand(first_symbol + np.arange(len(rules), dtype=np.uint32), rules, first_symbol)])
    many = n[seq]
    ends = np.cumsum(many)
    return pool[np.repeat(start[seq] - (ends - many), many) + np.arange(int(ends[-1]) if len(ends) else 0)]


def read_range(row, start: int, n: int) -> np.ndarray:
    """Ids ``start`` to ``start + n`` - 1 of a shard row, expanding only the
    symbols that cover them."""
    seq, rules, first = _symbols(row), np.frombuffer(row["rules"], np.uint32).reshape(-1, 2), row["first_symbol"]
    length = np.concatenate([np.ones(first, np.uint32), np.frombuffer(row["lengths"], np.uint32)])
    ends = np.cumsum(length[seq].astype(np.int64))
    a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, start + n, side="left") + 1
    skip = start - (int(ends[a - 1]) if a else 0)
    return expand(seq[a:b], rules, first)[skip:skip + n]


def _symbols(row) -> np.ndarray:
    raw = row["sequence"]
    if row["width"] == 4:
        return np.frombuffer(raw, "<u4")
    b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.uint32)
    return b[:, 0] | b[:, 1] << np.uint32(8) | b[:, 2] << np.uint32(16)


def _packed(seq: np.ndarray) -> tuple[int, bytes]:
    """Symbols in three bytes each where they fit."""
    if len(seq) and int(seq.max()) >= 1 << 24:
        return 4, seq.astype("<u4").tobytes()
    return 3, np.ascontiguousarray(seq.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


# ---- writing ----------------------------------------------------------------

def _encoder(path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = piece_tokenizer(path)
        shard, kept, docs, starts, size, part = 0, [], [], [0], 0, 0

        def row() -> pa.RecordBatch:
            seq, rules, lengths = compress(np.concatenate(kept))
            width, raw = _packed(seq)
            values = [part, shard, size, FIRST_SYMBOL, rules.tobytes(), lengths.tobytes(), width, raw, docs, starts]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], y) for v, y in zip(values, types)], names=[c.split()[0] for c in FILE.split(", ")])

        for batch in batches:
            for first, ids, bounds in t.slices(batch.column(1), end_id):
                part = batch.column(2)[0].as_py()
                names = batch.column(0).slice(first, len(bounds) - 1).to_pylist()
                a = 0
                while a < len(names):
                    # Documents up to the shard's size; a longer one is a shard of its own.
                    b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + shard_tokens - size, side="right")) - 1) if size < shard_tokens else a
                    b = min(b, len(names))
                    kept.append(ids[bounds[a]:bounds[b]])
                    docs.extend(names[a:b])
                    starts.extend((size + bounds[a + 1:b + 1] - bounds[a]).tolist())
                    size += int(bounds[b] - bounds[a])
                    a = b
                    if size >= shard_tokens or a < len(names):
                        yield row()
                        shard, kept, docs, starts, size = shard + 1, [], [], [0], 0
        if docs:
            yield row()

    return run


def write(docs: DataFrame, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the documents' ids in ascending order of doc_id; returns the files
    as a DataFrame of shard rows."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return stored(src.withColumn("_g_part", F.spark_partition_id()).mapInArrow(_encoder(path, end_id, shard_tokens), FILE), "repair-files")


# ---- reading ----------------------------------------------------------------

def _decoder():
    schema = pa.schema([("_g_part", pa.int32()), ("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = expand_all(_symbols(row), np.frombuffer(row["rules"], np.uint32).reshape(-1, 2), np.frombuffer(row["lengths"], np.uint32), row["first_symbol"])
                if len(ids) != row["n_tokens"]:
                    raise ValueError("a shard expands to another number of ids than written")
                raw, cuts = memoryview(ids.astype("<u4").tobytes()), row["doc_starts"]
                n = len(row["doc_ids"])
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([row["_g_part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                                                  pa.array(cuts[:-1], pa.int64()), pa.array(np.diff(cuts), pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    return run


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from
    the files. A shard's first id is the sum of all shards before it: summed by
    range partition, then within each."""
    sizes = files.select("_g_part", "shard", "n_tokens")
    parts = sizes.groupBy("_g_part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("_g_part", F.coalesce(F.sum("n").over(Window.orderBy("_g_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))   # one row per range partition
    inner = Window.partitionBy("_g_part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(parts, "_g_part").select("_g_part", "shard", (F.col("before") + F.col("inner")).alias("first"))
    docs = files.mapInArrow(_decoder(), "_g_part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(first, ["_g_part", "shard"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


# ---- registered query -------------------------------------------------------

def op6_repair_files(spark, sf_dir: str) -> DataFrame:
    return read(write(table(spark, sf_dir, "documents"), tokenizer_path()))
