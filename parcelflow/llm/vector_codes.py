"""Vector code compression: product codes whose nearest entries come from a GNAT.

Each component x becomes the integer floor(scale * x), vectors are cut into
equal consecutive parts, and every part position has a codebook of integer
entries: first the parts of the smallest ids, then some rounds of assigning all
parts to their nearest entries and moving each entry to the floor of its parts'
mean. A code names the nearest entry of each part (ties to the lower index).

The nearest entry is found by a geometric near-neighbour access tree (Brin,
1995) over the entries. A node has split points, far from each other; every
other entry belongs to its nearest split point, and for each split point i and
child j the node stores the range of distances from i to the entries of j. A
query measures its distance to the split points; by the triangle inequality a
child whose range, for any i, lies further from d(q, p_i) than the best
distance so far holds no better entry. A child goes only when it is strictly
further: distances are square roots of exact integers, rounded down where they
serve as lower bounds and up where they serve as upper ones, so an entry at
equal distance is never lost. What is left is decided by exact integer squared
distances, and the lower index wins a tie.

A batch of vectors descends the tree together in NumPy. A task sends counts and
sums per entry, never vectors, so a round shuffles at most one row per part,
entry and task; the codebooks (parts * entries * part length integers) are all
that reaches the driver. Components of 2**20 and more in size are worked on in
Python integers, exactly but slowly.

Defined results: rows whose vector is null, holds null or non-finite components,
or has another length than the smallest kept id's are dropped; components
beyond the last equal cut are ignored; repeated rows count as often as they
occur (equal ids are ordered by their vectors; null ids come last); fewer rows
than entries give as many entries; extra columns are left out; an empty table
gives an empty result. Errors beyond 64 bits are given as the largest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .worker import keep, trim

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a node, and entries below which a node is a plain list.
SPLITS, LEAF = 12, 24
#: Components of this size and more need Python integers (64 products of differences must stay below 2**53).
EXACT = 1 << 20
LARGEST = (1 << 63) - 1
#: Labels up to which their sums are broadcast (24 bytes each).
FEW_LABELS = 100_000
SALTS = 32


# ---- the tree over one codebook -------------------------------------------------

def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``."""
    if a.dtype == object or b.dtype == object:
        a, b = a.astype(object), b.astype(object)
        return np.stack([((a - row) ** 2).sum(1) for row in b], 1) if len(b) else np.zeros((len(a), 0), object)
    if a.shape[1] * 4 * EXACT * EXACT >= 1 << 53:              # float64 would round
        top = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)), 1)
        if a.shape[1] * 4 * top * top >= 1 << 53:
            return np.stack([((a - row) ** 2).sum(1) for row in b], 1)
    x, y = a.astype(np.float64), b.astype(np.float64)
    return ((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)).astype(np.int64)


def _root(squared: np.ndarray, up: bool) -> np.ndarray:
    """Square roots, rounded outwards beyond any error of float arithmetic."""
    r = np.sqrt(squared.astype(np.float64))
    return r * (1 + 1e-12) + 1e-9 if up else np.maximum(r * (1 - 1e-12) - 1e-9, 0)


class Gnat:
    """Nearest entry of integer points, exact, ties to the lower index."""

    def __init__(self, points: np.ndarray, index: np.ndarray | None = None):
        self.index = np.arange(len(points)) if index is None else index
        self.points = points
        self.measured = 0                       # distances measured, for tests
        self.children: list[Gnat | None] = []
        if len(points) <= LEAF:
            return
        far = _squared(points, points)
        chosen = [int(far.sum(1).argmax())]
        near = far[chosen[0]].copy()
        while len(chosen) < SPLITS and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, far[chosen[-1]])
        if len(chosen) < 2:                     # all entries are equal
            return
        self.splits = np.array(chosen)
        of = far[:, self.splits].argmin(1)
        of[self.splits] = np.arange(len(chosen))
        rest = np.ones(len(points), bool)
        rest[self.splits] = False
        m = len(chosen)
        self.low, self.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        for j in range(m):
            member = np.flatnonzero((of == j) & rest)
            self.children.append(Gnat(points[member], self.index[member]) if len(member) else None)
            if len(member):
                d = far[np.ix_(self.splits, member)]
                self.low[:, j], self.high[:, j] = _root(d.min(1), False), _root(d.max(1), True)

    def search(self, q: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        """Lower ``best`` (squared distance) and ``at`` (index) in place, for each row of ``q``."""
        if not len(q):
            return
        if not self.children:
            self._offer(_squared(q, self.points), self.index, best, at, np.arange(len(q)))
            return
        d = _squared(q, self.points[self.splits])
        self._offer(d, self.index[self.splits], best, at, np.arange(len(q)))
        down, up = _root(d, False), _root(d, True)
        # Lower bound of the distance to anything in child j, over all split points i.
        bound = np.stack([np.maximum(down - self.high[:, j], self.low[:, j] - up).max(1) for j in range(len(self.children))], 1)
        nearest = d.argmin(1)
        for first in (True, False):             # the nearest split point's child sets a good bound for the others
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                go = np.flatnonzero(((nearest == j) == first) & (bound[:, j] <= _root(best, True)))
                if len(go):
                    b, a, before = best[go], at[go], child.measured
                    child.search(q[go], b, a)
                    best[go], at[go] = b, a
                    self.measured += child.measured - before

    def _offer(self, d, index, best, at, rows) -> None:
        self.measured += d.size
        order = np.argsort(index)
        k = order[d[:, order].argmin(1)]        # the lower index of equal distances
        mine = d[rows, k]
        better = (mine < best) | ((mine == best) & (index[k] < at))
        best[better], at[better] = mine[better], index[k][better]

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        exact = q.dtype == object or self.points.dtype == object
        best = np.array([1 << 200] * len(q), object) if exact else np.full(len(q), LARGEST)
        at = np.full(len(q), len(self.points))
        self.search(q, best, at)
        return best, at


# ---- batches ----------------------------------------------------------------------

def _integers(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of a batch as rows of integers."""
    flat = column.flatten()
    x = flat.to_numpy(zero_copy_only=False)
    if x.dtype == object or (len(x) and np.abs(x).max() >= EXACT):
        x = np.array([int(v) for v in flat.to_pylist()], object)
    elif x.dtype != np.int64:
        x = x.astype(np.int64)
    return x.reshape(-1, length)


def _books(books: list, parts: int) -> list[Gnat]:
    def build():
        made = []
        for book in books:
            a = np.array(book, object)
            made.append(Gnat(a if len(a) and max(abs(v) for v in a.ravel()) >= EXACT else a.astype(np.int64)))
        return made

    return keep(("codebooks", str(books)), build)


def _assigned(x: np.ndarray, trees: list[Gnat]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    width = x.shape[1] // len(trees)
    found = [t.nearest(x[:, p * width:(p + 1) * width]) for p, t in enumerate(trees)]
    return [a for _, a in found], [d for d, _ in found]


def _summer(books: list, length: int):
    """Counts and sums of each entry's parts, one row per part and entry of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _books(books, len(books))
        width, total = length // len(books), {}
        for batch in batches:
            x = _integers(batch.column(0), length)
            codes, _ = _assigned(x, trees)
            for p, code in enumerate(codes):
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                sums = np.add.reduceat(x[order, p * width:(p + 1) * width], first, axis=0) if len(used) else []
                for e, n, s in zip(used.tolist(), np.diff([*first, len(code)]).tolist(), sums):
                    old = total.get((p, e))
                    total[p, e] = (n, s) if old is None else (old[0] + n, old[1] + s)
        rows = sorted(total)
        yield pa.RecordBatch.from_arrays([
            pa.array([p for p, _ in rows], pa.int32()), pa.array([e for _, e in rows], pa.int32()), pa.array([total[k][0] for k in rows], pa.int64()),
            pa.array([[str(v) for v in total[k][1].tolist()] for k in rows], pa.list_(pa.string()))], names=["part", "entry", "n", "sums"])
        trim()

    return run


def _coder(books: list, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _books(books, len(books))
        for batch in batches:
            x = _integers(batch.column(2), length)
            codes, errors = _assigned(x, trees)
            code = np.stack(codes, 1).astype(np.uint8).tobytes().hex() if len(x) else ""
            width = 2 * len(trees)
            error = [min(int(v), LARGEST) for v in sum(errors)] if len(x) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([code[k:k + width] for k in range(0, len(code), width)], pa.string()), pa.array(error, pa.int64())],
                                             names=["vec_id", "label", "code", "error"])
        trim()

    return run


# ---- over the whole table -----------------------------------------------------------

def _kept(rows: DataFrame, scale: int) -> tuple[DataFrame, int]:
    """Usable rows (vec_id, label, v of integers) and the length of their vectors."""
    whole = F.expr(f"transform(vector, x -> floor(cast(x as double) * {scale}d))")
    big = F.expr(f"transform(vector, x -> cast(floor(cast(cast(x as double) as decimal(38,9)) * {scale}) as decimal(38,0)))")
    finite = F.expr("forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    small = F.expr(f"forall(vector, x -> abs(cast(x as double)) * {scale} < 4611686018427387904d)")
    d = rows.where(F.coalesce(F.col("vector").isNotNull() & finite, F.lit(False)))
    d = d.select("vec_id", "label", F.when(small, whole.cast("array<decimal(38,0)>")).otherwise(big).alias("v"), small.alias("small"))
    if not d.where("not small").isEmpty():
        d = d.where("v is not null")
    else:
        d = d.select("vec_id", "label", F.col("v").cast("array<long>").alias("v"), "small")
    d = stored(d.drop("small"), "vectors")
    first = d.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("n")).first()
    if first is None:
        return d, 0
    return d.where(F.size("v") == first["n"]), first["n"]


def fit(vectors: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[list[list[int]]]:
    """Codebooks: part, entry, component. ``vectors`` has vec_id and v."""
    width = length // parts
    if not width:
        return [[] for _ in range(parts)]
    least = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = [[[int(x) for x in r["v"][p * width:(p + 1) * width]] for r in least] for p in range(parts)]
    v = vectors.select(F.slice("v", 1, parts * width).alias("v"))
    for _ in range(rounds):
        sent = v.mapInArrow(_summer(books, parts * width), "part int, entry int, n long, sums array<string>")
        # At most parts * entries rows come back.
        sums = sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[k].cast("decimal(38,0)")) for k in range(width)]).alias("sums")).collect()
        for r in sums:
            books[r["part"]][r["entry"]] = [int(s) // r["n"] for s in r["sums"]]
    return books


def codes(rows: DataFrame, vector: str = "embedding", id_col: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list]:
    """(vec_id, label, code, error) of every usable row, and the codebooks."""
    src = rows.select(F.col(id_col).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    kept, length = _kept(src, scale)
    books = fit(kept, length, parts, entries, rounds)
    width = length // parts
    kinds = f"vec_id {src.schema['vec_id'].dataType.simpleString()}, label {src.schema['label'].dataType.simpleString()}, code string, error long"
    if not width:                                # no rows, or vectors shorter than the parts
        return kept.select("vec_id", "label", F.lit("00" * parts).alias("code"), F.lit(0).cast("long").alias("error")), books
    v = kept.select("vec_id", "label", F.slice("v", 1, parts * width).alias("v"))
    return v.mapInArrow(_coder(books, parts * width), kinds), books


def books_text(books: list) -> str:
    return ",".join(str(x) for book in books for entry in book for x in entry)


# ---- registered query -----------------------------------------------------------------

def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    import hashlib

    coded, books = codes(table(spark, sf_dir, "embeddings"))
    coded = stored(coded, "vector-codes")
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-label-errors")
    if sums.count() <= FEW_LABELS:
        out = coded.alias("l").join(F.broadcast(sums).alias("r"), F.col("l.label").eqNullSafe(F.col("r.label")))
    else:                                        # a label's rows are dealt over SALTS tasks
        each = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
        out = rows.alias("l").join(each.alias("r"), F.col("l.label").eqNullSafe(F.col("r.label")) & (F.col("l.salt") == F.col("r.salt")))
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return out.select("l.vec_id", "l.code", "l.error", "r.label_error", F.lit(digest).alias("codebooks_sha256"))
