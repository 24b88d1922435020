"""MinHash near-duplicate detection with fast similarity sketching.

Sketch (Dahlgaard, Knudsen and Thorup, 2017): ``t`` coordinates are filled by
rounds. In each of the first ``t`` rounds every element is hashed into a bin
with a value that grows with the round, so an earlier round always wins; in the
next ``t`` rounds round i fills bin i alone. Every coordinate is therefore
filled, and the share of equal coordinates concentrates around the Jaccard
similarity like that of independent permutations, in O(n + t log t) hashes.

Bands of the sketch give candidate buckets. No bucket is expanded into pairs:
each member is compared with its bucket's smallest member, exactly, on the full
shingle sets. Only buckets whose members are then still in different components
are looked at again, and there only pairs across components (see ``_rest``).

Defined results: a null or empty text has the empty set, is linked with nothing
and stays; texts with equal sets form one class, of which the smallest id
stands for all; repeated rows with one id get the same answer; a row without an
id has no component and stays. Extra columns are carried through; working
columns start with ``_m_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import components, stored, table
from .worker import drop

#: Bands and rows a band. At a similarity of 0.85 a link's chance to share no
#: band is (1 - 0.85 ** 8) ** 48 = 2e-7; at 0.8 it is 2e-4.
BANDS, ROWS = 48, 8
#: The pipeline stage's, for links at 0.8: (1 - 0.8 ** 7) ** 54 = 3e-6.
STAGE_BANDS, STAGE_ROWS = 54, 7
#: Hash classes of the bound on common shingles; more are tighter, and wider rows.
CLASSES = 64
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---- per batch of texts -----------------------------------------------------

def shingle_sets(words: W.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ordered by (text, hash), and
    their texts. A text with fewer than ``width`` words, but some, has its
    whole sequence as its one shingle."""
    g, at = W.windows(words, width)
    doc = words.doc[at]
    n = np.diff(words.bounds)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        s = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            live = n[short] > k
            s[live] = W.mix((s[live] + words.hash[words.bounds[short[live]] + k]) * np.uint64(W.BASE) + np.uint64(k + 1))
        g, doc = np.concatenate([g, s]), np.concatenate([doc, short])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    return g[new], doc[new]


def sketches(x: np.ndarray, doc: np.ndarray, n_docs: int, t: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``t`` values per text; the rows of
    texts without elements stay ``FULL``."""
    out = np.full(n_docs * t, FULL)
    open_docs = np.zeros(n_docs, bool)
    open_docs[doc] = True
    for i in range(2 * t):
        if not len(x):
            break
        h = W.mix(x + np.uint64((i + 1) * W.BASE & 0xFFFFFFFFFFFFFFFF))
        bins = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else np.full(len(x), i - t)
        # Bits that chose the bin are independent of those of the value.
        np.minimum.at(out, doc * t + bins, np.uint64(i << 44) | (W.mix(h) >> np.uint64(20)))
        if i < 8 or i % 8 == 7:
            rows = np.flatnonzero(open_docs)
            done = rows[(out.reshape(n_docs, t)[rows] != FULL).all(axis=1)]
            if len(done):
                open_docs[done] = False
                live = open_docs[doc]
                x, doc = x[live], doc[live]
    return out.reshape(n_docs, t)


def bands_of(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    s = sketch.reshape(len(sketch), bands, rows)
    h = np.zeros(s.shape[:2], np.uint64) + np.arange(bands, dtype=np.uint64)[None, :]
    for k in range(rows):
        h = W.mix((h + s[:, :, k]) * np.uint64(W.BASE))
    return h


def _sum_by(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    b = np.searchsorted(doc, np.arange(n + 1))
    return total[b[1:]] - total[b[:-1]]


def _signatures(width: int, bands: int, rows: int):
    schema = pa.schema([("_m_id", pa.int64()), ("_m_n", pa.int64()), ("_m_f1", pa.int64()), ("_m_f2", pa.int64()),
                        ("_m_bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        for batch in batches:
            ids = batch.column(0)
            for w in W.slices(batch.column(1), W.NOT_SPACE, W.LOWER):
                x, doc = shingle_sets(w, width)
                n = np.bincount(doc, minlength=w.n_docs)
                b = bands_of(sketches(x, doc, w.n_docs, bands * rows), bands, rows).view(np.int64)
                flat = pa.array(b[n > 0].ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]), pa.int32()), flat)
                f1, f2 = (_sum_by(W.mix(x * np.uint64(2 * k + 3)), doc, w.n_docs).view(np.int64) for k in (1, 2))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(w.first, w.n_docs), pa.array(n, pa.int64()), pa.array(f1), pa.array(f2), lists], schema=schema)

    return run, "_m_id long, _m_n long, _m_f1 long, _m_f2 long, _m_bands array<long>"


def _sets(width: int):
    schema = pa.schema([("_m_id", pa.int64()), ("_m_set", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        for batch in batches:
            ids = batch.column(0)
            for w in W.slices(batch.column(1), W.NOT_SPACE, W.LOWER):
                x, doc = shingle_sets(w, width)
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=w.n_docs))])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(w.first, w.n_docs), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.view(np.int64)))], schema=schema)

    return run, "_m_id long, _m_set array<long>"


# ---- over all documents -----------------------------------------------------

def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_shingles, component_id and kept.

    Two texts are linked when 100 * |A and B| >= ``percent`` * |A or B| over
    their sets of ``width``-word shingles (A-Z lower-cased, words split at
    ASCII white space).
    """
    src = docs.select(F.col(id_col).cast("long").alias("_m_id"), F.col(text).alias("_m_text"))
    run, schema = _signatures(width, bands, rows)
    sig = stored(src.mapInArrow(run, schema), "near-signatures")

    # A class: texts with one and the same set. Its smallest id stands for it.
    of_class = ["_m_n", "_m_f1", "_m_f2"]
    reps = stored(sig.where("_m_n > 0 and _m_id is not null").groupBy(*of_class)
                  .agg(F.min_by("_m_bands", "_m_id").alias("_m_bands"), F.min("_m_id").alias("rep")), "near-classes")
    member = reps.select(F.explode("_m_bands").alias("bucket"), "rep", F.col("_m_n").alias("n"))
    shared = member.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    member = stored(member.join(shared, "bucket").select("bucket", "rep", "n", "low"), "near-members")

    sets = _needed_sets(src, member, width)
    sizes = member.select(F.col("rep").alias("low"), F.col("n").alias("low_n")).distinct()
    star = (member.where("rep <> low").select("low", "rep", "n").distinct().join(sizes, "low")
            .where(_may_link("n", "low_n", percent)).select(F.col("low").alias("a"), F.col("rep").alias("b")))
    links = stored(_verified(star, sets, percent), "near-links")
    label = components(links, "near-components")
    rest = _rest(member, label, sets, percent)
    if rest is not None:
        label = components(links.unionByName(rest), "near-components")

    of_rep = reps.join(label.withColumnRenamed("id", "rep"), "rep", "left").select(
        *of_class, F.coalesce("component", "rep").alias("component_id"))
    found = sig.drop("_m_bands").join(of_rep, of_class, "left").select(
        "_m_id", F.col("_m_n").alias("n_shingles"), F.coalesce("component_id", "_m_id").alias("component_id"))
    return found.select(F.col("_m_id").alias(id_col), "n_shingles", "component_id",
                        F.coalesce(F.col("_m_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _may_link(n: str, m: str, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _needed_sets(src: DataFrame, member: DataFrame, width: int) -> DataFrame:
    """Full shingle sets of the texts that share a bucket with another."""
    need = member.select(F.col("rep").alias("_m_id")).distinct()
    run, schema = _sets(width)
    got = src.join(need, "_m_id", "left_semi").select("_m_id", "_m_text").mapInArrow(run, schema)
    return stored(got.dropDuplicates(["_m_id"]), "near-sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links on the full sets."""
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(sets.select(F.col("_m_id").alias("a"), F.col("_m_set").alias("sa")), "a")
            .join(sets.select(F.col("_m_id").alias("b"), F.col("_m_set").alias("sb")), "b")
            .where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b"))


def _rest(member: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links between different components that share a bucket.

    Comparing with the smallest member joins nearly every group of copies, so
    few buckets still hold two components. Their members are paired across
    components only, and only where a bound on the common shingles allows a
    link: shingles found in one component alone can't be common, and of the
    others, counted by ``CLASSES`` hash classes, two texts share at most the
    smaller count of each class. The bound never rules out a link.
    """
    m = member.join(label.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "bucket", "rep", "n", F.coalesce("component", "rep").alias("c"))
    mixed = m.groupBy("bucket").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("bucket")
    m = stored(m.join(mixed, "bucket"), "near-mixed")
    if m.isEmpty():
        return None
    texts = m.select(F.col("rep").alias("_m_id"), "c").distinct()
    token = sets.join(texts, "_m_id").select("_m_id", "c", F.explode("_m_set").alias("g"))
    common = token.groupBy("g").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("g")
    of_class = F.pmod(F.col("g"), F.lit(CLASSES))
    counts = token.join(common, "g").groupBy("_m_id").agg(
        F.array(*[F.count(F.when(of_class == k, 1)).cast("int") for k in range(CLASSES)]).alias("v"), F.count("*").alias("s"))
    m = stored(m.join(counts.withColumnRenamed("_m_id", "rep"), "rep"), "near-counted")
    a, b = m.alias("a"), m.alias("b")
    at_most = F.aggregate(F.zip_with("a.v", "b.v", lambda x, y: F.least(x, y)), F.lit(0), lambda t, x: t + x)
    enough = lambda shared: (100 + percent) * shared >= percent * (F.col("a.n") + F.col("b.n"))
    on = ((F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.c") < F.col("b.c")) & _may_link("a.n", "b.n", percent)
          & enough(F.least("a.s", "b.s")) & enough(at_most))
    pairs = a.join(b, on).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()
    return stored(_verified(pairs, sets, percent), "near-rest")


# ---- registered query and pipeline stage ------------------------------------

def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, percent=85, width=3)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near duplicates (5-word
    shingles, similarity 0.8), the one with the smallest id."""
    found = near_duplicates(docs.select("doc_id", "text"), percent=80, width=5, bands=STAGE_BANDS, rows=STAGE_ROWS)
    out = found.where(~F.col("kept")).select("doc_id")
    return docs.join(out, "doc_id", "left_anti")
