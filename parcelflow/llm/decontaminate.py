"""Benchmark decontamination with one Aho-Corasick automaton.

The automaton holds every window of ``WINDOW`` consecutive words of every
benchmark text (a shorter text is one window). Its letters are words: the
benchmark's normalised words are numbered, and a document is normalised the
same way and scanned once as a sequence of those numbers. A match's end is the
last word of the occurrence, and the words' places in the original text give
the reported character spans.

The benchmark is the stated query set. Equal texts are one entry with the list
of their items. Entries are dealt by hash into blocks of about ``BLOCK_WORDS``
words, at most ``WINDOW`` nodes a word, so the automaton a worker builds stays
bounded however large the benchmark grows; each further block is one more pass
over the documents.

Defined results: null and empty texts have no words and are clean; an empty
benchmark hits nothing; a benchmark text without words has no window; an item
without id counts for hits and not for items; repeated items or rows are each
judged alike. Extra columns are carried through, but for those named like a
result, which it replaces; working columns start with ``_d_``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .worker import keep

WINDOW = 13
#: A document is contaminated when hit words are at least one in so many.
ONE_IN = 20
#: Words of the distinct benchmark texts in one automaton, on average.
BLOCK_WORDS = 150_000

#: Bytes of a word (ASCII letters and digits, all beyond ASCII), A-Z lower-cased; the others become spaces.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(FOLD).split()


def numbered_texts(texts: list[str]) -> tuple[dict[bytes, int], list[list[int]]]:
    """Numbers from 1 of the texts' normalised words, and the texts in them."""
    number: dict[bytes, int] = {}
    return number, [[number.setdefault(w, len(number) + 1) for w in normal_words(t)] for t in texts]


def windows_automaton(texts: list[list[int]], window: int = WINDOW):
    """Automaton over word numbers; a window's value is its number of words and
    the places in ``texts`` of those that hold it."""
    import ahocorasick

    a = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for at, w in enumerate(texts):
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            key = tuple(w[k:k + window])
            value = a.get(key, None)
            if value is None:
                a.add_word(key, (len(key), [at]))
            elif value[1][-1] != at:
                value[1].append(at)
    if len(a):
        a.make_automaton()
    return a


def scan(text: str | None, number: dict[bytes, int], automaton) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged word ranges [from, to) inside occurrences, and
    the places of the benchmark texts found. Words of no benchmark text are 0."""
    w = normal_words(text)
    if not w or not len(automaton):
        return len(w), [], set()
    ranges, found = [], set()
    get = number.get
    for end, (n, texts) in automaton.iter(tuple([get(x, 0) for x in w])):
        ranges.append((end + 1 - n, end + 1))
        found.update(texts)
    return len(w), _union(ranges), found


def _scanner(key: str, shared, text_at: int, columns: list[str]):
    """Adds the block's findings to those of the blocks before it."""
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, texts, ids, window = shared.value
        automaton = keep(("automaton", key), lambda: windows_automaton(texts, window))
        for batch in batches:
            docs = batch.column(text_at).to_pylist()
            before_words, before_items = (batch.column(columns.index(c)).to_pylist() for c in ("_d_ranges", "_d_items"))
            n, ranges, items = [], [], []
            for t, r0, i0 in zip(docs, before_words, before_items):
                k, r, found = scan(t, number, automaton)
                n.append(k)
                r = _union([(x["first"], x["end"]) for x in r0] + r) if r0 else r
                ranges.append([{"first": a, "end": b} for a, b in r])
                items.append(sorted({i for x in found for i in ids[x]}.union(i0)))
            new = {"_d_n": pa.array(n, pa.int64()), "_d_ranges": pa.array(ranges, span), "_d_items": pa.array(items, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(k)) for k, c in enumerate(columns)], names=columns)

    return run


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with _d_n (words), _d_ranges (hit word ranges) and _d_items."""
    spark: SparkSession = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where("t is not null")
    # A hot text is one row; its items are added up in parts before the shuffle.
    texts = items.groupBy("t").agg(F.sort_array(F.collect_set("i")).alias("ids")).withColumn("n", F.regexp_count("t", F.lit(WORD.pattern))).where("n > 0")
    texts = stored(texts, "benchmark-texts")
    total = texts.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    out = docs.select("*", F.lit(0).cast("long").alias("_d_n"), F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)").alias("_d_ranges"),
                      F.expr("cast(array() as array<bigint>)").alias("_d_items"))
    schema = out.schema
    for b in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).orderBy("t").collect()   # one block, bounded by block_words
        number, words = numbered_texts([r["t"] for r in rows])
        shared = spark.sparkContext.broadcast((number, words, [r["ids"] for r in rows], window))
        if b:
            out = stored(out, "decontaminate-block")
        out = out.mapInArrow(_scanner(f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}", shared, docs.columns.index(text), out.columns), schema)
    return out


def hit_words(ranges: Column) -> Column:
    return F.aggregate(ranges, F.lit(0).cast("long"), lambda t, x: t + x["end"] - x["first"])


def contaminated(n_words: Column, n_hit: Column) -> Column:
    return (n_hit > 0) & (ONE_IN * n_hit >= n_words)


def spans(text: str | None, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character spans in the original text of hit word ranges."""
    at = [m.span() for m in WORD.finditer(text or "")] if ranges else []
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def original_spans(text: Column | str, ranges: Column | str) -> Column:
    """Column of ``spans``: array of struct(start, end) into the text."""
    @F.pandas_udf("array<struct<start:int,end:int>>")
    def of(t: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b} for a, b in spans(x, [(y["first"], y["end"]) for y in rs])] for x, rs in zip(t, r)])

    return of(text, ranges)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, items, hit_spans (characters of the
    original text) and contaminated."""
    found = find(docs, benchmark, text)
    own = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "hit_spans", "contaminated")]
    return found.select(*own, F.col("_d_n").alias("n_words"), hit_words(F.col("_d_ranges")).alias("n_hit"),
                        F.col("_d_items").alias("items"), original_spans(text, "_d_ranges").alias("hit_spans"),
                        contaminated(F.col("_d_n"), hit_words(F.col("_d_ranges"))).alias("contaminated"))


# ---- registered query and pipeline stage ------------------------------------

def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("_d_items", lambda x: x.cast("string"))), ",")
    hit = hit_words(F.col("_d_ranges"))
    return found.select("doc_id", F.col("_d_n").alias("n_words"), hit.alias("n_hit"), F.size("_d_items").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), contaminated(F.col("_d_n"), hit).alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not contaminated."""
    found = find(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~contaminated(F.col("_d_n"), hit_words(F.col("_d_ranges")))).select(*docs.columns)
