"""Quality rules as a short-circuit cascade, with DataFrame functions only.

``plan`` runs every rule alone over a sample of the documents, measures what
share each rejects and what it costs, and orders the rules by rejection per
cost. ``apply`` evaluates them in that order inside one CASE expression, so a
document that an early rule rejects never pays for the later ones.

The verdict (kept or not) is the AND of all rules and so never depends on the
order; only the reported first failing rule and the cost do.

Defined results: null and empty texts have no words and fail ``min_words``;
repeated rows are judged alike; extra columns are carried through; an empty
table gives an empty result (and the order in which the rules were given);
working columns start with ``_q_`` and are dropped.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, table, text_of, words

#: Share of a document's words that may lie in repeated 3-word windows, in percent.
MAX_REPEAT_PERCENT = 50
MIN_WORDS = 50
MAX_SYMBOL_PERCENT = 10        # symbols per 100 words
MAX_DUP_LINE_PERCENT = 50      # lines equal to an earlier line
MAX_CAPITAL_PERCENT = 30       # A-Z among the characters of words
MEAN_WORD_CHARS = (3, 10)
#: The sample on which cost and selectivity are estimated (about so many rows).
SAMPLE_ROWS = 2000
#: Partitions of the sample, and the seed that draws it.
SAMPLE_PARTS, SAMPLE_SEED = 8, 7
SYMBOLS = "[^#*$%&|<>]+"


# ---- measures of one text, each a column expression -------------------------

def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    """Code points outside ASCII white space."""
    return F.char_length(F.regexp_replace(text_of(text), SPACES, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text_of(text), SYMBOLS, "")).cast("long")


def content_lines(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(text_of(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return _let(content_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    A text whose windows are all distinct is done after one hash set. In the
    others the repeated window hashes come from a sort; where they are few, the
    windows are looked up among them, else the windows are sorted with their
    positions and equal neighbours taken. The positions' words are united.
    O(n log n) in the length of the text, so very long documents cost no more
    per word.
    """
    return _repeat_words(words(text))


FEW = 16   # repeated windows up to which a linear lookup beats the second sort


def _repeat_words(ws: Column) -> Column:
    def windows(h: Column) -> Column:
        # The last two "windows" hold fewer than three words and so equal no other.
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    def repeated_values(g: Column) -> Column:
        return _let(F.sort_array(g), lambda s: F.array_distinct(F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1) == x, F.lit(False)))))

    def lookup(g: Column, values: Column) -> Column:
        return F.array_compact(F.transform(g, lambda x, i: F.when(F.array_contains(values, x), i)))

    def neighbours(g: Column) -> Column:
        same = lambda s, x, k: F.coalesce(F.get(s, k)["g"] == x["g"], F.lit(False))
        return _let(F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i")))),
                    lambda s: F.transform(F.filter(s, lambda x, k: same(s, x, k - 1) | same(s, x, k + 1)), lambda x: x["i"]))

    def covered(i: Column) -> Column:
        return F.size(F.array_distinct(F.concat(i, F.transform(i, lambda x: x + 1), F.transform(i, lambda x: x + 2))))

    def count(g: Column) -> Column:
        some = _let(repeated_values(g), lambda v: F.when(F.size(v) <= FEW, lookup(g, v)).otherwise(neighbours(g)))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(_let(some, covered))

    return _let(F.transform(ws, lambda x: F.xxhash64(x)), lambda h: _let(windows(h), count)).cast("long")


def n_capitals(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text_of(text), "[^A-Z]+", "")).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


# ---- rules ------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """``rejects(text)``: a boolean column, true for a document to reject."""

    name: str
    rejects: Callable[[Column], Column]


RULES = [
    Rule("repeated_windows", lambda t: 100 * n_repeat_words(t) > MAX_REPEAT_PERCENT * n_words(t)),
    Rule("repeated_lines", lambda t: 100 * n_dup_lines(t) > MAX_DUP_LINE_PERCENT * F.size(content_lines(t))),
    Rule("symbols", lambda t: 100 * n_symbols(t) > MAX_SYMBOL_PERCENT * n_words(t)),
    Rule("capitals", lambda t: 100 * n_capitals(t) > MAX_CAPITAL_PERCENT * word_chars(t)),
    Rule("word_length", lambda t: ~(word_chars(t) / F.greatest(n_words(t), F.lit(1))).between(*MEAN_WORD_CHARS)),
    Rule("min_words", lambda t: n_words(t) < MIN_WORDS),
]


@dataclass(frozen=True)
class Estimate:
    name: str
    rejected: float   # share of the sample
    seconds: float    # for the sample

    @property
    def rank(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def plan(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS,
         text: str = "text") -> tuple[list[Rule], list[Estimate]]:
    """Order ``rules`` by the share they reject per second on a sample.

    The sample is a random share of all rows, about ``sample_rows`` in number
    however many partitions there are. It decides the order only, never a verdict. Each rule's cost is
    the time to aggregate its verdicts over the cached sample, less that of a
    pass without a rule.
    """
    rules = list(RULES if rules is None else rules)
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = docs.select(F.col(text).alias("_q_text")).sample(share, seed=SAMPLE_SEED).repartition(SAMPLE_PARTS).persist()
    try:
        n = sample.count()
        if not n:
            return rules, []

        def timed(flag: Column) -> tuple[int, float]:
            began = time.perf_counter()
            hits = sample.agg(F.sum(flag.cast("long"))).first()[0]
            return hits or 0, time.perf_counter() - began

        timed(F.lit(False))                                # warm-up
        base = min(timed(F.col("_q_text").isNull())[1] for _ in range(2))
        out = []
        for r in rules:
            flag = F.coalesce(r.rejects(F.col("_q_text")), F.lit(False))
            hits, first = timed(flag)
            out.append(Estimate(r.name, hits / n, max(min(first, timed(flag)[1]) - base, 1e-4)))
    finally:
        sample.unpersist()
    order = sorted(range(len(rules)), key=lambda i: (-out[i].rank, i))
    return [rules[i] for i in order], [out[i] for i in order]


def first_failure(rules: list[Rule], text: Column) -> Column:
    """Name of the first rule of ``rules`` that rejects; null if none does.
    Later rules are not evaluated for a document an earlier one rejected."""
    out = None
    for r in rules:
        out = (F.when if out is None else out.when)(r.rejects(text), F.lit(r.name))
    return F.lit(None).cast("string") if out is None else out


def apply(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", out: str = "rejected_by",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``out``: the first rule, in the planned order, that
    rejects the document, or null for a kept one."""
    order, _ = plan(docs, rules, sample_rows, text)
    return docs.withColumn(out, first_failure(order, F.col(text)))


# ---- registered query and pipeline stage ------------------------------------

def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base measures of every document and the cascade's verdict.

    The measures are asked for on every row, so they are columns here; the
    cascade then runs over these columns, and its short circuit saves the
    rules that read the text again.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    t = F.col("text")
    m = docs.withColumn("_q_words", words(t))
    m = m.select("doc_id", "text", F.size("_q_words").cast("long").alias("n_words"),
                 F.char_length(F.array_join("_q_words", "")).cast("long").alias("word_chars"),
                 n_symbols(t).alias("n_symbols"), n_dup_lines(t).alias("n_dup_lines"),
                 _repeat_words(F.col("_q_words")).alias("n_repeat_words"))
    rules = {r.name: r for r in plan(docs)[0]}
    measured = {
        "min_words": F.col("n_words") < MIN_WORDS,
        "repeated_windows": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "capitals": 100 * n_capitals(t) > MAX_CAPITAL_PERCENT * F.col("word_chars"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"),
        "word_length": ~(F.col("word_chars") / F.greatest("n_words", F.lit(1))).between(*MEAN_WORD_CHARS),
    }
    order = [Rule(k, lambda x, k=k, r=r: measured.get(k, r.rejects(x))) for k, r in rules.items()]
    base_failed = measured["min_words"] | measured["repeated_windows"]
    m = m.withColumn("base_failed", base_failed)
    kept = ~F.col("base_failed") & first_failure(order, t).isNull()
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    kept.alias("kept"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that no rule rejects."""
    return apply(docs, out="_q_rule").where(F.col("_q_rule").isNull()).drop("_q_rule")


SQL_MEASURES = r"""
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents"""

OP3_SQL = rf"""
WITH d AS ({SQL_MEASURES}),
grams AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM grams),
hit AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM hit WHERE c > 1) GROUP BY 1),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS up
  FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > {MAX_SYMBOL_PERCENT} * n_words)
       AND NOT (100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines)
       AND NOT (100 * up > {MAX_CAPITAL_PERCENT} * word_chars)
       AND (word_chars / greatest(n_words, 1)) BETWEEN {MEAN_WORD_CHARS[0]} AND {MEAN_WORD_CHARS[1]} AS kept
FROM b"""
