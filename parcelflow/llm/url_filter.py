"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

The trees (Spark ML) are trained on labelled URLs. Features are column
expressions: lengths, path depth, digit ratio, character entropy, parameter
counts, sign counts and the block rate of the host's suffix, smoothed and, in
training, taken from the other folds so that a URL's own label stays out of it.

``op2_url_gbt`` is trained on the labelled URLs that its tables hold: those that
a rule decides, with the rule's verdict. The trees carry that over to URLs
without a rule; how well they agree with the rules on held-out URLs is tested in
``tests/llm``.

Defined results: a null URL, or one without ``://``, has an empty host and path
and no rule; without labels of both kinds the default verdict is allow; null
labels are ignored; repeated rows are judged alike; extra columns are dropped
by the query and carried by ``UrlModel.score``. Working columns start with
``_u_``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored, table

#: Rows the trees and suffix statistics are fitted on, at most; taken by hash of the URL.
MAX_TRAINING_ROWS = 20_000
TREES, DEPTH, FOLDS, SEED = 20, 4, 5, 17
#: Weight of the overall block rate in a suffix's smoothed rate.
PRIOR = 20
#: Distinct suffixes whose rates are kept, the most frequent ones; others get the overall rate.
MAX_SUFFIXES = 1000
BLOCK_AT = 0.5

#: (host suffix, path prefix, verdict), in the order of the query's contract.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

FEATURES = ["url_chars", "host_chars", "path_chars", "query_chars", "host_labels", "path_depth", "digit_ratio", "letter_entropy",
            "parameters", "hyphens", "percents", "longest_label", "is_https", "has_file_type", "suffix_rate"]


# ---- parts ------------------------------------------------------------------

def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_for(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. A rule fits its
    host and all subdomains when the path starts with the rule's."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    name = verdict = None
    for suffix, prefix, says in ordered:
        fits = ((host_ == suffix) | host_.endswith("." + suffix)) & path_.startswith(prefix)
        name = (F.when if name is None else name.when)(fits, F.lit(suffix + prefix))
        verdict = (F.when if verdict is None else verdict.when)(fits, F.lit(says))
    return name, verdict


def suffix(host_: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host_, ".", -2)


# ---- features ---------------------------------------------------------------

def lexical(url: Column) -> dict[str, Column]:
    u, h, p = F.coalesce(url, F.lit("")), host(url), path(url)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    size = lambda c: F.char_length(c).cast("double")
    count = lambda c, what: (F.char_length(c) - F.char_length(F.replace(c, F.lit(what), F.lit("")))).cast("double")
    chars = F.regexp_extract_all(F.lower(u), F.lit("[a-z0-9]"), F.lit(0))
    n = F.size(chars).cast("double")

    def entropy(cs: Column) -> Column:
        share = F.transform(F.array_distinct(cs), lambda x: F.size(F.filter(cs, lambda y: y == x)) / n)
        return F.aggregate(share, F.lit(0.0), lambda t, q: t - q * F.log2(q))

    return {
        "url_chars": size(u), "host_chars": size(h), "path_chars": size(p), "query_chars": size(query),
        "host_labels": count(h, ".") + F.when(h != "", 1.0).otherwise(0.0),
        "path_depth": F.size(F.array_remove(F.split(p, "/"), "")).cast("double"),
        "digit_ratio": size(F.regexp_replace(u, "[^0-9]+", "")) / F.greatest(size(u), F.lit(1.0)),
        "letter_entropy": F.when(n > 0, entropy(chars)).otherwise(F.lit(0.0)),
        "parameters": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
        "hyphens": count(h, "-"), "percents": count(u, "%"),
        "longest_label": F.coalesce(F.array_max(F.transform(F.split(h, r"\."), lambda x: F.char_length(x))), F.lit(0)).cast("double"),
        "is_https": u.startswith("https").cast("double"),
        "has_file_type": p.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
    }


@dataclass
class UrlModel:
    """Fitted trees and suffix rates; ``trees`` is None without labels of both kinds."""

    trees: object
    rates: dict[str, float]
    overall: float

    def score(self, urls: DataFrame, url: str = "url", out: str = "score") -> DataFrame:
        """``urls`` with the probability that a URL is to be blocked."""
        if self.trees is None:
            return urls.withColumn(out, F.lit(0.0))
        from pyspark.ml.functions import vector_to_array

        cols = urls.columns
        rate = _rate(self.rates, self.overall, suffix(host(F.col(url))))
        x = urls.select("*", *[c.alias(f"_u_{k}") for k, c in lexical(F.col(url)).items()], rate.alias("_u_suffix_rate"))
        done = self.trees.transform(_assembled(x))
        return done.select(*cols, F.get(vector_to_array("_u_probability"), 1).alias(out))


def _rate(rates: dict[str, float], overall: float, key: Column) -> Column:
    if not rates:
        return F.lit(overall)
    # A bounded literal: at most MAX_SUFFIXES entries.
    pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in rates]), F.array(*[F.lit(float(v)) for v in rates.values()]))
    return F.coalesce(F.element_at(pairs, key), F.lit(overall))


def _assembled(df: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=[f"_u_{k}" for k in FEATURES], outputCol="_u_features").transform(df)


def fit(labelled: DataFrame, url: str = "url", label: str = "label", max_rows: int = MAX_TRAINING_ROWS, trees: int = TREES,
        depth: int = DEPTH, seed: int = SEED) -> UrlModel:
    """Train on (url, label 0 allow / 1 block); at most ``max_rows`` rows, those
    with the smallest hash of the URL."""
    from pyspark.ml.classification import GBTClassifier

    rows = labelled.where(F.col(label).isNotNull()).select(F.col(url).alias("url"), F.col(label).cast("double").alias("label"))
    rows = rows.orderBy(F.xxhash64("url"), "url", "label").limit(max_rows)
    rows = rows.select("url", "label", suffix(host(F.col("url"))).alias("s"), F.pmod(F.xxhash64("url", F.lit(1)), F.lit(FOLDS)).alias("fold"))
    rows = stored(rows.coalesce(4), "url-training")
    by = {(r["s"], r["fold"]): (r["n"], r["y"]) for r in rows.groupBy("s", "fold").agg(F.count("*").alias("n"), F.sum("label").alias("y")).collect()}  # of max_rows rows
    n, y = sum(v[0] for v in by.values()), sum(v[1] for v in by.values())
    if not n or y in (0, n):
        return UrlModel(None, {}, 0.0)
    overall = y / n
    total: dict[str, tuple[int, float]] = {}
    for (s, _), (a, b) in by.items():
        c = total.get(s, (0, 0.0))
        total[s] = (c[0] + a, c[1] + b)
    smooth = lambda a, b: (b + PRIOR * overall) / (a + PRIOR)
    top = sorted(total, key=lambda s: (-total[s][0], s))[:MAX_SUFFIXES]
    rates = {s: smooth(*total[s]) for s in top}
    other = [({s: smooth(total[s][0] - by.get((s, f), (0, 0))[0], total[s][1] - by.get((s, f), (0, 0))[1]) for s in top}) for f in range(FOLDS)]
    rate = None
    for f in range(FOLDS):
        rate = (F.when if rate is None else rate.when)(F.col("fold") == f, _rate(other[f], overall, F.col("s")))
    x = rows.select("label", *[c.alias(f"_u_{k}") for k, c in lexical(F.col("url")).items()], rate.alias("_u_suffix_rate"))
    x = stored(_assembled(x).select("label", "_u_features"), "url-features")
    gbt = GBTClassifier(featuresCol="_u_features", labelCol="label", predictionCol="_u_prediction", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed)
    fitted = gbt.fit(x).setProbabilityCol("_u_probability").setRawPredictionCol("_u_raw")
    return UrlModel(fitted, rates, overall)


def judge(urls: DataFrame, model: UrlModel, url: str = "url", rules=RULES, block_at: float = BLOCK_AT) -> DataFrame:
    """``urls`` with host, path, rule, score and verdict (the rule's, else
    the model's); given columns of those names are replaced."""
    name, says = rule_for(F.col("_u_host"), F.col("_u_path"), rules)
    scored = model.score(urls, url, "_u_score").withColumn("_u_host", host(F.col(url))).withColumn("_u_path", path(F.col(url)))
    own = [c for c in urls.columns if c == url or c not in ("host", "path", "rule", "verdict", "score")]
    return scored.select(*own, F.col("_u_host").alias("host"), F.col("_u_path").alias("path"), name.alias("rule"),
                         F.coalesce(says, F.when(F.col("_u_score") >= block_at, "block").otherwise("allow")).alias("verdict"),
                         F.col("_u_score").alias("score"))


# ---- registered query -------------------------------------------------------

def rule_labels(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """(url, label): the URLs that a rule decides, 1 where it blocks."""
    at = pages.select(F.col(url).alias("url"), host(F.col(url)).alias("_u_host"), path(F.col(url)).alias("_u_path"))
    _, says = rule_for(F.col("_u_host"), F.col("_u_path"), rules)
    return at.select("url", (says == "block").cast("int").alias("label")).where("label is not null")


def op2_url_gbt(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, fit(rule_labels(pages))).select("page_id", "host", "path", "rule", "verdict", "score")
