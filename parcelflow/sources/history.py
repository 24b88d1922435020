"""A stored SCD2 table, published version by version.

Layout below ``path``::

    changes/run=<t>   the change feed of a run: one row per new, returned, changed
                      or deleted key, with its old and its new version
    closed/run=<t>    the versions that the run closed; written once, never again
    open/version=<t>  the open versions after the run

``<t>`` is the run's time in microseconds. A run joins the open versions with
the source once (full outer), writes the feed, derives the two other parts from
it and writes ``open`` last: its ``_SUCCESS`` file is the commit. Readers take
the newest complete open version and the closed runs up to it, so they see
either all of a run or nothing of it, also while one is being written. A run
that stopped is repeated with the same time and writes the same rows; closed
history is never read or rewritten, so a run costs what is open and what is in
the source, however long the history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scd2 import VALID_FROM, VALID_TO, _changed
from .tables import _fs

OPEN, CLOSED, CHANGES = "open", "closed", "changes"


def _micros(run_ts) -> int:
    t = dt.datetime.fromisoformat(str(run_ts)).replace(tzinfo=None)
    return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first (a listing)."""
    fs, p, jvm = _fs(spark, f"{path}/{OPEN}")
    if not fs.exists(p):
        return []
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def change_feed(current: DataFrame | None, source: DataFrame, key: str, check_cols, run_ts, closed_keys: DataFrame | None = None, invalidate_hard_deletes: bool = True) -> DataFrame:
    """(key, change, old, new) of every key in the open versions or the
    source; ``change`` is new, returned, changed, deleted, unchanged or kept (left
    the source, but stays open). ``old`` and ``new`` are whole versions or null.
    ``closed_keys`` tells returned keys from new ones."""
    cols, run = source.columns, F.lit(run_ts).cast("timestamp")
    none = F.lit(None).cast("timestamp")
    if current is None:
        current = source.limit(0).select(*cols, run.alias(VALID_FROM), none.alias(VALID_TO))
    s = source
    if closed_keys is not None:
        before = closed_keys.select(F.col(key).alias("_k"), F.lit(True).alias("_before"))
        s = source.join(before, F.col(key) == F.col("_k"), "left").drop("_k")
    else:
        s = source.withColumn("_before", F.lit(None).cast("boolean"))
    j = current.alias("h").join(s.alias("s"), F.col(f"h.{key}") == F.col(f"s.{key}"), "full_outer")
    change = (F.when(F.col(f"h.{key}").isNull(), F.when(F.col("s._before"), "returned").otherwise("new"))
              .when(F.col(f"s.{key}").isNull(), "deleted" if invalidate_hard_deletes else "kept")
              .when(_changed(check_cols), "changed").otherwise("unchanged"))
    old = F.when(F.col(f"h.{key}").isNotNull(), F.struct(*[F.col(f"h.{c}").alias(c) for c in cols], F.col(f"h.{VALID_FROM}").alias(VALID_FROM),
                                                         F.when(change.isin("changed", "deleted"), run).otherwise(none).alias(VALID_TO)))
    new = F.when(change.isin("new", "returned", "changed"), F.struct(*[F.col(f"s.{c}").alias(c) for c in cols], run.alias(VALID_FROM), none.alias(VALID_TO)))
    return j.select(F.coalesce(f"h.{key}", f"s.{key}").alias(key), change.alias("change"), old.alias("old"), new.alias("new"))


def run_snapshot(spark: SparkSession, path: str, source: DataFrame, key: str, check_cols, run_ts, invalidate_hard_deletes: bool = True) -> dict:
    """One run of the stored history; returns the number of each change.

    ``source`` is unique on ``key``; its null keys are refused. Runs come in
    the order of ``run_ts``; the newest may be repeated and gives the same rows.
    """
    run = _micros(run_ts)
    done = versions(spark, path)
    if done and run < done[-1]:
        raise ValueError(f"run {run_ts} is older than the newest version")
    if run in done:
        return _counts(spark, path, run, key)
    before = [v for v in done if v < run]
    current = spark.read.parquet(f"{path}/{OPEN}/version={before[-1]}") if before else None
    closed = _closed(spark, path, before[-1]) if before else None
    keys = closed.select(key).distinct() if closed is not None else None
    feed = change_feed(current, source, key, check_cols, run_ts, keys, invalidate_hard_deletes)
    feed.write.mode("overwrite").parquet(f"{path}/{CHANGES}/run={run}")
    feed = spark.read.schema(feed.schema).parquet(f"{path}/{CHANGES}/run={run}")
    if not feed.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"NULL in key {key}")
    shut = F.col("change").isin("changed", "deleted")
    feed.where(shut).select("old.*").write.mode("overwrite").parquet(f"{path}/{CLOSED}/run={run}")
    last = F.coalesce(F.col("new"), F.when(~shut, F.col("old")))
    feed.select(last.alias("v")).where("v is not null").select("v.*").write.mode("overwrite").parquet(f"{path}/{OPEN}/version={run}")
    return _counts(spark, path, run, key)


def _counts(spark, path, run, key) -> dict:
    rows = spark.read.parquet(f"{path}/{CHANGES}/run={run}").groupBy("change").count().collect()
    return {r["change"]: r["count"] for r in rows}


def _closed(spark: SparkSession, path: str, upto: int) -> DataFrame | None:
    fs, p, jvm = _fs(spark, f"{path}/{CLOSED}")
    if not fs.exists(p):
        return None
    runs = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("run=")]
    runs = [r.toString() for r in runs if int(r.getName()[4:]) <= upto and fs.exists(jvm.org.apache.hadoop.fs.Path(r, "_SUCCESS"))]
    return spark.read.option("basePath", f"{path}/{CLOSED}").parquet(*sorted(runs)).drop("run") if runs else None


def read_history(spark: SparkSession, path: str, as_of=None) -> DataFrame | None:
    """All versions, closed and open, as of the newest published run (or
    the newest at or before ``as_of``); None before the first run."""
    done = [v for v in versions(spark, path) if as_of is None or v <= _micros(as_of)]
    if not done:
        return None
    now = spark.read.parquet(f"{path}/{OPEN}/version={done[-1]}")
    closed = _closed(spark, path, done[-1])
    return now if closed is None else closed.unionByName(now)


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """D3: the open versions only; no closed history is read."""
    done = versions(spark, path)
    return spark.read.parquet(f"{path}/{OPEN}/version={done[-1]}") if done else None


def read_changes(spark: SparkSession, path: str) -> DataFrame | None:
    """(run_ts, key, change) of all published runs; unchanged keys are left out."""
    done = versions(spark, path)
    if not done:
        return None
    feed = spark.read.parquet(f"{path}/{CHANGES}").where(F.col("run").isin(done) & ~F.col("change").isin("unchanged", "kept"))
    return feed.withColumn("run_ts", F.timestamp_micros("run")).drop("run", "old", "new")


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete old open versions and complete feeds but the newest ``keep``
    (readers hold a version no longer than that)."""
    fs, _, jvm = _fs(spark, path)
    old = versions(spark, path)[:-max(1, keep)]
    for v in old:
        for name in (f"{OPEN}/version={v}", f"{CHANGES}/run={v}"):
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return old
