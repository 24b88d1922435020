"""Tables and views published together, version by version.

Layout below ``base``::

    <model>/version=<n>    a table, written whole by run n
    published/version=<n>  the pointer of run n: one row (model, written) per table

A run writes the tables it changed and the pointer last; the pointer's
``_SUCCESS`` file is the commit. A table the run did not write keeps its former
folder, which the new pointer names again. A reader takes the newest complete
pointer once and reads all tables through it, so what it sees is one run's
state of every table, also while the next run is being written or after it has
been published. Nothing is renamed or replaced. A stopped run leaves folders no
pointer names; its number is not used again.

:func:`retire` deletes the pointers older than the ``keep`` newest, then the
folders that no pointer names. A reader has to finish within ``keep`` runs.

A view is a function over a snapshot's tables. It is registered as a temporary
view, computed when read, and its plan is optimised with the query that reads
it: only the columns and days asked for are scanned.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .tables import _fs

POINTERS = "published"


def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """(number, complete) of the version folders below ``path``."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    P = jvm.org.apache.hadoop.fs.Path
    found = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("version=")]
    return sorted((int(f.getName().split("=", 1)[1]), bool(fs.exists(P(f, "_SUCCESS")))) for f in found)


def published(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the published versions, oldest first (a listing)."""
    return [n for n, complete in _versions(spark, f"{base}/{POINTERS}") if complete]


@dataclass(frozen=True)
class Snapshot:
    """One published version: ``tables[model]`` is the run that wrote it."""

    spark: SparkSession
    base: str
    version: int
    tables: Mapping[str, int]

    def read(self, model: str) -> DataFrame:
        if model not in self.tables:
            raise KeyError(f"version {self.version} has no table {model}")
        return self.spark.read.parquet(f"{self.base}/{model}/version={self.tables[model]}")


def snapshot(spark: SparkSession, base: str, version: int | None = None) -> Snapshot | None:
    """The newest published version (or the given one); None before the first."""
    there = published(spark, base)
    if version is None:
        version = there[-1] if there else None
    elif version not in there:
        raise KeyError(f"version {version} is not published")
    if version is None:
        return None
    rows = spark.read.schema("model string, written long").parquet(f"{base}/{POINTERS}/version={version}").collect()   # one row a model
    return Snapshot(spark, base, version, {r["model"]: r["written"] for r in rows})


def publish(spark: SparkSession, base: str, models: Mapping[str, DataFrame], drop=(), partition_by: Mapping[str, str] | None = None) -> int:
    """Write ``models`` and publish them with the unchanged others as the next
    version; ``drop`` names tables that end. One writer at a time: a second one
    with the same number fails, since its folders are there already."""
    if POINTERS in models:
        raise ValueError(f"{POINTERS} is the folder of the pointers")
    before = snapshot(spark, base)
    used = [n for folder in (POINTERS, *models) for n, _ in _versions(spark, f"{base}/{folder}")]
    n = max(used, default=-1) + 1
    for model, df in models.items():
        day = (partition_by or {}).get(model)
        w = (df.hint("rebalance", day) if day else df).write.mode("errorifexists")
        (w.partitionBy(day) if day else w).parquet(f"{base}/{model}/version={n}")
    tables = {m: v for m, v in (before.tables if before else {}).items() if m not in drop} | {m: n for m in models}
    (spark.createDataFrame(sorted(tables.items()), "model string, written long").coalesce(1)
     .write.mode("errorifexists").parquet(f"{base}/{POINTERS}/version={n}"))
    return n


def retire(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete what only pointers older than the ``keep`` newest name; returns
    the folders deleted. Not while a run is being written: its folders have no
    pointer yet."""
    if keep < 1:
        raise ValueError("keep at least one version")
    there = published(spark, base)
    snaps = {v: snapshot(spark, base, v) for v in there}
    named = {(m, n) for v in there[-keep:] for m, n in snaps[v].tables.items()}
    fs, _, jvm = _fs(spark, base)
    P = jvm.org.apache.hadoop.fs.Path
    gone = [f"{POINTERS}/version={v}" for v, complete in _versions(spark, f"{base}/{POINTERS}") if not complete or v not in there[-keep:]]
    for s in fs.listStatus(P(base)) if fs.exists(P(base)) else []:
        model = s.getPath().getName()
        if s.isDirectory() and model != POINTERS:
            gone += [f"{model}/version={n}" for n, _ in _versions(spark, f"{base}/{model}") if (model, n) not in named]
    for folder in gone:
        fs.delete(P(f"{base}/{folder}"), True)
    return gone


def register_views(snap: Snapshot, views: Mapping[str, Callable[[Snapshot], DataFrame]], prefix: str = "") -> list[str]:
    """Register the snapshot's tables and ``views`` over them under ``prefix``;
    nothing is computed until one is read."""
    names = []
    for model in sorted(snap.tables):
        snap.read(model).createOrReplaceTempView(prefix + model)
        names.append(prefix + model)
    for name, build in views.items():
        build(snap).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
