"""Additive schema evolution through ingest, merge and read.

A table's columns are named by a log beside it (``<path>__schema/<n>.json``,
newest number wins), not by its files. A batch with new columns adds them to the
log before it is merged; old files are read with the added columns NULL and are
not rewritten. The type of a column never changes: a batch that brings another
type is cast to the one in the log, and a row whose value can't be cast is
refused with the columns that failed, as a warehouse refuses the insert.

Two writers that extend the schema at once can't both create the same number;
the one that comes second merges again with what the first has added.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.validate import evolve
from .tables import _fs, _is_table, recover, upsert

ATTEMPTS = 5


def _folder(path: str) -> str:
    return path.rstrip("/") + "__schema"


def _newest(spark: SparkSession, path: str) -> int | None:
    fs, p, _ = _fs(spark, _folder(path))
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=None)


def logged_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's columns as of the newest entry; None where there is no log."""
    n = _newest(spark, path)
    if n is None:
        return None
    fs, _, jvm = _fs(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{_folder(path)}/{n}.json"))
    try:
        return T.StructType.fromJson(json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def extend_schema(spark: SparkSession, path: str, desired: T.StructType) -> T.StructType:
    """Add the columns of ``desired`` that the log lacks; returns the schema.

    A table without a log begins one with the columns its files have."""
    fs, _, jvm = _fs(spark, path)
    for _ in range(ATTEMPTS):
        n, known = _newest(spark, path), logged_schema(spark, path)
        if known is None and _is_table(spark, path):
            known = spark.read.option("mergeSchema", "true").parquet(path).schema
        merged = evolve(known, desired) if known is not None else T.StructType([T.StructField(f.name, f.dataType, True) for f in desired.fields])
        if n is not None and merged.names == known.names:
            return known
        target = f"{_folder(path)}/{0 if n is None else n + 1}"
        P = jvm.org.apache.hadoop.fs.Path
        temp = P(f"{target}.{jvm.java.util.UUID.randomUUID().toString()}.part")
        out = fs.create(temp, False)
        out.write(bytearray(json.dumps(merged.jsonValue()).encode("utf-8")))
        out.close()
        if not fs.exists(P(f"{target}.json")) and fs.rename(temp, P(f"{target}.json")):
            return merged
        fs.delete(temp, False)
    raise RuntimeError(f"the schema of {path} changes all the time")


def read_evolved(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with all columns of the log; files that lack one give NULL."""
    recover(spark, path)
    schema = logged_schema(spark, path)
    if not _is_table(spark, path):
        return None
    return spark.read.schema(schema).parquet(path).select(*schema.names) if schema is not None else spark.read.parquet(path)


def _cast(name: str, have: T.DataType, want: T.DataType) -> Column:
    return F.col(f"`{name}`") if have == want else F.col(f"`{name}`").try_cast(want)


def conform_batch(batch: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good, refused): rows in the columns and types of ``schema``; rows with a
    value that can't be cast, as JSON text ``row`` (batches differ in their
    types) with ``failed``, the columns."""
    have = {f.name: f.dataType for f in batch.schema.fields}
    cast = {f.name: _cast(f.name, have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType) for f in schema.fields}
    lost = [F.when(F.col(f"`{n}`").isNotNull() & c.isNull(), F.lit(n)) for n, c in cast.items() if n in have and have[n] != schema[n].dataType]
    failed = F.filter(F.array(*lost), lambda x: x.isNotNull()) if lost else F.array().cast("array<string>")
    marked = batch.withColumn("failed", failed)
    good = marked.where(F.size("failed") == 0).select(*[c.alias(n) for n, c in cast.items()])
    return good, marked.where(F.size("failed") > 0).select(F.to_json(F.struct(*[f"`{c}`" for c in batch.columns])).alias("row"), "failed")


def upsert_evolving(spark: SparkSession, path: str, batch: DataFrame, keys, refused_path: str | None = None, **kw) -> dict:
    """J2 with C7: extend the log by the batch's new columns, refuse what can't
    be cast (to ``refused_path``, if given), merge the rest."""
    schema = extend_schema(spark, path, batch.schema)
    good, refused = conform_batch(batch, schema)
    if refused_path:
        refused.write.mode("append").parquet(refused_path)
    return upsert(spark, path, good, keys, schema=schema, **kw)
