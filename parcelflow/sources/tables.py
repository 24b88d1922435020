"""Table materialisation on plain Parquet (S11) and the safe keyed upsert
(J2, SURVEY §4.3).

Neither Delta nor Iceberg is deployed, and ``MERGE INTO`` is unsupported on
Parquet tables, so the upsert works at partition-directory level:

1. dedup the updates on the key (newest wins) and refuse NULL keys;
2. touched partitions = partitions of the updates, plus partitions of
   target rows whose key is in the updates (a key may move between days);
3. new content of the touched partitions = their target rows ``left_anti``
   the updates, ``unionByName`` the updates;
4. write that to a folder of its own, then record the swap in a journal
   beside the table and carry it out: each touched day's old folder is moved
   aside and the new one moved in. Nothing is deleted before the whole swap is
   done, so a run that stops anywhere loses no row: the next run (or
   :func:`recover`) finds the journal and carries the same swap to its end.

All file operations use the Hadoop ``FileSystem`` of the path, so the same
code runs on local disk, HDFS or an object store. Readers must not run
during the swap (it is not atomic across partitions). Small whole-table
states (snapshots, dims) use :func:`write_version` / :func:`read_latest`
instead: each run writes ``version=N`` and readers take the newest complete
one, which is atomic.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import dedup_latest


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def _is_table(spark: SparkSession, path: str) -> bool:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def partition_values(spark: SparkSession, path: str, partition_col: str = "event_date") -> list:
    """Dates of the ``partition_col=YYYY-MM-DD`` directories that hold data
    files (a listing; no data is read)."""
    import datetime as dt
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(partition_col + "="):
            try:
                day = dt.date.fromisoformat(name.split("=", 1)[1])
            except ValueError:
                continue
            if any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(s.getPath())):
                out.append(day)
    return out


def materialize(df: DataFrame, path: str, partition_by=None, cluster_by=None,
                mode: str = "overwrite") -> None:
    """Write a model as a table: partition directories by day,
    rows clustered inside each file by ``cluster_by`` (sorted, so Parquet
    min/max statistics let later filters on those columns skip row groups).
    Rows are rebalanced by the partition column: small days share a task, a
    large day is split over as many as its size asks for."""
    w = df
    if partition_by:
        w = w.hint("rebalance", *([partition_by] if isinstance(partition_by, str) else partition_by))
    if cluster_by:
        w = w.sortWithinPartitions(*cluster_by)
    writer = w.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where there is none. Reading changes nothing: a swap
    that stopped half-way is carried to its end by the next writer."""
    return spark.read.parquet(path) if _is_table(spark, path) else None


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys, partition_col: str = "event_date",
           order=("event_ts", "sequence_no", "event_id"), cluster_by=None,
           search_days: int | None = None, schema=None, key_index: bool = False) -> dict:
    """Merge ``updates`` into the Parquet table at ``path`` by ``keys``
    (matched rows replaced, others inserted). Returns counts.

    Unlike a warehouse MERGE, a NULL key is refused rather than silently
    inserted as never-matching.

    Finding the days that hold a replaced key reads only the key and
    partition columns of the target (a semi join the updates' key side
    drives; AQE broadcasts it when its measured size is small). By default
    every day is searched, which is exact. ``search_days=n`` restricts the
    search to ``n`` days around the updates' days: a bounded cost for tables
    whose keys cannot move further than that (e.g. redelivered copies).
    ``key_index`` keeps an index of the keys beside the table and searches only
    the days that may hold one (:mod:`parcelflow.sources.key_index`): as exact
    as searching every day.
    ``schema`` gives the table's columns where its files have not all of them
    (:mod:`parcelflow.sources.schema_log`).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    null_key = None
    for k in keys:
        e = F.col(k).isNull()
        null_key = e if null_key is None else null_key | e
    recover(spark, path)
    work = f"{path.rstrip('/')}__work-{uuid.uuid4().hex[:12]}"
    try:
        done = _upsert(spark, path, work, updates, keys, partition_col, order, cluster_by, search_days, null_key, schema, key_index)
        if key_index and _is_table(spark, path):
            from .key_index import refresh
            refresh(spark, path, keys, partition_col)
        return done
    finally:
        _clear(spark, path, work)


def _upsert(spark, path, work, updates, keys, partition_col, order, cluster_by, search_days, null_key, schema=None, key_index=False) -> dict:
    once = dedup_latest(updates, keys, [c for c in order if c in updates.columns] or keys)
    # Written once: the steps below read the batch and don't evaluate it again.
    once.write.parquet(f"{work}/updates")
    upd = spark.read.schema(once.schema).parquet(f"{work}/updates")
    # One pass over the (already filtered) updates: NULL keys and touched days.
    stats = (upd.groupBy(F.col(partition_col).alias("p"))
             .agg(F.count(F.lit(1)).alias("n"), F.count_if(null_key).alias("nulls")).collect())
    if any(r["nulls"] for r in stats):
        raise ValueError(f"upsert: NULL in merge key {keys}")
    n_updates = sum(r["n"] for r in stats)
    target = read_table(spark, path)
    if target is not None and schema is not None:
        target = spark.read.schema(schema).parquet(path).select(*schema.names)
    if target is None:
        if n_updates:
            materialize(upd, path, partition_col, cluster_by, mode="overwrite")
        return {"inserted_or_updated": n_updates, "partitions": len(stats)}
    if not n_updates:
        return {"inserted_or_updated": 0, "partitions": 0}

    upd_days = [r["p"] for r in stats]
    # Days of target rows whose key is being replaced (they may live on
    # other days than the update). The list of days is bounded by the
    # calendar, not by the data.
    searched = target
    known_days = [d for d in upd_days if d is not None]
    if search_days is not None and known_days:
        upd_days_nn = known_days
        lo = min(upd_days_nn) - _dt.timedelta(days=int(search_days))
        hi = max(upd_days_nn) + _dt.timedelta(days=int(search_days))
        searched = target.filter(F.col(partition_col).between(F.lit(lo), F.lit(hi)))
    searched_days = None
    if key_index:
        from .key_index import days_to_open
        no_day = _part_dir(partition_col, None).split("=", 1)[1]
        searched_days = days_to_open(spark, path, upd, keys, partition_col)
        searched = searched.filter(F.coalesce(F.col(partition_col).cast("string"), F.lit(no_day)).isin(sorted(searched_days)))
    moved = (searched.select(*keys, partition_col).join(upd.select(*keys), keys, "left_semi")
             .select(partition_col).distinct().collect())
    touched = sorted({*upd_days, *[r[0] for r in moved]}, key=lambda d: (d is None, str(d)))
    cond = F.col(partition_col).isin([d for d in touched if d is not None])
    if any(d is None for d in touched):
        cond = cond | F.col(partition_col).isNull()
    keep = target.filter(cond).join(upd.select(*keys), keys, "left_anti")
    new_content = keep.unionByName(upd.select(*target.columns))

    materialize(new_content, f"{work}/new", partition_col, cluster_by, mode="overwrite")
    _swap(spark, work, path, partition_col, touched)
    done = {"inserted_or_updated": n_updates, "partitions": len(touched)}
    return done if searched_days is None else {**done, "searched": len(searched_days)}


def replace_groups(spark: SparkSession, path: str, dirty: DataFrame, rows: DataFrame, key: str, partition_col: str = "event_date", cluster_by=None) -> list:
    """Replace all rows of the groups in ``dirty`` (one column, ``key``) by
    ``rows``; returns the days touched. Only days that hold or get a row of such
    a group are rewritten, with the same journalled swap as :func:`upsert`."""
    recover(spark, path)
    work = f"{path.rstrip('/')}__work-{uuid.uuid4().hex[:12]}"
    try:
        rows.write.parquet(f"{work}/rows")
        rows = spark.read.schema(rows.schema).parquet(f"{work}/rows")
        days = {r[0] for r in rows.select(partition_col).distinct().collect()}             # bounded by the calendar
        target = read_table(spark, path)
        if target is None:
            if days:
                materialize(rows, path, partition_col, cluster_by)
            return sorted(days, key=str)
        old = target.select(key, partition_col).join(dirty, key, "left_semi").select(partition_col).distinct().collect()
        days |= {r[0] for r in old}
        if days:
            _replace_days(spark, path, work, target, days, target.join(dirty, key, "left_anti"), rows, partition_col, cluster_by)
        return sorted(days, key=str)
    finally:
        _clear(spark, path, work)


def replace_days(spark: SparkSession, path: str, days, rows: DataFrame, partition_col: str = "event_date", cluster_by=None) -> None:
    """Replace the given days of a table by ``rows`` (of these days only)."""
    recover(spark, path)
    work = f"{path.rstrip('/')}__work-{uuid.uuid4().hex[:12]}"
    try:
        if _is_table(spark, path):
            _replace_days(spark, path, work, None, set(days), None, rows, partition_col, cluster_by)
        else:
            materialize(rows, path, partition_col, cluster_by)
    finally:
        _clear(spark, path, work)


def _replace_days(spark, path, work, target, days, kept, rows, partition_col, cluster_by) -> None:
    if kept is not None:
        cond = F.col(partition_col).isin([d for d in days if d is not None])
        if None in days:
            cond = cond | F.col(partition_col).isNull()
        rows = kept.filter(cond).unionByName(rows.select(*target.columns))
    materialize(rows, f"{work}/new", partition_col, cluster_by)
    _swap(spark, work, path, partition_col, sorted(days, key=lambda d: (d is None, str(d))))


def _clear(spark, path, work) -> None:
    fs, _, jvm = _fs(spark, path)
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(_journal(path))):
        fs.delete(jvm.org.apache.hadoop.fs.Path(work), True)


def _part_dir(partition_col: str, value) -> str:
    return f"{partition_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def _journal(path: str) -> str:
    return path.rstrip("/") + "__journal"


def _swap(spark: SparkSession, work: str, path: str, partition_col: str, touched) -> None:
    """Record which day folders of ``work/new`` replace the table's, then do it."""
    fs, _, jvm = _fs(spark, path)
    P = jvm.org.apache.hadoop.fs.Path
    names = [_part_dir(partition_col, d) for d in touched]
    filled = [n for n in names if fs.exists(P(f"{work}/new/{n}"))]
    plan = json.dumps({"work": work, "filled": filled, "emptied": [n for n in names if n not in filled]})
    out = fs.create(P(_journal(path) + "__new"), True)
    out.write(bytearray(plan.encode("utf-8")))
    out.close()
    _rename(fs, P(_journal(path) + "__new"), P(_journal(path)))
    recover(spark, path)


def _rename(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {a} to {b}")


def recover(spark: SparkSession, path: str) -> bool:
    """Carry a recorded swap to its end; True if there was one.

    Every step can be repeated: a day whose new folder is gone from the work
    folder has been moved in; an old folder is only moved aside, never deleted
    before the journal is.
    """
    fs, _, jvm = _fs(spark, path)
    P = jvm.org.apache.hadoop.fs.Path
    if not fs.exists(P(_journal(path))):
        return False
    stream = fs.open(P(_journal(path)))
    plan = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    work = plan["work"]
    fs.mkdirs(P(f"{work}/old"))
    for name in [*plan["filled"], *plan["emptied"]]:
        new, live, old = P(f"{work}/new/{name}"), P(f"{path}/{name}"), P(f"{work}/old/{name}")
        waiting = fs.exists(new) or (name in plan["emptied"] and not fs.exists(old))
        if waiting and fs.exists(live):
            _rename(fs, live, old)
        if fs.exists(new):
            _rename(fs, new, live)
    fs.delete(P(_journal(path)), False)
    fs.delete(P(work), True)
    return True


def write_version(df: DataFrame, path: str) -> str:
    """Write a whole small table as the next ``version=N`` folder."""
    spark = df.sparkSession
    fs, p, jvm = _fs(spark, path)
    n = 0
    if fs.exists(p):
        for s in fs.listStatus(p):
            name = s.getPath().getName()
            if name.startswith("version="):
                n = max(n, int(name.split("=", 1)[1]) + 1)
    out = f"{path.rstrip('/')}/version={n}"
    df.write.mode("errorifexists").parquet(out)
    return out


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete (``_SUCCESS``-marked) version of a table."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    best = None
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            v = int(name.split("=", 1)[1])
            if best is None or v > best[0]:
                best = (v, s.getPath().toString())
    return spark.read.parquet(best[1]) if best else None
