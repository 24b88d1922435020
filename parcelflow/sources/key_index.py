"""Which days of a table may hold a key, without opening them.

Beside a day-partitioned table at ``path`` lies ``path__keys``. It holds, for
each day, the range of the first key column and a Bloom filter of the whole
keys, in rows of 64 bits: a key's hash chooses one row (``slot``) of its day and
``BITS`` bits in it. A merge looks its keys up there by one join on the slot and
opens only the days that may hold one of them.

The filter takes about 16 bits a key, so it says yes for a key that a day does
not hold in some 0.2 % of the cases. That costs the reading of a day; the merge
compares the keys themselves, so it never changes a result. A large batch of
spread keys therefore opens most days, as without the filter. Keys that grow
with time (the usual event ids) are kept apart by their range already.

Consistency needs no protocol. An entry carries the signature of its day: a
hash of the names of the day's data files, which Spark never uses twice. An
entry whose signature is not that of the listed files is ignored, and a day
without an entry may hold any key. So a stopped run, or a writer that knows
nothing of the index, costs time and not rows; the next :func:`refresh` indexes
what is missing. Entries are written run by run and count once the run's
``_SUCCESS`` is there; runs without a current entry are deleted.
"""

from __future__ import annotations

import hashlib
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import _fs, _is_table, _part_dir, exists

#: Bits a key sets in its row of 64, and keys a row takes at most on average.
BITS, KEYS_A_SLOT = 6, 4
#: Slot of the row that holds a day's range.
RANGE = -1
#: Rows and folders of the index; without it folder values would be taken for numbers or dates.
SCHEMA = "level int, slot long, bits long, lo string, hi string, run string, day string, sig string"


def index_path(path: str) -> str:
    return path.rstrip("/") + "__keys"


def _folder(file: str, name: str) -> str | None:
    """Value of the ``name=`` folder in a file's path; None where there is none."""
    found = [p for p in file.split("/")[:-1] if p.startswith(name + "=")]
    return unquote(found[-1].split("=", 1)[1]) if found else None


def _signatures(target: DataFrame, partition_col: str) -> dict[str, str]:
    """Day folder -> signature of its data files (a listing by Spark)."""
    files: dict[str, list[str]] = {}
    for f in target.inputFiles():
        files.setdefault(_folder(f, partition_col), []).append(f.rsplit("/", 1)[1])
    return {day: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()[:32] for day, names in files.items()}


def _hash(keys) -> Column:
    return F.xxhash64(*keys)


def _slot(h: Column, level: Column) -> Column:
    """One of 2 ** level rows, by the hash's upper bits."""
    return F.shiftrightunsigned(h, 36).bitwiseAND(F.pow(F.lit(2.0), level).cast("long") - 1)


def _mask(h: Column) -> Column:
    """The key's bits, six hash bits for each."""
    mask = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def _entries(spark: SparkSession, path: str, current: dict[str, str]) -> tuple[DataFrame | None, dict[str, str], list[str]]:
    """Index rows, day -> run of its current entry, and the runs without one."""
    root = index_path(path)
    if not exists(spark, root):
        return None, {}, []
    fs, p, jvm = _fs(spark, root)
    P = jvm.org.apache.hadoop.fs.Path
    runs = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("run=")]
    done = [r.toString() for r in runs if fs.exists(P(r, "_SUCCESS"))]
    filled = [r for r in done if _is_table(spark, r)]
    if not filled:
        return None, {}, [r.toString() for r in runs]
    rows = spark.read.schema(SCHEMA).option("basePath", root).parquet(*filled)
    held: dict[str, str] = {}
    for f in rows.inputFiles():
        day, run = _folder(f, "day"), _folder(f, "run")
        if day in current and _folder(f, "sig") == current[day]:
            held[day] = run
    used = set(held.values())
    return rows, held, [r.toString() for r in runs if r.getName().split("=", 1)[1] not in used]


def refresh(spark: SparkSession, path: str, keys, partition_col: str = "event_date") -> list[str]:
    """Index the days that have no current entry; returns their folder values."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    target = spark.read.parquet(path)
    current = _signatures(target, partition_col)
    _, held, stale = _entries(spark, path, current)
    missing = sorted(d for d in current if d not in held)
    if missing:
        day = F.coalesce(F.col(partition_col).cast("string"), F.lit(_part_dir(partition_col, None).split("=", 1)[1]))
        rows = target.select(day.alias("day"), *keys).where(F.col("day").isin(missing))
        # One row a day on the driver: bounded by the calendar.
        days = rows.groupBy("day").agg(F.count("*").alias("n"), F.min(keys[0]).cast("string").alias("lo"), F.max(keys[0]).cast("string").alias("hi")).collect()
        level = {r["day"]: max(0, (-(-r["n"] // KEYS_A_SLOT) - 1).bit_length()) for r in days}
        levels = F.create_map(*[F.lit(x) for kv in level.items() for x in kv])
        sigs = F.create_map(*[F.lit(x) for d in level for x in (d, current[d])])
        h = _hash(keys)
        bits = (rows.select("day", levels[F.col("day")].alias("level"), h.alias("h")).select("day", "level", _slot(F.col("h"), F.col("level")).alias("slot"), _mask(F.col("h")).alias("bits"))
                .groupBy("day", "level", "slot").agg(F.bit_or("bits").alias("bits")).withColumn("lo", F.lit(None).cast("string")).withColumn("hi", F.lit(None).cast("string")))
        ranges = spark.createDataFrame([(r["day"], level[r["day"]], RANGE, 0, r["lo"], r["hi"]) for r in days], "day string, level int, slot long, bits long, lo string, hi string")
        out = bits.unionByName(ranges).withColumn("sig", sigs[F.col("day")])
        (out.hint("rebalance", "day").sortWithinPartitions("day", "slot").write.partitionBy("day", "sig")
         .parquet(f"{index_path(path)}/run={uuid.uuid4().hex[:12]}"))
    fs, _, jvm = _fs(spark, path)
    for run in stale:
        fs.delete(jvm.org.apache.hadoop.fs.Path(run), True)
    return missing


def days_to_open(spark: SparkSession, path: str, batch: DataFrame, keys, partition_col: str = "event_date") -> set[str]:
    """Folder values of the days that may hold a key of ``batch``: days
    without a current entry, and days whose range and filter have one."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    target = spark.read.parquet(path)
    current = _signatures(target, partition_col)
    rows, held, _ = _entries(spark, path, current)
    unknown = {d for d in current if d not in held}
    if not held:
        return unknown
    entry = F.create_map(*[F.lit(x) for kv in held.items() for x in kv])
    rows = rows.where(F.col("day").isin(list(held))).where(entry[F.col("day")] == F.col("run"))
    # Hashes are those of the table's types; a key that isn't one of them isn't in the table.
    kind = target.schema[keys[0]].dataType
    batch = batch.select(*[F.col(k).try_cast(target.schema[k].dataType).alias(k) for k in keys])
    low, high = batch.agg(F.min(keys[0]), F.max(keys[0])).first()
    ranged = rows.where(F.col("slot") == RANGE)
    if low is not None:
        ranged = ranged.where((F.col("hi").cast(kind) >= F.lit(low)) & (F.col("lo").cast(kind) <= F.lit(high)))
    open_days = {r["day"]: r["level"] for r in ranged.select("day", "level").collect()}
    if not open_days:
        return unknown
    levels = sorted(set(open_days.values()))
    h = _hash(keys)
    probe = (batch.select(*keys).distinct().select(F.col(keys[0]).alias("k"), h.alias("h"))
             .select("k", "h", F.explode(F.array(*[F.lit(x) for x in levels])).alias("level"))
             .select("level", _slot(F.col("h"), F.col("level")).alias("slot"), _mask(F.col("h")).alias("mask")))
    bits = rows.where(F.col("slot") != RANGE).where(F.col("day").isin(list(open_days))).select("day", "level", "slot", "bits")
    hit = bits.join(probe, ["level", "slot"], "inner").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("day").distinct()
    return unknown | {r["day"] for r in hit.collect()}
