"""Shared helpers of the corpus operators: word splitting as column
expressions, shared-folder tables, distributed numbering and components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.session import scratch_path

#: ASCII white space, the separators of a "word" in the corpus contracts.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, through Spark's reader only (the folder may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text: Column | str) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs without ASCII white space; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character unchanged."""
    return F.translate(text, UPPER, LOWER)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage at files every executor can read, so a lost executor
    costs a task retry and the input is evaluated once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps nobody refers to any more.

    They go when the driver's garbage is collected; between the steps of a
    long job that is asked for, so they don't add up on the executors' disks.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (id, component) per
    endpoint, where component is the smallest id reachable.

    Alternating large-star / small-star rounds (Kiveris et al., 2014): each
    round links every node's larger (then smaller) neighbours to its smallest
    neighbour, so the edge count never grows and a graph of diameter d ends
    after O(log d) rounds in practice. Every round is a grouping and a join,
    written to the shared folder; only edge counts reach the driver.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = None
    for _ in range(max_rounds):
        # Large star: neighbours above a node move to its smallest neighbour (or itself).
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        # Small star: neighbours below a node, and the node, move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = stored(small, name)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components: not settled, raise max_rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def numbered(df: DataFrame, group: list[str], order: list[str], out: str, cell: Column) -> DataFrame:
    """Gapless 0-based number ``out`` within each ``group``, in the order of
    (``cell``, ``order``), without one task per group.

    ``cell`` deals a group's rows over many cells. The cells' counts are a
    small table whose running sums give each cell's first number; the rows are
    then numbered inside their own cell only.
    """
    d = df.withColumn("_cell", cell)
    counts = d.groupBy(*group, "_cell").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*group, "_cell", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_first"))
    inner = Window.partitionBy(*group, "_cell").orderBy(*order)
    d = d.withColumn("_k", F.row_number().over(inner) - 1)
    keys = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*group, "_cell"]]
    on = keys[0]
    for k in keys[1:]:
        on = on & k
    return (d.alias("l").join(first.alias("r"), on)
            .select(*[F.col(f"l.{c}") for c in df.columns], (F.col("_k") + F.col("_first")).cast("long").alias(out)))
