"""Balanced label propagation of documents over shards, with DataFrame functions only.

Documents with equal texts are linked. A group is a hub: a document's
neighbours' shards are its group's histogram over the shards, so no pair of
copies is ever formed. Rows of one group in one shard are interchangeable, so
the rounds work on cells (group, shard, count) and rows are handed out once, at
the end: a group of a billion copies is 40 cells. The method (after Ugander and
Backstrom, 2013):

1. linked documents are dealt over the shards evenly by rank, and counted to cells;
2. in each round every cell looks at the shard that holds most of its group;
   ties are drawn anew each round. A shard is full only when documents that
   want to be there fill it: those that want to leave count as room. Groups
   larger than a shard pass over full shards, of the others half, drawn anew
   each round, so the rest of a full shard can swap. If the move gains
   neighbours the cell asks for it (its rows move together; those of a group
   larger than a shard one by one);
3. each shard admits the requests with the highest gain up to its quota, the
   even share less those that stay; a cell may be admitted in part;
4. a shard over its share then gives up refused cells, small ones first, to the
   shards with room;
5. rounds end when nobody can gain by a move, or when ``PATIENCE`` rounds in a
   row made no further link whole; the deal with the most whole links is kept;
6. linked rows take the places of their group's cells by rank, and documents
   without links fill every shard up to its share.

So the shards' row counts differ by one at most (law ``rows``), and a group
larger than a shard spreads over as few as can hold it. Quotas and sums per
shard and gain (at most 66 a shard) are all that the driver sees; a level of
gain that fits only in part is summed up in buckets that grow in number with the
cells, so no shard is ranked in one task. Groups larger than a shard (fewer
than there are shards) are broadcast to their rows, so no join meets a hot text.

Defined results: a null text has no bytes and the CRC of the empty text, and
null and empty texts are linked with nothing; repeated rows are rows of their
own; extra columns are ignored; an empty table gives an empty result. Working
columns start with ``_s_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, stored, table, text_of

SHARDS = 40
#: Rounds without a further whole link after which the deal is final.
PATIENCE = 4
#: Rows ranked, or cells summed up, together in one task, about.
CELL_ROWS = 20_000
ROW_BYTES = 16


def _buckets(n: int) -> int:
    return max(1, -(-n // CELL_ROWS))


def _ranked(df: DataFrame, group: list[str], out: str, buckets: int) -> DataFrame:
    return numbered(df, group, ["_s_row"], out, F.pmod(F.xxhash64("_s_row"), F.lit(buckets)))


def _level(count: Column) -> Column:
    """Larger counts first, by powers of two."""
    return (64 - F.least(F.lit(63), F.floor(F.log2(count)))).cast("int")


def _within(cells: DataFrame, place: str, quota: dict[int, int], buckets: int, salt: int) -> DataFrame:
    """How much of each cell's count ``c`` lies within the quota of its
    ``place``, levels ``_s_level`` in order: column ``got``."""
    spark = cells.sparkSession
    sums: dict[int, list[tuple[int, int]]] = {}
    for r in cells.groupBy(place, "_s_level").agg(F.sum("c").alias("c")).collect():        # at most 66 levels a shard
        sums.setdefault(r[place], []).append((r["_s_level"], r["c"]))
    limits = []
    for p, levels in sums.items():
        before = 0
        for level, c in sorted(levels):
            limits.append((p, level, max(0, min(c, quota.get(p, 0) - before)), c))
            before += c
    limit = spark.createDataFrame(limits, "_s_p int, _s_l int, _s_may long, _s_all long")
    d = cells.join(F.broadcast(limit), (F.col(place) == F.col("_s_p")) & (F.col("_s_level") == F.col("_s_l"))).drop("_s_p", "_s_l")
    whole = d.where("_s_may = 0 or _s_may = _s_all").withColumn("got", F.when(F.col("_s_may") == 0, F.lit(0)).otherwise(F.col("c")).cast("long"))
    if not any(0 < may < c for _, _, may, c in limits):
        return whole.drop("_s_may", "_s_all")
    part = _running(d.where("_s_may > 0 and _s_may < _s_all"), [place, "_s_level"], buckets, salt)
    part = part.withColumn("got", F.greatest(F.lit(0), F.least(F.col("c"), F.col("_s_may") - F.col("_s_before"))).cast("long")).drop("_s_before")
    return whole.unionByName(part.select(whole.columns)).drop("_s_may", "_s_all")


def _running(cells: DataFrame, group: list[str], buckets: int, salt: int) -> DataFrame:
    """Sum of ``c`` before each cell of its ``group`` (``_s_before``), bucket by bucket."""
    d = cells.withColumn("_s_b", F.pmod(F.xxhash64("_s_group", F.lit(salt)), F.lit(buckets)).cast("int"))
    by = d.groupBy(*group, "_s_b").agg(F.sum("c").alias("_s_n"))
    upto = Window.partitionBy(*group).orderBy("_s_b").rowsBetween(Window.unboundedPreceding, -1)       # one row per bucket
    first = by.select(*group, "_s_b", F.coalesce(F.sum("_s_n").over(upto), F.lit(0)).alias("_s_first"))
    inner = Window.partitionBy(*group, "_s_b").orderBy("_s_group", "shard").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_s_in", F.coalesce(F.sum("c").over(inner), F.lit(0)))
    return d.join(first, [*group, "_s_b"]).withColumn("_s_before", F.col("_s_in") + F.col("_s_first")).drop("_s_b", "_s_in", "_s_first")


def _shares(n: int, shards: int) -> dict[int, int]:
    return {s: n // shards + (s < n % shards) for s in range(shards)}


def propagate(cells: DataFrame, n: int, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """Cells (_s_group, shard, c) of linked rows among ``n`` rows, moved.

    Before and after each round no shard holds more than its even share of
    ``n``. ``rounds`` bounds the rounds, if given.
    """
    share = _shares(n, shards)
    best_deal, most, idle, turn, full = cells, -1, 0, 0, []
    while True:
        # The shard with most of the group; ties go to a shard that depends on the group and the round.
        most_of = F.struct("c", F.xxhash64("_s_group", "shard", F.lit(turn)).alias("h"), "shard")
        groups = cells.groupBy("_s_group").agg(F.sum("c").alias("size"), F.collect_list(F.struct("c", "shard")).alias("places"),      # at most one entry per shard
                                               F.max(most_of).alias("any"), F.max(F.when(~F.col("shard").isin(full), most_of)).alias("open"))
        # A group that no shard can hold passes over the full ones; of the others half do, by a draw, so shards can swap.
        large = F.col("size") > n // shards
        passes = large | (F.pmod(F.xxhash64("_s_group", F.lit(-1 - turn)), F.lit(2)) == 0)
        groups = stored(groups.withColumn("b", F.when(passes, F.col("open")).otherwise(F.col("any"))), "shards-groups")
        could = F.when(large, F.exists("places", lambda x: (x["shard"] != F.col("open.shard")) & (x["c"] <= F.col("open.c")))).otherwise(F.size("places") > 1)
        square = F.aggregate("places", F.lit(0).cast("decimal(38,0)"), lambda t, x: (t + x["c"].cast("decimal(19,0)") * x["c"]).cast("decimal(38,0)"))
        seen = groups.agg(F.sum(square).alias("whole"), F.max(could).alias("could"), F.sum(F.size("places")).alias("cells")).first()
        whole, buckets = int(seen["whole"] or 0), _buckets(seen["cells"] or 0)
        best_deal, most, idle = (cells, whole, 0) if whole > most else (best_deal, most, idle + 1)
        if not seen["could"] or idle >= PATIENCE or turn == rounds:
            return best_deal
        # A cell moves with all its rows, so it gains the neighbours it finds there; of a large group rows move one by one.
        asked = groups.select("_s_group", "b", large.alias("large"), F.inline("places"))
        asked = asked.withColumn("gain", F.coalesce(F.col("b.c") - F.when(F.col("large"), F.col("c") - 1).otherwise(0), F.lit(0)))
        moves = F.col("b.shard").isNotNull() & (F.col("b.shard") != F.col("shard")) & (F.col("gain") > 0)
        asked = asked.select("_s_group", "shard", "c", F.when(moves, F.col("b.shard")).otherwise(F.col("shard")).alias("to"), F.when(moves, _level(F.col("gain"))).alias("_s_level"))
        stays = asked.where("to = shard")
        staying = {r["shard"]: r["c"] for r in stays.groupBy("shard").agg(F.sum("c").alias("c")).collect()}       # one row per shard
        quota = {s: share[s] - staying.get(s, 0) for s in share}
        asked = _within(asked.where("to <> shard"), "to", quota, buckets, turn)
        moved = stays.select("_s_group", "shard", "c", F.lit(True).alias("in"))
        moved = moved.unionByName(asked.select("_s_group", F.col("to").alias("shard"), F.col("got").alias("c"), F.lit(True).alias("in")))
        moved = moved.unionByName(asked.select("_s_group", "shard", (F.col("c") - F.col("got")).alias("c"), F.lit(False).alias("in"))).where("c > 0")
        # Refused cells lie where none stays or comes in, so a cell is the one or the other.
        cells = stored(moved.groupBy("_s_group", "shard").agg(F.sum("c").alias("c"), F.max("in").alias("in")), "shards-cells")
        held = {r["shard"]: r for r in cells.groupBy("shard").agg(F.sum("c").alias("c"), F.sum(F.when(F.col("in"), F.col("c"))).alias("settled")).collect()}
        full = [s for s, r in held.items() if (r["settled"] or 0) >= share[s]]
        over = any(r["c"] > share[s] for s, r in held.items())
        cells = _levelled(cells, n, shards, buckets) if over else cells.drop("in")
        turn += 1


def _levelled(cells: DataFrame, n: int, shards: int, buckets: int) -> DataFrame:
    """No shard over its share: what is over, refused cells (``in`` is false)
    and small ones first, goes to the shards with room."""
    spark, share = cells.sparkSession, _shares(n, shards)
    d = cells.select("_s_group", "shard", "c", (_level(F.col("c")) + F.when(F.col("in"), F.lit(0)).otherwise(F.lit(100))).alias("_s_level"))
    d = stored(_within(d, "shard", share, buckets, -1), "shards-within")
    held = {r["shard"]: r["c"] for r in d.groupBy("shard").agg(F.sum("got").alias("c")).collect()}       # one row per shard
    at, rooms = 0, []
    for s in share:
        room = share[s] - held.get(s, 0)
        rooms.append((at, at + room, s))
        at += room
    stay = d.where("got > 0").select("_s_group", "shard", F.col("got").alias("c"))
    spare = d.where("c > got").select("_s_group", "shard", (F.col("c") - F.col("got")).alias("c")).withColumn("_s_all", F.lit(0))
    spare = _running(spare, ["_s_all"], buckets, -2)
    gaps = spark.createDataFrame([(rooms,)], "rooms array<struct<a:long,b:long,s:int>>")                 # one entry per shard
    meet = F.filter("rooms", lambda g: (g["a"] < F.col("_s_before") + F.col("c")) & (g["b"] > F.col("_s_before")))
    dealt = spare.join(F.broadcast(gaps)).select("_s_group", "_s_before", "c", F.inline(meet))
    dealt = dealt.select("_s_group", F.col("s").alias("shard"), (F.least("b", F.col("_s_before") + F.col("c")) - F.greatest("a", "_s_before")).alias("c"))
    return stored(stay.unionByName(dealt).groupBy("_s_group", "shard").agg(F.sum("c").alias("c")), "shards-cells")


def _by_group(rows: DataFrame, groups: DataFrame, key: list[str], limit: int) -> DataFrame:
    """``rows`` with the columns of their group; groups of more than ``limit``
    rows (column ``size``; fewer than there are shards) are broadcast."""
    many = [tuple(r) for r in groups.where(F.col("size") > limit).select(*key).collect()]
    if not many:
        return rows.join(groups, key)
    hot = rows.sparkSession.createDataFrame(many, rows.select(*key).schema)
    cold = rows.join(F.broadcast(hot), key, "left_anti").join(groups.where(F.col("size") <= limit), key)
    warm = rows.join(F.broadcast(groups.where(F.col("size") > limit)), key)
    return warm.select(cold.columns).unionByName(cold)


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, size, text_crc32, shard and its slot there."""
    spark = docs.sparkSession
    t = text_of(text)
    rows = docs.select(F.col(id_col), (F.octet_length(t) + ROW_BYTES).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
                       F.when(t != "", F.md5(t.cast("binary"))).alias("_s_text"))
    rows = stored(rows.withColumn("_s_row", F.monotonically_increasing_id()), "shards-documents")
    n = rows.count()
    buckets, share, limit = _buckets(n), _shares(n, shards), n // shards
    # Groups of equal texts (by digest and size), each named by its first row.
    texts = rows.where("_s_text is not null").select("_s_row", "_s_text", F.col("size").alias("_s_size"))
    groups = stored(texts.groupBy("_s_text", "_s_size").agg(F.count("*").alias("size"), F.min("_s_row").alias("_s_group")).where("size > 1"), "shards-texts")
    linked = stored(_by_group(texts, groups, ["_s_text", "_s_size"], limit).select("_s_row", "_s_group"), "shards-linked")
    linked = stored(_ranked(linked, ["_s_group"], "_s_place", buckets), "shards-ranked")
    first = _ranked(linked.select("_s_row", "_s_group", F.lit(0).alias("_s_all")), ["_s_all"], "_s_rank", buckets)
    start = stored(first.groupBy("_s_group", F.pmod("_s_rank", F.lit(shards)).cast("int").alias("shard")).agg(F.count("*").alias("c")), "shards-cells")
    cells = propagate(start, n, shards, rounds)
    # Linked rows take their group's cells in order.
    held = {r["shard"]: r["c"] for r in cells.groupBy("shard").agg(F.sum("c").alias("c")).collect()}       # one row per shard
    places = cells.groupBy("_s_group").agg(F.sum("c").alias("size"), F.sort_array(F.collect_list(F.struct("shard", "c"))).alias("places"))     # at most one entry per shard
    ends = F.transform("places", lambda x, k: F.struct(x["shard"].alias("shard"), F.aggregate(F.slice("places", 1, k + 1), F.lit(0).cast("long"), lambda a, y: a + y["c"]).alias("end")))
    places = stored(places.select("_s_group", "size", ends.alias("ends")), "shards-places")
    put = _by_group(linked, places, ["_s_group"], limit)
    put = put.select("_s_row", F.filter("ends", lambda x: x["end"] > F.col("_s_place"))[0]["shard"].alias("shard"))
    # Rows without links fill the rooms that are left.
    free = rows.select("_s_row").join(linked.select("_s_row"), "_s_row", "left_anti").withColumn("_s_all", F.lit(0))
    free = _ranked(free, ["_s_all"], "_s_place", buckets)
    at, rooms = 0, []
    for s in share:
        at += share[s] - held.get(s, 0)
        rooms.append((s, at))
    gaps = spark.createDataFrame([(rooms,)], "ends array<struct<shard:int,end:long>>")                   # one entry per shard
    free = free.join(F.broadcast(gaps)).select("_s_row", F.filter("ends", lambda x: x["end"] > F.col("_s_place"))[0]["shard"].alias("shard"))
    done = stored(put.unionByName(free), "shards-rows")
    slots = _ranked(done, ["shard"], "slot", buckets)
    return rows.join(slots, "_s_row").select(id_col, "size", "text_crc32", "shard", "slot")


def cut_links(assigned: DataFrame, group: list[str], shard_col: str = "shard") -> DataFrame:
    """One row: links between equal rows (pairs of a group), and those cut."""
    each = assigned.groupBy(*group, shard_col).agg(F.count("*").cast("double").alias("c"))
    by = each.groupBy(*group).agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("q"))
    return by.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("links"), F.sum((F.col("n") * F.col("n") - F.col("q")) / 2).alias("cut"))


# ---- registered query -------------------------------------------------------

def op5_label_propagation(spark, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
