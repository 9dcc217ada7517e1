"""Sharding by balanced label propagation: linked documents gather in one shard, sizes stay even.

Documents of one group (here: of equal texts) are linked with each other. A group is held as cells, one for every shard that
has some of it, with the number of its documents there; a group of a third of all rows is ``shards`` cells. Labels start
spread evenly over the shards. Each round

1. sums the linked sizes by shard, and with them the room that is left under the quota (all sizes over ``shards``),
2. takes as a group's homes the shards that have room for all of it and hold most of it, or as many as have that room,
3. asks to move what stands elsewhere to a home, and grants of that the share that keeps every shard within its quota
   (and ``SLACK``), counting what moves away too (a table of shards by shards, so the driver does it).

Cells only move into cells that are there, so links cut never grow; the rounds end when nothing more moves. What a
shard then holds beyond its quota leaves its largest cells. Documents without links, and those, fill the room that is left: the
ones above a thousandth of the quota (at most 1000 x ``shards`` of them) one by one, largest first into the emptiest
shard; the others along one line, cut where a shard is full. So sizes differ by about a thousandth of the quota unless single
documents are larger than that allows.

Defined cases: a null text has the size of an empty one and is linked with empty ones; null and repeated keys are kept
row by row; rows equal in key and text are linked like any others; other columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlens.operators.rowindex import with_row_index
from txnlens.session import materialize

SHARDS = 40
#: Size of a document besides its text.
OWN_BYTES = 16
#: While labels move, shards may hold this much of their quota, so that there is room where all documents are linked.
SLACK = 1.1
#: Rounds in a row that bring nothing together before the propagation ends.
IDLE_ROUNDS = 3
#: Documents above this share of the quota are placed one by one.
LARGE = 1_000


def _pick(values: list[float], at: Column) -> Column:
    """The shard's number out of a list of ``shards`` numbers."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), at + 1)


def _uniform(*parts) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / float(1 << 40)


def granted(loads: list[float], wanted: dict[tuple[int, int], float], quota: float) -> list[float]:
    """For each shard the share of the wish to move there that its quota allows, with what leaves it by the same rule."""
    n = len(loads)
    share = [1.0] * n
    into = [sum(w for (_, t), w in wanted.items() if t == j) for j in range(n)]
    for _ in range(10 * n):
        leaves = [0.0] * n
        for (s, t), w in wanted.items():
            leaves[s] += share[t] * w
        new = [min(share[j], max(0.0, quota - loads[j] + leaves[j]) / into[j]) if into[j] else 0.0 for j in range(n)]
        if max(abs(a - b) for a, b in zip(share, new)) < 1e-9:
            break
        share = new
    return share


def loads_of(cells: DataFrame, shards: int) -> list[float]:
    out = [0.0] * shards
    for r in cells.groupBy("shard").agg(F.sum(F.col("m") * F.col("w")).alias("load")).collect():  # a row a shard
        out[r["shard"]] = float(r["load"])
    return out


def propagate(cells: DataFrame, quota: float, shards: int) -> DataFrame:
    """Rounds over (g, shard, m, w): documents ``m`` of mean size ``w`` that group ``g`` has in a shard."""
    turn = idle = 0
    best = 0.0
    mass = F.col("m") * F.col("w")
    while True:
        loads = loads_of(cells, shards)
        room = [max(0.0, quota - x) for x in loads]
        group = Window.partitionBy("g")  # at most one cell a shard
        placed = cells.withColumn("all", F.sum(mass).over(group)).withColumn("can", mass + _pick(room, F.col("shard")))
        most = group.orderBy(F.col("can") < F.col("all"), F.desc("m"), F.xxhash64("g", "shard"), "shard")
        placed = placed.withColumn("before", F.coalesce(F.sum("can").over(
            most.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        placed = placed.withColumn("home", (F.row_number().over(most) == 1) | (F.col("before") < F.col("all")))
        homes = F.collect_list(F.when(F.col("home"), F.col("shard"))).over(group)
        placed = placed.withColumn("homes", homes).withColumn(
            "target", F.when(F.col("home"), F.col("shard")).otherwise(F.element_at(
                "homes", (F.pmod(F.xxhash64("g", "shard"), F.size("homes")) + 1).cast("int"))))
        placed = materialize(placed.select("g", "shard", "m", "w", "target"), "wishes")
        wishes = placed.where("shard <> target").groupBy("shard", "target").agg(F.sum(mass).alias("bytes"))
        wanted = {(r["shard"], r["target"]): float(r["bytes"]) for r in wishes.collect()}  # shards x shards at most
        if not wanted:
            return cells
        share = granted(loads, wanted, quota)
        goes = F.when(F.col("shard") == F.col("target"), F.lit(0)).otherwise(F.least(F.col("m"), F.floor(
            F.col("m") * _pick(share, F.col("target")) + _uniform("g", "shard", F.lit(turn)))))
        split = placed.withColumn("goes", goes.cast("bigint")).select("g", "w", F.explode(F.array(
            F.struct("shard", (F.col("m") - F.col("goes")).alias("m")),
            F.struct(F.col("target").alias("shard"), F.col("goes").alias("m")))).alias("c"))
        after = materialize(split.select("g", "w", "c.*").where("m > 0").groupBy("g", "shard").agg(
            F.sum("m").alias("m"), F.first("w").alias("w")), "cells")
        # the rounds end when groups no longer come together; what is granted may be too little for a single document
        together = lambda c: float(c.agg(F.sum(F.col("m").cast("double") * F.col("m") * F.col("w"))).first()[0])
        now = together(after)
        idle, best = (0, now) if now > best * (1 + 1e-9) else (idle + 1, best)
        if idle == IDLE_ROUNDS:
            return cells
        cells, turn = after, turn + 1


def within_quota(cells: DataFrame, quota: float, shards: int) -> DataFrame:
    """Takes from the largest cell of a shard above its quota what is too much, until no shard is above it."""
    while True:
        loads = loads_of(cells, shards)
        over = [s for s in range(shards) if loads[s] > quota]
        if not over:
            return cells
        largest = cells.groupBy("shard").agg(F.max(F.struct(F.col("m") * F.col("w"), "g", "m", "w")).alias("c"))
        cut = [(r["shard"], r["c"]["g"], int(min(r["c"]["m"], -((quota - loads[r["shard"]]) // r["c"]["w"]))))
               for r in largest.where(F.col("shard").isin(over)).collect()]  # a row a shard
        less = cells.sparkSession.createDataFrame(cut, "shard int, g bigint, less bigint")
        cells = cells.join(F.broadcast(less), ["shard", "g"], "left")
        cells = materialize(cells.select("g", "shard", (F.col("m") - F.coalesce("less", F.lit(0))).alias("m"), "w")
                            .where("m > 0"), "cells")


def running_total(df: DataFrame, value: str, order: list[str], out: str) -> DataFrame:
    """The sum of ``value`` over the rows before each, in the given order, without bringing all rows to one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local = materialize(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "line")
    parts = local.groupBy("_part").agg(F.sum(value).alias("s"))  # a row a partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return local.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(F.broadcast(parts), "_part") \
        .withColumn(out, F.col("_inside") + F.col("_offset")).drop("_part", "_inside", "_offset")


def fill(rest: DataFrame, loads: list[float], quota: float) -> DataFrame:
    """(g, pos, shard) for documents (g, pos, z) without a shard."""
    spark = rest.sparkSession
    loads = list(loads)
    large = F.col("z") > quota / LARGE
    heap = [(x, s) for s, x in enumerate(loads)]
    heapq.heapify(heap)
    placed = []
    for r in sorted(rest.where(large).toLocalIterator(), key=lambda r: (-r["z"], r["g"], r["pos"])):  # at most LARGE x shards
        x, s = heapq.heappop(heap)
        placed.append((r["g"], r["pos"], s))
        loads[s] = x + r["z"]
        heapq.heappush(heap, (loads[s], s))
    first = spark.createDataFrame(placed, "g bigint, pos bigint, shard int")
    line = running_total(rest.where(~large).withColumn("_by", F.xxhash64("g", "pos")), "z", ["_by", "g", "pos"], "before")
    whole = line.agg(F.max(F.col("before") + F.col("z"))).first()[0] or 0
    # the level to which that much fills the emptiest shards
    order = sorted(range(len(loads)), key=lambda s: loads[s])
    level, used = loads[order[0]], float(whole)
    for i, s in enumerate(order):
        upper = loads[order[i + 1]] if i + 1 < len(order) else float("inf")
        step = min(upper - level, used / (i + 1))
        level, used = level + step, used - step * (i + 1)
        if used <= 1e-9:
            break
    ends, sum_ = [], 0.0
    for s in range(len(loads)):
        sum_ += max(0.0, level - loads[s])
        ends.append(sum_)
    middle = F.col("before") + F.col("z") / 2
    shard = F.lit(len(loads) - 1)
    passed = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= middle))
    shard = F.least(passed, F.lit(max((s for s in range(len(loads)) if loads[s] < level), default=0)))
    return first.unionByName(line.select("g", "pos", shard.cast("int").alias("shard")))


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(key, size, text_crc32, shard, slot) of each row; rows of equal texts are linked."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = materialize(docs.select(F.col(key).alias("k"), F.xxhash64(t).alias("g"), F.crc32(t.cast("binary")).alias("crc"),
                                   (F.octet_length(t) + OWN_BYTES).cast("bigint").alias("z")), "rows")
    groups = materialize(rows.groupBy("g").agg(F.count("*").alias("n"), F.sum("z").alias("all")).where("n > 1"), "groups")
    quota = float(rows.agg(F.sum("z")).first()[0] or 0) / shards

    first = F.pmod(F.xxhash64("g"), F.lit(shards))
    spread = groups.select("g", "n", (F.col("all") / F.col("n")).alias("w"), F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.least("n", F.lit(shards)) - 1)).alias("j"))
    cells = materialize(spread.select("g", ((first + F.col("j")) % shards).cast("int").alias("shard"),
                                      (F.floor((F.col("n") - 1 - F.col("j")) / shards) + 1).alias("m"), "w"), "cells")
    cells = within_quota(propagate(cells, quota * SLACK, shards), quota, shards)

    # Documents of a group are dealt to its cells in the order of their keys.
    held = cells.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("shard", "m"))).alias("cells"))  # at most one a shard
    linked = with_row_index(rows.join(groups.select("g"), "g"), ["g", "k"], "row")
    begin = linked.groupBy("g").agg(F.min("row").alias("begin"))
    ends = F.transform("cells", lambda c, i: F.struct(
        c["shard"].alias("shard"), F.aggregate(F.slice("cells", 1, i + 1), F.lit(0).cast("bigint"),
                                               lambda s, x: s + x["m"]).alias("end")))
    plan = materialize(begin.join(held, "g", "left").select("g", "begin", ends.alias("cells")), "plan")
    linked = linked.join(plan, "g").withColumn("pos", F.col("row") - F.col("begin"))
    at = F.filter("cells", lambda c: F.col("pos") < c["end"])
    linked = materialize(linked.select("k", "g", "crc", "z", "pos", F.get(at, F.lit(0))["shard"].alias("shard")), "linked")
    free = rows.join(groups.select("g"), "g", "left_anti").select("k", "g", "crc", "z", F.lit(0).cast("bigint").alias("pos"))

    rest = materialize(free.unionByName(linked.where("shard is null").drop("shard")), "rest")
    filled = rest.join(fill(rest.select("g", "pos", "z"), loads_of(cells, shards), quota), ["g", "pos"])
    every = linked.where("shard is not null").unionByName(filled.select(*linked.columns))
    numbered = with_row_index(every, ["shard", "g", "pos", "k"], "row")
    begin = numbered.groupBy("shard").agg(F.min("row").alias("begin"))  # a row a shard
    return numbered.join(F.broadcast(begin), "shard").select(
        F.col("k").alias(key), F.col("z").alias("size"), F.col("crc").cast("bigint").alias("text_crc32"), "shard",
        (F.col("row") - F.col("begin")).alias("slot"))
