"""Minimum-cost-flow resharding: move the fewest bytes to reach new capacities.

Documents of an old shard are grouped into *blocks* (old shard, size class, hash
sub-block); only the blocks' byte and row counts, a number bounded by the
parameters, reach the driver.  There

1. old shards supply their bytes, new shards demand their capacities, and a
   minimum-cost flow (cost 0 for bytes that stay in the shard of the same number, 1
   for bytes that move, or a given matrix) says how many bytes go from where to where;
2. the flow is carried out in whole blocks, largest first, each to the destination
   of its shard with the most bytes still open;
3. blocks of the fullest shard are then moved to the emptiest while that brings the
   sizes closer to their capacities.

Blocks of small documents are small, so sizes end close to the capacities, and a
document's shard follows from its block alone: every task looks it up in the
bounded plan.  :func:`rewrite` shuffles the texts once, by block, gives each row its
slot (offset of the block in its shard plus place in the block) and writes the shards
that lose or gain rows.

Defined results: a null text counts 0 bytes; equal rows are kept as separate rows; a
null id is an ordinary value; empty input gives no files and no rows.
"""

from __future__ import annotations

import heapq
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from hourcast.llm._frames import aside, without
from hourcast.session import checkpoint_dir

SUB_BLOCKS = 32
ROW_BYTES = 8


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[float]]) -> dict[tuple[int, int], int]:
    """Amounts (source, target) -> units that meet ``demand`` from ``supply`` (equal sums)
    at the least total cost, by successive shortest paths with potentials."""
    n, m = len(supply), len(demand)
    left, open_ = list(supply), list(demand)
    flow: dict[tuple[int, int], int] = {}
    # nodes: sources 0..n-1, targets n..n+m-1; potentials keep reduced costs >= 0
    potential = [0.0] * n + [min((cost[i][j] for i in range(n)), default=0.0) for j in range(m)]
    while any(left):
        dist = [math.inf] * (n + m)
        back = [-1] * (n + m)
        heap = [(0.0, i) for i in range(n) if left[i]]
        for _, i in heap:
            dist[i] = 0.0
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            if u < n:
                edges = ((n + j, cost[u][j]) for j in range(m))
            else:
                edges = ((i, -cost[i][u - n]) for i in range(n) if flow.get((i, u - n)))
            for v, c in edges:
                new = d + max(0.0, c + potential[u] - potential[v])
                if new < dist[v] - 1e-12:
                    dist[v], back[v] = new, u
                    heapq.heappush(heap, (new, v))
        target = min((j for j in range(m) if open_[j]), key=lambda j: dist[n + j] + potential[n + j], default=None)
        if target is None or math.isinf(dist[n + target]):
            raise ValueError("supply and demand differ")
        far = dist[n + target]
        for u in range(n + m):
            potential[u] += min(dist[u], far)
        path, u = [], n + target
        while back[u] >= 0:
            path.append((back[u], u))
            u = back[u]
        amount = min([left[u], open_[target]] + [flow[(v, a - n)] for a, v in path if a >= n])
        for a, v in path:
            if a < n:
                flow[(a, v - n)] = flow.get((a, v - n), 0) + amount
            else:
                flow[(v, a - n)] -= amount
        left[u] -= amount
        open_[target] -= amount
    return {k: v for k, v in flow.items() if v}


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def plan_blocks(blocks: list[tuple], old_shards: int, capacities: list[int],
                cost: list[list[float]] | None = None) -> tuple[dict[tuple, int], dict[tuple[int, int], int]]:
    """(block key -> new shard, flow) for blocks ``(key, old shard, bytes)``."""
    new = len(capacities)
    supply = [0] * old_shards
    for _, s, size in blocks:
        supply[s] += size
    if cost is None:
        cost = [[0.0 if i == j else 1.0 for j in range(new)] for i in range(old_shards)]
    flow = min_cost_flow(supply, capacities, cost)
    open_ = dict(flow)
    targets = {s: [j for j in range(new) if (s, j) in flow] for s in range(old_shards)}
    home: dict[tuple, int] = {}
    size_of = {}
    total = [0] * new
    for key, s, size in sorted(blocks, key=lambda b: (-b[2], str(b[0]))):
        to = max(targets[s], key=lambda j: (open_[(s, j)], -j)) if targets[s] else min(s, new - 1)
        if targets[s]:
            open_[(s, to)] -= size
        home[key], size_of[key] = to, size
        total[to] += size
    _even_out(home, size_of, total, capacities)
    return home, flow


def _even_out(home: dict, size_of: dict, total: list[int], capacities: list[int], rounds: int = 400) -> None:
    """Move blocks, or swap two, between the fullest and the emptiest shard while it helps."""
    import bisect
    members: list[list[tuple]] = [[] for _ in total]
    for key, shard in home.items():
        bisect.insort(members[shard], (size_of[key], str(key), key))
    for _ in range(rounds):
        over = [t - c for t, c in zip(total, capacities)]
        a, b = max(range(len(over)), key=over.__getitem__), min(range(len(over)), key=over.__getitem__)
        gap = over[a] - over[b]
        if gap <= 1:
            return
        best = None                                    # (remaining gap, block of a, block of b)
        for ours in members[a]:
            want = ours[0] - gap / 2
            if want <= 0:
                if best is None or abs(gap - 2 * ours[0]) < best[0]:
                    best = (abs(gap - 2 * ours[0]), ours, None)
                continue
            at = bisect.bisect(members[b], (want,))
            for theirs in members[b][max(0, at - 1):at + 1]:
                rest = abs(gap - 2 * (ours[0] - theirs[0]))
                if best is None or rest < best[0]:
                    best = (rest, ours, theirs)
        if best is None or best[0] >= gap:
            return
        for item, x, y in ((best[1], a, b), (best[2], b, a)):
            if item:
                members[x].remove(item)
                bisect.insort(members[y], item)
                home[item[2]] = y
                total[x] -= item[0]
                total[y] += item[0]


def measured(docs: DataFrame, old_shard: Column, text: str = "text", key: str = "doc_id",
             sub_blocks: int = SUB_BLOCKS) -> DataFrame:
    """``docs`` with __size, __old and the block columns __class and __sub."""
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")
    out = docs.withColumn("__size", size).withColumn("__old", old_shard.cast("int"))
    return (out.withColumn("__class", F.floor(F.log2("__size")).cast("int"))
            .withColumn("__sub", F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(sub_blocks)).cast("int")))


def plan(spark: SparkSession, sized: DataFrame, old_shards: int, new_shards: int,
         capacities: list[int] | None = None, cost: list[list[float]] | None = None) -> DataFrame:
    """Block table: __old, __class, __sub, shard, offset (rows of the shard before the block).

    It has at most old_shards * 64 * sub_blocks rows, whatever the number of documents.
    """
    key = ("__old", "__class", "__sub")
    got = sized.groupBy(*key).agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    got = sorted(got, key=lambda r: tuple(r[k] for k in key))
    total = sum(r["bytes"] for r in got)
    capacities = capacities or even_capacities(total, new_shards)
    home, _ = plan_blocks([(tuple(r[k] for k in key), r["__old"], r["bytes"]) for r in got],
                          old_shards, capacities, cost)
    rows, offset = [], [0] * len(capacities)
    for r in got:
        k = tuple(r[x] for x in key)
        rows.append((*k, home[k], offset[home[k]]))
        offset[home[k]] += r["rows"]
    return spark.createDataFrame(rows, "__old int, __class int, __sub int, shard int, offset long")


def rewrite(spark: SparkSession, sized: DataFrame, blocks: DataFrame, folder: str,
            key: str = "doc_id") -> list[int]:
    """Write the rows of every affected shard below ``folder`` (``shard=N``), with their
    ``slot``; returns the shards that keep all their rows and get none, whose old files stay.
    """
    # a shard is affected if one of its blocks comes from or goes to another shard
    moved = blocks.filter("__old != shard")
    affected = {r[0] for r in moved.select(F.explode(F.array("__old", "shard"))).distinct().collect()}
    kept = {r[0] for r in blocks.select("shard").distinct().collect()} - affected
    block = ("__old", "__class", "__sub")
    # the plan's size is bounded by its parameters (see plan)
    rows = sized.join(F.broadcast(blocks), list(block))
    if kept:
        rows = rows.filter(~F.col("shard").isin(*kept))
    place = Window.partitionBy(*block).orderBy(F.col(key).asc_nulls_first(), "__size")
    columns = [c for c in sized.columns if not c.startswith("__") and c not in ("shard", "slot")]
    (rows.withColumn("slot", (F.col("offset") + F.row_number().over(place) - 1).cast("long"))
     .select(*columns, "slot", "shard")
     .write.partitionBy("shard").parquet(folder))
    return sorted(kept)


def reshard(spark: SparkSession, docs: DataFrame, old_shard: Column, old_shards: int, new_shards: int,
            text: str = "text", key: str = "doc_id", folder: str | None = None) -> DataFrame:
    """Plan, write the affected shards and read them back: the rows of ``docs`` with
    ``shard`` and ``slot``."""
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/reshard-{uuid.uuid4().hex}"
    docs, back = aside(docs, "offset", but=(text, key))
    base = without(docs, "shard", "slot")
    sized = measured(base, old_shard, text, key)
    blocks = plan(spark, sized, old_shards, new_shards)
    kept = rewrite(spark, sized, blocks, folder, key)
    schema = StructType([*base.schema.fields, StructField("slot", LongType()), StructField("shard", IntegerType())])
    out = spark.read.schema(schema).parquet(folder)
    if kept:
        place = Window.partitionBy("__old", "__class", "__sub").orderBy(F.col(key).asc_nulls_first(), "__size")
        still = sized.join(F.broadcast(blocks.filter(F.col("shard").isin(*kept))), ["__old", "__class", "__sub"])
        still = still.withColumn("slot", (F.col("offset") + F.row_number().over(place) - 1).cast("long"))
        out = out.select(*base.columns, "slot", "shard").unionByName(
            still.select(*base.columns, "slot", "shard"))
    return back(out)
