"""Exact top-k inner-product search by a Voronoi kNN join.

Method:

1. Pivots (sampled vectors, of smallest hash) cut the space into cells; every vector goes
   to its nearest pivot.  Their number grows with the root of the rows (:func:`n_pivots`)
   up to ``MOST_PIVOTS``.
2. Queries of a cell form a group.  Its summary is the largest distance R of a query to
   the pivot and the smallest, over its queries, of a lower bound of the k-th best score,
   taken from ``WITNESSES`` real vectors.
3. Vectors of a cell are packed in chunks with a summary: the largest distance r to
   the pivot p.  For a query group with pivot c no score in the chunk is above
   <c, p> + R |p| + (|c| + R) r.  A chunk is sent to a group only if this reaches
   the group's bound, so a chunk that could hold a result is always sent.
4. A group's query blocks are bundled, about ``BUNDLE`` * ``BLOCK`` queries at a time, and the
   chunks sent to it are dealt over parts of about ``PART_CHUNKS``; every bundle meets every part in a cogrouped
   task, which holds each block and each chunk once, whatever their order, and solves
   them by matrix products.  It keeps k candidates per query, and the k best of these over
   all tasks are the result.

The numbers of bundles and parts of a group come from counts, so a task stays at some
16 MB for 64 components, and one crowded cell is spread over as many tasks as it needs.
Pivots, witnesses and group summaries have fixed maximum sizes.

Scores are exact while |score| < 2**53.  Defined results: a vector that is null or
holds null or non-finite components takes no part; a shorter vector counts as
padded with zeros; ties go to the smaller id; rows with equal ids are separate
candidates, and a query leaves out only rows of its own id; every query row is a query
of its own, so rows that share a query id, with equal vectors or not, give k rows each
under that id, ranked from 1; fewer than k candidates give fewer rows; a null id takes
no part; empty input, empty output.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.session import checkpoint_dir

LEAST_PIVOTS, MOST_PIVOTS = 16, 512
WITNESSES = 512
CHUNK = 1024
BLOCK = 2048
BUNDLE, PART_CHUNKS = 4, 16


def n_pivots(rows: int) -> int:
    """Pivots for so many vectors: 16 up to 50,000 rows, 158 for 5 million, 512 at most."""
    return min(MOST_PIVOTS, max(LEAST_PIVOTS, round((rows / 200) ** 0.5)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as one matrix, padded with zeros to ``dim``."""
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(n) and (n == dim).all():
        return flat.reshape(len(n), dim).astype(np.float64)
    out = np.zeros((len(n), dim))
    row = np.repeat(np.arange(len(n)), n)
    ends = np.cumsum(n)
    out[row, np.arange(len(flat)) - np.repeat(ends - n, n)] = flat
    return out


def valid_vectors(table: DataFrame, key: str, vector: str, component) -> DataFrame:
    """(id, v): usable vectors, each component through ``component`` as double."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (table.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(key).cast("long").alias("id"),
                    F.transform(vector, lambda x: component(x.cast("double")).cast("double")).alias("v")))


def _bounded(rows: DataFrame, n: int, total: int, dim: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``n`` of ``total`` vectors, those whose id has the smallest hash: (ids, matrix)."""
    h = F.xxhash64("id", F.lit(salt))
    # a bound on the hash that about 8 n vectors meet, so that few are sorted
    bound = min((1 << 63) - 1, -(1 << 63) + int(min(1.0, 8 * n / max(total, 1)) * (1 << 64)))
    got = rows.filter(h <= F.lit(bound)).orderBy(h, "id").limit(n).collect()
    out = np.zeros((len(got), dim))
    for i, r in enumerate(got):
        out[i, :len(r["v"])] = r["v"]
    return np.array([r["id"] for r in got], np.int64), out


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d2 = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None, :]
    cell = d2.argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def _chunks(shared, dim: int, k: int):
    """Vectors to packed chunks: of all vectors (is_query false) by cell, and of queries
    by cell in blocks.  A chunk holds ids and components of one cell, and a block also the
    row numbers, which tell queries of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, witness_ids, witnesses = shared.value
        names = ["is_query", "cell", "radius", "bound", "n", "ids", "vectors", "row_numbers"]
        types = [pa.bool_(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), *[pa.binary()] * 3]

        def rows(ids, x, cell, dist, bound, is_query, size, numbers=None):
            out = []
            for c in np.unique(cell):
                mine = np.flatnonzero(cell == c)
                mine = mine[np.argsort(dist[mine], kind="stable")]     # near and far ones apart: tight radii
                for i in range(0, len(mine), size):
                    m = mine[i:i + size]
                    out.append((is_query, int(c), float(dist[m].max()), float(bound[m].min()), len(m),
                                ids[m].tobytes(), x[m].tobytes(),
                                numbers[m].tobytes() if is_query else None))
            return out

        def flush(ids, x, query, numbers):
            cell, dist = _nearest(x, pivots)
            none = np.zeros(len(ids))
            out = rows(ids, x, cell, dist, none, False, CHUNK)
            q = np.flatnonzero(query)
            if len(q):
                score = x[q] @ witnesses.T
                score[ids[q][:, None] == witness_ids[None, :]] = -np.inf
                bound = (np.sort(score, axis=1)[:, -k] if score.shape[1] >= k
                         else np.full(len(q), -np.inf))
                out += rows(ids[q], x[q], cell[q], dist[q], bound, True, BLOCK, numbers[q])
            return pa.RecordBatch.from_arrays(
                [pa.array(list(v), t) for v, t in zip(zip(*out), types)], names)

        held, n = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), _matrix(batch.column(1), dim),
                         batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()))
            n += batch.num_rows
            if n >= 8 * CHUNK:
                columns = [np.concatenate(c) for c in zip(*held)]
                held, n = [], 0
                yield flush(*columns)
        if n:
            yield flush(*(np.concatenate(c) for c in zip(*held)))
    return run


_CHUNK = ("is_query boolean, cell int, radius double, bound double, n int, ids binary, vectors binary, "
          "row_numbers binary")


def _solve(dim: int, k: int):
    """Candidates of the queries of a bundle of blocks among the chunks of a part."""
    def best_of(qids, q, chunks):
        row, ids, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        least = np.full(len(qids), -np.inf)
        for cand, x in chunks:
            s = q @ x.T
            r, at = np.nonzero(s >= least[:, None])
            other = qids[r] != cand[at]
            r, at = r[other], at[other]
            row, ids, score = (np.concatenate(p) for p in zip((row, ids, score), (r, cand[at], s[r, at])))
            order = np.lexsort((ids, -score, row))
            row, ids, score = row[order], ids[order], score[order]
            keep = np.arange(len(row)) - np.searchsorted(row, np.arange(len(qids)))[row] < k
            row, ids, score = row[keep], ids[keep], score[keep]
            count = np.bincount(row, minlength=len(qids))
            full = np.flatnonzero(count >= k)
            least[full] = score[np.cumsum(count)[full] - 1]
        return row, ids, score

    def run(blocks: pa.Table, sent: pa.Table) -> pa.Table:
        chunks = [(np.frombuffer(i, np.int64), np.frombuffer(v).reshape(-1, dim))
                  for i, v in zip(sent["ids"].to_pylist(), sent["vectors"].to_pylist())]
        out = [[], [], [], []]
        for qids, q, numbers in zip(*(blocks[c].to_pylist() for c in ("query_ids", "queries", "row_numbers"))):
            qids, numbers = np.frombuffer(qids, np.int64), np.frombuffer(numbers, np.int64)
            row, ids, score = best_of(qids, np.frombuffer(q).reshape(-1, dim), chunks)
            for column, values in zip(out, (numbers[row], qids[row], ids, score.astype(np.int64))):
                column.append(values)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table(columns, names=["row_number", "query_id", "vec_id", "score"])
    return run


def top_k(spark: SparkSession, table: DataFrame, is_query: Column, k: int, key: str = "vec_id",
          vector: str = "embedding", component=lambda x: x, stats: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best vectors of every query.

    ``is_query`` is a condition on the column ``id``; ``component`` maps a component
    column (double) before scoring.  ``stats`` is given the number of pivots, of chunks, of
    (group, chunk) pairs and of those that were sent.
    """
    folder = f"{checkpoint_dir(spark).rstrip('/')}/knn-{uuid.uuid4().hex}"
    valid = valid_vectors(table, key, vector, component)
    dim, total = valid.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    out_schema = "query_id long, rank int, vec_id long, score long"
    if not dim:
        none = valid.filter(F.lit(False)).select(F.col("id").alias("query_id"))
        if dim is None:
            return none.select("query_id", F.lit(1).alias("rank"), F.col("query_id").alias("vec_id"),
                               F.col("query_id").alias("score"))
        dim = 1
    pivots = _bounded(valid, n_pivots(total), total, dim, 1)[1]
    if not len(pivots):                                   # no id below the hash bound
        pivots = np.zeros((1, dim))
    witness_ids, witnesses = _bounded(valid, WITNESSES, total, dim, 2)
    shared = spark.sparkContext.broadcast((pivots, witness_ids, witnesses))
    # the row numbers are fixed by writing the chunks
    (valid.select("id", "v", is_query.alias("q"), F.monotonically_increasing_id().alias("row_number"))
     .mapInArrow(_chunks(shared, dim, k), _CHUNK)
     .write.parquet(f"{folder}/chunks"))
    chunks = spark.read.parquet(f"{folder}/chunks")

    blocks = chunks.filter("is_query").select(
        "cell", "n", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"), "radius", "bound",
        "row_numbers", F.concat_ws("-", "cell", F.sha2("row_numbers", 256)).alias("block"))
    # at most MOST_PIVOTS rows: the summary of every query group
    groups = {r["cell"]: r for r in blocks.groupBy("cell").agg(
        F.max("radius").alias("radius"), F.min("bound").alias("bound"), F.sum("n").alias("n")).collect()}
    norm = np.sqrt((pivots * pivots).sum(1))
    dots = pivots @ pivots.T
    # per cell of data and group: the constant part and the factor of the chunk's radius
    limits = [(int(cell), int(g), float(dots[g, cell] + r["radius"] * norm[cell]), float(norm[g] + r["radius"]),
               float(r["bound"])) for g, r in groups.items() for cell in range(len(pivots))]
    if not limits:
        return spark.createDataFrame([], out_schema)
    pairs = spark.createDataFrame(limits, "cell int, g int, base double, slope double, least double")
    sent = (chunks.filter(~F.col("is_query")).select("cell", "radius", "ids", "vectors")
            .join(F.broadcast(pairs), "cell")          # MOST_PIVOTS ** 2 rows at most
            # a little slack covers rounding in the bound
            .filter(F.col("base") + F.col("slope") * F.col("radius")
                    + 1e-6 * (F.abs("base") + F.col("slope") * F.col("radius") + 1) >= F.col("least"))
            .select("g", "ids", "vectors"))
    received = {r["g"]: r["count"] for r in sent.groupBy("g").count().collect()}
    if stats is not None:
        n_chunks = chunks.filter(~F.col("is_query")).count()
        stats |= {"pivots": len(pivots), "chunks": n_chunks, "pairs": n_chunks * len(groups),
                  "sent": sum(received.values())}
    sizes = spark.createDataFrame(
        [(int(g), -(-r["n"] // (BUNDLE * BLOCK)), -(-received.get(g, 0) // PART_CHUNKS)) for g, r in groups.items()],
        "g int, bundles int, parts int")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    held = (blocks.withColumnRenamed("cell", "g").join(F.broadcast(sizes.filter("parts > 0")), "g")
            .withColumn("bundle", deal("block", "bundles")).withColumn("part", upto("parts"))
            .select("g", "bundle", "part", "query_ids", "queries", "row_numbers"))
    dealt = (sent.join(F.broadcast(sizes), "g").withColumn("part", deal("ids", "parts"))
             .withColumn("bundle", upto("bundles")).select("g", "bundle", "part", "ids", "vectors"))
    key = ["g", "bundle", "part"]
    found = held.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(
        _solve(dim, k), "row_number long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row_number").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
