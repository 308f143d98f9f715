"""Approximate nearest neighbours by collision counting over single projections.

Vectors are projected on `PROJECTIONS` random lines. Each block of candidates keeps one sorted array per line; a query
looks at a window of each array centred on its own projection and counts in how many windows a candidate falls.
Candidates that collide often enough are verified on the original vectors. If the nearest found are farther than the
radius the windows stand for, all windows are widened (virtual rehashing: the arrays stay as they are) and the counting
goes on, until the nearest are within the radius or the windows hold everything.

Largest inner products become least distances by one more coordinate that gives all vectors the same length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PROJECTIONS = 16
MISS = 0.03  # chance that a vector within the radius does not collide often enough
WIDTH = 0.75  # half a window, in radii
GROWTH = 1.2
BLOCK = 65_536
QUERY_BLOCK = 512
SEED = 20_240_229


def lines(size: int, count: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """Directions of the projections: the same for all blocks and runs."""
    return np.random.default_rng(seed).standard_normal((size, count))


def _bell(x: float) -> float:
    return math.erf(x / math.sqrt(2))


def collisions_needed(count: int = PROJECTIONS, width: float = WIDTH, miss: float = MISS) -> int:
    """Least number of windows that a vector at the radius falls into but for a chance of `miss`."""
    chance, below = _bell(width), 0.0
    for hits in range(count + 1):
        below += math.comb(count, hits) * chance**hits * (1 - chance) ** (count - hits)
        if below > miss:
            return hits
    return count


def search_block(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, k: int, longest: float) -> list[np.ndarray]:
    """For each query, places of its k nearest candidates of this block and of what may tie with the last; any of the k
    is missed with a chance of MISS.

    `own` has the place of the query itself among the candidates, or -1. `longest` is the length of the longest vector.
    """

    def lifted(rows: np.ndarray, extra: np.ndarray) -> np.ndarray:
        return np.concatenate([rows, extra[:, None]], axis=1)

    room = np.sqrt(np.maximum(longest**2 - (candidates**2).sum(axis=1), 0))
    away = lines(candidates.shape[1] + 1)
    placed = lifted(candidates, room) @ away
    # A query has no extra coordinate, and its length does not matter: it is scaled to the longest.
    norms = np.sqrt((queries**2).sum(axis=1))
    scaled = queries * (longest / norms)[:, None]
    asked = lifted(scaled, np.zeros(len(queries))) @ away
    order = np.argsort(placed, axis=0, kind="stable")
    ranked = np.take_along_axis(placed, order, axis=0)
    need = collisions_needed()
    number, count = placed.shape
    order, ranked = np.ascontiguousarray(order.T), np.ascontiguousarray(ranked.T)
    low = np.zeros((len(queries), count), dtype=np.int64)
    high = np.zeros((len(queries), count), dtype=np.int64)
    counts = np.zeros((len(queries), number), dtype=np.uint8)
    verified = np.zeros((len(queries), number), dtype=bool)
    verified[np.flatnonzero(own >= 0), own[own >= 0]] = True
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in queries]
    left, radius, first = np.arange(len(queries)), 0.5 * longest, True
    slack = 1e-9 * longest**2  # products of one run may differ in the last digits from those of another

    def verify(query: int, new: np.ndarray, products: np.ndarray | None) -> None:
        near = candidates[new] @ scaled[query] if products is None else products[new]
        places, found = np.concatenate([best[query][0], new]), np.concatenate([best[query][1], near])
        if len(found) > k:
            keep = found >= np.partition(found, -k)[-k] - slack  # with all that may tie with the last
            places, found = places[keep], found[keep]
        best[query] = places, found
        verified[query, new] = True

    while len(left):
        half = WIDTH * radius
        a = np.stack([np.searchsorted(ranked[line], asked[left, line] - half, "left") for line in range(count)], axis=1)
        b = np.stack([np.searchsorted(ranked[line], asked[left, line] + half, "right") for line in range(count)], axis=1)
        going = []
        for begin in range(0, len(left), 32):
            part = left[begin : begin + 32]
            fresh = []
            for place, query in enumerate(part, begin):
                hits = counts[query]
                for line in range(count):  # only what the window has grown by; a place is in a line once
                    if first:
                        hits[order[line, a[place, line] : b[place, line]]] += 1
                    else:
                        hits[order[line, a[place, line] : low[query, line]]] += 1
                        hits[order[line, high[query, line] : b[place, line]]] += 1
                whole = (a[place] == 0).all() and (b[place] == number).all()
                fresh.append(np.flatnonzero(((hits >= need) | whole) & ~verified[query]))
            # Where much of the block is to be verified, one product takes less time than picking the rows.
            dense = sum(map(len, fresh)) * 8 > len(part) * number
            products = candidates @ scaled[part].T if dense else None
            for place, (query, new) in enumerate(zip(part, fresh)):
                if len(new):
                    verify(query, new, products[:, place] if dense else None)
                found = best[query][1]
                far = math.sqrt(max(0.0, 2 * longest**2 - 2 * np.partition(found, -k)[-k])) if len(found) >= k else math.inf
                if far > radius and not verified[query].all():
                    going.append(begin + place)
        low[left], high[left] = a, b
        left, radius, first = left[going], radius * GROWTH, False
    return [places for places, _ in best]


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, with finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
    block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of largest inner product with each query, nearest first.

    Queries are the rows that `is_query` holds for; candidates are all rows but the query's own vec_id. Scores are in
    double precision on the original vectors, ties go to the smaller vec_id. Vectors that are null, empty, zero, or hold
    a null or non-finite component take no part, nor do rows without vec_id, nor vectors of another length than
    the query's. Of rows that share a vec_id the smallest vector stands. With fewer than k candidates all are
    returned. Other columns are left out; an empty table gives an empty one.

    Queries and candidates are cut into blocks by a hash of the id, and each pair of blocks is one task's work: tasks
    are of bounded size, and their number grows with queries times candidates.
    """
    rows = (
        vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), is_query.alias("q"))
        .where(F.col("vec_id").isNotNull() & usable(F.col("v")))
        .groupBy("vec_id")
        .agg(F.min(F.struct("v", "q")).alias("one"))
        .select("vec_id", "one.v", "one.q", F.size("one.v").alias("size"))
    )
    spark = vectors.sparkSession
    sizes = rows.groupBy("size").agg(
        F.count("*").alias("n"),
        F.count_if("q").alias("asked"),
        F.max(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)).alias("longest"),
    )
    # The number of blocks of vectors of a length, and the longest of them: a row for each length, hardly ever two.
    plan = sizes.select(
        "size",
        F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.col("asked") / F.lit(query_block)), F.lit(1)).cast("int").alias("query_blocks"),
        F.sqrt("longest").alias("longest"),
    )
    placed = rows.join(plan, "size")
    spread = F.xxhash64("vec_id")
    candidates = placed.withColumn("block", F.pmod(spread, F.col("blocks"))).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))
    )
    asked = placed.where("q").withColumn("query_block", F.pmod(spread, F.col("query_blocks"))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    columns = ["size", F.col("block").cast("int").alias("block"), F.col("query_block").cast("int").alias("query_block"), "vec_id", "v", "longest"]
    both = candidates.select(*columns, F.lit(False).alias("asks")).union(asked.select(*columns, F.lit(True).alias("asks")))

    def searched(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        ids = table.column("vec_id").to_numpy()
        size = table.column("size")[0].as_py()
        values = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), size)
        order = np.argsort(ids[~asks], kind="stable")
        names, points = ids[~asks][order], values[~asks][order]
        askers, queries = ids[asks], values[asks]
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(askers) and len(names):
            at = np.minimum(np.searchsorted(names, askers), len(names) - 1)
            own = np.where(names[at] == askers, at, -1)
            found = search_block(queries, points, own, k, table.column("longest")[0].as_py())
            for asker, query, places in zip(askers, queries, found):
                scores = (points[places] * query).sum(axis=1)
                best = np.lexsort((names[places], -scores))[:k]
                out["query_id"].append(np.full(len(best), asker))
                out["vec_id"].append(names[places][best])
                out["score"].append(scores[best])
        return pa.table(
            {name: pa.array(np.concatenate(parts) if parts else [], pa.float64() if name == "score" else pa.int64()) for name, parts in out.items()}
        )

    # So many partitions as the session has for shuffles: the rows are few for the work on them.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(parts, "size", "block", "query_block")
    found = both.groupBy("size", "block", "query_block").applyInArrow(searched, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
