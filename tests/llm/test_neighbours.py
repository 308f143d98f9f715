import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neighbours


def frame(spark, ids, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in zip(ids, vectors)], "vec_id bigint, embedding array<float>, rank string")


def brute(ids, vectors, queries, k):
    vectors = np.asarray(vectors, dtype=np.float32).astype(np.float64)
    out = {}
    for q in queries:
        scores = vectors @ vectors[ids.index(q)]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [ids[i] for i in order]
    return out


@pytest.mark.parametrize("scale", [0.0, 1.0])
def test_recall_against_all_pairs(spark, scale):
    draw = np.random.default_rng(7)
    centres = draw.standard_normal((30, 24))
    vectors = centres[draw.integers(0, 30, 1200)] + 0.4 * draw.standard_normal((1200, 24))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors *= np.exp(scale * draw.standard_normal(1200))[:, None]  # lengths matter to inner products
    ids = list(range(1200))
    got = neighbours.nearest(frame(spark, ids, vectors), F.col("vec_id") % 20 == 0, 20, block=300, query_block=25).collect()
    want = brute(ids, vectors, range(0, 1200, 20), 20)
    found = {}
    for row in got:
        found.setdefault(row["query_id"], {})[row["rank"]] = (row["vec_id"], row["score"])
    assert set(found) == set(want)
    hits = sum(len(set(want[q]) & {v for v, _ in found[q].values()}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    exact = np.asarray(vectors, dtype=np.float32).astype(np.float64)
    for q, ranks in found.items():
        assert sorted(ranks) == list(range(1, 21))
        scores = [ranks[r][1] for r in sorted(ranks)]
        assert scores == sorted(scores, reverse=True)
        assert all(abs(score - exact[v] @ exact[q]) < 1e-12 for v, score in ranks.values())


def test_odd_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, None, 20, 40, 40]
    vectors = [[1, 0], [1, 0], [1, 0], None, [], [0, 0], [nan, 1], [inf, 1], [None, 1], [1, 1], [0, 1], [1, 0, 0], [1, 0, 0]]
    got = neighbours.nearest(frame(spark, ids, vectors), F.col("vec_id") % 20 == 0, 20).collect()
    rows = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)
    assert rows == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]


def test_no_rows(spark):
    assert neighbours.nearest(frame(spark, [], []), F.col("vec_id") % 20 == 0).count() == 0


def test_collisions_needed_is_safe():
    need = neighbours.collisions_needed()
    chance = neighbours._bell(neighbours.WIDTH)
    hits = np.random.default_rng(1).binomial(neighbours.PROJECTIONS, chance, 100_000)
    assert (hits < need).mean() <= neighbours.MISS + 0.003
