import numpy as np
import pytest

from tidemark.llm import ngram_join
from tidemark.llm.graph import components


def brute(rows, width, percent):
    """(doc_id, n, component) row by row."""
    space = " \t\n\x0b\x0c\r"
    sets = []
    for _, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in space:
            lowered = lowered.replace(c, " ")
        words = [w for w in lowered.split(" ") if w]
        k = min(width, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("width", "percent", "seed"), [(4, 85, 1), (5, 80, 2), (3, 60, 3)])
def test_components_as_by_comparing_all_pairs(spark, family, width, percent, seed):
    rows = list(enumerate(family(150, seed)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = ngram_join.join_components(docs, width, percent)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, width, percent)


@pytest.mark.parametrize("run", [3, 4096])
def test_tree_finds_what_meetings_leave(spark, family, monkeypatch, run):
    """Without pairs to begin with, all links have to come from the tree, block against block."""
    rows = list(enumerate(family(60, 9, words=20, vocabulary=60)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole, begun = ngram_join.written, []

    def without_seeds(df, label):
        if label == "pairs" and not begun:
            begun.append(label)
            df = df.limit(0)
        return whole(df, label)

    monkeypatch.setattr(ngram_join, "written", without_seeds)
    members, roots = ngram_join.similar_classes(docs, 2, 60, run=run)
    least = {r["node"]: r["root"] for r in roots.collect()}
    groups = {}
    for row in members.collect():
        groups.setdefault(least.get(row["set"], row["set"]), []).append(row["doc_id"])
    got = sorted((d, min(ids)) for ids in groups.values() for d in ids)
    assert got == sorted((d, c) for d, _, c in brute(rows, 2, 60))


def test_tree_join_loses_no_pair():
    draw = np.random.default_rng(4)
    points = draw.integers(0, 4, (300, ngram_join.AXES)).astype(np.uint16)
    points[150:] = points[:150]
    points[150:, 0] += draw.integers(0, 3, 150).astype(np.uint16)
    sizes, roots = points.sum(axis=1).astype(np.int64), draw.integers(0, 250, 300)
    i, j = ngram_join.tree_join(points, sizes, roots, 80)
    got = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    minima = np.minimum(points[:, None], points[None]).sum(axis=2)
    need = -(-80 * (sizes[:, None] + sizes[None]) // 180)
    a, b = np.nonzero((minima >= need) & (roots[:, None] != roots[None]) & (100 * np.minimum.outer(sizes, sizes) >= 80 * np.maximum.outer(sizes, sizes)))
    assert {(x, y) for x, y in zip(a.tolist(), b.tolist()) if x < y} <= got
    assert len(i) == len(got)


def test_odd_documents(spark, odd, empty):
    got = ngram_join.join_components(odd, 4, 85)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute([(r["doc_id"], r["text"]) for r in odd.collect()], 4, 85)
    assert ngram_join.join_components(empty).count() == 0


def test_one_of_each_group_stays(spark, odd):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    # 7 has two equal rows; 8 has an added line and is still alike; the row without id goes with them.
    assert sorted((r["doc_id"] for r in kept.collect())) == [1, 2, 3, 4, 5, 6, 7, 9, 10, 12]


def test_a_run_over_several_batches():
    rows = np.array([[3] + [5] * 7, [0] * 8, [9, 1, 2, 3, 4, 5, 6, 7]], dtype=np.int64)
    arrow = ngram_join.pa
    batches = [arrow.RecordBatch.from_arrays([arrow.array(x[i : i + 2]) for x in rows], names=["token", "order", "set"]) for i in range(0, 8, 2)]
    pairs = {(a, b) for batch in ngram_join._seeds(iter(batches)) for a, b in zip(*batch.to_pydict().values())}
    assert pairs == {(1, i) for i in range(2, 8)} | {(i, i + 1) for i in range(1, 7)}


def test_long_chains_are_connected(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
