"""Sharding against its promises: every row once, nearly equal bytes, gapless slots, groups kept together."""

import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import queries, sharding


def check(rows, docs, shards=8):
    """Columns against the documents, and slots without gaps; returns bytes by shard and shards by text."""
    wanted = sorted((doc_id, len((text or "").encode()) + 1, zlib.crc32((text or "").encode())) for doc_id, text in docs)
    assert sorted((row.doc_id, row.size, row.text_crc32) for row in rows) == wanted
    slots, held, groups = defaultdict(list), defaultdict(int), defaultdict(set)
    for row in rows:
        assert row.law == "bytes" and 0 <= row.shard < shards and row.grown_shard is None
        slots[row.shard].append(row.slot)
        held[row.shard] += row.size
        groups[row.text_crc32].add(row.shard)
    for numbers in slots.values():
        assert sorted(numbers) == list(range(len(numbers)))
    return held, groups


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query(spark, folder):
    path = f"/root/testdata/{folder}"
    docs = [(row.doc_id, row.text) for row in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    held, groups = check(queries.QUERIES["op12_sharding"](spark, path).collect(), docs)
    mean = sum(held.values()) / 8
    largest = max(len((text or "").encode()) + 1 for _, text in docs)
    assert max(held.values()) <= max(1.01 * mean, largest) and all(len(found) == 1 for found in groups.values())


def frame_of(spark, docs, parts=4):
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)


def test_a_group_of_a_third_is_cut_and_others_stay_whole(spark):
    draw = random.Random(3)
    docs = [(i, f"text {draw.random()} " + "x" * draw.randrange(200)) for i in range(6_000)]
    docs += [(i, "hot " * 25) for i in range(10_000, 13_000)]
    docs += [(20_000 + i, f"copy {i % 100} " + "y" * 60) for i in range(1_000)]
    rows = sharding.assign(frame_of(spark, docs)).collect()
    held, groups = check(rows, docs)
    mean = sum(held.values()) / 8
    assert max(held.values()) < 1.01 * mean and min(held.values()) > 0.99 * mean
    hot = zlib.crc32(("hot " * 25).encode())
    assert len(groups[hot]) > 2 and all(len(found) == 1 for crc, found in groups.items() if crc != hot)


def test_equal_rows_only(spark):
    docs = [(7, "same")] * 4_000
    held, groups = check(sharding.assign(frame_of(spark, docs)).collect(), docs)
    assert len(held) == 8 and max(held.values()) < 1.1 * min(held.values())


def test_groups_that_leave_no_even_deal_are_cut(spark):
    docs = [(i, f"group {i % 9} " + "z" * 50) for i in range(9_000)]
    held, _ = check(sharding.assign(frame_of(spark, docs)).collect(), docs)
    assert max(held.values()) < 1.02 * min(held.values())


def test_odd_documents(spark, odd):
    found = sharding.assign(odd, keep=["doc_id", "n_lines", "score"]).collect()
    assert len(found) == odd.count() and {row.size for row in found if row.doc_id in (1, 2)} == {1}
    clash = odd.withColumnRenamed("score", "Shard").withColumnRenamed("n_lines", "size")
    rows = sharding.assign(clash, keep=clash.columns).collect()
    assert {"shard_", "size_", "slot", "Shard", "size"} <= set(rows[0].asDict()) and len(rows) == odd.count()
    assert sorted(row.slot for row in rows if row.shard_ == 0) == list(range(sum(row.shard_ == 0 for row in rows)))


def test_empty_table_and_one_shard(spark, empty):
    assert sharding.assign(empty).collect() == []
    docs = [(i, str(i)) for i in range(50)]
    held, _ = check(sharding.assign(frame_of(spark, docs), shards=1).collect(), docs, 1)
    assert len(held) == 1


def test_write_shards(spark, tmp_path):
    docs = [(i, f"text {i}") for i in range(400)]
    sharding.write_shards(frame_of(spark, docs), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((row.doc_id, row.text) for row in back.collect()) == docs and back.select("shard").distinct().count() == 8


def test_no_python_on_the_path(spark):
    plan = queries.QUERIES["op12_sharding"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
