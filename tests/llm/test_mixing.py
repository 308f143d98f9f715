import random
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import mixing


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefg"), st.integers(1, 40), min_size=1))
def test_deviation_is_less_than_one_block(weights):
    total = sum(weights.values())
    table = mixing.period(weights)
    slots = {slot: (source, release, deadline) for source, rows in table.items() for slot, release, deadline in rows}
    assert sorted(slots) == list(range(total))
    held = Counter()
    for slot in range(total):
        source, release, deadline = slots[slot]
        assert release <= slot < deadline
        held[source] += 1
        for name, weight in weights.items():
            assert abs(held[name] - Fraction((slot + 1) * weight, total)) < 1


def brute(blocks, weights):
    """Slot by slot: earliest deadline first of the released blocks, starting anew when a source runs out."""
    left, begun, out, start = dict(blocks), Counter(), {}, 0
    while any(left.values()):
        own = {s: weights[s] for s in sorted(blocks) if left[s]}
        total, taken, slot = sum(own.values()), Counter(), 0
        while all(left[s] for s in own):
            ready = [(-(-(taken[s] + 1) * total // w), s) for s, w in own.items() if taken[s] * total // w <= slot]
            _, source = min(ready)
            out[source, begun[source] + taken[source]] = start + slot
            taken[source] += 1
            left[source] -= 1
            slot += 1
        begun.update(taken)
        start += slot
    return out


def documents(spark, seed=2):
    draw = random.Random(seed)
    rows = [(i, draw.choice(["a", "a", "a", "b", "c", None, ""]), "x" * draw.choice([0, 3, 10, 40, 250])) for i in range(300)]
    return spark.createDataFrame([(i, s, None if i % 50 == 0 else t) for i, s, t in rows], "doc_id bigint, source string, text string")


def test_every_document_once_in_the_slot_of_its_block(spark):
    docs = documents(spark)
    weights = {"a": 3, "b": 2, "c": 1, None: 1, "": 2}
    rows = mixing.schedule(docs, weights, block_chars=100).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(300))
    names = {s: "null" if s is None else f"={s}" for s in weights}
    sizes = mixing.source_sizes(docs)
    blocks = {names[s]: max(1, -(-n // 100)) for s, n in sizes.items()}
    slots = brute(blocks, {names[s]: w for s, w in weights.items()})
    for row in rows:
        assert row["mix_slot"] == slots[names[row["source"]], row["mix_block"]]
        assert row["mix_release"] <= row["mix_slot"] < row["mix_deadline"]
        assert row["mix_block"] == min(row["mix_offset"] // 100, blocks[names[row["source"]]] - 1)
    for source in weights:
        own = sorted((r["mix_offset"] + len(r["text"] or ""), r["mix_offset"]) for r in rows if r["source"] == source)
        assert sum(end - begin for end, begin in own) == sizes[source]


def test_mixed_files_hold_the_order(spark, tmp_path):
    scheduled = mixing.schedule(documents(spark), {"a": 3, "b": 2, "c": 1, None: 1, "": 2}, block_chars=100)
    mixing.mixed(scheduled, ["mix_slot", "doc_id"]).coalesce(1).write.parquet(str(tmp_path / "mixed"))
    slots = [r["mix_slot"] for r in spark.read.parquet(str(tmp_path / "mixed")).collect()]
    assert slots == sorted(slots)


def test_odd_documents(spark, odd, empty):
    docs = odd.withColumn("source", odd["IDS"])
    got = mixing.schedule(docs, {"x": 5}, block_chars=1000)
    assert got.columns[: len(docs.columns)] == docs.columns and got.columns[len(docs.columns)] == "mix_slot_"
    assert sorted(map(repr, (r["doc_id"] for r in got.collect()))) == sorted(map(repr, (r["doc_id"] for r in odd.collect())))
    assert mixing.schedule(empty, {}).count() == 0


def test_bad_weights(spark):
    with pytest.raises(ValueError, match="no positive weight"):
        mixing.schedule(documents(spark), {"a": 1})
    assert mixing.share_weights({"a": 1.0, "b": 3.0, "c": 1e-9}, 100) == {"a": 25, "b": 75, "c": 1}
