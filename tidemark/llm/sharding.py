"""Shards of nearly equal bytes by sampled splitters, with built-in functions only.

Rows are ordered by a hash of their text and a row number. A sample of keys, drawn with a chance in proportion to size,
gives quantile boundaries; the ranges between them are measured exactly, and overfull ones are subdivided by a further
sample of their own. The ranges, a few thousand whatever the data, are dealt to the shards, largest first to the emptiest.

Equal texts are neighbours and stay in one range, and so in one shard, unless they are so many that the shards could not
be nearly equal otherwise; only then is their range cut between rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch_name, written

SHARDS = 8
RANGES = 64  # ranges aimed at for each shard
DRAWS = 32  # sampled keys aimed at for each range
TOLERANCE = 0.005  # groups of equal texts are cut where the fullest shard would be fuller than the mean by more
ROUNDS = 12
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

Bound = tuple[int, int]  # first key and row of a range


@dataclass(frozen=True)
class Plan:
    """Where ranges begin, and the shard of each; the first range begins before all."""

    bounds: Sequence[Bound]
    shards: Sequence[int]


def _range_number(bounds: Sequence[Bound]) -> Column:
    """Number of the range of (key, row), by halving steps over the sorted bounds."""
    if not bounds:
        return F.lit(0)
    key, row, count = F.col("key"), F.col("row"), len(bounds)
    keys = F.array(*[F.lit(bound[0]).cast("bigint") for bound in bounds])
    rows = F.array(*[F.lit(bound[1]).cast("bigint") for bound in bounds])
    steps = [1 << place for place in range(count.bit_length() - 1, -1, -1)]

    def go(at: Column, step: Column) -> Column:
        place = at + step - 1
        begun = (F.get(keys, place) < key) | ((F.get(keys, place) == key) & (F.get(rows, place) <= row))
        return F.when((at + step <= count) & begun, at + step).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), go)


def _sample(rows: DataFrame, step: float, seed: int) -> list[tuple[int, int, float]]:
    """Keys drawn in proportion to size, about DRAWS for every `step` bytes, each with the bytes it stands for."""
    rate = DRAWS / step
    draw = (F.xxhash64("row", "key", F.lit(seed)).bitwiseAND((1 << 52) - 1) + 0.5) / (1 << 52)
    drawn = rows.where(draw < F.col("size") * rate).select("key", "row", "size").collect()
    return sorted((one.key, one.row, max(float(one.size), 1 / rate)) for one in drawn)


def cuts(sample: list[tuple[int, int, float]], step: float, whole: float) -> set[Bound]:
    """Bounds about every `step` bytes of a sorted sample. Keys heavier than that get ranges of their own, which are
    cut between rows where a key is heavier than `whole`."""
    bounds: set[Bound] = set()
    held = 0.0
    for key, group in groupby(sample, lambda one: one[0]):
        rows = [(row, weight) for _, row, weight in group]
        weight = sum(weight for _, weight in rows)
        if weight > step or held + weight > step:
            bounds.add((key, _LEAST))
            held = 0.0
        if weight <= step:
            held += weight
            continue
        if key < _MOST:
            bounds.add((key + 1, _LEAST))
        if weight > whole:
            inside = 0.0
            for row, part in rows:
                if inside + part > step and inside:
                    bounds.add((key, row))
                    inside = 0.0
                inside += part
    return bounds


def deal(sizes: Sequence[int], shards: int) -> tuple[list[int], list[int]]:
    """Shard of each range, and bytes of each shard: largest range first, always to the emptiest shard."""
    heap = [(0, shard) for shard in range(shards)]
    chosen = [0] * len(sizes)
    for place in sorted(range(len(sizes)), key=lambda place: (-sizes[place], place)):
        held, shard = heapq.heappop(heap)
        chosen[place] = shard
        heapq.heappush(heap, (held + sizes[place], shard))
    return chosen, [held for held, _ in sorted(heap, key=lambda one: one[1])]


def _measured(rows: DataFrame, bounds: Sequence[Bound]) -> dict[int, Row]:
    found = rows.groupBy(_range_number(bounds).alias("range")).agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    return {one.range: one for one in found.collect()}


def plan(rows: DataFrame, shards: int = SHARDS) -> Plan:
    """Ranges of rows (key, row, size) and their shards. Only samples and one line a range come to the driver."""
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return Plan([], [0])
    step = total / (shards * RANGES)
    whole = total / shards / 4
    bounds = sorted(cuts(_sample(rows, step, 0), step, whole))
    ranges = _measured(rows, bounds)
    for seed in range(1, ROUNDS):

        def overfull(one: Row) -> bool:
            alone = one.low == one.high
            return one.rows > 1 and one.bytes > (max(whole, 2 * step) if alone else 2 * step)

        over = [number for number, one in ranges.items() if overfull(one)]
        if over:
            # A range is subdivided by a sample of its own rows.
            inside = rows.where(_range_number(bounds).isin(over))
            new: set[Bound] = set()
            begins = [(_LEAST, _LEAST), *bounds]
            sample = _sample(inside, step, seed)
            for number in over:
                end = begins[number + 1] if number + 1 < len(begins) else (_MOST, _MOST)
                part = [one for one in sample if begins[number] <= one[:2] < end]
                new |= cuts(part, step, whole)
            if not new - set(bounds):
                break
            bounds = sorted({*bounds, *new})
            ranges = _measured(rows, bounds)
            continue
        _, held = deal([one.bytes for one in ranges.values()], shards)
        alone = [one for one in ranges.values() if one.low == one.high and one.rows > 1 and one.bytes > 2 * step]
        if max(held) <= (1 + TOLERANCE) * total / shards or not alone:
            break
        whole = max(one.bytes for one in alone) / 2
    sizes = [ranges[number].bytes if number in ranges else 0 for number in range(len(bounds) + 1)]
    return Plan(bounds, deal(sizes, shards)[0])


def assign(docs: DataFrame, shards: int = SHARDS, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep` of all documents and size, text_crc32, law, shard, slot, grown_shard.

    `size` is the UTF-8 bytes of the text and one more; a null text counts as the empty one. Shards hold nearly equal
    sizes (law `bytes`), as far as single rows allow; `slot` numbers the rows of a shard from 0 without gaps, in the order
    of ranges; `grown_shard` belongs to another law and is null. Equal texts share a shard unless cutting their group is
    needed for the law. Rows are taken one by one: repeated rows, repeated and null ids each get a place. An empty table
    gives none. Where a new name is taken by a kept column, `_` is added to it.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in keep]).alias("kept"),
        (F.octet_length(whole).cast("bigint") + 1).alias("size"),
        F.crc32(whole.cast("binary")).alias("crc"),
        F.xxhash64(whole).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Row numbers must not change between passes; the text is read once.
    narrow = written(narrow, "shard-keys")
    made = plan(narrow.select("key", "row", "size"), shards)
    numbers = F.array(*map(F.lit, made.shards))
    placed = narrow.withColumn("shard", F.get(numbers, _range_number(made.bounds)))
    ordered = placed.repartitionByRange("shard", "key", "row").sortWithinPartitions("shard", "key", "row")
    counted = ordered.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    counted = written(counted.drop("key", "row"), "shard-rows")
    # One line for each shard in each partition; rows of a shard lie side by side in a partition.
    edges = counted.groupBy("shard", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select("shard", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    kept = docs.select(*[F.col(f"`{name}`") for name in keep])
    names = {name: scratch_name(kept, name) for name in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")}
    return counted.join(edges, ["shard", "part"]).select(
        "kept.*",
        F.col("size").alias(names["size"]),
        F.col("crc").alias(names["text_crc32"]),
        F.lit("bytes").alias(names["law"]),
        F.col("shard").alias(names["shard"]),
        (F.col("before") + F.col("at") - F.col("first")).alias(names["slot"]),
        F.lit(None).cast("int").alias(names["grown_shard"]),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text: str = "text") -> None:
    """Write all columns of the documents as Parquet below `path`, one folder `shard=N` for each shard that has rows."""
    placed = assign(docs, shards, docs.columns, text)
    shard = placed.columns[len(docs.columns) + 3]
    # Files by shard and stretch of slots, so that a shard of any size is written by many tasks.
    placed.write.partitionBy(shard).parquet(path)
