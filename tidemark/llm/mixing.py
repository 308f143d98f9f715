"""Mixing sources to target weights by Pfair scheduling.

Each source is a stream of blocks of `block_chars` characters. With integer weights of sum W, block j of a source of
weight w is released in slot floor(j W / w) and due before slot ceil((j + 1) W / w); the earliest deadline goes first.
So after any number of slots each source has had its share but for less than one block. The schedule repeats every
W slots, so that only one period has to be worked out, and each document finds its slot by itself. When a source has
run out, a new phase begins with the weights of the others; no document is dropped or repeated.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import scratch_name

BLOCK_CHARS = 1 << 16
RESOLUTION = 1_024
MAX_SOURCES = 2_048
MAX_TABLE = 1 << 22  # rows of all phases' periods
BUCKET_ROWS = 1_024


def period(weights: dict[str, int]) -> dict[str, list[tuple[int, int, int]]]:
    """(slot, release, deadline) of each block of a source within one period of the weights' sum."""
    total = sum(weights.values())
    coming = sorted(
        ((j * total // weight, -(-(j + 1) * total // weight), source, j) for source, weight in weights.items() for j in range(weight)),
        reverse=True,
    )
    slots: dict[str, list] = {source: [None] * weight for source, weight in weights.items()}
    ready: list[tuple[int, str, int, int]] = []
    for slot in range(total):
        while coming and coming[-1][0] <= slot:
            release, deadline, source, j = coming.pop()
            heapq.heappush(ready, (deadline, source, j, release))
        deadline, source, j, release = heapq.heappop(ready)
        slots[source][j] = (slot, release, deadline)
    return slots


def phases(blocks: dict[str, int], weights: dict[str, int]) -> list[dict]:
    """Phases of the schedule, each with its first slot, the blocks that each source begins and ends with, and its period."""
    left, begun, start, out = dict(blocks), dict.fromkeys(blocks, 0), 0, []
    rows = 0
    while any(left.values()):
        own = {source: weights[source] for source in blocks if left[source]}
        total = sum(own.values())
        rows += total
        if rows > MAX_TABLE:
            raise ValueError(f"the periods of all phases have more than {MAX_TABLE} rows: lower the resolution")
        table = period(own)
        last = min((n - 1) // own[s] * total + table[s][(n - 1) % own[s]][0] for s, n in left.items() if n)
        whole, rest = divmod(last + 1, total)
        taken = {s: whole * own[s] + sum(slot < rest for slot, _, _ in table[s]) for s in own}
        out.append(
            {
                "start": start,
                "length": total,
                "sources": {s: (begun[s], begun[s] + taken[s], own[s], table[s]) for s in own},
            }
        )
        for source, number in taken.items():
            left[source] -= number
            begun[source] += number
        start += last + 1
    return out


def share_weights(shares: dict[str, float], resolution: int = RESOLUTION) -> dict[str, int]:
    """Integer weights next to the shares, each one at least."""
    total = sum(shares.values())
    return {source: max(1, round(resolution * share / total)) if total else 1 for source, share in shares.items()}


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> dict[str | None, int]:
    """Characters of each source; refuses more than `MAX_SOURCES` of them."""
    sizes = docs.groupBy(F.col(source).cast("string").alias("s")).agg(F.sum(F.coalesce(F.length(text), F.lit(0))).alias("n"))
    rows = sizes.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return {row["s"]: row["n"] for row in rows}


def schedule(
    docs: DataFrame,
    weights: dict[str | None, int],
    source: str = "source",
    text: str = "text",
    doc_id: str = "doc_id",
    block_chars: int = BLOCK_CHARS,
    seed: int = 0,
) -> DataFrame:
    """All rows and columns, with mix_slot, mix_offset, mix_block, mix_release, mix_deadline and mix_phase.

    `weights` has a positive whole number for each source, None for documents without one; a source without a
    weight is refused. Documents of a source follow each other in the order of a hash of doc_id and seed, then of
    doc_id and text; rows that are equal in these are interchangeable. `mix_offset` counts the characters of the
    source before a document, `mix_block` the blocks: a document belongs to the block it begins in. A null text
    has no characters. Slots of blocks in which no document begins stay empty. The mixture is the order by
    (mix_slot, mix_offset); `mixed` writes it into the order of rows. An empty table gives an empty one. Columns of
    these names that exist already keep theirs, and the new ones get an underscore.
    """
    sizes = source_sizes(docs, source, text)
    names = {None: "null"} | {name: f"={name}" for name in sizes if name is not None}
    missing = [name for name in sizes if weights.get(name, 0) < 1]
    if missing:
        raise ValueError(f"no positive weight for sources {missing[:5]}")
    blocks = {names[name]: max(1, -(-size // block_chars)) for name, size in sizes.items()}
    plan = phases(blocks, {names[name]: weights[name] for name in sizes})

    spark = docs.sparkSession
    rows = docs.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    key, bucket, hashed, chars, tie = (scratch_name(docs, f"_mix_{name}") for name in ("key", "bucket", "hash", "chars", "tie"))
    order = F.xxhash64(F.col(doc_id), F.lit(seed))
    marked = docs.withColumns(
        {
            key: _key(F.col(source)),
            hashed: order,
            bucket: F.pmod(order, F.lit(buckets)),
            chars: F.coalesce(F.length(text), F.lit(0)).cast("bigint"),
            tie: F.xxhash64(text),
        }
    )
    held = marked.groupBy(key, bucket).agg(F.sum(chars).alias("n"))
    before = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = held.select(key, bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_mix_base"))
    inside = Window.partitionBy(key, bucket).orderBy(hashed, doc_id, tie).rowsBetween(Window.unboundedPreceding, -1)
    placed = marked.withColumn("_mix_inside", F.coalesce(F.sum(chars).over(inside), F.lit(0))).join(base, [key, bucket])
    total = spark.createDataFrame([(k, n) for k, n in blocks.items()], "_mix_source string, _mix_blocks bigint")
    offset = F.col("_mix_base") + F.col("_mix_inside")
    placed = placed.withColumn("_mix_offset", offset).join(F.broadcast(total), F.col(key) == F.col("_mix_source"))
    block = F.least(F.floor(F.col("_mix_offset") / F.lit(block_chars)), F.col("_mix_blocks") - 1)
    spans = spark.createDataFrame(
        [
            (number, source, first, end, weight, phase["start"], phase["length"])
            for number, phase in enumerate(plan)
            for source, (first, end, weight, _) in phase["sources"].items()
        ],
        "_phase int, _span_source string, _first bigint, _end bigint, _weight bigint, _start bigint, _length bigint",
    )
    slots = spark.createDataFrame(
        [
            (number, source, j, slot, release, deadline)
            for number, phase in enumerate(plan)
            for source, (_, _, _, table) in phase["sources"].items()
            for j, (slot, release, deadline) in enumerate(table)
        ],
        "_slot_phase int, _slot_source string, _j bigint, _slot bigint, _release bigint, _deadline bigint",
    )
    # Spans and slots have at most MAX_TABLE rows of numbers, however many documents there are.
    found = (
        placed.withColumn("_mix_block", block)
        .join(
            F.broadcast(spans),
            (F.col(key) == F.col("_span_source")) & (F.col("_mix_block") >= F.col("_first")) & (F.col("_mix_block") < F.col("_end")),
        )
        .withColumn("_turn", F.floor((F.col("_mix_block") - F.col("_first")) / F.col("_weight")))
        .join(
            F.broadcast(slots),
            (F.col("_phase") == F.col("_slot_phase"))
            & (F.col(key) == F.col("_slot_source"))
            & (F.pmod(F.col("_mix_block") - F.col("_first"), F.col("_weight")) == F.col("_j")),
        )
    )
    turn = F.col("_start") + F.col("_turn") * F.col("_length")
    added = {
        "mix_slot": turn + F.col("_slot"),
        "mix_offset": F.col("_mix_offset"),
        "mix_block": F.col("_mix_block"),
        "mix_release": turn + F.col("_release"),
        "mix_deadline": turn + F.col("_deadline"),
        "mix_phase": F.col("_phase"),
    }
    return found.select(
        *[F.col(f"`{name}`") for name in docs.columns],
        *[value.alias(scratch_name(docs, name)) for name, value in added.items()],
    )


def mixed(scheduled: DataFrame, columns: list[str], doc_id: str = "doc_id") -> DataFrame:
    """The columns in the order of the mixture: written as files, they hold it one after the other."""
    order = ["mix_slot", "mix_offset", doc_id]
    return scheduled.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)


def smoothed_weights(docs: DataFrame, power: float = 0.5, resolution: int = RESOLUTION) -> dict[str | None, int]:
    """Weights in proportion to a power of the sources' characters: small sources get more than their part."""
    sizes = source_sizes(docs)
    return share_weights({name: max(1, size) ** power for name, size in sizes.items()}, resolution)
