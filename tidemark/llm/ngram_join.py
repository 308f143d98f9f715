"""N-gram Jaccard join on count vectors.

A text is its set of distinct word shingles. Shingles are hashed into groups, and the counts of a set in the groups
are a point. What two sets have in common is at most the sum of the smaller of their counts, group by group.

1. Texts of equal sets are one class; only classes are compared.
2. Groups are ordered by how many shingles of the corpus they hold, the rarest first. Two sets that are similar
   enough must share one of the first (1 - t) n + 1 shingles in that order: without one the minima of the rest cannot
   add up. These shingles are the entries by which points come together, at any size of the corpus.
3. Of the classes that meet at an entry, each is compared with the one that shares most entries with others, and with
   the one before it in that order. Classes that this links are connected and need no further comparison.
4. What meets at an entry and is still not connected is indexed by an R-tree on its points; pairs of boxes whose
   summed coordinate minima are too small are cut off, and so are pairs of points.
5. Surviving pairs are verified on the whole sets.

An R-tree over all points at once cannot cut off anything in so many dimensions, as boxes of points that have nothing
in common still overlap; hence the entries as its upper level. No candidate is dropped other than by a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import Words, byte_texts, delete_path, fresh_path, mix, runs_of, scratch_name, shingle_hashes, written
from tidemark.llm.graph import components

GROUPS = 1 << 18  # of shingles, to find rare ones
PIECES = 16  # of the counts of groups, and of the filter
AXES = 256  # of a point
FAN = 16
RUN = 4_096
TREE_ROWS = 16_384  # of a tree, and the rest of a token that is met last
FILTER_BITS = 1 << 23


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    words = Words(texts)
    hashes = words.hashes()
    return [np.unique(shingle_hashes(hashes[begin:end], width)) for begin, end in zip(words.bounds[:-1], words.bounds[1:])]


def set_number(shingles: np.ndarray) -> int:
    """A 64-bit number for a set; a billion sets have one in forty chances that any two of them share a number."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), 17) - (1 << 63)


def _groups(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(GROUPS)).astype(np.int64)


def _point(shingles: np.ndarray) -> bytes:
    """Counts of a set in `AXES` groups, a byte each where that holds them, else four."""
    counts = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % AXES, minlength=AXES)
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes()


def _points(values: list[bytes]) -> np.ndarray:
    if all(len(value) == AXES for value in values):
        return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(values), AXES)
    parts = [np.frombuffer(value, dtype=np.uint8 if len(value) == AXES else np.uint32) for value in values]
    return np.stack([part.astype(np.uint32) for part in parts])


def needed(one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that two sets of these sizes must have in common."""
    return -(-percent * (one + other) // (100 + percent))


def _late_enough(sizes, places, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether an entry may be the first that a similar pair shares: behind it there must be enough left of both."""
    left = np.minimum(sizes[one] - places[one], sizes[other] - places[other])
    return left >= needed(sizes[one], sizes[other], percent)


def _sets_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), byte_texts(batch.column(1))
        for begin, end in runs_of([len(text) for text in texts]):
            yield from zip(ids[begin:end], shingle_sets(texts[begin:end], width))


def _members(width: int):
    """Rows (doc_id, n, set, point) of documents, and rows (piece, counts) with the counts of groups of a task.

    The point of a set comes with the first document of the task that has it.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, waiting, size, seen = np.zeros(GROUPS, dtype=np.uint32), [], [], 0, set()

        def batch(ids: list, sizes: list, sets: list, points: list, pieces: list, bytes_of: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(sets, pa.int64()),
                    pa.array(points, pa.binary()),
                    pa.array(pieces, pa.int32()),
                    pa.array(bytes_of, pa.binary()),
                ],
                names=["doc_id", "n", "set", "point", "piece", "counts"],
            )

        for doc_id, shingles in _sets_of(batches, width):
            waiting.append(_groups(shingles))
            size += len(shingles)
            if size > 1 << 20:
                counts += np.bincount(np.concatenate(waiting), minlength=GROUPS).astype(np.uint32)
                waiting, size = [], 0
            number = set_number(shingles)
            held.append((doc_id, len(shingles), number, None if number in seen or not len(shingles) else _point(shingles)))
            seen.add(number)
            if len(held) >= 50_000:
                yield batch(*map(list, zip(*held)), [None] * len(held), [None] * len(held))
                held = []
        if held:
            yield batch(*map(list, zip(*held)), [None] * len(held), [None] * len(held))
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=GROUPS).astype(np.uint32)
        none = [None] * PIECES
        yield batch(none, none, none, none, list(range(PIECES)), [part.tobytes() for part in np.split(counts, PIECES)])

    return rows


def _joined_pieces(rows: DataFrame, combine, kind, size: int) -> np.ndarray:
    """Pieces of arrays from all tasks combined: (piece, counts) rows to one array of `size` on the driver."""

    def merge(table: pa.Table) -> pa.Table:
        total = None
        for value in table.column("counts"):
            part = np.frombuffer(value.as_py(), dtype=kind)
            total = part.copy() if total is None else combine(total, part)
        return pa.table({"piece": table.column("piece")[:1].cast(pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    found = rows.groupBy("piece").applyInArrow(merge, "piece int, counts binary").orderBy("piece").collect()  # PIECES rows
    return np.concatenate([np.frombuffer(row["counts"], dtype=kind) for row in found] or [np.zeros(size, dtype=kind)])


def _entries(width: int, percent: int, shared):
    """Rows (token, set, n, place) of the first shingles of each set in the order of groups.

    A set is passed on once by a task, however many copies of it the task reads.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        tokens, owners, sizes = [], [], []

        def batch() -> pa.RecordBatch:
            lengths = [len(part) for part in tokens]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens), pa.int64()),
                    pa.array(np.repeat(np.array(owners, dtype=np.int64), lengths)),
                    pa.array(np.repeat(np.array(sizes, dtype=np.int32), lengths)),
                    pa.array(np.concatenate([np.arange(x, dtype=np.int32) for x in lengths])),
                ],
                names=["token", "set", "n", "place"],
            )

        for _, shingles in _sets_of(batches, width):
            n = len(shingles)
            number = set_number(shingles)
            if n == 0 or number in seen:
                continue
            seen.add(number)
            first = n - (percent * n + 99) // 100 + 1
            order = np.lexsort((shingles, counts[_groups(shingles)]))[:first]
            tokens.append(shingles[order].view(np.int64))
            owners.append(number)
            sizes.append(n)
            if len(tokens) >= 5_000:
                yield batch()
                tokens, owners, sizes = [], [], []
        if tokens:
            yield batch()

    return rows


def _by_token(judge, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What `judge` makes of rows in the order of their first column, the token; the rows of a token come together.

    Of a run of a million rows its first and last row stay to be met by those that follow.
    """
    held: np.ndarray | None = None
    for batch in batches:
        part = np.stack([column.to_numpy().astype(np.int64) for column in batch.columns])
        held = part if held is None else np.concatenate([held, part], axis=1)
        if held.shape[1] == 0:
            continue
        cut = int(np.searchsorted(held[0], held[0, -1]))  # tokens ascend within a partition
        if cut:
            yield judge(held[:, :cut])
            held = held[:, cut:]
        elif held.shape[1] >= 1 << 20:
            yield judge(held)
            held = held[:, [0, -1]]
    if held is not None and held.shape[1]:
        yield judge(held)


def _run_starts(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the first row of its run, and the length of the run."""
    starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    lengths = np.diff(np.append(starts, len(tokens)))
    return np.repeat(starts, lengths), np.repeat(lengths, lengths)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (token, set, n, place) of tokens that several sets have among their entries."""

    def judge(rows: np.ndarray) -> pa.RecordBatch:
        kept = rows[:, _run_starts(rows[0])[1] > 1]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()).cast(kind) for column, kind in zip(kept, kinds)], names=["token", "set", "n", "place"]
        )

    yield from _by_token(judge, batches)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (token, order, set) in that order: pairs of each set with the first of its token and the one before."""

    def judge(rows: np.ndarray) -> pa.RecordBatch:
        first, _ = _run_starts(rows[0])
        sets, place, pairs = rows[2], np.arange(rows.shape[1]), []
        for other in (first, np.maximum(place - 1, first)):
            keep = sets[other] != sets
            pairs.append(np.stack([np.minimum(sets[other], sets), np.maximum(sets[other], sets)])[:, keep])
        found = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    yield from _by_token(judge, batches)


def tree_join(
    points: np.ndarray, sizes: np.ndarray, roots: np.ndarray, percent: int, tokens: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points of one token and different roots whose summed coordinate minima allow the similarity, by an R-tree.

    Points are packed by token and size into boxes of `FAN`, boxes into boxes of `FAN`. Only the upper corner and the
    ranges of sizes and tokens of a box count for the bound.
    """
    tokens = np.zeros(len(points), dtype=np.int64) if tokens is None else tokens
    order = np.lexsort((*points.T[:4], sizes, tokens))
    points, sizes, roots, tokens = points[order], sizes[order], roots[order], tokens[order]
    levels = [(points, sizes, sizes, roots, roots, tokens, tokens)]
    while len(levels[-1][0]) > FAN:
        upper, small, large, low, high, first, last = levels[-1]
        starts = np.arange(0, len(upper), FAN)
        levels.append(
            (
                np.maximum.reduceat(upper, starts),
                np.minimum.reduceat(small, starts),
                np.maximum.reduceat(large, starts),
                np.minimum.reduceat(low, starts),
                np.maximum.reduceat(high, starts),
                np.minimum.reduceat(first, starts),
                np.maximum.reduceat(last, starts),
            )
        )
    top = len(levels[-1][0])
    left, right = np.triu_indices(top)
    for depth in range(len(levels) - 1, -1, -1):
        upper, small, large, low, high, first, last = levels[depth]
        keep = np.ones(len(left), dtype=bool)
        for begin in range(0, len(left), 1 << 14):
            i, j = left[begin : begin + (1 << 14)], right[begin : begin + (1 << 14)]
            may = (first[i] <= last[j]) & (first[j] <= last[i]) & (100 * large[i] >= percent * small[j]) & (100 * large[j] >= percent * small[i])
            may &= ~((low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j]))
            need = needed(small[i], small[j], percent)
            may[may] = np.minimum(upper[i[may]], upper[j[may]]).sum(axis=1, dtype=np.int64) >= need[may]
            keep[begin : begin + (1 << 14)] = may
        left, right = left[keep], right[keep]
        if depth == 0:
            break
        below = len(levels[depth - 1][0])
        step = np.arange(FAN)
        i = (left[:, None] * FAN + step)[:, :, None]
        j = (right[:, None] * FAN + step)[:, None, :]
        i, j = np.broadcast_arrays(i, j)
        inside = (i < below) & (j < below) & (i < j if depth == 1 else i <= j)
        left, right = i[inside], j[inside]
    if len(levels) == 1:
        keep = left < right
        left, right = left[keep], right[keep]
    return order[left], order[right]


def _tree_pairs(percent: int):
    """From rows (token, low, high, set, n, place, root, point, own) in the order of the first three: pairs that the
    tree leaves. One tree holds many tokens, each of which is whole in it."""

    def judge(table: pa.Table, tokens: np.ndarray) -> pa.RecordBatch:
        sets, sizes = table.column("set").to_numpy(), table.column("n").to_numpy().astype(np.int64)
        roots, own = table.column("root").to_numpy(), table.column("own").to_numpy()
        i, j = tree_join(_points(table.column("point").to_pylist()), sizes, roots, percent, tokens)
        late = _late_enough(sizes, table.column("place").to_numpy().astype(np.int64), i, j, percent)
        # Of two blocks, pairs within one are found where the block is paired with itself.
        one_block = table.column("low").to_numpy() == table.column("high").to_numpy()
        keep = late & (one_block[i] | (own[i] != own[j]))
        a, b = sets[i[keep]], sets[j[keep]]
        found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], names=["a", "b"])

    def runs(table: pa.Table) -> np.ndarray:
        names = [table.column(name).to_numpy() for name in ("token", "low", "high")]
        new = np.zeros(table.num_rows, dtype=np.int64)
        for values in names:
            new[1:] |= values[1:] != values[:-1]
        return np.cumsum(new)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(part.num_rows for part in held) < TREE_ROWS:
                continue
            table = pa.Table.from_batches(held)
            tokens = runs(table)
            cut = int(np.searchsorted(tokens, tokens[-1]))  # the last run may go on
            if cut:
                yield judge(table.slice(0, cut), tokens[:cut])
            held = table.slice(cut).to_batches()
        if sum(part.num_rows for part in held):
            table = pa.Table.from_batches(held)
            yield judge(table, runs(table))

    return pairs


def filter_bits(sets: DataFrame) -> np.ndarray:
    """Bits set at two places for each set number: `FILTER_BITS` of them, whatever the number of sets."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            for places in filter_places(batch.column(0).to_numpy()):
                bits[places] = True
        parts = [part.tobytes() for part in np.split(np.packbits(bits), PIECES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array(parts, pa.binary())], names=["piece", "counts"])

    parts = sets.mapInArrow(partial, "piece int, counts binary")
    return np.unpackbits(_joined_pieces(parts, np.bitwise_or, np.uint8, FILTER_BITS // 8)).astype(bool)


def filter_places(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    spread = mix(sets.view(np.uint64))
    return (spread % np.uint64(FILTER_BITS)).astype(np.int64), ((spread >> np.uint64(32)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _wanted_sets(width: int, shared):
    """Rows (set, shingles) of the sets that the filter lets through, once for each task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        numbers, held, size = [], [], 0
        for _, shingles in _sets_of(batches, width):
            number = set_number(shingles)
            one, two = filter_places(np.array([number], dtype=np.int64))
            if number in seen or not (bits[one[0]] and bits[two[0]]):
                continue
            seen.add(number)
            numbers.append(number)
            held.append(shingles.tobytes())
            size += len(held[-1])
            if size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(held, pa.binary())], names=["set", "shingles"])
                numbers, held, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(held, pa.binary())], names=["set", "shingles"])

    return rows


def _bounded(percent: int):
    """From rows (a, b, sizes, points): pairs whose summed coordinate minima allow the similarity."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            if len(one):
                minima = np.minimum(_points(batch.column(4).to_pylist()), _points(batch.column(5).to_pylist()))
                keep = minima.sum(axis=1, dtype=np.int64) >= needed(one, other, percent)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return rows


def _verified(percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (one, other))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows


def _links(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of set numbers that are similar enough, by their whole sets."""
    spark = docs.sparkSession
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    bits = spark.sparkContext.broadcast(filter_bits(wanted))
    path = fresh_path(spark, "sets")
    docs.mapInArrow(_wanted_sets(width, bits), "set bigint, shingles binary").join(wanted, "set", "left_semi").dropDuplicates(["set"]).write.parquet(path)
    bits.destroy()
    sets = spark.read.schema("set bigint, shingles binary").parquet(path)
    both = (
        pairs.join(sets.select(F.col("set").alias("a"), F.col("shingles").alias("one")), "a")
        .join(sets.select(F.col("set").alias("b"), F.col("shingles").alias("other")), "b")
        .select("a", "b", "one", "other")
    )
    out = fresh_path(spark, "links")
    both.mapInArrow(_verified(percent), "a bigint, b bigint").write.parquet(out)
    delete_path(spark, path)
    return spark.read.schema("a bigint, b bigint").parquet(out)


def similar_classes(docs: DataFrame, width: int = 5, percent: int = 80, run: int = RUN) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, n, set) and roots (node, root) of the sets that have links, for (doc_id, text) rows."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be over 0 and at most 100")
    spark = docs.sparkSession
    schema = "doc_id bigint, n int, set bigint, point binary, piece int, counts binary"
    table = written(docs.mapInArrow(_members(width), schema), "members")
    members = table.where("piece IS NULL").select("doc_id", "n", "set")
    held = table.where("piece IS NOT NULL").select("piece", "counts")
    shared = spark.sparkContext.broadcast(_joined_pieces(held, np.add, np.uint32, GROUPS))

    points = written(table.where("point IS NOT NULL").select("set", "n", "point").dropDuplicates(["set"]), "points")
    entries = docs.mapInArrow(_entries(width, percent, shared), "token bigint, set bigint, n int, place int")
    met = entries.repartition("token")
    shared_rows = met.sortWithinPartitions("token").mapInArrow(_shared, "token bigint, set bigint, n int, place int")
    runs = written(shared_rows.distinct(), "runs")
    shared.destroy()
    # The text that others were copied from has most entries in common with others: it goes first wherever it meets them.
    central = runs.groupBy("set").agg((-F.count("*")).alias("order"))
    placed = runs.join(central, "set").select("token", "order", "set").repartition("token")
    pairs = placed.sortWithinPartitions("token", "order", "set").mapInArrow(_seeds, "a bigint, b bigint")
    tested = written(pairs.distinct(), "pairs")
    both = (
        tested.join(points.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa")), "a")
        .join(points.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb")), "b")
        .select("a", "b", "na", "nb", "pa", "pb")
    )
    close = written(both.mapInArrow(_bounded(percent), "a bigint, b bigint"), "close")
    links = _links(docs, close, width, percent)
    roots = written(components(links), "roots")

    placed = runs.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    placed = written(placed, "placed")
    left = placed.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("rows")).where("x <> y")
    blocks = F.ceil(F.col("rows") / F.lit(run)).cast("int")
    left = left.select("token", blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    wide = placed.join(left, "token").withColumn("own", own)
    # A block meets itself and every other block of its token; most tokens have one block.
    spread = (
        wide.join(points.select("set", "point"), "set")
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("token", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), "set", "n", "place", "root", "point", "own")
    )
    group = ["token", "low", "high"]
    sorted_rows = spread.repartition(*group).sortWithinPartitions(*group)
    more = sorted_rows.mapInArrow(_tree_pairs(percent), "a bigint, b bigint").distinct()
    more = written(more.join(tested, ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        links = links.union(_links(docs, more, width, percent))
        roots = written(components(links), "roots")
    return members, roots


def join_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): the connected components of documents of similar shingle sets.

    Words are runs of other characters than ASCII space, A-Z lower-cased; a text of fewer than `width` words has one
    shingle of all of them. Two documents link when 100 |A and B| >= percent |A or B|. `component_id` is the least
    doc_id of the component. A null or empty text or one without words has no shingles and links with nothing: its
    component is its own doc_id, as is that of a text that is like no other. Rows that repeat are alike and so in one
    component; rows that share a doc_id are judged row by row, and a null doc_id is never the least unless there is
    no other. Other columns are left out. An empty table gives an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    members, roots = similar_classes(rows, width, percent)
    rooted = members.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    some = rooted.where("n > 0")
    least = some.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = some.join(least, "root").select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")
    none = members.where("n = 0").select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.union(none)


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that of the least doc_id; a document that is like no other stays.

    Of rows that share the doc_id kept, the one of least text hash stays. Columns are as before.
    """
    found = join_components(docs, width, percent)
    kept = written(
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(F.count("*").alias("rows")), "kept"
    )
    own = docs["doc_id"].cast("bigint")
    ids = kept.select(F.col("doc_id").alias("_kept"), "rows")
    single = docs.join(ids.where("rows = 1"), own.eqNullSafe(F.col("_kept")), "left_semi")
    many = docs.join(ids.where("rows > 1"), own.eqNullSafe(F.col("_kept")), "left_semi")
    place = scratch_name(docs, "_place")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    return single.union(many.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place))
