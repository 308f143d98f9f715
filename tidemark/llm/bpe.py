"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding.

Texts are cut into words by the pattern of the vocabulary. The distinct words that occur most often in the corpus
are folded once by Spark's higher-order functions with a literal map of the merges, and tasks get that table, which
is of bounded size. Other words are merged where they are met, the distinct new ones of a block side by side: the
higher-order functions are interpreted and take about 70 microseconds a word, far too long for the rare words of a
corpus, and long words would take them quadratic time. Texts are read twice and never shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import HashArray, fresh_path, runs_of, scratch_name, text_sizes

FOLD_BYTES = 48
BLOCK_BYTES = 4 << 20
KEPT_BYTES = 48 << 20
KEPT_SEGMENTS = 1 << 18
HEAD_WORDS = 1 << 17
FOLD_GROUPS = 16  # of the frequent words, for each core
BUCKETS = 1 << 16
SPREAD = 48_271
WIDE = 1 << 20
NOTHING = WIDE - 1


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def heap_merge(word: bytes, ranks: dict[bytes, int], below: int = 1 << 62) -> list[int]:
    """Ids of a word by the merges of rank under `below`: the lowest first, the leftmost of equals."""
    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap = [(rank, i) for i in range(len(word) - 1) if (rank := ranks.get(word[i : i + 2], below)) < below]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        if parts[i] is None or (j := after[i]) >= len(parts) or ranks.get(parts[i] + parts[j]) != rank:
            continue
        parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
        if after[i] < len(parts):
            before[after[i]] = i
            if (rank := ranks.get(parts[i] + parts[after[i]], below)) < below:
                heapq.heappush(heap, (rank, i))
        if (h := before[i]) >= 0 and (rank := ranks.get(parts[h] + parts[i], below)) < below:
            heapq.heappush(heap, (rank, h))
    return [ranks[part] for part in parts if part is not None]


def merge_words(words: list[bytes], byte_ids: np.ndarray, merges: HashArray, made: np.ndarray) -> tuple:
    """Ids of words side by side, and how many each has: in each round every word does its next merge.

    `merges` finds a pair of ids, left * WIDE + right, and `made` holds the ids they become, in its order.
    """
    sizes = np.array([len(word) for word in words], dtype=np.int64)
    parts = byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(words)), sizes)

    def ranks_of(at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each place; NOTHING at the end of a word."""
        after = np.minimum(at + 1, len(parts) - 1)
        found = merges.find((parts[at] * WIDE + parts[after]).astype(np.uint64))
        pair = (found >= 0) & (owner[at] == owner[after]) & (after > at)
        return np.where(pair, made[np.maximum(found, 0)], NOTHING)

    ranks = ranks_of(np.arange(len(parts)))
    done_owner, done_parts = [], []
    while len(parts):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        best = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, len(parts))))
        go = best < NOTHING
        done_owner.append(owner[~go])
        done_parts.append(parts[~go])
        parts, owner, ranks, best = parts[go], owner[go], ranks[go], best[go]
        if len(parts) == 0:
            break
        at = np.flatnonzero(ranks == best)
        at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]  # the leftmost in each word
        parts[at] = best[at]
        stay = np.ones(len(parts), dtype=bool)
        stay[at + 1] = False
        at -= np.arange(len(at))  # one part less for each word before
        parts, owner, ranks = parts[stay], owner[stay], ranks[stay]
        ranks[at] = ranks_of(at)
        left = at[(at > 0) & (owner[at] == owner[at - 1])] - 1
        ranks[left] = ranks_of(left)
    owners = np.concatenate(done_owner) if done_owner else owner
    order = np.argsort(owners, kind="stable")
    ids = (np.concatenate(done_parts) if done_parts else parts)[order]
    return ids.astype(np.int32), np.bincount(owners, minlength=len(words))


def merge_pairs(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The pair of ids that each longer token is merged from: what its bytes come to by the merges of lower rank.

    In a text where no merge of lower rank is left, a token can only come from this pair.
    """
    pairs = {}
    for token, rank in ranks.items():
        if len(token) > 1:
            parts = heap_merge(token, ranks, rank)
            if len(parts) == 2:
                pairs[parts[0], parts[1]] = rank
    return pairs


@lru_cache(maxsize=2)
def merge_arrays(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the pairs that merge, and the ids they become; worked out once a process."""
    merges = merge_pairs(load_ranks(path))
    pairs = np.fromiter((left * WIDE + right for left, right in merges), dtype=np.uint64, count=len(merges))
    return pairs, np.fromiter(merges.values(), dtype=np.int64, count=len(merges))


@lru_cache(maxsize=2)
def _rank_text(path: str) -> str:
    pairs, made = merge_arrays(path)
    places = ((pairs // np.uint64(WIDE)).astype(np.int64) * SPREAD + (pairs % np.uint64(WIDE)).astype(np.int64)) % BUCKETS
    order = np.argsort(places, kind="stable")
    cuts = np.searchsorted(places[order], np.arange(BUCKETS + 1)).tolist()
    entries = [f'"{pair}":{rank}' for pair, rank in zip(pairs[order].tolist(), made[order].tolist())]
    return "[" + ",".join("{" + ",".join(entries[i:j]) + "}" for i, j in zip(cuts[:-1], cuts[1:])) + "]"


def rank_map(text: Column) -> Column:
    """Merges from their text: an array of small maps from a pair of ids to the id it becomes, placed by the pair.

    Spark searches a map entry by entry, so that one map of all merges would be searched through for every pair.
    """
    return F.from_json(text, "array<map<string,int>>").cast("array<map<bigint,bigint>>")


def _let(value: Column, body) -> Column:
    """Evaluate a value once and use it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_merges(words: Column, merges: Column) -> Column:
    """Ids of words given as arrays of the ids of their bytes, by folding merges over each array.

    The state of the fold is an array with a number for each part: the id that the part and its right neighbour
    merge to, times WIDE, plus the part's own id. As ids are ranks, the least number shows the merge to do next.
    A part that stands for nothing at either end saves special cases. Of equal merges that overlap the left one
    goes first: two neighbours can become the same token only in turns of two ids, so a look to the left is enough.
    """

    def fold(word: Column, merges: Column) -> Column:
        def number(left: Column, right: Column) -> Column:
            slot = (left * SPREAD + right).bitwiseAND(BUCKETS - 1).cast("int")
            return F.coalesce(F.get(merges, slot)[left * WIDE + right], nothing) * WIDE + left

        def merge(state: Column, at: Column, new: Column) -> Column:
            before, after = F.get(state, at - 2), F.get(state, at + 1)
            return F.concat(
                F.slice(state, F.lit(1), at - 2),
                F.array(number(before.bitwiseAND(WIDE - 1), new), number(new, after.bitwiseAND(WIDE - 1))),
                F.slice(state, at + 2, most),
            )

        def step(state: Column, _: Column) -> Column:
            return _let(
                F.array_min(state),
                lambda best: F.when(best >= NOTHING * WIDE, state).otherwise(
                    _let(
                        F.shiftright(best, 20),
                        lambda new: _let(
                            F.array_position(state, best).cast("int"),
                            lambda at: _let(
                                F.when(F.shiftright(F.get(state, at - 2), 20) == new, at - 1).otherwise(at),
                                lambda at: merge(state, at, new),
                            ),
                        ),
                    )
                ),
            )

        nothing, most = F.lit(NOTHING).cast("bigint"), F.lit(FOLD_BYTES + 2)
        end = F.array(F.lit(NOTHING * WIDE + NOTHING).cast("bigint"))
        start = F.transform(word, lambda part, i: number(part, F.coalesce(F.get(word, i + 1), nothing)))
        return F.aggregate(
            F.sequence(F.lit(1), F.size(word)),
            F.concat(end, start, end),
            step,
            lambda state: F.transform(
                F.slice(state, F.lit(2), F.size(state) - 2), lambda part: part.bitwiseAND(WIDE - 1).cast("int")
            ),
        )

    none = F.array().cast("array<int>")
    return _let(
        merges,
        lambda merges: F.transform(words, lambda word: F.when(F.size(word) == 0, none).otherwise(fold(word, merges))),
    )


class _Codes(dict):
    """Code of a word: a given one, else the next number in order of appearance."""

    def __init__(self, given: dict[str, int], first: int):
        super().__init__(given)
        self.first, self.words = first, []

    def __missing__(self, word: str) -> int:
        code = self[word] = self.first + len(self.words)
        self.words.append(word)
        return code


class _Lists:
    """Lists of ids by number, side by side in one array."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes, self.starts = ids, sizes, np.cumsum(sizes) - sizes

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the lists of these numbers, one after the other, and the end of each."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        source = np.arange(int(ends[-1]) if len(ends) else 0)
        source += np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        return self.ids[source], ends


class _Encoder:
    """Ids of texts, block by block.

    Texts are cut into segments before each space or line end that follows another character; no match of the
    pattern goes on across such a place, and none looks back. Each distinct segment is cut into words by the pattern,
    each distinct word is merged. Texts with other white space are one segment. What was met is kept up to a bound.
    """

    def __init__(self, path: str, pattern: str, head: tuple):
        self.ranks, self.find = load_ranks(path), regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([value])] for value in range(256)], dtype=np.int64)
        words, self.head_ids, self.head_sizes, pairs, made = head
        self.merges = HashArray(pairs)
        self.made = made[self.merges.order]
        self.tokens = max(self.ranks.values()) + 1
        self.known = _text_tokens(self.ranks)
        self.known.update(zip(words, range(self.tokens, self.tokens + len(words))))
        self._reset()

    def _reset(self) -> None:
        self.words = _Codes(self.known, self.tokens + len(self.head_sizes))
        self.word_ids = _Lists(
            np.concatenate([np.arange(self.tokens, dtype=np.int32), self.head_ids]),
            np.concatenate([np.ones(self.tokens, dtype=np.int64), self.head_sizes]),
        )
        self.segments = _Codes({}, 0)
        self.segment_ids = _Lists(np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))
        self.kept_bytes = 0

    def block(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text begins, with the end."""
        if self.kept_bytes > KEPT_BYTES:
            self._reset()
        before = len(self.segments.words)
        found = [np.fromiter(map(self.segments.__getitem__, segments(text or "")), dtype=np.int32) for text in texts]
        new = self.segments.words[before:]
        self.kept_bytes += sum(map(len, new)) + 100 * len(new)
        self._learn(new)
        ids, ends = self.segment_ids.gather(np.concatenate(found) if found else np.zeros(0, dtype=np.int32))
        return ids, np.concatenate([[0], ends])[np.cumsum([0, *map(len, found)])]

    def _learn(self, new: list[str]) -> None:
        before = len(self.words.words)
        parts = [[self.words[word] for word in self.find(segment)] for segment in new]
        words = [word.encode() for word in self.words.words[before:]]
        long = {i: heap_merge(word, self.ranks) for i, word in enumerate(words) if len(word) > FOLD_BYTES}
        short = [b"" if i in long else word for i, word in enumerate(words)]
        ids, sizes = merge_words(short, self.byte_ids, self.merges, self.made)
        for i in sorted(long, reverse=True):
            at = int(sizes[:i].sum())
            ids = np.concatenate([ids[:at], np.array(long[i], dtype=np.int32), ids[at:]])
            sizes[i] = len(long[i])
        self.word_ids.add(ids, sizes)
        numbers = np.fromiter(itertools.chain.from_iterable(parts), dtype=np.int64)
        ids, ends = self.word_ids.gather(numbers)
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, parts)])]
        self.segment_ids.add(ids, np.diff(cuts))


_SEGMENT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")


def segments(text: str) -> list[str]:
    return [text] if text and _OTHER_SPACE.search(text) else _SEGMENT.findall(text)


def _text_tokens(ranks: dict[bytes, int]) -> dict[str, int]:
    """The tokens that are whole characters; a word that is one of them is not merged at all."""
    tokens = {}
    for token, rank in ranks.items():
        try:
            tokens[token.decode()] = rank
        except UnicodeDecodeError:
            continue
    return tokens


def _blocks(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end in runs_of(text_sizes(batch.column(place)), BLOCK_BYTES):
            yield batch.slice(begin, end - begin)


def frequent_words(docs: DataFrame, path: str, pattern: str, column: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """(word) that are no tokens and occur most often, at most `head_words` of them, counted over all texts.

    A word is counted in runs of texts where it occurs twice or more: one that never does is not frequent.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, find = _text_tokens(load_ranks(path)), regex.compile(pattern).findall

        def rows(met: Counter[str]) -> pa.RecordBatch:
            seen: Counter[str] = Counter()
            for segment, count in met.items():
                for word in find(segment):
                    seen[word] += count
            kept = [
                (word, count)
                for word, count in seen.items()
                if count > 1 and word not in tokens and len(word.encode()) <= FOLD_BYTES
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0] for row in kept], pa.string()), pa.array([row[1] for row in kept], pa.int64())],
                names=["word", "count"],
            )

        met: Counter[str] = Counter()
        for block in _blocks(batches, 0):
            for text in block.column(0).to_pylist():
                met.update(segments(text or ""))
            if len(met) > KEPT_SEGMENTS:
                yield rows(met)
                met = Counter()
        yield rows(met)

    spark = docs.sparkSession
    found = docs.select(column).mapInArrow(counts, "word string, count bigint")
    table = fresh_path(spark, "word-counts")
    # Counts are put into classes an eighth of a power of two wide; the highest classes that fit are taken.
    found.groupBy("word").agg(F.floor(F.log2(F.sum("count")) * 8).cast("int").alias("class")).write.parquet(table)
    words = spark.read.schema("word string, class int").parquet(table)
    least, held = None, 0
    for row in words.groupBy("class").count().orderBy(F.desc("class")).collect():  # a few hundred classes at most
        held += row["count"]
        if held > head_words:
            break
        least = row["class"]
    return words.where(F.lit(False) if least is None else F.col("class") >= least).select("word")


def fold_words(words: DataFrame, path: str) -> DataFrame:
    """(word, ids): the merges folded over the bytes of each word by higher-order functions.

    The merges are a row that joins each group of words. As a literal they would stand, megabytes long, in every
    description of the plan that the driver makes and keeps.
    """
    ranks = load_ranks(path)
    spark = words.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    byte_ids = F.array(*[F.lit(ranks[bytes([value])]).cast("bigint") for value in range(256)])
    digits = F.hex(F.encode("word", "UTF-8"))
    parts = F.transform(
        F.sequence(F.lit(1), F.length(digits), F.lit(2)),
        lambda i: F.get(byte_ids, F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("int")),
    )
    group = F.pmod(F.xxhash64("word"), F.lit(FOLD_GROUPS * tasks)).alias("group")
    groups = words.select(group, "word", parts.alias("parts")).groupBy("group").agg(F.collect_list(F.struct("word", "parts")).alias("held"))
    merges = spark.createDataFrame([(_rank_text(path),)], "ranks string").select(rank_map(F.col("ranks")).alias("merges"))
    joined = groups.repartition(tasks, "group").crossJoin(F.broadcast(merges))  # few words, but slow; one row of merges
    folded = joined.select(F.arrays_zip(F.col("held.word").alias("word"), fold_merges(F.col("held.parts"), F.col("merges")).alias("ids")).alias("held"))
    return folded.select(F.explode("held").alias("one")).select("one.word", "one.ids")


Rows = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoding(docs: DataFrame, path: str, pattern: str, column: str, head_words: int) -> tuple[Rows, T.StructType]:
    """What adds the ids to batches of `docs`, and the schema it makes."""
    head = fold_words(frequent_words(docs, path, pattern, column, head_words), path).toArrow()  # head_words rows
    lists = head["ids"].combine_chunks()
    ids, sizes = lists.flatten().to_numpy().astype(np.int32), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    # The words stay Arrow buffers here; tasks make strings of them.
    shared = docs.sparkSession.sparkContext.broadcast((head["word"], ids, sizes, *merge_arrays(path)))
    place = [name.lower() for name in docs.columns].index(column.lower())
    out = T.StructType([*_numbered(docs).schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    schema = to_arrow_schema(out)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, *rest = shared.value
        encoder = _Encoder(path, pattern, (words.to_pylist(), *rest))
        for block in _blocks(batches, place):
            found, bounds = encoder.block(block.column(place).to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found, pa.int32()))
            yield pa.RecordBatch.from_arrays([*block.columns, ids], schema=schema)

    return rows, out


def _numbered(df: DataFrame) -> DataFrame:
    """Names that cannot clash on the way through Arrow."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def encode(
    docs: DataFrame, path: str, pattern: str, column: str = "text", ids: str = "ids", head_words: int = HEAD_WORDS
) -> DataFrame:
    """All columns and the ids of a text as array<int>; special tokens are ordinary text.

    A null or empty text has no ids. Rows that repeat are encoded alike. The ids' column gets another name if `ids`
    is taken. An empty table gives an empty one. `head_words` bounds the table of folded words that tasks get. The
    pattern must not look back nor match across a space or line end after another character but white space.
    """
    rows, out = _encoding(docs, path, pattern, column, head_words)
    return _numbered(docs).mapInArrow(rows, out).toDF(*docs.columns, scratch_name(docs, ids))


def load_pieces(path: str) -> list[bytes]:
    """Bytes of each id; ids without a token stand for no bytes."""
    ranks = load_ranks(path)
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pieces


def decode_ids(ids: np.ndarray, pieces: list[bytes]) -> bytes:
    return b"".join([pieces[i] for i in ids.tolist()])


def decode(encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns, and the bytes that an array of ids stands for; null ids give null."""
    place = [name.lower() for name in encoded.columns].index(ids.lower())
    out = T.StructType([*_numbered(encoded).schema.fields, T.StructField("decoded", T.BinaryType())])
    schema = to_arrow_schema(out)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(path)
        for batch in batches:
            sizes = [size or 0 for size in pc.list_value_length(batch.column(place)).to_pylist()]
            for begin, end in runs_of(sizes, 1 << 20):
                part = batch.slice(begin, end - begin)
                texts = [decode_ids(one.values.to_numpy(), pieces) if one.is_valid else None for one in part.column(place)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], schema=schema)

    return _numbered(encoded).mapInArrow(rows, out).toDF(*encoded.columns, scratch_name(encoded, decoded))


def round_trip(
    docs: DataFrame, path: str, pattern: str, column: str = "text", head_words: int = HEAD_WORDS, keep_ids: bool = False
) -> DataFrame:
    """Columns but the text; n_tokens, and SHA-256 of the ids and of the bytes they are decoded to, in one pass.

    With `keep_ids` the ids follow as array<int>. Ids count as little-endian unsigned 32-bit numbers. Texts are encoded as by `encode`, and new names are kept
    apart as there.
    """
    rows, _ = _encoding(docs, path, pattern, column, head_words)
    place = [name.lower() for name in docs.columns].index(column.lower())
    keep = [i for i in range(len(docs.columns)) if i != place]
    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    added += [("ids", T.ArrayType(T.IntegerType()))] * keep_ids
    own = _numbered(docs).schema.fields
    out = T.StructType([*[own[i] for i in keep], *[T.StructField(name, kind) for name, kind in added]])
    schema = to_arrow_schema(out)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(path)
        for batch in rows(batches):
            lists = batch.column(batch.num_columns - 1)
            ids, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
            parts = [ids[begin:end] for begin, end in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in keep],
                    pa.array([len(part) for part in parts], pa.int64()),
                    pa.array([hashlib.sha256(part.astype("<u4").tobytes()).hexdigest() for part in parts], pa.string()),
                    pa.array([hashlib.sha256(decode_ids(part, pieces)).hexdigest() for part in parts], pa.string()),
                    *[lists] * keep_ids,
                ],
                schema=schema,
            )

    names = [docs.columns[i] for i in keep]
    return _numbered(docs).mapInArrow(digests, out).toDF(*names, *[scratch_name(docs.select(*names), name) for name, _ in added])
