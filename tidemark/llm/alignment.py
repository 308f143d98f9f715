"""Alignment of two tokenizers' tokens over the same text.

Tokens of both sides are byte ranges of space + text. Per batch, `merge_asof` keyed by document finds for the start of
each token the token of the other side that covers it; both directions together are all overlaps. Overlapping tokens that
end together are links; their ends cut a document into groups, the smallest stretches that both sides cut alike.

Both tokenizers always part a text before a single space between characters that are no space, so texts are tokenized
in such segments, and each distinct segment once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import runs_of, scratch_name, text_sizes, written

BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 8_192
CACHED_SEGMENTS = 200_000  # segments that a worker remembers from batch to batch
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_letters() -> dict[str, int]:
    """The letters of byte-level vocabularies: printable bytes stand for themselves, others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [value for value in range(256) if value not in plain]
    return {chr(value): value for value in plain} | {chr(256 + place): value for place, value in enumerate(rest)}


class Tokenizers:
    """Both tokenizers from the contents of their files, with the bytes of every token."""

    def __init__(self, byte_level: str, pieces: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, number in self.a.get_vocab().items():
            known = all(letter in letters for letter in entry)
            self.a_bytes[number] = bytes(letters[letter] for letter in entry) if known else entry.encode()
        self.b_bytes = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            byte = self.b.is_byte(number)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        self.sizes = [np.array([len(value) for value in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes)]
        self.number: dict[str, int] = {}
        self.good = np.zeros(0, dtype=bool)
        self.uses = np.zeros(0, dtype=np.int64)
        # Of each side, the ids of all known segments one after the other, and how many each segment has.
        self.ids = [np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)]
        self.counts = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)]

    def _forget(self) -> None:
        """Keep the segments that were met most often, a quarter of CACHED_SEGMENTS at most."""
        keep = np.zeros(len(self.uses), dtype=bool)
        keep[np.argsort(self.uses, kind="stable")[-(CACHED_SEGMENTS // 4) :]] = True
        keep &= self.uses > 1
        self.number = {part: place for place, part in enumerate(part for part, kept in zip(self.number, keep) if kept)}
        self.ids = [ids[np.repeat(keep, held)] for ids, held in zip(self.ids, self.counts)]
        self.counts = [held[keep] for held in self.counts]
        self.good, self.uses = self.good[keep], np.zeros(int(keep.sum()), dtype=np.int64)

    def numbers(self, parts: list[str]) -> np.ndarray:
        """Places of segments among the known ones, to which new ones are added. Places hold until the next call."""
        if len(self.number) > CACHED_SEGMENTS:
            self._forget()
        new = [part for part in dict.fromkeys(parts) if part not in self.number]
        for begin, end in runs_of([len(part) for part in new], 1 << 20):
            self._learn(new[begin:end])
        numbers = np.fromiter(map(self.number.__getitem__, parts), dtype=np.int64, count=len(parts))
        self.uses = np.bincount(numbers, minlength=len(self.good)) + np.pad(self.uses, (0, len(new)))
        return numbers

    def _learn(self, parts: list[str]) -> None:
        self.number.update(zip(parts, range(len(self.good), len(self.good) + len(parts))))
        ours = [one.ids for one in self.a.encode_batch_fast([" " + part for part in parts], add_special_tokens=False)]
        sides = [ours, self.b.encode(parts, num_threads=1)]
        wholes = [b" " + part.encode() for part in parts]
        lengths = np.fromiter(map(len, wholes), dtype=np.int64, count=len(wholes))
        good = np.ones(len(parts), dtype=bool)
        for side, (lists, entries) in enumerate(zip(sides, (self.a_bytes, self.b_bytes))):
            counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            ids = np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(counts.sum()))
            sums = np.concatenate([[0], np.cumsum(self.sizes[side][ids])])
            ends = np.cumsum(counts)
            good &= sums[ends] - sums[ends - counts] == lengths
            # With equal lengths all segments are right if their bytes are, one after the other.
            chosen = np.flatnonzero(good).tolist()
            joined = b"".join([entries[i] for place in chosen for i in lists[place]])
            if joined != b"".join([wholes[place] for place in chosen]):
                for place in chosen:
                    good[place] = b"".join([entries[i] for i in lists[place]]) == wholes[place]
            self.ids[side] = np.concatenate([self.ids[side], ids])
            self.counts[side] = np.concatenate([self.counts[side], counts])
        self.good = np.concatenate([self.good, good])


_loaded: dict[bytes, Tokenizers] = {}


def load(byte_level: str, pieces: bytes) -> Tokenizers:
    """Tokenizers are made once a worker."""
    key = hashlib.sha256(byte_level.encode() + pieces).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizers(byte_level, pieces)
    return _loaded[key]


@dataclass
class Tokens:
    """Tokens of one side of a batch: document, id and byte range, counted through the whole batch."""

    doc: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def tokenize(texts: list[str | None], use: Tokenizers) -> tuple[Tokens, Tokens]:
    """Tokens of both sides; texts that are null, empty or not what their tokens say have none."""
    parts, counts = [], np.zeros(len(texts), dtype=np.int64)
    for place, text in enumerate(texts):
        if text:
            cut = _CUT.split(text)
            parts += cut
            counts[place] = len(cut)
    doc = np.repeat(np.arange(len(texts)), counts)
    numbers = use.numbers(parts)
    odd = ~use.good[numbers]
    if odd.any():
        bad = np.zeros(len(texts), dtype=bool)
        bad[doc[odd]] = True
        numbers, doc = numbers[~bad[doc]], doc[~bad[doc]]
    sides = []
    for ids, held, sizes in zip(use.ids, use.counts, use.sizes):
        first = np.cumsum(held) - held
        counts = held[numbers]
        begins = np.cumsum(counts) - counts
        ids = ids[np.repeat(first[numbers] - begins, counts) + np.arange(int(counts.sum()))]
        size = sizes[ids]
        ends = np.cumsum(size)
        sides.append(Tokens(np.repeat(doc, counts), ids, ends - size, ends))
    return sides[0], sides[1]


def _covering(one: Tokens, other: Tokens) -> np.ndarray:
    """For the start of each token, the place of the other side's token that covers it."""
    left = pd.DataFrame({"at": one.starts, "doc": one.doc})
    right = pd.DataFrame({"at": other.starts, "doc": other.doc, "place": np.arange(len(other.ids))})
    return pd.merge_asof(left, right, on="at", by="doc")["place"].to_numpy(dtype=np.int64)


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of tokens that share a byte, in order of the first and then of the second."""
    over, under = _covering(a, b), _covering(b, a)
    # Where both begin together, one direction is enough.
    late = b.starts > a.starts[under]
    first = np.concatenate([np.arange(len(a.ids)), under[late]])
    second = np.concatenate([over, np.flatnonzero(late)])
    order = np.lexsort((second, first))
    return first[order], second[order]


def links(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places of the overlapping pairs that end together: the last tokens of each group."""
    first, second = overlaps(a, b)
    same = a.ends[first] == b.ends[second]
    return first[same], second[same]


def _groups(side: Tokens, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token, and number of tokens of each group, from the places of their last tokens."""
    counts = np.diff(np.concatenate([[-1], last]))
    return np.repeat(np.arange(len(last)), counts), counts


def group_texts(a: Tokens, b: Tokens, a_last: np.ndarray, b_last: np.ndarray, number: int) -> list[bytes]:
    """For each document of the batch, `a1,a2|b1;a3|b2,b3`: ids of both sides by group."""
    a_group, a_count = _groups(a, a_last)
    b_group, b_count = _groups(b, b_last)
    begin = np.cumsum(a_count + b_count) - a_count - b_count
    total = len(a.ids) + len(b.ids)
    ids, mark = np.zeros(total, dtype=np.int64), np.full(total, ord(","), dtype=np.uint64)
    a_at = begin[a_group] + np.arange(len(a.ids)) - (np.cumsum(a_count) - a_count)[a_group]
    b_at = (begin + a_count)[b_group] + np.arange(len(b.ids)) - (np.cumsum(b_count) - b_count)[b_group]
    ids[a_at], ids[b_at] = a.ids, b.ids
    mark[a_at[a_last]], mark[b_at[b_last]] = ord("|"), ord(";")
    words, digits = _digit_words(int(ids.max(initial=0)))
    # Eight bytes a token, of which those not needed are zero: its digits, then its mark.
    text = ((words[ids] | mark << np.uint64(56)).astype("<u8")).view(np.uint8)
    whole = text[text != 0].tobytes()
    # A document's text ends before its last mark.
    per_doc = np.bincount(a.doc, minlength=number) + np.bincount(b.doc, minlength=number)
    edges = np.concatenate([[0], np.cumsum(digits[ids] + 1)])[np.concatenate([[0], np.cumsum(per_doc)])]
    return [whole[one : other - 1] if other > one else b"" for one, other in zip(edges[:-1].tolist(), edges[1:].tolist())]


@lru_cache(maxsize=2)
def _all_digit_words(count: int) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(b"".join(str(value).encode().ljust(8, b"\0") for value in range(count)), dtype="<u8")
    return words, np.array([len(str(value)) for value in range(count)], dtype=np.int64)


def _digit_words(highest: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all numbers up to one of at most seven digits, as the bytes of a word each, and how many."""
    return _all_digit_words(1 << max(16, highest.bit_length()))


def _split(values: np.ndarray, doc: np.ndarray, number: int) -> list[np.ndarray]:
    """Values by document, which they are in order of."""
    return np.split(values, np.searchsorted(doc, np.arange(1, number)))


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch with texts of BLOCK_BYTES at most, or one longer text."""
    for begin, end in runs_of([size + BLOCK_BYTES // BLOCK_ROWS for size in text_sizes(batch.column(column))], BLOCK_BYTES):
        yield batch.slice(begin, end - begin)


def _files(byte_level: str, pieces: str) -> tuple[str, bytes]:
    """The tokenizers' files; tasks get their contents, a few MB whatever the data."""
    with open(byte_level, encoding="utf-8") as one, open(pieces, "rb") as other:
        return one.read(), other.read()


def align(docs: DataFrame, byte_level: str, pieces: str, text: str = "text") -> DataFrame:
    """All columns of the documents and a_ids, b_ids, overlaps, groups.

    `a_ids` and `b_ids` are the token ids of space + text by the byte-level BPE of the file `byte_level` and the BPE of the
    model `pieces`, without special tokens. `overlaps` holds (a, b, linked): places of tokens that share a byte, and whether
    they end together. `groups` holds (a, b): ids of both sides between two common ends. A text that is null or empty, or
    whose tokens do not give its bytes back, has empty arrays. Rows are worked on one by one, whatever ids repeat; where a
    new name is taken, `_` is added to it. A text is tokenized whole.
    """
    names = {}
    for wanted in ("a_ids", "b_ids", "overlaps", "groups"):
        names[wanted] = scratch_name(docs, wanted)
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names.values(), _KINDS)])
    column, fields = docs.columns.index(text), schema.names
    files = docs.sparkSession.sparkContext.broadcast(_files(byte_level, pieces))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = load(*files.value)
        for batch in batches:
            for chunk in _chunks(batch, column):
                number = chunk.num_rows
                a, b = tokenize(chunk.column(column).to_pylist(), use)
                first, second = overlaps(a, b)
                same = a.ends[first] == b.ends[second]
                a_base = np.searchsorted(a.doc, np.arange(number))
                b_base = np.searchsorted(b.doc, np.arange(number))
                pairs = zip((first - a_base[a.doc[first]]).tolist(), (second - b_base[b.doc[second]]).tolist(), same.tolist())
                pairs = [{"a": x, "b": y, "linked": z} for x, y, z in pairs]
                edges = np.searchsorted(a.doc[first], np.arange(number + 1))
                a_group, _ = _groups(a, first[same])
                b_group, _ = _groups(b, second[same])
                a_sets, b_sets = _split(a.ids, a_group, int(same.sum())), _split(b.ids, b_group, int(same.sum()))
                cut = np.searchsorted(a.doc[first[same]], np.arange(number + 1))
                groups = [[{"a": x, "b": y} for x, y in zip(a_sets[i:j], b_sets[i:j])] for i, j in zip(cut[:-1], cut[1:])]
                columns = [
                    _split(a.ids, a.doc, number), _split(b.ids, b.doc, number),
                    [pairs[i:j] for i, j in zip(edges[:-1], edges[1:])], groups,
                ]
                arrays = [pa.array(values, _ARROW[place]) for place, values in enumerate(columns)]
                yield pa.RecordBatch.from_arrays([*chunk.columns, *arrays], fields)

    return docs.mapInArrow(work, schema)


_IDS = T.ArrayType(T.IntegerType())
_OVERLAP = T.StructType().add("a", T.IntegerType()).add("b", T.IntegerType()).add("linked", T.BooleanType())
_KINDS = [_IDS, _IDS, T.ArrayType(_OVERLAP), T.ArrayType(T.StructType().add("a", _IDS).add("b", _IDS))]
_ARROW = [
    pa.list_(pa.int32()),
    pa.list_(pa.int32()),
    pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("linked", pa.bool_())])),
    pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])),
]
_DOC = pa.struct(
    [
        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups_sha256", pa.string()), ("slots", pa.binary()), ("times", pa.binary()),
    ]
)
_BLOCKS = (
    "block bigint, docs array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,"
    "groups_sha256:string,slots:binary,times:binary>>, pairs array<bigint>, counts array<bigint>"
)
_RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def _block(number: int, ids: list, texts: list[str | None], use: Tokenizers) -> pa.RecordBatch:
    """One row for a run of documents: their figures, the distinct linked id pairs, and who has which how often."""
    size = len(texts)
    a, b = tokenize(texts, use)
    a_last, b_last = links(a, b)
    doc = a.doc[a_last]
    codes = a.ids[a_last].astype(np.int64) << 32 | b.ids[b_last]
    pairs, slot, counts = np.unique(codes, return_inverse=True, return_counts=True)
    held, times = np.unique(doc * max(1, len(pairs)) + slot, return_counts=True)
    owner = held // max(1, len(pairs))
    slots = _split((held % max(1, len(pairs))).astype(np.uint32), owner, size)
    times = _split(times.astype(np.uint32), owner, size)
    per = [np.bincount(x, minlength=size).tolist() for x in (a.doc, b.doc, doc)]
    texts_of = group_texts(a, b, a_last, b_last, size)
    rows = [
        {
            "doc_id": doc_id, "n_a": n_a, "n_b": n_b, "n_groups": n, "n_links": n,
            "groups_sha256": hashlib.sha256(text).hexdigest() if n_a else "",
            # As differences the places are small numbers, which compress well.
            "slots": np.diff(held, prepend=np.uint32(0)).tobytes(), "times": often.tobytes(),
        }
        for doc_id, n_a, n_b, n, text, held, often in zip(ids, *per, texts_of, slots, times)
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()), pa.array([rows], pa.list_(_DOC)),
            pa.array([pairs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
        ],
        ["block", "docs", "pairs", "counts"],
    )


def _score(key: tuple, blocks: pa.Table, scored: pa.Table) -> pa.Table:
    """Sums over the documents of one block; `scored` has the corpus-wide figures of its pairs."""
    docs = [doc for chunk in blocks.column("docs").to_pylist() for doc in chunk]
    place = scored.column("place").to_numpy()
    total, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
    total[place] = scored.column("total").to_numpy()
    best[place] = scored.column("best").to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for doc in docs:
        slots = np.cumsum(np.frombuffer(doc.pop("slots"), dtype=np.uint32), dtype=np.int64)
        times = np.frombuffer(doc.pop("times"), dtype=np.uint32).astype(np.int64)
        n_best.append(int((best[slots] * times).sum()))
        count_sum.append(int((total[slots] * times).sum()))
    columns = {name: [doc[name] for doc in docs] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    columns |= {"n_best": n_best, "count_sum": count_sum}
    arrays = {name: pa.array(values, pa.int64()) for name, values in columns.items()}
    return pa.table(arrays | {"groups_sha256": pa.array([doc["groups_sha256"] for doc in docs], pa.string())})


def link_figures(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one for each row of the documents.

    Tokens, groups and links as in `align`. The count of an id pair is the number of links that hold it in all documents;
    `n_best` counts the links whose count is the highest that their second id has anywhere, `count_sum` adds the counts of
    a document's links. Without tokens all numbers are zero and the digest is empty. Repeated and null ids give a row
    each; an empty table gives none; other columns are not read.

    Documents are written in blocks of BLOCK_BYTES with the distinct pairs of the block, so that counting and scoring
    shuffle a pair once a block however many documents have it.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast(_files(byte_level, pieces))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = load(*files.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in _chunks(batch, 1):
                yield _block(number, chunk.column(0).to_pylist(), chunk.column(1).to_pylist(), use)
                number += 1

    blocks = written(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, _BLOCKS), "alignment-blocks")
    files.destroy()
    zipped = F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "one")
    pairs = blocks.select("block", zipped).select("block", "place", F.col("one.pairs").alias("pair"), F.col("one.counts").alias("n"))
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    # At most as many rows a second id as the first vocabulary has ids.
    second = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    totals = totals.withColumn("best", F.col("total") == F.max("total").over(second))
    scored = pairs.join(totals, "pair").select(F.col("block").alias("of"), "place", "total", "best")
    grouped = blocks.select("block", "docs").groupBy("block").cogroup(scored.groupBy("of"))
    return grouped.applyInArrow(_score, _RESULT)
