"""Alignment against whole-text tokenization and ranges compared one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment, queries

FOLDER = "/root/testdata/sf0.001"
A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def use():
    return alignment.load(*alignment._files(A_FILE, B_FILE))


@pytest.fixture(scope="module")
def whole(use):
    """Token ids and byte ranges of both sides, each text tokenized at once."""
    one = Tokenizer.from_file(A_FILE)
    one.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=B_FILE)

    def ranges(ids, entries):
        ends = np.cumsum([len(entries[i]) for i in ids]).tolist()
        return list(zip(ids, [0, *ends[:-1]], ends))

    def tokens(text):
        if not text:
            return [], []
        a, b = one.encode(" " + text, add_special_tokens=False).ids, other.encode(text)
        joined = (" " + text).encode()
        if b"".join(use.a_bytes[i] for i in a) != joined or b"".join(use.b_bytes[i] for i in b) != joined:
            return [], []
        return ranges(a, use.a_bytes), ranges(b, use.b_bytes)

    return tokens


def groups_of(a, b):
    ends = sorted({end for _, _, end in a} & {end for _, _, end in b})
    result, begin = [], 0
    for end in ends:
        result.append(([i for i, s, e in a if begin <= s and e <= end], [i for i, s, e in b if begin <= s and e <= end]))
        begin = end
    return result


def brute(rows, whole):
    """Digest rows by comparing every token with every other of its document."""
    docs = [(doc_id, *whole(text)) for doc_id, text in rows]
    linked = [[(x[0], y[0]) for x in a for y in b if x[2] == y[2]] for _, a, b in docs]
    count = Counter(pair for pairs in linked for pair in pairs)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    result = []
    for (doc_id, a, b), pairs in zip(docs, linked):
        groups = groups_of(a, b)
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        result.append((
            doc_id, len(a), len(b), len(groups), len(pairs), sum(count[p] == best[p[1]] for p in pairs),
            sum(count[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if a else "",
        ))
    return result


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

ODD = [
    "a", " a", "a ", "a  b", "  a   b  ", "\n", "\t \n x", "don't stop, it's 12,345 o'clock", "a▁b", "a ▁ b", "x y z",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "日本語 テキスト 日本", "Ελληνικά ﬁ Å½ ½", "👍🏽 ok", "x\x00y", "a\x1c b", "a\x85 b　 c",
    "é combining", "   ", "no_space_" * 50, "word " * 200, "​zero width​ space", "line\r\nbreak", "ñandú Ünïcode",
]


def test_segments_give_the_tokens_of_whole_texts(use, whole):
    draw = random.Random(4)
    letters = ["a", "B", " ", " ", "  ", "\n", "'s", "1", "é", "日", "▁", "\t", ",", "the", " of", " ", "-", "<", "👍"]
    texts = ODD + ["".join(draw.choices(letters, k=draw.randrange(1, 40))) for _ in range(500)]
    a, b = alignment.tokenize(texts, use)
    for place, text in enumerate(texts):
        expected = whole(text)
        for side, wanted in zip((a, b), expected):
            assert side.ids[side.doc == place].tolist() == [i for i, _, _ in wanted], text


def test_overlaps_are_all_pairs_that_share_a_byte(use, whole):
    a, b = alignment.tokenize(ODD, use)
    first, second = alignment.overlaps(a, b)
    found = list(zip(first.tolist(), second.tolist()))
    expected = [
        (i, j) for i in range(len(a.ids)) for j in range(len(b.ids))
        if a.doc[i] == b.doc[j] and a.starts[i] < b.ends[j] and b.starts[j] < a.ends[i]
    ]
    assert found == expected


def test_odd_documents(spark, odd, whole):
    rows = [(row.doc_id, row.text) for row in odd.select("doc_id", "text").collect()]
    found = [tuple(row[name] for name in COLUMNS) for row in alignment.link_figures(odd, A_FILE, B_FILE).collect()]
    short = [row for row in rows if row[1] is None or len(row[1]) < 5_000]
    long = [row for row in rows if row not in short]
    assert len(found) == len(rows)
    # The long text is compared by its tokens; its counts are part of the others' sums, so those are compared without it.
    alone = odd.where("text IS NULL OR length(text) < 5000")
    found = [tuple(row[name] for name in COLUMNS) for row in alignment.link_figures(alone, A_FILE, B_FILE).collect()]
    assert sorted(found, key=repr) == sorted(brute(short, whole), key=repr)
    assert len(long) == 1


def test_very_long_text(spark, odd, use, whole):
    text = odd.where("doc_id = 5").first().text
    a, b = alignment.tokenize([text, None, text], use)
    expected = whole(text)
    for side, wanted in zip((a, b), expected):
        assert side.ids.tolist() == [i for i, _, _ in wanted] * 2
    a_last, b_last = alignment.links(a, b)
    ends = sorted({end for _, _, end in expected[0]} & {end for _, _, end in expected[1]})
    assert len(a_last) == len(b_last) == 2 * len(ends)


def test_many_blocks_and_a_word_that_all_share(spark, whole, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 1_000)
    draw = random.Random(2)
    words = ["the", "tokenizer", "aligns", "überall", "12", "words,", "and", "Pieces", "日本"]
    rows = [(i, " ".join(draw.choices(words, k=draw.randrange(0, 30)))) for i in range(120)] + [(i, "the same") for i in range(200, 260)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = [tuple(row[name] for name in COLUMNS) for row in alignment.link_figures(frame, A_FILE, B_FILE).collect()]
    assert sorted(found) == sorted(brute(rows, whole))


def test_empty_table(empty):
    assert alignment.link_figures(empty, A_FILE, B_FILE).collect() == []
    assert alignment.align(empty, A_FILE, B_FILE).collect() == []


def test_align_returns_tokens_overlaps_and_groups(spark, whole):
    rows = [(i, text, [i]) for i, text in enumerate(["unbelievable tokens", None, "", "a▁b", "日本 x"])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, a_ids array<bigint>")
    for row in alignment.align(frame, A_FILE, B_FILE).collect():
        a, b = whole(row.text)
        assert row.a_ids == [row.doc_id] and row.a_ids_ == [i for i, _, _ in a] and row.b_ids == [i for i, _, _ in b]
        assert [(x.a, x.b) for x in row.groups] == groups_of(a, b)
        assert [tuple(x) for x in row.overlaps] == [
            (i, j, x[2] == y[2]) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]
        ]


def test_query_matches_brute_force(spark, whole):
    rows = [(row.doc_id, row.text) for row in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = {row.doc_id: row for row in queries.QUERIES["op11_alignment"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    docs = [(doc_id, *whole(text)) for doc_id, text in rows]
    linked = []
    for _, a, b in docs:
        ends = {end: i for i, _, end in b}
        linked.append([(i, ends[end]) for i, _, end in a if end in ends])
    count = Counter(pair for pairs in linked for pair in pairs)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    for (doc_id, a, b), pairs in zip(docs, linked):
        row = found[doc_id]
        assert (row.n_a, row.n_b, row.n_links, row.n_groups) == (len(a), len(b), len(pairs), len(pairs))
        assert row.n_best == sum(count[p] == best[p[1]] for p in pairs) and row.count_sum == sum(count[p] for p in pairs)
        if len(a) < 3_000:
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups_of(a, b))
            assert row.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if a else "")
