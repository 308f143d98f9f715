import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe
from tidemark.llm.common import HashArray

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    merges = bpe.merge_pairs(RANKS)
    pairs = np.array([left * bpe.WIDE + right for left, right in merges], dtype=np.uint64)
    none = np.zeros(0, dtype=np.int32)
    return bpe._Encoder(PATH, public_tokenizers.PATTERN, ([], none, none.astype(np.int64), pairs, np.array(list(merges.values()))))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_text_as_the_library(library, encoder, texts):
    ids, bounds = encoder.block(texts)
    parts = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert parts == [library.encode_ordinary(text) for text in texts]


def test_merging_side_by_side_and_with_a_heap():
    draw = random.Random(5)
    words = ["".join(draw.choice("abeinrst ñé的") for _ in range(draw.randrange(1, 30))).encode() for _ in range(400)]
    merges = bpe.merge_pairs(RANKS)
    found = HashArray(np.array([left * bpe.WIDE + right for left, right in merges], dtype=np.uint64))
    byte_ids = np.array([RANKS[bytes([value])] for value in range(256)], dtype=np.int64)
    ids, sizes = bpe.merge_words(words, byte_ids, found, np.array(list(merges.values()))[found.order])
    ends = np.cumsum(sizes)
    assert [ids[e - s : e].tolist() for s, e in zip(sizes, ends)] == [bpe.heap_merge(word, RANKS) for word in words]


def test_higher_order_functions_fold_the_same_merges(spark):
    draw = random.Random(6)
    words = sorted({" " + "".join(draw.choice("aeinrstdo") for _ in range(draw.randrange(1, 20))) for _ in range(300)} | {"é", "aaaaaaaaaaaa"})
    folded = bpe.fold_words(spark.createDataFrame([(word,) for word in words], "word string"), PATH)
    assert {r["word"]: list(r["ids"]) for r in folded.collect()} == {word: bpe.heap_merge(word.encode(), RANKS) for word in words}


def test_round_trip_of_odd_documents(spark, odd, library):
    encoded = bpe.encode(odd, PATH, public_tokenizers.PATTERN)
    assert encoded.columns == [*odd.columns, "ids_"]
    decoded = bpe.decode(encoded, PATH, ids="ids_")
    for row in decoded.collect():
        assert list(row["ids_"]) == library.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]).decode() == (row["text"] or "")


def test_digests_and_small_head(spark, odd, library):
    got = bpe.round_trip(odd.select("doc_id", "text", "n_tokens"), PATH, public_tokenizers.PATTERN, head_words=2, keep_ids=True)
    assert got.columns == ["doc_id", "n_tokens", "n_tokens_", "ids_sha256", "decoded_sha256", "ids"]
    texts = sorted(
        (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
        for r in odd.collect()
        for ids in [library.encode_ordinary(r["text"] or "")]
    )
    assert sorted((r["n_tokens_"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect()) == texts


def test_empty_table(spark, empty):
    assert bpe.encode(empty, PATH, public_tokenizers.PATTERN).count() == 0


def test_the_merges_do_not_stand_in_the_plan(spark):
    words = spark.createDataFrame([(word,) for word in ("hello", "hello", "Wörter", "x" * bpe.FOLD_BYTES)], "word string")
    folded = bpe.fold_words(words, PATH)
    assert len(folded._jdf.queryExecution().toString()) < 100_000
    ranks = bpe.load_ranks(PATH)
    got = sorted((row["word"], list(row["ids"])) for row in folded.collect())
    assert got == sorted((row["word"], bpe.heap_merge(row["word"].encode(), ranks)) for row in words.collect())
