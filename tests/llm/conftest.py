"""Small tables with everything that may be odd about a document."""

import random

import pytest

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(15_000))
SENTENCE = "The quick brown fox jumps over the lazy dog while seven wizards mix a potion of great and lasting strength."


def odd_rows():
    return [
        (1, None),
        (2, ""),
        (3, " \n\t \n"),
        (4, "a"),
        (5, LONG),
        (6, SENTENCE + "\nanother line of some length here\n" + SENTENCE),
        (7, SENTENCE),
        (7, SENTENCE),
        (8, SENTENCE + "\nend"),
        (9, "Ünïcode ñandú 日本語   Ελληνικά 👍🏽 ½ \x1c end\r\nnext"),
        (10, "no_space_" * 400),
        (None, SENTENCE),
        (12, "x" * 30 + "\n" + "  X" + "x" * 29 + "\t\n\n"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with columns whose names the operators would like to use."""
    schema = "doc_id bigint, text string, n_lines int, IDS string, _doc int, mix_slot int, P_TOXIC int, score int, n_tokens int"
    rows = [(doc_id, text, i, "x", i, i, i, i, i) for i, (doc_id, text) in enumerate(odd_rows())]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")


@pytest.fixture(scope="session")
def family():
    """Texts of random words, some of them edited copies of others."""

    def make(count: int, seed: int = 3, words: int = 60, vocabulary: int = 4_000):
        draw = random.Random(seed)
        texts = []
        for _ in range(count):
            if texts and draw.random() < 0.6:
                parts = draw.choice(texts).split(" ")
                for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
                    parts[draw.randrange(len(parts))] = f"w{draw.randrange(vocabulary)}"
                texts.append(" ".join(parts))
            else:
                texts.append(" ".join(f"w{draw.randrange(vocabulary)}" for _ in range(draw.randrange(4, words))))
        return texts

    return make
