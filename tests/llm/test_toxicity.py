import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.common import NOT_LETTER, Words


def made(spark, count=600, seed=1):
    draw = random.Random(seed)
    plain, bad = [f"plain{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)], ["rotten", "vile", "nastyword"]
    rows, labels = [], []
    for doc_id in range(count):
        words = [draw.choice(plain) for _ in range(draw.randrange(20, 120))]
        toxic, junk = draw.random() < 0.2, draw.random() < 0.3
        for i in range(len(words)):
            if toxic and draw.random() < 0.08 or toxic and i < 2:
                words[i] = draw.choice(bad)
            if junk and draw.random() < 0.2:
                words[i] = "clickbait" + draw.choice("xyz")
        rows.append((doc_id, " ".join(words), int(toxic)))
        if doc_id % 2 == 0:
            labels.append((doc_id, int(not junk), int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string, truth int").repartition(4),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_toxic_documents_are_found_and_others_left_alone(spark):
    docs, labels = made(spark)
    got = toxicity.judge(docs, labels)
    assert got.columns == ["doc_id", "text", "truth", "p_low_quality", "low_quality", "p_toxic", "toxic"]
    rows = got.where("doc_id % 2 = 1").collect()
    wrong = sum(r["toxic"] != bool(r["truth"]) for r in rows)
    assert wrong <= 0.02 * len(rows)


def test_later_categories_see_earlier_probabilities():
    draw = np.random.default_rng(3)
    first = draw.random(400) < 0.5
    wants = np.stack([first, first], axis=1).astype(float)
    owner, bucket = np.arange(400)[first], np.full(first.sum(), 7)
    buckets, weights, thresholds = toxicity.fit_rows(owner, bucket, np.full(first.sum(), 4.0), wants, np.arange(400) % toxicity.FOLDS)
    assert buckets.tolist() == [7] and weights.shape == (2, 3)
    assert weights[0, 1] == 0 and weights[1, 1] > 0.5  # the second category leans on the first
    assert (0 < thresholds).all() and (thresholds < 1).all()


def test_odd_documents_and_labels(spark, odd):
    docs, labels = made(spark, 200)
    rows = docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text").unionByName(odd, allowMissingColumns=True)
    own = labels.select((F.col("doc_id") + 1000).alias("doc_id"), "quality", "toxic")
    extra = spark.createDataFrame([(None, 1, 1), (1000, None, None), (1002, 0, 1), (1002, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = toxicity.judge(rows, own.union(extra))
    assert got.columns == [*rows.columns, "p_low_quality", "low_quality", "p_toxic_", "toxic"]
    by_text = {}
    for row in got.where("p_toxic_ IS NOT NULL").collect():
        assert 0 <= row["p_toxic_"] <= 1
        assert by_text.setdefault(row["text"] or "", row["p_toxic_"]) == row["p_toxic_"]
    assert sum(1 for _ in got.collect()) == rows.count()


def test_without_labels_nothing_is_flagged(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = toxicity.judge(odd.select("doc_id", "text"), labels)
    assert got.count() == odd.count() and got.where("toxic OR p_toxic > 0").count() == 0
    assert toxicity.judge(empty, labels).count() == 0


def test_rates_of_words_and_beginnings():
    texts = ["Rotten, rotten words".encode(), b"", "é".encode()]
    owner, feature, rate = toxicity.held_rates(texts)
    words = Words(texts, NOT_LETTER)
    assert np.diff(words.bounds).tolist() == [3, 0, 1]
    assert words.hashes()[0] == words.hashes()[1]
    assert rate.max() == 100 * 2 / (3 + toxicity.SMOOTH)
