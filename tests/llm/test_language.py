import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_contract(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    got = language.identify(docs).cache()
    held = got.where("held_out")
    assert 150 < held.count() < 350
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert got.where("NOT accepted").count() < 0.05 * got.count()
    wanted = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    assert got.where(wanted != F.col("held_out")).count() == 0
    # The label of a held-out document plays no part in what is predicted for any document.
    hidden = docs.withColumn("lang", F.when(wanted, F.lit("xx")).otherwise(F.col("lang")))
    both = language.identify(hidden).select("doc_id", F.col("lang_pred").alias("again"), F.col("score").alias("other"))
    assert got.join(both, "doc_id").where("lang_pred <> again OR score <> other").count() == 0


def test_odd_documents(spark, odd):
    learned = spark.createDataFrame([(100 + i, "the cat and the dog", "en") for i in range(40)] + [(200 + i, "der hund und die katze", "de") for i in range(40)], "doc_id bigint, text string, lang string")
    docs = learned.unionByName(odd.select("doc_id", "text"), allowMissingColumns=True).withColumn("SCORE", F.lit("own"))
    got = language.identify(docs)
    assert got.columns == ["doc_id", "text", "lang", "SCORE", "lang_pred", "score_", "accepted", "held_out"]
    rows = got.where("lang IS NULL").collect()
    assert len(rows) == odd.count()
    for row in rows:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters)
        assert letters or (row["score_"] == 0 and not row["accepted"])


def test_nothing_to_learn_from(spark, odd, empty):
    docs = odd.select("doc_id", "text").withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(docs).collect()} == {"und"}
    assert language.identify(empty).count() == 0


def test_probabilities_of_a_context_add_up_to_one():
    codes, sizes, _ = language.grams(["abracadabra abba", "barbara"])
    own, counts = np.unique(codes, return_counts=True)
    model = language.kneser_ney({"x": (own, counts)})
    bits = np.uint64(language.BITS)
    for context in np.unique(codes >> bits)[:6]:
        every = (np.uint64(context) << bits) | np.arange(1 << language.BITS, dtype=np.uint64)
        assert abs(np.exp(model.log_probabilities(every)[:, 0].astype(np.float64)).sum() - 1) < 1e-3


def test_hash_array_finds_what_it_holds():
    codes = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 5_000).astype(np.uint64))
    table = language.HashArray(codes[::2])
    found = table.find(codes)
    assert (found[1::2] == -1).all()
    assert (table.order[found[::2]] == np.arange(len(codes[::2]))).all()
