import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from tidemark.llm import bpe, mixing
from tidemark.llm.common import fresh_path

FOLDER = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, left = docs.columns, []
    texts = []
    for _, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, "stage")
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        left.append(docs.count())
        if "text" in docs.columns:
            assert docs.columns == columns
            texts.append({r["doc_id"]: r["text"] for r in docs.collect()})
    toxic, lines, near, mixed = texts
    total = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert 0.8 * total < left[0] < total and left[0] == left[1] >= left[2] == left[3] == left[4]
    assert any(toxic[i] != lines[i] for i in toxic) and all(near[i] == lines[i] for i in near) and mixed == near

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    for row in docs.collect():
        assert list(row["ids"]) == library.encode_ordinary(mixed[row["doc_id"]])
        assert row["n_tokens"] == len(row["ids"])
        assert row["decoded_sha256"] == hashlib.sha256(mixed[row["doc_id"]].encode()).hexdigest()


def test_the_mixture_is_the_order_of_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    weights = mixing.smoothed_weights(docs)
    order = {r["doc_id"]: (r["mix_slot"], r["mix_offset"]) for r in mixing.schedule(docs, weights).collect()}
    rows = [order[r["doc_id"]] for r in corpus_pipeline.mix_sources(spark, docs, FOLDER).collect()]
    assert rows == sorted(rows)


def test_run_has_a_row_for_each_document_kept(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() == got.select("doc_id").distinct().count() > 100
