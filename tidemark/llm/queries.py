"""The registered queries, one for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, bpe, fingerprints, language, mixing, neighbours, ngram_join, passages, sharding, surrogates, toxicity, whitening
from tidemark.llm.common import read_documents
from tidemark.llm.line_dedup import drop_repeated_lines
from tidemark.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]

LINE_DEDUP_SQL = r"""
    WITH lines AS (
        SELECT doc_id, coalesce(text, '') AS text,
               unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
        FROM documents
    ),
    keyed AS (
        SELECT doc_id, text, line, place,
               translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ),
    repeated AS (
        SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    ),
    judged AS (
        SELECT k.doc_id, k.place, k.line, r.key IS NOT NULL AND k.doc_id < r.owner AS dropped
        FROM keyed k LEFT JOIN repeated r ON k.key = r.key
    )
    SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
"""


@query("op10_line_dedup", LINE_DEDUP_SQL)
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder).select("doc_id", "text")
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    )


@query("op3_bpe")
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder).select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


@query("op2_language")
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder).select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "accepted")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder).select("doc_id", "text")
    return toxicity.judge(docs, read_documents(spark, folder, "labels")).drop("text")


@query("op1_pfair_mix")
def op1_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder).select("doc_id", "source", "text")
    return mixing.schedule(docs, mixing.smoothed_weights(docs)).drop("text")


def _tree_sql(text: str) -> str:
    """Macros of DuckDB would hide the steps; a subquery per text gives the fingerprint and its distinct pieces."""
    lines = f"string_split({text}, chr(10))"
    part = f"{lines}[first : first + {fingerprints.SECTION - 1}]"
    piece = f"list_transform(regexp_extract_all(line, '%s'), lambda piece : substr(md5(piece), 1, 8))"
    pieces = f"""flatten(list_transform({part}, lambda line :
        CASE WHEN length({text}) <= {fingerprints.SHORT} THEN {piece % fingerprints.WORDS}
             ELSE {piece % fingerprints.SENTENCE} END))"""
    digest = f"sha256(array_to_string(list_transform({part}, lambda line : sha256(line)), ''))"
    return f"""list_transform(range(1, len({lines}) + 1, {fingerprints.SECTION}),
        lambda first : {{'digest': {digest}, 'pieces': {pieces}}})"""


def _print_sql(tree: str) -> str:
    return f"""sha256(array_to_string(list_transform({tree}, lambda one : one.digest), '')) || '|' ||
        array_to_string(list_transform({tree}, lambda one :
            substr(one.digest, 1, 16) || ':' || array_to_string(one.pieces, '')), '|')"""


def _pieces_sql(tree: str) -> str:
    return f"list_distinct(flatten(list_transform({tree}, lambda one : one.pieces)))"


def _likeness_sql(one: str, other: str) -> str:
    return f"""CASE WHEN split_part({one}_print, '|', 1) = split_part({other}_print, '|', 1) THEN 1.0
        WHEN len({one}_pieces) + len({other}_pieces) = 0 THEN 0.0
        ELSE CAST(2 * len(list_intersect({one}_pieces, {other}_pieces)) AS DOUBLE)
             / (len({one}_pieces) + len({other}_pieces)) END"""


FINGERPRINT_SQL = f"""
    WITH docs AS (
        SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
               coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id),
                        first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next
        FROM documents
    ),
    edited AS (
        SELECT doc_id, n, text, next, substr(text, 1, n - n // 4) || substr(next, 1, n // 4) AS edited FROM docs
    ),
    trees AS (
        SELECT doc_id, n, edited, {_tree_sql("text")} AS a, {_tree_sql("edited")} AS b, {_tree_sql("next")} AS c
        FROM edited
    ),
    prints AS (
        SELECT doc_id, n, edited, {_print_sql("a")} AS a_print, {_pieces_sql("a")} AS a_pieces,
               {_print_sql("b")} AS b_print, {_pieces_sql("b")} AS b_pieces,
               {_print_sql("c")} AS c_print, {_pieces_sql("c")} AS c_pieces
        FROM trees
    )
    SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, a_print AS fingerprint,
           b_print AS edited_fingerprint, CAST({_likeness_sql("a", "b")} AS DOUBLE) AS near_edited,
           CAST({_likeness_sql("a", "c")} AS DOUBLE) AS near_next
    FROM prints
"""


@query("op4_fingerprints", FINGERPRINT_SQL)
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_with_edits(read_documents(spark, folder).select("doc_id", "text"))


NGRAM_JOIN_SQL = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    sets AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 2), lambda i : array_to_string(w[i : i + 3], ' ')) END) AS s
        FROM words
    ),
    sizes AS (SELECT doc_id, len(s) AS n FROM sets),
    tokens AS (SELECT doc_id, unnest(s) AS token FROM sets),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= 85 * (x.n + y.n - c)
    ),
    reach(a, b) AS (
        SELECT doc_id, doc_id FROM sizes
        UNION
        SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    )
    SELECT s.doc_id, CAST(any_value(s.n) AS BIGINT) AS n_shingles, min(r.b) AS component_id
    FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id
"""


@query("op6_ngram_join", NGRAM_JOIN_SQL)
def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_components(read_documents(spark, folder), width=4, percent=85)


@query("op8_passages")
def op8_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(read_documents(spark, folder).select("doc_id", "text"))


@query("op7_neighbours")
def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_documents(spark, folder, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


@query("op5_surrogates")
def op5_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder).select("doc_id", "text")
    return surrogates.replace_entities(docs, key="tidemark")


@query("op13_whitening")
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read_documents(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("op11_alignment")
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder).select("doc_id", "text")
    return alignment.link_figures(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query("op12_sharding")
def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(read_documents(spark, folder).select("doc_id", "text"))
