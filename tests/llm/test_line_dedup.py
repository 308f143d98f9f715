import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import line_dedup
from tidemark.llm.common import LOWER, SPACE


def brute(rows, min_chars=20, min_documents=3):
    def key(line):
        return line.encode().translate(LOWER).strip(SPACE).decode()

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(-(2**63) if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        own = -(2**63) if doc_id is None else doc_id
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_documents or own == max(holders[key(x)])]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def result(df):
    names = df.columns
    return sorted(((r["doc_id"], r["text"], r[names[-2]], r[names[-1]]) for r in df.collect()), key=repr)


def test_odd_documents_and_clashing_names(spark, odd):
    got = line_dedup.drop_repeated_lines(odd)
    assert got.columns == [*odd.columns, "n_lines_", "n_dropped"]
    assert result(got) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_random_lines(spark, family):
    lines = family(40, words=12)
    rows = [(i, "\n".join(lines[(i * 7 + j * j) % 40] for j in range(i % 9))) for i in range(60)]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), batches=3, fanout=2)
    assert result(got) == brute(rows)


def test_empty_table(spark, empty):
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_runs_are_compacted_and_carry_state(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for batch in range(5):
        rows = [(batch * 10 + i, f"line {(batch + i) % 4} which is long enough".encode()) for i in range(3)]
        lines = spark.createDataFrame([(d, hashlib.md5(k).digest()) for d, k in rows], "doc_id bigint, key binary")
        if batch == 4:
            assert runs.new_lines(lines).count() == 0
        runs.add(lines)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    again = line_dedup.LineRuns(spark, fanout=2, levels=runs.levels)
    assert again.totals().agg(F.sum("documents")).first()[0] == 15
    assert again.totals().agg(F.max("owner")).first()[0] == 42
