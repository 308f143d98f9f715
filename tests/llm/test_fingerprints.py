import hashlib
import re

from pyspark.sql import functions as F

from tidemark.llm import fingerprints


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(text):
    lines, sections = text.split("\n"), []
    pattern = fingerprints.WORDS if len(text) <= fingerprints.SHORT else fingerprints.SENTENCE
    for first in range(0, len(lines), fingerprints.SECTION):
        part = lines[first : first + fingerprints.SECTION]
        pieces = [hashlib.md5(x.encode()).hexdigest()[:8] for line in part for x in re.findall(pattern, line)]
        sections.append((sha("".join(map(sha, part))), pieces))
    return sha("".join(d for d, _ in sections)) + "|" + "|".join(d[:16] + ":" + "".join(p) for d, p in sections)


def brute_likeness(one, other):
    if one[:64] == other[:64]:
        return 1.0
    sets = [set(re.findall("[0-9a-f]{8}", "".join(b.split(":")[1] for b in x.split("|")[1:]))) for x in (one, other)]
    total = len(sets[0]) + len(sets[1])
    return 2.0 * len(sets[0] & sets[1]) / total if total else 0.0


def test_odd_documents(spark, odd):
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    ids = sorted({d for d, _ in rows if d is not None})
    after = dict(zip(ids, ids[1:] + ids[:1]))
    least = {d: min(t for e, t in rows if e == d) for d in ids}
    want = []
    for doc_id, text in rows:
        cut = len(text) // 4
        other = least[after[doc_id]] if doc_id is not None else ""
        edited = text[: len(text) - cut] + other[:cut]
        own, new = brute_tree(text), brute_tree(edited)
        near = brute_likeness(own, brute_tree(other)) if doc_id is not None else 0.0
        want.append((doc_id, len(text), sha(edited), own, new, brute_likeness(own, new), near))
    got = fingerprints.compare_with_edits(odd)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_edits_are_located(spark):
    lines = [f"Line {i} says something of its own. It goes on." for i in range(40)]
    changed = lines.copy()
    changed[19] = "Line 19 says something else."
    rows = [("\n".join(lines), "\n".join(changed))]
    frame = spark.createDataFrame(rows, "a string, b string").select(
        fingerprints.fingerprint(fingerprints.tree(F.col("a"))).alias("a"), fingerprints.fingerprint(fingerprints.tree(F.col("b"))).alias("b")
    )
    row = frame.select(fingerprints.differing_sections(F.col("a"), F.col("b")).alias("at"), fingerprints.likeness(F.col("a"), F.col("b")).alias("x")).first()
    assert list(row["at"]) == [2] and 0.9 < row["x"] < 1


def test_next_ids_over_slices(spark):
    ids = [3, 3, 8, 1, 90, 14, 15, 1_000_000, 2, None, 77]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    own = sorted({i for i in ids if i is not None})
    want = dict(zip(own, own[1:] + own[:1]))
    for size in (1, 2, 3, 100):
        assert {r[0]: r[1] for r in fingerprints.next_ids(frame, slice_rows=size).collect()} == want


def test_one_document_and_none(spark, empty):
    one = spark.createDataFrame([(5, "abcdefgh")], "doc_id bigint, text string")
    row = fingerprints.compare_with_edits(one).first()
    assert row["edited_sha256"] == sha("abcdefab") and row["near_next"] == 1.0
    assert fingerprints.compare_with_edits(empty).count() == 0
