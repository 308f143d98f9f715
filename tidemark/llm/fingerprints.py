"""Document fingerprints: a Merkle tree over the paragraphs and sections of a text, by built-in functions only.

Paragraphs are the lines of a text, sections are runs of `SECTION` paragraphs, and a paragraph is parted into pieces:
its sentences, or runs of words where the text is short. A paragraph's digest is of its text, a section's of its
paragraphs' digests, and the root's of the sections'. The fingerprint holds the tree: root, section digests, piece
digests. Equal roots mean equal texts; where roots differ, sections and pieces that differ locate the edits.

    <SHA-256 of the root>|<16 digits of a section>:<8 digits of each piece>|<16 digits of a section>:...
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import scratch_name

SECTION = 8
SHORT = 1_000  # characters up to which pieces are runs of words
SENTENCE = r"[^.!?]+[.!?]*|[.!?]+"
WORDS = r"[^ ]+(?: +[^ ]+){0,2} *| +"
SLICE_ROWS = 200_000
MAX_SLICES = 5_000


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def tree(text: Column) -> Column:
    """struct(root, sections array<struct(digest, pieces array<string>)>) of a text that is not null."""
    pattern = F.when(F.length(text) <= SHORT, F.lit(WORDS)).otherwise(F.lit(SENTENCE))
    lines = F.split(text, "\n", -1)

    def section(part: Column) -> Column:
        pieces = F.transform(
            F.flatten(F.transform(part, lambda line: F.regexp_extract_all(line, pattern, F.lit(0)))),
            lambda piece: F.substring(F.md5(piece.cast("binary")), 1, 8),
        )
        digest = _digest(F.array_join(F.transform(part, _digest), ""))
        return F.struct(digest.alias("digest"), pieces.alias("pieces"))

    def parts(lines: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(lines), F.lit(SECTION)), lambda first: section(F.slice(lines, first, F.lit(SECTION)))
        )

    def rooted(sections: Column) -> Column:
        return F.struct(_digest(F.array_join(sections["digest"], "")).alias("root"), sections.alias("sections"))

    def bound(value: Column, body) -> Column:  # evaluates the value once
        return F.get(F.transform(F.array(value), body), F.lit(0))

    return bound(lines, lambda lines: bound(parts(lines), rooted))


def fingerprint(tree: Column) -> Column:
    """The tree as a string."""
    branches = F.transform(
        tree["sections"], lambda one: F.concat(F.substring(one["digest"], 1, 16), F.lit(":"), F.array_join(one["pieces"], ""))
    )
    return F.concat_ws("|", tree["root"], F.array_join(branches, "|"))


def pieces(fingerprint: Column) -> Column:
    """The distinct piece digests that a fingerprint holds."""
    branches = F.filter(F.split(fingerprint, r"\|"), lambda _, i: i > 0)
    joined = F.array_join(F.transform(branches, lambda one: F.substring_index(one, ":", -1)), "")
    return F.array_distinct(F.regexp_extract_all(joined, F.lit("[0-9a-f]{8}"), F.lit(0)))


def likeness(one: Column, other: Column) -> Column:
    """Of two fingerprints: twice the pieces in common over all pieces; 1 for equal roots.

    Texts without pieces are alike only if they are equal. Null if either is null.
    """

    def shared(own: Column, theirs: Column) -> Column:
        total = F.size(own) + F.size(theirs)
        return F.when(total == 0, 0.0).otherwise(2.0 * F.size(F.array_intersect(own, theirs)) / total)

    def bound(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    same = F.substring_index(one, "|", 1) == F.substring_index(other, "|", 1)
    parted = bound(pieces(one), lambda own: bound(pieces(other), lambda theirs: shared(own, theirs)))
    return F.when(same, 1.0).when(one.isNotNull() & other.isNotNull(), parted)


def differing_sections(one: Column, other: Column) -> Column:
    """Numbers (from 0) of the sections of a fingerprint string whose digest the other fingerprint does not have."""

    def sections(text: Column) -> Column:
        branches = F.filter(F.split(text, r"\|"), lambda _, i: i > 0)
        return F.transform(branches, lambda one: F.substring_index(one, ":", 1))

    own, theirs = sections(one), sections(other)
    found = F.transform(own, lambda x, i: F.when(F.array_contains(theirs, x), None).otherwise(i))
    return F.filter(found, lambda i: i.isNotNull())


def next_ids(ids: DataFrame, column: str = "doc_id", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(column, _next) of distinct ids that are not null, the first following the last.

    Ids are cut into slices of about `slice_rows` at approximate quantiles, so that no task sorts all of them; the
    first id of the next slice follows the last of a slice.
    """
    ids = ids.select(column).where(F.col(column).isNotNull()).distinct()
    count = ids.count()
    slices = min(MAX_SLICES, max(1, -(-count // slice_rows)))
    cuts = []
    if slices > 1:
        steps = [i / slices for i in range(1, slices)]
        cuts = sorted(set(ids.agg(F.percentile_approx(column, steps, 10 * slices)).first()[0]))
    if cuts:
        number = F.size(F.filter(F.array(*[F.lit(cut) for cut in cuts]), lambda cut: cut <= F.col(column)))
    else:
        number = F.lit(0)
    sliced = ids.withColumn("_slice", number)
    own = Window.partitionBy("_slice").orderBy(column)
    firsts = sliced.groupBy("_slice").agg(F.min(column).alias("_first"))
    order = Window.orderBy("_slice")  # at most MAX_SLICES rows
    after = firsts.select(
        "_slice", F.coalesce(F.lead("_first").over(order), F.first("_first").over(order)).alias("_after")
    )
    return (
        sliced.withColumn("_next", F.lead(column).over(own))
        .join(F.broadcast(after), "_slice")
        .select(column, F.coalesce("_next", "_after").alias("_next"))
    )


def compare_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts and of their edited texts, and how like they are.

    The edited text has the last floor(n / 4) code points replaced by the first as many (or all) of the next
    document by doc_id, the first document following the last. A null text is an empty one. Rows that share a
    doc_id are one document to the one before: it is given the least of their texts' beginnings. A null doc_id has
    no next document: its text loses the last quarter, and near_next is 0. A single document is its own next. The
    result has doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next; other
    columns are left out. An empty table gives an empty one.
    """
    # One shuffle of the texts by doc_id serves them as documents and as next documents; of the latter only what
    # is asked for, a quarter of the text before, goes on to that one.
    # An alias of doc_id would stand in one use only after planning, and they would differ.
    rows = docs.select(doc_id, F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows if doc_id == "doc_id" else rows.toDF("doc_id", "text")
    quarter = F.floor(F.length("text") / 4).cast("int")
    sizes = rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(quarter).alias("quarter"))
    # The filter stands in both uses of the texts; otherwise it would only be in one, and the shuffles would differ.
    named, unnamed = rows.where(F.col("doc_id").isNotNull()), rows.where(F.col("doc_id").isNull())
    asked = (
        next_ids(rows, "doc_id")
        .join(sizes, "doc_id")
        .select(F.col("_next").alias("doc_id"), F.col("doc_id").alias("asker"), "quarter")
    )
    placed = named.repartition("doc_id")
    offers = (
        placed.join(asked, "doc_id")
        .select(
            "asker",
            F.substring("text", F.lit(1), F.col("quarter")).alias("start"),
            fingerprint(tree(F.col("text"))).alias("next_fingerprint"),
        )
        .groupBy("asker")
        .agg(F.min(F.struct("start", "next_fingerprint")).alias("offer"))
    )
    kept = F.substring("text", F.lit(1), F.length("text") - quarter)
    edited = F.concat(kept, F.coalesce(F.substring(F.col("offer.start"), F.lit(1), quarter), F.lit("")))
    joined = placed.join(offers, F.col("doc_id") == F.col("asker"), "left").select(
        "doc_id", "text", edited.alias("edited"), "offer.next_fingerprint"
    )
    joined = joined.union(unnamed.select("doc_id", "text", kept, F.lit(None).cast("string")))
    printed = joined.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        _digest(F.col("edited")).alias("edited_sha256"),
        fingerprint(tree(F.col("text"))).alias("fingerprint"),
        fingerprint(tree(F.col("edited"))).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    return printed.withColumns(
        {
            "near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")),
            "near_next": F.coalesce(likeness(F.col("fingerprint"), F.col("next_fingerprint")), F.lit(0.0)),
        }
    ).drop("next_fingerprint")
