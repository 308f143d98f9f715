"""Line dedup: levelled sorted runs of line keys, each new batch merged against them.

A run is a table (key, documents, owner) sorted by key: how many documents of one batch hold a line, and the
largest doc_id of them. A batch adds one run at level 0; `fanout` runs of a level are compacted into one run of
the next. Lines are identified by 128-bit hashes of the stripped, lower-cased line.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, SPACE, byte_texts, delete_path, fresh_path, scratch_name, written

LINES_SCHEMA = "doc_id bigint, version bigint, place int, key binary"


def _line_rows(min_chars: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions, places, keys = [], [], [], []
            for doc_id, version, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2))
            ):
                for place, line in enumerate(text.translate(LOWER).split(b"\n")):
                    key = line.strip(SPACE)
                    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
                        continue
                    ids.append(doc_id)
                    versions.append(version)
                    places.append(place)
                    keys.append(xxhash.xxh3_128_digest(key))
                if len(ids) >= 100_000:
                    yield _batch(ids, versions, places, keys)
                    ids, versions, places, keys = [], [], [], []
            yield _batch(ids, versions, places, keys)

    return rows


def _batch(ids: list, versions: list, places: list, keys: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(versions, pa.int64()),
            pa.array(places, pa.int32()),
            pa.array(keys, pa.binary()),
        ],
        names=["doc_id", "version", "place", "key"],
    )


def line_keys(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """(doc_id, version, place, key) of every line whose key has at least `min_chars` code points.

    `version` tells texts of one doc_id apart.
    """
    return docs.select("doc_id", F.xxhash64("text").alias("version"), "text").mapInArrow(_line_rows(min_chars), LINES_SCHEMA)


class LineRuns:
    """Levelled runs of line keys in the shared folder.

    `levels` is a list of lists of paths and is all the state there is: hand it to a later process to go on with
    the same runs. A batch that failed half-way leaves no run, as paths are listed after their write only.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, levels: list[list[str]] | None = None):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.fanout, self.levels = spark, fanout, levels or []

    def _read(self, paths: list[str]) -> DataFrame:
        schema = "key binary, documents bigint, owner bigint"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, run: DataFrame, level: int) -> None:
        path = fresh_path(self.spark, f"line-run-{level}")
        run.sortWithinPartitions("key").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    @staticmethod
    def _merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy("key").agg(F.sum("documents").alias("documents"), F.max("owner").alias("owner"))

    def paths(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def new_lines(self, lines: DataFrame) -> DataFrame:
        """Lines of a batch that no run holds: the merge-anti-join of a stream that keeps first occurrences."""
        return lines.join(self._read(self.paths()).select("key").hint("merge"), "key", "left_anti")

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (doc_id, key). A document belongs to one batch only; a null doc_id counts as one document."""
        once = lines.select("key", F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id")).distinct()
        self._write(once.groupBy("key").agg(F.count("doc_id").alias("documents"), F.max("doc_id").alias("owner")), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full = self.levels[level]
            self._write(self._merged(self._read(full)), level + 1)
            self.levels[level] = []
            for path in full:
                delete_path(self.spark, path)
            level += 1

    def totals(self) -> DataFrame:
        """All runs merged: one row per key."""
        paths = self.paths()
        return self._read(paths) if len(paths) == 1 else self._merged(self._read(paths))


def repeated_lines(lines: DataFrame, min_documents: int = 3, batches: int = 4, fanout: int = 4) -> DataFrame:
    """(key, owner) of keys held by at least `min_documents` documents; lines are added batch by batch."""
    spark = lines.sparkSession
    runs = LineRuns(spark, fanout)
    batch_of = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for number in range(batches):
        runs.add(lines.where(batch_of == number))
    repeated = written(runs.totals().where(F.col("documents") >= min_documents).select("key", "owner"), "line-repeated")
    for path in runs.paths():
        delete_path(spark, path)
    return repeated


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = 20, min_documents: int = 3, batches: int = 4, fanout: int = 4
) -> DataFrame:
    """Documents without the lines that at least `min_documents` documents hold, but for the largest doc_id of them.

    All columns stay; `text` loses lines, and `n_lines` and `n_dropped` are added (under other names if those are
    taken). Lines are split at \\n and compared stripped of ASCII space and with A-Z lower-cased; keys under
    `min_chars` code points stay. A null text counts as one empty line and comes back empty. Rows that share a
    doc_id are one document: each of them is cut alike where it holds the line. A null doc_id counts as one
    document smaller than all others. An empty table gives an empty one.
    """
    lines = written(line_keys(docs, min_chars), "line-keys")
    repeated = repeated_lines(lines, min_documents, batches, fanout)
    doc = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    key, version, gone = (scratch_name(docs, name) for name in ("_doc", "_version", "_gone"))
    split, n_lines, n_dropped = (scratch_name(docs, name) for name in ("_lines", "n_lines", "n_dropped"))
    lost = (
        lines.select(doc.alias(key), F.col("version").alias(version), "place", "key")
        .join(repeated, "key")
        .where(F.col(key) < F.col("owner"))
        .groupBy(key, version)
        .agg(F.collect_set("place").alias(gone))
    )
    joined = (
        docs.withColumns({key: doc, version: F.xxhash64("text")})
        .join(lost, [key, version], "left")
        .withColumn(split, F.split(F.coalesce("text", F.lit("")), "\n", -1))
    )
    count = F.size(split)
    stay = F.array_except(F.sequence(F.lit(0), count - 1), F.col(gone))
    kept = F.array_join(F.transform(stay, lambda place: F.col(split)[place]), "\n")
    text = F.when(F.col(gone).isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("text")
    return joined.select(
        *[text if name == "text" else F.col(f"`{name}`") for name in docs.columns],
        count.cast("bigint").alias(n_lines),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("bigint").alias(n_dropped),
    )
