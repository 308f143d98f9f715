"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other: the model of a category sees how often a text has each of the telling
words and beginnings of words, and the probabilities of the categories before it. While fitting, those probabilities are out-of-fold: each comes
from a model that has not seen the row, as at prediction time. Near copies share a fold. The chain is fitted on a bounded sample of labelled
rows in one task; all documents are then scored where they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import NOT_LETTER, Words, byte_texts, runs_of, scratch_name, shingle_hashes

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6, 7, 8)  # bytes
SMOOTH = 32
MOST = 8.0
FIT_ROWS = 8_192
FEATURES = 256
FOLDS = 5
PENALTY = 1e-4
STEPS = 800


@dataclass
class Chain:
    categories: list[str]
    buckets: np.ndarray  # of the telling words, ascending
    weights: np.ndarray  # category x (words, earlier categories, constant)
    thresholds: np.ndarray

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        lookup = np.full(BUCKETS, -1, dtype=np.int32)
        lookup[self.buckets] = np.arange(len(self.buckets))
        rows, words, rates = held_rates(texts, lookup)
        size = len(self.buckets)
        out = np.zeros((len(texts), len(self.categories)))
        for place in range(len(self.categories)):
            own = self.weights[place]
            total = np.bincount(rows, weights=own[words] * rates, minlength=len(texts)) + own[-1]
            total += out[:, :place] @ own[size : size + place]
            out[:, place] = _logistic(total)
        return out


def _logistic(total: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def held_rates(texts: list[bytes], lookup: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, rate): how often each word and beginning of a word occurs, in a hundred words of the text.

    Words are runs of letters. Features are hash buckets, or what `lookup` has for them, if that is not negative. Rates
    are taken as if there were `SMOOTH` words more, so that one word of a short text does not weigh too much.
    """
    words = Words(texts, NOT_LETTER)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
    owners, features = [owner], [words.hashes()]
    for size in PREFIXES:
        long, hashes = words.prefixes(size)
        owners.append(owner[long])
        features.append(hashes)
    owner = np.concatenate(owners)
    feature = (np.concatenate(features) % np.uint64(BUCKETS)).astype(np.int64)
    if lookup is not None:
        feature = lookup[feature]
        owner, feature = owner[feature >= 0], feature[feature >= 0].astype(np.int64)
    pairs, counts = np.unique(owner * BUCKETS + feature, return_counts=True)
    owner, feature = pairs // BUCKETS, pairs % BUCKETS
    rates = np.minimum(100 * counts / (np.diff(words.bounds)[owner] + SMOOTH), MOST)
    return owner, feature, rates


def families(texts: list[bytes]) -> list[int]:
    """A number for each text that near copies have in common mostly: its least hash of five words in a row."""
    words = Words(texts, NOT_LETTER)
    hashes = words.hashes()
    runs = (shingle_hashes(hashes[begin:end], 5) for begin, end in zip(words.bounds[:-1], words.bounds[1:]))
    return [int(run.min() >> np.uint64(8)) if len(run) else 0 for run in runs]


@dataclass
class Rows:
    """A matrix of few rates by (row, column, value), and dense columns after them, the constant last."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    words: int
    dense: np.ndarray

    def times(self, weights: np.ndarray) -> np.ndarray:
        words = np.bincount(self.row, weights=self.value * weights[self.column], minlength=len(self.dense))
        return words + self.dense @ weights[self.words :]

    def back(self, errors: np.ndarray) -> np.ndarray:
        words = np.bincount(self.column, weights=self.value * errors[self.row], minlength=self.words)
        return np.concatenate([words[: self.words], self.dense.T @ errors])

    def only(self, keep: np.ndarray) -> Rows:
        own = keep[self.row]
        number = np.cumsum(keep) - 1
        return Rows(number[self.row[own]], self.column[own], self.value[own], self.words, self.dense[keep])


def _fit_linear(rows: Rows, want: np.ndarray) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression; the constant is not penalised."""
    count = len(want)
    base = np.clip(want.mean(), 1e-4, 1 - 1e-4)
    weights = np.zeros(rows.words + rows.dense.shape[1])
    weights[-1] = np.log(base / (1 - base))
    ahead = before = weights
    penalty = np.full(len(weights), PENALTY)
    penalty[-1] = 0
    vector = np.ones(len(weights))
    for _ in range(12):  # the largest eigenvalue bounds the step
        vector = rows.back(rows.times(vector))
        largest = np.linalg.norm(vector)
        vector /= max(largest, 1e-12)
    step = 1 / (0.27 * largest / count + PENALTY)
    for turn in range(STEPS):
        slope = rows.back(_logistic(rows.times(ahead)) - want) / count + penalty * ahead
        weights = ahead - step * slope
        ahead = weights + turn / (turn + 3) * (weights - before)
        before = weights
    return weights


def _telling(owner: np.ndarray, bucket: np.ndarray, rate: np.ndarray, wants: np.ndarray, folds: np.ndarray) -> np.ndarray:
    """Buckets that tell a category best: those of the largest t statistic between its rows and the others.

    They have to differ the same way in all folds but one: a word that only a family of copies holds does not.
    """

    def sums(keep: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return np.bincount(bucket[keep], weights=weights, minlength=BUCKETS)

    chosen = []
    for want in wants.T:

        def t_of(rows: np.ndarray) -> np.ndarray:
            yes, no = max(1.0, want[rows].sum()), max(1.0, (1 - want[rows]).sum())
            keep = rows[owner]
            mine, square = sums(keep, rate[keep] * want[owner[keep]]), sums(keep, rate[keep] ** 2)
            other = sums(keep, rate[keep]) - mine
            spread = square / (yes + no) - ((mine + other) / (yes + no)) ** 2
            # A bucket that occurs once or twice has hardly any spread; it must not look sharp for that.
            return (mine / yes - other / no) / np.sqrt((np.maximum(spread, 0) + 1e-4) * (1 / yes + 1 / no))

        whole = t_of(np.ones(len(want), dtype=bool))
        alike = sum((t_of(folds == fold) * np.sign(whole) > 1).astype(int) for fold in range(FOLDS))
        score = np.where(alike >= FOLDS - 1, np.abs(whole), 0)
        best = np.argsort(-score, kind="stable")[:FEATURES]
        chosen.append(best[score[best] > 4])
    return np.unique(np.concatenate(chosen))


def _threshold(chance: np.ndarray, want: np.ndarray) -> float:
    """Where F1 is best; the middle of the gap between the scores on both sides."""
    order = np.argsort(-chance, kind="stable")
    hits = np.cumsum(want[order])
    score = 2 * hits / (np.arange(1, len(order) + 1) + max(1, want.sum()))
    last = np.append(np.diff(chance[order]) != 0, True)  # equal scores go together
    best = int(np.argmax(np.where(last, score, -1)))
    below = chance[order][best + 1] if best + 1 < len(order) else 0.0
    return float((chance[order][best] + below) / 2)


def fit_rows(owner: np.ndarray, bucket: np.ndarray, rate: np.ndarray, wants: np.ndarray, folds: np.ndarray) -> tuple:
    """Telling buckets, weights and thresholds from (row, bucket, rate) and a column of 0 and 1 per category."""
    buckets = _telling(owner, bucket, rate, wants, folds)
    lookup = np.full(BUCKETS, -1, dtype=np.int64)
    lookup[buckets] = np.arange(len(buckets))
    keep = lookup[bucket] >= 0
    words = (owner[keep].astype(np.int64), lookup[bucket[keep]], rate[keep].astype(np.float64), len(buckets))
    number, count = wants.shape
    weights, thresholds = np.zeros((count, len(buckets) + count)), np.zeros(count)
    earlier = np.zeros((number, 0))
    for place in range(count):
        rows = Rows(*words, np.concatenate([earlier, np.ones((number, 1))], axis=1))
        want = wants[:, place].astype(np.float64)
        fitted = _fit_linear(rows, want)
        weights[place, : len(buckets) + place] = fitted[:-1]
        weights[place, -1] = fitted[-1]
        chance = np.full(number, want.mean())
        for fold in range(FOLDS):
            own = folds == fold
            if own.any() and not own.all():
                chance[own] = _logistic(rows.only(own).times(_fit_linear(rows.only(~own), want[~own])))
        thresholds[place] = _threshold(chance, want) if 0 < want.sum() < number else 1.1 - 0.6 * want.mean()
        earlier = np.concatenate([earlier, chance[:, None]], axis=1)
    return buckets, weights, thresholds


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], max_rows: int = FIT_ROWS) -> Chain | None:
    """Chain over 0/1 columns of `labels`, in the order given; None if no labelled document is found.

    At most `max_rows` labelled rows, drawn by a hash of doc_id, are used. Rows with a null category or doc_id are
    left out; of several rows of a doc_id the highest value of each category counts.
    """
    complete = labels.dropna(subset=["doc_id", *categories])
    drawn = (
        complete.groupBy("doc_id")
        .agg(*[F.max(name).cast("double").alias(f"y{i}") for i, name in enumerate(categories)])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    values = [f"y{i}" for i in range(len(categories))]
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # max_rows rows of numbers

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for begin, end in runs_of([len(text) for text in texts]):
                owner, bucket, rate = held_rates(texts[begin:end])
                cuts = np.searchsorted(owner, np.arange(end - begin + 1))
                family = families(texts[begin:end])
                part = batch.slice(begin, end - begin)
                cuts = pa.array(cuts, pa.int32())
                buckets = pa.ListArray.from_arrays(cuts, pa.array(bucket, pa.int32()))
                rates = pa.ListArray.from_arrays(cuts, pa.array(rate, pa.float32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[part.column(name) for name in values], pa.array(family, pa.int64()), buckets, rates],
                    names=["doc_id", *values, "family", "buckets", "rates"],
                )

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        lists = table.column("buckets").combine_chunks()
        owner = np.repeat(np.arange(len(table), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
        bucket, rate = lists.flatten().to_numpy(), table.column("rates").combine_chunks().flatten().to_numpy()
        wants = np.stack([table.column(name).to_numpy() for name in values], axis=1)
        folds = table.column("family").to_numpy() % FOLDS
        buckets, weights, thresholds = fit_rows(owner, bucket, rate, wants, folds)
        text = json.dumps([buckets.tolist(), weights.tolist(), thresholds.tolist()])
        return pa.table({"model": pa.array([text])})

    schema = "doc_id bigint, " + "".join(f"{name} double, " for name in values) + "family bigint, buckets array<int>, rates array<float>"
    rows = sample.select("doc_id", "text", *values).mapInArrow(held, schema)
    found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(fitted, "model string").collect()  # one row; max_rows rows in the task
    if not found:
        return None
    buckets, weights, thresholds = json.loads(found[0]["model"])
    return Chain(categories, np.array(buckets, dtype=np.int64), np.array(weights), np.array(thresholds))


def predict(docs: DataFrame, chain: Chain | None, categories: list[str], column: str = "text") -> DataFrame:
    """All columns, with p_<category> and <category> (whether it is over the threshold of the fit) for each category.

    Names that are taken get an underscore. The whole text counts. A null or empty text has no words and gets the
    probability of that; without a chain every probability is 0 and nothing is flagged. Rows that repeat are judged
    alike, and an empty table gives an empty one.
    """
    names = [scratch_name(docs, prefix + name) for name in categories for prefix in ("p_", "")]
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    place = [name.lower() for name in docs.columns].index(column.lower())
    fields = [T.StructField(f"p{i}", T.DoubleType()) for i in range(len(categories))]
    flags = [T.StructField(f"f{i}", T.BooleanType()) for i in range(len(categories))]
    mixed = [field for pair in zip(fields, flags) for field in pair]
    out = T.StructType([*plain.schema.fields, *mixed])
    schema = to_arrow_schema(out)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            texts = byte_texts(batch.column(place))
            for begin, end in runs_of([len(text) for text in texts]):
                if chain is None:
                    chances = np.zeros((end - begin, len(categories)))
                    found = np.zeros(chances.shape, dtype=bool)
                else:
                    chances = chain.probabilities(texts[begin:end])
                    found = chances >= chain.thresholds
                added = [pa.array(x) for i in range(len(categories)) for x in (chances[:, i], found[:, i])]
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, *added], schema=schema)

    return plain.mapInArrow(rows, out).toDF(*docs.columns, *names)


CATEGORIES = ["low_quality", "toxic"]


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with the probabilities of being of low quality and of being toxic, in that order of the chain."""
    columns = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return predict(docs, fit(docs, columns, CATEGORIES), CATEGORIES)
