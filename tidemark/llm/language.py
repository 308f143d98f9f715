"""Language identification by interpolated Kneser-Ney character models.

Characters are lower-cased letters and, for any run of other characters, one gap. N-grams are 60-bit codes of five
symbols, spread over 64 bits and kept in sorted arrays with the log probabilities of all languages beside them. A
text gets the language of least cross-entropy per character. The counts cover all texts that may be learned from;
the model keeps the most frequent n-grams of each language, within `MODEL_CELLS` numbers for each order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import CHUNK_BYTES, HashArray, fresh_path, runs_of, scratch_name, text_sizes

ORDER = 5
BITS = 12
MODEL_CELLS = 1 << 24
MAX_LANGUAGES = 1024
CALIBRATION_ROWS = 8_192
NONE = "und"


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Symbol of each code point: 0 for what is no letter, the point itself below 2048, else one of 2048 classes."""
    points = np.arange(0x110000)
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool)
    return np.where(letter, np.where(points < 2048, points, 2048 + points % 2048), 0).astype(np.uint16)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram codes of texts, the number of them in each text, and the number of letters in each."""
    lowered = [text.lower().encode("utf-32-le", "replace") for text in texts]
    joined = np.frombuffer(b"\0\0\0\0".join([b"", *lowered]), dtype=np.uint32)
    symbols = _symbols()[joined]
    owner = np.repeat(np.arange(len(texts)), [len(text) // 4 + 1 for text in lowered])
    stay = np.ones(len(symbols), dtype=bool)
    stay[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0) | (owner[1:] != owner[:-1])
    symbols, owner = symbols[stay], owner[stay]
    place = np.arange(len(symbols)) + (ORDER - 1) * (owner + 1)
    padded = np.zeros(len(symbols) + (ORDER - 1) * (len(texts) + 1), dtype=np.uint64)
    padded[place] = symbols
    first = np.ones(len(symbols), dtype=bool)
    first[1:] = owner[1:] != owner[:-1]
    place = place[~first]
    codes = np.zeros(len(place), dtype=np.uint64)
    for back in range(ORDER):
        codes |= padded[place - back] << np.uint64(BITS * back)
    sizes = np.bincount(owner[~first], minlength=len(texts))
    letters = np.bincount(owner, weights=symbols != 0, minlength=len(texts)).astype(np.int64)
    return codes, sizes, letters


@dataclass
class Model:
    """Log probabilities of n-grams and log back-off weights of contexts, for all languages side by side."""

    languages: list[str]
    grams: list[HashArray]  # by order, from 1
    scores: list[np.ndarray]
    contexts: list[HashArray]
    weights: list[np.ndarray]
    unseen: np.ndarray
    reject: np.ndarray  # highest cross-entropy accepted, by language
    confidence: np.ndarray  # of the margin, of log length, constant

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), len(self.languages)), dtype=np.float32)
        left = np.arange(len(codes))
        for order in range(ORDER, 0, -1):
            own = codes[left] & np.uint64((1 << BITS * order) - 1)
            at = self.grams[order - 1].find(own)
            hit = at >= 0
            out[left[hit]] += self.scores[order - 1][at[hit]]
            left, own = left[~hit], own[~hit]
            if len(left) == 0:
                return out
            at = self.contexts[order - 1].find(own >> np.uint64(BITS))
            known = at >= 0
            out[left[known]] += self.weights[order - 1][at[known]]
        out[left] += self.unseen
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats per symbol of each text in each language, the numbers of symbols and of letters."""
        codes, sizes, letters = grams(texts)
        total = np.zeros((len(texts), len(self.languages)))
        step = max(1, (1 << 22) // len(self.languages))
        owner = np.repeat(np.arange(len(texts)), sizes)
        for begin in range(0, len(codes), step):
            part = self.log_probabilities(codes[begin : begin + step])
            own = owner[begin : begin + step]
            cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            total[own[cuts]] -= np.add.reduceat(part, cuts, axis=0, dtype=np.float64)
        return total / np.maximum(sizes, 1)[:, None], sizes, letters

    def judge(self, entropies: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language, its probability of being right, and whether it is accepted."""
        best = entropies.argmin(axis=1)
        least = entropies[np.arange(len(best)), best]
        score = 1 / (1 + np.exp(-np.clip(_features(entropies, sizes) @ self.confidence, -35, 35)))
        return best, score, least <= self.reject[best]


def _features(entropies: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    if entropies.shape[1] == 1:
        margin = np.full(len(entropies), 10.0)
    else:
        two = np.partition(entropies, 1, axis=1)[:, :2]
        margin = np.minimum((two[:, 1] - two[:, 0]) * np.sqrt(np.maximum(sizes, 1)), 10.0)
    return np.stack([margin, np.log1p(sizes) / 10, np.ones(len(margin))], axis=1)


def kneser_ney(tables: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Model from (codes, counts) of the highest order for each language."""
    languages = sorted(tables)
    share = 1 << BITS
    union = [np.unique(tables[languages[0]][0][:0]) for _ in range(ORDER)]
    levels: dict[str, list[tuple]] = {}
    for language in languages:
        codes, counts = tables[language]
        order_of = np.argsort(codes)
        codes, counts = codes[order_of], counts[order_of].astype(np.float64)
        own = []
        for order in range(ORDER, 0, -1):
            once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
            discount = once / (once + 2 * twice) if once and twice else 0.5
            contexts, first, kinds = np.unique(codes >> np.uint64(BITS), return_index=True, return_counts=True)
            totals = np.add.reduceat(counts, first)
            own.append((codes, np.maximum(counts - discount, 0) / np.repeat(totals, kinds), contexts, discount * kinds / totals))
            union[order - 1] = np.union1d(union[order - 1], codes)
            # Lower orders count in how many contexts an n-gram goes on, not how often it occurs.
            codes, counts = np.unique(codes & np.uint64((1 << BITS * (order - 1)) - 1), return_counts=True)
            counts = counts.astype(np.float64)
        levels[language] = own[::-1]
    hashes, scores, contexts, weights = [], [], [], []
    lower: list[np.ndarray] = []
    for order in range(1, ORDER + 1):
        codes = union[order - 1]
        context = np.unique(codes >> np.uint64(BITS))
        chance = np.zeros((len(codes), len(languages)))
        back = np.ones((len(context), len(languages)))
        for column, language in enumerate(languages):
            own, parts, own_contexts, own_weights = levels[language][order - 1]
            chance[np.searchsorted(codes, own), column] = parts
            back[np.searchsorted(context, own_contexts), column] = own_weights
        if order == 1:
            below = np.full((len(codes), len(languages)), 1 / share)
        else:
            below = lower[-1][np.searchsorted(union[order - 2], codes & np.uint64((1 << BITS * (order - 1)) - 1))]
        chance += back[np.searchsorted(context, codes >> np.uint64(BITS))] * below
        lower.append(chance)
        own_hashes, own_contexts = HashArray(codes), HashArray(context)
        hashes.append(own_hashes)
        scores.append(np.log(chance[own_hashes.order]).astype(np.float32))
        contexts.append(own_contexts)
        weights.append(np.log(np.maximum(back[own_contexts.order], 1e-9)).astype(np.float32))
    own = len(languages)
    return Model(
        languages, hashes, scores, contexts, weights, np.full(own, -np.log(share), dtype=np.float32),
        np.full(own, np.inf), np.array([1.0, 0.0, 0.0]),
    )


def calibrate(model: Model, entropies: np.ndarray, sizes: np.ndarray, languages: list[str]) -> None:
    """Fit confidence and rejection on texts that were not counted.

    Confidence is a logistic regression of being right on margin and length. A text is rejected if its
    cross-entropy is over the mean of its language by more than four deviations.
    """
    place = {language: i for i, language in enumerate(model.languages)}
    want = np.array([place.get(language, -1) for language in languages])
    entropies, sizes, want = entropies[want >= 0], sizes[want >= 0], want[want >= 0]
    if len(want) < 8:
        return
    best, least = entropies.argmin(axis=1), entropies.min(axis=1)
    right, rows = (best == want).astype(np.float64), _features(entropies, sizes)
    # A row that is right and one that is wrong at no margin keep the fit finite where all is right.
    rows = np.concatenate([rows, [[0, 0, 1.0], [0, 0, 1.0]]])
    right = np.concatenate([right, [0.0, 1.0]])
    weights = np.zeros(3)
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (right - chance) - 1e-2 * weights
        bend = (rows * (chance * (1 - chance))[:, None]).T @ rows + 1e-2 * np.eye(3)
        weights += np.linalg.solve(bend, slope)
    model.confidence = weights
    for language in range(len(model.languages)):
        own = least[(best == language) & (want == language)]
        if len(own) >= 8:
            model.reject[language] = own.mean() + 4 * own.std()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, gram) of a run of texts; rows are (lang, text)."""
    for batch in batches:
        sizes = text_sizes(batch.column(1))
        for begin, end in runs_of(sizes, 4 * CHUNK_BYTES):
            by_language: dict[str, list[str]] = {}
            part = batch.slice(begin, end - begin)
            for language, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                by_language.setdefault(language, []).append(text)
            for language, texts in by_language.items():
                codes, counts = np.unique(grams(texts)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(counts)],
                    names=["lang", "gram", "count"],
                )


def train(labelled: DataFrame, calibration: DataFrame, model_cells: int = MODEL_CELLS) -> Model | None:
    """Model of the languages in (lang, text) rows; None if there are none.

    All texts of `labelled` are counted. `calibration` holds other texts; the figures of at most
    `CALIBRATION_ROWS` of them, drawn by hash, are used. Beyond `MAX_LANGUAGES` languages, which are no languages, it refuses.
    """
    spark = labelled.sparkSession
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    path = fresh_path(spark, "language-counts")
    counts = known.mapInArrow(_count, "lang string, gram bigint, count bigint").groupBy("lang", "gram").agg(F.sum("count").alias("count"))
    counts.withColumn("class", F.floor(F.log2("count") * 8).cast("int")).write.parquet(path)
    table = spark.read.schema("lang string, gram bigint, count bigint, class int").parquet(path)
    if table.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang")
    classes: dict[str, list[tuple[int, int]]] = {}
    for row in table.groupBy("lang", "class").count().collect():
        classes.setdefault(row["lang"], []).append((row["class"], row["count"]))
    if not classes:
        return None
    share = max(1, model_cells // len(classes) ** 2)
    least = {}
    for language, found in classes.items():
        held = 0
        for number, size in sorted(found, reverse=True):
            held += size
            if held > share:
                break
            least[language] = number
    keep = F.lit(False)
    for language, number in least.items():
        keep = keep | ((F.col("lang") == language) & (F.col("class") >= number))
    rows = table.where(keep).select("lang", "gram", "count").toArrow()  # at most model_cells / languages rows
    names = np.array(rows["lang"].to_pylist(), dtype=object)
    codes, sizes = rows["gram"].to_numpy().astype(np.uint64), rows["count"].to_numpy()
    model = kneser_ney({language: (codes[names == language], sizes[names == language]) for language in least})
    shared = spark.sparkContext.broadcast(model)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in runs_of(text_sizes(batch.column(2))):
                part = batch.slice(begin, end - begin)
                found, symbols, letters = shared.value.cross_entropies(part.column(2).to_pylist())
                some = pa.array(letters > 0)
                columns = [part.column(0), part.column(1), pa.array(found.tolist()), pa.array(symbols, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["place", "lang", "entropies", "symbols"]).filter(some)

    spare = calibration.where("lang IS NOT NULL AND text IS NOT NULL").select(F.xxhash64("text").alias("place"), "lang", "text")
    judged = spare.mapInArrow(entropies, "place bigint, lang string, entropies array<double>, symbols bigint")
    sample = judged.orderBy("place", "lang").limit(CALIBRATION_ROWS).collect()
    calibrate(
        model,
        np.array([row["entropies"] for row in sample]).reshape(len(sample), len(model.languages)),
        np.array([row["symbols"] for row in sample]),
        [row["lang"] for row in sample],
    )
    return model


def predict(docs: DataFrame, model: Model | None, column: str = "text") -> DataFrame:
    """All columns, with `lang_pred`, `score` (0 to 1) and `accepted` (under other names if those are taken).

    The whole text is scored. A text that is null or has no letter is `und`, with score 0 and not accepted; so is
    every text if no language was learned. Other texts get a learned language even where it is not accepted. Of
    equal languages the first by name is taken. Rows that repeat are judged alike; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = [scratch_name(docs, name) for name in ("lang_pred", "score", "accepted")]
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    place = [name.lower() for name in docs.columns].index(column.lower())
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    out = T.StructType([*plain.schema.fields, *(T.StructField(f"p{i}", kind) for i, kind in enumerate(kinds))])
    schema = to_arrow_schema(out)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            sizes = text_sizes(batch.column(place))
            for begin, end in runs_of(sizes):
                part = batch.slice(begin, end - begin)
                texts = [text or "" for text in part.column(place).to_pylist()]
                if model is None:
                    found, scores, accepted = [NONE] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
                else:
                    entropies, symbols, letters = model.cross_entropies(texts)
                    best, scores, accepted = model.judge(entropies, symbols)
                    some = letters > 0
                    found = [model.languages[i] if yes else NONE for i, yes in zip(best, some)]
                    scores, accepted = np.where(some, scores, 0.0), accepted & some
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.string()), pa.array(scores), pa.array(accepted)], schema=schema
                )

    return plain.mapInArrow(rows, out).toDF(*docs.columns, *names)


def held_out(doc_id: Column) -> Column:
    """Documents not to learn from; a null doc_id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """`predict` with a model learned from the documents that have a language and are not held out.

    A sixteenth of them is not counted but used for calibration. Adds `held_out` too.
    """
    learn = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    spare = F.pmod(F.crc32(F.concat(F.lit("spare"), F.col("doc_id").cast("string")).cast("binary")), F.lit(16)) == 0
    model = train(learn.where(~spare), learn.where(spare))
    flag = scratch_name(docs, "held_out")
    return predict(docs, model).withColumn(flag, held_out(F.col("doc_id")))
