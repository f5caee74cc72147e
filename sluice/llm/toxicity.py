"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Toxic and ordinary labelled texts have counts of their own for the last character of five;
both smooth them with one shared distribution, the Kneser-Ney continuation counts of all
training text. So an expression too rare to judge scores nearly alike under both.

The alphabet has 32 symbols, hence a model has at most 32^5 cells, whatever the corpus:
that bounds what reaches the driver, and a model is broadcast as one byte a cell (32 MB).
All labelled text is counted.

A text is judged by the difference of its log-likelihoods under both models, divided by
the length: for the whole text, and for its most toxic stretch of a few words, since a
long text may be toxic in few places. A logistic curve over the two makes the score. It is
fitted to texts that were left out of the counts they are judged by.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import blocks, text_bytes, texts

ORDER, BITS = 5, 5
SYMBOLS = 1 << BITS
CONTEXTS = SYMBOLS ** (ORDER - 1)
CELLS = CONTEXTS * SYMBOLS
DISCOUNT = 0.75
STRETCH = 16  # characters
FOLDS = 2
# Log-ratios are kept in steps of this size, in one byte.
STEP = 1 / 16
# Labels are joined by broadcast up to this many rows (about 30 MB), beyond by a shuffle.
BROADCAST_LABELS = 1_000_000
# The logistic curve is fitted to a grid of counts of this many cells a side.
GRID = 96
RANGES = ((-0.4, 0.8), (-1.0, 5.0))
RIDGE = 1e-2

# Letters whatever their case, digits as one, the later bytes of other characters by two
# bits; everything else separates words and is symbol 0. First bytes are left out.
SYMBOL = np.array(
    [
        b - 64 if 65 <= b <= 90 else b - 96 if 97 <= b <= 122 else 27 if 48 <= b <= 57 else 28 + b % 4 if b > 127 else 0
        for b in range(256)
    ],
    np.int32,
)
FIRST_BYTE = np.arange(256) >= 0xC0


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt from."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, offsets) of texts."""
    kept = ~FIRST_BYTE[data]
    places = np.concatenate([[0], np.cumsum(kept)])
    return SYMBOL[data[kept]], places[offsets]


def cells(symbol: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place its cell (symbol and the four before it, within the word), and whether it counts."""
    starts = offsets[:-1][offsets[:-1] < len(symbol)]
    code, before, inside = symbol.copy(), symbol, None
    counts = symbol > 0
    for k in range(1, ORDER):
        shifted = np.zeros_like(symbol)
        shifted[1:] = before[:-1]
        shifted[starts] = 0
        if inside is None:
            counts |= shifted > 0
        else:
            shifted[~inside] = 0  # nothing from before the word's beginning
        inside = shifted > 0
        code |= shifted << (BITS * k)
        before = shifted
    return code, counts


def continuation(kinds: np.ndarray) -> np.ndarray:
    """Kneser-Ney probabilities of the last axis, from numbers of different contexts."""
    seen = kinds > 0
    total = kinds.sum(-1, keepdims=True)
    lower = continuation(seen.sum(0)) if kinds.ndim > 1 else np.full(SYMBOLS, 1 / SYMBOLS)
    left = DISCOUNT * seen.sum(-1, keepdims=True) * lower
    return np.where(total > 0, (np.maximum(kinds - DISCOUNT, 0) + left) / np.maximum(total, 1), lower)


def log_ratios(cell: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """log P(last symbol | toxic) - log P(... | ordinary) of all cells, in steps.

    `cell` lists the cells that were seen at all, the counts are of these.
    """
    used = (toxic + ordinary) > 0
    cell, toxic, ordinary = cell[used], toxic[used], ordinary[used]
    context, ending = cell >> BITS, cell & (CONTEXTS - 1)
    kinds = np.bincount(ending, minlength=CONTEXTS).reshape((SYMBOLS,) * (ORDER - 1))
    shared = continuation(kinds).reshape(-1)[ending]
    unseen, logs = [], []
    for counts in (toxic, ordinary):
        total = np.bincount(context, counts, CONTEXTS)
        left = DISCOUNT * np.bincount(context, counts > 0, CONTEXTS)
        with np.errstate(invalid="ignore", divide="ignore"):
            backoff = np.where(total > 0, left / total, 1.0)
        unseen.append(np.log(backoff))
        own = np.maximum(counts - DISCOUNT, 0) / np.maximum(total[context], 1)
        logs.append(np.log(own + backoff[context] * shared))
    steps = lambda x: np.clip(np.rint(x / STEP), -127, 127).astype(np.int8)
    # What toxic text never has is no sign of it, however few contexts that text has.
    ratios = np.repeat(steps(np.minimum(unseen[0] - unseen[1], 0)), SYMBOLS)
    known = logs[0] - logs[1]
    ratios[cell] = steps(np.where(toxic > 0, known, np.minimum(known, 0)))
    return ratios


def judged(data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the mean log-ratio of the whole, and of its most toxic stretch; 0 if empty."""
    symbol, offsets = symbols(data, offsets)
    code, counts = cells(symbol, offsets)
    value = np.where(counts, ratios[code], np.int8(0))
    sums = np.concatenate([[0.0], np.cumsum(value, dtype=np.int64) * STEP])
    size = np.diff(offsets)
    whole = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(size, 1)
    peak = np.zeros(len(size))
    if len(symbol) >= STRETCH:
        ends = sums[STRETCH:] - sums[:-STRETCH]
        # Only stretches within one text: those that begin early enough before its end.
        begins = np.arange(len(ends))
        own = np.repeat(np.arange(len(size)), size)[: len(ends)]
        ends[begins + STRETCH > offsets[1:][own]] = -np.inf
        long = np.flatnonzero(size >= STRETCH)
        if long.size:
            edges = np.stack([offsets[:-1][long], offsets[1:][long] - STRETCH + 1], 1).ravel()
            edges = edges[:-1] if edges[-1] >= len(ends) else edges
            peak[long] = np.maximum.reduceat(ends, edges)[::2]
    short = size < STRETCH
    peak[short] = (sums[offsets[1:]] - sums[offsets[:-1]])[short]
    return whole, peak / STRETCH


@dataclass
class Model:
    ratios: np.ndarray
    weights: np.ndarray  # intercept, whole, stretch

    def score(self, whole: np.ndarray, peak: np.ndarray) -> np.ndarray:
        z = self.weights[0] + self.weights[1] * whole + self.weights[2] * peak
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, fold) of labelled documents that are not held out."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    return texts(docs).join(known, F.col("doc_id") == F.col("_id")).select("text", "toxic", fold)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All counts of a task's texts, cell by cell."""
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(place, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        kind = np.asarray(batch.column("toxic")).astype(np.int64) * FOLDS + np.asarray(batch.column("fold"))
        for a, b in blocks(offsets):
            symbol, at = symbols(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            code, used = cells(symbol, at)
            kinds = np.repeat(kind[a:b], np.diff(at))
            held.append(np.unique(kinds[used] * CELLS + code[used], return_counts=True))
            if len(held) > 8:
                held[:] = [merged()]
    keys, n = merged()
    for i in range(0, len(keys), 1 << 16):
        part = keys[i : i + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((part // CELLS).astype(np.int32)),
                pa.array((part % CELLS).astype(np.int32)),
                pa.array(n[i : i + (1 << 16)]),
            ],
            names=["kind", "cell", "n"],
        )


def _fit_curve(grid: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method on counts[toxic, whole, stretch]."""
    axes = [low + (np.arange(GRID) + 0.5) * (high - low) / GRID for low, high in RANGES]
    x1, x2 = np.meshgrid(*axes, indexing="ij")
    x = np.stack([np.ones(GRID * GRID), x1.ravel(), x2.ravel()], 1)
    ordinary, toxic = grid[0].ravel().astype(float), grid[1].ravel().astype(float)
    n = ordinary + toxic
    weights = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -60, 60)))
        slope = x.T @ (toxic - n * p) - RIDGE * weights
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(3)
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 5.0 / np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of all labelled texts that are not held out; None if a class has none."""
    spark = docs.sparkSession
    training = _training(docs, labels)
    found = (
        training.mapInArrow(_count, "kind int, cell int, n bigint")
        .groupBy("kind", "cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # at most CELLS rows a class and fold, in practice those of real words
    )
    cell, place = np.unique(np.asarray(found["cell"]), return_inverse=True)
    counts = np.zeros((2 * FOLDS, len(cell)), np.int64)
    counts[np.asarray(found["kind"]), place] = np.asarray(found["n"])
    by_class = counts.reshape(2, FOLDS, len(cell))
    ordinary, toxic = by_class.sum(1)
    if not ordinary.sum() or not toxic.sum():
        return None
    apart = [log_ratios(cell, toxic - by_class[1, f], ordinary - by_class[0, f]) for f in range(FOLDS)]
    shared = spark.sparkContext.broadcast(apart)

    def grid(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, GRID * GRID), np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            toxic_, fold = np.asarray(batch.column("toxic")), np.asarray(batch.column("fold"))
            for a, b in blocks(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                for f in range(FOLDS):
                    rows = fold[a:b] == f
                    if rows.any():
                        places = []
                        for x, (low, high) in zip(judged(part, at, shared.value[f]), RANGES):
                            places.append(np.clip((x - low) * GRID / (high - low), 0, GRID - 1).astype(int))
                        place = (places[0] * GRID + places[1])[rows]
                        np.add.at(sums, (toxic_[a:b][rows], place), 1)
        kind_, place = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind_.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(sums[kind_, place])],
            names=["kind", "place", "n"],
        )

    cells_ = (
        training.mapInArrow(grid, "kind int, place int, n bigint").groupBy("kind", "place").agg(F.sum("n").alias("n"))
    ).toArrow()
    sums = np.zeros((2, GRID * GRID), np.int64)
    sums[np.asarray(cells_["kind"]), np.asarray(cells_["place"])] = np.asarray(cells_["n"])
    shared.unpersist()
    return Model(log_ratios(cell, toxic, ordinary), _fit_curve(sums))


def _sent(spark: SparkSession, model: Model | None) -> Broadcast:
    """The model's arrays, broadcast: workers need not know this module to read them."""
    return spark.sparkContext.broadcast((model.ratios, model.weights) if model else ())


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted.

    `labels` has (doc_id, toxic 0/1); only rows whose crc32(doc_id as text) mod 5 is not 0
    teach, several rows of one document count as toxic if one says so, null and other
    values teach nothing. `score` is a probability that the label is 1, `predicted` is 1
    from 0.5 on. The score depends on nothing but the text: equal texts score alike, null
    as empty. Without labelled text of both classes every score is 0. An empty table gives
    no rows, other columns are ignored.
    """
    model = _sent(docs.sparkSession, train(docs, labels))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*model.value) if model.value else None
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            scores = [np.zeros(0)]
            for a, b in blocks(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                scores.append(own.score(*judged(part, at, own.ratios)) if own else np.zeros(b - a))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(np.concatenate(scores))],
                names=["doc_id", "held_out", "score"],
            )

    known = texts(docs).withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    scored = known.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` whose text is not predicted toxic, with all their columns."""
    model = _sent(docs.sparkSession, train(docs, labels))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*model.value) if model.value else None
        for batch in batches:
            if own:
                data, offsets = text_bytes(batch.column("text").fill_null(""))
                fine = []
                for a, b in blocks(offsets):
                    part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                    fine.append(own.score(*judged(part, at, own.ratios)) < 0.5)
                batch = batch.filter(pa.array(np.concatenate(fine) if fine else np.zeros(0, bool)))
            yield batch

    return docs.mapInArrow(run, docs.schema)
