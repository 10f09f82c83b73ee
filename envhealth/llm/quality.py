"""Quality grades by ordinal regression.

A cumulative-link model: one weight per hashed feature of the text, shared by all grades, gives
a score s, and P(grade <= k) = 1 / (1 + exp(s - threshold_k)) with rising thresholds. It is fitted
to a bounded sample of rated documents by gradients that the executors sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import saved, small_batches
from .words import ALNUM, LOWER, NOT_SPACE, Texts, find_words, gram_hashes, mixed, pieces

FEATURE_BITS = 40
#: The fit takes about so many rated documents, in so many parts.
SAMPLE, PARTS = 20_000, 6
#: Features in a smaller share of the sample, or whose texts' mean grade is not so many standard
#: errors off, get no weight: they would only be learned by heart. The second number of errors is
#: for a full sample, of which the same effect makes more errors; a smaller one takes less.
LEAST_SHARE, LEAST_ERRORS, FULL_ERRORS = 0.001, 5.0, 12.0
STEPS, RATE, DECAY, SHRINK = 80, 0.6, 0.9, 1e-5
#: Least probability of the highest grade with which a document is kept. Held-out ratings gave it:
#: it lets go of about 3 good documents in 1,000.
KEEP = 0.8
#: Weight of a share of all tokens, next to 1 for a word that occurs.
SHARE_WEIGHT = 8.0
#: Slots of the constant, of words in capitals, of words said twice, of word triples said before.
BIAS, LOUD, TWICE, AGAIN = range(4)


def text_features(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots and values of each text of a piece that is not lower-cased yet.

    Words that occur (A-Z lower-cased) count 1. The share of each run of other characters, and
    of words in capitals, among all tokens shows layouts rather than topics.
    """
    lowered = Texts(texts.first, LOWER[texts.data], texts.offsets)
    words = find_words(lowered, ALNUM)
    marks = find_words(texts, NOT_SPACE & ~ALNUM & ~((np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)))
    capital = np.concatenate([[0], np.cumsum(texts.data != lowered.data)])
    in_capitals = capital[words.ends] - capital[words.starts] >= np.maximum(2, words.ends - words.starts)
    shift = np.uint64(64 - FEATURE_BITS)
    word_slots = (words.hashes >> shift).astype(np.int64)
    mark_slots = (mixed(marks.hashes) >> shift).astype(np.int64)
    for i in range(len(texts.offsets) - 1):
        a, b = words.bounds[i], words.bounds[i + 1]
        c, d = marks.bounds[i], marks.bounds[i + 1]
        present = np.unique(word_slots[a:b])
        runs, counts = np.unique(mark_slots[c:d], return_counts=True)
        total = max(1, b - a + d - c)
        slots = np.concatenate([present, runs, [BIAS, LOUD, TWICE, AGAIN]])
        loud = np.count_nonzero(in_capitals[a:b])
        own = words.hashes[a:b]
        twice = np.count_nonzero(own[1:] == own[:-1])
        triples = gram_hashes(own, 3)
        again = len(triples) - len(np.unique(triples))
        shares = np.concatenate([counts, [loud, twice, again]]) * (SHARE_WEIGHT / total)
        values = np.concatenate([np.ones(len(present)), shares[: len(runs)], [1.0], shares[len(runs) :]])
        yield slots, values.astype(np.float32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [x for texts in pieces(batch.column(1), lower=False) for x in text_features(texts)]
        columns = [batch.column(0), pa.array([x[0] for x in found], pa.list_(pa.int64())), pa.array([x[1] for x in found], pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["grade", "slots", "values"])


@dataclass
class Model:
    slots: np.ndarray  # those with a weight, in order
    weights: np.ndarray
    thresholds: np.ndarray

    def find(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which slots have a weight, and the places of those that have."""
        at = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
        known = self.slots[at] == slots
        return known, at[known]

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and each k but the highest grade."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -50, 50)))


def _narrowed(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Slots as places in the model; those without a weight go."""
    for batch in batches:
        slots, values, at = (batch.column(1).flatten(), batch.column(2).flatten(), batch.column(1).offsets.to_numpy())
        known, places = model.value.find(slots.to_numpy())
        bounds = pa.array(np.concatenate([[0], np.cumsum(known)])[at - at[0]].astype(np.int32))
        columns = [pa.array(places), values.filter(pa.array(known))]
        lists = [pa.ListArray.from_arrays(bounds, c) for c in columns]
        yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=batch.schema.names)


def _gradient(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m: Model = model.value
    k = len(m.thresholds)
    grad, bends = np.zeros(len(m.weights), np.float32), np.zeros(k)
    loss, n = 0.0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        grade = batch.column(0).to_numpy()
        slots, values = (batch.column(i).flatten().to_numpy() for i in (1, 2))
        at = batch.column(1).offsets.to_numpy()
        at = at - at[0]
        scores = np.add.reduceat(m.weights[slots] * values, at[:-1])  # no text is without a feature
        below = np.column_stack([np.zeros(len(grade)), 1 - m.above(scores), np.ones(len(grade))])
        rows = np.arange(len(grade))
        high, low = below[rows, grade + 1], below[rows, grade]
        chance = np.maximum(high - low, 1e-9)
        slope = (high + low - 1).astype(np.float32)
        np.add.at(grad, slots, np.repeat(slope, np.diff(at)) * values)
        np.add.at(bends, np.minimum(grade, k - 1), np.where(grade < k, high * (1 - high) / chance, 0))
        np.add.at(bends, np.maximum(grade - 1, 0), -np.where(grade > 0, low * (1 - low) / chance, 0))
        loss -= float(np.log(chance).sum())
        n += len(grade)
    row = [[grad.tobytes()], [bends.tolist()], [loss], [n]]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=["grad", "bends", "loss", "n"])


def train(rated: DataFrame, docs: DataFrame, grades: int) -> Model:
    """A model from `rated(doc_id, grade)`, grades 0 to `grades` - 1, and `docs(doc_id, text)`.

    About SAMPLE rated rows are used, chosen by a hash of doc_id, so that what is broadcast and
    learned from is bounded. Rows with a null id or grade are left out. Without any, every weight
    is 0 and every grade is as likely.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rated = rated.select("doc_id", F.col("grade").cast("int").alias("grade")).where("doc_id is not null and grade is not null")
    n = rated.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
    chosen = rated.where(draw < min(1.0, SAMPLE / max(1, n)))
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("grade", "text")
    made = joined.mapInArrow(_features, "grade int, slots array<long>, values array<float>")
    found = saved(made, "features")
    used = found.count()
    mean, spread = found.agg(F.avg("grade"), F.stddev_pop("grade")).first()
    occurs = found.select("grade", F.explode("slots").alias("slot")).groupBy("slot")
    occurs = occurs.agg(F.count("grade").alias("n"), F.avg("grade").alias("own"))
    errors = max(LEAST_ERRORS, FULL_ERRORS * (used / SAMPLE) ** 0.5)
    off = F.abs(F.col("own") - (mean or 0.0)) * F.sqrt("n") >= errors * (spread or 0.0)
    # At most a text's mean number of features divided by LEAST_SHARE remain.
    common = occurs.where((F.col("n") >= LEAST_SHARE * used) & off).select("slot").toArrow().column(0).to_numpy()
    slots = np.union1d(common, [BIAS, LOUD, TWICE, AGAIN]).astype(np.int64)
    model = Model(slots, np.zeros(len(slots), np.float32), np.linspace(-1.0, 1.0, grades - 1))
    narrow = partial(_narrowed, model=spark.sparkContext.broadcast(model))
    sample = saved(found.mapInArrow(narrow, found.schema).repartition(PARTS), "sample")
    speed, size = np.zeros(len(slots), np.float32), np.zeros(len(slots), np.float32)
    counts = sample.groupBy("grade").count().collect()
    share = np.zeros(grades)
    for grade, count in counts:
        share[grade] = count
    if share.sum():
        below = np.clip(np.cumsum(share)[:-1] / share.sum(), 0.01, 0.99)
        model.thresholds = np.maximum.accumulate(np.log(below / (1 - below)) + np.arange(grades - 1) * 1e-3)
    total = max(1.0, share.sum())
    for step in range(1, STEPS + 1 if share.sum() else 1):
        shared = spark.sparkContext.broadcast(model)
        parts = sample.mapInArrow(partial(_gradient, model=shared), "grad binary, bends array<double>, loss double, n long")
        grad, bends = np.zeros(len(slots), np.float32), np.zeros(grades - 1)
        for row in parts.collect():  # PARTS rows of one vector each
            grad += np.frombuffer(row[0], np.float32)
            bends += row[1]
        shared.destroy()
        grad = grad / total - SHRINK * model.weights
        speed = DECAY * speed + (1 - DECAY) * grad
        size = 0.98 * size + 0.02 * grad**2
        move = speed / (1 - DECAY**step) / (np.sqrt(size / (1 - 0.98**step)) + 1e-5)
        model = Model(slots, model.weights + RATE * move / np.sqrt(step), model.thresholds + bends / total)
        model.thresholds = np.maximum.accumulate(model.thresholds + np.arange(grades - 1) * 1e-6)
    return model


def _graded(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m: Model = model.value
    for batch in batches:
        scores = []
        for texts in pieces(batch.column(1), lower=False):
            for slots, values in text_features(texts):
                known, places = m.find(slots)
                scores.append(float(m.weights[places] @ values[known]))
        above = m.above(np.array(scores, float))
        columns = [batch.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, -1])]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "expected_grade", "tail_probability"])


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """`(doc_id, expected_grade, tail_probability)`, one row per row of `docs(doc_id, text)`.

    The second is the mean grade, the third the probability of the highest grade. A null text is
    an empty one and gets the grade of a text without features. Repeated rows are graded alike.
    Other columns are ignored; no rows, no result rows.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"doc_id {id_type}, expected_grade double, tail_probability double"
    return docs.select("doc_id", "text").mapInArrow(partial(_graded, model=shared), schema)


def _selected(batches: Iterator[pa.RecordBatch], model, text_at: int, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pair = pa.RecordBatch.from_arrays([batch.column(text_at)] * 2, names=["doc_id", "text"])
        for graded in _graded(iter([pair]), model):
            yield batch.filter(pa.array(graded.column(2).to_numpy() >= least))


def selected(docs: DataFrame, model: Model, least: float = KEEP) -> DataFrame:
    """The rows of `docs` whose probability of the highest grade is at least `least`, all columns."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run = partial(_selected, model=shared, text_at=docs.columns.index("text"), least=least)
    return docs.mapInArrow(run, docs.schema)
