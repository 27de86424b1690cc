"""Quality scores by positive-unlabelled learning.

Known good texts are the trusted positives; every text of the corpus, labelled or not, is the
unlabelled side, and labels of bad texts are never read. The share of good texts in the corpus,
the class prior, is estimated first: a classifier is trained to tell one half of the positives
from the corpus, and the prior is the smallest ratio of the corpus' to the other half's share of
scores above a threshold, with a margin for small counts. The quality classifier then minimises
the non-negative unbiased risk: the prior times the positives' loss, plus the corpus' loss as
negatives less the part of it that the positives among it explain, a difference that may not
fall below zero. Both classifiers are linear over measures of a text's make-up and thresholds of
them at quantiles of the corpus, and every step sums over all rows on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.llm.common import cut, scratch_names
from freightmill.llm.text_measures import MEASURES, measured_batches

QUANTILES = (0.01, 0.03, 0.06, 0.12, 0.25, 0.5, 0.75, 0.88, 0.94, 0.97, 0.99)
#: Cells of the score histogram that the class prior is read from.
CELLS = 4096


def is_held_out(id_column: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Scales:
    """Middle and spread of each measure over the corpus, and the thresholds of it."""

    middle: np.ndarray
    spread: np.ndarray
    cuts: np.ndarray

    def expand(self, measures: np.ndarray) -> np.ndarray:
        """Intercept, standardised measures, and for each threshold whether it is reached."""
        plain = np.clip((measures - self.middle) / self.spread, -6, 6)
        above = measures[:, :, None] >= self.cuts
        ones = np.ones((len(measures), 1))
        return np.concatenate([ones, plain, above.reshape(len(measures), -1)], axis=1)

    @property
    def width(self) -> int:
        return 1 + self.cuts.shape[0] * (1 + self.cuts.shape[1])


@dataclass(frozen=True)
class QualityModel:
    """Scores a text by itself, whatever else its row holds."""

    scales: Scales
    weight: np.ndarray
    prior: float

    def score(self, measures: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scales.expand(measures) @ self.weight)


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _measures(docs: DataFrame, text: str, kept: list[Column]) -> DataFrame:
    """Columns ``kept`` and the text's measures; one narrow pass over whole texts."""
    (hidden,) = scratch_names(docs, "text")
    source = docs.select(F.col(f"`{text}`").cast("string").alias(hidden), *kept)
    schema = T.StructType(
        [*source.schema.fields[1:], T.StructField("measures", T.ArrayType(T.DoubleType()))]
    )

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = list(measured_batches(batch.column(0)))
            flat = np.concatenate(found) if found else np.zeros((0, len(MEASURES)))
            bounds = pa.array(np.arange(len(flat) + 1) * len(MEASURES), pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists], names=schema.names)

    return source.mapInArrow(measure, schema)


def _training_rows(
    docs: DataFrame, labels: DataFrame, text: str, id_column: str, label: str
) -> DataFrame:
    """half, measures of all rows; half: 0 or 1 for trusted positives, NULL for all others."""
    marks = (
        labels.where(~is_held_out(F.col(f"`{id_column}`")) & F.col(f"`{id_column}`").isNotNull())
        .groupBy(F.col(f"`{id_column}`").alias("labelled"))
        .agg(F.min(F.col(f"`{label}`").cast("int")).alias("good"))
        .where("good > 0")
        .select("labelled", F.pmod(F.xxhash64("labelled"), F.lit(2)).cast("int").alias("half"))
    )
    rows = _measures(docs, text, [F.col(f"`{id_column}`").alias("labelled")])
    return rows.join(marks, "labelled", "left").select("half", "measures")


def _scales(rows: DataFrame) -> tuple[int, Scales]:
    wanted = F.array(*[F.lit(q) for q in QUANTILES])
    sums = [F.count("*").alias("n")]
    for k in range(len(MEASURES)):
        value = F.get("measures", F.lit(k))
        sums += [F.avg(value), F.stddev_pop(value), F.percentile_approx(value, wanted, 1000)]
    n, *found = rows.agg(*sums).first()
    if not n:
        flat = np.zeros(len(MEASURES))
        return 0, Scales(flat, flat + 1, np.zeros((len(MEASURES), len(QUANTILES))))
    spread = np.array(found[1::3], float)
    return n, Scales(
        np.array(found[0::3], float), np.where(spread > 1e-9, spread, 1.0), np.array(found[2::3])
    )


@dataclass
class _Losses:
    """Weighted losses of the rows as positives and as negatives, with slopes and curvature."""

    positive: float
    negative: float
    positive_slope: np.ndarray
    negative_slope: np.ndarray
    curvature: np.ndarray


def _losses(rows: DataFrame, scales: Scales, weight: np.ndarray, as_good: dict, as_bad: dict):
    """Logistic losses over all rows. ``as_good`` and ``as_bad`` give a row's weight on either
    side by its half (-1: no trusted positive). Comes back as one number for each sum."""
    width = scales.width
    upper = np.triu_indices(width)

    def add_up(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(2 + 2 * width + len(upper[0]))
        for batch in batches:
            if not batch.num_rows:
                continue
            half = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            measures = batch.column(1).flatten().to_numpy().reshape(len(half), -1)
            x = scales.expand(measures)
            margin = x @ weight
            chance = _sigmoid(margin)
            good, bad = (
                np.select([half == 0, half == 1], [side[0], side[1]], side[-1])
                for side in (as_good, as_bad)
            )
            loss = np.logaddexp(0, margin)
            curve = (x * ((good + bad) * chance * (1 - chance))[:, None]).T @ x
            total += np.concatenate(
                [
                    [(good * (loss - margin)).sum(), (bad * loss).sum()],
                    -(good * (1 - chance)) @ x,
                    (bad * chance) @ x,
                    curve[upper],
                ]
            )
        place = pa.array(np.arange(len(total), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([place, pa.array(total)], names=["place", "value"])

    parts = rows.mapInArrow(add_up, "place int, value double")
    # As many rows as the model has pairs of features.
    total = np.zeros(2 + 2 * width + len(upper[0]))
    for place, value in parts.groupBy("place").agg(F.sum("value")).collect():
        total[place] = value
    curvature = np.zeros((width, width))
    curvature[upper] = total[2 + 2 * width :]
    curvature = np.triu(curvature) + np.triu(curvature, 1).T
    return _Losses(
        total[0], total[1], total[2 : 2 + width], total[2 + width : 2 + 2 * width], curvature
    )


def _minimise(
    rows: DataFrame, scales: Scales, as_good: dict, as_bad: dict, penalty: float, steps: int
) -> np.ndarray:
    """Newton steps on the non-negative risk; a step that does not lower it is halved.

    Where the negative part has fallen below zero the step climbs it again, as the non-negative
    estimator asks, instead of following the whole risk further down.
    """
    width = scales.width
    pull = np.full(width, penalty)
    pull[0] = 1e-6
    weight, best, least, rate = np.zeros(width), None, math.inf, 1.0
    direction = np.zeros(width)
    for _ in range(steps):
        trial = weight - rate * direction
        found = _losses(rows, scales, trial, as_good, as_bad)
        risk = found.positive + max(0.0, found.negative) + 0.5 * float(pull @ trial**2)
        if best is not None and risk > least - 1e-7:
            rate /= 2
            if rate < 1 / 16 or risk <= least + 1e-7:
                break
            continue
        weight, best, least, rate = trial, found, risk, 1.0
        if found.negative < 0:
            slope = -found.negative_slope
        else:
            slope = found.positive_slope + found.negative_slope + pull * weight
        direction = np.linalg.solve(found.curvature + np.diag(pull + 1e-9), slope)
    return weight


def _score_shares(rows: DataFrame, scales: Scales, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of the corpus, and of the half of the positives not trained on, by score cell."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((2, CELLS), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            half = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            measures = batch.column(1).flatten().to_numpy().reshape(len(half), -1)
            score = _sigmoid(scales.expand(measures) @ weight)
            cell = np.minimum((score * CELLS).astype(np.int64), CELLS - 1)
            total[0] += np.bincount(cell, minlength=CELLS)
            total[1] += np.bincount(cell[half == 1], minlength=CELLS)
        cells = pa.array(np.arange(CELLS, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [cells, pa.array(total[0]), pa.array(total[1])], names=["cell", "every", "good"]
        )

    parts = rows.mapInArrow(count, "cell int, every long, good long")
    every, good = np.zeros(CELLS), np.zeros(CELLS)
    for cell, a, b in parts.groupBy("cell").agg(F.sum("every"), F.sum("good")).collect():
        every[cell], good[cell] = a, b
    return every, good


def class_prior(every: np.ndarray, good: np.ndarray) -> float:
    """Share of good texts in the corpus, from counts of scores of the corpus and of positives.

    Above any threshold the corpus holds at least the prior times the positives' share, and
    hardly more where bad texts do not score; the threshold with the smallest ratio plus margin
    decides.
    """
    if not (every.sum() and good.sum()):
        return 0.5
    above = [np.cumsum(side[::-1])[::-1] / side.sum() for side in (every, good)]
    corpus, positives = above[0], np.maximum(above[1], 1e-12)
    doubt = sum(math.sqrt(math.log(4 / 0.1) / (2 * side.sum())) for side in (every, good))
    at = int(np.argmin((corpus + 1.01 * doubt) / positives))
    return float(np.clip(corpus[at] / positives[at], 0.01, 0.99))


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    label: str = "quality",
    penalty: float = 4.0,
    steps: int = 14,
) -> QualityModel:
    """Class prior and classifier from all documents and the trusted positives among them.

    A positive is a document whose id has the label 1, and no other, in a row that is not held
    out. Rows of ``labels`` with a NULL id or label say nothing. NULL texts count as empty; a
    document that stands there repeatedly counts as often. ``steps`` bounds the passes of each
    of the two fits over the stored measures. ``penalty`` is divided by the number of positives,
    so that few of them give a flatter model. Without documents or positives every text gets
    the score 0.5.
    """
    rows = cut(_training_rows(docs, labels, text, id_column, label))
    n, scales = _scales(rows)
    sizes = {r["half"]: r["count"] for r in rows.where("half is not null").groupBy("half").count().collect()}
    first, second = sizes.get(0, 0), sizes.get(1, 0)
    if not n or not first + second:
        return QualityModel(scales, np.zeros(scales.width), 0.5)
    every = 0.5 / n
    penalty /= first + second
    prior = 0.5
    if first and second:
        told = _minimise(
            rows, scales, {0: 0.5 / first, 1: 0.0, -1: 0.0}, {0: every, 1: every, -1: every}, penalty, steps
        )
        prior = class_prior(*_score_shares(rows, scales, told))
    share = prior / (first + second)
    as_good = {0: share, 1: share, -1: 0.0}
    as_bad = {0: 1 / n - share, 1: 1 / n - share, -1: 1 / n}
    return QualityModel(scales, _minimise(rows, scales, as_good, as_bad, penalty, steps), prior)


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    text: str = "text",
    id_column: str = "doc_id",
    threshold: float = 0.7,
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``, default all) with held_out, score and predicted.

    NULL texts score as empty ones. A NULL id is not held out. Only the text decides a score,
    so equal texts score alike. Columns named like a result are replaced. One narrow pass.
    """
    results = ["held_out", "score", "predicted"]
    kept = [c for c in (keep or docs.columns) if c not in results]
    (hidden,) = scratch_names(docs, "text")
    source = docs.select(
        F.col(f"`{text}`").cast("string").alias(hidden),
        *[F.col(f"`{c}`") for c in kept],
        is_held_out(F.col(f"`{id_column}`")).alias("held_out"),
    )
    schema = T.StructType(
        [*source.schema.fields[1:]]
        + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            parts = [model.score(m) for m in measured_batches(batch.column(0))]
            scores = np.concatenate([*parts, np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores)]
                + [pa.array((scores >= threshold).astype(np.int32))],
                names=schema.names,
            )

    return source.mapInArrow(score, schema)
