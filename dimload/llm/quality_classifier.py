"""A quality score from document statistics: random Fourier features, ridge, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.common import utf8
from dimload.sources.scratch import cut_lineage

#: Statistics of a text, in order.
STATISTICS = (
    "log_words log_chars word_length word_length_spread long_words distinct_words distinct_pairs repeated_words "
    "upper digits symbols pipes other_punctuation beyond_ascii stops lines_per_word repeated_lines"
).split()
FEATURES, RIDGE, SEED = 128, 1e-3, 0
#: Sums of so many groups of tasks reach the driver; calibration sees scores in so many steps.
GROUPS, STEPS = 16, 2_000
_LOW, _HIGH = -1.0, 2.0


def _mask(characters: bytes) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(characters, np.uint8)).astype(np.float64)


_BYTES = np.stack(
    [
        _mask(bytes(range(65, 91))),
        _mask(bytes(range(97, 123))),
        _mask(b"0123456789"),
        _mask(b"#*$%&<>"),
        _mask(b"|"),
        _mask(b"!\"'()+,-./:;=?@[\\]^_`{}~"),
        _mask(bytes(range(128, 256))),
        _mask(b" \t\n\v\f\r"),
    ]
).T


def statistics(text: bytes) -> np.ndarray:
    """The statistics of one whole text; of a text without words all are zero."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(len(STATISTICS))
    length = np.fromiter(map(len, words), np.float64, n)
    upper, lower, digit, symbol, pipe, punctuation, high, white = np.bincount(
        np.frombuffer(text, np.uint8), minlength=256
    ) @ _BYTES
    solid = len(text) - white
    lines = [x for x in text.split(b"\n") if not x.isspace() and x]
    stops = sum(w[-1] in b".!?" for w in words)
    return np.array(
        [
            np.log1p(n),
            np.log1p(len(text)),
            length.mean(),
            length.std(),
            (length > 20).mean(),
            len(set(words)) / n,
            len(set(zip(words, words[1:]))) / max(n - 1, 1),
            sum(map(bytes.__eq__, words, words[1:])) / max(n - 1, 1),
            upper / max(upper + lower, 1),
            digit / solid,
            symbol / solid,
            pipe / solid,
            punctuation / solid,
            high / solid,
            stops / n,
            len(lines) / n,
            1 - len(set(lines)) / len(lines),
        ]
    )


def statistics_udf():
    """A column function from the bytes of a text to its statistics."""

    @F.pandas_udf("array<double>")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([statistics(x or b"") for x in batch])

    return count


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence with the least weighted squares to ``values`` (adjacent violators pooled)."""
    blocks: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist()):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    #: Ridge weights, one column from all labelled rows, then two from one half of them each.
    weights: np.ndarray
    steps: np.ndarray
    calibrated: np.ndarray

    def features(self, statistics: np.ndarray) -> np.ndarray:
        """Random Fourier features: inner products approximate a Gaussian kernel."""
        x = (statistics - self.mean) / self.scale
        z = np.cos(x @ self.frequency + self.phase) * np.sqrt(2 / self.frequency.shape[1])
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def score(self, statistics: np.ndarray) -> np.ndarray:
        raw = self.features(statistics) @ self.weights[:, 0]
        level = np.interp(raw, self.steps, self.calibrated)
        # Keeps the order within a step.
        return np.clip(0.999 * level + 0.001 * np.clip((raw - _LOW) / (_HIGH - _LOW), 0, 1), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _partial_sums(model: QualityModel):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of this task's rows, by half: Z'Z and Z'y side by side, as one row."""
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, half = _matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            z = model.features(x)
            both = np.concatenate([z, y[:, None]], axis=1)
            found = np.stack([z[half == h].T @ both[half == h] for h in (0, 1)])
            total = found if total is None else total + found
        if total is not None:
            group = TaskContext.get().partitionId() % GROUPS
            yield pa.RecordBatch.from_pydict({"g": pa.array([group], pa.int32()), "sums": pa.array([total.ravel()])})

    return sums


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            found = _matrix(batch.column(1)).sum(axis=0)
            total = found if total is None else total + found
    if total is not None:
        yield pa.RecordBatch.from_pydict({"g": pa.array([0], pa.int32()), "sums": pa.array([total])})


def train(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> QualityModel | None:
    """Fits ``labelled``: ``statistics`` (array), ``label`` (0 to 1), ``half`` (0 or 1).

    All rows are learned from. Each task sums its normal equations; sums of groups of
    tasks reach the driver, a few hundred kilobytes each. For the calibration each
    half is scored by the weights of the other, in ``STEPS`` steps, of which the driver
    gets a count and a sum. None if there are no rows."""
    n = len(STATISTICS)
    x = [F.col("statistics")[i] for i in range(n)]
    found = labelled.agg(F.count("*"), *[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first()
    if not found[0]:
        return None
    scale = np.array(found[1 + n :], np.float64)
    random = np.random.default_rng(seed)
    frequency = random.normal(size=(n, features)) / np.sqrt(n)
    phase = random.uniform(0, 2 * np.pi, features)
    mean = np.array(found[1 : 1 + n], np.float64)
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0), frequency, phase, np.zeros((features + 1, 3)), np.zeros(1), np.zeros(1))
    rows = labelled.select("statistics", F.col("label").cast("double"), F.col("half").cast("int"))
    schema = "g int, sums array<double>"
    parts = rows.mapInArrow(_partial_sums(model), schema).repartition(GROUPS, "g").mapInArrow(_total, schema)
    width = features + 1
    halves = sum(np.array(r.sums) for r in parts.collect()).reshape(2, width, width + 1)
    for k, used in enumerate((halves.sum(axis=0), halves[0], halves[1])):
        rows_used = max(used[-1, width - 1], 1)
        penalty = np.eye(width) * ridge * rows_used
        penalty[-1, -1] = 1e-9
        model.weights[:, k] = np.linalg.solve(used[:, :width] + penalty, used[:, width])

    @F.pandas_udf("int")
    def step(statistics: pd.Series, half: pd.Series) -> pd.Series:
        raw = model.features(np.stack(statistics.to_numpy())) @ model.weights
        by_other = np.where(half.to_numpy() == 0, raw[:, 2], raw[:, 1])
        return pd.Series(np.clip((by_other - _LOW) / (_HIGH - _LOW) * STEPS, 0, STEPS - 1).astype(np.int32))

    counted = labelled.select(step("statistics", "half").alias("step"), F.col("label").cast("double").alias("label"))
    counted = counted.groupBy("step").agg(F.count("*").alias("n"), F.avg("label").alias("label")).orderBy("step").collect()
    at = np.array([r.step for r in counted], np.float64)
    level = isotonic(np.array([r.label for r in counted]), np.array([r.n for r in counted], np.float64))
    model.steps, model.calibrated = _LOW + (at + 0.5) / STEPS * (_HIGH - _LOW), level
    return model


def score_udf(model: QualityModel | None):
    """A column function from statistics to the score; without a model it is one half."""

    @F.pandas_udf("double")
    def score(statistics: pd.Series) -> pd.Series:
        if model is None or not len(statistics):
            return pd.Series([0.5] * len(statistics), dtype="float64")
        return pd.Series(model.score(np.stack(statistics.to_numpy())))

    return score


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    learn=None,
    **options,
) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``; ``score`` is the calibrated chance of label 1.

    Only statistics of the text enter a score. Learned from rows with a label that is
    not NULL for which the condition ``learn`` over ``doc_id`` holds (all by default);
    several labels of a document count as their mean. A NULL or empty text has
    statistics of zero and is scored like any other; repeated rows are scored, and
    learned from, each; a NULL id has no label. Without labels all scores are one half.
    Other columns are not looked at; no rows, no rows.

    Statistics are computed once and written to the checkpoint folder; they, not texts,
    are joined to the labels."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), statistics_udf()(utf8(text)).alias("statistics"))
    rows = cut_lineage(rows)
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("labelled"))
    known = known.agg(F.avg(label).alias("label"))
    if learn is not None:
        known = known.where(learn(F.col("labelled")))
    half = F.pmod(F.xxhash64("labelled"), F.lit(2)).alias("half")
    fit = rows.join(known, F.col("doc_id") == F.col("labelled")).select("statistics", "label", half)
    model = train(cut_lineage(fit), **options)
    return rows.select("doc_id", score_udf(model)("statistics").alias("score"))
