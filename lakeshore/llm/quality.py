"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Seventeen statistics of a whole text (lengths, shares of character kinds,
repetition) are standardised and sent through ``cos`` of fixed random directions,
which approximates a Gaussian kernel. Each partition sums its normal equations by
fold, the sums are added in a tree, and the driver solves systems whose size is a
parameter. Scores of each fold by the model of the other folds are calibrated by
isotonic regression over a fine grid of scores, so calibration sees no score of a
document's own model and its input to the driver is bounded by the grid.

Defined cases: a null text counts as empty and has statistics like any other; a
null or unlabelled ``doc_id`` is scored but never learnt from; labels repeated for
one document each count once per distinct value; with no usable label every score
is 0.5; with labels of one value every score is that value; an empty table gives
an empty result; extra columns are kept by ``score`` and ignored by ``fit``. A
column named like one the operator adds is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.llm.common import table, written

FEATURES = 256  # random directions
WIDTH = 3.0  # of the Gaussian kernel, in standard deviations
RIDGE = 1e-3
GRID = 2000  # steps of a score between 0 and 1 in calibration
THRESHOLD = 0.3
N_STATS = 17
_FOLDS = 5  # by crc32(doc_id); remainder 0 is held out

_KIND = np.full(128, 4, np.uint8)  # of ASCII: 0 lower, 1 upper, 2 digit, 3 space, 4 other
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 3


def _statistics(text: str) -> list[float]:
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    words = text.split()
    n, w = max(len(raw), 1), max(len(words), 1)
    kinds = np.bincount(_KIND[raw[raw < 128]], minlength=5) / n
    marks = np.bincount(raw, minlength=256)
    distinct = len(set(words))
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = text.split("\n")
    ends = sum(x[-1:] in ".!?" for x in lines if x)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    return [
        np.log1p(len(words)),
        np.log1p(len(raw)) / 3,
        kinds[1],
        kinds[2],
        kinds[3],
        kinds[4],
        float(marks[ord("|")]) / w,
        float(marks[ord("!")]) / w,
        float(marks[[ord(c) for c in "#$%&*"]].sum()) / w,
        float(marks[[ord(c) for c in ".,;:?"]].sum()) / w,
        distinct / w,
        same / w,
        pairs / w,
        float(sizes.mean()),
        float(sizes.std()),
        np.log1p(len(lines)),
        ends / max(len(lines), 1),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [float(x) for x in _statistics(t)])


def statistics(text: Column) -> Column:
    """The statistics of a text column; null counts as empty."""
    return _statistics_udf(F.coalesce(text, F.lit("")))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % _FOLDS == 0


def directions(seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(size=(N_STATS, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES)


@dataclass(frozen=True)
class QualityModel:
    """Fixed-size parameters: scaling, weights, and the calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps_x: np.ndarray
    steps_y: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.steps_x):
            return np.full(len(stats), float(self.steps_y[0]))
        return np.clip(np.interp(self.raw(stats), self.steps_x, self.steps_y), 0.0, 1.0)


def fourier(z: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    w, b = directions()
    out = np.sqrt(2.0 / FEATURES) * np.cos(np.clip(z, -8, 8) @ w + b)
    return np.hstack([out, np.ones((len(z), 1))])


def isotonic(x: np.ndarray, positive: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending ``x``; the blocks' borders and their means."""
    blocks: list[list[float]] = []  # positive, count, first x, last x
    for a, p, c in zip(x, positive, count, strict=True):
        blocks.append([p, c, a, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            q = blocks.pop()
            blocks[-1] = [blocks[-1][0] + q[0], blocks[-1][1] + q[1], blocks[-1][2], q[3]]
    xs = [v for b in blocks for v in (b[2], b[3])]
    ys = [b[0] / b[1] for b in blocks for _ in (0, 1)]
    return np.array(xs), np.array(ys)


def _stack(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), N_STATS)


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from ``stats`` (doc_id, stats) and ``labels`` (doc_id, quality); held-out ids are left out."""
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    rows = stats.select("doc_id", "stats").join(marked.distinct(), "doc_id")
    fold = F.crc32(F.col("doc_id").cast("string")) % _FOLDS
    rows = written(rows.select(fold.cast("int").alias("fold"), "y", "stats"), "quality-rows")
    moments = rows.select(
        F.count(F.lit(1)).alias("n"),
        F.sum("y").alias("p"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(N_STATS)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(N_STATS)],
    ).first()
    nothing = np.zeros(0)
    if not moments["n"] or moments["p"] in (0, moments["n"]):
        flat = 0.5 if not moments["n"] else moments["p"] / moments["n"]
        return QualityModel(nothing, nothing, nothing, nothing, np.array([flat]))
    mean = np.array([moments[f"m{i}"] for i in range(N_STATS)])
    scale = np.array([moments[f"s{i}"] for i in range(N_STATS)])
    scale[scale < 1e-9] = 1.0
    size = FEATURES + 1

    def normal_equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((_FOLDS, size, size + 1))
        for batch in batches:
            z = fourier((_stack(batch["stats"]) - mean) / scale)
            y = batch["y"].to_numpy(np.float64)
            for k in range(1, _FOLDS):
                at = batch["fold"].to_numpy() == k
                sums[k, :, :size] += z[at].T @ z[at]
                sums[k, :, size] += z[at].T @ y[at]
        yield pd.DataFrame({"sums": [sums.tobytes()]})

    parts = rows.mapInPandas(normal_equations, "sums binary").rdd.map(
        lambda r: np.frombuffer(r["sums"]).reshape(_FOLDS, size, size + 1)
    )
    sums = parts.treeReduce(np.add, depth=2)
    every = sums.sum(axis=0)

    def solve(s: np.ndarray, n: float) -> np.ndarray:
        return np.linalg.solve(s[:, :size] + RIDGE * max(n, 1.0) * np.eye(size), s[:, size])

    # the constant feature's last cell is the number of rows
    models = np.array([solve(every - sums[k], (every - sums[k])[-1, size - 1]) for k in range(_FOLDS)])

    def out_of_fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = fourier((_stack(batch["stats"]) - mean) / scale)
            raw = np.einsum("ij,ij->i", z, models[batch["fold"].to_numpy()])
            yield pd.DataFrame({"bin": np.rint(np.clip(raw, -1, 2) * GRID).astype(np.int64), "y": batch["y"]})

    bins = (
        rows.mapInPandas(out_of_fold, "bin bigint, y int")
        .groupBy("bin")
        .agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin")
        .toPandas()  # at most 3 * GRID + 1 rows
    )
    x, y = isotonic(bins["bin"].to_numpy() / GRID, bins["p"].to_numpy(np.float64), bins["n"].to_numpy(np.float64))
    return QualityModel(mean, scale, models[0], x, y)


def score(rows: DataFrame, model: QualityModel, stats: str = "stats", name: str = "score") -> DataFrame:
    """``rows`` with the score of their statistics as column ``name``."""

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        return pd.Series(model.score(_stack(column))) if len(column) else pd.Series([], dtype="float64")

    return rows.withColumn(name, scored(stats))


def crc_fold(doc_id: int) -> int:
    """The fold of an id, as ``held_out`` computes it."""
    return zlib.crc32(str(doc_id).encode()) % _FOLDS


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibrated quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    stats = written(docs.select("doc_id", statistics(F.col("text")).alias("stats")), "quality-stats")
    model = fit(stats, table(spark, sf_dir, "labels"))
    return score(stats, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
