"""Quality: a regularised quadratic discriminant over transformed document statistics.

Each class is a Gaussian over the statistics of its texts. A class's covariance is shrunk towards the pooled one and
towards the pooled variances alone, each statistic having its own scale; its Cholesky factor is inverted once and kept with the
model, so a score costs one triangular product for each class: the difference of two Mahalanobis log-densities, with the class shares as priors.
Moments are summed over all labelled training rows.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import Saved, as_bytes, filter_arrow, map_arrow, texts
from careerlake.llm.toxicity import clean_labels

UPPER = bytes(range(65, 91))
LETTER = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
SYMBOL = b"#$%&*+/<=>@\\^_`{}~[]"
BAR = b"|"
LOUD = b"!?"
STOP = b".,;:"
DIGIT = b"0123456789"
STATISTICS = ("log_words", "upper", "symbols", "bars", "loud", "stops", "digits", "word_length", "short_words", "distinct", "repeats", "line_repeats", "line_length")


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a whole text; shares are arcsines of square roots. All 0 for a text without words."""
    found = text.split()
    n, size = len(found), len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    without = lambda drop: size - len(text.translate(None, drop))
    letters = without(LETTER)
    lines = [x for x in text.split(b"\n") if x]
    sizes = sorted(map(len, found))
    share = lambda k, of: float(np.arcsin(np.sqrt(min(1.0, max(0.0, k / of))))) if of else 0.0
    return [
        float(np.log1p(n)),
        share(without(UPPER), letters),
        share(without(SYMBOL), size),
        share(without(BAR), n),
        share(without(LOUD), n),
        share(without(STOP), n),
        share(without(DIGIT), size),
        float(np.log(sum(sizes) / n)),
        share(sum(s <= 3 for s in sizes) if n < 64 else int(np.searchsorted(np.array(sizes), 3, side="right")), n),
        float(np.log(len(set(found)) / n) / np.log(n + 8)),
        share(sum(map(operator.eq, found, found[1:])), n),
        share(sum(map(len, lines)) - sum(map(len, set(lines))), size),
        float(np.log1p(size / max(1, len(lines)))),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([statistics(t) for t in as_bytes(batch.column(1))], pa.list_(pa.float64()))], names=["doc_id", "x"])

        return run

    return map_arrow(texts(docs, id_col, text_col), make, f"doc_id {kind}, x array<double>")


@dataclass
class Model:
    """Log priors, means and Cholesky factors (of the covariances) of classes 0 and 1; whiten: the factors' inverses."""

    log_prior: np.ndarray
    mean: np.ndarray
    factor: np.ndarray

    def __post_init__(self):
        self.whiten = np.linalg.inv(self.factor)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of x."""
        density = []
        for k in (0, 1):
            u = self.whiten[k] @ (x - self.mean[k]).T
            density.append(self.log_prior[k] - 0.5 * np.sum(u * u, axis=0) - np.sum(np.log(np.diag(self.factor[k]))))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(stats: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", to_pooled: float = 0.3, to_variances: float = 0.05) -> Model:
    """Sums the moments of all labelled rows for which train (a condition on doc_id) holds.

    to_pooled and to_variances are the shrinkage weights. Null, odd or disagreeing labels aren't used. A class without
    rows has the other's moments, so that scores are the smoothed class share; without any rows they are 0.5.
    """
    d = len(STATISTICS)
    x = lambda i: F.col("x")[i]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    rows = stats.filter(train).join(clean_labels(labels, label_col).filter(train), "doc_id")
    got = {r["label"]: r for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.array(*(F.sum(x(i)) for i in range(d))).alias("s"), F.array(*(F.sum(x(i) * x(j)) for i, j in pairs)).alias("ss")).collect()}
    n = np.array([got[k]["n"] if k in got else 0 for k in (0, 1)], float)
    mean, scatter = np.zeros((2, d)), np.zeros((2, d, d))
    for k, r in got.items():
        mean[k] = np.array(r["s"]) / n[k]
        for (i, j), v in zip(pairs, r["ss"], strict=True):
            scatter[k, i, j] = scatter[k, j, i] = v
        scatter[k] -= n[k] * np.outer(mean[k], mean[k])
    pooled = scatter.sum(axis=0) / max(1.0, n.sum() - 2) + 1e-6 * np.eye(d)
    factor = np.zeros((2, d, d))
    for k in (0, 1):
        if not n[k]:
            mean[k] = mean[1 - k]
        own = scatter[k] / max(1.0, n[k] - 1) if n[k] > d else pooled
        c = (1 - to_pooled) * own + to_pooled * pooled
        c = (1 - to_variances) * c + to_variances * np.diag(np.diag(pooled))
        factor[k] = np.linalg.cholesky(c)
    return Model(np.log((n + 0.5) / (n.sum() + 1)), mean, factor)


def score_statistics(stats: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    kind = stats.schema["doc_id"].dataType.simpleString()

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            s = model.score(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=["doc_id", "score", "predicted"])

        return run

    return map_arrow(stats.select("doc_id", "x"), make, f"doc_id {kind}, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, train: Column, threshold: float = 0.7, label_col: str = "quality") -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, score (0 to 1) and predicted (1 if score >= threshold).

    Null texts are empty; texts without words have all statistics 0 and are scored like any other. Repeated rows each
    give a row; further columns are ignored; an empty table gives an empty result. The statistics are computed once
    and kept in the shared folder between the fit and the scoring.
    """
    stats = Saved(document_statistics(docs), "statistics").df
    return score_statistics(stats, fit(stats, labels, train, label_col), threshold)


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are whatever their names, whose texts are predicted good.

    Null texts are empty, repeated rows are judged alike, rows with a null id too; an empty table gives an empty result.
    """
    at = docs.columns.index(text_col)

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([statistics(t or b"") for t in as_bytes(batch.column(at))])
            return batch.filter(pa.array(model.score(x) >= threshold, pa.bool_()))

        return run

    return filter_arrow(docs, make)
