"""Operator 7: quality by a regularised quadratic discriminant.

Each text becomes a dozen transformed statistics. Two Gaussians, one per label, are fitted to the labelled rows
from sums that Spark adds up; their covariances are shrunk towards the pooled one and its mean variance. The score is
the logistic of the log-density difference, with Mahalanobis distances from Cholesky factors that are
computed once and sent along.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

NAMES = ("length", "upper", "digits", "symbols", "stops", "breaks", "beyond_ascii", "word_length", "short_words", "distinct_words", "repeated_lines", "shout")
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)
_STOPS = np.frombuffer(b".,;:?", np.uint8)


def statistics(text: bytes) -> list[float]:
    """Finite for every text, the empty one included."""
    n = len(text)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), text.split(b"\n")
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())

    def share(count: float, of: float) -> float:
        return math.log((count + 0.5) / (of + 10.0))

    k, long_lines = len(words), [x for x in lines if len(x) > 20]
    return [
        math.log1p(n),
        share(upper, upper + lower),
        share(int(seen[48:58].sum()), n),
        share(int(seen[_SYMBOLS].sum()), n),
        share(int(seen[_STOPS].sum()), k),
        share(int(seen[10]), k),
        share(int(seen[128:].sum()), n),
        math.log1p(float(lengths.mean())) if k else 0.0,
        share(int((lengths <= 3).sum()), k),
        math.log1p(len(set(words))) / math.log1p(k) if k > 1 else 1.0,
        share(len(long_lines) - len(set(long_lines)), len(long_lines)),
        share(int(seen[33]), k),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of each whole text."""
    common.arrow_limits(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            rows = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=schema.names)

    return docs.select(id_col, common.text_of(text_col).cast("binary")).mapInArrow(run, schema)


class Discriminant:
    """Two shrunk Gaussians over standardised statistics."""

    def __init__(self, sums: dict[int, tuple[int, np.ndarray, np.ndarray]], to_pooled: float = 0.2, to_mean: float = 0.05):
        p = len(NAMES)
        total = sum(n for n, _, _ in sums.values())
        self.bias = 0.0
        self.parts: list[tuple[np.ndarray, np.ndarray, float]] = []
        if not total or min(sums.get(k, (0,))[0] for k in (0, 1)) < 2:
            # labels of one kind, or none: the smoothed share of ones is all that is known
            ones = sums.get(1, (0,))[0]
            self.bias = math.log((ones + 1) / (total - ones + 1))
            return
        mean = sum(s for _, s, _ in sums.values()) / total
        scale = np.sqrt(np.maximum(np.diag(sum(q for _, _, q in sums.values())) / total - mean**2, 1e-12))
        self.mean, self.scale, cov = mean, scale, {}
        for k, (n, s, q) in sums.items():
            m = s / n
            cov[k] = (q / n - np.outer(m, m)) / np.outer(scale, scale)
        pooled = sum(sums[k][0] * cov[k] for k in sums) / total
        for k in (1, 0):
            n, s, _ = sums[k]
            c = (1 - to_pooled) * cov[k] + to_pooled * pooled
            c = (1 - to_mean) * c + to_mean * (np.trace(c) / p + 1e-6) * np.eye(p)
            factor = np.linalg.cholesky(c)
            self.parts.append(((s / n - mean) / scale, np.linalg.inv(factor), -np.log(np.diag(factor)).sum() + math.log(n / total)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.parts:
            return np.full(len(x), 1 / (1 + math.exp(-self.bias)))
        z = (x - self.mean) / self.scale
        density = [offset - 0.5 * (((z - m) @ inverse.T) ** 2).sum(axis=1) for m, inverse, offset in self.parts]
        # counts of labelled rows bound what a density far outside them can claim
        return 1 / (1 + np.exp(-np.clip(density[0] - density[1], -30, 30)))


def fit(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> Discriminant:
    """From all labelled rows outside the held-out fold, by sums: one row per label reaches the driver."""
    p = len(NAMES)
    known = labels.where(~common.held_out(id_col) & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("of"), F.col(label_col).cast("int").alias("label"))
    x = [F.col("x")[i] for i in range(p)]
    products = [F.sum(x[i] * x[j]) for i in range(p) for j in range(i, p)]
    rows = stats.join(known, stats[id_col] == known["of"]).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.array(*map(F.sum, x)).alias("s"), F.array(*products).alias("q")).collect()
    sums = {}
    for r in rows:
        q = np.zeros((p, p))
        q[np.triu_indices(p)] = r.q
        sums[r.label] = (r.n, np.array(r.s), q + np.triu(q, 1).T)
    return Discriminant(sums)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted.

    A null text is scored as an empty one. A null id is held out and never learnt from; repeated rows get the same
    score; a null label teaches nothing. With fewer than two rows of either label every score is the
    smoothed share of ones. Texts are read once; their statistics, 100 bytes a row, are stored and joined with the labels.
    """
    stats = common.materialise(document_statistics(docs, id_col, text_col), "quality-stats")
    model = fit(stats, labels, id_col, label_col)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            x = np.array(batch.column(1).flatten()).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], names=schema.names)

    scored = stats.mapInArrow(run, schema)
    return scored.select(id_col, common.held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
