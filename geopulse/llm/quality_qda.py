"""Document quality by regularised quadratic discriminant analysis.

A text becomes a vector of transformed statistics (logarithms of sizes, arcsine
roots of shares).  For each class the count, sum and sum of outer products of
the labelled vectors are added up on Spark; the driver sees only those totals.
Class covariances are shrunk towards the pooled one and towards its diagonal.
A score is the logistic function of the difference of the two log densities
(Mahalanobis distances from cached Cholesky factors) plus the log prior ratio.

Defined results: null and empty texts have a vector too (no words, no bytes);
null or other labels don't take part in fitting; repeated rows and repeated
labels count as often as they occur; with one class only, the score is that
class, with none 0.5; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import LOWER, SpanHash, text_slices, word_spans, written

#: Share of the pooled covariance in a class covariance, and of the diagonal in the result.
POOLED, DIAGONAL = 0.1, 0.02

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:?"]] = True
_SYMBOL = ~(_SPACE | _LETTER | _DIGIT | _STOP)
FEATURES = ("words", "bytes_per_word", "words_per_line", "upper", "symbol", "digit", "stop", "lone_symbol",
            "symbol_end", "distinct", "commonest", "repeated_pair", "repeated_line", "short_word")


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def _repeats(keys: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the count of the commonest one, for each row."""
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(k)))
    most = np.zeros(rows)
    np.maximum.at(most, r[at], counts)
    return np.bincount(r[at], minlength=rows).astype(float), most


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One vector of :data:`FEATURES` for each text."""
    rows, size = len(bounds) - 1, np.diff(bounds).astype(float)
    start, end, row = word_spans(data, bounds, ~_SPACE)
    words = np.bincount(row, minlength=rows).astype(float)
    line_start, line_end, line_row = word_spans(data, bounds, np.arange(256) != 10)
    lines = np.bincount(line_row, minlength=rows).astype(float)
    letters, upper = _per_row(_LETTER[data], bounds), _per_row(_UPPER[data], bounds)
    hashes = SpanHash(LOWER[data])
    word_hash = hashes.of(start, end)
    distinct, most = _repeats(word_hash, row, rows)
    same = row[1:] == row[:-1]
    pair_row = row[1:][same]
    with np.errstate(over="ignore"):
        pairs = (word_hash[:-1] * np.uint64(0x9E3779B97F4A7C15) + word_hash[1:])[same]
    pair_kinds, _ = _repeats(pairs, pair_row, rows)
    pair_count = np.bincount(pair_row, minlength=rows).astype(float)
    line_kinds, _ = _repeats(hashes.of(line_start, line_end), line_row, rows)
    edge = lambda flags: np.bincount(row, weights=flags, minlength=rows)
    last = data[end - 1] if len(end) else data[:0]
    lone = _SYMBOL[last] & (end - start == 1)
    return np.column_stack([
        np.log1p(words), np.log1p(size / np.maximum(words, 1)), np.log1p(words / np.maximum(lines, 1)),
        _share(upper, letters), _share(_per_row(_SYMBOL[data], bounds), size), _share(_per_row(_DIGIT[data], bounds), size),
        _share(_per_row(_STOP[data], bounds), size), _share(edge(lone), words), _share(edge(_SYMBOL[last]), words),
        _share(distinct, words), _share(most, words), _share(pair_count - pair_kinds, pair_count),
        _share(lines - line_kinds, lines), _share(edge(end - start <= 3), words)])


def document_features(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, features) for every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_slices(batches, "text"):
            x = features(data, bounds)
            values = pa.array(x.ravel(), pa.float64())
            sizes = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES), pa.int32())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(sizes, values)], names=["key", "features"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, features array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverse Cholesky factors, log determinants and log priors."""

    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    logs: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.center) / self.scale
        density = []
        for mean, factor, log in zip(self.means, self.factors, self.logs, strict=True):
            distance = (z - mean) @ factor.T
            density.append(log - 0.5 * np.einsum("ij,ij->i", distance, distance))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each class of the partition: count, sums and sums of products, as (label, at, value)."""
    d = len(FEATURES)
    totals = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for c, total in totals.items():
            own = x[label == c]
            total += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
    for c, total in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), c), pa.int32()), pa.array(np.arange(len(total)), pa.int32()),
                                          pa.array(total, pa.float64())], names=["label", "at", "value"])


def fit(labelled: DataFrame, pooled: float = POOLED, diagonal: float = DIAGONAL) -> Discriminant | float:
    """Model of (label 0/1, features); with fewer than two classes the constant score."""
    d = len(FEATURES)
    rows = (labelled.where("label in (0, 1)").select(F.col("label").cast("int"), "features")
            .mapInArrow(_moments, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value")).collect())
    totals = np.zeros((2, 1 + d + d * d))
    for r in rows:
        totals[r["label"], r["at"]] = r["value"]
    n = totals[:, 0]
    if not n.all():
        return 0.5 if not n.any() else float(n[1] > 0)
    sums, products = totals[:, 1:1 + d], totals[:, 1 + d:].reshape(2, d, d)
    center = sums.sum(0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(products.sum(0)) / n.sum() - center ** 2, 0))
    scale = np.where(scale > 1e-6, scale, 1)
    means = (sums / n[:, None] - center) / scale
    own = np.stack([(products[c] / n[c] - np.outer(sums[c], sums[c]) / n[c] ** 2) / np.outer(scale, scale) for c in (0, 1)])
    within = (own * n[:, None, None]).sum(0) / n.sum()
    factors, logs = [], []
    for c in (0, 1):
        cov = (1 - pooled) * own[c] + pooled * within
        cov = (1 - diagonal) * cov + diagonal * (np.diag(np.diag(cov)) + 0.05 * np.eye(d))
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        logs.append(np.log(n[c] / n.sum()) - np.log(np.diag(low)).sum())
    return Discriminant(center, scale, means, np.stack(factors), np.array(logs))


def score(vectors: DataFrame, model: Discriminant | float) -> DataFrame:
    """(key, score) for the feature vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            s = np.full(len(x), model) if isinstance(model, float) else model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["key", "score"])

    return vectors.select("key", "features").mapInArrow(run, f"key {vectors.schema['key'].dataType.simpleString()}, score double")


def with_score(df: DataFrame, model: Discriminant | float, text: str = "text", name: str = "quality_score") -> DataFrame:
    """``df`` with each row's score, computed from its text in place (no join)."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    kept = df.drop(name)
    schema = StructType([*kept.schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_slices(batches, text):
            s = np.full(rows.num_rows, model) if isinstance(model, float) else model.score(features(data, bounds))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(s, pa.float64())], names=[*rows.schema.names, name])

    return kept.mapInArrow(run, schema)


def fit_on(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Discriminant | float:
    """Model of the documents that have a label."""
    # no broadcast: the moments' tasks would hold a second Python worker beside that of the vectors
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).hint("merge")
    return fit(document_features(documents, key, text).join(known, "key"))


def quality_scores(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, score) of every document, from a model fitted on the labelled ones among ``labels``.

    The texts are read once: their vectors are written to the shared scratch folder.
    """
    vectors = written(document_features(documents, key, text), "quality-vectors")
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label"))
    return score(vectors, fit(vectors.join(known, "key")))
