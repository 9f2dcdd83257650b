"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean and a covariance of transformed statistics.  A class
covariance is shrunk towards the pooled one, and that towards its diagonal
mean.  The score is the logistic of the difference of the two log-densities (and log-priors),
each from a Mahalanobis distance through the Cholesky factor kept in the model.

Means and covariances come from moments that Spark sums over at most ``SAMPLE_PER_CLASS``
labelled rows of each class, taken by key hash; class shares come from all labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.frames import map_arrow, unused
from loanloom.llm.sampling import sampled_texts
from loanloom.llm.tokens import SPACES, slices, span_hashes, spans, utf8

SAMPLE_PER_CLASS = 20_000
#: Shrinkage of a class covariance to the pooled one, and of the pooled one to its diagonal.
TO_POOLED, TO_DIAGONAL = 0.1, 0.02
#: Log-density differences are divided by this before the logistic: the statistics are not independent draws.
TEMPERATURE = 2.0

_KINDS = ["upper", "digit", "line", "space", "bang", "star", "hash", "dollar", "percent", "and", "pipe", "stop",
          "comma", "other", "wide"]
STATISTICS = ["log_bytes", "log_words", "word_mean", "word_spread", *[f"share_{k}" for k in _KINDS],
              "distinct", "repeats", "line_mean", "marked_words", "capital_words"]


def _kind_of_byte() -> np.ndarray:
    kind = np.full(256, len(_KINDS), dtype=np.int64)           # lower-case letters
    named = {"upper": range(65, 91), "digit": range(48, 58), "line": [10, 13], "space": [9, 11, 12, 32],
             "bang": [33, 63], "star": [42], "hash": [35], "dollar": [36], "percent": [37], "and": [38],
             "pipe": [124], "stop": [46], "comma": [44, 58, 59]}
    kind[:65] = _KINDS.index("other")
    kind[91:97] = _KINDS.index("other")
    kind[123:128] = _KINDS.index("other")
    kind[128:] = _KINDS.index("wide")
    for name, codes in named.items():
        kind[list(codes)] = _KINDS.index(name)
    return kind


_KIND = _kind_of_byte()
_MARK = np.isin(_KIND, [_KINDS.index(k) for k in ("bang", "star", "hash", "dollar", "percent", "and", "pipe", "other")])


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text; an empty or null text has zeros for lengths and shares."""
    data, offsets = utf8(texts)
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(rows), sizes)
    width = len(_KINDS) + 1
    kinds = np.bincount(row * width + _KIND[data], minlength=rows * width).reshape(rows, width)[:, :-1]
    starts, stops, first = spans(data, offsets, SPACES)
    n = np.diff(first)
    length = (stops - starts).astype(float)
    word_row = np.repeat(np.arange(rows), n)
    some = np.maximum(n, 1)
    mean = np.bincount(word_row, length, rows) / some
    spread = np.sqrt(np.maximum(np.bincount(word_row, length ** 2, rows) / some - mean ** 2, 0.0))
    codes = span_hashes(data, starts, stops)
    # Distinct words of each row, and words that equal the word before.
    order = np.lexsort((codes, word_row))
    fresh = np.ones(len(codes), dtype=bool)
    fresh[1:] = (codes[order][1:] != codes[order][:-1]) | (word_row[order][1:] != word_row[order][:-1])
    distinct = np.bincount(word_row[order][fresh], minlength=rows) / some
    same = np.zeros(len(codes), dtype=bool)
    same[1:] = (codes[1:] == codes[:-1]) & (word_row[1:] == word_row[:-1])
    repeats = np.bincount(word_row[same], minlength=rows) / some
    marked = np.bincount(word_row[_MARK[data[stops - 1]]], minlength=rows) / some
    capital = np.zeros(len(codes), dtype=bool)
    two = length >= 2
    capital[two] = (_KIND[data[starts[two] + 1]] == 0)
    capitals = np.bincount(word_row[capital], minlength=rows) / some
    shares = kinds / np.maximum(sizes, 1)[:, None]
    lines = sizes / (kinds[:, _KINDS.index("line")] + 1.0)
    return np.column_stack([np.log1p(sizes), np.log1p(n), np.log1p(mean), np.log1p(spread), np.sqrt(shares),
                            np.log(distinct * np.sqrt(some) + 1e-2), np.sqrt(repeats), np.log1p(lines),
                            np.sqrt(marked), np.sqrt(capitals)])


@dataclass
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]       # class 0, class 1
    factors: list[np.ndarray]     # Cholesky factors of the shrunk covariances
    log_priors: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor, prior in zip(self.means, self.factors, self.log_priors):
            away = np.linalg.solve(factor, (z - mean).T)
            density.append(prior - 0.5 * (away ** 2).sum(axis=0) - np.log(np.diag(factor)).sum())
        gap = np.clip((density[1] - density[0]) / TEMPERATURE, -500, 500)
        return 1.0 / (1.0 + np.exp(-gap))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "quality", sample: int = SAMPLE_PER_CLASS) -> QualityModel | None:
    """Fit on documents whose id has label 0 or 1 (a null text counts as empty); None if a class has no row."""
    d = len(STATISTICS)
    rows, counts = sampled_texts(docs, labels, sample, id_column, text_column, label_column)

    def moments(batches):
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            text, label = batch.column("text"), np.asarray(batch.column("label"))
            for a, b in slices(text):
                x = statistics(text.slice(a, b - a))
                for k in (0, 1):
                    own = x[label[a:b] == k]
                    total[k] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        places = np.tile(np.arange(total.shape[1]), 2)
        yield pa.RecordBatch.from_pydict({"label": np.repeat([0, 1], total.shape[1]).astype(np.int32), "place": places, "value": total.ravel()})

    sums = np.zeros((2, 1 + d + d * d))
    summed = map_arrow(rows, moments, "label int, place long, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    for r in summed.collect():  # a fixed number of rows
        sums[r["label"], r["place"]] = r["value"]
    n = sums[:, 0]
    if (n == 0).any():
        return None
    mean = sums[:, 1:1 + d] / n[:, None]
    square = sums[:, 1 + d:].reshape(2, d, d)
    centre = sums[:, 1:1 + d].sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(square.sum(axis=0)) / n.sum() - centre ** 2, 1e-8))
    scatter = np.array([(square[k] - n[k] * np.outer(mean[k], mean[k])) / np.outer(scale, scale) for k in (0, 1)])
    pooled = scatter.sum(axis=0) / max(n.sum() - 2, 1)
    pooled = (1 - TO_DIAGONAL) * pooled + TO_DIAGONAL * np.diag(np.diag(pooled)) + 1e-3 * np.eye(d)
    factors = [np.linalg.cholesky((1 - TO_POOLED) * scatter[k] / max(n[k] - 1, 1) + TO_POOLED * pooled) for k in (0, 1)]
    shares = np.array([counts[k] for k in (0, 1)], dtype=float)
    return QualityModel(centre, scale, [(m - centre) / scale for m in mean], factors, np.log(shares / shares.sum()))


def score_rows(docs: DataFrame, model: QualityModel | None, text_column: str = "text",
               name: str = "score") -> DataFrame:
    """All rows of ``docs`` with the probability of label 1 added under ``name`` (numbered if taken).

    Texts that are null or empty are scored by their (zero) statistics; without
    a model every score is 0.5.  Repeated rows get equal scores.
    """
    name = unused(docs, name)
    place = docs.columns.index(text_column)

    def work(batches):
        for batch in batches:
            column = batch.column(place)
            parts = [model.score(statistics(column.slice(a, b - a))) if model else np.full(b - a, 0.5) for a, b in slices(column)]
            arrays = [*batch.columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))]
            yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kinds = [f.dataType.simpleString() for f in docs.schema] + ["double"]
    return map_arrow(plain, work, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))).toDF(*docs.columns, name)
