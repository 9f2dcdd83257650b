"""Quality rules: gradient-boosted trees over document statistics, after exact base rules.

Trees are grown on binned statistics of at most ``SAMPLE_PER_CLASS`` labelled documents of each class,
drawn by key hash; tasks compute the statistics, so only a bounded table of numbers reaches the driver.
A feature in ``MONOTONE`` may move the score in one direction only: a split against it is not taken,
and the children of a split on it are bounded by the mean of their weights, so that no deeper split undoes it.

The finished trees are flattened into node arrays (feature, threshold, left, right, value).  Scoring walks all
rows and trees at once, one level at a time; a leaf leads to itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanloom.llm.frames import map_arrow, unused
from loanloom.llm.sampling import sampled_texts

SAMPLE_PER_CLASS = 10_000
TREES, DEPTH, RATE, BINS = 60, 4, 0.15, 64
#: Penalty of a leaf's weight, least sum of second derivatives of a leaf, and least gain of a split.
PENALTY, LEAST_CHILD, LEAST_GAIN = 1.0, 2.0, 1e-3
LEAST_SCORE = 0.5
#: The base rules: fewest words, and the largest percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50

SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "exclaims", "points", "variety",
            "marked_words", "line_words", "ended_lines", "short_words", "lettered_words", "longest_word"]
#: 1: the score never falls as the feature rises; -1: it never rises.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeats": -1, "exclaims": -1, "lettered_words": 1}

_BLANKS = b" \t\n\v\f\r"
_KIND = np.zeros(256, dtype=np.int64)     # 0 other, 1 upper, 2 digit, 3 exclamation or question, 4 other punctuation, 5 lower or wide, 6 blank
_KIND[33:48] = _KIND[58:65] = _KIND[91:97] = _KIND[123:127] = 4
_KIND[[33, 63]], _KIND[48:58], _KIND[65:91] = 3, 2, 1
_KIND[97:123] = _KIND[128:] = 5
_KIND[list(_BLANKS)] = 6


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """How many words lie in a three-word window that occurs twice or more, its first occurrence included."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct ** 3 >= 2 ** 63:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, count = np.unique(pairs[:-1] * distinct + ids[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift:len(ids) - 2 + shift] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts and the features of one whole text; zeros for a text that is null or has no word."""
    raw = (text or "").encode()
    words = raw.split()     # ASCII white space, as the base rules have it
    n = len(words)
    if not n:
        return [0] * len(BASE), [0.0] * len(FEATURES)
    joined = b"".join(words)
    chars = len(joined.decode())
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(_BLANKS)]
    copies = len(lines) - len(set(lines))
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    repeats = repeated_words(ids, len(numbers))
    kind = _KIND[np.frombuffer(joined, np.uint8)]
    share = np.bincount(kind, minlength=7) / len(kind)
    length = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(length)
    lettered = np.add.reduceat(((kind == 1) | (kind == 5)).astype(np.int64), ends - length) > 0
    features = [np.log1p(n), chars / n, symbols / n, copies / len(lines), repeats / n, share[1], share[2], share[3], share[4],
                np.log(len(numbers) / np.sqrt(n)), float(np.isin(kind[ends - 1], (3, 4)).mean()), np.log1p(n / len(lines)),
                sum(x.rstrip(_BLANKS)[-1:] in b".!?\"" for x in lines) / len(lines), float((length <= 3).mean()), float(lettered.mean()),
                float(np.log1p(length.max()))]
    return [n, chars, symbols, copies, repeats], features


def table_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    rows = [statistics(t.as_py()) for t in texts]
    return (np.array([r[0] for r in rows], dtype=np.int64).reshape(-1, len(BASE)),
            np.array([r[1] for r in rows], dtype=float).reshape(-1, len(FEATURES)))


@dataclass
class Trees:
    """All trees in one set of node arrays."""
    bias: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray     # rows up to it go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        at = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            lower = x[row, self.feature[at]] <= self.threshold[at]
            at = np.where(lower, self.left[at], self.right[at])
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + self.value[at].sum(axis=1), -500, 500)))


class _Nodes:
    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def add(self) -> int:
        here = len(self.feature)
        for column, start in ((self.feature, 0), (self.threshold, np.inf), (self.left, here), (self.right, here), (self.value, 0.0)):
            column.append(start)
        return here


def _weight(gradient, curvature, low, high):
    return np.clip(-gradient / (curvature + PENALTY), low, high)


def _gain(gradient, curvature, weight):
    return -(gradient * weight + 0.5 * (curvature + PENALTY) * weight ** 2)


def _grow(nodes: _Nodes, codes: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, curvature: np.ndarray,
          directions: np.ndarray) -> tuple[int, np.ndarray]:
    """Add one tree, level by level; returns its root and the node of every row."""
    d, bins = codes.shape[1], BINS
    root = nodes.add()
    at = np.full(len(codes), root)
    bounds = {root: (-np.inf, np.inf)}
    open_ = [root]
    for level in range(DEPTH + 1):
        place = np.full(len(nodes.feature), -1)
        place[open_] = np.arange(len(open_))
        mine = place[at]
        rows = np.flatnonzero(mine >= 0)
        cell = ((mine[rows, None] * d + np.arange(d)) * bins + codes[rows]).ravel()
        size = len(open_) * d * bins
        g = np.bincount(cell, np.repeat(gradient[rows], d), size).reshape(len(open_), d, bins)
        h = np.bincount(cell, np.repeat(curvature[rows], d), size).reshape(len(open_), d, bins)
        following = []
        for i, node in enumerate(open_):
            low, high = bounds[node]
            all_g, all_h = g[i, 0].sum(), h[i, 0].sum()
            weight = _weight(all_g, all_h, low, high)
            nodes.value[node] = float(weight)
            if level == DEPTH:
                continue
            left_g, left_h = g[i].cumsum(axis=1)[:, :-1], h[i].cumsum(axis=1)[:, :-1]
            right_g, right_h = all_g - left_g, all_h - left_h
            left, right = _weight(left_g, left_h, low, high), _weight(right_g, right_h, low, high)
            gain = _gain(left_g, left_h, left) + _gain(right_g, right_h, right) - _gain(all_g, all_h, weight)
            against = directions[:, None] * (right - left) < 0
            gain[against | (left_h < LEAST_CHILD) | (right_h < LEAST_CHILD)] = -np.inf
            f, b = np.unravel_index(gain.argmax(), gain.shape)
            if not gain[f, b] > LEAST_GAIN:
                continue
            one, two = nodes.add(), nodes.add()
            nodes.feature[node], nodes.threshold[node], nodes.left[node], nodes.right[node] = int(f), float(edges[f][b]), one, two
            middle = (left[f, b] + right[f, b]) / 2
            bounds[one] = (middle if directions[f] < 0 else low, middle if directions[f] > 0 else high)
            bounds[two] = (middle if directions[f] > 0 else low, middle if directions[f] < 0 else high)
            own = rows[mine[rows] == i]
            at[own] = np.where(codes[own, f] <= b, one, two)
            following += [one, two]
        open_ = following
        if not open_:
            break
    return root, at


def boost(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Trees:
    """Trees on the logistic loss of weighted rows; equal rows in any order give equal trees."""
    d = x.shape[1]
    directions = np.array([MONOTONE.get(f, 0) for f in FEATURES][:d])
    edges = []
    for j in range(d):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
        edges.append(np.concatenate([cuts, np.full(BINS - 1 - len(cuts), np.inf)]))
    codes = np.column_stack([np.searchsorted(edges[j], x[:, j]) for j in range(d)])
    share = np.clip((weight * label).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    margin, nodes, roots = np.full(len(x), bias), _Nodes(), []
    for _ in range(TREES):
        p = 1.0 / (1.0 + np.exp(-margin))
        before = len(nodes.value)
        root, at = _grow(nodes, codes, edges, weight * (p - label), weight * p * (1 - p), directions)
        roots.append(root)
        nodes.value[before:] = [RATE * v for v in nodes.value[before:]]
        margin += np.array(nodes.value)[at]
    return Trees(bias, np.array(roots), np.array(nodes.feature), np.array(nodes.threshold), np.array(nodes.left),
                 np.array(nodes.right), np.array(nodes.value), DEPTH)


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "quality", sample: int = SAMPLE_PER_CLASS) -> Trees | None:
    """Trees from the documents whose id has label 0 or 1 (a null text counts as empty); None if a class has no row.

    The classes weigh as in all of ``labels``.
    """
    rows, counts = sampled_texts(docs, labels, sample, id_column, text_column, label_column)

    def features(batches):
        for batch in batches:
            _, x = table_of(batch.column("text"))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["label", "x"])

    found = map_arrow(rows, features, "label int, x array<double>").collect()  # the bounded sample
    label = np.array([r["label"] for r in found], dtype=float)
    if not (label == 1).any() or not (label == 0).any():
        return None
    x = np.array([r["x"] for r in found])
    order = np.lexsort((*x.T, label))
    x, label = x[order], label[order]
    weight = np.where(label == 1, counts[1] / (label == 1).sum(), counts[0] / (label == 0).sum())
    return boost(x, label, weight * len(x) / (counts[0] + counts[1]))


def judge(docs: DataFrame, model: Trees | None, text_column: str = "text", least_score: float = LEAST_SCORE) -> tuple[DataFrame, dict[str, str]]:
    """All rows of ``docs`` with base counts, ``base_failed``, ``rule_score`` and ``kept``; and the names these have
    (numbered where taken).

    A text that fails a base rule is not kept; any other is kept if its score reaches ``least_score``.  A null or
    empty text has no words and fails.  Without a model the score is null and the base rules decide.  Whole
    texts count, one at a time, whatever their length; repeated rows get equal verdicts.
    """
    added = {name: unused(docs, name) for name in [*BASE, "base_failed", "rule_score", "kept"]}
    place, width = docs.columns.index(text_column), len(docs.columns)

    def work(batches):
        for batch in batches:
            base, x = table_of(batch.column(place))
            failed = (base[:, 0] < LEAST_WORDS) | (100 * base[:, 4] > MOST_REPEATED * base[:, 0])
            score = model.score(x) if model else np.ones(len(x))
            arrays = [*batch.columns, *[pa.array(np.ascontiguousarray(base[:, j])) for j in range(len(BASE))], pa.array(failed),
                      pa.array(score if model else [None] * len(x), pa.float64()), pa.array(~failed & ((score >= least_score) if model else True))]
            yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])

    kinds = [f.dataType.simpleString() for f in docs.schema] + ["bigint"] * len(BASE) + ["boolean", "double", "boolean"]
    plain = docs.toDF(*[f"c{i}" for i in range(width)])
    out = map_arrow(plain, work, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds)))
    return out.toDF(*docs.columns, *added.values()), added
