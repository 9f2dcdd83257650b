"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words and their first bytes (a stem under many endings is one token).
Their scores are log-odds between the toxic and the clean class under an
informative Dirichlet prior (the token's own frequency over both classes), on
counts of the texts that hold the token.  A word scores as its longest form with a significant
difference; any other word costs a small constant.  One linear scan
finds all maximal scoring segments of a text.  A segment of score S in a text of n tokens has
the extreme-value expectation E = K n exp(-lambda S); those with E below a
bound are passages.  The score of a text is a logistic function of the
summed -log E of its passages.

Token counts and the calibration come from at most ``SAMPLE_PER_CLASS`` labelled
rows of each class, taken by key hash; class shares come from all labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.frames import map_arrow, stored, unused
from loanloom.llm.sampling import sampled_texts
from loanloom.llm.tokens import NON_WORD, mixed, slices, span_hashes, spans, utf8

SAMPLE_PER_CLASS = 8_000
STEMS = (6, 5, 4, 3)       # first bytes of a word that count as a token, longest first
PRIOR_SHARE, PRIOR_LEAST = 0.1, 0.5   # Dirichlet prior of a token: this share of its own count over both classes, and this much more
LEAST_Z = 3.0              # z-score from which a token's log-odds count
DRIFT = 0.5                # cost of any other token
LARGEST_E = 0.5            # a segment with a larger expectation is chance
MODEL_TOKENS = 200_000     # size bound of the token table; with the sample bound it is not reached in practice
EVIDENCE_BINS, EVIDENCE_STEP = 400, 0.25


@dataclass
class Passage:
    row: int
    first: int      # token numbers within the text
    last: int
    score: float
    expectation: float


@dataclass
class ToxicityModel:
    tokens: np.ndarray      # sorted hashes
    scores: np.ndarray
    rate: float             # lambda
    scale: float            # K
    slope: float = 1.0
    offset: float = -1.0

    def passages(self, forms: list[np.ndarray], first: np.ndarray) -> list[Passage]:
        """All significant maximal segments of each row, in order."""
        if not len(forms[0]) or not len(self.tokens):
            return []
        word_scores = np.zeros(len(forms[0]))
        for codes in reversed(forms):
            at = np.minimum(np.searchsorted(self.tokens, codes), len(self.tokens) - 1)
            known = self.tokens[at] == codes
            word_scores[known] = self.scores[at[known]]
        # A word said again at once is scored once, so that a run of one word is no passage; the first word of a row repeats none.
        again = np.zeros(len(word_scores), dtype=bool)
        again[1:] = forms[0][1:] == forms[0][:-1]
        again[first[:-1][first[:-1] < len(again)]] = False
        word_scores[again] = 0.0
        hits = np.flatnonzero(word_scores)
        values = word_scores[hits]
        rows = np.searchsorted(first, hits, side="right") - 1
        found = []
        for row in np.unique(rows[values > 0]):
            lo, hi = np.searchsorted(rows, [row, row + 1])
            n = int(first[row + 1] - first[row])
            for a, b, score in maximal_segments(hits[lo:hi] - first[row], values[lo:hi], DRIFT):
                e = self.scale * n * np.exp(-self.rate * score)
                if e <= LARGEST_E:
                    found.append(Passage(int(row), a, b, score, float(e)))
        return found

    def evidence(self, forms: list[np.ndarray], first: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first) - 1)
        for p in self.passages(forms, first):
            out[p.row] += min(-np.log(max(p.expectation, 1e-40)), 60.0)
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.offset + self.slope * evidence, -500, 500)))


def maximal_segments(places: np.ndarray, values: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (Ruzzo and Tompa) of a sequence given by its scored places.

    Every place not named costs ``drift``.  A candidate is kept with the running sums before
    and after it; each new positive token joins to the left while that raises the sum.
    """
    kept: list[tuple[int, int, float, float]] = []   # first, last, sum before, sum after
    total, before = 0.0, 0
    for place, value in zip(places.tolist(), values.tolist()):
        total -= drift * (place - before)
        before = place + 1
        left, total = total, total + value
        if value <= 0:
            continue
        first, right = place, total
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j -= 1
            if j < 0 or kept[j][3] >= right:
                break
            first, left = kept[j][0], kept[j][2]
            del kept[j:]
        kept.append((first, place, left, right))
    return [(a, b, right - left) for a, b, left, right in kept]


def token_forms(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of all words, then of their first bytes by ``STEMS`` (0 where the word is no longer), and the first word of each row.

    Case does not count for ASCII letters.
    """
    data, offsets = utf8(texts)
    lower = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    starts, stops, first = spans(data, offsets, NON_WORD)
    return forms_of(lower, starts, stops), first


def forms_of(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
    forms = [span_hashes(data, starts, stops)]
    for size in STEMS:
        longer = stops - starts > size
        codes = np.zeros(len(starts), dtype=np.uint64)
        # The stem of a word is another token than the word of the same bytes.
        codes[longer] = mixed(span_hashes(data, starts[longer], starts[longer] + size) + np.uint64(size))
        forms.append(codes)
    return forms


def unique_pairs(row: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token of each row once; code 0 is no token."""
    order = np.lexsort((codes, row))
    row, codes = row[order], codes[order]
    keep = codes != 0
    keep[1:] &= (row[1:] != row[:-1]) | (codes[1:] != codes[:-1])
    return row[keep], codes[keep]


def _evd(scores: np.ndarray, shares: np.ndarray, drift_share: float) -> tuple[float, float]:
    """lambda with sum p exp(lambda s) = 1 over clean text, and a conservative K of 1 - sum of p exp(lambda s) over s < 0."""
    def excess(rate: float) -> float:
        return float(np.sum(shares * np.exp(np.minimum(rate * scores, 700))) + drift_share * np.exp(-rate * DRIFT) - 1.0)
    low, high = 1e-6, 50.0
    if excess(high) <= 0:
        return high, 1.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low, float(np.clip(1.0 - drift_share * np.exp(-low * DRIFT), 1e-3, 1.0))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "toxic", sample: int = SAMPLE_PER_CLASS) -> ToxicityModel | None:
    """Fit on documents whose id has label 0 or 1 (a null text counts as empty); None if a class has no row."""
    drawn, all_counts = sampled_texts(docs, labels, sample, id_column, text_column, label_column)
    if len(all_counts) < 2:
        return None
    drawn = stored(drawn, "toxicity-sample")

    def count_tokens(batches):
        for batch in batches:
            text, label = batch.column("text"), np.asarray(batch.column("label"))
            for a, b in slices(text):
                forms, first = token_forms(text.slice(a, b - a))
                row = np.repeat(np.arange(a, b), np.diff(first))
                pairs = [unique_pairs(row, codes) for codes in forms]
                row, codes = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
                token, inverse = np.unique(codes, return_inverse=True)
                toxic = np.bincount(inverse, label[row], len(token)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"token": token.view(np.int64), "toxic": toxic, "clean": np.bincount(inverse, minlength=len(token)) - toxic})

    counts = (map_arrow(drawn, count_tokens, "token long, toxic long, clean long")
              .groupBy("token").agg(F.sum("toxic").alias("y1"), F.sum("clean").alias("y0")))
    counts = stored(counts, "toxicity-tokens")
    n1, n0, kinds = counts.agg(F.sum("y1"), F.sum("y0"), F.count("*")).first()
    if not n1 or not n0:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0)
    a_w = (F.col("y1") + F.col("y0")) * PRIOR_SHARE + PRIOR_LEAST
    a_0 = (n1 + n0) * PRIOR_SHARE + kinds * PRIOR_LEAST
    odds = [F.log((y + a_w) / (F.lit(float(n) + a_0) - y - a_w)) for y, n in ((F.col("y1"), n1), (F.col("y0"), n0))]
    delta = odds[0] - odds[1]
    z = delta / F.sqrt(1 / (F.col("y1") + a_w) + 1 / (F.col("y0") + a_w))
    telling = (counts.select("token", "y0", delta.alias("delta"), z.alias("z")).where(F.abs("z") >= LEAST_Z)
               .orderBy(F.desc(F.abs("z")), "token").limit(MODEL_TOKENS).collect())
    tokens = np.array([r["token"] for r in telling], dtype=np.int64).view(np.uint64)
    scores = np.array([r["delta"] for r in telling])
    shares = (np.array([r["y0"] for r in telling], dtype=float) + 0.5) / (n0 + 1.0)
    by = np.argsort(tokens)
    model = ToxicityModel(tokens[by], scores[by], *_evd(scores, shares, max(0.0, 1.0 - shares.sum())))

    def binned(batches):
        table = np.zeros((2, EVIDENCE_BINS), dtype=np.int64)
        for batch in batches:
            text, label = batch.column("text"), np.asarray(batch.column("label"))
            for a, b in slices(text):
                bins = np.minimum(model.evidence(*token_forms(text.slice(a, b - a))) / EVIDENCE_STEP, EVIDENCE_BINS - 1).astype(int)
                np.add.at(table, (label[a:b], bins), 1)
        for k in (0, 1):
            yield pa.RecordBatch.from_pydict({"label": np.full(EVIDENCE_BINS, k, np.int32), "bin": np.arange(EVIDENCE_BINS), "n": table[k]})

    table = np.zeros((2, EVIDENCE_BINS))
    for r in map_arrow(drawn, binned, "label int, bin long, n long").groupBy("label", "bin").agg(F.sum("n").alias("n")).collect():
        table[r["label"], r["bin"]] = r["n"]
    # Weigh the two samples back to the shares of all labelled rows.
    weights = table * np.array([[all_counts[k] / max(table[k].sum(), 1)] for k in (0, 1)])
    model.offset, model.slope = calibrated(np.arange(EVIDENCE_BINS) * EVIDENCE_STEP, weights)
    return model


def calibrated(x: np.ndarray, weights: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Ridge-guarded Newton steps of a one-variable logistic fit on weighted bins (row 1: label 1)."""
    beta = np.zeros(2)
    design = np.column_stack([np.ones_like(x), x])
    total = weights.sum(axis=0)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weights[1] - total * p) - 1e-2 * beta
        hessian = (design * (total * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def score_rows(docs: DataFrame, model: ToxicityModel | None, text_column: str = "text",
               names: tuple[str, str] = ("score", "passages")) -> DataFrame:
    """All rows of ``docs`` with a score and the toxic passages added.

    A passage is (first token, last token, score, expectation).  A null or empty text has
    no passage and the base score; without a model every score is 0.  New columns get a number if their name is taken.
    """
    score_name = unused(docs, names[0])
    passage_name = unused(docs, names[1])
    place = docs.columns.index(text_column)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("expectation", pa.float64())]))

    def work(batches):
        for batch in batches:
            column = batch.column(place)
            scores, passages = [], []
            for a, b in slices(column):
                own = [[] for _ in range(b - a)]
                evidence = np.zeros(b - a)
                if model:
                    for p in model.passages(*token_forms(column.slice(a, b - a))):
                        evidence[p.row] += min(-np.log(max(p.expectation, 1e-40)), 60.0)
                        own[p.row].append({"first": p.first, "last": p.last, "score": p.score, "expectation": p.expectation})
                scores.append(model.score(evidence) if model else evidence)
                passages += own
            arrays = [*batch.columns, pa.array(np.concatenate(scores) if scores else np.zeros(0)), pa.array(passages, kind)]
            yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kinds = [f.dataType.simpleString() for f in docs.schema] + ["double", "array<struct<first:bigint,last:bigint,score:double,expectation:double>>"]
    return map_arrow(plain, work, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))).toDF(*docs.columns, score_name, passage_name)
