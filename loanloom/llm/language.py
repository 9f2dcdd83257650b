"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of hashed 2- and 3-byte grams of its lower-cased
letters, scaled to length one.  Each language has several spherical k-means centroids; a text
takes the language of the centroid with the largest cosine.  A text whose best
cosine lies below what nearly all texts of its length reach is not accepted.

Document frequencies, centroids and acceptance bounds come from all training rows.  Only the first
centres are found on at most ``SAMPLE_PER_LANGUAGE`` rows of each language, taken by key hash: every row then
joins the nearest one of its language, and a centroid is the mean of all its rows.  For
the bounds each row is left out of its own centroid, and its beginnings of
many lengths count as well, so that short texts have bounds where few rows are short.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.frames import map_arrow, quoted, received, sent, unused
from loanloom.llm.sampling import sampled_keys
from loanloom.llm.tokens import slices, utf8

DIMENSIONS = 4096
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 800
#: A text is rejected if its cosine is below this share of the median of its length and below what all but this part of
#: such texts reach; below the least bound it is rejected anyway.
REJECT_SHARE, REJECT_PART, LEAST_FLOOR = 0.36, 0.01, 0.04
#: Characters of the beginnings that count for the bounds, two to each length class.
BEGINNINGS = [4, 6, 8, 11, 16, 23, 32, 45, 64, 90, 128, 181, 256, 362, 512, 724, 1024, 1448, 2048, 2896, 4096]
_CLASSES, _BINS, _ROWS = 64, 500, 64
UNKNOWN = "und"
_SMALL = 1 << 19
#: Steps of 1 in which the sums of centroids are added.
_UNIT = float(1 << 32)


def _letter_codes() -> np.ndarray:
    """Byte to code: letters and bytes above ASCII keep their value, all else counts as a blank."""
    codes = np.full(256, 32, dtype=np.uint32)
    codes[97:123] = np.arange(97, 123)
    codes[128:] = np.arange(128, 256)
    return codes


_CODES = _letter_codes()


def gram_counts(texts: pa.Array) -> np.ndarray:
    """Rows of hashed gram counts; runs of blanks are one blank and hold no gram of their own."""
    data, offsets = utf8(pc.utf8_lower(texts))
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    codes = _CODES[data]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32) | (row[1:] != row[:-1])
    codes, row = codes[keep], row[keep]
    cells = []
    for size in (2, 3):
        if len(codes) < size:
            continue
        n = len(codes) - size + 1
        gram = np.full(n, size, dtype=np.uint32)
        for j in range(size):
            gram = gram * np.uint32(0x01000193) + codes[j:j + n]
        gram = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 12)
        inside = row[:n] == row[size - 1:]
        cells.append(row[:n][inside] * DIMENSIONS + gram[inside])
    return np.bincount(np.concatenate(cells) if cells else np.zeros(0, np.int64), minlength=rows * DIMENSIONS).reshape(rows, DIMENSIONS)


def unit_rows(x: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(norms > 0, norms, 1.0)[:, None]


def vectors(counts: np.ndarray, idf: np.ndarray, sparse: bool = False) -> np.ndarray:
    """Unit rows of weighted counts; ``sparse`` takes the logarithm of those that are not 0 alone, which pays for short texts."""
    if not sparse:
        return unit_rows(np.log1p(counts) * idf)
    out = np.zeros(counts.shape)
    at = np.flatnonzero(counts)
    row = at // counts.shape[1]
    value = np.log1p(counts.ravel()[at]) * idf[at % counts.shape[1]]
    norms = np.sqrt(np.bincount(row, value * value, len(counts)))
    out.ravel()[at] = value / norms[row]
    return out


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; the first is the row nearest the mean, each next one the row least covered so far."""
    k = max(1, min(k, len(x)))
    centres = [x[int(np.argmax(x @ x.mean(axis=0)))]]
    while len(centres) < k:
        centres.append(x[int(np.argmin((x @ np.array(centres).T).max(axis=1)))])
    centres = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        centres = unit_rows(np.array([x[own == j].mean(axis=0) if (own == j).any() else centres[j] for j in range(k)]))
    return centres


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(1.0 + counts.sum(axis=1)).astype(int)


@dataclass
class LanguageModel:
    languages: list[str]
    owner: np.ndarray       # language of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray      # least cosine accepted, by length class

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and acceptance of each text."""
        counts = gram_counts(texts)
        cosines = vectors(counts, self.idf) @ self.centroids.T
        best = np.full((len(counts), len(self.languages)), -1.0)
        for j, language in enumerate(self.owner):
            best[:, language] = np.maximum(best[:, language], cosines[:, j])
        chosen = np.argmax(best, axis=1)
        top = best[np.arange(len(best)), chosen]
        share = np.exp(20.0 * (best - top[:, None])).sum(axis=1)
        floor = self.floors[np.minimum(length_class(counts), len(self.floors) - 1)]
        return chosen, np.clip(top, 0.0, 1.0) / share, (top > 0) & (top >= floor)


def fit(training: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        centroids: int = CENTROIDS, sample: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Fit on rows with a text and a language; others are ignored.  Without any such row the model rejects all."""
    rows = training.select(quoted(id_column).alias("id"), quoted(text_column).alias("text"),
                           quoted(lang_column).alias("lang")).where("text is not null and lang is not null")

    def frequencies(batches):
        held, n = np.zeros(DIMENSIONS), 0
        for batch in batches:
            column = batch.column("text")
            for a, b in slices(column, _SMALL):
                counts = gram_counts(column.slice(a, b - a))
                held += (counts > 0).sum(axis=0)
                n += len(counts)
        yield pa.RecordBatch.from_pydict({"gram": np.arange(-1, DIMENSIONS), "held": np.concatenate(([n], held)).astype(np.int64)})

    held = {r["gram"]: r["held"] for r in map_arrow(rows.select("text"), frequencies, "gram long, held long")
            .groupBy("gram").agg(F.sum("held").alias("held")).collect()}  # one row per dimension
    n = held.get(-1, 0)
    if not n:
        return LanguageModel([], np.zeros(0, int), np.zeros((0, DIMENSIONS)), np.ones(DIMENSIONS), np.zeros(1))
    idf = np.log((1.0 + n) / (1.0 + np.array([held.get(i, 0) for i in range(DIMENSIONS)]))) + 1.0

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        column = pa.array(pdf["text"], pa.large_string())
        parts = [gram_counts(column.slice(a, b - a)).astype(np.float32) for a, b in slices(column, _SMALL)]
        counts = np.concatenate(parts)
        x = vectors(counts, idf.astype(np.float32))
        centres = spherical_kmeans(x, centroids)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centres": [centres.astype(float).ravel().tolist()]})

    keys, _ = sampled_keys(rows.where("id is not null").select("id", F.col("lang").alias("label")), sample)
    drawn = rows.join(F.broadcast(keys.select("id").distinct()), "id")
    fitted = drawn.groupBy("lang").applyInPandas(cluster, "lang string, centres array<double>").orderBy("lang").collect()
    if not fitted:
        return LanguageModel([], np.zeros(0, int), np.zeros((0, DIMENSIONS)), idf, np.zeros(1))
    languages = [r["lang"] for r in fitted]
    centres = [np.array(r["centres"]).reshape(-1, DIMENSIONS) for r in fitted]
    owner = np.concatenate([np.full(len(c), i) for i, c in enumerate(centres)])
    first = LanguageModel(languages, owner, np.concatenate(centres), idf, np.zeros(1))
    held_first = sent(rows.sparkSession, first)

    def pieces(batches, first):
        """Texts and language numbers of some rows at a time; languages without a centre are left out."""
        number = {language: i for i, language in enumerate(first.languages)}
        for batch in batches:
            label = np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            at = np.flatnonzero(label >= 0)
            column, label = batch.column("text").take(pa.array(at)), label[at]
            for a, b in slices(column, _SMALL):
                for c in range(a, b, _ROWS):
                    d = min(b, c + _ROWS)
                    yield column.slice(c, d - c), label[c:d]

    def join(batches):
        first = received(held_first)
        totals = np.zeros(first.centroids.shape)
        for texts, label in pieces(batches, first):
            x = vectors(gram_counts(texts), first.idf)
            mine = members(first, x, label)
            for j in np.unique(mine):
                totals[j] += x[mine == j].sum(axis=0)
        centre, gram = np.nonzero(totals)
        # Whole numbers, so that the order in which tasks are added makes no difference.
        value = np.rint(totals[centre, gram] * _UNIT).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"centre": centre.astype(np.int32), "gram": gram.astype(np.int32), "value": value})

    joined = map_arrow(rows.select("lang", "text"), join, "centre int, gram int, value long").groupBy("centre", "gram").agg(
        F.sum("value").alias("value")).toArrow()    # at most a row for each centroid and dimension
    whole = np.zeros(first.centroids.shape)
    whole[np.asarray(joined["centre"]), np.asarray(joined["gram"])] = np.asarray(joined["value"]) / _UNIT
    sums = np.linalg.norm(whole, axis=1)
    model = LanguageModel(languages, owner, np.where(sums[:, None] > 0, unit_rows(whole), first.centroids), idf, np.zeros(1))
    held_model = sent(rows.sparkSession, model)

    def reach(batches):
        first, model = received(held_first), received(held_model)
        totals = np.zeros(_CLASSES * _BINS, dtype=np.int64)
        for texts, label in pieces(batches, first):
            totals += reached(first, model, sums, texts, label)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"cell": at, "n": totals[at]})

    cells = map_arrow(rows.select("lang", "text"), reach, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(_CLASSES * _BINS, dtype=np.int64)
    for r in cells:     # at most a row for each class and bin
        totals[r["cell"]] = r["n"]
    model.floors = acceptance_floors(totals.reshape(_CLASSES, _BINS))
    return model


def members(first: LanguageModel, x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The centre of its own language that each row joins."""
    return np.argmax(np.where(first.owner == label[:, None], x @ first.centroids.T, -2.0), axis=1)


def reached(first: LanguageModel, model: LanguageModel, sums: np.ndarray, texts: pa.Array, label: np.ndarray) -> np.ndarray:
    """Counts by length class and bin of the best cosines of training texts and of their beginnings.

    A row takes no part in the centroid it helped to make: ``sums`` are the lengths of the summed members of each, who
    joined the centres of ``first``.
    """
    counts = gram_counts(texts)
    x = vectors(counts, model.idf)
    mine = members(first, x, label)
    weight = sums[mine]
    cosines = np.einsum("ij,ij->i", x, model.centroids[mine])
    rest = np.sqrt(np.maximum(weight ** 2 - 2.0 * weight * cosines + 1.0, 0.0))
    totals = np.zeros(_CLASSES * _BINS, dtype=np.int64)

    def add(at: np.ndarray, counts: np.ndarray, y: np.ndarray) -> None:
        cosines = y @ model.centroids.T
        place = np.arange(len(at)), mine[at]
        without = weight[at] * cosines[place] - np.einsum("ij,ij->i", x[at], y)
        cosines[place] = np.where(rest[at] > 1e-6, without / np.maximum(rest[at], 1e-6), 0.0)
        best = cosines.max(axis=1)
        cell = np.minimum(length_class(counts), _CLASSES - 1) * _BINS + np.minimum((best * _BINS).astype(int), _BINS - 1)
        np.add.at(totals, cell[best > 1e-9], 1)     # what is like no other row says nothing of the others

    add(np.arange(len(x)), counts, x)
    lengths = np.asarray(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    for length in BEGINNINGS:
        at = np.flatnonzero(lengths > length)
        if len(at):
            counts = gram_counts(pc.utf8_slice_codeunits(texts.take(pa.array(at)), 0, length))
            add(at, counts, vectors(counts, model.idf, sparse=True))
    return totals


def acceptance_floors(totals: np.ndarray, least: int = 30) -> np.ndarray:
    """The bound of each length class from the counts of cosines by class and bin.

    A class with few texts takes that of its shorter neighbour, and before the first other class that of all texts together.
    """
    def floor(row: np.ndarray) -> float:
        low, middle = np.searchsorted(np.cumsum(row), np.maximum(1.0, np.array([REJECT_PART, 0.5]) * row.sum())) / len(row)
        return max(LEAST_FLOOR, min(low, REJECT_SHARE * middle))

    floors = np.zeros(len(totals))
    full = totals.sum(axis=1) >= least
    # Shorter texts reach less, so what holds for all is no more than the bound of the first class that has one.
    known = LEAST_FLOOR
    if totals.any():
        known = floor(totals.sum(axis=0))
        if full.any():
            known = min(known, floor(totals[int(np.argmax(full))]))
    for c, row in enumerate(totals):
        if full[c]:
            known = floor(row)
        floors[c] = known
    return floors


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns of ``docs`` with language, score and acceptance added.

    Returns the frame and the names of the three new columns (``lang_pred``,
    ``score``, ``accepted``, with a number where ``docs`` has such a column).
    A text that is null or has no letter is ``und``, score 0, not accepted.
    Null keys, repeated rows and other columns pass through unchanged; an
    empty table gives an empty table.
    """
    added = {name: unused(docs, name) for name in ("lang_pred", "score", "accepted")}
    place = docs.columns.index(text_column)

    def work(batches):
        for batch in batches:
            column = batch.column(place)
            lettered = np.asarray(pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False), dtype=bool)
            lang, score, accepted = [], [], []
            for a, b in slices(column, _SMALL):
                if model.languages:
                    chosen, value, good = model.predict(column.slice(a, b - a))
                else:
                    chosen, value, good = np.full(b - a, -1), np.zeros(b - a), np.zeros(b - a, bool)
                has = lettered[a:b] & (chosen >= 0)
                lang += [model.languages[c] if h else UNKNOWN for c, h in zip(chosen, has)]
                score.append(np.where(has, value, 0.0))
                accepted.append(good & has)
            arrays = [*batch.columns, pa.array(lang, pa.string()),
                      pa.array(np.concatenate(score) if score else [], pa.float64()),
                      pa.array(np.concatenate(accepted) if accepted else [], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])

    # Columns go by place, so that names that repeat in case or hold dots do no harm.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kinds = [f.dataType.simpleString() for f in docs.schema] + ["string", "double", "boolean"]
    out = map_arrow(plain, work, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds)))
    return out.toDF(*docs.columns, *added.values()), added


def accepted_rows(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """The rows whose language was accepted, with the columns they came with."""
    out, added = identify(docs, model, text_column)
    return out.where(quoted(added["accepted"])).drop(*added.values())
