"""Benchmark decontamination by spaced-seed hashing.

A window of ``SPAN`` words is cut into four blocks; each of the six masks looks
at two blocks and ignores the other two, so that a window with at most two
substituted words agrees under at least one mask.  An item of fewer words is one window, of
four blocks, or of three if only one of its words may be substituted.  Masked hashes of the test
items are met with those of every document window; each agreement is verified
on its diagonal: some run that begins and ends with equal words must be long enough and have few
substitutions, and the longest such run is told.

The test set is the small side.  It is taken in blocks of a fixed size, each of which
is sent to all tasks; documents are read once for each block and never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.frames import map_arrow, quoted, received, sent
from loanloom.llm.tokens import NON_WORD, mixed, slices, utf8, words

SPAN, PIECE = 12, 3
#: Masks as word offsets within a window.
MASKS = [np.array([PIECE * p + j for p in pair for j in range(PIECE)]) for pair in combinations(range(SPAN // PIECE), 2)]
#: An item of fewer words is too common to prove anything; one of fewer than SPAN words counts as a whole.
LEAST_ITEM = 5
#: Least words of a verified run, and the least share of them that are equal, as equal words to each substituted one.
LEAST_RUN, EQUAL_TO_EACH = 12, 3
#: Sets of places with more pairs than this meet by convolution, others in portions of so many pairs.
PAIRED, PAIRS_AT_ONCE = 1 << 16, 1 << 21
#: Text bytes of test items held by a task at once.
BLOCK_BYTES = 8 << 20
_FILTER_BITS = 22
#: Characters of scripts that set no blanks between words, and their punctuation; bytes that begin such a character.
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
_PUNCTUATION = r"[\x{3000}-\x{3004}\x{3008}-\x{3020}\x{3030}\x{303D}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}]"
_LEADS = np.zeros(256, dtype=bool)
_LEADS[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True


def item_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and the first word of each row; a character of a script without blanks is a word."""
    if _LEADS[utf8(texts)[0]].any():
        texts = pc.replace_substring_regex(pc.replace_substring_regex(texts, _PUNCTUATION, " "), _UNSPACED, r" \1 ")
    return words(texts, NON_WORD)


def short_masks(span: int) -> list[np.ndarray]:
    """Masks over a whole item of fewer than ``SPAN`` words: any substitutions that leave three quarters equal miss one of them."""
    blocks = 4 if span >= 8 else 3
    cuts = np.linspace(0, span, blocks + 1).round().astype(int)
    return [np.concatenate([np.arange(cuts[p], cuts[p + 1]) for p in pair]) for pair in combinations(range(blocks), 2)]


def masked_hashes(codes: np.ndarray, mask: np.ndarray, span: int, number: int) -> np.ndarray:
    """Hash of every window of ``span`` words under a mask."""
    n = len(codes) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, number + 1, dtype=np.uint64)
    for offset in mask:
        out = out * np.uint64(0x9FB21C651E98DF25) + codes[offset:offset + n]
    return mixed(out)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where each run of equal rows of sorted columns begins, and the end."""
    n = len(columns[0])
    fresh = np.ones(n, dtype=bool)
    if n:
        fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.append(np.flatnonzero(fresh), n)


def _differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distinct differences of two sets of places."""
    low_a, high_b = int(a.min()), int(b.max())
    n = int(a.max()) - low_a + high_b - int(b.min()) + 1
    size = 1 << (n - 1).bit_length()
    x, y = np.zeros(size), np.zeros(size)
    x[a - low_a] = 1
    y[high_b - b] = 1
    return np.flatnonzero(np.fft.irfft(np.fft.rfft(x) * np.fft.rfft(y), size)[:n] > 0.5) + low_a - high_b


@dataclass
class SeedIndex:
    """Masked hashes of a block of test items, with the words of the items for verification."""
    item_ids: list
    codes: np.ndarray
    first: np.ndarray
    masks: list[tuple[np.ndarray, int, int]]    # offsets, span, number
    keys: np.ndarray        # of each key and item that holds it, sorted
    item: np.ndarray
    start: np.ndarray       # where its places begin in ``place``, and one end more
    place: np.ndarray
    _filter: np.ndarray | None = field(default=None, repr=False)

    @staticmethod
    def build(item_ids: list, texts: list) -> SeedIndex:
        codes, first = item_words(pa.array(texts, pa.large_string()))
        lengths = np.diff(first)
        masks = [(mask, SPAN, k) for k, mask in enumerate(MASKS)]
        masks += [(mask, int(n), 100 * int(n) + k) for n in np.unique(lengths[(lengths >= LEAST_ITEM) & (lengths < SPAN)])
                  for k, mask in enumerate(short_masks(int(n)))]
        keys, item, place = [], [], []
        for i, n in enumerate(lengths):
            own = codes[first[i]:first[i + 1]]
            for mask, span, number in masks:
                if (span == SPAN and n >= SPAN) or span == n:
                    h = masked_hashes(own, mask, span, number)
                    keys.append(h)
                    item.append(np.full(len(h), i))
                    place.append(np.arange(len(h)))
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, item, place)]
        key, item, place = flat[0].astype(np.uint64), flat[1], flat[2]
        by = np.lexsort((place, item, key))
        key, item, place = key[by], item[by], place[by]
        start = _starts(key, item)
        return SeedIndex(item_ids, codes, first, masks, key[start[:-1]], item[start[:-1]], start, place)

    def _seen(self) -> np.ndarray:
        if self._filter is None:
            self._filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
            self._filter[self.keys >> np.uint64(64 - _FILTER_BITS)] = True
        return self._filter

    def overlaps(self, codes: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int, int]]:
        """(row, item) -> run length, equal words, first document word and first item word of the longest verified run."""
        hits = []
        if not len(self.keys):
            return {}
        for mask, span, number in self.masks:
            h = masked_hashes(codes, mask, span, number)
            at = np.flatnonzero(self._seen()[h >> np.uint64(64 - _FILTER_BITS)])
            if not len(at):
                continue
            row = np.searchsorted(first, at, side="right") - 1
            inside = at + span <= first[row + 1]
            at, row = at[inside], row[inside]
            hits += self._diagonals(codes, first, h[at], at, row, span)
        found: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        if not hits:
            return found
        row, item, diagonal = np.unique(np.concatenate(hits), axis=0).T
        # Diagonals of the longest overlap come first: one that cannot beat the run found so far is not looked at.
        over = np.minimum(np.diff(self.first)[item], np.diff(first)[row] - diagonal) - np.maximum(0, -diagonal)
        for k in np.lexsort((diagonal, -over, item, row)).tolist():
            r, i, d = int(row[k]), int(item[k]), int(diagonal[k])
            best = found.get((r, i), (0, 0, 0, 0))
            if (over[k], over[k], -max(0, d)) <= (best[0], best[1], -best[2]):
                continue
            run = self._verified(codes[first[r]:first[r + 1]], i, d)
            if run and (run[0], run[1], -run[2]) > (best[0], best[1], -best[2]):
                found[r, i] = run
        return found

    def _diagonals(self, codes, first, h, at, row, span) -> list[np.ndarray]:
        """Rows of (row, item, document place less item place), each once in a part, of the windows ``at`` with hashes ``h``.

        The windows of a row with one hash meet those of an item with this hash as two sets of places.  Small ones are paired;
        for large ones, as in texts that repeat themselves, the differences come from one convolution.
        """
        order = np.lexsort((at, h, row))
        h, at, row = h[order], at[order], row[order]
        begin = _starts(row, h)
        low, high = (np.searchsorted(self.keys, h[begin[:-1]], side=s) for s in ("left", "right"))
        n = high - low
        doc = np.repeat(np.arange(len(n)), n)
        ref = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        wide = np.diff(self.start)[ref]
        size = np.diff(begin)[doc] * wide
        out = []
        crowded = (size > PAIRED) & (wide > 1)
        for d, g in zip(doc[crowded].tolist(), ref[crowded].tolist()):
            places, own = at[begin[d]:begin[d + 1]] - first[row[begin[d]]], self.place[self.start[g]:self.start[g + 1]]
            apart = _differences(places, own)
            out.append(np.column_stack([np.full(len(apart), row[begin[d]]), np.full(len(apart), self.item[g]), apart]))
        doc, ref, wide, size = doc[~crowded], ref[~crowded], wide[~crowded], size[~crowded]
        ends = np.cumsum(size)
        cuts = [0]
        while cuts[-1] < len(size):
            done = ends[cuts[-1] - 1] if cuts[-1] else 0
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right"))))
        for a, b in zip(cuts[:-1], cuts[1:]):
            which = np.repeat(np.arange(a, b), size[a:b])
            k = np.arange(len(which)) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
            here = at[begin[doc[which]] + k // wide[which]]
            place = self.place[self.start[ref[which]] + k % wide[which]]
            item, of = self.item[ref[which]], row[begin[doc[which]]]
            if span < SPAN:     # few words under a mask are often met by chance
                same = sum((codes[here + j] == self.codes[self.first[item] + j]).astype(int) for j in range(span))
                good = same >= EQUAL_TO_EACH * (span - same)
                here, place, item, of = here[good], place[good], item[good], of[good]
            out.append(np.unique(np.column_stack([of, item, here - first[of] - place]), axis=0))
        return out

    def _verified(self, doc: np.ndarray, item: int, diagonal: int) -> tuple[int, int, int, int] | None:
        own = self.codes[self.first[item]:self.first[item + 1]]
        begin, end = max(0, -diagonal), min(len(own), len(doc) - diagonal)
        equal = own[begin:end] == doc[begin + diagonal:end + diagonal]
        if len(own) < LEAST_RUN:
            same = int(equal.sum())
            return (len(own), same, diagonal, 0) if len(equal) == len(own) and same >= EQUAL_TO_EACH * (len(own) - same) else None
        sums = np.concatenate(([0], np.cumsum(np.where(equal, 1, -EQUAL_TO_EACH))))
        starts = np.flatnonzero(equal)
        if not len(starts):
            return None
        # For each last word the earliest first word from which the sum is not negative: none but new minima can be it.
        stops = starts + 1
        first = starts[np.searchsorted(-np.minimum.accumulate(sums[starts]), -sums[stops])]
        lengths = stops - first
        best = int(np.argmax(lengths))
        start, length = int(first[best]), int(lengths[best])
        if length < LEAST_RUN:
            return None
        same = int(equal[start:start + length].sum())
        return length, same, start + begin + diagonal, start + begin


def item_blocks(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text",
                block_bytes: int = BLOCK_BYTES):
    """Indexes of the test set, one for each block of about ``block_bytes`` of text; null ids or texts are left out."""
    items = benchmark.select(quoted(id_column).alias("id"), quoted(text_column).alias("text")).where("id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // block_bytes
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).orderBy("id", "text").collect()  # one block
        if rows:
            yield SeedIndex.build([r["id"] for r in rows], [r["text"] for r in rows])


def overlaps(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document row and test item that share a verified run.

    Columns: doc_id, item_id, n_words (length of the run), n_equal, doc_word and item_word (where
    it starts), item_share (of the item's words).  A null or empty text shares nothing; repeated
    rows each give their own rows; a null document id is kept as null.
    """
    rows = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    ids = benchmark.select(quoted(item_id)).schema[0].dataType.simpleString()
    own = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {own}, item_id {ids}, n_words int, n_equal int, doc_word long, item_word long, item_share double"
    found = rows.sparkSession.createDataFrame([], schema)
    for index in item_blocks(benchmark, item_id, item_text, block_bytes):
        held = sent(rows.sparkSession, index)

        def search(batches, held=held):
            index = received(held)
            sizes = np.diff(index.first)
            for batch in batches:
                text, id_of = batch.column("text"), batch.column("doc_id")
                out, at = [], []
                for a, b in slices(text):
                    codes, first = item_words(text.slice(a, b - a))
                    for (row, item), (n, same, d, i) in sorted(index.overlaps(codes, first).items()):
                        at.append(a + row)
                        out.append((index.item_ids[item], n, same, d, i, n / sizes[item]))
                columns = list(zip(*out)) if out else [[] for _ in range(6)]
                kinds = [batch_type(ids), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [id_of.take(pa.array(at, pa.int64())), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]],
                    ["doc_id", "item_id", "n_words", "n_equal", "doc_word", "item_word", "item_share"])

        found = found.union(map_arrow(rows, search, schema))
    return found


def batch_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(kind, pa.string())


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_id: str = "item_id",
               item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that share no verified run with a test item."""
    place = docs.columns.index(text_column)
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    out = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    for index in item_blocks(benchmark, item_id, item_text, block_bytes):
        held = sent(docs.sparkSession, index)

        def keep(batches, held=held):
            index = received(held)
            for batch in batches:
                text = batch.column(place)
                clean = np.ones(len(text), dtype=bool)
                for a, b in slices(text):
                    codes, first = item_words(text.slice(a, b - a))
                    for row, _ in index.overlaps(codes, first):
                        clean[a + row] = False
                yield batch.filter(pa.array(clean))

        out = map_arrow(out, keep, schema)
    return out.toDF(*docs.columns)
