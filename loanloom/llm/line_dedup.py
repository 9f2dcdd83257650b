"""Line deduplication with two Bloom filters.

Every task sets the bits of its line keys in a once-seen filter and, where they were
set before, in a twice-seen filter.  The filters of all tasks are merged in segments: a bit is twice-seen if two
tasks saw it once or one task saw it twice.  Lines outside the twice-seen filter occur in
one document only and are never shuffled.  The others are confirmed exactly by a
128-bit hash: keys in enough documents lose their lines in all of them but one.

Filter size follows the number of lines.  What a task probes is folded to at most ``PROBE_BYTES``;
folding, like a false positive, only sends more lines to the exact count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.frames import map_arrow, quoted, stored, unused
from loanloom.llm.tokens import slices

LEAST_CHARACTERS, LEAST_DOCUMENTS = 40, 5
BITS_PER_KEY = 16
SEGMENT_BITS = 21           # a segment of the filters: 256 KB
PROBE_BYTES = 16 << 20
_TASK_KEYS = 1 << 20
_BLANKS = b" \t\n\v\f\r"


def line_key(line: bytes) -> bytes | None:
    """The stripped line with A-Z lower-cased, or None if it is too short to count."""
    key = line.strip(_BLANKS)
    if len(key) < LEAST_CHARACTERS or (len(key) < 4 * LEAST_CHARACTERS and len(key.decode()) < LEAST_CHARACTERS):
        return None
    return key.lower()


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _keys(rows: DataFrame) -> DataFrame:
    """doc_id with the hashes of its distinct line keys."""
    def work(batches):
        for batch in batches:
            held, ends = [], [0]
            for text in batch.column("text"):
                raw = text.as_py()
                own = {digest(k) for k in map(line_key, raw.encode().split(b"\n")) if k is not None} if raw else ()
                held += sorted(own)
                ends.append(len(held))
            flat = np.frombuffer(b"".join(held), dtype=np.int64).reshape(-1, 2)
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ascontiguousarray(flat[:, k]))) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "high", "low"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, work, f"doc_id {kind}, high array<bigint>, low array<bigint>")


def positions(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two filter positions of each key, both in the same segment."""
    segment = high.view(np.uint64) & np.uint64((1 << bits) - 1) & ~np.uint64((1 << SEGMENT_BITS) - 1)
    inner = np.uint64((1 << SEGMENT_BITS) - 1)
    x = low.view(np.uint64)
    return segment | (x & inner), segment | ((x >> np.uint64(SEGMENT_BITS)) & inner)


def flattened(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.asarray(batch.column(c).flatten().to_numpy(zero_copy_only=False), dtype=np.int64) for c in ("high", "low"))


def twice_seen(keys: DataFrame, bits: int) -> DataFrame:
    """The twice-seen filter of keys (two arrays of hashes a row), as (segment, positions within the segment)."""
    inner = np.uint64((1 << SEGMENT_BITS) - 1)

    def local(batches):
        # The task's own filters, as the sorted keys (both positions in one number) that are set.
        once = twice = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            high, low = flattened(batch)
            for k in range(0, len(high), _TASK_KEYS):
                first, second = positions(high[k:k + _TASK_KEYS], low[k:k + _TASK_KEYS], bits)
                keys = (first << np.uint64(SEGMENT_BITS)) | (second & inner)
                once, count = np.unique(np.concatenate([once, keys]), return_counts=True)
                twice = np.unique(np.concatenate([twice, once[count > 1]]))
                if len(once) > _TASK_KEYS:  # bounds the task's memory; the merge finds what lies across
                    yield from packed(once, twice)
                    once = twice = np.zeros(0, dtype=np.uint64)
        yield from packed(once, twice)

    def packed(once, twice):
        for name, keys in (("once", once), ("twice", twice)):
            segment = (keys >> np.uint64(2 * SEGMENT_BITS)).astype(np.int64)
            inside = np.column_stack([(keys >> np.uint64(SEGMENT_BITS)) & inner, keys & inner]).astype(np.int32)
            at = np.flatnonzero(np.diff(segment, prepend=-1))
            ends = np.append(at, len(segment))
            lists = pa.ListArray.from_arrays(pa.array(ends * 2, pa.int32()), pa.array(inside.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(segment[at]), pa.array([name == "twice"] * len(at), pa.bool_()), lists], ["segment", "again", "bits"])

    def merged(batches):
        own, once, twice = None, None, None

        def result():
            found = np.flatnonzero(twice).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array([found], pa.list_(pa.int32()))], ["segment", "bits"])

        for batch in batches:
            for segment, again, bits_of in zip(batch.column("segment").to_pylist(), batch.column("again").to_pylist(), batch.column("bits")):
                if segment != own:
                    if own is not None:
                        yield result()
                    own, once, twice = segment, np.zeros(1 << SEGMENT_BITS, bool), np.zeros(1 << SEGMENT_BITS, bool)
                pairs = np.asarray(bits_of.values).reshape(-1, 2)
                if again:
                    twice[pairs] = True
                else:
                    seen = once[pairs].all(axis=1)
                    twice[pairs[seen]] = True
                    once[pairs] = True
        if own is not None:
            yield result()

    parts = map_arrow(keys, local, "segment long, again boolean, bits array<int>")
    return map_arrow(parts.repartition("segment").sortWithinPartitions("segment"), merged, "segment long, bits array<int>")


def probe_filter(twice: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """The twice-seen filter as packed bits, folded to at most ``PROBE_BYTES``."""
    folded = min(bits, (PROBE_BYTES * 8).bit_length() - 1)
    segments = 1 << (folded - SEGMENT_BITS)

    def fold(batches):
        own, held = None, None

        def result():
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array([np.packbits(held).tobytes()], pa.binary())], ["segment", "bits"])

        for batch in batches:
            for segment, found in zip(batch.column("segment").to_pylist(), batch.column("bits")):
                if segment != own:
                    if own is not None:
                        yield result()
                    own, held = segment, np.zeros(1 << SEGMENT_BITS, bool)
                held[np.asarray(found.values)] = True
        if own is not None:
            yield result()

    parts = twice.select(F.pmod("segment", F.lit(segments)).alias("segment"), "bits").repartition("segment").sortWithinPartitions("segment")
    table = np.zeros((segments, (1 << SEGMENT_BITS) // 8), dtype=np.uint8)
    for r in map_arrow(parts, fold, "segment long, bits binary").collect():  # PROBE_BYTES at most
        table[r["segment"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return table.ravel(), folded


def seen_twice(table: np.ndarray, bits: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Which keys the folded filter holds: all that are in two rows, and a few others."""
    hit = np.ones(len(high), dtype=bool)
    for p in positions(high, low, bits):
        p = p.astype(np.int64)
        hit &= (table[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1
    return hit


def filter_bits(n: int) -> int:
    return max(SEGMENT_BITS, int(n * BITS_PER_KEY).bit_length())


def repeated_keys(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(doc_id, high, low): the keys whose lines each document loses.

    A key counts in distinct non-null ids; the largest id that holds it keeps its lines.
    """
    rows = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text")).where("doc_id is not null")
    keys = stored(_keys(rows), "line-keys")
    n = keys.agg(F.sum(F.size("high"))).first()[0] or 0
    bits = filter_bits(n)
    twice = stored(twice_seen(keys.select("high", "low"), bits), "line-filter")
    held = docs.sparkSession.sparkContext.broadcast(probe_filter(twice, bits))

    def suspected(batches):
        table, folded = held.value
        for batch in batches:
            high, low = flattened(batch)
            hit = seen_twice(table, folded, high, low)
            sizes = np.asarray(batch.column("high").value_lengths().to_numpy(zero_copy_only=False))
            row = np.repeat(np.arange(len(sizes)), sizes)[hit]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(high[hit]), pa.array(low[hit])], ["doc_id", "high", "low"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    suspects = stored(map_arrow(keys, suspected, f"doc_id {kind}, high long, low long"), "line-suspects")
    confirmed = stored(suspects.groupBy("high", "low").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
                       .where(F.col("n") >= least).select("high", "low", "keeper"), "line-repeats")
    return suspects.join(confirmed.hint("merge"), ["high", "low"]).where("doc_id <> keeper").select("doc_id", "high", "low")


def without_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                           least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns of ``docs`` with repeated lines taken out of the text, and two counts added.

    Returns the frame and the names of the counts (``n_lines`` before, ``n_dropped``; numbered
    where taken).  A null or empty text is one empty line and stays as it is.
    Rows of one id are one document; a row with a null id keeps all its lines.
    """
    added = {name: unused(docs, name) for name in ("n_lines", "n_dropped")}
    n_columns, place = len(docs.columns), docs.columns.index(text_column)
    lost = repeated_keys(docs, id_column, text_column, least)
    drops = lost.groupBy("doc_id").agg(F.collect_set(F.struct("high", "low")).alias("keys"))  # at most the document's own lines
    plain = docs.toDF(*[f"c{i}" for i in range(n_columns)])
    key = f"c{docs.columns.index(id_column)}"
    met = plain.join(drops, plain[key] == drops["doc_id"], "left").select(
        *plain.columns, F.col("keys.high").alias("high"), F.col("keys.low").alias("low"))

    def work(batches):
        for batch in batches:
            for a, b in slices(batch.column(place)):
                yield cleaned(batch.slice(a, b - a))

    def cleaned(batch):
        texts, n_lines, n_dropped = [], [], []
        for text, high, low in zip(batch.column(place), batch.column("high"), batch.column("low")):
            raw = text.as_py()
            n, gone = (raw.count("\n") + 1 if raw else 1), 0
            if raw and high.is_valid:
                lines = raw.encode().split(b"\n")
                taken = {bytes(x) for x in np.column_stack([np.asarray(high.values), np.asarray(low.values)]).astype(np.int64)}
                kept = [x for x in lines if (k := line_key(x)) is None or digest(k) not in taken]
                gone, raw = n - len(kept), b"\n".join(kept).decode()
            texts.append(raw)
            n_lines.append(n)
            n_dropped.append(gone)
        arrays = list(batch.columns[:n_columns])
        arrays[place] = pa.array(texts, batch.schema.field(place).type)
        arrays += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])

    kinds = [f.dataType.simpleString() for f in docs.schema] + ["bigint", "bigint"]
    out = map_arrow(met, work, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds)))
    return out.toDF(*docs.columns, *added.values()), added
