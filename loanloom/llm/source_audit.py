"""Divergence of the sources of each language by term frequencies, in exact whole numbers.

Every language keeps the terms that enough of its documents hold.  A source's (term id, count) entries lie in arrays sorted
by id, cut into segments of about ``SEGMENT_TERMS`` kept terms of the language, so that no array grows with
the vocabulary.  Sources are dealt into blocks; a task co-groups the arrays of two blocks in one segment
and prices each unordered pair both ways: a galloping intersection finds the terms both hold, the rest
of either array is one-sided, and the segment's other terms are absent from both.  Segments add up.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.frames import map_arrow, quoted, stored
from loanloom.llm.tokens import slices, span_hashes, spans, utf8

LEAST_DOCUMENTS, TOP_TERMS = 3, 200
PARTS = 1_000_000_000
#: Kept terms of a language in a segment, and sources of a block, on average.
SEGMENT_TERMS, BLOCK_SOURCES = 1 << 16, 8
#: Entries, bytes of terms, and groups that a task holds before it hands them on.
_TASK_ENTRIES, _TASK_BYTES, _TASK_GROUPS = 1_500_000, 32 << 20, 10_000

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)
_APART = np.array([c < 65 or 90 < c < 97 or 122 < c < 128 for c in range(256)])   # all but ASCII letters and what lies beyond ASCII
_SPLIT = bytes(32 if _APART[c] else int(_LOWER[c]) for c in range(256))


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of stretches of ``data``, one after the other."""
    ends = np.cumsum(sizes)
    return data[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _as_strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(data.tobytes()))


def term_entries(texts: pa.Array, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Group, hash, occurrences, documents and term of every distinct term of each group in some texts, ``group`` rising.

    Terms meet by a 64-bit hash and are then compared byte for byte; a clash sends the texts through a dictionary.
    """
    data, offsets = utf8(texts)
    data = _LOWER[data]
    starts, stops, first = spans(data, offsets, _APART)
    codes, sizes = span_hashes(data, starts, stops), stops - starts
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.argsort(codes, kind="stable")     # then by group and row, as rows come by group
    codes, row, starts, sizes = codes[order], row[order], starts[order], sizes[order]
    own = group[row]
    other = np.ones(len(codes), dtype=bool)
    other[1:] = codes[1:] != codes[:-1]
    met = np.flatnonzero(other)[np.cumsum(other) - 1]
    again = np.flatnonzero(~other)
    if (sizes[again] != sizes[met[again]]).any() or not np.array_equal(
            _gathered(data, starts[again], sizes[again]), _gathered(data, starts[met[again]], sizes[again])):
        return _by_dictionary(texts, group)
    in_group, in_row = other.copy(), other.copy()
    in_group[1:] |= own[1:] != own[:-1]
    in_row[1:] |= row[1:] != row[:-1]
    at = np.flatnonzero(in_group)
    n = np.diff(np.append(at, len(codes)))
    documents = np.add.reduceat(in_row.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    return own[at], codes[at], n, documents, _as_strings(_gathered(data, starts[at], sizes[at]), sizes[at])


def _by_dictionary(texts: pa.Array, group: np.ndarray):
    """:func:`term_entries` without hashes of its own."""
    counts: dict[tuple[int, bytes], list[int]] = {}
    for g, text in zip(group.tolist(), texts):
        for term, n in Counter((text.as_py() or "").encode().translate(_SPLIT).split()).items():
            entry = counts.setdefault((g, term), [0, 0])
            entry[0] += n
            entry[1] += 1
    terms = [t for _, t in counts]
    columns = np.array([(g, hash(t), n, d) for (g, t), (n, d) in counts.items()], dtype=np.int64).reshape(-1, 4)
    return (columns[:, 0], columns[:, 1].view(np.uint64) if len(columns) else np.zeros(0, np.uint64), columns[:, 2], columns[:, 3],
            pa.array(terms, pa.large_binary()).cast(pa.large_string()))


def merged_entries(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Group, occurrences, documents and term of the entries of several slices; equal ones (by hash and by bytes) add up.

    Entries whose hashes clash stay apart, to be added up in Spark like those of different tasks.
    """
    group, codes, n, documents = (np.concatenate([p[k] for p in parts]) for k in range(4))
    terms = pa.concat_arrays([p[4] for p in parts])
    order = np.lexsort((group, codes))
    group, codes, n, documents, terms = group[order], codes[order], n[order], documents[order], terms.take(pa.array(order))
    fresh = np.ones(len(codes), dtype=bool)
    if len(codes):
        fresh[1:] = (codes[1:] != codes[:-1]) | (group[1:] != group[:-1]) | ~np.asarray(pc.equal(terms[1:], terms[:-1]))
    at = np.flatnonzero(fresh)
    if not len(at):
        return group, n, documents, terms
    return group[at], np.add.reduceat(n, at), np.add.reduceat(documents, at), terms.take(pa.array(at))


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents) as each task has met them, with a null term for every group it has met."""
    def work(batches):
        numbers: dict[tuple, int] = {}
        parts, size, weight = [], 0, 0
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            group = np.array([numbers.setdefault(g, len(numbers)) for g in zip(langs, sources)], dtype=np.int64)
            for a, b in slices(batch.column("text")):
                order = np.argsort(group[a:b], kind="stable")
                parts.append(term_entries(batch.column("text").slice(a, b - a).take(pa.array(order)), group[a:b][order]))
                size += len(parts[-1][0])
                weight += parts[-1][4].nbytes
                if size >= _TASK_ENTRIES or weight >= _TASK_BYTES:
                    yield packed(parts, list(numbers))
                    parts, size, weight = [], 0, 0
            if len(numbers) >= _TASK_GROUPS:
                yield from rest(parts, numbers)
                numbers, parts, size, weight = {}, [], 0, 0
        yield from rest(parts, numbers)

    def rest(parts, numbers):
        if parts:
            yield packed(parts, list(numbers))
        names = list(numbers)
        zeros = pa.array(np.zeros(len(names), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in names], pa.string()), pa.array([g[1] for g in names], pa.string()),
                                          pa.nulls(len(names), pa.string()), zeros, zeros], ["lang", "source", "term", "n", "documents"])

    def packed(parts, names):
        group, n, documents, terms = merged_entries(parts)
        at = pa.array(group)
        named = [pa.array([g[k] for g in names], pa.string()).take(at) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*named, terms.cast(pa.string()), pa.array(n), pa.array(documents)], ["lang", "source", "term", "n", "documents"])

    return map_arrow(docs, work, "lang string, source string, term string, n long, documents long")


def shares(count: np.ndarray | int, total: int) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / total), in three steps of a thousand so that nothing overflows."""
    rest = np.asarray(count, dtype=np.int64) + 1
    out = rest // total
    for _ in range(3):
        rest = rest % total * 1000
        out = out * 1000 + rest // total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def gallop(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """First place in ``hay`` not less than each needle (both sorted).

    Every 16th needle is searched for in all of ``hay``; those behind it start from its place and double their
    steps until they pass, then halve.
    """
    if not len(needles) or not len(hay):
        return np.zeros(len(needles), dtype=np.int64)
    low = np.repeat(np.searchsorted(hay, needles[::16]), 16)[:len(needles)]     # hay[low - 1] < needle
    step = np.ones(len(needles), dtype=np.int64)
    going = np.arange(len(needles))
    while len(going):
        probe = low[going] + step[going] - 1
        behind = (probe < len(hay)) & (hay[np.minimum(probe, len(hay) - 1)] < needles[going])
        going = going[behind]
        low[going] += step[going]
        step[going] *= 2
    high = np.minimum(low + step - 1, len(hay))     # hay[high] >= needle, or the end
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        behind = hay[middle] < needles[open_]
        low[open_] = np.where(behind, middle + 1, low[open_])
        high[open_] = np.where(behind, high[open_], middle)


def pair_values(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int], kept: int) -> tuple[int, int]:
    """Divergence of a from b and of b from a over a segment of ``kept`` terms; each is (sorted ids, counts, N + V)."""
    if not kept:
        return 0, 0
    if len(a[0]) > len(b[0]):
        return pair_values(b, a, kept)[::-1]
    (ids, n, total), (others, m, all_) = a, b
    at = gallop(ids, others)
    both = np.zeros(len(ids), dtype=bool)
    inside = at < len(others)
    both[inside] = others[at[inside]] == ids[inside]
    alone = np.ones(len(others), dtype=bool)
    alone[at[both]] = False
    p, q = shares(n, total), shares(m, all_)
    p0, q0 = shares(0, total), shares(0, all_)
    absent = kept - len(ids) - len(others) + int(both.sum())
    there = back = 0
    for x, y in ((p[both], q[at[both]]), (p[~both], q0), (p0, q[alone])):
        there += int(divergence(x, y).sum())
        back += int(divergence(y, x).sum())
    return there + absent * int(divergence(p0, q0)), back + absent * int(divergence(q0, p0))


def _pair_task(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Prices of the pairs of two blocks in a segment, of each source with each later one."""
    def read(table):
        return [(s, (np.asarray(i.values), np.asarray(n.values), total), kept) for s, i, n, total, kept in zip(
            table["source"].to_pylist(), table["ids"].combine_chunks(), table["counts"].combine_chunks(),
            table["total"].to_pylist(), table["kept"].to_pylist())]

    lang, one_block = key[0].as_py(), key[2].as_py() == key[3].as_py()
    sources, items, values = [], [], []
    others = read(right)
    for source, a, kept in read(left):
        for item, b, _ in others:
            if source < item or (not one_block and source != item):
                there, back = pair_values(a, b, kept)
                sources += [source, item]
                items += [item, source]
                values += [there, back]
    return pa.table({"lang": pa.array([lang] * len(values), pa.string()), "source": pa.array(sources, pa.string()),
                     "item": pa.array(items, pa.string()), "value": pa.array(values, pa.int64())})


def _share(count: str, total: str) -> Column:
    """As :func:`shares`, of two long columns."""
    return F.expr(f"1 + cast(({count} + 1) as decimal(20,0)) * {PARTS} div {total}")


def audit(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
          least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, segment_terms: int = SEGMENT_TERMS,
          block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others and from its language.

    Part ``pair`` has a row for each other source of the language, part ``term`` the ``top`` terms that the source uses
    more than its language.  Null text, language and source count as empty.  Every row is a document, repeated
    rows and ids too.  A group without kept terms has its pairs; a language without kept terms has pairs of value 0.
    Texts are read whole, whatever their length.  An empty table gives no rows; other columns are not read.
    """
    named = docs.select(*[F.coalesce(quoted(c), F.lit("")).alias(n) for c, n in ((text_column, "text"), (lang_column, "lang"), (source_column, "source"))])
    counts = stored(_counted(named).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")), "audit-counts")
    kept = (counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents"))
            .where(F.col("documents") >= least).select("lang", "term", "lang_n"))
    # The written ids are unique; nothing reads them before they are written.
    kept = stored(kept.withColumn("id", F.monotonically_increasing_id()), "audit-terms")
    sizes = stored(counts.where("term is null").groupBy("lang").agg(F.count("*").alias("sources"))
                   .join(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left")
                   .select("lang", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
                           F.greatest(F.lit(1), F.ceil(F.coalesce("v", F.lit(0)) / segment_terms)).cast("int").alias("segments"),
                           F.ceil(F.col("sources") / block_sources).cast("int").alias("blocks")), "audit-sizes")
    segment = F.pmod(F.xxhash64("id"), F.col("segments")).cast("int").alias("segment")
    held = stored(counts.where("term is not null").join(kept, ["lang", "term"]).join(sizes.select("lang", "segments"), "lang")
                  .select("lang", "source", "term", "n", "lang_n", "id", segment), "audit-held")
    groups = (counts.where("term is null").select("lang", "source")
              .join(held.groupBy("lang", "source").agg(F.sum("n").alias("own")), ["lang", "source"], "left")
              .join(sizes, "lang")
              .select("lang", "source", (F.coalesce("own", F.lit(0)) + F.col("v")).alias("total"), (F.col("lang_total") + F.col("v")).alias("lang_total"),
                      "segments", "blocks", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")))
    groups = stored(groups, "audit-groups")
    result = _pairs(kept, sizes, held, groups).union(_terms(held, groups, top))
    return result.select("lang", "source", "part", "item", "value", "rank")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(kept: DataFrame, sizes: DataFrame, held: DataFrame, groups: DataFrame) -> DataFrame:
    in_segment = (kept.join(sizes.select("lang", "segments"), "lang")
                  .groupBy("lang", F.pmod(F.xxhash64("id"), F.col("segments")).cast("int").alias("segment")).agg(F.count("*").alias("kept")))
    lists = (held.groupBy("lang", "source", "segment").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("entries"))
             .select("lang", "source", "segment", F.col("entries.id").alias("ids"), F.col("entries.n").alias("counts")))
    none = F.array().cast("array<bigint>")
    # A row for every source and segment, also where the source has no term of it.
    places = groups.select("lang", "source", "total", "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("segments") - 1)).alias("segment"))
    arrays = stored(places.join(lists, ["lang", "source", "segment"], "left").join(in_segment, ["lang", "segment"], "left")
                    .select("lang", "source", "segment", "total", "block", "blocks", F.coalesce("ids", none).alias("ids"),
                            F.coalesce("counts", none).alias("counts"), F.coalesce("kept", F.lit(0)).alias("kept")), "audit-arrays")
    columns = ["lang", "segment", "one", "two", "source", "total", "kept", "ids", "counts"]
    left = arrays.select("*", F.col("block").alias("one"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("two")).select(columns)
    right = arrays.select("*", F.col("block").alias("two"), F.explode(F.sequence(F.lit(0), "block")).alias("one")).select(columns)
    key = ["lang", "segment", "one", "two"]
    priced = left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(_pair_task, "lang string, source string, item string, value long")
    return _ranked(priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pair")


def _terms(held: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    met = held.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    priced = (met.select("lang", "source", F.col("term").alias("item"), _share("n", "total").alias("p"), _share("lang_n", "lang_total").alias("q"))
              .where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value")))
    return _ranked(priced, "term").where(F.col("rank") <= top)
