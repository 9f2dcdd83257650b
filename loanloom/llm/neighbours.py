"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of a fixed set of pivots by the angle to it.
The inverted file of a pivot holds, for every vector of a block, the place of the pivot in
the vector's order.  A query opens the files of its nearest and its farthest
pivots; the differences of places add up to the footrule distance over these pivots.
An order says nothing of a vector's length.  So each query fits the cosine as a line of the
footrule on a few vectors of the block, and the vectors whose length times the cosine to be
expected, and its spread, is largest are ranked again by exact inner product in double precision.

Equal vectors are indexed once.  Vectors lie in blocks of bounded size; every
block is searched by every query, and the best of the blocks are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.frames import map_arrow, quoted, received, sent, stored

PIVOTS = 256
#: Nearest and farthest pivots whose files a query opens.
NEAREST, FARTHEST = 48, 48
#: Share of a block, and least number, of its vectors that are ranked again.
RERANK_SHARE, RERANK_LEAST = 0.15, 400
BLOCK_VECTORS = 8_000
#: Vectors of a block on which a query fits its line, most of them among those of small footrule.
FITTED = 128


def lengths_of(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows that are not zero, without overflow of squares."""
    largest = np.abs(x).max(axis=1)
    return largest * np.linalg.norm(x / largest[:, None], axis=1)


def pivot_places(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Place of each pivot in the order by nearness of each vector (ties to the lower pivot)."""
    order = np.argsort(-(x @ pivots.T), axis=1, kind="stable")
    places = np.empty(order.shape, dtype=np.int16)
    np.put_along_axis(places, order, np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
    return places


class Block:
    """The inverted files of one block of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.lengths = lengths_of(self.x)
        self.files = np.ascontiguousarray(pivot_places(self.x, pivots).T)

    def search(self, query: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(places)
        opened = np.arange(len(order)) if len(order) <= NEAREST + FARTHEST else np.r_[0:NEAREST, len(order) - FARTHEST:len(order)]
        footrule = np.zeros(len(self.ids), dtype=np.int32)
        for place in opened:
            footrule += np.abs(self.files[order[place]] - np.int16(place))
        n = max(RERANK_LEAST, int(RERANK_SHARE * len(self.ids)))
        at = np.argpartition(-self.expected(query, footrule), n)[:n] if n < len(self.ids) else np.arange(len(self.ids))
        scores = self.x[at] @ query
        best = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at[best]], scores[best]

    def expected(self, query: np.ndarray, footrule: np.ndarray) -> np.ndarray:
        """Upper estimates of the inner products with a query, up to its length."""
        order = np.argsort(footrule, kind="stable")
        some = order[np.unique((np.linspace(0.0, 1.0, FITTED) ** 2 * (len(order) - 1)).astype(int))]
        cosines = (self.x[some] / self.lengths[some, None]) @ (query / lengths_of(query[None, :])[0])
        rule = footrule - footrule.mean()
        own = rule[some] - rule[some].mean()
        # Of equal lengths the least footrule comes first, whatever the sample says.
        slope = min(float(own @ cosines) / max(float(own @ own), 1e-12), -1e-12)
        line = cosines.mean() + slope * (rule - rule[some].mean())
        return self.lengths * (line + (cosines - line[some]).std())


def nearest(vectors: DataFrame, queries: DataFrame | None = None, k: int = 20, id_column: str = "vec_id",
            vector_column: str = "embedding", query_step: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors of largest inner product found for each query.

    Queries are the rows of ``vectors`` whose id is divisible by ``query_step``, or the ids in ``queries``
    (a column of ``id_column``); a query is no neighbour of its own.  Ties go to the smaller id; fewer than
    ``k`` other vectors give fewer rows.  Null ids, and vectors that are null, empty, all zero or hold a null or
    non-finite component take no part; of several lengths only the most frequent one does.  Rows that
    repeat an id count once, with the first of their vectors in order.
    """
    spark = vectors.sparkSession
    v = F.col("vec")
    rows = vectors.select(quoted(id_column).cast("long").alias("id"), quoted(vector_column).cast("array<double>").alias("vec")).where(
        F.col("id").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists(v, lambda c: c != 0))
    # Zero has one sign here, so that equal vectors are equal keys.
    rows = rows.select("id", F.transform("vec", lambda c: c + F.lit(0.0)).alias("vec"))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    rows = stored(rows.where(F.size("vec") == sizes[0]["d"]).groupBy("id").agg(F.min("vec").alias("vec")), "ann-rows")
    same = stored(rows.groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "ann-distinct")
    member = stored(rows.join(same.select("vec", "rep").hint("merge"), "vec").select("id", "rep"), "ann-members")
    pivots = np.array([r["vec"] for r in same.select("vec", "rep").orderBy(F.xxhash64("rep"), "rep").limit(PIVOTS).collect()])
    pivots = pivots / lengths_of(pivots)[:, None] if len(pivots) else pivots
    n = same.count()
    blocks = max(1, -(-n // BLOCK_VECTORS))
    asked = (member.join(queries.select(quoted(id_column).cast("long").alias("id")).distinct(), "id", "left_semi") if queries is not None
             else member.where(F.col("id") % query_step == 0))
    asked = stored(asked, "ann-queries")
    held = sent(spark, pivots)
    posted = same.select(F.pmod(F.xxhash64("rep"), F.lit(blocks)).alias("block"), F.lit(0).alias("asks"), "rep", "vec")
    questions = (same.join(asked.select("rep").distinct().hint("merge"), "rep", "left_semi")
                 .select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("asks"), "rep", "vec"))

    def search(batches):
        pivots = received(held)
        own, parts, block = None, [], None
        for batch in batches:
            block_of, asks, reps = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("block", "asks", "rep"))
            x = np.asarray(batch.column("vec").flatten().to_numpy(zero_copy_only=False)).reshape(len(reps), -1)
            found = []
            cuts = np.flatnonzero((np.diff(block_of, prepend=-1) != 0) | (np.diff(asks, prepend=-1) != 0))
            for a, b in zip(cuts, np.append(cuts[1:], len(reps))):
                if block_of[a] != own:
                    own, parts, block = block_of[a], [], None
                if not asks[a]:
                    parts.append((reps[a:b], x[a:b]))
                    continue
                if not parts and block is None:
                    continue
                if block is None:
                    block = Block(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), pivots)
                    parts = []
                places = pivot_places(x[a:b], pivots)
                for i in range(a, b):
                    # One more than asked for: the query's own vector is among them.
                    ids, scores = block.search(x[i], places[i - a], k + 1)
                    found.append((np.full(len(ids), reps[i]), ids, scores))
            columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "rep", "score"])

    met = posted.union(questions).repartition(blocks, "block").sortWithinPartitions("block", "asks")
    per_query = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    best = (map_arrow(met, search, "query long, rep long, score double")
            .withColumn("place", F.row_number().over(per_query)).where(F.col("place") <= k + 1).select("query", "rep", "score"))
    best = stored(best, "ann-best")
    # Each vector found stands for its least ids, as many as can matter.
    least = stored(member.withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy("id")))
                   .where(F.col("place") <= k + 1).select("rep", "id"), "ann-least")
    spread = best.join(least.hint("merge"), "rep")
    few = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    spread = stored(spread.withColumn("place", F.row_number().over(few)).where(F.col("place") <= k + 1).select("query", "id", "score"), "ann-spread")
    # Queries of one vector share its list, less themselves.
    lists = spread.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))).alias("list"))
    answer = asked.withColumnRenamed("id", "query_id").join(stored(lists, "ann-lists").hint("merge"), F.col("rep") == F.col("query"))
    kept = F.slice(F.filter("list", lambda e: e["id"] != F.col("query_id")), 1, k)
    return answer.select("query_id", F.posexplode(kept).alias("place", "one")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.id").alias("vec_id"), (-F.col("one.s")).alias("score"))
