"""Bounded samples of labelled rows, taken by key hash before any text is touched."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.frames import quoted

_STEPS = 1 << 30


def sampled_keys(rows: DataFrame, per_label: int) -> tuple[DataFrame, dict]:
    """At most ``per_label`` ids (id, label) of each label of ``rows``, and the number of ids of each label.

    Rows that repeat an id and label count once.  A hash threshold from the counts thins the rows where they lie; the exact bound follows on what is left.
    The sample is bounded whatever the input, so it may be broadcast.
    """
    rows = rows.select("id", "label").distinct()
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    drawn = rows
    # Twice the bound on average and a margin, so that too few rows are as good as impossible.
    limits = {k: min(_STEPS, int(_STEPS * (2.0 * per_label + 200) / n)) for k, n in counts.items()}
    if any(v < _STEPS for v in limits.values()):
        limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("label")]
        drawn = drawn.where(F.pmod(F.xxhash64("id"), F.lit(_STEPS)) < limit)
    order = Window.partitionBy("label").orderBy(F.xxhash64(F.lit(1), "id"), "id")
    drawn = drawn.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label)
    return drawn.select("id", "label"), counts


def sampled_texts(docs: DataFrame, labels: DataFrame, per_label: int, id_column: str, text_column: str,
                  label_column: str) -> tuple[DataFrame, dict]:
    """(text, label) of a bounded sample of the ids with label 0 or 1, and the counts of both; texts are not shuffled."""
    rows = labels.select(quoted(id_column).alias("id"), quoted(label_column).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    keys, counts = sampled_keys(rows, per_label)
    texts = docs.select(quoted(id_column).alias("id"), quoted(text_column).alias("text"))
    return texts.join(F.broadcast(keys), "id").select("text", "label"), counts
