"""Small DataFrame helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the copy, so a lost executor costs a re-read."""
    path = shared_path(df.sparkSession, name)
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_1, name_2, ... that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    i, free = 0, name
    while free.lower() in taken:
        i += 1
        free = f"{name}_{i}"
    return free


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` that gives memory back when a task ends.

    Python workers live on for later stages, and what the C allocator keeps of one stage's arrays would add to
    that of the next.
    """
    def run(batches):
        yield from work(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)    # of the GNU C library
    if trim:
        trim(0)


def bucket_of(column: Column, modulus: int) -> Column:
    """CRC-32 of the decimal text of an id, modulo ``modulus`` (null for a null id)."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def sent(spark: SparkSession, value) -> Broadcast:
    """Broadcast ``value`` with its classes, for :func:`received`; only for values of a fixed largest size."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(held: Broadcast):
    return cloudpickle.loads(held.value)
