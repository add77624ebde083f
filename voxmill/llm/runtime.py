"""Session helpers shared by the operators: where intermediate tables go and how lineage is cut."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..materialize import materialize, shared_folder

_stored: list[tuple[SparkSession, str]] = []

#: What a worker keeps from one task of an operator to the next, by operator; it only affects speed.
kept: dict[str, object] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns memory that nothing uses to the system, where the allocators can; a worker lives on after its task and would hold it."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def task(keep: str = "") -> Callable:
    """For generators of a task's batches: what other operators than ``keep`` keep in the worker goes first, unused memory after the last batch."""

    def of(rows: Callable[..., Iterator]) -> Callable[..., Iterator]:
        @functools.wraps(rows)
        def run(*args, **options) -> Iterator:
            for other in kept.keys() - {keep}:
                del kept[other]
            give_back()
            yield from rows(*args, **options)
            give_back()

        return run

    return of


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared checkpoint folder."""
    return materialize(df)


def store(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written once as a Parquet table in the shared checkpoint folder, smaller than a checkpoint, and the table's place.

    Results may read it at any time, so it stays until the program ends.
    """
    spark = df.sparkSession
    place = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(place)
    _stored.append((spark, place))
    return spark.read.parquet(place), place


def discard(spark: SparkSession, place: str) -> None:
    """Deletes a stored table that nothing will read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _clean() -> None:
    for spark, place in _stored:
        with contextlib.suppress(Exception):  # the session may have ended before
            discard(spark, place)


def tasks(spark: SparkSession) -> int:
    """The number of shuffle partitions; given to ``repartition`` it keeps small but costly partitions from being merged."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of stages that nothing refers to any more, as a cut one's; it acts on collected garbage only."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def as_documents(docs: DataFrame, id_col: str, text_col: str, lower: bool = True) -> DataFrame:
    """Exactly the columns ``doc_id BIGINT, text STRING``; a null text is the empty text.

    Rows without an id cannot be named in a result and are left out here;
    filtering operators keep them.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        (F.lower(text) if lower else text).alias("text"),
    ).where(F.col("doc_id").isNotNull())


def unused(df: DataFrame, name: str) -> str:
    """``name``, or if the table has such a column, that name with underscores after it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is not in the one column of ``gone``; rows with a null id stay."""
    name = unused(docs, "gone_id")
    return docs.join(gone.toDF(name), F.col(f"`{id_col}`") == F.col(name), "left_anti")


FILTER_BITS = 24


def _bit(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def bit_set(ids: DataFrame) -> Broadcast:
    """A bit set of fixed size (2 MB), made of the one column of ``ids`` and sent to the executors."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bit(batch.column(0).to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["word", "bits"])

    found = ids.mapInArrow(bits, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(words)


def maybe_in(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids the bit set may hold."""
    at = _bit(ids)
    return (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (doc_id, text) whose doc_id is in the one column of ``ids``.

    A bit set of fixed size (2 MB), made of the ids and sent to the executors,
    leaves out most other rows before the join; the more ids there are the less
    it leaves out, and the join alone decides.
    """
    sent = bit_set(ids)

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe_in(sent.value, batch.column(0).to_numpy(zero_copy_only=False))))

    return rows.mapInArrow(maybe, rows.schema).join(ids, "doc_id", "left_semi")
