"""Joins of sharded and repeated runs: ordered score merge, transcript merge, cache, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import millis
from ..materialize import exists


def last_of(rows: DataFrame, keys: list[str], order: list[str], unique: bool = False) -> DataFrame:
    """One row for each key: the last in the given order.

    If the order tells all rows of a key apart (``unique``), rows are sorted by key and
    order once; the sort by key serves a join that follows, and of rows that are not yet
    together by key only a task's last ones are shuffled.
    """
    if unique:
        at = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order)))
        return rows.withColumn("__at", at).where("__at = 1").select(*keys, *(c for c in rows.columns if c not in keys))
    row = F.struct(*(c for c in rows.columns if c not in keys))
    return rows.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("r")).select(*keys, "r.*")


def with_last(expected: DataFrame, results: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """All expected rows, in ``__r`` the values of their key's last result in the given order; null without one or with a null key.

    Both sides are sorted together once and each expected row takes the last result before it. Nothing is shuffled where
    both already lie together by some of the keys, and what can't be held is spilled.
    """
    at = [f"__o{k}" for k in range(len(order))]
    side = results.select(*keys, F.struct(*values).alias("__r"), *(F.col(c).alias(o) for c, o in zip(order, at)), F.lit(0).alias("__side"))
    both = expected.withColumn("__side", F.lit(1)).unionByName(side, allowMissingColumns=True)
    last = F.last("__r", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("__side", *at).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return both.withColumn("__r", F.when(known, last)).where("__side = 1").select(*expected.columns, "__r")


def merge_scores(expected: DataFrame, scores: DataFrame, order: list[str], sort: bool = True, keys: tuple[str, ...] = ("seg_id",)) -> DataFrame:
    """Scores in the order of the expected segments; a repeated segment has the last file's score, one without scores is left out.

    ``expected`` has seg_id and what to sort by, ``scores`` seg_id and the columns
    ``order`` of file and line, which together tell all rows apart. ``keys`` may name
    columns of both that seg_id determines, as its recording: tables that lie together by these are not shuffled.
    """
    values = [c for c in scores.columns if c not in (*keys, *order)]
    found = with_last(expected, scores, [*keys], values, order).where("__r IS NOT NULL")
    out = found.select(*keys, *(c for c in expected.columns if c not in keys), "__r.*")
    # a sort looks through its rows twice: they are set down before it, not merged twice
    return out.repartition("seg_id").orderBy("audio_id", "seg_idx") if sort else out


def merge_counts(expected: DataFrame, scores: DataFrame, keys: tuple[str, ...] = ("seg_id",)) -> DataFrame:
    """(expected, written, missing, duplicates) of a score merge: segments without scores, and score rows beyond one a segment; ``keys`` as in ``merge_scores``."""
    sides = expected.select(*keys, F.lit(1).alias("__e"), F.lit(0).alias("__s")).unionByName(scores.select(*keys, F.lit(0).alias("__e"), F.lit(1).alias("__s")))
    each = sides.groupBy(*keys).agg(F.sum("__e").alias("__e"), F.sum("__s").alias("__s"))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("bigint")
    known = (F.col("__s") > 0) & F.col("seg_id").isNotNull()
    rows = each.agg(total("__e").alias("expected"), total(F.when(known, F.col("__e"))).alias("written"), total(F.greatest(F.col("__s") - 1, F.lit(0))).alias("duplicates"))
    return rows.select("expected", "written", (F.col("expected") - F.col("written")).alias("missing"), "duplicates")


def merge_transcripts(expected: DataFrame, results: DataFrame, order: list[str]) -> DataFrame:
    """Every expected segment with its text; without a result the text is empty and the error says so; repeated results: the last counts.

    Segments match on recording, times in whole milliseconds and segment id.
    """
    key = {"__s": millis(F.col("start_sec")), "__e": millis(F.col("end_sec")), "__id": F.trim(F.col("seg_id"))}
    keys = ["audio_id", *key]
    out = with_last(expected.withColumns(key), results.withColumns(key), keys, ["text", "error"], order)
    error = F.when(F.col("__r").isNull(), F.lit("missing_from_shards")).otherwise(F.col("__r.error"))
    return out.withColumns({"text": F.coalesce("__r.text", F.lit("")), "error": error}).drop("__r", *key)


def look_aside(rows: DataFrame, cache: DataFrame, key: str, compute) -> tuple[DataFrame, DataFrame]:
    """(all results, new cache entries): cached values where the key is known, else those that ``compute`` makes of the missing rows.

    ``cache`` has the key and the value columns; ``compute`` maps a table of rows to key and values.
    """
    wanted = rows.select(key).where(F.col(key).isNotNull()).distinct()
    known = cache.join(wanted, key, "left_semi").withColumn("status", F.lit("cached"))
    made = compute(rows.where(F.col(key).isNotNull()).join(cache.select(key), key, "left_anti"))
    return known.unionByName(made.withColumn("status", F.lit("computed"))), made


class CacheTable:
    """A cache kept in a folder: each upsert adds one batch, and of a key's rows those of the last batch count.

    A batch is complete with its success mark; one that was broken off is written again.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, schema: str):
        self.spark, self.folder, self.key, self.schema = spark, folder.rstrip("/"), key, schema

    def _next(self) -> int:
        k = 0
        while exists(self.spark, f"{self.folder}/batch={k}/_SUCCESS"):
            k += 1
        return k

    def read(self) -> DataFrame:
        """One row for each key."""
        n = self._next()
        if not n:
            return self.spark.createDataFrame([], self.schema)
        rows = None
        for k in range(n):
            batch = self.spark.read.schema(self.schema).parquet(f"{self.folder}/batch={k}")
            rows = batch if rows is None else rows.join(batch.select(self.key), self.key, "left_anti").unionByName(batch)
        return rows

    def upsert(self, new: DataFrame) -> None:
        """Rows of known keys replace them; ``new`` has one row for each key."""
        new.write.mode("overwrite").parquet(f"{self.folder}/batch={self._next()}")

    def compact(self) -> None:
        """Puts all rows into the last batch."""
        self.upsert(self.read())


def remaining(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done."""
    return rows.join(done.select(key), key, "left_anti")


def resume_union(done: DataFrame, new: DataFrame, key: str, repeated: bool = True) -> DataFrame:
    """Earlier and new results, one for each key, the earlier one first.

    ``repeated`` says whether a key may repeat within a side; where it may not, the rows are joined by key only.
    """
    first = lambda rows: last_of(rows.withColumn("__h", F.xxhash64(F.struct(*rows.columns))), [key], ["__h"]).drop("__h") if repeated else rows
    return first(done).unionByName(first(remaining(new, done, key)), allowMissingColumns=True)


def contiguous_shard(row: Column, total: int, shards: int) -> Column:
    """Slices of ``total // shards`` rows; the last takes the remainder, and with fewer rows than shards all."""
    size = total // shards
    return F.lit(shards - 1).cast("bigint") if size == 0 else F.least(F.floor(row / size), F.lit(shards - 1)).cast("bigint")


def modulo_shard(row: Column, shards: int) -> Column:
    return F.pmod(row, F.lit(shards)).cast("bigint")
