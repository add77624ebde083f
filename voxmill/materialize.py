"""Tables computed once in the shared checkpoint folder, and global row numbers without a single-partition window."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a single-machine session without the setting gets a temporary one."""
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="voxmill-shared-")
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, on whatever file system the path names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


#: Rows that a task gets by ``spread``.
ROWS_A_TASK = 1 << 18


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` of about so many rows, hash partitioned by the keys: a task's share stays the same as the table grows, whatever the session's setting."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK)), *keys)


def materialize(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def with_row_number(df: DataFrame, order: list[Column], name: str = "row") -> DataFrame:
    """``df`` with the 0-based number of each row in the given total order.

    Rows are range partitioned and sorted within partitions; the numbers of rows
    per partition, one small row each, give the offsets.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = materialize(spread.withColumn("__at", F.monotonically_increasing_id()))
    low = F.lit((1 << 33) - 1)
    part = F.shiftright("__at", 33)
    offsets, total = {}, 0
    for r in sorted(held.groupBy(part.alias("p")).count().collect(), key=lambda r: r.p):
        offsets[r.p] = total
        total += r["count"]
    if not offsets:
        return held.withColumn(name, F.lit(0).cast("bigint")).drop("__at")
    table = F.create_map(*(F.lit(x).cast("bigint") for pair in offsets.items() for x in pair))
    return held.withColumn(name, table[part] + F.col("__at").bitwiseAND(low)).drop("__at")
