"""Session helpers: make the package importable in Python workers and build local sessions."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's source to the executors, once for each Spark application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="voxmill-src-")) / "voxmill_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def local_session(cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session with the settings that tests and the bench use."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        "spark.sql.adaptive.enabled": "true",
    } | conf
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
