"""Speaker consistency: clustering of unknown speakers, centroids, similarities, decisions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import cosine, l2_normalize, norm
from ..functions.text import sanitize_id


def centroids(rows: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """(key, n, centroid): the normalized mean of each key's normalized vectors; null vectors don't count.

    Sums run over (key, place) with partial aggregation, so no key's vectors are gathered.
    """
    flat = rows.where(F.col(vector).isNotNull()).select(key, F.posexplode(l2_normalize(F.col(vector))).alias("place", "x"))
    sums = flat.groupBy(key, "place").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
    mean = sums.groupBy(key).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "x"))).alias("v"))
    return mean.select(key, "n", l2_normalize(F.transform("v", lambda p: p["x"])).alias("centroid"))


def similarities(rows: DataFrame, speakers: DataFrame, files: DataFrame, speaker: str, file: str, vector: str = "embedding") -> DataFrame:
    """Adds ``sim_spk`` and ``sim_file``, the cosine to each row's centroids; -1 where there is none."""
    s = speakers.select(speaker, F.col("centroid").alias("__s"))
    f = files.select(file, F.col("centroid").alias("__f"))
    out = rows.join(s, speaker, "left").join(f, file, "left")
    sim = lambda c: F.coalesce(cosine(F.col(vector), F.col(c)), F.lit(-1.0))
    return out.withColumns({"sim_spk": sim("__s"), "sim_file": sim("__f"), "__has_s": F.col("__s").isNotNull(), "__has_f": F.col("__f").isNotNull()}).drop("__s", "__f")


def decisions(rows: DataFrame, duration: Column, vector: Column, min_dur: float = 1.0, min_spk: float = 0.60, min_file: float = 0.65) -> DataFrame:
    """Adds ``keep_reason`` to the result of ``similarities``; a missing centroid passes, NaN fails."""
    ok = lambda sim, has, least: ~F.col(has) | ((F.col(sim) >= least) & ~F.isnan(sim))
    spk, file = ok("sim_spk", "__has_s", min_spk), ok("sim_file", "__has_f", min_file)
    reason = (
        F.when(F.coalesce(duration, F.lit(0.0)) < min_dur, "drop_short").when(vector.isNull(), "drop_no_emb")
        .when(~spk & ~file, "drop_spk_and_file").when(~spk, "drop_spk").when(~file, "drop_file").otherwise("keep")
    )
    return rows.withColumn("keep_reason", reason).drop("__has_s", "__has_f")


def greedy_labels(vectors: np.ndarray, least: float) -> list[int]:
    """Cluster of each vector in order: that of the most similar centroid if at least ``least``, else a new one."""
    held: list[np.ndarray] = []
    out = []
    for v in vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-12) if len(vectors) else vectors:
        if held:
            sims = np.clip(np.stack(held) @ v, -1, 1)
            k = int(sims.argmax())
            if sims[k] >= least:
                c = held[k] + v
                held[k] = c / (np.linalg.norm(c) + 1e-12)
                out.append(k)
                continue
        held.append(v)
        out.append(len(held) - 1)
    return out


def greedy_clusters(rows: DataFrame, file: str, order: str, speaker: str | None = None, vector: str = "embedding", least: float = 0.74, prefix: str = "AUTO", unknown: str = "UNKNOWN") -> DataFrame:
    """(file, order, spk_final): online clustering of each file's vectors of unknown speakers, in order; it depends on the order, so a file is one group.

    Rows with another name in ``speaker`` keep it, and unknown ones without a vector
    stay unknown; without that column all are unknown. Clusters are named by
    prefix, the file's name made safe and a number.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        labels = greedy_labels(np.array([np.asarray(v, np.float64) for v in pdf[vector]]), least)
        return pd.DataFrame({file: pdf[file], order: pdf[order], "spk_final": [f"{f}_p{k:03d}" for f, k in zip(pdf["__name"], labels)]})

    kinds = dict(rows.dtypes)
    name = F.col(speaker) if speaker else F.lit(unknown)
    open_ = name.eqNullSafe(F.lit(unknown)) & F.col(vector).isNotNull()
    named = F.concat(F.lit(f"{prefix}_"), sanitize_id(F.col(file).cast("string")))
    found = rows.where(open_).select(file, order, vector, named.alias("__name")).groupBy(file).applyInPandas(one, f"{file} {kinds[file]}, {order} {kinds[order]}, spk_final string")
    return found.unionByName(rows.where(~open_).select(file, order, name.alias("spk_final")))


__all__ = ["centroids", "cosine", "decisions", "greedy_clusters", "greedy_labels", "norm", "similarities"]
