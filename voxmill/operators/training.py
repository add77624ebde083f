"""Training tables: rows, reject reasons, seeded splits, hours and vocabulary."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import norm_text
from ..materialize import materialize, with_row_number

RESERVED = ("<pad>", "<unk>", "|")


@dataclass(frozen=True)
class TrainGate:
    targets: tuple[str, ...] = ("zh",)
    min_lang_prob: float = 0.90
    min_ovr: float = 0.0
    min_sig: float = 0.0
    min_bak: float = 0.0
    min_dur: float = 1.0
    max_dur: float = 30.0


def label_items(labels: DataFrame, model: str | None = None) -> DataFrame:
    """Label records of either layout as the flat columns that the training table is made of.

    The text is the transcript by ``model`` (none named: the first that isn't empty, by model
    name), else ``text``; duration, language, key and source fall back in the same
    way from the tar layout's columns to the loose ones. Absent columns count as null.
    """
    have = set(labels.columns)

    def of(name: str, kind: str = "string") -> Column:
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    said: Column = F.lit(None).cast("string")
    if "transcribe" in have:
        said = F.col("transcribe")[model] if model else F.get(F.filter(F.transform(F.sort_array(F.map_keys("transcribe")), lambda k: F.col("transcribe")[k]), lambda t: t != ""), F.lit(0))
    filled = {
        "text": F.coalesce(F.nullif(said, F.lit("")), of("text")),
        "duration_sec": F.coalesce(F.nullif(of("duration", "double"), F.lit(0.0)), of("duration_sec", "double"), F.lit(0.0)),
        "lang": F.coalesce(F.nullif(of("text_lang"), F.lit("")), of("lang"), F.lit("")),
        "key": F.coalesce(of("wav_uuid"), of("key")), "source_path": F.coalesce(of("tar_path"), of("source_path")), "wav": of("wav"),
        **{c: of(c, "double") for c in ("lang_prob", "mos_ovr", "mos_sig", "mos_bak")},
    }
    return labels.select(*(c for c in labels.columns if c not in filled), *(v.alias(k) for k, v in filled.items()))


def with_reason(items: DataFrame, gate: TrainGate) -> DataFrame:
    """Adds ``norm`` and ``reason``, the first gate a row fails: no_text, no_wav, duration, language, mos; or keep. Missing scores pass."""
    rows = items.withColumn("norm", norm_text(F.col("text")))
    dur = F.coalesce("duration_sec", F.lit(0.0))
    lang = F.coalesce(F.col("lang_prob"), F.lit(0.0)) < gate.min_lang_prob
    if gate.targets:
        lang |= ~F.coalesce(F.col("lang"), F.lit("")).isin(*gate.targets)
    low: Column = F.lit(False)
    for c, least in (("mos_ovr", gate.min_ovr), ("mos_sig", gate.min_sig), ("mos_bak", gate.min_bak)):
        low |= F.coalesce(F.col(c) < least, F.lit(False))
    reason = (
        F.when(F.col("norm") == "", "no_text").when(F.coalesce("wav", F.lit("")) == "", "no_wav").when((dur < gate.min_dur) | (dur > gate.max_dur), "duration")
        .when(lang, "language").when(low, "mos").otherwise("keep")
    )
    return rows.withColumn("reason", reason)


def reason_counts(items: DataFrame, gate: TrainGate) -> DataFrame:
    return with_reason(items, gate).groupBy("reason").agg(F.count("*").alias("n"))


def training_rows(items: DataFrame, gate: TrainGate, row: str) -> DataFrame:
    """The kept rows in the training layout; a row without an id is named by its number among all items."""
    rows = with_reason(items, gate).where("reason = 'keep'")
    return rows.select(
        F.coalesce("key", F.format_string("utt_%08d", F.col(row))).alias("key"), "wav", F.col("norm").alias("text"), "lang", "duration_sec", "mos_ovr", "mos_sig", "mos_bak",
        F.nullif("lang_prob", F.lit(0.0)).alias("lang_prob"), F.lit(None).cast("double").alias("sim_spk"), "source_path",
    )


def _edges(hashes: DataFrame, ranks: list[int]) -> list[str | None]:
    """The hash of each 0-based rank among the hex strings ``h``; None beyond the last.

    Counts of prefixes, one digit group after the other, lead to a group small enough to be fetched.
    """
    out: list[str | None] = []
    for rank in ranks:
        prefix, left = "", rank
        while True:
            width = len(prefix) + 4
            groups = hashes.where(F.col("h").startswith(prefix)).groupBy(F.left("h", F.lit(width)).alias("p")).count().orderBy("p").collect()
            inside = None
            for g in groups:
                if left < g["count"]:
                    inside = g
                    break
                left -= g["count"]
            if inside is None:
                out.append(None)
                break
            prefix = inside.p
            if inside["count"] <= 10_000 or len(prefix) >= 64:
                found = sorted(r.h for r in hashes.where(F.col("h").startswith(prefix)).limit(10_000 if inside["count"] <= 10_000 else 1).collect())
                out.append(found[left] if left < len(found) else found[-1])
                break
    return out


def _sizes(n: int, dev: float, test: float) -> tuple[int, int]:
    return max(1, int(n * test)), max(1, int(n * dev))


def seeded_split(rows: DataFrame, key: str, seed: int = 20260605, dev: float = 0.02, test: float = 0.02) -> DataFrame:
    """Adds ``split``: the rows in the order of a hash of seed and key are test, then dev, then train; test and dev get at least one row.

    Two passes read the key alone and find the hashes at which the parts end; the
    rows are then told apart by their own hashes, so none is moved or stored.
    """
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    hashes = rows.select(h.alias("h"))
    n = rows.count()
    if n == 0:
        return rows.withColumn("split", F.lit("train"))
    n_test, n_dev = _sizes(n, dev, test)
    last_test, last_dev = _edges(hashes, [n_test - 1, min(n_test + n_dev, n) - 1])
    return rows.withColumn("split", F.when(h <= last_test, "test").when(h <= last_dev, "dev").otherwise("train"))


def shuffled_split(rows: DataFrame, order: list[Column], seed: int = 20260605, dev: float = 0.02, test: float = 0.02, most: int = 10_000_000) -> DataFrame:
    """Adds ``split`` as ``random.Random(seed).shuffle`` of the rows in their order would: first test, then dev, then train.

    For parity with single-machine splits: that shuffle is one sequence of draws, so
    the driver makes it for row numbers; more than ``most`` rows are an error, use ``seeded_split``.
    """
    held = materialize(with_row_number(rows, order, "__row"))
    n = held.count()
    if n > most:
        raise ValueError(f"{n} rows; at most {most} can be shuffled in sequence")
    places = list(range(n))
    random.Random(seed).shuffle(places)
    n_test, n_dev = _sizes(n, dev, test)
    named = [(p, "test") for p in places[:n_test]] + [(p, "dev") for p in places[n_test : n_test + n_dev]]
    parts = rows.sparkSession.createDataFrame(named, "__row bigint, split string")
    return held.join(parts, "__row", "left").withColumn("split", F.coalesce("split", F.lit("train"))).drop("__row")


def split_hours(rows: DataFrame, duration: str = "duration_sec") -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("n"), F.sum(duration).alias("seconds"), F.round(F.sum(duration) / 3600, 6).alias("hours"))


def char_vocab(texts: DataFrame, text: str, order: str) -> DataFrame:
    """(token, id, n): reserved tokens, then the characters but the space by falling count, of equals the one seen first.

    Counting hashes characters with partial aggregation. First places are sought
    among each text's distinct characters only, as one number of the text's
    place and the character's; only the distinct characters are ranked in one partition.
    """
    real = "token NOT IN ('', ' ')"
    counts = texts.select(F.explode(F.split(F.col(text), "")).alias("token")).where(real).groupBy("token").agg(F.count("*").alias("n"))
    seen = texts.select(order, F.posexplode(F.array_distinct(F.split(F.col(text), ""))).alias("pos", "token")).where(real)
    place = F.col(order).cast("decimal(20,0)") * F.lit(1 << 21).cast("decimal(8,0)") + F.col("pos")
    first = seen.groupBy("token").agg(F.min(place.cast("decimal(38,0)")).alias("first"))
    ranked = counts.join(first, "token").select("token", "n", (F.row_number().over(Window.orderBy(F.desc("n"), "first")) + len(RESERVED) - 1).cast("int").alias("id"))
    spark = texts.sparkSession
    fixed = spark.createDataFrame([(t, None, k) for k, t in enumerate(RESERVED)], "token string, n bigint, id int")
    return fixed.unionByName(ranked)
