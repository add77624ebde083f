"""WARC external index merge: sorted runs of captures, merged by a loser tree into globally ordered histories."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import cut, tasks

_FIRST, _PERIOD, _STEP = 1_704_067_200, 31_536_000, 7919
_ROWS = 4096
PART_ROWS = 500_000


def url_key(url: Column) -> Column:
    """The sort key of a URL: host labels from the right, then path and query; null for null.

    Case, scheme, user, default port, a leading ``www.`` and the fragment don't
    count; a URL without a scheme starts with its host.
    """
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim(url)), r"#.*$", ""), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(plain, r"^([^/?]*)", 1)
    for pattern in (r"^.*@", r":(80|443)$", r"^www[0-9]*\."):
        host = F.regexp_replace(host, pattern, "")
    rest = F.regexp_replace(plain, r"^[^/?]*", "")
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


class LoserTree:
    """Merges sorted iterators: inner nodes hold the losers of the matches played there, the winner is on top.

    After the winner is taken only the matches on its way up are played again.
    Equal items come in the order of their iterators.
    """

    def __init__(self, runs: list[Iterator]):
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.head = [next(r, None) for r in self.runs]
        self.loser = [-1] * max(self.k, 1)
        for run in range(self.k):
            self._play(run)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        winner = run
        while node > 0:
            if self.loser[node] == -1:
                self.loser[node] = winner
                return
            if self._less(self.loser[node], winner):
                winner, self.loser[node] = self.loser[node], winner
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator:
        while self.k:
            run = self.loser[0]
            item = self.head[run]
            if item is None:
                return
            yield item
            self.head[run] = next(self.runs[run], None)
            self._play(run)


_LOW = float("-inf")
_NAMES = ["url_key", "ts", "page_id", "digest", "capture", "since_previous", "changed", "part", "at"]
_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64()]
_MERGED = "url_key string, ts bigint, page_id bigint, digest string, capture bigint, since_previous bigint, changed boolean, part int, at bigint"


def _order(key: str, ts: int | None, ident: int | None, digest: str | None) -> tuple:
    """What captures are ordered by; nulls come first."""
    return key, _LOW if ts is None else ts, _LOW if ident is None else ident, digest is not None, digest or ""


def _cursor(parts: list[pa.RecordBatch]) -> Iterator[tuple]:
    """(order, row) of one run, decoded a slice at a time."""
    for part in parts:
        for at in range(0, part.num_rows, _ROWS):
            for row in zip(*(c.to_pylist() for c in part.slice(at, _ROWS).columns)):
                yield _order(*row), row


def _runs(batches: Iterator[pa.RecordBatch]) -> list[list[pa.RecordBatch]]:
    """The rows, which come run after run, as their maximal ascending runs."""
    runs: list[list[pa.RecordBatch]] = []
    last = None
    for batch in batches:
        at = 0
        rows = batch
        for k, row in enumerate(zip(*(c.to_pylist() for c in rows.columns))):
            now = _order(*row)
            if last is None or now < last:
                if runs and k > at:
                    runs[-1].append(rows.slice(at, k - at))
                runs.append([])
                at = k
            last = now
        if rows.num_rows > at:
            runs[-1].append(rows.slice(at))
    return runs


def _merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Histories within a partition that holds a range of captures, run after run."""
    part = TaskContext.get().partitionId()
    before, number, at = None, 0, 0
    out: list[tuple] = []
    for _, row in LoserTree([_cursor(r) for r in _runs(batches)]):
        if before is None or row[0] != before[0]:
            before, number = None, 0
        number += 1
        since = row[1] - before[1] if before and row[1] is not None and before[1] is not None else None
        out.append((*row, number, since, before is None or row[3] != before[3], part, at))
        before = row
        at += 1
        if len(out) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)


_CARRY = "part int, url_key string, earlier bigint, last_ts bigint, last_digest string"


def _carried(ends: list) -> list[tuple]:
    """(part, key, captures of the key in parts before, last of them) of the parts that begin with the key that the part before ends with."""
    out = []
    key, count, ts, digest = None, 0, None, None
    for e in sorted(ends, key=lambda e: e.part):
        if key is not None and e.first_key == key:
            out.append((e.part, key, count, ts, digest))
        whole = e.first_key == e.last_key
        count = e.last_capture + (count if whole and e.first_key == key else 0)
        key, ts, digest = e.last_key, e.last_ts, e.last_digest
    return out


def capture_histories(captures: DataFrame, url_col: str = "url", ts_col: str = "ts", id_col: str = "page_id", digest_col: str = "digest", *, rows_per_part: int = PART_ROWS) -> DataFrame:
    """(url_key, ts, page_id, digest, capture, since_previous, changed) in global order of key, time, id and digest.

    Each input partition is sorted into a run. Ranges of captures, of about
    ``rows_per_part`` rows at most, gather their pieces of all runs, which arrive in
    order, and a loser tree merges them without another sort. A range may end within
    a key's history, so a key of very many captures is merged by many tasks; what a
    range needs of the one before, one row each, is added afterwards. ``capture``
    numbers the captures of a key from 1, ``since_previous`` is the time from the one
    before, and ``changed`` says whether the digest differs from it (true for the first).

    Captures with a null URL are left out; a null time, id or digest comes first
    and, for the time, has no ``since_previous``; equal captures all stay; an empty
    table gives no row; other columns are ignored.
    """
    spark = captures.sparkSession
    order = ["url_key", "ts", "page_id", "digest"]
    index = captures.select(
        url_key(F.col(f"`{url_col}`")).alias("url_key"), F.col(f"`{ts_col}`").cast("bigint").alias("ts"),
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{digest_col}`").cast("string").alias("digest"),
    ).where("url_key IS NOT NULL")
    runs = cut(index.sortWithinPartitions(*order))
    parts = max(tasks(spark), -(-runs.count() // rows_per_part))
    merged = cut(runs.repartitionByRange(parts, *order).mapInArrow(_merged_rows, _MERGED))
    size = merged.groupBy("part").agg(F.max("at").alias("at"))
    first = merged.where("at = 0").select("part", F.col("url_key").alias("first_key"))
    last = merged.join(size, ["part", "at"]).select("part", F.col("url_key").alias("last_key"), F.col("capture").alias("last_capture"), F.col("ts").alias("last_ts"), F.col("digest").alias("last_digest"))
    carried = spark.createDataFrame(_carried(first.join(last, "part").collect()), _CARRY)  # a row for each part at most
    both = merged.join(F.broadcast(carried), ["part", "url_key"], "left")
    opens = F.col("earlier").isNotNull() & (F.col("at") == 0)
    return both.select(
        "url_key", "ts", "page_id", "digest", (F.col("capture") + F.coalesce("earlier", F.lit(0))).alias("capture"),
        F.when(opens, F.col("ts") - F.col("last_ts")).otherwise(F.col("since_previous")).alias("since_previous"),
        F.when(opens, ~F.col("digest").eqNullSafe(F.col("last_digest"))).otherwise(F.col("changed")).alias("changed"),
    )


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures; they have no times, so each gets one within a year from its id."""
    ts = F.lit(_FIRST) + F.pmod(F.col("page_id") * _STEP, F.lit(_PERIOD))
    return pages.select("url", ts.alias("ts"), "page_id", F.md5(F.col("html").cast("binary")).alias("digest"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_histories(page_captures(spark.read.parquet(f"{sf_dir}/pages.parquet")))


ORACLE_SQL = f"""
WITH plain AS (
  SELECT page_id, html, regexp_replace(regexp_replace(lower(trim(url)), '#.*$', ''), '^[a-z][a-z0-9+.-]*://', '') AS u
  FROM pages WHERE url IS NOT NULL
), parts AS (
  SELECT page_id, html, regexp_replace(regexp_replace(regexp_replace(regexp_extract(u, '^([^/?]*)', 1), '^.*@', ''), ':(80|443)$', ''), '^www[0-9]*\\.', '') AS host,
         regexp_replace(u, '^[^/?]*', '') AS rest
  FROM plain
), captures AS (
  SELECT array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN starts_with(rest, '/') THEN rest ELSE '/' || rest END AS url_key,
         CAST({_FIRST} + (page_id * {_STEP}) % {_PERIOD} AS BIGINT) AS ts, page_id, md5(html) AS digest
  FROM parts
)
SELECT url_key, ts, page_id, digest,
       row_number() OVER w AS capture,
       ts - lag(ts) OVER w AS since_previous,
       coalesce(digest IS DISTINCT FROM lag(digest) OVER w, true) OR row_number() OVER w = 1 AS changed
FROM captures
WINDOW w AS (PARTITION BY url_key ORDER BY ts NULLS FIRST, page_id NULLS FIRST, digest NULLS FIRST)
"""
