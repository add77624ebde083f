"""MinHash near-duplicates verified by odd sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .runtime import among, as_documents, cut, release, store, task, unused, without_ids
from .words import find_words, mix64, numbers, shingles, text_chunks

SHINGLE = 3
HASHES = 192
BANDS = 48
SKETCH_BITS = 1024
THRESHOLD = 0.5
MARGIN = 0.15
BLOCK = 8192
_SMALL = 16
_CELLS = 1 << 21
_SEEN = 200_000


def min_hashes(value: np.ndarray, first: np.ndarray, hashes: int) -> np.ndarray:
    """uint32 (documents with shingles, hashes): the least value of each hash function over a document's shingles."""
    some = np.flatnonzero(np.diff(first))
    out = np.empty((len(some), hashes), np.uint32)
    if not len(some):
        return out
    x = (value >> np.uint64(32)).astype(np.uint32)
    salt = numbers(11, hashes).astype(np.uint32)
    odd = (numbers(12, hashes) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    at = first[some]
    for k in range(hashes):
        out[:, k] = np.minimum.reduceat((x ^ salt[k]) * odd[k], at)
    return out


def odd_sketches(sig: np.ndarray, bits: int) -> np.ndarray:
    """uint64 (documents, bits / 64): bit b is the parity of the number of (hash function, value) samples that fall on b."""
    parity = np.zeros((len(sig), bits), np.uint8)
    rows = np.arange(len(sig))
    for k, salt in enumerate(numbers(13, sig.shape[1])):
        place = mix64(sig[:, k].astype(np.uint64) ^ salt) % np.uint64(bits)
        parity[rows, place.astype(np.int64)] ^= 1
    return np.packbits(parity, axis=1).view(np.uint64)


def similarity_table(hashes: int, bits: int) -> np.ndarray:
    """Estimated Jaccard similarity for each population count of the XOR of two sketches."""
    odd = np.arange(bits + 1)
    room = np.maximum(1 - 2 * odd / bits, 1e-9)
    return np.clip(1 + bits / (4 * hashes) * np.log(room), 0.0, 1.0)


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """int64 (documents, bands): a hash of each band's values and its number."""
    width = sig.shape[1] // bands
    key = np.tile(numbers(14, bands), (len(sig), 1))
    for j in range(width):
        key = mix64(key ^ sig[:, j : width * bands : width].astype(np.uint64))
    return key.view(np.int64)


_SIGNATURE = "doc_id bigint, same_as bigint, sketch binary, bands binary"


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary value of each row of a 2-dimensional array."""
    width = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary())


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """The rows of a column of binary values of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offs[0] : offs[-1]].reshape(len(column), -1).copy().view(kind)


@task()
def _signature_rows(batches: Iterator[pa.RecordBatch], q: int, hashes: int, bands: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Sketch and band keys of each document; one whose bands all equal those of an earlier one of the task only names that one."""
    seen: dict[bytes, int] = {}
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in text_chunks(batch.column(1)):
            value, _, first = shingles(find_words(data, offsets), q)
            some = np.flatnonzero(np.diff(first))
            if not len(some):
                continue
            sig = min_hashes(value, first, hashes)
            key = band_keys(sig, bands)
            own = ids[a:b][some]
            if len(seen) > _SEEN:
                seen.clear()
            leader = np.array([seen.setdefault(k.tobytes(), i) for k, i in zip(key, own.tolist())], np.int64)
            lead = np.flatnonzero(leader == own)
            rest = np.flatnonzero(leader != own)
            yield pa.RecordBatch.from_arrays([pa.array(own[lead]), pa.nulls(len(lead), pa.int64()), _binary(odd_sketches(sig[lead], bits)), _binary(key[lead])], names=["doc_id", "same_as", "sketch", "bands"])
            if len(rest):
                none = pa.nulls(len(rest), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(own[rest]), pa.array(leader[rest]), none, none], names=["doc_id", "same_as", "sketch", "bands"])


@task()
def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            key = _matrix(batch.column(1), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), key.shape[1]))], names=["band", "doc_id"])


# In small buckets a pair (a, b) with place null; in others the band as a, the document as b and its block as place.
_MET = "a bigint, b bigint, place bigint"


@task()
def _met_rows(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """What the buckets of a partition sorted by (band, doc_id) have to compare; a bucket of any size is read as it comes."""
    last, held, done = None, np.zeros(0, np.int64), 0  # the bucket at the end of what was read: its members not yet given out, and how many were

    def give(band: int, ids: np.ndarray, at: int, open_: bool) -> Iterator[pa.RecordBatch]:
        if at or open_ or len(ids) > _SMALL:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), band)), pa.array(ids), pa.array((at + np.arange(len(ids))) // block)], names=["a", "b", "place"])
        elif len(ids) > 1:
            i, j = np.triu_indices(len(ids), 1)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j]), pa.nulls(len(i), pa.int64())], names=["a", "b", "place"])

    for batch in batches:
        band, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(band):
            continue
        edge = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1], [True]]))
        if last is not None and band[0] == last:
            own = np.unique(ids[: edge[1]])
            held = np.concatenate([held, own[own > held[-1]] if len(held) else own])
            edge = edge[1:]
            if len(held) > max(block, _SMALL):
                yield from give(last, held[:-1], done, True)
                done, held = done + len(held) - 1, held[-1:]
        if len(edge) > 1:
            if last is not None:
                yield from give(last, held, done, False)
            size = np.diff(edge)
            two = edge[:-2][size[:-1] == 2]
            two = two[ids[two] != ids[two + 1]]
            yield pa.RecordBatch.from_arrays([pa.array(ids[two]), pa.array(ids[two + 1]), pa.nulls(len(two), pa.int64())], names=["a", "b", "place"])
            for k in np.flatnonzero(size[:-1] > 2):
                yield from give(band[edge[k]], np.unique(ids[edge[k] : edge[k + 1]]), 0, False)
            last, held, done = band[-1], np.unique(ids[edge[-2] :]), 0
    if last is not None:
        yield from give(last, held, done, False)


@task()
def _compared(batches: Iterator[pa.RecordBatch], most: int, maybe: int) -> Iterator[pa.RecordBatch]:
    """(a, b, odd_bits) of rows (a, b, sketch_a, sketch_b) with at most ``maybe`` odd bits."""
    for batch in batches:
        if batch.num_rows:
            z = np.bitwise_count(_matrix(batch.column(2), np.uint64) ^ _matrix(batch.column(3), np.uint64)).sum(axis=1, dtype=np.int64)
            near = np.flatnonzero(z <= maybe)
            yield _edge_batch([(batch.column(0).to_numpy()[near], batch.column(1).to_numpy()[near], z[near])])


def link_bucket(ids: np.ndarray, sketch: np.ndarray, most: int, maybe: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verified edges that join all members whose sketches differ in at most ``most`` bits, directly or in steps.

    Every pair of members is compared unless both are known to be joined, so the
    components are those of all pairs. Members with equal sketches are joined to
    the first of them and take part once. Pairs not known to be joined that differ in
    at most ``maybe`` bits are returned too.
    """
    maybe = most if maybe is None else maybe
    _, pick, group = np.unique(sketch, axis=0, return_index=True, return_inverse=True)
    group = group.ravel()
    edges_a, edges_b, edges_z = [], [], []
    same = np.flatnonzero(pick[group] != np.arange(len(ids)))
    if len(same):
        edges_a.append(ids[pick[group[same]]])
        edges_b.append(ids[same])
        edges_z.append(np.zeros(len(same), np.int64))
    pick = np.sort(pick)
    s, who = sketch[pick], ids[pick]
    open_ = np.arange(len(pick))
    parts = []
    while len(open_):
        z = np.bitwise_count(s[open_] ^ s[open_[0]]).sum(axis=1, dtype=np.int64)
        near = z <= most
        if near.sum() > 1:
            edges_a.append(np.full(int(near.sum()) - 1, who[open_[0]]))
            edges_b.append(who[open_[near]][1:])
            edges_z.append(z[near][1:])
        parts.append(open_[near])
        open_ = open_[~near]
    if len(parts) > 1:
        parts.sort(key=len)  # the largest part is only ever compared against, not walked
        rest = np.concatenate(parts)
        at = 0
        for part in parts[:-1]:
            at += len(part)
            others = rest[at:]
            step = max(1, _CELLS // len(others))
            for k in range(0, len(part), step):
                rows = part[k : k + step]
                z = np.bitwise_count(s[rows][:, None, :] ^ s[others][None, :, :]).sum(axis=2, dtype=np.int64)
                i, j = np.nonzero(z <= maybe)
                if len(i):
                    edges_a.append(who[rows[i]])
                    edges_b.append(who[others[j]])
                    edges_z.append(z[i, j])
    if not edges_a:
        return ids[:0], ids[:0], np.zeros(0, np.int64)
    return np.concatenate(edges_a), np.concatenate(edges_b), np.concatenate(edges_z)


def _edge_batch(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b, z = (np.concatenate(x) for x in zip(*parts))
    low, high = np.minimum(a, b), np.maximum(a, b)
    keep = low != high
    return pa.RecordBatch.from_arrays(
        [pa.array(low[keep]), pa.array(high[keep]), pa.array(z[keep].astype(np.int32))], names=["a", "b", "odd_bits"]
    )


@task()
def _linked(batches: Iterator[pa.RecordBatch], most: int, maybe: int) -> Iterator[pa.RecordBatch]:
    """Edges of the buckets of a partition of rows (band, low, high, doc_id, sketch) that is sorted by the first three; a bucket may span batches."""
    held: list[pa.RecordBatch] = []

    def parts(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        band, low, high, ids = (table.column(k).to_numpy() for k in range(4))
        sketch = _matrix(table.column(4), np.uint64)
        edge = np.flatnonzero(np.concatenate([[True], (band[1:] != band[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]), [True]]))
        for x, y in zip(edge, edge[1:]):
            yield _edge_batch([link_bucket(ids[x:y], sketch[x:y], most, maybe)])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(k).to_numpy() for k in range(3)]
        other = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]) | (key[2] != key[2][-1]))
        cut_at = int(other[-1]) + 1 if len(other) else 0
        if held and [c[0].as_py() for c in held[0].columns[:3]] != [k[0] for k in key]:
            yield from parts(held)
            held = []
        if cut_at:
            yield from parts([*held, batch.slice(0, cut_at)])
            held = []
        held.append(batch.slice(cut_at))
    if held:
        yield from parts(held)


@task()
def _exact(batches: Iterator[pa.RecordBatch], q: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """(a, b) of rows (a, b, text_a, text_b) whose word shingles have a Jaccard similarity of at least ``threshold``."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            sides = []
            for column in part.columns[2:]:
                sets: list[np.ndarray] = []
                for a, b, data, offsets in text_chunks(column):
                    value, _, first = shingles(find_words(data, offsets), q)
                    sets += [np.unique(value[first[k] : first[k + 1]]) for k in range(b - a)]
                sides.append(sets)
            both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides)])
            every = np.array([len(x) + len(y) for x, y in zip(*sides)]) - both
            keep = pa.array(both >= threshold * every - 1e-9)
            yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["a", "b"])


def near_duplicate_edges(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    hashes: int = HASHES,
    bands: int = BANDS,
    sketch_bits: int = SKETCH_BITS,
    margin: float = MARGIN,
    block: int = BLOCK,
) -> tuple[DataFrame, int]:
    """(a, b, odd_bits), and the number of odd bits up to which a pair is sure; those with more are to be decided by their texts.

    Every document is a query. Candidates share a band of MinHash values. A pair is
    sure if the XOR population count of its odd sketches estimates a Jaccard similarity
    of word shingles of at least ``threshold`` + ``margin``, and is left out below
    ``threshold`` - ``margin``. Documents of one task with equal bands are one
    candidate. Only ids meet in bands, of which small buckets give their pairs;
    larger ones are compared in blocks of ``block`` documents and pairs of blocks, each a task's
    work of bounded size, in which only pairs already joined through others are left out.

    Null and empty texts are in no pair; rows with a null id are left out; ties, repeated
    rows and other columns are as in ``near_duplicates``; an empty table gives no row.
    """
    if not 0 <= threshold - margin <= threshold + margin <= 1:
        raise ValueError("threshold and margin must leave similarities between 0 and 1")
    table = similarity_table(hashes, sketch_bits)
    most, maybe = (int(np.flatnonzero(table >= x)[-1]) for x in (threshold + margin, threshold - margin))
    spark = docs.sparkSession
    rows = as_documents(docs, id_col, text_col)
    signatures, _ = store(rows.mapInArrow(lambda it: _signature_rows(it, shingle, hashes, bands, sketch_bits), _SIGNATURE))
    copies = signatures.where("same_as IS NOT NULL").select(F.least("doc_id", "same_as").alias("a"), F.greatest("doc_id", "same_as").alias("b"), F.lit(0).alias("odd_bits"))
    leaders = signatures.where("same_as IS NULL")
    sketches = leaders.select("doc_id", "sketch")
    keys = leaders.select("doc_id", "bands").mapInArrow(_band_rows, "band bigint, doc_id bigint")
    met, _ = store(keys.repartition("band").sortWithinPartitions("band", "doc_id").mapInArrow(lambda it: _met_rows(it, block), _MET).distinct())
    release(spark)
    edge = "a bigint, b bigint, odd_bits int"
    pairs = met.where("place IS NULL").select("a", "b")
    pairs = pairs.join(sketches.toDF("a", "sketch_a"), "a").join(sketches.toDF("b", "sketch_b"), "b").select("a", "b", "sketch_a", "sketch_b")
    found = pairs.mapInArrow(lambda it: _compared(it, most, maybe), edge)
    members = met.where("place IS NOT NULL").select(F.col("a").alias("band"), F.col("b").alias("doc_id"), "place")
    last = members.groupBy("band").agg(F.max("place").alias("last"))
    spread = members.join(last, "band").join(sketches, "doc_id").withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))))
    spread = spread.select("band", F.least("place", "other").alias("low"), F.greatest("place", "other").alias("high"), "doc_id", "sketch")
    keyed = spread.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high", "doc_id")
    linked = keyed.mapInArrow(lambda it: _linked(it, most, maybe), edge)
    return copies.union(found).union(linked).groupBy("a", "b").agg(F.min("odd_bits").alias("odd_bits")), most


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, kept_doc_id): each document of a near-duplicate group but the one that stays, and that one.

    The smallest id of a group stays. Null or word-less texts are in no group;
    rows with a null id are left out; rows that repeat an id count as that one
    document; an empty table gives no row; other columns are ignored whatever
    their names. A text of fewer words than a shingle is one shingle.
    """
    spark = docs.sparkSession
    edges, most = near_duplicate_edges(docs, id_col, text_col, **options)
    edges, _ = store(edges)
    release(spark)
    groups, _ = store(components(edges.where(F.col("odd_bits") <= most)))
    release(spark)
    # Unsure pairs matter only between groups; the groups that their texts join are joined in turn.
    of = groups.select(F.col("node").alias("__n"), F.col("component").alias("__c"))
    unsure = edges.where(F.col("odd_bits") > most).select("a", "b")
    for side in ("a", "b"):
        unsure = unsure.join(of, F.col(side) == F.col("__n"), "left").withColumn(f"group_{side}", F.coalesce("__c", side)).drop("__n", "__c")
    unsure, _ = store(unsure.where("group_a <> group_b"))
    joined = groups
    if not unsure.isEmpty():
        rows = as_documents(docs, id_col, text_col)
        texts = cut(among(rows, cut(unsure.select(F.col("a").alias("doc_id")).union(unsure.select("b")).distinct())).distinct())
        both = unsure.select("a", "b").join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
        q, threshold = options.get("shingle", SHINGLE), options.get("threshold", THRESHOLD)
        alike = both.mapInArrow(lambda it: _exact(it, q, threshold), "a bigint, b bigint").distinct()
        more, _ = store(components(unsure.join(alike, ["a", "b"], "left_semi").select(F.col("group_a").alias("a"), F.col("group_b").alias("b"))))
        release(spark)
        lone = more.join(groups.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
        joined = groups.union(lone).join(more.toDF("component", "__root"), "component", "left").select("node", F.coalesce("__root", "component").alias("component"))
    return joined.where("node <> component").select(F.col("node").alias("doc_id"), F.col("component").alias("kept_doc_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those of near duplicates; of rows with equal id and text one stays.

    Rows with a null id are kept (equal texts once); null and empty texts are no
    near duplicates; an empty table stays one; all columns stay, whatever their names.
    """
    left = without_ids(docs, cut(near_duplicates(docs, id_col, text_col, **options)).select("doc_id"), id_col)
    key = F.col(f"`{id_col}`")
    again = cut(docs.groupBy(key.alias("id")).count().where("count > 1").select("id"))
    if again.isEmpty():  # no row is repeated: no exchange of texts for it
        return left
    name = unused(docs, "again_id")
    of_again = key.eqNullSafe(F.col(name))
    repeated = left.join(again.toDF(name), of_again, "left_semi")
    return left.join(again.toDF(name), of_again, "left_anti").unionAll(repeated.dropDuplicates([id_col, text_col]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
