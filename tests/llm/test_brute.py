"""Operators against brute force, libraries and held-out data on small inputs."""

import io
import itertools
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import sp_model
from pyspark.sql import functions as F

from voxmill.llm import components, decontam, lm_score, media, near_dup, passages, quality, registry, runtime, sampling, secrets, token_counts, unigram, warc
from voxmill.llm.words import find_words, shingles

WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def edited(rng, words, rate, vocabulary):
    return [rng.choice(vocabulary) if rng.random() < rate else w for w in words]


def test_words():
    texts = ["", "A b-c", "é日 x", "  ", "q"]
    column = pa.array(texts)
    raw = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    found = find_words(np.frombuffer(raw, np.uint8), offsets)
    assert [raw[a:b].decode() for a, b in zip(found.start, found.end)] == ["A", "b", "c", "é日", "x", "q"] and found.first.tolist() == [0, 0, 3, 5, 5, 6]
    assert len(column) == 5 and shingles(found, 2)[2].tolist() == [0, 0, 2, 3, 3, 4]


def test_near_duplicates_recall_and_precision(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, number = [], 0
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(40, 200))]
        for rate in (0, 0.02, 0.05, 0.1):
            rows.append((number, " ".join(edited(rng, words, rate, vocabulary))))
            number += 1
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = {k: set(zip(*(t.split()[j:] for j in range(near_dup.SHINGLE)))) for k, t in rows}
    like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sets, 2)}
    group = {r.doc_id: r.kept_doc_id for r in near_dup.near_duplicates(df).collect()}
    near = [p for p, j in like.items() if j >= near_dup.THRESHOLD + 0.05]
    assert np.mean([group.get(a, a) == group.get(b, b) for a, b in near]) >= 0.97
    assert all(a // 4 == b // 4 for a, b in group.items())
    assert near_dup.drop_near_duplicates(df).count() == len(rows) - len(group)


def test_pairs_at_the_threshold(spark):
    """Isolated pairs of documents that share exactly so many of their shingles."""
    rng = random.Random(9)
    draw = lambda n: [f"w{rng.randrange(1 << 40)}" for _ in range(n)]
    rows, like = [], []
    for own in [50] * 40 + [45] * 20 + [33] * 20 + [66] * 40:
        common = draw(102)
        for _ in range(2):
            rows.append((len(rows), " ".join(common + draw(own))))
        like.append(100 / (100 + 2 * own))
    found = {r.doc_id // 2 for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    share = lambda low, high: np.mean([k in found for k, j in enumerate(like) if low <= j < high])
    assert share(0.5, 0.51) >= 0.8 and share(0.5, 0.8) >= 0.9 and share(0, 0.5) <= 0.05


def test_blocks_of_large_buckets(spark):
    rng = random.Random(10)
    vocabulary = [f"w{k}" for k in range(5000)]
    rows = []
    for size in (45, 30, 3):
        words = [rng.choice(vocabulary) for _ in range(90)]
        rows += [(len(rows) + k, " ".join(edited(rng, words, 0.04 * (k > 3), vocabulary))) for k in range(size)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    sets = {k: set(zip(*(t.split()[j:] for j in range(near_dup.SHINGLE)))) for k, t in rows}
    near = [(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= near_dup.THRESHOLD * len(sets[a] | sets[b])]
    root = list(range(len(rows)))
    for _ in rows:
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    want = {k: m for k, m in enumerate(root) if m != k}
    for block in (near_dup.BLOCK, 7):
        assert {r.doc_id: r.kept_doc_id for r in near_dup.near_duplicates(df, block=block).collect()} == want


def test_buckets_are_read_as_they_come():
    """Whatever the batches, small buckets give all pairs, large ones their members in blocks."""
    rng = random.Random(11)
    sizes = [1, 2, 3, 16, 17, 40, 2, 1, 100]
    rows = [(b, i) for b, n in enumerate(sizes) for i in sorted(rng.sample(range(1000), n)) for _ in range(1 + (i % 7 == 0))]
    for step in (1, 3, 50, 1000):
        batches = [pa.record_batch([pa.array([x for x, _ in rows[k : k + step]]), pa.array([x for _, x in rows[k : k + step]])], names=["band", "doc_id"]) for k in range(0, len(rows), step)]
        got = [r for b in near_dup._met_rows(iter(batches), 8) for r in b.to_pylist()]
        for band, n in enumerate(sizes):
            ids = sorted({i for b, i in rows if b == band})
            if n > near_dup._SMALL:
                mine = sorted((r["b"], r["place"]) for r in got if r["place"] is not None and r["a"] == band)
                assert [i for i, _ in mine] == ids and [p for _, p in mine] == [k // 8 for k in range(n)]
        pairs = sorted((r["a"], r["b"]) for r in got if r["place"] is None)
        assert pairs == sorted(p for band, n in enumerate(sizes) if n <= near_dup._SMALL for p in itertools.combinations(sorted({i for b, i in rows if b == band}), 2))


def test_odd_sketches_estimate_high_similarities():
    rng = np.random.default_rng(0)
    for j, spread in ((0.5, 0.2), (0.8, 0.1), (0.95, 0.05)):
        wrong = []
        for _ in range(30):
            n = 4000
            both = int(n * j)
            value = rng.integers(0, 1 << 62, 2 * n - both).astype(np.uint64) << np.uint64(1)
            a, b = value[:n], value[n - both :]
            sig = near_dup.min_hashes(np.concatenate([a, b]), np.array([0, n, 2 * n]), 128)
            s = near_dup.odd_sketches(sig, 256)
            wrong.append(near_dup.similarity_table(128, 256)[np.bitwise_count(s[0] ^ s[1]).sum()] - both / (2 * n - both))
        assert abs(np.mean(wrong)) < 0.05 and np.std(wrong) < spread


def test_bucket_links_all_groups():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, (5, 4)).astype(np.uint64)
    sketch = np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 63, (20, 4)).astype(np.uint64)) * (rng.random((20, 4)) < 0.5) for b in base])
    ids = np.arange(100)
    most = 9
    a, b, _ = near_dup.link_bucket(ids, sketch, most)

    def groups(pairs):
        root = list(range(100))
        for x, y in pairs:
            x, y = (next(k for k in iter(lambda s=[v]: s.__setitem__(0, root[s[0]]) or s[0], None) if root[k] == k) for v in (x, y))
            root[max(x, y)] = min(x, y)
        return [next(k for k in iter(lambda s=[v]: s.__setitem__(0, root[s[0]]) or s[0], None) if root[k] == k) for v in range(100)]

    brute = [(x, y) for x, y in itertools.combinations(range(100), 2) if np.bitwise_count(sketch[x] ^ sketch[y]).sum() <= most]
    assert groups(zip(a.tolist(), b.tolist())) == groups(brute)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 103), (103, 101), (7, 7), (None, 3), (1, 2)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100, 103: 100}


def test_decontamination_against_all_windows(texts):
    rng = random.Random(5)
    items = [t.lower() for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/benchmark.parquet' ORDER BY item_id LIMIT 12").fetchall()]
    vocabulary = " ".join(texts.values()).lower().split()[:3000]
    planted, truth = [], []
    for k, item in enumerate(items):
        for rate in (0, 0.05, 0.1):
            around = [rng.choice(vocabulary) for _ in range(60)]
            planted.append(" ".join(around[:30] + edited(rng, item.split(), rate, vocabulary) + around[30:]))
            truth.append(k)
    index = decontam.build_index(np.arange(len(items)), items, decontam.SHINGLE)
    searcher = decontam.Searcher(index, decontam.SHINGLE, decontam.RADIUS, decontam.THRESHOLD)
    batch = pa.record_batch([pa.array(range(len(planted))), pa.array(planted)], names=["d", "t"])
    found = {(r["doc_id"], r["item_id"]) for b in searcher.rows([batch]) for r in b.to_pylist()}
    wide = decontam.Searcher(index, decontam.SHINGLE, 64, decontam.THRESHOLD)  # every fingerprint is within 64 bits: exact similarity of all windows
    brute = {(r["doc_id"], r["item_id"]) for b in wide.rows([batch]) for r in b.to_pylist()}
    assert found <= brute and len(found) >= 0.9 * len(brute)
    assert {(3 * k, k) for k in range(len(items))} <= found and all(truth[d] == i for d, i in found)


def test_leaks_against_loops():
    """Similarity, fingerprints and the choice of windows by plain loops over every window."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(60)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (6, 9, 9, 14)]
    texts = [" ".join(rng.choice(words) for _ in range(10)) + " " + " ".join(w if rng.random() > 0.12 else rng.choice(words) for w in rng.choice(items).split()) + " " + rng.choice(items) for _ in range(25)]
    index = decontam.build_index(np.arange(4), items, 2)
    weight = lambda h: float(index.weight[h >> np.uint64(64 - decontam._FILTER_BITS)])

    def hashes(text):
        raw = text.encode()
        return shingles(find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])), 2)[0].tolist()

    def simhash(hs):
        return [sum(weight(np.uint64(h)) * (1 if h >> j & 1 else -1) for h in hs) > 0 for j in range(64)]

    def like(x, y):
        both, every = 0.0, 0.0
        for h in {*x, *y}:
            both += min(x.count(h), y.count(h)) * weight(np.uint64(h))
            every += max(x.count(h), y.count(h)) * weight(np.uint64(h))
        return both / every

    want = set()
    for d, text in enumerate(texts):
        w = text.split()
        for i, item in enumerate(items):
            n, best = len(item.split()), None
            for at in range(len(w) - n + 1):
                own, its = hashes(" ".join(w[at : at + n])), hashes(item)
                if sum(a != b for a, b in zip(simhash(own), simhash(its))) <= decontam.RADIUS and (s := like(own, its)) >= decontam.THRESHOLD - 1e-9 and (best is None or s > best[0] + 1e-12):
                    best = (s, at)
            if best:
                want.add((d, i, best[1], round(best[0], 5)))
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["d", "t"])
    found = {(r["doc_id"], r["item_id"], r["first_word"], round(r["similarity"], 5)) for b in decontam.Searcher(index, 2, decontam.RADIUS, decontam.THRESHOLD).rows([batch]) for r in b.to_pylist()}
    assert found == want and len(want) > 20


def test_parts_of_the_benchmark_change_nothing(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    whole, parts = (sorted(tuple(r) for r in decontam.find_leaks(docs, items, part_bytes=n).collect()) for n in (decontam.PART_BYTES, 2000))
    assert whole == parts and whole


def test_hamming_blocks_find_all_within_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 40).astype(np.uint64)
    items = [" ".join(f"t{rng.integers(0, 50)}" for _ in range(20)) for _ in range(60)]
    s = decontam.Searcher(decontam.build_index(np.arange(60), items, 2), 2, 24, 0.5)
    w, i, d = s.candidates(np.zeros(40, np.int64), prints)
    brute = {(a, b) for a in range(40) for b in range(60) if np.bitwise_count(prints[a] ^ s.index.fingerprint[b]) <= 24}
    assert set(zip(w.tolist(), i.tolist())) == brute and all(np.bitwise_count(prints[a] ^ s.index.fingerprint[b]) == c for a, b, c in zip(w, i, d))


def test_exact_passages_are_found(spark, docs, texts):
    runs = {}
    for k, t in texts.items():
        w = WORD.findall(t.lower())
        for j in range(len(w) - 49):
            runs.setdefault(tuple(w[j : j + 50]), set()).add(k)
    want = set().union(*(v for v in runs.values() if len(v) > 1), set())
    rows = passages.repeated_passages(docs).collect()
    assert want <= {r.doc_id for r in rows} == {r.other_doc_id for r in rows}
    spans: dict[int, list] = {}
    for r in rows:
        spans.setdefault(r.doc_id, []).append((r.first_word, r.end_word))
    for k, t in texts.items():  # every repeated run of 50 words lies in a passage that was found, whichever document it is paired with
        w = WORD.findall(t.lower())
        for j in range(len(w) - 49):
            if len(runs[tuple(w[j : j + 50])]) > 1:
                assert any(a <= j and j + 50 <= b for a, b in spans[k])
    tokens = {k: WORD.findall(t.lower()) for k, t in texts.items()}
    for r in rows:
        a, b = tokens[r.doc_id][r.first_word : r.end_word], tokens[r.other_doc_id][r.other_first_word : r.other_end_word]
        assert len(a) == len(b) >= 50
        same = [a[k : k + 8] == b[k : k + 8] for k in range(len(a) - 7)]
        assert np.mean(same) == pytest.approx(r.similarity, abs=1e-6) and r.similarity >= passages.SHARE


def test_hot_tokens_and_repeated_ids(spark, monkeypatch):
    rng = random.Random(12)
    words = [f"v{k}" for k in range(20000)]
    draw = lambda n: [rng.choice(words) for _ in range(n)]
    shared, other = draw(70), draw(60)
    rows = [(k, " ".join(draw(30) + shared + draw(30))) for k in range(60)] + [(100, " ".join(draw(40) + other)), (200, " ".join(draw(80))), (200, " ".join(other + draw(20))), (200, None), (None, " ".join(other))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(passages, "_HOT_SAMPLE", 0.999)
    hot = passages.hot_tokens(passages.as_documents(df, "doc_id", "text"), 50, 8, 6, 20)
    assert len(hot[0]) and (hot[1] >= 2).all()
    found = passages.repeated_passages(df, hot=20).collect()
    assert {r.doc_id for r in found} == {*range(60), 100, 200} and not any(r.doc_id == r.other_doc_id for r in found)
    assert {(r.first_word, r.end_word) for r in found if r.doc_id == 200} == {(0, 60)}


def test_links_of_hot_tokens(spark, monkeypatch):
    """Documents whose passages have hot tokens only: as one network over all of them, and edited copies as without hot tokens."""
    rng = random.Random(16)
    words = [f"v{k}" for k in range(20000)]
    draw = lambda n: [rng.choice(words) for _ in range(n)]
    value = lambda w: shingles(find_words(np.frombuffer(x := " ".join(w).encode(), np.uint8), np.array([0, len(x)])), 8)[0]
    monkeypatch.setattr(passages, "_HOT_SAMPLE", 0.999)
    block, rows, edits = draw(30), [], {}
    for family in range(4):
        p = draw(20) + block + draw(20)
        for j in range(45):
            copy = edited(rng, p, 0.04 if j >= 40 else 0, words)
            if j >= 40 and passages.aligned_passages(value(p), value(copy), 0, 50, 8, passages.SHARE):
                edits[len(rows)] = family
            rows.append((len(rows), " ".join(draw(40) + copy + draw(40))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for options in ({"hot": 20}, {"pairwise": 16}, {"hot": 20, "pairwise": 16}):
        network = list(range(len(rows)))

        def root(k):
            while network[k] != k:
                k = network[k]
            return k

        for r in passages.repeated_passages(df, **options).collect():
            assert r.doc_id // 45 == r.other_doc_id // 45
            network[root(r.doc_id)] = root(r.other_doc_id)
        for family in range(4):
            assert len({root(45 * family + j) for j in range(40)}) == 1
        assert len(edits) > 8 and sum(root(k) == root(45 * family) for k, family in edits.items()) >= 0.97 * len(edits)


def test_second_tokens_of_verified_passages():
    """Windows of a token that lie in one verified passage meet by a second token."""
    rng = random.Random(17)
    words = [f"v{k}" for k in range(20000)]
    met = 0
    for _ in range(60):
        p = [rng.choice(words) for _ in range(60)]
        texts = [" ".join([f"x{j}_{k}" for k in range(50)] + c + [f"y{j}_{k}" for k in range(50)]) for j, c in enumerate((p, edited(rng, p, 0.05, words)))]
        a, b = passages._tokens(pa.array(texts, pa.large_string()), 8)
        for x, y, _ in passages.aligned_passages(a, b, 0, 50, 8, passages.SHARE):
            for c in (k for k in range(x, y + 1) if a[k] == b[k]):
                window = [{"token": 0, "place": c << 24 | 43 << 8 | 43, "kind": 3}]
                batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts), pa.array([window, window], pa.list_(pa.struct({"token": pa.int64(), "place": pa.int64(), "kind": pa.int8()})))], names=["doc_id", "text", "windows"])
                keys: dict[int, set] = {1: set(), 2: set()}
                for out in passages._around_rows(iter([batch]), 43, 8, 1):
                    for token, doc in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
                        keys[doc].add(token)
                assert keys[1] & keys[2]
                met += 1
    assert met > 100


def test_alike_windows_of_large_groups_meet_as_neighbours():
    """Pairs of alike windows in a large group are linked without comparing all with all, and to no other window."""
    rng = np.random.default_rng(3)
    n, compared = 6000, []
    words = rng.integers(0, 1 << 42, (n // 2, 2)).repeat(2, axis=0)
    place = np.full(n, 100 << 24 | 43 << 8 | 43)
    cols = [np.zeros(n, np.int64), np.arange(n), place, words[:, 0], words[:, 1], np.full(n, 42 << 8 | 42)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["token", "doc_id", "place", "front", "back", "ends"])
    alike = passages._alike
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(passages, "_alike", lambda *a: compared.append(len(a[4])) or alike(*a))
        out = pa.Table.from_batches(passages._linked_rows(iter([batch]), 43, 8))
    assert {(2 * k, 2 * k + 1) for k in range(n // 2)} == set(zip(out["a"].to_pylist(), out["b"].to_pylist()))
    assert sum(compared) < 20 * n


def test_edited_passages(spark):
    rng = random.Random(4)
    words = [f"v{k}" for k in range(5000)]
    rows = []
    for k in range(50):
        p = [rng.choice(words) for _ in range(120)]
        for j in range(2):
            rows.append((2 * k + j, " ".join([rng.choice(words) for _ in range(80)] + edited(rng, p, 0.03 * j, words) + [rng.choice(words) for _ in range(80)])))
    found = {(r.doc_id, r.other_doc_id) for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc_id < other_doc_id").collect()}
    assert all(a // 2 == b // 2 for a, b in found) and len(found) >= 45


def test_edited_copies_of_popular_passages(spark):
    rng = random.Random(6)
    words = [f"v{k}" for k in range(20000)]
    rows, verifiable = [], set()
    for family in range(8):
        p = [rng.choice(words) for _ in range(60)]
        value = lambda w: shingles(find_words(np.frombuffer(x := " ".join(w).encode(), np.uint8), np.array([0, len(x)])), 8)[0]
        for j in range(70):
            copy = edited(rng, p, 0.04 if j >= 60 else 0, words)
            if j >= 60 and passages.aligned_passages(value(p), value(copy), 0, 50, 8, passages.SHARE):
                verifiable.add(len(rows))
            rows.append((len(rows), " ".join([rng.choice(words) for _ in range(60)] + copy + [rng.choice(words) for _ in range(60)])))
    found = {(r.doc_id, r.other_doc_id) for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc_id < other_doc_id").collect()}
    assert all(a // 70 == b // 70 for a, b in found)
    assert len(verifiable) > 40 and len(verifiable & {x for p in found for x in p}) >= 0.97 * len(verifiable)
    assert len(found) < 30 * len(rows)


def test_verbatim_passages_over_common_blocks(spark):
    rng = random.Random(8)
    words = [f"v{k}" for k in range(20000)]
    draw = lambda n: [rng.choice(words) for _ in range(n)]
    rows, want = [], []
    for block, more in [(48, 4), (49, 2), (46, 6), (48, 3), (49, 1), (47, 4)] * 3:
        shared, rest = draw(block), draw(more)
        for j in range(42):
            rows.append((len(rows), " ".join(draw(60) + shared + (rest if j >= 40 else []) + draw(60))))
        want.append((len(rows) - 2, len(rows) - 1))
    found = {(r.doc_id, r.other_doc_id) for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc_id < other_doc_id").collect()}
    assert set(want) <= found


def test_compact_windows_against_all_nodes():
    rng = np.random.default_rng(1)
    for trial in range(20):
        sizes = rng.integers(0, 60, 5)
        first = np.concatenate([[0], np.cumsum(sizes)])
        value = rng.integers(0, 30 if trial % 2 else 1 << 60, sizes.sum()).astype(np.uint64)
        width, salt = int(rng.integers(1, 15)), np.uint64(5)
        key = (passages.mix64(value ^ salt) & ~np.uint64(0xFFFFFFFF)) | np.arange(len(value), dtype=np.uint64)
        want = set()
        for d in range(5):
            for c in range(first[d], first[d + 1]):
                lo = next((k + 1 for k in range(c - 1, first[d] - 1, -1) if key[k] < key[c]), first[d])
                hi = next((k - 1 for k in range(c + 1, first[d + 1]) if key[k] < key[c]), first[d + 1] - 1)
                if hi - lo + 1 >= width:
                    want.add((d, lo, c, hi))
        assert set(zip(*(x.tolist() for x in passages.compact_windows(value, first, salt, width)))) == want


def test_quality_held_out(spark):
    """A model of every second label, threshold included, against the other labels."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: (r.quality == 1 and r.toxic == 0, r.toxic == 1) for r in labels.where("doc_id % 2 = 1").collect()}
    kept = {r.doc_id: r.kept for r in quality.judged(docs.join(labels.select("doc_id"), "doc_id"), labels.where("doc_id % 2 = 0")).collect()}
    share = lambda wanted: np.mean([kept[d] for d, x in known.items() if wanted(x)])
    print(share(lambda x: x[0]), share(lambda x: not x[0]), share(lambda x: x[1]))
    assert share(lambda x: x[0]) > 0.97 and share(lambda x: not x[0]) < 0.2 and share(lambda x: x[1]) < 0.35


def test_quality_fits_all_labelled_documents(spark):
    """Shards of any size together take every labelled document, and a shard of all gives the weights of the dense fit."""
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "awful" if k % 3 == 0 else "fine"]) for _ in range(20))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(300)], "doc_id bigint, quality int, toxic int")
    one, many = quality.train(docs, labels), quality.train(docs, labels, shard=40)
    assert one.word.tolist() == many.word.tolist() and len(one.word) and one.level == pytest.approx(many.level)
    assert np.corrcoef(one.weight[: len(one.word)], many.weight[: len(one.word)])[0, 1] > 0.9
    assert np.allclose(one.mean, many.mean)
    x = np.random.default_rng(1).random((200, 5)).astype(np.float32)
    good = x[:, 0] > x[:, 1]
    scale = x.std(axis=0, dtype=np.float64)
    weight, _ = quality.fit_sparse(np.arange(201) * 3, np.tile(np.arange(3, dtype=np.int32), 200), x[:, :3].ravel(), x[:, 3:].astype(np.float64), good, 3)
    assert np.allclose(weight, quality.fit_pairs((x - x.mean(axis=0)) / scale.astype(np.float32), good) / scale, rtol=1e-2, atol=1e-2)


def test_threshold_against_all_cuts():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randrange(1, 30)
        score = np.array([rng.choice([0.0, 0.5, 1.0, rng.random()]) for _ in range(n)])
        good = np.array([rng.random() < s for s in score])
        cuts = sorted(set(score.tolist())) + [2.0]
        wrong = [sum((s < c) == g for s, g in zip(score, good)) for c in cuts]
        best = cuts[int(np.argmin(wrong))]
        level = quality.best_level(score, good)
        assert level == np.mean(score < best)
        assert ((score < quality.quantile_limit(score, level)) == (score < best)).all()


def test_significant_terms_against_loops(spark):
    rng = random.Random(7)
    rows = []
    for k in range(120):
        part = k % 2
        rows.append((part, " ".join([rng.choice(["alpha", "beta", "gamma"]) for _ in range(20)] + (["awful", "terrific"[: 4 + k % 5]] if part == 0 and rng.random() < 0.8 else []))))
    sample = spark.createDataFrame(rows, "part int, text string").repartition(3)
    found = quality.significant_terms(sample, 60, 60, 4.0)
    shares: dict[int, dict[int, float]] = {}
    for k, (_, text) in enumerate(rows):
        for _, _, words, terms, _ in quality._read(pa.array([text])):
            for of in terms:
                for t, n in zip(*np.unique(of, return_counts=True)):
                    shares.setdefault(int(t), {})[k] = (n / 20 if len(text.split()) == 20 else n / len(text.split())) ** 0.5
    want = set()
    for t, of in shares.items():
        groups = [[of.get(j, 0.0) for j, (p, _) in enumerate(rows) if p == g] for g in (0, 1)]
        if sum(x > 0 for g in groups for x in g) >= quality.MIN_SEEN:
            tests = []
            for floor, f in ((1e-7, lambda x: x), (1e-3, lambda x: float(x > 0))):
                (m, v), (m2, v2) = [(np.mean([f(x) for x in g]), (np.var([f(x) for x in g]) + floor) / len(g)) for g in groups]
                tests.append(abs(m - m2) / (v + v2) ** 0.5)
            if max(tests) >= 4:
                want.add(t)
    assert want == set(found.tolist()) and want


def test_bradley_terry_recovers_an_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3)).astype(np.float32)
    w = quality.fit_pairs(x, x[:, 0] * 2 - x[:, 1] > 0)
    assert w[0] > -w[1] > 0 and abs(w[2]) < 0.2 * w[0]


@pytest.fixture(scope="module")
def automata():
    return secrets.learn(secrets.labelled_credentials(150))


def test_automata_on_held_out_credentials(automata):
    named = []
    for name, w in secrets.labelled_credentials(40, seed=5):
        for text in (w, f'user/{w} "x"', f"<key>{w}</key>"):
            named.append(any(text[a:b] == w and f == name for _, a, b, f, _ in secrets.scan([text.encode()], automata)))
    assert np.mean(named) > 0.93
    plain = ["internationalization", "http://example.com/a/long/path/index.html", "g" * 40, "abcdefabcdefabcdefabcdefabcdefabcdefabcx", "9807915762804490", "a" * 300, "a.b@mail.example.com", "password="]
    assert all(not secrets.scan([w.encode()], automata) for w in plain)


def test_scanner_against_all_candidates(automata):
    rng = random.Random(2)
    held = [w for _, w in secrets.labelled_credentials(6, seed=9)]
    apart = set(secrets._SEPARATORS.decode())
    token = lambda c: c.isascii() and (c.isalnum() or c in apart)
    for _ in range(12):
        text = "".join(rng.choice([*held, " ", "\n", "-", "=", "a/b.", "é", "deadbeef", "AKIA", ":"]) for _ in range(8))
        want, reached, k = [], 0, 0
        while k < len(text):
            starts = token(text[k]) and (k == 0 or not token(text[k - 1]) or (text[k - 1] in apart and text[k] not in apart))
            found = []
            if starts and k >= reached:
                end = next((j for j in range(k, len(text)) if not token(text[j])), len(text))
                for j in range(k + 1, end + 1):
                    if j == end or text[j] in apart or text[j - 1] in apart:
                        for n, (name, m) in enumerate(automata.items()):
                            score = secrets.likelihoods([text[k:j].encode()], m)[0]
                            if j - k >= m.shortest and score >= m.least:
                                found.append((-(j - k), m.least - score, n, name, score))
            if found:
                length, _, _, name, score = min(found)
                want.append((len(text[:k].encode()), len(text[: k - length].encode()), name, pytest.approx(score)))
                reached = k - length
            k += 1
        got = [(a, b, name, s) for _, a, b, name, s in secrets.scan([text.encode()], automata)]
        assert got == want


def test_merged_states_make_loops_and_a_distribution():
    rng = random.Random(3)
    words = sorted("x" + "".join(rng.choice("ab") for _ in range(rng.randrange(1, 14))) + "y" for _ in range(400))
    model = secrets.automaton([w.encode() for w in words], slack=1.0)
    assert len(model.step) <= 6 and np.isfinite(secrets.likelihoods([b"x" + b"ab" * 20 + b"y"], model)[0])
    assert not np.isfinite(secrets.likelihoods([b"xab", b"aby", b"xcy", b"y"], model)).any()
    mass, total = {0: 1.0}, 0.0
    for _ in range(400):  # strings of every length together have probability 1
        ahead: dict[int, float] = {}
        for state, p in mass.items():
            total += p * np.exp(model.logp[state, secrets._END])
            for c in range(secrets._END):
                if model.step[state, c] >= 0:
                    ahead[model.step[state, c]] = ahead.get(model.step[state, c], 0) + p * np.exp(model.logp[state, c])
        mass = ahead
    assert total == pytest.approx(1, abs=1e-6)
    fixed = secrets.automaton([("".join(rng.choice("01") for _ in range(9))).encode() for _ in range(200)])
    assert np.isfinite(secrets.likelihoods([b"010101010"], fixed)[0]) and not np.isfinite(secrets.likelihoods([b"01010101", b"0101010101"], fixed)).any()


def test_planted_secrets_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {(r.doc_id, r.length) for r in secrets.find_secrets(docs).collect()}
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    planted = {d for d, t in rows if re.search(r'"([0-9a-f]{40}|[0-9A-F]{40})"', t)}
    assert planted and {(d, 40) for d in planted} == found


def test_likelihood_is_the_path_product():
    model = secrets.automaton([b"ab1", b"ab2", b"ab2", b"b"], alpha=0.05, slack=0.0)
    for w in (b"ab1", b"b", b"ab", b"zz", b""):
        state, total = 0, 0.0
        for c in [*w, secrets._END]:
            total += model.logp[state, c] if state >= 0 else -np.inf
            state = model.step[state, c] if state >= 0 else -1
        assert secrets.likelihoods([w], model)[0] == pytest.approx(total / (len(w) + 1))


@pytest.fixture(scope="module")
def model():
    return open(token_counts.MODEL, "rb").read()


def test_counts_equal_the_library(model, texts):
    """Whole texts, scores that are no round numbers, and ties by rounding: the library adds in single precision."""
    vocab = unigram.parse(model)
    rng = np.random.default_rng(1)
    round_ = vocab.score / unigram.UNIT
    some = [*texts.values(), "", "   ", " a", "a  b\n\nc", "日本語テキスト", "ﬁ½\U0001f600", "a" * 3000, " ".join(texts.values())[:50_000]]
    for score in (round_, round_ + rng.normal(0, 0.3, len(round_)), np.round(round_)):
        own = sp_model.as_unigram(model, score.tolist())
        library = sentencepiece.SentencePieceProcessor(model_proto=own)
        counter = token_counts.Counter(own)
        assert counter.lattices.vocab.single is not None and counter(some)[0] == [len(x) for x in library.encode(some)]


def test_counts_of_a_vocabulary_without_scores(model, texts):
    """Exact sums: cut and remembered chunks count as whole texts do."""
    counter = token_counts.Counter(model)
    some = [t[:3000] for t in texts.values()][:60]
    counter.lattices.separable = False
    whole = counter(some)
    counter.lattices.separable = True
    counter.known.clear()
    assert counter.lattices.vocab.single is None and counter(some) == whole


def test_trie_and_machine_give_the_same_lattice(model):
    vocab = unigram.parse(model)
    chunks = ["▁the", "▁▁▁x\ny", "日本", "▁" * 20, "q"]
    a, b = (unigram.Lattices(vocab, trie=t).edges(chunks) for t in (False, True))
    assert all((x == y).all() for x, y in zip(a, b))


def all_cuts(vocab, text):
    marked = "▁" + text.replace(" ", "▁")
    number = {p: k for k, p in enumerate(vocab.piece) if vocab.kind[k] == 1}

    def rest(i):
        if i == len(marked):
            yield (), 0
            return
        one = False
        for j in range(i + 1, len(marked) + 1):
            k = number.get(marked[i:j])
            if k is not None:
                one |= j == i + 1
                for ids, s in rest(j):
                    yield (k, *ids), s + vocab.score[k]
        if not one:
            for ids, s in rest(i + 1):
                yield (*vocab.byte_id[list(marked[i].encode())].tolist(), *ids), s + vocab.unknown

    return list(rest(0))


@pytest.mark.parametrize("text", ["ab c", "the cat", "é\nx 日"])
def test_samples_follow_the_distribution(model, text):
    sampler = sampling.Sampler(model, 3, 0.5, 1)
    cuts = all_cuts(sampler.vocab, text)
    w = np.array([s for _, s in cuts]) * 0.5 / unigram.UNIT
    p = np.exp(w - w.max())
    p /= p.sum()
    number = {ids: k for k, (ids, _) in enumerate(cuts)}
    n = 6000
    first, second, weight = np.zeros(len(p)), np.zeros(len(p)), []
    for at in range(0, n, 500):
        for found in sampler(np.arange(at, at + 500), [text] * 500):
            ks = [number[tuple(x[0].tolist())] for x in found]
            assert len(set(ks)) == len(ks) and len(ks) == min(3, len(p)) and all(a[2] >= b[2] for a, b in zip(found, found[1:]))
            assert all(x[1] == pytest.approx(np.log(p[k]), abs=1e-9) for x, k in zip(found, ks))
            first[ks[0]] += 1 / n
            second[ks[1]] += 1 / n
            weight.append(sum(np.exp(x[1] - x[3]) for x in found))
    want = sum(p[a] * np.where(np.arange(len(p)) == a, 0, p) / max(1 - p[a], 1e-12) for a in range(len(p)))
    assert abs(first - p).sum() / 2 < 0.03 and abs(second - want).sum() / 2 < 0.05 and np.mean(weight) == pytest.approx(1, abs=0.03)


def test_chunks_are_cut_and_numbered_in_one_pass(model):
    lattices = unigram.Lattices(unigram.parse(model), trie=True)
    for text in ("", " ", "a", "a b", " a b", "a  b", "a b ", "a\nb \u2581c", "a\u00a0b c"):
        marked = unigram.SPACE + text.replace(" ", unigram.SPACE) if text else ""
        assert lattices.chunks(text) == (unigram._CHUNK.findall(marked) if lattices.separable else [marked] if marked else [])
    tables = sampling.Tables(lattices, 0.5)
    assert tables.numbers(iter(["a", "b", "a", "c"]), 4).tolist() == [0, 1, 0, 2] and tables.numbers(iter(["c", "d"]), 2).tolist() == [2, 3]
    assert tables.chunks == 4 and tables.size[:4].tolist() == [1, 1, 1, 1] and not tables.number.new


def test_samples_do_not_depend_on_company(model):
    sampler = sampling.Sampler(model, 2, 0.5, 1)
    alone = sampler(np.array([7]), ["some words here"])[0]
    among = sampler(np.array([3, 7]), ["others", "some words here"])[1]
    assert [(a[0].tolist(), round(a[2], 9)) for a in alone] == [(a[0].tolist(), round(a[2], 9)) for a in among]


def test_workers_give_up_what_other_operators_keep(texts):
    rows = pa.record_batch({"doc_id": list(texts), "text": list(texts.values())})
    with open(token_counts.MODEL, "rb") as f:
        list(sampling._sample_rows(iter([rows]), f.read(), 2, 0.5, 1))
    assert set(runtime.kept) == {"sampling"}
    assert sum(b.num_rows for b in near_dup._signature_rows(iter([rows]), 3, 192, 48, 1024)) > 0
    assert not runtime.kept


def test_gradient_and_learning(texts):
    net = lm_score.Network(*(x.astype(np.float64) for x in lm_score.fresh_network(9, members=4, hidden=5)))
    r = np.random.default_rng(0)
    context, target = r.integers(0, 9, (40, 4)), r.integers(1, 9, 40)
    g = lm_score.loss_and_gradient(net, context, target)[1]
    embed = np.zeros_like(net.embed)
    for k, (cls, d) in enumerate(g.embed):
        embed[k // 2, k % 2][cls] = d
    for x, d in zip(net, [embed, *g[1:]]):
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in x.shape)
            old, sides = x[at], []
            for e in (1e-5, -1e-5):
                x[at] = old + e
                sides.append(lm_score.loss_and_gradient(net, context, target)[0])
            x[at] = old
            assert old == lm_score._NEVER or (sides[0] - sides[1]) / 2e-5 == pytest.approx(d[at], abs=1e-6)
    trainer = lm_score.Trainer(lm_score.fresh_network(9, members=4))
    target = context[:, 0] * 0 + 1 + (context[:, 2] > 4)
    losses = [trainer.step(context, target) for _ in range(150)]
    assert losses[-1] < 0.2 * losses[0]


def class_probability(net, context, target):
    """log P(target | context) by loops over every weight's formula."""
    groups, wide, members = net.inner.shape
    h = [float(np.tanh(net.embed[s, 0][context[2 * s]][j] + net.embed[s, 1][context[2 * s + 1]][j] + net.shift[s * wide // 2 + j])) for s in (0, 1) for j in range(wide // 2)]
    soft = lambda z, k: z[k] - np.log(np.sum(np.exp(z)))
    outer = [sum(h[j] * net.outer[j, g] for j in range(wide)) + net.outer_bias[g] for g in range(groups)]
    g, m = divmod(target, members)
    inner = [sum(h[j] * net.inner[g, j, k] for j in range(wide)) + net.inner_bias[g, k] for k in range(members)]
    return soft(np.array(outer), g) + soft(np.array(inner), m)


def test_pseudo_likelihoods_against_loops(spark, monkeypatch):
    texts = {1: "a b a c rare", 2: "b b once", 3: "c a rare seldom b", 4: "", 5: "once"}
    docs = spark.createDataFrame([*texts.items(), (2, texts[2]), (2, "other text of a seen id")], "doc_id bigint, text string").repartition(3)
    net = lm_score.fresh_network(8, members=3, hidden=4)
    monkeypatch.setattr(lm_score, "train", lambda *a, **k: net)
    found = lm_score.pseudo_likelihoods(docs, vocabulary=3, classes=8, own=2, members=3).collect()
    rows = [*texts.values(), texts[2], "other text of a seen id"]
    split = [t.split() for t in rows]
    hash_of = {w: int(find_words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)])).hash[0]) for t in split for w in t}
    count = {w: sum(t.count(w) for t in split) for w in hash_of}
    order = sorted(hash_of, key=lambda w: (-count[w], hash_of[w]))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    cls = {w: 1 + order.index(w) if order.index(w) < 2 else 3 + signed(hash_of[w]) % 5 for w in hash_of}
    mass = {c: sum(count[w] for w in hash_of if cls[w] == c) for c in cls.values()}
    want = []
    for t in split:
        at = lambda k, t=t: cls[t[k]] if 0 <= k < len(t) else 0
        want.append(sum(class_probability(net, [at(k - 1), at(k - 2), at(k + 1), at(k + 2)], cls[w]) + np.log(count[w] / mass[cls[w]]) for k, w in enumerate(t)))
    assert sorted((r.words, r.log_likelihood) for r in found) == [(n, pytest.approx(x, abs=1e-3)) for n, x in sorted(zip(map(len, split), want))]
    assert all(r.per_word == pytest.approx(r.log_likelihood / max(r.words, 1), abs=1e-4) for r in found)


def test_training_raises_the_likelihood(spark):
    r = random.Random(1)
    pairs = [("sun", "shines"), ("rain", "falls"), ("wind", "blows")]
    docs = spark.createDataFrame([(k, " ".join(w for _ in range(60) for w in r.choice(pairs))) for k in range(40)], "doc_id bigint, text string").repartition(3)
    options = dict(vocabulary=100, classes=16, own=8, members=4)
    mean = lambda rounds: lm_score.pseudo_likelihoods(docs, rounds=rounds, **options).agg(F.avg("per_word")).first()[0]
    assert mean(0) < np.log(1 / 6) and mean(24) > -0.7  # half of the words are certain, the other half are one of three given a neighbour: -0.55


def test_counts_of_all_words_are_known(spark):
    docs = spark.createDataFrame([(k, f"common words and seldom{k // 2 if k < 40 else k}x") for k in range(80)], "doc_id bigint, text string")
    found = {r.doc_id: r.log_likelihood for r in lm_score.pseudo_likelihoods(docs, vocabulary=3, classes=5, own=3, members=4).collect()}
    assert min(found[k] for k in range(40)) - max(found[k] for k in range(40, 80)) == pytest.approx(np.log(2), abs=1e-3)


def test_images_round_trip_and_resize():
    r = np.random.default_rng(0)
    for shape in ((7, 5), (9, 4, 3), (1, 1), (40, 33)):
        image = r.integers(0, 256, shape, dtype=np.uint8)
        assert (media.decode_image(media.encode_netpbm(image)) == image).all() and (media.decode_image(media.encode_bmp(image)) == image).all()
        for h, w in ((3, 4), (8, 9), (16, 2)):
            whole = np.repeat(np.repeat(image.astype(float), h, 0), w, 1)
            assert np.allclose(whole.reshape(h, shape[0], w, shape[1], *shape[2:]).mean((1, 3)), media.area_resize(image, h, w))
    assert (np.load(io.BytesIO(media.npy(image))) == image).all()
    assert media.decode_image(b"P1 # c\n3 1\n1 0 1").tolist() == [[0, 255, 0]] and media.decode_image(b"P2 2 1 3 0 3").tolist() == [[0, 255]]
    assert media.decode_image(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]] and media.decode_image(b"P5 1 1 65535\n\xff\xff").tolist() == [[255]]
    assert media.decode_image(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    ramp = np.tile(np.arange(90, 0, -10, dtype=np.uint8), (8, 1))
    assert media.difference_hash(ramp) == -1 and media.difference_hash(ramp[:, ::-1]) == 0


def bmp(bits, rows, palette=b"", top_down=False):
    """An uncompressed BMP of packed rows, top row first."""
    import struct

    h, width = len(rows), len(rows[0]) * 8 // bits
    body = b"".join(r + b"\0" * (-len(r) % 4) for r in (rows if top_down else rows[::-1]))
    at = 54 + len(palette)
    return b"BM" + struct.pack("<IHHI", at + len(body), 0, 0, at) + struct.pack("<IiiHHIIiiII", 40, width, -h if top_down else h, 1, bits, 0, len(body), 0, 0, len(palette) // 4, 0) + palette + body


def test_bitmaps_of_every_depth():
    grey, colours = bytes([10, 10, 10, 0, 200, 200, 200, 0]), bytes([1, 2, 3, 0, 4, 5, 6, 0, 7, 8, 9, 0])
    for down in (False, True):
        assert media.decode_image(bmp(1, [b"\xa0", b"\x0f"], grey, down)).tolist() == [[200, 10, 200, 10, 10, 10, 10, 10], [10, 10, 10, 10, 200, 200, 200, 200]]
        assert media.decode_image(bmp(4, [b"\x01", b"\x20"], colours, down)).tolist() == [[[3, 2, 1], [6, 5, 4]], [[9, 8, 7], [3, 2, 1]]]
        assert media.decode_image(bmp(32, [bytes([1, 2, 3, 9, 4, 5, 6, 9])], b"", down)).tolist() == [[[3, 2, 1], [6, 5, 4]]]
        assert media.decode_image(bmp(24, [bytes([1, 2, 3]), bytes([4, 5, 6])], b"", down)).tolist() == [[[3, 2, 1]], [[6, 5, 4]]]
    with pytest.raises(ValueError):
        media.decode_image(bmp(4, [b"\x05"], colours))


def test_media_query_against_loops(spark, data, texts):
    rows = {}
    for r in media.query(spark, data).collect():
        rows.setdefault(r.media_id, []).append(r)
    for ident in sorted(texts)[::9]:
        raw, colour = np.frombuffer(texts[ident].encode() or b"\0", np.uint8), ident % 2
        image = np.pad(raw, (0, -len(raw) % (64 * (3 if colour else 1)))).reshape((-1, 64, 3) if colour else (-1, 64)).astype(float)
        h = len(image)
        over = lambda n, m: np.array([[max(0.0, min(j + 1, (i + 1) * n / m) - max(j, i * n / m)) for j in range(n)] for i in range(m)])
        small = np.einsum("ij,jk...,lk->il...", over(h, 32), image, over(64, 32)) / (h * 64 / 1024)
        for r in rows[ident]:
            tile = np.load(io.BytesIO(r.npy))
            want = small[16 * r.tile_row : 16 * r.tile_row + 16, 16 * r.tile_col : 16 * r.tile_col + 16]
            assert (r.height, r.width, r.error) == (h, 64, None) and np.abs(tile - want).max() <= 0.5 + 1e-6
        grey = image @ np.array([0.299, 0.587, 0.114]) if colour else image
        cells = over(h, 8) @ grey @ over(64, 9).T / (h * 64 / 72)
        bits = "".join("1" if a > b + 1e-6 else "0" for row in cells for a, b in zip(row, row[1:]))
        assert len(rows[ident]) == 4 and rows[ident][0].dhash == (int(bits, 2) - (1 << 64 if bits[0] == "1" else 0))


def test_saved_tiles(spark, tmp_path):
    image = media.encode_netpbm(np.arange(64, dtype=np.uint8).reshape(8, 8))
    tiles = media.media_tiles(spark.createDataFrame([(5, bytearray(image))], "media_id bigint, content binary"), side=8, tile=4)
    assert media.save_tiles(tiles, str(tmp_path)).count() == 4
    assert np.load(tmp_path / "5_1_0.npy").tolist() == np.arange(64).reshape(8, 8)[4:, :4].tolist()


def test_loser_tree():
    r = random.Random(0)
    for k in range(9):
        runs = [sorted(r.choices(range(50), k=r.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(sum(runs, []))


def test_hot_key_spans_parts(spark):
    r = random.Random(4)
    rows = [("hot.com", r.randrange(300) if r.random() > 0.1 else None, k, r.choice("xyz")) for k in range(400)] + [(f"u{k % 9}.com", r.randrange(50), k, "d") for k in range(60)]
    captures = spark.createDataFrame(rows, "url string, ts bigint, page_id bigint, digest string").repartition(5)
    found = [tuple(x) for x in warc.capture_histories(captures, rows_per_part=37).collect()]
    want, before = [], {}
    low = lambda x: -1 if x is None else x
    for url, ts, ident, digest in sorted(rows, key=lambda x: (f"com,{x[0][:-4]})/", low(x[1]), x[2], x[3])):
        n, last_ts, last = before.get(url, (0, None, None))
        want.append((f"com,{url[:-4]})/", ts, ident, digest, n + 1, ts - last_ts if n and None not in (ts, last_ts) else None, n == 0 or digest != last))
        before[url] = (n + 1, ts, digest)
    assert found == want


def test_warc_oracle(spark, data):
    found = [tuple(r) for r in warc.query(spark, data).collect()]
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{data}/pages.parquet'")
    want = duckdb.sql(warc.ORACLE_SQL).fetchall()
    assert sorted(found, key=str) == sorted(want, key=str) and [r[0] for r in found] == sorted(r[0] for r in found)


def test_pipeline_against_its_parts(spark, data, docs):
    import corpus_pipeline

    labels, benchmark = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("labels", "benchmark"))
    kept = {r.doc_id for r in quality.judged(docs, labels).where("kept").collect()}
    left = docs.where(F.col("doc_id").isin(*kept))
    gone = {r.doc_id for r in near_dup.near_duplicates(left).collect()}
    left = left.where(~F.col("doc_id").isin(*gone, -1))
    gone |= {r.doc_id for r in decontam.find_leaks(left, benchmark).collect()}
    want = kept - gone
    rows = corpus_pipeline.run(spark, data).collect()
    vocab = unigram.parse(open(token_counts.MODEL, "rb").read())
    assert {r.doc_id for r in rows} == want and all(r.decoded for r in rows)
    assert not any(re.search(r"\b[0-9a-f]{40}\b", unigram.decode(vocab, r.ids)) for r in rows)
    assert [n for n, _ in corpus_pipeline.STAGES][:2] == ["quality_classifier", "minhash_near_dedup"]


def test_every_word_is_a_training_target(monkeypatch):
    seen, real = [], lm_score.contexts
    monkeypatch.setattr(lm_score, "contexts", lambda cls, first, at, doc: seen.extend(at.tolist()) or real(cls, first, at, doc))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([" ".join("abcdefgh" * 50)])], names=["doc_id", "text"])
    none = lm_score.lexicon(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(lm_score.CLASSES - 1 - lm_score.OWN_CLASSES), lm_score.CLASSES, lm_score.OWN_CLASSES)
    for k in range(lm_score.ROUNDS):
        list(lm_score._trained_rows(iter([batch]), none, lm_score.fresh_network(lm_score.CLASSES), lm_score.STRIDE, k, 0.01))
    assert sorted(seen) == list(range(400))


def test_registry():
    numbers = sorted(int(re.match(r"op(\d+)_", n).group(1)) for n in registry.queries())
    assert numbers == list(range(1, 11)) and set(registry.oracle_sql()) <= set(registry.queries())
