"""Suffix-array removal, importance resampling and centroid clustering against plain versions."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lodestone.llm import clustering, queries, resampling, suffixes

DOCS = "doc_id long, text string, slice string, bucket string, docs string, bits int, rank int, score int, gain int, weight int"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "s", "b", "d", 1, 2, 3, 4, 5) for d, t in rows], DOCS)


# --- op11 -----------------------------------------------------------------------------------------


def plain_removal(rows, window=50, earlier=()):
    """Sorted (doc_id, n_bytes, n_removed, n_spans, digest): every string in a dict of its smallest doc_id."""
    first: dict[bytes, float] = {}
    for d, t in [*earlier, *rows]:
        raw = (t or "").encode()
        if d is not None:
            for k in range(len(raw) - window + 1):
                s = raw[k : k + window]
                first[s] = min(first.get(s, math.inf), d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - window + 1):
            if d is not None and first[raw[k : k + window]] < d:
                gone[k : k + window] = b"\x01" * window
        spans = len(re.findall(b"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got_removal(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    some = [" ".join(word() for _ in range(rng.randint(1, 160))) for _ in range(25)]
    shared = [" ".join(word() for _ in range(n)) for n in (9, 14, 40, 400)]
    texts = [*some, *(f"{rng.choice(some)} {rng.choice(shared)} {rng.choice(some)}" for _ in range(40)), *(shared[2] for _ in range(15))]
    for t in some[:10]:
        k = rng.randint(0, len(t))
        texts.append(t[:k] + "#" + t[k + 1 :])
    texts += [None, "", "x", "y" * 49, "z" * 50, "z" * 51, "z" * 700, "ab" * 300, "ab" * 26, "日本語" * 40, "日本語" * 30]
    rng.shuffle(texts)
    return list(zip(rng.sample(range(1000), len(texts)), texts, strict=True))


@pytest.mark.parametrize("buckets", [1, 7, None])
def test_removal_equals_every_string(spark, buckets):
    rows = [*corpus(), (5000, "repeat " * 20), (5000, "repeat " * 20), (None, "repeat " * 20), (None, None)]
    assert got_removal(suffixes.dedupe(docs(spark, rows).repartition(3), buckets=buckets)[0]) == plain_removal(rows)


@pytest.mark.parametrize("window", [24, 37, 100])
def test_removal_of_other_lengths(spark, window):
    rows = corpus(window)
    assert got_removal(suffixes.dedupe(docs(spark, rows), window=window)[0]) == plain_removal(rows, window)


def test_removal_of_nothing(spark):
    out = suffixes.dedupe(docs(spark, [(1, "a")]).limit(0))[0]
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "n_bytes"]


def test_kept_bytes_are_returned(spark):
    text = "The same long sentence stands in both documents, whole and unchanged. "
    left = {r.doc_id: bytes(r.kept).decode() for r in suffixes.dedupe(docs(spark, [(1, text), (2, "Before. " + text + "After.")]))[0].collect()}
    assert left == {1: text, 2: "Before. After."}


def test_slices_and_blocks_don_t_matter(spark, monkeypatch):
    rng = np.random.default_rng(2)
    text = rng.integers(97, 101, 5000).astype(np.uint8)
    whole = suffixes.entries(text, np.array([40, 60, 0, 2900, 2000]))
    assert whole.count.sum() == 11 + 2851 + 1951
    monkeypatch.setattr(suffixes, "BLOCK", 61)
    parts = suffixes.entries(text, np.array([40, 60, 0, 2900, 2000]))
    strings = lambda e: np.concatenate([np.arange(s, s + n) for s, n in zip(e.start, e.count, strict=True)]).tolist()
    anchors = lambda e: np.repeat(e.least, e.count).tolist()
    assert strings(whole) == strings(parts) and anchors(whole) == anchors(parts)


def test_a_family_judges_later_batches(spark):
    """Batches one by one: each is judged against itself and all before it, and levels merge."""
    rows = corpus(9)
    index, before = None, []
    for k in range(4):
        batch = [(1000 * (k + 1) + d, t) for d, t in rows[k::4]]
        out, index = suffixes.dedupe(docs(spark, batch), buckets=2, index=index, keep=True)
        assert got_removal(out) == plain_removal(batch, earlier=before)
        before += batch
    levels = index.groupBy("bucket").count().collect()
    assert len(levels) == 2 and all(r["count"] <= 3 for r in levels)


def test_levels_fall_in_size():
    rng = np.random.default_rng(5)
    family, seen = suffixes.Family(), {}
    for k in range(40):
        n = int(rng.integers(1, 30))
        high, low = rng.integers(0, 12, (2, n)).astype(np.uint64)
        for pair in zip(high.tolist(), low.tolist(), strict=True):
            seen[pair] = seen.get(pair, 0) + 1
        family.add(suffixes.sort_level(high, low, np.arange(n) + 100 * k, np.zeros(n, bool)))
        sizes = [len(x.entry).bit_length() for x in family.levels]
        assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == len(sizes)
    assert sum(seen.values()) == sum(len(x.entry) for x in family.levels)
    for x in family.levels:
        assert list(zip(x.high, x.low, strict=True)) == sorted(zip(x.high, x.low, strict=True))


def test_one_hash_for_two_strings(monkeypatch):
    """Hashes that always collide change nothing: texts decide."""
    rows = [(k, t) for k, (_, t) in enumerate(corpus(4)[:30])]
    raw = [(t or "").encode() for _, t in rows]
    texts = pa.array(raw, pa.binary())
    found = suffixes.entries(np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw]))
    monkeypatch.setattr(suffixes, "entries", lambda *_: found)
    monkeypatch.setattr(suffixes, "_mix", lambda h: h * np.uint64(0))
    s = suffixes.Slice(texts, np.array([d for d, _ in rows]), 1, 50)
    packed = [dict(zip(suffixes._BATCH_NAMES, p, strict=True)) for p in s.packed(0)]
    bits = {b: x for p in packed for _, b, x in suffixes.Bucket([p], 50).bits()}
    ends = np.cumsum(s.sizes)
    gone = s.removed(bits)
    assert [(d, int(gone[e - n : e].sum())) for (d, _), e, n in zip(rows, ends, s.sizes, strict=True)] == sorted((r[0], r[2]) for r in plain_removal(rows))


# --- op12 -----------------------------------------------------------------------------------------


def plain_resample(rows, target, percent=25, least=20, buckets=10_000, orders=2, seed=7):
    def grams(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[k : k + n]).encode()) % buckets for n in range(1, orders + 1) for k in range(len(w) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    for side, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for b in grams(text)[1]:
                side[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    scored = []
    for d, text in rows:
        n, found = grams(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        scored.append((d, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((x for x in scored if x[1] >= least), key=lambda x: (-x[4], math.inf if x[0] is None else x[0]))
    drawn = {k: r + 1 for r, k in enumerate(order[: percent * len(order) // 100])}
    return sorted(((*x, drawn.get(x)) for x in scored), key=repr)


TARGET = ["red green blue and RED green", None, "", "Äpfel und Öl 12 12 12"]


def mixed(n=160):
    rng = random.Random(8)
    pool = ["red", "Green", "blue", "und", "Äpfel", "x1", "12", "don't", "ÖL", "İ", "日本", "sea-side", "\x00"]
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("orders", [1, 2, 3])
def test_resample_equals_plain(spark, orders):
    rows = [*enumerate(mixed()), (900, None), (901, ""), (902, " .,- "), (903, "one"), (904, "long " * 30_000), (None, "a null id " * 12)]
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, bucket int")
    out = resampling.resample(docs(spark, rows), target, orders=orders)
    got = sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()), key=repr)
    assert got == plain_resample(rows, TARGET, orders=orders)


def test_repeated_rows_have_ranks_of_their_own(spark):
    rows = [(7, "the same words " * 10)] * 40 + [(8, "others here " * 15)] * 4
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    out = resampling.resample(docs(spark, rows), target, percent=50).collect()
    assert sorted(r["rank"] for r in out if r["rank"] is not None) == list(range(1, 23)) and len(out) == 44


def test_resample_of_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(docs(spark, [(1, "a")]).limit(0), none).count() == 0
    rows = list(enumerate(mixed(30)))
    got = resampling.resample(docs(spark, rows), none).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got), key=repr) == plain_resample(rows, [])


def test_resampling_stays_in_spark(spark):
    rows = resampling.resample(docs(spark, list(enumerate(mixed(5)))), spark.createDataFrame([(t,) for t in TARGET], "text string"))
    assert not re.search("Python|Arrow|Pandas", rows._jdf.queryExecution().executedPlan().toString())


# --- op13 -----------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, vector string, weight int, cluster string, distance int"


def plain_clusters(rows, clusters, rounds, dims, scale=64, seed=1):
    """Lloyd's rounds over every row, in exact integers."""
    kept = []
    for d, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((d, [max(-clustering.BOUND, min(clustering.BOUND, math.floor(scale * float(np.float32(x))))) for x in v]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, vs in groups.items():
            centroids[k] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    out = [(d, *nearest(v)) for d, v in kept]
    inertia: dict[int, int] = {}
    for _, s, k in out:
        inertia[k] = inertia.get(k, 0) + s
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((d, k, s, inertia[k], sum(inertia.values()), digest[k]) for d, s, k in out), key=repr)


def got_clusters(spark, rows, **kw):
    df = spark.createDataFrame([(d, v, "v", 1, "c", 2) for d, v in rows], VECTORS)
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in clustering.cluster(df, **kw).collect()), key=repr)


def test_clusters_equal_plain(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(0, 0.3, 6)]) for k in range(150)]
    rows += [(200 + k, rows[3][1]) for k in range(90)] + [(7, rows[9][1]), (7, rows[9][1]), (None, rows[1][1]), (None, rows[2][1])]
    rows += [(500, None), (501, []), (502, [1.0] * 5), (503, [1.0] * 7), (504, [float("nan")] * 6), (505, [float("inf")] + [0.0] * 5), (506, [None] + [0.0] * 5), (507, [-0.0] * 6)]
    for kw in ({"clusters": 5, "rounds": 3}, {"clusters": 16, "rounds": 0}, {"clusters": 400, "rounds": 1}):
        assert got_clusters(spark, rows, dimensions=6, **kw) == plain_clusters(rows, dims=6, **kw)


def test_large_components_are_held(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [2e6, -2e6]), (4, [2.0, 1e30])]
    assert got_clusters(spark, rows, clusters=2, rounds=2, dimensions=2) == plain_clusters(rows, 2, 2, 2)


def test_equal_vectors_fill_one_cluster(spark):
    rows = [(k, [0.5, -0.5]) for k in range(50)]
    got = got_clusters(spark, rows, clusters=4, rounds=2, dimensions=2)
    assert got == plain_clusters(rows, 4, 2, 2) and {r[1] for r in got} == {0}
    assert got_clusters(spark, [], dimensions=2) == []


# --- registered queries ---------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("name", ["op11_suffix_dedup", "op12_importance_resampling", "op13_centroid_clusters"])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    df = queries.queries()[name](spark, "/root/testdata/sf0.001")
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.select(*cols).collect())
