"""Nearest neighbours and SimHash classes against brute force, and their edge cases."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from claimlens.llm import ann, queries, simhash

SF = "/root/testdata/sf0.01"


def brute(ids, vecs, q, k):
    s = {}
    for i, v in zip(ids, vecs):
        if i != ids[q]:
            t = 0.0
            for a, b in zip(vecs[q], v):
                t += float(a) * float(b)
            s[i] = t
    return sorted(s.items(), key=lambda x: (-x[1], x[0]))[:k]


def test_recall_and_exact_scores(spark):
    got = queries.QUERIES["op1_nearest_neighbours"](spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, vecs = [r[0] for r in rows], [r[1] for r in rows]
    hit = total = 0
    for q in range(0, len(ids), 20):
        own = got[got.query_id == ids[q]].sort_values("rank")
        want = brute(ids, vecs, q, 20)
        score = dict(brute(ids, vecs, q, len(ids)))
        assert own["rank"].tolist() == list(range(1, 21))
        assert own.score.tolist() == [score[i] for i in own.vec_id]
        hit += len(set(own.vec_id) & {i for i, _ in want})
        total += 20
    assert hit / total >= 0.9


def test_ann_edge_cases(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 8)).round(3)
    base *= rng.uniform(0.5, 2, (60, 1))                       # norms differ
    rows = [(i, [float(x) for x in v], 7) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in base[20]], 7) for i in range(50)]   # equal vectors
    rows += [(40, [float(x) for x in base[40]], 7)]            # a repeated row
    rows += [(200, None, 7), (220, [], 7), (240, [0.0] * 8, 7), (260, [1.0, None] + [0.0] * 6, 7),
             (280, [float("nan")] + [1.0] * 7, 7), (300, [float("inf")] + [1.0] * 7, 7), (None, [1.0] * 8, 7), (320, [1.0, 2.0], 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")
    for crowded in (32_768, 16):                               # whole buckets, and split ones
        monkeypatch.setattr(ann, "CROWDED", crowded)
        got = ann.search(df, lambda i: i % 20 == 0, k=5, tables=6, probes=16).toPandas()
        good = [(i, v) for i, v, _ in dict(((r[0], tuple(r[1] or ())), r) for r in rows if r[0] is not None and r[0] < 200).values()]
        ids, vecs = [i for i, _ in good], [v for _, v in good]
        assert set(got.query_id) == {i for i in ids if i % 20 == 0}
        for q, i in enumerate(ids):
            if i % 20 == 0:
                own = got[got.query_id == i].sort_values("rank")
                assert list(zip(own.vec_id, own.score)) == brute(ids, vecs, q, 5)
    assert ann.search(df.limit(0), lambda i: i % 20 == 0).count() == 0


def test_second_axis(monkeypatch):
    monkeypatch.setattr(ann, "TARGET", 4)
    h = ann.Hasher(16, 2000, 1.0, 1.0, 4, 8)
    x = np.random.default_rng(0).normal(size=(50, 16))
    assert h.second
    for t in range(4):
        own, probed = h.buckets(x, t), h.buckets(x, t, True)
        assert (probed[:, :1] == own).all() and (probed < 2 * h.width * 2 * h.second).all()
        assert all(len(set(r)) == len(r) for r in probed.tolist())
    y = ann.hadamard(x)
    assert np.allclose(np.linalg.norm(y, axis=1), np.linalg.norm(x, axis=1))


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


TEXTS = ["", None, " \n\t", "One", "one two", "A b C d e f", "Ünï cödé wörds hëre\vand\fthere", "x " * 4000, "a b c " * 30, " no split here"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 1000)
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_hash_is_sparks(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"a b c", seed=42)


def classes(ids, fps, radius):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    out = []
    for i in range(len(ids)):
        own = [ids[j] for j in range(len(ids)) if find(j) == find(i) and ids[j] is not None]
        out.append(min(own) if own else None)
    return out


@pytest.mark.parametrize("segments,tile", [(4, 1 << 15), (8, 1 << 15), (4, 4), (8, 2)])
def test_links_are_whole(spark, monkeypatch, segments, tile):
    """Chains, crowds and far values; whole tiles and split ones."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(segments + tile)
    seeds = [int(x) for x in rng.integers(0, 2**63, 12)] + [0, 2**64 - 1]
    fps = set(seeds)
    for s in seeds[:8]:
        cur = s
        for _ in range(12):                                   # a chain of steps of at most two bits
            cur ^= (1 << int(rng.integers(64))) | (1 << int(rng.integers(64)))
            fps.add(cur)
            fps.add(s ^ (1 << int(rng.integers(64))))          # a crowd around its start
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    found = {r[0]: r[1] for r in simhash.components(simhash.links(simhash.tiled(df, 2, segments), 2)).collect()}
    want = classes(list(range(len(fps))), fps, 2)
    got = [found.get(f, f) for f in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_near_copies_edge_cases(spark):
    rows = [(i, t, "z") for i, t in enumerate(TEXTS)] + [(50, TEXTS[8], "z"), (50, TEXTS[8], "z"), (None, TEXTS[8], "z"), (None, "alone in the world of words", "z"), (51, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = simhash.near_copies(df).collect()
    fps = [slow_fingerprint(t) for _, t, _ in rows]
    want = classes([r[0] for r in rows], fps, 2)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted([(r[0], r[1], r[2]) for r in got], key=key) == sorted([(r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, want)], key=key)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted([r[0] for r in kept.collect() if r[0] is not None]) == sorted({c for r, c in zip(rows, want) if r[0] is not None})
    # one row of each class: the copy of TEXTS[8] without an id belongs to the class of an id, the other is alone
    assert [r[1] for r in kept.collect() if r[0] is None] == ["alone in the world of words"]
    assert simhash.near_copies(df.limit(0)).count() == 0 and simhash.keep_first(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    got = queries.QUERIES["op7_simhash_near_dedup"](spark, SF).toPandas().sort_values("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert got.fingerprint.tolist() == [f"{simhash.fingerprint(t):016x}" for _, t in docs]
    assert got.component_id.tolist() == classes(got.doc_id.tolist(), [int(f, 16) for f in got.fingerprint], 2)


@pytest.mark.parametrize("kind", ["one long", "heavy tail", "two crowds"])
def test_recall_with_unequal_norms(spark, kind):
    """Norms of any spread leave the recall; scores are inner products of the original vectors."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "one long":
        x[7] *= 100
    elif kind == "heavy tail":
        x *= (1 + rng.pareto(1.0, (1500, 1)))
    else:
        x[::2] *= 30.0 * rng.uniform(0.98, 1.02, (750, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(df, lambda i: i % 20 == 0, k=20).toPandas()
    s = x[::20] @ x.T
    s[np.arange(75), np.arange(0, 1500, 20)] = -np.inf
    hit = sum(len(set(got[got.query_id == 20 * q].vec_id) & set(np.argsort(-s[q])[:20].tolist())) for q in range(75))
    assert (got.groupby("query_id").size() == 20).all() and got.query_id.nunique() == 75
    assert hit / (75 * 20) >= 0.9
    assert np.allclose(got.score, [s[q // 20, v] for q, v in zip(got.query_id, got.vec_id)])


def test_queries_far_from_all_data(spark, monkeypatch):
    """A query whose buckets hold fewer than k is compared with everything, in blocks."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 16)) * 0.01
    x[:, 0] += 1                                               # a narrow crowd
    x[::100] = -x[::100]                                       # and queries opposite to it
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for crowded in (32_768, 100):
        monkeypatch.setattr(ann, "CROWDED", crowded)
        got = ann.search(df, lambda i: i % 100 == 0, k=20, tables=2, probes=2).toPandas()
        for q in range(0, 400, 100):
            own = got[got.query_id == q].sort_values("rank")
            want = brute(range(400), x, q, 20)
            assert list(zip(own.vec_id, own.score)) == want and own["rank"].tolist() == list(range(1, 21))


@pytest.mark.parametrize("target", [10, 2, 0.5])
def test_recall_with_second_axis(spark, monkeypatch, target):
    monkeypatch.setattr(ann, "TARGET", target)
    x = np.array([r[0] for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").select("embedding").collect()])
    h = ann.Hasher(x.shape[1], len(x), 1.0, 1.0, 12, 12)
    assert h.second
    seen = np.zeros((100, len(x)), bool)
    for t in range(12):
        own, probed = h.buckets(x, t)[:, 0], h.buckets(x[::20], t, True)
        for q in range(100):
            seen[q] |= np.isin(own, probed[q])
    s = x[::20] @ x.T
    s[np.arange(100), np.arange(0, 2000, 20)] = -np.inf
    recall = np.mean([seen[q, np.argsort(-s[q])[:20]].mean() for q in range(100)])
    print("second", h.second, "probes", h.probes, "recall", recall)
    assert recall >= 0.95
