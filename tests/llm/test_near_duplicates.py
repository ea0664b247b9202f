from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from ledgerflow.llm import minhash, vector_graph
from ledgerflow.llm.components import connected


def groups_of(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_connected_against_brute_force(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1080)] + [(7, 2000 + i) for i in range(200)]
    want = groups_of({x for e in edges for x in e if e[0] != e[1]}, [e for e in edges if e[0] != e[1]])
    got = {r["id"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_sets(rows, k):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    return out


def near_rows():
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(3000)]
    base = [" ".join(rng.choices(vocab, k=rng.randrange(5, 160))) for _ in range(60)]
    rows = []
    for n, t in enumerate(base * 4):
        w = t.split()
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((n, " ".join(w).upper() if n % 7 == 0 else " ".join(w)))
    line = " ".join(rng.choices(vocab, k=12))
    rows += [(1000 + i, line + " " + " ".join(rng.choices(vocab, k=rng.randrange(0, 8)))) for i in range(150)]  # a passage that many share
    core = rng.choices(vocab, k=60)
    for i in range(150):  # one large group of near copies
        w = list(core)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(60)] = rng.choice(vocab)
        rows.append((2000 + i, " ".join(w)))
    return rows + [(3000, None), (3001, ""), (3002, " \t\n"), (3003, "one"), (3004, "ONE"), (3005, "two words"), (3006, "x " * 30_000), (3007, "x " * 30_001), (3007, "x " * 30_001)]


@pytest.mark.parametrize("words", [4, 5])
def test_minhash_against_brute_force(make_docs, words, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 64)  # long lists are cut into blocks
    rows = near_rows()
    sets = brute_sets(rows, words)
    inverted = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inverted[x].append(i)
    both = defaultdict(int)
    for ids in inverted.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1 :]:
                both[a, b] += 1
    links = [(a, b) for (a, b), n in both.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    want = groups_of(sets, links)
    got = minhash.near_duplicates(make_docs([*rows, (None, "one")]), words).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"]), r


def test_minhash_keep_first_and_empty(make_docs):
    docs = make_docs([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other text"), (None, "a b c d e f g")])
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, None]
    assert minhash.near_duplicates(make_docs([])).count() == 0


def vector_rows():
    rng = np.random.RandomState(2)
    rows, i = [], 0
    for label in (0, 1, 2):
        centres = rng.randn(25, 32)
        for c in centres:
            for _ in range(rng.randint(1, 25)):
                v = c / np.linalg.norm(c) + rng.randn(32) * rng.choice([0.01, 0.03, 0.05])
                rows.append((i, [float(np.float32(x)) for x in v], label))
                i += 1
    same = rows[5]
    rows += [(i + k, same[1], same[2]) for k in range(30)]
    rows += [(i + 40, same[1], None), (i + 41, None, 0), (i + 42, [0.0] * 32, 0), (i + 43, [float("nan")] * 32, 0), (i + 44, [1.0, None] * 16, 0), (i + 45, [1.0, 2.0], 0)]
    rows += [(i + 46, [float("inf")] + [1.0] * 31, 0), (i + 47, [], 0), (i + 48, [2 * x for x in same[1]], same[2]), (i + 49, [1e-30 * x for x in same[1]], same[2])]
    return rows


@pytest.mark.parametrize("block", [1024, 64])
def test_vectors_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_graph, "SHARD", 100)
    monkeypatch.setattr(vector_graph, "BLOCK", block)
    rows = vector_rows()
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' as dim", "1 as copies", "0 as shard")
    good = {}
    for i, v, label in rows:
        x = np.asarray([np.nan if c is None else np.float32(c) for c in v or []], np.float64)
        if label is not None and len(x) and np.isfinite(x).all() and (x @ x) > 0:
            good[i] = (label, len(x), x / np.linalg.norm(x))
    links = [(a, b) for a in good for b in good if a < b and good[a][:2] == good[b][:2] and good[a][2] @ good[b][2] >= 0.93]
    degree = defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    want = groups_of([r[0] for r in rows], links)
    result = vector_graph.near_duplicates(vectors)
    got = {r["vec_id"]: r for r in result.collect()}
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got.values())
    assert 0.99 * 2 * len(links) <= found <= 2 * len(links)
    assert all(got[i]["n_links"] <= degree[i] for i in got)
    assert np.mean([got[i]["component_id"] == want[i] for i in got]) > 0.99
    assert vector_graph.audit(vectors, result, every=5, block=100).first()["recall"] >= 0.99


def test_vectors_recall_with_hundreds_of_centres(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD", 5)
    monkeypatch.setattr(vector_graph, "SAMPLE", 400)  # most vectors shape no centre, as in large tables
    rng = np.random.RandomState(4)
    rows = []
    for i in range(500):  # pairs close to the threshold, in no cluster
        a, u = rng.randn(2, 64)
        a /= np.linalg.norm(a)
        u -= (u @ a) * a
        cosine = rng.uniform(0.931, 0.95)
        b = cosine * a + np.sqrt(1 - cosine**2) * u / np.linalg.norm(u)
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, b.tolist(), 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    classes = vectors.selectExpr("string(label) as label", "size(embedding) as dim", "vec_id", "1L as copies", "embedding")
    assert len(vector_graph.centres(classes)["0", 64]) >= 200
    shards = {r["vec_id"]: set(r["shards"]) for r in vector_graph.sharded(classes).collect()}
    assert all(shards[i] & shards[i + 1] for i in range(0, 1000, 2))
    result = vector_graph.near_duplicates(vectors)
    recall = vector_graph.audit(vectors, result, every=1).first()
    assert recall["present"] == 1000 and recall["recall"] >= 0.99


def test_only_visitors_with_a_partner_join_the_graph(monkeypatch):
    """A shard's graph is built once over its own vectors; a task makes lists for no visitor that can't be linked."""
    rng = np.random.RandomState(6)
    own, far = rng.randn(300, 64), rng.randn(600, 64)
    near = own[:10] + 0.01 * rng.randn(10, 64)
    x = np.concatenate([own, far, near])
    n = len(x)
    part = pd.DataFrame({"shard": 3, "owner": np.where(np.arange(n) < 300, 3, 5), "block": 0, "one": 0, "other": 0, "vec_id": np.arange(n), "copies": 2, "embedding": list(x)})
    lists = vector_graph.build_block(part[part["owner"] == 3])
    part = part.merge(lists, "left", on="vec_id")
    part["neighbours"] = [e if isinstance(e, (list, np.ndarray)) else None for e in part["neighbours"]]
    made, real = [], vector_graph._pruned
    monkeypatch.setattr(vector_graph, "_pruned", lambda *given: [out := real(*given), made.append(len(out))][0])
    got = vector_graph.search_block(part, 0.93)
    assert sum(made) <= 10
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted([(i, 2, i) for i in range(10)] + [(900 + i, 2, i) for i in range(10)])


def test_vectors_of_one_id_keep_their_own_links(spark):
    """Rows that share a vec_id but not the vector or the label are rows of their own."""
    x, y = [1.0, 0.0, 0.0, 0.01], [0.0, 1.0, 0.0, 0.01]
    near = lambda v: [c + 0.05 for c in v]
    rows = [(1, x, 0), (1, y, 0), (1, [0.0, 0.0, 1.0, 0.0], 1), (4, near(x), 0), (5, near(y), 0), (6, [0.0, 0.0, 1.0, 0.02], 1), (6, [0.0, 0.0, 1.0, 0.02], 1), (7, x, 1)]
    got = vector_graph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()) == [
        (1, 1, 1, True), (1, 1, 1, True), (1, 2, 1, True), (4, 1, 1, False), (5, 1, 1, False), (6, 2, 1, False), (6, 2, 1, False), (7, 0, 7, True)
    ]


def test_vectors_empty(spark):
    assert vector_graph.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
