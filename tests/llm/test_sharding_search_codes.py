"""Sharding, ranked lexical search and vector codes against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerflow.llm import lexical_search, sharding, vector_codes
from ledgerflow.llm.common import table
from ledgerflow.session import scratch_path

SF = "/root/testdata/sf0.01"


# --- sharding -------------------------------------------------------------


def sharded(spark, docs, shards=8):
    return sharding.digests(sharding.shard(docs, scratch_path(spark, "shards"), shards)).collect()


def loads(rows, shards=8):
    out = [0] * shards
    for r in rows:
        out[r.shard] += r.size
    return out


def assert_gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_shards_hold_every_document_once_with_equal_bytes(spark):
    docs = table(spark, SF, "documents")
    rows = sharded(spark, docs)
    want = sorted((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs.collect())
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert_gapless(rows)
    held = loads(rows)
    assert max(held) - min(held) <= 0.001 * sum(held) / 8
    where = defaultdict(set)
    for r in rows:
        where[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in where.values())  # no group of sf0.01 is above a quarter shard
    assert {r.law for r in rows} == {"bytes"} and all(r.grown_shard is None for r in rows)
    assert sorted(map(tuple, sharded(spark, docs.repartition(5)))) == sorted(map(tuple, rows))  # the input's partitions do not matter


def test_shards_divide_a_hot_text_and_a_hot_row(spark, make_docs):
    rows = [(i, f"text {i} " + "x" * (i % 50)) for i in range(600)]
    rows += [(1000 + i, "the same text for a third of all rows") for i in range(400)]
    rows += [(7777, "one row, repeated " * 3)] * 700
    out = sharded(spark, make_docs(rows))
    assert len(out) == 1700 and Counter(r.doc_id for r in out)[7777] == 700
    assert_gapless(out)
    held = loads(out)
    assert max(held) - min(held) <= 0.01 * sum(held) / 8
    assert len({r.shard for r in out if r.doc_id == 7777}) > 1
    assert len({r.shard for r in out if 1000 <= r.doc_id < 1400}) > 1


def test_shards_of_nulls_empty_and_very_long_texts(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "x" * 300_000), (4, "ä" * 10), (4, "ä" * 10), (4, "other")]
    out = sharded(spark, make_docs(rows), shards=3)
    assert sorted((r.doc_id or 0, r.size) for r in out) == [(0, 6), (1, 1), (2, 1), (3, 300_001), (4, 6), (4, 21), (4, 21)]
    assert_gapless(out)
    assert sum(r.shard == [x.shard for x in out if x.doc_id == 3][0] for r in out) == 1  # the long text has a shard of its own
    assert sharded(spark, make_docs([])) == []


def test_shard_files_keep_whole_rows(spark, make_docs):
    docs = make_docs([(i, f"t{i}") for i in range(20)]).selectExpr("*", "'c' as shard", "'c' as slot", "'c' as record")
    written = sharding.shard(docs, scratch_path(spark, "shards"), 2)
    assert sorted(r.record.doc_id for r in written.collect()) == list(range(20))
    assert written.select("record.*").columns == docs.columns


def test_overfull_ranges_are_subdivided(spark, make_docs, monkeypatch):
    """A first sample that sees hardly anything leaves overfull ranges, which are then cut."""
    monkeypatch.setattr(sharding, "SAMPLES", 0.02)
    monkeypatch.setattr(sharding, "LEAST_RANGES", 64)
    docs = make_docs([(i, f"text {i}") for i in range(3000)])
    records = sharding.keyed(docs).groupBy("h", "k", "size").count().withColumnRenamed("count", "n")
    total = sum(len(f"text {i}") + 1 for i in range(3000))
    _, few = sharding.ranges(records, total, 64)
    monkeypatch.setattr(sharding, "SAMPLES", 16)
    _, many = sharding.ranges(records, total, 64)
    share = total / 64
    assert many["bytes"].max() <= 2 * share and few["rows"].sum() == many["rows"].sum() == 3000
    monkeypatch.setattr(sharding, "ROUNDS", 0)
    monkeypatch.setattr(sharding, "SAMPLES", 0.02)
    _, uncut = sharding.ranges(records, total, 64)
    assert uncut["bytes"].max() > few["bytes"].max()


# --- lexical search --------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def brute_rank(docs, items, top=50):
    words = [(d, TERM.findall((t or "").translate(SMALL))) for d, t in docs]
    words = [(d, w) for d, w in words if w]
    n_docs, n_terms = len(words), sum(len(w) for _, w in words)
    counts = [(d, len(w), Counter(w)) for d, w in words]
    df = Counter(t for _, _, c in counts for t in c)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(SMALL)))
        scored = []
        for d, n, c in counts:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, rank, None if none else d, -minus) for rank, (minus, none, d) in enumerate(sorted(scored)[:top], 1)]
    return out


def ranked(spark, docs, items, top=50, extra=False):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    if extra:
        d, i = (x.selectExpr("*", "1 as score", "2 as rank", "3 as terms", "4 as seq", "5 as item_row", "6 as n") for x in (d, i))
    return [tuple(r) for r in lexical_search.rank(d, i, top).collect()]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_ranking_equals_brute_force_on_the_given_tables(spark):
    docs = table(spark, SF, "documents")
    items = table(spark, SF, "benchmark")
    got = [tuple(r) for r in lexical_search.rank(docs, items).collect()]
    want = brute_rank([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(got) == sorted(want)


def test_ranking_ties_nulls_and_signs(spark):
    docs = [(i, "alpha beta") for i in range(120, 0, -1)] + [(None, "alpha beta"), (500, None), (501, ""), (502, "... !"), (503, "Alpha-BETA_alpha Ärger ärger ²")]
    docs += [(7, "alpha beta")]  # a repeated row is a document of its own
    items = [(1, "ALPHA, beta!"), (2, None), (3, ""), (4, "ärger"), (4, "Ärger"), (None, "alpha"), (5, "unknown words")]
    got = ranked(spark, docs, items, extra=True)
    assert sorted(got, key=key) == sorted(brute_rank(docs, items), key=key)
    mine = [r for r in got if r[0] == 1]
    assert [r[1] for r in sorted(mine, key=lambda r: r[1])] == list(range(1, 51))
    assert sum(r[2] == 7 for r in mine) == 2


def test_ranking_of_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == []
    assert ranked(spark, [(1, "a")], []) == []
    assert ranked(spark, [(1, "...")], [(1, "a")]) == []


def test_ranking_in_batches_and_long_texts(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choice(vocab, rng.integers(1, 60)))) for i in range(700)] + [(9999, "w1 w2 " * 100_000)]
    items = [(i, " ".join(rng.choice(vocab, 12))) for i in range(30)]
    want = sorted(brute_rank(docs, items, 10))
    assert sorted(ranked(spark, docs, items, 10)) == want
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 200)  # several batches of items
    assert sorted(ranked(spark, docs, items, 10)) == want


def test_bounds_prune_whole_batches(spark):
    """Documents of other topics are never scored, and the ranking is still exact."""
    rng = np.random.default_rng(5)
    docs, items = [], []
    for topic in range(40):
        vocab = [f"t{topic}x{i}" for i in range(30)]
        docs += [(topic * 1000 + i, " ".join(rng.choice(vocab, 25))) for i in range(150)]
        items.append((topic, " ".join(rng.choice(vocab, 8))))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    found, work = lexical_search.rank_with_work(d, spark.createDataFrame(items, "item_id long, text string"), 10)
    assert sorted(map(tuple, found.collect())) == sorted(brute_rank(docs, items, 10))
    (scored, pairs), = work
    assert pairs == 40 * 6000 and scored < 0.15 * pairs


# --- vector codes ------------------------------------------------------------


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """Plain k-means with Python's whole numbers: (vec_id, code, error, label_error), and the digest of the codebooks."""
    kept = [(i, [math.floor(4096 * float(v)) for v in x], label) for i, x, label in rows if x is not None and all(v is not None and math.isfinite(v) for v in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    width = max(1, -(-max(len(x) for _, x, _ in kept) // parts))
    cut = [[(x + [0] * (width * parts - len(x)))[p * width : (p + 1) * width] for p in range(parts)] for _, x, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for c in cut:
                held[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(held[e]) for col in zip(*held[e])] if held[e] else books[p][e] for e in range(len(books[p]))]
    out, per_label = [], Counter()
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        per_label[label] += out[-1][2]
    flat = ",".join(str(v) for p in range(parts) for e in books[p] for v in e)
    return [(i, code, error, per_label[label]) for i, code, error, label in out], hashlib.sha256(flat.encode()).hexdigest()


def coded(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    if extra:
        df = df.selectExpr("*", "1 as code", "2 as error", "3 as x", "4 as kind", "5 as no_label", "6 as label_rows")
    return vector_codes.encode(df).collect()


def assert_codes(spark, rows):
    got = coded(spark, rows)
    want, digest = brute_codes(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=key_str) == sorted(want, key=key_str)
    assert {r.codebooks_sha256 for r in got} == ({digest} if want else set())


def key_str(r):
    return repr(r)


def test_codes_equal_plain_k_means(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(np.float32(v)) for v in rng.normal(size=24)], int(i) % 3 if i % 7 else None) for i in rng.permutation(400)]
    assert_codes(spark, rows)


def test_codes_with_ties_copies_and_holes(spark):
    rng = np.random.default_rng(2)
    # few distinct values: many equal distances and entries that are equal from the start
    rows = [(i, [float(v) / 4096 for v in rng.integers(-2, 3, 16)], 1) for i in range(300)]
    rows += [(5, rows[5][1], 2), (5, rows[9][1], 2), (5, rows[9][1], 2)]
    rows += [(900, None, 1), (901, [1.0, None] * 8, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [0.0] * 15, None), (None, [0.5] * 16, None)]
    assert_codes(spark, rows)


def test_codes_of_few_short_and_no_vectors(spark):
    assert_codes(spark, [(3, [0.25] * 16, None), (1, [-0.5] * 16, 1)])
    assert_codes(spark, [(i, [float(i)] * (i % 12), i % 2) for i in range(40)])  # lengths 0 to 11
    assert_codes(spark, [(1, [], 1), (2, [], 1)])
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, 1)]) == []
    with pytest.raises(ValueError):
        coded(spark, [(1, [1e30] * 8, 1)])


def test_balls_skip_work(spark):
    """On clustered vectors most distances are never computed, and the codes are those of the full search."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(16, 64)) * 4
    rows = [(i, [float(np.float32(v)) for v in centres[i % 16] + rng.normal(size=64) * 0.05], i % 5) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    codes = vector_codes.fit(df)
    assert codes.compared[0] == 600 * 8 * 16
    assert sum(codes.compared[1:]) < 0.15 * 6 * 600 * 8 * 16
    want, digest = brute_codes(rows)
    assert sorted((r.vec_id, r.code, r.error) for r in codes.rows.collect()) == sorted(w[:3] for w in want)
    assert codes.sha256() == digest


def test_a_still_ball_is_kept_unseen():
    """No distances to other entries where neither the entry nor its neighbours moved."""
    rng = np.random.default_rng(6)
    book = rng.integers(-1000, 1000, (16, 8))
    parts = book[rng.integers(0, 16, 500)] + rng.integers(-400, 400, (500, 8))
    codes, best = vector_codes.full_search(parts, book)
    radius = np.array([best[codes == e].max(initial=0) for e in range(16)])
    new, again, compared = vector_codes.Balls(book, book, radius).assign(parts, codes)
    assert compared == 500 and (new == codes).all() and (again == best).all()
    new, again, more = vector_codes.Balls(book, None, None).assign(parts, rng.integers(0, 16, 500))
    assert more > 500 and (new == codes).all() and (again == best).all()
