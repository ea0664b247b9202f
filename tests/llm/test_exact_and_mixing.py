from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerflow.llm import exact_dedup, mixing


def brute_groups(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        g = groups[norm(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "a b"), (2, "a  b"), (3, "a\tb"), (4, " a b"), (5, ""), (6, None), (7, " "), (8, "é" * 50_000), (9, "é" * 50_000), (9, "é" * 50_000), (None, "a b"), (None, "only"), (10, "a b ")]


def test_groups_against_brute_force(make_docs):
    got = exact_dedup.exact_groups(make_docs(ROWS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(ROWS)


def test_chained_collisions_and_split_buckets(make_docs):
    """With 3 hash bits nearly all texts share a hash; buckets of one key split to full depth."""
    rows = [(i, f"text {i % 40}") for i in range(200)]
    got = exact_dedup.exact_groups(make_docs(rows), capacity=1, hash_bits=3).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(rows)
    texts = make_docs(rows).select("doc_id", F.col("text").alias("norm")).withColumn("h", exact_dedup.hash_key(F.col("norm"), 3))
    index = exact_dedup.build_index(texts, texts, len(rows), 1, 3)
    assert index.count() == 40 and index.agg(F.max("chain")).first()[0] > 1


def test_directory_splits_only_what_is_over_capacity(spark):
    keys = spark.createDataFrame([(h, 1) for h in [0, 1, 2, 3, 4, 5, 6, 7, 0x80, 0xC0]], "h long, n long")
    slots = {r["slot"]: (r["local_depth"], r["bucket"]) for r in exact_dedup.directory(keys, 8, 2, 8).collect()}
    assert slots[0x80] == slots[0xC0][:1] + (0x80,) or slots[0x80][0] == 1  # two keys in the upper half share one bucket
    assert slots[0][0] == 7 and slots[0][1] == slots[1][1] and slots[2][1] != slots[0][1]


def test_owners_have_whole_buckets_in_order_and_like_shares(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("h"), F.lit(1).cast("long").alias("n"))
    rows = exact_dedup.owned(exact_dedup.directory(keys, 10, 20), 8).join(
        keys.groupBy(F.shiftrightunsigned("h", 54).alias("slot")).agg(F.count("*").alias("n")), "slot"
    ).orderBy("slot").collect()
    of_bucket = defaultdict(set)
    share = defaultdict(int)
    for r in rows:
        of_bucket[r["bucket"]].add(r["owner"])
        share[r["owner"]] += r["n"]
    assert all(len(o) == 1 for o in of_bucket.values())
    assert [r["owner"] for r in rows] == sorted(r["owner"] for r in rows)
    assert sorted(share) == list(range(8)) and max(share.values()) < 1.2 * 4000 / 8


def test_owners_compare_where_texts_were_sent(spark, make_docs, capfd):
    """Texts are shuffled once, to the owners; a text that many rows share is combined before."""
    rows = [(i, "hot" if i % 3 else f"text {i % 500}") for i in range(3000)]
    got = exact_dedup.exact_groups(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(rows)
    sent = make_docs(rows).withColumn("owner", (F.col("doc_id") % 8).cast("int")).repartitionById(8, F.col("owner"))
    capfd.readouterr()
    sent.groupBy("owner", "text").agg(F.count("*")).explain()
    assert capfd.readouterr().out.count("Exchange") == 1


def test_keep_first_drops_repeats(make_docs):
    docs = make_docs(ROWS)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 10, 4, 5, 7, 8, None]


def test_empty_table(make_docs):
    assert exact_dedup.exact_groups(make_docs([])).count() == 0
    assert mixing.mix(make_docs([])).count() == 0


def brute_targets(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not full:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def test_targets_and_taken(make_docs):
    rows = [(i, "w " * (1 + i % 7), "en", "a") for i in range(100)] + [(200 + i, "x y", "en", "b") for i in range(3)]
    rows += [(300 + i, "z " * 30, "en", None) for i in range(40)] + [(400, None, "en", "a"), (401, "", "en", "empty"), (300, "z " * 30, "en", None)]
    docs = make_docs(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = brute_targets(sizes)
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s, t in taken.items():
        assert abs(t - want[s]) <= 30
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()))
    rows_out = mixing.mixed(docs)
    assert rows_out.columns == docs.columns
    assert rows_out.count() == sum(r["taken"] // r["size"] for r in got if r["size"])


def test_no_python_in_the_plan(make_docs):
    for df in (exact_dedup.exact_groups(make_docs(ROWS, extra=False)), mixing.mix(make_docs(ROWS, extra=False))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
