from __future__ import annotations

import hashlib
import random

import sentencepiece

import corpus_pipeline as cp
from ledgerflow.llm import mixing
from ledgerflow.llm.catalog import ORACLE_SQL, QUERIES, tokenizer_path
from ledgerflow.llm.common import stage

GOOD = ["the quick brown fox jumps over the lazy dog while the small bird sings in the old tree", "a long road leads from the quiet village to the sea where fishing boats wait for the tide"]


def test_names_and_registration():
    import __spark_entry__ as entry

    assert [n for n, _ in cp.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
    found = entry.queries()
    assert "pipeline" in found and set(QUERIES) <= set(found)
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_stages_against_brute_force(spark, make_docs):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(" ".join(GOOD).split(), k=40))) for i in range(40)]
    copy, near = rows[4][1], rows[6][1] + " more"
    rows += [(100, copy.replace(" ", "  ")), (101, copy), (102, near), (103, "12345 !!"), (104, None), (105, ""), (106, "Все люди рождаются свободными", None), (4, copy), (None, copy), (None, "the quick brown dog", None)]
    docs = make_docs(rows)
    columns = docs.columns
    kept = []
    for name, step in cp.STAGES[:-1]:
        docs = stage(step(spark, docs, "unused"), f"test-{name}")
        assert docs.columns == columns, name
        kept.append(sorted((r["doc_id"] for r in docs.collect()), key=str))
    first = sorted([r[0] for r in rows if r[0] not in (103, 104, 105, 106)], key=str)
    assert kept[0] == first  # texts without letters and an unknown script go
    clean = list(range(40))
    assert sorted(x for x in kept[1] if x is not None) == [*clean, 102] and kept[1].count(None) == 1
    assert set(x for x in kept[2] if x is not None) <= set(clean) and 102 not in kept[2] and set(clean) - {6} <= set(kept[2])
    assert set(kept[3]) <= set(kept[2])
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = [(r["doc_id"], sp.encode(r["text"])) for r in docs.collect()]
    last = cp.STAGES[-1][1](spark, docs, "unused").collect()
    assert sorted(((r["doc_id"], list(r["ids"])) for r in last), key=str) == sorted(texts, key=str)
    digests = [(r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in docs.collect()]
    assert sorted(((r["doc_id"], r["decoded_sha256"]) for r in last), key=str) == sorted(digests, key=str)


def test_empty_documents_go_through(spark, make_docs):
    docs = make_docs([])
    for name, step in cp.STAGES:
        docs = stage(step(spark, docs, "unused"), f"test-{name}")
        assert docs.count() == 0


def test_mix_repeats_rows(spark, make_docs):
    docs = make_docs([(i, "w " * 10, "en", "a") for i in range(90)] + [(100 + i, "w " * 10, "en", "b") for i in range(10)])
    out = mixing.mixed(docs)
    assert 3 * 10 == out.filter("doc_id >= 100").count() and abs(out.count() - 100) <= 1
