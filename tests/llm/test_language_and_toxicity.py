from __future__ import annotations

import math
import zlib

import numpy as np

from ledgerflow.llm import language_id as li
from ledgerflow.llm import toxicity as tx

SENTENCES = {
    "en": "the quick brown fox jumps over the lazy dog and then it runs through the green field with the other animals",
    "de": "der schnelle braune fuchs springt über den faulen hund und dann läuft er durch das grüne feld mit den anderen tieren",
    "fr": "le rapide renard brun saute par dessus le chien paresseux et puis il court dans le champ vert avec les autres animaux",
}


def language_rows():
    rows, i = [], 0
    for lang, s in SENTENCES.items():
        words = s.split()
        for k in range(30):
            rows.append((i, " ".join(words[(k * 7 + j * 3) % len(words)] for j in range(12)), lang))
            i += 1
    return rows


def brute_kneser_ney(words_by_lang: dict[str, list[str]], lang: str, word: str, order: int = 4) -> float:
    """Log probability of a word by the textbook recursion over dictionaries."""
    top: dict[str, int] = {}
    for w in words_by_lang[lang]:
        p = " " * (order - 1) + w + " "
        for i in range(len(p) - order + 1):
            top[p[i : i + order]] = top.get(p[i : i + order], 0) + 1
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = {}
        for g in counts[k + 1]:
            counts[k][g[1:]] = counts[k].get(g[1:], 0) + 1

    def prob(g: str) -> float:
        k = len(g)
        if not k:
            return 1.0 / (len(counts[1]) + 1)
        c = counts[k]
        n1, n2 = (sum(v == x for v in c.values()) for x in (1, 2))
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        same = {h: v for h, v in c.items() if h[:-1] == g[:-1]}
        if not same:
            return prob(g[1:])
        total = sum(same.values())
        return max(c.get(g, 0) - d, 0) / total + d * len(same) / total * prob(g[1:])

    p = " " * (order - 1) + word + " "
    return sum(math.log(prob(p[i : i + order])) for i in range(len(p) - order + 1))


def test_models_against_the_textbook(make_docs):
    rows = language_rows()
    models = li.train(make_docs(rows).select("lang", "text"))
    by_lang: dict = {}
    for _, text, lang in rows:
        by_lang.setdefault(lang, []).extend(text.split())
    sums = li.Scorer(models)._words(["fox", "grün", "xyz", "animaux", "q"])
    for i, w in enumerate(["fox", "grün", "xyz", "animaux", "q"]):
        for j, lang in enumerate(models.langs):
            assert abs(sums[i, j] - brute_kneser_ney(by_lang, lang, w)) < 1e-3, (w, lang)


def test_no_gram_of_a_large_alphabet_is_lost(make_docs):
    rng = np.random.RandomState(6)
    words = ["".join(chr(c) for c in rng.randint(0x4E00, 0x9FA0, 60)) for _ in range(1600)]  # some 100,000 distinct 4-grams
    models = li.train(make_docs([(i, " ".join(words[i::8]), "zh") for i in range(8)]).select("lang", "text"))
    top = {(" " * 3 + w + " ")[i : i + 4] for w in words for i in range(len(w) + 1)}
    for k in range(4, 0, -1):
        assert models.tables.filter(f"k = {k}").count() == len(top)
        top = {g[1:] for g in top}
    some = words[:1]
    sums = li.Scorer(models)._words(some)
    for i, w in enumerate(some):
        assert abs(sums[i, 0] - brute_kneser_ney({"zh": words}, "zh", w)) < 1e-3 * len(w)


def test_held_out_accuracy_and_edges(make_docs):
    rows = language_rows()
    docs = make_docs([*rows, (900, None), (901, ""), (902, "123 !?"), (903, "Все люди рождаются свободными и равными", None), (None, SENTENCES["de"], None), (904, SENTENCES["fr"] * 2000, None)])
    models = li.train_on(docs)
    found = li.identify(docs.select("doc_id", "text"), models)
    got = {r["doc_id"]: r for r in found.select("*", li.held_out().alias("held")).collect()}
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in rows if got[i]["held"]) >= 0.97 * sum(got[i]["held"] for i, _, _ in rows)
    for i, _, _ in rows:
        assert not got[i]["rejected"] and 0 <= got[i]["score"] <= 1
        assert got[i]["held"] == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert all(got[i]["lang_pred"] == "und" and got[i]["rejected"] and got[i]["score"] == 0 for i in (900, 901, 902))
    assert got[903]["rejected"] and got[None]["lang_pred"] == "de" and got[904]["lang_pred"] == "fr"
    nothing = li.identify(docs.select("doc_id", "text"), li.train(docs.filter("false").select("lang", "text"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert li.identify(make_docs([]).select("doc_id", "text"), models).count() == 0


def test_rows_without_language_teach_nothing(make_docs):
    rows = language_rows()
    a = li.gram_counts(make_docs(rows).select("lang", "text")).collect()
    with_nulls = make_docs([*rows, *((500 + i, "zzz zzz", None) for i in range(5))]).filter("lang is not null")
    assert sorted(map(tuple, a)) == sorted(map(tuple, li.gram_counts(with_nulls.select("lang", "text")).collect()))


def toxic_rows(spark):
    rng = np.random.RandomState(3)
    words = ["alpha", "beta", "gamma", "delta", "women", "muslims", "people", "tree", "river", "stone"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        text = " ".join(rng.choice(words, 20))
        if bad:
            text += " " + ("vileness" if i % 2 else "vilest") + (" women" if i % 3 else "")
        rows.append((i, text))
        labels.append((i, int(bad)))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_held_out_and_fair(make_docs, spark):
    rows, labels = toxic_rows(spark)
    docs = make_docs([*rows, (1000, None), (1001, ""), (1002, "tree " * 50_000 + "vilest"), (None, "vilest thing")])
    model = tx.train(docs, labels.filter(~tx.held_out()))
    scored = tx.score_texts(docs.select("doc_id", "text"), model).collect()
    assert len(scored) == 404
    got = {r["doc_id"]: r for r in scored}
    for i, _ in rows:
        assert got[i]["predicted"] == int(i % 5 == 0) == int(got[i]["score"] >= 0.3)
    assert got[1000]["score"] == got[1001]["score"] and got[1000]["predicted"] == 0
    assert got[1002]["predicted"] == 1 and got[None]["predicted"] == 1
    score = lambda t: model.bias + sum(model.weights.get(f, 0.0) for w in tx.text_words(t) for f in tx.word_features(w))
    assert abs(score("the women walk") - score("the men walk")) < 0.25  # a group's name does not move the score
    assert tx.score_texts(make_docs([]).select("doc_id", "text"), model).count() == 0


def test_counterfactual_penalty_matters(make_docs, spark):
    rows, _ = toxic_rows(spark)
    feats = [(np.array(sorted({f for w in tx.text_words(t) for f in tx.word_features(w)}), np.int64), int(i % 5 == 0)) for i, t in rows]
    pairs = tx.counterfactuals([(0,) if "women" in t else () for _, t in rows])
    gap = lambda m: abs(sum(m.weights.get(f, 0.0) for f in tx.word_features("women")) - sum(m.weights.get(f, 0.0) for f in tx.word_features("men")))
    assert gap(tx.fit(feats, pairs, 0.2, fair=1.0)) <= gap(tx.fit(feats, pairs, 0.2, fair=0.0)) + 1e-9


def test_one_class_or_no_labels(make_docs, spark):
    docs = make_docs([(1, "a"), (2, "b")])
    for rows in ([], [(1, 0), (2, 0)], [(1, None)]):
        model = tx.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert [r["predicted"] for r in tx.score_texts(docs.select("doc_id", "text"), model).collect()] == [0, 0]


def test_words_are_letters_with_their_marks():
    from ledgerflow.llm.language_id import words_of

    assert words_of("x²½ Ünï Ⅷ a1b don’t") == ["x", "ünï", "a", "b", "don", "t"]
    assert words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    assert words_of("²½ 12 _ Ⅷ") == []


def test_blocks_of_any_size_give_the_same_result(spark, make_docs, monkeypatch):
    from ledgerflow.llm import language_id

    rows = [(i, f"the cat number{'x' * (i % 7)} sat on mats" if i % 2 else f"der hund nummer{'y' * (i % 5)} lag auf matten", "en" if i % 2 else "de") for i in range(60)]
    docs = make_docs([*rows, (None, None), (61, ""), (62, "²½")]).repartition(3, "doc_id").sortWithinPartitions("doc_id")
    models = language_id.train_on(docs)
    found = []
    for limit in (1, 200, 10**6):
        monkeypatch.setattr(language_id, "BLOCK_CHARS", limit)
        found.append(sorted(map(str, language_id.identify(docs, models).select("doc_id", "lang_pred", "score", "rejected").collect())))
    assert len(found[0]) == 63 and found[0] == found[1] == found[2]
    assert sum("lang_pred='und'" in r for r in found[0]) == 3
