from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import piece_lattice as pl
from ledgerflow.llm import token_files as tf
from ledgerflow.llm import wrapper
from ledgerflow.llm.catalog import tokenizer_path
from ledgerflow.session import scratch_path

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-consent">We use cookies</div>
<main><article><h1>Title {n}</h1><p>First &amp; <b>bold</b>{n}<br>line<p>Second &eacute; {n}<table><tr><td>a{n}<td>b</table>
<p>Follow us everywhere</p><aside>see also</aside><form><p>mail</p></form></article><section id="comments"><p>nice!</p></section></main>
<div class="sidebar-right"><p>ads</p></div><footer>&copy; me</footer></body></html>"""


def test_rules_decode_and_leave_out():
    want = "Title 1 First & bold1 line Second é 1 a1 b Follow us everywhere"
    assert wrapper.main_text(PAGE.format(n=1)) == want
    cut = PAGE.format(n=1)
    for k in range(0, len(cut), 7):  # a page cut off anywhere neither crashes nor gains text
        assert wrapper.main_text(cut[:k]).split() == [] or set(wrapper.main_text(cut[:k]).split()) - set(want.split()) <= set(cut[:k].split("<")[-1].split()) | {w for w in want.split()} | set(wrapper.main_text(cut[:k]).split()[-1:])


@pytest.mark.parametrize("html,want", [("", ""), (None, ""), ("plain", "plain"), ("<p>a<p>b", "a b"), ("x < y", "x < y"), ("<!-- open", ""), ("<div " * 3000 + "t", ""), ("<div>" * 3000 + "t", "t"), ("<p>&nbsp;&amp;amp</p>", "&amp"), ("<article><p>in</article><p>out", "in"), ("<script>x", ""), ("a<b>b</b>c", "abc"), ("<div class='page with-sidebar'><article><p>in</p></article><div class=sidebar>s</div><div class=comments><article>c</article></div></div>", "in")])
def test_odd_pages(html, want):
    assert wrapper.main_text(html or "") == want


def brute_match(a, b):
    """Largest match of two trees by trying all order-keeping pairings."""
    if a[0] != b[0]:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), brute_match(x[0], y[0]) + best(x[1:], y[1:]) if x[0][0] == y[0][0] else 0)

    return 1 + best(a[2], b[2])


def test_simple_tree_matching_against_brute_force():
    rng = random.Random(4)

    def grow(depth):
        return "".join(rng.choice("abc") + (f"({grow(depth - 1)})" if depth and rng.random() < 0.6 else "") + "," for _ in range(rng.randrange(1, 4)))

    for _ in range(60):
        a, b = wrapper.tree_of(grow(2)), wrapper.tree_of(grow(2))
        size, pairs = wrapper.simple_tree_matching(a, b)
        assert size == brute_match(a, b) == len(pairs)


def test_constant_slots_become_template(spark):
    rows = [(i, f"https://Site.example:80/p{i}", PAGE.format(n=i)) for i in range(12)]
    rows += [(100 + i, "https://site.example/copy", PAGE.format(n=0)) for i in range(40)]  # copies of one page make nothing template
    rows += [(200, "https://small.example/", PAGE.format(n=3)), (201, None, PAGE.format(n=3)), (202, "nonsense", None), (None, "https://site.example/", ""), (203, "https://site.example/q", "<p>x</p>" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "'h' as host", "1 as slot")
    got = {r["page_id"]: r for r in wrapper.extract(pages).collect()}
    assert len(got) == len(rows)
    for i in range(12):
        assert got[i]["text"] == f"Title {i} First & bold{i} line Second é {i} a{i}" and got[i]["n_chars"] == len(got[i]["text"])
    assert got[105]["text"] == got[0]["text"]
    assert got[200]["text"].endswith("a3 b Follow us everywhere") and got[201]["text"] == got[200]["text"]
    assert got[202]["text"] == got[None]["text"] == "" and got[203]["n_chars"] == 39_999
    assert wrapper.extract(pages.filter("false")).count() == 0


TEXTS = ["Hello world, it's 12 o'clock.", "", None, "日本語 Ünïcödé ß", "Hello<|endoftext|> again", "a" * 5000, "the the THE The. the, \t\x0b\x85 x\xa0y", " lead and trail ", "word " * 30_000]


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_planes_round_trip(unit):
    rng = np.random.RandomState(0)
    for n in (1, 7, 8, 1000):
        ids = rng.randint(0, 2**32, n, dtype=np.uint64).astype("<u4")
        planes = tf.to_planes(ids, unit)
        assert len(planes) == {"byte": 4, "bit": 32}[unit] and (tf.from_planes(planes, n) == ids).all()


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_token_files_against_the_library(spark, make_docs, unit):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = [(i * 3 % 17, t) for i, t in enumerate(TEXTS)] + [(50, "twice"), (51, "same"), (51, "same"), (None, "null id")]
    path = scratch_path(spark, "token-test")
    tf.write_ids(make_docs(rows), path, tokenizer_path("word_bpe_49k.json"), block_ids=1000, unit=unit)
    got = tf.id_digests(spark, path).orderBy("start").collect()
    start = 0
    for r, (doc_id, text) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0])), strict=True):
        ids = np.asarray(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    index = spark.read.parquet(f"{path}/index")
    assert index.agg(F.sum("n_ids")).first()[0] == start and index.filter("n_ids > 1000").count() == 0


def test_token_files_empty(spark, make_docs):
    path = scratch_path(spark, "token-test")
    tf.write_ids(make_docs([]), path, tokenizer_path("word_bpe_49k.json"))
    assert tf.id_digests(spark, path).count() == 0


PIECE_TEXTS = TEXTS + ["def f(x):\r\n    return x;\r\n", "😀 emoji 😀😀", "▁ sign ▁▁x", "\n\n \n", "x" * 200 + "é" * 200, "https://a.b/c?d=e&f=g" * 30, " " * 300 + "deep", "naïve café déjà-vu. ...,,,;;;"]


def test_pieces_against_the_library(make_docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    pieces = pl.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    assert pieces.bpe
    rows = [*enumerate(PIECE_TEXTS), (3, PIECE_TEXTS[3]), (None, "no id")]
    encoded = pl.encode(make_docs(rows), pieces)
    got = encoded.collect()
    key = lambda i, ids: (str(i), list(ids))
    assert sorted(key(r["doc_id"], r["ids"]) for r in got) == sorted(key(i, sp.encode(t or "")) for i, t in rows)
    assert all(r["n_ids"] == len(r["ids"]) for r in got)
    back = {r["doc_id"]: r["text"] for r in pl.decode(encoded, pieces).collect()}
    for i, t in rows:
        # a text that holds the blank sign itself does not come back
        assert (back[i] == (t or "")) == ("▁" not in (t or ""))
    digests = {r["doc_id"]: r["decoded_sha256"] for r in pl.encode(make_docs(rows), pieces, decoded=True).collect()}
    assert digests == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in back.items()}
    assert pl.encode(make_docs([]), pieces).count() == 0


def test_decoded_batches_agree_with_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    pieces = pl.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    texts = ["", " ", "a", " two  blanks ", "日本語 ☃ é", "\u0000\u0001", "x" * 5000, "emoji 😀 then words", "tab\tline\n"]
    ids = [sp.encode(t) for t in texts]
    batch = pa.array([None, *ids, None], pa.list_(pa.int32()))
    assert pl.decode_batch(batch, pieces) == [None, *texts, None] == [None, *(sp.decode(i) for i in ids), None]
    assert pl.decode_batch(batch.slice(3, 5), pieces) == texts[2:7]
    assert pl.decode_batch(batch.slice(0, 0), pieces) == []


def test_long_units_merge_as_the_library_does():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    pieces = pl.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    rng = random.Random(9)
    for _ in range(200):
        word = "".join(rng.choice("abcdeinrst") for _ in range(rng.randrange(1, 120)))
        assert pl.merge_long(pl.BLANK + word, pieces) == sp.encode(word)


def test_viterbi_fold_against_brute_force(spark):
    rng = random.Random(6)
    names = [*"abcd", "ab", "bc", "abc", "cd", "da", "dab"]
    pieces = pl.Pieces(names, [round(-rng.uniform(2, 7), 2) for _ in names], [True] * len(names), {}, 0, False)
    units = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 10))) for _ in range(200)})

    def best(u):
        score = [0.0] + [-1e9] * len(u)
        for e in range(1, len(u) + 1):
            score[e] = max(score[s] + pieces.score[pieces.ids[u[s:e]]] for s in range(max(0, e - 3), e) if u[s:e] in pieces.ids)
        return score[-1]

    frame = spark.createDataFrame([(u, [1]) for u in units], "unit string, at array<int>")
    got = pl.fold_viterbi(pl.lattice(frame, pl.piece_table(spark, pieces), pieces.longest)).collect()
    assert len(got) == len(units)
    for r in got:
        assert "".join(names[i] for i in r["ids"]) == r["unit"] and abs(sum(pieces.score[i] for i in r["ids"]) - best(r["unit"])) < 1e-9


def test_long_units_of_a_unigram_model_take_the_best_path(make_docs):
    scores = {pl.BLANK: -1.0, "a": -5.0, "b": -5.0, "c": -5.0, "d": -1.0, "ab": -2.0, "cd": -2.0, "abc": -2.5, "bc": -9.0, "da": -9.0, "dab": -9.25}
    pieces = pl.Pieces(list(scores), list(scores.values()), [True] * len(scores), {}, 0, False)
    name = pieces.text.index
    docs = make_docs([(n, "abcd" * n) for n in (10, 15, 16, 40, 500)])  # 40 to 2,000 characters; merging by rank gives ab, cd
    got = {r["doc_id"]: r["ids"] for r in pl.encode(docs, pieces).collect()}
    assert got == {n: [name(pl.BLANK)] + [name("abc"), name("d")] * n for n in got} and len(got) == 5
    rng = random.Random(8)
    for _ in range(20):
        unit = "".join(rng.choice("abcd") for _ in range(rng.randrange(61, 200)))
        best = [0.0]
        for e in range(1, len(unit) + 1):
            best.append(max(best[s] + scores[unit[s:e]] for s in range(max(0, e - 3), e) if unit[s:e] in scores))
        ids = pl.viterbi_long(unit, pieces)
        assert "".join(pieces.text[i] for i in ids) == unit and abs(sum(pieces.score[i] for i in ids) - best[-1]) < 1e-9
    assert pl.viterbi_long("ab?c", pieces) == [name("ab"), 0, name("c")]


def test_all_of_main_or_all_articles_are_the_text():
    from ledgerflow.llm.wrapper import main_text

    assert main_text("<nav>menu</nav><main><h1>Title</h1><p>Intro</p><article>A</article><article>B</article></main>") == "Title Intro A B"
    assert main_text("<p>side</p><article>A</article><p>between</p><article>B<aside>x</aside></article>") == "A B"


def test_depth_does_not_bring_back_what_is_left_out():
    from ledgerflow.llm.wrapper import main_text

    for depth in (10, 210, 1000):
        assert main_text("<div>" * depth + "<nav><p>menu</p></nav>text body") == "text body"
        assert main_text("<p>side</p>" + "<div>" * depth + "<article>deep <nav>m</nav>text</article>") == "deep text"


@pytest.mark.parametrize("inside", [False, True])
def test_texts_are_cut_by_columns_as_one_at_a_time(inside):
    """Runs of blanks, blanks at the ends, blank signs, signs of no piece, nulls; a model with and one without blanks inside pieces."""
    names = ["a", "b", "é", "▁", "▁▁", "▁a", "ab", "aé", "東", *(["a▁b"] if inside else [])]
    pieces = pl.Pieces(names, [-float(i) for i in range(len(names))], [True] * len(names), {}, 0, True)
    cut, pairs, rng = pl.Cutter(pieces), pieces.pairs(), random.Random(5)
    texts = [None, "", " ", "  ", " a", "a ", "a  b", "▁", "a▁ b", "\n", "x🙂 東"] + ["".join(rng.choices(" ▁ab\né東🙂.", k=rng.randrange(25))) for _ in range(500)]
    words = cut.words(pa.array(texts, pa.string()))
    assert words[1:].to_pylist() == cut.words(pa.array(texts[1:], pa.string())).to_pylist()
    units, per_word = cut.units(words.flatten())
    ends = np.cumsum([0, *per_word])[np.asarray(words.offsets)]
    for k, text in enumerate(map(pl.normalised, (t or "" for t in texts))):
        want = []
        for i, c in enumerate(text):
            if i and text[i - 1 : i + 1] in pairs:
                want[-1] += c
            else:
                want.append(c)
        assert units[ends[k] : ends[k + 1]].to_pylist() == want


def test_a_slice_of_texts_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(pl, "SLICE", 3)
    monkeypatch.setattr(pl, "SLICE_BYTES", 10)
    assert list(pl._slices(pa.array(["a"] * 4 + ["b" * 50, None, "c" * 9, "d" * 9]))) == [(0, 3), (3, 2), (5, 3)]
    assert list(pl._slices(pa.array([], pa.string()))) == []


def test_words_are_cut_in_stretches(monkeypatch):
    pieces = pl.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    cut = pl.Cutter(pieces)
    many = pa.array([f"wörd-{i * 7919 % 1_000_003:07d}x" for i in range(600_000)])
    tracemalloc.start()
    units, per_word = cut.units(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * many.nbytes  # at once it takes more than 40 times their bytes
    words = pa.array(["", "a", "é-é", "", "東京", "x" * 50, "a", "don't", ""])
    whole, counts = cut.units(words)
    monkeypatch.setattr(pl, "CUT_WORDS", 3)
    monkeypatch.setattr(pl, "CUT_BYTES", 10)
    some, some_counts = cut.units(words)
    assert some.to_pylist() == whole.to_pylist() and some.dictionary.to_pylist() == whole.dictionary.to_pylist() and list(some_counts) == list(counts)
    none, counts = cut.units(words[:0])
    assert len(none) == len(none.dictionary) == len(counts) == 0


def test_equal_hashes_of_units_and_pieces_change_nothing(make_docs, monkeypatch):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    pieces = pl.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    hashed = F.xxhash64
    monkeypatch.setattr(pl.F, "xxhash64", lambda c: F.pmod(hashed(c), F.lit(5000)))
    texts = ["the theme of another anthem", "naïve café déjà-vu", "", None, "unbelievable interoperability", "x" * 70]
    got = {r["doc_id"]: r["ids"] for r in pl.encode(make_docs(enumerate(texts)), pieces).collect()}
    assert got == {i: sp.encode(t or "") for i, t in enumerate(texts)}


def test_edges_are_grouped_by_two_numbers_and_not_shuffled(spark):
    pieces = pl.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    words = spark.createDataFrame([("▁theme", 1), ("▁other", 2)], "unit string, place long")
    plan = pl.encode_units(words, pieces)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # of units
    assert re.search(r"keys=\[h#\d+L, number#\d+L\]", plan) and re.search(r"BroadcastHashJoin \[key#\d+L\]", plan)
