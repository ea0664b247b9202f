"""Language identification with interpolated Kneser-Ney character models.

Words are lower-cased runs of letters, padded with blanks. Counts of
character 4-grams per language come from all training texts; Spark sums them
and derives the Kneser-Ney tables (absolute discount, continuation counts,
interpolation down to a uniform model). The tables are kept whole and in
shared files. What the texts need of them is looked up by joins: the distinct
n-grams of blocks of texts, each order joined to the one below, and the
probabilities back to the blocks, which hold them as sorted arrays of 64-bit
codes. A block is a stretch of one input partition, so its n-grams come from
one task and only once. Only a row per language passes the driver. A text goes to the language with the lowest cross-entropy per
character. It is rejected
where its words, each under the language that fits it best, still lie far
above what that language's own training text has; so a text that mixes known
languages stays.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerflow.llm.common import give_back, giving_back, id_bucket, join_by_key, shuffle_width, stage

ORDER = 4
#: A text is rejected above its language's mean cross-entropy by this many standard errors and nats.
REJECT_ERRORS = 8.0
REJECT_NATS = 1.0
#: Characters that count as independent evidence for the score.
EVIDENCE = 40
#: Words a worker remembers.
CACHED_WORDS = 400_000
#: Characters of the texts that a block should hold.
BLOCK_CHARS = 16_000_000
UNKNOWN = "und"

#: Letters, for texts without a character that may be a mark or a number of another kind; ``_WIDE`` finds those.
_LETTERS = re.compile("[^\\W\\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+")
_WIDE = re.compile("[\u0300-\u1fff\u2070-\U0010ffff]")
_ANY_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased; a letter's marks, as vowel signs, belong to the run, numbers of no kind do."""
    text = text.lower()
    return (_ANY_LETTERS if _WIDE.search(text) else _LETTERS).findall(text)


def gram_counts(train: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text): grams of ``order`` characters, words padded with blanks."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        pad = " " * (order - 1)

        def flush() -> pa.RecordBatch:
            langs, grams, counts = [], [], []
            for lang, seen in words.items():
                found: dict[str, int] = {}
                for w, n in seen.items():
                    w = pad + w + " "
                    for i in range(len(w) - order + 1):
                        g = w[i : i + order]
                        found[g] = found.get(g, 0) + n
                langs += [lang] * len(found)
                grams += found.keys()
                counts += found.values()
            words.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())], names=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words.setdefault(lang, Counter()).update(words_of(text.as_py() or ""))
                if len(words[lang]) > CACHED_WORDS:
                    yield flush()
        yield flush()

    return train.select("lang", "text").mapInArrow(run, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, k, gram, n, own, bow): per n-gram of each order k its discounted share ``own`` and its context's weight ``bow`` for the order below.

    The orders are written one by one: a plan over all of them at once takes
    the driver much memory.
    """
    by_k = {order: counts.select("lang", "gram", F.col("n").cast("double").alias("n"))}
    for k in range(order - 1, 0, -1):
        by_k[k] = stage(by_k[k + 1].groupBy("lang", F.expr(f"substring(gram, 2, {k})").alias("gram")).agg(F.count("*").cast("double").alias("n")), "lang-lower-grams")
    out = None
    for k, grams in by_k.items():
        ones = F.sum(F.when(F.col("n") == 1, 1.0).otherwise(0.0))
        twos = F.sum(F.when(F.col("n") == 2, 1.0).otherwise(0.0))
        # the usual estimate; a model too small to have it gets 0.5
        discount = grams.groupBy("lang").agg(F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(F.lit(0.5)).alias("d"))
        context = Window.partitionBy("lang", "context")
        rows = (
            grams.join(F.broadcast(discount), "lang")  # one row per language
            .withColumn("context", F.expr(f"substring(gram, 1, {k - 1})"))
            .withColumn("total", F.sum("n").over(context))
            .withColumn("kinds", F.count("*").over(context))
            .select("lang", F.lit(k).alias("k"), "gram", "n", ((F.col("n") - F.col("d")) / F.col("total")).alias("own"), (F.col("d") * F.col("kinds") / F.col("total")).alias("bow"))
        )
        rows = stage(rows, "lang-order")
        out = rows if out is None else out.unionByName(rows)
    return out


@dataclass
class Models:
    """All languages' models: the rows of ``kneser_ney`` in shared files; ``uniform``, ``mean`` and ``spread`` (of the training text's cost a character) by language."""

    langs: list[str]
    order: int
    tables: DataFrame
    uniform: np.ndarray
    mean: np.ndarray
    spread: np.ndarray


def _by_language(langs: list[str], value: str, default: float) -> Column:
    """Array over the languages from rows of (lang, value)."""
    return F.array(*(F.coalesce(F.max(F.when(F.col("lang") == lang, F.col(value))), F.lit(default)) for lang in langs))


def _language_array(values: np.ndarray) -> Column:
    return F.array(*(F.lit(float(x)) for x in values))


def probabilities(models: Models, grams: DataFrame) -> DataFrame:
    """(gram, p) for the distinct values of the column gram, strings of ``order`` characters: the last one's probability after the others, by language.

    A gram that a language never had weighs nothing of its own there, and a
    context it never had passes the lower order on whole. As in
    ``kneser_ney``, the orders below the last are written one by one.
    """
    wanted = {models.order: grams.select("gram").distinct()}
    for k in range(models.order - 1, 0, -1):
        wanted[k] = stage(wanted[k + 1].select(F.expr(f"substring(gram, 2, {k})").alias("gram")).distinct(), "lang-wanted")
    lower = None
    for k in range(1, models.order + 1):
        rows = models.tables.filter(F.col("k") == k)
        own = rows.groupBy("gram").agg(_by_language(models.langs, "own", 0.0).alias("own"))
        bow = rows.groupBy(F.expr(f"substring(gram, 1, {k - 1})").alias("context")).agg(_by_language(models.langs, "bow", 1.0).alias("bow"))
        asked = wanted[k].select("gram", F.expr(f"substring(gram, 1, {k - 1})").alias("context"), F.expr(f"substring(gram, 2, {k - 1})").alias("rest"))
        asked = asked.join(own, "gram", "left")
        if lower is None:  # one context, the empty one
            asked = asked.join(F.broadcast(bow), "context", "left").withColumn("below", _language_array(models.uniform))
        else:
            asked = asked.join(bow, "context", "left").join(lower.toDF("rest", "below"), "rest")
        p = [F.coalesce(F.col("own")[i], F.lit(0.0)) + F.coalesce(F.col("bow")[i], F.lit(1.0)) * F.col("below")[i] for i in range(len(models.langs))]
        lower = asked.select("gram", F.array(*(F.greatest(x, F.lit(1e-30)) for x in p)).alias("p"))
        if k < models.order:
            lower = stage(lower, "lang-below")
    return lower


def train(rows: DataFrame, order: int = ORDER) -> Models:
    """Models from all rows of (lang, text); rows with a null lang or text teach nothing."""
    counts = stage(gram_counts(rows.filter("lang is not null and text is not null"), order), "lang-grams")
    tables = stage(kneser_ney(counts, order), "lang-models")
    kinds = {r["lang"]: r["kinds"] for r in tables.filter("k = 1").groupBy("lang").agg(F.count("*").alias("kinds")).collect()}  # one row per language
    langs = sorted(kinds)
    m = Models(langs, order, tables, np.array([1.0 / (kinds[x] + 1.0) for x in langs]), np.zeros(len(langs)), np.zeros(len(langs)))
    if langs:
        # a gram has at most a row per language
        seen = counts.join(probabilities(m, counts), "gram")
        cost = -F.log(F.element_at("p", F.array_position(F.array(*map(F.lit, langs)), F.col("lang")).cast("int")))
        n = F.col("n")
        total = {r["lang"]: r for r in seen.groupBy("lang").agg(F.sum(n).alias("n"), F.sum(n * cost).alias("one"), F.sum(n * cost * cost).alias("two")).collect()}
        m.mean = np.array([total[x]["one"] / total[x]["n"] for x in langs])
        m.spread = np.sqrt(np.maximum(np.array([total[x]["two"] / total[x]["n"] for x in langs]) - m.mean**2, 0.0))
    return m


def _hash(chars: np.ndarray, k: int) -> np.ndarray:
    """64-bit codes of rows of k code points."""
    with np.errstate(over="ignore"):
        h = np.full(len(chars), k, np.uint64)
        for i in range(k):
            h = (h ^ chars[:, i].astype(np.uint64)) * _MULTIPLIERS[i]
            h ^= h >> np.uint64(29)
    return h


def _windows(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the padded words' n-grams in order, the first of each word, and the words' lengths."""
    pad = " " * (order - 1)
    points = np.frombuffer((pad + f" {pad}".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + order)])[:-1]
    first = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    rows = np.repeat(starts - first, lengths + 1) + np.arange(int((lengths + 1).sum()))
    return np.lib.stride_tricks.sliding_window_view(points, order)[rows], first, lengths


def grams_of(words: list[str], order: int = ORDER) -> list[str]:
    """Distinct n-grams of the padded words."""
    out: dict[int, str] = {}
    for a in range(0, len(words), 20_000):
        grams, _, _ = _windows(words[a : a + 20_000], order)
        codes, at = np.unique(_hash(grams, order), return_index=True)
        text = np.ascontiguousarray(grams[at]).tobytes().decode("utf-32-le", "surrogatepass")
        out.update(zip(codes.tolist(), (text[i : i + order] for i in range(0, len(text), order)), strict=True))
    return list(out.values())


class Scorer:
    """Sums of log probabilities per text; a word seen before is looked up."""

    def __init__(self, models: Models, grams: list[str] | None = None, p: np.ndarray | None = None):
        self.m = models
        self.codes = None
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, len(models.langs) + 2))
        if grams is not None:
            self._learn(grams, p)

    def _learn(self, grams: list[str], p: np.ndarray) -> None:
        codes = _hash(np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, self.m.order), self.m.order)
        sort = np.argsort(codes)
        self.codes, self.logp = codes[sort], np.log(p[sort])

    def _words(self, words: list[str]) -> np.ndarray:
        """Per word its log probability by language, the best of these, then its characters (with the end)."""
        order = self.m.order
        if self.codes is None:  # a few words, on the driver
            asked = self.m.tables.sparkSession.createDataFrame([(g,) for g in grams_of(words, order)], "gram string")
            got = probabilities(self.m, asked).collect()
            self._learn([r["gram"] for r in got], np.array([r["p"] for r in got]))
        out = np.zeros((len(words), len(self.m.langs) + 2))
        for a in range(0, len(words), 20_000):
            grams, first, lengths = _windows(words[a : a + 20_000], order)
            wanted = _hash(grams, order)
            at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
            if (self.codes[at] != wanted).any():
                raise RuntimeError("an n-gram of the texts was not looked up")
            sums = np.add.reduceat(self.logp[at], first, axis=0)
            out[a : a + len(lengths), :-2] = sums
            out[a : a + len(lengths), -2] = sums.max(axis=1)
            out[a : a + len(lengths), -1] = lengths + 1
        return out

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """Per text: log probability by language, with the best language word by word, then the number of characters (0: no letter)."""
        split = [words_of(t) if t else [] for t in texts]
        new = list({w for words in split for w in words if w not in self.place})
        if len(self.place) + len(new) > CACHED_WORDS:
            new = list({w for words in split for w in words})
            self.place, self.table = {}, self.table[:0]
        if new:
            base = len(self.place)
            self.place.update((w, base + i) for i, w in enumerate(new))
            if base + len(new) > len(self.table):
                grown = np.zeros((max(2 * (base + len(new)), 1024), self.table.shape[1]))
                grown[:base] = self.table[:base]
                self.table = grown
            self.table[base : base + len(new)] = self._words(new)
        get = self.place.__getitem__
        out = np.zeros((len(texts), len(self.m.langs) + 2))
        for i, words in enumerate(split):
            if words:
                out[i] = self.table[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0)
        return out


def judge(models: Models, sums: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, rejected) from ``Scorer.texts``."""
    n = sums[:, -1]
    if not models.langs:
        return [UNKNOWN] * len(sums), np.zeros(len(sums)), np.ones(len(sums), bool)
    mean = sums[:, :-2] / np.maximum(n, 1)[:, None]
    best = mean.argmax(axis=1)  # ties: the first language by code point
    top = mean[np.arange(len(mean)), best]
    score = 1.0 / np.exp((mean - top[:, None]) * np.minimum(n, EVIDENCE)[:, None]).sum(axis=1)
    limit = models.mean[best] + REJECT_ERRORS * models.spread[best] / np.sqrt(np.maximum(n, 1)) + REJECT_NATS
    empty = n == 0
    return (
        [UNKNOWN if e else models.langs[b] for e, b in zip(empty, best, strict=True)],
        np.where(empty, 0.0, score),
        empty | (-sums[:, -2] / np.maximum(n, 1) > limit),
    )


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """``docs`` with lang_pred, score and rejected appended (replacing columns of these names).

    Needs the column text only, nothing else enters a prediction. A null
    text, or one without a letter, gets ``und``, score 0 and is rejected; so
    does every text if nothing was learnt. Texts are read whole. Ties go to
    the first language by code point; equal texts get equal results.
    """
    base = docs.drop("lang_pred", "score", "rejected")
    if not models.langs:
        return base.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "rejected": F.lit(True)})
    chars = base.agg(F.sum(F.length("text"))).first()[0] or 0
    limit = min(BLOCK_CHARS, chars // shuffle_width(docs.sparkSession) + 1)
    in_block = stage(block_grams(base.select("text"), limit, models.order), "lang-block-grams")
    sizes = stage(in_block.groupBy("gram").agg(F.count("*").alias("size")), "lang-sizes")
    p = stage(probabilities(models, sizes).join(sizes, "gram"), "lang-probabilities")
    given = join_by_key(in_block, in_block.count(), p, ["gram"], "size").select("block", "gram", "p").groupBy("block")
    light = Models(models.langs, models.order, None, models.uniform, models.mean, models.spread)
    added = StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def judged(rows: pa.Table, grams: pa.Table) -> pa.Table:
        p = np.asarray(pc.list_flatten(grams.column("p")), np.float64).reshape(-1, len(light.langs))
        scorer = Scorer(light, grams.column("gram").to_pylist(), p)
        lang, score, rejected = [], [], []
        row = rows.column("row").combine_chunks()
        text = row.field("text")
        for a in range(0, rows.num_rows, 256):
            for out, part in zip((lang, score, rejected), judge(light, scorer.texts(text.slice(a, 256).to_pylist())), strict=True):
                out.extend(part)
        cols = [*row.flatten(), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
        return pa.Table.from_arrays(cols, names=[*(f.name for f in row.type), "lang_pred", "score", "rejected"])

    def run(rows: pa.Table, grams: pa.Table) -> pa.Table:
        out = judged(rows, grams)
        give_back()
        return out

    rows = numbered(base.select(F.struct("*").alias("row")), limit).groupBy("block")
    return rows.cogroup(given).applyInArrow(run, StructType([*base.schema.fields, *added.fields]))


class _Stretches:
    """Numbers a partition's rows: blocks of about ``limit`` characters, one after the other."""

    def __init__(self, limit: int):
        self.limit, self.block, self.held = limit, TaskContext.get().partitionId() << 32, 0

    def number(self, texts: pa.Array) -> list[int]:
        out = []
        for n in pc.fill_null(pc.utf8_length(texts), 0).to_pylist():
            if self.held >= self.limit:
                self.block, self.held = self.block + 1, 0
            self.held += n + 1
            out.append(self.block)
        return out


def numbered(rows: DataFrame, limit: int) -> DataFrame:
    """(block, row) from the structs (row), whose field text counts. The same input gives the numbers of ``block_grams``.

    Were a partition's order another one, the scorer would miss n-grams and
    fail; it never scores a text by part of them.
    """

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Stretches(limit)
        for batch in batches:
            number = blocks.number(batch.column(0).field("text"))
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), batch.column(0)], names=["block", "row"])

    return rows.mapInArrow(run, StructType([StructField("block", LongType()), rows.schema["row"]]))


def block_grams(texts: DataFrame, limit: int, order: int = ORDER) -> DataFrame:
    """Distinct (block, gram) of the rows (text)."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, now = _Stretches(limit), None
        words: set[str] = set()
        found: set[str] = set()

        def flush() -> pa.RecordBatch:
            grams = list(found.union(grams_of(list(words), order)) if words else found)
            words.clear()
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array([now] * len(grams), pa.int64()), pa.array(grams, pa.string())], names=["block", "gram"])

        for batch in batches:
            for block, text in zip(blocks.number(batch.column(0)), batch.column(0), strict=True):
                if block != now:
                    if now is not None:
                        yield flush()
                    now = block
                words.update(words_of(text.as_py() or ""))
                if len(words) > CACHED_WORDS:
                    found.update(grams_of(list(words), order))
                    words.clear()
        if now is not None:
            yield flush()

    return texts.mapInArrow(run, "block bigint, gram string")


def held_out(col: str = "doc_id"):
    """Rows that teach nothing: crc32 of the id as text, mod 3, is 1. A null id is not held out."""
    return F.coalesce(id_bucket(col, 3) == 1, F.lit(False))


def train_on(docs: DataFrame) -> Models:
    """Models from the rows of ``docs`` that are not held out."""
    return train(docs.filter(~held_out()).select("lang", "text"))
