"""Ranked lexical search by a dual tree: items against documents, whole batches at a time.

Scores are sums over an item's terms of (term weight) * (impact of the term in
the document), all in whole numbers. Both sides have a hierarchy whose nodes
hold coordinate maxima: an item node holds the terms of any of its items, a
document node the largest impact of each term in any of its documents. The
product of the two is an upper bound for every pair below them; where it stays
under the weakest k-th score that the node's items already have, all those
pairs go at once. What remains is scored exactly, so nothing is lost.

On Spark: one pass over the texts leaves a narrow row per document, the terms
that items ask for with their counts. The corpus counts come from those rows.
Documents are then range-partitioned by their strongest terms, so that a block
(a subtree of the document hierarchy) holds like with like, and written as
blocks. A sixteenth of the blocks is searched first; the k-th scores found
there are the thresholds the other blocks start with.

Items come in batches of bounded text, each searched like that.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import shuffle_width, stage
from ledgerflow.session import remove_path, scratch_path

TOP = 50
#: Text of the items that one batch holds in memory, about.
ITEM_BYTES = 4 << 20
#: Documents in a block, in an inner node and in a leaf of it.
BLOCK, INNER, LEAF = 2048, 128, 16
#: Items in the nodes of the item hierarchy's upper levels.
GROUPS = (32, 8)
#: One block in so many is searched before the others.
FIRST = 16

#: Bytes that end a term (ASCII other than letters and digits) become blanks, A-Z become small; bytes of longer characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_VECTOR = "doc_id long, n long, terms binary, counts binary"
_KEYED = "doc_id long, seq long, first long, second long, terms binary, impacts binary"
_BLOCKS = "ids binary, known binary, starts binary, terms binary, impacts binary, wave int"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Items:
    """A batch of items: its vocabulary, the weights of its terms and the item hierarchy.

    ``levels`` goes from groups of items to single items; a level is a list of
    (terms, start, end): the union of the terms of items start to end.
    """

    def __init__(self, rows: list[tuple[int, str | None]]):
        words = [(row, set(terms_of(text))) for row, text in rows]
        words = [(row, w) for row, w in words if w]
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(w for _, w in words)) if words else ()))}
        self.items = [(row, np.array(sorted(self.vocabulary[t] for t in w), "int64")) for row, w in words]
        self.weights = np.zeros(len(self.vocabulary), "int64")

    def weigh(self, n_docs: int, df: dict[int, int]) -> None:
        """Set the weights and arrange the items so that neighbours share heavy terms."""
        for i in range(len(self.weights)):
            self.weights[i] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1)))
        self.items = self._arranged(self.items)
        self.rows = np.array([r for r, _ in self.items], "int64")
        self.levels = [self._nodes(g) for g in (*GROUPS, 1)]

    def _arranged(self, items: list) -> list:
        if len(items) <= GROUPS[-1]:
            return items
        mass = [self.weights[t].sum() for _, t in items]
        one = items[int(np.argmax(mass))][1]
        shared = np.array([self.weights[t[np.isin(t, one)]].sum() for _, t in items])
        other = items[int(np.argmin(shared))][1]
        lean = shared - np.array([self.weights[t[np.isin(t, other)]].sum() for _, t in items])
        order = np.argsort(-lean, kind="stable")
        half = len(items) // 2
        return self._arranged([items[i] for i in order[:half]]) + self._arranged([items[i] for i in order[half:]])

    def _nodes(self, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node of each entry, its term, first item of each node)."""
        starts = np.arange(0, len(self.items), group)
        unions = [np.unique(np.concatenate([t for _, t in self.items[s : s + group]])) for s in starts]
        return np.repeat(np.arange(len(starts)), [len(u) for u in unions]), np.concatenate(unions), starts


def vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: its length in terms, and how often it holds each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                if words:
                    counts = Counter(words)
                    held = sorted((known[t], counts[t]) for t in counts.keys() & known.keys())
                    pairs = np.array(held, "int64").reshape(-1, 2)
                    out.append((doc_id, len(words), pairs[:, 0].astype("uint32").tobytes(), pairs[:, 1].astype("uint32").tobytes()))
            yield _batch(out, [pa.int64(), pa.int64(), pa.binary(), pa.binary()], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _VECTOR)


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def document_counts(found: DataFrame) -> dict[int, int]:
    """df of each vocabulary term; one row per term leaves each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for batch in batches:
            joined = b"".join(batch.column(0).to_pylist())
            terms, n = np.unique(np.frombuffer(joined, "uint32"), return_counts=True)
            df.update(dict(zip(terms.tolist(), n.tolist())))
        yield _batch(sorted(df.items()), [pa.int64(), pa.int64()], ["term", "df"])

    rows = found.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in rows.collect()}  # at most the vocabulary


def lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents of n terms: 50 and the share of the mean length, in whole numbers of any size."""
    if len(n) and 50 * int(n.max()) * n_docs < 1 << 62:
        return 50 + (50 * n * n_docs) // n_terms
    return np.array([50 + (50 * int(x) * n_docs) // n_terms for x in n], "int64")


def keyed(found: DataFrame, items, n_docs: int, n_terms: int) -> DataFrame:
    """Documents with a scoring term: impacts, and the two terms that weigh most in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = items.value.weights
        for batch in batches:
            out = []
            m = lengths(batch.column("n").to_numpy(), n_docs, n_terms)
            for i, (doc_id, seq, terms, counts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "seq", "terms", "counts")))):
                t, tf = np.frombuffer(terms, "uint32").astype("int64"), np.frombuffer(counts, "uint32").astype("int64")
                impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[i])
                keep = (impact > 0) & (weights[t] > 0)
                t, impact = t[keep], impact[keep]
                if len(t):
                    part = weights[t] * impact
                    first = int(part.argmax())
                    part[first] = -1
                    second = int(part.argmax())
                    out.append((doc_id, seq, int(t[first]), int(t[second]), t.astype("uint32").tobytes(), impact.astype("int32").tobytes()))
            yield _batch(out, [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()], ["doc_id", "seq", "first", "second", "terms", "impacts"])

    return found.mapInArrow(run, _KEYED)


def blocks(rows: DataFrame) -> DataFrame:
    """The documents, in the order they come, as blocks of up to BLOCK; wave 0 is searched first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids = np.array([r[0] or 0 for r in held], "int64")
            known = np.array([r[0] is not None for r in held], "uint8")
            starts = np.concatenate([[0], np.cumsum([len(r[2]) // 4 for r in held])]).astype("int64")
            wave = 0 if (held[0][1] * 2654435761 >> 16) % FIRST == 0 else 1
            row = (ids.tobytes(), known.tobytes(), starts.tobytes(), b"".join(r[2] for r in held), b"".join(r[3] for r in held), wave)
            held.clear()
            return _batch([row], [pa.binary()] * 5 + [pa.int32()], ["ids", "known", "starts", "terms", "impacts", "wave"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "seq", "terms", "impacts"))):
                held.append(row)
                if len(held) == BLOCK:
                    yield flush()
        if held:
            yield flush()

    return rows.mapInArrow(run, _BLOCKS)


class Search:
    """The dual-tree search of one task: the items, their thresholds and the best documents so far."""

    def __init__(self, items: Items, thresholds: np.ndarray, top: int):
        self.items, self.top = items, top
        self.weakest = thresholds.astype("float64")
        self.best: list[list[tuple]] = [[] for _ in items.items]
        self.scored = 0
        self.local = np.full(len(items.weights), -1, "int64")

    def _weights(self, level: tuple, wanted: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Weights of the wanted nodes of a level over the given terms (doubles, which hold these whole numbers exactly)."""
        node, term, _ = level
        row = np.full(int(node[-1]) + 1, -1)
        row[wanted] = np.arange(len(wanted))
        self.local[columns] = np.arange(len(columns))
        take = (row[node] >= 0) & (self.local[term] >= 0)
        out = np.zeros((len(wanted), len(columns)))
        out[row[node[take]], self.local[term[take]]] = self.items.weights[term[take]]
        self.local[columns] = -1
        return out

    @staticmethod
    def _maxima(doc: np.ndarray, column: np.ndarray, impact: np.ndarray, size: int, n_docs: int, n_columns: int) -> np.ndarray:
        """Largest impact of every term in each run of ``size`` documents."""
        out = np.zeros((-(-n_docs // size), n_columns))
        np.maximum.at(out, (doc // size, column), impact)
        return out

    def block(self, ids: np.ndarray, known: np.ndarray, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        n = len(ids)
        columns, column = np.unique(terms, return_inverse=True)
        doc = np.repeat(np.arange(n), np.diff(starts))
        leaf = self._maxima(doc, column, impacts, LEAF, n, len(columns))
        inner = np.maximum.reduceat(leaf, np.arange(0, len(leaf), INNER // LEAF), axis=0)
        root = inner.max(axis=0, keepdims=True)
        # pairs still possible, from (groups, root) down to (single items, leaves)
        alive = np.ones((len(self.items.levels[0][2]), 1), bool)
        for depth, (level, maxima) in enumerate(zip(self.items.levels, (root, inner, leaf))):
            if depth:
                above = self.items.levels[depth - 1][2]
                parent = np.searchsorted(above, level[2], side="right") - 1
                wide = np.arange(len(maxima)) // (len(maxima) if depth == 1 else INNER // LEAF)
                alive = alive[parent][:, wide]
            wanted = np.flatnonzero(alive.any(axis=1))
            if not len(wanted):
                return
            bound = np.zeros(alive.shape)
            bound[wanted] = self._weights(level, wanted, columns) @ maxima.T
            alive &= (bound >= np.minimum.reduceat(self.weakest, level[2])[:, None]) & (bound > 0)
        for at in np.argsort(-bound.max(axis=0), kind="stable"):
            wanted = np.flatnonzero(alive[:, at] & (bound[:, at] >= self.weakest))
            if len(wanted):
                self._leaf(int(at), wanted, ids, known, starts, terms, impacts)

    def _leaf(self, at: int, wanted: np.ndarray, ids, known, starts, terms, impacts) -> None:
        """Exact scores of a leaf's documents for the wanted items."""
        lo, hi = at * LEAF, min((at + 1) * LEAF, len(ids))
        a, b = starts[lo], starts[hi]
        columns, column = np.unique(terms[a:b], return_inverse=True)
        table = np.zeros((hi - lo, len(columns)))
        table[np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1])), column] = impacts[a:b]
        scores = self._weights(self.items.levels[-1], wanted, columns) @ table.T
        self.scored += scores.size
        for i, row in zip(wanted, scores):
            good = np.flatnonzero((row >= self.weakest[i]) & (row > 0))
            if len(good):
                best = self.best[i]
                best.extend((-int(row[g]), 0 if known[lo + g] else 1, int(ids[lo + g])) for g in good)
                if len(best) >= self.top:
                    best.sort()
                    del best[self.top :]
                    self.weakest[i] = max(self.weakest[i], -best[-1][0])


def search(found: DataFrame, items, thresholds, top: int) -> DataFrame:
    """(item_row, doc_id, score, scored): each task's best documents of every item, at most ``top``.

    Every task also leaves one row without an item that says how many pairs
    it scored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Search(items.value, thresholds.value, top)
        for batch in batches:
            for row in batch.to_pylist():
                state.block(
                    np.frombuffer(row["ids"], "int64"),
                    np.frombuffer(row["known"], "uint8"),
                    np.frombuffer(row["starts"], "int64"),
                    np.frombuffer(row["terms"], "uint32").astype("int64"),
                    np.frombuffer(row["impacts"], "int32").astype("float64"),
                )
        rows = [(int(items.value.rows[i]), None if none else doc, -minus, None) for i, best in enumerate(state.best) for minus, none, doc in best]
        rows.append((None, None, None, state.scored))
        yield _batch(rows, [pa.int64()] * 4, ["item_row", "doc_id", "score", "scored"])

    return found.mapInArrow(run, "item_row long, doc_id long, score long, scored long")


def best_of(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` best rows of every item, ranked; Spark keeps no more than that of an item in any task before the shuffle."""
    order = Window.partitionBy("item_row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _batch_of_items(spark: SparkSession, docs: DataFrame, rows: list, top: int) -> tuple[DataFrame, tuple[int, int]] | None:
    context = spark.sparkContext
    items = Items(rows)
    if not items.items:
        return None
    vocabulary = context.broadcast(items.vocabulary)  # the terms of one batch
    found = stage(vectors(docs, vocabulary).withColumn("seq", F.monotonically_increasing_id()), "search-vectors")
    n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    vocabulary.destroy()
    if not n_docs:
        return None
    items.weigh(n_docs, document_counts(found))
    del items.vocabulary
    held = context.broadcast(items)
    path = scratch_path(spark, "search-blocks")
    dealt = keyed(found, held, n_docs, n_terms).repartitionByRange(shuffle_width(spark), "first", "second", "seq").sortWithinPartitions("first", "second", "seq")
    blocks(dealt).write.partitionBy("wave").parquet(path)
    every = spark.read.schema(_BLOCKS).parquet(path)
    none = context.broadcast(np.zeros(len(items.items)))
    early = stage(search(every.filter("wave = 0"), held, none, top), "search-first")
    weakest = {r.item_row: r.score for r in best_of(early.filter("item_row is not null"), top).filter(F.col("rank") == top).collect()}  # a number per item
    thresholds = context.broadcast(np.array([float(weakest.get(int(r), 0)) for r in items.rows]))
    late = search(every.filter("wave = 1"), held, thresholds, top)
    both = stage(early.unionByName(late), "search-found")
    best = stage(best_of(both.filter("item_row is not null"), top).select("item_row", "rank", "doc_id", "score"), "search-best")
    scored = both.agg(F.coalesce(F.sum("scored"), F.lit(0))).first()[0]
    for b in (held, none, thresholds):
        b.destroy()
    remove_path(spark, path)
    return best, (scored, n_docs * len(items.items))  # documents without any of the terms are never scored


def rank_with_work(docs: DataFrame, items: DataFrame, top: int = TOP) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The ranking (see ``rank``), and for each batch of items how many (item, document) pairs were scored out of how many."""
    spark = docs.sparkSession
    numbered = stage(items.select(F.monotonically_increasing_id().alias("item_row"), "item_id", "text"), "search-items")
    size = numbered.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    batches = size // ITEM_BYTES + 1
    out, work = None, []
    for i in range(batches):
        mine = numbered.filter(F.pmod(F.xxhash64("item_row"), F.lit(batches)) == i)
        done = _batch_of_items(spark, docs, [tuple(r) for r in mine.select("item_row", "text").collect()], top)
        if done:
            out = done[0] if out is None else out.unionByName(done[0])
            work.append(done[1])
    if out is None:
        out = spark.createDataFrame([], "item_row long, rank int, doc_id long, score long")
    return numbered.select("item_row", "item_id").join(out, "item_row").select("item_id", "rank", "doc_id", "score"), work


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item with a score above 0.

    Needs doc_id and text of ``docs``, item_id and text of ``items``; other
    columns are ignored. Null texts have no terms; documents without a term
    count nowhere, items without one have no rows. Equal scores rank by
    ascending doc_id, a null doc_id last. Every row is a document of its own,
    also if its id or text repeats, and every item row has its own ranking.
    An empty table on either side gives an empty result. Texts of any length
    are read whole.
    """
    return rank_with_work(docs, items, top)[0]
