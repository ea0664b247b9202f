"""Near-duplicate texts by a signature-coordinate inverted join.

Each distinct word-shingle set gets a MinHash signature. Every coordinate and
value is a posting key; a document posts under the rarest of its keys only,
as many as guarantee that two documents with enough equal coordinates meet
under one (prefix filtering: the keys in ascending order of frequency). Lists
of rare keys give candidate pairs; pairs are kept that collide in enough
coordinates, and confirmed on the full sets. Lists of frequent keys (text
that many documents share, large groups of near copies) are never expanded:
their documents are compared block by block inside tasks, each pair under one
key only, and leave a spanning forest of confirmed links.

Equal sets are one class from the start, so copies meet nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import give_back, giving_back, join_by_key, stage
from ledgerflow.llm.components import connected

COORDINATES = 32
#: Pairs need this many equal coordinates: at a similarity of 0.8, one pair in five million has fewer.
MATCHES = 13
#: So many keys of a document, the rarest, are posted.
PREFIX = COORDINATES - MATCHES + 1
#: There are at most so many frequent keys (2 MB to broadcast).
FREQUENT_KEYS = 131_072
LIST_LEAST = 32
#: Documents of a frequent key that one task holds against as many others.
BLOCK = 1024
#: After so many documents of a frequent key the worker gives its memory back; most keys have fewer.
LARGE_PART = 512
PERCENT = 80
CACHED_WORDS = 500_000

_RNG = np.random.RandomState(7)
_MULTIPLY = _RNG.randint(0, 2**63, COORDINATES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.randint(0, 2**63, COORDINATES, dtype=np.int64).astype(np.uint64)
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _PLACES[0]
    h ^= h >> np.uint64(29)
    return h


def shingles(text: bytes | None, words: int, seen: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``words`` words; fewer words are one shingle, none give none.

    A-Z are lower-cased; words are runs of anything but blanks and \\t to \\r.
    """
    parts = text.lower().split() if text else []
    n = len(parts)
    if not n:
        return np.zeros(0, np.uint64)
    x = np.fromiter(map(seen.__getitem__, parts), np.uint64, n)
    k = min(words, n)
    with np.errstate(over="ignore"):
        h = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            h = _mixed(h + x[i : n - k + 1 + i] * _PLACES[i % len(_PLACES)] + np.uint64(i + 1))
    return np.unique(h)


def signature(h: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's hash, upper 32 bits."""
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for a in range(0, len(h), 256):
            block = h[a : a + 256, None] * _MULTIPLY
            block += _ADD
            np.minimum(out, block.min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def _set_key(h: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    d = xxhash.xxh3_128_digest(h.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, hi, lo, sig) per row; sig is empty for an empty set."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Words()
        for batch in batches:
            n, hi, lo, sig = [], [], [], []
            for text in batch.column(1):
                h = shingles(text.as_py(), words, seen)
                key = _set_key(h)
                n.append(len(h))
                hi.append(key[0])
                lo.append(key[1])
                sig.append(signature(h).tobytes() if len(h) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(sig, pa.binary())],
                names=["doc_id", "n_shingles", "hi", "lo", "sig"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, hi bigint, lo bigint, sig binary")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles): the whole set as bytes, for confirming."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Words()
        for batch in batches:
            sets = [shingles(t.as_py(), words, seen).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, shingles binary")


def _keys(sig: bytes) -> np.ndarray:
    return np.frombuffer(sig, np.uint32).astype(np.int64) | (np.arange(COORDINATES, dtype=np.int64) << 32)


def frequent_keys(classes: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, their frequency), sorted by key: at most FREQUENT_KEYS, as those with fewer documents than a bound that the number of documents gives stay out."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [s.as_py() for s in batch.column(0)]
            keys, counts = np.unique(np.concatenate([_keys(s) for s in sigs]) if sigs else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], names=["key", "n"])

    least = max(LIST_LEAST, n * COORDINATES // FREQUENT_KEYS + 1)
    counted = classes.select("sig").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    got = counted.filter(F.col("n") >= least).toPandas().sort_values("key")
    return got["key"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


def postings(classes: DataFrame, keys: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(key, frequent, mask, doc_id, n_shingles) for the PREFIX rarest keys of each class; mask: the coordinates of its frequent ones."""
    held = classes.sparkSession.sparkContext.broadcast((keys, counts))

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.stack([_keys(s.as_py()) for s in batch.column(2)])
            if len(keys):
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                freq = np.where(keys[at] == own, counts[at], 0)
            else:
                freq = np.zeros(own.shape, np.int64)
            order = np.lexsort((own, freq), axis=1)[:, :PREFIX]
            own, freq = np.take_along_axis(own, order, 1), np.take_along_axis(freq, order, 1)
            mask = np.where(freq > 0, np.int64(1) << (own >> 32), 0).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own.ravel()),
                    pa.array((freq > 0).ravel()),
                    pa.array(np.repeat(mask, PREFIX)),
                    pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), PREFIX)),
                    pa.array(np.repeat(batch.column(1).to_numpy(zero_copy_only=False), PREFIX)),
                ],
                names=["key", "frequent", "mask", "doc_id", "n_shingles"],
            )

    return classes.select("doc_id", "n_shingles", "sig").mapInArrow(run, "key bigint, frequent boolean, mask bigint, doc_id bigint, n_shingles bigint")


def rare_pairs(posted: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, that share a rare key and are of like size. A rare list is short: fewer documents than the bound of ``frequent_keys``."""
    lists = posted.filter("not frequent").groupBy("key").agg(F.collect_list(F.struct("doc_id", "n_shingles")).alias("l")).filter("size(l) > 1")
    pairs = F.expr(
        "flatten(transform(l, (x, i) -> transform(filter(slice(l, i + 2, size(l)), "
        f"y -> 100 * least(x.n_shingles, y.n_shingles) >= {percent} * greatest(x.n_shingles, y.n_shingles) and x.doc_id != y.doc_id), "
        "y -> struct(least(x.doc_id, y.doc_id) as a, greatest(x.doc_id, y.doc_id) as b))))"
    )
    return lists.select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()


def _confirmed(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def colliding(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs with at least MATCHES equal coordinates."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, COORDINATES) for c in (2, 3))
                yield pa.RecordBatch.from_arrays([c.filter(pa.array((x == y).sum(axis=1) >= MATCHES)) for c in batch.columns[:2]], names=["a", "b"])

    sig = classes.select("doc_id", "sig")
    return (
        pairs.join(sig.toDF("a", "sig_a"), "a")
        .join(sig.toDF("b", "sig_b"), "b")
        .select("a", "b", "sig_a", "sig_b")
        .mapInArrow(run, "a bigint, b bigint")
    )


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are as alike as asked for."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [
                _confirmed(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(hits, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return (
        pairs.join(sets.toDF("a", "x"), "a")
        .join(sets.toDF("b", "y"), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(run, "a bigint, b bigint")
    )


def _list_links(part: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A spanning forest of the confirmed links between the documents of one frequent key (two blocks of them at most).

    A pair belongs to the key of its first equal coordinate that is frequent
    in both; under other keys it is passed over.
    """
    part = part.sort_values(["block", "doc_id"], kind="stable")
    n = len(part)
    coordinate = np.uint64(int(part["key"].iloc[0]) >> 32)
    sig = np.frombuffer(b"".join(part["sig"]), np.uint32).reshape(n, COORDINATES)
    ids, size, mask = (part[c].to_numpy() for c in ("doc_id", "n_shingles", "mask"))
    mask = mask.astype(np.uint64)
    block = part["block"].to_numpy()
    two = part["other"].iloc[0] != part["one"].iloc[0]
    sets = [np.frombuffer(s, np.uint64) for s in part["shingles"]]
    lower = np.uint64(1) << coordinate
    root = np.arange(n)
    out_a, out_b = [], []
    for i in range(n - 1):
        j = np.arange(i + 1, n)
        j = j[(root[j] != root[i]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))]
        if two:
            j = j[block[j] != block[i]]
        if not len(j):
            continue
        equal = sig[j] == sig[i]
        enough = equal.sum(axis=1) >= MATCHES
        j, equal = j[enough], equal[enough]
        bits = (equal.astype(np.uint64) << np.arange(COORDINATES, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) & mask[i] & mask[j]
        for k in j[(bits & (~bits + np.uint64(1))) == lower]:
            if root[k] != root[i] and _confirmed(sets[i], sets[k], percent):
                out_a.append(min(ids[i], ids[k]))
                out_b.append(max(ids[i], ids[k]))
                root[root == root[k]] = root[i]
    return pd.DataFrame({"a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)})


def frequent_links(posted: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) that span what the frequent keys connect; a long list is cut into blocks, every two of which meet in a task."""
    lists = posted.filter("frequent").select("key", "mask", "doc_id", "n_shingles")
    blocks = lists.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id", "key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = (
        lists.join(blocks, "key")
        .withColumn("block", own)
        .select("key", "mask", "doc_id", "n_shingles", "block", other.alias("with"))
        .withColumn("one", F.least("block", "with"))
        .withColumn("other", F.greatest("block", "with"))
        .join(classes.select("doc_id", "sig"), "doc_id")
        .join(sets, "doc_id")
    )

    def run(part: pd.DataFrame) -> pd.DataFrame:
        out = _list_links(part, percent)
        if len(part) >= LARGE_PART:
            give_back()
        return out

    return rows.groupBy("key", "one", "other").applyInPandas(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Needs doc_id and text; other columns are ignored. Documents are linked
    whose sets of ``words``-word shingles have a Jaccard similarity of at
    least ``percent`` in a hundred; component_id is the smallest doc_id
    reachable, kept marks it. A null or empty text has the empty set and is
    linked with nothing. Rows of one doc_id are one document. A row without
    doc_id is linked with nothing, has no component_id and is kept. Texts are
    read whole. An empty table gives an empty result.
    """
    rows = stage(signatures(docs, words), "minhash-rows")
    n_rows = rows.count()
    linkable = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(linkable.groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("members")), "minhash-classes")
    first = stage(
        linkable.join(classes.select("doc_id", "hi", "lo"), ["doc_id", "hi", "lo"]).dropDuplicates(["doc_id", "hi", "lo"]).select("doc_id", "n_shingles", "sig"),
        "minhash-first",
    )
    keys, counts = frequent_keys(first, first.count())
    posted = stage(postings(first, keys, counts), "minhash-postings")
    pairs = stage(colliding(rare_pairs(posted, percent), first), "minhash-pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).unionByName(posted.filter("frequent").select("doc_id")).distinct()
    sets = stage(full_sets(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), words), "minhash-sets")
    links = confirm(pairs, sets, percent).unionByName(frequent_links(posted, first, sets, percent))
    found = connected(links)
    of_class = (
        classes.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("hi", "lo", F.coalesce("component", "doc_id").alias("component_id"), "members")
    )
    joined = join_by_key(linkable.select("doc_id", "n_shingles", "hi", "lo"), n_rows, stage(of_class, "minhash-of-class"), ["hi", "lo"], "members")
    alone = rows.filter("not (n_shingles > 0 and doc_id is not null)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.select("doc_id", "n_shingles", "component_id").unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, whose doc_id is the smallest of its group of near duplicates."""
    gone = near_duplicates(docs, words, percent).filter("not kept").select("doc_id").distinct()
    return docs.join(stage(gone, "minhash-gone"), "doc_id", "left_anti")
