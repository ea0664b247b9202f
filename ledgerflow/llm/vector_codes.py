"""Vector codes by product quantisation, trained with ball k-means in whole numbers.

Vectors are cut into parts and every part position has a codebook. An entry
and the parts assigned to it form a ball; its radius is the largest distance
in it. Only entries nearer than twice the radius are neighbours of a ball. A
part nearer to its entry than half the way to the nearest neighbour lies in
the stable core and keeps its entry unseen. The others lie in rings between
half the distances to one neighbour and the next: a part is compared exactly
with the neighbours up to its ring alone. A ball whose entry and neighbours
did not move keeps all its parts without a look. All bounds compare whole
numbers and leave out an entry only when it is truly farther, so the codes
equal those of the full search, ties included.

The vectors travel as blocks of rows with their present codes. A round reads
and writes each block once; besides the blocks it writes the sums of each
entry, which meet in one small aggregate. The driver sees the codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import join_by_key
from ledgerflow.session import remove_path, scratch_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Vectors of one block.
BLOCK = 4096
#: Whole components must stay below this, so that no squared distance or sum of them leaves 64 bits.
LIMIT = 1 << 27
#: Below this, doubles hold every sum of products exactly.
EXACT = 1 << 22

_BLOCK = pa.schema([("kind", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("known", pa.binary()), ("vectors", pa.binary()), ("codes", pa.binary()), ("errors", pa.binary()), ("part", pa.int32()), ("entry", pa.int32()), ("sums", pa.list_(pa.int64())), ("n", pa.int64()), ("radius", pa.int64()), ("compared", pa.int64())])
_DDL = "kind int, ids binary, labels binary, known binary, vectors binary, codes binary, errors binary, part int, entry int, sums array<bigint>, n bigint, radius bigint, compared bigint"


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x) of the rows whose vector is there and finite throughout, x = floor(4096 * component)."""
    d = F.col("embedding").cast("array<double>")
    fine = F.col("embedding").isNotNull() & F.forall(d, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # coalesce: a null component makes the test null
    return vectors.filter(F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(d, lambda v: F.floor(v * SCALE).cast("long")).alias("x")
    )


def squares(parts: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances of parts (n, w) to one entry (w)."""
    gap = parts - entry
    if len(gap) and np.abs(gap).max() < EXACT:
        gap = gap.astype("float64")
        return np.einsum("ij,ij->i", gap, gap).astype("int64")
    return np.einsum("ij,ij->i", gap, gap)


def full_search(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part, ties to the lower index, and its squared distance."""
    every = np.stack([squares(parts, e) for e in book], axis=1)
    code = every.argmin(axis=1)
    return code, every[np.arange(len(parts)), code]


class Balls:
    """What one part position's codebook says about candidates: each entry's neighbours by distance, and what moved."""

    def __init__(self, book: np.ndarray, before: np.ndarray | None, radius: np.ndarray | None):
        self.book = book
        self.between = np.stack([squares(book, e) for e in book], axis=1) if len(book) else np.zeros((0, 0), "int64")
        self.moved = np.ones(len(book), bool) if before is None else (book != before).any(axis=1)
        #: Squared radii bound the balls as they were assigned; a moved entry's ball is measured in the task.
        self.radius = radius

    def neighbours(self, i: int, radius2: int) -> tuple[np.ndarray, np.ndarray]:
        """(entries, squared distances) of the entries that a part within radius2 of entry i can be as near to, nearest first."""
        d = self.between[i]
        near = np.flatnonzero((d <= 4 * radius2) & (np.arange(len(d)) != i))
        near = near[np.argsort(d[near], kind="stable")]
        return near, d[near]

    def still(self, i: int) -> bool:
        """Whether neither entry i nor any entry that its ball can reach moved."""
        if self.radius is None or self.moved[i]:
            return False
        return not self.moved[self.neighbours(i, int(self.radius[i]))[0]].any()

    def assign(self, parts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(codes, squared distances, distances computed) of parts whose last codes are given."""
        new, best, compared = codes.copy(), np.zeros(len(parts), "int64"), 0
        for i in np.unique(codes):
            mine = np.flatnonzero(codes == i)
            own = squares(parts[mine], self.book[i])
            compared += len(mine)
            best[mine] = own
            if self.still(int(i)):
                continue
            near, gap = self.neighbours(int(i), int(own.max()))
            if not len(near):
                continue
            # ring: how many neighbours are at most twice as far from the entry as the part is; none is the stable core
            ring = np.searchsorted(gap, 4 * own, side="right")
            for r in range(ring.max()):
                out = np.flatnonzero(ring > r)
                there = squares(parts[mine[out]], self.book[near[r]])
                compared += len(out)
                at = mine[out]
                wins = (there < best[at]) | ((there == best[at]) & (near[r] < new[at]))
                new[at[wins]], best[at[wins]] = near[r], there[wins]
        return new, best, compared


def _emit(ids, labels, known, vectors, codes, errors) -> dict:
    return {"kind": 0, "ids": ids, "labels": labels, "known": known, "vectors": vectors.tobytes(), "codes": codes.astype("uint8").tobytes(), "errors": errors.astype("int64").tobytes()}


def _round(batches: Iterator[pa.RecordBatch], books: np.ndarray, before: np.ndarray | None, radii: np.ndarray | None, width: int, fresh: bool) -> Iterator[pa.RecordBatch]:
    """Assign blocks; give them back with their codes, and the sums of every entry over the task's blocks."""
    parts, entries, w = books.shape
    balls = [Balls(books[p], None if before is None else before[p], None if radii is None else radii[p]) for p in range(parts)]
    sums, counts = np.zeros((parts, entries, w), "int64"), np.zeros((parts, entries), "int64")
    most, compared = np.zeros((parts, entries), "int64"), np.zeros((parts,), "int64")

    def blocks() -> Iterator[tuple]:
        for batch in batches:
            if fresh:
                for at in range(0, batch.num_rows, BLOCK):
                    piece = batch.slice(at, BLOCK)
                    yield _matrix(piece, width)
            else:
                for row in batch.to_pylist():
                    n = len(row["ids"]) // 8
                    yield row["ids"], row["labels"], row["known"], np.frombuffer(row["vectors"], "int32").reshape(n, parts * w), np.frombuffer(row["codes"], "uint8").reshape(n, parts).astype("int64")

    for ids, labels, known, small, codes in blocks():
        vectors = small.astype("int64")
        errors = np.zeros(len(vectors), "int64")
        new = np.zeros((len(vectors), parts), "int64")
        for p in range(parts):
            mine = vectors[:, p * w : (p + 1) * w]
            if codes is None:
                new[:, p], best = full_search(mine, books[p])
                compared[p] += entries * len(mine)
            else:
                new[:, p], best, seen = balls[p].assign(mine, codes[:, p])
                compared[p] += seen
            errors += best
            for e in np.unique(new[:, p]):
                its = new[:, p] == e
                sums[p, e] += mine[its].sum(axis=0)
                counts[p, e] += its.sum()
                most[p, e] = max(most[p, e], best[its].max())
        yield pa.RecordBatch.from_pylist([_emit(ids, labels, known, small, new, errors)], _BLOCK)
    rows = [{"kind": 1, "part": p, "entry": e, "sums": sums[p, e].tolist(), "n": int(counts[p, e]), "radius": int(most[p, e]), "compared": int(compared[p]) if e == 0 else 0} for p in range(parts) for e in range(entries) if counts[p, e] or e == 0]
    yield pa.RecordBatch.from_pylist(rows, _BLOCK)


def _matrix(piece: pa.RecordBatch, width: int) -> tuple:
    """A batch of (vec_id, label, x) as a block; vectors shorter than ``width`` end in zeros."""
    ids, labels, x = (piece.column(c) for c in ("vec_id", "label", "x"))
    known = np.stack([np.array(ids.is_valid()), np.array(labels.is_valid())]).astype("uint8")
    out = np.zeros((piece.num_rows, width), "int32")
    lengths = np.array(x.value_lengths())
    flat = x.flatten().to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(piece.num_rows), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[at] = flat
    return ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes(), labels.fill_null(0).to_numpy(zero_copy_only=False).tobytes(), known.tobytes(), out, None


def _rows(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, code, error) per vector of the blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, labels = np.frombuffer(row["ids"], "int64"), np.frombuffer(row["labels"], "int64")
            known = np.frombuffer(row["known"], "uint8").reshape(2, len(ids)) == 0
            codes = np.frombuffer(row["codes"], "uint8").reshape(len(ids), parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=known[0]), pa.array(labels, mask=known[1]), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(np.frombuffer(row["errors"], "int64"))],
                ["vec_id", "label", "code", "error"],
            )


def first_entries(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The codebooks (part, entry, position) of the smallest ids; equal ids in the order of their vectors, no id last."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    book = np.zeros((len(least), width), "int64")
    for i, r in enumerate(least):
        book[i, : len(r.x)] = r.x
    return np.ascontiguousarray(book.reshape(len(least), parts, width // parts).transpose(1, 0, 2))


class Codes:
    """A fitted coder: the final codebooks, the codes of all vectors, and how many distances each round computed."""

    def __init__(self, books: np.ndarray, rows: DataFrame, compared: list[int]):
        self.books, self.rows, self.compared = books, rows, compared

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes:
    """Train the codebooks on all vectors and give every vector its code.

    Needs vec_id, embedding and label; other columns are ignored. Rows whose
    vector is null or holds a null or non-finite component are dropped. The
    width is that of the longest vector, made up to a multiple of ``parts``;
    shorter vectors, empty ones too, end in zeros. With fewer vectors than
    entries there are as many entries as vectors. Repeated rows count each;
    equal ids start the codebook in the order of their vectors. A component
    whose whole number reaches 2**27 is an error, since squared distances
    would leave 64 bits. An empty table gives no codebook and no row.
    """
    spark = vectors.sparkSession
    rows = whole(vectors)
    size = rows.agg(F.max(F.size("x")).alias("w"), F.max(F.array_max(F.transform("x", F.abs))).alias("m")).first()
    if (size.m or 0) >= LIMIT:
        raise ValueError(f"a component reaches {LIMIT // SCALE}: squared distances would leave 64 bits")
    width = max(1, -(-(size.w or 0) // parts)) * parts
    books = first_entries(rows, width, parts, entries)
    before = radii = old = None
    compared = []
    for turn in range(rounds + 1 if books.shape[1] else 0):
        path = scratch_path(spark, f"codes-{turn}")
        step = lambda batches, b=books, o=before, r=radii, f=turn == 0: _round(batches, b, o, r, width, f)
        source = rows if turn == 0 else spark.read.schema(_DDL).parquet(old).filter("kind = 0")
        source.mapInArrow(step, _DDL).write.partitionBy("kind").parquet(path)
        if old:
            remove_path(spark, old)
        old = path
        told = spark.read.schema(_DDL).parquet(path).filter("kind = 1")
        # at most parts * entries rows
        found = told.groupBy("part", "entry").agg(
            *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width // parts)], F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("compared").alias("compared")
        ).collect()
        compared.append(sum(r.compared for r in found))
        if turn == rounds:
            break
        before, radii = books, np.zeros(books.shape[:2], "int64")
        books = books.copy()
        for r in found:
            if r.n:
                books[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(width // parts)]
                radii[r.part, r.entry] = r.radius
    done = spark.read.schema(_DDL).parquet(old).filter("kind = 0") if old else spark.createDataFrame([], _DDL)
    return Codes(books, done.mapInArrow(lambda b: _rows(b, parts), "vec_id long, label long, code string, error long"), compared)


def encode(vectors: DataFrame) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256 (see ``fit``)."""
    codes = fit(vectors)
    rows = codes.rows.withColumn("no_label", F.col("label").isNull()).withColumn("label", F.coalesce("label", F.lit(0).cast("long")))
    per_label = rows.groupBy("no_label", "label").agg(F.sum("error").alias("label_error"), F.count("*").alias("label_rows"))
    found = join_by_key(rows, rows.count(), per_label, ["no_label", "label"], "label_rows")
    return found.select("vec_id", "code", "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))
