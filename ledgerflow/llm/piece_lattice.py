"""SentencePiece encoding and decoding over a relational lattice.

Texts fall into units: a run of the blank sign with the word after it. Which
pieces cover a unit depends on the unit alone, so the work is done once per
distinct unit: its substrings of bounded length are exploded and equi-joined
to the piece table, the edges grouped by unit, and the lattice is folded with
Spark's ``aggregate``. For a unigram model the fold is Viterbi: the best score
to every position. The scores of a BPE model are merge ranks, which no path
sum respects; its fold walks the same lattice and applies, while there is one,
the best edge that joins two neighbouring pieces.

Texts themselves are not shuffled as rows of words: each task turns its share
into blocks, a list of distinct units and compressed numbers that lead from
documents to words to units. Units go out by hash, their ids come back by block.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import give_back, giving_back, shuffle_width
from ledgerflow.llm.token_files import from_planes, to_planes

BLANK = "▁"
#: Longer units, of which no cut is safe, are not folded in the lattice (bits of a long mark the positions) but by merge_long or viterbi_long.
UNIT = 60
#: A block is closed at so many distinct words, bytes of these, or words in all.
BLOCK_WORDS = 700_000
BLOCK_BYTES = 32_000_000
BLOCK_PLACES = 8_000_000
#: Documents, and about the bytes of text, that are cut at once.
SLICE = 2048
SLICE_BYTES = 8_000_000
#: Words, and about the bytes of these, that are cut into units at once.
CUT_WORDS = 65_536
CUT_BYTES = 1_000_000
#: A place is a block's number and a unit's place in it; a block has fewer units than 2 ** PLACE_BITS.
PLACE_BITS = 24
#: Partitions of units per ordinary shuffle partition.
SPREAD = 8


@dataclass
class Pieces:
    """A SentencePiece model as plain tables."""

    text: list[str]
    score: list[float]
    normal: list[bool]
    byte_ids: dict[int, int]
    unknown: int
    bpe: bool
    longest: int = 0
    bits: int = 0
    ids: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.ids = {p: i for i, (p, ok) in enumerate(zip(self.text, self.normal, strict=True)) if ok}
        self.longest = max(map(len, self.ids), default=1)
        self.bits = (len(self.text) + 1).bit_length()
        order = {s: r for r, s in enumerate(sorted({self.score[i] for i in self.ids.values()}, reverse=True))}
        self.rank = {i: order[self.score[i]] for i in self.ids.values()}

    @classmethod
    def load(cls, path: str) -> Pieces:
        """From a model file. BPE models are told by their scores, which are whole numbers: minus the merge rank."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.vocab_size())
        text, score = [sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n]
        normal = [not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in n]
        byte_ids = {int(text[i][3:5], 16): i for i in n if sp.is_byte(i)}
        return cls(text, score, normal, byte_ids, sp.unk_id(), all(float(s).is_integer() for s in score))

    def fallback(self, chars: str) -> list[int]:
        """Ids of characters that no piece has: their bytes, or the unknown id."""
        if len(self.byte_ids) < 256:
            return [self.unknown]
        return [self.byte_ids[b] for b in chars.encode("utf-8", "surrogatepass")]

    def unit_pattern(self) -> re.Pattern:
        """Cuts that no piece crosses: before a run of blank signs, and around characters that only stand alone."""
        inside = {c for p in self.ids if len(p) > 1 for c in p} | {BLANK}
        letters = "".join(re.escape(c) for c in sorted(inside - {BLANK}))
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            return re.compile(f"[{letters}{BLANK}]+|.", re.S)
        return re.compile(f"{BLANK}*[{letters}]+|{BLANK}+|." if letters else f"{BLANK}+|.", re.S)

    def covers(self, unit: str) -> bool:
        """Whether the lattice has a path through a unit: none has a character that no piece holds, none longer than UNIT is tried."""
        return 1 < len(unit) <= UNIT or unit in self.ids

    def pairs(self) -> set[str]:
        return {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}


def normalised(text: str) -> str:
    """The identity normaliser with a dummy prefix."""
    return BLANK + text.replace(" ", BLANK) if text else ""


class Cutter:
    """Texts to words, words to units, some thousands at a time: cuts that no piece crosses, since none holds the two characters on their sides.

    Where no piece holds a blank sign after another character, a word is what
    stands between two blanks, without the blank before it.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.pattern = pieces.unit_pattern().findall
        self.runs = re.compile(f"{BLANK}+[^{BLANK}]*").findall
        self.by_blanks = not any(BLANK in p.lstrip(BLANK) for p in pieces.ids)
        pairs = sorted(pieces.pairs())
        # characters of pieces get classes, and a table tells which classes stand side by side in one
        chars = sorted({c for p in pairs for c in p})
        self.class_of = np.zeros(0x110000, np.int32)
        self.class_of[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.n = len(chars) + 1
        side = np.array([[self.class_of[ord(c)] for c in p] for p in pairs], np.int64).reshape(-1, 2)
        at = side[:, 0] * self.n + side[:, 1]
        self.joined = np.zeros(self.n * self.n // 8 + 1, np.uint8)  # one bit a pair
        np.bitwise_or.at(self.joined, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def words(self, texts: pa.Array) -> pa.ListArray:
        """The words of each text; none of an empty one."""
        texts = pc.fill_null(texts, "")
        if self.by_blanks:
            plain = pc.replace_substring(texts, BLANK, " ")
            odd = pc.match_substring_regex(plain, "^ |  | $|^$")  # blanks in a run, or at an end
            if not pc.any(odd).as_py():
                return pc.split_pattern(plain, " ")
            cut = lambda t: [w[1:] for w in self.runs(normalised(t))] if "  " in t or t[:1] == " " or t[-1:] == " " else t.split(" ") if t else []
            return pa.array(map(cut, plain.to_pylist()), pa.list_(pa.string()))
        return pa.array([self.pattern(normalised(t)) for t in texts.to_pylist()], pa.list_(pa.string()))

    def units(self, words: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """(units one after the other, how many each word has); some words at a time, whose positions take many times their bytes."""
        some = [self._units(words.slice(a, n)) for a, n in _slices(words, CUT_WORDS, CUT_BYTES)] or [self._units(words)]
        return pa.concat_arrays([u for u, _ in some]).dictionary_encode(), np.concatenate([n for _, n in some])

    def _units(self, words: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
        joined = pc.binary_join_element_wise(BLANK if self.by_blanks else "", words, "")
        ends = np.cumsum(np.asarray(pc.utf8_length(joined), np.int64))
        data = b"".join(pc.binary_join(pa.ListArray.from_arrays([0, len(joined)], joined), "").cast(pa.binary()).to_pylist())
        text = data.decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        classes = self.class_of[points].astype(np.int64)
        pair = classes[:-1] * self.n + classes[1:]
        cut = np.ones(len(points) + 1, bool)
        cut[1:-1] = (self.joined[pair >> 3] >> (pair & 7).astype(np.uint8)) & 1 == 0
        cut[ends] = True
        at = np.flatnonzero(cut)
        size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(size)])[at].astype(np.int64)
        units = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
        return units, np.diff(np.searchsorted(at, ends), prepend=0)


def merge_long(unit: str, pieces: Pieces) -> list[int]:
    """BPE of one unit of any length with a heap of merges (best score first, then leftmost), as the lattice fold does for short ones."""
    n = len(unit)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        b = end[a]
        if b < n and (i := pieces.ids.get(unit[a : end[b]])) is not None:
            heapq.heappush(heap, (pieces.rank[i], a, b, end[b]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, a, b, e = heapq.heappop(heap)
        if not (alive[a] and alive[b] and end[a] == b and end[b] == e):
            continue
        alive[b], end[a] = False, e
        if e < n:
            before[e] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    out, a = [], 0
    while a < n:
        i = pieces.ids.get(unit[a : end[a]])
        out += [i] if i is not None else pieces.fallback(unit[a : end[a]])
        a = end[a]
    return out


def viterbi_long(unit: str, pieces: Pieces) -> list[int]:
    """The best path by the sum of scores through one unit of any length, as the lattice fold has it for short ones."""
    low = min((pieces.score[i] for i in pieces.ids.values()), default=0.0) - 10.0
    best, back = [0.0], [(0, -1)]
    for e in range(1, len(unit) + 1):
        top, way = best[e - 1] + low, (e - 1, -1)  # a character that is no piece
        found = False
        for s in range(max(0, e - pieces.longest), e):
            if (i := pieces.ids.get(unit[s:e])) is not None and (not found or best[s] + pieces.score[i] > top):
                top, way, found = best[s] + pieces.score[i], (s, i), True
        if found and unit[e - 1] not in pieces.ids and best[e - 1] + low > top:
            top, way = best[e - 1] + low, (e - 1, -1)
        best.append(top)
        back.append(way)
    out: list[list[int]] = []
    e = len(unit)
    while e:
        s, i = back[e]
        out.append([i] if i >= 0 else pieces.fallback(unit[s:e]))
        e = s
    return [i for part in reversed(out) for i in part]


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """(piece, id, rank, score, early), one row per ordinary piece: as many as the model has.

    early: some longer piece that starts or ends with this one has a better
    rank, so it may become possible only after its turn.
    """
    rank = {p: pieces.rank[i] for p, i in pieces.ids.items()}
    early = {x for p, r in rank.items() for k in range(1, len(p)) for x in (p[:k], p[k:]) if rank.get(x, -1) > r}
    rows = [(p, i, rank[p], float(pieces.score[i]), p in early) for p, i in pieces.ids.items()]
    lone = {c for p in pieces.ids for c in p} - pieces.ids.keys()
    last = len(pieces.text)
    low = min((r[3] for r in rows), default=0.0) - 10.0
    rows += [(c, -1 - ord(c), last, low, False) for c in sorted(lone)]  # characters within pieces that are no piece themselves
    return spark.createDataFrame(rows, "piece string, id int, rank int, score double, early boolean")


def lattice(units: DataFrame, table: DataFrame, longest: int, **lists: Column) -> DataFrame:
    """(unit, at, n) of each unit, and its edges: one list for each of ``lists``, whose column tells what it holds of an edge (null: nothing).

    Such a column sees the edge's start and length, ``s`` and ``l``, and the
    columns of its piece; without any there is one list, ``edges``.
    ``units`` has one row per unit of at most UNIT characters, with whatever
    it carries in ``at``. Where it lies partitioned by ``h``, the unit's
    hash, the edges, many to a unit, are not shuffled. They are grouped by
    that hash and the unit's number within its task, and the unit and what it
    carries travel with its first edge alone. The hash of a substring finds
    the piece, both are compared after.
    """
    lists = lists or {"edges": F.expr("struct(s, s + l as e, id, score)")}
    units = units if "h" in units.columns else units.withColumn("h", F.xxhash64("unit"))
    numbered = units.withColumn("number", F.monotonically_increasing_id()).withColumn("n", F.char_length("unit"))
    starts = numbered.withColumn("s", F.explode(F.expr("sequence(0, n - 1)"))).withColumn("rest", F.expr(f"substring(unit, s + 1, {longest})"))
    subs = starts.withColumn("l", F.explode(F.expr(f"sequence(1, least({longest}, n - s))"))).withColumn("sub", F.expr("substring(rest, 1, l)"))
    same = F.col("sub").startswith(F.col("piece")) & F.col("piece").startswith(F.col("sub"))  # "=" would make the piece a second key
    edges = subs.withColumn("key", F.xxhash64("sub")).join(F.broadcast(table.withColumn("key", F.xxhash64("piece"))), "key").filter(same)
    of = F.when(F.expr("s = 0 and l = 1"), F.struct("unit", "at", "n")).alias("of")
    grouped = edges.select("h", "number", of, *(c.alias(k) for k, c in lists.items())).groupBy("h", "number")
    return grouped.agg(F.first("of", ignorenulls=True).alias("of"), *(F.collect_list(k).alias(k) for k in lists)).select("of.*", *lists)


#: Marks a state whose unit needs the merges one at a time (no position has this bit).
_AGAIN = 1 << 62
#: Bits of an id, which is made positive by _ID, and of a position or a length.
_ID_BITS, _AT_BITS = 24, 6
_ID = 0x110000


def bpe_lists() -> dict[str, Column]:
    """What ``fold_bpe`` needs of the edges: ``joins`` of several characters, ``singles`` of one.

    ``turn`` has an edge's rank, start, length and ``early`` in one long,
    ``id`` its start and id, ``ends`` the bits of its two ends, ``span``
    those of all positions from one to the other.
    """
    turn = f"shiftleft(shiftleft(shiftleft(cast(rank as long), {_AT_BITS}) | s, {_AT_BITS}) | l, 1) | if(early, 1, 0) as turn"
    at_id = f"shiftleft(cast(s as long), {_ID_BITS}) | (id + {_ID})"
    join = f"if(l > 1, struct({turn}, {at_id} as id, shiftleft(1L, s) | shiftleft(1L, s + l) as ends, shiftleft(1L, s + l + 1) - shiftleft(1L, s) as span), null)"
    return {"joins": F.expr(join), "singles": F.expr(f"if(l = 1, {at_id}, null)")}


def fold_bpe(edges: DataFrame) -> DataFrame:
    """(unit, at, ids) by best merges.

    The state is a set of positions, one bit each: an edge can merge if its
    ends and one position between are set. One pass over the edges by rank,
    then start, is enough unless a merge makes a better-ranked edge possible,
    whose turn is over; the few units where that happens repeat: the best
    possible merge at a time.
    """
    edges = edges.withColumn("joins", F.sort_array("joins"))
    rank = lambda x: f"shiftright({x}.turn, {2 * _AT_BITS + 1})"
    can = lambda b, x: f"({b} & {x}.ends) = {x}.ends and bit_count({b} & {x}.span) = 3"
    without = lambda b, x: f"({b} & ~({x}.span & ~{x}.ends))"
    every = "(shiftleft(1L, n + 1) - 1L)"
    missed = f"(x.turn & 1L) = 1L and exists(joins, y -> {rank('y')} < {rank('x')} and {can(without('b', 'x'), 'y')})"
    one_pass = f"(b, x) -> if({can('b', 'x')}, {without('b', 'x')} | if({missed}, {_AGAIN}L, 0L), b)"
    step_by_step = (
        f"aggregate(slice(sequence(1, n), 1, n - 1), {every}, "
        f"(b, i) -> b & ~coalesce(get(transform(filter(joins, x -> {can('b', 'x')}), x -> x.span & ~x.ends), 0), 0L))"
    )
    alone = f"shiftleft(3L, cast(shiftright(x, {_ID_BITS}) as int))"
    pieces = (
        "transform(sort_array(concat("
        "transform(filter(joins, x -> (c & x.span) = x.ends), x -> x.id), "
        f"filter(singles, x -> (c & {alone}) = {alone}))), x -> cast((x & {(1 << _ID_BITS) - 1}L) - {_ID} as int))"
    )
    # the inner aggregate only names the final state, so that it is computed once
    ids = f"aggregate(joins, {every}, {one_pass}, b -> aggregate(array(0), if((b & {_AGAIN}L) = 0, b, {step_by_step}), (c, i) -> c, c -> {pieces}))"
    return edges.select("unit", "at", F.expr(ids).alias("ids"))


def fold_viterbi(edges: DataFrame) -> DataFrame:
    """(unit, at, ids) by the best sum of scores; of equal sums the one whose last piece is longer."""
    best = (
        "aggregate(sequence(1, n), array(named_struct('score', 0.0D, 's', 0, 'id', 0)), (st, p) -> "
        "concat(st, array(coalesce(reduce(filter(edges, x -> x.e = p), cast(null as struct<score:double,s:int,id:int>), (a, x) -> "
        "if(get(st, x.s).score is null or (a is not null and (a.score > get(st, x.s).score + x.score or (a.score = get(st, x.s).score + x.score and a.s <= x.s))), a, "
        "named_struct('score', get(st, x.s).score + x.score, 's', x.s, 'id', x.id))), named_struct('score', cast(null as double), 's', p - 1, 'id', 0)))), "
        "st -> aggregate(sequence(1, n), named_struct('p', n, 'ids', cast(array() as array<int>)), (a, i) -> "
        "if(a.p = 0, a, named_struct('p', get(st, a.p).s, 'ids', concat(array(get(st, a.p).id), a.ids))), a -> a.ids))"
    )
    return edges.select("unit", "at", F.expr(best).alias("ids"))


_UNITS = pa.schema([("block", pa.int64()), ("units", pa.list_(pa.string()))])
_PLANES = pa.list_(pa.binary())
_CODES = pa.schema(
    [("of", pa.int64()), ("n_units", pa.int64()), ("odd", pa.list_(pa.string())), ("ids", pa.list_(pa.int64())), ("words", pa.list_(pa.int32()))]
    + [("n_words", pa.int64()), ("n_parts", pa.int64()), ("per_word", _PLANES), ("parts", _PLANES), ("numbers", _PLANES)]
)
_CODES_SQL = (
    "of bigint, n_units bigint, odd array<string>, ids array<bigint>, words array<int>, n_words bigint, n_parts bigint, "
    "per_word array<binary>, parts array<binary>, numbers array<binary>"
)


class _Block:
    """What one block gathers: its words, numbered as they appear, and its documents as numbers of words."""

    def __init__(self) -> None:
        self.seen = pa.array([], pa.string())
        self.ids: list = []
        self.words: list[int] = []
        self.numbers: list[np.ndarray] = []
        self.size = 0

    def full(self) -> bool:
        return len(self.seen) >= BLOCK_WORDS or self.seen.nbytes >= BLOCK_BYTES or self.size >= BLOCK_PLACES

    def add(self, doc_ids: pa.Array, found: pa.ListArray, units: bool) -> None:
        """Some documents; with ``units`` only their words are kept."""
        flat = found.flatten().dictionary_encode()
        both = pa.concat_arrays([self.seen, flat.dictionary]).dictionary_encode()  # words known come first and keep their numbers
        number = np.asarray(both.indices)[len(self.seen) :].astype(np.uint32)
        self.seen = both.dictionary
        self.size += len(flat)
        if not units:
            self.numbers.append(number[np.asarray(flat.indices)])
            self.ids += doc_ids.to_pylist()
            self.words += pc.list_value_length(found).to_pylist()

    def split(self, cut: Cutter) -> tuple[pa.Array, list[str], np.ndarray, np.ndarray]:
        """(units for the lattice, odd units, units per word, their numbers), words in order of appearance; odd units are numbered last."""
        found, per_word = cut.units(self.seen)
        names = found.dictionary
        length = np.asarray(pc.utf8_length(names))
        odd = (length <= 1) | (length > UNIT)
        for i in np.flatnonzero(odd):
            odd[i] = not cut.pieces.covers(names[i].as_py())
        place = np.empty(len(names), np.uint32)
        place[np.flatnonzero(~odd)] = np.arange(len(names) - odd.sum(), dtype=np.uint32)
        place[np.flatnonzero(odd)] = np.arange(len(names) - odd.sum(), len(names), dtype=np.uint32)
        if len(names) >> PLACE_BITS:
            raise RuntimeError(f"a block has {len(names)} units")
        plain, strange = (names.filter(pa.array(x)).cast(pa.string()) for x in (~odd, odd))
        return plain, strange.to_pylist(), per_word.astype(np.uint32), place[np.asarray(found.indices)]

    def codes(self, block: int, cut: Cutter) -> pa.RecordBatch:
        flat = np.concatenate([np.zeros(0, np.uint32), *self.numbers])
        units, odd, per_word, parts = self.split(cut)
        # frequent words get small numbers, which compress better
        order = np.argsort(-np.bincount(flat, minlength=len(self.seen)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        first = np.cumsum(per_word, dtype=np.int64) - per_word
        parts, per_word = _gather(parts, first[order], per_word[order].astype(np.int64)), per_word[order]
        cols = [block, len(units), odd, self.ids, self.words, len(order), len(parts), to_planes(per_word, level=6), to_planes(parts, level=6), to_planes(rank[flat], level=6)]
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cols, _CODES, strict=True)], schema=_CODES)


def _slices(texts: pa.Array, most: int | None = None, size: int | None = None) -> Iterator[tuple[int, int]]:
    """(first, number) of texts taken at once: at most ``most`` (SLICE), and no more once they have ``size`` bytes (SLICE_BYTES)."""
    most, size = most or SLICE, size or SLICE_BYTES
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    a = 0
    while a < len(ends):
        full = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size)) + 1
        b = min(a + most, full, len(ends))
        yield a, b - a
        a = b


def _blocks(docs: DataFrame, pieces: Pieces, units: bool) -> DataFrame:
    """One row per block: its units, or its documents as codes. Both come from the same texts in the same order, so the numbers agree."""
    held = docs.sparkSession.sparkContext.broadcast(pieces)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, task, n, block = Cutter(held.value), TaskContext.get().partitionId(), 0, _Block()

        def close() -> pa.RecordBatch:
            nonlocal n, block
            number, done, n, block = (task << 16) + n, block, n + 1, _Block()
            if not units:
                return done.codes(number, cut)
            plain = done.split(cut)[0]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(plain)], plain)], schema=_UNITS)

        for batch in batches:
            for at, length in _slices(batch.column(1)):
                some = batch.slice(at, length)
                block.add(some.column(0), cut.words(some.column(1)), units)
                if block.full():
                    yield close()
                    give_back()
        if block.size or block.ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "block bigint, units array<string>" if units else _CODES_SQL)


def encode_units(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, at, ids) for every distinct unit of (unit, place) rows; at: the places that have it.

    A unit becomes some twenty edges in its task, so the units are dealt to
    more partitions than their own size asks for.
    """
    spark = words.sparkSession
    h = F.xxhash64("unit")  # not sent along: the tasks compute it again
    dealt = words.repartition(SPREAD * shuffle_width(spark), h).withColumn("h", h)
    units = dealt.groupBy("h", "unit").agg(F.collect_list("place").alias("at"))
    table = piece_table(spark, pieces)
    return fold_bpe(lattice(units, table, pieces.longest, **bpe_lists())) if pieces.bpe else fold_viterbi(lattice(units, table, pieces.longest))


def packed(bits: int):
    """Columns few and many for ``ids``: as many ids as fit into a long, ``bits`` each, or the list."""
    few = F.expr(f"if(size(ids) <= {62 // bits} and not exists(ids, x -> x < 0), aggregate(ids, 0L, (a, x) -> shiftleft(a, {bits}) | (x + 1)), null)")
    return few.alias("few"), F.when(few.isNull(), F.col("ids")).alias("many")


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` one after the other."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    first = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - first, lengths) + np.arange(total)]


def _unit_ids(dictionary: pa.Table, model: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, values) of the ids of a block's units; characters without a piece become bytes."""
    bits, n = model.bits, dictionary.num_rows
    few = dictionary.column("few")
    listed = np.asarray(few.is_null().combine_chunks() if n else pa.array([], pa.bool_())).astype(bool)
    code = np.asarray(few.fill_null(0).combine_chunks() if n else pa.array([], pa.int64()), np.int64)
    parts = (code[:, None] >> (bits * np.arange(62 // bits - 1, -1, -1))) & ((1 << bits) - 1)
    there = parts > 0  # an id is stored plus one; unused places come first
    lengths, values = there.sum(axis=1), (parts[there] - 1).astype(np.int32)
    starts = np.cumsum(lengths) - lengths
    if listed.any():
        lists = [
            np.array([y for x in ids for y in ([x] if x >= 0 else model.fallback(chr(-1 - x)))], np.int32)
            for ids in dictionary.column("many").filter(pa.array(listed)).to_pylist()
        ]
        lengths[listed] = [len(x) for x in lists]
        starts[listed] = len(values) + np.cumsum(lengths[listed]) - lengths[listed]
        values = np.concatenate([values, *lists])
    return starts, lengths, values


def encode(docs: DataFrame, pieces: Pieces, decoded: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_ids, ids (array<int>); with ``decoded`` also decoded_sha256.

    decoded_sha256 is the digest, in lower-case hex, of the UTF-8 text that the
    ids decode to, taken where the ids are made, some texts at a time. That
    text is the document's, but for blank signs in it, which become blanks.

    Needs doc_id and text; other columns are ignored. A null or empty text
    has no ids. Texts are encoded whole; a word of any length is. Rows that
    repeat a doc_id stay apart. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    words = _blocks(docs, pieces, units=True).select("block", F.posexplode("units").alias("pos", "unit"))
    words = words.select(F.expr(f"shiftleft(block, {PLACE_BITS}) | pos").alias("place"), "unit")
    coded = encode_units(words, pieces).select("at", *packed(pieces.bits)).select(F.explode("at").alias("place"), "few", "many")
    pos = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    coded = coded.select(F.shiftright("place", PLACE_BITS).alias("block"), pos.cast("int").alias("pos"), "few", "many")
    held = spark.sparkContext.broadcast(pieces)
    out = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int32()))] + ([("decoded_sha256", pa.string())] if decoded else []))

    def joined(block: pa.Table, dictionary: pa.Table) -> pa.Table:
        model = held.value
        long_fold = merge_long if model.bpe else viterbi_long
        if not block.num_rows:
            raise RuntimeError("units came back to a block that is not there")
        row = block.to_pylist()[0]
        n_units = row["n_units"]
        pos = dictionary.column("pos").to_numpy()
        if len(pos) != n_units or (len(pos) and np.bincount(pos, minlength=n_units).max() > 1):
            raise RuntimeError(f"a block of {n_units} units got {len(pos)} back")
        at, size, values = _unit_ids(dictionary, model)
        odd = [np.array(long_fold(u, model), np.int32) for u in row["odd"]]
        starts, lengths = np.zeros(n_units + len(odd), np.int64), np.zeros(n_units + len(odd), np.int64)
        starts[pos], lengths[pos] = at, size
        if odd:
            lengths[n_units:] = [len(x) for x in odd]
            starts[n_units:] = len(values) + np.cumsum(lengths[n_units:]) - lengths[n_units:]
            values = np.concatenate([values, *odd])
        # ids of words, from those of their units
        per_word, parts = from_planes(row["per_word"], row["n_words"]), from_planes(row["parts"], row["n_parts"])
        values = _gather(values, starts[parts], lengths[parts])
        word_ends = np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])
        part_ends = np.concatenate([[0], np.cumsum(lengths[parts])])
        starts, lengths = part_ends[word_ends[:-1]], np.diff(part_ends[word_ends])
        ends = np.cumsum(np.asarray(row["words"], np.int64))
        numbers = from_planes(row["numbers"], int(ends[-1]))
        tables = []
        a = 0
        for k in range(0, len(row["ids"]), 512):
            part = slice(k, min(k + 512, len(row["ids"])))
            b = int(ends[part.stop - 1])
            n = numbers[a:b]
            ids = _gather(values, starts[n], lengths[n])
            offsets = np.concatenate([[0], np.cumsum(lengths[n])])[np.concatenate([[a], ends[part]]) - a].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
            counts = np.diff(offsets).astype(np.int64)
            cols = [pa.array(row["ids"][part], pa.int64()), pa.array(counts), lists]
            if decoded:
                cols.append(pa.array(map(digest, decode_batch(lists, model)), pa.string()))
            tables.append(pa.Table.from_arrays(cols, schema=out))
            a = b
        return pa.concat_tables(tables)

    def run(block: pa.Table, dictionary: pa.Table) -> pa.Table:
        out = joined(block, dictionary)
        give_back()
        return out

    codes = _blocks(docs, pieces, units=False)
    return codes.groupBy("of").cogroup(coded.groupBy("block")).applyInArrow(run, "doc_id bigint, n_ids bigint, ids array<int>" + (", decoded_sha256 string" if decoded else ""))


def decode_ids(ids: list[int], pieces: Pieces) -> str:
    """The text of ids: pieces joined, byte pieces read as UTF-8 (what is not becomes the replacement sign), blank signs as blanks, the dummy prefix gone."""
    byte_of = pieces.__dict__.setdefault("_byte_of", {i: b for b, i in pieces.byte_ids.items()})
    text = pieces.text
    if byte_of.keys().isdisjoint(ids):
        out = "".join([text[i] for i in ids])
    else:
        parts: list[str] = []
        run = bytearray()
        for i in ids:
            if i in byte_of:
                run.append(byte_of[i])
                continue
            if run:
                parts.append(run.decode("utf-8", "replace"))
                run.clear()
            parts.append(text[i])
        parts.append(run.decode("utf-8", "replace"))
        out = "".join(parts)
    out = out.replace(BLANK, " ")
    return out[1:] if out[:1] == " " else out


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def decode_batch(ids: pa.ListArray, pieces: Pieces) -> list[str | None]:
    """The texts of a batch: pieces joined by Arrow, ids of bytes one text at a time."""
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(ids), 0), np.int64)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.asarray(ids.flatten(), np.int64)
    cache = pieces.__dict__
    names = cache.setdefault("_names", pa.array(pieces.text, pa.large_string()))
    is_byte = cache.setdefault("_is_byte", np.isin(np.arange(len(pieces.text)), list(pieces.byte_ids.values())))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names.take(pa.array(flat))), pa.scalar("", pa.large_string()))
    texts = [t[1:] if t[:1] == " " else t for t in pc.replace_substring(joined, BLANK, " ").to_pylist()]
    bytes_before = np.concatenate([[0], np.cumsum(is_byte[flat])])[ends]
    for i in np.flatnonzero(np.diff(bytes_before)):
        texts[i] = decode_ids(flat[ends[i] : ends[i + 1]].tolist(), pieces)
    for i in np.flatnonzero(np.asarray(ids.is_null())) if ids.null_count else ():
        texts[i] = None
    return texts


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids decode to a null text."""
    held = encoded.sparkSession.sparkContext.broadcast(pieces)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decode_batch(batch.column(1), held.value), pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, text string")
