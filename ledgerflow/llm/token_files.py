"""Token ids in bit-plane shuffled files.

Texts are encoded with a given tokenizer and end in an end id. The ids, as
little-endian unsigned 32-bit integers in ascending doc_id order, are cut into
blocks of a fixed number of ids; each block is transposed into byte planes (or
bit planes) and every plane compressed with zstandard. A block row also holds
the index: shard, block number, first id, number of ids and the documents'
places. The files are Parquet, written and read by Spark's own readers, so
they can lie in any store.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import shuffle_width

BLOCK_IDS = 65_536
END_ID = 1
#: Words whose ids a worker remembers (about 200 bytes each).
CACHED_WORDS = 700_000
#: Words encoded in one call.
CALL_WORDS = 512

_PLACE = pa.struct([("doc_no", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("whole", pa.bool_())])
_BLOCK = pa.schema(
    [("shard", pa.int32()), ("block", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("planes", pa.list_(pa.binary())), ("places", pa.list_(_PLACE))]
)
BLOCK_SCHEMA = (
    "shard int, block bigint, first_id bigint, n_ids bigint, planes array<binary>, "
    "places array<struct<doc_no:bigint,doc_id:bigint,start:bigint,at:bigint,n:bigint,whole:boolean>>"
)


def to_planes(ids: np.ndarray, unit: str = "byte", level: int = 1) -> list[bytes]:
    """Transpose a block of uint32 ids into 4 byte planes or 32 bit planes, each compressed."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == "bit":
        planes = [np.packbits(p) for p in np.unpackbits(raw, axis=1, bitorder="little").T]
    else:
        planes = [np.ascontiguousarray(p) for p in raw.T]
    pack = zstandard.ZstdCompressor(level=level)
    return [pack.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor()
    size = n if len(planes) == 4 else (n + 7) // 8
    rows = [np.frombuffer(unpack.decompress(p, max_output_size=size), np.uint8) for p in planes]
    if len(planes) == 32:
        bits = np.stack([np.unpackbits(p, count=n) for p in rows], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")
    return np.ascontiguousarray(np.stack(rows, axis=1)).reshape(-1).view("<u4")


#: The cutting pattern of tokenizer files of this kind, and the same for lower-cased Latin-1 text, all classes spelled out.
CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN_CUTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_BEYOND_LATIN = re.compile(r"[^\x00-\xff]")


class WordEncoder:
    """Encodes texts; words that come again are looked up.

    For tokenizer files that lower-case, cut with CUT_PATTERN and merge within
    cuts, the ids of a text are those of its cuts one after the other, and the
    cuts of Latin-1 text are found here. Texts beyond Latin-1 or with a
    special token in them, and other tokenizers, are left to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        self.by_word = cuts_by_pattern(config)
        self.special = [t["content"] for t in config.get("added_tokens", [])]
        self.words = Tokenizer.from_file(path)
        if self.by_word:  # words come lower-cased and cut
            self.words.normalizer = None
            self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def cuts(self, text: str) -> list[str] | None:
        if not self.by_word or _BEYOND_LATIN.search(text) or any(t in text for t in self.special):
            return None
        return _LATIN_CUTS.findall(text.lower())

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words, many to a call, told apart by the cut each id belongs to."""
        out = {}
        for i in range(0, len(words), CALL_WORDS):
            part = words[i : i + CALL_WORDS]
            got = self.words.encode(" ".join(part), add_special_tokens=False)
            data = np.asarray(got.ids, "<u4").tobytes()
            at = (4 * np.searchsorted(np.asarray(got.word_ids, np.int64), np.arange(len(part) + 1))).tolist()
            out.update((w, data[a:b]) for w, a, b in zip(part, at, at[1:], strict=False))
        return out

    def batch(self, texts: list[str | None]) -> list[bytes]:
        known = self.known
        split = [self.cuts(t) if t else [] for t in texts]
        found = [None if words is None else list(map(known.get, words)) for words in split]
        missed = {w for words, ids in zip(split, found, strict=True) if ids and None in ids for w, i in zip(words, ids, strict=True) if i is None}
        fresh = self.learn(list(missed))
        if len(known) + len(fresh) <= CACHED_WORDS:
            known.update(fresh)
        out = []
        for text, words, ids in zip(texts, split, found, strict=True):
            if ids is None:
                out.append(self.whole(text))
            else:
                out.append(b"".join([fresh[w] if i is None else i for w, i in zip(words, ids, strict=True)] if None in ids else ids))
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file, so that later tasks find the words of earlier ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cuts_by_pattern(config: dict) -> bool:
    """True for a tokenizer file whose normalizer and cuts are those that ``WordEncoder.cuts`` does for Latin-1 text."""
    steps = [n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", [])]
    cuts = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and cuts[0].get("pattern") == {"Regex": CUT_PATTERN}
        and cuts[0].get("behavior") == "Removed"
        and cuts[0].get("invert") is True
        and [c.get("type") for c in cuts[1:]] == ["ByteLevel"]
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in config.get("added_tokens", []))
    )


def encode_blocks(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS, unit: str = "byte") -> DataFrame:
    """Blocks of the ids of all documents in ascending doc_id order, one shard per range of ids.

    Needs doc_id and text; other columns are ignored. A null or empty text
    has the end id alone; a null doc_id comes first; rows that repeat a
    doc_id stay apart. A text of any length is encoded whole and may span
    blocks. An empty table gives no blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = encoder(tokenizer_path), np.asarray([end_id], "<u4").tobytes()
        held, size, places, block, first, doc_no, shard = [], 0, [], 0, 0, 0, None

        def cut(last: bool) -> Iterator[dict]:
            """Full blocks of what is held; at the end the rest, too."""
            nonlocal held, size, places, block, first
            data = b"".join(held)
            at = 0
            while size - at >= block_ids or (last and size > at):
                n = min(block_ids, size - at)
                inside = []
                while places and places[0]["start"] < first + n:
                    p = places[0]
                    stop = p["start"] + p["n"]
                    a, b = max(p["start"], first), min(stop, first + n)
                    inside.append({**p, "at": a - first, "n": b - a, "whole": b - a == p["n"]})
                    if stop > first + n:
                        break
                    places.pop(0)
                ids = np.frombuffer(data, "<u4", n, 4 * at)
                yield {"shard": shard, "block": block, "first_id": first, "n_ids": n, "planes": to_planes(ids, unit), "places": inside}
                at, block, first = at + n, block + 1, first + n
            held, size = [data[4 * at :]], size - at

        start = 0
        for batch in batches:
            ids, texts, shards = (batch.column(k).to_pylist() for k in range(3))
            shard = shards[0] if shards else shard
            for a in range(0, len(texts), 256):
                for doc_id, got in zip(ids[a : a + 256], words.batch(texts[a : a + 256]), strict=True):
                    n = len(got) // 4 + 1
                    held += [got, end]
                    size += n
                    places.append({"doc_no": doc_no, "doc_id": doc_id, "start": start, "n": n})
                    doc_no, start = doc_no + 1, start + n
                if size >= block_ids:
                    for row in cut(False):
                        yield pa.RecordBatch.from_pylist([row], _BLOCK)
        for row in cut(True):
            yield pa.RecordBatch.from_pylist([row], _BLOCK)

    spark = docs.sparkSession
    shards = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shuffle_width(spark), "doc_id").sortWithinPartitions("doc_id")
    return shards.withColumn("shard", F.spark_partition_id()).mapInArrow(run, BLOCK_SCHEMA)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, **options) -> None:
    """Write ``path``/blocks (the planes) and ``path``/index (the same rows without planes, and each shard's first id)."""
    encode_blocks(docs, tokenizer_path, **options).write.parquet(f"{path}/blocks")
    spark = docs.sparkSession
    index = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").select("shard", "block", "first_id", "n_ids", F.transform("planes", lambda p: F.octet_length(p)).alias("plane_bytes"))
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("ids"))  # one row per shard: few
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")).alias("shard_start"))
    index.join(starts, "shard").write.parquet(f"{path}/index")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: (shard, doc_no, doc_id, start, seq, n, whole, ids) per document and block it lies in."""
    out = pa.schema([("shard", pa.int32()), ("doc_no", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("seq", pa.int64()), ("n", pa.int64()), ("whole", pa.bool_()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = from_planes(row["planes"], row["n_ids"]).tobytes()
                rows = []
                for p in row["places"]:
                    ids = data[4 * p["at"] : 4 * (p["at"] + p["n"])]
                    rows.append({"shard": row["shard"], "seq": row["block"], "ids_crc32": zlib.crc32(ids), "ids": None if p["whole"] else ids, **{k: p[k] for k in ("doc_no", "doc_id", "start", "n", "whole")}})
                yield pa.RecordBatch.from_pylist(rows, out)

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, "shard int, doc_no bigint, doc_id bigint, start bigint, seq bigint, n bigint, whole boolean, ids_crc32 bigint, ids binary")


def id_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of all its ids)."""
    starts = spark.read.parquet(f"{path}/index").select("shard", "shard_start").distinct()  # one row per shard
    pieces = F.array_sort(F.collect_list(F.when(~F.col("whole"), F.struct("seq", "ids"))))
    joined = F.aggregate(pieces, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    docs = read_ids(spark, path).groupBy("shard", "doc_no").agg(
        F.min("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.sum("n").alias("n_tokens"),
        F.max(F.when(F.col("whole"), F.col("ids_crc32"))).alias("crc"),
        joined.alias("joined"),
    )
    return docs.join(starts, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("start")).alias("start"), "n_tokens", F.coalesce("crc", F.crc32("joined")).alias("ids_crc32")
    )
