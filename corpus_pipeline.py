"""A training corpus from raw documents: five stages, each one operator of ``ledgerflow.llm``.

Every stage takes all that its predecessor kept, read back from Parquet, and
its decisions take effect: rejected languages, copies and near copies go, the
mix drops or repeats documents, and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import exact_dedup, language_id, minhash, mixing, piece_lattice
from ledgerflow.llm.catalog import tokenizer_path
from ledgerflow.llm.common import stage, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus has labels for; the rest, and texts without a letter, go."""
    models = language_id.train_on(docs)
    rows = docs.select(F.struct("*").alias("row"), "text")
    return language_id.identify(rows, models).filter("not rejected").select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity 0.8)."""
    return minhash.keep_first(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids and ids of every document, and the digest of the text that the ids decode to."""
    pieces = piece_lattice.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    return piece_lattice.encode(docs, pieces, decoded=True)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Kneser-Ney models, MinHash candidates and merge folds are not expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; between two the rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
