"""The registered queries: each applies one operator to its whole table.

The operators keep their own interfaces; a query here derives the columns of
its contract from the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import exact_dedup, language_id, lexical_search, minhash, mixing, piece_lattice, pii, sharding, token_files, toxicity, vector_codes, vector_graph, wrapper
from ledgerflow.llm.common import table
from ledgerflow.session import scratch_path


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies (the same place on every machine)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_pii(table(spark, sf_dir, "documents")))


def op2_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = language_id.train_on(docs)
    found = language_id.identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op5_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out()))
    scored = toxicity.score_texts(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"))
    return token_files.id_digests(spark, path)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = piece_lattice.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    return piece_lattice.encode(table(spark, sf_dir, "documents"), pieces, decoded=True)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(sharding.shard(table(spark, sf_dir, "documents"), scratch_path(spark, "shards")))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_wrapper,
        op3_mixing,
        op4_language_id,
        op5_vector_graph,
        op6_minhash,
        op7_toxicity,
        op8_token_files,
        op9_exact_dedup,
        op10_piece_lattice,
        op11_sharding,
        op12_lexical_search,
        op13_vector_codes,
    )
}


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain k-means over whole numbers, one step of the query per round."""
    steps = [
        f"""vectors AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
cut AS MATERIALIZED (
  SELECT r, p, list_slice(x, p * len(x) // {parts} + 1, (p + 1) * len(x) // {parts}) AS part FROM vectors, range({parts}) AS t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, part AS entry FROM cut WHERE r <= {entries})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""near{i} AS MATERIALIZED (
  SELECT r, p, min({{'d': d, 'e': e}}) AS best
  FROM (SELECT c.r, c.p, b.e, list_sum(list_transform(list_zip(c.part, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM cut c JOIN book{i} b ON c.p = b.p)
  GROUP BY r, p)"""
        )
        if i < rounds:
            steps.append(
                f"""book{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry
  FROM book{i} b LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS entry
    FROM (SELECT c.p, n.best.e AS e, pos, sum(c.part[pos])::BIGINT AS s, count(*) AS n
          FROM cut c JOIN near{i} n ON c.r = n.r AND c.p = n.p, range(1, len(c.part) + 1) AS t(pos) GROUP BY ALL)
    GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)"""
            )
    steps.append(
        f"""coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY r),
digest AS (
  SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})"""
    )
    return (
        "WITH "
        + ",\n".join(steps)
        + """
SELECT v.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY v.label))::BIGINT AS label_error, d.codebooks_sha256
FROM vectors v JOIN coded c ON v.r = c.r, digest d
"""
    )


ORACLE_SQL = {
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         length(coalesce(text, '')) AS chars,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
keyed AS (
  SELECT doc_id, source, size, -ln(u) / CASE WHEN chars::DOUBLE / greatest(size, 1) BETWEEN 3 AND 12 THEN 1.0 ELSE 0.5 END AS key FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM keyed GROUP BY source),
ranked AS (
  SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / w AS full_at FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
  FROM ranked WINDOW before AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT source, source_size, least(cap::DOUBLE, (SELECT arg_min(level, full_at) FROM levels WHERE level <= full_at) * w) AS target FROM levels),
plan AS (
  SELECT *, least(floor(target / greatest(source_size, 1)), 3)::BIGINT AS epochs FROM goal),
placed AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN rest > 0 AND before + size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
""",
    "op9_exact_dedup": r"""
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
grouped AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM norm n JOIN grouped g ON n.t = g.t
""",
    "op12_lexical_search": r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
lengths AS (SELECT r, doc_id, count(*) AS n FROM words GROUP BY r, doc_id),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
held AS (SELECT r, term, count(*) AS tf FROM words GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, totals GROUP BY term, n_docs),
scored AS (
  SELECT q.item_id, l.doc_id, l.r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM wanted q JOIN held h ON q.term = h.term JOIN weights s ON s.term = h.term JOIN lengths l ON l.r = h.r, totals
  GROUP BY q.item_id, l.doc_id, l.r)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
""",
    "op13_vector_codes": _codes_sql(),
}
