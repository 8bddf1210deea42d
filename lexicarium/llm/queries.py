"""Registered queries of the operators, with production parameters, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicarium.llm import alignment, bpe, decontaminate, jaccard_join, language_id, line_dedup, lm_score, packing, periodic_runs, quality, sharding, toxicity, warc
from lexicarium.llm.store import new_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, RANKS).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_join(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_corpus(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.apply_quality(docs, PIECES, RANKS, without_text=True).drop("lang")


#: Arrivals of op7: shares of the range of ids, so that shards of several sizes meet in the table.
ARRIVALS = (0.5, 0.75, 0.875, 0.9375)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    table = sharding.ShardedTable(spark, new_path(spark, "shards"))
    ends = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = ends.low or 0, ends.high or 0
    cuts = [int(low + (high - low + 1) * share) for share in ARRIVALS]
    place = F.col("doc_id")
    for k in range(len(cuts) + 1):  # every row is in one arrival, rows without an id in the first
        after = place >= cuts[k - 1] if k else F.coalesce(place < cuts[0], F.lit(True))
        table.append(docs.where(after & (place < cuts[k]) if 0 < k < len(cuts) else after))
    version = table.compact(docs.schema)
    rows = table.read(docs.schema)
    return rows.select("doc_id", "n_chars", F.col("_metadata.file_name").alias("shard"), F.col("_metadata.file_size").alias("shard_bytes"), F.lit(version).cast("long").alias("version"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    return toxicity.score_documents(docs, labels).select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = periodic_runs.find_runs(docs.select("doc_id", "text"), periodic_runs.planted_text(F.col("doc_id"), F.col("text")))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best_run.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best_run.length div best_run.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), WORDS)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents").select("doc_id", "text"), BYTES, PIECES)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_bpe": op3_bpe,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_lm_score": op5_lm_score,
    "op6_quality": op6_quality,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_line_dedup": op10_line_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_packing": op12_packing,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL = {
    "op9_warc": """
WITH k AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS best FROM k WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, k.payload_digest,
       CASE WHEN best IS NULL OR best = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN best <> page_id THEN best END AS refers_to
FROM k LEFT JOIN g ON k.payload_digest = g.payload_digest AND payload_bytes >= 1000""",
    "op2_decontamination": r"""
WITH iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
isx AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM iw WHERE len(w) >= 5),
dsx AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM dw WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS n_item_shingles FROM isx GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_matched FROM isx JOIN dsx USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item_shingles, n_matched, n_matched / n_item_shingles AS containment
FROM m JOIN n USING (item_id) WHERE n_matched >= 0.8 * n_item_shingles""",
    "op10_line_dedup": r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, unnest(range(0, len(ls) - 2)) AS pos, ls FROM l WHERE len(ls) >= 3),
x AS (SELECT doc_id, pos, ls[pos + 1] AS a, ls[pos + 2] AS b, ls[pos + 3] AS c FROM w),
y AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS k FROM x WHERE trim(a) <> '' OR trim(b) <> '' OR trim(c) <> ''),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 3)) AS pos FROM y WHERE k > 1),
e AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS pos FROM l),
k AS (SELECT e.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed, coalesce(string_agg(CASE WHEN g.pos IS NULL THEN e.line END, chr(10) ORDER BY e.pos), '') AS text
      FROM e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos GROUP BY e.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(text) AS text_sha256 FROM k""",
}
