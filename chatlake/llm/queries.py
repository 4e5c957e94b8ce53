"""One query for each operator, over its whole table, in the columns that were agreed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from chatlake.llm.common import read_table


def op1_winnowing(spark, folder):
    from chatlake.llm.winnowing import fingerprints_with_edits

    return fingerprints_with_edits(read_table(spark, folder, "documents"))


def op2_token_counts(spark, folder):
    from chatlake.llm.token_counts import token_counts

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts(read_table(spark, folder, "documents"), path)


def op3_pq(spark, folder):
    from chatlake.llm.pq import near_duplicates

    return near_duplicates(read_table(spark, folder, "embeddings"))


def op4_simhash(spark, folder):
    from chatlake.llm.simhash import near_duplicates

    found = near_duplicates(read_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), "component_id")


def op5_packing(spark, folder):
    from chatlake.llm.packing import packed_documents

    path = public_tokenizers.path("byte_bpe_50k.json")
    return packed_documents(read_table(spark, folder, "documents"), path)


def op6_quality(spark, folder):
    from chatlake.llm.quality import judged

    return judged(read_table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "score", "kept")


def op7_host_trust(spark, folder):
    from chatlake.llm.host_trust import filtered_urls

    return filtered_urls(read_table(spark, folder, "pages"))


def op8_hilbert(spark, folder):
    from chatlake.llm.hilbert import hilbert_shards

    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = read_table(spark, folder, "documents").select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col("source").cast("string"),
        F.col("lang").cast("string"),
    )
    return hilbert_shards(rows, ["source", "lang", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op9_suffix_dedup(spark, folder):
    from chatlake.llm.suffix_dedup import deduplicated

    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_mixing(spark, folder):
    from chatlake.llm.mixing import mix

    return mix(read_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_whitening_of(vectors):
    from chatlake.llm.whitening import whitened

    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("_at", "_")
    return whitened(vectors).select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("_at") + 1).alias("component"), "n", "deviation", "_.whitened", "_.explained", "identity_error"
    )


def op11_whitening(spark, folder):
    return op11_whitening_of(read_table(spark, folder, "embeddings"))


def op12_nnls_packing(spark, folder):
    from chatlake.llm.histogram_packing import packed_windows

    path = public_tokenizers.path("word_bpe_49k.json")
    found = packed_windows(read_table(spark, folder, "documents"), path)
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_alignment_of(docs):
    from chatlake.llm.alignment import alignments

    found = alignments(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op13_alignment(spark, folder):
    return op13_alignment_of(read_table(spark, folder, "documents"))


LLM_QUERIES = {
    "op1_winnowing": op1_winnowing,
    "op2_token_counts": op2_token_counts,
    "op3_pq": op3_pq,
    "op4_simhash": op4_simhash,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_host_trust": op7_host_trust,
    "op8_hilbert": op8_hilbert,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_nnls_packing": op12_nnls_packing,
    "op13_alignment": op13_alignment,
}

#: Every pair of a label by its cosine, and what can be reached over the links.
_COSINES = """
WITH RECURSIVE entries AS (
  SELECT row_number() OVER () AS row, vec_id, label,
    CASE WHEN len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      THEN embedding::DOUBLE[] END AS e
  FROM embeddings
),
usable AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM entries
  WHERE label IS NOT NULL AND len(e) > 0 AND list_dot_product(e, e) > 0
),
links AS (
  SELECT a.row AS x, b.row AS y FROM usable a JOIN usable b
  ON a.label = b.label AND a.row <> b.row AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
),
reached AS (
  SELECT row AS node, row AS start FROM entries
  UNION
  SELECT links.y, reached.start FROM reached JOIN links ON links.x = reached.node
),
least AS (
  SELECT reached.start AS row, min(entries.vec_id) AS component_id
  FROM reached JOIN entries ON entries.row = reached.node GROUP BY reached.start
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.x = entries.row) AS n_links, component_id,
  vec_id = component_id AS kept
FROM entries JOIN least USING (row)"""

#: SQL for the queries that it can express on whole tables.
LLM_ORACLE: dict[str, str] = {"op3_pq": _COSINES}
