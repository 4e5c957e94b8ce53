"""A training corpus in five stages: each takes what its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.llm.common import read_table, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects; the others keep all their columns."""
    from chatlake.llm.quality import judged

    # Packed, so that no column can have the name of one of the operator's.
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_document"))
    return judged(rows).filter("kept").select("_document.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of SimHash near-duplicates, with the operator's shingles and bit distance.

    Groups are of rows: of those that repeat an id each is judged by its own text. The row with the smallest id
    stays, a row without an id only if none of its group has one, and one of rows that are equal.
    """
    from chatlake.llm.simhash import near_duplicates

    # Stored, so that a row has the same number for every reader.
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("_document")))
    numbered = rows.select(F.col("row").alias("doc_id"), F.col("_document")["text"].alias("text"))
    found = near_duplicates(numbered).select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    own_id = F.col("_document")["doc_id"]
    ordered = rows.select("row", F.struct(own_id.isNull(), own_id.alias("doc_id"), "row").alias("order"))
    kept = ordered.join(found, "row").groupBy("group").agg(F.min("order").alias("first"))
    return rows.join(kept.select(F.col("first")["row"].alias("row")), "row", "left_semi").select("_document.*")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out byte strings that occur earlier; documents of which nothing is left go."""
    from chatlake.llm.suffix_dedup import deduplicated

    # Packed, so that no column can have the name of one of the operator's.
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_document"))
    rest = deduplicated(rows).filter("n_removed < n_bytes or n_bytes = 0")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("_document")["text"])
    new = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return rest.select(*[new[c].alias(c) if c in new else F.col("_document")[c].alias(c) for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a document taken in part once more as a whole."""
    from chatlake.llm.mixing import mix

    # Packed, so that no column can have the name of one of the operator's.
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_document"))
    found = mix(rows, keep=["_document"]).filter("taken > 0")
    copies = F.ceil(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    return found.select("_document", F.explode(F.sequence(F.lit(1), copies)).alias("_copy")).select("_document.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences of 2048 tokens."""
    from chatlake.llm.packing import packed_documents

    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_documents),
    ("simhash_near_dedup", one_of_each_group),
    ("suffix_array_dedup", without_repeats),
    ("source_mixing", mixed_sources),
    ("best_fit_packing", packed_sequences),
]

#: Trained scores, hashes and tokens are not expressible in SQL; tests/llm compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stored before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
