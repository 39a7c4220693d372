"""The training-data pipeline: STAGES over `documents`, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a frame; all but the last keep the
columns of documents, further ones and clashing names included.  The last encodes the
documents and checks by decoding that every text comes back.

NULL and empty texts are of no language, so the first stage drops them; given to a later
stage they are equal texts, near to nothing, not contaminated, and have no tokens.  Of
repeated rows exact dedup keeps one.  NULL ids are ids like others, the least ones.  An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm import bpe, contamination, exact_dedup, language_crf, near_dedup
from basketry.llm.common import ROW, pinned, ship, stored, table, with_row_id
from basketry.llm.graph import only_rows

LEAST_CONFIDENCE = 0.5  # mean probability of the words' own languages


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts whose words are of no learned language.

    A text may switch between languages: its words are judged by their own labels.
    Without a labelled text nothing is learned, and all documents stay.
    """
    docs = pinned(docs)
    field = language_crf.fitted(docs)
    if field is None:
        return docs
    found = language_crf.identified(docs, field)
    kept = found.where((F.col("lang_pred") != "und") & (F.col("confidence") >= LEAST_CONFIDENCE))
    return only_rows(docs, kept)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of texts with five-word shingles of similarity 0.8 or more."""
    return near_dedup.deduplicated(docs, width=5, threshold=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a ten-word window of a benchmark item go."""
    return contamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): token ids, and whether decoding gives the text back."""
    from public_tokenizers import path

    vocabulary = bpe.Vocabulary(path("byte_bpe_50k.json"))
    docs = pinned(docs)
    coded = bpe.encode(docs, vocabulary)
    decoded = bpe.decode(coded, vocabulary).withColumn("_sha", F.sha2(F.encode("text", "UTF-8"), 256))
    source = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    texts = with_row_id(docs).select(ROW, source.alias("_source"))
    return decoded.join(texts, ROW).select(
        "doc_id", "n_tokens", "ids", (F.col("_sha") == F.col("_source")).alias("round_trip")
    )


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# Language identification and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
