"""Corpus preparation: language filter, exact and near copies, source mix, piece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result to the
shared scratch folder and reads it back as the next stage's input. All but the last return the
columns of their input. Stages keep whole rows, so other columns, clashing or not, pass through.

Defined cases: documents without letters are rejected by the first stage, null and empty texts
among them, and so are documents in which no labelled language is recognised; rows that repeat
are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import exact, jaccard, langid, mixing, pieces
from tallybook.session import materialize, small_batches

#: Parts that an encoding task remembers. Its worker has a heap beside it that earlier stages filled.
MEMORY_PARTS = 30_000


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; filters are fitted on the documents' own labels."""
    small_batches(spark)
    return langid.known_texts(docs, langid.fit(docs.select("doc_id", "text", "lang")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked near copies, the document with the smallest id."""
    small_batches(spark)
    return jaccard.one_of_each_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights take them."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, piece_ids and the text they decode to."""
    small_batches(spark)
    chosen = docs.select("doc_id", "lang", "source", "text")
    return pieces.encode_texts(chosen, public_tokenizers.path("piece_bpe_32k.model"), memory_parts=MEMORY_PARTS)


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("shingle_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("piece_codec", encode_pieces),
]

#: The language filters and piece vocabularies can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
