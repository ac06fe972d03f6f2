"""The corpus pipeline: toxicity, quality, near-duplicates, mixing of sources, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; its result is written as Parquet and read
again as the next stage's input. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import mixing, quality, sentencepiece_stream, simhash, toxicity
from skyloom.llm.work import stored, table

# Rows of texts that Spark hands to a Python worker at once: 10,000 (its default) are a whole partition of 30 MB, held
# by the executor and by the worker beside a heap that earlier stages have filled.
ARROW_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Sets the rows of an Arrow batch to ``ARROW_ROWS`` for the session, unless they are fewer already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the cut."""
    short_batches(spark)
    return toxicity.kept(docs, table(spark, sf_dir, "labels"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of quality."""
    short_batches(spark)
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id."""
    short_batches(spark)
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the SentencePiece ids of every document."""
    short_batches(spark)
    return sentencepiece_stream.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), known_words=KNOWN_WORDS)


# Words kept by the last stage's workers, fixed value: they run beside an executor's heap that four stages have filled.
KNOWN_WORDS = 25_000

STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# The classifiers and the encoder cannot be expressed in SQL; tests compare the run with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stage's result stored before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
