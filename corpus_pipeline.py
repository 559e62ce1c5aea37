"""Documents to training tokens: toxicity filter, exact dedup, near dedup, decontamination, pieces.

Every stage works on all rows its predecessor kept. Stages but the last return
the columns of their input. A null text counts as empty: it is never toxic nor
contaminated, and equals other empty texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstlight.llm import decontam, exact_dedup, jaccard_join, sentencepieces, toxicity
from firstlight.llm.tables import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from labels that are not held out."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels.filter(~toxicity.held_out(labels))))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest ``doc_id`` stays."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at 0.8 on five-word shingles the smallest ``doc_id`` stays."""
    return jaccard_join.one_of_each(docs, width=5, threshold=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids, lossless``: merge-dropout pieces, checked by decoding them."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepieces.encode(docs, model, keep=["lang", "source"], checked=True)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("sentencepiece", to_pieces),
]

# Models and segmentations are beyond SQL; tests/llm compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
