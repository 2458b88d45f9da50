"""A training-data pipeline over ``documents``: stages of the operators in ``parley.llm``.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame. ``run``
writes what a stage returns as Parquet in the shared staging folder and reads it
again as the next stage's ``docs``, so a lost executor costs a stage at most.

1. Toxicity: documents scored 0.5 or more by a model learnt from ``labels`` go.
2. Near duplicates: of each class the document with the smallest id stays.
3. Secrets: their spans are replaced in ``text``; ``n_chars`` follows. All documents stay.
4. Mixing: whole documents up to their source's target, repeated where it exceeds the source.
5. Encoding and decoding: ``ids`` of every text, end id included, and ``decoded``, the text that they give back.

Documents with null or empty text are neither toxic nor duplicates nor do they hold
secrets; they cost the mix nothing and stay once. Empty tables pass through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import dartminhash, mixing, pieces, secrets, toxicity
from parley.llm.common import table
from parley.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return dartminhash.keep_one_per_class(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    return secrets.redact_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix of sources, repeated where a source is taken more than once."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their texts and the texts of these ids."""
    model = pieces.default_model()
    return pieces.encode_documents(docs, model).withColumn("decoded", pieces.decode_ids(F.col("ids"), model))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing to target weights", mix_sources),
    ("sentencepiece encoding", encode),
]

#: Learned stages are not expressible in SQL; tests/llm/test_pipeline.py holds the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's documents."""
    docs = table(spark, sf_dir, "documents")
    for position, (_, step) in enumerate(STAGES):
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{position}")
    return docs
