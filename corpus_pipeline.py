"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns what the next stage works on.
All but the last return the columns of ``documents``.  A stage's result is to be written before the next stage
is called, which drops what the one before it staged.  ``run`` writes each stage as Parquet in the shared folder and
reads it again, so a lost executor costs the work of one stage at most.

Stages hand texts to Python workers in batches of at most ``BATCH_BYTES`` (a setting of the session, lowered where it is
higher): a task holds several copies of a batch, in the JVM and in the worker.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import mixing, packing, pii, queries, simhash, toxicity
from tidewire.storage import drop, recorded, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes of a batch handed to a Python worker; one row more where a text crosses the bound.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: By application, what the last stage staged; its result reads it until it is written.
_LEFT: dict[str, list[str]] = {}


def _bound_batches(spark: SparkSession) -> None:
    """Lower the session's batch size; a result is computed after its stage has returned, so the setting stays."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_SETTING))
    if size > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")


def _cleaning(function: Stage) -> Stage:
    """Drops what the stage before left in the shared folder: its result is written once the next one starts."""

    @functools.wraps(function)
    def cleaned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _bound_batches(spark)
        application = spark.sparkContext.applicationId
        for path in _LEFT.pop(application, []):
            drop(spark, path)
        with recorded() as made:
            result = function(spark, docs, sf_dir)
        _LEFT[application] = made
        return result

    return cleaned


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on this stage's labelled rows, doesn't reject."""
    return toxicity.clean_documents(docs, toxicity.train(docs, queries.table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """One document of each group of texts whose SimHash fingerprints are linked: that with the smallest doc_id."""
    return simhash.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Personal data replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Documents as often, and as much of them, as the target weights take."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Sequences of power-of-two lengths with their ids."""
    return packing.pack(docs, queries.vocabulary())


STAGES = [
    ("toxicity", _cleaning(drop_toxic)),
    ("simhash near-dedup", _cleaning(drop_near_copies)),
    ("personal data", _cleaning(mask_personal_data)),
    ("source mixing", _cleaning(mix_sources)),
    ("packing", _cleaning(pack_sequences)),
]

#: SQL can't express the learned stages, the hashes and the tokenizer; tests compare with plain computations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
