"""Corpus pipeline: toxicity, near duplicates, benchmark passages, personal data, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame on what the last one kept. All but the
last return the columns of ``documents``. Null and empty texts stay unless they are duplicates of each
other; columns beyond those of the table pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilframe.llm import decontam, packing, pii, simhash, toxicity
from perilframe.llm.common import fresh, staged
from perilframe.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below one half."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), toxicity.learnable())
    [name] = fresh(docs, "toxicity")
    return toxicity.scored(docs, model, name=name).where(F.col(f"{name}.score") < 0.5).drop(name)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest id, the first where ids repeat."""
    return simhash.deduplicated(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    [name] = fresh(docs, "matches")
    found = decontam.with_matches(docs, _table(spark, sf_dir, "benchmark"), name=name)
    return found.where(F.size(name) == 0).drop(name)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows the text."""
    found = pii.detect(docs)
    changed = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast(docs.schema["n_chars"].dataType)}
    return found.withColumns(changed).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("benchmark", remove_benchmark),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet into the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs


#: Models, fingerprints and token ids are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
