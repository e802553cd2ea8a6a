"""The operators as named queries over the given tables, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilframe.llm import (
    decontam,
    infill,
    langid,
    packing,
    periods,
    pii,
    quality,
    repeats,
    simhash,
    spans,
    toxicity,
    trust,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of whole texts: fingerprint and component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.hex_print().alias("fingerprint"), "component_id"
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written into WARC archives and read back."""
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts without any 200 bytes that start anywhere else, as counts and a digest."""
    found = repeats.removals(_table(spark, sf_dir, "documents"))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", lost.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in whole texts: counts, digest of the base spans and all spans."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.detect(docs).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of whole texts and the verdict of the weighed rules."""
    found = quality.assess(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *quality.MEASURES, "base_failed", "kept", "quality")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of whole texts, learnt from three of four documents."""
    found = langid.assess(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in whole documents, one row per document and item."""
    return decontam.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without sentences of repeated runs, as counts and a digest of what is kept."""
    found = spans.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_sentences", "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of whole texts, learnt from four of five labelled documents, with evidence."""
    return toxicity.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of whole texts, learnt from trusted good ones and unlabelled ones."""
    return trust.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of whole texts: the longest, and digests of all and of what is kept."""
    found = periods.collapse(_table(spark, sf_dir, "documents"), order=periods.echoed)
    ahead = lambda a, b: F.when(a["length"] >= b["length"], a).otherwise(b)
    first = F.get("runs", F.lit(0))
    longest = F.aggregate("runs", first, ahead)  # runs are in order, so the first of equal ones stays
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"), F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).cast("long").alias("exponent_milli"),
        periods.runs_digest().alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts rearranged for filling in the middle, and restored from that."""
    made = infill.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(infill.restored().cast("binary"), 256).alias("restored_sha256"))


def vocabulary() -> str:
    """Where the public tokenizers keep the vocabulary that the packed ids come from."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary())


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_warc": op2_warc,
    "op3_repeats": op3_repeats,
    "op4_pii": op4_pii,
    "op5_quality": op5_quality,
    "op6_langid": op6_langid,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_spans": op9_spans,
    "op10_toxicity": op10_toxicity,
    "op11_trust": op11_trust,
    "op12_periods": op12_periods,
    "op13_infill": op13_infill,
}
ORACLE_SQL: dict[str, str] = {
    "op2_warc": warc.SQL,
    "op9_spans": spans.SQL,
    "op13_infill": infill.SQL,
}
