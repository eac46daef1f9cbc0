"""Registered queries of this subpackage: each applies one operator with its
production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import decontaminate, divergence, hamming, language, licenses, lines, mixing, pii, resample, simhash, tokens, toxicity, webarchive
from cadence.llm.common import prepared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised ones included."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and checksum, and all spans."""
    return pii.digest(pii.sanitised(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with fingerprint and near-duplicate class."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), simhash.SHINGLE, simhash.MAX_BITS)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, learnt from the labels outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.scored(docs, model)


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in the token files."""
    import public_tokenizers

    return tokens.tokenised(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule of documents that mixes the sources to the target entropy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    plan = mixing.schedule(docs, mixing.weights(docs, mixing.ENTROPY, mixing.MAX_REPEAT), mixing.SEED)
    return plan.select("row.doc_id", F.coalesce("row.source", F.lit("")).alias("source"), "epoch", "block_rank", "n_tokens")


def op9_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    return hamming.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, hamming.K)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, those of recurring templates dropped, and what is left."""
    found = lines.deduplicated(table(spark, sf_dir, "documents"), lines.MIN_DOCS)
    return found.select("doc_id", "n_lines", "n_dropped", F.md5(F.col("kept").cast("binary")).alias("kept_md5"))


def op8_webarchive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion record of every page's response."""
    made = webarchive.derivatives(webarchive.responses(table(spark, sf_dir, "pages")))
    return made.withColumn("block", F.decode("block", "UTF-8"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language from text, markup, address and host together."""
    model = language.train(table(spark, sf_dir, "documents"))
    return language.identified(table(spark, sf_dir, "pages"), model)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's n-gram weight towards the benchmark, its noisy score, and its rank if drawn."""
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of every language are apart, and the terms each of them raises."""
    return divergence.audited(table(spark, sf_dir, "documents"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases and the licenses whose whole wording stands in it."""
    return licenses.digest(licenses.scanned(table(spark, sf_dir, "documents")))


QUERIES = {
    "op7_lines": op7_lines,
    "op8_webarchive": op8_webarchive,
    "op10_language": op10_language,
    "op9_hamming": op9_hamming,
    "op2_pii": op2_pii,
    "op4_mixing": op4_mixing,
    "op6_tokens": op6_tokens,
    "op1_decontaminate": op1_decontaminate,
    "op5_toxicity": op5_toxicity,
    "op3_simhash": op3_simhash,
    "op11_licenses": op11_licenses,
    "op12_resample": op12_resample,
    "op13_divergence": op13_divergence,
}

ORACLE: dict[str, str] = {"op4_mixing": mixing.sql(), "op7_lines": lines.SQL, "op11_licenses": licenses.SQL, "op12_resample": resample.SQL, "op13_divergence": divergence.SQL}
