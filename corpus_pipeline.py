"""The corpus pipeline: toxic documents go, one document of each near-duplicate
group stays, documents holding benchmark items go, sources are mixed to target
weights, and the rest is written as token ids.

Every stage takes (spark, docs, sf_dir), docs being what the one before kept;
all but the last return the columns of docs.  A stage's result is written as
Parquet in the shared scratch folder and read again, so lost executors never
cost more than a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadence.llm import decontaminate, mixing, simhash, tokens, toxicity
from cadence.llm.common import prepared, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of
    the documents it is given."""
    labels = prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(toxicity.labelled_sample(docs, labels))
    return toxicity.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (the smallest doc_id)."""
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or re-parameterised, go."""
    return decontaminate.clean(docs, prepared(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated until the mix reaches the target entropy or
    the repetition limit; no document goes."""
    return mixing.mixed(docs, mixing.ENTROPY, mixing.MAX_REPEAT).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' rows: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    return tokens.tokenised(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", token_ids),
]
#: The classifier and the tokeniser are not SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
