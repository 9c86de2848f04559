"""Corpus pipeline: five stages from raw documents to token-id files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of ``documents``; the last returns, for every document of
the mix, where its ids stand in the files and their checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlens.llm import decontam, langid, mixing, simhash, token_binary
from eventlens.llm.common import folder, ship, written
from eventlens.session import apply_runtime_defaults


def _ready(spark: SparkSession) -> None:
    apply_runtime_defaults(spark)
    ship(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, or far from every language for their length,
    belong to no language and go."""
    _ready(spark)
    labelled = langid.training_part(docs)
    model = langid.train(labelled)
    return langid.reject(docs, model, least=langid.least_scores(labelled, model))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 3-word SimHash neighbours (3 bits) stays."""
    _ready(spark)
    return simhash.dedup(docs, k=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    _ready(spark)
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    _ready(spark)
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the ids as range-coded files and reads them back."""
    import public_tokenizers

    _ready(spark)
    path = folder(spark, "pipeline-ids")
    return token_binary.read_ids(token_binary.write_ids(docs, path, public_tokenizers.path("byte_bpe_50k.json")), path)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix_sources),
    ("token-ID output", token_ids),
]
#: Hash vectors and fingerprints have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
