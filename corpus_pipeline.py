"""A training-data pipeline: each stage works on what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netpulse.llm import bpe, mixing, simhash, substrings, toxicity
from netpulse.llm.common import stored
from netpulse.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash links stays."""
    return simhash.deduplicate(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut; n_chars follows the text."""
    cut = substrings.deduplicated(docs)
    names = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return cut.withColumns(names).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; the text stays to check the decoded bytes against."""
    path = public_tokenizers.path(VOCABULARY)
    both = bpe.encoded_and_decoded(docs, path, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    n = F.expr("cast(octet_length(ids) / 4 as bigint)")
    return both.select(*docs.columns, "ids", n.alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("substrings", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The stages train a classifier, link components and hash with functions that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
