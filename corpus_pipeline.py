"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read back as the next one's docs. All but the last return the columns of `documents`.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from postlake.llm.bpe import byte_bpe
from postlake.llm.mixture import mix, repeated
from postlake.llm.quality import quality_rules
from postlake.llm.queries import MIX, domain_of_source, tokenizer_file
from postlake.llm.setjoin import near_duplicates_removed
from postlake.llm.units import substring_dedup
from postlake.session import stage

#: The budget of the mixture, as a percentage of the tokens that reach it.
BUDGET_PERCENT = 90


def rate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no quality rule."""
    return quality_rules(docs).where("kept").select(*docs.columns)


def thin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    return near_duplicates_removed(docs, k=5, percent=80).select(*docs.columns)


def cut(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines and passages that an earlier document has. A document of which no word is
    left goes; one that never had a word stays."""
    done = substring_dedup(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike("[^ \\t-\\r]")
    return done.where(~F.coalesce(emptied, F.lit(False))).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def balance(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights ask for, repeated where a source has two epochs."""
    chosen = mix(docs, domain_of_source(), BUDGET_PERCENT, MIX, epochs=2, seed=17)
    return repeated(chosen).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    encoded = byte_bpe(docs.select("doc_id", "lang", "source", "text"), *tokenizer_file())
    exact = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", exact.alias("exact"))


STAGES = [
    ("quality_rules", rate),
    ("ngram_jaccard_join", thin),
    ("substring_dedup", cut),
    ("source_mixture", balance),
    ("byte_bpe", encode),
]

#: Merges of byte pairs by rank are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
