"""From raw documents to token ids: the stages of a training corpus, each written and read again."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm import pieces, quality, simhash, substrings
from towerlens.llm.queries import mix
from towerlens.sources.workspace import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at two or fewer differing bits."""
    return simhash.one_of_each(docs, shingle=3, max_distance=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur more than once; ``n_chars`` follows the text."""
    return substrings.cleaned(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document stands there once for each epoch that takes it."""
    return mix(docs).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text they decode to."""
    rows = pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_quality),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", target_weights),
    ("sentencepiece", token_ids),
]

# The stages hash with XXH64 and segment with a given vocabulary, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
