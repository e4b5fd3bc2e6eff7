"""The registered queries of this subpackage, over whole tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm import (
    chats,
    collocations,
    html_text,
    languages,
    manifest,
    minhash,
    mixing,
    nearest,
    pieces,
    quality,
    simhash,
    substrings,
    token_counts,
)

TOKEN_LIMIT = 2048
# The columns of a document that its leaf covers.
MANIFEST = ["doc_id", "source", "lang", "n_chars", "text"]

# The mix: documents have no domain of their own, so one is told from the last digit of the source's name.
MIX_LEVELS_SQL = {
    "domain": "CASE WHEN right(source, 1) IN ('0', '1', '2', '3', '4') THEN 'web' ELSE 'reference' END",
    "lang": "lang",
    "source": "source",
}
MIX = {
    "weights": {"domain": {"web": 3, "reference": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}},
    "share": (3, 5),
    "epochs": 2,
    "seed": 20240501,
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removals(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.over_limit(token_counts.token_counts(_table(spark, sf_dir, "documents"), path), TOKEN_LIMIT)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encoded(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", *pieces.digests())


def op5_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.rendered(_table(spark, sf_dir, "conversations"))


def mix(docs: DataFrame) -> DataFrame:
    return mixing.mixed(docs, {name: F.expr(sql) for name, sql in MIX_LEVELS_SQL.items()}, **MIX)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs).select("row.doc_id", *MIX_LEVELS_SQL, "n_tokens", "epoch")


def op7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = languages.learned(docs.where(fold != 1))
    docs = docs.select("doc_id", "text", F.coalesce(fold == 1, F.lit(False)).alias("held_out"))
    return languages.predicted(docs, model, ["doc_id", "held_out"])


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf_dir, "pages"), ["page_id", "url"])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(_table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = minhash.edited_likeness(_table(spark, sf_dir, "documents"))
    digest = F.sha2("edited", 256).alias("edited_sha256")
    return rows.select(
        "doc_id", "n_chars", digest, "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(_table(spark, sf_dir, "documents"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    # What a reader of the row would hash: half of the rows have lost the line ends of their text.
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(changed, F.translate("text", "\n", "")).otherwise(F.col("text"))
    seen = manifest.leaf([text if name == "text" else F.col(name) for name in MANIFEST])
    rows = manifest.manifest(docs, MANIFEST, {"doc_id": F.col("doc_id"), "seen": seen})
    rows = rows.withColumn("folded", manifest.folded(F.col("seen"), "path"))
    digests = [manifest.hexed(name).alias(name) for name in ("leaf", "subroot", "root")]
    ends = [manifest.hexed("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified")]
    return rows.select("doc_id", *digests, manifest.proof("path").alias("proof_sha256"), *ends)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_substrings": op2_substrings,
    "op3_token_counts": op3_token_counts,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_chats": op5_chats,
    "op6_mixing": op6_mixing,
    "op7_languages": op7_languages,
    "op8_main_text": op8_main_text,
    "op9_quality_rules": op9_quality_rules,
    "op10_fingerprints": op10_fingerprints,
    "op11_collocations": op11_collocations,
    "op12_nearest": op12_nearest,
    "op13_manifest": op13_manifest,
}

ORACLES: dict[str, str] = {
    "op2_substrings": substrings.ORACLE,
    "op5_chats": chats.ORACLE,
    "op6_mixing": mixing.oracle(MIX_LEVELS_SQL, **MIX),
    "op9_quality_rules": quality.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_nearest": nearest.ORACLE,
    "op13_manifest": manifest.ORACLE,
}
