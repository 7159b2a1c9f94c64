"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import format_chats, learned_text, read_turns
from .collocations import mine_collocations
from .common import table, tokenizer_path
from .cross_polytope import nearest
from .fingerprint import fingerprint
from .hard_negatives import mine
from .jaccard_join import jaccard_components
from .licenses import scan_licenses
from .mixing import mix
from .oracle import ORACLE_SQL  # noqa: F401
from .pii import find
from .resampling import resample_scores
from .sampled_segmentation import sample_segmentations
from .suffix_dedup import remove_repeats
from .token_files import write_and_read

# Conversation -7 holds control strings of the template as plain text.
_PROBE = "\\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_PROBE).alias("text"))
    chats = format_chats(turns.unionByName(probe))
    read = chats.withColumn("read", read_turns(F.col("formatted"))).withColumn(
        "learned", learned_text(F.col("formatted"), F.col("loss")))
    digest = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_merged"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_sampled_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_segmentations(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_and_read(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        "n_repeated_marks")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                        "spans", F.regexp_count("spans", F.lit("secret:")).cast("long").alias("n_secret"),
                        F.regexp_count("spans", F.lit("[a-z]+:")).cast("long").alias("n_spans"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    return mine(table(spark, sf_dir, "embeddings"), vec_id % 50 == 0,
                F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance_resampling": op1_importance_resampling,
    "op2_cross_polytope": op2_cross_polytope,
    "op3_sampled_segmentation": op3_sampled_segmentation,
    "op4_fingerprints": op4_fingerprints,
    "op5_token_files": op5_token_files,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_pii": op8_pii,
    "op9_chat_format": op9_chat_format,
    "op10_source_mix": op10_source_mix,
    "op11_license_scan": op11_license_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}

