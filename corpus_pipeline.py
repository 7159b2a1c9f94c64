"""The corpus pipeline: documents in, token ids of the filtered, deduplicated, redacted and mixed corpus out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of ``documents``; each works on
every row that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm.common import materialize, table, tokenizer_path
from mercato.llm.jaccard_join import keep_one_per_component
from mercato.llm.mixing import mix, repeated
from mercato.llm.pii import redacted_docs
from mercato.llm.resampling import resample
from mercato.llm.sampled_segmentation import sample_segmentations


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling toward the labelled good ones keeps."""
    return resample(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles of five words link at a similarity of 0.8."""
    return keep_one_per_component(docs, words=5, similarity=80)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind."""
    return redacted_docs(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out, so that sources come near their target weights."""
    return repeated(mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, as ids, with inclusion scores."""
    return sample_segmentations(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", filter_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("PII", redact_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

# Hashed importance weights, exact set joins, boosted trees and lattice sampling are not SQL;
# tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
