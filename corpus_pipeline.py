"""Training corpus pipeline: quality rules, language ID, near-duplicates, source mixing, tokens.

Each stage reads what its predecessor wrote and calls one operator of
``histmart.llm``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.llm import byte_bpe, common, language_id, mixing, quality_rules, simhash
from histmart.llm.queries import DOMAINS, TARGETS, split_pattern, tokenizer_file
from histmart.session import checkpoint_dir


def pass_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, own = common.set_aside(docs, {f.name for f in quality_rules.FIELDS})
    return quality_rules.quality_rules(docs).where("kept").select(*own)


def pass_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, own = common.set_aside(docs, {f.name for f in language_id.FIELDS})
    return language_id.identify(docs).where("kept").select(*own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, size=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = common.read(spark, sf_dir, "labels")
    docs, own = common.set_aside(docs, {f.name for f in mixing.FIELDS})
    return mixing.realise(mixing.mix(docs, labels, F.expr(DOMAINS), TARGETS, anchor="clean", anchor_floor=1.0, stage=False), own)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(docs, tokenizer_file("byte_bpe_50k.tiktoken"), split_pattern(),
                               keep=["doc_id", "lang", "source"])


STAGES = [
    ("quality_rules", pass_quality_rules),
    ("language_id", pass_language_id),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode_bytes),
]

#: The stages are not expressible in SQL (learned references, fingerprint trees, BPE); tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared checkpoint folder and read again."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = common.read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
