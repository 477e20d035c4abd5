"""Documents to packed training pieces, stage by stage.

Each stage works on all rows that its predecessor kept and returns the columns of ``documents``,
the last one the pieces. Null texts count as empty, rows without id or with a repeated id are
documents like others, further columns pass through, and an empty table gives an empty result.
"""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetmart.catalog.registry import table
from fleetmart.llm import chosenpath, packing, quality, repeats, toxicity
from fleetmart.sinks.scratch import scratch_path

#: Documents below this quality and from this toxicity on are rejected.
LEAST_QUALITY, TOXIC = 0.3, 0.5
#: Jaccard similarity of word shingles from which documents are copies of each other.
SIMILARITY = Fraction(4, 5)
#: Bytes of a passage that may occur once only, anywhere.
REPEATED_BYTES = 200


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")), LEAST_QUALITY)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosenpath.keep_one(docs, SIMILARITY)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.cleaned(docs, REPEATED_BYTES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", reject_low_quality),
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", pack),
]

#: Models, encodings and similarity joins are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
