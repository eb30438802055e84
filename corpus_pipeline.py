"""A corpus pipeline: score quality, drop exact and near copies, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All stages but the last
return the columns of ``documents``. Defined cases are those of the operators; a stage that keeps nothing
passes an empty table on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterhawk.llm import bpe, exact_dedup, mixing, near_dedup, quality
from meterhawk.llm.common import Scratch, read_table
from meterhawk.llm.queries import MIXTURE, VOCABULARY

# Share of the tokens that the mixture takes. One epoch, so that no copy comes back.
MIXTURE_SHARE = 0.9
# Share of word shingles from which two documents are near copies. op1_near_dedup has a contract of its own, 0.85.
SIMILAR = (80, 100)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is fitted on labelled rows of the stage's own input."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, similar=SIMILAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.select_rows(docs, MIXTURE, MIXTURE_SHARE, epochs=1)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("exact dedup", drop_exact_copies),
    ("near-duplicate dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

# A trained model and the tokenizer's pattern cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's rows are written and read again as the next one's input."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, scratch.put(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if name != STAGES[0][0]:
            scratch.drop(before)
    return docs
