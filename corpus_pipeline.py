"""Training-data pipeline over ``documents``: clean, drop boilerplate, keep one of
each near-duplicate group, mix the sources, pack into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playerledger.llm import line_dedup, minhash_dedup, mixing, packing, quality_rules
from playerledger.llm.common import documents, stored, tokenizer_file


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: failed lines go, and the documents that lose too much with them."""
    return quality_rules.keep_clean(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines on too many documents of a source go."""
    return line_dedup.without_boilerplate(docs, host="source")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays."""
    return minhash_dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each source by its target, a document as often as it is drawn."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: token pieces with their sequence and offset."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", clean),
    ("line_dedup", drop_lines),
    ("minhash_dedup", drop_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: SQL can't draw the mix or pack: no oracle, see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
