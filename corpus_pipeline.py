"""The corpus pipeline: quality rules, SimHash de-duplication, substring de-duplication, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the
columns of ``documents``; the last returns the packed pieces. Between stages the rows are
written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import decontamination, packing, quality_rules, simhash_dedup, substring_dedup
from aerolith.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays: that with the smallest id."""
    return simhash_dedup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred before go from the texts; ``n_chars`` follows the text. A null text stays null with its
    ``n_chars``, an empty one stays empty, equal rows lose the same, other columns of any name stay."""
    cut = substring_dedup.apply(docs, spans_col=None)
    kind = dict(docs.dtypes).get("n_chars")
    if kind:
        cut = cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))
    return cut


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality rules", keep_good),
    ("simhash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack_sequences),
]

#: the fingerprint, component and packing stages have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if i < len(STAGES) - 1:
            rows = stored(rows, f"stage-{i + 1}")
    return rows
