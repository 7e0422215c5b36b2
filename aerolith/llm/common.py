"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.session import cut_lineage, ensure_checkpoint_dir

#: ASCII white space, as a regular-expression class body: blank, tab, LF, VT, FF, CR.
ASCII_SPACE = r"\x20\x09-\x0D"

checkpoint = cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, so other columns of any name cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def in_fold(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32(id as text) mod ``modulus`` = ``remainder``; a null id is in no held-out fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))
