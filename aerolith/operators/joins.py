"""Joins and lookups (JN1-JN9, DQ11, SC11, ST2/ST3).

Join strategy is left to Catalyst/AQE: both sides of a fact-fact join are
hash-partitioned on the full key (entity *and* time, so a hot entity spreads
over many partitions) and AQE splits skewed partitions at run time. A
dimension side is broadcast only when it is a fixed-size table (entity
dimension, band list), never a side that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANONICAL_COLLATION = "UNICODE_CI_AI"


def merge_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """JN1: equi-join on all ``keys`` (NULL keys never match, unlike pandas)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return left.filter(cond).join(right.filter(cond), on=keys, how=how)


def enrich(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """JN2: inner enrichment; a failed lookup drops the row and right-side fields overwrite left ones."""
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    l2 = left.drop(*shared)
    return merge_on_keys(l2, right, keys, "inner").select(
        *keys, *[c for c in left.columns if c not in keys and c not in shared],
        *[c for c in right.columns if c not in keys])


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` without a partner (``left_anti``)."""
    return left.join(right, on=keys, how="left_anti")


def canonical_key(c: Column | str) -> Column:
    """SC11: trimmed, case- and accent-insensitive comparison key."""
    col = F.col(c) if isinstance(c, str) else c
    return F.collate(F.trim(col), CANONICAL_COLLATION)


def canonical_lookup(probes: DataFrame, dimension: DataFrame, probe_col: str = "raw_name",
                     name_col: str = "entity") -> DataFrame:
    """JN3/DQ11: resolve raw names to the canonical dimension name; unknown -> NULL + ``is_known`` false.

    No broadcast hint: an entity dimension can grow with the number of
    stations, so the strategy is left to AQE's size-checked broadcast
    threshold (a shuffled hash/sort-merge join on the collation key otherwise).
    """
    dim = dimension.select(F.col(name_col).alias("canonical_name"),
                           canonical_key(name_col).alias("_ck"))
    out = probes.join(dim, canonical_key(probe_col) == F.col("_ck"), "left")
    return out.drop("_ck").withColumn("is_known", F.col("canonical_name").isNotNull())


def distinct_union(*dfs: DataFrame) -> DataFrame:
    """ST2/ST3: UNION DISTINCT (hash aggregate after the union)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def zero_filled_counts(keys: DataFrame, events: DataFrame, key: str, name: str = "n") -> DataFrame:
    """JN9: count per key for every key in ``keys``; absent keys get 0."""
    counts = events.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return keys.select(key).distinct().join(counts, key, "left").fillna({name: 0})


def pair_on_time(df: DataFrame, key: str, ts: str, value: str, a: str, b: str) -> DataFrame:
    """JN8: two entities' values side by side on common timestamps (inner self join on time)."""
    left = df.filter(F.col(key) == a).select(ts, F.col(value).alias("value_a"))
    right = df.filter(F.col(key) == b).select(ts, F.col(value).alias("value_b"))
    return left.join(right, ts, "inner").filter(F.col("value_a").isNotNull() & F.col("value_b").isNotNull())
