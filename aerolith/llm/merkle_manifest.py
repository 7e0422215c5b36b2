"""Merkle manifest of a dataset by checkpoint and recompute.

Every row is a leaf, the SHA-256 of its fields. Leaves of one tree (one language) stand in the order
of their ids; every ``FANOUT`` consecutive nodes become their hash until one node, the subroot, remains, and
the subroots become the root in the same way.

Only every ``STRIDE``-th level is persisted: a table of (tree, pos, node) under the manifest's folder. The
levels between are never stored. A proof is extracted from the top down: each aligned subtree of
``FANOUT ** STRIDE`` stored descendants regenerates its missing interior nodes in one row, emits the siblings on the
path of each descendant, appends those of the subtree's own path and drops the interior again.

Nothing is ordered in one task: a leaf's position is its place in a range-partitioned, sorted table plus the counts of
earlier partitions, so a tree with a third of all rows is dealt out like any other. A subtree
holds at most ``FANOUT ** STRIDE`` digests. The driver learns one number per persisted level (the size of the largest tree).

Defined results: a null field counts as ``-``; a null language is a tree of its own, before all others; null ids
stand first in their tree; rows that share an id are ordered by leaf, and repeats of a whole row are equal leaves next to each
other; a tree of one leaf has that leaf as subroot and a single tree has its subroot as root, with no
siblings there; an empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.llm.common import shared_path, table

#: nodes under one parent
FANOUT = 8
#: levels from one persisted level to the next
STRIDE = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "struct<left:string,right:string>"


def digest(*fields: Column) -> Column:
    """SHA-256 over the fields, each as ``-`` if null, else byte count, ``:`` and value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def tree_key(lang: Column) -> Column:
    """A key that is never null and keeps the order of the language: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("-"))


def _level(spark: SparkSession, folder: str, k: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/level-{k}")


def place(rows: DataFrame, order: list[str], folder: str) -> DataFrame:
    """``rows`` with ``pos``, the place of a row in its tree by ``order``; rows equal in all of it stand in any order.

    The sorted rows are stored under ``folder``, so their partition and place cannot change between the two reads.
    """
    spark = rows.sparkSession
    keys = ["tree", *order]
    # no number of partitions: the session's, less where the rows are few
    (rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
     .write.parquet(folder))
    placed = spark.read.parquet(folder).withColumn("part", F.shiftright("at", 33))
    firsts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = firsts.select("tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(starts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _parents(nodes: str) -> str:
    """The level above an array of nodes."""
    return f"transform(sequence(0, (size({nodes}) - 1) div {FANOUT}), i -> sha2(array_join(slice({nodes}, i * {FANOUT} + 1, {FANOUT}), ''), 256))"


def subtrees(level: DataFrame, payload: list[str]) -> DataFrame:
    """One row for each aligned subtree over a persisted level: tree, pos, items, up (levels to the next persisted one), l0 to l3.

    ``l0`` holds the stored nodes, ``l1`` and on the regenerated levels above them; a tree that needs fewer
    levels to come to one node has fewer (``up``).
    """
    total = level.groupBy("tree").agg(F.count(F.lit(1)).alias("total"))
    span = FANOUT ** STRIDE
    needed = " ".join(f"WHEN total <= {FANOUT ** j} THEN {j}" for j in range(STRIDE))
    out = (level.groupBy("tree", F.expr(f"pos div {span}").alias("pos"))
           .agg(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("place"), "node", *payload))).alias("items"))
           .join(total, "tree").selectExpr("tree", "pos", "items", f"CASE {needed} ELSE {STRIDE} END AS up", "items.node AS l0"))
    for j in range(1, STRIDE + 1):
        out = out.selectExpr("*", f"CASE WHEN up >= {j} THEN {_parents(f'l{j - 1}')} END AS l{j}")
    return out


def build(leaves: DataFrame, order: list[str], payload: list[str], folder: str) -> int:
    """Persist the levels of every tree over ``leaves`` (tree, node, columns of ``order`` and ``payload``); the number of the last one."""
    spark = leaves.sparkSession
    place(leaves, order, f"{folder}/leaves").write.parquet(f"{folder}/level-0")
    k = 0
    while True:
        level = _level(spark, folder, k)
        most = level.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return k
        top = F.expr("element_at(CASE up " + " ".join(f"WHEN {j} THEN l{j}" for j in range(STRIDE)) + f" ELSE l{STRIDE} END, 1)")
        subtrees(level, []).select("tree", "pos", top.alias("node")).write.parquet(f"{folder}/level-{k + 1}")
        k += 1


def _step(j: int) -> str:
    """Siblings, left and right, of the node over item ``i`` in regenerated level ``j``."""
    at = f"(i div {FANOUT ** j})"
    run = f"({at} - {at} % {FANOUT})"
    return (f"named_struct('left', array_join(slice(l{j}, {run} + 1, {at} % {FANOUT}), ''), "
            f"'right', array_join(slice(l{j}, {at} + 2, {FANOUT - 1} - {at} % {FANOUT}), ''))")


def paths(level: DataFrame, above: DataFrame, payload: list[str]) -> DataFrame:
    """tree, pos, node, payload, steps and end of every node of a persisted level, given the same (steps, end) of the level above."""
    cut = f"slice(array({', '.join(_step(j) for j in range(STRIDE))}), 1, up)"
    more = "".join(f", '{c}', x.{c}" for c in payload)
    found = f"transform(items, (x, i) -> named_struct('pos', x.place, 'node', x.node{more}, 'steps', concat({cut}, steps)))"
    return (subtrees(level, payload).join(above.select("tree", "pos", "steps", "end"), ["tree", "pos"])
            .selectExpr("tree", "end", f"inline({found})"))


def prove(spark: SparkSession, folder: str, last: int, tops: DataFrame, payload: list[str]) -> DataFrame:
    """Proof of every leaf of a built manifest; ``tops`` has tree, steps (from subroot on) and end for each tree.

    ``steps`` goes from the leaf up: the concatenated digests left and right of the path. Paths of the persisted
    levels between are stored too, one row for every ``FANOUT ** STRIDE`` of the level below.
    """
    above = _level(spark, folder, last).join(tops, "tree")
    for k in range(last - 1, -1, -1):
        above = paths(_level(spark, folder, k), above, payload if k == 0 else [])
        if k:
            above.write.parquet(f"{folder}/paths-{k}")
            above = spark.read.parquet(f"{folder}/paths-{k}")
    return above


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def siblings_digest(steps: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(rows: DataFrame, payload: list[str], folder: str | None = None) -> DataFrame:
    """Proofs over ``rows`` (lang, doc_id, leaf, payload): tree, pos, node (the leaf), payload, steps and end (subroot, root).

    The levels persisted under ``folder`` are one manifest of the trees and one of the subroots.
    """
    spark = rows.sparkSession
    folder = folder or shared_path(spark, "manifest")
    # equal rows, however many, are spread over partitions by the salt
    leaves = rows.select(tree_key(F.col("lang")).alias("tree"), "doc_id", F.col("leaf").alias("node"), *payload,
                         F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    leaves.write.parquet(f"{folder}/rows")
    last = build(spark.read.parquet(f"{folder}/rows"), ["doc_id", "node", "salt"], payload, f"{folder}/trees")
    subroots = _level(spark, f"{folder}/trees", last).select(F.col("tree").alias("name"), "node")
    top = build(subroots.select(F.lit("").alias("tree"), "name", "node"), ["name"], ["name"], f"{folder}/subroots")
    root = _level(spark, f"{folder}/subroots", top).select("tree", F.array().cast(f"array<{STEP}>").alias("steps"), F.struct(F.col("node").alias("root")).alias("end"))
    above = prove(spark, f"{folder}/subroots", top, root, ["name"])
    tops = above.select(F.col("name").alias("tree"), "steps", F.struct(F.col("node").alias("subroot"), "end.root").alias("end"))
    return prove(spark, f"{folder}/trees", last, tops, ["doc_id", *payload])


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof digest and verification of every document, a third of them presented with a tampered text."""
    fields = [F.col(c) for c in FIELDS]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    forged = F.when(tampered, digest(*fields[:-1], F.translate(F.col("text"), UPPER, LOWER)))
    rows = table(spark, sf_dir, "documents").select("lang", F.col("doc_id").cast("long").alias("doc_id"), digest(*fields).alias("leaf"), forged.alias("forged"))
    proofs = manifest(rows, ["forged"])
    out = proofs.select("doc_id", F.col("node").alias("leaf"), "end.subroot", "end.root", siblings_digest(F.col("steps")).alias("proof_sha256"),
                        fold(F.coalesce("forged", "node"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}

#: CRC-32 in SQL: eight shifts for every byte, polynomial 0xEDB88320
_CRC = ("xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), "
        "lambda h, b: list_reduce([xor(h, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda r, _: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295)")
_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(text if c == "text" else c) for c in FIELDS) + ")"


def _levels(name: str, leaves: str) -> str:
    return f"""{name} AS (
  SELECT tree, 0 AS level, pos, node, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // {FANOUT}, sha256(string_agg(node, '' ORDER BY pos)), (n + {FANOUT - 1}) // {FANOUT}
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // {FANOUT}, n),
{name}_steps AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.pos // {FANOUT} = b.pos // {FANOUT}
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos)"""


SQL = {"op13_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf('text')} END AS shown
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos FROM d),
t0 AS (SELECT tree, pos, leaf AS node FROM p),
{_levels('t', 't0')},
subroots AS (SELECT tree AS name, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS nth FROM t WHERE n = 1),
u0 AS (SELECT '' AS tree, nth AS pos, subroot AS node FROM subroots),
{_levels('u', 'u0')},
steps AS (
  SELECT p.doc_id, p.leaf, s.level AS k, s.l, s.r FROM p JOIN t_steps s ON s.tree = p.tree AND s.pos = p.pos // ({FANOUT} ** s.level)::BIGINT
  UNION ALL
  SELECT p.doc_id, p.leaf, 1000 + s.level, s.l, s.r FROM p JOIN subroots x ON x.name = p.tree JOIN u_steps s ON s.pos = x.nth // ({FANOUT} ** s.level)::BIGINT),
paths AS (SELECT doc_id, leaf, list(l ORDER BY k) AS l, list(r ORDER BY k) AS r, string_agg(l || r, '' ORDER BY k) AS siblings FROM steps GROUP BY doc_id, leaf),
walk AS (
  SELECT p.doc_id, p.leaf, p.shown AS node, coalesce(paths.l, []) AS l, coalesce(paths.r, []) AS r, coalesce(paths.siblings, '') AS siblings, p.tree, 0 AS k
  FROM p LEFT JOIN paths USING (doc_id, leaf)
  UNION ALL
  SELECT doc_id, leaf, sha256(l[k + 1] || node || r[k + 1]), l, r, siblings, tree, k + 1 FROM walk WHERE k < len(l))
SELECT w.doc_id, w.leaf, s.subroot, u.node AS root, sha256(w.siblings) AS proof_sha256, w.node AS folded_root, w.node = u.node AS verified
FROM walk w JOIN subroots s ON s.name = w.tree, (SELECT node FROM u WHERE n = 1) u WHERE w.k = len(w.l)"""}
