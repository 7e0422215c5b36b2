"""SimHash near-duplicates by pivot distance tables.

A document's fingerprint has bit i set if more than half of its word shingles' hashes have
it. Fingerprints at most ``MAX_BITS`` bits apart are linked; documents belong to the same component
if links lead from one to the other.

Equal fingerprints are merged first, so copies cost one row. For each distinct fingerprint the
Hamming distances to a fixed set of reference fingerprints (pivots) are precomputed: the zero
fingerprint and, for each of ``BLOCKS`` runs of bits, as many patterns on that run as it has bits.
By the triangle inequality, linked fingerprints differ by at most ``MAX_BITS`` in every
coordinate, and since no more than ``MAX_BITS`` runs can differ, the coordinates of all
pivots on the other runs, less the distance to zero, are equal. So rows meet only under keys made
of the coordinates of BLOCKS - MAX_BITS runs; under a key, pairs whose largest coordinate difference
exceeds ``MAX_BITS`` are discarded, and the survivors are verified bit by bit.

Under a key with more than ``DENSE`` fingerprints (a large family of near copies) pairs would
grow with the square of the family. There every fingerprint names itself and each neighbour one bit
away; two fingerprints at most two bits apart share such a name, so the smallest fingerprint per
name keeps every link at a cost that grows with the family. Links of a key are given as
edges to the smallest fingerprint linked, not as pairs. Components come from alternating
star contraction, in which all state stays in distributed tables.

Defined results: null texts and texts without words have fingerprint zero and are linked like any others; a
null id takes part, and a component's id is null only if all its ids are; repeated rows give
repeated results; an empty table gives no rows; extra columns are ignored by
``components`` and kept by ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import checkpoint, id_text, stored, table

SHINGLE = 3
MAX_BITS = 2
BLOCKS = 5
DENSE = 512
SEED = 42
#: rank of a null id
LAST = 2**63 - 1


def _runs() -> list[list[int]]:
    return [r.tolist() for r in np.array_split(np.arange(64), BLOCKS)]


def pivots() -> list[list[int]]:
    """For each run of bits, its pivots: prefixes of the run, which are linearly independent."""
    return [[sum(1 << b for b in run[:k]) for k in range(1, len(run) + 1)] for run in _runs()]


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit fingerprint of the word shingles of a text, repeats included; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    last = ends[size - 1:] if len(words) >= size else ends[-1:]
    h = xxhash.xxh64_digest
    digests = b"".join([h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())])
    ones = np.zeros(64, np.int64)
    every = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    for i in range(0, n, 1 << 16):  # the bits of a long text, a part at a time
        ones += np.unpackbits(every[i:i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(size: int):
    def run(batches):
        for b in batches:
            f = np.array([fingerprint(t.as_py(), size) for t in b.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("hash"), pa.array(f)], names=["doc_id", "hash", "fp"])
    return run


def fingerprints(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, hash (of the text), fp (the 64 bits as a signed long)."""
    texts = id_text(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    return texts.mapInArrow(_fingerprints(size), "doc_id long, hash long, fp long")


def _popcount(a: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a).astype(np.int16)


def distance_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints (rows) to zero and to every pivot, run after run (columns)."""
    refs = np.array([0] + [p for run in pivots() for p in run], np.uint64)
    return np.stack([_popcount(fp ^ r) for r in refs], axis=1)


def _keys(batches):
    """For each choice of BLOCKS - MAX_BITS runs, a key of the coordinates on them."""
    sizes = [len(r) for r in _runs()]
    ends = np.cumsum(sizes)
    columns = [np.arange(1 + e - n, 1 + e) for e, n in zip(ends, sizes)]
    for b in batches:
        fp = b.column("fp").to_numpy().view(np.uint64)
        d = distance_table(fp)
        own = d - d[:, :1]  # depends on the bits of each pivot's run only
        for c, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - MAX_BITS)):
            part = np.ascontiguousarray(own[:, np.concatenate([columns[i] for i in chosen])].astype(np.int8))
            key = [xxhash.xxh64_intdigest(r.tobytes(), c) for r in part]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(key, np.uint64).view(np.int64)), b.column("fp")], names=["key", "fp"])


def _linked(u: np.ndarray, d: np.ndarray) -> np.ndarray:
    """For each of some fingerprints (and their distances to the pivots) the place of the first one linked to it."""
    root = list(range(len(u)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(u) - 1):
        near = np.flatnonzero((np.abs(d[i + 1:] - d[i]) <= MAX_BITS).all(axis=1)) + i + 1
        for j in near[np.bitwise_count(u[near] ^ u[i]) <= MAX_BITS].tolist():
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return np.array([find(i) for i in range(len(u))])


def _verified(batches):
    """Edges (a, b) from each fingerprint under a key to the smallest one linked to it; a key per row."""
    for batch in batches:
        a, b = [], []
        lists = batch.column("fps")
        fp = lists.flatten().to_numpy()
        ends = np.cumsum(lists.value_lengths().to_numpy())
        d = distance_table(fp.view(np.uint64)) if len(fp) else None
        for start, end in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
            order = start + np.argsort(fp[start:end])
            top = _linked(fp[order].view(np.uint64), d[order])
            moved = np.flatnonzero(top != np.arange(len(top)))
            a.append(fp[order[moved]]), b.append(fp[order[top[moved]]])
        none = np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))], names=["a", "b"])


def links(fps: DataFrame) -> DataFrame:
    """a, b: edges between distinct fingerprints whose components are those of all links."""
    keyed = stored(fps.select("fp").distinct().mapInArrow(_keys, "key long, fp long"), "pivot-keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = keyed.join(sizes, "key")
    few = met.where(F.col("n") <= DENSE).groupBy("key").agg(F.collect_list("fp").alias("fps"))  # DENSE at most
    pairs = few.select("fps").mapInArrow(_verified, "a long, b long")
    dense = met.where(F.col("n") > DENSE).select("fp").distinct()
    names = dense.select("fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("name"))
    smallest = names.groupBy("name").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("name", "b")
    near = names.join(smallest, "name").select(F.col("fp").alias("a"), "b").where("a != b")
    return pairs.unionByName(near).distinct()


def contract(edges: DataFrame) -> DataFrame:
    """a, b: every vertex with an edge, and the smallest vertex of its component (stars in the end)."""
    e = checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x"))
                 .select("x.a", "x.b").where("a != b").distinct())
        e = checkpoint(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            return e
        state = now


def components(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, hash, fp and component_id (the smallest id of the component)."""
    f = stored(fingerprints(docs, size, id_col, text_col), "fingerprints")
    star = contract(links(f))
    per_fp = f.groupBy("fp").agg(F.min("doc_id").alias("low"))
    topped = per_fp.join(star.select(F.col("a").alias("fp"), F.col("b").alias("top")), "fp", "left").withColumn("top", F.coalesce("top", "fp"))
    lowest = topped.groupBy("top").agg(F.min("low").alias("component_id"))
    return f.join(topped.join(lowest, "top").select("fp", "top", "component_id"), "fp")


def keep_one(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each component: that with the smallest id (null ids last).

    Of rows that share this id, one with the lowest hash of its text stays.
    """
    rank = F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("rank")
    kept = components(docs, size, id_col, text_col).groupBy("top").agg(F.min(F.struct(rank, "hash")).alias("k")).select("k.rank", "k.hash")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("rank"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"))
    return (rows.join(kept, ["rank", "hash"], "left_semi").dropDuplicates(["rank", "hash"])
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = components(table(spark, sf_dir, "documents"))
    return c.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op4_simhash_dedup": op4_simhash_dedup}
SQL: dict[str, str] = {}
