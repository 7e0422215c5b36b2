"""Benchmark decontamination with a distributed positional inverted index.

Texts are read once. Each block of documents becomes one stored row of the index: for
every word that occurs in the benchmark, the sorted positions of its tokens in the block.
Summed over the blocks, posting lengths say how rare each word is in the whole corpus. A window
of the benchmark is then searched from its rarest word: the positions of that word less its offset in
the window are candidate starts, intersected with the offset-adjusted positions of the next
rarest word, until none is left or all words agree. Starts that survive are exact phrase
matches; with ``slop`` above 0 each word may lie up to so many places from its own
(proximity matches).

Blocks hold whole documents, so nothing of the index is shuffled, and a frequent word or a
group of copies only lengthens posting lists inside their blocks. The windows of the benchmark,
the query set, are searched in blocks of at most ``WINDOWS``; that many windows travel to the tasks at
once, however large the benchmark is.

Defined results: null or empty texts have no words and no windows; an item shorter than a window is one
window, an item without words none; null ids pass through, and items with a null id are named
by an empty string; documents or items that repeat are each reported; empty tables on
either side give no rows or no hits; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm.common import id_text, stored, table

WINDOW = 10
#: benchmark windows searched at once
WINDOWS = 100_000
#: tokens after which a block of documents is closed
BLOCK_TOKENS = 1_000_000

#: bytes of words: digits, a-z and all that is not ASCII; A-Z become a-z, the rest blanks
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

INDEX_SCHEMA = "doc_ids array<long>, hashes array<long>, n_words array<int>, terms array<int>, lengths array<int>, gaps binary"
_INDEX = pa.schema([("doc_ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())), ("terms", pa.list_(pa.int32())),
                    ("lengths", pa.list_(pa.int32())), ("gaps", pa.binary())])
HIT_SCHEMA = "doc_id long, hash long, n_words int, items array<string>, spans array<struct<start:int,len:int>>"


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of digits, a-z and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


@F.udf(T.ArrayType(T.StringType()))
def _words_udf(text):
    return [w.decode("utf-8", "surrogatepass") for w in words(text)]


def windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """window (array of words), items (sorted ids as strings): the distinct windows of the benchmark."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), _words_udf(F.col(text_col).cast("string")).alias("w"))
    each = items.where(F.size("w") > 0).select("item", F.explode(F.expr(
        f"IF(size(w) <= {size}, array(w), transform(sequence(1, size(w) - {size - 1}), i -> slice(w, i, {size})))")).alias("window"))
    return each.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _index(terms: dict[bytes, int], apart: int):
    """Index rows of blocks of documents; ``apart`` positions are left free between two documents."""
    def row(ids, hashes, counts, found, at):
        term, pos = np.concatenate(found) if found else np.empty((0,), np.int32), np.concatenate(at) if at else np.empty((0,), np.int32)
        order = np.argsort(term, kind="stable")
        term, pos = term[order], pos[order]
        used, first, n = np.unique(term, return_index=True, return_counts=True)
        gaps = np.diff(pos, prepend=np.int32(0)).astype(np.int32)
        gaps[first] = pos[first]
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([hashes], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int32())), pa.array([used], pa.list_(pa.int32())),
                                           pa.array([n.astype(np.int32)], pa.list_(pa.int32())), pa.array([gaps.tobytes()], pa.binary())], schema=_INDEX)

    def run(batches):
        get = terms.get
        ids, hashes, counts, found, at, base = [], [], [], [], [], 0
        for b in batches:
            for doc, text, h in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("hash").to_pylist()):
                ws = words(text)
                ts = np.array([get(w, -1) for w in ws], np.int32)
                where = np.flatnonzero(ts >= 0)
                ids.append(doc), hashes.append(h), counts.append(len(ws)), found.append(ts[where]), at.append((where + base).astype(np.int32))
                base += len(ws) + apart
                if base >= BLOCK_TOKENS:
                    yield row(ids, hashes, counts, found, at)
                    ids, hashes, counts, found, at, base = [], [], [], [], [], 0
        if ids:
            yield row(ids, hashes, counts, found, at)
    return run


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], apart: int) -> DataFrame:
    """The stored index of ``docs`` over the words of ``vocabulary``."""
    return stored(id_text(docs).withColumn("hash", F.xxhash64("text")).mapInArrow(_index(vocabulary, apart), INDEX_SCHEMA), "positional-index", compression="zstd")


def _near(starts: np.ndarray, other: np.ndarray, slop: int) -> np.ndarray:
    """The starts with a value of ``other`` (sorted) at most ``slop`` away."""
    i = np.searchsorted(other, starts - slop)
    return starts[(i < len(other)) & (other[np.minimum(i, len(other) - 1)] <= starts + slop)] if len(other) else starts[:0]


def _search(queries: list[tuple[list[tuple[int, int]], int, list[str]]], apart: int, slop: int):
    """queries: for each window its (term, offset) from the rarest term up, its length and its items."""
    def run(batches):
        for b in batches:
            out = ([], [], [], [], [])
            for r in b.to_pylist():
                n = np.array(r["lengths"], np.int64)
                ends = np.cumsum(n)
                gaps = np.frombuffer(r["gaps"], np.int32)
                place = {t: (e - k, e) for t, e, k in zip(r["terms"], ends.tolist(), n.tolist())}
                listed: dict[int, np.ndarray] = {}

                def postings(t):
                    if t not in listed:
                        a, e = place[t]
                        listed[t] = np.cumsum(gaps[a:e], dtype=np.int64)
                    return listed[t]

                first = np.concatenate([[0], np.cumsum(np.array(r["n_words"], np.int64) + apart)])
                hits: dict[int, tuple[set, list]] = {}
                for terms, size, items in queries:
                    if any(t not in place for t, _ in terms):
                        continue
                    starts = postings(terms[0][0]) - terms[0][1]
                    for t, o in terms[1:]:
                        if not len(starts):
                            break
                        starts = _near(starts, postings(t) - o, slop)
                    for s in starts.tolist():
                        d = int(np.searchsorted(first, max(s, 0), "right")) - 1
                        got = hits.setdefault(d, (set(), []))
                        got[0].update(items)
                        got[1].append((max(0, s - int(first[d])), size))
                for d, (doc, h, k) in enumerate(zip(r["doc_ids"], r["hashes"], r["n_words"])):
                    items, spans = hits.get(d, ((), ()))
                    for col, v in zip(out, (doc, h, k, sorted(items), [{"start": s, "len": min(e, k) - s} for s, e in merged(spans)])):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.string())),
                                              pa.array(out[4], pa.list_(pa.struct([("start", pa.int32()), ("len", pa.int32())])))],
                                             names=["doc_id", "hash", "n_words", "items", "spans"])
    return run


def merged(spans) -> list[tuple[int, int]]:
    """(start, end) of the union of (start, length) spans."""
    out: list[list[int]] = []
    for s, n in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s + n)
        else:
            out.append([s, s + n])
    return [tuple(x) for x in out]


def _one_block(docs: DataFrame, block: list, slop: int) -> DataFrame:
    """Hits of at most WINDOWS windows: a row per row of ``docs``."""
    found = [([w.encode("utf-8", "surrogatepass") for w in r["window"]], r["items"]) for r in block]
    terms = {w: i for i, w in enumerate(sorted({w for ws, _ in found for w in ws}))}
    apart = WINDOW + slop + 1
    index = build_index(docs, terms, apart)
    counts = (index.select(F.explode(F.arrays_zip("terms", "lengths")).alias("x"))
              .groupBy("x.terms").agg(F.sum(F.col("x.lengths").cast("long")).alias("n")).collect())  # a row per word of the windows
    rare = {r["terms"]: r["n"] for r in counts}
    queries = []
    for ws, items in found:
        at = [(terms[w], i) for i, w in enumerate(ws)]
        if all(t in rare for t, _ in at):  # a word that no document has rules its windows out
            queries.append((sorted(at, key=lambda x: (rare[x[0]], x)), len(ws), items))
    return index.mapInArrow(_search(queries, apart, slop), HIT_SCHEMA)


@F.udf(T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("len", T.IntegerType())])))
def _merge_udf(spans):
    return [(s, e - s) for s, e in merged([(x["start"], x["len"]) for x in spans or ()])]


def hits(docs: DataFrame, benchmark: DataFrame, slop: int = 0) -> DataFrame:
    """doc_id, hash (of the text), n_words, items found and merged spans of hit words, a row per row of ``docs``."""
    found = stored(windows(benchmark), "benchmark-windows")
    blocks = max(1, math.ceil(found.count() / WINDOWS))
    which = F.pmod(F.xxhash64("window"), F.lit(blocks))
    parts = [_one_block(docs, found.where(which == i).collect(), slop) for i in range(blocks)]
    if blocks == 1:
        return parts[0]
    more = parts[1]
    for p in parts[2:]:
        more = more.unionByName(p)
    more = (more.where(F.size("items") > 0).groupBy(F.coalesce("doc_id", F.lit(-1)).alias("d"), F.col("hash").alias("h"))
            .agg(F.flatten(F.collect_set("items")).alias("more_items"), F.flatten(F.collect_set("spans")).alias("more_spans")))
    first = parts[0].join(more, (F.coalesce("doc_id", F.lit(-1)) == F.col("d")) & (F.col("hash") == F.col("h")), "left")
    return first.select("doc_id", "hash", "n_words",
                        F.sort_array(F.array_union("items", F.coalesce("more_items", F.array().cast("array<string>")))).alias("items"),
                        _merge_udf(F.concat("spans", F.coalesce("more_spans", F.array().cast("array<struct<start:int,len:int>>")))).alias("spans"))


def report(docs: DataFrame, benchmark: DataFrame, slop: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return hits(docs, benchmark, slop).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.expr("aggregate(spans, 0L, (a, s) -> a + s.len)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, slop: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    own = id_text(docs, id_col, text_col)
    bad = hits(own, benchmark, slop).where(F.size("spans") > 0).select(F.coalesce("doc_id", F.lit(-1)).alias("d"), F.col("hash").alias("h")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("d"), F.xxhash64(F.col(text_col).cast("string")).alias("h"))
    return rows.join(bad, ["d", "h"], "left_anti").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_decontamination": op5_decontamination}
SQL = {"op5_decontamination": f"""
WITH dw AS (SELECT doc_id, [x for x in string_split_regex(lower_ascii, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)),
iw AS (SELECT item_id, [x for x in string_split_regex(lower_ascii, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM benchmark)),
win AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS k
  FROM (SELECT item_id, w, UNNEST(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, UNNEST(range(1, len(w) + 1)) AS i FROM dw), sizes WHERE i + n - 1 <= len(w)),
hit AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM pos p JOIN win ON win.n = p.n AND win.k = p.k),
h AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hit), (SELECT UNNEST(range(0, {WINDOW})) AS o) WHERE o < n GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h ON h.doc_id = dw.doc_id LEFT JOIN it ON it.doc_id = dw.doc_id"""}
