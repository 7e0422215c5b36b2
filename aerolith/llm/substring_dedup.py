"""Substring de-duplication by hashing units of text.

Units do not follow the layout: a text is its words in order, and a new unit begins after a word that ends a
sentence, between equal words, or where the bytes of two neighbouring words say so (``CUT``). The same passage is therefore cut in the
same way however its lines are wrapped and wherever it stands in a line; only the units at its two ends
depend on what surrounds it. A unit is normalised (ASCII capitals lowered, white space made one blank), reduced to a
digest, and digests are grouped globally. The earliest occurrence by (doc_id, unit number) stays; a later
one is removed if it stands in a run of repeated units with ``RUN_WORDS`` words or more, so stock phrases and short sentences
that recur by themselves stay, while the short units inside a repeated passage go with it. Removed runs keep their offsets
in the original text.

Work is done in blocks of documents. A block sends each of its distinct digests once, with the smallest (rank, key) that has
it there, to a bucket by digest; the bucket answers with one bit: earlier elsewhere or not. A unit that a third
of all documents share costs one entry per block. Buckets grow in number with the input, not in size. Texts are shuffled once, for
the join with their removed runs.

Defined results: a null text stays null and has no units; an empty text stays empty; rows with a
null id rank after all others; rows with one id and one text are the same document, so all
of them keep what one of them keeps; rows with one id and different texts are different
documents, ordered by a hash of the text; very long texts are read whole, in parts of some hundred
thousand bytes; an empty table gives no rows; other columns of the input pass through ``apply``
untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm.common import stored, table

#: words in a run of repeated units that is removed
RUN_WORDS = 16
#: one in about CUT pairs of words begins a unit; most words in a unit
CUT, MOST_WORDS = 14, 512
#: a prime for the sums over bytes that say where units begin
PRIME = 1009
#: bytes of a digest
DIGEST = 10
#: units in a block, units per bucket, bytes of a text worked on at a time
BLOCK_UNITS, BUCKET_UNITS, PART = 1 << 17, 1 << 18, 1 << 18
#: rank of a null id
LAST = 2**63 - 1
CUT_TYPE = T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("len", T.IntegerType())])))])
BLOCK_SCHEMA = "block long, n_units long, ranks binary, keys binary, units binary, words binary, digests binary"

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STOPS = np.isin(np.arange(256), list(b".!?"))


def _parts(data: bytes):
    """``data`` in parts of about PART bytes, cut at white space."""
    at = 0
    while len(data) - at > PART:
        m = re.compile(rb"[\x20\x09-\x0D]").search(data, at + PART)
        if not m:
            break
        yield data[at:m.start()]
        at = m.start()
    yield data[at:]


def units(text: str) -> tuple[list[bytes], list[int]]:
    """Digest and number of words of each unit of a text."""
    digests: list[bytes] = []
    sizes: list[int] = []
    carry = b""
    parts = list(_parts(text.encode("utf-8", "surrogatepass").translate(_LOWER)))
    for p, part in enumerate(parts):
        words = (carry + part).split()
        if not words:
            carry = b""
            continue
        length = np.fromiter(map(len, words), np.int64, len(words))
        norm = b" ".join(words) + b" "
        ends = np.cumsum(length + 1)
        starts = ends - length - 1
        b = np.frombuffer(norm, np.uint8)
        place = np.arange(1, len(b) + 1) - np.repeat(starts, length + 1)
        weighed = b * place
        weighed[ends - 1] = 0
        v = np.add.reduceat(weighed, starts) % PRIME
        cut = np.ones(len(words), bool)
        cut[1:] = _STOPS[b[ends[:-1] - 2]] | ((v[:-1] * 3 + v[1:] * 5) % PRIME % CUT == 0)
        for i in (np.flatnonzero((v[1:] == v[:-1]) & (length[1:] == length[:-1])) + 1).tolist():
            cut[i] = cut[i] or words[i] == words[i - 1]
        first = np.flatnonzero(cut)
        run = np.arange(len(words)) - np.repeat(first, np.diff(np.append(first, len(words))))
        first = np.flatnonzero(run % MOST_WORDS == 0)
        last = np.append(first[1:], len(words))
        if p < len(parts) - 1:  # the last unit may go on in the next part
            carry = norm[starts[first[-1]]:]
            first, last = first[:-1], last[:-1]
        digests += [hashlib.blake2b(norm[s:e], digest_size=DIGEST).digest() for s, e in zip(starts[first].tolist(), (ends[last - 1] - 1).tolist())]
        sizes += (last - first).tolist()
    return digests, sizes


def _blocks(batches):
    part, n = TaskContext.get().partitionId() << 32, 0
    docs: list[tuple] = []
    held = 0

    def row():
        docs.sort(key=lambda d: d[:2])
        return pa.RecordBatch.from_arrays(
            [pa.array([v]) for v in (part + n, held, np.array([d[0] for d in docs], np.int64).tobytes(), np.array([d[1] for d in docs], np.int64).tobytes(),
                                     np.array([len(d[3]) for d in docs], np.int32).tobytes(), np.concatenate([np.array(d[3], np.uint16) for d in docs]).tobytes(),
                                     b"".join(x for d in docs for x in d[2]))], names=["block", "n_units", "ranks", "keys", "units", "words", "digests"])

    for batch in batches:
        for rank, key, text in zip(batch["rank"].to_pylist(), batch["key"].to_pylist(), batch["text"]):
            digests, sizes = units(text.as_py())
            docs.append((rank, key, digests, sizes))
            held += len(sizes)
            if held >= BLOCK_UNITS:
                yield row()
                docs, held, n = [], 0, n + 1
    if docs:
        yield row()


class Block:
    """Documents of a block by (rank, key), their units, and each distinct digest with its first unit."""

    def __init__(self, r: dict):
        self.rank, self.key = np.frombuffer(r["ranks"], np.int64), np.frombuffer(r["keys"], np.int64)
        per = np.frombuffer(r["units"], np.int32)
        self.words = np.frombuffer(r["words"], np.uint16)
        self.doc = np.repeat(np.arange(len(per)), per)
        self.nth = np.arange(len(self.words)) - np.repeat(np.cumsum(per) - per, per)
        d = np.frombuffer(r["digests"], np.uint8).reshape(-1, DIGEST)
        self.high, self.low = np.ascontiguousarray(d[:, :8]).view(">u8").ravel().astype(np.uint64), np.ascontiguousarray(d[:, 8:]).view(">u2").ravel().astype(np.uint16)
        order = np.lexsort((self.low, self.high))  # stable: units of one digest stay in the order of their documents
        new = np.ones(len(order), bool)
        new[1:] = (self.high[order][1:] != self.high[order][:-1]) | (self.low[order][1:] != self.low[order][:-1])
        self.first = order[new]  # one unit per distinct digest, by digest
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1

    def dealt(self, buckets: int):
        """Places in ``first``, by bucket, and (bucket, from, to) of each."""
        to = (self.high[self.first] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        to = to[order]
        edge = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.empty(0, np.int64)
        return order, list(zip(to[edge].tolist(), edge.tolist(), [*edge[1:].tolist(), len(to)]))


def _send(buckets: int):
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            for r in b.to_pylist():
                block = Block(r)
                order, runs = block.dealt(buckets)
                u = block.first[order]
                cols = [x[u] for x in (block.high, block.low)] + [x[block.doc[u]] for x in (block.rank, block.key)]
                rows = [(k, r["block"], *(pack(c[a:e].tobytes()) for c in cols)) for k, a, e in runs]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in map(list, zip(*rows))], names=["bucket", "block", "high", "low", "rank", "key"])
    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bit for each digest that a block sent: it occurs in a document before the first of that block that has it."""
    unpack = zstandard.ZstdDecompressor().decompress
    got = {c: [np.frombuffer(unpack(x), t) for x in pdf[c]] for c, t in (("high", np.uint64), ("low", np.uint16), ("rank", np.int64), ("key", np.int64))}
    ends = np.cumsum([len(x) for x in got["low"]])
    high, low, rank, key = (np.concatenate(got[c]) for c in ("high", "low", "rank", "key"))
    order = np.lexsort((key, rank, low, high))
    h, w = high[order], low[order]
    new = np.append(True, (h[1:] != h[:-1]) | (w[1:] != w[:-1]))
    least = order[new][np.cumsum(new) - 1]  # the earliest of the same digest
    bits = np.empty(len(order), bool)
    bits[order] = (rank[least] != rank[order]) | (key[least] != key[order])
    return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "bits": [np.packbits(bits[e - len(x):e]).tobytes() for x, e in zip(got["low"], ends)]})


def runs_of(again: np.ndarray, words: np.ndarray, doc: np.ndarray, run_words: int):
    """(document, first word, words) of each run of repeated units with ``run_words`` words or more; units are in order."""
    if not len(again):
        return []
    edge = np.append(True, (again[1:] != again[:-1]) | (doc[1:] != doc[:-1]))
    at = np.flatnonzero(edge)
    size = np.add.reduceat(words.astype(np.int64), at)
    before = np.cumsum(words, dtype=np.int64) - words  # words before a unit in the block
    base = before[np.searchsorted(doc, doc[at])]
    keep = again[at] & (size >= run_words)
    return list(zip(doc[at][keep].tolist(), (before[at] - base)[keep].tolist(), size[keep].tolist()))


def _report(buckets: int, run_words: int):
    def run(batches):
        for b in batches:
            out: dict = {}
            for r in b.to_pylist():
                block = Block(r)
                order, parts = block.dealt(buckets)
                bits = {a["bucket"]: a["bits"] for a in r["answers"] or ()}
                elsewhere = np.zeros(len(order), bool)
                for k, a, e in parts:
                    elsewhere[order[a:e]] = np.unpackbits(np.frombuffer(bits[k], np.uint8), count=e - a).astype(bool)
                first = block.first[block.which]
                d, f = block.doc, block.doc[first]
                later = (block.rank[d] != block.rank[f]) | (block.key[d] != block.key[f]) | (block.nth != block.nth[first])
                for doc, word, size in runs_of(elsewhere[block.which] | later, block.words, d, run_words):
                    out.setdefault((int(block.rank[doc]), int(block.key[doc])), set()).add((word, size))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in out]), pa.array([k[1] for k in out]),
                                                  pa.array([[{"word": w, "n": n} for w, n in sorted(v)] for v in out.values()], pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())])))],
                                                 names=["rank", "key", "runs"])
    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), F.xxhash64(F.col(text_col).cast("string"))


def repeated(docs: DataFrame, run_words: int = RUN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rank, key, runs: for each document that loses any, the removed runs as (first word, words)."""
    rank, key = _keyed(docs, id_col, text_col)
    texts = docs.select(rank.alias("rank"), key.alias("key"), F.col(text_col).cast("string").alias("text")).where(F.length("text") > 0)
    blocks = stored(texts.mapInArrow(_blocks, BLOCK_SCHEMA), "unit-blocks", compression="zstd")
    buckets = max(8, (blocks.agg(F.sum("n_units")).first()[0] or 0) // BUCKET_UNITS)
    sent = blocks.mapInArrow(_send(buckets), "bucket long, block long, high binary, low binary, rank binary, key binary")
    bits = sent.groupBy("bucket").applyInPandas(_answer, "block long, bucket long, bits binary")
    answers = stored(bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")), "unit-answers")
    found = blocks.join(answers, "block", "left").mapInArrow(_report(buckets, run_words), "rank long, key long, runs array<struct<word:long,n:long>>")
    # repeats of one row are found once each
    return found.groupBy("rank", "key").agg(F.first("runs").alias("runs"))


def cut(text: str, runs) -> tuple[str, list[dict]]:
    """``text`` without its removed runs, and their places (start, len). A run goes with the white space behind it."""
    starts = [m.start() for m in _WORD.finditer(text)]
    starts.append(len(text))
    spans = [(starts[r["word"]], starts[r["word"] + r["n"]]) for r in runs]
    kept, at = [], 0
    for s, e in spans:
        kept.append(text[at:s])
        at = e
    return "".join(kept) + text[at:], [{"start": s, "len": e - s} for s, e in spans]


@F.pandas_udf(CUT_TYPE)
def _without(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
    both = [cut(t, r) if t is not None and r is not None and len(r) else (t, []) for t, r in zip(text, runs)]
    return pd.DataFrame({"text": pd.Series([t for t, _ in both], dtype=object), "spans": pd.Series([s for _, s in both], dtype=object)})


def apply(docs: DataFrame, run_words: int = RUN_WORDS, id_col: str = "doc_id", text_col: str = "text", spans_col: str | None = "removed_spans") -> DataFrame:
    """``docs`` with repeated runs cut from the text, and ``spans_col`` (start, len in the original text); the latter replaces a column
    of its name, or is left out if None."""
    names = [c for c in docs.columns if c != spans_col]
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in names}
    rank, key = _keyed(docs, id_col, text_col)
    rows = docs.select(F.struct(*[quoted[c].alias(f"c{i}") for i, c in enumerate(names)]).alias("row"), rank.alias("rank"), key.alias("key"))
    t = names.index(text_col)
    j = rows.join(repeated(docs, run_words, id_col, text_col), ["rank", "key"], "left")
    j = j.withColumn("done", _without(F.col(f"row.c{t}").cast("string"), F.col("runs")))
    out = [(F.col("done.text") if i == t else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(names)]
    return j.select(*out, *([F.col("done.spans").alias(spans_col)] if spans_col else []))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with repeated passages removed: doc_id, n_removed, removed_chars, removed_spans, text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply(docs).select(
        "doc_id", F.size("removed_spans").cast("long").alias("n_removed"),
        F.expr("aggregate(removed_spans, 0L, (a, s) -> a + s.len)").alias("removed_chars"),
        F.expr("array_join(transform(removed_spans, s -> concat(s.start, '+', s.len)), ',')").alias("removed_spans"), "text")


QUERIES = {"op8_substring_dedup": op8_substring_dedup}
SQL = {"op8_substring_dedup": f"""
WITH p AS (  -- words with the white space behind them; what stands before the first
  SELECT doc_id, length(regexp_extract(text, '^[\\x20\\x09-\\x0D]*')) AS lead, UNNEST(l) AS p, UNNEST(range(len(l))) AS i
  FROM (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*') AS l FROM documents WHERE text <> '')),
w AS (
  SELECT doc_id, p, i, translate(regexp_extract(p, '^[^\\x20\\x09-\\x0D]+'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w,
    lead + sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i) AS upto
  FROM p),
v AS (
  SELECT w, list_sum(list_transform(range(1, strlen(w) + 1), lambda k: ('0x' || substr(h, 2 * k - 1, 2))::INT * k)) % {PRIME} AS v
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM w)),
k AS (
  SELECT w.*, i = 0 OR regexp_matches(lag(w.w) OVER o, '[.!?]$') OR lag(w.w) OVER o = w.w OR (lag(v.v) OVER o * 3 + v.v * 5) % {PRIME} % {CUT} = 0 AS cut
  FROM w JOIN v ON w.w = v.w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT *, max(CASE WHEN cut THEN i END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM k),
n AS (SELECT *, sum(CASE WHEN (i - run) % {MOST_WORDS} = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS u FROM f),
units AS (SELECT doc_id, u, string_agg(w, ' ' ORDER BY i) AS unit, count(*) AS words FROM n GROUP BY doc_id, u),
ranked AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id, u) > 1 AS again FROM units),
grouped AS (
  SELECT *, u - row_number() OVER (PARTITION BY doc_id, again ORDER BY u) AS island FROM ranked),
gone AS (
  SELECT doc_id, u, again AND sum(words) OVER (PARTITION BY doc_id, again, island) >= {RUN_WORDS} AS gone, again, island FROM grouped),
words AS (SELECT n.doc_id, n.i, n.p, n.upto - length(n.p) AS start, n.upto, g.gone, g.island FROM n JOIN gone g ON g.doc_id = n.doc_id AND g.u = n.u),
spans AS (SELECT doc_id, min(start) AS start, max(upto) - min(start) AS size FROM words WHERE gone GROUP BY doc_id, island),
cuts AS (
  SELECT doc_id, count(*) AS n_removed, sum(size) AS removed_chars, string_agg(start::BIGINT || '+' || size::BIGINT, ',' ORDER BY start) AS removed_spans
  FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, coalesce(string_agg(CASE WHEN NOT gone THEN p END, '' ORDER BY i), '') AS text FROM words GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n_removed, 0)::BIGINT AS n_removed, coalesce(c.removed_chars, 0)::BIGINT AS removed_chars,
  coalesce(c.removed_spans, '') AS removed_spans,
  CASE WHEN k.doc_id IS NULL THEN d.text ELSE regexp_extract(d.text, '^[\\x20\\x09-\\x0D]*') || k.text END AS text
FROM documents d LEFT JOIN cuts c ON c.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id"""}
