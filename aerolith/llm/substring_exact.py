"""Exact repeated substrings by a depth-limited radix sort of suffixes.

Every byte covered by a ``LENGTH``-byte string that also starts in a document with a smaller id is
removed. Windows (the suffixes cut at LENGTH bytes) are ordered by most-significant-digit passes over
8-byte digits; groups that are still together after the last digit are exactly the repeated windows, and
rows that are alone in a group leave after each pass.

Sorting every window would move some fifty times the text, so windows are first dealt out by an anchor
that depends on their content alone: the ``GRAM``-byte gram with the least hash in the window. Equal windows
have equal anchors. Neighbouring windows mostly share one, so about one position in
fourteen is an anchor, and a window whose anchor occurs in one document only cannot be repeated. The steps:

1. Documents are stored in blocks of some megabytes, compressed.
2. Each block sends the hashes of its anchors, once each, to buckets by hash; a bucket answers with
   one bit per hash: seen in another block or document, or not.
3. For the anchors that are, each block sends the bytes around them (all windows of the anchor), equal ones once with the
   smallest id; the buckets run the radix passes and answer with one bit per window: in a smaller document or not. What the
   block needs for its report travels along, so no text is hashed again.
4. Each block marks the covered bytes of its documents and reports.

Hashes only choose what is compared; windows are compared by their bytes, so the result is exact. A string that
a third of all documents share costs one row per block and bucket. Buckets grow in number with the input, not in size.

Defined results: a null text counts as empty; null ids rank after all others and have no smaller document among
themselves; rows that share an id are one document in this respect; texts shorter than LENGTH lose nothing; very
long texts are worked on in overlapping pieces; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import id_text, stored, table

LENGTH = 50
GRAM = 24
#: grams in a window, which is also the number of windows an anchor can serve
SPREAD = LENGTH - GRAM + 1
#: bytes around an anchor that its windows cover
AROUND = LENGTH + SPREAD - 1
BLOCK_BYTES = 4 << 20
#: bytes worked on at a time
CHUNK = 1 << 18
#: bytes of text per bucket
BUCKET_BYTES = 8 << 20
#: rank of a null id
LAST = 2**63 - 1

_BYTE = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)]


def _blocks(batches):
    """Rows (block, ranks, sizes, data) of whole documents."""
    part, n = TaskContext.get().partitionId() << 32, 0
    ranks, texts, size = [], [], 0
    pack = zstandard.ZstdCompressor(level=3).compress

    def row():
        return pa.RecordBatch.from_arrays([pa.array([part + n]), pa.array([np.array(ranks, np.int64).tobytes()]),
                                           pa.array([np.array([len(t) for t in texts], np.int64).tobytes()]), pa.array([pack(b"".join(texts))])],
                                          names=["block", "ranks", "sizes", "data"])

    for b in batches:
        for r, t in zip(b.column("rank").to_pylist(), b.column("text")):
            ranks.append(r), texts.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield row()
                ranks, texts, size, n = [], [], 0, n + 1
    if texts:
        yield row()


def _slide(x: np.ndarray, width: int, f) -> np.ndarray:
    """f over every run of ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        x = f(x[:-step], x[step:])
        step *= 2
    return f(x[:len(x) - (width - step)], x[width - step:]) if step < width else x


def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash, never 0, of the GRAM bytes from each position."""
    h, steps, n = _BYTE[data], {}, 1
    while 2 * n <= GRAM:
        steps[n] = h
        a = h[:-n] * _MIX[n.bit_length() % 4]
        a ^= a >> np.uint64(29)
        h, n = a + h[n:], 2 * n
    steps[n] = h
    for m in sorted(steps, reverse=True):
        if n + m <= GRAM:
            a = h[:len(h) - m] * _MIX[3]
            a ^= a >> np.uint64(31)
            h, n = a + steps[m][n:n + len(a)], n + m
    h = (h ^ h >> np.uint64(30)) * _MIX[4]
    return (h ^ h >> np.uint64(27)) | np.uint64(1)


class Texts:
    """The documents of a block."""

    def __init__(self, ranks: bytes, sizes: bytes, data: bytes):
        self.rank = np.frombuffer(ranks, np.int64)
        self.size = np.frombuffer(sizes, np.int64)
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=int(self.end[-1])) if self.end[-1] else b"", np.uint8)


class Block(Texts):
    """The documents of a block and their anchors."""

    def __init__(self, ranks: bytes, sizes: bytes, data: bytes):
        super().__init__(ranks, sizes, data)
        self.chunks = [self._chunk(c) for c in self._pieces()]
        none = [np.empty(0, np.uint64)]
        self.hash = np.concatenate(none + [c[3] for c in self.chunks])  # of every anchor
        self.at = np.concatenate([np.empty(0, np.int64)] + [c[4] for c in self.chunks])  # its place in the block
        self.doc = np.searchsorted(self.end, self.at, "right")

    def _pieces(self):
        """Lists of (start, end): parts of documents whose windows are worked on together."""
        part, size = [], 0
        for s, e in zip(self.start.tolist(), self.end.tolist()):
            for a in range(s, e - LENGTH + 1, CHUNK):
                b = min(e, a + CHUNK + LENGTH - 1)
                part.append((a, b))
                size += b - a
                if size >= CHUNK:
                    yield part
                    part, size = [], 0
        if part:
            yield part

    def _chunk(self, pieces):
        """(least hash per window or 0, hash per gram, anchors' index, anchors' hash, anchors' place in the block)."""
        data = np.concatenate([self.data[a:b] for a, b in pieces])
        sizes = np.array([b - a for a, b in pieces])
        ends = np.cumsum(sizes)
        z = _hashes(data)
        least = _slide(z, SPREAD, np.minimum)  # of the window from each position
        for e in ends[:-1].tolist():
            least[e - LENGTH + 1:e] = 0  # not in one document
        pad = np.zeros(SPREAD - 1, np.uint64)
        i = np.flatnonzero(_slide(np.concatenate([pad, least, pad]), SPREAD, np.maximum) == z)
        piece = np.searchsorted(ends, i, "right")
        return least, z, i, z[i], i - (ends - sizes)[piece] + np.array([a for a, _ in pieces])[piece]

    def distinct(self):
        """Short hashes of the block's anchors, each once, sorted; and whether two documents of the block have it."""
        short = self.hash >> np.uint64(16)
        order = np.argsort(short, kind="stable")
        value, first = np.unique(short[order], return_index=True)
        if not len(value):
            return value, np.empty(0, bool)
        rank = self.rank[self.doc[order]]
        return value, np.minimum.reduceat(rank, first) != np.maximum.reduceat(rank, first)

    def around(self, repeated: np.ndarray):
        """For the anchors whose short hash is in ``repeated``: hash, document, place, windows (a bit each), bytes around."""
        out = []
        done = 0
        for least, z, i, value, at in self.chunks:
            n = len(i)
            doc = self.doc[done:done + n]
            done += n
            keep = np.zeros(n, bool)
            if len(repeated):
                s = value >> np.uint64(16)
                keep = repeated[np.minimum(np.searchsorted(repeated, s), len(repeated) - 1)] == s
            i, value, at, doc = i[keep], value[keep], at[keep], doc[keep]
            windows = np.zeros(len(i), np.uint32)
            for o in range(SPREAD):
                j = i - o
                ok = (j >= 0) & (j < len(least))
                ok[ok] = least[j[ok]] == value[ok]
                windows |= ok.astype(np.uint32) << np.uint32(o)
            j = at[:, None] + np.arange(-(SPREAD - 1), LENGTH)
            inside = (j >= self.start[doc][:, None]) & (j < self.end[doc][:, None])
            out.append((value, doc, at, windows, np.where(inside, self.data[np.clip(j, 0, max(0, len(self.data) - 1))], 0).astype(np.uint8)))
        if not out:
            return [np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.uint32)] + [np.empty((0, AROUND), np.uint8)]
        return [np.concatenate(x) for x in zip(*out)]

    def contexts(self, repeated: np.ndarray):
        """Distinct (bytes around, windows) with hash and smallest rank; and for every anchor: its context, document, place, windows."""
        value, doc, at, windows, near = self.around(repeated)
        rows = np.concatenate([near, windows.astype("<u4").view(np.uint8).reshape(-1, 4)], axis=1)
        first, inverse = distinct_rows(rows)
        low = np.full(len(first), LAST, np.int64)
        np.minimum.at(low, inverse, self.rank[doc])
        return value[first], rows[first], low, inverse, doc, at, windows


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of bytes: one index per distinct row, and for each row which of them is equal to it.

    Rows are ordered by a hash and neighbours compared by their bytes, so rows of one number are always equal; should two different rows
    share a hash, some equal rows may get two numbers, which costs a row and no result.
    """
    if not len(rows):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8)))).view(np.uint64)
    h = np.zeros(len(rows), np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * _MIX[k % len(_MIX)]
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    h, words = h[order], words[order]
    new = np.ones(len(rows), bool)
    new[1:] = (h[1:] != h[:-1]) | (words[1:] != words[:-1]).any(axis=1)
    inverse = np.empty(len(rows), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse


def _bucket(short: np.ndarray, buckets: int) -> np.ndarray:
    return (short % np.uint64(buckets)).astype(np.int64)


def _runs(sorted_values: np.ndarray):
    """(value, from, to) of each run of equal values."""
    if not len(sorted_values):
        return
    first = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    yield from zip(sorted_values[first].tolist(), first.tolist(), [*first[1:].tolist(), len(sorted_values)])


def _send_hashes(buckets: int):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                value, twice = Block(r["ranks"], r["sizes"], r["data"]).distinct()
                to = _bucket(value, buckets)
                order = np.argsort(to, kind="stable")
                value, twice = value[order], twice[order]
                rows = [(k, r["block"], value[a:e].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), np.packbits(twice[a:e]).tobytes())
                        for k, a, e in _runs(to[order])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in map(list, zip(*rows))], names=["bucket", "block", "hashes", "twice"])
    return run


def _answer_hashes(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bit for each hash that a block sent: in another document, or not."""
    lists, twice = [], []
    for h, t in zip(pdf["hashes"], pdf["twice"]):
        six = np.frombuffer(h, np.uint8).reshape(-1, 6)
        lists.append(np.concatenate([six, np.zeros((len(six), 2), np.uint8)], axis=1).view("<u8").ravel())
        twice.append(np.unpackbits(np.frombuffer(t, np.uint8), count=len(six)).astype(bool))
    ends = np.cumsum([len(x) for x in lists])
    _, inverse, n = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    again = n > 1
    again[inverse[np.concatenate(twice)]] = True
    bits = again[inverse]
    return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "bits": [np.packbits(bits[e - len(x):e]).tobytes() for x, e in zip(lists, ends)]})


def _repeated(block: Block, answers, buckets: int) -> np.ndarray:
    """Sorted short hashes of the block that occur in several documents, from the buckets' answers."""
    value, _ = block.distinct()
    to = _bucket(value, buckets)
    order = np.argsort(to, kind="stable")
    value = value[order]
    bits = {a["bucket"]: a["bits"] for a in answers or ()}
    found = [value[a:e][np.unpackbits(np.frombuffer(bits[k], np.uint8), count=e - a).astype(bool)] for k, a, e in _runs(to[order]) if k in bits]
    return np.sort(np.concatenate([np.empty(0, np.uint64), *found]))


def _dealt(block: Block, answers, buckets: int):
    """``contexts`` of the repeated anchors, ordered by bucket; the order of contexts is that of sending."""
    value, rows, low, inverse, doc, at, windows = block.contexts(_repeated(block, answers, buckets))
    to = _bucket(value >> np.uint64(16), buckets)
    order = np.argsort(to, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return to[order], rows[order], low[order], place[inverse] if len(order) else inverse, doc, at, windows


def _send_contexts(buckets: int):
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            for r in b.to_pylist():
                block = Block(r["ranks"], r["sizes"], r["data"])
                to, rows, low, context, doc, at, windows = _dealt(block, r["answers"], buckets)
                runs = list(_runs(to))
                out = [(k, r["block"], pack(rows[a:e].tobytes()), low[a:e].tobytes()) for k, a, e in runs]
                if out:
                    # what the report needs of the anchors, under a key of the block's own
                    order = np.argsort(at, kind="stable")
                    cols = (np.array([x for k, a, e in runs for x in (k, e - a)], np.int64), low, context[order].astype(np.uint32), np.diff(at[order], prepend=0), windows[order])
                    out.append((-1 - r["block"], r["block"], pickle.dumps([(c.dtype.str, pack(c.tobytes())) for c in cols]), b""))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in map(list, zip(*out))], names=["bucket", "block", "rows", "low"])
    return run


def radix_groups(text: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
    """Group numbers of rows of bytes: equal rows share one, rows without an equal have -1.

    Most significant digits (8 bytes) first; rows alone in their group drop out after each pass. ``own``: groups
    by digits before these, if any.
    """
    n, width = text.shape
    group = np.full(n, -1, np.int64)
    left, own = np.arange(n), np.zeros(n, np.int64) if own is None else own
    for a in range(0, width, 8):
        if not len(left):
            break
        part = np.zeros((len(left), 8), np.uint8)
        part[:, :min(8, width - a)] = text[left, a:a + 8]
        digit = part.view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((digit, own))
        left, own, digit = left[order], own[order], digit[order]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (digit[1:] != digit[:-1])])
        own = np.cumsum(new) - 1
        many = np.bincount(own) > 1
        keep = many[own]
        left, own = left[keep], own[keep]
    group[left] = own
    return group


def _answer_contexts(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each context that a block sent, a bit for each window: in a smaller document than the block's, or not.

    The first three digits of the radix passes are the anchor's gram, common to all windows of a context and so done once; the
    others are the rest of the window, before and behind the gram.
    """
    if pdf["bucket"].iloc[0] < 0:
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "flags": pdf["rows"]})
    unpack = zstandard.ZstdDecompressor().decompress
    sent = [np.frombuffer(unpack(x), np.uint8).reshape(-1, AROUND + 4) for x in pdf["rows"]]
    ends = np.cumsum([len(x) for x in sent])
    rows = np.concatenate(sent)
    low = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["low"]])
    first, which = distinct_rows(rows)
    rows = rows[first]
    own_low = np.full(len(first), LAST, np.int64)  # the smallest rank with this very context
    np.minimum.at(own_low, which, low)
    windows = np.ascontiguousarray(rows[:, AROUND:]).view("<u4").ravel()
    flags = np.zeros(len(low), np.uint32)
    a, e = SPREAD - 1, SPREAD - 1 + GRAM
    gram = radix_groups(rows[:, a:e])
    for o in range(SPREAD):
        bit = windows >> np.uint32(o) & np.uint32(1) == 1
        least = np.where(bit, own_low, LAST)
        has = np.flatnonzero(bit & (gram >= 0))
        group = radix_groups(np.concatenate([rows[has, a - o:a], rows[has, e:a - o + LENGTH]], axis=1), gram[has])
        some = np.flatnonzero(group >= 0)
        if len(some):
            in_group = np.full(group.max() + 1, LAST, np.int64)
            np.minimum.at(in_group, group[some], own_low[has[some]])
            least[has[some]] = in_group[group[some]]
        flags[least[which] < low] |= np.uint32(1 << o)
    return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "flags": [flags[e - len(x):e].tobytes() for x, e in zip(sent, ends)]})


def _report():
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for r in b.to_pylist():
                block = Texts(r["ranks"], r["sizes"], r["data"])
                got = {a["bucket"]: a["flags"] for a in r["flags"] or ()}
                notes = [np.frombuffer(unpack(x), t) for t, x in pickle.loads(got[-1 - r["block"]])] if got else [np.empty(0, np.int64)] * 5
                runs, low, context, at, windows = notes
                at = np.cumsum(at)
                flags = np.concatenate([np.empty(0, np.uint32)] + [np.frombuffer(got[int(k)], np.uint32) for k in runs[::2]])
                doc = np.searchsorted(block.end, at, "right")
                edge = np.zeros(len(block.data) + 1, np.int32)
                if len(at):
                    cut = np.where(block.rank[doc] > low[context], windows, flags[context])
                    for o in range(SPREAD):
                        s = at[cut >> np.uint32(o) & np.uint32(1) == 1] - o
                        edge[s] += 1  # places of one offset differ; a place that two parts of a long text share counts once at both ends
                        edge[s + LENGTH] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                out = ([], [], [], [], [])
                for rank, s, e in zip(block.rank.tolist(), block.start.tolist(), block.end.tolist()):
                    g = gone[s:e]
                    runs = int(np.count_nonzero(g[1:] & ~g[:-1])) + int(e > s and g[0])
                    for col, v in zip(out, (None if rank == LAST else rank, e - s, int(np.count_nonzero(g)), runs, hashlib.sha256(block.data[s:e][~g].tobytes()).hexdigest())):
                        col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(),) * 4 + (pa.string(),))],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    texts = id_text(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(LAST)).alias("rank"), "text")
    blocks = stored(texts.mapInArrow(_blocks, "block long, ranks binary, sizes binary, data binary"), "text-blocks")
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    buckets = int(max(8, total // BUCKET_BYTES))
    sent = blocks.mapInArrow(_send_hashes(buckets), "bucket long, block long, hashes binary, twice binary")
    bits = sent.groupBy("bucket").applyInPandas(_answer_hashes, "block long, bucket long, bits binary")
    answers = stored(bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")), "anchor-answers")
    asked = blocks.join(answers, "block", "left")
    around = asked.mapInArrow(_send_contexts(buckets), "bucket long, block long, rows binary, low binary")
    flags = around.groupBy("bucket").applyInPandas(_answer_contexts, "block long, bucket long, flags binary")
    told = stored(flags.groupBy("block").agg(F.collect_list(F.struct("bucket", "flags")).alias("flags")), "window-answers")
    return blocks.join(told, "block", "left").mapInArrow(_report(), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))


QUERIES = {"op6_suffix_dedup": op6_suffix_dedup}
SQL: dict[str, str] = {}
