"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words and the first letters of its longer words (endings vary), hashed
into ``SLOTS`` slots; each slot that occurs has the value 1. The score is the logistic of a bias, a
weight per slot and, for every pair of slots that occur together, the inner product of their factor
vectors, so a pair such as an insult with the mention of a group has a weight of its own
that no sum of single weights has.

The model is fitted on at most ``SAMPLE`` labelled training documents of either class, those whose ids hash
lowest, by mini-batch AdaGrad; only their slots, bounded per document by the number of slots, come to the
driver. Every slot that occurs in the sample is fitted, whatever its own share of toxic documents: a
slot that tells nothing alone may tell in a pair. Weights of weak evidence take small steps, and factors
are shrunk by their standard errors. Scoring
reads every text once, whole, without a shuffle; the model has at most ``SLOTS`` slots.

Defined results: null and empty texts have no terms and score the bias; documents without a label, with a null
label or a null id are not learned from; a repeated row may be learned from repeatedly; without any
training document every score is 0.5; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import in_fold, table

SLOTS = 1 << 18
FACTORS = 4
#: most labelled documents of either class that are fitted
SAMPLE = 6_000
EPOCHS, BATCH, DECAY = 12, 64, 1e-4
RATE, RATE_FACTOR, RATE_BIAS = 0.1, 0.1, 0.05
#: root of the likelihood ratio of a slot whose weight takes half steps; standard errors by which factors are shrunk
STRONG, LEAST = 4.5, 2.0
PREFIX = 4
#: remembered words per worker
CACHE = 300_000

_word = re.compile(r"[^\W\d_]+")
_slots: dict[str, tuple[int, ...]] = {}


def _of(word: str) -> tuple[int, ...]:
    b = word.encode("utf-8", "surrogatepass")
    if len(word) <= PREFIX:
        return (zlib.crc32(b) % SLOTS,)
    return (zlib.crc32(b) % SLOTS, zlib.crc32(b"^" + word[:PREFIX].encode("utf-8", "surrogatepass")) % SLOTS)


def terms(text: str | None) -> np.ndarray:
    """Sorted slots of the terms of a text."""
    if len(_slots) > CACHE:
        _slots.clear()
    found: set[int] = set()
    for w in set(_word.findall((text or "").lower())):
        got = _slots.get(w)
        if got is None:
            got = _slots[w] = _of(w)
        found.update(got)
    return np.array(sorted(found), np.int32)


def _terms(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array([terms(t.as_py()) for t in b.column("text")], pa.list_(pa.int32()))], names=["toxic", "slots"])


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """toxic, slots of at most ``most`` training documents of either class."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().where(~in_fold("doc_id", 5, 0)).distinct()
    pick = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    chosen = pick[0].unionByName(pick[1])  # at most 2 * most ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.select("toxic", "text").mapInArrow(_terms, "toxic int, slots array<int>")


class Model:
    """Bias, weights and factors of the slots in ``known`` (sorted)."""

    def __init__(self, known: np.ndarray, bias: float, weight: np.ndarray, factor: np.ndarray):
        self.known, self.bias, self.weight, self.factor = known, bias, weight, factor

    def rows(self, slots: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.known, slots), len(self.known) - 1)
        return at[self.known[at] == slots]

    def logit(self, at: np.ndarray) -> float:
        v = self.factor[at]
        s = v.sum(axis=0)
        return float(self.bias + self.weight[at].sum() + 0.5 * ((s * s).sum() - (v * v).sum()))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(self.rows(terms(text))), -30, 30))))


def evidence(at: list[np.ndarray], y: np.ndarray, slots: int) -> np.ndarray:
    """Share of the full step that the weight of each slot takes: near 1 where its own counts tell the classes apart, never cut off."""
    sizes = [len(a) for a in at]
    cat = np.concatenate(at)
    seen = np.bincount(cat, minlength=slots)
    bad = np.bincount(cat, np.repeat(y, sizes), slots)
    ratio = np.zeros(slots)
    for n, part in ((bad, y.mean()), (seen - bad, 1 - y.mean())):
        ratio += 2 * n * np.log(np.maximum(n, 1e-9) / (seen * part))
    ratio = np.maximum(ratio, 0) ** 2
    return ratio / (ratio + STRONG ** 4)


def _shrunk(total: np.ndarray, square: np.ndarray, epoch: int) -> np.ndarray:
    """Change of factors: the sum of their gradients in standard errors of one pass, less ``LEAST``."""
    z = np.abs(total) / np.sqrt(square)
    return -RATE_FACTOR * np.sign(total) * np.maximum(0, z - LEAST * np.sqrt(epoch))


def _per(group: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(group, value[:, f], n) for f in range(value.shape[1])], axis=1)


def fit(rows: list[tuple[int, np.ndarray]]) -> Model:
    """Logistic loss, both classes weighing the same, over shuffled mini-batches.

    Weights: AdaGrad with decay, its step scaled by ``evidence``. Factors: dual averaging, so that only steady gradients
    move them, whatever a slot tells alone.
    """
    if not rows or len({y for y, _ in rows}) < 2:
        return Model(np.empty(0, np.int32), 0.0, np.empty(0), np.empty((0, FACTORS)))
    rows = sorted(rows, key=lambda r: (r[0], r[1].tobytes()))
    known = np.unique(np.concatenate([s for _, s in rows]))
    rng = np.random.default_rng(7)
    start = rng.normal(0, 0.01, (len(known), FACTORS))
    m = Model(known, 0.0, np.zeros(len(known)), start)
    at = [m.rows(s) for _, s in rows]
    y = np.array([float(c) for c, _ in rows])
    share = y.mean()
    cost = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    step = RATE * evidence(at, y, len(known))
    g_w, g_b = np.full(len(known), 1e-8), 1e-8
    total, square = np.zeros((len(known), FACTORS)), np.full((len(known), FACTORS), 1e-16)
    for epoch in range(1, EPOCHS + 1):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            part = order[i:i + BATCH]
            cat = np.concatenate([at[k] for k in part])
            doc = np.repeat(np.arange(len(part)), [len(at[k]) for k in part])
            used, inv = np.unique(cat, return_inverse=True)
            v = (start[used] + _shrunk(total[used], square[used], epoch))[inv]
            s = _per(doc, v, len(part))
            z = m.bias + np.bincount(doc, m.weight[cat], len(part)) + 0.5 * ((s * s).sum(axis=1) - np.bincount(doc, (v * v).sum(axis=1), len(part)))
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * cost[part]
            grad_v = e[doc, None] * (s[doc] - v)
            total[used] += _per(inv, grad_v, len(used))
            square[used] += _per(inv, grad_v ** 2, len(used))
            grad_w = np.bincount(inv, e[doc], len(used)) / len(part) + DECAY * m.weight[used]
            g_w[used] += grad_w ** 2
            g_b += e.mean() ** 2
            m.weight[used] -= step[used] * grad_w / np.sqrt(g_w[used])
            m.bias -= RATE_BIAS * e.mean() / np.sqrt(g_b)
    m.factor = start + _shrunk(total, square, EPOCHS)
    return m


def _score(model: Model):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([model.score(t.as_py()) for t in b.column("text")], pa.float64())],
                                             names=["doc_id", "held_out", "score"])
    return run


def train(docs: DataFrame, labels: DataFrame) -> Model:
    t = sample(docs, labels).toArrow().combine_chunks()  # as arrays: a list of numbers would take ten times the memory
    return fit([(y, s.values.to_numpy()) for y, s in zip(t.column("toxic").to_pylist(), t.column("slots"))])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", in_fold("doc_id", 5, 0))
    return (rows.select("doc_id", "held_out", "text").mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op7_toxicity": op7_toxicity}
SQL: dict[str, str] = {}
