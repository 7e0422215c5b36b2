"""Language identification by rank-order profiles of n-grams.

A language's profile is the list of its most frequent 1- to 3-grams of letters over all its training
documents, most frequent first. A document's own list is made the same way from its whole text and compared
with each profile by the out-of-place distance: the sum, over the document's n-grams, of how
far each lies from its place in the profile, or ``PROFILE`` places where it is not in it. The
nearest language wins; ties go to the name that sorts first.

Counting runs inside the tasks that read the texts: each batch of rows becomes one row per
language and n-gram, summed by a grouping that combines before the shuffle, so neither a very
frequent language nor a very frequent n-gram meets in one task as rows. Profiles are
``PROFILE`` rows per language and travel to the tasks; the number of languages is checked (``LANGUAGES``).

Defined results: a null text, or one without a letter, is ``und`` with score 0; if nothing can be learned every
document is ``und``; null ids are never held out and pass through; repeated rows count as often as they
occur; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.llm.common import checkpoint, in_fold, table

PROFILE = 400
#: most languages whose profiles are sent to the tasks
LANGUAGES = 5_000
#: characters counted at a time in training
SLICE = 2_000_000
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of other characters than letters as one 0, with a 0 at both ends."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c = np.concatenate([[0], np.where(_letters()[c], c, 0), [0]])
    return c[(c != 0) | (np.concatenate([[1], c[:-1]]) != 0)]


def _grams(c: np.ndarray) -> np.ndarray:
    """All 1- to 3-grams of a code sequence as numbers of 21 bits a character, without the blank alone."""
    two = c[:-1] << 21 | c[1:]
    return np.concatenate([c[c != 0], two | 1 << 62, two[:-1] << 21 | c[2:] if len(c) > 2 else c[:0]])


def profile(text: str | None, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams of a text, most frequent first; ties by number."""
    c = _codes(text or "")
    if not c.any():
        return np.empty(0, np.int64)
    return _ranked(*np.unique(_grams(c), return_counts=True), size)


def _ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    if len(grams) > size:  # all that can be among the first
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:size]


def _count(batches):
    """lang, gram, n for each slice of the texts of a batch."""
    for b in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
            by_lang.setdefault(lang, []).append(text.as_py())
        for lang, texts in by_lang.items():
            part, size = [], 0
            for k, t in enumerate(texts):
                part.append(_grams(_codes(t)))
                size += len(t)
                if size >= SLICE or k == len(texts) - 1:
                    grams, n = np.unique(np.concatenate(part), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])
                    part, size = [], 0


def learn(docs: DataFrame, size: int = PROFILE, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, grams: the profile of each language, most frequent n-gram first."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the first of each part of a language, then the first of those: no task ranks all n-grams of one language
    parts = counts.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(64)))
    order = [F.desc("n"), F.asc("gram")]
    some = parts.withColumn("r", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("r") <= size)
    first = some.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("r") <= size)
    return first.groupBy("lang").agg(F.expr("transform(sort_array(collect_list(struct(r, gram))), x -> x.gram)").alias("grams"))


def _predict(profiles: list[tuple[str, list[int]]], size: int):
    names = [x for x, _ in profiles]

    def run(batches):
        known = np.unique(np.concatenate([np.array(g, np.int64) for _, g in profiles])) if profiles else np.empty(0, np.int64)
        # place[i, l]: rank of the known n-gram i in language l, or size
        place = np.full((len(known) + 1, len(profiles)), size, np.int64)
        absent = np.ones((len(known) + 1, len(profiles)), bool)
        for k, (_, grams) in enumerate(profiles):
            at = np.searchsorted(known, np.array(grams, np.int64))
            place[at, k], absent[at, k] = np.arange(len(grams)), False
        for b in batches:
            lang, score = [], []
            for t in b.column("text"):
                own = profile(t.as_py(), size)
                if not len(own) or not profiles:
                    lang.append(UNKNOWN), score.append(0.0)
                    continue
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                at = np.where(known[at] == own, at, len(known))
                off = np.where(absent[at], size, np.abs(place[at] - np.arange(len(own))[:, None])).sum(axis=0)
                best = int(np.argmin(off))
                lang.append(names[best]), score.append(1.0 - float(off[best]) / (size * len(own)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, profiles: DataFrame, size: int = PROFILE, text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for rows with doc_id, held_out and a text."""
    learned = checkpoint(profiles)
    n = learned.count()
    if n > LANGUAGES:
        raise ValueError(f"{n} languages; at most {LANGUAGES} profiles are sent to the tasks")
    ordered = [(r["lang"], r["grams"]) for r in learned.orderBy("lang").collect()]
    return docs.select("doc_id", "held_out", F.col(text_col).cast("string").alias("text")).mapInArrow(
        _predict(ordered, size), "doc_id long, held_out boolean, lang_pred string, score double")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").withColumn("held_out", in_fold("doc_id", 4, 2))
    return predict(docs, learn(docs.where("NOT held_out")))


QUERIES = {"op10_language_id": op10_language_id}
SQL: dict[str, str] = {}
