"""Co-training: quality that lies in the words alone, odd inputs on the fitted path."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from aerolith.llm import quality_classifier as q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=900, seed=1):
    """Texts of one shape; bad ones hold words of spam, in the same number and length as the good ones' words. Sources lean to a side."""
    rng = random.Random(seed)
    words = {1: [f"good{i:03d}" for i in range(40)], 0: [f"spam{i:03d}" for i in range(40)]}
    common = [f"word{i:03d}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        y = i % 2
        text = [*rng.choices(common, k=70), *rng.choices(words[y], k=6)]
        rng.shuffle(text)
        docs.append((i, " ".join(text).capitalize() + ".", "en", rng.choice("abc" if y else "bcd"), 600))
        if i % 3 == 0:
            labels.append((i, y))
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = corpus()
    odd = [docs[2], (None, "spam001 spam002", "en", "d", 3), (10_000, None, None, None, None), (10_001, "", "en", "a", 0), (10_002, "word " * 30_000, "xx", "a", -5)]
    df = spark.createDataFrame(docs + odd, SCHEMA)
    for c in ("row", "words", "terms", "share", "ratios", "size", "page", "label", "_p", "fold", "y"):
        df = df.withColumn(c, F.lit(1))
    lab = spark.createDataFrame(labels + [(None, 1), (4, None), (10_000, 0)], "doc_id long, quality int")
    return {True: docs, False: odd}, q.co_train(df, lab).collect(), dict(labels)


def test_words_alone_tell(trained):
    groups, rows, _ = trained
    unseen = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert len(unseen) > 100 and sum(r["kept"] == bool(r["doc_id"] % 2) for r in unseen) >= 0.97 * len(unseen)
    assert {r["held_out"] for r in unseen} == {True} and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in unseen)


def test_odd_rows_on_the_fitted_path(trained):
    groups, rows, _ = trained
    assert len(rows) == len(groups[True]) + len(groups[False])
    assert all(0 <= r["score"] <= 1 and 0 <= r["p_text"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 2}) == 1
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]


def test_missing_metadata_columns(spark):
    docs, labels = corpus(300)
    df = spark.createDataFrame(docs, SCHEMA).select("doc_id", "text")
    got = q.co_train(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert got.count() == 300


def test_rounds_use_pseudo_labels(spark):
    """A source that no labelled document has is learned through the text view's confident labels."""
    docs, labels = corpus(900)
    docs = [(i, t, lang, ("new1" if i % 2 else "new0") if i % 3 else s, n) for i, t, lang, s, n in docs]
    got = {n: q.co_train(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int"), rounds=n).where("doc_id % 3 <> 0").toPandas() for n in (1, 3)}
    right = {n: ((d.p_meta > 0.5) == (d.doc_id % 2 == 1)).mean() for n, d in got.items()}
    assert right[3] > 0.95 > right[1]
