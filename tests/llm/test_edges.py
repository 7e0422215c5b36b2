"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from aerolith.llm import (decontamination, language_id, packing, quality_classifier, quality_rules, sharding,
                          simhash_dedup, substring_exact, toxicity)

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
ROWS = [(1, "a b c d e f g h i j"), (2, None), (3, ""), (None, "null id text of some words here now"), (4, LONG), (4, LONG),
        (5, "a b c d e f g h i j"), (None, None), (6, " \t\n \x0b\x0c\r"), (7, "Éé ÀÀ ß 漢字 \U0001f600 ok")]
#: names that operators use inside
CLASH = dict(rank=1, key="k", hash=2, row="r", votes=3, n=4, fp=5, lang="en", source="s", n_chars=9, kept=True, top=1, spans="x", w="w", t="t", l="l")


@pytest.fixture(scope="module")
def docs_of(spark):
    def make(rows, **more):
        df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        for name, value in more.items():
            df = df.withColumn(name, F.lit(value))
        return df
    return make


@pytest.fixture(scope="module")
def docs(docs_of):
    return docs_of(ROWS, **CLASH)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x))


ALL = ids([{"doc_id": i} for i, _ in ROWS])


def test_quality_rules(docs, none):
    rows = quality_rules.score(docs).collect()
    assert ids(rows) == ALL
    empty = [r for r in rows if r["doc_id"] in (2, 3, 6)]
    assert all(r["n_words"] == 0 and r["base_failed"] and not r["kept"] for r in empty)
    assert {r["n_words"] for r in rows if r["doc_id"] == 4} == {30_000}
    assert quality_rules.filter_good(docs).columns == docs.columns
    assert quality_rules.score(none).count() == 0 and quality_rules.filter_good(none).count() == 0


def test_sharding(docs, none):
    rows = sharding.shard(docs, 3).collect()
    assert ids(rows) == ALL
    for s in {r["shard"] for r in rows}:
        at = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert at == list(range(len(at)))
    assert all(r["size"] == 8 and r["text_crc32"] == 0 for r in rows if r["doc_id"] in (2, 3))
    assert sharding.shard(none, 3).count() == 0


def test_simhash(docs, none):
    rows = simhash_dedup.components(docs).collect()
    assert ids(rows) == ALL
    zero = {r["component_id"] for r in rows if r["fp"] == 0}
    assert zero == {2}  # null, empty and blank texts link, the null id with them
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 5)} == {1}
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert ids(kept.collect()) == [1, 2, 4, 7, None]
    assert simhash_dedup.components(none).count() == 0 and simhash_dedup.keep_one(none).count() == 0


def test_decontamination(docs, none, spark):
    bench = spark.createDataFrame([(1, "A b, C d e f g h i j"), (2, "漢字"), (3, None), (None, "null id text of some"), (4, "---")], "item_id long, text string")
    got = {}
    for r in decontamination.report(docs, bench).collect():
        got.setdefault(r["doc_id"], set()).add((r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]))
    assert got[1] == got[5] == {(10, 10, 1, True)}
    assert got[2] == got[3] == got[6] == {(0, 0, 0, False)}
    assert got[None] == {(8, 5, 1, True), (0, 0, 0, False)}
    assert got[4] == {(30_000, 0, 0, False)}
    assert {x[1] for x in got[7]} == {1}
    clean = decontamination.clean(docs, bench)
    assert clean.columns == docs.columns and ids(clean.collect()) == [2, 3, 4, 4, 6, None]
    assert decontamination.report(none, bench).count() == 0
    assert decontamination.report(docs, bench.where("false")).where("contaminated").count() == 0


def test_substring_exact(docs, none):
    rows = substring_exact.removed(docs).collect()
    assert ids(rows) == ALL
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_bytes"] == 0 and by[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert all(r["n_removed"] == 0 for r in rows)  # repeated rows are one document
    assert substring_exact.removed(none).count() == 0


def test_toxicity(docs, none, spark):
    labels = spark.createDataFrame([(1, 0), (5, 1), (None, 1), (2, None)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert ids(rows) == ALL and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    blank = toxicity.score(docs, toxicity.train(none, labels)).collect()
    assert {r["score"] for r in blank} == {0.5}
    assert toxicity.score(none, model).count() == 0


def test_packing(docs, none):
    rows = packing.pack(packing.pieces(docs, capacity=64), capacity=64).collect()
    assert ids({r["doc_id"]: r for r in rows}.values()) == sorted({i for i, _ in ROWS if i is not None}) + [None]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0 and sum(n for _, n in parts) <= 64
    assert [r["length"] for r in rows if r["doc_id"] == 2] == [1]
    assert packing.pack(packing.pieces(none)).count() == 0


def test_language(docs, none):
    d = docs.withColumn("held_out", F.lit(False))
    rows = language_id.predict(d, language_id.learn(d)).collect()
    assert ids(rows) == ALL
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 6)} == {"und"}
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 1} == {"en"}
    unlearned = language_id.predict(d, language_id.learn(d.where("false"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlearned} == {("und", 0.0)}
    assert language_id.predict(none.withColumn("held_out", F.lit(False)), language_id.learn(d)).count() == 0


def test_quality_classifier(docs, none, spark):
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    rows = quality_classifier.co_train(docs, labels).collect()
    assert ids(rows) == ALL and len({r["score"] for r in rows}) == 1
    assert quality_classifier.co_train(none, labels).count() == 0
