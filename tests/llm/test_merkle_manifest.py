"""The Merkle manifest against a plain recursion, and its odd inputs."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from aerolith.llm import merkle_manifest as m

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, lower=False):
    text = row["text"]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and for each node its siblings (left, right) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            a = k - k % 8
            paths[i].append(("".join(nodes[a:k]), "".join(nodes[k + 1:a + 8])))
        nodes, at = [sha("".join(nodes[a:a + 8])) for a in range(0, len(nodes), 8)], [k // 8 for k in at]
    return nodes[0], paths


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    first = lambda v: (v is not None, v)
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    done = {}
    for lang in order:
        rs = sorted(langs[lang], key=lambda r: (first(r["doc_id"]), leaf(r)))
        done[lang] = (rs, *tree([leaf(r) for r in rs]))
    root, tops = tree([done[lang][1] for lang in order])
    out = []
    for lang, top in zip(order, tops):
        rs, subroot, paths = done[lang]
        for r, path in zip(rs, paths):
            forged = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = leaf(r, forged)
            for left, right in path + top:
                node = sha(left + node + right)
            out.append((r["doc_id"], leaf(r), subroot, root, sha("".join(a + b for a, b in path + top)), node, node == root))
    return sorted(out, key=str)


@pytest.fixture()
def query(spark, tmp_path):
    def run(df):
        df.write.parquet(str(tmp_path / "documents.parquet"))
        return m.op13_merkle_manifest(spark, str(tmp_path))
    return run


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9, "de": 8, "fr": 1, None: 3}, {f"l{i}": 2 for i in range(70)}])
def test_small_trees(spark, query, sizes):
    rng = random.Random(1)
    rows = [dict(doc_id=rng.randrange(10**6), text=rng.choice(["ABC é x", None, ""]), lang=lang, source=rng.choice(["s", None]), n_chars=rng.choice([3, None]))
            for lang, n in sizes.items() for _ in range(n)]
    got = query(spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_more_than_one_persisted_level(spark, query):
    """A tree of 5 levels over three persisted ones, another at an exact power, repeated rows and ids."""
    rows = [dict(doc_id=i // 2, text=f"Text {i % 700}", lang="en", source="s", n_chars=1) for i in range(4500)]
    rows += [dict(doc_id=i, text=f"Wort {i}", lang="de", source=None, n_chars=2) for i in range(512)]
    rows += [dict(doc_id=7, text="same", lang="fr", source="x", n_chars=4)] * 600 + [dict(doc_id=None, text="null id", lang="fr", source="x", n_chars=4)]
    got = query(spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA).repartition(7))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_only_every_third_level_is_stored(spark, tmp_path):
    leaves = spark.range(1000).select(F.lit("=a").alias("tree"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("node"))
    last = m.build(leaves, ["doc_id"], [], str(tmp_path))
    assert [spark.read.parquet(f"{tmp_path}/level-{k}").count() for k in range(last + 1)] == [1000, 2, 1]


def test_empty_table_and_clashing_names(spark, query):
    df = spark.createDataFrame([(1, "A", "en", "s", 1)], SCHEMA)
    for c in ("tree", "node", "pos", "steps", "end", "up", "l0", "items", "leaf", "forged", "salt", "at", "part"):
        df = df.withColumn(c, F.lit(1))
    assert query(df).collect()[0]["leaf"] == leaf(dict(doc_id=1, text="A", lang="en", source="s", n_chars=1))
    assert m.manifest(spark.createDataFrame([], "lang string, doc_id long, leaf string, forged string"), ["forged"]).count() == 0
