"""Operators that SQL cannot express, against brute force, the named library or held-out labels."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from aerolith.llm import (decontamination, language_id, packing, quality_classifier, quality_rules, sharding, simhash_dedup,
                          substring_exact, toxicity)

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas().itertuples(index=False, name=None))


def brute_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """id -> smallest id reachable over links of at most two bits."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 2 and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_simhash(spark, texts):
    got = simhash_dedup.op4_simhash_dedup(spark, SF).toPandas()
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    assert {i: int(f, 16) for i, f in zip(got.doc_id, got.fingerprint)} == prints
    assert dict(zip(got.doc_id, got.component_id)) == brute_components(prints)


@pytest.mark.parametrize("dense", [512, 3])
def test_links_keep_components(spark, monkeypatch, dense):
    """A family of fingerprints a few bits apart, under keys with few and with many fingerprints."""
    monkeypatch.setattr(simhash_dedup, "DENSE", dense)
    rng = np.random.default_rng(3)
    prints = {}
    for i in range(160):
        bits = rng.choice(64, rng.integers(0, 5), replace=False) if i % 2 else rng.choice(6, rng.integers(0, 4), replace=False)
        prints[i] = 0x123456789ABCDEF0 ^ sum(1 << int(b) for b in bits)
    signed = [(i, x - 2**64 if x >= 2**63 else x) for i, x in prints.items()]
    fps = spark.createDataFrame(signed, "doc_id long, fp long")
    top = {r["a"]: r["b"] for r in simhash_dedup.contract(simhash_dedup.links(fps)).collect()}
    want = brute_components(prints)
    assert len({top.get(f, f) for _, f in signed}) == len(set(want.values()))
    assert all((top.get(fa, fa) == top.get(fb, fb)) == (want[a] == want[b]) for a, fa in signed for b, fb in signed)


def test_substring_exact(spark, texts):
    low = {}
    for i in sorted(texts):
        b = texts[i].encode()
        for j in range(len(b) - 49):
            low.setdefault(b[j:j + 50], i)
    want = {}
    for i, t in texts.items():
        b = t.encode()
        g = bytearray(len(b))
        for j in range(len(b) - 49):
            if low[b[j:j + 50]] < i:
                g[j:j + 50] = b"\1" * 50
        spans = sum(1 for j in range(len(b)) if g[j] and not (j and g[j - 1]))
        want[i] = (len(b), sum(g), spans, hashlib.sha256(bytes(c for c, z in zip(b, g) if not z)).hexdigest())
    got = substring_exact.op6_suffix_dedup(spark, SF).toPandas()
    assert {r[0]: tuple(r[1:]) for r in got.itertuples(index=False)} == want
    assert got.n_removed.sum() > 0


def test_substring_exact_in_pieces(spark, monkeypatch):
    """Documents longer than a chunk, runs of one byte and copies that overlap themselves."""
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("abcdefgh "), 4000))
    docs = {1: base, 2: "x" * 700 + base[500:1500], 3: "x" * 300, 4: base[3000:] + base[:60], 5: base[100:149], 6: "y" * 50 + "x" * 49}
    monkeypatch.setattr(substring_exact, "CHUNK", 256)
    rows = []
    for at in docs.items():
        rows.append(at)
    low = {}
    for i in docs:
        for j in range(len(docs[i]) - 49):
            low.setdefault(docs[i][j:j + 50], i)
    want = {}
    for i, t in docs.items():
        g = set()
        for j in range(len(t) - 49):
            if low[t[j:j + 50]] < i:
                g.update(range(j, j + 50))
        want[i] = len(g)
    got = substring_exact.removed(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in got.collect()} == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(min_size=11, max_size=11).map(lambda b: bytes(x & 1 for x in b)), min_size=1, max_size=40))
def test_radix_groups(rows):
    group = substring_exact.radix_groups(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), 11))
    for i, a in enumerate(rows):
        assert (group[i] >= 0) == (rows.count(a) > 1)
        assert all((group[i] == group[j]) == (a == b) for j, b in enumerate(rows) if group[i] >= 0)


def test_token_ids(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.vocabulary()[0])
    enc = packing.Encoder(*packing.vocabulary())
    odd = ["a  b", " lead", "trail  ", "tab\t x\n\n y", "漢字 кот", "<|endoftext|> x", "it's I'LL   x", "", "½ ²³ ٣ \x1c \x85 é"]
    for t in [*texts.values(), *odd]:
        assert enc.encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    got = packing.op9_best_fit_packing(spark, SF).toPandas()
    for i, t in texts.items():
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4")
        parts = got[got.doc_id == i].sort_values("piece")
        assert list(parts.piece) == list(range(len(parts))) and parts.length.sum() == len(ids)
        assert all(n == 1024 for n in list(parts.length)[1:])
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == c for s, n, c in zip(parts.start, parts.length, parts.ids_crc32))
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert list(seq.offset) == [0, *seq.length.cumsum()[:-1]] and seq.length.sum() <= 1024
    least = -(-got.length.sum() // 1024)
    assert got.sequence_id.nunique() <= 1.02 * least + 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=60))
def test_place(lengths):
    """Each piece goes where the sum of squares is least among the open bins with room."""
    bin_of, offset = packing.place(np.array(lengths, np.int64), 32)
    level = {}
    for n, b, o in zip(lengths, bin_of.tolist(), offset.tolist()):
        assert level.get(b, 0) == o

        def cost(changed, to):
            open_ = [to if k == changed else v for k, v in level.items()] + ([to] if changed not in level else [])
            return sum(c * c for c in np.unique([x for x in open_ if x < 32], return_counts=True)[1].tolist())

        room = [k for k, v in level.items() if v + n <= 32]
        assert (b in room) if room else (b not in level)
        assert all(cost(b, o + n) <= cost(k, level[k] + n) for k in room)
        level[b] = o + n


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x alpha beta gamma"), (2, "alpha beta x gamma"), (3, "gamma x x x x alpha")], "doc_id long, text string")
    near = {s: {r["doc_id"] for r in decontamination.report(docs, bench, slop=s).where("contaminated").collect()} for s in (0, 1)}
    assert near == {0: {1}, 1: {1, 2}}


def test_windows_in_blocks(spark, monkeypatch):
    whole = decontamination.op5_decontamination(spark, SF).toPandas().sort_values("doc_id").values.tolist()
    monkeypatch.setattr(decontamination, "WINDOWS", 150)
    assert decontamination.op5_decontamination(spark, SF).toPandas().sort_values("doc_id").values.tolist() == whole


def test_language_held_out(spark):
    got = language_id.op10_language_id(spark, SF_LABELS).toPandas()
    lang = spark.read.parquet(f"{SF_LABELS}/documents.parquet").select("doc_id", "lang").toPandas()
    m = got.merge(lang, on="doc_id")
    assert (m.lang_pred == m.lang)[m.held_out].mean() > 0.95


def test_toxicity_held_out(spark):
    got = toxicity.op7_toxicity(spark, SF_LABELS).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    m = got.merge(spark.read.parquet(f"{SF_LABELS}/labels.parquet").toPandas(), on="doc_id")
    m = m[m.held_out]
    rank, bad = m.score.rank(), m.toxic == 1
    auc = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.9 and (m.predicted[~bad].mean() < 0.06)


def test_toxicity_scores_pairs():
    """Pairs that are toxic only together: the factors tell classes apart that no sum of single weights does."""
    rows = [(int(a == b), np.array(sorted([10 + a, 20 + b]), np.int32)) for a in (0, 1) for b in (0, 1)]
    factor = np.zeros((4, toxicity.FACTORS))
    factor[:, 0] = [1, -1, 1, -1]
    model = toxicity.Model(np.array([10, 11, 20, 21]), 0.0, np.zeros(4), factor)
    assert all((model.logit(model.rows(s)) > 0) == bool(y) for y, s in rows)


def test_toxicity_fits_pairs():
    """Terms toxic only together, each as common in clean texts, among other words: the fit finds them."""
    rng = np.random.default_rng(1)

    def rows(n):
        out = []
        for _ in range(n):
            a, b = rng.integers(0, 2, 2)
            out.append((int(a == b), np.array(sorted([10 + a, 20 + b, *(100 + rng.choice(500, 10, replace=False))]), np.int32)))
        return out

    model = toxicity.fit(rows(400))
    assert np.mean([(model.logit(model.rows(s)) > 0) == bool(y) for y, s in rows(400)]) > 0.9


def test_toxicity_fits_rare_insults():
    """Insults seen 3 to 6 times, as many toxic texts as clean ones."""
    rng = np.random.default_rng(1)
    words = lambda *more: np.array(sorted([*more, *(100 + rng.choice(12, 4, replace=False))]), np.int32)
    insults = [j for j in range(8) for _ in range(3 + j % 4)]
    model = toxicity.fit([(1, words(j)) for j in insults] + [(0, words()) for _ in insults])
    bad = [model.logit(model.rows(words(j))) for j in range(8) for _ in range(20)]
    good = [model.logit(model.rows(words())) for _ in range(160)]
    assert np.mean(np.array(bad)[:, None] > np.array(good)) > 0.9


def test_quality_held_out(spark):
    got = quality_classifier.op3_quality_classifier(spark, SF_LABELS).toPandas()
    m = got.merge(spark.read.parquet(f"{SF_LABELS}/labels.parquet").toPandas(), on="doc_id")
    m = m[m.held_out]
    assert (m.kept == (m.quality == 1)).mean() > 0.9


def test_sharding_balance_and_rebalance(spark):
    got = sharding.op2_sharding(spark, SF_LABELS).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(size) == 24 and size.max() - size.min() <= got["size"].max()
    d = sharding.digest(spark.read.parquet(f"{SF_LABELS}/documents.parquet"))
    weights = sharding.slot_bytes(d)
    one = sharding.edit_map(weights, 24)
    two = sharding.edit_map(weights, 25, one, version=2).toPandas().merge(one.toPandas(), on="slot")
    moved = two[two.shard_x != two.shard_y]
    assert 0 < moved.bytes_x.sum() < 0.1 * two.bytes_x.sum() and (two.shard_x == 24).any()
    same = sharding.edit_map(weights, 24, one, version=2).toPandas().merge(one.toPandas(), on="slot")
    assert same[same.shard_x != same.shard_y].bytes_x.sum() < 0.15 * same.bytes_x.sum()


def test_pipeline(spark, texts):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = stages["quality rules"](spark, docs, SF)
    kept = {r["doc_id"] for r in quality_rules.op1_quality_rules(spark, SF).where("kept").collect()}
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == kept
    rest = docs.where(docs.doc_id.isin(sorted(kept)))
    one = {r["doc_id"] for r in stages["simhash near-dedup"](spark, rest, SF).collect()}
    top = brute_components({i: brute_fingerprint(texts[i]) for i in kept})
    assert one == set(top.values())
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed.doc_id) <= one and len(packed)
