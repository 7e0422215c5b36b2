"""Substring de-duplication against a plain re-statement, wrapped copies, and odd inputs."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from aerolith.llm import substring_dedup as sd

BLANK = "\x20\x09-\x0D"


def brute_units(text):
    """[(unit, first word, words)] by the stated rule."""
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(f"[^{BLANK}]+", text)]
    value = [sum(b * k for k, b in enumerate(w.encode("utf-8", "surrogatepass"), 1)) % sd.PRIME for w in words]
    cuts = []
    for i, w in enumerate(words):
        new = i == 0 or words[i - 1][-1] in ".!?" or words[i - 1] == w or (value[i - 1] * 3 + value[i] * 5) % sd.PRIME % sd.CUT == 0
        if new or i - cuts[-1] >= sd.MOST_WORDS:
            cuts.append(i)
    return [(" ".join(words[a:e]), a, e - a) for a, e in zip(cuts, [*cuts[1:], len(words)])]


def brute(rows, run_words):
    """Text and spans of each row; rows are (rank, text), equal rows one document."""
    units = {r: brute_units(r[1]) for r in set(rows) if r[1]}
    first = {}
    for r in sorted(units):
        for k, (u, _, _) in enumerate(units[r]):
            first.setdefault(u, (r, k))
    out = {}
    for r, us in units.items():
        text = r[1]
        starts = [m.start() for m in re.finditer(f"[^{BLANK}]+", text)] + [len(text)]
        spans, run = [], None
        for k, (u, a, n) in [*enumerate(us), (len(us), (None, 0, 0))]:
            if u is not None and first[u] != (r, k):
                run = (run[0], a + n) if run else (a, a + n)
            else:
                if run and run[1] - run[0] >= run_words:
                    spans.append((starts[run[0]], starts[run[1]]))
                run = None
        left, at = "", 0
        for s, e in spans:
            left, at = left + text[at:s], e
        out[r] = (left + text[at:], [(s, e - s) for s, e in spans])
    return [(r[0], *out.get(r, (r[1], []))) for r in rows]


def got(df):
    return [(r["doc_id"], r["text"], [(s["start"], s["len"]) for s in r["removed_spans"]]) for r in df.collect()]


WORDS = ["a", "The", "the", "b.", "\u00e9t\u00e9", "\u00dfx", "\U0001f600", "long-word", "x" * 40, "no\u00a0break", "end!", "7"]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=60), st.sampled_from([" ", "\n", " \t\n", "\x0b\x0c\r"]))
def test_units(words, gap):
    text = gap.join(words)
    digests, sizes = sd.units(text)
    want = brute_units(text)
    assert sizes == [n for _, _, n in want]
    by = dict(zip([u for u, _, _ in want], digests))
    assert [by[u] for u, _, _ in want] == digests and len(set(by.values())) == len(by)


def test_units_in_parts(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice(WORDS) for _ in range(5000))
    whole = sd.units(text)
    monkeypatch.setattr(sd, "PART", 100)
    assert sd.units(text) == whole
    same = "w " * 3000
    assert sum(sd.units(same)[1]) == 3000


def test_against_brute(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK_UNITS", 300)
    rng = random.Random(5)
    word = [f"w{i}" for i in range(300)] + ["the", "of", "so.", "it!"] * 20
    passages = [" ".join(rng.choice(word) for _ in range(rng.randint(5, 120))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [" ".join(rng.choice(word) for _ in range(rng.randint(0, 40))) for _ in range(3)] + rng.sample(passages, rng.randint(0, 3))
        rng.shuffle(parts)
        rows.append((i if rng.random() < 0.95 else 7, rng.choice(["\n", " ", "\n\n"]).join(parts)))
    rows += rows[:10] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    # rows with one id and different texts are ordered by a hash of the text
    keys = {r["text"]: r["k"] for r in df.select("text", F.xxhash64("text").alias("k")).collect()}
    ranked = [((i, keys[t]), t) for i, t in rows]
    want = [(r[0], t, s) for r, t, s in brute(ranked, sd.RUN_WORDS)]
    assert sorted(got(sd.apply(df)), key=str) == sorted(want, key=str)
    assert any(s for _, _, s in want)


def test_wrapped_copies(spark):
    """One passage as one line, wrapped at 7 words, inside a longer line, and in capitals: only the first stays."""
    rng = random.Random(3)
    passage = [f"{rng.choice('abcdef')}{rng.randrange(10**6)}" + ("." if i % 9 == 8 else "") for i in range(63)]
    wrapped = "\n".join(" ".join(passage[i:i + 7]) for i in range(0, 63, 7))
    inside = "some words before it " + " ".join(passage) + " and some after"
    rows = [(1, " ".join(passage)), (2, wrapped), (3, inside), (4, "  " + "\t".join(passage).upper() + "\n")]
    out = {r[0]: r[1] for r in got(sd.apply(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert out[1] == rows[0][1] and out[2] == "" and out[4] == "  "
    left = out[3].split()
    assert len(left) <= 8 + 20 and left[:4] == "some words before it".split() and left[-3:] == "and some after".split()


def test_stock_phrases_stay(spark):
    rows = [(i, f"unique{i} opening. All rights are reserved by the owner. Unique{i} ending.") for i in range(20)]
    assert all(not s for _, _, s in got(sd.apply(spark.createDataFrame(rows, "doc_id long, text string"))))


def test_edges(spark):
    p = " ".join(f"w{i}" for i in range(40)) + "."
    rows = [(2, f"{p}\nown.\n{p}"), (1, f"head.\n{p.upper()}"), (None, p), (3, None), (4, ""), (2, f"{p}\nown.\n{p}"), (5, p), (6, " \t\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("rank", "key", "runs", "row", "done", "words", "text.x", "block", "c0"):
        df = df.withColumn(c, F.lit(1))
    out = sd.apply(df)
    assert out.columns == [*df.columns, "removed_spans"]
    by = sorted(((r["doc_id"], r["text"], len(r["removed_spans"])) for r in out.collect()), key=str)
    assert [x for x in by if x[0] in (1, 3, 4, 6)] == [(1, rows[1][1], 0), (3, None, 0), (4, "", 0), (6, " \t\n", 0)]
    assert [x[1] for x in by if x[0] in (5, None)] == ["", ""]
    assert [x[1:] for x in by if x[0] == 2] == [("own.\n", 2)] * 2
    assert sd.apply(df.where("false")).count() == 0
    assert sd.apply(df, spans_col=None).columns == df.columns


@pytest.mark.parametrize("name", ["removed_spans", "a.b", "a`b"])
def test_pipeline_stage_keeps_columns(spark, name):
    p = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, p, "en", 7), (2, p, "en", 7), (3, None, None, None)], "doc_id long, text string, lang string, n_chars int").withColumn(name, F.lit("x"))
    out = corpus_pipeline.cut_repeats(spark, df, "")
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, p, "en", len(p), "x"), (2, "", "en", 0, "x"), (3, None, None, None, "x")], key=str)
