"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation-maximisation
estimates each rule's accuracy, the chance that its vote is right where it votes, and the
posterior probability of "good" replaces "all rules must pass". Rules that mostly agree
with the others gain weight, rules that mostly conflict lose it; each accuracy is
drawn to ``ACCURACY`` by as many votes as the rule casts, so a corpus without conflicts
cannot flip the classes. The share of good documents before any vote is a parameter
(``BALANCE``). A document without votes has that posterior.

The counts are one pass of SQL expressions over the documents; no text is shuffled.
Votes collapse to at most 3 ^ (number of rules) patterns with their counts, so the
iterations run as one SQL fold over a single row of bounded size, and the posterior
per pattern is joined back to the stored counts by broadcast (that bounded table).
Everything is DataFrame or SQL expressions.

Defined results: a null or empty text has no words, fails the base rules, gets no votes and is not
kept; null ids pass through; repeated rows give repeated results; an empty table gives no
rows; extra columns are ignored by ``score`` and kept by ``filter_good``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import ASCII_SPACE, checkpoint, table

ITERATIONS = 12
THRESHOLD = 0.5
BALANCE = 0.5
ACCURACY = 0.9
#: rule: (votes bad when, votes good when), over the counts of ``counts``
RULES = {
    "symbols": ("10 * n_symbols > n_words", "false"),
    "capitals": ("100 * n_capitals > 30 * word_chars", "false"),
    "repeats": ("100 * n_repeat_words > 30 * n_words", "false"),
    "lines": ("100 * n_dup_lines > 50 * n_lines", "false"),
    "word_length": ("word_chars < 2 * n_words OR word_chars > 15 * n_words", "false"),
    "bangs": ("5 * n_bangs > n_words", "false"),
    "sentences": ("false", "n_stops > 0 AND 50 * n_symbols <= n_words AND n_words BETWEEN 3 * n_stops AND 60 * n_stops"),
}
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

#: words in 3-word windows that occur twice or more; hashes only tell whether any does, the rest compares the words
_REPEATS = """
CASE WHEN size(w) < 4 THEN 0 ELSE element_at(transform(array(transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))), h ->
  CASE WHEN size(array_distinct(h)) = size(h) THEN 0 ELSE
    element_at(transform(array(sort_array(transform(sequence(0, size(w) - 3), i -> struct(concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS s, i AS i)))), s ->
      element_at(transform(array(sort_array(transform(filter(s, (x, k) -> (k > 0 AND s[k - 1].s = x.s) OR (k < size(s) - 1 AND s[k + 1].s = x.s)), x -> x.i))), p ->
        aggregate(transform(p, (x, k) -> IF(k = size(p) - 1, 3, least(3, p[k + 1] - x))), 0, (a, x) -> a + x)), 1)), 1)
  END), 1) END"""


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """doc_id and the counts the rules use; columns to ``carry`` come along as the struct ``row``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []
    kept = ["doc_id", *["row"] * len(row)]
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"), *row)
    d = d.select(*kept, "t", F.filter(F.split("t", f"[{ASCII_SPACE}]+"), lambda x: x != "").alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{ASCII_SPACE}]")).alias("l"))
    without = lambda chars: (F.char_length("t") - F.char_length(F.regexp_replace("t", chars, ""))).cast("long")
    # Always 0, but not deterministic to the optimizer: a filter on the counts then stays above this projection. Pushed
    # below it, the filter would hold the split itself inside the functions over its words, and split once per word.
    zero = F.least(F.monotonically_increasing_id(), F.lit(0))
    return d.select(
        *kept, (F.size("w") + zero).cast("long").alias("n_words"), F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        without("[#*$%&|<>]+").alias("n_symbols"), (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.expr(_REPEATS).cast("long").alias("n_repeat_words"), F.size("l").cast("long").alias("n_lines"),
        without("[A-Z]+").alias("n_capitals"), without("!+").alias("n_bangs"),
        (without(f"[.?][{ASCII_SPACE}]") / 2).cast("long").alias("n_stops"))


def votes(counted: DataFrame) -> DataFrame:
    """``counted`` with ``votes`` (array of -1, 0, 1 in the order of RULES) and ``base_failed``."""
    each = ", ".join(f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END" for bad, good in RULES.values())
    return counted.withColumn("votes", F.expr(f"array({each})")).withColumn("base_failed", F.expr(BASE_FAILED))


def posteriors(patterns: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """votes, posterior and the estimated accuracies, from the vote patterns and their counts ``n``."""
    last = len(RULES) - 1
    right = "CASE p.votes[j] WHEN 1 THEN p.n * p.q WHEN -1 THEN p.n * (1D - p.q) ELSE 0D END"
    cast_ = "aggregate(post, 0D, (s, p) -> s + IF(p.votes[j] <> 0, p.n, 0D))"
    model = ("element_at(transform(array({post}), post -> transform(sequence(0, " + str(last) + f"), j -> (aggregate(post, 0D, (s, p) -> s + {right}) "
             f"+ {ACCURACY}D * greatest(1D, {cast_})) / ({cast_} + greatest(1D, {cast_})))), 1)")
    odds = (f"ln({BALANCE}D / (1D - {BALANCE}D)) + aggregate(sequence(0, {last}), 0D, (s, j) -> s + p.votes[j] * ln(m[j] / (1D - m[j])))")
    post = f"transform(pats, p -> struct(p.votes AS votes, p.n AS n, 1D / (1D + exp(-({odds}))) AS q))"
    start = f"transform(sequence(0, {last}), j -> {ACCURACY}D)"
    row = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("pats"))
    fit = row.selectExpr("pats", f"aggregate(sequence(1, {iterations}), {start}, (m, i) -> {model.format(post=post)}) AS m")
    return fit.selectExpr("m", f"explode({post}) AS x").selectExpr("x.votes AS votes", "x.q AS posterior", "m AS accuracies")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts, votes, base_failed, posterior and kept for each document."""
    v = checkpoint(votes(counts(docs, id_col, text_col)))
    post = posteriors(v.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))).select("votes", "posterior")
    return v.join(F.broadcast(post), "votes").withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def filter_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The counts are made again next to the row instead of joining decisions to it, so texts are never
    shuffled; only the posterior per pattern is joined, by broadcast.
    """
    patterns = votes(counts(docs, id_col, text_col)).groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    post = checkpoint(posteriors(checkpoint(patterns)).select("votes", "posterior"))
    v = votes(counts(docs, id_col, text_col, carry=docs.columns)).join(F.broadcast(post), "votes")
    return (v.where(~F.col("base_failed") & (F.col("posterior") >= THRESHOLD))
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    """The same counts, and the iterations as a chain of small tables."""
    names = list(RULES)
    vote = [f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v_{x}" for x, (bad, good) in RULES.items()]
    cols = ", ".join(f"v_{x}" for x in names)
    fit = ", ".join(
        f"(sum(CASE v_{x} WHEN 1 THEN n * q WHEN -1 THEN n * (1 - q) ELSE 0 END) + {ACCURACY} * greatest(1, sum(CASE WHEN v_{x} <> 0 THEN n ELSE 0 END))) / "
        f"(sum(CASE WHEN v_{x} <> 0 THEN n ELSE 0 END) + greatest(1, sum(CASE WHEN v_{x} <> 0 THEN n ELSE 0 END)))::DOUBLE AS a_{x}" for x in names)
    odds = f"ln({BALANCE} / (1 - {BALANCE})) + " + " + ".join(f"v_{x} * ln(a_{x} / (1 - a_{x}))" for x in names)
    steps = ["m0 AS MATERIALIZED (SELECT " + ", ".join(f"{ACCURACY}::DOUBLE AS a_{x}" for x in names) + ")"]
    for i in range(1, ITERATIONS + 1):
        steps += [f"q{i} AS MATERIALIZED (SELECT {cols}, n::DOUBLE AS n, 1 / (1 + exp(-({odds}))) AS q FROM pats, m{i - 1})",
                  f"m{i} AS MATERIALIZED (SELECT {fit} FROM q{i})"]
    space = "[\\x20\\x09-\\x0D]+"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, [x for x in regexp_split_to_array(t, '{space}') if x <> ''] AS w,
  [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS l FROM t),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) > 1 AS again
  FROM (SELECT doc_id, w, UNNEST(range(1, greatest(len(w) - 1, 1))) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM g, (SELECT UNNEST([0, 1, 2]) AS o) WHERE again GROUP BY doc_id),
c AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
  length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals, length(t) - length(replace(t, '!', '')) AS n_bangs,
  (length(t) - length(regexp_replace(t, '[.?][\\x20\\x09-\\x0D]', '', 'g'))) // 2 AS n_stops
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
v AS (SELECT *, {", ".join(vote)}, ({BASE_FAILED}) AS base_failed FROM c),
pats AS MATERIALIZED (SELECT {cols}, count(*) AS n FROM v GROUP BY {cols}),
{", ".join(steps)},
final AS (SELECT {cols}, 1 / (1 + exp(-({odds}))) AS q FROM pats, m{ITERATIONS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND q >= {THRESHOLD} AS kept
FROM v JOIN final USING ({cols})"""


QUERIES = {"op1_quality_rules": op1_quality_rules}
SQL = {"op1_quality_rules": _sql()}
