"""Quality classifier by co-training.

Two logistic classifiers see each document from different sides: its text (hashed terms of the whole text, and beside them
symbols, capitals, repetition, word and sentence lengths) and its page metadata (source, language, stated length). Over
``ROUNDS`` rounds each is fitted on the labels and on the confident pseudo-labels of the other, which
reach documents that have no label. In the end a third logistic model, fitted on a
fold of labels that neither has seen, calibrates and combines the two views.

Fitting runs on Spark over all labelled and pseudo-labelled rows; the table of both views is
made in one pass over the texts and stored (a sparse vector of at most ``TERMS`` terms a document). Pseudo-labels are
expressions over that table, so nothing is materialised between rounds.

Folds by crc32(doc_id as text) mod 5: 0 is held out, 1 calibrates, the rest is learned from.

Defined results: a null or empty text has zero counts; null metadata count as a value of their own; rows with a
null id are scored and never labelled; labels that disagree about an id count as their largest; an input without one
of the columns ``lang``, ``source`` and ``n_chars`` counts as having nulls there;
without labels of both classes every score is the share of good labels, or 0.5 without any; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import ASCII_SPACE, stored, table
from aerolith.llm.quality_rules import counts

ROUNDS = 3
#: a view's pseudo-label counts from this probability (or below its complement)
CONFIDENT = 0.95
#: slots for the hashed values of the metadata columns, and for the hashed terms of a text
HASHED, TERMS = 64, 1 << 12

_RATIOS = ["n_symbols / greatest(n_words, 1)", "n_capitals / greatest(word_chars, 1)", "n_repeat_words / greatest(n_words, 1)",
           "n_dup_lines / greatest(n_lines, 1)", "word_chars / greatest(n_words, 1)", "n_bangs / greatest(n_words, 1)",
           "n_stops / greatest(n_words, 1)", "ln(1 + n_words)"]
#: most labelled documents that are learned from and calibrated on, those whose ids hash lowest
LABELLED = 200_000
#: factor of the ratios, which are mostly far below 1: their weights are penalised less by its square
SCALE = 20
#: the class of ASCII white space inside a SQL string
_SPACE = ASCII_SPACE.replace("\\", "\\\\")
_META = {"lang": "string", "source": "string", "n_chars": "long"}


def views(docs: DataFrame) -> DataFrame:
    """doc_id, text_x and meta_x: the features of both views as vectors."""
    rows = docs.select("doc_id", "text", *[(F.col(c) if c in docs.columns else F.lit(None)).cast(t).alias(c) for c, t in _META.items()])
    d = counts(rows, carry=["text", *_META])
    named = lambda c: f"concat('{c}=', coalesce(row.{c}, ''))"
    d = d.selectExpr("doc_id", f"array({', '.join(f'cast({SCALE} * ({x}) AS double)' for x in _RATIOS)}) AS ratios",
                     f"split(lower(coalesce(row.text, '')), '[{_SPACE}]+') AS words", f"array({named('lang')}, {named('source')}) AS page",
                     "array(cast(ln(1 + greatest(coalesce(row.n_chars, 0), 0)) AS double)) AS size")
    d = d.withColumn("ratios", array_to_vector("ratios")).withColumn("size", array_to_vector("size"))
    d = HashingTF(numFeatures=TERMS, binary=True, inputCol="words", outputCol="terms").transform(d)
    d = Normalizer(p=2.0, inputCol="terms", outputCol="share").transform(d)
    d = HashingTF(numFeatures=HASHED, binary=True, inputCol="page", outputCol="page_x").transform(d)
    for c, n in (("ratios", len(_RATIOS)), ("size", 1)):
        d = VectorSizeHint(inputCol=c, size=n, handleInvalid="optimistic").transform(d)
    d = VectorAssembler(inputCols=["ratios", "share"], outputCol="text_x").transform(d)
    return VectorAssembler(inputCols=["size", "page_x"], outputCol="meta_x").transform(d).select("doc_id", "text_x", "meta_x")


def _fit(rows: DataFrame, x: str, y: str):
    # not scaled by deviation: a term seen once would weigh as much as a common one
    lr = LogisticRegression(featuresCol=x, labelCol="label", regParam=3e-5, maxIter=25, standardization=False, probabilityCol="_p", rawPredictionCol="_r", predictionCol="_c")
    return lr.fit(rows.where(F.col(y).isNotNull()).select(x, F.col(y).cast("double").alias("label")))


def _probability(df: DataFrame, model, name: str) -> DataFrame:
    """``df`` with the model's probability of class 1."""
    return model.transform(df).withColumn(name, vector_to_array("_p")[1]).drop("_p", "_r", "_c")


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, p_text, p_meta, score, kept for every document."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5, F.lit(-1))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna().groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    # at most LABELLED rows are broadcast, so no vector is shuffled
    base = stored(views(docs).join(F.broadcast(known), "doc_id", "left").withColumn("fold", fold), "views")
    base = base.withColumn("y", F.when(F.col("fold") >= 2, F.col("quality")))
    seen = {(r["fold"], r["quality"]): r["n"] for r in base.where("fold >= 1 AND quality IS NOT NULL").groupBy(F.least("fold", F.lit(2)).alias("fold"), "quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = seen.get((2, 1), 0), seen.get((2, 0), 0)
    held = (F.col("fold") == 0).alias("held_out")
    if not good or not bad:
        share = good / (good + bad) if good + bad else 0.5
        return base.select("doc_id", held, *[F.lit(share).alias(c) for c in ("p_text", "p_meta", "score")], F.lit(share >= 0.5).alias("kept"))
    sure = lambda p: F.when(F.col(p) >= CONFIDENT, 1).when(F.col(p) <= 1 - CONFIDENT, 0)
    # held-out and calibration rows never teach a view, not even by pseudo-labels
    state = base.withColumn("y_text", F.col("y")).withColumn("y_meta", F.col("y"))
    for _ in range(rounds):
        state = _probability(state, _fit(state, "text_x", "y_text"), "p_text")
        state = _probability(state, _fit(state, "meta_x", "y_meta"), "p_meta")
        teach = (F.col("fold") >= 2) | (F.col("fold") == -1)
        state = state.select(*base.columns, "p_text", "p_meta",
                             F.coalesce("y", F.when(teach, sure("p_meta"))).alias("y_text"), F.coalesce("y", F.when(teach, sure("p_text"))).alias("y_meta"))
    logit = lambda p: F.log(F.greatest(F.col(p), F.lit(1e-9)) / F.greatest(1 - F.col(p), F.lit(1e-9)))
    both = state.withColumn("both", array_to_vector(F.array(logit("p_text"), logit("p_meta")))).withColumn("y_both", F.when(F.col("fold") == 1, F.col("quality")))
    if seen.get((1, 0)) and seen.get((1, 1)):
        scored = _probability(both, _fit(both, "both", "y_both"), "score")
    else:
        scored = both.withColumn("score", (F.col("p_text") + F.col("p_meta")) / 2)
    return scored.select("doc_id", held, "p_text", "p_meta", "score", (F.col("score") >= 0.5).alias("kept"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co_train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op3_quality_classifier": op3_quality_classifier}
SQL: dict[str, str] = {}
