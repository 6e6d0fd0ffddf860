"""Queries on classifier metrics, fed by formula scores over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from classkit.operators import metrics, ranking, split
from classkit.plans.inputs import (
    JUDGED,
    LINES,
    SEED,
    folds_sql,
    judged_documents,
    lines,
    table,
)
from classkit.plans.registry import query
from classkit.plans.report_sql import report_sql

# --- a formula classifier on order lines: three classes ----------------------

LINE_SCORED = f"""{LINES}, scored AS (
  SELECT line_id, l_linenumber, l_returnflag AS label,
    CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN 'N' ELSE 'R' END AS prediction FROM lines)"""


def line_scored(spark, sf_dir):
    q = F.col("l_quantity")
    predicted = F.when(q < 17, "A").when(q < 34, "N").otherwise("R")
    df = lines(spark, sf_dir)
    return df.select("line_id", "l_linenumber", F.col("l_returnflag").alias("label"), predicted.alias("prediction"))


# --- a formula score on order lines: two classes, many distinct scores -------

LINE_BINARY = f"""{LINES}, scored AS (
  SELECT line_id, l_linenumber, (l_returnflag = 'R')::INTEGER AS label, l_extendedprice / (l_extendedprice + 30000) AS score,
    (l_extendedprice / (l_extendedprice + 30000) >= 0.5::DOUBLE)::INTEGER AS prediction FROM lines)"""


def line_binary(spark, sf_dir):
    price = F.col("l_extendedprice")
    df = lines(spark, sf_dir).withColumn("score", price / (price + 30000))
    return df.select(
        "line_id",
        "l_linenumber",
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("prediction"),
    )


# --- formula scores on judged documents: two classes, imbalanced -------------

MODELS = """models AS (
  SELECT doc_id, 'length' AS model, label, n_chars / (n_chars + 500) AS score FROM judged
  UNION ALL SELECT doc_id, 'digits', label, 1 / (1 + n_digits) FROM judged
  UNION ALL SELECT doc_id, 'lines', label, n_lines / (n_lines + n_words) FROM judged),
scored AS (SELECT *, (score >= 0.5::DOUBLE)::INTEGER AS prediction FROM models)"""
DOC_SCORED = f"{JUDGED}, {MODELS}"


def document_models(spark, sf_dir):
    """One long table of three models' scores on the same documents."""
    scores = F.array(
        F.struct(F.lit("length").alias("model"), (F.col("n_chars") / (F.col("n_chars") + 500)).alias("score")),
        F.struct(F.lit("digits").alias("model"), (1 / (1 + F.col("n_digits"))).alias("score")),
        F.struct(F.lit("lines").alias("model"), (F.col("n_lines") / (F.col("n_lines") + F.col("n_words"))).alias("score")),
    )
    df = judged_documents(spark, sf_dir).select("doc_id", "label", F.inline(scores))
    return df.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def _round(df, *names, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


@query("accuracy", f"WITH {LINE_SCORED} SELECT round(avg((label = prediction)::INT), 9) AS accuracy FROM scored")
def accuracy(spark, sf_dir):
    return _round(metrics.accuracy(line_scored(spark, sf_dir)), "accuracy", digits=9)


@query("error_rate", f"WITH {LINE_SCORED} SELECT round(1 - avg((label = prediction)::INT), 9) AS error_rate FROM scored")
def error_rate(spark, sf_dir):
    return _round(metrics.error_rate(line_scored(spark, sf_dir)), "error_rate", digits=9)


CLASSES = "(SELECT unnest(['A', 'N', 'R', 'Z']) AS c)"
BINARY_CLASSES = "(SELECT unnest([0, 1])::INTEGER AS c)"


@query(
    "confusion_cells",
    f"""WITH {LINE_SCORED}
SELECT r.c AS label, p.c AS prediction, count(s.label) AS row_count
FROM {CLASSES} r CROSS JOIN {CLASSES} p LEFT JOIN scored s ON s.label = r.c AND s.prediction = p.c GROUP BY 1, 2""",
)
def confusion_cells(spark, sf_dir):
    cells = metrics.confusion_cells(line_scored(spark, sf_dir), labels=["A", "N", "R", "Z"])
    return cells.withColumnRenamed("rows", "row_count")


@query(
    "confusion_matrix",
    f"""WITH {LINE_SCORED}
SELECT c AS label, {", ".join(f"count(*) FILTER (label = c AND prediction = '{x}') AS pred_{x}" for x in "ANRZ")}
FROM {CLASSES} k, scored GROUP BY c""",
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(line_scored(spark, sf_dir), ["A", "N", "R", "Z"])


@query(
    "confusion_from_data",
    f"""WITH {DOC_SCORED}, classes AS (SELECT model, label AS c FROM scored UNION SELECT model, prediction FROM scored)
SELECT r.model, r.c AS label, p.c AS prediction, count(s.doc_id) AS row_count
FROM classes r JOIN classes p USING (model)
LEFT JOIN scored s ON s.model = r.model AND s.label = r.c AND s.prediction = p.c GROUP BY 1, 2, 3""",
)
def confusion_from_data(spark, sf_dir):
    cells = metrics.confusion_cells(document_models(spark, sf_dir), by=["model"])
    return cells.withColumnRenamed("rows", "row_count")


@query(
    "class_scores",
    f"""WITH {LINE_SCORED}, t AS (
  SELECT c, count(*) FILTER (label = c AND prediction = c)::DOUBLE AS tp, count(*) FILTER (label = c) AS support,
    count(*) FILTER (prediction = c) AS predicted FROM {CLASSES} k, scored GROUP BY c)
SELECT c AS label, round(coalesce(tp / nullif(predicted, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(support, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(support + predicted, 0), 0), 6) AS f1, support FROM t""",
)
def class_scores(spark, sf_dir):
    scores = metrics.class_scores(line_scored(spark, sf_dir), labels=["A", "N", "R", "Z"]).drop("tp")
    return _round(scores, "precision", "recall", "f1")


@query("classification_report", f"WITH {LINE_SCORED}, {report_sql('scored', CLASSES, ' cyl', 4)}")
def classification_report(spark, sf_dir):
    return metrics.classification_report(
        line_scored(spark, sf_dir), labels=["A", "N", "R", "Z"], suffix=" cyl", digits=4
    )


@query(
    "report_named_classes",
    f"""WITH {LINE_BINARY}, {report_sql("scored", BINARY_CLASSES, "", 2).replace("concat(c, '')", "CASE c WHEN 0 THEN 'malignant' ELSE 'benign' END")}""",
)
def report_named_classes(spark, sf_dir):
    return metrics.classification_report(
        line_binary(spark, sf_dir), target_names={0: "malignant", 1: "benign"}, digits=2
    )


@query(
    "f1_scores",
    f"""WITH {DOC_SCORED}, t AS (
  SELECT model, c, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (label = c) AS support,
    count(*) FILTER (prediction = c) AS predicted FROM scored, {BINARY_CLASSES} k GROUP BY model, c),
f AS (SELECT *, coalesce(2.0::DOUBLE * tp / nullif(support + predicted, 0), 0) AS f1 FROM t)
SELECT model, round(max(f1) FILTER (c = 1), 6) AS f1_positive, round(max(f1) FILTER (c = 0), 6) AS f1_negative,
  round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM f GROUP BY model""",
)
def f1_scores(spark, sf_dir):
    scores = metrics.f1_scores(document_models(spark, sf_dir), by=["model"])
    return _round(scores, "f1_positive", "f1_negative", "f1_macro", "f1_weighted")


SUMMARY = [
    "accuracy",
    "f1_positive",
    "f1_negative",
    "f1_macro",
    "f1_weighted",
    "roc_auc",
    "average_precision",
    "log_loss",
]

AUC_SQL = """SELECT {by} (sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0::DOUBLE)
  / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)::DOUBLE) AS roc_auc FROM (
  SELECT *, rank() OVER ({part} ORDER BY score) + (count(*) OVER ({part2} score) - 1) / 2.0::DOUBLE AS r FROM scored) x"""


def auc_sql(by: str = "") -> str:
    """Mean ranks of the positives, ties averaged."""
    part = f"PARTITION BY {by}" if by else ""
    part2 = f"PARTITION BY {by}," if by else "PARTITION BY"
    return AUC_SQL.format(by=f"{by}," if by else "", part=part, part2=part2) + (f" GROUP BY {by}" if by else "")


def ap_sql(by: str = "") -> str:
    """Recall steps times precision, over falling distinct scores."""
    key = f"{by}," if by else ""
    part = f"PARTITION BY {by} " if by else ""
    whole = f"PARTITION BY {by}" if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"""SELECT {key} sum(pos / all_pos * cum_pos / cum_n) AS average_precision FROM (
  SELECT {key} pos, sum(pos) OVER ({part}ORDER BY score DESC) AS cum_pos, sum(n) OVER ({part}ORDER BY score DESC) AS cum_n,
    (sum(pos) OVER ({whole}))::DOUBLE AS all_pos
  FROM (SELECT {key} score, sum(label)::BIGINT AS pos, count(*) AS n FROM scored GROUP BY {key} score) g) c{tail}"""


@query("roc_auc", f"WITH {LINE_BINARY}, a AS ({auc_sql()}) SELECT round(roc_auc, 9) AS roc_auc FROM a")
def roc_auc(spark, sf_dir):
    return _round(ranking.roc_auc(line_binary(spark, sf_dir)), "roc_auc", digits=9)


@query(
    "average_precision",
    f"WITH {LINE_BINARY}, a AS ({ap_sql()}) SELECT round(average_precision, 9) AS average_precision FROM a",
)
def average_precision(spark, sf_dir):
    return _round(ranking.average_precision(line_binary(spark, sf_dir)), "average_precision", digits=9)


@query(
    "ranking_by_model",
    f"""WITH {DOC_SCORED}, a AS ({auc_sql("model")}), p AS ({ap_sql("model")})
SELECT model, round(roc_auc, 9) AS roc_auc, round(average_precision, 9) AS average_precision FROM a JOIN p USING (model)""",
)
def ranking_by_model(spark, sf_dir):
    out = ranking.ranking_metrics(document_models(spark, sf_dir), by=["model"])
    return _round(out, "roc_auc", "average_precision", digits=9)


LOSS = "-ln(least(greatest(CASE WHEN label = 1 THEN score ELSE 1 - score END, 2.220446049250313e-16), 1 - 2.220446049250313e-16))"


@query("log_loss", f"WITH {DOC_SCORED} SELECT model, round(avg({LOSS}), 6) AS log_loss FROM scored GROUP BY model")
def log_loss(spark, sf_dir):
    return _round(metrics.log_loss(document_models(spark, sf_dir), by=["model"]), "log_loss")


@query(
    "multiclass_log_loss",
    """WITH long AS (
  SELECT vec_id, label, list_max(embedding)::DOUBLE AS m, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos
  FROM embeddings),
p AS (SELECT vec_id, max(CASE WHEN pos = label THEN exp(x - m) END) / sum(exp(x - m)) AS p_true FROM long GROUP BY vec_id)
SELECT round(avg(-ln(p_true)), 6) AS log_loss FROM p""",
)
def multiclass_log_loss(spark, sf_dir):
    from classkit.functions import softmax

    df = table(spark, sf_dir, "embeddings").select(
        "label", softmax(F.col("embedding").cast("array<double>")).alias("p")
    )
    return _round(metrics.multiclass_log_loss(df), "log_loss")


FOLD_SCORED = f"{LINE_SCORED}, {folds_sql('f', 'scored', 'line_id', 'label')}"


def fold_scored(spark, sf_dir):
    return split.stratified_folds(line_scored(spark, sf_dir), "line_id", "label", 5, SEED)


@query(
    "fold_accuracy",
    f"WITH {FOLD_SCORED} SELECT fold, round(avg((label = prediction)::INT), 9) AS accuracy FROM f GROUP BY fold",
)
def fold_accuracy(spark, sf_dir):
    return _round(metrics.fold_accuracy(fold_scored(spark, sf_dir)), "accuracy", digits=9)


@query(
    "cross_validation_summary",
    f"""WITH {FOLD_SCORED}, a AS (SELECT fold, avg((label = prediction)::INT) AS accuracy FROM f GROUP BY fold)
SELECT count(*) AS folds, round(avg(accuracy), 9) AS accuracy_mean, round(stddev_pop(accuracy), 9) AS accuracy_sd FROM a""",
)
def cross_validation_summary(spark, sf_dir):
    out = metrics.cross_validation_summary(fold_scored(spark, sf_dir))
    return _round(out, "accuracy_mean", "accuracy_sd", digits=9)


@query(
    "model_comparison",
    f"""WITH {DOC_SCORED}, a AS ({auc_sql("model")}), p AS ({ap_sql("model")}),
b AS (SELECT model, avg((label = prediction)::INT) AS accuracy, avg({LOSS}) AS log_loss FROM scored GROUP BY model),
t AS (
  SELECT model, c, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (label = c) AS support,
    count(*) FILTER (prediction = c) AS predicted FROM scored, {BINARY_CLASSES} k GROUP BY model, c),
f AS (SELECT *, coalesce(2.0::DOUBLE * tp / nullif(support + predicted, 0), 0) AS f1 FROM t),
g AS (
  SELECT model, max(f1) FILTER (c = 1) AS f1_positive, max(f1) FILTER (c = 0) AS f1_negative, avg(f1) AS f1_macro,
    sum(f1 * support) / sum(support) AS f1_weighted FROM f GROUP BY model)
SELECT model, {", ".join(f"round({m}, 6) AS {m}" for m in SUMMARY)}
FROM a JOIN p USING (model) JOIN b USING (model) JOIN g USING (model) ORDER BY model""",
)
def model_comparison(spark, sf_dir):
    return _round(ranking.binary_summary(document_models(spark, sf_dir), ["model"]), *SUMMARY).orderBy("model")
