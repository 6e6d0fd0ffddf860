"""Queries on nearest neighbours and the choice of k."""

from __future__ import annotations

from pyspark.sql import functions as F

from classkit.operators import knn, metrics, split
from classkit.plans.inputs import (
    BINARY_VECTORS,
    SEED,
    TEST_SIZE,
    VECTORS,
    binary_vectors,
    folds_sql,
    split_sql,
    vectors,
)
from classkit.plans.registry import query
from classkit.plans.report_sql import report_sql

K = 5
GRID_SQL = "(SELECT unnest(generate_series(1, 29, 2))::INTEGER AS k)"


def scaled_sql(name: str, source: str, fit: str) -> str:
    """``source`` with ``scaled``: statistics from the rows of ``fit``."""
    return f"""{name}_long AS (SELECT unnest(features) AS x, generate_subscripts(features, 1) AS pos FROM {fit}),
{name}_stats AS (SELECT pos, avg(x) AS mean, stddev_pop(x) AS std FROM {name}_long GROUP BY pos),
{name}_cells AS (SELECT vec_id, unnest(features) AS x, generate_subscripts(features, 1) AS pos FROM {source}),
{name}_vec AS (
  SELECT vec_id, list((x - mean) / CASE WHEN std = 0 THEN 1 ELSE std END ORDER BY pos) AS scaled
  FROM {name}_cells JOIN {name}_stats USING (pos) GROUP BY vec_id),
{name} AS (SELECT * FROM {source} JOIN {name}_vec USING (vec_id))"""


def neighbours_sql(base: str, k: int) -> str:
    """CTEs ending in ``near``: the k nearest train rows of every test row."""
    return f"""{base}, {split_sql("s", "vectors", "vec_id", "label", TEST_SIZE)},
fit AS (SELECT * FROM s WHERE part = 'train'),
{scaled_sql("z", "s", "fit")},
pairs AS (
  SELECT q.vec_id AS query_id, p.vec_id AS neighbour_id, p.label, round(list_distance(q.scaled, p.scaled), 9) AS distance
  FROM z q JOIN z p ON q.part = 'test' AND p.part = 'train'),
near AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)::INTEGER AS rank
  FROM pairs QUALIFY rank <= {k})"""


NEAR = neighbours_sql(VECTORS, K)


def _parts(df):
    parts = split.stratified_split(df, "vec_id", "label", TEST_SIZE, SEED)
    return parts.where("split = 'train'"), parts.where("split = 'test'")


def _near(spark, sf_dir, source=vectors, k=K):
    train, test = _parts(source(spark, sf_dir))
    return knn.fit_and_search(train, test, k, "vec_id", "label", "features"), test


@query("nearest_neighbours", f"WITH {NEAR} SELECT query_id, rank, neighbour_id, label, round(distance, 6) AS distance FROM near")
def nearest_neighbours(spark, sf_dir):
    return _near(spark, sf_dir)[0].withColumn("distance", F.round("distance", 6))


VOTES = "v AS (SELECT query_id, label, count(*) AS votes FROM near GROUP BY 1, 2)"
WON = f"{VOTES}, won AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, label) = 1)"


@query("majority_vote", f"WITH {NEAR}, {WON} SELECT query_id, label AS prediction, votes::INTEGER AS votes, {K} AS k FROM won")
def majority_vote(spark, sf_dir):
    return knn.majority_vote(_near(spark, sf_dir)[0])


@query(
    "vote_shares",
    f"""WITH {NEAR}, {VOTES}
SELECT query_id, label AS class, votes, round(votes / sum(votes) OVER (PARTITION BY query_id), 9) AS probability FROM v""",
)
def vote_shares(spark, sf_dir):
    return knn.vote_shares(_near(spark, sf_dir)[0]).withColumn("probability", F.round("probability", 9))


def knn_report(spark, sf_dir):
    """Split, scale, 5 nearest neighbours, vote, and the report on the test rows."""
    near, test = _near(spark, sf_dir)
    votes = knn.majority_vote(near)
    truth = test.select(F.col("vec_id").alias("query_id"), "label")
    report = metrics.classification_report(votes.join(truth, "query_id"), labels=range(10))
    return _rounded(report, ["precision", "recall", "f1"])


def _rounded(df, names, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


query(
    "knn_report",
    f"""WITH {NEAR}, {WON},
scored AS (SELECT s.label, won.label AS prediction FROM won JOIN s ON s.vec_id = won.query_id),
{report_sql("scored", "(SELECT unnest(range(10))::INTEGER AS c)")}""",
)(knn_report)


CV = f"""{BINARY_VECTORS}, {split_sql("s", "vectors", "vec_id", "label", TEST_SIZE)},
fit AS (SELECT * EXCLUDE (part) FROM s WHERE part = 'train'),
{folds_sql("f", "fit", "vec_id", "label")},
folds AS (SELECT DISTINCT fold AS held FROM f),
cv_long AS (SELECT vec_id, fold, unnest(features) AS x, generate_subscripts(features, 1) AS pos FROM f),
cv_stats AS (
  SELECT held, pos, avg(x) AS mean, stddev_pop(x) AS std FROM folds JOIN cv_long ON fold <> held GROUP BY held, pos),
cv_scaled AS (
  SELECT held, vec_id, list((x - mean) / CASE WHEN std = 0 THEN 1 ELSE std END ORDER BY pos) AS scaled
  FROM cv_long JOIN cv_stats USING (pos) GROUP BY held, vec_id),
cv AS (SELECT * FROM cv_scaled JOIN f USING (vec_id)),
cv_pairs AS (
  SELECT q.held AS fold, q.vec_id, q.label, p.label AS vote, p.vec_id AS near_id,
         round(list_distance(q.scaled, p.scaled), 9) AS distance
  FROM cv q JOIN cv p ON q.held = p.held AND q.fold = q.held AND p.fold <> p.held),
cv_near AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, near_id) AS rank FROM cv_pairs QUALIFY rank <= 29),
cv_votes AS (
  SELECT fold, vec_id, any_value(label) AS label, k, vote, count(*) AS n
  FROM cv_near JOIN {GRID_SQL} g ON rank <= k GROUP BY fold, vec_id, k, vote),
cv_won AS (
  SELECT fold, vec_id, label, k, vote AS prediction FROM cv_votes
  QUALIFY row_number() OVER (PARTITION BY vec_id, k ORDER BY n DESC, vote) = 1),
cv_folds AS (
  SELECT k, fold, avg((label = prediction)::INT) AS accuracy,
         2.0::DOUBLE * count(*) FILTER (label = 1 AND prediction = 1) AS tp2,
         count(*) FILTER (label = 1) + count(*) FILTER (prediction = 1) AS sides FROM cv_won GROUP BY k, fold),
grid AS (
  SELECT k, avg(accuracy) AS cv_accuracy_mean, avg(CASE WHEN sides = 0 THEN 0 ELSE tp2 / sides END) AS cv_f1_mean
  FROM cv_folds GROUP BY k),
best AS (
  SELECT * FROM grid ORDER BY round(cv_f1_mean, 9) DESC, round(cv_accuracy_mean, 9) DESC, k LIMIT 1)"""


def _grid(spark, sf_dir):
    train, test = _parts(binary_vectors(spark, sf_dir))
    folds = split.stratified_folds(train.drop("split"), "vec_id", "label", knn.CV_FOLDS, SEED)
    votes = knn.cross_validated_votes(folds, "vec_id", "label", "features")
    return knn.grid_scores(votes), train, test


@query(
    "knn_fold_votes",
    f"WITH {CV} SELECT fold, vec_id, label, k, prediction FROM cv_won",
)
def knn_fold_votes(spark, sf_dir):
    train, _ = _parts(binary_vectors(spark, sf_dir))
    folds = split.stratified_folds(train.drop("split"), "vec_id", "label", knn.CV_FOLDS, SEED)
    votes = knn.cross_validated_votes(folds, "vec_id", "label", "features")
    return votes.select("fold", "vec_id", "label", "k", "prediction")


@query(
    "knn_k_grid",
    f"WITH {CV} SELECT k, round(cv_accuracy_mean, 6) AS cv_accuracy_mean, round(cv_f1_mean, 6) AS cv_f1_mean FROM grid ORDER BY k",
)
def knn_k_grid(spark, sf_dir):
    return _rounded(_grid(spark, sf_dir)[0], ["cv_accuracy_mean", "cv_f1_mean"]).orderBy("k")


@query(
    "knn_best_k",
    f"WITH {CV} SELECT k, round(cv_accuracy_mean, 6) AS cv_accuracy_mean, round(cv_f1_mean, 6) AS cv_f1_mean FROM best",
)
def knn_best_k(spark, sf_dir):
    return _rounded(knn.best_k(_grid(spark, sf_dir)[0]), ["cv_accuracy_mean", "cv_f1_mean"])


@query(
    "knn_selected_scores",
    f"""WITH {CV},
{scaled_sql("z", "s", "fit")},
pairs AS (
  SELECT q.vec_id, q.label, p.label AS vote, p.vec_id AS near_id, round(list_distance(q.scaled, p.scaled), 9) AS distance
  FROM z q JOIN z p ON q.part = 'test' AND p.part = 'train'),
near AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, near_id) AS rank
  FROM pairs QUALIFY rank <= (SELECT k FROM best)),
scored AS (SELECT vec_id, any_value(label) AS label, avg(vote) AS score FROM near GROUP BY vec_id)
SELECT vec_id, label, (score > 0.5)::INTEGER AS prediction, round(score, 9) AS score FROM scored""",
)
def knn_selected_scores(spark, sf_dir):
    """Choose k by cross-validation, refit on all train rows, score the test rows."""
    grid, train, test = _grid(spark, sf_dir)
    return selected_scores(grid, train, test).withColumn("score", F.round("score", 9))


def selected_scores(grid, train, test):
    near = knn.fit_and_search(train, test, max(knn.K_GRID), "vec_id", "label", "features")
    scored = knn.positive_share(knn.within_best_k(near, grid))
    truth = test.select(F.col("vec_id").alias("query_id"), "label")
    return scored.join(truth, "query_id").select(F.col("query_id").alias("vec_id"), "label", "prediction", "score")
