import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from classkit.operators import metrics, ranking


def scored(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, label int, prediction int, score double")


def test_missing_classes_score_zero_and_keep_zero_cells(spark):
    # class 1 is never predicted, class 2 is never real
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 0)], "label int, prediction int")
    cells = {(r["label"], r["prediction"]): r["rows"] for r in metrics.confusion_cells(df).collect()}
    assert len(cells) == 9 and cells[0, 0] == cells[0, 2] == cells[1, 0] == 1 and sum(cells.values()) == 3
    scores = {r["label"]: r for r in metrics.class_scores(df).collect()}
    assert scores[1]["precision"] == scores[1]["recall"] == scores[1]["f1"] == 0.0
    assert scores[2]["recall"] == 0.0 and scores[2]["support"] == 0
    assert scores[0]["precision"] == 0.5 and scores[0]["recall"] == 0.5


def test_listed_labels_extend_report_and_matrix(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    names = {r["name"]: r["support"] for r in metrics.classification_report(df, labels=[0, 1, 9]).collect()}
    assert names == {"0": 1, "1": 1, "9": 0, "accuracy": 2, "macro avg": 2, "weighted avg": 2}
    matrix = {r["label"]: r.asDict() for r in metrics.confusion_matrix(df, [0, 1, 9]).collect()}
    assert matrix[9] == {"label": 9, "pred_0": 0, "pred_1": 0, "pred_9": 0} and matrix[1]["pred_0"] == 1


@pytest.mark.parametrize(
    ("scores", "labels", "auc", "ap"),
    [([0.1, 0.4, 0.35, 0.8], [0, 0, 1, 1], 0.75, 0.8333333333), ([0.5] * 4, [0, 0, 0, 1], 0.5, 0.25)],
)
def test_ranking_with_ties(spark, scores, labels, auc, ap):
    df = scored(spark, [(y, int(s >= 0.5), s) for s, y in zip(scores, labels)])
    row = ranking.ranking_metrics(df).first()
    assert row["roc_auc"] == pytest.approx(auc) and row["average_precision"] == pytest.approx(ap)


def test_one_class_has_no_auc_but_a_finite_loss(spark):
    df = scored(spark, [(1, 1, 1.0), (1, 0, 0.0)])
    assert ranking.roc_auc(df).first()["roc_auc"] is None
    assert math.isfinite(metrics.log_loss(df).first()["log_loss"])


def naive(rows):
    n, pos = len(rows), sum(y for y, _, _ in rows)
    pairs = [(p, q) for y, _, p in rows if y for z, _, q in rows if not z]
    auc = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in pairs) / len(pairs) if pairs else None
    ap, seen = 0.0, 0.0
    for cut in sorted({s for _, _, s in rows}, reverse=True):
        above = [y for y, _, s in rows if s >= cut]
        if pos:
            ap += (sum(above) / pos - seen) * sum(above) / len(above)
            seen = sum(above) / pos

    def f1(c):
        tp = sum(y == c and p == c for y, p, _ in rows)
        sides = sum(y == c for y, _, _ in rows) + sum(p == c for _, p, _ in rows)
        return 2 * tp / sides if sides else 0.0

    present = [c for c in (0, 1) if any(c in (y, p) for y, p, _ in rows)]
    return {
        "accuracy": sum(y == p for y, p, _ in rows) / n,
        "roc_auc": auc,
        "average_precision": ap if pos else None,
        "f1_positive": f1(1),
        "f1_negative": f1(0),
        "f1_macro": sum(map(f1, present)) / len(present),
        "f1_weighted": (f1(1) * pos + f1(0) * (n - pos)) / n,
    }


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.2, 0.5, 0.50001, 0.9, 1.0])), min_size=1, max_size=30))
def test_summary_equals_definition(spark, pairs):
    rows = [(y, int(s >= 0.5), s) for y, s in pairs]
    out = ranking.binary_summary(scored(spark, rows)).first()
    for name, value in naive(rows).items():
        assert out[name] == (value if value is None else pytest.approx(value)), name


def test_running_totals_over_many_ranges_and_a_hot_value(spark):
    # a third of the rows share one score; small ranges are forced
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        random.seed(3)
        rows = [(random.randint(0, 1), 0, 0.25 if i % 3 == 0 else random.random()) for i in range(900)]
        rows = [(y, int(s >= 0.5), s) for y, _, s in rows]
        out = ranking.binary_summary(scored(spark, rows)).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name, value in naive(rows).items():
        assert out[name] == pytest.approx(value), name


def test_percentile_interpolates(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0)], "x double")
    assert ranking.exact_percentile(df, "x", 0.99).first()["percentile"] == pytest.approx(3.97)


def test_cross_validation_uses_population_deviation(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (1, 1, 1)], "fold int, label int, prediction int")
    row = metrics.cross_validation_summary(df).first()
    assert row["accuracy_mean"] == 0.75 and row["accuracy_sd"] == 0.25


def test_too_many_classes_raise(spark):
    scored = spark.range(30_000).selectExpr("id AS label", "id AS prediction")
    for found in (metrics.classification_report(scored), metrics.confusion_cells(scored)):
        with pytest.raises(Exception, match="too many classes"):
            found.count() if "name" not in found.columns else found.collect()


def test_confusion_grid_by_definition(spark, monkeypatch):
    """Groups with classes of their own, a null group, null labels and predictions, listed classes with a null."""
    rng = random.Random(6)
    rows = [(g, rng.choice([None, *range(5 + n)]), rng.choice([None, *range(3, 9)])) for n, g in enumerate(["a", "b", None]) for _ in range(40)]
    df = spark.createDataFrame(rows, "g string, label int, prediction int").repartition(3)
    count = lambda g, y, p: sum(r == (g, y, p) for r in rows)
    for values in (metrics.CLASS_VALUES, 1):
        monkeypatch.setattr(metrics, "CLASS_VALUES", values)
        monkeypatch.setattr(metrics, "ZERO_CELLS", 7)
        want = {}
        for g in ("a", "b", None):
            classes = {x for r in rows if r[0] == g for x in r[1:] if x is not None}
            want |= {(g, y, p): count(g, y, p) for y in classes for p in classes}
        got = metrics.confusion_cells(df, ["g"]).collect()
        assert len(got) == len(want) and {(r["g"], r["label"], r["prediction"]): r["rows"] for r in got} == want
        listed = [3, None, 4, 77]
        got = metrics.confusion_cells(df, ["g"], labels=listed).collect()
        want = {(g, y, p): count(g, y, p) for g in ("a", "b", None) for y in listed for p in listed}
        assert len(got) == len(want) and {(r["g"], r["label"], r["prediction"]): r["rows"] for r in got} == want
    assert metrics.confusion_cells(df.where("false")).count() == 0
    got = metrics.confusion_cells(df.where("false"), labels=[1, 2]).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 0), (1, 2, 0), (2, 1, 0), (2, 2, 0)]


def test_zero_cells_are_made_by_many_tasks(spark):
    scored = spark.range(3_000).selectExpr("id AS label", "(id * 7) % 3000 AS prediction")
    cells = metrics.confusion_cells(scored)
    per_task = cells.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count"), F.count("*")).head()
    assert per_task[1] == 9_000_000 and per_task[0] < 2 * metrics.ZERO_CELLS and per_task[2] >= 9
    assert cells.agg(F.sum("rows")).head()[0] == 3_000


def test_percentiles_from_brackets(spark, monkeypatch):
    """Groups of many rows: spread, one hot value, two hot values, far outliers, negative, nulls, a null group, one row."""
    rng = np.random.default_rng(4)
    groups = {
        "spread": rng.normal(size=3_000).tolist(),
        "hot": [1.0] * 2_000 + rng.uniform(size=500).tolist(),
        "two": [1.0] * 700 + [2.0] * 700,
        "far": [1e300, -1e300] + rng.lognormal(0, 8, 2_000).tolist(),
        "steps": [float(i % 7) for i in range(1_000)],
        None: [float(i) for i in range(300)],
        "one": [5.0],
    }
    rows = [(g, x) for g, values in groups.items() for x in [*values, None]]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    monkeypatch.setattr(ranking, "FEW_VALUES", 40)
    for q in (0.0, 0.5, 0.99, 1.0):
        got = {r["g"]: r["percentile"] for r in ranking.exact_percentile(df, "x", q, ["g"]).collect()}
        assert got.keys() == groups.keys()
        for g, values in groups.items():
            assert got[g] == pytest.approx(np.percentile(values, q * 100), rel=1e-12), (g, q)
    whole = [x for values in groups.values() for x in values]
    assert ranking.exact_percentile(df, "x", 0.7).first()["percentile"] == pytest.approx(np.percentile(whole, 70))
    assert ranking.exact_percentile(df.where("false"), "x", 0.5).count() == 0
