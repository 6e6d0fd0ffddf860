"""Classifier metrics on scored tables.

One counting pass over the rows (combined on the map side) gives the confusion
cells; everything else is arithmetic on those few cells. ``by`` names extra key
columns, such as a model or a fold, that get their own metrics in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classkit.functions import clipped_log_loss
from classkit.runtime import MAX_CLASSES, bounded, written

ZERO_CELLS = 1_000_000  # empty cells of a confusion grid that one task makes
CLASS_VALUES = 1_000_000  # classes of all groups together up to which they are broadcast


def accuracy(scored: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"):
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return scored.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def error_rate(scored: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"):
    return accuracy(scored, by, label, prediction).select(*by, (1.0 - F.col("accuracy")).alias("error_rate"))


def _counts(scored: DataFrame, by: Sequence[str], label: str, prediction: str) -> DataFrame:
    return scored.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def _listed(counts: DataFrame, by: Sequence[str], labels: Sequence) -> DataFrame:
    """``(by.., classes)`` with the given classes for every group."""
    groups = counts.select(*by).distinct() if by else counts.sparkSession.range(1)
    return groups.select(*by, _class_list(counts, labels).alias("classes"))


def confusion_cells(
    scored: DataFrame,
    by: Sequence[str] = (),
    labels: Sequence | None = None,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """``(by.., label, prediction, rows)`` for the full grid of classes, zeros kept.

    Without ``labels`` the classes are all values seen as real or predicted; a null label or prediction is in no cell.
    Only zero cells are made: of each class, the classes it was never predicted as. They are made by so many tasks that
    none has much over ZERO_CELLS of them, and nothing but the classes seen travels.
    """
    counts = written(_counts(scored, by, label, prediction), "cells")
    if labels is None:
        both = F.explode(F.array("label", "prediction")).alias("_class")
        seen = counts.select(*by, both).where("_class IS NOT NULL").distinct()
        found = counts.where("label IS NOT NULL AND prediction IS NOT NULL")
    else:
        groups = counts.select(*by).distinct() if by else counts.sparkSession.range(1)
        seen = groups.select(*by, F.explode(_class_list(counts, dict.fromkeys(labels))).alias("_class"))
        found = counts.where(_listed_in("label", labels) & _listed_in("prediction", labels))
    seen = written(seen, "classes")
    # The classes of each group are counted before any are gathered.
    sizes = seen.groupBy(*by).agg(F.count(F.lit(1)).alias("n")) if by else seen.agg(F.count(F.lit(1)).alias("n"))
    largest, values, grid = sizes.agg(F.max("n"), F.sum("n"), F.sum(F.col("n") * F.col("n"))).head()
    if (largest or 0) > MAX_CLASSES:
        return counts.where(bounded(F.lit(largest), F.lit(True), "classes", MAX_CLASSES))  # fails once it runs
    classes = seen.groupBy(*by).agg(F.collect_set("_class").alias("classes"), F.max(F.col("_class").isNull()).alias("_null"))
    classes = classes.select(*[F.col(k).alias(f"_of_{k}") for k in by], _with_null("classes", "_null", counts).alias("classes"))
    if (values or 0) <= CLASS_VALUES:
        classes = F.broadcast(classes)  # its values are counted above
    # One row per class of a group, and what it was predicted as.
    met = found.select(*by, F.col("label").alias("_class"), F.struct("prediction").alias("_cell"))
    held = seen.withColumn("_cell", F.lit(None).cast(met.schema["_cell"].dataType)).unionByName(met)
    parts = max(1, -(-(grid or 0) // ZERO_CELLS))
    held = held.repartition(parts, *by, "_class").groupBy(*by, "_class").agg(F.collect_list("_cell").alias("_cells"))
    held = held.join(classes, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by]) if by else held.crossJoin(classes)
    missing = F.array_except("classes", F.transform("_cells", lambda c: c["prediction"]))
    zeros = held.select(*by, F.col("_class").alias("label"), F.explode(missing).alias("prediction"))
    return found.unionByName(zeros.withColumn("rows", F.lit(0).cast("long")))


def _class_list(counts: DataFrame, labels) -> Column:
    return F.array(*[F.lit(v) for v in labels]).cast(T.ArrayType(counts.schema["label"].dataType))


def _listed_in(name: str, labels: Sequence) -> Column:
    inside = F.coalesce(F.col(name).isin([v for v in labels if v is not None]), F.lit(False))
    return inside | F.col(name).isNull() if None in labels else inside


def _with_null(name: str, has_null: str, counts: DataFrame) -> Column:
    """The gathered classes, which leave a null out, with it if it is one of them."""
    null = F.array(F.lit(None).cast(counts.schema["label"].dataType))
    return F.when(F.col(has_null), F.concat(F.col(name), null)).otherwise(F.col(name))


def confusion_matrix(scored: DataFrame, labels: Sequence, by: Sequence[str] = (), prefix: str = "pred_", **names):
    """Wide form: one row per real class, one column per predicted class."""
    cells = confusion_cells(scored, by, labels, **names)
    wide = cells.groupBy(*by, "label").pivot("prediction", list(labels)).agg(F.first("rows"))
    return wide.select(*by, "label", *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in labels])


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(bottom == 0, 0.0).otherwise(top / F.when(bottom == 0, 1).otherwise(bottom))


def class_scores(
    scored: DataFrame,
    by: Sequence[str] = (),
    labels: Sequence | None = None,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Precision, recall, F1 and support per class, for the classes seen and ``labels``."""
    counts = _counts(scored, by, label, prediction)
    rows, none = F.col("rows"), F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), rows).otherwise(none)

    def side(value: str, tp: Column, support: Column, predicted: Column) -> Column:
        return F.struct(
            F.col(value).alias("class"), tp.alias("tp"), support.alias("support"), predicted.alias("predicted")
        )

    # Every cell counts once for its real and once for its predicted class.
    sides = counts.select(
        *by, F.inline(F.array(side("label", hit, rows, none), side("prediction", none, none, rows)))
    )
    if labels is not None:
        listed = _listed(counts, by, labels).select(*by, F.explode("classes").alias("class"))
        sides = sides.unionByName(listed.select("*", *[none.alias(c) for c in ("tp", "support", "predicted")]))
    sums = sides.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return sums.select(
        *by,
        F.col("class").alias("label"),
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(2 * tp, support + predicted).alias("f1"),
        "support",
        "tp",
    )


def classification_report(
    scored: DataFrame,
    by: Sequence[str] = (),
    labels: Sequence | None = None,
    target_names: dict | None = None,
    suffix: str = "",
    digits: int | None = None,
    **names,
) -> DataFrame:
    """Per-class rows, then ``accuracy``, ``macro avg`` and ``weighted avg`` rows.

    Classes are shown by ``target_names[class]``, else as ``"{class}{suffix}"``.
    """
    scores = class_scores(scored, by, labels, **names)
    shown = F.concat(F.col("label").cast("string"), F.lit(suffix))
    if target_names:
        pairs = [F.lit(x) for item in target_names.items() for x in item]
        shown = F.coalesce(F.create_map(*pairs)[F.col("label")], shown)
    ratios = ("precision", "recall", "f1")

    def row(kind: str, name: Column, values: Sequence[Column]) -> Column:
        named = [(v if digits is None else F.round(v, digits)).alias(m) for m, v in zip(ratios, values, strict=True)]
        return F.struct(F.lit(kind).alias("row_kind"), name.alias("name"), *named, F.col("support").alias("support"))

    def weighted(metric: str) -> Column:
        return _ratio(F.sum(F.col(metric) * F.col("support")), F.sum("support"))

    # The class rows are never gathered: one aggregate gives the summaries, which refuse too many classes.
    groups = scores.groupBy(*by).agg(
        F.count("label").alias("classes"),
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in ratios],
        *[weighted(m).alias(f"weighted_{m}") for m in ratios],
        F.sum("support").alias("support"),
    )
    groups = groups.withColumn("support", bounded(F.col("classes"), F.col("support"), "classes", MAX_CLASSES))
    nothing = F.lit(None).cast("double")
    summaries = F.array(
        row("summary", F.lit("accuracy"), [nothing, nothing, F.col("accuracy")]),
        *[row("summary", F.lit(f"{k} avg"), [F.col(f"{k}_{m}") for m in ratios]) for k in ("macro", "weighted")],
    )
    classes = scores.select(*by, row("class", shown, [F.col(m) for m in ratios]).alias("r")).select(*by, "r.*")
    return classes.unionByName(groups.select(*by, F.inline(summaries)))


def f1_scores(scored: DataFrame, by: Sequence[str] = (), positive=1, negative=0, **names) -> DataFrame:
    """F1 of the positive and the negative class, macro and support-weighted."""
    scores = class_scores(scored, by, **names)

    def of(value) -> Column:
        return F.coalesce(F.max(F.when(F.col("label") == F.lit(value), F.col("f1"))), F.lit(0.0))

    return scores.groupBy(*by).agg(
        of(positive).alias("f1_positive"),
        of(negative).alias("f1_negative"),
        F.avg("f1").alias("f1_macro"),
        _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"),
    )


def log_loss(scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """Binary log-loss with labels 0 and 1; finite even if one class is absent."""
    p_true = F.when(F.col(label) == 1, F.col(score)).otherwise(1.0 - F.col(score))
    return scored.groupBy(*by).agg(F.avg(clipped_log_loss(p_true)).alias("log_loss"))


def multiclass_log_loss(scored: DataFrame, by: Sequence[str] = (), label: str = "label", probabilities: str = "p"):
    p_true = F.element_at(probabilities, (F.col(label) + 1).cast("int"))
    return scored.groupBy(*by).agg(F.avg(clipped_log_loss(p_true)).alias("log_loss"))


def fold_accuracy(scored: DataFrame, fold: str = "fold", **names) -> DataFrame:
    return accuracy(scored, [fold], **names)


def cross_validation_summary(scored: DataFrame, fold: str = "fold", **names) -> DataFrame:
    """Mean and population standard deviation of the per-fold accuracy."""
    return fold_accuracy(scored, fold, **names).agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("accuracy").alias("accuracy_mean"),
        F.stddev_pop("accuracy").alias("accuracy_sd"),
    )
