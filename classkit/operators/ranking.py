"""Running totals over a whole column, and the metrics that need them.

A window without a partition would sort everything in one task. Here equal
values are collapsed first (so a hot value is one row), the values left are
range-partitioned, and totals run inside each range on top of the totals of the
lower ranges. Where the ranges meet changes the load, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from classkit.functions import clipped_log_loss
from classkit.runtime import written


def running_totals(df: DataFrame, by: Sequence[str], order: str, totals: Sequence[str]) -> DataFrame:
    """Add ``cum_<t>``, the total of each column over rows up to and including
    this one, and ``all_<t>``, its total over all rows.

    ``df`` holds one row per (``by``, ``order``) value. It is written once with
    its ranges, so the rows behind it are read a single time; Spark chooses the
    number of ranges by size.
    """
    ranged = df.repartitionByRange(*by, order).withColumn("_range", F.spark_partition_id())
    placed = written(ranged, "ranges")
    keys = [*by, "_range"]
    sums = placed.groupBy(*keys).agg(*[F.sum(t).alias(f"_sum_{t}") for t in totals])
    group = Window.partitionBy(*by)  # one row per range
    bases = sums.select(
        *keys,
        *[(F.sum(f"_sum_{t}").over(group.orderBy("_range")) - F.col(f"_sum_{t}")).alias(f"_base_{t}") for t in totals],
        *[F.sum(f"_sum_{t}").over(group).alias(f"all_{t}") for t in totals],
    )
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.join(bases, keys).select(
        *df.columns,
        *[(F.col(f"_base_{t}") + F.sum(t).over(inside)).alias(f"cum_{t}") for t in totals],
        *[f"all_{t}" for t in totals],
    )


def score_counts(scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score", positive=1):
    """``(by.., score, pos, neg)``: one row per distinct score."""
    is_positive = F.col(label) == F.lit(positive)
    return scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg")
    )


def _ranking_sums() -> list[Column]:
    """ROC-AUC and average precision over rows with ``pos``, ``neg`` and their totals."""
    pos, neg = F.col("pos"), F.col("neg")
    # Share of (positive, negative) pairs in the right order, ties counting half.
    ordered = F.sum(pos.cast("double") * (F.col("cum_neg") - neg / 2))
    auc = ordered / F.nullif(F.sum(pos).cast("double") * F.sum(neg), F.lit(0.0))
    # Rows at or above a score = all rows minus the rows strictly below it.
    pos_above = F.col("all_pos") - F.col("cum_pos") + pos
    neg_above = F.col("all_neg") - F.col("cum_neg") + neg
    gained = F.sum(pos * pos_above / (pos_above + neg_above))
    return [auc.alias("roc_auc"), (gained / F.nullif(F.sum(pos).cast("double"), F.lit(0.0))).alias("average_precision")]


def ranking_metrics(
    scored: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    score: str = "score",
    positive=1,
) -> DataFrame:
    """ROC-AUC and average precision; AUC is null when only one class is present.

    Average precision sums, over falling distinct scores, the recall gained times
    the precision reached.
    """
    counts = score_counts(scored, by, label, score, positive)
    return running_totals(counts, by, "score", ["pos", "neg"]).groupBy(*by).agg(*_ranking_sums())


def binary_summary(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All metrics of a two-class model, one row per group, from one pass over the rows.

    ``scored`` has ``label``, ``prediction`` (0 or 1) and ``score``. Every metric
    follows from the counts per distinct score.
    """
    real, predicted = F.col("label") == 1, F.col("prediction") == 1
    counts = scored.groupBy(*by, "score").agg(
        F.count_if(real).alias("pos"),
        F.count_if(~real).alias("neg"),
        F.count_if(real & predicted).alias("tp"),
        F.count_if(~real & predicted).alias("fp"),
    )
    loss = F.col("pos") * clipped_log_loss(F.col("score")) + F.col("neg") * clipped_log_loss(1.0 - F.col("score"))
    running = running_totals(counts, by, "score", ["pos", "neg"])
    sums = running.groupBy(*by).agg(
        *[F.sum(c).cast("double").alias(c) for c in ("pos", "neg", "tp", "fp")],
        F.sum(loss).alias("loss"),
        *_ranking_sums(),
    )
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    rows, tn = pos + neg, neg - fp

    def f1(hits: Column, sides: Column) -> Column:
        return F.when(sides == 0, 0.0).otherwise(2 * hits / F.greatest(sides, F.lit(1.0)))

    positive, negative = f1(tp, pos + tp + fp), f1(tn, neg + rows - tp - fp)
    # A class that is neither real nor predicted anywhere is not averaged.
    seen = (pos + tp + fp > 0).cast("int") + (neg + rows - tp - fp > 0).cast("int")
    return sums.select(
        *by,
        ((tp + tn) / rows).alias("accuracy"),
        positive.alias("f1_positive"),
        negative.alias("f1_negative"),
        ((positive + negative) / seen).alias("f1_macro"),
        ((positive * pos + negative * neg) / rows).alias("f1_weighted"),
        "roc_auc",
        "average_precision",
        (F.col("loss") / rows).alias("log_loss"),
    )


def roc_auc(scored: DataFrame, by: Sequence[str] = (), **names) -> DataFrame:
    return ranking_metrics(scored, by, **names).select(*by, "roc_auc")


def average_precision(scored: DataFrame, by: Sequence[str] = (), **names) -> DataFrame:
    return ranking_metrics(scored, by, **names).select(*by, "average_precision")


FEW_VALUES = 100_000  # rows among which places are counted one by one
CUTS, CUT_ACCURACY = 256, 10_000  # cut points of a bracket, and the accuracy of the sketch that finds them


def _same(left: Sequence[str], right: str) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"{right}{k}")) for k in left]


def _bracketed(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that are inside their group's bracket, with the columns of ``state``."""
    named = state.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in state.columns if c not in keys])
    met = rows.join(named, _same(keys, "_of_")).drop(*[f"_of_{k}" for k in keys])
    return met.where("(_low is null or value >= _low) and (_high is null or value <= _high)")


def _narrowed(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Large brackets cut down to about 3 of CUTS parts, by a sketch of their rows and then an exact count."""
    large = state.where(_large())
    shares = [i / CUTS for i in range(CUTS + 1)]
    cuts = _bracketed(rows, large, keys).groupBy(*keys).agg(
        F.percentile_approx("value", shares, CUT_ACCURACY).alias("_cuts"), *[F.first(c).alias(c) for c in ("_first", "_below", "_inside")]
    )
    at = F.floor((F.col("_first") - F.col("_below")) / F.col("_inside") * CUTS).cast("int")
    asked = cuts.select(
        *keys,
        F.get("_cuts", F.greatest(at - 1, F.lit(0))).alias("_from"),
        F.get("_cuts", F.least(at + 2, F.lit(CUTS))).alias("_to"),
    )
    plain = large.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_low", "_high")
    asked = asked.join(plain, _same(keys, "_k_")).drop(*[f"_k_{k}" for k in keys])
    counted = _bracketed(rows, asked, keys).groupBy(*keys).agg(
        F.first("_from").alias("_from"),
        F.first("_to").alias("_to"),
        F.count_if(F.col("value") < F.col("_from")).alias("_less"),
        F.count_if((F.col("value") >= F.col("_from")) & (F.col("value") <= F.col("_to"))).alias("_within"),
    )
    counted = counted.select(*[F.col(k).alias(f"_n_{k}") for k in keys], "_from", "_to", "_less", "_within")
    below = F.col("_below") + F.col("_less")
    fits = (below <= F.col("_first")) & (F.col("_last") < below + F.col("_within")) & (F.col("_within") < F.col("_inside"))
    fits = F.coalesce(fits, F.lit(False))
    return state.join(counted, _same(keys, "_n_"), "left").select(
        *keys,
        "_place",
        "_first",
        "_last",
        F.when(fits, F.col("_from")).otherwise(F.col("_low")).alias("_low"),
        F.when(fits, F.col("_to")).otherwise(F.col("_high")).alias("_high"),
        F.when(fits, below).otherwise(F.col("_below")).alias("_below"),
        F.when(fits, F.col("_within")).otherwise(F.col("_inside")).alias("_inside"),
        (F.col("_settled") | (F.col("_within").isNotNull() & ~fits)).alias("_settled"),
    )


def _large() -> str:
    """Brackets that are to be cut down further. One value, however frequent, needs no cutting."""
    return f"_inside > {FEW_VALUES} and not _settled and not coalesce(_low = _high, false)"


def exact_percentile(df: DataFrame, value: str, q: float, by: Sequence[str] = ()) -> DataFrame:
    """``(by.., percentile)`` with linear interpolation between neighbouring values; nulls are left out.

    No column is ordered. Per group a bracket of values is kept that holds the place asked for. While it has over
    FEW_VALUES rows, a sketch, combined on the map side, proposes a narrower one, and an exact count confirms it; each
    round leaves about a hundredth of the rows. Then equal values are collapsed and the places of the few left are counted.
    """
    keys = list(by) or ["_all"]
    source = df if by else df.withColumn("_all", F.lit(0))
    rows = source.select(*keys, F.col(value).alias("value")).where("value is not null")
    place = F.lit(q) * (F.col("_inside") - 1)  # counted from 0
    unbounded = F.lit(None).cast(rows.schema["value"].dataType)
    state = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_inside")).select(
        *keys,
        place.alias("_place"),
        F.floor(place).alias("_first"),
        F.ceil(place).alias("_last"),
        unbounded.alias("_low"),
        unbounded.alias("_high"),
        F.lit(0).cast("long").alias("_below"),
        "_inside",
        F.lit(False).alias("_settled"),
    )
    state = written(state, "brackets")
    while state.where(_large()).limit(1).count():
        state = written(_narrowed(rows, state, keys), "brackets")
    held = _bracketed(rows, state, keys).groupBy(*keys, "value").agg(
        F.count(F.lit(1)).alias("rows"), *[F.first(c).alias(c) for c in ("_place", "_first", "_last", "_below")]
    )
    upto = F.col("_below") + F.sum("rows").over(Window.partitionBy(*keys).orderBy("value"))
    running = held.withColumn("_upto", upto)
    covers = lambda at: (F.col("_upto") - F.col("rows") <= F.col(at)) & (F.col(at) < F.col("_upto"))
    found = running.groupBy(*keys).agg(
        F.max(F.when(covers("_first"), F.col("value"))).alias("low"),
        F.max(F.when(covers("_last"), F.col("value"))).alias("high"),
        F.first(F.col("_place") - F.col("_first")).alias("part"),
    )
    return found.select(*by, (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("percentile"))
