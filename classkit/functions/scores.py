"""Column expressions on scores, probabilities and weights.

All of them are built-in Spark functions, so they stay inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The decision threshold, and the probability clip of log-loss.
DECISION_THRESHOLD = 0.5
PROBABILITY_EPS = 2.220446049250313e-16


def threshold(score: Column, cut: float = DECISION_THRESHOLD) -> Column:
    """1 where ``score >= cut``, else 0; the cut itself counts as positive."""
    return (score >= F.lit(cut)).cast("int")


def argmax(probabilities: Column) -> Column:
    """Index of the largest entry of an array; ties go to the lowest index."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def positive_probability(probabilities: Column) -> Column:
    """P(class 1) out of a two-entry probability array."""
    return probabilities[1]


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, not at every use."""
    return F.transform(F.array(value), body)[0]


def softmax(margins: Column) -> Column:
    """Normalised exponentials of an array, shifted by its maximum."""

    def normalised(exps: Column) -> Column:
        total = F.aggregate(exps, F.lit(0.0), lambda acc, e: acc + e)
        return bind(total, lambda t: F.transform(exps, lambda e: e / t))

    shifted = bind(F.array_max(margins), lambda top: F.transform(margins, lambda m: F.exp(m - top)))
    return bind(shifted, normalised)


def clipped_log_loss(p_true: Column) -> Column:
    """``-ln(p)`` of the true class, with p kept inside [eps, 1 - eps]."""
    eps = PROBABILITY_EPS
    return -F.ln(F.least(F.greatest(p_true, F.lit(eps)), F.lit(1.0 - eps)))


def edge_width(weight: Column, largest: Column, widest: float, narrowest: float = 0.3) -> Column:
    """Width proportional to ``abs(weight)``, never below ``narrowest``."""
    return F.greatest(F.lit(narrowest), F.lit(widest) * F.abs(weight) / largest)


def edge_width_clipped(weight: Column, ceiling: Column, narrowest: float, widest: float) -> Column:
    """``abs(weight)`` clipped at ``ceiling`` and mapped onto [narrowest, widest]."""
    share = F.least(F.abs(weight), ceiling) / ceiling
    return F.lit(narrowest) + share * F.lit(widest - narrowest)


def centred_unit(value: Column, largest: Column) -> Column:
    """Map [-largest, largest] onto [0, 1] with zero at one half; values beyond saturate."""
    return F.least(F.greatest(F.lit(0.5) + F.lit(0.5) * value / largest, F.lit(0.0)), F.lit(1.0))
