"""Stratified splits and folds with exact sizes, without moving the rows.

Rows of a class are ordered by ``md5(id | seed)``. A part of a split is a range
of that order, so a row's part follows from comparing its key with a few cut
keys per class. The cuts are found from a histogram of key prefixes (combined on
the map side), refined below a prefix that holds a cut and many rows; only the
rows of a small prefix holding a cut are ranked. The cut
keys, one row per class, are fitted when the function is called; applying them
is a scan with a broadcast lookup, and the data itself is never shuffled,
however uneven the classes are.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from classkit.runtime import MAX_CLASSES, local_table, written

PREFIX_DIGITS = 3  # 4,096 prefixes per class, and as many again below each that is cut finer
KEY_DIGITS = 32  # of an order key
BUCKET_ROWS = 100_000  # rows of one prefix that are ranked together at most, unless their keys are equal

# From the size of every class, in class order, the rank of the last row of each
# part but the final one.
PartEnds = Callable[[list[int]], list[list[int]]]


def order_key(id_col: str, seed: int | str) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def _prefix(digits: int) -> Column:
    return F.substring("key", 1, digits).alias("prefix")


def _locate(histogram: DataFrame, ends: list[dict], label_type: T.DataType) -> list:
    """For every end, the prefix whose rows hold it, its place among them, and how many they are.

    ``histogram`` counts prefixes below (label, parent), ``ends`` are ranks there.
    """
    below = T.StructType().add("label", label_type).add("parent", "string")
    table = local_table(histogram.sparkSession, ends, below.add("part", "integer").add("last", "long"))
    upto = F.sum("rows").over(Window.partitionBy("label", "parent").orderBy("prefix"))
    running = histogram.withColumn("upto", upto).join(F.broadcast(table), ["label", "parent"])
    inside = running.where((F.col("last") <= F.col("upto")) & (F.col("last") > F.col("upto") - F.col("rows")))
    nth = (F.col("last") - F.col("upto") + F.col("rows")).alias("nth")
    return inside.select("label", "prefix", nth, "part", "rows").collect()  # one row per class and part


def _cut_keys(keyed: DataFrame, histogram: DataFrame, ends: list[dict], label_type: T.DataType) -> dict:
    """``(label, part) -> {key, id}`` of the rows that close the parts in ``ends``."""
    spark, digits, settled = keyed.sparkSession, PREFIX_DIGITS, []
    prefixes = T.StructType().add("label", label_type).add("parent", "string")

    def within(pairs: set[tuple], digits: int) -> DataFrame:
        """The rows of the given (label, prefix) pairs; few prefixes, so the join is a scan."""
        table = local_table(spark, [{"label": x, "parent": p} for x, p in sorted(pairs)], prefixes)
        return keyed.withColumn("parent", _prefix(digits)).join(F.broadcast(table), ["label", "parent"])

    located = _locate(histogram, [{**e, "parent": ""} for e in ends], label_type)
    while located:
        # A prefix with many rows is cut finer by the key's next digits, so few rows are ever ranked together.
        large = [r for r in located if r["rows"] > BUCKET_ROWS and digits < KEY_DIGITS]
        settled += [(digits, r) for r in located if r not in large]
        if not large:
            break
        finer = within({(r["label"], r["prefix"]) for r in large}, digits).groupBy("label", "parent", _prefix(digits + PREFIX_DIGITS))
        open_ends = [{"label": r["label"], "parent": r["prefix"], "part": r["part"], "last": r["nth"]} for r in large]
        located = _locate(finer.agg(F.count(F.lit(1)).alias("rows")), open_ends, label_type)
        digits += PREFIX_DIGITS

    cuts = {}
    for length in sorted({d for d, _ in settled}):
        parts: dict[tuple, list[int]] = {}
        for r in (r for d, r in settled if d == length):
            parts.setdefault((r["label"], r["prefix"], r["nth"]), []).append(r["part"])
        schema = T.StructType([*prefixes.fields]).add("nth", "long")
        wanted = local_table(spark, [{"label": x, "parent": p, "nth": n} for x, p, n in parts], schema)
        near = within({(x, p) for x, p, _ in parts}, length)
        place = F.row_number().over(Window.partitionBy("label", "parent").orderBy("key", "id")).cast("long")
        closing = near.withColumn("nth", place).join(F.broadcast(wanted), ["label", "parent", "nth"]).collect()
        cuts |= {
            (r["label"], part): {"key": r["key"], "id": r["id"]}
            for r in closing
            for part in parts[r["label"], r["parent"], r["nth"]]
        }
    return cuts


def _fit_cuts(df: DataFrame, id_col: str, label_col: str, seed, part_ends: PartEnds) -> DataFrame:
    """``(label, _cuts)``: where the parts of each class end in its order, one row per class."""
    keyed = df.where(F.col(label_col).isNotNull()).select(
        F.col(label_col).alias("label"), F.col(id_col).alias("id"), order_key(id_col, seed).alias("key")
    )
    counts = keyed.groupBy("label", F.lit("").alias("parent"), _prefix(PREFIX_DIGITS)).agg(F.count(F.lit(1)).alias("rows"))
    # At most 4,096 rows per class, written so that the table is not scanned again for them.
    histogram = written(counts, "histogram")
    sizes = histogram.groupBy("label").agg(F.sum("rows").alias("n"))
    classes = sorted((r["label"], r["n"]) for r in sizes.limit(MAX_CLASSES + 1).collect())
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    ends = [
        {"label": label, "part": part, "last": last}
        for (label, _), lasts in zip(classes, part_ends([n for _, n in classes]), strict=True)
        for part, last in enumerate(lasts)
    ]
    label_type, id_type = df.schema[label_col].dataType, df.schema[id_col].dataType
    # A part that ends at rank 0 holds no row, and its end lies below every key.
    cut_of = _cut_keys(keyed, histogram, [e for e in ends if e["last"] > 0], label_type)
    cuts = {label: [] for label, _ in classes}
    for e in ends:
        cuts[e["label"]].append(cut_of.get((e["label"], e["part"]), {"key": "", "id": None}))
    cut_type = T.ArrayType(T.StructType().add("key", "string").add("id", id_type))
    return local_table(
        df.sparkSession,
        [{label_col: label, "_cuts": c} for label, c in cuts.items()],
        T.StructType().add(label_col, label_type).add("_cuts", cut_type),
    )


def _apply_cuts(df: DataFrame, cuts: DataFrame, id_col: str, label_col: str, seed, target: str) -> DataFrame:
    """Add ``target``: how many part ends lie below the row in the order of its class.

    A row without a label gets no part.
    """
    below = F.filter(
        "_cuts",
        lambda c: (c["key"] < F.col("_key")) | ((c["key"] == F.col("_key")) & (c["id"] < F.col(id_col))),
    )
    return (
        df.withColumn("_key", order_key(id_col, seed))
        .join(F.broadcast(cuts), label_col, "left")
        .withColumn(target, F.size(below))
        .select(*df.columns, target)
    )


def _assign_parts(df: DataFrame, id_col: str, label_col: str, seed, part_ends: PartEnds, target: str) -> DataFrame:
    cuts = _fit_cuts(df, id_col, label_col, seed, part_ends)
    return _apply_cuts(df, cuts, id_col, label_col, seed, target)


def _test_ends(test_size: float) -> PartEnds:
    """Test rows per class: floor of the proportional share, leftovers to the
    largest fractions, ties to the lower class."""

    def ends(sizes: list[int]) -> list[list[int]]:
        if min(sizes, default=2) < 2:
            raise ValueError("every class needs at least 2 rows to be split")
        total = sum(sizes)
        want = math.ceil(test_size * total)
        shares = [divmod(want * n, total) for n in sizes]
        spare = want - sum(base for base, _ in shares)
        favoured = set(sorted(range(len(sizes)), key=lambda i: (-shares[i][1], i))[:spare])
        return [[base + (i in favoured)] for i, (base, _) in enumerate(shares)]

    return ends


def _fold_ends(n_folds: int) -> PartEnds:
    """Fold sizes of dealing the rows, sorted by class, round robin to the folds."""

    def ends(sizes: list[int]) -> list[list[int]]:
        lasts, start = [], 0
        for n in sizes:
            dealt = [len(range(start + (fold - start) % n_folds, start + n, n_folds)) for fold in range(n_folds)]
            lasts.append([sum(dealt[: fold + 1]) for fold in range(n_folds - 1)])
            start += n
        return lasts

    return ends


def stratified_split(
    df: DataFrame,
    id_col: str,
    label_col: str,
    test_size: float = 0.3,
    seed: int | str = 42,
    target: str = "split",
    names: tuple[str, str] = ("test", "train"),
) -> DataFrame:
    """Add ``split``; the test part has ``ceil(test_size * rows)`` rows in all.

    ``id_col`` must be unique. A class with a single row is an error.
    """
    parts = _assign_parts(df, id_col, label_col, seed, _test_ends(test_size), "_part")
    name = F.when(F.col("_part") == 0, names[0]).when(F.col("_part") > 0, names[1])
    return parts.withColumn(target, name).select(*df.columns, target)


def nested_split(
    df: DataFrame,
    id_col: str,
    label_col: str,
    test_size: float = 0.3,
    valid_size: float = 0.2,
    seed: int | str = 42,
) -> DataFrame:
    """``split`` in train / valid / test: the validation part is drawn from train only; rows without a label go.

    Ids and labels of the train part are written once, for the inner split to be found from. Both splits are then looked
    up in the same scan of ``df``.
    """
    inner_seed, keys = f"{seed}|valid", df.select(id_col, label_col)
    outer = _fit_cuts(df, id_col, label_col, seed, _test_ends(test_size))
    train = written(_apply_cuts(keys, outer, id_col, label_col, seed, "_outer").where("_outer > 0").drop("_outer"), "outer")
    inner = _fit_cuts(train, id_col, label_col, inner_seed, _test_ends(valid_size))
    parts = _apply_cuts(df, outer, id_col, label_col, seed, "_outer").where("_outer >= 0")
    parts = _apply_cuts(parts, inner, id_col, label_col, inner_seed, "_inner")
    name = F.when(F.col("_outer") == 0, "test").when(F.col("_inner") == 0, "valid").otherwise("train")
    return parts.withColumn("split", name).select(*df.columns, "split")


def stratified_folds(
    df: DataFrame, id_col: str, label_col: str, n_folds: int = 5, seed: int | str = 42, target: str = "fold"
) -> DataFrame:
    """Add a fold number 0..n_folds-1; folds differ by at most one row, in every
    class and in all."""
    return _assign_parts(df, id_col, label_col, seed, _fold_ends(n_folds), target)


def class_shares(df: DataFrame, split_col: str, label_col: str) -> DataFrame:
    """Rows and share of every class inside every split."""
    counts = df.groupBy(split_col, label_col).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(split_col))
    return counts.withColumn("share", F.col("rows") / total)
