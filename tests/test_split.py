from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from classkit.operators import split


def labelled(spark, sizes):
    rows = [(i * 100 + j, label) for i, (label, n) in enumerate(sizes.items()) for j in range(n)]
    return spark.createDataFrame(rows, "id long, label string")


def sizes_of(df, part):
    return Counter((r["label"], r[part]) for r in df.collect())


def test_tiny_strata_have_exact_sizes(spark):
    # 10 rows, 30% -> 3 test rows; shares .6, .9, 1.5 -> 0, 0, 1 and two leftovers to .9 and .6
    out = split.stratified_split(labelled(spark, {"a": 2, "b": 3, "c": 5}), "id", "label", 0.3)
    sizes = sizes_of(out, "split")
    assert {k: v for k, v in sizes.items() if k[1] == "test"} == {("a", "test"): 1, ("b", "test"): 1, ("c", "test"): 1}
    assert out.select("id").distinct().count() == 10


def test_a_class_may_get_no_test_rows(spark):
    out = split.stratified_split(labelled(spark, {"a": 2, "b": 30}), "id", "label", 0.1)
    assert sizes_of(out, "split") == {("a", "train"): 2, ("b", "train"): 26, ("b", "test"): 4}


def test_single_row_class_is_an_error(spark):
    with pytest.raises(ValueError):
        split.stratified_split(labelled(spark, {"a": 1, "b": 5}), "id", "label")


def test_same_seed_same_split_other_seed_other_split(spark):
    df = labelled(spark, {"a": 40, "b": 40})
    one, two, other = (
        {r["id"] for r in split.stratified_split(df, "id", "label", seed=s).where("split = 'test'").collect()}
        for s in (42, 42, 7)
    )
    assert one == two != other


@pytest.mark.parametrize(("digits", "rows"), [(1, 100_000), (3, 100_000), (1, 20), (8, 0)])
def test_cuts_equal_plain_ranks(spark, monkeypatch, digits, rows):
    monkeypatch.setattr(split, "PREFIX_DIGITS", digits)
    monkeypatch.setattr(split, "BUCKET_ROWS", rows)
    # two thirds of the rows in one class
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("label"))
    out = split.stratified_folds(df, "id", "label", 7, seed=5)
    place = F.row_number().over(Window.partitionBy("label").orderBy(split.order_key("id", 5), "id"))
    ranked = out.withColumn("place", place)
    # folds are ranges of the class order
    runs = ranked.groupBy("label", "fold").agg(F.min("place").alias("lo"), F.max("place").alias("hi"), F.count("*").alias("n"))
    assert all(r["hi"] - r["lo"] + 1 == r["n"] for r in runs.collect())
    assert {r["fold"] for r in runs.collect()} == set(range(7))


def test_folds_differ_by_one_row(spark):
    out = split.stratified_folds(labelled(spark, {"a": 7, "b": 11, "c": 5}), "id", "label", 5)
    whole = Counter(r["fold"] for r in out.collect())
    assert max(whole.values()) - min(whole.values()) <= 1 and sum(whole.values()) == 23
    for label in "abc":
        per_class = [sizes_of(out, "fold").get((label, f), 0) for f in range(5)]
        assert max(per_class) - min(per_class) <= 1


def test_rows_without_label_stay_without_part(spark):
    df = spark.createDataFrame([(i, None if i == 0 else "a") for i in range(11)], "id long, label string")
    out = split.stratified_split(df, "id", "label")
    assert out.count() == 11 and out.where("split is null").count() == 1


def test_nested_split_is_disjoint(spark):
    out = split.nested_split(labelled(spark, {"a": 50, "b": 50}), "id", "label")
    assert Counter(r["split"] for r in out.collect()) == {"test": 30, "valid": 14, "train": 56}
    assert out.select("id").distinct().count() == 100


def test_nested_split_equals_a_split_of_the_train_part(spark):
    df = labelled(spark, {"a": 60, "b": 31, "c": 9, "none": 1}).withColumn("more", F.lit(1))
    df = df.withColumn("label", F.when(F.col("label") != "none", F.col("label")))
    out = split.nested_split(df, "id", "label")
    assert out.columns == [*df.columns, "split"] and out.count() == 100
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()  # one scan
    train = split.stratified_split(df, "id", "label").where("split = 'train'").drop("split")
    want = {r["id"]: r["s"] for r in split.stratified_split(train, "id", "label", 0.2, "42|valid", "s", ("valid", "train")).collect()}
    assert {r["id"]: r["split"] for r in out.where("split != 'test'").collect()} == want
