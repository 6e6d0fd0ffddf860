import pytest
from pyspark.sql import functions as F

from classkit import functions as fn
from classkit.operators import columns
from classkit.runtime import few, small
from classkit.sources import explode_features, pack_features, preview, read_table, write_table


def test_csv_with_blank_header_cell(spark, tmp_path):
    path = tmp_path / "cars.csv"
    path.write_text(',mpg,cyl\n"Mazda RX4",21.0,6\n"Datsun 710",22.8,4\n')
    df = columns.rename_column(read_table(spark, str(path)), "_c0", "model")
    assert df.columns == ["model", "mpg", "cyl"]
    typed = columns.cast_target(columns.drop_columns(df, ["model"]), "cyl")
    assert dict(typed.dtypes)["cyl"] == "int" and columns.numeric_columns(df, ["cyl"]) == ["mpg"]
    assert [r["cyl"] for r in preview(typed, "cyl", 1).collect()] == [4]


def test_write_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, kind string")
    write_table(df, str(tmp_path / "t"), ["kind"])
    assert read_table(spark, str(tmp_path / "t")).count() == 2


def test_dropping_an_absent_column_is_an_error(spark):
    with pytest.raises(KeyError):
        columns.drop_columns(spark.range(1), ["nope"])
    assert columns.rename_column(spark.range(1), "nope", "x").columns == ["id"]


def test_bad_features_are_counted(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 1.0)], "id long, x double")
    with pytest.raises(ValueError, match="x: 1 null, 1 NaN"):
        columns.require_clean(df, ["id", "x"])
    assert columns.require_clean(df, ["id"]) is df


@pytest.mark.parametrize("names", [["c"], ["label_idx"], ["c", "label_idx"], ["n_classes"]])
def test_too_many_classes_raise_under_every_projection(spark, names):
    df = spark.range(10_500).withColumnRenamed("id", "c")
    with pytest.raises(Exception, match="too many classes"):
        columns.label_index(df, "c").select(*names).collect()


def test_label_index_is_sorted_not_by_frequency(spark):
    df = spark.createDataFrame([(8,), (8,), (8,), (4,), (6,)], "cyl int")
    index = {r["cyl"]: r["label_idx"] for r in columns.label_index(df, "cyl").collect()}
    assert index == {4: 0, 6: 1, 8: 2}
    back = columns.decode_label(columns.with_label_index(df, "cyl"), "label_idx", columns.label_index(df, "cyl"), "cyl", "name", " cyl")
    assert {(r["label_idx"], r["name"]) for r in back.collect()} == {(0, "4 cyl"), (1, "6 cyl"), (2, "8 cyl")}


def test_array_columns_round_trip(spark):
    df = spark.createDataFrame([(1, [0.5, 1.5])], "id long, v array<double>")
    wide = explode_features(df, "v", ["a", "b"])
    assert wide.first().asDict() == {"id": 1, "a": 0.5, "b": 1.5}
    assert pack_features(wide, ["a", "b"], "v").first()["v"] == [0.5, 1.5]


def test_scores(spark):
    row = spark.range(1).select(
        fn.threshold(F.lit(0.5)).alias("at"),
        fn.threshold(F.lit(0.4999)).alias("below"),
        fn.argmax(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))).alias("tie"),
        fn.softmax(F.array(F.lit(1000.0), F.lit(1000.0))).alias("soft"),
        fn.logistic(F.lit(0.0)).alias("half"),
        fn.clipped_log_loss(F.lit(0.0)).alias("clipped"),
        fn.edge_width(F.lit(0.001), F.lit(1.0), 4.0).alias("narrow"),
        fn.centred_unit(F.lit(-2.0), F.lit(2.0)).alias("low"),
    ).first()
    assert (row["at"], row["below"], row["tie"]) == (1, 0, 1)
    assert row["soft"] == [0.5, 0.5] and row["half"] == 0.5 and 36 < row["clipped"] < 36.1
    assert row["narrow"] == 0.3 and row["low"] == 0.0


def test_small_refuses_a_larger_table(spark):
    assert small(spark.range(3), 3, "rows").count() == 3
    with pytest.raises(ValueError):
        small(spark.range(4), 3, "rows")


def test_few_fails_a_broadcast_side_that_is_too_large(spark):
    df = spark.range(10)
    assert df.join(few(spark.range(3), 3, "rows"), "id").count() == 3
    with pytest.raises(Exception, match="too many rows"):
        df.join(few(spark.range(4), 3, "rows"), "id").collect()
