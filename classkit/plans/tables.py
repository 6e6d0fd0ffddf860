"""Queries on sources, columns, splits and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from classkit import functions as fn
from classkit.operators import columns, early_stop, ranking, scale, split
from classkit.operators.model_tables import ROBUST_PERCENTILE, WEAK_SHARE
from classkit.plans.inputs import (
    JUDGED,
    LINE_FEATURES,
    LINES,
    SEED,
    TEST_SIZE,
    VALID_SIZE,
    VECTORS,
    folds_sql,
    judged_documents,
    lines,
    split_sql,
    table,
    vectors,
)
from classkit.plans.registry import query
from classkit.runtime import scratch_path
from classkit.sources import explode_features, pack_features, preview, read_table, write_table

WIDTH = 64  # entries of the embedding column
NAMES = [f"f{i}" for i in range(WIDTH)]

# --- sources and sinks ------------------------------------------------------

PART_SCHEMA = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)


@query("csv_round_trip", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "part") + ".csv"
    write_table(table(spark, sf_dir, "part").select(*PART_SCHEMA.names), path)
    return read_table(spark, path, PART_SCHEMA)


@query(
    "parquet_round_trip",
    "SELECT o_orderstatus, count(*) AS row_count, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def parquet_round_trip(spark, sf_dir):
    path = scratch_path(spark, "orders")
    write_table(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, ["o_orderstatus"])
    written = read_table(spark, path)
    return written.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "explode_features",
    "SELECT vec_id, label, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS {n}" for i, n in enumerate(NAMES)) + " FROM embeddings",
)
def explode_features_query(spark, sf_dir):
    return explode_features(vectors(spark, sf_dir), "features", NAMES)


@query(
    "pack_features",
    f"""WITH {LINES}, packed AS (
  SELECT line_id, l_returnflag, [l_quantity, l_extendedprice, l_discount, l_tax] AS v FROM lines)
SELECT line_id, l_returnflag, len(v)::INTEGER AS width, round(list_sum(v), 4) AS total FROM packed""",
)
def pack_features_query(spark, sf_dir):
    packed = pack_features(lines(spark, sf_dir), LINE_FEATURES)
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return packed.select("line_id", "l_returnflag", F.size("features").alias("width"), F.round(total, 4).alias("total"))


@query("preview_rows", "SELECT * EXCLUDE (ts) FROM events ORDER BY event_id LIMIT 5")
def preview_rows(spark, sf_dir):
    return preview(table(spark, sf_dir, "events").drop("ts"), "event_id", 5)


# --- columns ----------------------------------------------------------------


@query("rename_column", "SELECT p_partkey AS part_id, p_size FROM part")
def rename_column(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return columns.rename_column(columns.rename_column(df, "p_partkey", "part_id"), "_c0", "model")


@query("drop_columns", "SELECT * EXCLUDE (p_name, p_type) FROM part")
def drop_columns(spark, sf_dir):
    return columns.drop_columns(table(spark, sf_dir, "part"), ["p_name", "p_type"])


@query(
    "select_numeric",
    "SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice, p_type FROM part",
)
def select_numeric(spark, sf_dir):
    return columns.select_features(table(spark, sf_dir, "part"), "p_type", keep=["p_partkey"])


@query("cast_target", "SELECT event_id, trunc(value)::INTEGER AS value FROM events")
def cast_target(spark, sf_dir):
    return columns.cast_target(table(spark, sf_dir, "events").select("event_id", "value"), "value")


STATUS_NAMES = {"F": "filled", "O": "open"}


@query(
    "map_values",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS status FROM orders",
)
def map_values(spark, sf_dir):
    df = columns.map_values(table(spark, sf_dir, "orders"), "o_orderstatus", "status", STATUS_NAMES)
    return df.select("o_orderkey", "status")


CLASSES_SQL = """SELECT event_type, (row_number() OVER (ORDER BY event_type) - 1)::INTEGER AS label_idx,
  (count(*) OVER ())::INTEGER AS n_classes FROM (SELECT DISTINCT event_type FROM events)"""


@query("distinct_classes", CLASSES_SQL)
def distinct_classes(spark, sf_dir):
    return columns.label_index(table(spark, sf_dir, "events"), "event_type").orderBy("label_idx")


@query("label_index", "SELECT event_id, (dense_rank() OVER (ORDER BY event_type) - 1)::INTEGER AS label_idx FROM events")
def label_index(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "event_type")
    return columns.with_label_index(df, "event_type").select("event_id", "label_idx")


@query(
    "decode_label",
    "SELECT vec_id, (dense_rank() OVER (ORDER BY label) - 1)::INTEGER AS label_idx, concat(label, ' cyl') AS shown FROM embeddings",
)
def decode_label(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    indexed = columns.with_label_index(df, "label").drop("label")
    return columns.decode_label(indexed, "label_idx", columns.label_index(df, "label"), "label", "shown", " cyl")


@query(
    "threshold",
    f"WITH {LINES} SELECT line_id, (l_discount * 10 >= 0.5::DOUBLE)::INTEGER AS prediction FROM lines",
)
def threshold(spark, sf_dir):
    return lines(spark, sf_dir).select("line_id", fn.threshold(F.col("l_discount") * 10).alias("prediction"))


@query(
    "argmax",
    "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS prediction FROM embeddings",
)
def argmax(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", fn.argmax(F.col("embedding")).alias("prediction"))


@query(
    "class_probabilities",
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, list_max(embedding)::DOUBLE AS m FROM embeddings),
long AS (SELECT vec_id, m, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e),
z AS (SELECT vec_id, sum(exp(x - m)) AS total, max(CASE WHEN pos = 2 THEN exp(x - m) END) AS one,
             max(CASE WHEN pos = 1 THEN x END) AS first FROM long GROUP BY vec_id)
SELECT vec_id, round(one / total, 9) AS p_class_1, round(1 / (1 + exp(-first)), 9) AS p_first FROM z""",
)
def class_probabilities(spark, sf_dir):
    return vectors(spark, sf_dir).select(
        "vec_id",
        F.round(fn.positive_probability(fn.softmax(F.col("features"))), 9).alias("p_class_1"),
        F.round(fn.logistic(F.col("features")[0]), 9).alias("p_first"),
    )


@query(
    "bad_features",
    f"""WITH {JUDGED}, d AS (SELECT *, CASE WHEN n_digits > 0 THEN n_lines / n_digits END AS per_digit FROM judged),
c AS (SELECT 'n_chars' AS feature, n_chars AS x FROM d UNION ALL SELECT 'per_digit', per_digit FROM d)
SELECT feature, count(*) FILTER (x IS NULL) AS nulls, count(*) FILTER (isnan(x)) AS nans FROM c GROUP BY feature""",
)
def bad_features(spark, sf_dir):
    df = judged_documents(spark, sf_dir)
    df = df.withColumn("per_digit", F.when(F.col("n_digits") > 0, F.col("n_lines") / F.col("n_digits")))
    return columns.bad_feature_counts(df, ["n_chars", "per_digit"])


@query(
    "bad_vectors",
    """SELECT count(*) AS n_rows, count(*) FILTER (embedding IS NULL) AS null_rows,
  count(*) FILTER (len(list_filter(embedding, lambda x: x IS NULL)) > 0) AS null_entry_rows,
  count(*) FILTER (len(list_filter(embedding, lambda x: isnan(x))) > 0) AS nan_rows,
  min(len(embedding))::INTEGER AS min_width, max(len(embedding))::INTEGER AS max_width FROM embeddings""",
)
def bad_vectors(spark, sf_dir):
    return columns.bad_vector_counts(table(spark, sf_dir, "embeddings"), "embedding")


# --- splits -----------------------------------------------------------------


@query(
    "stratified_split",
    f"WITH {split_sql('s', 'orders', 'o_orderkey', 'o_orderstatus', TEST_SIZE)} "
    "SELECT o_orderkey, o_orderstatus, part AS split FROM s",
)
def stratified_split(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(df, "o_orderkey", "o_orderstatus", TEST_SIZE, SEED)


@query(
    "stratified_split_lines",
    f"WITH {LINES}, {split_sql('s', 'lines', 'line_id', 'l_returnflag', TEST_SIZE)} "
    "SELECT line_id, l_returnflag, part AS split FROM s",
)
def stratified_split_lines(spark, sf_dir):
    df = lines(spark, sf_dir).select("line_id", "l_returnflag")
    return split.stratified_split(df, "line_id", "l_returnflag", TEST_SIZE, SEED)


NESTED_SQL = f"""{split_sql("outer_", "orders", "o_orderkey", "o_orderstatus", TEST_SIZE)},
inner_train AS (SELECT * EXCLUDE (part) FROM outer_ WHERE part = 'train'),
{split_sql("inner_", "inner_train", "o_orderkey", "o_orderstatus", VALID_SIZE, f"{SEED}|valid")}
"""


@query(
    "nested_split",
    f"""WITH {NESTED_SQL}
SELECT o_orderkey, o_orderstatus, 'test' AS split FROM outer_ WHERE part = 'test'
UNION ALL SELECT o_orderkey, o_orderstatus, CASE part WHEN 'test' THEN 'valid' ELSE 'train' END FROM inner_""",
)
def nested_split(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split.nested_split(df, "o_orderkey", "o_orderstatus", TEST_SIZE, VALID_SIZE, SEED)


@query(
    "stratified_folds",
    f"WITH {folds_sql('f', 'orders', 'o_orderkey', 'o_orderstatus')} SELECT o_orderkey, o_orderstatus, fold FROM f",
)
def stratified_folds(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_folds(df, "o_orderkey", "o_orderstatus", 5, SEED)


@query(
    "class_shares",
    f"""WITH {split_sql("s", "events", "event_id", "event_type", TEST_SIZE)},
c AS (SELECT part AS split, event_type, count(*) AS row_count FROM s GROUP BY 1, 2)
SELECT split, event_type, row_count, round(row_count / sum(row_count) OVER (PARTITION BY split), 9) AS share FROM c""",
)
def class_shares(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "event_type")
    parts = split.stratified_split(df, "event_id", "event_type", TEST_SIZE, SEED)
    shares = split.class_shares(parts, "split", "event_type")
    return shares.select("split", "event_type", F.col("rows").alias("row_count"), F.round("share", 9).alias("share"))


# --- scaling ----------------------------------------------------------------

LINES_SPLIT = f"{LINES}, {split_sql('s', 'lines', 'line_id', 'l_returnflag', TEST_SIZE)}"
LINE_STATS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_pop({c}) AS std FROM s WHERE part = 'train'" for c in LINE_FEATURES
)


@query(
    "fit_column_scaler",
    f"WITH {LINES_SPLIT}, stats AS ({LINE_STATS}) SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM stats",
)
def fit_column_scaler(spark, sf_dir):
    parts = split.stratified_split(lines(spark, sf_dir), "line_id", "l_returnflag", TEST_SIZE, SEED)
    stats = scale.fit_column_scaler(parts.where("split = 'train'"), LINE_FEATURES)
    return stats.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(
    "apply_scaler",
    f"""WITH {LINES_SPLIT}, t AS (SELECT * FROM s WHERE part = 'train'),
stats AS (SELECT {", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(LINE_FEATURES))} FROM t)
SELECT line_id, part AS split,
  {", ".join(f"round(({c} - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END, 6) AS {c}" for i, c in enumerate(LINE_FEATURES))}
FROM s, stats""",
)
def apply_scaler(spark, sf_dir):
    packed = pack_features(lines(spark, sf_dir), LINE_FEATURES)
    parts = split.stratified_split(packed, "line_id", "l_returnflag", TEST_SIZE, SEED)
    scaler = scale.fit_scaler(parts.where("split = 'train'"), "features")
    scaled = scale.apply_scaler(parts, scaler, "features")
    return scaled.select(
        "line_id", "split", *[F.round(F.col("features")[i], 6).alias(c) for i, c in enumerate(LINE_FEATURES)]
    )


@query(
    "fit_fold_scalers",
    f"""WITH {VECTORS}, {folds_sql("f", "vectors", "vec_id", "label")},
long AS (SELECT fold, unnest(features) AS x, generate_subscripts(features, 1) - 1 AS pos FROM f),
folds AS (SELECT DISTINCT fold FROM f)
SELECT folds.fold, pos::INTEGER AS pos, count(*) AS n, round(avg(x), 9) AS mean, round(stddev_pop(x), 9) AS std
FROM folds JOIN long ON long.fold <> folds.fold GROUP BY folds.fold, pos""",
)
def fit_fold_scalers(spark, sf_dir):
    folds = split.stratified_folds(vectors(spark, sf_dir), "vec_id", "label", 5, SEED)
    stats = scale.fit_fold_scalers(folds, "features")
    long = stats.select("fold", "n", F.posexplode(F.arrays_zip("mean", "std")).alias("pos", "s"))
    return long.select("fold", "pos", "n", F.round("s.mean", 9).alias("mean"), F.round("s.std", 9).alias("std"))


# --- weight tables ----------------------------------------------------------

# A table shaped like network weights: one layer per class, one node per vector.
WEIGHTS = """weights AS (
  SELECT label AS layer, vec_id AS src, unnest(embedding)::DOUBLE AS weight, (generate_subscripts(embedding, 1) - 1)::INTEGER AS dst
  FROM embeddings)"""


def weights(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    return df.select(F.col("label").alias("layer"), F.col("vec_id").alias("src"), F.posexplode("embedding").alias("dst", "w")).select(
        "layer", "src", "dst", F.col("w").cast("double").alias("weight")
    )


# Widths of drawn edges.
WIDEST, NARROWEST_CLIPPED, WIDEST_CLIPPED = 4.0, 0.2, 3.0


@query(
    "strong_weights",
    f"""WITH {WEIGHTS}, m AS (SELECT *, max(abs(weight)) OVER (PARTITION BY layer) AS largest FROM weights)
SELECT layer, src, dst, weight FROM m WHERE abs(weight) >= {WEAK_SHARE}::DOUBLE * largest""",
)
def strong_weights(spark, sf_dir):
    from classkit.operators.model_tables import strong_edges

    return strong_edges(weights(spark, sf_dir))


@query(
    "edge_styles",
    f"""WITH {WEIGHTS}, c AS (SELECT quantile_cont(abs(weight), {ROBUST_PERCENTILE}) AS robust, max(abs(weight)) AS largest FROM weights)
SELECT layer, src, dst, round(greatest(0.3, {WIDEST} * abs(weight) / largest), 6) AS width,
  round({NARROWEST_CLIPPED} + least(abs(weight), robust) / robust * ({WIDEST_CLIPPED} - {NARROWEST_CLIPPED}), 6) AS clipped_width,
  round(0.5 + 0.5 * weight / largest, 6) AS colour,
  round(least(greatest(0.5 + 0.5 * weight / robust, 0), 1), 6) AS robust_colour FROM weights, c""",
)
def edge_styles(spark, sf_dir):
    from classkit.operators.model_tables import edge_styles as styled

    out = styled(weights(spark, sf_dir), widest=WIDEST, narrowest_clipped=NARROWEST_CLIPPED, widest_clipped=WIDEST_CLIPPED)
    rounded = [F.round(c, 6).alias(c) for c in ("width", "clipped_width", "colour", "robust_colour")]
    return out.select("layer", "src", "dst", *rounded)


@query(
    "layer_sizes",
    f"""WITH {WEIGHTS} SELECT layer, (max(src) + 1)::BIGINT AS n_in, (max(dst) + 1)::BIGINT AS n_out FROM weights GROUP BY layer""",
)
def layer_sizes(spark, sf_dir):
    from classkit.operators.model_tables import layer_sizes as sizes

    return sizes(weights(spark, sf_dir))


@query(
    "robust_maximum",
    f"""WITH {WEIGHTS} SELECT layer, round(CASE WHEN max(abs(weight)) = 0 THEN 1 ELSE quantile_cont(abs(weight), {ROBUST_PERCENTILE}) END, 9) AS ceiling
FROM weights GROUP BY layer""",
)
def robust_maximum(spark, sf_dir):
    from classkit.operators.model_tables import robust_maximum as ceiling

    out = ceiling(weights(spark, sf_dir), by=["layer"])
    return out.select("layer", F.round("ceiling", 9).alias("ceiling"))


@query(
    "weight_matrix",
    f"""WITH {WEIGHTS} SELECT src AS feature,
  {", ".join(f"max(CASE WHEN dst = {i} THEN weight END) AS h{i + 1}" for i in range(WIDTH))} FROM weights GROUP BY src""",
)
def weight_matrix(spark, sf_dir):
    from classkit.operators.model_tables import weight_matrix as matrix

    return matrix(weights(spark, sf_dir), WIDTH).withColumnRenamed("src", "feature")


@query(
    "exact_percentile",
    "SELECT round(quantile_cont(o_totalprice, 0.99), 6) AS p99 FROM orders",
)
def exact_percentile(spark, sf_dir):
    out = ranking.exact_percentile(table(spark, sf_dir, "orders"), "o_totalprice", 0.99)
    return out.select(F.round("percentile", 6).alias("p99"))


# --- early stopping ---------------------------------------------------------

HISTORY = """history AS (
  SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS epoch,
         round(value / 100, 6) AS val_loss FROM events)"""


@query(
    "early_stop",
    f"""WITH RECURSIVE {HISTORY},
walk AS (
  SELECT run, 1::BIGINT AS epoch, val_loss AS best, 1::BIGINT AS best_epoch, 0 AS waited FROM history WHERE epoch = 1
  UNION ALL
  SELECT h.run, h.epoch,
    CASE WHEN val_loss < best - 0.001::DOUBLE THEN val_loss ELSE best END,
    CASE WHEN val_loss < best - 0.001::DOUBLE THEN h.epoch ELSE best_epoch END,
    CASE WHEN val_loss < best - 0.001::DOUBLE THEN 0 ELSE waited + 1 END
  FROM walk JOIN history h ON h.run = walk.run AND h.epoch = walk.epoch + 1
  WHERE waited < 3)
SELECT run, best_epoch::INTEGER AS best_epoch, best AS best_loss, epoch::INTEGER AS stop_epoch, waited >= 3 AS stopped_early
FROM walk QUALIFY row_number() OVER (PARTITION BY run ORDER BY epoch DESC) = 1""",
)
def early_stop_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id").orderBy("event_id")
    history = events.select(
        F.col("user_id").alias("run"),
        F.row_number().over(order).alias("epoch"),
        F.round(F.col("value") / 100, 6).alias("val_loss"),
    )
    return early_stop.early_stop(history, patience=3)


