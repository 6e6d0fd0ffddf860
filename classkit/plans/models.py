"""Queries that train and apply models, with the library's defaults.

All run at full length: up to 2,000 iterations with the stall rule, up to 200
epochs of batches of 32 rows with the stop rule, 300 or 15,000 rounds of trees.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from classkit import functions as fn
from classkit.operators import boosting, knn, metrics, mlp, model_tables, ranking, scale, split, stored
from classkit.plans.inputs import (
    BINARY_VECTORS,
    DOC_FEATURES,
    SEED,
    TEST_SIZE,
    VALID_SIZE,
    VECTORS,
    binary_vectors,
    judged_documents,
    vectors,
)
from classkit.plans.registry import query
from classkit.runtime import scratch_path, written
from classkit.sources import explode_features, pack_features

OUTPUT_NAMES, OUTPUT_LAYER = ["high"], 4  # the one output of the network with epochs, after three hidden layers
# The trees of the binary model that are shown.
BINARY_TREE_IDS = [0, 4, 499, 14_999]


def _rounded(df, names, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def documents(spark, sf_dir):
    """Judged documents with their counts in one array column.

    Written once: training scans the few numbers many times, the texts only now.
    """
    df = judged_documents(spark, sf_dir).select("doc_id", "label", *DOC_FEATURES)
    return written(pack_features(df, DOC_FEATURES), "documents")


# --- a network with formula weights: forward pass and gradient ---------------

HIDDEN, CLASSES, WIDTH = 8, 10, 64


def formula_network() -> mlp.Network:
    """Weights sin(1 + place) / 4, biases cos(place) / 4, as in FORMULA below."""

    def matrix(n_in, n_out):
        return np.sin(1.0 + np.arange(n_in * n_out)).reshape(n_in, n_out) / 4.0

    return mlp.Network(
        [matrix(WIDTH, HIDDEN), matrix(HIDDEN, CLASSES)],
        [np.cos(np.arange(HIDDEN)) / 4.0, np.cos(np.arange(CLASSES)) / 4.0],
    )


ENTRIES = "SELECT vec_id, label, unnest(features) AS x, generate_subscripts(features, 1) - 1 AS i FROM vectors"
LAYERS = f"""
w1 AS (SELECT i, j, sin(1.0::DOUBLE + i * {HIDDEN} + j) / 4 AS w
       FROM (SELECT unnest(range({WIDTH})) AS i) a, (SELECT unnest(range({HIDDEN})) AS j) b),
w2 AS (SELECT j, k, sin(1.0::DOUBLE + j * {CLASSES} + k) / 4 AS w
       FROM (SELECT unnest(range({HIDDEN})) AS j) a, (SELECT unnest(range({CLASSES})) AS k) b),
z1 AS (SELECT vec_id, label, j, sum(x * w) + cos(j::DOUBLE) / 4 AS z FROM x JOIN w1 USING (i) GROUP BY vec_id, label, j),
z2 AS (SELECT vec_id, label, k, sum(greatest(z, 0) * w) + cos(k::DOUBLE) / 4 AS z FROM z1 JOIN w2 USING (j) GROUP BY vec_id, label, k),
p AS (SELECT *, exp(z) / sum(exp(z)) OVER (PARTITION BY vec_id) AS p FROM z2)"""


FORMULA = f"{VECTORS}, x AS ({ENTRIES}), {LAYERS}"


@query("mlp_forward", f"WITH {FORMULA} SELECT vec_id, k::INTEGER AS class, round(p, 9) AS probability FROM p")
def mlp_forward(spark, sf_dir):
    scored = mlp.predict(vectors(spark, sf_dir), mlp.Fit(formula_network()))
    long = scored.select("vec_id", F.posexplode("p").alias("class", "probability"))
    return long.withColumn("probability", F.round("probability", 9))


GRADIENT = f"""{FORMULA},
d2 AS (SELECT vec_id, k, p - (label = k)::INT AS d FROM p),
d1 AS (SELECT vec_id, j, any_value(z) AS z, sum(d * w) * (any_value(z) > 0)::INT AS d
       FROM z1 JOIN w2 USING (j) JOIN d2 USING (vec_id, k) GROUP BY vec_id, j),
g AS (
  SELECT 0 AS layer, i AS src, j AS dst, sum(x * d) AS gradient FROM x JOIN d1 USING (vec_id) GROUP BY i, j
  UNION ALL SELECT 0, -1, j, sum(d) FROM d1 GROUP BY j
  UNION ALL SELECT 1, j, k, sum(greatest(z, 0) * d2.d) FROM z1 JOIN d2 USING (vec_id) GROUP BY j, k
  UNION ALL SELECT 1, -1, k, sum(d) FROM d2 GROUP BY k)"""


def _network_table(spark, network, name):
    """Weights and biases in one table; biases have ``src`` -1."""
    weights = mlp.weight_table(spark, network).withColumnRenamed("weight", name)
    biases = mlp.bias_table(spark, network).select("layer", F.lit(-1).alias("src"), F.col("node").alias("dst"), F.col("bias").alias(name))
    return _rounded(weights.unionByName(biases), [name])


@query(
    "mlp_gradient",
    f"""WITH {GRADIENT}
SELECT layer, src::INTEGER AS src, dst::INTEGER AS dst, round(gradient, 6) AS gradient FROM g""",
)
def mlp_gradient(spark, sf_dir):
    """The summed gradient of one full pass."""
    network = formula_network()
    total = mlp.sum_gradients(mlp.training_rows(vectors(spark, sf_dir)), {0: mlp.Fit(network)})[0]
    return _network_table(spark, network.like(total[2:]), "gradient")


@query(
    "mlp_first_step",
    f"""WITH {GRADIENT},
w AS (
  SELECT 0 AS layer, i AS src, j AS dst, w, 0.001::DOUBLE * w AS decay FROM w1
  UNION ALL SELECT 1, j, k, w, 0.001::DOUBLE * w FROM w2
  UNION ALL SELECT 0, -1, j, cos(j::DOUBLE) / 4, 0 FROM (SELECT unnest(range({HIDDEN})) AS j)
  UNION ALL SELECT 1, -1, k, cos(k::DOUBLE) / 4, 0 FROM (SELECT unnest(range({CLASSES})) AS k)),
m AS (SELECT layer, src, dst, w, (gradient + decay) / (SELECT count(*) FROM vectors) AS g FROM w JOIN g USING (layer, src, dst))
SELECT layer, src::INTEGER AS src, dst::INTEGER AS dst,
  round(w - 0.001::DOUBLE * sqrt(1 - 0.999::DOUBLE) / (1 - 0.9::DOUBLE) * (0.1::DOUBLE * g)
    / (sqrt(0.001::DOUBLE * g * g) + 1e-8::DOUBLE), 6) AS weight FROM m""",
)
def mlp_first_step(spark, sf_dir):
    """All weights after one step of the full-batch fit from the formula network."""
    fit = mlp.fit_full_batch(vectors(spark, sf_dir), n_classes=CLASSES, max_iter=1, start=formula_network())[0]
    return _network_table(spark, fit.network, "weight")


# --- a short epoch: three batches, one after the other -------------------------

EPOCH_STEPS, EPOCH_ALPHA = 3, 1e-4


def _epoch_sql() -> str:
    """Forward pass, gradient and Adam's step for each batch in turn, from the formula network."""
    sql = f"""WITH {VECTORS},
x AS MATERIALIZED (
  SELECT vec_id, label, ('0x' || substr(md5(concat(vec_id::VARCHAR, '|{SEED}')), 1, 8))::BIGINT % {EPOCH_STEPS} AS batch,
    unnest(features) AS x, generate_subscripts(features, 1) - 1 AS i FROM vectors),
w0 AS MATERIALIZED (
  SELECT *, 0::DOUBLE AS m, 0::DOUBLE AS v, CASE WHEN src >= 0 THEN {EPOCH_ALPHA}::DOUBLE ELSE 0 END AS decay FROM (
    SELECT 0 AS layer, i AS src, j AS dst, sin(1.0::DOUBLE + i * {HIDDEN} + j) / 4 AS w FROM range({WIDTH}) a(i), range({HIDDEN}) b(j)
    UNION ALL SELECT 1, j, k, sin(1.0::DOUBLE + j * {CLASSES} + k) / 4 FROM range({HIDDEN}) a(j), range({CLASSES}) b(k)
    UNION ALL SELECT 0, -1, j, cos(j::DOUBLE) / 4 FROM range({HIDDEN}) a(j)
    UNION ALL SELECT 1, -1, k, cos(k::DOUBLE) / 4 FROM range({CLASSES}) a(k)))"""
    for t in range(EPOCH_STEPS):
        rate = f"0.001::DOUBLE * sqrt(1 - pow(0.999::DOUBLE, {t + 1})) / (1 - pow(0.9::DOUBLE, {t + 1}))"
        sql += f""",
a{t} AS MATERIALIZED (
  SELECT x.vec_id, x.label, w.dst AS j, sum(x.x * w.w) + any_value(c.w) AS z
  FROM x JOIN w{t} w ON w.layer = 0 AND w.src = x.i JOIN w{t} c ON c.layer = 0 AND c.src = -1 AND c.dst = w.dst
  WHERE x.batch = {t} GROUP BY x.vec_id, x.label, w.dst),
z{t} AS (
  SELECT a.vec_id, a.label, w.dst AS k, sum(greatest(a.z, 0) * w.w) + any_value(c.w) AS z
  FROM a{t} a JOIN w{t} w ON w.layer = 1 AND w.src = a.j JOIN w{t} c ON c.layer = 1 AND c.src = -1 AND c.dst = w.dst
  GROUP BY a.vec_id, a.label, w.dst),
d{t} AS MATERIALIZED (SELECT vec_id, k, exp(z) / sum(exp(z)) OVER (PARTITION BY vec_id) - (label = k)::INT AS d FROM z{t}),
e{t} AS MATERIALIZED (
  SELECT a.vec_id, a.j, sum(d.d * w.w) * (any_value(a.z) > 0)::INT AS d
  FROM a{t} a JOIN w{t} w ON w.layer = 1 AND w.src = a.j JOIN d{t} d ON d.vec_id = a.vec_id AND d.k = w.dst GROUP BY a.vec_id, a.j),
g{t} AS (
  SELECT 0 AS layer, x.i AS src, e.j AS dst, sum(x.x * e.d) AS g FROM x JOIN e{t} e ON e.vec_id = x.vec_id GROUP BY x.i, e.j
  UNION ALL SELECT 0, -1, j, sum(d) FROM e{t} GROUP BY j
  UNION ALL SELECT 1, a.j, d.k, sum(greatest(a.z, 0) * d.d) FROM a{t} a JOIN d{t} d ON d.vec_id = a.vec_id GROUP BY a.j, d.k
  UNION ALL SELECT 1, -1, k, sum(d) FROM d{t} GROUP BY k),
s{t} AS (
  SELECT w.layer, w.src, w.dst, w.w, w.decay, w.m, w.v,
    (g.g + w.decay * w.w) / (SELECT count(DISTINCT vec_id) FROM x WHERE batch = {t}) AS g
  FROM w{t} w JOIN g{t} g ON g.layer = w.layer AND g.src = w.src AND g.dst = w.dst),
m{t} AS (SELECT * REPLACE (m + 0.1::DOUBLE * (g - m) AS m, v + 0.001::DOUBLE * (g * g - v) AS v) FROM s{t}),
w{t + 1} AS MATERIALIZED (SELECT layer, src, dst, w - {rate} * m / (sqrt(v) + 1e-8::DOUBLE) AS w, m, v, decay FROM m{t})"""
    return sql + f"""
SELECT layer, src::INTEGER AS src, dst::INTEGER AS dst, round(w, 6) AS weight FROM w{EPOCH_STEPS}"""


@query("mlp_first_epoch", _epoch_sql())
def mlp_first_epoch(spark, sf_dir):
    """All weights after the relay of one epoch from the formula network, in three batches."""
    df = vectors(spark, sf_dir)
    third = -(-df.count() // EPOCH_STEPS)
    fit = mlp.fit_epochs(
        df, df, "vec_id", n_classes=CLASSES, alpha=EPOCH_ALPHA, max_epochs=1, seed=SEED, batch_rows=third, start=formula_network()
    )
    return _network_table(spark, fit.network, "weight")


# --- scaled network on ten classes, with cross-validation --------------------


def _vector_network(spark, sf_dir):
    parts = split.stratified_split(vectors(spark, sf_dir), "vec_id", "label", TEST_SIZE, SEED)
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    scaler = scale.fit_scaler(train, "features")
    fit = mlp.fit_full_batch(train, n_classes=CLASSES, seed=SEED, scalers=scaler)[0]
    return fit, test


def _with_class(scored):
    return scored.withColumn("prediction", fn.argmax(F.col("p")))


@query("mlp_loss_curve")
def mlp_loss_curve(spark, sf_dir):
    return mlp.loss_table(spark, _vector_network(spark, sf_dir)[0])


@query("mlp_report")
def mlp_report(spark, sf_dir):
    fit, test = _vector_network(spark, sf_dir)
    return metrics.classification_report(_with_class(mlp.predict(test, fit)), labels=range(CLASSES))


@query("mlp_cross_validation")
def mlp_cross_validation(spark, sf_dir):
    """All folds of the whole table are trained by the same passes."""
    folds = split.stratified_folds(vectors(spark, sf_dir), "vec_id", "label", 5, SEED)
    scalers = scale.fit_fold_scalers(folds, "features")
    fits = mlp.fit_full_batch(folds, n_classes=CLASSES, seed=SEED, scalers=scalers, folds=range(5))
    return metrics.cross_validation_summary(_with_class(mlp.predict_held_out(folds, fits)))


# --- network on two classes, epochs with early stopping ----------------------


def _document_network(spark, sf_dir, table=None):
    parts = split.nested_split(table or documents(spark, sf_dir), "doc_id", "label", TEST_SIZE, VALID_SIZE, SEED)
    scaler = scale.fit_scaler(parts.where("split = 'train'"), "features")
    scaled = scale.apply_scaler(parts, scaler, "features")
    train, valid, test = (scaled.where(F.col("split") == s) for s in ("train", "valid", "test"))
    fit = mlp.fit_epochs(train, valid, "doc_id", seed=SEED)
    return fit, test


def _document_scores(spark, sf_dir, table=None):
    fit, test = _document_network(spark, sf_dir, table)
    score = fn.positive_probability(F.col("p"))
    scored = mlp.predict(test, fit).withColumn("score", score)
    return scored.select("doc_id", "label", fn.threshold(F.col("score")).alias("prediction"), "score")


@query("mlp_early_stop_history")
def mlp_early_stop_history(spark, sf_dir):
    return mlp.history_table(spark, _document_network(spark, sf_dir)[0])


@query("mlp_test_summary")
def mlp_test_summary(spark, sf_dir):
    return ranking.binary_summary(_document_scores(spark, sf_dir))


@query("knn_vs_mlp")
def knn_vs_mlp(spark, sf_dir):
    """Both models on the same test rows, one metric row per model."""
    table = documents(spark, sf_dir)
    parts = split.stratified_split(table, "doc_id", "label", TEST_SIZE, SEED)
    train, test = parts.where("split = 'train'").drop("split"), parts.where("split = 'test'")
    folds = split.stratified_folds(train, "doc_id", "label", knn.CV_FOLDS, SEED)
    grid = knn.grid_scores(knn.cross_validated_votes(folds, "doc_id", "label", "features"))
    near = knn.fit_and_search(train, test, max(knn.K_GRID), "doc_id", "label", "features")
    votes = knn.positive_share(knn.within_best_k(near, grid)).withColumnRenamed("query_id", "doc_id")
    scored = votes.join(test.select("doc_id", "label"), "doc_id").withColumn("model", F.lit("knn"))
    other = _document_scores(spark, sf_dir, table).withColumn("model", F.lit("mlp"))
    return ranking.binary_summary(scored.unionByName(other), by=["model"])


# --- what the network looks like ---------------------------------------------


@query("mlp_edges")
def mlp_edges(spark, sf_dir):
    """The strong connections of a fitted network with their drawing styles."""
    weights = mlp.weight_table(spark, _document_network(spark, sf_dir)[0].network)
    edges = model_tables.strong_edges(model_tables.edge_styles(weights))
    return edges.withColumns(
        {
            "src_name": model_tables.node_name(F.col("layer"), F.col("src"), DOC_FEATURES, OUTPUT_NAMES, OUTPUT_LAYER),
            "dst_name": model_tables.node_name(F.col("layer") + 1, F.col("dst"), DOC_FEATURES, OUTPUT_NAMES, OUTPUT_LAYER),
        }
    )


@query("mlp_nodes")
def mlp_nodes(spark, sf_dir):
    """Biases on a zero-centred scale, and the layer sizes beside them; input nodes have bias 0 and layer -1."""
    network = _document_network(spark, sf_dir)[0].network
    biases = mlp.bias_table(spark, network, inputs=True)
    ceiling = model_tables.robust_maximum(biases.where("layer >= 0"), "bias").scalar()
    sizes = model_tables.layer_sizes(mlp.weight_table(spark, network))
    shown = biases.withColumn("_c", ceiling).withColumn("colour", fn.centred_unit(F.col("bias"), F.col("_c"))).drop("_c")
    name = model_tables.node_name(F.col("layer") + 1, F.col("node"), DOC_FEATURES, OUTPUT_NAMES, OUTPUT_LAYER)
    return shown.join(F.broadcast(sizes), "layer", "left").withColumn("name", name)


@query("mlp_input_weights")
def mlp_input_weights(spark, sf_dir):
    fit, _ = _vector_network(spark, sf_dir)
    first = mlp.weight_table(spark, fit.network).where("layer = 0")
    return model_tables.weight_matrix(first, 32, [f"x{i + 1}" for i in range(WIDTH)]).withColumnRenamed("src", "feature")


# --- boosted trees -----------------------------------------------------------

BINS = 16

FIRST_GAINS = f"""{BINARY_VECTORS},
x AS (SELECT label, unnest(features) AS x, generate_subscripts(features, 1) - 1 AS feature FROM vectors),
r AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM x GROUP BY feature),
b AS (SELECT feature, label, least(floor((x - lo) / (hi - lo) * {BINS}), {BINS - 1})::INTEGER AS bin FROM x JOIN r USING (feature)),
c AS (SELECT feature, bin, sum(0.5::DOUBLE - label) AS g, sum(0.25::DOUBLE) AS h FROM b GROUP BY feature, bin),
s AS (
  SELECT feature::INTEGER AS feature, bin, sum(g) OVER (PARTITION BY feature ORDER BY bin) AS gl,
    sum(h) OVER (PARTITION BY feature ORDER BY bin) AS hl, sum(g) OVER (PARTITION BY feature) AS ga,
    sum(h) OVER (PARTITION BY feature) AS ha FROM c),
gains AS (
  SELECT feature, bin, gl, hl, ga, ha, CASE WHEN least(hl, ha - hl) >= 1 THEN
    0.5::DOUBLE * (gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)) END AS gain FROM s)"""


def _first_histogram(spark, sf_dir):
    """Derivatives of the logistic loss at score 0, summed over equal-width bins."""
    long = binary_vectors(spark, sf_dir).select("label", F.posexplode("features").alias("feature", "x"))
    ranges = long.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))  # one row per feature
    place = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS)
    binned = long.join(F.broadcast(ranges), "feature").select(
        "feature", "label", F.least(place, F.lit(BINS - 1)).cast("int").alias("bin")
    )
    sums = binned.groupBy("feature", "bin").agg(
        F.sum(F.lit(0.5) - F.col("label")).alias("g"), (F.count(F.lit(1)) * F.lit(0.25)).alias("h")
    )
    return sums.select(F.lit(0).alias("tree"), F.lit(0).alias("node"), "feature", "bin", "g", "h")


@query(
    "boosting_split_gains",
    f"WITH {FIRST_GAINS} SELECT feature, bin, round(gl, 6) AS g_left, round(hl, 6) AS h_left, round(gain, 6) AS gain FROM gains",
)
def boosting_split_gains(spark, sf_dir):
    gains = boosting.split_gains(_first_histogram(spark, sf_dir))
    return _rounded(gains.select("feature", "bin", "g_left", "h_left", "gain"), ["g_left", "h_left", "gain"])


@query(
    "boosting_best_split",
    f"""WITH {FIRST_GAINS} SELECT feature, bin, round(gain, 6) AS gain, round(ga, 6) AS g_all, round(ha, 6) AS h_all
FROM gains ORDER BY round(gains.gain, 9) DESC NULLS LAST, feature, bin LIMIT 1""",
)
def boosting_best_split(spark, sf_dir):
    best = boosting.best_splits(boosting.split_gains(_first_histogram(spark, sf_dir)))
    return _rounded(best.select("feature", "bin", "gain", "g_all", "h_all"), ["gain", "g_all", "h_all"])


FIRST_TREE = f"""{FIRST_GAINS},
root AS (SELECT * FROM gains ORDER BY round(gain, 9) DESC NULLS LAST, feature, bin LIMIT 1),
y AS (SELECT vec_id, label, unnest(features) AS x, generate_subscripts(features, 1) - 1 AS feature FROM vectors),
z AS (SELECT vec_id, feature, label, least(floor((x - lo) / (hi - lo) * {BINS}), {BINS - 1})::INTEGER AS bin FROM y JOIN r USING (feature)),
side AS (SELECT vec_id, CASE WHEN z.bin <= root.bin THEN 1 ELSE 2 END AS node FROM z JOIN root USING (feature)),
c2 AS (SELECT node, feature, bin, sum(0.5::DOUBLE - label) AS g, sum(0.25::DOUBLE) AS h FROM z JOIN side USING (vec_id) GROUP BY ALL),
s2 AS (
  SELECT node, feature::INTEGER AS feature, bin, sum(g) OVER (PARTITION BY node, feature ORDER BY bin) AS gl,
    sum(h) OVER (PARTITION BY node, feature ORDER BY bin) AS hl, sum(g) OVER (PARTITION BY node, feature) AS ga,
    sum(h) OVER (PARTITION BY node, feature) AS ha FROM c2),
g2 AS (
  SELECT *, CASE WHEN least(hl, ha - hl) >= 1 THEN
    0.5::DOUBLE * (gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)) END AS gain FROM s2),
b2 AS (SELECT * FROM g2 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC NULLS LAST, feature, bin) = 1),
n2 AS (SELECT *, coalesce(round(gain, 9) > 0, false) AS parts,
         3 + 2 * coalesce(sum(coalesce(round(gain, 9) > 0, false)::INT) OVER (ORDER BY node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS child FROM b2),
nodes AS (
  SELECT 0 AS node_id, true AS inner_node, feature, bin, gain, ga AS g, ha AS h FROM root
  UNION ALL SELECT node, parts, feature, bin, gain, ga, ha FROM n2
  UNION ALL SELECT child, false, NULL, NULL, NULL, gl, hl FROM n2 WHERE parts
  UNION ALL SELECT child + 1, false, NULL, NULL, NULL, ga - gl, ha - hl FROM n2 WHERE parts)"""


@query(
    "boosted_first_tree",
    f"""WITH {FIRST_TREE} SELECT node_id::INTEGER AS node_id, CASE WHEN inner_node THEN nodes.feature END::INTEGER AS feature,
  round(CASE WHEN inner_node THEN lo + (hi - lo) * (bin + 1) / {BINS} END, 6) AS threshold,
  round(CASE WHEN inner_node THEN gain END, 6) AS gain, round(h, 6) AS cover,
  round(CASE WHEN NOT inner_node THEN -0.05::DOUBLE * g / (h + 1) END, 6) AS prediction
FROM nodes LEFT JOIN r ON r.feature = nodes.feature""",
)
def boosted_first_tree(spark, sf_dir):
    """A finished tree of depth 2: splits, routing and leaf values, over equal-width bins and all rows and columns."""
    df = binary_vectors(spark, sf_dir)
    long = df.select(F.posexplode("features").alias("feature", "x"))
    ranges = long.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("feature").collect()
    edges = [np.array([r["lo"] + (r["hi"] - r["lo"]) * (b + 1) / BINS for b in range(BINS - 1)]) for r in ranges]
    model = boosting.fit_boosted(df, "vec_id", rounds=1, max_depth=2, subsample=1.0, colsample=1.0, max_bins=BINS, edges=edges)
    nodes = boosting.tree_table(spark, model, [0]).select("node_id", "feature", "threshold", "gain", "cover", "prediction")
    return _rounded(nodes, ["threshold", "gain", "cover", "prediction"])


STUMP_ROUNDS = 3


def _stumps_sql(source: str, outputs: int, eta: float) -> str:
    """Rounds of trees of depth 1: derivatives at the margins so far, gains, the best split of each output, new margins."""
    if outputs == 1:
        p, h, hit = "1 / (1 + exp(-margin))", "p * (1 - p)", "label"
    else:
        p, h, hit = "exp(margin) / sum(exp(margin)) OVER (PARTITION BY vec_id)", "2 * p * (1 - p)", "(label = t)::INT"
    sql = f"""WITH {source},
y AS (SELECT vec_id, unnest(features) AS x, generate_subscripts(features, 1) - 1 AS feature FROM vectors),
r AS MATERIALIZED (SELECT feature, min(x) AS lo, max(x) AS hi FROM y GROUP BY feature),
z AS MATERIALIZED (SELECT vec_id, y.feature, least(floor((x - lo) / (hi - lo) * {BINS}), {BINS - 1})::INTEGER AS bin FROM y JOIN r ON r.feature = y.feature),
m0 AS MATERIALIZED (SELECT vec_id, label, t, 0::DOUBLE AS margin FROM vectors, range({outputs}) AS o(t))"""
    for n in range(STUMP_ROUNDS):
        sql += f""",
p{n} AS (SELECT vec_id, label, t, {p} AS p FROM m{n}),
d{n} AS (SELECT vec_id, t, p - {hit} AS g, {h} AS h FROM p{n}),
c{n} AS (SELECT t, feature, bin, sum(g) AS g, sum(h) AS h FROM d{n} d JOIN z ON z.vec_id = d.vec_id GROUP BY t, feature, bin),
s{n} AS (
  SELECT t, feature, bin, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY t, feature) AS ga, sum(h) OVER (PARTITION BY t, feature) AS ha
  FROM c{n} WINDOW w AS (PARTITION BY t, feature ORDER BY bin)),
g{n} AS (
  SELECT *, CASE WHEN least(hl, ha - hl) >= 1 THEN
    0.5::DOUBLE * (gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)) END AS gain FROM s{n}),
b{n} AS MATERIALIZED (
  SELECT *, coalesce(round(gain, 9) > 0, false) AS parts FROM g{n}
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY round(gain, 9) DESC NULLS LAST, feature, bin) = 1),
m{n + 1} AS MATERIALIZED (
  SELECT m.vec_id, m.label, m.t, m.margin - {eta}::DOUBLE * CASE WHEN NOT b.parts THEN ga / (ha + 1)
    WHEN z.bin <= b.bin THEN gl / (hl + 1) ELSE (ga - gl) / (ha - hl + 1) END AS margin
  FROM m{n} m JOIN b{n} b ON b.t = m.t JOIN z ON z.vec_id = m.vec_id AND z.feature = b.feature),
n{n} AS (
  SELECT {n * outputs} + t AS tree_id, 0 AS node_id, parts, feature, bin, gain, ga AS g, ha AS h FROM b{n}
  UNION ALL SELECT {n * outputs} + t, 1, false, NULL, NULL, NULL, gl, hl FROM b{n} WHERE parts
  UNION ALL SELECT {n * outputs} + t, 2, false, NULL, NULL, NULL, ga - gl, ha - hl FROM b{n} WHERE parts)"""
    nodes = " UNION ALL ".join(f"SELECT * FROM n{n}" for n in range(STUMP_ROUNDS))
    return sql + f"""
SELECT tree_id::INTEGER AS tree_id, node_id::INTEGER AS node_id, CASE WHEN parts THEN n.feature END::INTEGER AS feature,
  round(CASE WHEN parts THEN lo + (hi - lo) * (bin + 1) / {BINS} END, 6) AS threshold, round(CASE WHEN parts THEN gain END, 6) AS gain,
  round(h, 6) AS cover, round(CASE WHEN NOT parts THEN -{eta}::DOUBLE * g / (h + 1) END, 6) AS prediction
FROM ({nodes}) n LEFT JOIN r ON r.feature = n.feature"""


def _stumps(spark, df, outputs):
    """Trees of depth 1 over equal-width bins and all rows and columns."""
    long = df.select(F.posexplode("features").alias("feature", "x"))
    ranges = long.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("feature").collect()
    edges = [np.array([r["lo"] + (r["hi"] - r["lo"]) * (b + 1) / BINS for b in range(BINS - 1)]) for r in ranges]
    model = boosting.fit_boosted(
        df, "vec_id", n_classes=max(2, outputs), rounds=STUMP_ROUNDS, max_depth=1, subsample=1.0, colsample=1.0, max_bins=BINS, edges=edges
    )
    nodes = boosting.tree_table(spark, model, range(STUMP_ROUNDS * outputs))
    return _rounded(nodes.drop("left", "right"), ["threshold", "gain", "cover", "prediction"])


@query("boosted_binary_rounds", _stumps_sql(BINARY_VECTORS, 1, 0.05))
def boosted_binary_rounds(spark, sf_dir):
    """Three rounds of two classes, each from the margins of the rounds before."""
    return _stumps(spark, binary_vectors(spark, sf_dir), 1)


@query("boosted_softmax_rounds", _stumps_sql(VECTORS, CLASSES, 0.1))
def boosted_softmax_rounds(spark, sf_dir):
    """Three rounds of ten classes."""
    return _stumps(spark, vectors(spark, sf_dir), CLASSES)


def formula_trees() -> boosting.Boosted:
    """Two fixed trees of two classes, spelled out in SQL beside their query."""
    first, second = boosting.Tree(), boosting.Tree()
    left, right = first.split(0, 0, 0.0, 0, 1.0)
    first.value[right] = 0.75
    low, high = first.split(left, 1, 0.1, 0, 1.0)
    first.value[low], first.value[high] = 0.5, -0.25
    left, right = second.split(0, 2, -0.05, 0, 1.0)
    second.value[left], second.value[right] = -0.5, 0.125
    return boosting.Boosted([first, second], 1, 0.1)


@query(
    "boosted_scores",
    f"""WITH {VECTORS}, m AS (SELECT vec_id,
  CASE WHEN features[1] <= 0 THEN CASE WHEN features[2] <= 0.1::DOUBLE THEN 0.5 ELSE -0.25 END ELSE 0.75 END::DOUBLE
  + CASE WHEN features[3] <= -0.05::DOUBLE THEN -0.5 ELSE 0.125 END::DOUBLE AS margin FROM vectors)
SELECT vec_id, round(1 / (1 + exp(-margin)), 9) AS score, (1 / (1 + exp(-margin)) >= 0.5)::INTEGER AS prediction FROM m""",
)
def boosted_scores(spark, sf_dir):
    scored = boosting.predict_boosted(vectors(spark, sf_dir), formula_trees())
    score = fn.positive_probability(F.col("p"))
    return scored.select("vec_id", F.round(score, 9).alias("score"), fn.threshold(score).alias("prediction"))


# --- fitted pipelines, written and read back ----------------------------------


@query(
    "stored_network_scores",
    f"""WITH {VECTORS}, x0 AS ({ENTRIES}),
s AS (SELECT i, avg(x) AS m, stddev_pop(x) AS sd FROM x0 GROUP BY i),
x AS (SELECT vec_id, label, (x - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END AS x, x0.i FROM x0 JOIN s ON s.i = x0.i), {LAYERS}
SELECT vec_id, concat('class ', max_by(k, p)) AS class, max_by(k, p)::INTEGER AS prediction, round(max(p), 9) AS score
FROM p GROUP BY vec_id""",
)
def stored_network_scores(spark, sf_dir):
    """Scaler, network and class names through their tables, then all rows scored."""
    df = vectors(spark, sf_dir)
    fit = stored.with_scaler(mlp.Fit(formula_network()), scale.fit_scaler(df, "features"))
    path = scratch_path(spark, "pipeline")
    stored.save_pipeline(spark, path, stored.Pipeline(fit, ["features"], [f"class {i}" for i in range(CLASSES)]))
    scored = stored.apply_pipeline(df, stored.load_pipeline(spark, path))
    return scored.select("vec_id", "class", "prediction", F.round(F.array_max("p"), 9).alias("score"))


@query(
    "stored_trees_scores",
    f"""WITH {VECTORS}, m AS (SELECT vec_id,
  CASE WHEN features[1] <= 0 THEN CASE WHEN features[2] <= 0.1::DOUBLE THEN 0.5 ELSE -0.25 END ELSE 0.75 END::DOUBLE
  + CASE WHEN features[3] <= -0.05::DOUBLE THEN -0.5 ELSE 0.125 END::DOUBLE AS margin FROM vectors)
SELECT vec_id, round(1 / (1 + exp(-margin)), 9) AS score, CASE WHEN 1 / (1 + exp(-margin)) >= 0.5 THEN 'high' ELSE 'low' END AS class FROM m""",
)
def stored_trees_scores(spark, sf_dir):
    """Trees and class names through their tables, then rows with a column per feature scored."""
    names = [f"x{i + 1}" for i in range(WIDTH)]
    path = scratch_path(spark, "pipeline")
    stored.save_pipeline(spark, path, stored.Pipeline(formula_trees(), names, ["low", "high"]))
    wide = explode_features(vectors(spark, sf_dir), "features", names)
    scored = stored.apply_pipeline(wide, stored.load_pipeline(spark, path))
    return scored.select("vec_id", F.round(fn.positive_probability(F.col("p")), 9).alias("score"), "class")


def _document_trees(spark, sf_dir):
    parts = split.stratified_split(documents(spark, sf_dir), "doc_id", "label", TEST_SIZE, SEED)
    # 15,000 trees are some million nodes: they go to a table as they are grown.
    model = boosting.fit_boosted(parts.where("split = 'train'"), "doc_id", store=scratch_path(spark, "trees"))
    return model, parts.where("split = 'test'")


@query("boosted_multiclass_report")
def boosted_multiclass_report(spark, sf_dir):
    parts = split.stratified_split(vectors(spark, sf_dir), "vec_id", "label", TEST_SIZE, SEED)
    model = boosting.fit_boosted(parts.where("split = 'train'"), "vec_id", n_classes=CLASSES)
    scored = _with_class(boosting.predict_boosted(parts.where("split = 'test'"), model))
    return metrics.classification_report(scored, labels=range(CLASSES), digits=4)


@query("boosted_binary_report")
def boosted_binary_report(spark, sf_dir):
    model, test = _document_trees(spark, sf_dir)
    test = test.repartition(spark.sparkContext.defaultParallelism)  # few rows, but each meets 15,000 trees
    score = fn.positive_probability(F.col("p"))
    scored = boosting.predict_boosted(test, model).withColumn("prediction", fn.threshold(score))
    names = {0: "low", 1: "high"}
    return metrics.classification_report(scored, labels=[0, 1], target_names=names, digits=4)


@query("boosted_tree_nodes")
def boosted_tree_nodes(spark, sf_dir):
    """Nodes of chosen trees."""
    model, _ = _document_trees(spark, sf_dir)
    return boosting.chosen_trees(boosting.tree_table(spark, model, BINARY_TREE_IDS), BINARY_TREE_IDS)
