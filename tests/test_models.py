import numpy as np
import pytest
from pyspark.sql import functions as F

from classkit.operators import boosting, knn, mlp, model_tables, scale, split, stored
from classkit.operators.early_stop import EarlyStopping, early_stop
from classkit.plans import QUERIES


def moons(spark, n=300, seed=0):
    """Two classes that a line cannot part: inside and outside a ring."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    rows = [(i, x[i].tolist(), int((x[i] ** 2).sum() < 1.2)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


class PlainAdam:
    """The published update, written out."""

    def __init__(self, rate):
        self.rate, self.t, self.m, self.v = rate, 0, 0.0, 0.0

    def change(self, g):
        self.t += 1
        self.m, self.v = 0.9 * self.m + 0.1 * g, 0.999 * self.v + 0.001 * g**2
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        return -rate * self.m / (np.sqrt(self.v) + 1e-8)


def weights_only(network):
    return np.concatenate([a for w, b in zip(network.weights, network.biases) for a in (w.ravel(), np.zeros(b.size))])


def arrays(df):
    rows = df.orderBy("id").collect()
    return np.array([r["features"] for r in rows]), np.array([r["label"] for r in rows])


@pytest.mark.parametrize("sizes", [[4, 5, 3], [4, 5, 6, 1]])
def test_gradient_matches_differences(sizes):
    rng = np.random.default_rng(0)
    network, x = mlp.Network.create(sizes), rng.normal(size=(9, 4))
    y = rng.integers(0, max(2, sizes[-1]), 9)
    _, gradient = network.gradient(x, y)
    flat, step = network.flat, 1e-6
    numeric = [
        (network.like(flat + step * e).gradient(x, y)[0] - network.like(flat - step * e).gradient(x, y)[0]) / (2 * step)
        for e in np.eye(len(flat))
    ]
    assert np.allclose(gradient, numeric, atol=1e-6)


def test_full_batch_equals_a_plain_loop(spark):
    df = moons(spark, 120).repartition(5)
    fit = mlp.fit_full_batch(df, hidden=(6,), max_iter=15, rate=0.01)[0]
    x, y = arrays(df)
    network, losses = mlp.Network.create([2, 6, 1]), []
    adam = PlainAdam(0.01)
    for _ in range(15):
        loss, gradient = network.gradient(x, y)
        losses.append(loss / 120 + 0.5 * 1e-3 * sum((w**2).sum() for w in network.weights) / 120)
        network = network.like(network.flat + adam.change((gradient + 1e-3 * weights_only(network)) / 120))
    assert np.allclose(fit.losses, losses) and np.allclose(fit.network.flat, network.flat)


def test_partial_sums_are_added_on_executors_beyond_the_fan_in(spark, monkeypatch):
    df = moons(spark, 120).repartition(7)
    whole = mlp.fit_full_batch(df, hidden=(4,), max_iter=3)[0]
    monkeypatch.setattr(mlp, "FAN_IN", 2)
    assert np.allclose(mlp.fit_full_batch(df, hidden=(4,), max_iter=3)[0].network.flat, whole.network.flat)


def test_fold_networks_equal_separate_fits(spark):
    folds = split.stratified_folds(moons(spark, 90), "id", "label", 3)
    scalers = scale.fit_fold_scalers(folds, "features")
    together = mlp.fit_full_batch(folds, hidden=(4,), max_iter=4, scalers=scalers, folds=range(3))
    for k in range(3):
        rest = folds.where(F.col("fold") != k)
        alone = mlp.fit_full_batch(rest, hidden=(4,), max_iter=4, scalers=scale.fit_scaler(rest, "features"))[0]
        assert np.allclose(together[k].network.flat, alone.network.flat)
    scored = mlp.predict_held_out(folds, together)
    assert scored.count() == 90 and scored.where(F.abs(F.col("p")[0] + F.col("p")[1] - 1) > 1e-12).count() == 0


@pytest.mark.parametrize("how", [{"batch_rows": 33}, {"steps": 4}, {"batch_rows": 33, "relay": 40}, {"steps": 4, "relay": 20}])
def test_epochs_equal_a_plain_loop(spark, monkeypatch, how):
    df = moons(spark, 130)
    monkeypatch.setattr(mlp, "RELAY_ROWS", how.get("relay", mlp.RELAY_ROWS))  # several partitions, or shares of a batch
    settings = {k: v for k, v in how.items() if k != "relay"}
    fit = mlp.fit_epochs(df.repartition(3), df, "id", hidden=(5,), max_epochs=3, **settings)
    rows = df.withColumn("batch", mlp.batch_key(F.col("id"), 42) % 4).orderBy("id").collect()
    x, y = np.array([r["features"] for r in rows]), np.array([r["label"] for r in rows])
    batch = np.array([r["batch"] for r in rows])
    network, losses, adam = mlp.Network.create([2, 5, 1]), [], PlainAdam(1e-3)
    for _ in range(3):
        for step in range(4):
            xs, ys = x[batch == step], y[batch == step]
            _, gradient = network.gradient(xs, ys)
            network = network.like(network.flat + adam.change((gradient + 1e-4 * weights_only(network)) / len(ys)))
        losses.append(mlp.cross_entropy(network.activations(x)[-1], y).mean())
    assert np.allclose([h["val_loss"] for h in fit.history], losses)


@pytest.mark.parametrize("how", [{"batch_rows": 10}, {"steps": 5}])
def test_epochs_do_not_depend_on_partitions(spark, how):
    df = moons(spark, 200)
    one, two = (
        mlp.fit_epochs(df.repartition(n), df.repartition(n), "id", hidden=(5,), max_epochs=3, **how) for n in (1, 6)
    )
    assert one.history == two.history and (one.network.flat == two.network.flat).all()


def test_a_pass_of_very_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(mlp, "FAN_IN", 2)
    df = moons(spark, 60)
    rows = mlp.training_rows(df.repartition(7))
    network = mlp.Network.create([2, 3, 1])
    total = mlp.sum_gradients(rows, {0: mlp.Fit(network)})[0]
    x, y = (np.array([r[c] for r in df.collect()]) for c in ("features", "label"))
    assert total[0] == 60 and np.allclose(total[2:], network.gradient(x, y)[1])


@pytest.mark.parametrize("bad", [None, [1.0, None], [1.0, float("nan")], [1.0]])
def test_bad_vectors_are_counted(spark, bad):
    rows = [(i, [float(i), 1.0], i % 2) for i in range(20)] + [(20, bad, 0)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")
    folds = df.withColumn("fold", (F.col("id") % 2).cast("int"))
    good = df.where("id < 20")
    attempts = [
        lambda: mlp.fit_full_batch(df, max_iter=1),
        lambda: mlp.fit_epochs(df, good, "id", max_epochs=1),
        lambda: mlp.fit_epochs(good, df, "id", max_epochs=1),
        lambda: boosting.fit_boosted(df, "id", rounds=1, max_depth=1),
        lambda: knn.nearest_neighbours(df, good, 2, "id", "features").count(),
        lambda: knn.nearest_neighbours(good, df, 2, "id", "features").count(),
        lambda: scale.fit_fold_scalers(folds, "features"),
    ]
    for attempt in attempts:
        with pytest.raises(Exception, match="(features: \\{|bad vectors among)"):
            attempt()


def test_epochs_learn_and_stop(spark):
    df = moons(spark)
    parts = split.stratified_split(df, "id", "label")
    train, valid = parts.where("split = 'train'"), parts.where("split = 'test'")
    fit = mlp.fit_epochs(
        train, valid, "id", hidden=(16, 8), rate=0.01, steps=6, max_epochs=25, stopping=EarlyStopping(patience=6)
    )
    assert max(h["val_acc"] for h in fit.history) > 0.85
    assert fit.best_epoch == min(fit.history, key=lambda h: h["val_loss"])["epoch"] or len(fit.history) < 25


def test_weight_tables(spark):
    network = mlp.Network.create([4, 3, 2])
    weights = mlp.weight_table(spark, network)
    assert weights.count() == 4 * 3 + 3 * 2 and mlp.bias_table(spark, network).count() == 5
    assert {tuple(r) for r in model_tables.layer_sizes(weights).collect()} == {(0, 4, 3), (1, 3, 2)}
    wide = model_tables.weight_matrix(weights.where("layer = 0"), 3).orderBy("src").collect()
    assert np.allclose([[r[f"h{j + 1}"] for j in range(3)] for r in wide], network.weights[0])


def test_zero_layer_and_outlier(spark):
    rows = [(0, 0, j, 0.0) for j in range(3)] + [(1, 0, 0, 100.0), (1, 0, 1, 4.9), (1, 0, 2, -5.0)]
    weights = spark.createDataFrame(rows, "layer int, src int, dst int, weight double")
    ceilings = {r["layer"]: r["ceiling"] for r in model_tables.robust_maximum(weights, by=["layer"]).collect()}
    assert ceilings[0] == 1.0 and ceilings[1] == pytest.approx(np.percentile([100.0, 4.9, 5.0], 99))
    kept = {(r["layer"], r["dst"]) for r in model_tables.strong_edges(weights, 0.05).collect()}
    assert kept == {(0, 0), (0, 1), (0, 2), (1, 0), (1, 2)}


def history(spark, losses):
    return spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(losses)], "run string, epoch int, val_loss double")


@pytest.mark.parametrize(
    ("losses", "best", "stop", "early"),
    [
        ([0.5, 0.499, 0.4], 3, 3, False),  # a gain of exactly min_delta is none
        ([0.5] + [0.5] * 20 + [0.1], 1, 21, True),  # stops after 20 epochs without gain
        ([1.0 - 0.01 * i for i in range(60)], 60, 60, False),
        ([1.0 - 0.002 * i for i in range(450)], 450, 450, False),
    ],
)
def test_early_stop_rule(spark, losses, best, stop, early):
    row = early_stop(history(spark, losses)).first()
    assert (row["best_epoch"], row["stop_epoch"], row["stopped_early"]) == (best, stop, early)
    rule = EarlyStopping()
    for step, loss in enumerate(losses, 1):
        rule.improved(step, loss)
        if rule.stopped:
            break
    assert (rule.best_step, step, rule.stopped) == (best, stop, early)


def plain_rule(losses, patience, min_delta):
    rule, best, read = EarlyStopping(patience, min_delta), None, 0
    for step, loss in enumerate(losses, 1):
        if rule.stopped:
            break
        read = step
        if rule.improved(step, float("nan") if loss is None else loss):
            best = step
    return best, rule.best if best else None, read, rule.stopped


def test_runs_cut_into_pieces(spark):
    """Every way of cutting a history gives the rule's own result."""
    rng = np.random.default_rng(11)
    runs = {}
    for i in range(60):
        falling = np.linspace(1, rng.uniform(-1, 1), 90) + rng.normal(size=90) * rng.choice([0, 1e-3, 0.05])
        losses = [float(x) for x in falling.round(int(rng.integers(2, 6)))]
        for j in rng.integers(0, 90, 6):
            losses[j] = [None, float("nan"), float("inf")][int(rng.integers(0, 3))]
        runs[i] = losses[: int(rng.integers(1, 91))]
    runs |= {100: [None], 101: [float("inf")] * 30, 102: [1.0 - 1e-4 * i for i in range(90)], None: [0.5, 0.1], 103: [0.25] * 12}
    rows = [(run, step, loss) for run, losses in runs.items() for step, loss in enumerate(losses, 1)]
    df = spark.createDataFrame(rows, "run int, epoch int, val_loss double")
    keep = "spark.sql.adaptive.coalescePartitions.enabled"
    before, shuffles = spark.conf.get(keep), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set(keep, "false")
        for parts, patience in ((1, 5), (40, 5), (40, 1), (40, 17)):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            got = {r["run"]: tuple(r)[1:] for r in early_stop(df, patience=patience).collect()}
            assert got == {run: plain_rule(losses, patience, 1e-3) for run, losses in runs.items()}
        got = {r["run"]: tuple(r)[1:] for r in early_stop(df, patience=9, max_epochs=25).collect()}
        assert got == {run: plain_rule(losses[:25], 9, 1e-3) for run, losses in runs.items()}
    finally:
        spark.conf.set(keep, before)
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    assert early_stop(df.where("false")).count() == 0


def test_weights_that_no_row_reaches_do_not_become_subnormal():
    """Their gradient is the decay alone; numbers below 1e-308 made a step ten times as long."""
    adam = mlp.Adam(np.array([0.5, -0.3]), 1e-3)
    for _ in range(20_000):
        adam.move(np.array([1e-4, 1e-4]) * adam.flat / 32)
    for values in (adam.flat, adam.first, adam.second):
        assert not ((values != 0) & (np.abs(values) < 1e-300)).any()


def test_an_epoch_of_many_narrow_rows_is_one_job(spark):
    """689,000 rows of 4 features, as 6 GB have: one relay job; the validation rows are measured by many tasks."""
    width, rows = 4, 689_000
    assert mlp._partitions(rows, rows // 32, min(mlp.RELAY_ROWS, mlp.RELAY_VALUES // (width + 2))) == (1, 1)
    assert mlp._partitions(172_000, 172, mlp.MEASURED_ROWS) == (9, 1)


def test_boosting_learns_a_ring(spark):
    df = moons(spark, 400)
    model = boosting.fit_boosted(df, "id", rounds=5, max_depth=4, eta=0.5, subsample=1.0, max_bins=32)
    scored = boosting.predict_boosted(df, model).withColumn("hit", (F.col("p")[1] >= 0.5).cast("int") == F.col("label"))
    assert scored.where("hit").count() > 370


def test_first_tree_equals_a_plain_search(spark):
    df = moons(spark, 200)
    model = boosting.fit_boosted(df, "id", rounds=1, max_depth=1, subsample=1.0, colsample=1.0, max_bins=256)
    x, y = arrays(df)
    g, h = 0.5 - y, np.full(len(y), 0.25)

    def score(mask):
        return g[mask].sum() ** 2 / (h[mask].sum() + 1)

    best = max(
        (0.5 * (score(x[:, f] <= t) + score(x[:, f] > t) - score(x[:, f] < np.inf)), f, t)
        for f in (0, 1)
        for t in np.unique(x[:, f])[:-1]
        if min(h[x[:, f] <= t].sum(), h[x[:, f] > t].sum()) >= 1
    )
    tree = model.trees[0]
    assert tree.feature[0] == best[1] and tree.gain[0] == pytest.approx(best[0])
    left = x[:, best[1]] <= tree.threshold[0]
    assert tree.value[tree.left[0]] == pytest.approx(-0.05 * g[left].sum() / (h[left].sum() + 1))


def test_margins_and_histograms_do_not_depend_on_how_they_are_kept(spark, monkeypatch):
    df = spark.createDataFrame(
        [(i, [float(i % 17), float((i * 7) % 23)], (i % 17 > 8) + (i % 5 > 3)) for i in range(200)],
        "id long, features array<double>, label int",
    )
    monkeypatch.setattr(boosting, "LOCAL_VALUES", 0)
    kept = boosting.fit_boosted(df, "id", n_classes=3, rounds=3, max_depth=3, max_bins=16)
    monkeypatch.setattr(boosting, "MARGIN_ROUNDS", 1)
    monkeypatch.setattr(boosting, "DENSE_CELLS", 0)
    other = boosting.fit_boosted(df.repartition(4), "id", n_classes=3, rounds=3, max_depth=3, max_bins=16)
    assert [list(t.feature) for t in kept.trees] == [list(t.feature) for t in other.trees]
    assert np.allclose(np.concatenate([t.value for t in kept.trees]), np.concatenate([t.value for t in other.trees]))


@pytest.mark.parametrize("n_classes,depth", [(2, 6), (3, 4)])
def test_trees_are_the_same_wherever_they_are_grown(spark, monkeypatch, n_classes, depth):
    """By levels alone, by levels and finished in tasks, or whole rounds in one task, in one go or several."""
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).round(2).tolist(), int(rng.integers(0, n_classes))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")

    def grown(local_rows, local_rounds=100, parts=1):
        monkeypatch.setattr(boosting, "LOCAL_VALUES", local_rows * (4 + (1 if n_classes == 2 else n_classes)))
        monkeypatch.setattr(boosting, "LOCAL_ROUNDS", local_rounds)
        return boosting.fit_boosted(df.repartition(parts), "id", n_classes=n_classes, rounds=2, max_depth=depth, max_bins=32, seed=3)

    one = grown(10_000)
    for other in (grown(10_000, 1, 3), grown(60, parts=3), grown(0)):
        for a, b in zip(one.trees, other.trees, strict=True):
            assert list(a.feature) == list(b.feature) and list(a.left) == list(b.left) and list(a.cut) == list(b.cut)
            assert np.allclose(a.threshold, b.threshold) and np.allclose(a.value, b.value)
            assert np.allclose(a.cover, b.cover) and np.allclose(a.gain, b.gain)
    assert max(len(t.feature) for t in one.trees) > 15


def test_a_round_of_several_classes_has_a_task_per_tree(spark, monkeypatch):
    """The same trees as from one task, with rows that repeat, ids that repeat, and margins kept anew."""
    rng = np.random.default_rng(11)
    rows = [(i % 250, rng.integers(0, 4, 3).astype(float).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int").repartition(3)
    settings = {"n_classes": 3, "rounds": 5, "max_depth": 4, "max_bins": 16}
    one = boosting.fit_boosted(df, "id", **settings)
    spread, called = boosting._spread_table, []
    monkeypatch.setattr(boosting, "SPREAD_VALUES", 0)
    monkeypatch.setattr(boosting, "SPREAD_ROUNDS", 2)
    monkeypatch.setattr(boosting, "_spread_table", lambda *a: called.append(1) or spread(*a))
    other = boosting.fit_boosted(df.repartition(5), "id", **settings)
    assert called and len(one.trees) == len(other.trees) == 15 and max(len(t.feature) for t in one.trees) > 7
    for a, b in zip(one.trees, other.trees, strict=True):
        assert list(a.feature) == list(b.feature) and list(a.cut) == list(b.cut) and np.allclose(a.value, b.value)


def test_equal_rows_are_one_unit_that_counts_as_often_as_drawn():
    rng = np.random.default_rng(12)
    bins, label = rng.integers(0, 3, (200, 2)).astype(np.uint8), rng.integers(0, 2, 200).astype(np.int32)
    key = rng.integers(-(2**63), 2**63, 200)
    (units,) = boosting._Units.of([{"rows": 200, "key": key.tobytes(), "bins": bins.tobytes(), "label": label.tobytes()}])
    assert len(units.label) <= 18 and units.ends[-1] == 200
    settings, used = boosting.replace(boosting.BINARY, subsample=0.5, max_depth=3), np.arange(2)
    g, h = boosting._derivatives(np.zeros((len(units.label), 1)), units.label)
    tree, leaf = units.grown(g[:, 0], h[:, 0], 4, used, settings)
    drawn = boosting._drawn(key, 4, settings.seed, 0.5)
    g, h = (d[drawn, 0] for d in boosting._derivatives(np.zeros((200, 1)), label))
    plain, places = boosting._subtree(bins[drawn].T, g, h, used, 3, settings)
    assert len(tree.feature) > 3 and all(np.allclose(getattr(tree, n), getattr(plain, n)) for n in ("feature", "cut", "left", "gain", "cover", "value"))
    columns = (tree.feature, tree.cut, tree.left, tree.right, tree.value)
    assert (boosting._leaf(columns, units.bins.T) == leaf).all() and (boosting._leaf(columns, bins[drawn]) == places).all()


def test_a_subtree_measures_the_smaller_child_and_gives_the_plain_tree(monkeypatch):
    """Against sums over all rows of a node; in a narrow tree, whose splits cut few rows off, few rows are measured."""
    rng = np.random.default_rng(13)
    n = 20_000
    bins = np.stack([np.minimum(rng.geometric(0.02, n) - 1, 255), np.minimum(rng.geometric(0.5, n) - 1, 30), rng.integers(0, 200, n)]).astype(np.uint8)
    times = rng.integers(0, 3, n).astype(float)
    y = (np.searchsorted([90, 110, 130, 150, 170], bins[0]) + np.searchsorted([3, 5], bins[1])) % 2 ^ (bins[2] > 190) ^ (rng.random(n) < 0.1)
    p = rng.uniform(0.2, 0.8, n)
    g, h, settings = times * (p - y), times * p * (1 - p), boosting.replace(boosting.BINARY, max_depth=9, min_child_weight=5.0)
    added, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda at, *rest: added.append(len(at)) or bincount(at, *rest))
    tree, leaf = boosting._subtree(bins, g, h, np.arange(3), 9, settings)
    monkeypatch.undo()

    def best(rows):
        found = []
        for f in range(3):
            left = [np.bincount(bins[f, rows], w[rows], 256).cumsum() for w in (g, h)]
            (a, b), (ga, ha) = left, (left[0][-1], left[1][-1])
            gain = 0.5 * (a * a / (b + 1) + (ga - a) ** 2 / (ha - b + 1) - ga * ga / (ha + 1))
            gain = np.where(np.minimum(b, ha - b) >= 5, gain.round(9), -np.inf)
            found.append((gain.max(), -f, -int(gain.argmax())))
        return max(found)

    held, levels = {0: np.arange(n)}, 0
    for node in range(len(tree.feature)):
        rows = held[node]
        gain, f, cut = best(rows)
        assert np.isclose(tree.cover[node], h[rows].sum()) and np.isclose(tree.value[node], -0.05 * g[rows].sum() / (h[rows].sum() + 1))
        if tree.feature[node] < 0:
            assert (leaf[rows] == node).all()
            continue
        assert (tree.feature[node], tree.cut[node]) == (-f, -cut) and np.isclose(tree.gain[node], gain)
        right = bins[tree.feature[node], rows] > tree.cut[node]
        held[tree.left[node]], held[tree.right[node]] = rows[~right], rows[right]
        levels += len(rows)
    assert len(tree.feature) > 60
    assert sum(added) < 0.8 * 3 * 2 * levels * (times > 0).mean()  # those of g and h over all rows of all split nodes


def test_units_equal_in_the_drawn_features_are_grown_as_one(monkeypatch):
    rng = np.random.default_rng(14)
    n = 5_000
    bins, label = rng.integers(0, 9, (n, 4)).astype(np.uint8), rng.integers(0, 2, n).astype(np.int32)
    key = rng.integers(-(2**63), 2**63, n)
    (units,) = boosting._Units.of([{"rows": n, "key": key.tobytes(), "bins": bins.tobytes(), "label": label.tobytes()}])
    settings, used = boosting.replace(boosting.BINARY, max_depth=5), np.array([0, 1, 3])
    g, h = (d[:, 0] for d in boosting._derivatives(rng.normal(size=(len(units.label), 1)), units.label))
    plain, places = units.grown(g, h, 4, used, settings)
    assert set(units.merge(3).merged) == {(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3)}
    subtree, seen = boosting._subtree, []
    monkeypatch.setattr(boosting, "_subtree", lambda lines, *rest: seen.append(lines.shape[1]) or subtree(lines, *rest))
    tree, leaf = units.grown(g, h, 4, used, settings)
    assert seen[0] <= 9**3 < len(units.label)
    assert (leaf == places).all() and all(np.allclose(getattr(tree, c), getattr(plain, c)) for c in ("feature", "cut", "left", "gain", "cover", "value"))


def test_scores_by_distinct_rows_are_those_of_every_row(spark, monkeypatch):
    """Bounds that rows lie on, rows that repeat, and trees of one leaf; to the last bit."""
    rng = np.random.default_rng(15)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    df = spark.createDataFrame([(i, r.tolist(), int((r[0] > 5) ^ (r[1] > 3) ^ (rng.random() < 0.1))) for i, r in enumerate(x)], "id long, features array<double>, label int")
    model = boosting.fit_boosted(df, "id", rounds=60, max_depth=4, max_bins=16)
    model.trees.insert(30, boosting.Tree())
    columns = [t.columns(by_bin=False) for t in model.trees]
    plain = boosting._probabilities(boosting._add_trees(np.zeros((400, 1)), columns, x))
    led, leaf = [], boosting._leaf
    monkeypatch.setattr(boosting, "MERGED_TREES", 2)
    monkeypatch.setattr(boosting, "_leaf", lambda columns, rows: led.append(len(rows)) or leaf(columns, rows))
    assert (boosting._probabilities(boosting._Coded.of(columns).add(np.zeros((400, 1)), x)) == plain).all()
    assert sum(led) < 0.7 * 400 * len(columns)
    monkeypatch.undo()
    monkeypatch.setattr(boosting, "SENT_NODES", 200)  # several parts
    monkeypatch.setattr(boosting, "SCORED_ROWS", 50)
    found = boosting.predict_boosted(df.repartition(2), model).orderBy("id").select("p").collect()
    assert [r["p"] for r in found] == plain.tolist()


def test_a_part_of_the_trees_that_cannot_be_written_is_an_error(spark, monkeypatch, tmp_path):
    """Parts are written beside the growing; what fails there is not lost."""
    monkeypatch.setattr(boosting, "STORED_NODES", 5)
    monkeypatch.setattr(boosting, "LOCAL_ROUNDS", 2)
    (tmp_path / "grown").mkdir()
    (tmp_path / "grown" / "part=1").mkdir()
    with pytest.raises(Exception, match="(?i)exists"):
        boosting.fit_boosted(moons(spark, 60), "id", rounds=6, max_depth=2, max_bins=8, store=f"{tmp_path}/grown")


def test_siblings_by_subtraction(spark, monkeypatch):
    """Below the root at most half of the rows are measured, and the cells are those of a direct count."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=3).round(1).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int").repartition(3)
    monkeypatch.setattr(boosting, "LOCAL_VALUES", 40 * (3 + 3))
    histogram, level = boosting._histogram, boosting._level_cells
    seen = []

    def counted(state, pending, growing, measured, columns, settings, round_):
        partial = histogram(state, pending, growing, measured, columns, settings, round_)
        seen.append((partial.groupBy("tree", "feature").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0], state, growing, columns, settings, round_, pending))
        return partial

    def compared(partial, above, siblings):
        cells = level(partial, above, siblings)
        if above is not None:
            _, state, growing, columns, settings, round_, pending = seen[-1]
            open_nodes = {}
            for s in siblings:
                for node, is_open in ((s["node"], s["node_open"]), (s["sibling"], s["sibling_open"])):
                    if is_open:
                        open_nodes.setdefault(s["tree"], []).append(node)
            keys = ["tree", "node", "feature", "bin"]
            direct = histogram(state, pending, growing, open_nodes, columns, settings, round_).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in "ghn"])
            a, b = (np.array(d.select(*keys, "n", "g", "h").orderBy(*keys).collect()) for d in (cells, direct))
            assert a.shape == b.shape and (a[:, :5] == b[:, :5]).all() and np.allclose(a, b)
        return cells

    monkeypatch.setattr(boosting, "_histogram", counted)
    monkeypatch.setattr(boosting, "_level_cells", compared)
    boosting.fit_boosted(df, "id", n_classes=3, rounds=1, max_depth=4, max_bins=32, subsample=1.0)
    assert len(seen) > 2 and seen[0][0] == 400 and all(s[0] <= 200 for s in seen[1:])


def test_no_rows_to_boost(spark):
    empty = spark.createDataFrame([], "id long, features array<double>, label int")
    model = boosting.fit_boosted(empty, "id", rounds=2, edges=[np.array([0.5])])
    assert [list(t.feature) for t in model.trees] == [[-1], [-1]]


@pytest.mark.parametrize("local_values", [0, 1 << 22])
def test_stored_trees_score_and_show_as_those_in_memory(spark, monkeypatch, tmp_path, local_values):
    df = moons(spark, 120).withColumn("label", F.col("label") + (F.col("id") % 2).cast("int"))
    monkeypatch.setattr(boosting, "LOCAL_VALUES", local_values)
    monkeypatch.setattr(boosting, "LOCAL_ROUNDS", 2)
    settings = {"n_classes": 3, "rounds": 4, "max_depth": 2, "max_bins": 8}
    held = boosting.fit_boosted(df, "id", **settings)
    monkeypatch.setattr(boosting, "STORED_NODES", 20)
    monkeypatch.setattr(boosting, "SENT_NODES", 45)
    model = boosting.fit_boosted(df, "id", store=f"{tmp_path}/grown", **settings)
    assert model.trees == [] and model.parts > 1 and model.written == 12
    p = lambda m: [r["p"] for r in boosting.predict_boosted(df, m).orderBy("id").collect()]
    table = lambda m: sorted(map(tuple, boosting.tree_table(spark, m, [0, 5, 11, 12]).collect()), key=str)
    assert p(model) == p(held) and table(model) == table(held)
    for name, one in (("a", held), ("b", model)):
        stored.save_pipeline(spark, f"{tmp_path}/{name}", stored.Pipeline(one, ["features"], ["4", "6", "8"]))
        back = stored.load_pipeline(spark, f"{tmp_path}/{name}")
        assert p(back.model) == p(held) and table(back.model) == table(held) and back.classes == ["4", "6", "8"]


def test_stored_network_scores_alike(spark, tmp_path):
    df = moons(spark, 90)
    fit = mlp.fit_full_batch(df, hidden=(5, 3), max_iter=4, scalers=scale.fit_scaler(df, "features"))[0]
    stored.save_pipeline(spark, f"{tmp_path}/net", stored.Pipeline(fit, ["features"], ["out", "in"]))
    back = stored.load_pipeline(spark, f"{tmp_path}/net")
    assert (back.model.network.flat == fit.network.flat).all()
    scored = stored.apply_pipeline(df, back).orderBy("id").collect()
    plain = mlp.predict(df, fit).orderBy("id").collect()
    assert [r["p"] for r in scored] == [r["p"] for r in plain]
    assert all(r["class"] == ["out", "in"][r["prediction"]] and r["prediction"] == (r["p"][1] >= 0.5) for r in scored)
    with pytest.raises(Exception, match="(?i)exists"):
        stored.save_pipeline(spark, f"{tmp_path}/net", stored.Pipeline(fit, ["features"], ["out", "in"]))


def test_missing_trees_are_reported(spark):
    model = boosting.fit_boosted(moons(spark, 60), "id", rounds=2, max_depth=2, max_bins=8)
    nodes = boosting.chosen_trees(boosting.tree_table(spark, model, [0, 499]), [0, 499])
    by_tree = {r["tree_id"]: r["status"] for r in nodes.collect()}
    assert by_tree == {0: "found", 499: "missing"}


class Called(Exception):
    """Carries what a registered query hands to a trainer."""


def handed(monkeypatch, spark, module, trainer, name):
    def record(*tables, **settings):
        raise Called(tables, settings)

    monkeypatch.setattr(module, trainer, record)
    with pytest.raises(Called) as caught:
        QUERIES[name](spark, "/root/testdata/sf0.001")
    return caught.value.args


@pytest.mark.parametrize("name", ["boosted_binary_report", "boosted_multiclass_report", "boosted_tree_nodes"])
def test_registered_trees_have_all_bins(spark, monkeypatch, name):
    _, settings = handed(monkeypatch, spark, boosting, "fit_boosted", name)
    assert settings.get("max_bins", boosting.BINARY.max_bins) == 256
    assert "rounds" not in settings  # the fixed 300 or 15,000


def test_nodes_have_names(spark):
    rows = [(0, 0), (0, 1), (0, 5), (1, 2), (2, 0)]
    df = spark.createDataFrame(rows, "layer int, node int")
    name = model_tables.node_name(F.col("layer"), F.col("node"), ["width", "height"], ["low"], 2)
    assert [r[0] for r in df.select(name).collect()] == ["width", "height", None, "h1_3", "low"]


@pytest.mark.parametrize("name", ["mlp_early_stop_history", "mlp_test_summary", "mlp_edges", "mlp_nodes"])
def test_registered_networks_take_batches_of_32_rows(spark, monkeypatch, name):
    (train, *_), settings = handed(monkeypatch, spark, mlp, "fit_epochs", name)
    assert settings.get("batch_rows", mlp.BATCH_ROWS) == 32 and "steps" not in settings
