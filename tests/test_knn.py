import numpy as np
import pytest

from classkit.operators import knn, scale, split


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


def brute(queries, points, k):
    out = {}
    for qid, q, _ in queries:
        ranked = sorted((round(float(np.sqrt(((np.array(q) - np.array(p)) ** 2).sum())), 9), pid) for pid, p, _ in points)
        out[qid] = [pid for _, pid in ranked[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["neighbour_id"])
    return out


def test_equal_distances_go_to_the_lower_id(spark):
    points = [(i, [float(x), 0.0], 0) for i, x in [(5, 1), (3, -1), (9, 1), (1, 2)]]
    near = knn.nearest_neighbours(table(spark, [(0, [0.0, 0.0], 0)]), table(spark, points), 3, "id", "features")
    assert found(near) == {0: [3, 5, 9]}


def test_vote_tie_goes_to_the_lower_class(spark):
    votes = spark.createDataFrame([(1, 2), (1, 0), (1, 2), (1, 0), (2, 1)], "query_id long, label int")
    out = {r["query_id"]: r["prediction"] for r in knn.majority_vote(votes).collect()}
    assert out == {1: 0, 2: 1}
    shares = {(r["query_id"], r["class"]): r["probability"] for r in knn.vote_shares(votes).collect()}
    assert shares == {(1, 0): 0.5, (1, 2): 0.5, (2, 1): 1.0}


@pytest.mark.parametrize(("cells", "block_values"), [(1, 1 << 18), (1, 60), (6, 60), (20, 1 << 18)])
def test_cells_and_blocks_stay_exact(spark, cells, block_values):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 3)) * 10
    points = [(i, (centres[i % 5] + rng.normal(size=3)).tolist(), i % 2) for i in range(240)]
    # a third of all points are copies of one
    points += [(1000 + i, points[0][1], 1) for i in range(120)]
    queries = [(i, (centres[i % 5] + rng.normal(size=3)).tolist(), 0) for i in range(60)]
    queries += [(500, points[0][1], 0), (501, [100.0, 100.0, 100.0], 0)]
    near = knn.nearest_neighbours(
        table(spark, queries), table(spark, points), 7, "id", "features", cells=cells, block_values=block_values
    )
    assert found(near) == brute(queries, points, 7)


def test_fewer_points_than_k(spark):
    points = [(1, [0.0], 0), (2, [1.0], 1)]
    near = knn.nearest_neighbours(table(spark, [(7, [0.2], 0)]), table(spark, points), 5, "id", "features", cells=2)
    assert found(near) == {7: [1, 2]}


def test_cross_validation_never_looks_into_the_held_out_fold(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), i % 2) for i in range(60)]
    folds = split.stratified_folds(table(spark, rows), "id", "label", 3)
    votes = knn.cross_validated_votes(folds, "id", "label", "features", grid=(1, 3))
    got = {(r["id"], r["k"]): r["prediction"] for r in votes.collect()}
    fold_of = {r["id"]: r["fold"] for r in folds.collect()}
    assert len(got) == 120
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    for i in range(60):
        others = np.array([j for j in range(60) if fold_of[j] != fold_of[i]])
        mean, std = x[others].mean(axis=0), x[others].std(axis=0)
        distance = np.sqrt(((((x[others] - mean) / std) - (x[i] - mean) / std) ** 2).sum(axis=1))
        order = others[np.lexsort((others, distance))]
        assert got[i, 1] == y[order[0]]
        assert got[i, 3] == int(y[order[:3]].sum() >= 2)


@pytest.mark.parametrize(("cells", "block_values"), [(None, 1 << 18), (None, 60), (6, 60), (15, 1 << 18)])
def test_folds_share_one_search(spark, cells, block_values):
    """Folds of very different spread, many copies, one feature that is constant outside a fold; rows move once."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(210):
        fold = i % 3
        x = rng.normal(size=3) * [1.0, 10.0 ** (fold - 1), 1.0 if fold == 2 else 0.0] + [10.0 * (i % 5), 0.0, 0.0]
        rows.append((i, x.tolist(), i % 2, fold))
    rows += [(1000 + i, rows[4][1], 1, i % 3) for i in range(90)]
    folds = spark.createDataFrame(rows, "id long, features array<double>, label int, fold int").repartition(4)
    near = knn.fold_neighbours(folds, scale.fit_fold_scalers(folds, "features"), 5, "id", "features", cells=cells, block_values=block_values)
    want = {}
    for f in range(3):
        others = [r for r in rows if r[3] != f]
        x = np.array([r[1] for r in others])
        mean, std = x.mean(axis=0), np.where(x.std(axis=0) == 0, 1, x.std(axis=0))
        scaled = [[(i, ((np.array(v) - mean) / std).tolist(), 0) for i, v, _, g in rows if (g == f) == own] for own in (True, False)]
        want |= brute(*scaled, 5)
    assert found(near) == want


def test_leaves_of_two_levels_stay_exact(spark, monkeypatch):
    """Queries in several parts, equal pivots, empty leaves, tasks, far offsets, queries of a task without points."""
    monkeypatch.setattr(knn, "QUERY_VALUES", 40)
    monkeypatch.setattr(knn, "LIMIT_CELLS", 3)
    rng = np.random.default_rng(8)
    for offset in (0.0, 1e6):
        points = [(i, (rng.normal(size=2) + 20 * (i % 7) + offset).tolist(), i % 3, i % 2) for i in range(300)]
        points += [(1000 + i, points[0][1], 1, i % 2) for i in range(100)]
        queries = [(i, (rng.normal(size=2) * 30 + 60 + offset).tolist(), 0, i % 2) for i in range(50)]
        queries += [(90, points[0][1], 0, 0), (91, points[0][1], 0, 2)]
        ddl = "id long, features array<double>, label int, part int"
        sides = [spark.createDataFrame(x, ddl).repartition(3) for x in (queries, points)]
        near = knn.nearest_neighbours(*sides, 6, "id", "features", task="part", cells=25, block_values=30).collect()
        for part in (0, 1):
            want = brute(*[[r[:3] for r in x if r[3] == part] for x in (queries, points)], 6)
            got = {}
            for r in sorted((r for r in near if r["part"] == part), key=lambda r: (r["query_id"], r["rank"])):
                got.setdefault(r["query_id"], []).append(r["neighbour_id"])
            assert got == want
        assert {r["part"] for r in near} == {0, 1}


def test_a_tree_of_pivots_rules_out_only_what_it_may():
    rng = np.random.default_rng(9)
    pivots = rng.normal(size=(40, 3)).round(1)
    pivots[7] = pivots[1]
    tree = knn._Pivots(pivots)
    points, queries = rng.normal(size=(500, 3)), rng.normal(size=(80, 3))
    cell, radius = tree.assign(points)
    assert np.allclose(radius, np.linalg.norm(points - pivots[cell], axis=1))
    to_pivot = np.linalg.norm(queries[:, None] - pivots[None], axis=2)
    least = tree.nearer_elsewhere(queries, to_pivot)[:, cell]
    assert (least <= np.linalg.norm(queries[:, None] - points[None], axis=2) + 1e-9).all()
    assert (least > 0.1).any()


def test_best_k_prefers_f1_then_accuracy_then_small_k(spark):
    rows = [(1, 0.8, 0.7), (3, 0.9, 0.75), (5, 0.9, 0.75), (7, 0.95, 0.7)]
    grid = spark.createDataFrame(rows, "k int, cv_accuracy_mean double, cv_f1_mean double")
    assert knn.best_k(grid).first()["k"] == 3


def test_constant_column_scales_to_zero(spark):
    df = table(spark, [(1, [1.0, 5.0], 0), (2, [3.0, 5.0], 1)])
    out = scale.apply_scaler(df, scale.fit_scaler(df, "features"), "features")
    assert [r["features"] for r in out.orderBy("id").collect()] == [[-1.0, 0.0], [1.0, 0.0]]


def test_scaler_divides_by_n(spark):
    df = table(spark, [(1, [1.0], 0), (2, [2.0], 0), (3, [4.0], 1)])
    assert scale.fit_scaler(df, "features").first()["std"][0] == pytest.approx(np.std([1, 2, 4]))
    one = scale.fit_scaler(df.where("id = 1"), "features").first()
    assert one["std"] == [0.0] and one["mean"] == [1.0]


def test_nan_features_are_refused(spark):
    df = table(spark, [(1, [1.0, float("nan")], 0), (2, [2.0, 1.0], 1)])
    with pytest.raises(ValueError, match="'nan_rows': 1"):
        scale.fit_scaler(df, "features")


def test_a_task_measures_few_queries_at_once(monkeypatch):
    """A batch of queries against a full block: what is held besides the rows stays small, the answer is the plain one."""
    rng = np.random.default_rng(5)
    queries, points = rng.normal(size=(2_000, 64)), rng.normal(size=(knn.BLOCK_VALUES // 64, 64))
    measured, held = knn._squared_distances, []
    monkeypatch.setattr(knn, "_squared_distances", lambda a, b: held.append(len(a) * len(b)) or measured(a, b))
    found = list(knn._nearest_in_block(queries, points, 3))
    assert max(held) * 8 <= 8 << 20
    rows, cols = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    for row in (0, 255, 256, 1_999):
        plain = np.sqrt(((queries[row] - points) ** 2).sum(axis=1))
        assert cols[rows == row].tolist() == np.argsort(plain)[:3].tolist()
