"""Exact k-nearest neighbours, majority vote, and choosing k by cross-validation.

Points are cut into blocks of bounded size. A shuffle brings the queries to each
block, whose task holds the block and lets the queries stream by in batches: a
matrix product finds the k nearest of the block, and only those leave the task.
No pair of rows is ever a row of a table, and a block of points travels once,
however many queries there are (twice, if there are over QUERY_VALUES numbers in
the queries of a block, and so on).

Large point sets are first cut into leaves around pivots of two levels. Each
query meets its home leaf first; the k-th distance found there, and the triangle
inequality, say which other leaves can hold a neighbour: the rest is skipped,
and the answer stays exact. Blocks split a leaf however large it is, and
identical points are reduced to the k lowest ids beforehand, so neither a crowded
leaf nor a group of copies ends up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from classkit.functions import bind
from classkit.operators.blocks import matrix
from classkit.operators.columns import bad_vector_aggregates, refuse_bad_vectors
from classkit.operators.scale import apply_scaler, fit_fold_scalers, fit_scaler
from classkit.runtime import local_table, small, written

# The grid of odd k, and the number of folds.
K_GRID = tuple(range(1, 31, 2))
CV_FOLDS = 5

BLOCK_VALUES = 1 << 18  # numbers per block of points: 2 MB of doubles
QUERY_VALUES = 1 << 26  # numbers of queries that stream past one copy of a block
CELL_POINTS = 25_000  # points per leaf aimed at
MAX_CELLS = 2_048  # pivots kept by every task
LIMIT_CELLS = 32  # nearest leaves whose points bound a query's k-th distance before it has met any
STEP_VALUES = 1 << 20  # distances that a task holds at once: 8 MB, and as much again for the product and the partition
DISTANCE_DIGITS = 9  # distances are ranked at this precision, ties by lower id


def _squared_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    norms = np.einsum("ij,ij->i", left, left)[:, None] + np.einsum("ij,ij->i", right, right)[None, :]
    norms -= (2.0 * left) @ right.T
    return np.maximum(norms, 0.0, out=norms)


def _nearest_in_block(queries: np.ndarray, points: np.ndarray, k: int):
    """(query row, point row, distance) of the k nearest points of every query.

    The matrix product is fast but loses digits, so it only shortlists; the
    shortlist, with room for its error, is measured again by differences.
    """
    k = min(k, len(points))
    step = max(1, STEP_VALUES // len(points))
    largest = np.einsum("ij,ij->i", points, points).max()
    for start in range(0, len(queries), step):
        part = queries[start : start + step]
        rough = _squared_distances(part, points)
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
        room = 1e-8 * np.sqrt(kth) + 1e-11 * (np.einsum("ij,ij->i", part, part) + largest) + 1e-16
        rows, cols = np.nonzero(rough <= (kth + room)[:, None])
        exact = np.round(np.sqrt(((part[rows] - points[cols]) ** 2).sum(axis=1)), DISTANCE_DIGITS)
        order = np.lexsort((cols, exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < k
        yield start + rows[keep], cols[keep], exact[keep]


def _block_join(k: int, schema: pa.Schema):
    def nearest(queries: pa.Table, points: pa.Table) -> pa.Table:
        if not len(queries) or not len(points):
            return schema.empty_table()
        points = points.sort_by("_pid")  # row order now breaks ties towards the lower id
        found = list(_nearest_in_block(matrix(queries["_vec"]), matrix(points["_vec"]), k))
        rows = pa.array(np.concatenate([f[0] for f in found]))
        cols = pa.array(np.concatenate([f[1] for f in found]))
        columns = [
            queries["_task"].take(rows),
            queries["_qid"].take(rows),
            points["_pid"].take(cols),
            points["_payload"].take(cols),
            pa.array(np.concatenate([f[2] for f in found])),
        ]
        return pa.table(columns, schema=schema)

    return nearest


def _lowest_copies(points: DataFrame, k: int) -> DataFrame:
    """Of identical points only the k lowest ids can be neighbours; the limit is
    applied before the shuffle, so a group of copies never gathers."""
    same = Window.partitionBy("_task", F.xxhash64("_vec"), "_vec").orderBy("_pid")
    return points.withColumn("_copy", F.row_number().over(same)).where(F.col("_copy") <= k).drop("_copy")


def _pivots(points: DataFrame, cells: dict[int, int]) -> dict[int, np.ndarray]:
    """Per task, as many pseudo-random points as it has cells (at most MAX_CELLS)."""
    spread = Window.partitionBy("_task").orderBy(F.md5(F.col("_pid").cast("string")), "_pid")
    picked = (
        points.withColumn("_n", F.row_number().over(spread)).where(F.col("_n") <= max(cells.values())).collect()
    )
    return {
        task: np.array([r["_vec"] for r in sorted(picked, key=lambda r: r["_n"]) if r["_task"] == task and r["_n"] <= n])
        for task, n in cells.items()
    }


def _per_task(batch: pa.RecordBatch):
    tasks = batch.column("_task").to_numpy(zero_copy_only=False)
    vectors = matrix(batch.column("_vec"))
    for task in np.unique(tasks):
        rows = np.nonzero(tasks == task)[0]
        yield int(task), rows, vectors[rows]


class _Pivots:
    """Pivots of two levels: the first few are tops, and every pivot belongs to its nearest top."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.tops = pivots[: int(np.ceil(np.sqrt(len(pivots))))]
        self.top_of = _squared_distances(pivots, self.tops).argmin(axis=1)
        self.used = np.unique(self.top_of)  # of equal tops one may have all the pivots

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every vector the nearest pivot below its nearest top, and the distance to it."""
        top = self.used[_squared_distances(vectors, self.tops[self.used]).argmin(axis=1)]
        cell, radius = np.zeros(len(vectors), np.int32), np.zeros(len(vectors))
        for t in np.unique(top):
            rows, members = np.flatnonzero(top == t), np.flatnonzero(self.top_of == t)
            distances = np.sqrt(_squared_distances(vectors[rows], self.pivots[members]))
            cell[rows], radius[rows] = members[distances.argmin(axis=1)], distances.min(axis=1)
        return cell, radius

    def nearer_elsewhere(self, vectors: np.ndarray, to_pivot: np.ndarray) -> np.ndarray:
        """Per vector and pivot: a vector assigned to the pivot is at least this far (half the detour past other pivots)."""
        to_top = np.sqrt(_squared_distances(vectors, self.tops))
        past_tops = (to_top - to_top[:, self.used].min(axis=1)[:, None])[:, self.top_of]
        least = np.full(to_top.shape, np.inf)
        for t in self.used:
            least[:, t] = to_pivot[:, self.top_of == t].min(axis=1)
        return np.maximum(past_tops, to_pivot - least[:, self.top_of]) / 2


def _with_cell(points: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add the leaf of every row (see `_Pivots`) and the distance to its pivot; rows of unknown tasks are left out."""

    def assign(batches):
        trees = {task: _Pivots(p) for task, p in pivots.items() if len(p)}
        for batch in batches:
            cell = np.full(batch.num_rows, -1, dtype=np.int32)
            radius = np.zeros(batch.num_rows)
            for task, rows, vectors in _per_task(batch):
                if task in trees:
                    cell[rows], radius[rows] = trees[task].assign(vectors)
            made = batch.append_column("_cell", pa.array(cell)).append_column("_radius", pa.array(radius))
            yield made.filter(pa.array(cell >= 0))

    added = [T.StructField("_cell", T.IntegerType()), T.StructField("_radius", T.DoubleType())]
    schema = T.StructType([*points.schema.fields, *added])
    return points.mapInArrow(assign, schema)


def _cell_bounds(points: DataFrame, k: int) -> dict[tuple[int, int], tuple[float, float, np.ndarray]]:
    """Per cell: smallest and largest radius, and its k smallest radii."""
    ranges = points.groupBy("_task", "_cell").agg(F.min("_radius").alias("low"), F.max("_radius").alias("high"))
    inner = Window.partitionBy("_task", "_cell").orderBy("_radius")
    first = (
        points.select("_task", "_cell", "_radius")
        .withColumn("_n", F.row_number().over(inner))
        .where(F.col("_n") <= k)
        .groupBy("_task", "_cell")
        .agg(F.array_sort(F.collect_list("_radius")).alias("first"))
    )
    rows = ranges.join(first, ["_task", "_cell"]).collect()  # one row per cell
    return {(r["_task"], r["_cell"]): (r["low"], r["high"], np.array(r["first"])) for r in rows}


def _with_candidate_cells(queries: DataFrame, pivots, bounds, k: int, stretch: dict[int, float] | None = None) -> DataFrame:
    """Add the cells that may hold one of the k nearest points of each query.

    Queries with a column ``_home`` have met that cell already, and know a distance ``_kth`` within which they have k
    points (null: not yet). ``stretch`` is for neighbours by another distance than that of the cells: per task, how many
    times farther a point may be by the cells' distance and still be nearer by the other.
    """
    met = "_home" in queries.columns

    def route(batches):
        trees = {task: _Pivots(p) for task, p in pivots.items() if len(p)}
        for batch in batches:
            rows_of, cells_of = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
            for task, rows, vectors in _per_task(batch):
                cells = sorted(c for t, c in bounds if t == task)
                if not cells:
                    continue
                low, high = (np.array([bounds[task, c][i] for c in cells]) for i in (0, 1))
                radii = np.full((len(cells), k), np.inf)
                for i, c in enumerate(cells):
                    radii[i, : len(bounds[task, c][2])] = bounds[task, c][2]
                some_cells = min(LIMIT_CELLS, len(cells))
                largest = np.sqrt(np.einsum("ij,ij->i", pivots[task], pivots[task]).max()) + high.max()
                step = max(1, STEP_VALUES // max(len(pivots[task]), some_cells * k))
                for start in range(0, len(rows), step):
                    some, part = rows[start : start + step], vectors[start : start + step]
                    to_pivot = np.sqrt(_squared_distances(part, pivots[task]))
                    to_cell = to_pivot[:, cells]
                    # k-th smallest of (distance to pivot + radius of a point): no neighbour is farther.
                    near = np.argpartition(to_cell, some_cells - 1, axis=1)[:, :some_cells]
                    reach = (np.take_along_axis(to_cell, near, axis=1)[:, :, None] + radii[near]).reshape(len(some), -1)
                    limit = np.partition(reach, k - 1, axis=1)[:, k - 1] * (stretch[task] if stretch else 1.0)
                    if met:
                        kth = batch.column("_kth").take(pa.array(some)).to_numpy(zero_copy_only=False).astype(float)
                        limit = np.fmin(limit, kth)
                    size = np.sqrt(np.einsum("ij,ij->i", part, part)) + largest
                    limit = (limit + 1e-6 * (1.0 + limit) + 1e-7 * size)[:, None]  # room for rounding
                    may = (to_cell - limit <= high) & (to_cell + limit >= low)
                    may &= trees[task].nearer_elsewhere(part, to_pivot)[:, cells] <= limit
                    if met:
                        home = batch.column("_home").take(pa.array(some)).to_numpy()
                        may &= np.array(cells)[None, :] != home[:, None]
                    query, cell = np.nonzero(may)
                    rows_of.append(some[query])
                    cells_of.append(np.array(cells, np.int32)[cell])
            owner, cell = np.concatenate(rows_of), np.concatenate(cells_of)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cell[np.argsort(owner, kind="stable")]))
            yield batch.append_column("_cells", lists)

    schema = T.StructType([*queries.schema.fields, T.StructField("_cells", T.ArrayType(T.IntegerType()))])
    return queries.mapInArrow(route, schema).withColumn("_cell", F.explode("_cells")).drop("_cells", "_home", "_kth")


_PLACE = ("_task", "_cell", "_p_block", "_q_part")


def _sizes(p: DataFrame, q: DataFrame) -> dict[tuple[int, int, str], int]:
    """Rows per task, cell and side ("p" or "q"): at most MAX_CELLS of them per task and side."""
    sides = [df.groupBy("_task", "_cell").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(x)) for df, x in ((p, "p"), (q, "q"))]
    return {(r["_task"], r["_cell"], r["side"]): r["n"] for r in sides[0].unionByName(sides[1]).collect()}


def _past_points(join, schema: pa.Schema):
    """Rows come ordered by place, points first: a block's points are held, its queries stream by."""

    def run(batches):
        place, held, points = None, [], None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in (*_PLACE, "_side")]
            changes = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            starts = [0, *(np.flatnonzero(changes) + 1).tolist()] if batch.num_rows else []
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                *here, side = (c[start] for c in columns)
                if here != place:
                    place, held, points = here, [], None
                rows = batch.slice(start, end - start)
                if side == 0:
                    held.append(rows)
                elif held:
                    points = points or pa.Table.from_batches(held).combine_chunks()
                    yield from join(pa.Table.from_batches([rows]), points).to_batches()
        yield from schema.empty_table().to_batches()

    return run


def _block_pairs(q: DataFrame, p: DataFrame, sizes: dict[tuple[int, int, str], int], width: int, block_values: int, join, schema) -> DataFrame:
    """All queries with every block of points of the same ``_task`` and ``_cell``, given to ``join`` batch by batch."""

    def parts(rows: int, values: int) -> int:
        return -(-rows // max(1, values // max(1, width)))

    rows = [
        {"_task": t, "_cell": c, "_p_blocks": parts(n, block_values), "_q_parts": parts(sizes[t, c, "q"], QUERY_VALUES)}
        for (t, c, side), n in sizes.items()
        if side == "p" and (t, c, "q") in sizes
    ]
    names = ("_task", "_cell", "_p_blocks", "_q_parts")
    layout = F.broadcast(local_table(q.sparkSession, rows, T.StructType([T.StructField(name, T.IntegerType()) for name in names])))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(id_name: str, n: str) -> Column:
        return F.pmod(F.xxhash64(id_name), F.col(n)).cast("int")

    of_p, of_q = ([c for c in df.columns if c not in _PLACE] for df in (p, q))
    p = p.join(layout, ["_task", "_cell"]).withColumn("_p_block", own("_pid", "_p_blocks"))
    p = p.withColumn("_q_part", every("_q_parts")).select(*_PLACE, F.lit(0).alias("_side"), *of_p)
    q = q.join(layout, ["_task", "_cell"]).withColumn("_q_part", own("_qid", "_q_parts"))
    q = q.withColumn("_p_block", every("_p_blocks")).select(*_PLACE, F.lit(1).alias("_side"), *of_q)
    both = p.unionByName(q, allowMissingColumns=True).repartition(*_PLACE).sortWithinPartitions(*_PLACE, "_side")
    return both.mapInArrow(_past_points(join, to_arrow_schema(schema)), schema)


def _nearest_k(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy("distance", "neighbour_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def nearest_neighbours(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    id_col: str,
    features: str,
    payload: str = "label",
    task: str | None = None,
    cells: int | None = None,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """``(task, query_id, rank, neighbour_id, payload, distance)``, Euclidean, exact.

    ``task`` names an integer column: queries only meet points of their own task,
    which is how all folds of a cross-validation share one job. ``payload`` is a
    column of ``points`` carried along. Ids are unique within a task. ``cells``
    overrides the number of pivots per task.
    """
    key = F.col(task).cast("int") if task else F.lit(0)
    vector = F.col(features).cast("array<double>").alias("_vec")
    q = queries.select(key.alias("_task"), F.col(id_col).alias("_qid"), vector)
    p = points.select(key.alias("_task"), F.col(id_col).alias("_pid"), F.col(payload).alias("_payload"), vector)
    p = _lowest_copies(p, k)

    counted = [F.count(F.lit(1)).alias("n"), *bad_vector_aggregates(F.col("_vec"))]
    sides = [df.groupBy("_task").agg(*counted).withColumn("side", F.lit(side)) for side, df in (("p", p), ("q", q))]
    sizes = sides[0].unionByName(sides[1]).withColumn("width", F.col("max_width")).collect()  # one row per task and side
    for row in sizes:
        refuse_bad_vectors(row, features)
    if len({r["width"] for r in sizes}) > 1:
        raise ValueError(f"{features}: vectors of widths {sorted({r['width'] for r in sizes})}")
    width = max([r["width"] for r in sizes], default=1)
    wanted = {r["_task"]: cells or min(MAX_CELLS, -(-r["n"] // CELL_POINTS)) for r in sizes if r["side"] == "p"}
    schema = T.StructType(
        [
            T.StructField("_task", T.IntegerType()),
            T.StructField("query_id", queries.schema[id_col].dataType),
            T.StructField("neighbour_id", points.schema[id_col].dataType),
            T.StructField(payload, points.schema[payload].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def search(q: DataFrame, sizes: dict) -> DataFrame:
        return _block_pairs(q, p, sizes, width, block_values, _block_join(k, to_arrow_schema(schema)), schema)

    ids = ["_task", "query_id"]
    if max(wanted.values(), default=1) > 1:
        p = written(p, "points")
        pivots = _pivots(p, wanted)
        p = written(_with_cell(p, pivots), "cells")
        bounds = _cell_bounds(p, k)
        p = p.drop("_radius")
        q = written(_with_cell(q, pivots).drop("_radius"), "queries")
        near = written(_nearest_k(search(q, _sizes(p, q)), ids, k).drop("rank"), "home")
        kth = near.groupBy(*ids).agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("_kth"))
        q = q.withColumnRenamed("_cell", "_home").join(kth.withColumnRenamed("query_id", "_qid"), ["_task", "_qid"], "left")
        q = written(_with_candidate_cells(q, pivots, bounds, k), "queries")
        found = search(q, _sizes(p, q)).unionByName(near)
    else:
        p, q = p.withColumn("_cell", F.lit(0)), q.withColumn("_cell", F.lit(0))
        found = search(q, {(r["_task"], 0, r["side"]): r["n"] for r in sizes})
    top = _nearest_k(found, ids, k)
    top = top.withColumnRenamed("_task", task) if task else top.drop("_task")
    return top.select(*([task] if task else []), "query_id", "rank", "neighbour_id", payload, "distance")


def _fold_join(k: int, schema: pa.Schema, scales: dict[int, tuple[np.ndarray, np.ndarray]]):
    """As `_block_join`, for queries of several folds: each is scaled, with all points of other folds, by its fold's rule."""

    def nearest(queries: pa.Table, points: pa.Table) -> pa.Table:
        if not len(queries) or not len(points):
            return schema.empty_table()
        points = points.sort_by("_pid")
        q_fold, p_fold = (t["_fold"].to_numpy() for t in (queries, points))
        q_all, p_all = matrix(queries["_vec"]), matrix(points["_vec"])
        made = []
        for fold in np.unique(q_fold).tolist():
            mine, others = np.flatnonzero(q_fold == fold), np.flatnonzero(p_fold != fold)
            if fold not in scales or not len(others):
                continue
            mean, divisor = scales[fold]
            for rows, cols, distances in _nearest_in_block((q_all[mine] - mean) / divisor, (p_all[others] - mean) / divisor, k):
                made.append((mine[rows], others[cols], distances))
        if not made:
            return schema.empty_table()
        rows, cols, distances = (np.concatenate(c) for c in zip(*made))
        rows, cols = pa.array(rows), pa.array(cols)
        columns = [queries["_fold"].take(rows), queries["_qid"].take(rows), points["_pid"].take(cols), points["_payload"].take(cols)]
        return pa.table([*columns, pa.array(distances)], schema=schema)

    return nearest


def fold_neighbours(
    train: DataFrame,
    scalers: DataFrame,
    k: int,
    id_col: str,
    features: str,
    payload: str = "label",
    fold: str = "fold",
    cells: int | None = None,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """``(fold, query_id, rank, neighbour_id, payload, distance)``: for every row the k nearest rows of other folds.

    Distances are those after scaling with the row's own fold of ``scalers`` (`fit_fold_scalers`). Rows travel unscaled and
    once for all folds: the tasks scale them by each fold's rule and leave the own fold out. Cells are cut by one scale
    between those of the folds; a fold's distance is at most r and at least r' times that one's, r and r' its largest and
    smallest ratio of divisors, so bounds widened by r / r' hold for it. Rows without a fold take no part.
    """
    scales = {r[fold]: (np.array(r["mean"]), np.array([s or 1.0 for s in r["std"]])) for r in scalers.collect()}
    rows, vector = train.where(F.col(fold).isNotNull()), F.col(features).cast("array<double>")
    key = F.col(fold).cast("int").alias("_task")
    q = rows.select(key, F.col(id_col).alias("_qid"), vector.alias("_vec"))
    p = rows.select(key, F.col(id_col).alias("_pid"), F.col(payload).alias("_payload"), vector.alias("_vec"))
    p = _lowest_copies(p, k)
    width = max((len(mean) for mean, _ in scales.values()), default=1)
    n = rows.count()
    wanted = cells or min(MAX_CELLS, -(-n // CELL_POINTS))
    if wanted > 1 and scales:
        base = np.mean([divisor for _, divisor in scales.values()], axis=0)
        ratios = {f: base / divisor for f, (_, divisor) in scales.items()}
        by_base = F.zip_with("_vec", F.array(*[F.lit(float(x)) for x in base]), lambda x, s: x / s)
        p, q = (df.withColumn("_raw", F.col("_vec")).withColumn("_vec", by_base) for df in (p, q))
        p = written(p, "points")
        picked = p.orderBy(F.md5(F.col("_pid").cast("string")), "_pid").limit(wanted).collect()
        folds = sorted({r[0] for r in p.select("_task").distinct().collect()} | set(scales))
        pivots = dict.fromkeys(folds, np.array([r["_vec"] for r in picked]))
        p = written(_with_cell(p, pivots), "cells")
        found = {}
        for (f, cell), bound in _cell_bounds(p, k).items():  # one of each fold and cell
            found.setdefault(cell, {})[f] = bound
        bounds = {}
        for held in scales:
            for cell, of_folds in found.items():
                others = [b for f, b in of_folds.items() if f != held]
                if not others:
                    continue
                first = np.sort(np.concatenate([b[2] for b in others]))[:k]
                bounds[held, cell] = (min(b[0] for b in others), max(b[1] for b in others), first)
        stretch = {f: float(r.max() / r.min()) for f, r in ratios.items()}
        q = written(_with_candidate_cells(q.where(F.col("_task").isin(list(scales))), pivots, bounds, k, stretch), "queries")
        p, q = (df.drop("_vec", "_radius").withColumnRenamed("_raw", "_vec") for df in (p, q))
        sizes = {}
        for (_, cell, side), rows_in in _sizes(p, q).items():
            sizes[0, cell, side] = sizes.get((0, cell, side), 0) + rows_in
    else:
        p, q = (df.withColumn("_cell", F.lit(0)) for df in (p, q))
        sizes = {(0, 0, side): n for side in "pq" if n}
    p, q = (df.withColumnRenamed("_task", "_fold").withColumn("_task", F.lit(0)) for df in (p, q))
    schema = T.StructType(
        [
            T.StructField(fold, T.IntegerType()),
            T.StructField("query_id", train.schema[id_col].dataType),
            T.StructField("neighbour_id", train.schema[id_col].dataType),
            T.StructField(payload, train.schema[payload].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    met = _block_pairs(q, p, sizes, width, block_values, _fold_join(k, to_arrow_schema(schema), scales), schema)
    return _nearest_k(met, [fold, "query_id"], k).select(fold, "query_id", "rank", "neighbour_id", payload, "distance")


def _tally(labels: Column) -> Column:
    """``(votes, -class)`` of the winning class: most votes, then the lowest class."""
    return F.array_max(
        F.transform(
            F.array_distinct(labels),
            lambda c: F.struct(F.size(F.filter(labels, lambda x: x == c)).alias("votes"), (-c).alias("negated")),
        )
    )


def majority_vote(neighbours: DataFrame, by: Sequence[str] = ("query_id",), label: str = "label") -> DataFrame:
    """``(by.., prediction, votes, k)``; a tie goes to the lowest class."""
    gathered = neighbours.groupBy(*by).agg(F.collect_list(label).alias("labels"))  # k entries
    won = gathered.withColumn("won", _tally(F.col("labels")))
    return won.select(
        *by, (-F.col("won.negated")).alias("prediction"), F.col("won.votes").alias("votes"), F.size("labels").alias("k")
    )


def vote_shares(neighbours: DataFrame, by: Sequence[str] = ("query_id",), label: str = "label") -> DataFrame:
    """``(by.., class, votes, probability)`` for the classes that got votes."""
    votes = neighbours.groupBy(*by, F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("votes"))
    total = F.sum("votes").over(Window.partitionBy(*by))
    return votes.withColumn("probability", F.col("votes") / total)


def positive_share(neighbours: DataFrame, by: Sequence[str] = ("query_id",), label: str = "label", positive=1):
    """``(by.., prediction, score)`` for two classes: the share of positive votes."""
    share = F.avg((F.col(label) == positive).cast("double"))
    scored = neighbours.groupBy(*by).agg(share.alias("score"))
    # Half the votes is a tie, and a tie goes to class 0.
    return scored.select(*by, (F.col("score") > 0.5).cast("int").alias("prediction"), "score")


def grid_votes(
    neighbours: DataFrame,
    by: Sequence[str],
    grid: Sequence[int] = K_GRID,
    label: str = "label",
    truth: DataFrame | None = None,
) -> DataFrame:
    """``(by.., k, prediction)`` for every k at once, from one ranked list per query.

    Columns of ``truth``, keyed by ``by``, are joined to that list and carried along.
    """
    ranked = neighbours.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("rank", F.col(label).alias("c")))).alias("r"))
    ranked = ranked if truth is None else ranked.join(truth, list(by))
    carried = [c for c in ranked.columns if c != "r"]
    each = ranked.select(*carried, F.col("r.c").alias("labels"), F.explode(F.array(*[F.lit(k) for k in grid])).alias("k"))
    won = bind(F.slice("labels", 1, F.col("k")), _tally)
    return each.select(*carried, "k", (-won["negated"]).alias("prediction"))


def cross_validated_votes(
    train: DataFrame,
    id_col: str,
    label_col: str,
    features: str,
    grid: Sequence[int] = K_GRID,
    fold: str = "fold",
    **search,
) -> DataFrame:
    """``(fold, id, label, k, prediction)``: every train row scored by the other folds.

    ``train`` carries a fold column. Each fold is scaled with the statistics of
    the others, and one search with the largest k serves all folds and the whole grid.
    """
    scalers = fit_fold_scalers(train, features, fold)
    found = fold_neighbours(train, scalers, max(grid), id_col, features, label_col, fold, **search)
    truth = train.select(fold, F.col(id_col).alias("query_id"), F.col(label_col).alias("label"))
    return grid_votes(found, [fold, "query_id"], grid, label_col, truth).withColumnRenamed("query_id", id_col)


def grid_scores(votes: DataFrame, positive=1, fold: str = "fold") -> DataFrame:
    """``(k, cv_accuracy_mean, cv_f1_mean)``: fold metrics averaged per k."""
    real, predicted = F.col("label") == positive, F.col("prediction") == positive
    per_fold = votes.groupBy("k", fold).agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        F.count_if(real & predicted).alias("tp"),
        (F.count_if(real) + F.count_if(predicted)).alias("sides"),
    )
    f1 = F.when(F.col("sides") == 0, 0.0).otherwise(2 * F.col("tp") / F.greatest("sides", F.lit(1)))
    return per_fold.groupBy("k").agg(F.avg("accuracy").alias("cv_accuracy_mean"), F.avg(f1).alias("cv_f1_mean"))


def best_k(grid: DataFrame) -> DataFrame:
    """The first row by F1, then accuracy, then the smaller k.

    Means are compared at 9 places: the order in which folds are added up must
    not decide between equal scores.
    """
    keys = [F.round("cv_f1_mean", 9).desc(), F.round("cv_accuracy_mean", 9).desc(), F.col("k")]
    return grid.orderBy(*keys).limit(1)


def fit_and_search(
    train: DataFrame, test: DataFrame, k: int, id_col: str, label_col: str, features: str, **search
) -> DataFrame:
    """Scale both parts with train statistics and find the k nearest train rows."""
    scaler = fit_scaler(train, features)
    scaled = [apply_scaler(part, scaler, features) for part in (test, train)]
    return nearest_neighbours(*scaled, k, id_col, features, label_col, **search)


def within_best_k(neighbours: DataFrame, grid: DataFrame) -> DataFrame:
    """Keep the neighbours that the chosen k would ask for."""
    chosen = small(best_k(grid).select("k"), 1, "best k")
    return neighbours.where(F.col("rank") <= chosen.scalar())


__all__ = [
    "best_k",
    "cross_validated_votes",
    "fit_and_search",
    "fold_neighbours",
    "grid_scores",
    "grid_votes",
    "majority_vote",
    "nearest_neighbours",
    "positive_share",
    "vote_shares",
    "within_best_k",
]
