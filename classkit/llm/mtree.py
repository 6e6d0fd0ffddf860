"""Exact top-k by inner product over a forest of M-trees."""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from classkit.llm.common import named, rebatched, written

# Rows of one tree, entries of one page, queries that travel together, and cells that rows are dealt to.
TREE_ROWS, PAGE, QUERY_ROWS, CELLS = 4_096, 64, 256, 256


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a double, or null if the vector is null or a component null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Page(NamedTuple):
    """A node: entries with their distances to the node's routing point; children and covering radii, or none in a leaf."""

    points: np.ndarray
    parent: np.ndarray
    radii: np.ndarray | None = None
    children: list | None = None


class MTree:
    """Metric tree over integer vectors, in the space where larger inner products are smaller distances.

    Every vector x gets a further coordinate sqrt(norm2 - |x|^2), so that all have the length sqrt(norm2), and a query a
    zero; then d(q, x)^2 = |q|^2 + norm2 - 2 q.x. Pages hold at most `PAGE` entries.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm2: int):
        self.ids, self.vectors, self.norm2 = ids, vectors, norm2
        lift = np.sqrt(np.maximum(0, norm2 - np.einsum("ij,ij->i", vectors, vectors)).astype(float))
        lifted = np.column_stack([vectors.astype(float), lift])
        rng = np.random.default_rng(len(ids))
        self.root, self.radius = self._build(lifted, np.arange(len(ids)), 0, rng)

    def packed(self) -> bytes:
        def plain(page: Page) -> tuple:
            return (page.points, page.parent, page.radii, page.children and [plain(p) for p in page.children])

        return pickle.dumps((self.ids, self.vectors, self.norm2, plain(self.root), self.radius))

    @classmethod
    def unpacked(cls, data: bytes) -> MTree:
        def page(parts: tuple) -> Page:
            return Page(*parts[:3], parts[3] and [page(p) for p in parts[3]])

        tree = cls.__new__(cls)
        tree.ids, tree.vectors, tree.norm2, root, tree.radius = pickle.loads(data)
        tree.root = page(root)
        return tree

    @staticmethod
    def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * (a @ b.T)
        return np.sqrt(np.maximum(0, square))

    def _build(self, lifted: np.ndarray, rows: np.ndarray, routing: int, rng: np.random.Generator) -> tuple[Page, float]:
        """The page of ``rows`` below routing point ``routing``, and its covering radius."""
        if len(rows) <= PAGE:
            far = self._distances(lifted[rows], lifted[routing : routing + 1])[:, 0]
            return Page(rows, far), float(far.max(initial=0.0))
        seeds = rng.choice(rows, min(PAGE, max(2, -(-2 * len(rows) // PAGE))), replace=False)
        nearest = self._distances(lifted[rows], lifted[seeds]).argmin(1)
        groups = [(int(s), rows[nearest == i]) for i, s in enumerate(seeds)]
        groups = [(s, g) for s, g in groups if len(g)]
        if len(groups) == 1:  # equal points: any parts do
            groups = [(int(g[0]), g) for g in np.array_split(rows, len(seeds)) if len(g)]
        made = [self._build(lifted, g, s, rng) for s, g in groups]
        points = np.array([s for s, _ in groups])
        parent = self._distances(lifted[points], lifted[routing : routing + 1])[:, 0]
        radii = np.array([r for _, r in made])
        return Page(points, parent, radii, [page for page, _ in made]), float((parent + radii).max())

    def search(self, query: np.ndarray, own: int, k: int, bound: int | None) -> list[tuple[int, int]]:
        """The k best (score, id) but for id ``own``, larger scores and smaller ids first.

        Scores below ``bound`` are of no interest. Pages are opened nearest first. An entry whose stored distance to its
        parent already shows, by the triangle inequality, that it cannot matter is passed over without computing its own
        distance; then the computed distance less the covering radius decides.
        """
        q2 = int(query @ query) + self.norm2
        slack = 1e-6 * math.sqrt(max(1, q2))
        best: list[tuple[int, int]] = []  # a heap: (score, -id), worst first
        limit = math.inf if bound is None else math.sqrt(max(0, q2 - 2 * bound)) + slack

        def to(points: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0, q2 - 2 * (self.vectors[points] @ query)).astype(float))

        first = float(to(np.array([0]))[0])
        queue = [(max(0.0, first - self.radius), 0, first, self.root)]
        tie = 1
        while queue and queue[0][0] <= limit:
            _, _, distance, page = heapq.heappop(queue)
            if page.children is None:
                points = page.points[np.abs(distance - page.parent) <= limit]
                scores = self.vectors[points] @ query
                if len(best) == k:
                    good = scores >= best[0][0]
                    points, scores = points[good], scores[good]
                for score, id_ in zip(scores.tolist(), self.ids[points].tolist()):
                    if id_ == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -id_))
                    elif (score, -id_) > best[0]:
                        heapq.heapreplace(best, (score, -id_))
                if len(best) == k:
                    limit = min(limit, math.sqrt(max(0, q2 - 2 * best[0][0])) + slack)
                continue
            near = np.flatnonzero(np.abs(distance - page.parent) - page.radii <= limit)
            computed = to(page.points[near])
            low = np.maximum(0, computed - page.radii[near])
            for i, d, least in zip(near.tolist(), computed.tolist(), low.tolist()):
                if least <= limit:
                    heapq.heappush(queue, (least, tie, d, page.children[i]))
                    tie += 1
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def _matrix(array: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows, shorter ones padded with zeros."""
    offsets, flat = array.offsets.to_numpy(), array.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = np.zeros((len(array), width), np.int64)
    if (sizes == width).all():
        out[:] = flat[offsets[0] : offsets[-1]].reshape(-1, width)
    else:
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            out[i, : b - a] = flat[a:b]
    return out


def _lift(vectors: np.ndarray, norm2: int, query: bool = False) -> np.ndarray:
    rest = 0 * vectors[:, 0] if query else np.maximum(0, norm2 - np.einsum("ij,ij->i", vectors, vectors))
    return np.column_stack([vectors.astype(float), np.sqrt(rest.astype(float))])


def _assign(pivots: np.ndarray, width: int, norm2: int):
    """mapInArrow over (id, vector, tag): (id, vector, tag, cell, distance to the cell's pivot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lifted = _lift(pivots, norm2)
        for batch in batches:
            far = MTree._distances(_lift(_matrix(batch.column(1), width), norm2), lifted)
            cell = far.argmin(1)
            arrays = [*batch.columns, pa.array(cell, pa.int32()), pa.array(far[np.arange(len(cell)), cell])]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "vector", "tag", "cell", "far"])

    return run


def _plant(width: int, norm2: int):
    """mapInArrow over (tree, id, vector) sorted by tree: (tree, packed M-tree)."""

    def packed(tree: int, ids: list, parts: list) -> tuple:
        return tree, MTree(np.concatenate(ids), np.concatenate(parts), norm2).packed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tree, ids, parts = None, [], []
        for batch in batches:
            keys, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vectors = _matrix(batch.column(2), width)
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if tree is not None and keys[a] != tree:
                    yield packed(tree, ids, parts)
                    ids, parts = [], []
                tree = int(keys[a])
                ids.append(own[a:b])
                parts.append(vectors[a:b])
        if ids:
            yield packed(tree, ids, parts)

    return run


def _requests(pivots: np.ndarray, cells: dict[int, tuple[int, int, float, float]], width: int, norm2: int, home: bool):
    """mapInArrow over (tag, id, vector, bound): (tree, packed queries) for the trees that may hold a result.

    ``cells`` has each cell's first tree, its number of trees, and the least and largest distance from its pivot. With
    ``home`` each query goes to one tree of its nearest cell, else to all others that its bound allows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        lifted = _lift(pivots, norm2)
        order = sorted(cells)
        first, count = (np.array([cells[c][i] for c in order]) for i in (0, 1))
        least, most = (np.array([cells[c][i] for c in order]) for i in (2, 3))
        for whole in batches:
            for start in range(0, whole.num_rows, QUERY_ROWS):
                batch = whole.slice(start, QUERY_ROWS)
                tags, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                vectors, bounds = _matrix(batch.column(2), width), batch.column(3).to_pylist()
                far = MTree._distances(_lift(vectors, norm2, query=True), lifted)[:, order]
                nearest = far.argmin(1)
                homes = first[nearest] + ids % count[nearest]
                q2 = np.einsum("ij,ij->i", vectors, vectors) + norm2
                limit = [np.inf if b is None else math.sqrt(max(0, q - 2 * b)) for q, b in zip(q2.tolist(), bounds)]
                limit = np.array(limit) + 2e-6 * np.sqrt(np.maximum(1, q2))
                for c in range(len(order)):
                    fits = (far[:, c] - most[c] <= limit) & (least[c] - far[:, c] <= limit)
                    for tree in range(first[c], first[c] + count[c]):
                        chosen = np.flatnonzero((homes == tree) if home else (fits & (homes != tree)))
                        if chosen.size:
                            part = (tags[chosen], ids[chosen], vectors[chosen], [bounds[i] for i in chosen.tolist()])
                            yield int(tree), pickle.dumps(part)

    return run


def _answer(k: int):
    """mapInArrow over (packed tree, packed queries): (tag, id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last, tree = None, None
        for batch in batches:
            for number, packed, queries in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if number != last:
                    last, tree = number, MTree.unpacked(packed.as_py())
                for tag, own, vector, bound in zip(*pickle.loads(queries.as_py())):
                    for score, id_ in tree.search(vector, int(own), k, bound):
                        yield int(tag), id_, score

    return run


def _arrow(df: DataFrame, function, ddl: str, size: int = 2_000) -> DataFrame:
    schema = to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)
    return df.mapInArrow(lambda batches: rebatched(function(batches), schema, size), ddl)


def top_inner_products(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row the k rows with the largest inner products, ties by id.

    Components are turned into floor(scale * x). Queries are the rows for which ``is_query`` holds; candidates are all
    rows with another id than the query's (all of them, if there are fewer than k). Vectors that are null or hold null,
    NaN or infinite components, and rows with a null id, take no part; shorter vectors count as padded with zeros;
    every row stands for itself, repeated ones too: each is a candidate, and a query row that is repeated has its results
    as often. Scores are exact while they fit a long. Without vectors the result is empty.

    Rows are dealt to the cells of at most `CELLS` pivots (rows with the smallest hashes), and each cell to
    trees of about ``tree_rows`` rows, however many it has. A query first searches one tree of its nearest cell; its
    k-th score then rules out cells by their covering radii, and it searches the trees of the others with that bound.
    """
    spark = df.sparkSession
    result = "query_id long, rank int, vec_id long, score long"
    rows = df.select(named(id_col).cast("long").alias("vec_id"), scaled(named(vector_col), scale).alias("vector"), is_query.alias("asks"))
    rows = rows.where("vec_id is not null and size(vector) > 0")
    rows = written(rows.withColumn("tag", F.monotonically_increasing_id()), "vectors")
    norm = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x)
    n, norm2, width = rows.agg(F.count("*"), F.max(norm), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], result)

    wanted = min(CELLS, -(-n // tree_rows))
    chosen = rows.orderBy(F.xxhash64("vec_id", "tag"), "tag").select("vector").limit(wanted).collect()
    pivots = np.zeros((len(chosen), width), np.int64)
    for i, row in enumerate(chosen):
        pivots[i, : len(row[0])] = row[0]
    ddl = "vec_id long, vector array<long>, tag long, cell int, far double"
    dealt = written(rows.select("vec_id", "vector", "tag").mapInArrow(_assign(pivots, width, norm2), ddl), "dealt")
    sizes = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.min("far").alias("least"), F.max("far").alias("most"))
    cells, trees = {}, 0
    for row in sizes.orderBy("cell").collect():  # at most CELLS rows
        count = -(-row["n"] // tree_rows)
        cells[row["cell"]] = (trees, count, row["least"], row["most"])
        trees += count
    firsts = spark.createDataFrame([(c, v[0], v[1]) for c, v in cells.items()], "cell int, first long, count long")
    tree = (F.col("first") + F.pmod(F.xxhash64("vec_id", "tag"), F.col("count"))).alias("tree")
    # The trees are written before they are searched, so each is built once.
    own = dealt.join(F.broadcast(firsts), "cell").select(tree, "vec_id", "vector")
    own = own.repartition(max(1, min(trees, 100_000)), "tree").sortWithinPartitions("tree", "vec_id")
    forest = written(_arrow(own, _plant(width, norm2), "tree long, packed binary", 8), "forest")

    asked = rows.where("asks").select("tag", "vec_id", "vector")

    def answers(queries: DataFrame, home: bool) -> DataFrame:
        sent = _arrow(queries, _requests(pivots, cells, width, norm2, home), "tree long, queries binary", 16)
        met = forest.join(sent, "tree").select("tree", "packed", "queries")
        return _arrow(met, _answer(k), "tag long, vec_id long, score long")

    none = F.lit(None).cast("long").alias("bound")
    begun = written(answers(asked.select("tag", "vec_id", "vector", none), home=True), "begun")
    bounds = begun.groupBy("tag").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    rest = answers(asked.join(bounds, "tag", "left").select("tag", "vec_id", "vector", "bound"), home=False)
    place = F.expr("row_number() over (partition by tag order by score desc, vec_id)")
    ranked = begun.union(rest).withColumn("rank", place).where(F.col("rank") <= k)
    names = asked.select("tag", F.col("vec_id").alias("query_id"))
    return ranked.join(names, "tag").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
