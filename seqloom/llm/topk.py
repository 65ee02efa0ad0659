"""Exact top-k inner products by best-first search over M-trees.

Inner products become distances by one more coordinate: with the longest vector's norm m,
the points (x, sqrt(m^2 - |x|^2)) stand at the squared distance |q|^2 + m^2 - 2 q.x from the
query (q, 0).  A tree's nodes are pages of at most ``PAGE`` entries.  An entry of an inner page is a
routing point, which is one of the points, with the covering radius of its subtree and the distance to the
routing point of its page; an entry of a leaf is a point with that distance.  A search keeps a
heap of pages by their least possible distance, stops where no page can better its k-th result, and
computes distances only for entries that the triangle inequality with the stored distances to the
routing point does not exclude.  Bounds are taken with a margin for rounding; scores are integers.

Rows are dealt to the nearest of a bounded number of pivots, and large cells are cut into groups
of a page tree each.  A query first searches one group of its own cell, which seeds its k-th score, and then
visits the groups whose covering radius allows a better one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import if_small, sorted_groups
from seqloom.plans.recovery import cut, table

SLACK = 1e-6
PAGE, FAN = 512, 16
#: Pivots for each vector length, and lengths with pivots, at most: what is broadcast is bounded by them.
PIVOTS, LENGTHS = 256, 16
EXACT = float(1 << 53)


def _apart(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - point) ** 2).sum(axis=1))


class Leaf:
    """A page of points: rows ``lo`` and on of the tree, by their distance to the page's routing point."""

    __slots__ = ("apart", "lo", "rows")

    def __init__(self, rows: np.ndarray, apart: np.ndarray) -> None:
        order = np.argsort(apart, kind="stable")
        self.rows, self.apart, self.lo = rows[order], apart[order], 0


class Inner:
    """A page of routing points, each with its distance to this page's own, its subtree's radius and its page."""

    __slots__ = ("apart", "children", "points", "radii", "rows")

    def __init__(self, rows: np.ndarray, points: np.ndarray, apart: np.ndarray, radii: np.ndarray, children: list) -> None:
        self.rows, self.points, self.apart, self.radii, self.children = rows, points, apart, radii, children


class Tree:
    """An M-tree over integer vectors; rows are put in the order of its leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, fan: int = FAN) -> None:
        wide = vectors.astype(np.float64)
        square = (wide**2).sum(axis=1)
        self.top = float(square.max())
        self.points = np.hstack((wide, np.sqrt(np.maximum(self.top - square, 0.0))[:, None]))
        self.page, self.fan = page, fan
        self.computed = 0  # distances and scores of searches so far
        self.route = self.points[0]
        apart = _apart(self.points, self.route)
        self.radius = float(apart.max())
        self.leaves: list[Leaf] = []
        self.root = self._built(np.arange(len(ids)), apart)
        order = np.concatenate([leaf.rows for leaf in self.leaves])
        at = np.cumsum([0, *(len(leaf.rows) for leaf in self.leaves)])
        for leaf, lo in zip(self.leaves, at.tolist(), strict=False):
            leaf.lo = lo
        self.ids, self.whole, self.vectors = ids[order], vectors[order], wide[order]

    def _built(self, rows: np.ndarray, apart: np.ndarray) -> Leaf | Inner:
        """The page over ``rows``, which stand ``apart`` from its routing point."""
        if len(rows) <= self.page:
            self.leaves.append(Leaf(rows, apart))
            return self.leaves[-1]
        # Routing points far from each other: each is the farthest from those before it.
        fan = min(self.fan, max(2, -(-2 * len(rows) // self.page)))
        points = self.points[rows]
        chosen, near = [int(apart.argmax())], np.full(len(rows), np.inf)
        owner = np.zeros(len(rows), dtype=np.int64)
        for k in range(fan):
            to = _apart(points, points[chosen[k]])
            owner[to < near] = k
            near = np.minimum(near, to)
            if k + 1 < fan:
                if near.max() <= 0:
                    break
                chosen.append(int(near.argmax()))
        if len(chosen) == 1 or np.bincount(owner).max() > 0.9 * len(rows):
            owner = np.arange(len(rows)) * fan // len(rows)  # nothing parts them: even runs
            chosen = [int(np.flatnonzero(owner == k)[0]) for k in range(fan)]
        radii, children = [], []
        for k, c in enumerate(chosen):
            own = np.flatnonzero(owner == k)
            to = _apart(points[own], points[c])
            radii.append(float(to.max()))
            children.append(self._built(rows[own], to))
        return Inner(rows[chosen], points[chosen], apart[chosen], np.array(radii), children)

    def search(self, query: np.ndarray, own: int, k: int, floor: float = -np.inf) -> list[tuple[int, int]]:
        """(score, id) of the ``k`` best rows with other ids than ``own`` and scores of ``floor`` or more, ties to the smaller id."""
        q = query.astype(np.float64)
        norm = float(q @ q)
        if norm * self.top > EXACT**2:
            return self._large(query, own, k)
        base = norm + self.top
        point = np.append(q, 0.0)
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst first
        reach = math.sqrt(max(base - 2 * floor, 0.0)) * (1 + SLACK) + SLACK if floor > -np.inf else math.inf
        to = float(_apart(self.route[None], point)[0])
        self.computed += 1
        heap = [(max(to - self.radius, 0.0), 0, to, self.root)]
        pushed = 1
        while heap and heap[0][0] <= reach:
            _, _, to, node = heapq.heappop(heap)
            if isinstance(node, Inner):
                some = np.flatnonzero(np.abs(to - node.apart) - node.radii <= reach)
                far = _apart(node.points[some], point)
                self.computed += len(some)
                least = np.maximum(far - node.radii[some], 0.0)
                for i, x, y in zip(some.tolist(), least.tolist(), far.tolist(), strict=True):
                    if x <= reach:
                        heapq.heappush(heap, (x, pushed, y, node.children[i]))
                        pushed += 1
                continue
            lo, hi = node.apart.searchsorted((to - reach, to + reach)).tolist() if reach < math.inf else (0, len(node.apart))
            lo, hi = node.lo + lo, node.lo + min(hi + 1, len(node.apart))
            scores = self.vectors[lo:hi] @ q
            self.computed += hi - lo
            fit = np.flatnonzero(scores >= (max(best[0][0], floor) if len(best) == k else floor))
            if not len(fit):
                continue
            scores, ids = scores[fit], self.ids[lo + fit]
            if (ids == own).any():
                scores, ids = scores[ids != own], ids[ids != own]
            if len(scores) > k:
                order = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[order], ids[order]
            for score, i in zip(scores.tolist(), ids.tolist(), strict=True):
                item = (int(score), -i)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                reach = min(reach, math.sqrt(max(base - 2 * max(best[0][0], floor), 0.0)) * (1 + SLACK) + SLACK)
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))

    def _large(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """``search`` where scores may be beyond what doubles hold: in integers, without bounds."""
        if float(np.linalg.norm(query.astype(np.float64))) * self.top**0.5 >= float(1 << 62):
            raise OverflowError("an inner product does not fit into 64 bits")
        self.computed += len(self.ids)
        scores = self.whole @ query
        order = np.lexsort((self.ids, -scores))
        return [(int(scores[i]), int(self.ids[i])) for i in order[self.ids[order] != own][:k].tolist()]


class Cells:
    """The pivots of one vector length."""

    def __init__(self, sample: np.ndarray, pivots: int) -> None:
        sample = sample.astype(np.float64)
        chosen, near = [0], np.full(len(sample), np.inf)
        while len(chosen) < min(pivots, len(sample)):
            near = np.minimum(near, _apart(sample, sample[chosen[-1]]))
            if near.max() <= 0:
                break
            chosen.append(int(near.argmax()))
        self.pivots = sample[chosen]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each vector and the distance to it."""
        cell, far = np.zeros(len(vectors), dtype=np.int64), np.full(len(vectors), np.inf)
        for k, p in enumerate(self.pivots):
            to = _apart(vectors, p)
            cell[to < far] = k
            far = np.minimum(far, to)
        return cell, far

    def best(self, vectors: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """The largest score that each query may have in each cell: q.p + |q| radius, with a margin."""
        size = np.sqrt((vectors**2).sum(axis=1))[:, None]
        most = vectors @ self.pivots.T + size * radii
        return most + np.abs(most) * SLACK + size * radii * SLACK + 1


def _matrices(dims: np.ndarray, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their vectors) for each vector length of a batch."""
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)


def _dealt(rows: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """``rows`` (vec_id, v) with dim, cell and the distance to the cell's pivot; lengths without pivots are one cell without bounds."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            cell, far = np.zeros(len(dims), dtype=np.int64), np.full(len(dims), np.inf)
            for dim, at, vectors in _matrices(dims, batch.column(1)):
                if dim in shared.value:
                    cell[at], far[at] = shared.value[dim].nearest(vectors.astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], ["vec_id", "v", "dim", "cell", "far"])

    return rows.withColumn("dim", F.size("v").cast("long")).mapInArrow(kernel, "vec_id long, v array<long>, dim long, cell long, far double")


def _visited(points: DataFrame, asked: DataFrame, k: int, block: int) -> DataFrame:
    """(quid, query_id, vec_id, score, times): the ``k`` best rows of a group for each query that is sent there.

    ``asked`` is (dim, cell, part, quid, query_id, times, floor, v).  A group meets its queries in
    blocks of about ``block``, so its rows are copied once for each block.
    """
    group = ["dim", "cell", "part"]
    blocks = asked.groupBy(*group).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocks = if_small(cut(blocks))
    sent = asked.join(blocks, group)
    sent = sent.withColumn("b", F.pmod(F.xxhash64("quid"), F.col("blocks")).cast("int"))
    held = points.join(blocks, group).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key, none = F.xxhash64(*group, "b").alias("key"), F.lit(None).cast("long")
    both = held.select(key, F.lit(0).alias("asked"), none.alias("quid"), "vec_id", none.alias("times"), F.lit(None).cast("double").alias("floor"), "v")
    both = both.unionByName(sent.select(key, F.lit(1).alias("asked"), "quid", F.col("query_id").alias("vec_id"), "times", "floor", "v"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_groups(batches):
            n = int((part.column("asked").to_numpy() == 0).sum())
            ids = part.column("vec_id").to_numpy()
            flat = part.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            tree = Tree(ids[:n], flat[:n])
            rest = zip(part.column("quid").to_pylist()[n:], ids[n:].tolist(), part.column("times").to_pylist()[n:], part.column("floor").to_pylist()[n:], flat[n:], strict=True)
            found = [(quid, own, i, s, times) for quid, own, times, floor, v in rest for s, i in tree.search(v, own, k, floor)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["quid", "query_id", "vec_id", "score", "times"])

    dealt = both.repartition("key").sortWithinPartitions("key", "asked", "vec_id")
    return dealt.mapInArrow(kernel, "quid long, query_id long, vec_id long, score long, times long")


def search(vectors: DataFrame, every: int = 50, k: int = 5, group: int | None = None, block: int = 1 << 15, pivots: int = PIVOTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows by integer inner product.

    Components become floor(256 x).  Queries are the rows whose id is divisible by
    ``every``.  Vectors that are null, empty or hold null or non-finite components, and rows with a
    null id, take no part; rows of other lengths than the query's are no candidates; rows with the query's id are its own.
    As in SQL, ranks count pairs of rows: a repeated candidate takes a rank for each of its rows,
    and the rows of a repeated query id are ranked together, each with its own results; equal ones are searched once.
    An inner product that 64 bits may not hold raises OverflowError.  An empty table gives an empty result.

    A task holds one group of about ``group`` rows (by default 32768, or fewer if there are fewer rows
    than tasks could use) and ``block`` queries.
    """
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    ints = F.transform(vec_col, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    rows = vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).where((F.size(vec_col) > 0) & ~bad)
    rows = cut(rows.select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v")))
    lengths = rows.groupBy(F.size("v").cast("long").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()
    if group is None:
        group = min(32768, max(1024, sum(r["count"] for r in lengths) // (2 * rows.sparkSession.sparkContext.defaultParallelism)))
    cells = {}
    for r in lengths:
        wanted = min(pivots, -(-r["count"] // group))
        if wanted > 1:
            some = rows.where(F.size("v") == r.dim).where(F.rand(7) < 16 * wanted / r["count"]).limit(16 * wanted).collect()
            if some:
                cells[r.dim] = Cells(np.array([x.v for x in some]), wanted)
    dealt = table(_dealt(rows, cells).withColumn("uid", F.monotonically_increasing_id()), "top-k-cells")
    sizes = cut(dealt.groupBy("dim", "cell").agg(F.ceil(F.count("*") / group).cast("int").alias("parts"), F.max("far").alias("radius")))
    placed = dealt.join(if_small(sizes), ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
    points = placed.select("dim", "cell", "part", "vec_id", "v")
    queries = placed.where(F.col("vec_id") % every == 0).groupBy("vec_id", "dim", "v").agg(F.min("cell").alias("cell"), F.min("part").alias("part"), F.min("uid").alias("quid"), F.count("*").alias("times"))
    queries = cut(queries.withColumnRenamed("vec_id", "query_id"))
    first = cut(_visited(points, queries.withColumn("floor", F.lit(float("-inf"))), k, block))

    floors = first.groupBy("quid").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
    seeded = queries.join(floors, "quid", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    # Other parts of bounded cells by their radii; lengths without pivots are one cell, of which every part is met.
    known = {r.dim: {} for r in lengths}
    for r in sizes.where(F.col("dim").isin(list(cells))).collect() if cells else []:
        known[r.dim][r.cell] = (r.radius, r.parts)
    shared = rows.sparkSession.sparkContext.broadcast((cells, known))
    names = ["quid", "query_id", "times", "floor", "dim", "cell", "part", "v"]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, known = shared.value
        for batch in batches:
            dims, floor, own = batch.column(4).to_numpy(), batch.column(3).to_numpy(), list(zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True))
            for dim, at, vectors in _matrices(dims, batch.column(7)):
                radii = np.array([known[dim].get(c, (-np.inf, 0))[0] for c in range(len(cells[dim].pivots))])
                most = cells[dim].best(vectors.astype(np.float64), np.where(radii < 0, 0.0, radii))
                hit, cell = np.nonzero((most >= floor[at][:, None]) & (radii >= 0))
                for c in np.unique(cell).tolist():
                    for part in range(known[dim][c][1]):
                        out = [i for i in at[hit[cell == c]].tolist() if own[i] != (c, part)]
                        if out:
                            cut_ = batch.take(pa.array(out))
                            where = [pa.array([c] * len(out), pa.int64()), pa.array([part] * len(out), pa.int32())]
                            yield pa.RecordBatch.from_arrays([*cut_.columns[:5], *where, cut_.column(7)], names)

    seeded = seeded.select(*names)
    bounded = F.col("dim").isin(list(cells)) if cells else F.lit(False)
    asked = seeded.where(bounded).mapInArrow(kernel, "quid long, query_id long, times long, floor double, dim long, cell long, part int, v array<long>")
    others = seeded.where(~bounded).join(sizes.select("dim", "cell", "parts"), ["dim", "cell"])
    others = others.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("other <> part")
    asked = table(asked.unionByName(others.withColumn("part", F.col("other")).select(*names)), "top-k-asked")
    found = first.unionByName(_visited(points, asked, k, block))
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("times"), F.lit(k)).cast("int"))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
WHERE rank <= 5
"""
