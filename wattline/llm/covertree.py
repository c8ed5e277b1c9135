"""Exact top-k inner products by dual-tree search over cover trees.

Rows fall into shards by a hash of their id; each shard becomes a cover tree
(children cover their points within a shrinking radius and their centres keep
that distance), and so does each block of queries.  A pair of nodes is pruned
when its bound, from the centres and both covering radii, lies below the worst
kth score of the query group.  Every block of queries first meets one shard; the
kth scores found there bound its search in all other shards, of which a shard
whose root lies below them is left at once.  Equal vectors are one point of the tree.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm import shipped
from wattline.llm.exchange import stage

SHARD = 8192    # rows in a tree
QUERIES = 1024  # queries in a tree
TASKS = 64      # searched at once, where there are so many pairs of trees
LEAF = 96       # points in a leaf
SHRINK = 0.6    # radius of children against their parent's


class Tree:
    """Nodes as arrays: centre, radius, points from start to end, children (none: a leaf)."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.square = np.einsum("ij,ij->i", points, points)
        self.order = np.arange(len(points))
        self.centre, self.radius, self.start, self.end, self.children = [], [], [], [], []
        far = self._distances(0, self.order)
        self._grow(0, 0, len(points), far)
        self.points = points[self.order]
        self.centre = points[np.array(self.centre)]
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.centre, self.centre))
        self.radius = np.array(self.radius)
        del self.square

    def _distances(self, centre, members):
        gap = self.square[members] + self.square[centre] - 2.0 * (self.points[members] @ self.points[centre])
        return np.sqrt(np.maximum(gap, 0.0))

    def _node(self, centre, start, end, far):
        self.centre.append(centre)
        self.radius.append(float(far.max()) if len(far) else 0.0)
        self.start.append(start)
        self.end.append(end)
        self.children.append([])
        return len(self.centre) - 1

    def _grow(self, centre, start, end, far):
        """A node over order[start:end], whose distances from ``centre`` are ``far``; an explicit stack
        stands for the recursion."""
        root = self._node(centre, start, end, far)
        todo = [(root, centre, far)]
        while todo:
            node, centre, far = todo.pop()
            start, end = self.start[node], self.end[node]
            if end - start <= LEAF or self.radius[node] == 0.0:
                continue
            members = self.order[start:end].copy()
            reach = self.radius[node] * SHRINK
            near, owner, centres = far.copy(), np.zeros(len(members), np.int64), [centre]
            most = max(2, (end - start) // (LEAF // 4))
            while near.max() > reach and len(centres) < most:  # the farthest point becomes a centre
                new = int(members[int(near.argmax())])
                gap = self._distances(new, members)
                closer = gap < near
                near[closer] = gap[closer]
                owner[closer] = len(centres)
                centres.append(new)
            if len(centres) == 1:
                continue
            by = np.argsort(owner, kind="stable")
            self.order[start:end] = members[by]
            cuts = np.searchsorted(owner[by], np.arange(len(centres) + 1))
            for k, c in enumerate(centres):
                a, b = int(cuts[k]), int(cuts[k + 1])
                if a == b:
                    continue
                gaps = near[by[a:b]]
                child = self._node(c, start + a, start + b, gaps)
                self.children[node].append(child)
                todo.append((child, c, gaps))


def bound(q: Tree, a: int, r: Tree, nodes: np.ndarray) -> np.ndarray:
    """Largest inner product of any query of node a with any point of each node of r."""
    inner = r.centre[nodes] @ q.centre[a]
    return inner + r.radius[nodes] * q.norm[a] + q.radius[a] * r.norm[nodes] + q.radius[a] * r.radius[nodes]


def search(q: Tree, q_ids: np.ndarray, r: Tree, ids: np.ndarray, ends: np.ndarray, k: int,
           floor: np.ndarray | None = None):
    """(ids, scores) of each query's best k, queries in the order of ``q.order``; absent: score -inf.

    ``floor``: scores below which a query needs no answer.  ids[ends[i]:ends[i + 1]] are the ids of point i of ``r.points``, ascending."""
    best = np.full((len(q.points), k), -np.inf)
    names = np.full((len(q.points), k), np.iinfo(np.int64).max)
    least = np.full(len(q.points), -np.inf) if floor is None else floor.copy()  # a better score than this is needed, or an equal one
    todo = [(0, np.zeros(1, np.int64))]  # query node, frontier of r
    while todo:
        a, frontier = todo.pop()
        top = bound(q, a, r, frontier)
        s, e = q.start[a], q.end[a]
        wanted = top >= least[s:e].min() - 1e-6 * np.maximum(1.0, np.abs(top))
        top, frontier = top[wanted], frontier[wanted]
        if not len(frontier):
            continue
        if q.children[a]:
            # open the widest half of the frontier for the query node's children, all of it together
            frontier = frontier[np.argsort(-top, kind="stable")]
            opened = np.concatenate([np.array(r.children[n] or [n], np.int64) for n in frontier.tolist()]) if len(frontier) < 256 else frontier
            todo.extend((c, opened) for c in q.children[a])
            continue
        heap = [(-u, n) for u, n in zip(top.tolist(), frontier.tolist(), strict=True)]
        heapq.heapify(heap)
        while heap:
            u, n = heapq.heappop(heap)
            if -u < least[s:e].min() - 1e-6 * max(1.0, abs(u)):
                break
            if r.children[n]:
                kids = np.array(r.children[n], np.int64)
                for v, c in zip(bound(q, a, r, kids).tolist(), kids.tolist(), strict=True):
                    heapq.heappush(heap, (-v, c))
                continue
            x, y = r.start[n], r.end[n]
            score = products(q.points[s:e], r.points[x:y])
            columns = np.repeat(np.arange(y - x), np.diff(ends[x:y + 1]))
            score, own = score[:, columns], ids[ends[x]:ends[y]]
            score = np.where(own[None, :] == q_ids[s:e, None], -np.inf, score)
            if not (score >= least[s:e, None]).any():
                continue
            score = np.concatenate([best[s:e], score], axis=1)
            name = np.concatenate([names[s:e], np.broadcast_to(own, (e - s, len(own)))], axis=1)
            order = np.lexsort((name, -score), axis=1)[:, :k]
            best[s:e] = np.take_along_axis(score, order, 1)
            names[s:e] = np.take_along_axis(name, order, 1)
            least[s:e] = np.maximum(least[s:e], best[s:e, -1])
    return names, best


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integral doubles; exact while they stay below 2**53."""
    return a @ b.T


def _vectors(column, factor: float):
    """(rows taking part, matrix) of a list column whose lists have one length."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(factor * values).reshape(len(column), -1)


def top_inner_products(rows: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 20,
                       every: int = 20, factor: float = 64.0) -> DataFrame:
    """query_id, rank, key, score: each query's ``k`` highest inner products, ties to the smaller key.

    Components become ``floor(factor * x)``.  Queries: rows whose key is
    divisible by ``every``; candidates: all rows of another key and the same
    length.  Null keys, null or empty vectors and vectors with a null or
    non-finite component take no part.  Repeated rows stay candidates; a
    repeated query is answered once for each row, in its own ranks.  Fewer
    candidates than ``k`` give fewer rows; an empty table gives none.  Scores are
    computed in doubles: exact below 2**53, so for components below 2**53 / dimensions
    by square."""
    value = F.col(column).cast("array<double>")
    fine = rows.select(F.col(key).cast("long").alias("id"), value.alias("v")).where(
        F.col("id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    count = shipped(fine).agg(F.count("*").alias("n"), F.count(F.when(F.pmod("id", F.lit(every)) == 0, 1)).alias("q")).first()
    shards, blocks = max(1, -(-count["n"] // SHARD)), max(1, -(-count["q"] // QUERIES))
    dim = F.size("v").alias("dim")

    def build(group: pa.Table) -> pa.Table:
        ids = group["id"].to_numpy()
        points = _vectors(group["v"].combine_chunks(), factor)
        distinct, which = np.unique(points, axis=0, return_inverse=True)
        order = np.lexsort((ids, which.ravel()))
        which, ids = which.ravel()[order], ids[order]
        first = np.searchsorted(which, np.arange(len(distinct)))
        keep = np.arange(len(ids)) - first[which] <= k  # of equal vectors no more than k+1 can be in an answer
        which, ids = which[keep], ids[keep]
        tree = Tree(distinct)
        first, last = (np.searchsorted(which, np.arange(len(distinct)), side)[tree.order] for side in ("left", "right"))
        size = last - first
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = ids[np.repeat(first - ends[:-1], size) + np.arange(int(ends[-1]))]
        return pa.table({"dim": pa.array([points.shape[1]], pa.int32()), "part": pa.array([group["part"][0].as_py()], pa.int64()),
                         "tree": pa.array([pickle.dumps((tree, ids, ends), protocol=5)], pa.binary())})

    def build_queries(group: pa.Table) -> pa.Table:
        tree = Tree(_vectors(group["v"].combine_chunks(), factor))
        return pa.table({"dim": pa.array([group["dim"][0].as_py()], pa.int32()), "block": pa.array([group["part"][0].as_py()], pa.int64()),
                         "queries": pa.array([pickle.dumps((tree, group["id"].to_numpy()[tree.order]), protocol=5)], pa.binary())})

    spread = fine.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(shards)))
    trees = spread.select("id", "v", dim, "part").groupBy("dim", "part").applyInArrow(build, "dim int, part long, tree binary")
    asked = fine.where(F.pmod("id", F.lit(every)) == 0).withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)))
    trees = stage(trees)
    queries = stage(asked.select("id", "v", dim, "part").groupBy("dim", "part").applyInArrow(build_queries, "dim int, block long, queries binary"))
    own = F.pmod("block", F.lit(shards))

    def answer(record_batches):
        for rb in record_batches:
            for i in range(rb.num_rows):
                dim, block, floors = rb.column(0)[i].as_py(), rb.column(1)[i].as_py(), rb.column(4)[i].as_py() or ()
                q, q_ids = pickle.loads(rb.column(2)[i].as_py())
                r, ids, ends = pickle.loads(rb.column(3)[i].as_py())
                floor = np.full(len(q_ids), -np.inf)
                for f in floors:
                    floor[f["row"]] = f["least"]
                names, best = search(q, q_ids, r, ids, ends, k, floor)
                row, place = np.nonzero(np.isfinite(best) & (best >= floor[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), dim), pa.int32()), pa.array(np.full(len(row), block)), pa.array(row), pa.array(q_ids[row]),
                     pa.array(names[row, place]), pa.array(best[row, place].astype(np.int64))],
                    names=["dim", "block", "row", "query_id", "id", "score"])

    def meet(wanted, salts):
        """The answers of the wanted (dim, block, part, floors); ``salts`` tasks share a shard."""
        tasks = min(4 * shards * salts, 8192)
        left = wanted.withColumn("salt", F.pmod("block", F.lit(salts))).repartition(tasks, "dim", "part", "salt")
        right = trees.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        pairs = left.join(right.repartition(tasks, "dim", "part", "salt"), ["dim", "part", "salt"])
        return pairs.select("dim", "block", "queries", "tree", "floors").mapInArrow(
            answer, "dim int, block long, row long, query_id long, id long, score long")

    none = F.lit(None).cast("array<struct<row: bigint, least: bigint>>").alias("floors")
    first = stage(meet(queries.select("dim", "block", "queries", own.alias("part"), none), 1))
    floors = (first.groupBy("dim", "block", "row").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
              .groupBy("dim", "block").agg(F.collect_list(F.struct("row", "least")).alias("floors")))
    others = (queries.join(floors, ["dim", "block"], "left")
              .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).where(F.col("part") != own))
    found = first.unionByName(meet(others, max(1, min(blocks, -(-TASKS // shards)))))
    rank = F.row_number().over(Window.partitionBy("query_id", "dim", "block", "row").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
