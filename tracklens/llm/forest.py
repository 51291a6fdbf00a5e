"""Approximate nearest neighbours by a forest of random-projection trees (operator 7).

Trees split the space by random hyperplanes at the median of a sample; every row is then
filed in one leaf of each tree. A query walks all trees through one priority queue, always
opening the branch with the smallest distance to the hyperplanes passed on the way, until
it has seen enough leaves. The candidates in these leaves are ranked by exact distances.
How many leaves are enough is calibrated on the sample against brute force.
"""

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklens.llm.storage import lists, stored
from tracklens.llm.vectors import blocks, matrix, sample, valid

SAMPLE = 20_000   # vectors that the trees and the calibration see, at most about
TREES = 4
LEAF = 64         # sample vectors in a leaf, at most
BLOCK = 1024      # residents or queries compared at once
PROBES = 200      # calibration queries


@dataclass
class Tree:
    """Nodes in arrays: hyperplane, offset, and children; a leaf's children are -1 - its number."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaves: int

    def file(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(rows), np.int64)
        if not len(self.offsets):
            return at
        out, open_rows = np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(open_rows):
            node = at[open_rows]
            side = np.einsum("ij,ij->i", rows[open_rows], self.normals[node]) > self.offsets[node]
            after = self.children[node, side.astype(int)]
            out[open_rows[after < 0]] = -1 - after[after < 0]
            at[open_rows] = after
            open_rows = open_rows[after >= 0]
        return out


def plant(rows: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """One tree over the rows; equal projections can't be split and end in a larger leaf."""
    normals, offsets, children, leaves = [], [], [], 0

    def grow(members: np.ndarray) -> int:
        nonlocal leaves
        for _ in range(4 if len(members) > leaf else 0):
            normal = rng.normal(size=rows.shape[1])
            normal /= np.sqrt((normal**2).sum())
            value = rows[members] @ normal
            offset = float(np.median(value))
            right = value > offset
            if right.any():
                break
        else:
            leaves += 1
            return -leaves
        node = len(offsets)
        normals.append(normal)
        offsets.append(offset)
        children.append((0, 0))
        children[node] = (grow(members[~right]), grow(members[right]))
        return node

    grow(np.arange(len(rows)))
    return Tree(np.array(normals).reshape(len(offsets), rows.shape[1]), np.array(offsets),
                np.array(children, np.int64).reshape(len(offsets), 2), leaves)


@dataclass
class Forest:
    """Trees, their sample's leaves being numbered through, and the leaves that a query opens."""

    trees: list[Tree]
    opened: int

    def starts(self) -> np.ndarray:
        return np.cumsum([0, *(tree.leaves for tree in self.trees)])

    def file(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([tree.file(rows) + start for tree, start in
                         zip(self.trees, self.starts(), strict=False)], axis=1)

    def open(self, row: np.ndarray, most: int | None = None) -> list[int]:
        """Leaves in the order of the shared queue."""
        starts, out, turn = self.starts(), [], 0
        margins = [tree.normals @ row - tree.offsets for tree in self.trees]
        heap = [(0.0, k, k, 0 if len(tree.offsets) else -1) for k, tree in enumerate(self.trees)]
        turn = len(heap)
        while heap and len(out) < (most or self.opened):
            far, _, tree, node = heapq.heappop(heap)
            while node >= 0:
                margin, (left, right) = margins[tree][node], self.trees[tree].children[node]
                near, away = (right, left) if margin > 0 else (left, right)
                heapq.heappush(heap, (far + margin * margin, turn, tree, int(away)))
                turn, node = turn + 1, int(near)
            out.append(int(starts[tree] - 1 - node))
        return out


def nearest(rows: np.ndarray, query: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and Euclidean distances of the ``k`` nearest rows, ties to the smaller id."""
    distance = np.sqrt(((rows - query) ** 2).sum(axis=1))
    if len(rows) > 4 * k:
        edge = np.partition(distance, k - 1)[k - 1]
        some = np.flatnonzero(distance <= edge)
    else:
        some = np.arange(len(rows))
    order = some[np.lexsort((ids[some], distance[some]))][:k]
    return order, distance[order]


def build(rows: np.ndarray, *, k: int, recall: float, trees: int = TREES, leaf: int = LEAF,
          seed: int = 5) -> Forest:
    """Plant the trees on a sample and calibrate the leaves to open.

    Probes are sample vectors; for each, the leaves needed to hold the share ``recall`` of its
    k nearest others are counted, and the mean recall over all probes is brought to ``recall``.
    """
    rng = np.random.default_rng(seed)
    forest = Forest([plant(rows, leaf, rng) for _ in range(trees)], 1)
    filed, total = forest.file(rows), int(forest.starts()[-1])
    probes = rng.permutation(len(rows))[:PROBES]
    met = np.zeros(total)
    wanted = 0
    for probe in probes:
        others = np.delete(np.arange(len(rows)), probe)
        if not len(others):
            continue
        best = others[nearest(rows[others], rows[probe], others, k)[0]]
        rank = np.full(total, total)
        order = forest.open(rows[probe], total)
        rank[order] = np.arange(len(order))
        met += np.bincount(rank[filed[best]].min(axis=1), minlength=total)[:total]
        wanted += len(best)
    if wanted:
        forest.opened = int(np.searchsorted(np.cumsum(met) / wanted, recall) + 1)
    forest.opened = min(forest.opened, max(total, 1))
    return forest


def _rank(table: pa.Table, k: int) -> pa.Table:
    """The k nearest of one block for each of its queries."""
    role = np.array(table.column("role").to_pylist())
    ids, queries = table.column("id").to_numpy(), table.column("query_id").fill_null(-1).to_numpy()
    vectors = matrix(table.column("embedding"))
    r, v = np.flatnonzero(role == "r"), np.flatnonzero(role == "v")
    out = {name: [] for name in ("query_id", "vec_id", "score")}
    for q in v:
        mine = r[ids[r] != queries[q]]
        if len(mine):
            place, score = nearest(vectors[mine], vectors[q], ids[mine], k)
            out["query_id"].append(np.full(len(place), queries[q]))
            out["vec_id"].append(ids[mine][place])
            out["score"].append(score)
    kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
    return pa.table({n: pa.array(np.concatenate(x) if x else [], kinds[n]) for n, x in out.items()})


def search(embeddings: DataFrame, queries: DataFrame, *, k: int = 10, recall: float = 0.97,
           sample_rows: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query.

    Both frames have (vec_id, embedding); a query's own vec_id is no candidate of it. Nearness
    is the Euclidean distance in double precision, ties go to the smaller vec_id. Vectors that
    are null, zero or have null or non-finite components, and rows without vec_id, take no
    part. Rows that share a vec_id count once, with the smallest of their vectors. With fewer
    candidates than ``k`` all of them are returned once every leaf that holds some is opened.
    The trees see about ``sample_rows`` vectors, the index holds all.
    """
    def ready(df, name):
        one = valid(df).filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
        return stored(one, name)

    rows, asked = ready(embeddings, "vectors"), ready(queries, "queries")
    shape = "query_id bigint, vec_id bigint, score double"
    known = sample(rows, sample_rows)
    if not len(known):
        known = matrix(rows.limit(1).toArrow().column("embedding"))
    if not len(known):
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    shared = rows.sparkSession.sparkContext.broadcast(build(known, k=k, recall=recall))

    def cells(of):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    found = of(shared.value, matrix(batch.column("embedding")))
                    yield pa.RecordBatch.from_arrays([
                        batch.column("vec_id"), batch.column("embedding"),
                        lists(pa.array(np.concatenate(found), pa.int64()), [len(x) for x in found])],
                        ["vec_id", "embedding", "cells"])
        return run

    filed = rows.mapInArrow(cells(lambda forest, x: list(forest.file(x))),
                            "vec_id bigint, embedding array<double>, cells array<bigint>")
    opened = asked.mapInArrow(cells(lambda forest, x: [np.array(forest.open(row)) for row in x]),
                              "vec_id bigint, embedding array<double>, cells array<bigint>")
    filed, opened = stored(filed, "filed"), stored(opened, "opened")
    residents = filed.select(F.explode("cells").alias("cell"), F.col("vec_id").alias("id"), "embedding",
                             F.col("vec_id").alias("salt"))
    visits = opened.select(F.explode("cells").alias("cell"), F.col("vec_id").alias("query_id"), "embedding",
                           F.col("vec_id").alias("salt"))
    near = blocks(residents, visits.withColumn("id", F.col("query_id")), size=BLOCK).groupBy(
        "cell", "rb", "vb").applyInArrow(lambda table: _rank(table, k), shape)
    once = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
