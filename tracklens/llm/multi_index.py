"""Near-duplicate vectors by an inverted multi-index (operator 3).

Codebooks for the two halves of the vectors are trained independently; a pair of codewords
is a cell of the product grid. Every vector lives in one cell and visits the cells nearest
to it, in the order of the multi-sequence traversal, as many as a calibration finds
necessary for the target recall; the vectors met are compared exactly. A link is found if
either end visits the other. Since each vector knows which cells the other visits, every
link is counted once on each side without writing pairs down.
"""

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.graph import components
from tracklens.llm.storage import importable, lists, stored, with_keys
from tracklens.llm.vectors import blocks, matrix, sample, takes_part, valid

SAMPLE = 20_000     # vectors that codebooks and calibration see, at most about
PER_CELL = 200      # vectors wanted in a cell
MOST_CODES = 1024   # codewords for a half
BLOCK = 1024        # residents or visitors compared at once
PROBES = 400        # vectors in the calibration


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def squares(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances of rows to codewords."""
    return np.maximum((rows**2).sum(1)[:, None] - 2 * rows @ codes.T + (codes**2).sum(1), 0)


def codebook(rows: np.ndarray, size: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Lloyd's algorithm from distinct starting rows; empty codewords keep their place."""
    distinct = np.unique(rows, axis=0)
    codes = np.random.default_rng(seed).permutation(distinct)[:size].copy()
    for _ in range(rounds):
        nearest = squares(rows, codes).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(codes))
        for k in np.flatnonzero(count):
            codes[k] = rows[nearest == k].mean(axis=0)
    return codes


def traversal(near: np.ndarray, far: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Cells of the grid by growing sum of the two halves' distances, ``most`` of them."""
    first, second = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
    heap, out, pushed = [(near[first[0]] + far[second[0]], 0, 0)], [], {(0, 0)}
    while heap and len(out) < most:
        _, i, j = heapq.heappop(heap)
        out.append((int(first[i]), int(second[j])))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(first) and b < len(second) and (a, b) not in pushed:
                pushed.add((a, b))
                heapq.heappush(heap, (near[first[a]] + far[second[b]], a, b))
    return out


def rank(near: np.ndarray, far: np.ndarray, i: int, j: int) -> int:
    """How many cells the traversal has visited once it comes to (i, j), equally far ones counted before it.

    Takes one search per codeword, so calibrating needs no list of the grid's cells.
    """
    before = np.searchsorted(np.sort(far), near[i] + far[j] - near, side="right")
    before[i] = (far <= far[j]).sum()  # unharmed by rounding
    return int(before.sum())


@dataclass
class Index:
    """Codebooks of both halves, and how many cells a vector visits."""

    codes: tuple[np.ndarray, np.ndarray]
    visits: int

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = self.codes[0].shape[1]
        return squares(rows[:, :width], self.codes[0]), squares(rows[:, width:], self.codes[1])

    def cells(self, rows: np.ndarray, most: int | None = None) -> np.ndarray:
        """Visited cells of each row, nearest first; the first is the row's own."""
        near, far = self.halves(rows)
        n = len(self.codes[1])
        most = min(most or self.visits, len(self.codes[0]) * n)
        return np.array([[i * n + j for i, j in traversal(a, b, most)] for a, b in zip(near, far, strict=True)],
                        np.int64).reshape(len(rows), most)


def build(rows: np.ndarray, total: int, *, cosine: float, recall: float, seed: int = 3) -> Index:
    """Fit codebooks on a sample and calibrate the number of visits.

    The probes are sample vectors with a made neighbour at exactly the threshold, the hardest
    case of a link. The visits suffice for the share ``recall`` of them from one side alone.
    """
    rows = unit(rows)
    width = max(1, rows.shape[1] // 2)
    size = int(np.clip(2 ** round(np.log2(max(1.0, total / PER_CELL)) / 2), 1, MOST_CODES))
    right = rows[:, width:] if rows.shape[1] > width else np.zeros((len(rows), 0))
    index = Index((codebook(rows[:, :width], size), codebook(right, size) if right.size else np.zeros((1, 0))), 1)
    rng = np.random.default_rng(seed)
    probes = rows[rng.permutation(len(rows))[:PROBES]]
    away = rng.normal(size=probes.shape)
    away -= (away * probes).sum(1, keepdims=True) * probes
    away /= np.maximum(np.sqrt((away**2).sum(1, keepdims=True)), 1e-12)
    others = cosine * probes + np.sqrt(1 - cosine**2) * away
    homes = index.cells(others, 1)[:, 0]
    ranks = [rank(near, far, *divmod(int(home), len(far))) for near, far, home in zip(*index.halves(probes), homes)]
    index.visits = int(np.quantile(ranks, recall, method="higher"))
    return index


def _located(classes: DataFrame, index: Index, kind: str) -> DataFrame:
    """Visited cells of each class; vectors go along as they were given, ``kind`` bytes a component."""
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        index = shared.value
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column("embedding"))
                cells = index.cells(unit(rows))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), batch.column("weight"), pa.array([x.tobytes() for x in rows.astype(kind)], pa.binary()),
                    lists(pa.array(cells.ravel()), [cells.shape[1]] * len(cells))],
                    ["id", "weight", "vector", "visited"])

    return classes.select("id", "weight", "embedding").mapInArrow(
        run, "id bigint, weight bigint, vector binary, visited array<bigint>")


def _compare(table: pa.Table, cosine: float, kind: str) -> pa.Table:
    """Partial link counts of one block, and for each vector the smallest one it hangs together with."""
    role = np.array(table.column("role").to_pylist())
    ids, weight = (table.column(c).to_numpy() for c in ("id", "weight"))
    raw = table.column("vector").to_pylist()
    vectors = unit(np.frombuffer(b"".join(raw), kind).astype(np.float64).reshape(len(raw), -1))
    r, v = np.flatnonzero(role == "r"), np.flatnonzero(role == "v")
    out = {name: [] for name in ("id", "links", "root")}
    if len(r) and len(v):
        near = vectors[v] @ vectors[r].T >= cosine
        near &= ids[v][:, None] != ids[r][None, :]
        visited = matrix(table.column("visited").combine_chunks().take(pa.array(r))).astype(np.int64)
        home = np.array([x[0] for x in table.column("visited").take(pa.array(v)).to_pylist()])
        kinds, kind = np.unique(home, return_inverse=True)
        back = np.stack([(visited == k).any(axis=1) for k in kinds])[kind]
        found = np.zeros(len(ids), np.int64)
        np.add.at(found, v, near @ weight[r])
        np.add.at(found, r, (near & ~back).T @ weight[v])
        nodes, place = np.unique(ids, return_inverse=True)
        root = np.arange(len(nodes))
        a, b = np.nonzero(near)
        a, b = place[v[a]], place[r[b]]
        while True:
            low = np.minimum(root[a], root[b])
            after = root.copy()
            np.minimum.at(after, a, low)
            np.minimum.at(after, b, low)
            after = after[after]
            if np.array_equal(after, root):
                break
            root = after
        sums = np.bincount(place, found, len(nodes)).astype(np.int64)
        hit = sums.astype(bool) | (root != np.arange(len(nodes)))
        out = {"id": nodes[hit], "links": sums[hit], "root": nodes[root[hit]]}
    return pa.table({k: pa.array(x, pa.int64()) for k, x in out.items()})


def near_duplicates(embeddings: DataFrame, *, cosine: float = 0.9, recall: float = 0.95,
                    sample_rows: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``embeddings`` (vec_id, embedding).

    Vectors are linked from a cosine of ``cosine`` on, in double precision. ``n_links`` counts
    other rows, copies included. The component is the smallest vec_id that links reach. A
    vector that is null, zero or has null or non-finite components is linked with nothing. A
    row without vec_id is linked with nothing, its component is null and it is kept. All
    vectors have one length. Rows that share a vec_id count as one vector once they are equal;
    different ones of one vec_id stay apart in counting and are one node of the components.
    Codebooks and calibration see about ``sample_rows`` vectors, the index holds all.
    """
    importable(embeddings.sparkSession)
    taking = stored(valid(embeddings).filter("vec_id IS NOT NULL"), "vectors")
    classes = taking.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    classes = stored(classes.select("id", "weight", "embedding"), "vector-classes")
    n = classes.count()
    labels = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    if not n:
        return labels.select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                             F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    rows = sample(classes.withColumnRenamed("id", "vec_id"), sample_rows)
    if not len(rows):
        rows = matrix(classes.limit(1).toArrow().column("embedding"))
    index = build(rows, n, cosine=cosine, recall=recall)
    single = embeddings.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = "<f4" if single else "<f8"  # single precision loses nothing of what came in it
    located = stored(_located(classes, index, kind), "located")
    residents = located.select(F.element_at("visited", 1).alias("cell"), "id", "weight", "vector", "visited",
                               F.col("id").alias("salt"))
    visits = located.select(F.explode("visited").alias("cell"), "id", "weight", "vector",
                            F.slice("visited", 1, 1).alias("visited"), F.col("id").alias("salt"))
    met = blocks(residents, visits, size=BLOCK).groupBy("cell", "rb", "vb").applyInArrow(
        lambda table: _compare(table, cosine, kind), "id bigint, links bigint, root bigint")
    met = stored(met, "met")
    counted = met.groupBy("id").agg(F.sum("links").alias("links"))
    reached = components(met, "id", "root")
    found = classes.join(counted, "id", "left").join(reached, classes.id == reached.v, "left").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("u", "id").alias("component_id"), F.col("weight").alias("_n"))
    linked = with_keys(taking, stored(found, "found"), "embedding").select("vec_id", "n_links", "component_id")
    alone = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), takes_part().alias("takes")).filter(
        "vec_id IS NULL OR NOT takes").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
