"""Vectors compressed to a few code numbers, in whole numbers throughout (operator 11).

A vector is cut into parts; each part position has a codebook, and a part is coded by its
nearest entry. Codebooks are trained over all vectors by rounds of assigning and averaging.

The distinct parts of a batch, sorted, are the leaves of a trie with one component per level.
It is gone through depth first, a run of leaves at a time: a node's distances to all entries,
over the components so far, are its parent's plus one squared difference, so parts that start
alike share that work, and each path goes on where the run before left it. Leaves take the
nearest entry and add up their components, as often as their part stands in the batch. Tasks
hand on sums per entry, so nothing but codebooks is collected, whatever the table's size.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.storage import importable, lists, stored, text_batches, with_keys
from tracklens.llm.vectors import matrix

LEAVES = 256    # of the trie, gone through together
LIMIT = 1 << 30  # of a component's whole number


def whole() -> Column:
    """False for vectors that are null or empty, or hold null or non-finite components."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & (F.size(vector) > 0), F.lit(False))


def scaled(embeddings: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, row): components as whole numbers floor(scale * x), 32 bits each."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.floor(scale * matrix(batch.column("embedding")))
            if np.abs(values).max() >= LIMIT:
                raise ValueError(f"a component times {scale} needs more than 31 bits")
            rows = values.astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([x.tobytes() for x in rows], pa.binary())],
                ["vec_id", "label", "row"])

    kind = embeddings.schema["label"].dataType.simpleString()
    return embeddings.filter(whole()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "label",
        F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        run, f"vec_id bigint, label {kind}, row binary")


def unpacked(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers; all vectors must have one length."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<i4").reshape(len(rows), -1).astype(np.int64)


def cuts(width: int, parts: int) -> list[slice]:
    """Consecutive parts of equal width; where ``parts`` doesn't divide it, earlier ones are wider by one."""
    edges = np.cumsum([0] + [width // parts + (k < width % parts) for k in range(parts)]).tolist()
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


class Trie:
    """The distinct rows of a batch in lexicographic order, as paths of a trie."""

    def __init__(self, rows: np.ndarray):
        order = np.lexsort(rows.T[::-1]) if rows.shape[1] else np.arange(len(rows))
        ordered = rows[order]
        differs = ordered[1:] != ordered[:-1]
        width = rows.shape[1]
        # the first component in which a row leaves the path of the one before; ``width`` for a repeat
        branch = np.where(differs.any(axis=1), differs.argmax(axis=1) if width else 0, width)
        branch = np.concatenate(([0], branch)) if len(rows) else branch
        first = (branch < width) | (np.arange(len(branch)) == 0)
        self.leaves, self.branch = ordered[first], branch[first]
        leaf = np.cumsum(first) - 1
        self.weight = np.bincount(leaf, minlength=len(self.leaves))
        self.leaf = np.empty(len(rows), np.int64)  # of each row
        self.leaf[order] = leaf

    def nearest(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each leaf the lowest of its nearest entries, and the squared distance to it."""
        n, width = self.leaves.shape
        largest = max(int(np.abs(x).max(initial=0)) for x in (self.leaves, codes))
        if (bound := 4 * largest * largest * max(width, 1)) >= 1 << 62:
            raise ValueError("squared distances need more than 62 bits")
        kind = np.int32 if bound < 1 << 31 else np.int64
        leaves, columns = self.leaves.astype(kind), np.ascontiguousarray(codes.T, kind)
        chosen, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
        path = np.zeros((width + 1, len(codes)), kind)  # distances along the path last gone, by depth
        own, parents = (np.empty((min(n, LEAVES) + 1, len(codes)), kind) for _ in range(2))
        for at in range(0, n, LEAVES):
            run, branch = leaves[at:at + LEAVES], self.branch[at:at + LEAVES]
            parents[0] = path[0]
            above = np.zeros(len(run), np.int64)  # each row's node one level up; 0 is the path's
            for depth in range(width):
                new = np.flatnonzero(branch <= depth)
                nodes = own[1:len(new) + 1]
                np.subtract(run[new, depth, None], columns[depth], out=nodes)
                nodes *= nodes
                nodes += parents[above[new]]
                own[0] = path[depth + 1]
                path[depth + 1] = own[len(new)]
                above = np.cumsum(branch <= depth)
                own, parents = parents, own
            ends = parents[above]
            chosen[at:at + len(run)] = ends.argmin(axis=1)
            error[at:at + len(run)] = ends[np.arange(len(run)), chosen[at:at + len(run)]]
        return chosen, error


def _sums(vectors: DataFrame, books: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per part: how many parts each entry is nearest to, and the sums of their components."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = shared.value
        counts = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros(book.shape, np.int64) for book in books]
        for batch in text_batches(batches, "row"):
            rows = unpacked(batch.column("row"))
            for k, cut in enumerate(cuts(rows.shape[1], len(books))):
                trie = Trie(rows[:, cut])
                chosen, _ = trie.nearest(books[k])
                counts[k] += np.bincount(chosen, trie.weight, len(books[k])).astype(np.int64)
                np.add.at(sums[k], chosen, trie.leaves * trie.weight[:, None])
        for k, (count, total) in enumerate(zip(counts, sums, strict=True)):
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(used), k)), pa.array(used), pa.array(count[used]),
                lists(pa.array(total[used].ravel()), [total.shape[1]] * len(used))],
                ["part", "entry", "n", "total"])

    found = vectors.select("row").mapInArrow(run, "part bigint, entry bigint, n bigint, total array<bigint>")
    each = found.select("part", "entry", F.posexplode(F.concat(F.array("n"), F.col("total"))).alias("place", "x"))
    # as many rows as the codebooks have numbers, whatever the table's size
    table = each.groupBy("part", "entry", "place").agg(F.sum("x").alias("x")).toArrow()
    part, entry, place, x = (table.column(c).to_numpy() for c in ("part", "entry", "place", "x"))
    whole_ = [np.zeros((len(book), book.shape[1] + 1), np.int64) for book in books]
    for k, one in enumerate(whole_):
        mine = part == k
        one[entry[mine], place[mine]] = x[mine]
    return [x[:, 0] for x in whole_], [x[:, 1:] for x in whole_]


def train(vectors: DataFrame, *, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """Codebooks over all rows of ``vectors`` (vec_id, row), none for an empty table."""
    start = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "row").limit(entries).select("row").toArrow()
    if not start.num_rows:
        return []
    rows = unpacked(start.column("row"))
    books = [rows[:, cut] for cut in cuts(rows.shape[1], parts)]
    for _ in range(rounds):
        counts, sums = _sums(vectors, books)
        books = [np.where(n[:, None] > 0, total // np.maximum(n, 1)[:, None], book)
                 for n, total, book in zip(counts, sums, books, strict=True)]
    return books


def digest(books: list[np.ndarray]) -> str:
    """Of all numbers of all entries, part by part."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def coded(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of each row; one pass, no shuffle."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = shared.value
        digits = max(2, *(len(f"{len(book) - 1:x}") for book in books)) if books else 2
        for batch in text_batches(batches, "row"):
            rows = unpacked(batch.column("row"))
            error, codes = np.zeros(len(rows), np.int64), []
            for k, cut in enumerate(cuts(rows.shape[1], len(books))):
                trie = Trie(rows[:, cut])
                chosen, far = trie.nearest(books[k])
                codes.append([f"{x:0{digits}x}" for x in chosen[trie.leaf].tolist()])
                error += far[trie.leaf]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), pa.array(list(map("".join, zip(*codes))), pa.string()),
                pa.array(error)], ["vec_id", "label", "code", "error"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id bigint, label {kind}, code string, error bigint")


def compressed(embeddings: DataFrame, *, parts: int = 4, entries: int = 256, rounds: int = 4,
               scale: int = 1024) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for the rows of ``embeddings`` (vec_id, embedding, label).

    A vector that is null or empty, or holds null or non-finite components, is dropped. The
    others, all of one length, become whole numbers floor(scale * x); one of 2^30 or more is
    an error. Codebooks start as the parts of the ``entries`` smallest vec_ids (null vec_ids
    come last, equal ones in the order of their vectors) and take ``rounds`` rounds over all
    rows: each part goes to its nearest entry, ties to the lower one, and each entry becomes
    the rounded-down mean of its parts; unused ones stay. ``code`` has each part's entry in
    hexadecimal, two digits or as many as the largest needs. ``error`` is the squared distance
    left, ``label_error`` its sum over rows of an equal label, null labels together.
    Repeated rows count each time. Other columns play no part. Without rows there is no result.
    """
    importable(embeddings.sparkSession)
    vectors = stored(scaled(embeddings, scale), "scaled")
    books = train(vectors, parts=parts, entries=entries, rounds=rounds)
    codes = stored(coded(vectors, books), "codes")
    # a label in a struct, so that null ones join
    codes = codes.withColumn("_label", F.struct("label"))
    sums = stored(codes.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")), "labels")
    found = with_keys(codes, sums, "_label")
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def statement(table: str = "embeddings", *, parts: int = 4, entries: int = 256, rounds: int = 4,
              scale: int = 1024) -> str:
    """The same in DuckDB's SQL, by plain comparison of all parts with all entries."""
    near = """near{r} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(e, d * {entries} + e) AS e, min(d) AS d, any_value(c) AS c FROM (
    SELECT a.vec_id, a.p, a.c, b.e, CAST(list_inner_product(a.c, a.c) - 2 * list_inner_product(a.c, b.c)
      + list_inner_product(b.c, b.c) AS BIGINT) AS d FROM cut a JOIN book{r} b USING (p)) GROUP BY vec_id, p)"""
    book = """means{r} AS (
  SELECT p, e, list(x ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(c[i]) / count(*)) AS x FROM near{r}, range(1, {width} + 1) t(i)
    WHERE i <= len(c) GROUP BY p, e, i) GROUP BY p, e),
book{s} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN means{r} m USING (p, e))"""
    steps = []
    for r in range(rounds):
        steps += [near.format(r=r, entries=entries),
                  book.format(r=r, s=r + 1, width="(SELECT max(len(v)) FROM kept)")]
    steps.append(near.format(r=rounds, entries=entries))
    return f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM {table}
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS c FROM kept, range({parts}) t(p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, c FROM cut
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})),
{", ".join(steps)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id),
numbers AS (
  SELECT sha256(string_agg(list_aggregate(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), 'string_agg', ','), ','
    ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), numbers"""
