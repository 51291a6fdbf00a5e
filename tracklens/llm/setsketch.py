"""Near-duplicate documents by SetSketch registers (operator 5).

A document's set holds the hashes of its distinct word shingles. Each element is the start of
its own Poisson process of points, rising by exponential steps, and each point falls on a
register; a register's minimum ``x`` over the set is kept as ``floor(1 - log_b(x))``: a
truncated minimum on an exponential scale. An element is left once its next point lies above
every register's minimum, so most are after a step or two. Registers merge by maximum, and two
sets agree in a register with a chance of about ``log_b(1 + J (b - 1))``. Bands of register
values give candidates; the likelihood of both sketches together rules out pairs that are
far below the threshold; the rest is confirmed on full sets.

Equal sets are one class from the start. Inside a bucket no pairs are formed as long as a
few links hold it together: every member is compared with some first ones of its buckets, and
those that stay apart with others in turn. What then remains in different components is
compared in full: sketches in blocks of bounded size first, then the full sets of those that
have a plausible partner, so no link inside a bucket is lost and no pairs are written.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.graph import components
from tracklens.llm.storage import encoded, importable, stored, text_batches, with_keys
from tracklens.llm.vectors import blocks
from tracklens.llm.words import mix, shingle_hashes, word_hashes

BASE, RATE, TOP = 1.2, 20.0, 254  # of the register scale; a register fits a byte
BANDS, ROWS = 48, 8               # a pair at 0.8 shares no band with a chance of 3e-5
DOUBT = 12.0                      # log likelihood below the maximum at which a pair is given up: a chance of 5e-7
TAG = 255                         # bits of a bucket's key that tell its band
CELLS = 1 << 16                   # registers filled together
PAIRS = 20_000                    # pairs of sketches looked at together in a task
FIRST = 3                         # members that each one is compared with at first
BLOCK = 4 << 20                   # bytes of sketches, and of a quarter of the sets, on one side of a block
MOST_BITS = 27                    # log of the bits that tell which documents' sets are wanted

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 24) - 1)


def _minima(state: np.ndarray, owner: np.ndarray, n: int, m: int) -> np.ndarray:
    """The least point on each of ``m`` registers of ``n`` sets, given all their elements."""
    least = np.full((n, m), np.inf)
    flat, x, step = least.reshape(-1), np.zeros(len(state)), 0
    while len(state):
        state = state + _STEP
        drawn = mix(state)
        x = x - np.log(((drawn >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40) / (m * RATE)
        slot = ((drawn & _LOW) * np.uint64(m) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(flat, owner * m + slot, x)
        step += 1
        if step % max(1, step // 4) == 0:
            left = owner[np.flatnonzero(np.diff(owner, prepend=-1))]
            limit = np.zeros(n)
            limit[left] = least[left].max(axis=1)
            going = x < limit[owner]
            state, x, owner = state[going], x[going], owner[going]
    return least


def registers(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Sketches of non-empty sets of hashes, ``m`` bytes each."""
    out = np.empty((len(sets), m), np.uint8)
    sizes = np.array(list(map(len, sets)), np.int64)
    order, together = np.argsort(sizes, kind="stable"), max(1, CELLS // m)
    for at in range(0, len(order), together):  # sets of like sizes take a like number of steps
        rows = order[at:at + together]
        least = _minima(np.concatenate([sets[r] for r in rows]), np.repeat(np.arange(len(rows)), sizes[rows]),
                        len(rows), m)
        out[rows] = np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP + 1)
    return out


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log(np.clip(1 - x * (BASE - 1) / BASE, 1e-300, 1.0)) / np.log(BASE)


def likelihood(jaccard, n_a, n_b, above, below, equal) -> np.ndarray:
    """Log likelihood of a similarity, given set sizes and how registers compare."""
    u = n_a / (n_a + n_b)
    more, less = _chance(u - (1 - u) * jaccard), _chance(1 - u - u * jaccard)
    tiny = 1e-12
    return (above * np.log(np.maximum(more, tiny)) + below * np.log(np.maximum(less, tiny))
            + equal * np.log(np.maximum(1 - more - less, tiny)))


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
             threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of the greatest joint likelihood per pair, and how far the threshold is below it.

    ``a``, ``b``: registers, a row for each pair. The second value is 0 where the estimate
    reaches the threshold.
    """
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    given = (n_a, n_b, above, below, equal)
    low, high = np.zeros(len(a)), np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    for _ in range(40):
        left, right = low + (high - low) / 3, high - (high - low) / 3
        better = likelihood(left, *given) < likelihood(right, *given)
        low, high = np.where(better, left, low), np.where(better, high, right)
    best = (low + high) / 2
    gap = likelihood(best, *given) - likelihood(np.full(len(a), threshold), *given)
    return best, np.where(best >= threshold, 0.0, gap)


def sketches(docs: DataFrame, *, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_hash, registers); the last two are null without words."""
    def run(batches):
        for batch in text_batches(batches, most=4 << 20):
            hashes, counts = word_hashes([x.lower() for x in encoded(batch)])
            ends = np.cumsum(counts)
            sets = [shingle_hashes(hashes[e - n:e], shingle) for e, n in zip(ends, counts, strict=True)]
            sketch = iter(registers([x for x in sets if len(x)], bands * rows))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(list(map(len, sets)), pa.int64()),
                pa.array([hashlib.sha256(x.tobytes()).digest()[:16] if len(x) else None for x in sets], pa.binary()),
                pa.array([next(sketch).tobytes() if len(x) else None for x in sets], pa.binary())],
                ["doc_id", "n_shingles", "set_hash", "registers"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_hash binary, registers binary")


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that set sizes and the joint likelihood of the sketches don't rule out."""
    a = classes.select(F.col("id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("registers").alias("r_a"))
    b = classes.select(F.col("id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("registers").alias("r_b"))
    sized = (pairs.join(a, "a").join(b, "b")
             .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            width = len(batch.column("r_a")[0].as_py())
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, width)
                    for c in ("r_a", "r_b"))
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b")]
            keep = estimate(a, b, *sizes, percent / 100)[1] <= DOUBT
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    return sized.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, "a bigint, b bigint").distinct()


def _bitmap(ids: DataFrame) -> tuple[np.ndarray, int]:
    """Bits that are set for all of ``ids`` and for few others, 16 MB at most, and the log of their number."""
    size = min(MOST_BITS, max(16, (16 * ids.count()).bit_length()))
    words = ids.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(1 << size))).selectExpr(
        "shiftright(slot, 6) AS word", "shiftleft(1L, CAST(slot & 63 AS int)) AS bit")
    found = words.groupBy("word").agg(F.expr("bit_or(bit) AS bits")).toArrow()
    bits = np.zeros(1 << (size - 6), np.uint64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bits, size


def _full_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles as sorted 64-bit hashes) of the documents named, a row for each of their texts.

    Texts stay where they are read: a bitmap of the ids leaves out most others, and only the
    sets of the rest meet the ids themselves.
    """
    bits, size = _bitmap(ids)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        bits = shared.value
        for batch in text_batches(batches, most=4 << 20):
            slot = batch.column("slot").to_numpy()
            hit = (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
            batch = batch.filter(pa.array(hit.astype(bool)))
            hashes, counts = word_hashes([x.lower() for x in encoded(batch)])
            ends = np.cumsum(counts)
            sets = [shingle_hashes(hashes[e - n:e], shingle).tobytes() for e, n in zip(ends, counts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").filter("id IS NOT NULL")
    texts = texts.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(1 << size)))
    return texts.mapInArrow(run, "id bigint, shingles binary").filter("octet_length(shingles) > 0").join(
        ids, "id", "left_semi")


def _common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements a sorted set shares with each of several."""
    sizes = np.array(list(map(len, others)))
    values = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, values), len(one) - 1)] == values
    return np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)


def _confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough. Texts don't move, only the sets of the pairs."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = stored(_full_sets(docs, ids, shingle).distinct(), "sets")

    def run(batches):
        for batch in batches:
            for part in text_batches(text_batches([batch], "s_a"), "s_b"):
                near = []
                for one, other in zip(*(part.column(c).to_pylist() for c in ("s_a", "s_b")), strict=True):
                    one, other = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
                    both = int(_common(one, [other])[0])
                    near.append(100 * both >= percent * (len(one) + len(other) - both))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).filter(pa.array(near, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("s_b"))
    return (pairs.join(right, "b").join(left, "a").select("a", "b", "s_a", "s_b")
            .mapInArrow(run, "a bigint, b bigint").distinct())


_MEMBER = "cell bigint, band int, rb int, vb int, role string, id bigint, c bigint, n bigint, registers binary"
_BLOCK_KEYS = ["cell", "rb", "vb"]


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _in_blocks(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(table, edges)`` on the rows of whole blocks, many small ones or one large one at a time.

    ``edges`` are the first rows of the blocks and the end; residents come before visitors.
    """
    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            keys = [table.column(c).to_numpy() for c in _BLOCK_KEYS]
            edges = np.flatnonzero(np.any([x[1:] != x[:-1] for x in keys], axis=0)) + 1
            held = table
            if len(edges):
                yield from work(table.slice(0, edges[-1]), np.concatenate(([0], edges))).to_batches()
                held = table.slice(edges[-1])
        if held is not None:
            yield from work(held, np.array([0, held.num_rows])).to_batches()

    # few bytes but much work, so the number of tasks is not left to bytes
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS, "role").mapInArrow(run, schema)


def _plausible_pairs(table: pa.Table, edges: np.ndarray, percent: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of visitors and of residents that may be near, block by block.

    Members of one component need no comparison. The others must fit by size and by the
    likelihood of their sketches. A pair that shares several bands is looked at in the first
    of them, so its other buckets cost next to nothing.
    """
    visitor = pa.compute.equal(table.column("role"), "v").to_numpy()
    sizes, part, band = (table.column(c).to_numpy() for c in ("n", "c", "band"))
    sketch = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint8).reshape(table.num_rows, -1)
    bands = np.arange(sketch.shape[1] // rows)
    block = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    residents = np.bincount(block, ~visitor, len(edges) - 1).astype(np.int64)
    asks = np.flatnonzero(visitor)
    many = residents[block[asks]]
    found, at, upto = [[], []], 0, np.cumsum(many)
    while at < len(asks):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + PAIRS, side="right")))
        v, own = np.repeat(asks[at:end], many[at:end]), many[at:end]
        r = edges[block[v]] + np.arange(len(v)) - np.repeat(np.cumsum(own) - own, own)
        at = end
        fits = (100 * np.minimum(sizes[v], sizes[r]) >= percent * np.maximum(sizes[v], sizes[r])) & (part[v] != part[r])
        v, r = v[fits], r[fits]
        same = (sketch[v] == sketch[r]).reshape(len(v), len(bands), rows).all(axis=2)
        first = ~(same & (bands < band[v][:, None])).any(axis=1)
        v, r = v[first], r[first]
        gap = estimate(sketch[v], sketch[r], sizes[v].astype(np.float64), sizes[r].astype(np.float64), percent / 100)[1]
        found[0].append(v[gap <= DOUBT])
        found[1].append(r[gap <= DOUBT])
    empty = np.empty(0, np.int64)
    return tuple(np.concatenate(x) if x else empty for x in found)


def _members_of_blocks(table: pa.Table, edges: np.ndarray, percent: int, rows: int) -> pa.Table:
    """Members that may be near one of another component across their block."""
    return table.take(pa.array(np.unique(np.concatenate(_plausible_pairs(table, edges, percent, rows)))))


def _links_of_blocks(table: pa.Table, edges: np.ndarray, percent: int, rows: int) -> pa.Table:
    """Links between visitors and residents of a block, one for each visitor and component."""
    v, r = _plausible_pairs(table, edges, percent, rows)
    ids, parts = (table.column(name).to_numpy() for name in ("id", "c"))
    sets, found = table.column("shingles"), []
    for some in np.split(np.argsort(v, kind="stable"), np.flatnonzero(np.diff(np.sort(v))) + 1) if len(v) else []:
        one = np.frombuffer(sets[int(v[some[0]])].as_buffer(), np.uint64)
        others = [np.frombuffer(sets[int(k)].as_buffer(), np.uint64) for k in r[some]]
        both = _common(one, others)
        near = 100 * both >= percent * (len(one) + np.array(list(map(len, others))) - both)
        reached = {parts[k]: ids[k] for k in r[some][near]}
        found += [(ids[v[some[0]]], other) for other in reached.values()]
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _linked_in_blocks(rest: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int,
                      rows: int) -> DataFrame:
    """Links that join components which share a bucket.

    In each bucket all that is apart from its main component meets all members, in blocks of
    bounded bytes: sketches first, then the full sets of members with a plausible partner.
    What leaves a block is at most its members, then its links, never pairs that fail.
    """
    known = classes.join(rest.select("id").distinct(), "id", "left_semi").select(
        "id", F.col("n_shingles").alias("n"), "registers")
    members = rest.groupBy(F.col("key").alias("cell"), "band", "main", "id", "c").agg(F.max("n").alias("n")).withColumn(
        "salt", F.col("id"))
    members = stored(members, "members-of-blocks")
    placed = blocks(members, members.filter("c <> main"), size=BLOCK, weight=2 * F.col("n") + 500)
    met = placed.select("cell", "band", "rb", "vb", "role", "id", "c").join(known, "id")
    near = stored(_in_blocks(met.select(*_names(_MEMBER)), lambda table, edges: _members_of_blocks(
        table, edges, percent, rows), _MEMBER), "plausible")
    sets = stored(_full_sets(docs, stored(near.select("id").distinct(), "ids"), shingle), "sets")
    return _in_blocks(near.join(sets, "id"), lambda table, edges: _links_of_blocks(
        table, edges, percent, rows), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Texts are lower-cased in A-Z only. A text with fewer words than ``shingle`` counts whole
    as one shingle; one without words (or null) has an empty set and is linked with nothing.
    Documents are linked from a Jaccard similarity of ``percent`` hundredths on; the component
    is the smallest doc_id that links reach. Rows that share a doc_id are one document, linked
    as any of its texts is. A row without doc_id is linked with nothing, its component is
    null and it is kept. Other columns play no part.
    """
    importable(docs.sparkSession)
    sketch = stored(sketches(docs, shingle=shingle, bands=bands, rows=rows), "sketches")
    linkable = sketch.filter("set_hash IS NOT NULL AND doc_id IS NOT NULL")
    first = stored(linkable.groupBy("set_hash").agg(F.min("doc_id").alias("id"), F.count("*").alias("_n")), "sets-first")
    # on both keys, so that the copies of one text don't meet in one task
    classes = linkable.join(first.select("set_hash", F.col("id").alias("doc_id")), ["set_hash", "doc_id"]).dropDuplicates(
        ["set_hash", "doc_id"])
    classes = stored(classes.select(F.col("doc_id").alias("id"), "n_shingles", "registers"), "classes")

    # the low bits of a key are its band
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("registers", k * rows + 1, rows)).bitwiseAND(F.lit(~TAG)).bitwiseOR(
        F.lit(k)) for k in range(bands)])
    dealt = classes.select(F.explode(keys).alias("key"), "id", F.col("n_shingles").alias("n")).repartition(
        "key")  # one shuffle for both uses
    buckets = dealt.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z"), F.count("*").alias("n"),
                                       F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sum")).filter("a < z")
    # of buckets with the same members the one of the first band stands for all
    buckets = buckets.groupBy("a", "z", "n", "sum").agg(
        F.min(F.struct(F.col("key").bitwiseAND(F.lit(TAG)).alias("band"), "key")).alias("x")).select("x.key", "a", "x.band")
    members = stored(dealt.join(buckets, "key").select("key", "id", "n", "a", F.col("band").cast("int").alias("band")),
                     "members")

    def links_of(pairs: DataFrame) -> DataFrame:
        plausible = stored(_plausible(pairs, classes, percent), "plausible")
        return stored(_confirmed(plausible, docs, shingle, percent), "links")

    near = members.filter("a <> id").groupBy("id").agg(
        F.slice(F.sort_array(F.collect_set("a")), 1, FIRST).alias("a"))
    links = links_of(near.select(F.explode("a").alias("a"), F.col("id").alias("b")))
    # a doc_id of several texts hangs them together
    several = linkable.groupBy("doc_id").agg(F.min(F.xxhash64("set_hash")).alias("a"), F.max(F.xxhash64("set_hash")).alias("z"))
    own = linkable.join(several.filter("a < z").select("doc_id"), "doc_id", "left_semi").join(first, "set_hash")
    links = stored(links.union(own.select(F.col("id").alias("a"), F.col("doc_id").alias("b")).filter("a <> b")), "links")
    most = 4 * max(members.count(), 10_000)
    labels, n_links, tries = components(links, "a", "b"), links.count(), 0
    while True:
        placed = members.join(labels, members.id == labels.v, "left").select(
            "key", "band", "id", "n", F.coalesce("u", "id").alias("c"))
        sizes = placed.groupBy("key", "c").agg(
            F.count("*").alias("n"), F.min_by("id", F.xxhash64(F.lit(tries), "id")).alias("other"))
        split = sizes.groupBy("key").agg(F.max(F.struct("n", "c", "other")).alias("main"), F.sum("n").alias("total"),
                                         F.count("*").alias("parts")).filter("parts > 1")
        split = stored(split.select("key", F.col("main.c").alias("main"), "main.other", "total"), "split")
        # a bucket's main component is often nearly all of it, so only what is apart from it leaves the join
        apart = stored(placed.join(split, "key").filter("c <> main").select("key", "id", "other", "total"), "apart")
        work = apart.agg(F.sum("total")).first()[0] or 0
        if not work:
            break
        exact = work <= most or tries == 6
        if exact:
            rest = stored(placed.join(split.select("key", "main"), "key"), "rest")
            more = stored(_linked_in_blocks(rest, classes, docs, shingle, percent, rows), "links")
        else:
            more = links_of(apart.groupBy("id").agg(
                F.min_by("other", F.xxhash64(F.lit(tries), "key")).alias("a")).select("a", F.col("id").alias("b")))
        found = more.count()
        if found:
            links = links.union(more)
            labels = components(labels.select(F.col("u").alias("a"), F.col("v").alias("b")).union(more), "a", "b")
        n_links += found
        tries = tries + 1 if found * 50 > n_links else 6
        if exact:
            break

    reached = first.join(labels, first.id == labels.v, "left").select(
        "set_hash", F.coalesce("u", "id").alias("component_id"), "_n")
    linked = with_keys(linkable.select("doc_id", "n_shingles", "set_hash"), reached, "set_hash").select(
        "doc_id", "n_shingles", "component_id")
    alone = sketch.filter("set_hash IS NULL OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
