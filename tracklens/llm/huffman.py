"""Token ids in length-limited canonical Huffman code (operator 4).

File format: one Parquet folder with two tables.

``code``   id, length: bits of each id's code word; words are canonical (shorter first, then
           by id), so lengths say all.
``blocks`` part, offset (ids before the block in its part), doc_ids and n_tokens of its
           documents, bits (the code words of all its ids, most significant
           bit first), checkpoints (bit offset of every ``EVERY``-th id).

Parts follow each other in ascending doc_id order, and so do documents within them. A block
holds whole documents and can be read alone, from any of its checkpoints.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklens.llm.storage import encoded, importable, stored, text_batches
from tracklens.llm.token_ids import word_encoder

LIMIT = 20          # bits of a code word, at most
EVERY = 512         # ids between checkpoints
BLOCK = 1 << 16     # ids in a block, at least, but for the last of a task
PART = 1 << 24      # ids in a part, about


def lengths(counts: dict[int, int], limit: int = LIMIT) -> dict[int, int]:
    """Code word lengths of the least total size among those of at most ``limit`` bits.

    Package-merge: ``limit`` times, neighbouring pairs of the cheapest items become packages
    that compete with the single ids; an id's length is the number of chosen items it is in.
    """
    if len(counts) < 2:
        return dict.fromkeys(counts, 1)
    if len(counts) > 1 << limit:
        raise ValueError(f"{len(counts)} ids need more than {limit} bits")
    ids = sorted(counts, key=lambda x: (counts[x], x))
    weight = np.array([counts[x] for x in ids], np.float64)
    # an item is a single id, or the pair (2k, 2k + 1) of the level below
    levels, packed = [], np.empty(0)
    for _ in range(limit):
        both = np.concatenate([weight, packed])
        single = np.concatenate([np.ones(len(weight), bool), np.zeros(len(packed), bool)])
        order = np.argsort(both, kind="stable")
        levels.append(single[order])
        merged = both[order]
        merged = merged[:len(merged) // 2 * 2]
        packed = merged[::2] + merged[1::2]
    size, take = np.zeros(len(ids), np.int64), 2 * len(ids) - 2
    for single in reversed(levels):
        n = int(single[:take].sum())
        size[:n] += 1
        take = 2 * (take - n)
    return {x: int(n) for x, n in zip(ids, size, strict=True)}


class Code:
    """Tables for encoding and decoding from the lengths of code words."""

    def __init__(self, ids: np.ndarray, size: np.ndarray):
        order = np.lexsort((ids, size))
        self.ids, self.size = ids[order].astype(np.int64), size[order].astype(np.int64)
        self.top = int(self.size.max()) if len(size) else 1
        span = np.int64(1) << (self.top - self.size)
        starts = np.cumsum(span) - span
        self.word_of = np.zeros(int(self.ids.max()) + 1 if len(ids) else 1, np.uint64)
        self.size_of = np.zeros(len(self.word_of), np.int64)
        self.word_of[self.ids] = (starts >> (self.top - self.size)).astype(np.uint64)
        self.size_of[self.ids] = self.size
        self.table_id = np.zeros(1 << self.top, np.uint32)
        self.table_size = np.ones(1 << self.top, np.uint8)
        used = int(span.sum())
        self.table_id[:used] = np.repeat(self.ids, span)
        self.table_size[:used] = np.repeat(self.size, span)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of the ids, and the bit offset of every ``EVERY``-th."""
        size = self.size_of[ids]
        ends = np.cumsum(size)
        starts = ends - size
        total = int(ends[-1]) if len(ends) else 0
        shift = (64 - (starts & 31) - size).astype(np.uint64)
        value = self.word_of[ids] << shift
        cell = starts >> 5
        n = (total >> 5) + 2
        words = np.bincount(cell, (value >> np.uint64(32)).astype(np.float64), n)
        words[1:] += np.bincount(cell, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n)[:-1]
        return words.astype(np.uint32).astype(">u4").tobytes(), starts[::EVERY].astype(np.int64)

    def unpack(self, bits: list[bytes], counts: np.ndarray, checkpoints: list[np.ndarray]) -> list[np.ndarray]:
        """Ids of several blocks, all of their checkpoints read on side by side."""
        offsets = np.cumsum([0, *(len(x) * 8 for x in bits)])
        raw = np.frombuffer(b"".join(bits) + b"\0" * 8, np.uint8).astype(np.uint64)
        at = np.concatenate([c + o for c, o in zip(checkpoints, offsets, strict=False)] or [np.empty(0, np.int64)])
        left = np.concatenate([np.minimum(EVERY, n - EVERY * np.arange(len(c)))
                               for n, c in zip(counts, checkpoints, strict=True)] or [np.empty(0, np.int64)])
        out = np.zeros((len(at), EVERY), np.uint32)
        by = np.argsort(-left, kind="stable")
        at, left = at[by], left[by]
        keep = np.uint64((1 << self.top) - 1)
        for step in range(EVERY):
            n = int(np.searchsorted(-left, -step))  # lanes with more than ``step`` ids
            if not n:
                break
            byte = at[:n] >> 3
            window = raw[byte] << np.uint64(24)
            for k in (1, 2, 3):
                window |= raw[byte + k] << np.uint64(24 - 8 * k)
            shift = (32 - self.top - (at[:n] & 7)).astype(np.int64)
            key = (window >> shift.astype(np.uint64)) & keep
            out[:n, step] = self.table_id[key]
            at[:n] += self.table_size[key]
        back = np.empty_like(by)
        back[by] = np.arange(len(by))
        out, ids, lane = out[back], [], 0
        for n, c in zip(counts, checkpoints, strict=True):
            ids.append(out[lane:lane + len(c)].ravel()[:n])
            lane += len(c)
        return ids


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, mark, n_tokens, ids) where the texts lie; ids in the encoder's width, ``mark`` a hash of the text."""
    def run(batches):
        encoder = word_encoder(path)
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in text_batches(batches):
            ids = [x + end for x in encoder.encode(encoded(batch))]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("mark"), pa.array([len(x) // len(end) for x in ids], pa.int64()),
                pa.array(ids, pa.binary())], ["doc_id", "mark", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text").mapInArrow(
        run, "doc_id bigint, mark bigint, n_tokens bigint, ids binary")


def counted(tokens: DataFrame, width: str) -> DataFrame:
    """(id, n): how often each id stands in the whole table."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), width))
            if len(found) > len(total):
                found[:len(total)] += total
                total = found
            else:
                total[:len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


_BLOCK = ("part int, offset bigint, doc_ids array<bigint>, n_tokens array<bigint>, bits binary, "
          "checkpoints array<bigint>")


def _blocks(tokens: DataFrame, code, width: str) -> DataFrame:
    """Blocks of the rows of each task, in their order."""
    numbers = pa.list_(pa.int64())
    kinds = {"part": pa.int32(), "offset": pa.int64(), "doc_ids": numbers, "n_tokens": numbers,
             "bits": pa.binary(), "checkpoints": numbers}

    def block(part, offset, rows):
        docs, sizes, raw = zip(*rows, strict=True)
        bits, checkpoints = code.value.pack(np.frombuffer(b"".join(raw), width))
        made = (part, offset, docs, sizes, bits, checkpoints.tolist())
        return pa.RecordBatch.from_arrays(
            [pa.array([x], kind) for x, kind in zip(made, kinds.values(), strict=True)], list(kinds))

    def run(batches):
        part, offset, rows, n = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if n >= BLOCK:
                    yield block(part, offset, rows)
                    offset, rows, n = offset + n, [], 0
                rows.append(row)
                n += row[1]
        if rows:
            yield block(part, offset, rows)

    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(run, _BLOCK)


def write_ids(docs: DataFrame, path: str, *, tokenizer: str, end_id: int, limit: int = LIMIT) -> None:
    """Tokenize whole texts of ``docs`` (doc_id, text) and write them to ``path`` in the file format.

    ``tokenizer`` is a file of the tokenizers library (see :mod:`token_ids` for which). Each
    document ends with ``end_id``. A null text counts as empty. Null doc_ids come first; rows
    that share a doc_id follow each other in the order of a hash of their texts.
    """
    importable(docs.sparkSession)
    width = "<u2" if word_encoder(tokenizer).kind == "H" else "<u4"
    tokens = stored(tokenized(docs, tokenizer, end_id), "tokens")
    counts = {row.id: row.n for row in counted(tokens, width).collect()}  # at most the vocabulary
    size = lengths(counts, limit)
    spark = docs.sparkSession
    spark.createDataFrame(sorted(size.items()), "id bigint, length int").coalesce(1).write.parquet(f"{path}/code")
    code = spark.sparkContext.broadcast(Code(np.array(list(size), np.int64), np.array(list(size.values()), np.int64)))
    # only ids are put in order, texts stay where they are
    parts = max(spark.sparkContext.defaultParallelism, sum(counts.values()) // PART + 1)
    place = [F.col("doc_id").asc_nulls_first(), F.col("mark")]
    ordered = tokens.repartitionByRange(parts, *place).sortWithinPartitions(*place)
    _blocks(ordered, code, width).write.option("compression", "none").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from files of the format; ids as little-endian uint32.

    ``start`` counts the ids of all documents before. Rows come in no particular order.
    """
    rows = spark.read.schema("id bigint, length int").parquet(f"{path}/code").collect()  # at most the vocabulary
    code = spark.sparkContext.broadcast(
        Code(np.array([r.id for r in rows], np.int64), np.array([r.length for r in rows], np.int64)))
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    importable(spark)
    own = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda total, n: total + n)
    parts = blocks.groupBy("part").agg(F.sum(own).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                part = batch.slice(at, 16)
                sizes = part.column("n_tokens").to_pylist()
                found = code.value.unpack(
                    part.column("bits").to_pylist(), np.array([sum(x) for x in sizes]),
                    [np.array(x, np.int64) for x in part.column("checkpoints").to_pylist()])
                ids, starts = [], []
                for values, own, start in zip(found, sizes, part.column("start").to_pylist(), strict=True):
                    ends = np.cumsum(own)
                    raw = values.astype("<u4").tobytes()
                    ids += [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), own, strict=True)]
                    starts.append(ends - own + start)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_ids").flatten(), pa.array(np.concatenate(starts), pa.int64()),
                    part.column("n_tokens").flatten(), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    # a row for each part of the file, so the bits stay where they are read
    placed = blocks.join(F.broadcast(parts), "part").select(
        "doc_ids", "n_tokens", "bits", "checkpoints", (F.col("before") + F.col("offset")).alias("start"))
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
