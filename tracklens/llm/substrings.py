"""Passages that repeat across documents, found by level-wise doubling (operator 6).

Levels look at windows of a quarter of the asked length, of twice that, and so on up to the
asked length itself. Of the shortest windows inside one long window only the one with the
smallest hash, its anchor, is needed: equal long windows have equal anchors at equal places.
A level drops the places whose window only one document has; what survives alone is extended
to twice the length, to the right where that stays inside the long windows the place stands
for and else to the left, until the asked length is reached or nothing survives. (Hashes of all
levels are made while a text is at hand; a level reads them for survivors only.)

At the asked length, places stand for the whole span of their long windows. A span that a
document with a smaller id also has is settled as a whole, so the thousandth copy of a
passage costs one row per place; single windows are only compared between first
occurrences of spans.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.storage import encoded, importable, lists, stored, text_batches, with_keys
from tracklens.llm.words import Windows, word_hashes


def levels(length: int) -> list[int]:
    """Lengths of windows before the asked one, each twice the one before."""
    found = [max(1, (length + 3) // 4)]
    while 2 * found[-1] < length:
        found.append(2 * found[-1])
    return found


def places(words: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Places of a text that stand for its windows: a row of hashes for each level, spans, first and last window.

    Which place stands for a window, and what it is extended to, follows from the window's
    own words alone.
    """
    windows, sizes = Windows(words), levels(length)
    short = sizes[0]
    at = np.arange(len(words) - short + 1)
    small = windows.hashes(at, at + short)
    view = np.lib.stride_tricks.sliding_window_view(small, length - short + 1)
    window = np.arange(len(view))
    starts = [view.argmin(axis=1) + window]
    for before, size in zip(sizes, sizes[1:]):  # to the right, or else to the left
        right = starts[-1] + size <= window + length
        starts.append(np.where(right, starts[-1], starts[-1] + before - size))
    moved = np.zeros(len(window), bool)
    for one in starts:
        moved |= np.diff(one, prepend=-1) != 0
    first = np.flatnonzero(moved)
    last = np.append(first[1:], len(window)) - 1
    place = [one[first] for one in starts]
    span = windows.hashes(first, last + length) ^ (place[0] - first).astype(np.uint64)
    return np.stack([windows.hashes(one, one + size) for one, size in zip(place, sizes, strict=True)]), span, first, last


def _joined(text: bytes, removed: np.ndarray | None = None) -> tuple[int, str]:
    words = text.split()
    kept = words if removed is None else [w for w, out in zip(words, removed, strict=True) if not out]
    return len(words), hashlib.sha256(b" ".join(kept)).hexdigest()


def scan(docs: DataFrame, length: int) -> DataFrame:
    """One row per document with its places; ``digest`` is of all its words."""
    names = [f"level{k}" for k in range(len(levels(length)))] + ["span"]

    def run(batches):
        for batch in text_batches(batches):
            texts = encoded(batch)
            hashes, counts = word_hashes(texts)
            found, sizes, at = [], [], 0
            for count in counts:
                if count >= length:
                    own, span, *_ = places(hashes[at:at + count], length)
                    found.append([*own, span])
                sizes.append(len(found[-1][-1]) if count >= length else 0)
                at += count
            flat = ([np.concatenate(x).view(np.int64) for x in zip(*found, strict=True)] if found
                    else [np.empty(0, np.int64)] * len(names))
            digests = [_joined(x)[1] for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(digests),
                 *(lists(pa.array(x), sizes) for x in flat)], ["doc_id", "n_words", "digest", *names])

    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, digest string"
                           + "".join(f", {name} array<bigint>" for name in names))


def _several(df: DataFrame, key: str) -> DataFrame:
    """Keys that more than one document has, with the smallest doc_id and the number of rows."""
    return stored(df.groupBy(key).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                                      F.count("*").alias("_n")).filter("low < high").select(key, "low", "_n"), "several")


def survivors(rows: DataFrame, length: int) -> list[DataFrame]:
    """What is left of ``rows`` (doc_id, level0, level1, ..., span) after each level, until nothing is."""
    left = []
    for k in range(len(levels(length))):
        rows = stored(with_keys(rows, _several(rows, f"level{k}"), f"level{k}").drop(f"level{k}", "low"), "survivors")
        left.append(rows)
        if rows.isEmpty():
            break
    return left


def _windows(texts: DataFrame, length: int) -> DataFrame:
    """Single windows of the spans whose first document this is: (doc_id, hash, at)."""
    def run(batches):
        for batch in batches:
            for part in text_batches([batch], "text"):
                hashes, counts = word_hashes(encoded(part))
                ids, marks = part.column("doc_id").to_pylist(), part.column("open").to_pylist()
                at, out = 0, [[], [], []]
                for doc, count, wanted in zip(ids, counts, marks, strict=True):
                    words = hashes[at:at + count]
                    at += count
                    if count < length or not wanted:
                        continue
                    _, span, first, last = places(words, length)
                    mine = np.isin(span.view(np.int64), np.array(wanted, np.int64))
                    starts = np.concatenate([np.arange(a, b + 1) for a, b in
                                             zip(first[mine], last[mine], strict=True)] or [first[:0]])
                    out[0].append(np.full(len(starts), doc))
                    out[1].append(Windows(words).hashes(starts, starts + length).view(np.int64))
                    out[2].append(starts.astype(np.int32))
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in out], ["doc_id", "hash", "at"])

    return texts.select("doc_id", "text", "open").mapInArrow(run, "doc_id bigint, hash bigint, at int")


def _cut(texts: DataFrame, length: int) -> DataFrame:
    """Remove the words of settled spans and of single windows: (doc_id, digest, n_removed, ...)."""
    def run(batches):
        for batch in batches:
            for part in text_batches([batch], "text"):
                raw = encoded(part)
                hashes, counts = word_hashes(raw)
                settled, starts = part.column("settled").to_pylist(), part.column("starts").to_pylist()
                values = part.column("hashes").to_pylist()
                at, rows = 0, [[], [], [], []]
                for text, count, spans, firsts, seen in zip(raw, counts, settled, starts, values, strict=True):
                    words = hashes[at:at + count]
                    at += count
                    edge = np.zeros(count + 1, np.int64)
                    if count >= length:
                        _, span, first, last = places(words, length)
                        gone = np.isin(span.view(np.int64), np.array(spans or [], np.int64))
                        begin, end = first[gone], last[gone] + length
                        single = np.array(firsts or [], np.int64)
                        known = np.array(seen or [], np.int64)[single <= count - length]
                        single = single[single <= count - length]
                        same = Windows(words).hashes(single, single + length).view(np.int64) == known
                        begin = np.concatenate([begin, single[same]])
                        end = np.concatenate([end, single[same] + length])
                        np.add.at(edge, begin, 1)
                        np.add.at(edge, end, -1)
                    removed = np.cumsum(edge)[:-1] > 0
                    rows[0].append(_joined(text)[1])
                    rows[1].append(int(removed.sum()))
                    rows[2].append(_joined(text, removed)[1])
                    rows[3].append(b" ".join(
                        w for w, out in zip(text.split(), removed, strict=True) if not out).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, rows)],
                    ["doc_id", "digest", "n_removed", "kept_sha256", "kept_text"])

    return texts.select("doc_id", "text", "settled", "starts", "hashes").mapInArrow(
        run, "doc_id bigint, digest string, n_removed bigint, kept_sha256 string, kept_text string")


def without_repeats(docs: DataFrame, *, length: int = 50) -> DataFrame:
    """Remove each word covered by a window of ``length`` words that a smaller doc_id also has.

    ``docs``: (doc_id, text), other columns play no part. Returns one row per row of ``docs``:
    doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) and
    kept_text, which is null where nothing is removed. Words are split at ASCII white space
    and compared unchanged; windows are judged on the input. A null text has no words.
    Shorter texts lose nothing. Rows that share a doc_id don't take words from each other;
    rows without doc_id neither take nor lose words.
    """
    importable(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = stored(scan(docs, length), "places")
    names = [f"level{k}" for k in range(len(levels(length)))] + ["span"]
    rows = found.filter("doc_id IS NOT NULL AND size(span) > 0").select(
        "doc_id", F.explode(F.arrays_zip(*names)).alias("x")).select("doc_id", *[f"x.{name}" for name in names])
    spans = stored(survivors(rows, length)[-1].select("doc_id", "span").distinct(), "spans")
    low = stored(spans.groupBy("span").agg(F.min("doc_id").alias("low"), F.count("*").alias("_n")), "low")
    first = F.col("low") == F.col("doc_id")
    per_doc = with_keys(spans, low, "span").select("doc_id", "span", first.alias("first"))
    marks = per_doc.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("first"), F.col("span"))).alias("open"),
        F.collect_list(F.when(~F.col("first"), F.col("span"))).alias("settled"))
    texts = stored(docs.join(marks, "doc_id"), "marked")

    single = stored(_windows(texts, length), "windows")
    late = with_keys(single, _several(single, "hash"), "hash").filter("low < doc_id")
    settled = late.groupBy("doc_id").agg(F.collect_list("at").alias("starts"), F.collect_list("hash").alias("hashes"))
    cut = _cut(texts.join(settled, "doc_id", "left"), length)
    cut = stored(cut.dropDuplicates(["doc_id", "digest"]), "cut")
    return found.select("doc_id", "n_words", "digest").join(cut, ["doc_id", "digest"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"), "kept_text")
