"""Tokens of two tokenizers aligned by the bytes they cover (operator 13).

Every document is a pair of pointers, one into its A tokens and one into its B tokens. One
step moves the pointers of all documents of a batch at once: tokens under both pointers
overlap, which is a link; whichever token ends first is left behind, and where both end
together stands a cut. Documents that are through are compacted away. Long documents start
several pairs of pointers, at places where an A token and a B token end together, so that
one of them doesn't keep a whole batch going.

Ids linked across the corpus are counted by documents: each task writes the pairs of ids of
its block of documents once, sums run over these, and every block gets back the counts of
its own pairs. Links themselves never move.
"""

import hashlib
import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracklens.llm.storage import encoded, importable, lists, stored, text_batches

LANE = 256        # A tokens after which a document may start another pair of pointers
BATCH = 4 << 20   # bytes of text aligned at once
BLOCK = 8 << 20   # bytes of text whose pairs of ids are written together
SPACE = "▁"  # stands for a space in B's pieces


def _letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in plain]
    return {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(rest)}


def _quick(path: str, pattern: str, letters: dict[str, int]) -> tiktoken.Encoding | None:
    """The file's merges in the quicker library, where ids follow merges and pieces follow ``pattern``; else None."""
    with open(path, encoding="utf-8") as lines:
        data = json.load(lines)
    model, cut = data["model"], data["pre_tokenizer"]
    vocab, merges = model["vocab"], [x.split(" ") if isinstance(x, str) else x for x in model.get("merges", [])]
    if (data["normalizer"] or cut != {**cut, "type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
            or any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(merges))):
        return None
    ranks = {bytes(map(letters.__getitem__, token)): i for token, i in vocab.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Tokenizers:
    """Both tokenizers, what bytes their tokens stand for, and how ids are written."""

    def __init__(self, path_a: str, path_b: str, pattern: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        letters = _letters()
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.quick = _quick(path_a, pattern, letters) if pattern else None
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_a = {i: bytes(letters[x] for x in token) if set(token) <= letters.keys() else token.encode()
                   for token, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes = [[bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)], []]
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes[1].append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                 else piece.replace(SPACE, " ").encode())
        self.width = [np.array(list(map(len, x)), np.int64) for x in self.bytes]
        numbers = [[str(i).encode() for i in range(len(x))] for x in self.bytes]
        # an id as it is written inside a group, and at the end of the group's A or B part
        self.written = [np.array([x + b"," for x in own] + [x + end for x in own], object)
                        for own, end in zip(numbers, (b"|", b";"), strict=True)]

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.quick:
            return [self.quick.encode_ordinary(x) for x in texts]
        return [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of all texts by A and by B, and how many each text has.

        A text whose tokens' bytes differ from a space and the text has none on either side.
        """
        plain = [x.decode() for x in texts]
        found = [self._encode_a([" " + x for x in plain]), self.b.encode(plain, num_threads=1)]
        for row, text in enumerate(texts):
            whole = b" " + text
            if not text or any(b"".join(map(tokens.__getitem__, own[row])) != whole
                               for tokens, own in zip(self.bytes, found, strict=True)):
                found[0][row], found[1][row] = [], []
        counts = [np.array(list(map(len, own)), np.int64) for own in found]
        return [np.fromiter(chain.from_iterable(own), np.int32, int(n.sum()))
                for own, n in zip(found, counts, strict=True)], counts


def lockstep(end_a: np.ndarray, end_b: np.ndarray, last: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, ...]:
    """Links (places in A, places in B), in no order, and which of them end a group.

    ``end_a``, ``end_b``: where each token ends in the bytes of all documents, rising;
    ``last``: the places in A of the documents' last tokens.
    """
    tries = np.setdiff1d(np.arange(lane - 1, len(end_a), lane), last)
    meet = np.searchsorted(end_b, end_a[tries])
    tries = tries[end_b[np.minimum(meet, len(end_b) - 1)] == end_a[tries]] if len(end_b) else tries
    stops = np.union1d(last, tries) + 1
    i = np.concatenate(([0], stops[:-1])).astype(np.int64)[:len(stops)]
    j = np.searchsorted(end_b, end_a[i - 1], side="right") * (i > 0) if len(i) else i
    found_a, found_b, cuts = [i[:0]], [i[:0]], [np.empty(0, bool)]
    while len(i):
        a, b = end_a[i], end_b[j]
        through_a, through_b = a <= b, b <= a
        found_a.append(i)
        found_b.append(j)
        cuts.append(through_a & through_b)
        i, j = i + through_a, j + through_b
        going = i < stops  # both tokens end together at a stop
        if not going.all():
            i, j, stops = i[going], j[going], stops[going]
    return np.concatenate(found_a), np.concatenate(found_b), np.concatenate(cuts)


def _written(tokenizers: Tokenizers, ids, counts, ends_group) -> list[str]:
    """Digest of each document's groups, '' without tokens."""
    group_of = [np.cumsum(x) - x for x in ends_group]
    # a token's place: those of its own side before it, and the other side's of earlier (for B, also this) groups
    n_groups = int(ends_group[0].sum())
    per_group = [np.bincount(x, minlength=n_groups) for x in group_of]
    before_b = np.cumsum(per_group[1]) - per_group[1]
    through_a = np.cumsum(per_group[0])
    out = np.empty(len(ids[0]) + len(ids[1]), object)
    for side, shift in ((0, before_b), (1, through_a)):
        names = tokenizers.written[side]
        place = np.arange(len(ids[side])) + (shift[group_of[side]] if n_groups else 0)
        out[place] = names[ids[side] + ends_group[side] * (len(names) // 2)]
    stops = np.cumsum(counts[0] + counts[1])
    starts = stops - counts[0] - counts[1]
    return [hashlib.sha256(b"".join(out[a:b].tolist())[:-1]).hexdigest() if a < b else ""
            for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


@lru_cache(maxsize=2)
def tokenizers_of(path_a: str, path_b: str, pattern: str | None = None) -> Tokenizers:
    """Both tokenizers, once per worker process."""
    return Tokenizers(path_a, path_b, pattern)


_ALIGNED = ("block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
            "places binary, times binary, pair array<bigint>, seen array<bigint>")


def aligned(docs: DataFrame, path_a: str, path_b: str, pattern: str | None = None) -> DataFrame:
    """A row for each document, and one for each block of them with its pairs of ids.

    A document's ``places`` say which pairs of its block it holds (each as the step from the
    one before, unsigned 32-bit), ``times`` how often. A block's row has no counts; its
    ``pair`` is A's id times the size of B's vocabulary plus B's id, ``seen`` the number of
    its documents that hold the pair.
    """
    def block(number, rows, held, width):
        pairs, at, seen = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        out, stop = [], 0
        for columns, sizes, times in rows:
            ends = np.cumsum(sizes)
            step = np.diff(at[stop:stop + len(times)], prepend=0)
            first = (ends - sizes)[sizes > 0]
            step[first] = at[stop + first]
            stop += len(times)
            step, times = step.astype("<u4").tobytes(), times.astype("<u4").tobytes()
            cut = list(zip((4 * (ends - sizes)).tolist(), (4 * ends).tolist(), strict=True))
            n = len(sizes)
            out.append(pa.RecordBatch.from_arrays([
                pa.array([number] * n, pa.int64()), *columns, pa.array([step[a:b] for a, b in cut], pa.binary()),
                pa.array([times[a:b] for a, b in cut], pa.binary()),
                pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], width))
        own = [pa.array([number], pa.int64()), *(pa.nulls(1, x.type) for x in out[0].columns[1:-2]),
               lists(pa.array(pairs), [len(pairs)]), lists(pa.array(seen.astype(np.int64)), [len(seen)])]
        return [*out, pa.RecordBatch.from_arrays(own, width)]

    def run(batches):
        tokenizers = tokenizers_of(path_a, path_b, pattern)
        names = [x.split()[0] for x in _ALIGNED.split(", ")]
        part, number, size, rows, held = TaskContext.get().partitionId(), 0, 0, [], []
        for batch in text_batches(batches, most=BATCH):
            texts = encoded(batch)
            ids, counts = tokenizers.encode(texts)
            ends = [np.cumsum(width[own]) for width, own in zip(tokenizers.width, ids, strict=True)]
            last = np.cumsum(counts[0])[counts[0] > 0] - 1
            i, j, cuts = lockstep(*ends, last)
            owner = np.repeat(np.arange(len(texts)), counts[0])
            ends_group = [np.zeros(len(x), np.int64) for x in ids]
            ends_group[0][i[cuts]] = ends_group[1][j[cuts]] = 1
            doc = owner[i]
            n_b = len(tokenizers.bytes[1])
            span = len(tokenizers.bytes[0]) * n_b
            keys, times = np.unique(doc * span + ids[0][i].astype(np.int64) * n_b + ids[1][j], return_counts=True)
            held.append(keys % span)
            n = len(texts)
            columns = [batch.column("doc_id"), pa.array(counts[0]), pa.array(counts[1]),
                       pa.array(np.bincount(owner, ends_group[0], n).astype(np.int64)),
                       pa.array(np.bincount(doc, minlength=n)), pa.array(_written(tokenizers, ids, counts, ends_group))]
            rows.append((columns, np.bincount(keys // span, minlength=n), times))
            size += sum(map(len, texts))
            if size >= BLOCK:
                yield from block(part << 24 | number, rows, held, names)
                number, size, rows, held = number + 1, 0, [], []
        if rows:
            yield from block(part << 24 | number, rows, held, names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _ALIGNED)


_RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "n_best bigint, count_sum bigint")


def _weighed(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """A block's documents with the counts of their links, from those of the block's pairs."""
    n = pairs.num_rows
    total, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    place = pairs.column("place").to_numpy()
    total[place] = pairs.column("total").to_numpy()
    best[place] = pairs.column("total").to_numpy() == pairs.column("most").to_numpy()
    steps, times = (docs.column(c).to_pylist() for c in ("places", "times"))
    sums = [[], []]
    for step, often in zip(steps, times, strict=True):
        at = np.cumsum(np.frombuffer(step, "<u4").astype(np.int64))
        often = np.frombuffer(often, "<u4").astype(np.int64)
        sums[0].append(int(often @ best[at]))
        sums[1].append(int(often @ total[at]))
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return kept.append_column("n_best", pa.array(sums[0], pa.int64())).append_column(
        "count_sum", pa.array(sums[1], pa.int64()))


def align(docs: DataFrame, *, path_a: str, path_b: str, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) for each row of ``docs`` (doc_id, text).

    ``path_a``: a byte-level file of the tokenizers library, which encodes a space and the
    text; ``path_b``: a sentencepiece model, which adds that space itself. Neither takes
    special tokens out of texts. ``pattern``: what A cuts texts by, if known; then tiktoken
    does A's merges, to the same ids in a third of the time. A null or empty text, or one that either side's tokens don't
    give back byte by byte, has no tokens: zeros and an empty ``groups_sha256``. A pair of ids
    counts once for each row that links it; rows that repeat, or share a doc_id, are documents
    of their own, and a null doc_id stays. Very long texts take several pairs of pointers.
    Other columns play no part. An empty table gives an empty one.
    """
    importable(docs.sparkSession)
    found = stored(aligned(docs, path_a, path_b, pattern), "aligned")
    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    # pairs of ids of a block, once for each block, whatever the number of its documents
    entries = found.filter("pair IS NOT NULL").select(
        F.col("block").alias("home"), F.posexplode(F.arrays_zip("pair", "seen")).alias("place", "x")).select(
        "home", "place", "x.pair", "x.seen")
    totals = stored(entries.groupBy("pair").agg(F.sum("seen").alias("total")), "pairs")
    side_a = F.expr(f"pair div {n_b}")
    most = totals.groupBy(side_a.alias("a")).agg(F.max("total").alias("most"))  # one row for an id of A
    counted = entries.join(totals, "pair").withColumn("a", side_a).join(F.broadcast(most), "a").select(
        "home", "place", "total", "most")
    rows = found.filter("pair IS NULL").drop("pair", "seen")
    return rows.groupBy("block").cogroup(counted.groupBy("home")).applyInArrow(_weighed, _RESULT)
