"""Text quality by a factorisation machine (operator 12).

A document is a sparse vector of three fields: its hashed words, weighted by the logarithm
of how often they stand and scaled to a fixed length; statistics of its structure (repeats,
symbols, capitals, lines, ..., for the whole text and for its worst stretch), each as the bin
it falls in; and metadata columns, binned the same way. A factorisation machine gives every
coordinate a weight and a short vector; a pair of coordinates counts by the product of
their vectors, so a word may mean something else beside many symbols. All pairs together take
linear time, since the sum over pairs of v_i v_j x_i x_j is half the squared sum of v_i x_i less
the sum of their squares.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.storage import encoded, importable, text_batches
from tracklens.llm.words import word_hashes

BITS = 16        # of a hashed word's coordinate
BINS = 12        # of a statistic, and one for a missing value
DIM = 8          # of the vectors
STRETCH = 512    # bytes, and
RUN = 64         # words, of which the worst stretch is looked for
SLICE = 4 << 20  # bytes of a text looked at once

# classes of bytes: other, lower case, capital, digit, white space, line end, common punctuation, symbol
_OTHER, _LOWER, _UPPER, _DIGIT, _GAP, _LINE, _MARK, _SYMBOL = range(8)
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _SYMBOL
_CLASS[ord("a"):ord("z") + 1] = _LOWER
_CLASS[ord("A"):ord("Z") + 1] = _UPPER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = _GAP
_CLASS[0x0A] = _LINE
_CLASS[[ord(x) for x in ".,;:?!'\"()-"]] = _MARK

STATISTICS = ("words", "word_size", "other", "capitals", "digits", "gaps", "marks", "symbols", "worst_capitals",
              "worst_symbols", "worst_marks", "worst_digits", "repeats", "worst_repeats", "distinct", "worst_distinct",
              "commonest", "lines", "line_size", "same_lines")


def _worst(flags: np.ndarray, size: int) -> float:
    """The largest share of a run of ``size`` flags; a short rest belongs to the run before."""
    starts = np.arange(0, max(len(flags) - size // 2, 1), size)
    sums = np.add.reduceat(flags.astype(np.int64), starts)
    return float((sums / np.diff(np.append(starts, len(flags)))).max())


def structure(text: bytes, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of STATISTICS of one text, given its words' hashes and how often each stands."""
    if not len(words):
        return np.concatenate(([0.0], np.full(len(STATISTICS) - 1, np.nan)))
    of_class, worst = np.zeros(8, np.int64), dict.fromkeys((_UPPER, _SYMBOL, _MARK, _DIGIT), 0.0)
    for at in range(0, len(text), SLICE):  # slices, so that memory doesn't follow the longest text
        kinds = _CLASS[np.frombuffer(text[at:at + SLICE], np.uint8)]
        of_class += np.bincount(kinds, minlength=8)
        for kind in worst:
            worst[kind] = max(worst[kind], _worst(kinds == kind, STRETCH))
    n, share = len(words), of_class / len(text)
    ordered = np.sort(words[:n // RUN * RUN].reshape(-1, RUN), axis=1)
    distinct = ((np.diff(ordered, axis=1) != 0).sum(axis=1) + 1).min() / RUN if len(ordered) else len(counts) / n
    again = words[1:] == words[:-1]
    n_lines, size, seen = 1 + of_class[_LINE], 0, set()
    for line in text.split(b"\n"):
        if line.strip():
            size += 1
            seen.add(hash(line))
    return np.array([
        np.log1p(n), (len(text) - of_class[_GAP] - of_class[_LINE]) / n, share[_OTHER], share[_UPPER], share[_DIGIT],
        share[_GAP], share[_MARK], share[_SYMBOL], worst[_UPPER], worst[_SYMBOL], worst[_MARK], worst[_DIGIT],
        again.mean() if n > 1 else 0.0, _worst(again, RUN) if n > 1 else 0.0, len(counts) / n, distinct,
        counts.max() / n, np.log1p(n_lines), len(text) / n_lines, 1 - len(seen) / max(size, 1)])


Described = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def described(texts: list[bytes], bits: int = BITS) -> Described:
    """Coordinates and values of all texts' words, how many each text has, and its statistics.

    However long a text, it has each coordinate at most once.
    """
    lowered = [x.lower() for x in texts]
    hashes, sizes = word_hashes(lowered)
    ids, values, own, rows, at = [], [], [], [], 0
    for text, size in zip(texts, sizes.tolist(), strict=True):
        words = hashes[at:at + size]
        at += size
        different, counts = np.unique(words, return_counts=True)
        bucket = (different >> np.uint64(64 - bits)).astype(np.int64)  # in order, as the hashes are
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        weight = np.add.reduceat(1 + np.log(counts), first) if size else np.empty(0)
        ids.append(bucket[first])
        values.append(weight / np.sqrt((weight * weight).sum()) if size else weight)
        own.append(len(first))
        rows.append(structure(text, words, counts))
    flat = [np.concatenate(x) if x else np.empty(0, kind) for x, kind in ((ids, np.int64), (values, np.float64))]
    return *flat, np.array(own, np.int64), np.array(rows).reshape(len(texts), len(STATISTICS))


@dataclass
class Model:
    """Weights and vectors of hashed words first, then of the bins of statistics and metadata."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    edges: list[np.ndarray]  # between the bins of each statistic and metadata column
    bits: int = BITS

    def coordinates(self, ids, values, own, numbers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coordinates and values of whole documents, and how many each has."""
        n, fields = numbers.shape
        bins = np.stack([np.where(np.isnan(column), BINS, np.searchsorted(edges, column, side="right"))
                         for edges, column in zip(self.edges, numbers.T, strict=True)], axis=1)
        bins += (1 << self.bits) + (BINS + 1) * np.arange(fields)
        order = np.argsort(np.concatenate([np.repeat(np.arange(n), own), np.repeat(np.arange(n), fields)]), kind="stable")
        return (np.concatenate([ids, bins.ravel()])[order],
                np.concatenate([values, np.full(n * fields, 1 / np.sqrt(fields))])[order], own + fields)

    def scores(self, ids, values, own, numbers) -> np.ndarray:
        ids, values, own = self.coordinates(ids, values, own, numbers)
        starts = np.cumsum(own) - own
        once = np.add.reduceat(self.weights[ids] * values, starts)
        scaled = self.vectors[ids] * values[:, None]
        sums = np.add.reduceat(scaled, starts)
        pairs = (sums * sums - np.add.reduceat(scaled * scaled, starts)).sum(axis=1) / 2
        return 1 / (1 + np.exp(-np.clip(self.bias + once + pairs, -60, 60)))


def train(texts: Described, label: np.ndarray, metadata: np.ndarray, *, examples: int = 48_000, rate: float = 0.1,
          decay: float = 1e-5, size: int = 32, seed: int = 11) -> Model:
    """Fit weights and vectors together, by stochastic gradients with step sizes per coordinate.

    Goes over the texts as often as it takes to see ``examples`` of them, 60 times at most.
    ``texts`` come from :func:`described`; ``metadata``: a row of numbers for each text, NaN
    where there is none. Without examples of
    both labels there is nothing to tell apart: every score is then the share of label 1, a
    half without any.
    """
    label = np.asarray(label, np.float64)
    ids, values, own, rows = texts
    numbers = np.concatenate([rows, np.asarray(metadata, np.float64).reshape(len(own), np.shape(metadata)[1])], axis=1)
    edges = []
    for column in numbers.T:
        known = column[~np.isnan(column)]
        cut = np.quantile(known, np.arange(1, BINS) / BINS) if len(known) else np.zeros(BINS - 1)
        edges.append(cut)
    n = (1 << BITS) + (BINS + 1) * numbers.shape[1]
    rng = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(n), rng.normal(0, 0.05, (n, DIM)), edges)
    if not 0 < label.sum() < len(label):
        model.vectors[:] = 0
        model.bias = float(np.clip(40 * ((label.mean() if len(label) else 0.5) - 0.5), -20, 20))
        return model
    share = label.mean()
    model.bias = float(np.log(share / (1 - share)))
    ids, values, own = model.coordinates(ids, values, own, numbers)
    ends = np.cumsum(own)
    seen, seen_v = np.full(n, 1e-2), np.full(n, 1e-2)
    for _ in range(min(60, -(-examples // len(label)))):
        order = rng.permutation(len(label))
        for at in range(0, len(order), size):
            chosen = order[at:at + size]
            place = np.concatenate([np.arange(ends[r] - own[r], ends[r]) for r in chosen])
            i, x, sizes = ids[place], values[place], own[chosen]
            starts, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(chosen)), sizes)
            scaled = model.vectors[i] * x[:, None]
            sums = np.add.reduceat(scaled, starts)
            pairs = (sums * sums - np.add.reduceat(scaled * scaled, starts)).sum(axis=1) / 2
            odds = model.bias + np.add.reduceat(model.weights[i] * x, starts) + pairs
            slope = (1 / (1 + np.exp(-np.clip(odds, -60, 60))) - label[chosen]) / len(chosen)
            by = np.argsort(i, kind="stable")
            first = np.flatnonzero(np.diff(i[by], prepend=-1))
            hit = i[by][first]
            step = np.add.reduceat((slope[row] * x)[by], first) + decay * model.weights[hit]
            step_v = np.add.reduceat((slope[row, None] * x[:, None] * (sums[row] - scaled))[by], first)
            step_v += decay * model.vectors[hit]
            seen[hit] += step * step
            seen_v[hit] += (step_v * step_v).mean(axis=1)
            model.weights[hit] -= rate * step / np.sqrt(seen[hit])
            model.vectors[hit] -= rate * step_v / np.sqrt(seen_v[hit])[:, None]
            model.bias -= rate * float(slope.sum())
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, metadata: list[str], *, most: tuple[int, int],
                    learn: Column | None = None) -> DataFrame:
    """(doc_id, text, label, metadata columns): about ``most`` labelled rows of label 0 and 1, chosen by a hash of doc_id.

    ``learn`` says which doc_ids may be learnt from. Labels other than 0 and 1 and rows without
    text are left out; of several labels of a doc_id the larger holds.
    """
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    if learn is not None:
        known = known.filter(learn)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {row.label: row.n for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, min(1.0, most[label] / n)).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.filter(place < share)  # about sum(most) rows of two numbers at any size
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       *[F.col(c).cast("double").alias(f"_m{k}") for k, c in enumerate(metadata)])
    return rows.filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, *, metadata: list[str] | None = None, most: tuple[int, int] = (2000, 4000),
        learn: Column | None = None, **options) -> Model:
    """Train on a bounded sample (about ``most`` rows of label 0 and 1) on the driver.

    Texts stay in the workers; the driver gets their coordinates and statistics, which are
    bounded for texts of any length.
    """
    importable(docs.sparkSession)
    metadata = metadata or []
    extra = [f"_m{k}" for k in range(len(metadata))]

    def run(batches):
        for batch in text_batches(batches):
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                ids, values, _, numbers = described(encoded(one))
                yield pa.RecordBatch.from_arrays([
                    one.column("doc_id"), one.column("label"), pa.array([ids.astype("<i4").tobytes()], pa.binary()),
                    pa.array([values.tobytes()], pa.binary()), pa.array([numbers.tobytes()], pa.binary()),
                    *(one.column(c) for c in extra)], ["doc_id", "label", "ids", "values", "numbers", *extra])

    rows = labelled_sample(docs, labels, metadata, most=most, learn=learn).mapInArrow(
        run, "doc_id bigint, label int, ids binary, values binary, numbers binary" + "".join(f", {c} double" for c in extra))
    rows = rows.toPandas().sort_values(["doc_id", "ids", "values"], kind="stable")
    ids, values, numbers = (np.frombuffer(b"".join(map(bytes, rows[c])), kind) for c, kind in (
        ("ids", "<i4"), ("values", np.float64), ("numbers", np.float64)))
    own = np.array([len(x) // 4 for x in rows["ids"]], np.int64)
    texts = ids.astype(np.int64), values, own, numbers.reshape(len(rows), len(STATISTICS))
    return train(texts, rows["label"].to_numpy(), rows[extra].to_numpy(np.float64), **options)


def scored(docs: DataFrame, model: Model, *, metadata: list[str] | None = None, key: str = "doc_id") -> DataFrame:
    """(key, score) for each row of ``docs``: how likely its whole text has label 1, 0 to 1.

    Only ``text`` and the numeric columns ``metadata`` (those of :func:`fit`) are looked at. A
    null text counts as empty; an empty text, or one without words, has only its metadata, and
    null metadata are a case of their own. Repeated rows are scored alike, each for itself, and
    very long texts whole. Other columns play no part; an empty table gives an empty one.
    """
    importable(docs.sparkSession)
    metadata, shared = metadata or [], docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in text_batches(batches):
            if not batch.num_rows:
                continue
            *words, numbers = described(encoded(batch), model.bits)
            extra = [batch.column(f"_m{k}").to_numpy(zero_copy_only=False).astype(np.float64)
                     for k in range(len(metadata))]
            numbers = np.column_stack([numbers, *extra])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(model.scores(*words, numbers))], [key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text", *[F.col(c).cast("double").alias(f"_m{k}") for k, c in enumerate(metadata)]).mapInArrow(
        run, f"{key} {kind}, score double")
