"""Toxicity by subword bags (operator 1).

A passage is a few consecutive words. Its vector is the average of the embeddings of its
words' character n-grams, hashed into buckets; a linear softmax on it tells toxic from
clean. Embeddings and softmax are trained jointly in numpy. Misspelt or inflected words that
training never saw share n-grams, and so vectors, with those it saw. A document is as toxic
as its most toxic passage, so a long text doesn't water down a few words; training looks at
that passage too, once a first round over all passages has given it a direction.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZES = (3, 4, 5, 6)  # bytes in an n-gram; the gap before and after a word counts as one
BITS = 17             # of a bucket
DIM = 8
PASSAGE = 12          # words
SLICE = 1 << 20       # bytes worked on at once
STRETCH = 1 << 15     # characters of a text that training sees, at most

_WORD = np.zeros(256, bool)
_WORD[0x80:] = _WORD[ord("0"):ord("9") + 1] = _WORD[ord("a"):ord("z") + 1] = True


def grams(text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Buckets of a lower-case text's n-grams, the passage of each, and the number of passages."""
    raw = np.frombuffer(b" " + text + b" ", np.uint8)
    inside = _WORD[raw]
    starts = inside & ~np.concatenate(([False], inside[:-1]))
    word = np.cumsum(starts)
    n_words = int(word[-1])
    passage = np.maximum(word - 1, 0) // PASSAGE
    symbol = np.where(inside, raw, 32).astype(np.uint32)
    buckets, places = [], []
    whole = np.ones(len(raw), bool)
    value = symbol
    for size in range(2, max(SIZES) + 1):
        n = len(raw) - size + 1
        if n <= 0:
            break
        value = value[:n] * np.uint32(0x01000193) + symbol[size - 1:]
        if size > 2:
            whole = whole[:n] & inside[size - 2:size - 2 + n]
        if size in SIZES:
            x = value[whole[:n]] ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            buckets.append((x ^ (x >> np.uint32(13))) & np.uint32((1 << BITS) - 1))
            # the gap before a word belongs to that word's passage
            places.append(passage[1:][np.flatnonzero(whole[:n])])
    if not buckets or not n_words:
        return np.empty(0, np.uint32), np.empty(0, np.int64), 0
    return np.concatenate(buckets), np.concatenate(places), -(-n_words // PASSAGE)


def pieces(text: bytes):
    """A text in slices of bounded size, cut between words."""
    at = 0
    while len(text) - at > SLICE:
        cut = text.find(b" ", at + SLICE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode()


@dataclass
class Model:
    """What scoring needs: per bucket, its embedding times the difference of the softmax's columns."""

    weights: np.ndarray
    bias: float

    def logit(self, text: bytes) -> float:
        """Of the most toxic passage; a text without words has the bias alone."""
        best = -np.inf
        for piece in pieces(text):
            bucket, place, n = grams(piece)
            if n:
                count = np.maximum(np.bincount(place, minlength=n), 1)
                best = max(best, float((np.bincount(place, self.weights[bucket], n) / count).max()))
        return self.bias + (best if np.isfinite(best) else 0.0)

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(text), -60, 60))))


def train(texts: list[bytes], toxic: np.ndarray, *, examples: int = 24_000, rate: float = 0.4,
          size: int = 32, seed: int = 7) -> Model:
    """Fit embeddings and softmax together, by stochastic gradients with per-bucket step sizes.

    Goes over the texts as often as it takes to see ``examples`` of them, 40 times at most.

    Without examples of both labels there is nothing to tell apart: every score is then the
    share of toxic ones, a half without any.
    """
    toxic = np.asarray(toxic, np.int64)
    if not 0 < toxic.sum() < len(toxic):
        share = toxic.mean() if len(toxic) else 0.5
        return Model(np.zeros(1 << BITS), float(np.clip(40 * (share - 0.5), -20, 20)))
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    softmax = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias, seen = np.zeros(2, np.float32), np.full(1 << BITS, 1e-8, np.float32)
    for epoch in range(min(40, -(-examples // len(texts)))):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), size):
            bags, labels = [], []
            slope = softmax[:, 1] - softmax[:, 0]
            for row in order[at:at + size]:
                piece = list(pieces(texts[row]))
                bucket, place, n = grams(piece[rng.integers(len(piece))])
                if not n:
                    continue
                if epoch == 0:
                    chosen = rng.permutation(n)[:4]
                else:
                    value = np.bincount(place, vectors[bucket] @ slope, n)
                    value /= np.maximum(np.bincount(place, minlength=n), 1)
                    chosen = [int(value.argmax())]
                    if not toxic[row]:
                        chosen.append(int(rng.integers(n)))
                for one in chosen:
                    bags.append(bucket[place == one])
                    labels.append(toxic[row])
            keep = [k for k, bag in enumerate(bags) if len(bag)]
            if not keep:
                continue
            bags, label = [bags[k] for k in keep], np.array([labels[k] for k in keep])
            sizes = np.array([len(bag) for bag in bags])
            ids, row = np.concatenate(bags), np.repeat(np.arange(len(bags)), sizes)
            mean = np.add.reduceat(vectors[ids], np.cumsum(sizes) - sizes) / sizes[:, None]
            odds = mean @ softmax + bias
            odds -= odds.max(axis=1, keepdims=True)
            odds = np.exp(odds)
            odds /= odds.sum(axis=1, keepdims=True)
            odds[np.arange(len(label)), label] -= 1
            odds /= len(label)
            back = (odds @ softmax.T) / sizes[:, None]
            by = np.argsort(ids, kind="stable")
            first = np.flatnonzero(np.diff(ids[by].astype(np.int64), prepend=-1))
            step, hit = np.add.reduceat(back[row[by]], first), ids[by][first]
            seen[hit] += (step * step).mean(axis=1)
            vectors[hit] -= rate * step / np.sqrt(seen[hit])[:, None]
            softmax -= rate * (mean.T @ odds)
            bias -= rate * odds.sum(axis=0)
    slope = (softmax[:, 1] - softmax[:, 0]).astype(np.float64)
    return Model(vectors.astype(np.float64) @ slope, float(bias[1] - bias[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, *, most: tuple[int, int], learn=None) -> DataFrame:
    """(doc_id, text, toxic): about ``most`` labelled rows of label 0 and 1, chosen by hash.

    ``learn`` says which doc_ids may be learnt from (a Column of doc_id; default all). Labels
    other than 0 and 1, and rows without text, are left out. The choice depends on doc_ids
    alone, not on partitioning. Of a text of more than ``STRETCH`` characters training sees
    one stretch, chosen by the hash, so the sample is bounded in bytes too.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    if learn is not None:
        known = known.filter(learn)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("toxic") == label, min(1.0, most[label] / n)).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.filter(place < share)  # about sum(most) rows of two numbers at any size
    stretch = F.expr(f"substring(text, int(pmod(xxhash64(doc_id), ceil(length(text) / {STRETCH}D)) * {STRETCH}) + 1, {STRETCH})")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(
        "text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", F.when(F.length("text") > STRETCH, stretch).otherwise(F.col("text")).alias("text"), "toxic")


def fit(docs: DataFrame, labels: DataFrame, *, most: tuple[int, int] = (6000, 2000), learn=None, **options) -> Model:
    """Train on a bounded sample (about ``most`` clean and toxic rows) on the driver.

    Rows that share a doc_id share its label and are each an example; of several labels of a
    doc_id the larger holds.
    """
    rows = labelled_sample(docs, labels, most=most, learn=learn).toPandas()
    rows = rows.sort_values(["doc_id", "text"], kind="stable")
    return train([lowered(x) for x in rows["text"]], rows["toxic"].to_numpy(), **options)


def scorer(docs: DataFrame, model: Model):
    """A function from a text column to its score, 0 to 1. Null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([model.score(lowered(x)) for x in texts], dtype="float64")

    return score


def scored(docs: DataFrame, model: Model, *, score_col: str = "toxicity") -> DataFrame:
    """Add each whole text's score; no column but ``text`` is looked at.

    An existing column of the name ``score_col`` is replaced.
    """
    return docs.withColumn(score_col, scorer(docs, model)("text"))
