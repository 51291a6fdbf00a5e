"""TF-IDF weights of issue texts and the issues closest to a text."""

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import one_of, words_of
from tracklens.session import written

VOCABULARY_SIZE = 300
SPLIT = 100_000   # texts, and queries, that one task goes through
MARGIN = 1e-8     # above what rounding to nine places can move a score
DENSE = 4         # terms of a query the average text has, from where on none of them is left out
CELLS = 2_400_000  # numbers in the matrix of a block of texts
ROUGH = 2.0 ** -23  # times the terms: above what single precision can move a score
BLOCKS = 8        # groups that a block's worth of queries may be dealt to
FEW = 20          # one in so many pairs is multiplied alone, more as a block


def terms(texts: DataFrame, *, stop_words: list[str], text_col: str = "feature_text",
          key: str = "number") -> DataFrame:
    """One row per term occurrence, stop words left out."""
    rows = texts.selectExpr(key, f"explode({words_of(text_col)}) AS term")
    return rows.filter(f"NOT {one_of('term', stop_words)}")


def vocabulary(occurrences: DataFrame, *, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The most frequent terms over all texts, ties by term."""
    counts = occurrences.groupBy("term").agg(F.expr("count(1) AS total"))
    return counts.orderBy(F.desc("total"), "term").limit(size)


class TermWeights:
    """Vocabulary and smoothed inverse document frequencies of a set of texts.

    Everything stays a lazy frame. The vocabulary and the frequencies have at
    most ``size`` rows each, so they may be broadcast whatever the input.
    """

    def __init__(self, texts: DataFrame, *, size: int = VOCABULARY_SIZE, stop_words: list[str],
                 text_col: str = "feature_text", key: str = "number",
                 keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df):
        """``keep``: gets each frame that others are made from, and its name; may write it once."""
        self.key, self.text_col, self.stop_words = key, text_col, stop_words
        occurrences = terms(texts, stop_words=stop_words, text_col=text_col, key=key)
        self.vocabulary = keep(vocabulary(occurrences, size=size).select("term"), "vocabulary")
        self.counts = keep(self._count(occurrences), "counts")
        documents = texts.agg(F.expr("count(1)")).scalar()
        frequency = self.counts.groupBy("term").agg(F.expr("count(1) AS df"))
        self.idf = keep(frequency.withColumn("documents", documents).selectExpr(
            "term", "ln((1D + documents) / (1D + df)) + 1D AS idf"), "idf")

    def _count(self, occurrences: DataFrame) -> DataFrame:
        return occurrences.join(F.broadcast(self.vocabulary), "term").groupBy(
            self.key, "term").agg(F.expr("count(1) AS tf"))

    def _weigh(self, counts: DataFrame) -> DataFrame:
        raw = counts.join(F.broadcast(self.idf), "term").selectExpr(
            self.key, "term", "tf", "tf * idf AS raw")
        # One text has at most ``size`` terms, so the window is small.
        norm = f"sqrt(sum(raw * raw) OVER (PARTITION BY {self.key}))"
        return raw.selectExpr(self.key, "term", "tf", f"raw / {norm} AS weight")

    def weights(self) -> DataFrame:
        """key, term, tf, weight with unit length per text; terms present only."""
        return self._weigh(self.counts)

    def counts_of(self, texts: DataFrame) -> DataFrame:
        """key, term, tf of other texts; terms of this vocabulary only."""
        return self._count(terms(texts, stop_words=self.stop_words, text_col=self.text_col, key=self.key))

    def weights_of(self, texts: DataFrame) -> DataFrame:
        """Weights of other texts by this vocabulary and these frequencies."""
        return self._weigh(self.counts_of(texts))


def tfidf(texts: DataFrame, *, stop_words: list[str], size: int = VOCABULARY_SIZE,
          text_col: str = "feature_text", key: str = "number") -> DataFrame:
    """Unit-length TF-IDF weights over the most frequent terms, in long form."""
    return TermWeights(texts, size=size, stop_words=stop_words, text_col=text_col,
                       key=key).weights()


def find_similar_issues(closed: DataFrame, text: str, *, stop_words: list[str], k: int = 5,
                        size: int = VOCABULARY_SIZE, text_col: str = "feature_text") -> DataFrame:
    """The ``k`` closed issues closest to ``text`` by cosine.

    One scan scores every closed issue, also those sharing no term (0). The
    asked text has at most ``size`` weights, so its side is broadcast and no pair
    of issues is ever formed. Equal scores (copies) go by number; scores are cut
    to nine places so that summation order cannot break a tie.
    """
    fitted = TermWeights(closed, size=size, stop_words=stop_words, text_col=text_col)
    asked = closed.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("number"), F.lit(text).alias(text_col))
    wanted = fitted.weights_of(asked).selectExpr("term", "weight AS asked_weight")
    products = fitted.weights().join(F.broadcast(wanted), "term").selectExpr(
        "number", "weight * asked_weight AS part")
    every = closed.selectExpr("number", "0D AS part")
    scores = products.unionByName(every).groupBy("number").agg(
        F.expr("round(sum(part), 9) AS similarity"))
    nearest = scores.orderBy(F.desc("similarity"), "number").limit(k)
    # At most k rows, whatever the input.
    found = closed.drop(text_col, "text").join(F.broadcast(nearest), "number")
    return found.orderBy(F.desc("similarity"), "number")


def _nearest(scores: DataFrame, n: int) -> DataFrame:
    """First ``n`` per query; each task keeps ``n`` per query before the shuffle."""
    return scores.selectExpr("*", "row_number() OVER (PARTITION BY query ORDER BY score DESC, number) "
                             "AS rank").filter(F.col("rank") <= n)


def _packed(counts: DataFrame, places: DataFrame, *more: str) -> DataFrame:
    """One row per text: its terms' places, rarest first, how often it has them, and the length of its vector."""
    return counts.join(F.broadcast(places), "term").groupBy("number").agg(
        F.expr("sort_array(collect_list(struct(place, CAST(tf AS int) AS tf))) AS held"),
        F.expr("sqrt(sum(tf * idf * tf * idf)) AS norm"), *map(F.expr, more)).selectExpr(
        "*", "held.place AS places", "held.tf AS tfs").drop("held")


def _unpacked(texts: DataFrame, places: DataFrame) -> DataFrame:
    """One row per term of a packed text, with its weight."""
    pairs = texts.withColumn("held", F.expr("explode(arrays_zip(places, tfs))"))
    return pairs.selectExpr(*[c for c in texts.columns if c not in ("places", "tfs")], "held.places AS place", "held.tfs AS tf").join(
        F.broadcast(places), "place").withColumn("weight", F.expr("tf * idf / norm"))


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of each element."""
    lists = lists.combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), lengths), lists.flatten().to_numpy(zero_copy_only=False)


def _matrix(rows: pa.Table, idf: np.ndarray) -> np.ndarray:
    """Weights of packed texts, one row each."""
    (at, place), (_, tf) = _flat(rows["places"]), _flat(rows["tfs"])
    out = np.zeros((rows.num_rows, len(idf)))
    out[at, place] = tf * idf[place] / rows["norm"].to_numpy()[at]
    return out


def _first(k: int, at: np.ndarray, text: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, ...]:
    """The ``k`` best of each query, ties by place of the text, and their ranks from 0 on."""
    order = np.lexsort((text, -score, at))
    at = at[order]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][:len(at)])
    rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
    good = rank < k
    return at[good], text[order][good], score[order][good], rank[good]


def _reaching(k: int, left: np.ndarray, looked: np.ndarray, exact: np.ndarray, right: np.ndarray, has: np.ndarray,
              beat: np.ndarray) -> tuple[np.ndarray, ...]:
    """Query, text and score, to nine places, of the pairs that reach what the query has to beat, and of its ``k`` best.

    Pairs that cannot be among those, by a product in single precision and its greatest error,
    are left out; the others are multiplied again in full. ``looked``: each query's terms without
    which no text reaches; texts with none of them are not multiplied.
    """
    used = np.flatnonzero(left.any(axis=0))
    some = np.flatnonzero(has[looked.any(axis=0)].any(axis=0))
    if 2 * len(some) < len(exact):
        rough = left[:, used].astype(np.float32) @ right[np.ix_(used, some)]
        exact = exact[some]
    else:
        some = np.arange(len(exact))
        rough = left[:, used].astype(np.float32) @ right[used]
    error, tiny = MARGIN + ROUGH * (left.shape[1] + 4), np.finfo(np.float32).tiny
    near = rough >= np.maximum(beat - error, tiny).astype(np.float32)[:, None]
    if np.count_nonzero(near) * FEW > near.size:
        last = max(0, len(some) - k)
        best = np.partition(rough, last, axis=1)[:, last]
        near &= rough >= (best - 2 * error).astype(np.float32)[:, None]
    at, text = np.divmod(np.flatnonzero(near), len(some))
    if len(at) * FEW > near.size:
        score = (left @ exact.T)[near]
    else:
        step = max(1, CELLS // left.shape[1])
        score = np.concatenate([np.zeros(0), *(
            np.einsum("ij,ij->i", left[at[i:i + step]], exact[text[i:i + step]]) for i in range(0, len(at), step))])
    score = np.round(score, 9)
    good = (score > 0) & (score >= beat[at])
    return at[good], some[text[good]], score[good]


def _best_of_block(k: int, idf: np.ndarray) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def best(asked: pa.Table, texts: pa.Table) -> pa.Table:
        """The ``k`` best texts of a cell for each of its queries, ties by number; none with a score of 0 or under ``least``."""
        texts = texts.take(pc.sort_indices(texts, [("number", "ascending")], null_placement="at_start"))
        asked = asked.take(pc.sort_indices(asked, [("lead", "ascending")]))  # queries of like terms side by side
        beat = asked["least"].to_numpy() - MARGIN
        rows = max(1, CELLS // len(idf))
        step = max(1, CELLS // rows)
        held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for start in range(0, texts.num_rows, rows):
            exact = _matrix(texts.slice(start, rows), idf)
            right = np.ascontiguousarray(exact.T, np.float32)
            has, found = right > 0, [held]
            for first in range(0, asked.num_rows, step):
                part = asked.slice(first, step)
                left = _matrix(part, idf)
                looked = left > 0
                looked[_flat(part["idle"])] = False
                at, text, score, _ = _first(k, *_reaching(k, left, looked, exact, right, has, beat[first:first + step]))
                found.append((at + first, text + start, score))
            *held, rank = _first(k, *map(np.concatenate, zip(*found)))
            full = rank == k - 1
            beat[held[0][full]] = np.maximum(beat[held[0][full]], held[2][full])
        at, text, score = held
        return pa.table({"query": asked["query"].take(pa.array(at)), "number": texts["number"].take(pa.array(text)),
                         "score": pa.array(score)})
    return best


def _best_in_blocks(asked: DataFrame, texts: DataFrame, idf: np.ndarray, *, k: int, split: int) -> DataFrame:
    """Scores of each query's ``k`` best texts at least, from products of blocks of queries and texts.

    A task has a group of queries and one of texts, packed, and multiplies them block by
    block. Only groups are copied: queries once per group of texts, texts once per group of
    queries. Of a task only ``k`` rows per query leave it, none under the query's ``least``.
    """
    context, many = texts.sparkSession.sparkContext, asked.count()
    text_groups = max(1, ceil(texts.count() / split))
    # Texts stay together for as many cores as there are: what a query has to beat grows with each block.
    blocks, tasks = ceil(many * len(idf) / CELLS * BLOCKS), ceil(4 * context.defaultParallelism / text_groups)
    asked_groups = max(1, ceil(many / split), min(blocks, tasks))
    dealt = lambda key, groups: f"pmod(xxhash64({key}), {groups})"
    left = asked.selectExpr("query", "places", "tfs", "norm", "places[0] AS lead", "idle", "least",
                            f"{dealt('query', asked_groups)} AS a", f"explode(sequence(0L, {text_groups - 1}L)) AS b")
    right = texts.selectExpr("number", "places", "tfs", "norm", f"explode(sequence(0L, {asked_groups - 1}L)) AS a",
                             f"{dealt('number', text_groups)} AS b")
    number, query = texts.schema["number"].dataType, asked.schema["query"].dataType
    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(
        _best_of_block(k, idf), f"query {query.simpleString()}, number {number.simpleString()}, score double")


def find_similar_for_each(queries: DataFrame, closed: DataFrame, *, stop_words: list[str], k: int = 5,
                          size: int = VOCABULARY_SIZE, text_col: str = "feature_text",
                          split: int = SPLIT) -> DataFrame:
    """For each row of ``queries`` (number, text) the ``k`` closed issues closest to it: query, rank, number, similarity.

    The same rows as :func:`find_similar_issues` for each text. Texts and queries are packed,
    one row each, and meet in groups of at most ``split``, whose pairs are scored where they
    meet: no row per pair, or per pair and term, is ever written. A term's weight in any
    text is bounded, and so is what it can add to a query's scores. The texts that hold each
    term heaviest, ``k`` per term, give a query a score to beat. Its commonest terms that together
    cannot reach that score are then not looked up: a text that has no other term of it
    is left out. Nothing that could be among the ``k`` is lost. Texts that share no term
    with a query have 0 and follow by number; several rows of one query number are one text.

    A query of common terms meets most texts, on many terms each. Where its terms are held
    more than ``DENSE`` times per text, all of them are looked up.
    """
    fitted = TermWeights(closed, size=size, stop_words=stop_words, text_col=text_col, keep=written)
    # At most ``size`` rows, as are those of ``terms_`` below.
    places = written(fitted.idf.selectExpr("term", "idf", "row_number() OVER (ORDER BY idf DESC, term) - 1 AS place"), "places")
    idf = np.array([row.idf for row in places.orderBy("place").collect()])
    texts = written(_packed(fitted.counts, places), "texts")
    weights = _unpacked(texts, places)
    # How many texts have a term, and its greatest weight in any.
    terms_ = written(places.join(weights.groupBy("term").agg(
        F.expr("count(1) AS df"), F.expr("max(weight) AS most")), "term"), "terms")

    documents = closed.agg(F.expr("count(1)")).scalar()
    asked = written(_packed(fitted.counts_of(queries.select("number", text_col)), terms_, "sum(df) AS met").filter(
        "number IS NOT NULL").withColumn("documents", documents).selectExpr(
        "number AS query", "places", "tfs", "norm", f"met > {DENSE} * documents AS dense"), "asked")

    # At most ``k * size`` texts, and whole scores of the best of them.
    heaviest = weights.selectExpr("number", "row_number() OVER (PARTITION BY term ORDER BY weight DESC, number) AS place")
    heaviest = texts.join(F.broadcast(heaviest.filter(F.col("place") <= k).select("number").distinct()), "number")
    free = asked.selectExpr("*", "CAST(array() AS array<int>) AS idle", "0D AS least")
    beat = _nearest(_best_in_blocks(free, heaviest, idf, k=k, split=split), k).groupBy("query").agg(
        F.expr(f"if(count(1) = {k}, min(score), 0D) AS least"))
    scored = written(asked.join(beat, "query", "left").withColumn("least", F.expr("coalesce(least, 0D)")), "least")

    # What a query's commonest terms can add together.
    bounds = _unpacked(scored.filter("NOT dense"), terms_).selectExpr(
        "query", "term", "place", "least", "weight * most AS bound").selectExpr(
        "*", "sum(bound) OVER (PARTITION BY query ORDER BY bound, term) AS reach")
    bounds = written(bounds.selectExpr("*", f"reach < least - {MARGIN} AS idle"), "bounds")
    idle = bounds.filter("idle").groupBy("query").agg(F.expr("collect_list(place) AS idle"))
    scored = scored.join(idle, "query", "left").withColumn("idle", F.expr("coalesce(idle, CAST(array() AS array<int>))"))
    best = _best_in_blocks(scored, texts, idf, k=k, split=split)

    # Whoever meets fewer than k texts goes on with the smallest numbers.
    lowest = closed.select("number").distinct().orderBy("number").limit(k).agg(
        F.expr("collect_list(number)")).scalar()
    every = queries.selectExpr("number AS query").distinct().withColumn("number", F.explode(lowest)).selectExpr(
        "query", "number", "0D AS score")
    scores = best.unionByName(every).groupBy("query", "number").agg(F.expr("round(sum(score), 9) AS score"))
    return _nearest(scores, k).selectExpr("query", "rank", "number", "score AS similarity")
