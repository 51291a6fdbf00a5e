"""Mixing sources to target weights (operator 9), in DataFrame functions alone.

A source's weight is its share of tokens to the power of an exponent: 1 keeps the corpus as
it is, 0 makes all sources equal. The exponent is bisected to the target, six steps at a
time. Each source then gets a budget of tokens, which is spent on whole passes over its
documents and one pass over some of them. A pass goes through the documents in the order of a
hash. A table of blocks of that order tells where the rest of the budget ends, so that only
the block it ends in is looked at row by row; from there the pass goes on with documents that
still fit, so a long one in the way costs a source nothing.
"""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklens.llm.storage import stored

BLOCK = 1024    # documents in a block, about
ROUNDS = 6      # of the search; each narrows the exponent 64 times
STEPS = 64
FILLS = 40      # times that the last pass goes on past a document that doesn't fit, at most
CLOSE = 1000    # it stops once less than one part in so many of a source's quota is left
NONE = "\x00"   # stands for a null source

WORDS = r"[^ \t-\r]+"


def measured(docs: DataFrame) -> DataFrame:
    """``_row`` (all columns), ``_source``, ``_tokens`` (words) and ``_pos``, the place in every pass, 0 to 1."""
    digest = F.md5(F.concat_ws("\x01", F.col("doc_id").cast("string"), F.col("text")).cast("binary"))
    place = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") / float(1 << 48)
    return docs.select(
        F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("_source"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint").alias("_tokens"),
        place.alias("_pos"))


def exponent(sizes: DataFrame, total: int, *, entropy: float | None, repetition: float | None,
             budget: int | None) -> float:
    """The largest exponent that reaches ``entropy``, or the smallest within ``repetition``.

    ``entropy`` is a share of the greatest possible one; ``repetition`` is the number of times
    any source may be gone through. 0 to 1 in either case: where even 0 misses the entropy, or
    1 the limit, that end is the answer.
    """
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / STEPS for k in range(STEPS + 1)]
        power = F.pow("p", F.col("e"))
        rows = sizes.filter("tokens > 0").select((F.col("tokens") / total).alias("p")).select(
            "p", F.explode(F.array(*map(F.lit, grid))).alias("e")).groupBy("e").agg(
            F.sum(power).alias("z"), F.sum(power * F.ln("p")).alias("l"), F.count("*").alias("n"),
            F.max(power / F.col("p")).alias("most"), F.min(power / F.col("p")).alias("least")).collect()
        good = []
        for row in rows:  # one row for each exponent of the grid
            if entropy is not None:
                share = math.log(row.z) - row.e * row.l / row.z
                good.append((row.e, share >= entropy * math.log(row.n)))
            else:
                times = row.most / row.least if budget is None else row.most / row.z * budget / total
                good.append((row.e, times <= repetition))
        fits = sorted(e for e, ok in good if ok)
        step = (high - low) / STEPS
        if entropy is not None:
            low = fits[-1] if fits else low
            high = min(high, low + step) if fits else low
        else:
            high = fits[0] if fits else high
            low = max(low, high - step) if fits else high
        if low == high:
            break
    return low if entropy is not None else high


def plan(docs: DataFrame, *, entropy: float | None = None, repetition: float | None = None,
         budget: int | None = None) -> DataFrame:
    """One row per source: tokens, weight, quota, whole passes, and the runs of the pass after them.

    ``until`` is the place where the first of these runs ends; ``spent`` and ``realised`` are
    the tokens that come out and their share of all.

    ``docs`` comes from :func:`measured`. Without a budget every source is gone through at
    least once, the least repeated one exactly once.
    """
    if (entropy is None) == (repetition is None):
        raise ValueError("give either an entropy or a repetition limit")
    rows = stored(docs.select("_source", "_tokens", "_pos"), "places")
    sizes = stored(rows.groupBy("_source").agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("n")), "sizes")
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        none = F.expr("cast(null AS array<struct<after:double,until:double,most:bigint>>)")
        return sizes.select("_source", "tokens", F.lit(0.0).alias("weight"), F.col("tokens").alias("quota"),
                            F.lit(1).cast("bigint").alias("passes"), F.lit(-1.0).alias("until"), none.alias("runs"),
                            F.col("tokens").alias("spent"), F.lit(0.0).alias("realised"))
    e = exponent(sizes, total, entropy=entropy, repetition=repetition, budget=budget)
    p = F.col("tokens") / total
    power = F.when(F.col("tokens") > 0, F.pow(p, F.lit(e))).otherwise(0.0)
    scale = sizes.select(F.sum(power).alias("z"), F.min(F.when(F.col("tokens") > 0, power / p)).alias("least")).first()
    spend = float(budget) if budget is not None else total * scale.z / scale.least
    # a hair more than the quotient, so that rounding doesn't cost a whole multiple its last word
    quota = F.floor(F.lit(spend) * power / scale.z + 1e-6).cast("bigint")
    if budget is None:  # doubles round by more than that hair at some 1e10 words; a whole pass is due in any case
        quota = F.greatest(quota, F.col("tokens"))
    share = sizes.select("_source", "tokens", "n", (power / scale.z).alias("weight"), quota.alias("quota")).withColumn(
        "passes", F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(1).cast("bigint"))
    share = share.withColumn("rest", F.when(
        F.col("tokens") > 0, F.col("quota") - F.col("passes") * F.col("tokens")).otherwise(0))
    share = stored(share, "shares")
    runs = stored(_last_pass(rows, share), "last-pass")
    taken = runs.groupBy("_source").agg(
        F.sum("taken").alias("taken"), F.min("until").alias("until"),
        F.sort_array(F.collect_list(F.struct("after", "until", "most"))).alias("runs"))  # FILLS at most
    spent = F.col("passes") * F.col("tokens") + F.coalesce("taken", F.lit(0))
    out = stored(share.join(taken, "_source", "left").withColumn("spent", spent), "plan")
    all_spent = max(out.agg(F.sum("spent")).first()[0] or 0, 1)
    return out.select("_source", "tokens", "weight", "quota", "passes", F.coalesce("until", F.lit(0.0)).alias("until"),
                      "runs", "spent", (F.col("spent") / all_spent).alias("realised"))


def _last_pass(rows: DataFrame, share: DataFrame) -> DataFrame:
    """(_source, after, until, most, taken): runs of the last pass.

    A run takes the documents of at most ``most`` tokens whose place lies between ``after``
    and ``until``, ``taken`` tokens in all. It ends before the first one that would overrun;
    what is left of the budget goes to the next run, behind that document.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    state = share.filter("rest > 0 AND tokens > 0").select(
        "_source", "quota", blocks.alias("blocks"), "rest", F.lit(-1.0).alias("after"))
    schema = "_source string, after double, until double, most bigint, taken bigint"
    found = rows.sparkSession.createDataFrame([], schema)
    for _ in range(FILLS):
        state = stored(state, "open")
        if state.isEmpty():
            break
        placed = rows.join(state, "_source").filter("_tokens <= rest AND _pos > after").withColumn(
            "block", F.floor(F.col("_pos") * F.col("blocks")))
        sums = placed.groupBy("_source", "block").agg(F.sum("_tokens").alias("here"), F.max("rest").alias("rest"))
        so_far = F.sum("here").over(Window.partitionBy("_source").orderBy("block"))
        sums = stored(sums.withColumn("end", so_far), "block-sums")
        ends = sums.filter("end > rest").groupBy("_source").agg(F.min(F.struct("block", "end", "here")).alias("x")).select(
            "_source", F.col("x.block").alias("last"), (F.col("x.end") - F.col("x.here")).alias("before"))
        inside = placed.join(ends, "_source").filter("block = last").groupBy("_source", "_pos").agg(
            F.sum("_tokens").alias("here"), F.max("rest").alias("rest"), F.max("before").alias("before"))
        reach = F.col("before") + F.sum("here").over(Window.partitionBy("_source").orderBy("_pos"))
        stops = inside.withColumn("reach", reach).filter("reach > rest").groupBy("_source").agg(
            F.min(F.struct("_pos", "reach", "here")).alias("x")).select(
            "_source", F.col("x._pos").alias("until"), (F.col("x.reach") - F.col("x.here")).alias("taken"))
        whole = sums.groupBy("_source").agg(F.max("end").alias("whole"))
        done = stored(state.join(whole, "_source", "left").join(stops, "_source", "left").select(
            "_source", "quota", "blocks", "rest", "after", F.coalesce("until", F.lit(2.0)).alias("until"),
            F.coalesce("taken", "whole", F.lit(0)).alias("taken")), "runs")
        found = found.unionByName(done.select("_source", "after", "until", F.col("rest").alias("most"), "taken"))
        state = done.withColumn("rest", F.col("rest") - F.col("taken")).filter(
            f"until <= 1 AND rest * {CLOSE} > quota").select("_source", "quota", "blocks", "rest", F.col("until").alias("after"))
    return found


def mixed(docs: DataFrame, *, entropy: float | None = None, repetition: float | None = None,
          budget: int | None = None) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, source) as often as the weights ask for.

    Adds ``pass_no`` (from 1) and ``place``, 0 to 1: ordered by it, every source is spread
    evenly over the mixture. Existing columns of these names are replaced. A null source is a
    source of its own; a null text has no tokens. Equal rows share a place. A source without
    tokens is gone through once. The last pass of a source leaves out documents that would
    overrun its budget, such as a very long one, and goes on with those that fit, until less
    than a thousandth of the budget is left or nothing fits. :func:`plan` has the target
    (``weight``) and the realised weight of each source. A very long text is one row, whole.
    """
    base = measured(docs.drop("pass_no", "place"))
    shares = stored(plan(base, entropy=entropy, repetition=repetition, budget=budget).select(
        "_source", "passes", "runs", "quota", "tokens"), "plan")
    joined = base.join(shares, "_source")
    last = F.coalesce(F.expr("exists(runs, r -> _pos > r.after AND _pos < r.until AND _tokens <= r.most)"), F.lit(False))
    times = (F.col("passes") + last.cast("bigint")).cast("int")
    copies = joined.withColumn("_times", times).filter("_times > 0").withColumn(
        "pass_no", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    spans = F.greatest(F.col("quota") / F.greatest("tokens", F.lit(1)), F.col("passes") + F.lit(0.0), F.col("pass_no") + F.lit(0.0))
    return copies.select("_row.*", "pass_no", ((F.col("pass_no") - 1 + F.col("_pos")) / spans).alias("place"))
