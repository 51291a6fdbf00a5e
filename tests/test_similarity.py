import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.frames import rows_by
from tracklens.operators import similarity
from tracklens.operators.similarity import find_similar_for_each, find_similar_issues, tfidf

TEXTS = {
    1: "bug in login system authentication failed", 2: "feature request add dark mode to settings",
    3: "Login LOGIN crash, login again: x é été", 4: "", 5: "bug in login system authentication failed",
}
STOP = ["in", "to"]


def frame(spark):
    return spark.createDataFrame(
        [(n, t, f"title {n}") for n, t in TEXTS.items()],
        "number bigint, feature_text string, title string")


def brute(texts, size):
    words = {n: [w for w in re.findall(r"\b\w\w+\b", t.lower()) if w not in STOP]
             for n, t in texts.items()}
    totals = Counter(w for ws in words.values() for w in ws)
    vocabulary = sorted(totals, key=lambda w: (-totals[w], w))[:size]
    df = Counter(w for ws in words.values() for w in set(ws) if w in vocabulary)
    idf = {w: math.log((1 + len(texts)) / (1 + df[w])) + 1 for w in vocabulary}

    def weigh(text):
        tf = Counter(w for w in re.findall(r"\b\w\w+\b", text.lower()) if w in idf)
        raw = {w: n * idf[w] for w, n in tf.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        return {w: v / norm for w, v in raw.items()}
    return weigh, words


@pytest.mark.parametrize("size", [5, 300])
def test_weights_by_brute_force(spark, size):
    got = {k: r["weight"] for k, r in rows_by(
        tfidf(frame(spark), stop_words=STOP, size=size), "number", "term").items()}
    weigh, _ = brute(TEXTS, size)
    want = {(n, w): v for n, t in TEXTS.items() for w, v in weigh(t).items()}
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_similar(spark):
    asked = "user login authentication problem with password"
    found = find_similar_issues(frame(spark), asked, stop_words=STOP, k=5).collect()
    weigh, _ = brute(TEXTS, 300)
    query = weigh(asked)
    want = {n: sum(v * query.get(w, 0) for w, v in weigh(t).items()) for n, t in TEXTS.items()}
    order = sorted(want, key=lambda n: (-round(want[n], 9), n))
    assert [r.number for r in found] == order
    assert order[:2] == [1, 5]
    assert all(r.similarity == pytest.approx(want[r.number], abs=1e-8) for r in found)
    assert all(0 <= r.similarity <= 1 for r in found)
    assert found[0].title == "title 1"


def test_nothing_in_common_and_nothing_closed(spark):
    found = find_similar_issues(frame(spark), "zzz", stop_words=STOP, k=2).collect()
    assert [(r.number, r.similarity) for r in found] == [(1, 0.0), (2, 0.0)]
    assert find_similar_issues(frame(spark).limit(0), "login", stop_words=STOP).count() == 0


def made(seed, n, words):
    """Texts of words whose frequencies fall off, some of them copies."""
    rng = random.Random(seed)
    common = [f"w{min(int(rng.expovariate(0.08)), words - 1)}" for _ in range(20 * n)]
    texts = [" ".join(rng.sample(common, rng.randrange(0, 14))) for _ in range(n)]
    return texts + texts[:3]


@pytest.mark.parametrize("size, split, k", [(300, 100_000, 5), (300, 7, 5), (12, 3, 1)])
def test_many_texts_at_once_equal_the_single_form(spark, size, split, k):
    closed = spark.createDataFrame([(n, t, f"title {n}") for n, t in enumerate(made(1, 120, 60))],
                                   "number bigint, feature_text string, title string").cache()
    asked = [(1000 + n, t) for n, t in enumerate([*made(2, 6, 60), "zzz", "", None])]
    queries = spark.createDataFrame(asked, "number bigint, feature_text string")
    found = find_similar_for_each(queries, closed, stop_words=STOP, k=k, size=size, split=split).collect()
    assert len(found) == k * len(asked)
    for number, text in asked:
        single = find_similar_issues(closed, text or "", stop_words=STOP, k=k, size=size).collect()
        got = sorted((r.rank, r.number, r.similarity) for r in found if r.query == number)
        assert got == [(place, r.number, pytest.approx(r.similarity, abs=2e-9)) for place, r in enumerate(single, 1)]


def test_common_terms_are_multiplied_in_blocks(spark, monkeypatch):
    """Texts that all share many terms meet in blocks, not as joined rows per term; blocks of any size agree."""
    monkeypatch.setattr(similarity, "CELLS", 40 * 30)
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(30)}"
    closed = spark.createDataFrame([(n, " ".join(word() for _ in range(60)), "t") for n in range(150)],
                                   "number bigint, feature_text string, title string").cache()
    asked = [(1000 + n, " ".join(word() for _ in range(60))) for n in range(50)]
    queries = spark.createDataFrame(asked, "number bigint, feature_text string")
    seen = {}
    keep = similarity.written
    monkeypatch.setattr(similarity, "written", lambda df, name: seen.setdefault(name, keep(df, name)))
    found = find_similar_for_each(queries, closed, stop_words=STOP, k=3, size=30).collect()
    assert seen["asked"].count() == 50 and seen["bounds"].count() == 0
    assert len(found) == 150
    for number, text in asked[:4]:
        single = find_similar_issues(closed, text, stop_words=STOP, k=3, size=30).collect()
        assert sorted((r.rank, r.number, r.similarity) for r in found if r.query == number) == [
            (place, r.number, pytest.approx(r.similarity, abs=2e-9)) for place, r in enumerate(single, 1)]


def test_bounds_leave_terms_out(spark, monkeypatch):
    """Common terms that cannot matter are not looked up, and results stay the same."""
    texts = [f"rare{n} rare{n}x common shared" for n in range(40)] + ["common shared"] * 40
    closed = spark.createDataFrame(list(enumerate(texts)), "number bigint, feature_text string")
    queries = spark.createDataFrame([(900, texts[3]), (901, texts[8])], "number bigint, feature_text string")
    seen = {}
    keep = similarity.written
    monkeypatch.setattr(similarity, "written", lambda df, name: seen.setdefault(name, keep(df, name)))
    found = find_similar_for_each(queries, closed, stop_words=STOP, k=1).collect()
    assert [(r.query, r.number) for r in sorted(found)] == [(900, 3), (901, 8)]
    idle = {(r.query, r.term) for r in seen["bounds"].filter("idle").collect()}
    assert {(900, "common"), (900, "shared"), (901, "common")} <= idle


@pytest.mark.parametrize("split", [100_000, 50])
def test_no_row_per_pair_leaves_a_group(spark, monkeypatch, split):
    """Also queries of few terms are scored where groups meet: k rows each leave a group, however many texts they meet."""
    monkeypatch.setattr(similarity, "CELLS", 40 * 30)
    texts = [" ".join(f"w{j}" for j in range(30) if (n * 7 + j * 11) % 10 < 4) for n in range(200)]
    closed = spark.createDataFrame(list(enumerate(texts)), "number bigint, feature_text string").cache()
    asked = [(1000 + n, f"w{n % 30} w{n * 7 % 30} w{n * 3 % 30}") for n in range(40)]
    queries = spark.createDataFrame(asked, "number bigint, feature_text string")
    left, score = [], similarity._best_in_blocks
    monkeypatch.setattr(similarity, "_best_in_blocks", lambda *a, **b: left.append(score(*a, **b).cache()) or left[-1])
    found = find_similar_for_each(queries, closed, stop_words=STOP, k=3, size=30, split=split).collect()
    assert len(found) == 120
    groups = -(-len(texts) // split)
    assert 120 <= left[-1].count() <= 120 * groups
    assert {r.query for r in left[-1].collect()} == {n for n, _ in asked}
    for number, text in asked[:3]:
        single = find_similar_issues(closed, text, stop_words=STOP, k=3, size=30).collect()
        assert sorted((r.rank, r.number, r.similarity) for r in found if r.query == number) == [
            (place, r.number, pytest.approx(r.similarity, abs=2e-9)) for place, r in enumerate(single, 1)]


@pytest.mark.parametrize("few", [20, 0, 10 ** 9])
def test_pairs_are_left_out_only_if_they_cannot_be_among_the_best(few, monkeypatch):
    """Blocks by single precision first give what whole products give, ties by number, alone or as a block."""
    monkeypatch.setattr(similarity, "CELLS", 30 * 40)
    monkeypatch.setattr(similarity, "FEW", few)
    rng = random.Random(3)
    idf = np.array([1 + 0.1 * n for n in range(30)])

    def packed(n, key, copies):
        held = [sorted(rng.sample(range(30), rng.randrange(1, 9))) for _ in range(n)]
        held = [*held, *held[:copies]] if copies else held
        tfs = [[1 + (p * 5 + len(ps)) % 3 for p in ps] for ps in held]
        norm = [math.sqrt(sum((t * idf[p]) ** 2 for p, t in zip(ps, ts))) for ps, ts in zip(held, tfs)]
        keys = rng.sample(range(10 ** 6), len(held))
        return pa.table({key: keys, "places": pa.array(held, pa.list_(pa.int32())), "tfs": pa.array(tfs, pa.list_(pa.int32())), "norm": norm})

    texts, asked = packed(150, "number", 40), packed(60, "query", 0)
    whole = np.round(similarity._matrix(asked, idf) @ similarity._matrix(texts, idf).T, 9)
    want = {}
    for query, row in zip(asked["query"].to_pylist(), whole):
        best = sorted((-score, number) for score, number in zip(row, texts["number"].to_pylist()) if score > 0)[:4]
        want[query] = [(number, pytest.approx(-score, abs=2e-9)) for score, number in best]
    lead = pa.array([p[0] for p in asked["places"].to_pylist()], pa.int32())
    asked = asked.append_column("lead", lead).append_column("least", pa.array([0.0] * 60)).append_column(
        "idle", pa.array([[]] * 60, pa.list_(pa.int32())))
    found = similarity._best_of_block(4, idf)(asked, texts)
    got = {query: [] for query in want}
    for row in sorted(found.to_pylist(), key=lambda r: (-r["score"], r["number"])):
        got[row["query"]].append((row["number"], row["score"]))
    assert got == want


def test_many_texts_without_closed_ones(spark):
    queries = spark.createDataFrame([(1, "login")], "number bigint, feature_text string")
    assert find_similar_for_each(queries, frame(spark).limit(0), stop_words=STOP).count() == 0
    assert find_similar_for_each(queries.limit(0), frame(spark), stop_words=STOP).count() == 0
