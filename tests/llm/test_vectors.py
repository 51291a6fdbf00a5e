"""Operators on vectors: awkward cases, exactness and recall against brute force."""

import numpy as np

from tests.llm import frames
from tracklens.llm import forest, multi_index

BAD = [None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "?") for i, v in rows],
                                 "vec_id bigint, embedding array<float>, label int, cell string")


def made(seed=0, n=300, width=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = centres[rng.integers(12, size=n)] + rng.normal(size=(n, width)) * rng.choice([0.1, 0.6], size=(n, 1))
    rows = rows.astype(np.float32)
    if n > 60:
        rows[50:60] = rows[49]
    return [(int(i), [float(x) for x in row]) for i, row in enumerate(rows)]


def test_near_duplicates(spark):
    good = made()
    given = [*good, *((1000 + k, v) for k, v in enumerate(BAD)), (None, good[0][1]), (None, None)]
    found = multi_index.near_duplicates(table(spark, given), cosine=0.9).collect()
    x = np.array([v for _, v in good], np.float64)
    x /= np.sqrt((x**2).sum(1))[:, None]
    near = x @ x.T >= 0.9
    pairs = [(a, b) for a, b in zip(*np.nonzero(near)) if a != b]
    got = {r.vec_id: r for r in found if r.vec_id is not None}
    total = sum(got[i].n_links for i, _ in good)
    assert 0.9 * len(pairs) <= total <= len(pairs)
    assert all(got[i].n_links <= near[i].sum() - 1 for i, _ in good)
    want = frames.groups(range(len(good)), pairs)
    same = sum(got[i].component_id == want[i] for i, _ in good)
    assert same >= 0.9 * len(good)
    for k in range(len(BAD)):
        assert (got[1000 + k].n_links, got[1000 + k].component_id, got[1000 + k].kept) == (0, 1000 + k, True)
    assert len(found) == len(given) and all(r.kept and r.component_id is None for r in found if r.vec_id is None)


def test_links_just_above_the_threshold(spark):
    """Planted pairs at cosines of 0.90 to 0.93, the hardest to meet, and none below."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3000, 32))
    base /= np.sqrt((base**2).sum(1))[:, None]
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(1)[:, None] * base
    away /= np.sqrt((away**2).sum(1))[:, None]
    near = rng.uniform(0.9005, 0.93, (3000, 1))
    rows = np.concatenate([base, near * base + np.sqrt(1 - near**2) * away]).astype(np.float32)
    found = multi_index.near_duplicates(table(spark, [(int(i), row.tolist()) for i, row in enumerate(rows)]), cosine=0.9).collect()
    x = rows.astype(np.float64)
    x /= np.sqrt((x**2).sum(1))[:, None]
    links = (x @ x.T >= 0.9).sum() - len(x)
    assert 0.95 * links <= sum(r.n_links for r in found) <= links


def test_rank_is_the_place_in_the_traversal():
    rng = np.random.default_rng(4)
    for _ in range(50):
        near, far = rng.random(11), rng.random(6)
        cells = multi_index.traversal(near, far, 66)
        assert [multi_index.rank(near, far, i, j) for i, j in cells] == list(range(1, 67))


def test_traversal_is_ordered():
    rng = np.random.default_rng(1)
    near, far = rng.random(9), rng.random(7)
    cells = multi_index.traversal(near, far, 63)
    sums = [near[i] + far[j] for i, j in cells]
    assert len(set(cells)) == 63 and sums == sorted(sums)


def test_blocks_meet_once(spark, monkeypatch):
    """A hot cell in many blocks gives the same counts as one block."""
    given = made(seed=3, n=200)
    whole = {r.vec_id: tuple(r) for r in multi_index.near_duplicates(table(spark, given)).collect()}
    monkeypatch.setattr(multi_index, "BLOCK", 16)
    assert {r.vec_id: tuple(r) for r in multi_index.near_duplicates(table(spark, given)).collect()} == whole


def test_search(spark):
    good = made(seed=2, n=400)
    given = table(spark, [*good, *((1000 + k, v) for k, v in enumerate(BAD)), (None, good[0][1]), good[7]])
    queries = given.filter("vec_id % 20 = 0")
    found = forest.search(given, queries, k=10).collect()
    x = np.array([v for _, v in good], np.float64)
    hits = 0
    for q in range(0, 400, 20):
        distance = np.sqrt(((x - x[q]) ** 2).sum(1))
        distance[q] = np.inf
        best = np.lexsort((np.arange(400), distance))[:10]
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        order = [(r.score, r.vec_id) for r in mine]
        assert order == sorted(order) and all(abs(r.score - distance[r.vec_id]) < 1e-12 for r in mine)
        hits += len(set(best) & {r.vec_id for r in mine})
    assert hits >= 0.9 * 200 and len(found) == 200


def test_few_and_no_rows(spark):
    few = table(spark, made(n=4)[:4])
    found = forest.search(few, few.filter("vec_id = 0"), k=10).collect()
    assert sorted(r.vec_id for r in found) == [1, 2, 3]
    none = table(spark, [])
    assert forest.search(none, none).count() == 0
    assert multi_index.near_duplicates(none).count() == 0
