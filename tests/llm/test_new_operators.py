"""Vector codes, quality classifier and tokenizer alignment: awkward cases, SQL and brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.check_oracle import differences
from tests.llm import frames
from tracklens.llm import alignment, part_codes, quality

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


# --- vector codes ------------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame([(*row, "?", "?") for row in rows],
                                 "vec_id bigint, embedding array<float>, label int, code string, row string")


def made(seed, n, width):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width)) * rng.choice([0.02, 0.5], size=(n, 1))
    rows[n // 2:n // 2 + 20] = rows[3]
    return [(int(i), [float(x) for x in row], [None, 1, 2][i % 3]) for i, row in enumerate(rows.astype(np.float32))]


def brute_codes(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0]))
    cuts = part_codes.cuts(len(kept[0][1]), parts)
    books = [[tuple(v[cut]) for _, v, _ in kept[:entries]] for cut in cuts]

    def nearest(part, book):
        far = [sum((x - y) ** 2 for x, y in zip(part, entry)) for entry in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for k, cut in enumerate(cuts):
            taken = defaultdict(list)
            for _, v, _ in kept:
                taken[nearest(v[cut], books[k])[0]].append(v[cut])
            books[k] = [tuple(sum(x) // len(x) for x in zip(*taken[e])) if e in taken else entry
                        for e, entry in enumerate(books[k])]
    out, sums = [], Counter()
    for i, v, label in kept:
        found = [nearest(v[cut], books[k]) for k, cut in enumerate(cuts)]
        error = sum(d for _, d in found)
        sums[label] += error
        out.append((i, "".join(f"{e:02x}" for e, _ in found), error, label))
    numbers = ",".join(str(x) for book in books for entry in book for x in entry)
    sha = hashlib.sha256(numbers.encode()).hexdigest()
    return Counter((i, code, error, sums[label], sha) for i, code, error, label in out)


BAD = [(900, None, 1), (901, [], 1), (902, [None] + [1.0] * 9, 1), (903, [float("nan")] * 10, 2),
       (904, [float("inf")] + [0.0] * 9, None)]


@pytest.mark.parametrize("parts, entries", [(4, 16), (2, 256), (3, 1)])
def test_codes_by_brute_force(spark, parts, entries):
    rows = made(parts, 150, 10)
    given_rows = [*rows, *BAD, (None, rows[0][1], 1), (7, rows[7][1], 1)]
    found = part_codes.compressed(vectors(spark, given_rows), parts=parts, entries=entries, rounds=3, scale=1024)
    got = Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found.collect())
    assert got == brute_codes(given_rows, parts, entries, 3, 1024)


def test_codes_by_sql(spark):
    rows = [(i, [float("nan")] * 8 if i % 50 == 49 else v, label) for i, v, label in made(5, 400, 8)]
    df = vectors(spark, rows)
    con = duckdb.connect()
    con.register("given", df.select("vec_id", "embedding", "label").toArrow())
    found = part_codes.compressed(df, entries=32, rounds=2).toPandas()
    assert differences(found, con.sql(part_codes.statement("given", entries=32, rounds=2)).df()) == ""


def test_codes_of_nothing(spark):
    empty = part_codes.compressed(vectors(spark, BAD[:2]))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    one = part_codes.compressed(vectors(spark, [(5, [0.5] * 4, None)])).collect()
    assert [(r.code, r.error, r.label_error) for r in one] == [("00000000", 0, 0)]
    with pytest.raises(Exception, match="more than 31 bits"):
        part_codes.compressed(vectors(spark, [(5, [1e30] * 4, None)])).collect()


@pytest.mark.parametrize("leaves", [1, 3, 256])
@pytest.mark.parametrize("scale", [3, 40_000])
def test_trie_equals_plain_distances(monkeypatch, leaves, scale):
    """Whatever the run of leaves and the width of numbers; parts that start alike and repeat."""
    monkeypatch.setattr(part_codes, "LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    rows, codes = rng.integers(-scale, scale, (500, 4)), rng.integers(-scale, scale, (9, 4))
    codes[5] = codes[2]
    trie = part_codes.Trie(rows)
    chosen, error = trie.nearest(codes)
    far = ((rows[:, None] - codes) ** 2).sum(axis=2)
    assert np.array_equal(chosen[trie.leaf], far.argmin(axis=1)) and np.array_equal(error[trie.leaf], far.min(axis=1))
    assert np.array_equal(trie.leaves[trie.leaf], rows) and trie.weight.sum() == len(rows)
    assert len(trie.leaves) == len(np.unique(rows, axis=0))


# --- quality -----------------------------------------------------------------------------------

def test_quality_separates_what_it_never_saw():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    texts, labels = [], []
    for k in range(400):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(10, 300)))
        if k % 4 == 0:
            text = [text.upper() + "!!", text.replace(" ", " $ "), " ".join(w + " " + w for w in text.split())][k % 3]
        texts.append(text.encode())
        labels.append(k % 4 != 0)
    labels = np.array(labels)
    model = quality.train(quality.described(texts[:300]), labels[:300], np.zeros((300, 0)), examples=12_000)
    score = model.scores(*quality.described(texts[300:]))
    assert ((score >= 0.5) == labels[300:]).mean() >= 0.95


def test_scores_equal_the_sum_over_pairs():
    rng = np.random.default_rng(5)
    texts = ["a b b c", "", "one two three", "a " * 300]
    edges = [np.sort(rng.normal(size=quality.BINS - 1)) for _ in range(len(quality.STATISTICS) + 1)]
    n = (1 << quality.BITS) + (quality.BINS + 1) * len(edges)
    model = quality.Model(0.3, rng.normal(size=n), rng.normal(size=(n, 3)), edges)
    ids, values, own, numbers = quality.described([x.encode() for x in texts])
    numbers = np.column_stack([numbers, [1.0, np.nan, 2.0, 3.0]])
    got = model.scores(ids, values, own, numbers)
    ids, values, own = model.coordinates(ids, values, own, numbers)
    at = 0
    for k, size in enumerate(own):
        i, x = ids[at:at + size], values[at:at + size]
        at += size
        z = model.bias + sum(model.weights[i] * x)
        z += sum(model.vectors[i[p]] @ model.vectors[i[q]] * x[p] * x[q] for p in range(size) for q in range(p))
        assert got[k] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_quality_on_awkward_tables(spark):
    docs = frames.documents(spark)
    labels = spark.createDataFrame([(1, 1), (5, 0), (8, 0), (10, 1), (12, 7), (14, None), (None, 1)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels, metadata=["n_chars"])
    found = quality.scored(docs, model, metadata=["n_chars"])
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    alike = defaultdict(set)
    for r in rows:
        alike[r.doc_id].add(r.score)
    assert alike[5] == alike[6] and alike[1] == alike[7] and len(alike[11]) == 1
    none = frames.documents(spark, [])
    assert quality.scored(none, model, metadata=["n_chars"]).count() == 0
    untaught = quality.fit(none, labels, metadata=["n_chars"])
    assert {r.score for r in quality.scored(docs, untaught, metadata=["n_chars"]).collect()} == {0.5}


# --- alignment ---------------------------------------------------------------------------------

def _bytes():
    letters = alignment._letters()
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    of_a = {i: bytes(letters[x] for x in t) for t, i in a.get_vocab().items()}
    of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(b.get_piece_size())]
    return a, b, of_a, of_b


PLAIN = _bytes()


def brute_alignment(rows):
    """Results of the contract, one token pair at a time, by the libraries' plain calls on whole texts."""
    a, b, of_a, of_b = PLAIN
    out, count = [], Counter()
    for doc, text in rows:
        whole = (" " + text).encode() if text else b""
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if not text or b"".join(map(of_a.__getitem__, ids[0])) != whole or b"".join(map(of_b.__getitem__, ids[1])) != whole:
            out.append((doc, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(names[i]) for i in own]).tolist() for names, own in zip((of_a, of_b), ids)]
        starts = [[0, *x[:-1]] for x in ends]
        links, j0 = [], 0
        for i in range(len(ids[0])):
            while ends[1][j0] <= starts[0][i]:
                j0 += 1
            j = j0
            while j < len(ids[1]) and starts[1][j] < ends[0][i]:
                links.append((ids[0][i], ids[1][j]))
                j += 1
        cuts, at = sorted(set(ends[0]) & set(ends[1])), 0
        groups = []
        for cut in cuts:
            groups.append("|".join(",".join(str(x) for x, e in zip(own, end) if at < e <= cut)
                                   for own, end in zip(ids, ends)) if len(cuts) < 300 else None)
            at = cut
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None
        count.update(set(links))
        out.append((doc, len(ids[0]), len(ids[1]), links, (len(cuts), sha)))
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [(doc, n_a, n_b, g[0] if g else 0, len(links), sum(count[x] == best[x[0]] for x in links),
             sum(count[x] for x in links), g[1] if g else "") for doc, n_a, n_b, links, g in out]


def aligned(spark, rows):
    found = alignment.align(frames.documents(spark, rows), path_a=A, path_b=B, pattern=public_tokenizers.PATTERN)
    return Counter(tuple(r) for r in found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                                  "groups_sha256").collect())


def same(got, want):
    """Digests are left out where brute force has none (long texts)."""
    known = {(*w[:-1], w[-1]) for w in want if w[-1] is not None}
    short = Counter(w[:-1] for w in want)
    assert Counter({k: sum(n for g, n in got.items() if g[:-1] == k) for k in short}) == short
    assert all(g in known for g in got if any(g[:-1] == w[:-1] and w[-1] is not None for w in want))
    assert sum(got.values()) == len(want)


def test_alignment_by_brute_force(spark):
    same(aligned(spark, frames.texts(spark)), brute_alignment(frames.texts(spark)))


def test_alignment_on_awkward_texts(spark):
    rows = frames.awkward_texts() + [
        (20, "a ▁ b"), (21, "<s> x </s> <|endoftext|> <unk>"), (22, " lead"), (23, "trail "), (24, "a  b   c\n\n d\t e"),
        (25, "𝄞 clef 日本語 é é"), (26, "a\x00b c　d\x1ce"), (27, " "), (28, "\n")]
    same(aligned(spark, rows), brute_alignment(rows))
    assert aligned(spark, []) == Counter()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t.'s9　 \x1c\x85İ日𝄞  "), max_size=40), min_size=1, max_size=5))
def test_quick_merges_give_the_ids_of_the_file(texts):
    raw = [t.encode() for t in texts]
    plain, quick = (alignment.tokenizers_of(A, B, p) for p in (None, public_tokenizers.PATTERN))
    assert plain.quick is None and quick.quick is not None
    for one, other in zip(plain.encode(raw), quick.encode(raw), strict=True):
        assert all(np.array_equal(x, y) for x, y in zip(one, other, strict=True))


def test_quick_merges_on_every_character():
    plain, quick = (alignment.tokenizers_of(A, B, p) for p in (None, public_tokenizers.PATTERN))
    codes = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(codes), 50_000):
        texts = [f" a{c}b 1{c}2 {c} .{c}" for c in codes[at:at + 50_000]]
        assert plain._encode_a(texts) == quick._encode_a(texts)


@pytest.mark.parametrize("lane", [1, 2, 7, 1000])
def test_lockstep_by_brute_force(lane):
    rng = np.random.default_rng(lane)
    total, last, ends = 0, [], [[], []]
    for size in rng.integers(1, 60, 30):
        for side in ends:
            side.extend(sorted({*(total + rng.integers(1, size + 1, size // 2)).tolist(), total + int(size)}))
        total += int(size)
        last.append(len(ends[0]) - 1)
    a, b = (np.array(x) for x in ends)
    i, j, cuts = alignment.lockstep(a, b, np.array(last), lane=lane)
    start_a, start_b = np.concatenate(([0], a[:-1])), np.concatenate(([0], b[:-1]))
    want = {(x, y) for x in range(len(a)) for y in range(len(b)) if start_a[x] < b[y] and start_b[y] < a[x]}
    assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
    assert {(x, y) for x, y, c in zip(i.tolist(), j.tolist(), cuts) if c} == {p for p in want if a[p[0]] == b[p[1]]}
