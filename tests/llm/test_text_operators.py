"""Operators on texts: awkward cases and brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tests.llm import frames
from tracklens.llm import byte_bpe, huffman, licences, setsketch, substrings, toxicity
from tracklens.llm.token_ids import WordEncoder


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    for given in (frames.awkward_texts(), frames.texts(spark)):
        found = setsketch.near_duplicates(frames.documents(spark, given), shingle=size, percent=80)
        sizes, group = frames.near(given, size, 80)
        want = Counter((i, n, group.get(i), i is None or group[i] == i) for (i, _), n in zip(given, sizes))
        assert rows(found, "doc_id", "n_shingles", "component_id", "kept") == want


def test_near_duplicates_split_bucket(spark):
    """A chain of copies whose ends are far apart: links must not get lost."""
    rng, words = random.Random(1), [f"w{k}" for k in range(120)]
    given = []
    for i in range(60):
        words[rng.randrange(len(words))] = f"n{i}"
        words[rng.randrange(len(words))] = f"m{i}"
        given.append((i, " ".join(words)))
    found = setsketch.near_duplicates(frames.documents(spark, given), shingle=2, percent=80)
    assert {r.doc_id: r.component_id for r in found.collect()} == frames.near(given, 2, 80)[1]


def test_only_rows_apart_leave_the_bucket_join(spark, monkeypatch):
    words = [f"w{k}" for k in range(150)]
    near = [" ".join(words[:-1] + [f"x{k}"]) for k in range(20)]
    apart = [" ".join(words[:123] + [f"y{k}z{n}" for n in range(27)]) for k in range(4)]  # 0.69 alike
    kept, write = {}, setsketch.stored

    def stored(df, name):
        kept[name] = df, write(df, name)
        return kept[name][1]

    monkeypatch.setattr(setsketch, "stored", stored)
    docs = frames.documents(spark, list(enumerate(near + apart)))
    found = {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs, shingle=2, percent=80).collect()}
    assert found == {k: 0 if k < 20 else k for k in range(24)}
    assert {r.id for r in kept["apart"][1].select("id").collect()} <= {20, 21, 22, 23}  # not the twenty linked ones
    plan = kept["members-of-blocks"][0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # sizes are carried, not looked up again


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 2**63, 900).astype(np.uint64) for _ in range(2))
    b[:600] = a[:600]
    both, one, two = setsketch.registers([np.union1d(a, b), a, b], 512)
    assert np.array_equal(both, np.maximum(one, two))
    guess, gap = setsketch.estimate(one[None], two[None], np.array([900.0]), np.array([900.0]), 0.8)
    assert abs(guess[0] - 0.5) < 0.1 and gap[0] > setsketch.DOUBT


@pytest.mark.parametrize("length", [1, 7, 50])
def test_substrings(spark, length):
    for given in (frames.awkward_texts(), frames.texts(spark)):
        found = substrings.without_repeats(frames.documents(spark, given), length=length)
        want = Counter((i, *x) for (i, _), x in zip(given, frames.without_repeats(given, length)))
        assert rows(found, "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_licences(spark):
    given = [*frames.awkward_texts(), (9000, licences.TEMPLATES[0][1]), (9001, "no " + dict(licences.TEMPLATES)["isc"] + " at all"),
             *frames.texts(spark)]
    found = {}
    for r in licences.scan(frames.documents(spark, given)).collect():
        found.setdefault((r.doc_id, r.n_words), []).append(r)
    for i, text in given:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        want = sorted((k, label) for phrase, label in licences.PHRASES.items() for k in range(len(words))
                      if words[k:k + len(phrase.split())] == phrase.split())
        got = found[i, len(words)][0]
        assert sorted((x.first, x.label) for x in got.phrases) == want
        if i in (9000, 9001):
            assert {"mit", "isc"} & {x.label for x in got.spans} and max(x.covered for x in got.spans) == 1.0


@pytest.mark.parametrize("label", sorted({label for label, _ in licences.TEMPLATES}))
def test_licence_texts_are_told_apart(label):
    """Every longest wording carries its own label and no relative's, also with words changed or left out."""
    text = max((t for x, t in licences.TEMPLATES if x == label), key=len)
    scan = licences.scanner()
    rng = random.Random(label)
    whole = text.split()
    changed = [w if rng.random() > 0.02 else "other" for w in whole if rng.random() > 0.01] if len(whole) > 60 else whole
    for words in (whole, ["before", "it", *whole, "and", "after"], changed):
        n, _, runs = scan.scan(" ".join(words).encode())
        spans = scan.spans(runs)
        relatives = {"gpl-2": {"gpl"}, "gpl-3": {"gpl"}, "bsd-2": {"bsd"}, "bsd-3": {"bsd"}, "gpl": {"gpl-2", "gpl-3"}}
        assert label in {x[0] for x in spans} and {x[0] for x in spans} <= {label} | relatives.get(label, set())
        assert all(0 <= first <= last < n and covered <= 1 for _, first, last, covered in spans)


def test_spans_of_unlike_words():
    scan = licences.scanner([("x", "a b c d e f g h i j")], {})
    for text, want in (("a b c d e f g h i j", [("x", 0, 9, 1.0)]), ("a b c d z z e f g h i j", [("x", 0, 11, 1.0)]),
                       ("a b c d e z", []), ("a b c d " + "z " * 20 + "e f g h i j", [("x", 24, 29, 0.6)]),
                       ("g h i j a b c d e f", [("x", 4, 9, 0.6)])):
        assert scan.spans(scan.scan(text.encode())[2]) == want


def test_matching_statistics_brute():
    rng = random.Random(3)
    templates = [[bytes([rng.choice(b"abc")]) for _ in range(rng.randint(1, 12))] for _ in range(8)]
    auto = licences.Automaton.of(templates, templates[:2])
    runs = {tuple(t[a:b]) for t in templates for a in range(len(t)) for b in range(a, len(t) + 1)}
    text, state, length = [bytes([rng.choice(b"abcd")]) for _ in range(2000)], 0, 0
    for k, word in enumerate(text):
        state, length = auto.match(state, length, word)
        assert length == max(n for n in range(k + 2) if n <= 13 and tuple(text[k + 1 - n:k + 1]) in runs)
        for phrase in range(2):
            size = len(templates[phrase])
            stands = text[max(0, k + 1 - size):k + 1] == templates[phrase]
            assert stands == (phrase in auto.phrases[state] and length >= size)


def test_byte_bpe(spark):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    given = [*frames.awkward_texts(), *frames.texts(spark), (70, "tabs\t\tand  spaces \n\n end "), (71, " 日本語  12３'ll ")]
    found = byte_bpe.tokens(frames.documents(spark, given), path=path, pattern=public_tokenizers.PATTERN, decode=True)
    want = Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in given)
    got = Counter((r.doc_id, tuple(memoryview(bytes(r.ids)).cast("I")), bytes(r.decoded)) for r in found.collect())
    assert got == want


def test_byte_bpe_merges_brute():
    rng, ranks = random.Random(5), {bytes([k]): k for k in range(256)}
    while len(ranks) < 400:
        a, b = rng.choice(list(ranks)[97:101] + list(ranks)[256:]), rng.choice(list(ranks)[97:101] + list(ranks)[256:])
        if len(a + b) < 9:
            ranks.setdefault(a + b, len(ranks))
    encoder = byte_bpe.Encoder(ranks, r"\S+|\s+")
    for _ in range(2000):
        piece = bytes(rng.choices(b"abcd", k=rng.randint(1, 30)))
        want = [ranks[piece]] if piece in ranks else byte_bpe.merged(piece, ranks)
        assert encoder.piece(piece) == want


def test_word_encoder():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), WordEncoder(path)
    library.encode_special_tokens = True
    texts = ["", "It's  A test of É é \x1c odd\x85 <|endoftext|> spaces\n", "日本 12 ½ ǅ ΑΣ", "́x y"]
    for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_files(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    given = [*frames.awkward_texts(), *((i + 100, t) for i, t in frames.texts(spark))]
    huffman.write_ids(frames.documents(spark, given), f"{tmp_path}/t", tokenizer=path, end_id=1)
    got = sorted(huffman.read_ids(spark, f"{tmp_path}/t").collect(), key=lambda r: r.start)
    own = WordEncoder(path)
    want = Counter((i, zlib.crc32(np.append(np.frombuffer(own.encode([(t or "").encode()])[0], "<u2"), 1)
                                  .astype("<u4").tobytes())) for i, t in given)
    assert Counter((r.doc_id, zlib.crc32(bytes(r.ids))) for r in got) == want
    assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()


def test_added_tokens_as_the_library_reads_them(spark, tmp_path):
    from tokenizers import AddedToken, Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    given = [(1, "a <|endoftext|> b"), (2, "a b"), (3, "pre<|startoftext|>́x<|endoftext|><|endoftext|>. <|EndOfText|>"),
             (4, None), (5, "<|endoftext|"), (6, "odd\x85<|endoftext|>\x1cé \n" + "y" * 1200 + "<|startoftext|>")]
    huffman.write_ids(frames.documents(spark, given), f"{tmp_path}/t", tokenizer=path, end_id=1)
    got = {r.doc_id: r for r in huffman.read_ids(spark, f"{tmp_path}/t").collect()}
    start = 0
    for i, text in given:
        want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert np.frombuffer(got[i].ids, "<u4").tolist() == want and got[i].start == start
        start += len(want)
    assert 49407 in np.frombuffer(got[1].ids, "<u4")

    texts = ["A new york NEW YORK xy<b> Xx x<|endoftext|>"]
    for token in (AddedToken("new york", normalized=False), AddedToken("xx", normalized=True),
                  AddedToken("york", single_word=True, lstrip=True, normalized=False)):
        other = Tokenizer.from_file(path)
        other.add_tokens([token])
        other.save(f"{tmp_path}/other.json")
        want = other.encode(texts[0], add_special_tokens=False).ids
        own = WordEncoder(f"{tmp_path}/other.json", added_tokens=True)
        assert np.frombuffer(own.encode([texts[0].encode()])[0], "<u2").tolist() == want


def test_code_lengths():
    rng = random.Random(6)
    for limit in (5, 8, 20):
        counts = {k: rng.randrange(1, 4 ** rng.randrange(1, 12)) for k in range(30)}
        size = huffman.lengths(counts, limit)
        assert max(size.values()) <= limit and sum(2.0**-n for n in size.values()) == 1
        code = huffman.Code(np.array(list(size)), np.array(list(size.values())))
        ids = np.array([rng.randrange(30) for _ in range(5000)])
        bits, marks = code.pack(ids)
        assert np.array_equal(code.unpack([bits, bits], np.array([5000, 5000]), [marks, marks])[1], ids)
    fibonacci = {0: 1, 1: 1, 2: 2, 3: 3, 4: 5}
    assert huffman.lengths(fibonacci, 20) == {0: 4, 1: 4, 2: 3, 3: 2, 4: 1}
    least = min(sum(c * n for c, n in zip(fibonacci.values(), size))
                for size in itertools.product(range(1, 4), repeat=5) if sum(2.0**-n for n in size) <= 1)
    assert sum(fibonacci[k] * n for k, n in huffman.lengths(fibonacci, 3).items()) == least


def test_toxicity_learns_misspellings(spark):
    rng = random.Random(7)
    plain = ["lovely", "weather", "report", "market", "garden", "window", "people", "river"]
    given, labels = [], []
    for i in range(300):
        words = [rng.choice(plain) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(3, 200))]
        toxic = int(i % 3 == 0)
        if toxic:
            words.insert(rng.randrange(len(words)), "blockhead" + rng.choice(["", "s", "ish"]))
        given.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    docs = frames.documents(spark, [*given, *frames.awkward_texts()])
    known = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None), (2, 1, None)],
                                  "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, known, examples=6000)
    for text, toxic in (("what a blokheadd you are", 1), ("lovely garden people", 0)):
        assert (model.score(text.encode()) >= 0.5) == bool(toxic)
    scores = toxicity.scored(docs, model, score_col="x").select("doc_id", "x").collect()
    assert len(scores) == docs.count() and all(0 <= r.x <= 1 for r in scores)
    one = toxicity.fit(docs, known.filter("toxic = 0"))
    assert one.score(b"anything") < 0.5
    assert toxicity.fit(docs, known.limit(0)).score(b"") == 0.5


def test_empty_tables(spark, tmp_path):
    docs = frames.documents(spark, [])
    assert setsketch.near_duplicates(docs).count() == 0
    assert substrings.without_repeats(docs).count() == 0
    assert licences.scan(docs).count() == 0
    assert byte_bpe.tokens(docs, path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                           pattern=public_tokenizers.PATTERN).count() == 0
    huffman.write_ids(docs, f"{tmp_path}/t", tokenizer=public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    assert huffman.read_ids(spark, f"{tmp_path}/t").count() == 0


def test_digests():
    assert hashlib.sha256(b"").hexdigest() == substrings._joined(b"")[1]


def test_byte_bpe_holds_a_megabyte_at_a_time():
    """A batch of many texts is not held with all its ids and decoded bytes; a worker's words are bounded."""
    import pyarrow as pa

    from tracklens.llm import byte_bpe

    encoder = byte_bpe.Encoder({bytes([k]): k for k in range(256)}, r" ?\S+|\s")
    texts = [f"{k} " + "ab cd " * 20_000 for k in range(20)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(22)), "text": texts})
    made = list(byte_bpe._batches([batch], encoder, decode=True))
    assert max(x.num_rows for x in made) < 12 and sum(x.num_rows for x in made) == 22
    assert [y.as_py() for x in made for y in x.column("decoded")] == [(x or "").encode() for x in texts]
    assert byte_bpe.REMEMBERED <= 250_000
