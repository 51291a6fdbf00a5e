"""Every registered corpus query on a small folder, all contract columns, against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import frames
from tests.llm.test_new_operators import brute_alignment, brute_codes
from tracklens.llm import byte_bpe, licences, quality, queries, toxicity

FOLDER = frames.FOLDER
RUN = queries.registered()


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text, r.n_chars) for r in frames.read(spark, "documents").collect()]


@pytest.fixture(scope="module")
def vectors(spark):
    return {r.vec_id: (np.array(r.embedding, np.float64), r.label) for r in frames.read(spark, "embeddings").collect()}


def rows(spark, name, *columns):
    return Counter(tuple(r) for r in RUN[name](spark, FOLDER).select(*columns).collect())


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def multi_bpe():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_toxicity(model, text):
    """The score of a text from its words' n-grams, passage by passage."""
    raw = (text or "").lower().encode()
    words = re.findall(rb"[0-9a-z\x80-\xff]+", raw)
    best = None
    for at in range(0, len(words), toxicity.PASSAGE):
        values = []
        for word in words[at:at + toxicity.PASSAGE]:
            padded = b" " + word + b" "
            for size in toxicity.SIZES:
                for k in range(len(padded) - size + 1):
                    x = 0
                    for n, byte in enumerate(padded[k:k + size]):
                        x = byte if n == 0 else (x * 0x01000193 + byte) & 0xFFFFFFFF
                    x ^= size * 0x9E3779B1 & 0xFFFFFFFF
                    x = ((x ^ (x >> 15)) * 0x85EBCA6B) & 0xFFFFFFFF
                    values.append(model.weights[(x ^ (x >> 13)) & ((1 << toxicity.BITS) - 1)])
        value = sum(values) / max(len(values), 1)
        best = value if best is None else max(best, value)
    return 1 / (1 + np.exp(-(model.bias + (best or 0.0))))


def test_op1(spark, documents):
    found = {r.doc_id: r for r in RUN["op1_toxicity"](spark, FOLDER).collect()}
    mark = queries.F.crc32(queries.F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(frames.read(spark, "documents"), frames.read(spark, "labels"), learn=~mark)
    assert len(found) == len(documents)
    for doc, text, _ in documents:
        r = found[doc]
        assert (r.held_out, r.predicted) == (held_out(doc), int(r.score >= 0.5)) and 0 <= r.score <= 1
        assert r.score == pytest.approx(plain_toxicity(model, text), abs=1e-6)


def test_op2(spark, documents):
    want = Counter()
    for doc, text, _ in documents:
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
        places = [(k, label) for phrase, label in licences.PHRASES.items() for k in range(len(words))
                  if words[k:k + len(phrase.split())] == phrase.encode().split()]
        starts = [k for k, _ in places]
        want[doc, len(words), len(places), min(starts, default=None), max(starts, default=None),
             ",".join(sorted({label for _, label in places}))] += 1
    assert rows(spark, "op2_license_scan", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    for r in RUN["op2_license_scan"](spark, FOLDER).collect():
        labels = r.labels.split(",") if r.labels else []
        assert set(r.base_labels.split(",")) - {""} <= set(labels) and labels == sorted(set(labels))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def test_op3(spark, vectors):
    ids = sorted(vectors)
    x = np.array([vectors[i][0] for i in ids])
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    near = x @ x.T >= 0.9
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a != b]
    group, count = frames.groups(ids, links), Counter(a for a, _ in links)
    found = {r.vec_id: r for r in RUN["op3_embedding_near_dedup"](spark, FOLDER).collect()}
    assert sorted(found) == ids and all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert all(found[i].n_links <= count[i] for i in ids)
    assert sum(r.n_links for r in found.values()) >= 0.95 * len(links)
    assert sum(found[i].component_id == group[i] for i in ids) >= 0.95 * len(ids)


def test_op4(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = Counter(), 0
    for doc, text, _ in sorted(documents):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want[doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert rows(spark, "op4_token_id_output", "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_op5(spark, documents):
    given = [(doc, text) for doc, text, _ in documents]
    sizes, group = frames.near(given, 2, 80)
    want = Counter((doc, n, group[doc], group[doc] == doc) for (doc, _), n in zip(given, sizes))
    assert rows(spark, "op5_minhash_near_dedup", "doc_id", "n_shingles", "component_id", "kept") == want


def test_op6(spark, documents):
    given = [(doc, text) for doc, text, _ in documents]
    want = Counter((doc, *x) for (doc, _), x in zip(given, frames.without_repeats(given, 50)))
    assert rows(spark, "op6_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_op7(spark, vectors):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i][0] for i in ids])
    found = defaultdict(list)
    for r in RUN["op7_nearest_neighbours"](spark, FOLDER).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    asked = [i for i in ids if i % 100 == 0]
    assert sorted(found) == asked
    hits = 0
    for q in asked:
        far = np.sqrt(((x - vectors[q][0]) ** 2).sum(axis=1))
        mine = sorted(found[q])
        assert [n for n, _, _ in mine] == list(range(1, 11)) and q not in {i for _, i, _ in mine}
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        assert all(s == far[np.searchsorted(ids, i)] for _, i, s in mine)
        far[np.searchsorted(ids, q)] = np.inf
        hits += len({i for _, i, _ in mine} & set(ids[np.lexsort((ids, far))[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(asked)


def test_op8(spark, documents):
    """What is masked is gone from the text, and nothing else is."""
    found = {r.doc_id: r for r in RUN["op8_secret_scan"](spark, FOLDER).collect()}
    assert len(found) == len(documents)
    for doc, text, _ in documents:
        r = found[doc]
        assert r.n_candidates == len(r.scores) and r.n_secrets == sum(s >= 0.5 for s in r.scores)
        if not r.n_secrets:
            assert r.redacted_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    keys = {doc for doc, text, _ in documents if text and re.search(r"(?<![A-Za-z0-9_+/-])AKIA[A-Z0-9]{16}(?![A-Za-z0-9_+/-])", text)}
    assert keys <= {doc for doc, r in found.items() if r.n_secrets}


def test_op9(spark):
    given = {r.doc_id: r for r in frames.read(spark, "documents").collect()}
    found = RUN["op9_source_mixing"](spark, FOLDER).collect()
    times, size, spent = Counter(r.doc_id for r in found), Counter(), Counter()
    for doc, r in given.items():
        n = len(re.findall(rb"[^ \t-\r]+", r.text.encode()))
        size[r.source] += n
        spent[r.source] += n * times[doc]
    assert set(times) == set(given) and "text" not in found[0].asDict()
    ratio = {s: spent[s] / size[s] for s in size}
    largest = max(size, key=size.get)
    assert ratio[largest] == 1 and all(1 <= x <= 1.25 + 1e-9 for x in ratio.values())
    # the smallest source is repeated as often as the limit allows, but for what its documents' sizes leave over
    smallest = min(size, key=size.get)
    short = [len(re.findall(rb"[^ \t-\r]+", r.text.encode())) for r in given.values() if r.source == smallest]
    assert spent[smallest] >= 1.25 * size[smallest] * 0.998 - min(short) - 2


def test_op10(spark, documents):
    library, want = multi_bpe(), Counter()
    for doc, text, _ in documents:
        ids = library.encode_ordinary(text or "")
        want[doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert rows(spark, "op10_byte_level_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_op11(spark, vectors):
    some = [(i, v.tolist(), label) for i, (v, label) in sorted(vectors.items()) if i < 120]
    schema = "vec_id bigint, embedding array<float>, label int"
    found = queries.part_codes.compressed(spark.createDataFrame(some, schema), entries=256, rounds=4)
    assert Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found.collect()) == brute_codes(
        some, 4, 256, 4, 1024)


def test_op12(spark, documents):
    found = {r.doc_id: r for r in RUN["op12_quality"](spark, FOLDER).collect()}
    mark = queries.F.crc32(queries.F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = quality.fit(frames.read(spark, "documents"), frames.read(spark, "labels"), metadata=["n_chars"], learn=~mark)
    *words, numbers = quality.described([(text or "").encode() for _, text, _ in documents])
    extra = [np.nan if n is None else float(n) for _, _, n in documents]
    scores = model.scores(*words, np.column_stack([numbers, extra]))
    assert len(found) == len(documents)
    for (doc, _, _), score in zip(documents, scores):
        r = found[doc]
        assert (r.held_out, r.predicted) == (held_out(doc), int(r.score >= 0.3)) and r.score == pytest.approx(score, abs=1e-9)


def test_op12_on_labels_it_never_saw(spark):
    """On a table with some hundred labels to learn from."""
    folder = FOLDER.replace("sf0.001", "sf0.01")
    found = {r.doc_id: r for r in RUN["op12_quality"](spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for quality_, least in ((0, 0.9), (1, 0.95)):
        hits = [found[d].predicted == q for d, q in labels.items() if d in found and held_out(d) and q == quality_]
        assert len(hits) >= 10 and np.mean(hits) >= least


def test_op13(spark, documents):
    want = brute_alignment([(doc, text) for doc, text, _ in documents])
    found = rows(spark, "op13_tokenizer_alignment", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    assert found == Counter(w[:-1] for w in want)


def test_pipeline_run(spark, documents):
    """Every stage on what the one before kept: plain Python for the first two and the last."""
    stages = dict(corpus_pipeline.STAGES)
    docs = frames.read(spark, "documents")
    mark = queries.F.crc32(queries.F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(docs, frames.read(spark, "labels"), learn=~mark)
    clean = [(doc, text) for doc, text, _ in documents if plain_toxicity(model, text) < 0.5]
    group = frames.near(clean, 5, 80)[1]
    left = docs.filter(queries.F.col("doc_id").isin([doc for doc, _ in clean if group[doc] == doc]))
    masked = stages["secrets"](spark, left, FOLDER)
    assert masked.count() == left.count() and masked.columns == docs.columns
    mixed = stages["mixing"](spark, masked, FOLDER)
    library, want = multi_bpe(), Counter()
    for r in mixed.collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()
        want[r.doc_id, len(ids) // 4, ids, hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in found) == want
    assert all(r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest() for r in found)
