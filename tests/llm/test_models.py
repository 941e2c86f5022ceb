"""Trained operators: brute force where there is one, else held-out accuracy and odd rows."""

import json
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from strandline.llm import langid, lm, pii, quality, text, topk
from strandline.llm.text import fold
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# language

@pytest.fixture(scope="module")
def languages(docs):
    return langid.train(docs.where(fold("doc_id", 5) != 0), PIECES)


def test_language_of_held_out_documents(docs, languages):
    held = docs.where(fold("doc_id", 5) == 0)
    rows = langid.identify(held, languages).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == held.count()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(odd, languages):
    found = langid.identify(odd, languages, carry=True)
    assert found.select("row.*").columns == odd.columns
    rows = [(r["doc_id"], r["row"]["text"], r["lang_pred"]) for r in found.collect()]
    assert sorted(((i, t) for i, t, _ in rows), key=repr) == sorted(ROWS, key=repr)
    for _, text, lang in rows:
        assert (lang == "und") == (not re.search(r"[^\W\d_]", text or ""))


def test_language_without_anything_to_learn(none, odd):
    model = langid.train(none, PIECES)
    assert {r["lang_pred"] for r in langid.identify(odd, model).collect()} == {"und"}
    assert langid.identify(none, model).collect() == []


def test_forward_sums_all_segmentations():
    pieces = langid.load_pieces(PIECES)
    words = ["the", "tionen", "日本", "zé", "ß", "ab" * 40]
    weights = np.random.default_rng(2).random((pieces.number, 2)) / 100

    def brute(word):
        sums = [np.ones(2)] + [np.zeros(2) for _ in word]
        for i in range(len(word)):
            state = 0
            for j in range(i, len(word)):
                state = int(pieces.trie.find(np.array([state]), np.array([ord(word[j])]))[0])
                piece = pieces.piece_of[state] if state >= 0 else -1
                if j == i:
                    piece = max(piece, 0)
                if piece >= 0:
                    sums[j + 1] = sums[j + 1] + sums[i] * weights[piece]
                if state < 0:
                    break
        return sums[-1]
    assert np.allclose(langid.word_scores(pieces, words, weights), np.log10([brute(langid.WORD_START + w) for w in words]))
    arcs = langid.lattice(pieces, [langid.WORD_START + w for w in words])
    assert np.allclose(langid.backward(arcs, weights)[arcs.first], langid.forward(arcs, weights)[arcs.last])
    # one column for all languages counts the same pieces, as often as the words occur
    even = np.repeat(weights[:, :1], 2, axis=1)
    counts = np.array([[1.0, 2], [0, 1], [3, 0], [1, 1], [0, 0], [2, 5]])
    both = langid.expected_pieces(pieces, words, counts, even)
    single = langid.expected_pieces(pieces, words, counts[:, :1], even[:, :1])
    assert np.allclose(both[:, 0], single[:, 0])
    for w, n in zip(words[:3], counts):
        found = langid.expected_pieces(pieces, [w], n[None], even)
        assert (found.sum(0) >= n - 1e-9).all() and (found.sum(0) <= n * (len(w) + 1) + 1e-9).all()


def test_long_words_are_summed_whole():
    pieces = langid.load_pieces(PIECES)
    draw = np.random.default_rng(3)
    words = ["a", "strasse" * 9, "".join(draw.choice(list("abcdehinorst日本語"), 700)), "".join(draw.choice(list("aeionrt"), 10_000))]
    weights = np.exp(draw.normal(-22, 3, (pieces.number, 2)))  # 1e-10 each: products leave the range of floats

    def brute(word):
        """Forward and backward sums and piece counts in logarithms, place by place."""
        arcs = [[] for _ in word]
        for i in range(len(word)):
            state = 0
            for j in range(i, len(word)):
                state = int(pieces.trie.find(np.array([state]), np.array([ord(word[j])]))[0])
                piece = pieces.piece_of[state] if state >= 0 else -1
                piece = max(piece, 0) if j == i else piece
                if piece >= 0:
                    arcs[i].append((j + 1, piece))
                if state < 0:
                    break
        ahead, back = (np.full((len(word) + 1, 2), -np.inf) for _ in range(2))
        ahead[0] = back[-1] = 0
        for i in range(len(word)):
            for j, piece in arcs[i]:
                ahead[j] = np.logaddexp(ahead[j], ahead[i] + np.log(weights[piece]))
        used = np.zeros((pieces.number, 2))
        for i in reversed(range(len(word))):
            for j, piece in arcs[i]:
                back[i] = np.logaddexp(back[i], back[j] + np.log(weights[piece]))
                used[piece] += np.exp(ahead[i] + np.log(weights[piece]) + back[j] - ahead[-1])
        return ahead[-1] / math.log(10), used
    each = [brute(langid.WORD_START + w) for w in words]
    scores = langid.word_scores(pieces, words, weights)
    assert np.allclose(scores, [s for s, _ in each], rtol=1e-9) and scores[2:].max() < -300
    counts = np.array([[1.0, 2], [3, 0], [1, 1], [2, 5]])
    found = langid.expected_pieces(pieces, words, counts, weights)
    assert np.allclose(found, sum(u * n for (_, u), n in zip(each, counts)), rtol=1e-6, atol=1e-9)


# quality

def test_quality_of_held_out_documents(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = "crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"
    rows = quality.quality(docs, labels, learn).join(labels, "doc_id").where(fold("doc_id", 5) == 0).collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 1), (100, 1), (9, 0), (11, 0), (None, 0), (4, None), (7, 5)], "doc_id long, quality int")
    rows = quality.quality(odd, labels).collect()
    assert sorted((r["doc_id"] for r in rows), key=repr) == sorted((i for i, _ in ROWS), key=repr)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in quality.quality(odd, labels.where("quality = 1")).collect()} == {0.5}
    assert quality.quality(none, labels).collect() == []


def test_scores_are_the_density_ratio():
    draw = np.random.default_rng(0)
    width = len(quality.NAMES)
    means = draw.normal(size=(2, width))
    covariances = [np.cov(draw.normal(size=(width, 60)) * (c + 1)) + np.eye(width) for c in (0, 1)]
    model = quality.Discriminant(np.log([0.3, 0.7]), means, np.stack([np.linalg.cholesky(c) for c in covariances]),
                                 np.array([np.linalg.slogdet(c)[1] for c in covariances]))
    x = draw.normal(size=(5, width))
    logs = [np.log(p) - 0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) - 0.5 * np.linalg.slogdet(c)[1]
            for p, m, c in zip((0.3, 0.7), means, covariances)]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])))


# top k

def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(4)
    vectors = [(i, (draw.normal(size=16) * draw.choice([0.1, 1.0])).tolist()) for i in range(900)]
    vectors += [(300, vectors[0][1]), (300, vectors[0][1]), (1000, [0.5] * 16), (1001, [0.5] * 16), (1002, [0.5] * 16)]  # ties, repeats
    odd = [(None, [1.0] * 16), (1100, None), (1200, [1.0] * 15 + [float("nan")]), (1300, [float("inf")] * 16), (1400, [1.0] * 15 + [None]),
           (1500, [1.0] * 8), (1501, [2.0] * 8)]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors + odd], "vec_id long, embedding array<float>, row string, score int")
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(table.repartition(5)).collect())
    expected = []
    usable = vectors + [odd[-2], odd[-1]]
    scaled = [np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int) for _, v in usable]
    for q, (i, _) in enumerate(usable):
        if i % 100 == 0:
            scores = sorted((-int(scaled[q] @ scaled[c]), usable[c][0]) for c in range(len(usable))
                            if c != q and len(scaled[c]) == len(scaled[q]))
            expected += [(i, r, v, -s) for r, (s, v) in enumerate(scores[:10], 1)]
    assert found == sorted(expected)


def test_top_k_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(400, 8))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in topk.top_k(table, every=3, k=5).collect()}
    scaled = np.floor(vectors * 1024).astype(int)
    for q in range(0, 400, 3):
        scores = [(-int(scaled[q] @ scaled[c]), c) for c in range(400) if c != q]
        for score, c in sorted(scores)[:5]:
            assert found.pop((q, c)) == -score
    assert not found


@pytest.mark.parametrize("large", [1e10, 1e60, 1e300, 1.7e308])
def test_top_k_is_exact_for_large_components(spark, monkeypatch, large):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(8)
    vectors = [rng.normal(size=3).tolist() for _ in range(40)]
    vectors[3], vectors[7], vectors[9] = [large, 0.5, -large], [large, 1.0, large], [0.0, 2.0, 0.0]
    vectors[20], vectors[21] = [1.0, 1.0, 1.0], [-large, 0.25, large]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    whole = [[math.floor(1024 * x) if abs(x) < 1e300 else int(x) * 1024 for x in v] for v in vectors]

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(whole[a], whole[b], strict=True)), -(1 << 63)), (1 << 63) - 1)
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(table, every=3, k=5).collect())
    expected = []
    for q in range(0, 40, 3):
        best = sorted((-score(q, o), o) for o in range(40) if o != q)[:5]
        expected += [(q, rank, o, -s) for rank, (s, o) in enumerate(best, 1)]
    assert found == expected


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty).collect() == []
    assert topk.top_k(spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<float>")).collect() == []


def shuffled_bytes(node):
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_bytes(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_bytes(node.plan())
    own = node.metrics().apply("dataSize").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled_bytes(node.children().apply(i)) for i in range(node.children().size()))


def test_top_k_does_not_copy_rows_for_each_block_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    draw = np.random.default_rng(9)
    vectors = draw.normal(size=(2000, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = topk.top_k(table, every=4, k=1)
        rows = sorted((r["query_id"], r["vec_id"]) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scaled = np.floor(vectors * 1024).astype(int)
    scores = scaled[::4] @ scaled.T
    scores[np.arange(500), np.arange(0, 2000, 4)] = topk.LOWEST
    assert rows == list(zip(range(0, 2000, 4), scores.argmax(1).tolist(), strict=True))
    # 2,000 rows once, 500 queries for each of 32 groups, and what each finds there: 1.5 MB, where pairs of blocks were 13
    assert 0 < shuffled_bytes(found._jdf.queryExecution().executedPlan()) < 4_000_000


def test_top_k_of_many_ties_in_several_chunks(spark):
    draw = np.random.default_rng(10)
    vectors = draw.integers(-2, 3, size=(5000, 3)).astype(float)
    vectors[draw.choice(5000, 1500, replace=False)] = [2.0, 1.0, -2.0]
    ids = draw.integers(0, 4000, 5000)
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>")
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(table.repartition(3), every=7, k=4).collect())
    scaled = np.floor(vectors * 1024).astype(int)
    expected = []
    for q in np.flatnonzero(ids % 7 == 0):
        scores = scaled @ scaled[q]
        order = [c for c in np.lexsort((ids, -scores)) if c != q][:4]
        expected += [(int(ids[q]), r, int(ids[c]), int(scores[c])) for r, c in enumerate(order, 1)]
    assert found == sorted(expected)


def test_chunks_that_bounds_exclude_are_not_evaluated(monkeypatch):
    draw = np.random.default_rng(12)
    centres = draw.normal(size=(8, 16))
    vectors = np.floor(1024 * np.concatenate([c / np.linalg.norm(c) + 0.02 * draw.normal(size=(3000, 16)) for c in centres])).astype(np.int16)
    vectors = vectors[draw.permutation(len(vectors))]
    numbers = np.arange(len(vectors))
    chosen = vectors[:32].astype(np.int64)
    most = float(np.sqrt((vectors.astype(float) ** 2).sum(1).max())) + 1
    evaluated, products = [], topk.products
    monkeypatch.setattr(topk, "products", lambda v, q, m: evaluated.append(len(v) * len(q)) or products(v, q, m))
    queries = vectors[:100].astype(np.int64)
    held = topk.Rows(numbers, numbers, vectors, 1024, chosen, most, True)
    least = np.partition(queries @ vectors[100:1100].astype(np.int64).T, -5, axis=1)[:, -5]
    query, ids, scores = held.search(queries, numbers[:100], topk.distances(queries, chosen, most, False), least, 5).found()
    whole = queries @ vectors.astype(np.int64).T
    whole[np.arange(100), np.arange(100)] = topk.LOWEST
    best = [np.lexsort((numbers, ~s))[:5] for s in whole]
    assert ids.reshape(100, 5).tolist() == [b.tolist() for b in best] and query.tolist() == np.repeat(np.arange(100), 5).tolist()
    assert scores.reshape(100, 5).tolist() == [s[b].tolist() for s, b in zip(whole, best, strict=True)]
    assert sum(evaluated) < 0.5 * whole.size


# language model

def test_base_scores_equal_brute_force(odd):
    rows = lm.score(odd, fold("doc_id", 10) != 0).collect()
    tokens = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b"\n"]
    counts = Counter()
    for i, text in ROWS:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, text in ROWS:
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(text))
        expected.append((i, len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), n, round(base, 6)))
    found = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_scores_over_several_buckets_equal_the_formula(spark, odd, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(lm, "SHARD_BYTES", 8000)
    rows = lm.score(odd, fold("doc_id", 10) != 0, strength=2.0, share=0.5).collect()
    tokens = lambda t: [b" "] + re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b"\n"]
    single, double = Counter(), Counter()
    for i, text in ROWS:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            single.update(tokens(text))
            double.update(zip(tokens(text), tokens(text)[1:]))
    n, v = sum(single.values()) - single[b" "], len(single) - 1

    def score(text):
        total = 0.0
        for h, w in zip(tokens(text), tokens(text)[1:]):
            base = (single[w] + 0.1) / (n + 0.1 * (v + 1))
            left = 2.0 + 0.5 * single[h]
            total += math.log10((double[h, w] + left * base) / (single[h] + left) if single[h] else base)
        return round(total, 6)
    assert sorted(((r["doc_id"], round(r["score"], 6)) for r in rows), key=repr) == \
        sorted(((i, score(t)) for i, t in ROWS), key=repr)


def test_the_model_beats_the_base_on_held_out_rows(docs):
    rows = lm.score(docs, fold("doc_id", 10) != 0).where(fold("doc_id", 10) == 0).collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_scores_without_a_corpus(odd, none):
    assert {r["n_known"] for r in lm.score(odd, fold("doc_id", 10) > 10).collect()} == {0}
    assert lm.score(none, fold("doc_id", 10) != 0).collect() == []


# personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(s))) % 10 == 0
    return sorted(
        [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
        + [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        + [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
        + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15])


def test_base_spans_equal_the_plain_patterns(docs):
    draw = np.random.default_rng(8)
    for _ in range(3000):
        text = "".join(draw.choice(list("a.@1-+ ()29_%é\n"), draw.integers(0, 40)))
        assert pii.base_spans(text) == brute_spans(text), text
    for text in ["a@b.c@d.e", "a@b@c.d.", "x@y", "@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.3.0004", "4111 1111 1111 1111",
                 "4111-1111-1111-1111 5", "++1 (626) 555-5759-", "+1 (626) 555-5759 4111111111111111", "é@a.b 日a@b-c.日.d"]:
        assert pii.base_spans(text) == brute_spans(text), text


@pytest.fixture(scope="module")
def field(docs, spark):
    return pii.fit(pii.labelled_table(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")))


def test_the_field_finds_what_the_patterns_miss(spark, field):
    texts = ["Write to bosbt.42(at)mail8.example.com soon", "Call (626) 555-5759 today", "No data in Version 2.0 of this text",
             "Rent thedtion or withthreeaou. Edon the. Anoneran inre of eswhou", "Call +1 (626) 555-5759 today"]
    rows = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), field).collect()}
    assert rows[0]["spans"].startswith("email:") and rows[0]["n_email"] == 0 and rows[0]["base"] == ""
    assert rows[1]["spans"].startswith("phone:")
    assert rows[2]["spans"] == rows[3]["spans"] == ""
    assert rows[4]["spans"] == rows[4]["base"] == "phone:5:22" and rows[4]["n_phone"] == 1


def test_personal_data_of_odd_rows(odd, none, field):
    rows = pii.find(odd, field, carry=True).collect()
    assert sorted(((r["doc_id"], r["row"]["text"]) for r in rows), key=repr) == sorted(ROWS, key=repr)
    for r in rows:
        assert r["base"] == pii._written(brute_spans(r["row"]["text"] or ""))
        assert set(filter(None, r["base"].split(","))) <= set(r["spans"].split(","))
    assert pii.find(none, field).collect() == []
    assert pii.fit(pii.labelled_table(none)).names == {}


def test_finding_drops_what_other_operators_keep_and_decodes_bounded_parts(spark, field, monkeypatch):
    texts, tasks, decoded = ["mail a@b.org now " * 50] * 10 + ["word " * 3000, "", None, "ip 10.0.0.1"], [], []
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [tuple(r) for r in pii.find(docs, field).orderBy("doc_id").collect()]
    decode = pii.Decoder.decode
    monkeypatch.setattr(pii.Decoder, "decode", lambda self, words, lengths: decoded.append(words) or decode(self, words, lengths))
    monkeypatch.setattr(pii, "CHARS", 2000, raising=False)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: tasks.append(task) or self)
    pii.find(docs, field)
    text.kept(("another operator",), list)
    rows = [tuple(r.values()) for b in tasks[0](iter([pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])]))
            for r in b.to_pylist()]
    assert rows == want
    assert not text._KEPT
    assert max(len(" ".join(w)) for w in decoded if w != ["word"] * 3000) <= 2000


def test_decoding_is_the_best_path():
    draw = np.random.default_rng(9)
    n = len(pii.LABELS)
    words = ["a", "b1", "c@d", "+1"]
    names = {f: i for i, f in enumerate({f for w in words for f in pii.features(pii.shape(w))})}
    crf = pii.Crf(names, draw.normal(size=(len(names), n)), draw.normal(size=(n, n)))
    decoder = pii.Decoder(crf)
    sequences = [draw.choice(words, k).tolist() for k in (1, 3, 4, 2)]
    found = decoder.decode(sum(sequences, []), np.array(list(map(len, sequences))))

    def value(sequence, labels):
        rows = [crf.potentials(pii.shape(w)) for w in sequence]
        return sum(rows[i][pii.OWN][label] + (rows[i - 1][pii.BEFORE][label] + crf.transitions[labels[i - 1], label] if i else 0)
                   + (rows[i + 1][pii.BEHIND][label] if i + 1 < len(rows) else 0) for i, label in enumerate(labels))
    at = 0
    for sequence in sequences:
        best = max((tuple(int(i) for i in np.unravel_index(c, (n,) * len(sequence))) for c in range(n ** len(sequence))),
                   key=lambda labels: value(sequence, labels))
        assert tuple(found[at:at + len(sequence)].tolist()) == best
        at += len(sequence)


def test_mask():
    assert pii.mask("a b@c.d, 1.2.3.4!", "email:2:7,ip:9:16") == "a [email], [ip]!"
    assert pii.mask("123456", "card:0:4,phone:2:6") == "[card]"


def test_labels_of_windows():
    words, labels = pii.labels_of("call +1 (626) 555 now", [(5, 3, 17)])
    assert [pii.LABELS[i] for i in labels] == ["O", "B-phone", "I-phone", "I-phone", "O"]
    assert json.dumps(words)
