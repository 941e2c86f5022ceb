"""Divergence of sources, licence scans and importance resampling against plain versions of their definitions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import divergence, licenses, resample
from strandline.llm.spans import LETTERS, Spans, run_crcs

LOWER = {c: c + 32 for c in range(65, 91)}
WORD, TERM = (re.compile(x) for x in (r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"))


def words_of(text, kind=WORD):
    return kind.findall((text or "").translate(LOWER))


# ---------------------------------------------------------------- words and crcs

def test_spans_and_crcs_of_runs():
    random.seed(3)
    texts = ["Hello wörld A-b 9 " + "x" * 70 + " " + "y" * 5000 + " z", "", "end", "start", "", "é"] + [
        " ".join("".join(random.choice("abcé9-") for _ in range(random.randint(1, 20))) for _ in range(50)) for _ in range(30)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    for kind, pattern in ((LETTERS, TERM), (None, WORD)):
        spans = Spans(data, offsets, kind) if kind is not None else Spans(data, offsets)
        runs = run_crcs(spans, 3)
        for t, text in enumerate(texts):
            words, a, b = words_of(text, pattern), spans.first[t], spans.first[t + 1]
            assert [bytes(spans.bytes[x:y]).decode() for x, y in zip(spans.begin[a:b], spans.end[a:b])] == words
            for k, (at, crc) in enumerate(runs):
                own = (at >= a) & (at < b)
                assert crc[own].tolist() == [zlib.crc32(" ".join(words[i:i + k + 1]).encode()) for i in range(len(words) - k)]


# ---------------------------------------------------------------- divergence

def plain_audit(rows, least=3, top=200):
    rows = [(lang or "", source or "", words_of(text, TERM)) for lang, source, text in rows]
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in rows:
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def share(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])}
    return out


def corpus(n, sources, seed):
    random.seed(seed)
    vocabulary = ["the", "a", "of"] + [x + y + z for x in ("pre", "pra", "ü", "straße", "internation") for y in ("al", "e", "")
                                       for z in ("isation", "ised", "s", "x" * 40)]
    weight = [300, 200, 100] + [random.random() ** 3 * 5 for _ in vocabulary[3:]]
    return [(random.choice(["en", "en", "de", None]), random.choice(sources),
             " ".join(random.choices(vocabulary, weight, k=random.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("levels", [(), (2, 4, 8), (1, 3)])
def test_audit_equals_its_definition(spark, levels):
    rows = corpus(150, ["s1", "s2", "s3", None, "S 4", "é"], 1) + [
        ("en", "quiet", None), ("en", "quiet", ""), ("xx", "alone", "one two"), ("yy", "a", "word"), ("yy", "b", None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, g int, p0 int").repartition(5)
    found = list(map(tuple, divergence.audit(df, levels=levels).collect()))
    assert len(found) == len(set(found)) and set(found) == plain_audit(rows)


def test_audit_ranks_and_limits(spark):
    rows = corpus(80, ["s1", "s2"], 2)
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert set(map(tuple, divergence.audit(df, most_terms=3, least=2).collect())) == plain_audit(rows, 2, 3)


def test_audit_with_huge_counts_and_many_partners(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS", 7)  # terms meet in pieces
    terms = spark.createDataFrame([("x", [(g, 10 ** 9 - g * 7 * t, 1 + g) for g in range(9)]) for t in range(1, 4)],
                                  "lang string, held array<struct<i:int,p:long,p0:long>>").coalesce(1)
    want = Counter()
    for t in range(1, 4):
        for a, b in itertools.permutations(range(9), 2):
            (p, p0), (q, q0) = ((10 ** 9 - g * 7 * t, 1 + g) for g in (a, b))
            want[a, b] += (p - q) ** 2 // q - (p - q0) ** 2 // q0 - (p0 - q) ** 2 // q + (p0 - q0) ** 2 // q0
    got = divergence._meetings(terms).groupBy("a", "b").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("v")).collect()
    assert {(r.a, r.b): int(r.v) for r in got} == dict(want)
    big = spark.createDataFrame([(7 * 10 ** 12, 9 * 10 ** 13, 10 ** 7)], "n long, total long, v long")
    share = big.select(divergence._share(F.col("n"), F.col("total"), F.col("v"), 10 ** 9, 1)).first()[0]
    assert share == 1 + 10 ** 9 * (7 * 10 ** 12 + 1) // (9 * 10 ** 13 + 10 ** 7)


@pytest.mark.parametrize("unit", [1, divergence.UNIT_BYTES])
def test_frequent_terms_prune_and_stay_exact(spark, monkeypatch, unit):
    monkeypatch.setattr(divergence, "UNIT_BYTES", unit)
    rows = corpus(120, ["s1", "s2"], 5)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    terms = divergence.cut_terms(docs, divergence.numbered_groups(docs, "lang", "source"), "lang", "source", "text")
    held = defaultdict(set)
    for i, (lang, _, text) in enumerate(rows):
        for t in words_of(text, TERM):
            held[lang or "", t].add(i)
    prefixes = defaultdict(set)
    for (lang, t), docs in held.items():
        prefixes[lang, t.encode()[:2]] |= docs
    level = {(r.lang, bytes(r.prefix)): r.docs for r in divergence._level(terms, 2, None).collect()}
    assert level == {k: len(v) for k, v in prefixes.items()}
    for least in (1, 3, 9, 1000):
        kept = divergence.frequent_terms(terms, least)
        assert {(r.lang, r.term) for r in kept.collect()} == {k for k, v in held.items() if len(v) >= least}
    stayed = divergence._level(terms, 2, None).where("docs >= 9")
    after = divergence._level(terms, 40, (2, divergence._filter_of(stayed)))
    assert {bytes(r.prefix)[:2] for r in after.collect()} <= {bytes(r.prefix) for r in stayed.collect()}


def test_audit_takes_odd_tables(spark, odd, none):
    found = divergence.audit(odd.withColumn("source", F.lit("s")).withColumn("lang", F.lit(None).cast("string")))
    assert {r.part for r in found.collect()} <= {"pair", "term"}
    assert divergence.audit(none.withColumn("source", F.lit("s"))).count() == 0


# ---------------------------------------------------------------- licences

def plain_places(text):
    words = words_of(text)
    return words, sorted((i, label) for phrase, label in licenses.BASE_PHRASES.items() for i in range(len(words))
                         if words[i:i + phrase.count(" ") + 1] == phrase.split(" "))


LICENCE_TEXTS = [
    "Licensed under the Apache License, Version 2.0. Released under the MIT\nLicense.",
    "GNU General Public License GNU GENERAL public-license; gnu general public licensee",
    "cc by cc by nc, CC-BY-SA 4.0 and CC BY", "mit licenses, smit license, mit license",
    "SPDX-License-Identifier: (MIT OR GPL-3.0-only) AND Apache-2.0 WITH LLVM-exception\nmore",
    "# SPDX-License-Identifier: GPL-2.0-or-later AND\n", "license: MIT. Or else", "License: see the file", 'license = "BSD-3-Clause"',
    "SPDX-License-Identifier: Foo-1.0 */", "Mit License é license", "", None, "   ", "apache" + " " * 3000 + "license",
    "x " * 70000 + "mit license", "The Apache License—MIT License", "mit", "license",
]


def test_scan_equals_its_definition(spark):
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(LICENCE_TEXTS)] + [(None, "mit license", "n"), (3, "mit license", "n")],
                                 "doc_id long, text string, row string").repartition(2)
    found = licenses.scan(docs, carry=True)
    assert found.columns[-1] == "row"
    got = found.collect()
    assert len(got) == len(LICENCE_TEXTS) + 2
    for r in got:
        words, base = plain_places(r.row.text)
        assert r.n_words == len(words) and [(p.word, p.label) for p in r.places if p.base] == base
        assert (r.n_base, r.first_word, r.last_word) == (len(base), base[0][0] if base else None, base[-1][0] if base else None)
        assert r.base_labels == ",".join(sorted({label for _, label in base})) and 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score > 0) == bool(r.places or r.expressions)
    by_id = {r.doc_id: r for r in got if r.row.text is None or r.row.text == LICENCE_TEXTS[r.doc_id or 0]}
    assert by_id[4].expressions[0].meaning == "(MIT OR GPL-3.0-only) AND Apache-2.0 WITH LLVM-exception"
    assert by_id[4].labels == "apache,mit" and by_id[4].expressions[0].demands == 1
    assert by_id[5].expressions[0].meaning is None and by_id[5].labels == ""
    assert by_id[6].labels == "mit" and by_id[7].expressions == [] and by_id[8].labels == "bsd"
    assert by_id[9].labels == "other"


def test_scan_report_and_empty_tables(spark, odd, none):
    report = licenses.report(licenses.scan(odd))
    assert report.count() == odd.count() and "score" in report.columns
    assert licenses.report(licenses.scan(none)).count() == 0


def test_labels_of_identifiers():
    assert [licenses.label_of(x)[0] for x in ("MIT", "LGPL-2.1+", "GPL-3.0", "CC-BY-SA-4.0", "CC-BY-4.0", "Mitten", "AGPL-3.0-only", "0BSD")] == [
        "mit", "lgpl", "gpl", "cc-by-sa", "cc-by", "other", "agpl", "bsd"]


def _tree(depth):
    if not depth or random.random() < 0.25:
        return random.choice(["MIT", "GPL-3.0", "AGPL-3.0", "MPL-2.0", "Unknown-1", "CC0-1.0"])
    return (random.choice(["and", "or"]), _tree(depth - 1), _tree(depth - 1)) if random.random() < 0.85 else ("with", random.choice(
        ["GPL-2.0", "MPL-2.0"]), "Classpath-exception-2.0")


def _written(tree, bind=0):
    if isinstance(tree, str):
        return tree
    word, a, b = tree
    own = {"or": 1, "and": 2, "with": 3}[word]
    text = f"{_written(a, own)} {word.upper() if random.random() < 0.5 else word} {_written(b, own + 1)}"
    return f"({text})" if own < bind or random.random() < 0.15 and word != "with" else text


def _meaning(tree):
    if isinstance(tree, str):
        label, demands = licenses.label_of(tree)
        return {label}, demands
    word, a, b = tree
    left = _meaning(a)
    if word == "with":
        return left[0], left[1] - 1
    right = _meaning(b)
    if word == "and":
        return left[0] | right[0], max(left[1], right[1])
    return left if left[1] <= right[1] else right


def test_expressions_follow_their_tree():
    random.seed(11)
    for _ in range(500):
        tree = _tree(4)
        text = _written(tree)
        tokens, end = licenses.tokens_of(text)
        terms = licenses.evaluate(tokens)
        assert end == len(text) and (set(terms.labels), terms.demands) == _meaning(tree), text
        again = licenses.evaluate(licenses.tokens_of(terms.text)[0])
        assert (again.labels, again.demands, again.text) == (terms.labels, terms.demands, terms.text)


@pytest.mark.parametrize("text", ["", "MIT AND", "(MIT", "()", "(MIT OR", "(MIT AND GPL-2.0) WITH x", "MIT WITH (a OR b)", "GPL-2.0 WITH a WITH b"])
def test_broken_expressions(text):
    assert licenses.evaluate(licenses.tokens_of(text)[0]) is None


def test_long_expressions_are_read_whole(spark):
    text = "SPDX-License-Identifier: " + " AND ".join(["MIT"] * 500 + ["GPL-3.0"])
    row = licenses.scan(spark.createDataFrame([(1, text + "\nMIT")], "doc_id long, text string")).first()
    assert row.expressions[0].written.count("AND") == 500 and row.labels == "gpl,mit"


# ---------------------------------------------------------------- resampling

def plain_resample(rows, target, buckets=10_000, most=2, percent=25, least=20, seed=7):
    def features(text):
        words = words_of(text)
        return [zlib.crc32(" ".join(words[i:i + k]).encode()) % buckets for k in range(1, most + 1) for i in range(len(words) - k + 1)]

    s, t = (Counter(f for text in texts for f in features(text)) for texts in ([x[1] for x in rows], target))
    n_s, n_t = sum(s.values()), sum(t.values())
    gains = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        own = features(text)
        weight = sum(gains[f] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text))])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    ranks = Counter()
    for i, r in enumerate(able):
        ranks[(*r[:4], i + 1 if i < len(able) * percent // 100 else None)] += 1
    for r in out:
        if r[4] < least:
            ranks[(*r[:4], None)] += 1
    return ranks


TARGET = ["the quick brown fox jumps\nover the lazy dog", "alpha beta gamma delta", None, "\n\n", "dog\nalpha"]


@pytest.mark.parametrize("settings", [{}, {"most": 3, "buckets": 97, "percent": 60, "least": 5, "seed": 1}])
def test_resample_equals_its_definition(spark, odd, settings):
    aim = spark.createDataFrame([(t,) for t in TARGET], "text string")
    lines = spark.createDataFrame([(300 + i, "\n".join(["same line of boilerplate here"] * (i % 4) + [f"own {i}", "", "--", "tail x"]))
                                   for i in range(40)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionAll(lines).withColumn("row", F.lit("clash")).withColumn("key", F.lit(1))
    given = {{"least": "least_words"}.get(k, k): v for k, v in settings.items()}
    got = Counter(map(tuple, resample.resample(docs, aim, **given).collect()))
    assert got == plain_resample([(r.doc_id, r.text) for r in docs.collect()], TARGET, **settings)


def test_a_line_is_counted_once_and_weighed_by_its_occurrences(spark):
    docs = spark.createDataFrame([(i, "a b\nc d\n\na b\n") for i in range(5)], "doc_id long, text string")
    found = {bytes(r.key): r for r in resample.segments(docs, "text", 2, 10_000).collect()}
    assert {k: r.times for k, r in found.items()} == {hashlib.md5(b"a b").digest(): 10, hashlib.md5(b"c d").digest(): 5}
    cut = resample.cut_texts(docs, "doc_id", "text", 2, 10_000).first()
    assert sorted(cut.features) == sorted(zlib.crc32(x) % 10_000 for x in (b"b c", b"d a"))
    assert {bytes(x.key): x.times for x in cut.lines} == {hashlib.md5(b"a b").digest(): 2, hashlib.md5(b"c d").digest(): 1}


def test_resample_of_empty_tables(spark, none):
    aim = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert resample.resample(none, aim).count() == 0
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    got = Counter(map(tuple, resample.resample(docs, aim.limit(0), least_words=1, percent=100).collect()))
    assert got == plain_resample([(1, "a b c"), (2, None)], [], least=1, percent=100)
