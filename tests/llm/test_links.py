"""SimHash links, components and benchmark passages against brute force."""

import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from strandline.llm import decontaminate, simhash
from strandline.llm.components import connected_components
from tests.llm.conftest import ROWS, prose

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_fingerprint(text, width=3):
    words = SPACE.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints_equal_brute_force():
    for _, text in ROWS:
        assert simhash.fingerprint((text or "").encode(), 3) == brute_fingerprint(text)


@pytest.mark.parametrize("most", [simhash.MOST_MATCHES, 3, 0])
def test_links_are_all_pairs_within_two_bits(spark, most):
    draw = np.random.default_rng(5)
    prints = set()
    for base in draw.integers(0, 1 << 62, 12).tolist():
        for flips in range(5):
            prints |= {base ^ sum(1 << int(b) for b in draw.choice(64, flips, replace=False)) for _ in range(4)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.linked_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"), most).collect()
    pairs = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    assert all(r["distance"] <= 2 for r in found)
    ours = brute_components(prints, [(r["fp"] % (1 << 64), r["root"] % (1 << 64)) for r in found])
    assert ours == brute_components(prints, pairs)


def test_a_segment_that_many_share_links_by_whole_values(spark):
    # 600 fingerprints with one half in common, numbered by odd multiples in the other, and a neighbour of each tenth
    prints = [(i * 2654435761 % (1 << 31) << 32) | 12345 for i in range(600)]
    prints += [p ^ (1 << 40) ^ 4 for p in prints[::10]]
    found = simhash.linked_fingerprints(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()
    pairs = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    assert all((r["fp"] ^ r["root"]).bit_count() == r["distance"] <= 2 for r in found)
    assert brute_components(prints, [(r["fp"], r["root"]) for r in found]) == brute_components(prints, pairs)


def test_near_duplicates_of_odd_rows(odd):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == len(ROWS)
    prints = [(i, brute_fingerprint(t)) for i, t in ROWS]
    linked = [(a, b) for a, b in combinations(range(len(ROWS)), 2) if (prints[a][1] ^ prints[b][1]).bit_count() <= 2]
    groups = defaultdict(list)
    for n, r in brute_components(range(len(ROWS)), linked).items():
        groups[r].append(n)
    expected = []
    for members in groups.values():
        smallest = min((prints[m][0] for m in members if prints[m][0] is not None), default=None)
        expected += [(prints[m][0], prints[m][1], smallest) for m in members]
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found), key=repr) == sorted(expected, key=repr)


def test_one_of_each_keeps_columns_and_one_row(odd):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(3) == 0 and ids.count(1) == 1 and 2 not in ids  # 3 is text 1 but for case and white space
    assert ids.count(4) == 1 and 5 not in ids and 6 not in ids  # without words
    assert sum(200 <= (i or 0) < 230 for i in ids) == 0 and 101 in ids


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)],
    [(3, None), (None, None), (7, 9)], [(5, 4), (4, 5), (4, 5), (-3, 2), (2, 8)],
])
def test_components(spark, edges):
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [e for e in edges if None not in e and e[0] != e[1]]
    assert found == brute_components({n for e in real for n in e}, real)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(text, items, span):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    hit, names = set(), set()
    for name, item in items:
        theirs = WORD.findall((item or "").lower())
        n = min(span, len(theirs))
        windows = {tuple(theirs[i:i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                names.add(str(name))
    return len(words), len(hit), ",".join(sorted(names))


@pytest.mark.parametrize("span", [10, 7])
def test_passages_equal_brute_force(spark, odd, span):
    items = [(1, prose(4, 25)), (2, prose(1, 10).upper()), (3, "lazy"), (4, "quick brown fox"), (10, "jumps over the lazy dog it s"),
             (5, ""), (6, None), (7, "..."), (8, "x" * 4000), (9, prose(3, 300)), (11, " ".join(["same"] * 30)), (9, prose(2, 12)),
             (None, prose(5, 20))]
    docs = odd.union(spark.createDataFrame(
        [(300, "same " * 50, "", "", 0, 0, 0), (301, f"{prose(4, 25)[3:]} and-then {prose(9, 30)}", "", "", 0, 0, 0)], odd.schema))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated_words(docs, benchmark, span=span)
    report = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.report(found).collect()}
    named = [i for i in items if i[0] is not None]
    expected = set()
    for r in docs.collect():
        n, hit, names = brute_hits(r["text"], named, span)
        expected.add((r["doc_id"], n, hit, len(names.split(",")) if names else 0, hit > 0))
    assert report == expected
    assert found.count() == docs.count()
    clean = decontaminate.clean(docs, benchmark, span=span)
    assert clean.columns == docs.columns
    assert clean.count() == sum(brute_hits(r["text"], named, span)[1] == 0 for r in docs.collect())


def test_clean_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, prose(1, 30), "a", "b"), (2, "clean text", "c", "d"), (None, None, "e", "f")],
                                 "doc_id long, text string, _hit_id string, _hit_key string")
    benchmark = spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r._hit_id for r in kept.collect()) == ["c", "e"]
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == 3


def test_empty_tables(spark, none, odd):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated_words(none, benchmark).collect() == []
    assert decontaminate.report(decontaminate.contaminated_words(odd, benchmark)).where("contaminated").collect() == []
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.one_of_each(none).collect() == []


def test_every_shared_span_shares_a_fingerprint():
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in draw.integers(0, 40, 400)]
    text = np.frombuffer(" ".join(words).encode(), np.uint8)
    whole = decontaminate.Words(text, np.array([0, len(text)]))
    places, _ = decontaminate.winnow(whole, 5, 6)
    for i in range(len(words) - 9):
        assert ((places >= i) & (places <= i + 5)).any()


def test_similar_documents_are_copies_with_few_changes(spark):
    draw = np.random.default_rng(11)
    words = [f"w{i}" for i in range(3000)]
    rows, base = [], []
    for i in range(60):
        base.append(draw.choice(words, 400).tolist())
        rows.append((i, " ".join(base[-1])))
    for i, changes in enumerate([0, 1, 2, 3, 4] * 12):  # a similarity of 0.9 or more
        copy = list(base[i])
        for place in draw.choice(400, changes, replace=False):
            copy[place] = "changed"
        rows.append((100 + i, " ".join(copy).upper().replace(" ", "  ")))
    rows += [(200 + i, " ".join(base[i][:200] + draw.choice(words, 200).tolist())) for i in range(20)]  # half of it
    rows += [(300, ""), (301, None), (302, "one"), (303, "two")]
    found = {r["doc_id"]: r["component_id"] for r in
             simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert sum(found[100 + i] == i for i in range(60)) >= 57 and all(found[100 + i] == i for i in range(0, 60, 5))
    assert all(found[i] == i for i in [*range(60), *range(200, 221), 302, 303] if i < 220 or i > 300)
    assert found[300] == found[301] == 300


def test_pairs_of_a_shared_value_are_linear(spark):
    # a thousand fingerprints that share all but one segment
    prints = [(i, [i, 0, 0, 0, 0]) for i in range(1000)]
    found = simhash.similar_pairs(spark.createDataFrame(prints, "node long, fp array<long>"), 64)
    assert found.count() < 40_000
    linked = brute_components(range(1000), [(r["a"], r["b"]) for r in found.collect()])
    assert set(linked.values()) == {0}


def test_unrelated_nodes_displace_no_pair(spark):
    # every node has the same first word; nodes i and 199 - i are alike elsewhere, and all others lie between or around them
    draw = np.random.default_rng(5)
    rest = [draw.integers(-2 ** 63, 2 ** 63, 4).tolist() for _ in range(100)]
    prints = [(i, [7, *rest[min(i, 199 - i)][:3], i]) for i in range(200)]
    mixed = [(n, [*fp[:1], *(w ^ (0x0101010101010101 * (n > 99)) for w in fp[1:4]), fp[4]]) for n, fp in prints]  # 4 bits of every segment
    found = simhash.similar_pairs(spark.createDataFrame(mixed, "node long, fp array<long>"), 40).collect()
    assert {(r["a"], r["b"]) for r in found} >= {(i, 199 - i) for i in range(100)}
    assert all(sum((x ^ y).bit_count() if x ^ y >= 0 else ((x ^ y) % 2 ** 64).bit_count() for x, y in
                   zip(mixed[r["a"]][1], mixed[r["b"]][1], strict=True)) <= 40 for r in found)


def test_groups_are_those_of_exact_similarity(spark):
    draw = np.random.default_rng(17)
    words = [f"w{i}" for i in range(4000)]
    common = draw.choice(words, 60).tolist()
    rows = []
    for i in range(120):
        base = common + draw.choice(words, int(draw.integers(40, 300))).tolist()
        rows.append((len(rows), " ".join(base)))
        for changes in draw.integers(1, 14, 3):  # similarities from about 0.3 to 0.97, many near 0.8
            copy = list(base)
            for place in draw.choice(len(copy), changes, replace=False):
                copy[place] = str(draw.choice(words))
            rows.append((len(rows), " ".join(copy)))
    hub = draw.choice(words, 150).tolist()
    for _ in range(60):  # each like the hub, many not like one another
        copy = list(hub)
        for place in draw.choice(150, 3, replace=False):
            copy[place] = str(draw.choice(words))
        rows.append((len(rows), " ".join(copy)))
    sets = [{tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)} for _, t in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    near = [0.65 <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < 0.8 for a, b in combinations(range(len(rows)), 2)]
    assert sum(near) > 50 and sum(len(sets[a] & sets[b]) < 0.85 * len(sets[a] | sets[b]) for a, b in links) > 20
    found = {r["doc_id"]: r["component_id"] for r in
             simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert found == brute_components(range(len(rows)), links)


def test_near_copies_are_linked_by_their_fingerprints_first(spark, monkeypatch):
    """Links that are known before shared shingles are looked at: near fingerprints of similar texts, no others."""
    draw = np.random.default_rng(31)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 4000, 900)) for _ in range(6)]
    copies = [f"{t} {t.split()[0]}" for t in texts[:4]]
    halves = [" ".join(t.split()[:450]) for t in texts]
    rows = list(enumerate([*texts, *copies, *halves, "", None]))
    known = []

    def only_known(keyed, nodes, may, verify, links):
        known.append(links.count())
        return links
    monkeypatch.setattr(simhash, "linked_pairs", only_known)
    found = {r.doc_id: r.component_id for r in
             simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    prints = [simhash.common_bits(simhash.shingle_set((t or "").encode(), 5)) for _, t in rows]
    near = [i for i in range(4) if (prints[i] ^ prints[6 + i]).bit_count() <= 2]
    assert near and known == [len(near)]
    want = {i: i for i, _ in rows} | {6 + i: i for i in near} | {len(rows) - 1: len(rows) - 2}
    assert found == want


def test_shingles_of_all_texts_are_counted(odd):
    expected = np.zeros(simhash.CELLS, np.int64)
    for _, text in ROWS:
        cells = (simhash.shingle_set((text or "").encode(), 5) % np.uint64(simhash.CELLS)).astype(np.int64)
        np.add.at(expected, cells, 1)
    assert (simhash.shingle_counts(odd, "text", 5) == expected).all()
