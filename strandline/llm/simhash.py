"""SimHash fingerprints and the documents they link, by multi-index hashing."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_through
from .components import connected_components
from .tables import Table, written
from .text import in_small_batches, let_go, mix64, utf8_list

SEED = 42


def shingle_hashes(text: bytes, shingle_words: int) -> np.ndarray:
    """XXH64 of each word shingle, repeats included.

    A-Z is lower-cased, words part at ASCII white space, fewer words than a shingle are one shingle.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in
                     zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist(), strict=True)], "<u8")


def fingerprint(text: bytes, shingle_words: int) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 if it has no words."""
    return common_bits(shingle_hashes(text, shingle_words))


def common_bits(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have; 0 if there are none."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """``doc_id, key, fp`` (signed longs) for every row; ``key`` is a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = np.array([fingerprint(t, shingle_words) for t in utf8_list(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found.view(np.int64))],
                                             ["doc_id", "key", "fp"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("key"))
    return in_small_batches(read).mapInArrow(run, "doc_id long, key long, fp long")


#: Bits of a segment; two fingerprints within 2 bits differ in at most one in either segment.
SEGMENT_BITS = 32
#: Fingerprints of a table's bucket beyond which the bucket is met by whole values instead.
MOST_MATCHES = 64


def segment_of(fp: str, segment: str) -> str:
    """SQL for a segment of a fingerprint, as a long."""
    return f"shiftrightunsigned({fp}, {SEGMENT_BITS} * {segment}) & {(1 << SEGMENT_BITS) - 1}L"


def linked_fingerprints(prints: DataFrame, most_matches: int = MOST_MATCHES) -> DataFrame:
    """``fp, root, distance``: pairs of the different fingerprints ``prints`` that differ in at most 2 bits, enough to connect all such.

    A table has each fingerprint under either of its two segments. The Hamming ball of radius 1 is enumerated within each segment,
    and what the table has under its values is verified by complete distance: of two fingerprints within 2 bits some segment
    differs in at most one, so each finds the other. A bucket of more than ``most_matches`` fingerprints is not met this way, as its pairs
    grow with its square: the fingerprints whose balls reach it, its own included, link by shared whole values
    (``linked_by_neighbours``), which loses none of them and has bounded groups. So a fingerprint meets a bounded number of others
    however many share a segment.
    """
    segments = "explode(array(0, 1)) as segment"
    table = prints.select("fp", F.expr(segments)).select("fp", "segment", F.expr(segment_of("fp", "segment")).alias("value"))
    ball = f"explode(transform(sequence(-1, {SEGMENT_BITS - 1}), i -> value ^ if(i < 0, 0L, shiftleft(1L, i)))) as value"
    probes = table.select("fp", "segment", F.expr(ball))
    heavy = write_through(table.groupBy("segment", "value").count().where(F.col("count") > most_matches).select("segment", "value"), "heavy")
    light = table.join(heavy, ["segment", "value"], "left_anti").withColumnRenamed("fp", "root")
    found = probes.join(light, ["segment", "value"]).where("root < fp and bit_count(fp ^ root) <= 2").select("fp", "root")
    if not heavy.isEmpty():
        reaching = probes.join(heavy, ["segment", "value"], "left_semi").select("fp").distinct()
        found = found.union(linked_by_neighbours(reaching))
    return found.distinct().withColumn("distance", F.expr("bit_count(fp ^ root)"))


def linked_by_neighbours(prints: DataFrame) -> DataFrame:
    """``fp, root``: pairs of the different fingerprints ``prints`` within 2 bits, enough to connect all such.

    If two differ in at most 2 bits, some third value differs from either in at most one. The whole values that differ from a fingerprint in
    at most one bit are keys; at most 65 fingerprints have a key, and each is paired with the least of its key only.
    """
    keyed = prints.select("fp", F.expr("explode(transform(sequence(-1, 63), i -> fp ^ if(i < 0, 0L, shiftleft(1L, i)))) as value"))
    return keyed.select("fp", F.expr("min(fp) over (partition by value)").alias("root")).where("fp <> root").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3) -> DataFrame:
    """``doc_id, key, fp, component, component_id``, one row for every row of ``docs``; ``key`` is a hash of the text,
    ``component`` a fingerprint that stands for the linked ones.

    Rows whose fingerprints differ in at most 2 bits are linked; ``component_id`` is the smallest id reachable over links.
    Null, empty and blank texts have fingerprint 0 and are linked like any other. A null id takes part in no minimum: a
    component of null ids only has a null component id. Repeated rows are rows of one component. An empty table gives
    no rows; other columns are not read. Copies meet as one fingerprint, so a group's size adds no pairs.
    """
    prints = write_through(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    nodes = write_through(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    components = connected_components(
        linked_fingerprints(nodes.select("fp")).select(F.col("fp").alias("a"), F.col("root").alias("b")))
    of_node = nodes.join(components.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = of_node.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of_node.join(smallest, "component").select("fp", "component", "component_id")
    return prints.join(named, "fp").select("doc_id", "key", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of similar ones: that of the smallest id.

    Of several rows with this id the one with the smallest hash of its text stays, of equal rows any.
    """
    linked = similar_documents(docs, id_col, text_col, shingle_words, similarity)
    id_of = {"has": F.col("id").isNotNull(), "id": F.coalesce("id", F.lit(0)), "key": F.col("key")}
    first = linked.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component").agg(
        F.min(F.struct("doc_id", "key")).alias("first")).select(F.col("first.doc_id").alias("id"), "first.key")
    stay = first.select(*(c.alias(n) for n, c in id_of.items()))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*(docs[f"`{c}`"].alias(n) for c, n in zip(docs.columns, names, strict=True)),
                       docs[f"`{id_col}`"].cast("long").alias("id"), F.xxhash64(docs[f"`{text_col}`"]).alias("key"))
    # plain keys, the same for the join and for repeated rows: whole rows are shuffled once
    rows = rows.select(*names, *(c.alias(n) for n, c in id_of.items()))
    kept = rows.join(stay, list(id_of), "left_semi").dropDuplicates(list(id_of))
    return kept.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))


# Pairs of long fingerprints, and pairs under shared values.

#: A long fingerprint has so many words of 64 bits, each of two segments.
LONG_WORDS = 5
SEGMENTS = 2 * LONG_WORDS


#: Members of a value that meet all others of it in the first round, and by how much their number grows with each round.
FIRST_PIVOTS, PIVOT_GROWTH = 8, 8


def linked_pairs(keyed: DataFrame, nodes: DataFrame, may: Column, verify: Callable[[DataFrame], Table],
                 links: DataFrame | None = None) -> DataFrame:
    """``a, b``: verified pairs of nodes under one value, enough to connect all that any such pair connects.

    ``keyed`` has each ``value`` and ``node`` (longs) once, ``nodes`` a row of each node; ``may`` tells of the columns of two, as structs
    ``a`` and ``b``, whether they can be a pair, and ``verify`` writes the true ones of pairs ``a, b``. ``links`` are verified
    pairs that are known before.

    In a round some members of each value, the pivots, meet all others of it; only verified pairs count. Pivots
    have then met everyone and leave; values whose members are all connected are settled. Pivots grow in number
    from round to round, those of the smallest components first, until nothing is left. So every pair of a value is verified
    or connected by others: a large group of copies adds pairs by its members, and unrelated nodes displace nobody.
    """
    of_value = Window.partitionBy("value")
    held = [written(keyed.withColumn("n", F.count("*").over(of_value)).where("n > 1").drop("n"), "shared")]
    left, pivots = held[0].rows, FIRST_PIVOTS
    while not left.isEmpty():
        if links is None:
            rows = left.withColumn("component", F.col("node")).withColumn("near", F.lit(1).cast("long"))
        else:
            rows = left.join(connected_components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
            rows = rows.withColumn("near", F.count("*").over(Window.partitionBy("value", "component")))
        # a written table: places decide both who meets now and who stays
        rows = rows.select("*", F.min("component").over(of_value).alias("low"), F.max("component").over(of_value).alias("high"),
                           F.count("*").over(of_value).alias("n"),
                           F.row_number().over(of_value.orderBy("near", F.xxhash64("node"), "node")).alias("place"))
        held.append(written(rows.where("low < high").select("value", "node", "component", "n", "place"), "placed"))
        held.pop(0).free()
        rows = held[0].rows
        sides = rows.join(nodes, "node").select("value", "component", "place", F.struct(*nodes.columns).alias("side"))
        first = sides.where(F.col("place") <= pivots).select(
            "value", F.col("component").alias("of_a"), F.col("place").alias("place_a"), F.col("side").alias("a"))
        other = sides.select("value", F.col("component").alias("of_b"), F.col("place").alias("place_b"), F.col("side").alias("b"))
        met = first.join(other, "value").where(F.expr("place_a < place_b and of_a <> of_b") & may)
        met = met.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()
        found = verify(met).rows
        links = found if links is None else links.union(found)
        left = rows.where((F.col("place") > pivots) & (F.col("n") > pivots + 1)).select("value", "node")
        pivots *= PIVOT_GROWTH
    held[0].free()
    return keyed.sparkSession.createDataFrame([], "a long, b long") if links is None else links


def similar_pairs(prints: DataFrame, bits: int) -> DataFrame:
    """``a, b`` of ``prints`` (node, fp: different long fingerprints): pairs that differ in at most ``bits`` bits.

    In every segment of 32 bits the Hamming ball of radius 1 is enumerated, and fingerprints that share a value of the balls, thus differ
    in at most 2 bits there, are candidates. Their complete distances are verified before any is left out (``linked_pairs``), so the
    pairs connect all candidates within ``bits``, and a value that many near copies share adds a few times its members, not their pairs.
    """
    ball = ("explode(flatten(transform(sequence(0, {0}), s -> transform(sequence(-1, 31), b -> "
            "shiftleft(cast(s as long), 32) | ((shiftrightunsigned(fp[s div 2], 32 * (s % 2)) & 4294967295L) ^ "
            "if(b < 0, 0L, shiftleft(1L, b))))))) as value").format(SEGMENTS - 1)
    distance = " + ".join(f"bit_count(a.fp[{i}] ^ b.fp[{i}])" for i in range(LONG_WORDS))
    return linked_pairs(prints.select("node", F.expr(ball)), prints.select("node", "fp"), F.expr(distance) <= bits, lambda pairs: written(pairs, "links"))


# Similar documents: linked fingerprints, then shared rare shingles; exact similarity decides either.

#: Shingles are counted in so many cells; the counts only order shingles.
CELLS = 1 << 18
#: 64-bit words of a parity map of a text's shingles, and bits of the filter of texts whose shingles are wanted.
PARITY_WORDS, WANTED_BITS = 8, 1 << 20


def shingle_set(text: bytes, shingle_words: int) -> np.ndarray:
    """The different shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(text, shingle_words))


def prefix_length(size: int, similarity: float) -> int:
    """Of two sets of a Jaccard ``similarity`` or more, so many first members of each, in any one order, have one in common."""
    return size - math.ceil(similarity * size - 1e-9) + 1 if size else 0


def parity_map(hashes: np.ndarray) -> np.ndarray:
    """Parities of the set's members by cell: two maps differ in no more bits than the sets in members."""
    bits = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % (64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def shingle_counts(docs: DataFrame, text_col: str, shingle_words: int) -> np.ndarray:
    """How often shingles fall in each of ``CELLS`` cells, over all texts; tasks send their cells."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for text in utf8_list(batch.column(0)):
                cells = (shingle_set(text, shingle_words) % np.uint64(CELLS)).astype(np.int64)
                np.add.at(total, cells, 1)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for counts in batch.column(0).to_pylist():
                total += np.frombuffer(counts, np.int64)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["counts"])

    read = docs.select(F.col(text_col).alias("text"))
    partial = in_small_batches(read).mapInArrow(count, "counts binary")
    merged = partial.repartition(8).mapInArrow(add, "counts binary").collect()  # bounded: eight tables of cells
    return sum((np.frombuffer(r["counts"], np.int64) for r in merged), np.zeros(CELLS, np.int64))


def with_prefixes(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, similarity: float) -> DataFrame:
    """``doc_id, key, node, size, fp, print, prefix`` for every row: ``node`` is a hash of the text's shingle set, ``size`` its members,
    ``fp`` its parity map, ``print`` its SimHash, ``prefix`` the first of its members, rare ones first."""
    shared = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs, text_col, shingle_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            nodes, sizes, maps, prints, prefixes = [], [], [], [], []
            for text in utf8_list(batch.column(1)):
                hashes = shingle_set(text, shingle_words)
                order = np.lexsort((mix64(hashes), counts[(hashes % np.uint64(CELLS)).astype(np.int64)]))
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                sizes.append(len(hashes))
                maps.append(parity_map(hashes))
                prints.append(common_bits(hashes))
                prefixes.append(hashes[order[:prefix_length(len(hashes), similarity)]])
            widths = [PARITY_WORDS] * len(maps), [len(p) for p in prefixes]
            lists = [pa.ListArray.from_arrays(np.r_[0, np.cumsum(w)].astype(np.int32), np.concatenate([np.zeros(0, np.int64), *(x.view(np.int64) for x in v)]))
                     for w, v in zip(widths, (maps, prefixes), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), lists[0],
                 pa.array(np.array(prints, np.uint64).view(np.int64)), lists[1]],
                ["doc_id", "key", "node", "size", "fp", "print", "prefix"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    return in_small_batches(read).mapInArrow(run, "doc_id long, key long, node long, size int, fp array<long>, print long, prefix array<long>")


def fingerprint_pairs(nodes: DataFrame, may: Column) -> DataFrame:
    """``a, b``: pairs of nodes whose SimHash fingerprints differ in at most 2 bits, by multi-index hashing (``linked_fingerprints``), enough
    to connect all such; without those that ``may`` tells are none."""
    firsts = write_through(nodes.groupBy("print").agg(F.min("node").alias("first")), "prints")
    same = nodes.join(firsts, "print").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    near = linked_fingerprints(firsts.select(F.col("print").alias("fp")))
    for print_of, c in (("fp", "a"), ("root", "b")):
        near = near.join(firsts.select(F.col("print").alias(print_of), F.col("first").alias(c)), print_of)
    pairs = same.union(near.select("a", "b"))
    for c in "ab":
        side = nodes.select(F.col("node").alias(f"{c}_node"), F.struct("node", "size", "fp").alias(f"of_{c}"))
        pairs = pairs.join(side, F.col(c) == F.col(f"{c}_node")).drop(c, f"{c}_node").withColumnRenamed(f"of_{c}", c)
    return pairs.where(may).select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def truly_similar(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text_col: str, shingle_words: int, similarity: float) -> Table:
    """Those of ``pairs`` (a, b: nodes) whose shingle sets have the Jaccard ``similarity``, computed in full.

    A fixed-size filter keeps most other texts from being read again; the join decides.
    """
    candidates = written(pairs, "candidates")
    pairs = candidates.rows
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(nodes.select("node", "key").join(ends, "node"), "wanted")
    slots = wanted.rows.select(F.pmod("key", F.lit(WANTED_BITS)).cast("int").alias("slot")).distinct().toArrow().column(0)  # bounded by the filter
    marks = np.zeros(WANTED_BITS, bool)
    marks[slots.to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(marks))

    def want(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(marked[batch.column(0).to_numpy() % WANTED_BITS]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            true = []
            ends = [c.to_pylist() for c in batch.columns[:2]]
            for a, b, of_a, of_b in zip(*ends, *map(utf8_list, batch.columns[2:]), strict=True):
                for node, text in ((a, of_a), (b, of_b)):
                    if node not in known:
                        known[node] = shingle_set(text, shingle_words)
                one, two = known[a], known[b]
                both = len(np.intersect1d(one, two, assume_unique=True))
                true.append((1 + similarity) * both >= similarity * (len(one) + len(two)) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(true, pa.bool_()))

    # Texts travel, not their hashes, which do not compress.
    read = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    found = in_small_batches(read).mapInArrow(want, "key long, text string").join(wanted.rows, "key").dropDuplicates(["key"])
    texts = written(found.select("node", "text"), "wanted-texts")
    for c in "ab":
        pairs = pairs.join(texts.rows.select(F.col("node").alias(c), F.col("text").alias(f"of_{c}")), c)
    true = written(pairs.select("a", "b", "of_a", "of_b").mapInArrow(compare, "a long, b long"), "links")
    for table in (candidates, wanted, texts):
        table.free()
    return true


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                      similarity: float = 0.8) -> DataFrame:
    """``doc_id, key, component, component_id``, one row for every row of ``docs``; as ``near_duplicates``, for texts of a Jaccard
    ``similarity`` (above 0) of their sets of shingle hashes or more.

    SimHash fingerprints of the sets that differ in at most 2 bits are found by multi-index hashing, and those of texts that are similar,
    compared in full, link them (``fingerprint_pairs``). Fingerprints of less similar texts lie further apart, so shared shingles follow.
    The groups are exact: such texts share one of the first members of their sets, rare ones first (``prefix_length``), and every pair that
    does is compared, by size and parity map and then in full, or connected by others that were (``linked_pairs``).
    Texts without words are alike. Null ids, repeated rows, empty tables and other columns as for ``near_duplicates``.
    """
    prefixes = written(with_prefixes(docs, id_col, text_col, shingle_words, similarity), "prefixes")
    prints = prefixes.rows
    nodes = write_through(prints.groupBy("node", "size", "fp", "print").agg(F.min("doc_id").alias("least"), F.min("key").alias("key")), "nodes")
    keyed = prints.select("node", "prefix").dropDuplicates(["node"]).select("node", F.explode("prefix").alias("value"))
    # Sets of a similarity s have at most (1 - s) / (1 + s) of their summed sizes in one only.
    apart = " + ".join(f"bit_count(a.fp[{i}] ^ b.fp[{i}])" for i in range(PARITY_WORDS))
    total = F.col("a.size") + F.col("b.size")
    may = ((F.least("a.size", "b.size") >= similarity * F.greatest("a.size", "b.size") - 1e-9)
           & ((1 + similarity) * F.expr(apart) <= (1 - similarity) * total + 1e-9))

    def verify(pairs: DataFrame) -> Table:
        return truly_similar(pairs, docs, nodes, text_col, shingle_words, similarity)
    linked = verify(fingerprint_pairs(nodes, may)).rows
    components = connected_components(linked_pairs(keyed, nodes.select("node", "size", "fp"), may, verify, linked))
    of_node = nodes.join(components, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component"))
    smallest = of_node.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of_node.join(smallest, "component").select("node", "component", "component_id")
    result = write_through(prints.select("doc_id", "key", "node").join(named, "node")
                           .select("doc_id", "key", "component", "component_id"), "similar")
    prefixes.free()
    return result
