"""Divergence of sources: how the words of each source differ from those of others, over the words that enough documents hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_through
from .spans import LETTERS, Spans
from .text import in_small_batches, utf8_slices

#: Bytes of the prefixes that are counted before the complete terms.
LEVELS = (2, 4, 8)
#: Bits of the filter of prefixes that stay, whatever their number.
FILTER_BITS = 1 << 23
BUCKET_BITS = 32_768  # bits of one of Spark's bitmaps
_SEED = 42  # fixed value: that of Spark's xxhash64
#: Bytes of terms that a task counts at once before it hands them on.
UNIT_BYTES = 6 << 20
#: Pairs of one term's sources that are compared at once.
PAIRS = 1 << 20


#: Joins each term with nothing by a space, which so stands behind it.
_BEHIND = pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary())


def numbered_groups(docs: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """``lang, source, i``: every language and source that occurs, and the number of the source in its language, from 0."""
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                           for c, name in ((lang_col, "lang"), (source_col, "source")))).distinct()
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return write_through(groups.withColumn("i", number), "groups")


def cut_terms(docs: DataFrame, groups: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """``lang, i, terms, counts`` for every row: its group, its distinct terms with a space behind each, and how often each
    occurs in it, as little-endian 32-bit numbers."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    rows = rows.join(groups, ["lang", "source"]).select("lang", "i", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(2)):
                spans = Spans(data, offsets, LETTERS)
                ends = np.r_[0, np.cumsum(spans.end - spans.begin)].astype(np.int64)
                words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(spans.begin), [
                    None, pa.py_buffer(ends), pa.py_buffer(spans.bytes[spans.inside])]).dictionary_encode()
                known = max(len(words.dictionary), 1)
                codes, counts = np.unique(spans.text * known + words.indices.to_numpy(), return_counts=True)
                places = np.r_[0, np.cumsum(np.bincount(codes // known, minlength=end - first))].astype(np.int64)
                spaced = pc.binary_join_element_wise(words.dictionary, *_BEHIND).take(pa.array(codes % known))
                letters = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset:spaced.offset + len(spaced) + 1]
                terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), end - first, [
                    None, pa.py_buffer(letters[places]), spaced.buffers()[2]])
                numbers = pa.LargeBinaryArray.from_buffers(pa.large_binary(), end - first, [
                    None, pa.py_buffer(4 * places), pa.py_buffer(counts.astype("<i4"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first),
                     terms.cast(pa.binary()), numbers.cast(pa.binary())], ["lang", "i", "terms", "counts"])

    return write_through(in_small_batches(rows).mapInArrow(run, "lang string, i int, terms binary, counts binary"), "terms")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[_Unit]:
    """The rows of a partition, by as many batches at once as have ``UNIT_BYTES`` of terms."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.column(2).nbytes for b in held) >= UNIT_BYTES:
            yield _Unit(pa.Table.from_batches(held))
            held = []
    if held:
        yield _Unit(pa.Table.from_batches(held))


class _Unit:
    """The terms of some rows as numbers: of each term of a row its row, its word and its count."""

    def __init__(self, table: pa.Table):
        langs = table.column(0).combine_chunks().dictionary_encode()
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)
        self.group = table.column(1).to_numpy().astype(np.int64)
        texts = table.column(2).combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        spaces = data == 32
        ends = np.flatnonzero(spaces)
        length = np.diff(ends, prepend=-1) - 1
        places = np.r_[0, np.cumsum(length)].astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(data[~spaces])]).dictionary_encode()
        self.words, self.word = words.dictionary, words.indices.to_numpy().astype(np.int64)
        counts = table.column(3).combine_chunks().cast(pa.large_binary())
        at = np.frombuffer(counts.buffers()[1], np.int64)[counts.offset:counts.offset + len(counts) + 1]
        self.count = np.frombuffer(counts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]].view("<i4").astype(np.int64)
        self.row = np.repeat(np.arange(len(at) - 1), np.diff(at) // 4)

    def prefixes(self, width: int) -> tuple[pa.Array, np.ndarray]:
        """The distinct prefixes of the words, and the prefix of each word."""
        if not len(self.words):
            return self.words, np.zeros(0, np.int64)
        encoded = pc.binary_slice(self.words, 0, width).dictionary_encode()
        return encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)

    def only(self, width: int, bits: bytes) -> None:
        """Leave the terms whose prefix of that width passes the filter of their language."""
        passed = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        prefixes, of = self.prefixes(width)
        known = max(len(prefixes), 1)
        own = self.lang[self.row] * known + of[self.word]
        there = np.zeros(known * len(self.langs), bool)
        there[own] = True
        codes, texts = np.flatnonzero(there), prefixes.to_pylist()
        seeds = [xxhash.xxh64_intdigest(lang.encode(), _SEED) for lang in self.langs.to_pylist()]
        there[codes] = passed[np.array([xxhash.xxh64_intdigest(texts[c % known], seeds[c // known]) & (FILTER_BITS - 1)
                                        for c in codes.tolist()], np.int64)] > 0
        stay = there[own]
        self.row, self.word, self.count = self.row[stay], self.word[stay], self.count[stay]


def _level(terms: DataFrame, width: int, before: tuple[int, bytes] | None) -> DataFrame:
    """``lang, prefix, docs``: prefixes of ``width`` bytes whose shorter prefix stayed, and how many rows hold each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _units(batches):
            if before:
                found.only(*before)
            prefixes, of = found.prefixes(width)
            known = max(len(prefixes), 1)
            held = np.unique(found.row * known + of[found.word])  # once for each row
            docs = np.bincount(found.lang[held // known] * known + held % known, minlength=known * len(found.langs))
            codes = np.flatnonzero(docs)
            yield pa.RecordBatch.from_arrays(
                [found.langs.take(pa.array(codes // known)), prefixes.take(pa.array(codes % known)).cast(pa.binary()),
                 pa.array(docs[codes], pa.int64())], ["lang", "prefix", "docs"])

    counted = in_small_batches(terms).mapInArrow(run, "lang string, prefix binary, docs long")
    return counted.groupBy("lang", "prefix").agg(F.sum("docs").alias("docs"))


def _filter_of(prefixes: DataFrame) -> bytes:
    """The bits of ``lang, prefix``; a fixed number of bytes is gathered, whatever the number of prefixes."""
    bit = F.xxhash64("lang", "prefix").bitwiseAND(FILTER_BITS - 1)
    rows = prefixes.select(bit.alias("bit")).groupBy(F.expr(f"bit div {BUCKET_BITS}").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(bit % {BUCKET_BITS})").alias("bits")).collect()
    whole = bytearray(FILTER_BITS // 8)
    for row in rows:
        whole[row["bucket"] * BUCKET_BITS // 8:(row["bucket"] + 1) * BUCKET_BITS // 8] = row["bits"]
    return bytes(whole)


_COUNTED = "lang string, term binary, docs long, total long, sources array<int>, counts array<long>"


def _sums(keys: np.ndarray, values: np.ndarray, below: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sums of the values of each; ``below`` all keys are, if it is given."""
    if below is not None and below <= 4 * len(keys) and values.sum(dtype=float) < 1 << 53:  # exact as doubles
        found = np.flatnonzero(np.bincount(keys, minlength=below))
        return found, np.bincount(keys, values, below)[found].astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(values[order], starts) if len(starts) else values[:0]


def _by_term(langs: pa.Array, terms: pa.Array, docs: np.ndarray, owner: np.ndarray, source: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for each term, of whose sources ``owner`` (the row), ``source`` and ``n`` tell; sources are summed."""
    many = int(source.max(initial=0)) + 1
    cells, n = _sums(owner * many + source, n, len(terms) * many)
    ends = np.r_[0, np.cumsum(np.bincount(cells // many, minlength=len(terms)))]
    total = np.r_[0, np.cumsum(n)][ends]
    return pa.RecordBatch.from_arrays(
        [langs, terms, pa.array(docs, pa.int64()), pa.array(np.diff(total), pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cells % many, pa.int32())),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(n, pa.int64()))],
        ["lang", "term", "docs", "total", "sources", "counts"])


def _merged(table: pa.Table) -> pa.RecordBatch:
    """One row for each term of a table sorted by term."""
    lang, term, docs, _, sources, counts = (c.combine_chunks() for c in table.columns)
    n = len(table)
    new = np.ones(n, bool)
    new[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    heads, of = np.flatnonzero(new), np.cumsum(new) - 1
    owner = np.repeat(of, sources.value_lengths().to_numpy(zero_copy_only=False))
    return _by_term(lang.take(pa.array(heads)), term.take(pa.array(heads)), np.add.reduceat(docs.to_numpy(), heads), owner,
                    sources.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy())


def frequent_terms(terms: DataFrame, least: int, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``lang, term, total, sources, counts``: terms that at least ``least`` rows of their language hold, how often each
    occurs in the language, in which of its sources, and how often in each.

    Prefixes grow level by level. A prefix fewer rows hold than ``least`` goes, and with it all that begins with it: the
    next level, and at last the count of complete terms, look only at what passes a filter of the prefixes that stayed. The
    filter has a fixed size, so it may let others pass, which the count of complete terms discards; it holds back none.
    Complete terms are summed within a task, dealt by term, and merged in order of the terms, one at a time.
    """
    before = None
    for width in levels:
        stayed = _level(terms, width, before).where(F.col("docs") >= least)
        before = width, _filter_of(stayed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _units(batches):
            if before:
                found.only(*before)
            known = max(len(found.words), 1)
            own = found.lang[found.row] * known + found.word
            docs = np.bincount(own, minlength=known * len(found.langs))
            codes, number = np.flatnonzero(docs), np.cumsum(docs > 0) - 1
            yield _by_term(found.langs.take(pa.array(codes // known)).cast(pa.string()),
                           found.words.take(pa.array(codes % known)).cast(pa.binary()), docs[codes], number[own],
                           found.group[found.row], found.count)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[pa.RecordBatch] = []  # the term that may go on in the next batch
        for batch in batches:
            if batch.num_rows:
                found = _merged(pa.Table.from_batches([*last, batch]))
                last = [found.slice(found.num_rows - 1)]
                yield found.slice(0, found.num_rows - 1)
        yield from last

    counted = in_small_batches(terms).mapInArrow(count, _COUNTED)
    merged = counted.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(merge, _COUNTED)
    return write_through(merged.where(F.col("docs") >= least).select(
        "lang", F.col("term").cast("string").alias("term"), "total", "sources", "counts"), "frequent-terms")


def _share(count: Column, total: Column, v: Column, scale: int, add: int) -> Column:
    """One plus the floor of ``scale`` times the smoothed share of a count, in whole numbers."""
    wide = F.lit(scale).cast("decimal(12,0)") * (count.cast("decimal(20,0)") + F.lit(add).cast("decimal(5,0)"))
    return F.call_function("div", wide, total + F.lit(add) * v) + 1


def _far(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _meetings(terms: DataFrame) -> DataFrame:
    """``lang, a, b, value`` of ``terms`` (lang, held: i, p, p0): for two sources that hold a term, what the term adds beyond
    the sums that take it as absent from either; summed over the terms of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            lists = batch.column(1)
            length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            i, p, p0 = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("i", "p", "p0"))
            many = int(i.max(initial=0)) + 1
            lang = np.repeat(langs.indices.to_numpy().astype(np.int64), length)
            several = np.repeat(length, length)
            begin = np.repeat(np.cumsum(length) - length, length)
            ends = np.cumsum(several)
            at = 0
            while at < len(i):  # as many left members as have PAIRS partners, one at least
                stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")), at + 1)
                n = several[at:stop]
                left = np.repeat(np.arange(at, stop), n)
                right = np.repeat(begin[at:stop] - np.cumsum(n) + n, n) + np.arange(n.sum())
                left, right = left[left != right], right[left != right]
                at = stop

                def far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                    return (x - y) ** 2 // y

                codes, sums = _sums((lang[left] * many + i[left]) * many + i[right], far(p[left], p[right])
                                    - far(p[left], p0[right]) - far(p0[left], p[right]) + far(p0[left], p0[right]))
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(codes // many // many)), pa.array(codes // many % many, pa.int32()),
                     pa.array(codes % many, pa.int32()), pa.array(sums, pa.int64())], ["lang", "a", "b", "value"])

    return terms.mapInArrow(run, "lang string, a int, b int, value long")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least: int = 3,
          most_terms: int = 200, add: int = 1, scale: int = 1_000_000_000, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from the others of its language, and by which terms.

    A term is a run of letters, A-Z in lower case; a language keeps those that at least ``least`` of its rows hold. Shares
    are smoothed over the kept terms and scaled to whole numbers, all sums are exact. Part ``pair`` has, for every other
    source of the language, the squared differences of the two sources' shares over that source's, summed over all kept
    terms, 0 if there are none. Part ``term`` has the ``most_terms`` terms whose share in the source exceeds the language's
    by most. ``rank`` counts from 1 by value, equal ones by item.

    Two sources that lack a term differ by a constant there, and one that lacks it has the share of nothing: these sums come
    from how many terms a source has of each share; only terms that both hold are compared one by one, within a batch. Part
    ``pair`` has as many rows as a language's sources have pairs, by definition.

    Null texts, languages and sources are empty ones; every language and source that occurs has its rows, with or without
    terms; a language of one source has no pairs; repeated rows count each time; an empty table gives no rows. Other columns
    are not read.
    """
    groups = numbered_groups(docs, lang_col, source_col)
    kept = frequent_terms(cut_terms(docs, groups, lang_col, source_col, text_col), least, levels)
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("in_lang"))
    of_group = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy(
        "lang", F.col("c.sources").alias("i")).agg(F.sum("c.counts").alias("in_group"), F.count("*").alias("own"))
    groups = groups.join(of_lang, "lang", "left").join(of_group, ["lang", "i"], "left").na.fill(0)
    p0 = F.when(F.col("v") > 0, _share(F.lit(0), F.col("in_group"), F.col("v"), scale, add))
    groups = write_through(groups.withColumn("p0", p0), "groups")
    lists = write_through(groups.groupBy("lang", "v", "in_lang").agg(
        F.sort_array(F.collect_list(F.struct("i", "in_group", "p0"))).alias("all")), "group-lists")

    def member(x: Column) -> Column:
        own = F.element_at("all", x["sources"] + 1)
        return F.struct(x["sources"].alias("i"), _share(x["counts"], own["in_group"], F.col("v"), scale, add).alias("p"),
                        own["p0"].alias("p0"))

    shares = write_through(kept.join(lists, "lang").select(
        "lang", "term", _share(F.col("total"), F.col("in_lang"), F.col("v"), scale, add).alias("q"),
        F.transform(F.arrays_zip("sources", "counts"), member).alias("held")), "shares")
    cells = shares.select("lang", "term", "q", F.explode("held").alias("c")).select("lang", "term", "q", "c.*")
    names = groups.select("lang", "i", "source")

    ranked = Window.partitionBy("lang", "i").orderBy(F.col("value").desc(), "item")
    by_term = cells.where("p > q").select("lang", "i", F.col("term").alias("item"), _far("p", "q").alias("value"))
    by_term = by_term.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= most_terms)
    by_term = by_term.join(names, ["lang", "i"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    wide = "decimal(38,0)"
    one = groups.select("lang", "v", *(F.col(c).alias(f"a_{c}") for c in ("i", "p0", "own")))
    other = groups.select("lang", *(F.col(c).alias(f"b_{c}") for c in ("i", "p0", "own")))
    absent = F.coalesce((F.col("v") - F.col("a_own") - F.col("b_own")).cast("decimal(20,0)") * _far("a_p0", "b_p0"), F.lit(0))
    both = one.join(other, "lang").where("a_i <> b_i").select("lang", F.col("a_i").alias("a"), F.col("b_i").alias("b"),
                                                              absent.cast(wide).alias("value"))
    alike = cells.groupBy("lang", "i", "p").agg(F.count("*").cast("decimal(20,0)").alias("n"))
    alone = alike.join(other, "lang").where("i <> b_i").select("lang", F.explode(F.array(
        F.struct(F.col("i").alias("a"), F.col("b_i").alias("b"), (F.col("n") * _far("p", "b_p0")).cast(wide).alias("value")),
        F.struct(F.col("b_i").alias("a"), F.col("i").alias("b"), (F.col("n") * _far("b_p0", "p")).cast(wide).alias("value")))
    ).alias("x")).select("lang", "x.*")
    met = _meetings(shares.select("lang", "held")).withColumn("value", F.col("value").cast(wide))
    by_pair = both.unionAll(alone).unionAll(met).groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value"))
    by_pair = (by_pair.join(names.withColumnRenamed("i", "a"), ["lang", "a"])
               .join(names.select("lang", F.col("i").alias("b"), F.col("source").alias("item")), ["lang", "b"])
               .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
               .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))))
    return by_pair.unionAll(by_term).withColumn("rank", F.col("rank").cast("long"))
