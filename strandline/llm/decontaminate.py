"""Benchmark passages in documents, found by winnowing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.naming import unused
from ..session import write_through
from .text import in_small_batches, mix64, utf8_slices

BASE = 0x9E3779B97F4A7C15
#: Bits of the filter of benchmark fingerprints that goes to every task, whatever the benchmark's size.
FILTER_BITS = 1 << 23
BUCKET_BITS = 32_768  # bits of one of Spark's bitmaps

#: A-Z in lower case, what is in no word as a space.
_BYTES = np.arange(256, dtype=np.uint8)
_IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80) \
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
_FOLDED = np.where(_IS_WORD, np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES), 32).astype(np.uint8)


class Words:
    """The words of a run of texts: folded bytes, begin and end of each word, its text and its hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.bytes = _FOLDED[data]
        inside = _IS_WORD[data]
        before = np.r_[False, inside[:-1]] if len(inside) else inside.copy()
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        behind = np.r_[inside[1:], False] if len(inside) else inside.copy()
        behind[offsets[1:][offsets[1:] > 0] - 1] = False
        self.begin = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~behind) + 1
        self.text = np.searchsorted(offsets, self.begin, side="right") - 1
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))  # first word of each text, and the end
        power = np.cumprod(np.r_[np.uint64(1), np.full(len(data), BASE, np.uint64)])
        inverse = np.cumprod(np.r_[np.uint64(1), np.full(len(data), pow(BASE, -1, 1 << 64), np.uint64)])
        sums = np.r_[np.uint64(0), np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * power[:-1])]
        self.hash = mix64((sums[self.end] - sums[self.begin]) * inverse[self.begin])

    def strings(self, begin: int, end: int) -> list[str]:
        """The words from ``begin`` to ``end``, which are of one text."""
        if begin >= end:
            return []
        return [w for w in bytes(self.bytes[self.begin[begin]:self.end[end - 1]]).decode().split(" ") if w]


def winnow(words: Words, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (first words) and hashes of the k-grams kept: the least of every ``window`` in a row, the last if equal."""
    n = len(words.hash) - k + 1
    if n - window + 1 <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(n, np.uint64)
    for j in range(k):
        grams = grams * np.uint64(BASE) + words.hash[j:j + n]
    grams = mix64(grams)
    m = n - window + 1
    best, at = grams[:m].copy(), np.arange(m)
    for j in range(1, window):
        other = grams[j:j + m]
        less = other <= best
        best = np.where(less, other, best)
        at = np.where(less, np.arange(j, j + m), at)
    whole = words.text[:m] == words.text[window + k - 2:window + k - 2 + m]
    kept = np.zeros(n, bool)
    kept[at[whole]] = True
    places = np.flatnonzero(kept)
    return places, grams[places]


FINGERPRINT = ("array<struct<scheme:int,hash:long,at:long,left:array<string>,gram:array<string>,right:array<string>>>")
_ARROW = pa.list_(pa.struct([("scheme", pa.int32()), ("hash", pa.int64()), ("at", pa.int64()),
                             ("left", pa.list_(pa.string())), ("gram", pa.list_(pa.string())),
                             ("right", pa.list_(pa.string()))]))


def schemes_of(span: int, k: int, lengths: list[int]) -> list[tuple[int, int, int]]:
    """``(need, k, window)`` for each length of passage that must be found: ``window + k - 1 = need``."""
    return [(n, min(k, n), n - min(k, n) + 1) for n in sorted({min(n, span) for n in lengths})]


def _fingerprints(df: DataFrame, schemes: list[tuple[int, int, int]], only: bytes | None, exact_lengths: int) -> DataFrame:
    """``id, key, n_words, prints`` of ``df`` (id, key, text).

    ``only``: the filter a fingerprint must pass. ``exact_lengths``: for benchmark items, the span; an item has
    fingerprints by the scheme of its own length. Each comes with the words beside it that a passage can reach.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = np.unpackbits(np.frombuffer(only, np.uint8), bitorder="little") if only is not None else None
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(2)):
                words = Words(data, offsets)
                found: list[list] = [[] for _ in range(end - first)]
                lengths = np.diff(words.first)
                for need, k, window in schemes:
                    places, hashes = winnow(words, k, window)
                    if passed is not None:
                        places, hashes = (x[passed[hashes & np.uint64(FILTER_BITS - 1)] > 0] for x in (places, hashes))
                    if exact_lengths:
                        own = np.minimum(lengths[words.text[places]], exact_lengths) == need
                        places, hashes = places[own], hashes[own]
                    texts = words.text[places]
                    for p, t, h in zip(places.tolist(), texts.tolist(), hashes.view(np.int64).tolist(), strict=True):
                        lo, hi = max(int(words.first[t]), p - need + k), min(int(words.first[t + 1]), p + need)
                        found[t].append({"scheme": need, "hash": h, "at": p - int(words.first[t]),
                                         "left": words.strings(lo, p)[::-1], "gram": words.strings(p, p + k),
                                         "right": words.strings(p + k, hi)})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first),
                     pa.array(lengths, pa.int64()), pa.array(found, _ARROW)], ["id", "key", "n_words", "prints"])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return in_small_batches(df).mapInArrow(run, f"id {kinds['id']}, key {kinds['key']}, n_words long, prints {FINGERPRINT}")


def _same_from_start(a: str, b: str) -> Column:
    """How many words two lists have in common from their start."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False)
    return F.when(stop > 0, stop - 1).otherwise(F.size(same))


def _filter_of(prints: DataFrame) -> bytes:
    """The bits of the fingerprints' hashes; a fixed number of bytes is gathered, whatever the number of hashes."""
    bit = F.col("hash").bitwiseAND(FILTER_BITS - 1)
    rows = prints.select(bit.alias("bit")).groupBy(F.expr(f"bit div {BUCKET_BITS}").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(bit % {BUCKET_BITS})").alias("bits")).collect()
    whole = bytearray(FILTER_BITS // 8)
    for row in rows:
        whole[row["bucket"] * BUCKET_BITS // 8:(row["bucket"] + 1) * BUCKET_BITS // 8] = row["bits"]
    return bytes(whole)


def contaminated_words(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", span: int = 10, k: int = 5) -> DataFrame:
    """``id, key, n_words, runs, items`` for every row of ``docs``: the runs of words (first, number) that lie in a window
    of a benchmark item, and the ids of these items, sorted as text, each once.

    A window is ``span`` words in a row of an item; an item of fewer words, but some, is one window. Of every window the
    least k-gram hash is kept, on both sides, so a shared window shares it. Document fingerprints that pass a filter of
    the benchmark's, of fixed size, meet the benchmark's in a join by hash; a hit is extended over equal words to either
    side, and counts if it spans a window. The words themselves are compared, so hashes that collide add nothing. Items of
    fewer than ``span`` words get a scheme for their length.

    ``key`` is the hash of the text: rows with equal id and text share their result; a null or empty text has no words;
    items without id or words take no part; empty tables give no runs or no rows. Other columns are not read.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.xxhash64(item_text_col).alias("key"),
                             F.col(item_text_col).alias("text")).where("id is not null and text is not null")
    n = F.size(F.expr(r"regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', 0)"))
    lengths = [r[0] for r in items.select(F.least(n, F.lit(span)).alias("n")).where("n > 0").distinct().collect()]
    schemes = schemes_of(span, k, lengths)
    theirs = _fingerprints(items, schemes, None, span).select("id", F.explode("prints").alias("p"))
    theirs = write_through(theirs.groupBy(*(F.col(f"p.{c}").alias(c) for c in ("scheme", "hash", "gram", "left", "right")))
                           .agg(F.array_sort(F.collect_set("id")).alias("items")), "benchmark-prints")
    ours = write_through(_fingerprints(
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")),
        schemes, _filter_of(theirs), 0), "document-prints")

    hits = ours.select("id", "key", F.explode("prints").alias("p")).select(
        "id", "key", "p.at", *(F.col(f"p.{c}").alias(f"d_{c}") for c in ("scheme", "hash", "gram", "left", "right")))
    met = hits.join(theirs, (F.col("d_hash") == F.col("hash")) & (F.col("d_scheme") == F.col("scheme"))
                    & (F.col("d_gram") == F.col("gram")))
    met = met.withColumn("l", _same_from_start("d_left", "left")).withColumn("r", _same_from_start("d_right", "right"))
    runs = met.select("id", "key", (F.col("at") - F.col("l")).alias("first"),
                      (F.col("l") + F.size("gram") + F.col("r")).cast("long").alias("number"), "items", "scheme")
    runs = runs.where("number >= scheme").groupBy("id", "key").agg(
        F.collect_set(F.struct("first", "number")).alias("runs"), F.collect_set("items").alias("items")).select(
        F.col("id").alias("h_id"), F.col("key").alias("h_key"), "runs",
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))
    joined = ours.select("id", "key", "n_words").join(
        runs, F.col("id").eqNullSafe(F.col("h_id")) & (F.col("key") == F.col("h_key")), "left")
    return joined.select("id", "key", "n_words",
                         F.coalesce("runs", F.array().cast("array<struct<first:bigint,number:bigint>>")).alias("runs"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def report(found: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of ``contaminated_words``."""
    words = F.expr("size(array_distinct(flatten(transform(runs, r -> sequence(r.first, r.first + r.number - 1)))))")
    return found.select(F.col("id").alias("doc_id"), "n_words", words.cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("items") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 10,
          k: int = 5) -> DataFrame:
    """``docs`` without the rows that share a window with a benchmark item; columns of any name stay as they are.

    Rows with equal id and text, null ids included, go or stay together; null and empty texts stay; an empty benchmark leaves
    all rows, an empty table has none.
    """
    hit_id, hit_key = unused(docs.columns, "_hit_id", "_hit_key")
    found = contaminated_words(docs, benchmark, id_col, text_col, span=span, k=k).where("size(items) > 0")
    # written, so that its size is known: few hits are sent to the rows, and whole rows are shuffled only to meet many
    found = write_through(found.select(F.col("id").alias(hit_id), F.col("key").alias(hit_key)).distinct(), "hits")
    same = docs[f"`{id_col}`"].eqNullSafe(F.col(hit_id)) & (F.xxhash64(docs[f"`{text_col}`"]) == F.col(hit_key))
    return docs.join(found, same, "left_anti")
