"""Importance resampling towards a target: hashed n-grams of two corpora, counted once for each distinct line."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_global_index
from ..session import write_through
from .spans import Spans, run_crcs
from .text import in_small_batches, utf8_slices

#: Fixed value: the parts of a whole in which a gain is counted, and the values a hash has.
GAIN_UNIT, HASHES = 1000, 1 << 32


def _lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """``values`` as lists, by the row that owns each."""
    order = np.argsort(owner, kind="stable")
    ends = np.cumsum(np.bincount(owner, minlength=n))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values[order].astype(np.int32)))


def _runs(spans: Spans, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, last word and bucket of every run of 1 to ``most`` words of one text."""
    found = run_crcs(spans, most)
    first = np.concatenate([at for at, _ in found])
    last = np.concatenate([at + k for k, (at, _) in enumerate(found)])
    return first, last, np.concatenate([crc for _, crc in found]) % np.uint32(buckets)


def segments(docs: DataFrame, text_col: str, most: int, buckets: int) -> DataFrame:
    """``key, times, features``: every distinct line of the corpus that is not empty, the MD5 of its bytes, how often it
    occurs, and the buckets of its n-grams, repeats included. A line that many texts hold is counted before the shuffle.
    """
    lines = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("line")).where("line <> ''")
    lines = lines.groupBy("line").agg(F.count("*").alias("times"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(0)):
                spans = Spans(data, offsets)
                begin, _, bucket = _runs(spans, most, buckets)
                raw = data.tobytes()
                keys = [hashlib.md5(raw[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), batch.column(1).slice(first, end - first),
                     _lists(spans.text[begin], bucket, end - first)], ["key", "times", "features"])

    return write_through(in_small_batches(lines).mapInArrow(run, "key binary, times long, features array<int>"), "segments")


def cut_texts(docs: DataFrame, id_col: str, text_col: str, most: int, buckets: int) -> DataFrame:
    """``row, doc_id, n_words, lines, features`` for every row: the keys of its lines with their occurrences, and the buckets
    of the n-grams that reach over an end of line. ``row`` tells rows apart."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    pairs = pa.list_(pa.struct([("key", pa.binary()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(2)):
                spans = Spans(data, offsets)
                line = np.searchsorted(np.flatnonzero(data == 10), spans.begin)
                begin, last, bucket = _runs(spans, most, buckets)
                across = line[begin] != line[last]
                raw, held = data.tobytes(), []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    counts = Counter(x for x in raw[a:b].split(b"\n") if x)
                    held.append([{"key": hashlib.md5(x).digest(), "times": n} for x, n in counts.items()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first),
                     pa.array(np.diff(spans.first), pa.int64()), pa.array(held, pairs),
                     _lists(spans.text[begin[across]], bucket[across], end - first)],
                    ["row", "doc_id", "n_words", "lines", "features"])

    return write_through(in_small_batches(rows).mapInArrow(
        run, f"row long, doc_id {kinds['doc_id']}, n_words long, lines array<struct<key:binary,times:long>>, features array<int>"),
        "cut-texts")


def feature_counts(found: DataFrame, cut: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in a corpus: features of distinct lines times their occurrences, and those across lines.

    The driver gets a row for each bucket, at most ``buckets``.
    """
    both = found.select(F.explode("features").alias("bucket"), "times").unionAll(
        cut.select(F.explode("features").alias("bucket"), F.lit(1).cast("long").alias("times")))
    counts = np.zeros(buckets, np.int64)
    for row in both.groupBy("bucket").agg(F.sum("times").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The floored log ratio of each bucket's share of the target to its share of the source, one added to every count."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(GAIN_UNIT * math.log((float(y) + 1) * (s + n) / ((float(x) + 1) * (t + n))))
                     for x, y in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _gains_of(table: DataFrame, key: str, gains: np.ndarray) -> DataFrame:
    """``key, n, gain``: number and sum of gains of the ``features`` of each row."""
    kind = table.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.r_[0, np.cumsum(gains[lists.flatten().to_numpy(zero_copy_only=False)])]
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(sums[ends] - sums[ends - n])], [key, "n", "gain"])

    return table.select(key, "features").mapInArrow(run, f"{key} {kind}, n long, gain long")


def weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
            most: int = 2, buckets: int = 10_000) -> DataFrame:
    """``row, doc_id, n_words, n_features, weight`` for every row of ``docs``.

    Features are all runs of 1 to ``most`` words of a text, hashed into ``buckets``. Line ends cut the texts: the features
    of each distinct line are found once, counted as often as the line occurs, and its gains are summed once for all texts
    that hold it; only runs over an end of line belong to a text of its own. ``weight`` is the mean gain of a text's
    features, rounded down; 0 without features.
    """
    found, cut = segments(docs, text_col, most, buckets), cut_texts(docs, id_col, text_col, most, buckets)
    aim = target.select(F.lit(0).alias("doc_id"), F.col(target_col).alias("text"))
    gains = bucket_gains(feature_counts(found, cut, buckets), feature_counts(
        segments(aim, "text", most, buckets), cut_texts(aim, "doc_id", "text", most, buckets), buckets))
    lines = cut.select("row", F.explode("lines").alias("l")).select("row", F.col("l.key").alias("key"), "l.times")
    lines = lines.join(_gains_of(found, "key", gains), "key").select(
        "row", (F.col("n") * F.col("times")).alias("n"), (F.col("gain") * F.col("times")).alias("gain"))
    sums = lines.unionAll(_gains_of(cut, "row", gains)).groupBy("row").agg(F.sum("n").alias("n_features"), F.sum("gain").alias("gain"))
    weight = F.when(F.col("n_features") > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(0)
    return cut.select("row", "doc_id", "n_words").join(sums, "row").select(
        "row", "doc_id", "n_words", "n_features", weight.cast("long").alias("weight"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             most: int = 2, buckets: int = 10_000, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row: a draw without replacement of ``percent`` of the texts of
    at least ``least_words`` words, likelier the more a text's features are the target's.

    ``score`` adds Gumbel noise of the id (as text; null as empty) to the weight, in thousandths; the highest scores are
    drawn, equal ones by smaller id, a null id first, and repeated rows in any order; ``rank`` counts them from 1 and is
    null for the others. Null and empty texts have no features, weight 0 and are never drawn. Empty tables give no rows;
    an empty target weighs by the source alone. Other columns are not read, whatever their names.
    """
    found = weights(docs, target, id_col, text_col, target_col, most, buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    part = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(HASHES))
    noise = F.floor(F.lit(-float(GAIN_UNIT)) * F.log(-F.log(part))).cast("long")
    scored = write_through(found.withColumn("score", F.col("weight") + noise), "scored")
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    placed = with_global_index(scored.where(able), [F.col("score").desc(), "doc_id", "row"], "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("long")
    out = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*out, rank.alias("rank")).unionAll(
        scored.where(~able).select(*out, F.lit(None).cast("long").alias("rank")))
