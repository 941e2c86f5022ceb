"""Token ids of a corpus in files, in the order of the documents' ids, and back.

The files are Parquet; a row is a group of whole documents: its place, the documents' ids and lengths, and the token ids in blocks of
the range coder. Spark commits them, so a lost task leaves nothing behind, on any file system.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import rangecoder
from .text import in_small_batches, kept, text_list
from .wordbpe import spelling

#: Ids after which a group ends, with the document that reaches them.
GROUP_IDS = 1 << 21
REMEMBERED = 1_200_000
TEXTS = 4_000
SCHEMA = "part int, number int, doc_ids array<long>, lengths array<long>, blocks array<binary>"
#: A single space between other characters: a pre-token begins with it, and none crosses it.
SPACE = re.compile(r"(?<=\S) (?=\S)")
LETTERS, SIGNS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+", r"[!-&(-/:-;=-@\[-`{-~]+"
#: A word of settled letters and the signs behind it, also over lines; its words, signs and ends of lines are pre-tokens of their own.
LINES = re.compile(rf"{LETTERS}(?:{SIGNS})?(?:\n{LETTERS}(?:{SIGNS})?)*")
PARTS = re.compile(rf"{LETTERS}|{SIGNS}|\n")
#: How the vocabulary spells the bytes of a pre-token.
SPELLING = spelling()
SPACED = "Ġ"
#: Instead of a unit's number.
UNSURE = -1
#: White space that a unit must neither begin nor end with.
WHITE = frozenset(chr(c) for c in range(0x3001) if chr(c).isspace())


class UnitEncoder:
    """Encodes texts by units whose ids it remembers.

    The library's byte-level pattern begins a pre-token with a single space between other characters, so what lies
    between such spaces has ids of its own. Texts are cut at all spaces; where a piece is empty, or begins or ends with white space,
    the cut was not between other characters, and its text is cut with care. Units are numbered; their ids stand one after another.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are parallel already
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.behind: dict[str, int] = {}  # pieces behind a space, without it; UNSURE where the cut may not be right
        self.units: dict[str, int] = {}  # other units, as they stand in a text
        self.ids, self.ends = array("H"), array("q", [0])

    def _numbers(self, ids: np.ndarray | list[int], lengths: np.ndarray | list[int]) -> range:
        """The numbers of units whose ids stand one after another in ``ids``."""
        begin = len(self.ends) - 1
        self.ends.frombytes((self.ends[-1] + np.cumsum(lengths, dtype=np.int64)).tobytes())
        self.ids.frombytes(np.asarray(ids, np.uint16).tobytes())
        return range(begin, len(self.ends) - 1)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units, one after another, and how many each has."""
        bounds, ids = np.frombuffer(self.ends, np.int64), np.frombuffer(self.ids, np.uint16)
        starts = bounds[numbers]
        lengths = bounds[numbers + 1] - starts
        ends = np.cumsum(lengths)
        return ids[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)], lengths

    def _library(self, units: list[str]) -> Iterator[int]:
        """The numbers of units that the library encodes."""
        for first in range(0, len(units), 10_000):
            found = [x.ids for x in self.tokenizer.encode_batch_fast(units[first:first + 10_000], add_special_tokens=False)]
            yield from self._numbers(list(chain.from_iterable(found)), list(map(len, found)))

    def _learn_units(self, units: Iterable[str]) -> None:
        new = list(set(units).difference(self.units))
        self.units.update(zip(new, self._library(new), strict=True))

    def _learn_words(self, known: dict[str, int], words: Iterable[str], before: str = "") -> None:
        """One pre-token each, so the library's model takes them as they are spelled."""
        tokenize, words = self.tokenizer.model.tokenize, list(set(words).difference(known))
        for first in range(0, len(words), 50_000):
            part = words[first:first + 50_000]
            spelled = " ".join(part).encode().decode("latin-1").translate(SPELLING).split(" ")
            ids, lengths = [], []
            for spelling in spelled:
                found = tokenize(before + spelling)
                lengths.append(len(found))
                ids += [t.id for t in found]
            known.update(zip(part, self._numbers(ids, lengths), strict=True))

    def _learn(self, pieces: list[str]) -> None:
        """Pieces behind a space; words, signs behind them and lines of these are put together from their pre-tokens."""
        words, starts, signs, joined, others = [], [], [], [], []
        for piece in pieces:
            if piece.isalpha() and piece.isascii():
                words.append(piece)
            elif not piece or piece[0] in WHITE or piece[-1] in WHITE:
                self.behind[piece] = UNSURE
            elif LINES.fullmatch(piece):
                word, *rest = PARTS.findall(piece)
                words.append(word)
                if rest:
                    joined.append(piece)
                    starts += [x for x in rest if x[0].isalpha()]
                    signs += [x for x in rest if not x[0].isalpha()]
            else:
                others.append(piece)
        self._learn_words(self.behind, words, SPACED)
        self._learn_words(self.units, starts)
        self._learn_units(signs)
        self.behind.update(zip(others, self._library([" " + p for p in others]), strict=True))
        if joined:
            numbers, counts = [], []
            for piece in joined:
                word, *rest = PARTS.findall(piece)
                numbers.append(self.behind[word])
                numbers += [self.units[x] for x in rest]
                counts.append(1 + len(rest))
            ids, lengths = self._gather(np.array(numbers))
            self.behind.update(zip(joined, self._numbers(ids, np.add.reduceat(lengths, np.cumsum(counts) - counts)), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not texts:
            return []
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets = cut.offsets.to_numpy()
        cells = cut.flatten().dictionary_encode()
        place, pieces = cells.indices.to_numpy(), cells.dictionary.to_numpy(zero_copy_only=False).tolist()
        firsts = [pieces[i] for i in place[offsets[:-1]].tolist()]
        numbers = list(map(self.behind.get, pieces))
        new = [p for p, n in zip(pieces, numbers, strict=True) if n is None]
        if len(self.behind) + len(self.units) + 2 * len(new) > REMEMBERED:
            self.forget()
            new, numbers = pieces, [None] * len(pieces)
        self._learn(new)
        place = np.array([self.behind[p] if n is None else n for p, n in zip(pieces, numbers, strict=True)], np.int64)[place]
        careful = np.flatnonzero(np.logical_or.reduceat(place == UNSURE, offsets[:-1])).tolist()
        sides = {t: [x for x in _with_spaces(SPACE.split(texts[t])) if x] for t in careful}
        normal = [t for t in range(len(texts)) if t not in sides]
        self._learn_units(chain((firsts[t] for t in normal), chain.from_iterable(sides.values())))
        place[offsets[normal]] = [self.units[firsts[t]] for t in normal]  # a first piece has no space before it
        if sides:
            split = np.split(place, offsets[1:-1])
            for t, units in sides.items():
                split[t] = np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))
            place = np.concatenate(split)
            offsets = np.r_[0, np.cumsum([len(s) for s in split])]
        ids, lengths = self._gather(place)
        bounds = np.r_[0, np.cumsum(lengths)][offsets]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _with_spaces(cut: list[str]) -> Iterator[str]:
    yield cut[0]
    yield from (" " + p for p in cut[1:])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], int]]:
    """Ids and texts of about ``TEXTS`` rows at a time, and the part they are of."""
    keys, texts, part = [], [], 0
    for batch in batches:
        if batch.num_rows:
            keys, texts = keys + batch.column(0).to_pylist(), texts + text_list(batch.column(1))
            part = batch.column(2)[0].as_py()
        if len(keys) >= TEXTS:
            yield keys, texts, part
            keys, texts = [], []
    if keys:
        yield keys, texts, part


def write(docs: DataFrame, path: str, out: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the ids of every text (null: empty), each followed by ``end_id``, to files at ``out``; returns ``out``.

    Rows are dealt by ranges of their id and sorted inside, null ids first, equal ids by a hash of their text; parts
    follow the ranges. The vocabulary at ``path`` must have fewer than 65,535 ids. An empty table gives files without rows.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("ids", path), lambda: UnitEncoder(path))
        end = np.array([end_id], "<u2")
        ids, held, size, number, part = [], [], 0, 0, 0

        def group() -> pa.RecordBatch:
            lengths = np.array([len(x) + 1 for x in held], np.int64)
            blocks = rangecoder.encode(np.concatenate([x for h in held for x in (h, end)]).astype(np.int64))
            row = {"part": part, "number": number, "doc_ids": list(ids), "lengths": lengths.tolist(), "blocks": blocks}
            return pa.RecordBatch.from_pylist([row], pa.schema(
                [("part", pa.int32()), ("number", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                 ("lengths", pa.list_(pa.int64())), ("blocks", pa.list_(pa.binary()))]))

        for keys, texts, part in _gathered(batches):
            for key, coded in zip(keys, encoder.encode(texts), strict=True):
                ids.append(key)
                held.append(coded)
                size += len(coded) + 1
                if size >= GROUP_IDS:
                    yield group()
                    ids, held, size, number = [], [], 0, number + 1
        if ids:
            yield group()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = in_small_batches(rows).repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))
    dealt.withColumn("part", F.spark_partition_id()).mapInArrow(encode, SCHEMA).write.parquet(out)
    return out


def read(spark: SparkSession, path: str, digest: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, value`` for every document of the files, from the decoded ids.

    ``start`` is the number of ids of all documents before it; ``value`` is ``digest`` of its ids, an integer (unsigned
    crc32 of them as little-endian unsigned 32-bit integers, unless another is given). A block that its checksum does
    not confirm is an error.
    """
    groups = spark.read.schema(SCHEMA).parquet(path)
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)
    sizes = groups.select("part", "number", total.alias("n"))
    # one row for each part meets in one task, then one for each group of a part: never one for each document
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    before = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(parts, "part").select("part", "number", (
        F.col("part_start") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = rangecoder.decode(row["blocks"])
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                if digest is None:
                    data = memoryview(ids.astype("<u4").tobytes())
                    values = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                else:
                    values = [digest(x) for x in np.split(ids, ends[:-1])]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["number"], np.int32)),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(ends - lengths), pa.array(lengths), pa.array(values, pa.int64())],
                    ["part", "number", "doc_id", "inside", "n_tokens", "value"])

    decoded = groups.select("part", "number", "doc_ids", "lengths", "blocks").mapInArrow(
        decode, "part int, number int, doc_id long, inside long, n_tokens long, value long")
    return decoded.join(starts, ["part", "number"]).select("doc_id", (F.col("start") + F.col("inside")).alias("start"),
                                                           "n_tokens", "value")


def round_trip(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, written to files and read back from them."""
    spark = docs.sparkSession
    return read(spark, write(docs, path, scratch_path(spark, "token-ids"), end_id)).withColumnRenamed("value", "ids_crc32")
