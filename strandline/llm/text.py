"""Texts of Arrow batches, and the fold of a document."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 19
#: Rows of an Arrow batch of texts, which may be long.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session hands at most ``BATCH_ROWS`` rows to Python at once from here on."""
    if int(df.sparkSession.conf.get(_BATCH)) > BATCH_ROWS:
        df.sparkSession.conf.set(_BATCH, str(BATCH_ROWS))
    return df


_KEPT: list[tuple] = []


def kept(key: tuple, make: Callable[[], object]):
    """What ``make`` returned for this key, kept by the worker over its tasks until it is asked for another key.

    So a worker that serves the stages of a pipeline one after another holds the memory of one of them.
    """
    if not _KEPT or _KEPT[0][0] != key:
        let_go()
        _KEPT.append((key, make()))
    return _KEPT[0][1]


def let_go() -> None:
    """Drop what the worker keeps, and hand the memory that is free in the process back to the system."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU C library
        trim(0)


def forget_others(known: dict, wanted: Iterable[str]) -> None:
    """Leave in ``known`` only what is wanted now, which has the frequent ones."""
    stay = {w: known[w] for w in wanted if w in known}
    known.clear()
    known.update(stay)


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, mod ``folds``; a null id counts as empty text (fold 0)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def rows_to_read(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """``doc_id, text`` and, if ``carry``, ``row``: all columns of ``docs``, whatever their names, as one struct."""
    row = [F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")] if carry else []
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *row)


def schema_with(read: DataFrame, fields: str) -> T.StructType:
    """The type of ``doc_id``, the ``fields``, and ``row`` if it is carried."""
    schema = T.StructType([read.schema["doc_id"], *T.StructType.fromDDL(fields)])
    return schema.add(read.schema["row"]) if "row" in read.columns else schema


def carried(batch: pa.RecordBatch, first: int, number: int) -> list[pa.Array]:
    """The part of ``row`` that belongs to some rows of a batch, if it is carried."""
    return [batch.column(i).slice(first, number) for i in range(batch.num_columns) if batch.schema.field(i).name == "row"]


def utf8_list(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()


def text_list(column: pa.Array) -> list[str]:
    """The texts; null is empty."""
    return pc.fill_null(column, "").to_pylist()


def utf8_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, end row, their bytes, the offsets of the rows in them."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def mix64(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a hash depends on every bit of its input."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
