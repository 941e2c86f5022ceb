"""Text quality by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through
from .text import in_small_batches, mix64, utf8_slices

#: Classes of bytes whose shares are statistics: name and members.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "stop": b".,;:", "shout": b"!?", "symbol": b"#$%&*+=<>@^_~/\\", "bar": b"|", "quote": b"\"'`()[]{}-",
    "line": b"\n\r",
}
NAMES = ["bytes", "words", "word_bytes", "word_spread", "other", *CLASSES, "distinct", "top_word", "distinct_lines"]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of transformed statistics (``NAMES``) for each text; an empty text has the row of zero counts.

    Lengths are taken as logarithms, shares as logits of (count + 0.5) / (whole + 1).
    """
    sizes = np.diff(offsets)
    rows = len(sizes)
    text = np.repeat(np.arange(rows), sizes)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(mask)][offsets])

    space = np.isin(data, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
    opens = np.r_[True, text[1:] != text[:-1]] if len(data) else np.zeros(0, bool)
    begin = np.flatnonzero(~space & (opens | np.r_[True, space[:-1]])) if len(data) else np.zeros(0, np.int64)
    closes = np.r_[text[1:] != text[:-1], True] if len(data) else opens
    end = np.flatnonzero(~space & (closes | np.r_[space[1:], True])) + 1 if len(data) else begin
    lengths, owner = (end - begin).astype(float), text[begin]
    words = np.bincount(owner, minlength=rows)
    total, squares = (np.bincount(owner, lengths ** p, rows) for p in (1, 2))
    mean = total / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(squares / np.maximum(words, 1) - mean ** 2, 0))

    def distinct(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many different slices each text has, and how often the commonest occurs."""
        hashes = _slice_hashes(data, begin, end)
        order = np.lexsort((hashes, text[begin]))
        of, hashes = text[begin][order], hashes[order]
        head = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])]) if len(of) else order
        runs = np.diff(np.r_[head, len(of)])
        most = np.zeros(rows)
        np.maximum.at(most, of[head], runs)
        return np.bincount(of[head], minlength=rows), most

    different, most = distinct(begin, end)
    line = np.isin(data, np.frombuffer(CLASSES["line"], np.uint8))
    line_begin = np.flatnonzero(~line & (opens | np.r_[True, line[:-1]])) if len(data) else begin
    line_end = np.flatnonzero(~line & (closes | np.r_[line[1:], True])) + 1 if len(data) else begin
    lines = np.bincount(text[line_begin], minlength=rows)
    different_lines, _ = distinct(line_begin, line_end)

    def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
        ratio = (count + 0.5) / (whole + 1)
        return np.log(ratio) - np.log1p(-ratio)

    shares = [share(per_text(np.isin(data, np.frombuffer(m, np.uint8))), sizes) for m in CLASSES.values()]
    return np.stack([np.log1p(sizes), np.log1p(words), np.log1p(mean), np.log1p(spread), share(per_text(data >= 128), sizes),
                     *shares, share(different, words), share(most, words), share(different_lines, lines)], 1)


def _slice_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    base = 0x9E3779B97F4A7C15
    power = np.cumprod(np.r_[np.uint64(1), np.full(len(data), base, np.uint64)])
    inverse = np.cumprod(np.r_[np.uint64(1), np.full(len(data), pow(base, -1, 1 << 64), np.uint64)])
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])]
    return mix64((sums[end] - sums[begin]) * inverse[begin])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, stats`` (a list of doubles, ``NAMES``) for every row; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(1)):
                stats = statistics(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first),
                     pa.ListArray.from_arrays(np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32), stats.ravel())],
                    ["doc_id", "stats"])

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return in_small_batches(read).mapInArrow(run, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, stats array<double>")


@dataclass
class Discriminant:
    """Two classes, each with a mean, a shrunk covariance's Cholesky factor and its log determinant."""

    log_prior: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """The probability of class 1."""
        logs = []
        for c in (0, 1):
            z = np.linalg.solve(self.factors[c], (stats - self.means[c]).T)  # triangular: the cached factor
            logs.append(self.log_prior[c] - 0.5 * (z ** 2).sum(0) - 0.5 * self.log_dets[c])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(labelled: DataFrame, shrinkage: float = 0.1, pooling: float = 0.05) -> Discriminant | None:
    """From ``stats, label`` (0 or 1) of all labelled rows; None if a class has none.

    Tasks send sums and products, so what is gathered does not grow with the rows. A class covariance moves by
    ``pooling`` towards the pooled one and by ``shrinkage`` towards its own diagonal.
    """
    width = len(NAMES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            stats = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                x = stats[labels == c]
                sums[c] += np.r_[len(x), x.sum(0), (x.T @ x).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(list(sums))], ["label", "sums"])

    parts = labelled.select("stats", F.col("label").cast("int").alias("label")).where("label in (0, 1)").mapInArrow(
        moments, "label int, sums array<double>")
    cells = parts.select("label", F.posexplode("sums").alias("place", "value")).groupBy("label", "place").agg(
        F.sum("value").alias("value")).collect()
    sums = np.zeros((2, 1 + width + width * width))
    for row in cells:
        sums[row["label"], row["place"]] = row["value"]
    counts = sums[:, 0]
    if (counts < 1).any():
        return None
    means = sums[:, 1:1 + width] / counts[:, None]
    covariances = np.stack([sums[c, 1 + width:].reshape(width, width) / counts[c] - np.outer(means[c], means[c])
                            for c in (0, 1)])
    pooled = (covariances * counts[:, None, None]).sum(0) / counts.sum()
    factors, log_dets = [], []
    for c in (0, 1):
        shrunk = (1 - pooling) * covariances[c] + pooling * pooled
        shrunk = (1 - shrinkage) * shrunk + shrinkage * np.diag(np.diag(shrunk)) + 1e-4 * np.eye(width)
        factors.append(np.linalg.cholesky(shrunk))
        log_dets.append(2 * np.log(np.diag(factors[-1])).sum())
    return Discriminant(np.log(counts / counts.sum()), means, np.stack(factors), np.array(log_dets))


def quality(docs: DataFrame, labels: DataFrame, learn: str = "true", id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` for every row; ``score`` is the probability that the label is 1.

    Learns from all labelled rows whose ``doc_id`` meets the SQL condition ``learn``. Labels other than 0 and 1 and null
    ids teach nothing; an id with several labels teaches each of them. Without rows of both classes every score is 0.5. A
    null or empty text is scored by its statistics, which are those of zero counts; equal rows give equal rows. Whole texts
    are read; other columns are not. The model is a few kilobytes, whatever the input.
    """
    stats = write_through(document_statistics(docs, id_col, text_col), "statistics")
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where(learn).where(
        "doc_id is not null and label in (0, 1)")
    model = fit(stats.join(marks, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            score = model.scores(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
