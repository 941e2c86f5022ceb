"""Token counts by rank-synchronous merging of batched pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import forget_others, in_small_batches, kept, text_list
from .wordbpe import NO_RANK, WordBpe, read_file

#: Units whose counts a worker remembers before it starts afresh.
REMEMBERED = 500_000


def surviving_symbols(vocabulary: WordBpe, pretokens: list[str]) -> np.ndarray:
    """How many symbols of each pre-token are left when nothing can be merged.

    All sequences lie in one ragged array. A round finds every sequence's lowest rank and merges all its
    pairs of that rank, from the left; sequences without a pair of any rank leave the array. A merge never
    makes a pair of a lower rank (the loader checks that), so a round does what leftmost-first merging does.
    """
    symbols, offsets = vocabulary.symbol_ids(pretokens)
    counts, owner = np.diff(offsets), np.arange(len(pretokens))
    left = counts.copy()
    while len(symbols):
        starts = np.cumsum(left) - left
        sequence = np.repeat(np.arange(len(left)), left)
        ranks = np.full(len(symbols), NO_RANK)
        inner = np.flatnonzero(sequence[:-1] == sequence[1:])
        found = vocabulary.ranks.find(symbols[inner], symbols[inner + 1])
        ranks[inner] = np.where(found >= 0, found, NO_RANK)
        lowest = np.minimum.reduceat(ranks, starts)
        live = lowest < NO_RANK
        at = np.flatnonzero((ranks == lowest[sequence]) & live[sequence])
        if len(at):
            # pairs of one symbol twice overlap in runs; every second one of a run is merged
            follows = np.r_[False, (np.diff(at) == 1) & (sequence[at[1:]] == sequence[at[:-1]])]
            place = np.arange(len(at))
            begin = np.maximum.accumulate(np.where(follows, 0, place))
            at = at[(place - begin) % 2 == 0]
            symbols[at] = vocabulary.merged[ranks[at]]
        stay = live[sequence]
        stay[at + 1] = False
        counts[owner] -= np.bincount(sequence[at], minlength=len(left))
        symbols, owner = symbols[stay], owner[live]
        left = counts[owner]
    return counts


def unit_counts(vocabulary: WordBpe, units: list[str]) -> list[int]:
    """Tokens of each unit; a special string is one."""
    pretokens, owner = vocabulary.pretokens(units)
    distinct: dict[str, int] = {}
    kinds = np.array([distinct.setdefault(p, len(distinct)) for p in pretokens], np.int64)
    each = surviving_symbols(vocabulary, list(distinct))
    totals = np.bincount(owner, weights=each[kinds], minlength=len(units)).astype(int).tolist()
    return [n if u[0] != "\t" else 1 for n, u in zip(totals, units, strict=True)]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, counted as the tokenizers library encodes the text
    with the vocabulary at ``path``, without added special tokens; special strings inside texts are special tokens.

    A null or empty text has 0 bytes and 0 tokens; a null id stays null; equal rows give equal rows; other columns
    are not read. Texts are counted whole, whatever their length.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = kept(("counts", path), lambda: (read_file(path), {}))
        for batch in batches:
            texts = text_list(batch.column(1))
            n_tokens = []
            for first in range(0, len(texts), 500):
                units = [vocabulary.units(t) for t in texts[first:first + 500]]
                wanted = set().union(*units)
                new = list(wanted - known.keys())
                if len(known) + len(new) > REMEMBERED:
                    forget_others(known, wanted)
                known.update(zip(new, unit_counts(vocabulary, new), strict=True))
                n_tokens += [sum(map(known.__getitem__, u)) for u in units]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n_tokens, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return in_small_batches(read).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
