"""BPE encoding by segment trees over adjacent pair ranks, and decoding."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import forget_others, in_small_batches, kept, rows_to_read, schema_with, text_list
from .wordbpe import WordBpe, read_file

#: Units whose ids a worker remembers before it starts afresh.
REMEMBERED = 400_000
PLACE_BITS = 32
#: No pair here, or none that merges.
NONE = np.int64(1) << 62


def merge_by_trees(vocabulary: WordBpe, symbols: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Merge sequences of at most ``width`` symbols, a power of two; returns the symbols by row, -1 where merged away.

    Each row has a segment tree whose leaf i holds rank and place of the pair that starts at symbol i, and whose inner
    nodes hold the least of their children: the root is the leftmost lowest-rank pair. A merge changes three leaves
    (the pair itself, the one before, and the one that starts at the symbol that went) and their ancestors. Rows
    take their steps together, and leave when the root has no pair.
    """
    rows = len(lengths)
    held = np.full((rows, width), -1, np.int64)
    held[np.arange(width) < lengths[:, None]] = symbols
    following = np.tile(np.arange(1, width + 1), (rows, 1))
    following[np.arange(rows), lengths - 1] = -1
    before = np.tile(np.arange(-1, width - 1), (rows, 1))
    tree = np.full((rows, 2 * width), NONE)

    row, place = np.nonzero(np.arange(1, width + 1) < lengths[:, None])
    found = vocabulary.ranks.find(held[row, place], held[row, np.minimum(place + 1, width - 1)])
    tree[row, width + place] = np.where(found >= 0, found << PLACE_BITS | place, NONE)
    level = width
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2

    def put(row: np.ndarray, place: np.ndarray, value: np.ndarray | np.int64) -> None:
        node = place + width
        tree[row, node] = value
        while len(node) and node[0] > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def put_pair(row: np.ndarray, place: np.ndarray, right: np.ndarray) -> None:
        found = vocabulary.ranks.find(held[row, place], held[row, right])
        put(row, place, np.where(found >= 0, found << PLACE_BITS | place, NONE))

    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        root = tree[live, 1]
        at = root & (1 << PLACE_BITS) - 1
        gone = following[live, at]
        after = following[live, gone]
        held[live, at] = vocabulary.merged[root >> PLACE_BITS]
        held[live, gone] = -1
        following[live, at] = after
        put(live, gone, NONE)
        more = after >= 0
        put(live[~more], at[~more], NONE)
        before[live[more], after[more]] = at[more]
        put_pair(live[more], at[more], after[more])
        ahead = before[live, at]
        more = ahead >= 0
        put_pair(live[more], ahead[more], at[more])
        live = live[tree[live, 1] < NONE]
    return held


def encode_pretokens(vocabulary: WordBpe, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pre-tokens, flat, and the offsets of the pre-tokens; those of similar length merge together."""
    lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
    widths = 1 << np.ceil(np.log2(np.maximum(lengths, 2))).astype(np.int64)
    merged, counts = [], np.zeros(len(pretokens), np.int64)
    for width in np.unique(widths).tolist():
        members = np.flatnonzero(widths == width)
        step = max(1, (1 << 18) // width)  # bounds the trees of one call
        for part in (members[i:i + step] for i in range(0, len(members), step)):
            symbols, _ = vocabulary.symbol_ids([pretokens[i] for i in part])
            held = merge_by_trees(vocabulary, symbols, lengths[part], width)
            counts[part] = (held >= 0).sum(1)
            merged.append((part, held[held >= 0]))
    offsets = np.r_[0, np.cumsum(counts)]
    flat = np.zeros(offsets[-1], np.int64)
    for part, ids in merged:
        begin = np.repeat(np.cumsum(counts[part]) - counts[part], counts[part])
        flat[np.repeat(offsets[part], counts[part]) + np.arange(len(ids)) - begin] = ids
    return flat, offsets


def encode_units(vocabulary: WordBpe, units: list[str]) -> Iterator[tuple[bytes, str]]:
    """For each unit its ids as little-endian unsigned 32-bit integers and its decoded text."""
    pretokens, owner = vocabulary.pretokens(units)
    distinct: dict[str, int] = {}
    kinds = [distinct.setdefault(p, len(distinct)) for p in pretokens]
    flat, offsets = encode_pretokens(vocabulary, list(distinct))
    packed, tokens, offsets = flat.astype("<u4").tobytes(), decode_tokens(vocabulary, flat.tolist()), offsets.tolist()
    each = [(packed[4 * a:4 * b], " ".join(tokens[a:b])) for a, b in zip(offsets, offsets[1:])]
    ends = np.cumsum(np.bincount(owner, minlength=len(units))).tolist()
    for unit, begin, end in zip(units, [0, *ends], ends):
        if unit[0] == "\t":
            yield vocabulary.special[unit[1:]].to_bytes(4, "little"), unit[1:]
        elif end == begin + 1:
            yield each[kinds[begin]]
        else:
            parts = [each[k] for k in kinds[begin:end]]
            yield b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])


def decode_tokens(vocabulary: WordBpe, ids: list[int]) -> list[str]:
    return list(map(vocabulary.tokens.__getitem__, ids))


def decode(vocabulary: WordBpe, ids: list[int]) -> str:
    """The tokens of the ids, joined as the vocabulary's file asks: it names no decoder, so by spaces."""
    return " ".join(decode_tokens(vocabulary, ids))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           keep: str = "ids, decoded") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded, ids_sha256, decoded_sha256`` for every row (``keep`` names which of ids and
    decoded to return besides the digests; '' for neither).

    ``ids`` are those of the tokenizers library for the vocabulary at ``path`` without added special tokens, as
    little-endian unsigned 32-bit integers; ``decoded`` is the library's decode of them, special tokens included.
    A null or empty text has no ids and decodes to the empty string; a null id stays null; equal rows give equal
    rows; other columns are not read. Texts are encoded whole, whatever their length.
    """
    wanted = [x.strip() for x in keep.split(",") if x.strip()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = kept(("bpe", path), lambda: (read_file(path), {}))
        for batch in batches:
            texts = text_list(batch.column(1))
            for first in range(0, len(texts), 500):
                units = [vocabulary.units(t) for t in texts[first:first + 500]]
                different = set().union(*units)
                new = list(different - known.keys())
                if len(known) + len(new) > REMEMBERED:
                    forget_others(known, different)
                known.update(zip(new, encode_units(vocabulary, new), strict=True))
                out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], **{w: [] for w in wanted}}
                for each in units:
                    pairs = [known[u] for u in each]
                    ids, decoded = b"".join([p[0] for p in pairs]), " ".join([p[1] for p in pairs])
                    out["n_tokens"].append(len(ids) // 4)
                    out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                    for name, value in (("ids", ids), ("decoded", decoded)):
                        if name in out:
                            out[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(units)), pa.array(out["n_tokens"], pa.int64()),
                     *(pa.array(v, pa.binary() if k == "ids" else pa.string()) for k, v in out.items() if k != "n_tokens")],
                    ["doc_id", *out])

    read = rows_to_read(docs, id_col, text_col, False)
    fields = "".join(f", {w} {'binary' if w == 'ids' else 'string'}" for w in wanted)
    return in_small_batches(read).mapInArrow(run, schema_with(read, f"n_tokens long, ids_sha256 string, decoded_sha256 string{fields}"))
