"""Language identification by segmentation-marginalised unigrams over a fixed vocabulary of pieces."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import carried, in_small_batches, kept, rows_to_read, schema_with, text_list
from .wordbpe import PairTable

LETTERS = re.compile(r"[^\W\d_]+")
WORD_START = "▁"
#: Products of weights are kept above 10 to this power; words that may fall below it are summed as logarithms.
LEAST_POWER = -280
#: Characters of words laid out at once when they are summed as logarithms; a longer word is alone, in windows of so many.
WINDOW = 1 << 12
#: Words whose scores a worker remembers before it starts afresh.
REMEMBERED = 200_000
#: Words a worker gathers before it counts their pieces.
MOST_HELD = 2_000_000
TEXTS = 500
#: Words whose ways of cutting are laid out at once.
STEP = 20_000
UNKNOWN = "und"


@dataclass
class Pieces:
    """The vocabulary as a trie: state and character to state, and the piece that ends in a state."""

    trie: PairTable
    piece_of: np.ndarray
    number: int  # pieces, piece 0 stands for any single character that has none
    longest: int  # characters of the longest piece


@lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    """The ordinary pieces of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = sorted({model.id_to_piece(i) for i in ids})
    states: dict[tuple[int, int], int] = {}
    piece_of = [-1]
    for number, piece in enumerate(pieces, 1):
        state = 0
        for char in map(ord, piece):
            if (state, char) not in states:
                states[state, char] = len(piece_of)
                piece_of.append(-1)
            state = states[state, char]
        piece_of[state] = number
    keys = np.array(list(states), np.int64)
    return Pieces(PairTable(keys[:, 0], keys[:, 1], np.array(list(states.values()))), np.array(piece_of), len(pieces) + 1,
                  max(map(len, pieces), default=1))


def words_of(text: str) -> list[str]:
    """The lower-cased runs of letters of a text."""
    return LETTERS.findall(text.lower())


def with_letters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a letter."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([LETTERS.search(t) is not None for t in text_list(batch.column(place))], pa.bool_()))

    return in_small_batches(docs).mapInArrow(run, docs.schema)


@dataclass
class Lattice:
    """All ways to cut words into pieces. Nodes are the places between characters, arcs the pieces, by their end."""

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    steps: list[tuple[int, int]]  # arcs whose end is the 1st, 2nd, … place of its word
    first: np.ndarray
    last: np.ndarray
    nodes: int


def lattice(pieces: Pieces, words: list[str]) -> Lattice:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    node = np.arange(len(codes)) + word  # each word has a node more than characters
    starts, ends, found, offs = [], [], [], []
    live, state = np.arange(len(codes)), np.zeros(len(codes), np.int64)
    size = 0
    while len(live):
        state = pieces.trie.find(state, codes[live + size])
        piece = np.where(state >= 0, pieces.piece_of[state], -1)
        size += 1
        if size == 1:
            piece = np.maximum(piece, 0)  # every single character has an arc
        arc = piece >= 0
        starts.append(node[live[arc]])
        ends.append(node[live[arc]] + size)
        offs.append(place[live[arc]] + size)
        found.append(piece[arc])
        more = (state >= 0) & (place[live] + size < lengths[word[live]])
        live, state = live[more], state[more]
    start, end, piece, off = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends, found, offs))
    order = np.lexsort((end, off))
    start, end, piece, off = start[order], end[order], piece[order], off[order]
    bounds = np.searchsorted(off, np.arange(1, (off[-1] if len(off) else 0) + 2)).tolist()
    first = np.cumsum(lengths + 1) - lengths - 1
    return Lattice(start, end, piece, list(zip(bounds, bounds[1:])), first, first + lengths, len(codes) + len(words))


def forward(arcs: Lattice, weights: np.ndarray) -> np.ndarray:
    """For each node and language the sum over all ways from the word's start; ``weights`` by piece and language."""
    sums = np.zeros((arcs.nodes, weights.shape[1]))
    sums[arcs.first] = 1
    for begin, stop in arcs.steps:
        if begin < stop:
            ends = arcs.end[begin:stop]
            heads = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
            sums[ends[heads]] = np.add.reduceat(sums[arcs.start[begin:stop]] * weights[arcs.piece[begin:stop]], heads)
    return sums


def backward(arcs: Lattice, weights: np.ndarray) -> np.ndarray:
    """For each node and language the sum over all ways to the word's end."""
    sums = np.zeros((arcs.nodes, weights.shape[1]))
    sums[arcs.last] = 1
    for begin, stop in reversed(arcs.steps):
        if begin < stop:
            part = np.argsort(arcs.start[begin:stop], kind="stable") + begin
            starts = arcs.start[part]
            heads = np.flatnonzero(np.r_[True, starts[1:] != starts[:-1]])
            sums[starts[heads]] += np.add.reduceat(sums[arcs.end[part]] * weights[arcs.piece[part]], heads)
    return sums


def log_forward(arcs: Lattice, logs: np.ndarray, weights: np.ndarray, done: int = 0) -> np.ndarray:
    """``forward`` in natural logarithms, in ``logs``, whose nodes up to place ``done`` are set; ``weights`` are logarithms too."""
    for begin, stop in arcs.steps[done:]:
        if begin < stop:
            ends = arcs.end[begin:stop]
            heads = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
            logs[ends[heads]] = log_sums(logs[arcs.start[begin:stop]] + weights[arcs.piece[begin:stop]], heads)
    return logs


def log_backward(arcs: Lattice, logs: np.ndarray, weights: np.ndarray, done: int | None = None) -> np.ndarray:
    """``backward`` in natural logarithms, in ``logs``; from place ``done`` on its nodes are set, if that is given.

    Arcs go by their start here, from the last place to the first, so a node is set once.
    """
    place = arcs.start - np.repeat(arcs.first, arcs.last - arcs.first + 1)[arcs.start]
    order = np.lexsort((arcs.start, -place))
    place = place[order]
    bounds = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True]) if len(place) else []
    for begin, stop in zip(bounds[:-1], bounds[1:], strict=True):
        if done is None or place[begin] < done:
            part = order[begin:stop]
            starts = arcs.start[part]
            heads = np.flatnonzero(np.r_[True, starts[1:] != starts[:-1]])
            logs[starts[heads]] = log_sums(logs[arcs.end[part]] + weights[arcs.piece[part]], heads)
    return logs


def log_sums(terms: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Logarithms of sums of runs of rows that start at ``heads``; ``terms`` are finite logarithms."""
    most = np.maximum.reduceat(terms, heads)
    runs = np.diff(np.r_[heads, len(terms)])
    return most + np.log(np.add.reduceat(np.exp(terms - np.repeat(most, runs, axis=0)), heads))


def parted(words: list[str], weights: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """The numbers of the words whose sums stay in range, and those of the others in groups of up to ``WINDOW`` characters."""
    safe = LEAST_POWER / min(math.log10(weights.min()), -1e-9)
    short = [i for i, w in enumerate(words) if len(w) <= safe]
    groups: list[list[int]] = []
    held = WINDOW
    for i in sorted((i for i, w in enumerate(words) if len(w) > safe), key=lambda i: len(words[i])):
        if held + len(words[i]) > WINDOW:
            groups.append([])
            held = 0
        groups[-1].append(i)
        held += len(words[i])
    return short, groups


def windows_forward(pieces: Pieces, word: str, weights: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Windows of a word: the places they start and end at, and the logarithms of the forward sums of all places from
    the longest piece before the start to the end. Later windows start from earlier ones' last sums."""
    before = np.zeros((1, weights.shape[1]))
    for begin in range(0, len(word), WINDOW):
        low, end = max(0, begin - pieces.longest), min(begin + WINDOW, len(word))
        logs = np.zeros((end - low + 1, weights.shape[1]))
        logs[:begin - low + 1] = before[-(begin - low + 1):]
        log_forward(lattice(pieces, [word[low:end]]), logs, weights, begin - low)
        yield begin, end, logs
        before = logs[-(pieces.longest + 1):].copy()


def word_scores(pieces: Pieces, words: list[str], weights: np.ndarray) -> np.ndarray:
    """log10 probability of each word by language, all segmentations summed, whatever its length."""
    words = [WORD_START + w for w in words]
    scores = np.zeros((len(words), weights.shape[1]))
    short, groups = parted(words, weights)
    arcs = lattice(pieces, [words[i] for i in short])
    scores[short] = np.log10(forward(arcs, weights)[arcs.last])
    logs = np.log(weights) if groups else weights
    for group in groups:
        if len(words[group[0]]) > WINDOW:
            for _, _, sums in windows_forward(pieces, words[group[0]], logs):
                scores[group] = sums[-1] / math.log(10)
        else:
            arcs = lattice(pieces, [words[i] for i in group])
            scores[group] = log_forward(arcs, np.zeros((arcs.nodes, weights.shape[1])), logs)[arcs.last] / math.log(10)
    return scores


def used_pieces(arcs: Lattice, share: np.ndarray, number: int) -> np.ndarray:
    """By piece and language the sum of the arcs' shares."""
    return np.stack([np.bincount(arcs.piece, share[:, i], number) for i in range(share.shape[1])], 1)


def expected_pieces(pieces: Pieces, words: list[str], counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """By piece and language, how often each piece is used in words that occur ``counts`` (word, language) times."""
    words = [WORD_START + w for w in words]
    if (weights == weights[:, :1]).all():  # one sum serves all languages
        weights = weights[:, :1]
    short, groups = parted(words, weights)
    arcs = lattice(pieces, [words[i] for i in short])
    before, behind = forward(arcs, weights), backward(arcs, weights)
    word = np.repeat(np.arange(len(short)), arcs.last - arcs.first + 1)[arcs.start]
    share = before[arcs.start] * weights[arcs.piece] * behind[arcs.end] / before[arcs.last][word]
    total = used_pieces(arcs, share * counts[short][word], pieces.number)
    logs = np.log(weights) if groups else weights
    for group in groups:
        if len(words[group[0]]) > WINDOW:
            total += long_word_pieces(pieces, words[group[0]], logs) * counts[group[0]]
            continue
        arcs = lattice(pieces, [words[i] for i in group])
        before, behind = (way(arcs, np.zeros((arcs.nodes, logs.shape[1])), logs) for way in (log_forward, log_backward))
        word = np.repeat(np.arange(len(group)), arcs.last - arcs.first + 1)[arcs.start]
        share = np.exp(before[arcs.start] + logs[arcs.piece] + behind[arcs.end] - before[arcs.last][word])
        total += used_pieces(arcs, share * counts[group][word], pieces.number)
    return total


def long_word_pieces(pieces: Pieces, word: str, weights: np.ndarray) -> np.ndarray:
    """How often each piece is used in one occurrence of a long word; ``weights`` are logarithms.

    A first pass keeps the forward sums at the start of each window only; a second one goes over the windows from the last to
    the first, finds the forward sums of a window anew and carries the backward sums. Memory holds one window.
    """
    starts, sums = [], np.zeros((1, weights.shape[1]))
    for begin, _, logs in windows_forward(pieces, word, weights):
        starts.append(sums)
        sums = logs[-(pieces.longest + 1):].copy()
    total, whole = np.zeros((pieces.number, weights.shape[1])), sums[-1]
    after = np.zeros((1, weights.shape[1]))  # of the places from a window's end on
    for number in reversed(range(len(starts))):
        begin = number * WINDOW
        end = min(begin + WINDOW, len(word))
        low, high = max(0, begin - pieces.longest), min(end + pieces.longest, len(word))
        before = np.zeros((end - low + 1, weights.shape[1]))
        before[:begin - low + 1] = starts[number][-(begin - low + 1):]
        before = log_forward(lattice(pieces, [word[low:end]]), before, weights, begin - low)[begin - low:]
        arcs = lattice(pieces, [word[begin:high]])
        behind = np.zeros((high - begin + 1, weights.shape[1]))
        behind[end - begin:] = after[:high - end + 1]
        log_backward(arcs, behind, weights, end - begin)
        inside = arcs.start < end - begin
        used = Lattice(arcs.start[inside], arcs.end[inside], arcs.piece[inside], [], arcs.first, arcs.last, arcs.nodes)
        share = np.exp(before[used.start] + weights[used.piece] + behind[used.end] - whole)
        total += used_pieces(used, share, pieces.number)
        after = behind[:pieces.longest + 1].copy()
    return total


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # by piece and language
    path: str


def train(docs: DataFrame, path: str, text_col: str = "text", lang_col: str = "lang", rounds: int = 1,
          smoothing: float = 0.01, most_languages: int = 1000) -> LanguageModel:
    """Piece probabilities by language from all rows with a text and a language.

    A round counts the pieces expected under the last round's probabilities (the first: the same for
    every piece), adds ``smoothing`` to each count, and divides by the sum. Tasks send a
    count for each piece and language, so what is gathered is bounded by the vocabulary times the number of languages,
    of which there may be ``most_languages``. Rows without text or language teach nothing; without any, the model has no
    language and finds every text unknown.
    """
    if smoothing <= 0:
        raise ValueError("smoothing must be above 0")
    read = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    languages = sorted(r[0] for r in read.select("lang").distinct().limit(most_languages + 1).collect())
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    pieces = load_pieces(path)
    weights = np.full((pieces.number, max(1, len(languages))), 1.0 / pieces.number)
    number = {x: i for i, x in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        def count(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            known, total = load_pieces(path), np.zeros_like(weights)
            words: dict[str, int] = {}
            seen, held = [np.zeros(0, np.int64)], 0

            def flush() -> None:
                cells = np.concatenate(seen)
                width = len(languages)
                table = np.bincount(cells, minlength=len(words) * width).reshape(-1, width).astype(float)
                spelled = list(words)
                for i in range(0, len(spelled), STEP):
                    total[:] += expected_pieces(known, spelled[i:i + STEP], table[i:i + STEP], weights)
                words.clear()
                seen[:] = [np.zeros(0, np.int64)]

            for batch in batches:
                for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = [words.setdefault(w, len(words)) for w in words_of(text)]
                    seen.append(np.array(ids, np.int64) * len(languages) + number[lang])
                    held += len(ids)
                    if len(words) > REMEMBERED or held > MOST_HELD:
                        flush()
                        held = 0
            flush()
            for i in range(total.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total[:, i].astype("<f8").tobytes()])],
                                                 ["lang", "counts"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for lang, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    sums[lang] = sums.get(lang, 0) + np.frombuffer(counts, "<f8")
            for lang, counts in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.int32()), pa.array([counts.tobytes()])],
                                                 ["lang", "counts"])

        schema = "lang int, counts binary"
        partial = in_small_batches(read).mapInArrow(count, schema)
        # partial sums meet by language in a few tasks first, so no task and no gathering grows with the input
        merged = partial.repartition(16).mapInArrow(add, schema).collect()
        total = np.zeros_like(weights)
        for row in merged:
            total[:, row["lang"]] += np.frombuffer(row["counts"], "<f8")
        total += smoothing
        weights = total / total.sum(0)
    return LanguageModel(languages, weights, path)


class Scores:
    """The scores of words that a worker has met under one model."""

    def __init__(self, weights: np.ndarray, pieces: Pieces):
        self.weights, self.pieces = weights, pieces
        self.known: dict[str, int] = {}
        self.table = np.zeros((1 << 16, weights.shape[1]))

    def of(self, words: set[str]) -> tuple[dict[str, int], np.ndarray]:
        """The place of each word, and the scores by place."""
        new = list(words - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(words)
        begin = len(self.known)
        self.known.update(zip(new, range(begin, begin + len(new)), strict=True))
        while len(self.table) < len(self.known):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for i in range(0, len(new), STEP):
            part = new[i:i + STEP]
            self.table[begin + i:begin + i + len(part)] = word_scores(self.pieces, part, self.weights)
        return self.known, self.table


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
             carry: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, and its columns as ``row`` if ``carry``.

    The text's log probability under a language is the sum over its words (lower-cased runs of letters) of the forward
    sum over all segmentations; ``score`` is the best language's share of the probability, languages being equally likely
    beforehand. Null or empty texts and those without a letter are ``und`` with score 0; of equally likely languages the first by
    name is taken; equal rows give equal rows; other columns are not read. Whole texts are read, of any length.
    """
    languages, path = model.languages, model.path
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)  # bounded: pieces times languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, pieces = shared.value, load_pieces(path)
        scores = kept(("languages", id(weights)), lambda: Scores(weights, pieces))
        for batch in batches:
            texts = text_list(batch.column(1))
            for first in range(0, len(texts), TEXTS):
                words = [words_of(t) for t in texts[first:first + TEXTS]]
                known, table = scores.of(set().union(*words))
                lang, score = [], []
                for each in words:
                    if not each or not languages:
                        lang.append(UNKNOWN)
                        score.append(0.0)
                        continue
                    sums = table[np.fromiter(map(known.__getitem__, each), np.int64, len(each))].sum(0)
                    best = int(sums.argmax())
                    lang.append(languages[best])
                    score.append(float(1 / (10.0 ** np.maximum(sums - sums[best], -300)).sum()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(words)), pa.array(lang, pa.string()),
                                                  pa.array(score, pa.float64()), *carried(batch, first, len(words))], names)

    read = rows_to_read(docs, id_col, text_col, carry)
    schema = schema_with(read, "lang_pred string, score double")
    names = schema.names
    return in_small_batches(read).mapInArrow(run, schema)

