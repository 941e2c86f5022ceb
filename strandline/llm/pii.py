"""Personal data by patterns, and by a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import carried, in_small_batches, let_go, rows_to_read, schema_with, text_list

KINDS = ["email", "ip", "card", "phone"]
#: Outside, then begin and inside of each kind.
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: From the first digit of a run; possessive, as nothing that is given back could match.
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
#: Characters of the texts that are decoded at once.
CHARS = 4_000_000


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of what the patterns find, leftmost and non-overlapping per kind, by start, then kind."""
    spans = []
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            free = domain.end()
            spans.append((begin, 0, free))
        at = text.find("@", max(at + 1, free))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


RUNS = re.compile(r"[0-9]+|[^\W\d_]+|(.)\1*", re.S)
TRAIL = ".,;:!?"


def shape(token: str) -> str:
    """The word's shape: runs of letters as x or X, runs of digits as their number, other characters once each.

    At most the first 16 runs are told apart; a token of more has the mark of a long one besides. A token whose digits are
    as many as a card's and pass its check has a mark of that.
    """
    core = token.rstrip(TRAIL)
    if core.isalpha():
        return ("X" if core[0].isupper() else "x") + token[len(core):len(core) + 1]
    parts = []
    for m in RUNS.finditer(token):
        if len(parts) == 16:
            parts.append("…")
            break
        run = m.group()
        if run[0] in "0123456789":
            parts.append(str(min(len(run), 20)) + "d")
        elif run.isalpha():
            parts.append("X" if run[0].isupper() else "x")
        else:
            parts.append(run[0])
    digits = "".join(c for c in token if c in "0123456789")
    return "".join(parts) + "✓" * (14 <= len(digits) <= 19 and luhn(digits))


OWN, BEFORE, BEHIND = 0, 1, 2


def features(kind: str) -> list[tuple[int, str]]:
    """What a shape tells of its own label, and of the labels of the words that it stands before and behind."""
    digits = sum(int(d) for d in re.findall(r"(\d+)d", kind))
    told = [f"shape={kind}", f"coarse={re.sub('[0-9]+d', 'd', kind)}", f"digits={min(digits, 20)}", f"head={kind[0]}",
            f"tail={kind[-1]}", f"at={'@' in kind}", f"dots={min(kind.count('.'), 4)}", f"letters={'x' in kind or 'X' in kind}"]
    return [(side, name) for side in (OWN, BEFORE, BEHIND) for name in told]


@dataclass
class Crf:
    """Weights of features by label, and of label after label."""

    names: dict[tuple[int, str], int]
    weights: np.ndarray
    transitions: np.ndarray

    def potentials(self, kind: str) -> np.ndarray:
        """By side and label; features that training did not meet weigh nothing."""
        row = np.zeros((3, len(LABELS)))
        for side, name in features(kind):
            if (side, name) in self.names:
                row[side] += self.weights[self.names[side, name]]
        return row


class Decoder:
    """Viterbi decoding in batches; remembers the shapes of words and the potentials of shapes."""

    def __init__(self, crf: Crf):
        self.crf = crf
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.shapes: dict[str, int] = {}
        self.rows = np.zeros((0, 3, len(LABELS)), np.float32)

    def kinds(self, words: list[str]) -> np.ndarray:
        """The number of each word's shape."""
        new = set(words) - self.words.keys()
        if len(self.words) + len(new) > 200_000 or len(self.shapes) > 100_000:
            self.forget()
            new = set(words)
        rows = []
        for word in new:
            kind = shape(word)
            if kind not in self.shapes:
                self.shapes[kind] = len(self.shapes)
                rows.append(self.crf.potentials(kind))
            self.words[word] = self.shapes[kind]
        if rows:
            self.rows = np.concatenate([self.rows, np.stack(rows).astype(np.float32)])
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))

    def decode(self, words: list[str], lengths: np.ndarray) -> np.ndarray:
        """The best label of each word; ``words`` holds sequences of ``lengths`` (over 0) one after another."""
        kinds, n = self.kinds(words), len(LABELS)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        scores = self.rows[kinds, OWN]
        inner = np.ones(len(kinds), bool)
        inner[starts] = False
        inner = np.flatnonzero(inner)
        scores[inner] += self.rows[kinds[inner - 1], BEFORE]
        scores[inner - 1] += self.rows[kinds[inner], BEHIND]
        order = np.argsort(-lengths, kind="stable")
        live = np.searchsorted(-lengths[order], -np.arange(1, lengths.max(initial=0) + 1), side="right")
        back = np.zeros((len(kinds), n), np.uint8)
        transitions = self.crf.transitions.astype(np.float32).T[None]  # to, from
        best = scores[starts[order]]
        final = np.zeros((len(lengths), n), np.float32)
        for step in range(1, len(live)):
            now = live[step]
            final[now:len(best)] = best[now:]
            ways = best[:now, None, :] + transitions
            from_ = ways.argmax(2)
            at = starts[order[:now]] + step
            back[at] = from_
            best = np.take_along_axis(ways, from_[:, :, None], 2)[:, :, 0] + scores[at]
        final[:len(best)] = best
        labels = np.zeros(len(kinds), np.uint8)
        label = final.argmax(1)
        for step in range(len(live) - 1, -1, -1):
            now = live[step]
            ending = lengths[order[:now]] == step + 1
            at = starts[order[:now]] + step
            if step + 1 < len(live):
                more = np.flatnonzero(~ending)
                label[more] = back[at[more] + 1, label[more]]
            labels[at] = label[:now]
        return labels


def train(windows: list[tuple[list[str], list[int]]], rounds: int = 80, rate: float = 0.1, decay: float = 1e-4) -> Crf:
    """Maximum likelihood by gradient steps, from words and labels; without windows every word is outside."""
    kinds: dict[str, int] = {}
    names: dict[tuple[int, str], int] = {}
    n = len(LABELS)
    if not windows:
        return Crf(names, np.zeros((0, n)), np.zeros((n, n)))
    most = max(len(w) for w, _ in windows)
    kind = np.full((len(windows), most), -1, np.int64)
    gold = np.zeros((len(windows), most), np.int64)
    for i, (words, labels) in enumerate(windows):
        kind[i, :len(words)] = [kinds.setdefault(shape(w), len(kinds)) for w in words]
        gold[i, :len(words)] = labels
    used = [[names.setdefault(f, len(names)) for f in features(k)] for k in kinds]
    sides = np.array([side for side, _ in names])
    has = np.zeros((len(kinds), len(names)))
    for k, f in enumerate(used):
        has[k, f] = 1
    has = np.stack([has * (sides == side) for side in (OWN, BEFORE, BEHIND)])
    real = kind >= 0
    row, place = np.nonzero(real)
    flat = kind[row, place]
    weights, transitions = np.zeros((len(names), n)), np.zeros((n, n))
    state = [np.zeros_like(x) for x in (weights, weights, transitions, transitions)]
    target = np.zeros((len(windows), most, n))
    target[row, place, gold[row, place]] = 1
    both = real[:, 1:]
    pairs = np.zeros((n, n))
    np.add.at(pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    for step in range(1, rounds + 1):
        rows = has @ weights  # side, kind, label
        scores = np.zeros((len(windows), most, n))
        scores[row, place] = rows[OWN][flat]
        before, behind = np.nonzero(both)
        scores[before, behind + 1] += rows[BEFORE][kind[before, behind]]
        scores[before, behind] += rows[BEHIND][kind[before, behind + 1]]
        ahead, back = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, most):
            came = _logsum(ahead[:, t - 1, :, None] + transitions, 1) + scores[:, t]
            ahead[:, t] = np.where(real[:, t, None], came, ahead[:, t - 1])
        for t in range(most - 2, -1, -1):
            goes = _logsum((scores[:, t + 1] + back[:, t + 1])[:, None, :] + transitions, 2)
            back[:, t] = np.where(real[:, t + 1, None], goes, 0)
        whole = _logsum(ahead[:, -1], 1)
        share = np.exp(ahead + back - whole[:, None, None]) * real[:, :, None]
        joint = np.zeros((n, n))
        for t in range(1, most):
            way = ahead[:, t - 1, :, None] + transitions + (scores[:, t] + back[:, t])[:, None, :] - whole[:, None, None]
            joint += np.exp(way)[real[:, t]].sum(0)
        wrong = target - share
        by_kind = np.zeros((3, len(kinds), n))
        np.add.at(by_kind[OWN], flat, wrong[row, place])
        np.add.at(by_kind[BEFORE], kind[before, behind], wrong[before, behind + 1])
        np.add.at(by_kind[BEHIND], kind[before, behind + 1], wrong[before, behind])
        gradients = [np.einsum("skf,skl->fl", has, by_kind) / len(windows) - decay * weights,
                     (pairs - joint) / len(windows) - decay * transitions]
        for x, g, m, v in ((weights, gradients[0], *state[:2]), (transitions, gradients[1], *state[2:])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Crf(names, weights, transitions)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


WORD = re.compile(r"\S+")


def labelled_windows(text: str, beside: int = 8) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """Lines cut to the words beside each pattern's match, and one window of words with digits but no match.

    Spans are relative to the window.
    """
    begin, spared = 0, False
    spans = base_spans(text)
    for line in text.split("\n"):
        end = begin + len(line)
        words = [(m.start() + begin, m.end() + begin) for m in WORD.finditer(line)] if DIGIT.search(line) or "@" in line else []
        inside = [s for s in spans if begin <= s[0] and s[2] <= end]
        centres = [next(i for i, w in enumerate(words) if w[1] > s[0]) for s in inside if words]
        if not centres and words and not spared:
            centres, spared = [next(i for i, w in enumerate(words) if DIGIT.search(text, *w) or "@" in text[w[0]:w[1]])], True
        for centre in centres:
            a, b = words[max(0, centre - beside)][0], words[min(len(words), centre + beside) - 1][1]
            yield text[a:b], [(s - a, k, e - a) for s, k, e in inside if a <= s and e <= b]
        begin = end + 1


def variants(window: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """The window, and the window with its first span written as the patterns do not take it."""
    yield window, spans
    if not spans:
        return
    start, kind, end = spans[0]
    value = window[start:end]
    digits = re.sub("[^0-9]", "", value)
    other = {
        "email": [value.replace("@", "(at)"), value.replace("@", "[at]").replace(".", "[dot]")],
        "ip": [],
        "card": [".".join(digits[i:i + 4] for i in range(0, len(digits), 4)), "/".join(digits[i:i + 4] for i in range(0, len(digits), 4))],
        "phone": [value.lstrip("+"), f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}",
                  f"{digits[-10:-7]}.{digits[-7:-4]}.{digits[-4:]}"],
    }[KINDS[kind]]
    for new in other:
        moved = len(new) - (end - start)
        yield (window[:start] + new + window[end:],
               [(start, kind, start + len(new)), *((s + moved, k, e + moved) for s, k, e in spans[1:] if s >= end)])


def labels_of(window: str, spans: list[tuple[int, int, int]]) -> tuple[list[str], list[int]]:
    """The words of a window and the label of each; of overlapping spans the first counts."""
    words, labels, last = [], [], -1
    for m in WORD.finditer(window):
        over = next((i for i, (s, _, e) in enumerate(spans) if s < m.end() and m.start() < e), None)
        words.append(m.group())
        labels.append(0 if over is None else 1 + 2 * spans[over][1] + (over == last))
        last = over if over is not None else -1
    return words, labels


def labelled_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_docs: int = 20_000,
                   most_windows: int = 2_000) -> DataFrame:
    """The small labelled table: ``window, starts, kinds, ends`` from about ``most_docs`` documents drawn by a hash.

    Its size is bounded by ``most_windows`` however large ``docs`` is; it is labelled by the patterns.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    share = min(1.0, most_docs / max(1, read.count()))
    drawn = read.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30))).where("text rlike '[@0-9]'")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w for t in text_list(batch.column(0)) for w in labelled_windows(t) if len(w[0]) < 2000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.string()),
                 *(pa.array([[s[i] for s in spans] for _, spans in found], pa.list_(pa.int32())) for i in (0, 1, 2))],
                ["window", "starts", "kinds", "ends"])

    table = in_small_batches(drawn.select("text")).mapInArrow(cut, "window string, starts array<int>, kinds array<int>, ends array<int>")
    return table.orderBy(F.xxhash64("window"), "window").limit(most_windows)


def fit(table: DataFrame) -> Crf:
    """Train on the labelled table and the variants of its windows."""
    windows = []
    for row in table.collect():  # bounded by labelled_table
        spans = list(zip(row["starts"], row["kinds"], row["ends"], strict=True))
        windows += [labels_of(*v) for v in variants(row["window"], spans)]
    return train([w for w in windows if w[0]])


def added_spans(text: str, labels: list[tuple[int, np.ndarray]], lines: list[str],
                base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the labels (line and its words' labels) that meet no span of the patterns, punctuation cut off."""
    begins = np.cumsum([0, *(len(x) + 1 for x in lines)])
    added = []
    for line, marks in labels:
        words = list(WORD.finditer(lines[line]))
        i = 0
        while i < len(marks):
            if not marks[i]:
                i += 1
                continue
            kind, j = (int(marks[i]) - 1) // 2, i + 1
            while j < len(marks) and marks[j] == 2 + 2 * kind:
                j += 1
            start, end = int(begins[line]) + words[i].start(), int(begins[line]) + words[j - 1].end()
            value = text[start:end]
            end -= len(value) - len(value.rstrip(".,;:!?\"'|)]"))
            start += len(value) - len(value.lstrip(".,;:!?\"'|["))
            if start < end and not any(s < end and start < e for s, _, e in base):
                added.append((start, kind, end))
            i = j
    return added


def find(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text", carry: bool = False,
         batch_docs: int = 1000) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans`` for every row, and if ``carry`` also ``masked``, the text with its spans masked,
    and its columns as ``row``.

    The counts and ``base`` (``kind:start:end`` in code points, by start, then kind) are the patterns'; ``spans`` has these and
    what the field adds where no pattern matched. A sequence is a line of a text; every line of every text is decoded.
    Null and empty texts have no spans; a null id stays null; equal rows give equal rows; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        decoder = Decoder(crf)
        for batch in batches:
            texts = text_list(batch.column(1))
            for first, end in _parts(texts, batch_docs):
                part = texts[first:end]
                base = [base_spans(t) if "@" in t or DIGIT.search(t) else [] for t in part]
                words: list[str] = []
                where, lengths = [], []
                for i, text in enumerate(part):
                    for j, line in enumerate(text.split("\n")):
                        if found := line.split():
                            where.append((i, j))
                            lengths.append(len(found))
                            words += found
                spans = [list(b) for b in base]
                if words:
                    labels = decoder.decode(words, np.array(lengths))
                    starts = np.cumsum([0, *lengths])
                    marked: dict[int, list] = {}
                    for s in np.unique(np.searchsorted(starts, np.flatnonzero(labels), side="right") - 1).tolist():
                        marked.setdefault(where[s][0], []).append((where[s][1], labels[starts[s]:starts[s + 1]]))
                    for i, lines in marked.items():
                        spans[i] = sorted(base[i] + added_spans(part[i], lines, part[i].split("\n"), base[i]))
                counts = [[sum(s[1] == k for s in b) for b in base] for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array(map(_written, base), pa.string()), pa.array(map(_written, spans), pa.string()),
                     *([pa.array([mask(t, _written(s)) for t, s in zip(part, spans, strict=True)], pa.string())] if carry else []),
                     *carried(batch, first, len(part))], names)

    read = rows_to_read(docs, id_col, text_col, carry)
    schema = schema_with(read, "".join(f"n_{k} long, " for k in KINDS) + "base string, spans string"
                         + (", masked string" if carry else ""))
    names = schema.names
    return in_small_batches(read).mapInArrow(run, schema)


def _parts(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Runs of at most ``most`` texts and ``CHARS`` characters, or of one longer text: first text, end."""
    first = held = 0
    for i, text in enumerate(texts):
        if i > first and (i - first == most or held + len(text) > CHARS):
            yield first, i
            first, held = i, 0
        held += len(text)
    if texts:
        yield first, len(texts)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def mask(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the union, named by the first."""
    if not spans:
        return text
    out, done = [], 0
    for kind, start, end in (s.split(":") for s in spans.split(",") if s):
        if int(start) >= done:
            out += [text[done:int(start)], f"[{kind}]"]
        done = max(done, int(end))
    return "".join([*out, text[done:]])
