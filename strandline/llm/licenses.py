"""Licence scans: identifier tags and notice phrases by one automaton, licence expressions by a shunting-yard parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import Spans
from .text import carried, in_small_batches, rows_to_read, schema_with, utf8_slices

# The phrases of the base and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# More phrases of licence notices, words in lower case, and their labels.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "proprietary",
}
# Words of a tag that an expression follows. A tag of one common word needs a known licence behind it.
TAGS = ("spdx license identifier", "license expression", "license")
# Beginnings of licence identifiers in lower case, their label, and what they ask for: 0 next to nothing,
# 1 notices, 2 changes of their own files, 3 of the whole work, 4 also of what is served, 5 no reuse.
IDENTIFIERS = {
    "0bsd": ("bsd", 0),
    "agpl": ("agpl", 4),
    "apache": ("apache", 1),
    "bsd": ("bsd", 1),
    "bsl-1.0": ("bsl", 1),
    "cc-by-nc": ("cc-by-nc", 5),
    "cc-by-nd": ("cc-by-nd", 5),
    "cc-by-sa": ("cc-by-sa", 3),
    "cc-by": ("cc-by", 1),
    "cc0": ("cc0", 0),
    "epl": ("epl", 2),
    "eupl": ("eupl", 3),
    "gpl": ("gpl", 3),
    "isc": ("isc", 1),
    "lgpl": ("lgpl", 2),
    "mit": ("mit", 1),
    "mpl": ("mpl", 2),
    "proprietary": ("proprietary", 5),
    "unlicense": ("unlicense", 0),
    "zlib": ("zlib", 1),
}
OTHER = ("other", 5)
#: How sure a place makes of a licence: a phrase, an expression that can be evaluated, one that cannot.
SURE = {"phrase": 0.7, "expression": 0.95, "broken": 0.3}

_BIND = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_ASSIGN = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?")
_REACH = 200  # bytes of a line that are read behind a tag first; more where the expression goes on


def label_of(identifier: str) -> tuple[str, int]:
    """Label and demands of a licence identifier; ``OTHER`` if it is not known."""
    name = identifier.lower()
    fits = [p for p in IDENTIFIERS if name.startswith(p) and name[len(p):len(p) + 1] in ("", "-", "+", ".")]
    return IDENTIFIERS[max(fits, key=len)] if fits else OTHER


@dataclass(frozen=True)
class Terms:
    """What an expression comes to: the licences to keep, their labels, what they ask for at most, and its text."""

    labels: frozenset[str]
    demands: int
    text: str
    bind: int = 4


def _one(token: str) -> Terms:
    label, demands = label_of(token)
    return Terms(frozenset([label]), demands, token)


def _inside(terms: Terms, bind: int) -> str:
    return terms.text if terms.bind >= bind else f"({terms.text})"


def _joined(word: str, a: Terms, b: Terms | str) -> Terms:
    """``and`` keeps both, ``or`` whichever asks for less (the first if equal), ``with`` eases a share-alike licence."""
    bind = _BIND[word]
    if word == "with":
        return Terms(a.labels, a.demands - (2 <= a.demands <= 4), f"{a.text} WITH {b}", bind)
    text = f"{_inside(a, bind)} {word.upper()} {_inside(b, bind)}"
    if word == "and":
        return Terms(a.labels | b.labels, max(a.demands, b.demands), text, bind)
    less = a if a.demands <= b.demands else b
    return Terms(less.labels, less.demands, text, bind)


def tokens_of(text: str) -> tuple[list[str], int]:
    """The tokens an expression at the start of ``text`` can have, and where they end: where an identifier or an opening
    bracket cannot follow, behind an identifier with punctuation, or at any other character."""
    out, at, open_brackets, wants = [], 0, 0, True
    while found := _TOKEN.match(text, at):
        token = found[1] or found[2].rstrip(".:-")
        word = token.lower()
        if wants:
            if token == ")" or word in _BIND:
                break
            wants = token == "("
        elif word in _BIND:
            wants = True
        elif token != ")" or not open_brackets:
            break
        open_brackets += (token == "(") - (token == ")")
        out.append(token)
        at = found.end()
        if len(token) < len(found[1] or found[2]):
            break
    return out, at


def evaluate(tokens: list[str]) -> Terms | None:
    """What an expression comes to, by the shunting-yard algorithm: ``with`` binds before ``and``, that before ``or``, all
    from the left. None for one that is not whole: empty, a bracket or an operand missing, ``with`` without an exception."""
    values: list[Terms] = []
    waiting: list[str] = []

    def reduce() -> bool:
        word = waiting.pop()
        if word == "(" or len(values) < 2:
            return False
        b, a = values.pop(), values.pop()
        if word == "with" and (a.bind < 4 or b.bind < 4):
            return False
        values.append(_joined(word, a, b.text if word == "with" else b))
        return True

    for token in tokens:
        word = token.lower()
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                if not reduce():
                    return None
            if not waiting:
                return None
            waiting.pop()
        elif word in _BIND:
            while waiting and waiting[-1] != "(" and _BIND[waiting[-1]] >= _BIND[word]:
                if not reduce():
                    return None
            waiting.append(word)
        else:
            values.append(_one(token))
    while waiting:
        if not reduce():
            return None
    return values[0] if len(values) == 1 else None


def _expression(raw: bytes, at: int, end: int, tag: str) -> tuple[str, Terms | None] | None:
    """The expression behind a tag that ends at ``at``: as written, and what it comes to. None where none follows."""
    stop = raw.find(b"\n", at, end)
    stop = end if stop < 0 else stop
    reach = _REACH
    while True:
        rest = raw[at:min(stop, at + reach)].decode("utf-8", "replace")
        assigned = _ASSIGN.match(rest)
        begin = assigned.end() if assigned else 0
        tokens, used = tokens_of(rest[begin:]) if assigned else ([], 0)
        behind = _TOKEN.match(rest, begin + used)
        if at + reach >= stop or (behind.end() < len(rest) if behind else rest[begin + used:].strip(" \t")):
            break  # no more to read, or something else follows
        reach *= 4
    if not tokens:
        return None
    terms = evaluate(tokens)
    if tag == TAGS[-1] and (terms is None or OTHER[0] in terms.labels):
        return None
    return " ".join(tokens), terms


_PLACE = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))
_EXPRESSION = pa.list_(pa.struct([("word", pa.int64()), ("written", pa.string()), ("meaning", pa.string()), ("demands", pa.int32())]))
FIELDS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "places array<struct<word:bigint,label:string,base:boolean>>, "
          "expressions array<struct<word:bigint,written:string,meaning:string,demands:int>>")


def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for phrase in [*BASE_PHRASES, *NOTICE_PHRASES, *TAGS]:
        machine.add_word(phrase, phrase)
    machine.make_automaton()
    return machine


def _spaced(spans: Spans) -> tuple[bytes, np.ndarray]:
    """All words, each followed by a space, or by a line end where its text ends; and where each begins."""
    length = spans.end - spans.begin
    begin = np.cumsum(length + 1) - length - 1
    out = np.full(int(length.sum() + len(length)), 32, np.uint8)
    letters = spans.bytes[spans.inside]
    out[np.arange(len(letters)) + np.repeat(np.arange(len(length)), length)] = letters
    last = np.flatnonzero(np.diff(spans.text, append=-1))
    out[begin[last] + length[last]] = 10
    return out.tobytes(), begin


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id``, what the licence statements of its text are, and ``row`` if ``carry``.

    ``places`` are the words at which a phrase or an evaluated expression stands, with its label, and whether it is one of
    the base; ``expressions`` are what follows identifier tags: as written, what they mean (null where the expression is
    not whole) and what the licences to keep ask for, 0 to 5. ``n_base``, ``first_word``, ``last_word`` and
    ``base_labels`` are of the phrases of the base, ``labels`` of all places. ``score`` is how sure a licence is stated: one
    minus the product of the doubts of all distinct labels and of broken expressions.

    One automaton finds phrases and tags in the words of a batch; a phrase counts where words begin and end with it, and
    phrases may overlap. Null and empty texts have no words, no places, null for the first and last word, score 0; rows
    with the same id or text each get their own; empty tables give no rows. Texts of any length are read whole. Other
    columns come along in ``row`` only.
    """
    read = rows_to_read(docs, id_col, text_col, carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton()
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(1)):
                spans = Spans(data, offsets)
                words, begin = _spaced(spans)
                raw = data.tobytes()
                found: list[list[tuple[int, str, bool]]] = [[] for _ in range(end - first)]
                told: list[list[tuple[int, str, Terms | None]]] = [[] for _ in range(end - first)]
                for last, phrase in machine.iter(words.decode("latin-1")):
                    at = last + 1 - len(phrase)
                    if (at and words[at - 1] > 32) or words[last + 1] > 32:
                        continue
                    word = int(np.searchsorted(begin, at))
                    text = int(spans.text[word])
                    start = word - int(spans.first[text])
                    if phrase not in TAGS:
                        base = phrase in BASE_PHRASES
                        found[text].append((start, BASE_PHRASES[phrase] if base else NOTICE_PHRASES[phrase], base))
                        continue
                    tag_end = int(spans.end[word + phrase.count(" ")])
                    stated = _expression(raw, tag_end, int(offsets[text + 1]), phrase)
                    if stated:
                        told[text].append((start, *stated))
                columns: list[list] = [[] for _ in range(9)]
                for text, places in enumerate(found):
                    places += [(s, label, False) for s, _, terms in told[text] if terms for label in sorted(terms.labels)]
                    places.sort()
                    base = [p for p in places if p[2]]
                    doubt = 1.0
                    evaluated = {label for _, _, terms in told[text] if terms for label in terms.labels}
                    for label in sorted({p[1] for p in places}):
                        doubt *= 1 - SURE["expression" if label in evaluated else "phrase"]
                    doubt *= (1 - SURE["broken"]) ** sum(terms is None for _, _, terms in told[text])
                    row = (int(spans.first[text + 1] - spans.first[text]), len(base), base[0][0] if base else None,
                           base[-1][0] if base else None, ",".join(sorted({p[1] for p in base})),
                           ",".join(sorted({p[1] for p in places})), 1 - doubt if places or told[text] else 0.0,
                           [{"word": s, "label": label, "base": b} for s, label, b in places],
                           [{"word": s, "written": written, "meaning": terms.text if terms else None,
                             "demands": terms.demands if terms else None} for s, written, terms in told[text]])
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _PLACE, _EXPRESSION]
                names = ["doc_id", *(f.strip().split(" ")[0] for f in FIELDS.split(", "))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                     *carried(batch, first, end - first)], [*names, *["row"] * carry])

    return in_small_batches(read).mapInArrow(run, schema_with(read, FIELDS))


def report(found: DataFrame) -> DataFrame:
    """The columns of ``scan`` that tell of the document as a whole."""
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                        F.aggregate("expressions", F.lit(None).cast("int"), lambda most, e: F.greatest(most, e.demands))
                        .alias("demands"))
