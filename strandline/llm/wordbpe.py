"""The word BPE vocabulary: units of a text, their pre-tokens, and the merges as a hash table.

A text is cut at the strings of special tokens first, then at white space. Normalisation and
pre-tokenisation never look across white space, so each piece between (a unit) has ids of its own, and equal
units have equal ids. Normalising and pre-tokenising are the library's; the merging is the operators'.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import regex

#: White space as the tokenizer's patterns know it; str.split knows the separators 1C to 1F besides.
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
PLAIN = regex.compile("[\x00-\u024f]*")
#: The pre-tokeniser's pattern, and the space that parts units here.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+| ")
SEPARATORS = "\x1c\x1d\x1e\x1f"
NO_RANK = np.int64(1) << 40
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class PairTable:
    """Pairs of symbol ids to a value, looked up for whole arrays by open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, values: np.ndarray):
        self.bits = int(np.ceil(np.log2(max(len(left), 2)))) + 2
        self.keys = np.full(1 << self.bits, EMPTY)
        self.values = np.full(1 << self.bits, -1, np.int64)
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        for key, slot, value in zip(keys, self._slots(keys).tolist(), values.tolist(), strict=True):
            while self.keys[slot] != EMPTY:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.values[slot] = key, value

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The value of each pair, -1 where there is none; negative symbols pair with nothing."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slots = self._slots(keys)
        found = self.keys[slots]
        open_ = np.flatnonzero((found != keys) & (found != EMPTY))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % len(self.keys)
            found = self.keys[slots[open_]]
            open_ = open_[(found != keys[open_]) & (found != EMPTY)]
        return np.where(self.keys[slots] == keys, self.values[slots], -1)


@dataclass
class WordBpe:
    """A vocabulary file of the tokenizers library."""

    tokenizer: object
    tokens: list[str]
    special: dict[str, int]
    symbols: dict[str, int]
    last_symbols: dict[str, int]
    ranks: PairTable
    merged: np.ndarray  # by rank
    spelling: dict[int, str]  # bytes to the characters that stand for them

    def segments(self, text: str) -> list[tuple[str, int]]:
        """The text cut at special strings: (ordinary text, -1) and ('', id)."""
        if not any(s in text for s in self.special):
            return [(text, -1)]
        parts = re.split("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")", text)
        return [("", self.special[p]) if p in self.special else (p, -1) for p in parts if p]

    def units(self, text: str) -> list[str]:
        """What stands between white space; a special string is a unit of its own, marked by a leading tab."""
        units: list[str] = []
        for part, special in self.segments(text):
            if special >= 0:
                units.append("\t" + self.tokens[special])
            elif any(s in part for s in SEPARATORS):
                units += [x for x in WHITE.split(part) if x]
            else:
                units += part.split()
        return units

    def pretokens(self, units: list[str]) -> tuple[list[str], np.ndarray]:
        """The pre-tokens of the units, unit by unit, and the index of each one's unit; special units have none.

        Characters below U+0250 are composed already and of a settled class, so units of these are lower-cased and
        cut here; the library does the others.
        """
        found: list[list[str]] = [[]] * len(units)
        plain, others = [], []
        for i, unit in enumerate(units):
            if unit.isascii() and unit.isalpha():  # one pre-token, whose bytes stand for themselves
                found[i] = [unit.lower()]
            elif unit[0] != "\t":
                (plain if PLAIN.fullmatch(unit) else others).append(i)
        if plain:
            pieces = PIECES.findall(" ".join([units[i].lower() for i in plain]))
            spelled = " ".join(pieces).encode().decode("latin-1").translate(self.spelling).split(" ")
            # a separating space among the pieces has become three: two empty strings
            begin = 0
            for i in plain:
                end = begin
                while end < len(spelled) and spelled[end]:
                    end += 1
                found[i] = spelled[begin:end]
                begin = end + 2
        if others:
            normal = self.tokenizer.normalizer.normalize_str(" ".join([units[i] for i in others]))
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            starts = np.array([s for _, (s, _) in pieces], np.int64)
            spaces = np.flatnonzero(np.frombuffer(normal.encode("utf-32-le"), np.uint32) == 32)
            ends = np.searchsorted(starts, spaces).tolist()
            for i, begin, end in zip(others, [0, *ends], [*ends, len(pieces)], strict=True):
                found[i] = [p for p, _ in pieces[begin:end]]
        return [p for f in found for p in f], np.repeat(np.arange(len(units)), list(map(len, found)))

    def symbol_ids(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols of all pre-tokens, flat, and the offsets of the pre-tokens in them."""
        ends = np.cumsum([0, *map(len, pretokens)])
        flat = np.fromiter(map(self.symbols.__getitem__, "".join(pretokens)), np.int64, int(ends[-1]))
        flat[ends[1:] - 1] = np.fromiter((self.last_symbols[p[-1]] for p in pretokens), np.int64, len(pretokens))
        return flat, ends


def read_file(path: str) -> WordBpe:
    """The vocabulary at ``path``, which must have a word-end suffix and merges that follow what they merge."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, suffix = content["model"], content["model"]["end_of_word_suffix"]
    vocabulary = model["vocab"]
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    tokens = [""] * (1 + max([*vocabulary.values(), *special.values()]))
    for token, number in [*vocabulary.items(), *special.items()]:
        tokens[number] = token
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left, right = (np.array([vocabulary[p[i]] for p in pairs], np.int64) for i in (0, 1))
    merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
    made = np.full(len(tokens), -1, np.int64)
    np.maximum.at(made, merged, np.arange(len(merged)))
    if (np.maximum(made[left], made[right]) >= np.arange(len(merged))).any():
        raise ValueError("a merge ranks before one that makes its parts")
    single = {t: i for t, i in vocabulary.items() if len(t) == 1}
    return WordBpe(Tokenizer.from_file(path), tokens, special, single, {t: vocabulary[t + suffix] for t in single},
                   PairTable(left, right, np.arange(len(merged))), merged, spelling())


load = lru_cache(maxsize=4)(read_file)


def spelling() -> dict[int, str]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others as U+0100 onwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return table | {0x20: " "}
