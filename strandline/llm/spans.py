"""Words as places in the bytes of a run of texts."""

from __future__ import annotations

import zlib

import numpy as np

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 0x41) & (_BYTE <= 0x5A)
_LOWER = np.where(_UPPER, _BYTE + 32, _BYTE).astype(np.uint8)
#: Bytes of letters: A-Z, a-z and all of characters beyond ASCII.
LETTERS = _UPPER | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
#: Letters and 0-9.
WORDS = LETTERS | ((_BYTE >= 0x30) & (_BYTE <= 0x39))


class Spans:
    """The words of a run of texts: bytes with A-Z in lower case, and of each word its begin, end and text.

    ``first[t]`` is the first word of text ``t``; ``first`` ends with the number of words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORDS):
        self.bytes = _LOWER[data]
        inside = kind[data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]  # a word ends with its text
        starts[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        self.inside = inside
        self.begin, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.text = np.searchsorted(offsets, self.begin, side="right") - 1
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))


# ---------------------------------------------------------------- crc32 of words and of runs of words

_POLYNOMIAL = np.uint32(0xEDB88320)  # fixed value: the reflected polynomial of zlib's crc32
_ONES = np.uint32(0xFFFFFFFF)
_LONG = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, _POLYNOMIAL ^ (table >> 1), table >> 1)
    return table


_STEP = _byte_table()


def _apply(shift: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given as what it makes of each of the four bytes."""
    return (shift[..., 0, :][..., crc & 255] ^ shift[..., 1, :][..., (crc >> 8) & 255]
            ^ shift[..., 2, :][..., (crc >> 16) & 255] ^ shift[..., 3, :][..., crc >> 24])


def _zero_bytes() -> tuple[np.ndarray, list[np.ndarray]]:
    """What 0 to 63 zero bytes make of a crc, and what 64, 128, 256 ... make of it."""
    value = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    few = []
    for _ in range(_LONG):
        few.append(value)
        value = _STEP[value & 255] ^ (value >> 8)
    many = [value]
    for _ in range(25):
        many.append(_apply(many[-1], many[-1]))
    return np.stack(few), many


_FEW, _MANY = _zero_bytes()


def _moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Crcs after as many zero bytes as ``by`` says."""
    low = by % _LONG
    crc = (_FEW[low, 0, crc & 255] ^ _FEW[low, 1, (crc >> 8) & 255]
           ^ _FEW[low, 2, (crc >> 16) & 255] ^ _FEW[low, 3, crc >> 24])
    rest, power = by // _LONG, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        crc[odd] = _apply(_MANY[power], crc[odd])
        rest, power = rest >> 1, power + 1
    return crc


def word_crcs(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of each word's bytes."""
    length = end - begin
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    long_ones = int(np.searchsorted(-length, -_LONG))  # more than 64 bytes
    crc = np.full(len(length), _ONES, np.uint32)
    for p in range(int(length[long_ones]) if long_ones < len(length) else 0):
        stop = int(np.searchsorted(-length, -p))  # words with a byte at p
        part = crc[long_ones:stop]
        crc[long_ones:stop] = _STEP[(part ^ data[begin[long_ones:stop] + p]) & 255] ^ (part >> 8)
    crc ^= _ONES
    for i in range(long_ones):
        crc[i] = zlib.crc32(data[begin[i]:begin[i] + length[i]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def run_crcs(spans: Spans, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2 ... ``most`` words of one text: their first words and the crc32 of the words joined by a space."""
    words = word_crcs(spans.bytes, spans.begin, spans.end)
    length, at, crc = spans.end - spans.begin, np.arange(len(words)), words
    out = [(at, crc)]
    for k in range(1, most):
        whole = at + k < len(words)
        whole[whole] = spans.text[at[whole] + k] == spans.text[at[whole]]
        at, crc = at[whole], crc[whole]
        spaced = crc ^ _ONES
        spaced = (_STEP[(spaced ^ np.uint32(32)) & 255] ^ (spaced >> 8)) ^ _ONES
        crc = _moved(spaced, length[at + k]) ^ words[at + k]
        out.append((at, crc))
    return out
