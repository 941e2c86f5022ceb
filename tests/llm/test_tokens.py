"""Token counts, BPE and id files against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandline.llm import bpe, idfiles, rangecoder, token_counts, wordbpe
from tests.llm.conftest import ROWS

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def _counted(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_counts_equal_the_library(odd, library):
    expected = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048)
                for i, t in ROWS]
    found = token_counts.token_counts(odd, WORD)
    assert _counted(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)


def test_ids_and_decoded_text_equal_the_library(odd, library):
    expected = []
    for i, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded, packed = library.decode(ids, skip_special_tokens=False), np.array(ids, "<u4").tobytes()
        expected.append((i, len(ids), bytearray(packed), decoded, hashlib.sha256(packed).hexdigest(),
                         hashlib.sha256(decoded.encode()).hexdigest()))
    found = bpe.encode(odd, WORD)
    assert _counted(found, "doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)


def test_empty_tables(none):
    assert token_counts.token_counts(none, WORD).collect() == []
    assert bpe.encode(none, WORD).collect() == []
    assert idfiles.round_trip(none, BYTE).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), max_size=4).map(" ".join))
def test_any_text(text):
    library, vocabulary = Tokenizer.from_file(WORD), wordbpe.load(WORD)
    units = vocabulary.units(text)
    ids = library.encode(text, add_special_tokens=False).ids
    assert sum(token_counts.unit_counts(vocabulary, units)) == len(ids)
    assert np.frombuffer(b"".join(p for p, _ in bpe.encode_units(vocabulary, units)), "<u4").tolist() == ids
    encoder = idfiles.UnitEncoder(BYTE)
    assert encoder.encode([text])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_lines_of_words_are_put_together_from_pretokens():
    encoder, asked = idfiles.UnitEncoder(BYTE), []

    class Library:
        model = encoder.tokenizer.model

        def encode_batch_fast(self, units, **kwargs):
            asked.extend(units)
            return library.encode_batch_fast(units, **kwargs)

    library, encoder.tokenizer = encoder.tokenizer, Library()
    texts = ["One by.\nThen $$two, three!!\nÉtat\nfour", "1 bye.\nNow two's x\n\ny three?? <|endoftext|>a.\nb c\n", "", "by.\nThen"]
    for _ in range(2):
        asked.clear()
        found = encoder.encode(texts)
        assert [f.tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert " three!!\nÉtat\nfour" not in asked and " by.\nThen" not in asked
    assert not asked


@pytest.mark.parametrize("word", ["a" * 3000, "ab" * 1500, "abc" * 700 + "z", "th" * 5 + "in" * 9])
def test_both_ways_of_merging_agree(word):
    vocabulary = wordbpe.load(WORD)
    flat, _ = bpe.encode_pretokens(vocabulary, [word])
    assert len(flat) == token_counts.surviving_symbols(vocabulary, [word])[0]


def test_trees_merge_the_leftmost_lowest_rank():
    vocabulary = wordbpe.load(WORD)
    for word in ["thinking", "ananan", "banana", "mississippi", "aaaaaaa"]:
        symbols, _ = vocabulary.symbol_ids([word])
        symbols = symbols.tolist()
        while True:
            ranks = [vocabulary.ranks.find(np.array([a]), np.array([b]))[0] for a, b in zip(symbols, symbols[1:])]
            found = [(r, i) for i, r in enumerate(ranks) if r >= 0]
            if not found:
                break
            rank, i = min(found)
            symbols[i:i + 2] = [int(vocabulary.merged[rank])]
        assert bpe.encode_pretokens(vocabulary, [word])[0].tolist() == symbols


def test_files_give_back_every_document(odd):
    library = Tokenizer.from_file(BYTE)
    found = idfiles.round_trip(odd, BYTE).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i))
    expected, at = [], 0
    ids = {}
    for i, text in ROWS:
        ids.setdefault(i, []).append(library.encode(text or "", add_special_tokens=False).ids + [2])
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
        expected = [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[r["doc_id"]]]
        assert (r["n_tokens"], r["ids_crc32"]) in expected


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 5000), st.integers(1, 65_535), st.integers(0, 2 ** 32 - 1))
def test_coder_round_trip(n, kinds, seed):
    draw = np.random.default_rng(seed)
    for ids in (draw.integers(0, kinds, n), np.minimum(draw.zipf(1.2, n), 65_534), np.full(n, kinds - 1)):
        assert (rangecoder.decode(rangecoder.encode(ids.astype(np.int64))) == ids).all()


def test_coder_learns_and_checks():
    ids = np.tile(np.random.default_rng(1).integers(0, 50_000, 40), 500)
    blocks = rangecoder.encode(ids)
    assert sum(map(len, blocks)) < len(ids) / 4
    assert rangecoder.decode(blocks[1:2]).tolist() == ids[rangecoder.BLOCK:2 * rangecoder.BLOCK].tolist()
    damaged = bytearray(blocks[0])
    damaged[20] ^= 1
    with pytest.raises(ValueError):
        rangecoder.decode([bytes(damaged)])
    with pytest.raises(ValueError):
        rangecoder.encode(np.array([65_535]))
