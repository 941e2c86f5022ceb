"""Log probabilities of texts under a bigram backoff automaton learnt from the corpus."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_through
from .text import mix64, utf8_list

#: Bytes of text in a bucket, whose part of the model one task holds, and of the corpus in a shard of the counts.
BUCKET_BYTES = 4 << 20
SHARD_BYTES = 8 << 20
#: Neither is a word: words hold no white space.
END, START = b"\n", b" "
WORDS, BIGRAMS = 0, 1
_SHARD_SCHEMA = "bucket long, shard long, kind int, keys binary, counts binary"
_REPLY_SCHEMA = "bucket long, shard long, kind int, totals binary, n_tokens long, n_words long, n_texts long"


class Grams:
    """The tokens of a bucket's texts by number, its different words and bigrams, and their hashes in ascending order."""

    def __init__(self, texts: list[bytes]):
        numbers: dict[bytes, int] = {END: 0, START: 1}
        tokens = [[numbers.setdefault(w, len(numbers)) for w in t.lower().split()] + [0] for t in texts]
        self.width = len(numbers)
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.tokens = np.fromiter((w for t in tokens for w in t), np.int64, int(self.lengths.sum()))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
        before = np.r_[1, self.tokens[:-1]]
        before[(np.cumsum(self.lengths) - self.lengths)] = 1
        self.pairs, self.pair_of = np.unique(before * self.width + self.tokens, return_inverse=True)
        pair_hashes = mix64(hashes[self.pairs // self.width] * np.uint64(0x9E3779B97F4A7C15) + hashes[self.pairs % self.width])
        self.order = {WORDS: np.argsort(hashes), BIGRAMS: np.argsort(pair_hashes)}
        self.hashes = {WORDS: hashes[self.order[WORDS]], BIGRAMS: pair_hashes[self.order[BIGRAMS]]}

    def counts(self, kind: int, taught: np.ndarray) -> np.ndarray:
        """How often each word or bigram occurs in the texts that teach, in the order of its hashes."""
        ids = self.tokens if kind == WORDS else self.pair_of
        weights = np.repeat(taught.astype(float), self.lengths)
        number = self.width if kind == WORDS else len(self.pairs)
        counts = np.bincount(ids, weights, number).astype(np.int64)
        if kind == WORDS:
            counts[1] = taught.sum()  # as the history of first tokens
        return counts[self.order[kind]]


def _pack(counts: np.ndarray) -> bytes:
    """Counts as 4 planes of bytes, of which all but the first are nearly all zero."""
    return counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _shards(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard begins in ascending hashes: shards are equal ranges of the upper 32 bits."""
    edges = (np.arange(1, shards, dtype=np.float64) / shards * 2.0 ** 32).astype(np.uint64) << np.uint64(32)
    return np.r_[0, np.searchsorted(hashes, edges), len(hashes)]


class Automaton:
    """States, arcs by state and word, and failure arcs.

    The root has an arc for every word. Every word that the corpus has is a state, and so is the start; its arcs are
    the bigrams that the corpus has, its failure arc leads to the root at the weight that is left.
    """

    def __init__(self, grams: Grams, counts: np.ndarray, pair_counts: np.ndarray, n: int, v: int, strength: float,
                 share: float):
        width = grams.width
        base = (counts + 0.1) / (n + 0.1 * (v + 1))
        seen = pair_counts > 0
        left = strength + share * counts  # what a history leaves to the base, in counts
        history, word = grams.pairs[seen] // width, grams.pairs[seen] % width
        weights = np.log10((pair_counts[seen] + left[history] * base[word]) / (counts[history] + left[history]))
        # state 0 is the root, state 1 + w the history w
        self.width = width
        self.weight = dict(zip([*range(width), *((1 + history) * width + word).tolist()],
                               [*np.log10(base).tolist(), *weights.tolist()], strict=True))
        self.to = np.where(counts > 0, 1 + np.arange(width), 0).tolist()
        self.failure = [0.0, *np.log10(left / (counts + left)).tolist()]
        self.start = self.to[1]

    def traverse(self, tokens: list[int]) -> float:
        """The log10 probability of the tokens: from state to state, over failure arcs where a state lacks the word."""
        total, state, weight, width = 0.0, self.start, self.weight, self.width
        for token in tokens:
            arc = weight.get(state * width + token)
            while arc is None:
                total += self.failure[state]
                state = 0
                arc = weight.get(token)
            total += arc
            state = self.to[token]
        return total


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          strength: float = 5.0, share: float = 1.0) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    A-Z is lower-cased; tokens are what stands between ASCII white space, and an end. The corpus is the rows for which ``learn``
    holds. ``base_score`` is the sum of log10((c + 0.1) / (N + 0.1 (V + 1))) over the tokens (c: a token's count, N: all,
    V: different ones), ``n_known`` the tokens with c > 0. ``score`` is the log10 probability under the bigram model
    (c(h, w) + s p(w)) / (c(h) + s), s = ``strength`` + ``share`` c(h), p the base's probability; after a history h that the
    corpus lacks the base's holds.

    All counts of the corpus are gathered: texts go to buckets, buckets send their words and bigrams with their counts
    to shards by hash, shards add up and answer each bucket for what it sent. So a task holds the part of the automaton
    that its texts can visit, whatever the size of the corpus, and no word is hot: a bucket sends each once. Words are
    told apart by 64-bit hashes.

    A null or empty text is the end alone; a null id stays null; equal rows give equal rows; without a corpus N and V are 0.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("taught"))
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, shards = (max(1, math.ceil(size / x)) for x in (BUCKET_BYTES, SHARD_BYTES))
    placed = read.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)))

    def send(key: tuple, table: pa.Table) -> pa.Table:
        grams = Grams(utf8_list(table.column("text").combine_chunks()))
        taught = table.column("taught").to_numpy()
        rows = []
        for kind in (WORDS, BIGRAMS):
            counts, edges = grams.counts(kind, taught), _shards(grams.hashes[kind], shards)
            for shard, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                if a < b:
                    rows.append((key[0].as_py(), shard, kind, grams.hashes[kind][a:b].tobytes(), _pack(counts[a:b])))
        return pa.table(dict(zip(("bucket", "shard", "kind", "keys", "counts"), map(list, zip(*rows, strict=True)), strict=True)),
                        schema=pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("kind", pa.int32()),
                                          ("keys", pa.binary()), ("counts", pa.binary())]))

    starts = xxhash.xxh3_64_intdigest(START)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        shard, kind = (k.as_py() for k in key)
        keys = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([_unpack(x) for x in table.column("counts").to_pylist()])
        different, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(place, counts, len(different)).astype(np.int64)
        ends = np.cumsum([0, *map(len, keys)])
        each = totals[place]
        out = [(bucket, shard, kind, _pack(each[a:b]), 0, 0, 0) for bucket, a, b in
               zip(table.column("bucket").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        if kind == WORDS:
            token = different != np.uint64(starts)
            out.append((-1, shard, -1, b"", int(totals[token].sum()), int((totals[token] > 0).sum()), int(totals[~token].sum())))
        names = ("bucket", "shard", "kind", "totals", "n_tokens", "n_words", "n_texts")
        return pa.table(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema=pa.schema(
            [("bucket", pa.int64()), ("shard", pa.int64()), ("kind", pa.int32()), ("totals", pa.binary()),
             *((n, pa.int64()) for n in names[4:])]))

    sent = placed.groupBy("bucket").applyInArrow(send, _SHARD_SCHEMA)
    replies = write_through(sent.groupBy("shard", "kind").applyInArrow(answer, _REPLY_SCHEMA), "gram-counts")
    whole = replies.where("bucket = -1").agg(F.sum("n_tokens").alias("n"), F.sum("n_words").alias("v")).first()
    n, v = whole["n"] or 0, whole["v"] or 0

    def traverse(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(utf8_list(table.column("text").combine_chunks()))
        counts = {}
        for kind in (WORDS, BIGRAMS):
            part = answers.filter(pa.compute.equal(answers.column("kind"), kind)).sort_by("shard")
            counts[kind] = np.zeros(len(grams.hashes[kind]), np.int64)
            counts[kind][grams.order[kind]] = np.concatenate([_unpack(x) for x in part.column("totals").to_pylist()])
        automaton = Automaton(grams, counts[WORDS], counts[BIGRAMS], n, v, strength, share)
        starts = np.cumsum(grams.lengths) - grams.lengths
        base = np.log10((counts[WORDS] + 0.1) / (n + 0.1 * (v + 1)))
        tokens, begins, ends = grams.tokens.tolist(), starts.tolist(), (starts + grams.lengths).tolist()
        return pa.table({
            "doc_id": table.column("doc_id"), "n_tokens": grams.lengths,
            "n_known": np.add.reduceat((counts[WORDS] > 0)[grams.tokens].astype(np.int64), starts),
            "train_tokens": np.full(len(starts), n, np.int64), "base_score": np.add.reduceat(base[grams.tokens], starts),
            "score": np.array([automaton.traverse(tokens[a:b]) for a, b in zip(begins, ends, strict=True)])})

    kind = read.schema["doc_id"].dataType.simpleString()
    return placed.groupBy("bucket").cogroup(replies.where("bucket >= 0").groupBy("bucket")).applyInArrow(
        traverse, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
