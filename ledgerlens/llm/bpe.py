"""BPE encoding by speculation and verification, and decoding.

A word is first cut greedily into the longest tokens. That is the right encoding exactly when
every token is what BPE makes of its own bytes and no merge could ever join two neighbours
across their border, and the latter is a property of the two tokens alone. All adjacent pairs
of a batch of words are therefore tested at once, and only words with a failing pair are
merged step by step.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.chunks import Known, pieces
from ledgerlens.llm.common import beside, slices, whole

# Fixed value: the published pre-tokenisation pattern of this vocabulary.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NEVER, NONE = np.int64(1 << 40), 1 << 40


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: a byte that prints stands for
    itself, the others follow from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and the tables for the pair test, of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        vocab = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *added.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(symbols[c] for c in token)
        for content, i in added.items():
            self.bytes[i] = content.encode()
        self.ids = {self.bytes[i]: i for i in vocab.values()}
        self.reach: dict[bytes, int] = {}
        for token in self.ids:
            self.reach[token[:2]] = max(self.reach.get(token[:2], 1), len(token))
        self.special = added
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.base = [self.ids[bytes([b])] for b in range(256)]
        self.left, self.right = np.arange(size), np.arange(size)
        self.rank = np.full(size, -1, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            joined = vocab[a + b]
            self.merge.setdefault((vocab[a], vocab[b]), (r, joined))
            if self.rank[joined] < 0:
                self.rank[joined], self.left[joined], self.right[joined] = r, vocab[a], vocab[b]
        keys = np.array([(a << 32) | b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        self.own: dict[int, bool] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of the merges of pairs, NEVER where there is none."""
        keys = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of tokens: would BPE leave the border between them alone?

        Going back in time, the token that was made later is undone: what touches the border
        is then its outer part, which lived until that merge. A merge across the border would
        have happened where it came before the end of both parts; of equal merges the left
        one comes first.
        """
        fine = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        a_end, b_end = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(live):
            m = self.ranks(a, b)
            bad = (m < a_end) & (m <= b_end) & (m < NEVER)
            fine[live[bad]] = False
            a_made, b_made = self.rank[a], self.rank[b]
            go = ~bad & ((a_made >= 0) | (b_made >= 0))
            undo_a = a_made > b_made
            a_end, b_end = np.where(undo_a, a_made, a_end), np.where(undo_a, b_end, b_made)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            live, a, b, a_end, b_end = live[go], a[go], b[go], a_end[go], b_end[go]
        return fine

    def greedy(self, word: bytes) -> list[int]:
        out, at, n = [], 0, len(word)
        ids, reach = self.ids, self.reach
        while at < n:
            # No token that starts with these two bytes is longer than that.
            stop = min(n, at + reach.get(word[at:at + 2], 1))
            while word[at:stop] not in ids:
                stop -= 1
            out.append(ids[word[at:stop]])
            at = stop
        return out

    def exact(self, word: bytes) -> list[int]:
        """Merging in order of rank, leftmost first."""
        return self._exact_short(word) if len(word) <= 48 else self._exact_long(word)

    def _exact_short(self, word: bytes) -> list[int]:
        token = [self.base[c] for c in word]
        merge, none = self.merge.get, (NONE, 0)
        ranks = [merge(pair, none) for pair in zip(token, token[1:])]
        while ranks and (best := min(ranks)) is not none and best[0] != NONE:
            i = ranks.index(best)
            token[i:i + 2] = [best[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = merge((token[i - 1], token[i]), none)
            if i < len(ranks):
                ranks[i] = merge((token[i], token[i + 1]), none)
        return token

    def _exact_long(self, word: bytes) -> list[int]:
        """The same with a heap, in n log n steps."""
        token = [self.base[c] for c in word]
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        merge = self.merge.get
        for i in range(n - 1):
            if m := merge((token[i], token[i + 1])):
                heap.append((m[0], i, token[i], token[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= n or token[j] != b:
                continue
            token[i], token[j] = merge((a, b))[1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if m := merge((token[i], token[after[j]])):
                    heapq.heappush(heap, (m[0], i, token[i], token[after[j]]))
            if before[i] >= 0 and (m := merge((token[before[i]], token[i]))):
                heapq.heappush(heap, (m[0], before[i], token[before[i]], token[i]))
        return [t for t in token if t >= 0]

    def is_own(self, token: int) -> bool:
        if token not in self.own:
            self.own[token] = self.exact(self.bytes[token]) == [token]
        return self.own[token]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Each word's tokens; words are not empty."""
        proposed = [self.greedy(w) for w in words]
        flat = np.array([t for p in proposed for t in p], np.int64)
        of = np.repeat(np.arange(len(words)), [len(p) for p in proposed])
        inside = of[1:] == of[:-1]
        keys, back = np.unique((flat[:-1][inside] << 32) | flat[1:][inside], return_inverse=True)
        fine = self.compatible(keys >> 32, keys & 0xFFFFFFFF)[back]
        bad = np.zeros(len(words), bool)
        bad[of[1:][inside][~fine]] = True
        tokens, back = np.unique(flat, return_inverse=True)
        own = np.array([self.is_own(int(t)) for t in tokens], bool)
        bad[of[~own[back]]] = True
        for i in np.flatnonzero(bad):
            proposed[i] = self.exact(words[i])
        return proposed


class Codec:
    """Encodes and decodes texts; words and pieces that were met before come from tables."""

    def __init__(self, path: str, most: int = 250_000):
        self.vocabulary = Vocabulary(path)
        self.words, self.pieces = Known(most), Known(most)

    def _split(self, piece: str, special: bool) -> list[str]:
        if special:
            parts = self.vocabulary.cut.split(piece)
            return [w for p in parts if p for w in ([p] if p in self.vocabulary.special else WORD.findall(p))]
        if piece[1:].isalpha() and piece[0] == " " and piece.isascii():
            return [piece]
        return WORD.findall(piece)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        specials = self.vocabulary.special
        special = any(s in t for s in specials for t in texts)
        cut = [pieces(t) for t in texts]
        new = [(p, self._split(p, special)) for p in self.pieces.missing({p for c in cut for p in c})]
        unknown = self.words.missing({w for _, ws in new for w in ws} - specials.keys())
        young = self.words.young
        if unknown:
            coded = self.vocabulary.encode_words([w.encode() for w in unknown])
            young.update((w, array("i", ids).tobytes()) for w, ids in zip(unknown, coded, strict=True))
        tokens = young if not special else {**young, **{s: array("i", [i]).tobytes() for s, i in specials.items()}}
        self.pieces.young.update(
            (p, tokens[ws[0]] if len(ws) == 1 else b"".join([tokens[w] for w in ws])) for p, ws in new)
        get = self.pieces.young.__getitem__
        return [np.frombuffer(b"".join(map(get, c)), np.int32) for c in cut]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(1)
def codec_of(path: str) -> Codec:
    """One codec, with the words it knows, for all tasks of a worker process."""
    return Codec(path)


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of int) and decoded (the text made of those ids again), per row of docs.

    Null texts count as empty and have no ids; special tokens in a text are encoded as such.
    Rows are treated one by one: repeated ones give repeated rows, other columns are not read,
    an empty table gives none. Memory is bounded by one slice of about a megabyte of text, or
    one text, and the tables.
    """
    schema = beside(docs, id_col, "ids array<int>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokenizer)
        for b in slices(batches, "_text"):
            coded = codec.encode(b["_text"].to_pylist())
            ends = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
            values = np.concatenate(coded) if coded else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [b[id_col], pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32())),
                 pa.array([codec.decode(c) for c in coded], pa.string())], [id_col, "ids", "decoded"])

    return docs.select(id_col, whole(text_col).alias("_text")).mapInArrow(run, schema)


def bpe_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256.

    A null text counts as empty: no tokens, and the digests of nothing. Null ids and repeated
    rows are rows like any other; other columns are not read; an empty table gives none.
    """
    return round_trip(docs, tokenizer, id_col, text_col).select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
