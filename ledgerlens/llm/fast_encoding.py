"""Whole Arrow columns of text to token ids, each distinct piece of a slice encoded once.

A text may be cut before every space that follows a character other than white space: neither
byte-level BPE nor the piece model ever joins across such a place. The pieces of a slice are
cut and numbered in Arrow, only the distinct ones reach a tokenizer, all of them in one call,
and the lengths of the tokens in bytes tell where each piece ends. Nothing is kept between
slices, so memory follows the slice alone.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerlens.llm.bpe import byte_symbols

# Pieces of more bytes go to the tokenizers library one by one: their pattern match is linear.
LONG = 20_000
# The bytes before the last one of white space outside ASCII in UTF-8
# (U+0085, U+00A0, U+1680, U+2000 to U+205F, U+3000).
_WIDE_SPACE = np.isin(np.arange(256), [0xC2, 0x9A, 0x80, 0x81])


def _solid(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For places after at least one byte: is what ends there surely not white space?"""
    last = data[ends - 1]
    before = data[np.maximum(ends - 2, 0)]
    return (last > 32) & ~((last >= 0x80) & _WIDE_SPACE[before])


def _column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of an array of text without nulls."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8)[offsets[0]:offsets[-1]] if whole is not None and len(whole) else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


class Pieces:
    """The pieces of texts: `distinct` ones, `index` of each in order, `starts` of each text."""

    def __init__(self, texts: pa.Array):
        offsets, data = _column(texts)
        flags = np.zeros(len(data) + 1, bool)
        at = np.flatnonzero(data[1:] == 32) + 1
        flags[at[_solid(data, at)]] = True
        flags[offsets] = True
        cuts = np.flatnonzero(flags)
        if cuts[-1] != len(data):
            cuts = np.append(cuts, len(data))
        self.starts = np.searchsorted(cuts, offsets)
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        coded = cut.dictionary_encode()
        self.distinct, self.index = coded.dictionary, coded.indices.to_numpy()

    def spread(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another and where each text's begin, given those of the
        distinct pieces one after another and their ends."""
        begins = np.concatenate([[0], ends])
        lists = pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), pa.array(ids))
        flat = lists.take(pa.array(self.index)).flatten().to_numpy()
        counts = np.concatenate([[0], np.cumsum((begins[1:] - begins[:-1])[self.index])])
        return flat, counts[self.starts]


class ByteLevel:
    """Ids of a byte-level BPE file, equal to those of the tokenizers library."""

    def __init__(self, path: str, special: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]} if special else {}
        names = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(symbols[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in names}
        # Fixed value: the published pre-tokenisation pattern of this vocabulary.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        # Merging by the id of what is made is merging by rank where ids follow the merges.
        made = [ranks[bytes(symbols[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError(f"{path}: ids don't follow the merges")
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.added)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = not special
        size = max([*ranks.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.names = [b""] * size
        for token, i in [*ranks.items(), *((c.encode(), i) for c, i in self.added.items())]:
            self.names[i] = token
        self.lengths = np.array([len(n) for n in self.names], np.int64)

    def _one(self, piece: bytes) -> list[int]:
        if len(piece) > LONG:
            return self.library.encode(piece.decode(), add_special_tokens=False).ids
        return self.fast.encode(piece.decode(), allowed_special="all", disallowed_special=())

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets, data = _column(pieces)
        lengths = np.diff(offsets)
        joint = (lengths >= 2) & (lengths <= LONG)
        joint[joint] = (data[offsets[:-1][joint]] == 32) & _solid(data, offsets[1:][joint])
        for s in self.added:
            joint &= ~pc.match_substring(pieces, s.encode()).to_numpy(zero_copy_only=False)
        joined = pieces.filter(pa.array(joint))
        ends, text = _column(joined)
        ids = self.fast.encode_to_numpy(text.tobytes().decode(), allowed_special="all", disallowed_special=()).astype(self.kind)
        counts = np.zeros(len(pieces), np.int64)
        counts[joint] = np.diff(np.searchsorted(np.cumsum(self.lengths[ids]), ends[1:]) + 1, prepend=0)
        rest = np.flatnonzero(~joint)
        if not len(rest):
            return ids, np.cumsum(counts)
        own = [self._one(p) for p in pieces.take(pa.array(rest)).to_pylist()]
        counts[rest] = [len(o) for o in own]
        out = np.empty(int(counts.sum()), self.kind)
        mine = np.repeat(~joint, counts)
        out[~mine] = ids
        out[mine] = [i for o in own for i in o]
        return out, np.cumsum(counts)

    def __call__(self, texts: pa.Array | Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and n + 1 places between which each one's lie."""
        pieces = texts if isinstance(texts, Pieces) else Pieces(texts)
        if not len(pieces.distinct):
            return np.zeros(0, self.kind), np.zeros(len(pieces.starts), np.int64)
        return pieces.spread(*self._distinct(pieces.distinct))


class PieceModel:
    """Ids of a piece model with byte fallback, of texts that start with the space it adds."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.space = self.model.piece_to_id("▁")
        self.bytes = [self._bytes(i) for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")

    def _bytes(self, i: int) -> bytes:
        name = self.model.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()

    def __call__(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        if not len(pieces.distinct):
            return np.zeros(0, self.kind), np.zeros(len(pieces.starts), np.int64)
        # Each piece starts with a space, which the model puts before what it is given, unless
        # that is empty.
        coded = self.model.encode([p[1:].decode() for p in pieces.distinct.to_pylist()], num_threads=1)
        coded = [c or [self.space] for c in coded]
        ends = np.cumsum([len(c) for c in coded])
        return pieces.spread(np.array([i for c in coded for i in c], self.kind), ends)


@lru_cache(2)
def byte_level(path: str, special: bool) -> ByteLevel:
    """One encoder for all tasks of a worker process."""
    return ByteLevel(path, special)


@lru_cache(1)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)
