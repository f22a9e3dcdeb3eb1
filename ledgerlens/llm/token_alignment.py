"""Alignment of the tokens of two tokenizers, each distinct text once.

Texts are shuffled by their full content, so that copies meet and are tokenised and aligned
once with their number of copies. A task works on slices of texts: where tokens of both sides
end at the same byte the text is cut into groups, every token of one side in a group is linked
with every token of the other, and the links of a slice become one row of it: its distinct id
pairs with the number of documents that hold them, and for each text which pairs and how
often. Pair counts are then an aggregate over (slice, pair), and go back to the slices by a
join; texts carry their measures to the documents by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlens.llm.common import slices, table, whole
from ledgerlens.llm.fast_encoding import Pieces, byte_level, piece_model

# Bytes of text that are aligned at once; what that takes is some hundred bytes for each of them.
SLICE = 3 << 20
# Groups with more links are counted by distinct ids before they are multiplied.
LARGE = 64
# An id pair is one number: A's id times this plus B's, which is below it.
SIDE = 1 << 31
MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
PER_TEXT = ", ".join(f"{m} array<long>" for m in MEASURES)
SCHEMA = f"slice long, digests array<binary>, {PER_TEXT}, groups array<string>, bounds array<long>, at binary, times binary, pairs array<long>, docs array<long>"
RESULT = "_digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each count."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _within(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sums of values between bounds."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


class Side:
    """The tokens of one tokenizer for the texts of a slice: ids, where each text's lie, and
    the byte at which each token ends, over all texts."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, lengths: np.ndarray):
        self.ids, self.bounds = ids.astype(np.int64), bounds
        self.ends = np.cumsum(lengths[ids])

    def kept(self, good: np.ndarray, lengths: np.ndarray) -> Side:
        counts = np.diff(self.bounds)
        return Side(self.ids[np.repeat(good, counts)], np.concatenate([[0], np.cumsum(np.where(good, counts, 0))]), lengths)


def _faithful(texts: pa.Array, side: Side, names: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Which texts the bytes of their tokens spell."""
    lengths = np.concatenate([[0], side.ends])[side.bounds]
    same = np.diff(lengths) == sizes
    mine = np.repeat(same, np.diff(side.bounds))
    spelt = pa.array(names, pa.large_binary()).take(pa.array(side.ids[mine]))
    want = texts.filter(pa.array(same)).cast(pa.large_binary())
    a, b = (np.frombuffer(x.buffers()[2] or b"", np.uint8)[:int(sizes[same].sum())] for x in (spelt, want))
    wrong = _within(a != b, np.concatenate([[0], np.cumsum(sizes[same])]))
    same[same] = wrong == 0
    return same


class Alignment:
    """The groups of a slice and what is linked in them."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        last = np.searchsorted(b.ends, a.ends)
        shared = b.ends[np.minimum(last, len(b.ends) - 1)] == a.ends if len(b.ends) else np.zeros(len(a.ends), bool)
        shared_b = np.zeros(len(b.ends), bool)
        shared_b[last[shared]] = True
        self.of_a, self.of_b = np.cumsum(shared) - shared, np.cumsum(shared_b) - shared_b
        n = int(shared.sum())
        self.n_a, self.n_b = np.bincount(self.of_a, minlength=n), np.bincount(self.of_b, minlength=n)
        self.first_a, self.first_b = (np.concatenate([[0], np.cumsum(x)]) for x in (self.n_a, self.n_b))
        # A text's last tokens end together, so no group reaches over two texts.
        self.bounds = np.searchsorted(self.first_a, a.bounds)
        self.text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text its distinct pairs: text, pair, times; by text and pair."""
        small = self.n_a * self.n_b <= LARGE
        mine = np.flatnonzero(small[self.of_a])
        times = self.n_b[self.of_a[mine]]
        i = np.repeat(mine, times)
        j = self.first_b[self.of_a[i]] + _runs(times)
        text, pair = self.text[self.of_a[i]], self.a.ids[i] * SIDE + self.b.ids[j]
        weight = np.ones(len(pair), np.int64)
        parts = [(text, pair, weight)]
        for g in np.flatnonzero(~small):
            x, nx = np.unique(self.a.ids[self.first_a[g]:self.first_a[g + 1]], return_counts=True)
            y, ny = np.unique(self.b.ids[self.first_b[g]:self.first_b[g + 1]], return_counts=True)
            p = (x[:, None] * SIDE + y).ravel()
            parts.append((np.full(len(p), self.text[g]), p, (nx[:, None] * ny).ravel()))
        text, pair, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((pair, text))
        text, pair, weight = text[order], pair[order], weight[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])
        starts = np.flatnonzero(new)
        return text[starts], pair[starts], np.add.reduceat(weight, starts) if len(starts) else weight

    def written(self) -> list[str]:
        """Per text the digest of its groups in decimal ids; empty where it has no tokens."""
        a, b = self.a, self.b
        next_a = np.append(self.of_a[1:], -1) == self.of_a
        next_b = np.append(self.of_b[1:], -1) == self.of_b
        ends = np.zeros(len(b.ids) + 1, bool)
        ends[b.bounds] = True
        after_b = np.where(next_b, 0, np.where(ends[1:], 3, 2))
        # The tokens of a group's A side, then those of its B side, then the next group.
        codes = np.empty(len(a.ids) + len(b.ids), np.int64)
        codes[np.arange(len(a.ids)) + self.first_b[self.of_a]] = a.ids * 4 + np.where(next_a, 0, 1)
        codes[np.arange(len(b.ids)) + self.first_a[self.of_b + 1]] = b.ids * 4 + after_b
        used, index = np.unique(codes, return_inverse=True)
        names = pa.array([f"{c >> 2}{',|;'[c & 3:(c & 3) + 1]}" for c in used.tolist()], pa.large_string())
        text = names.take(pa.array(index))
        offsets = np.frombuffer(text.buffers()[1], np.int64)[:len(index) + 1] if len(index) else np.zeros(1, np.int64)
        data = memoryview(text.buffers()[2] or b"")
        edges = offsets[a.bounds + b.bounds].tolist()
        return [hashlib.sha256(data[i:j]).hexdigest() if j > i else "" for i, j in zip(edges, edges[1:])]


def _small(values: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, the lowest bytes first, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _large(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def slice_row(batch: pa.RecordBatch, number: int, tokenizer_a: str, tokenizer_b: str) -> dict:
    """A slice of distinct texts (`text`, `_copies`, `_digest`) as a row of SCHEMA."""
    encode_a, encode_b = byte_level(tokenizer_a, False), piece_model(tokenizer_b)
    texts = pc.binary_join_element_wise(pa.scalar(" "), batch["text"], pa.scalar(""))
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    pieces = Pieces(texts)
    a, b = Side(*encode_a(pieces), encode_a.lengths), Side(*encode_b(pieces), encode_b.lengths)
    good = _faithful(texts, a, encode_a.names, sizes) & _faithful(texts, b, encode_b.bytes, sizes)
    a, b = a.kept(good, encode_a.lengths), b.kept(good, encode_b.lengths)
    aligned = Alignment(a, b)
    text, pair, times = aligned.links()
    pairs, at = np.unique(pair, return_inverse=True)
    copies = batch["_copies"].to_numpy(zero_copy_only=False)
    bounds = np.searchsorted(text, np.arange(len(good) + 1))
    first = np.zeros(len(text), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    steps = np.where(first, at, np.diff(at, prepend=0))
    docs = np.zeros(len(pairs), np.int64)
    np.add.at(docs, at, copies[text])
    measures = [np.diff(a.bounds), np.diff(b.bounds), np.diff(aligned.bounds), _within(times, bounds)]
    return {"slice": number, "digests": batch["_digest"].to_pylist(), **dict(zip(MEASURES, measures, strict=True)),
            "groups": aligned.written(), "bounds": bounds, "at": _small(steps), "times": _small(times), "pairs": pairs, "docs": docs}


def aligned_slices(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, text_col: str = "text") -> DataFrame:
    """The distinct texts of docs, aligned; a row per slice of some megabytes, written."""
    spark = docs.sparkSession
    texts = docs.select(whole(text_col).alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("_copies"))
    texts = texts.select("text", "_copies", _digest(F.col("text")).alias("_digest"))
    schema = to_arrow_schema(spark.createDataFrame([], SCHEMA).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in slices(batches, "text", SLICE):
            yield pa.RecordBatch.from_pylist([slice_row(b, number, tokenizer_a, tokenizer_b)], schema)
            number += 1

    return table(texts.mapInArrow(run, SCHEMA), "aligned")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _slice_pairs(aligned: DataFrame) -> DataFrame:
    return aligned.select("slice", F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select(
        "slice", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))


def link_counts(aligned: DataFrame) -> DataFrame:
    """a_id, b_id, n_docs (documents that hold the pair linked), best (no other pair of its
    A id has more). A task adds up its own slices first; an A id has at most as many pairs as
    B's vocabulary has ids."""
    counts = _slice_pairs(aligned).groupBy("pair").agg(F.sum("docs").alias("n_docs"))
    sided = counts.select(F.floor(F.col("pair") / SIDE).alias("a_id"), F.pmod("pair", F.lit(SIDE)).alias("b_id"), "n_docs")
    return sided.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a_id")))


def _measured(aligned: DataFrame) -> DataFrame:
    """RESULT per distinct text."""
    counts = link_counts(aligned).select((F.col("a_id") * SIDE + F.col("b_id")).alias("pair"), "n_docs", "best")
    back = _slice_pairs(aligned).select(F.col("slice").alias("_of"), "pair").join(counts, "pair")
    kept = aligned.select("slice", "digests", *MEASURES, "groups", "bounds", "at", "times")

    def measure(texts: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by("pair")
        count, best = (found[c].to_numpy().astype(np.int64) for c in ("n_docs", "best"))
        row = texts.slice(0, 1).to_pylist()[0]
        bounds, steps, times = np.array(row["bounds"]), _large(row["at"]), _large(row["times"])
        # Steps begin anew with each text: the first one is its place.
        begun = np.repeat(np.concatenate([[0], np.cumsum(steps)])[bounds[:-1]], np.diff(bounds))
        at = np.cumsum(steps) - begun
        sums = [_within(times * best[at], bounds), _within(times * count[at], bounds)]
        return pa.table({
            "_digest": pa.array(row["digests"], pa.binary()), **{m: pa.array(row[m], pa.int64()) for m in MEASURES},
            "n_best": pa.array(sums[0], pa.int64()), "count_sum": pa.array(sums[1], pa.int64()),
            "groups_sha256": pa.array(row["groups"], pa.string())})

    # Both sides of a group are of one slice, whose size is bounded.
    return kept.groupBy("slice").cogroup(back.groupBy("_of")).applyInArrow(measure, RESULT)


def alignment_digests(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text that is null or empty, or that one of the tokenizers does not spell back to its bytes,
    has no tokens: zeros and an empty digest. Repeated rows and null ids are documents of their
    own and count as such; other columns are not read; an empty table gives no row. A text is
    never cut; a task holds one slice of texts or one text, and its links.
    """
    aligned = aligned_slices(docs, tokenizer_a, tokenizer_b, text_col)
    named = docs.select(F.col(id_col), whole(text_col).alias("_text"))
    # Empty texts have nothing to look up and would all meet in one task.
    full = named.where("_text <> ''").select(id_col, _digest(F.col("_text")).alias("_digest"))
    found = full.join(_measured(aligned), "_digest", "left").drop("_digest")
    zeros = [F.lit(0).cast("long").alias(c) for c in [*MEASURES, "n_best", "count_sum"]]
    empty = named.where("_text = ''").select(id_col, *zeros, F.lit("").alias("groups_sha256"))
    return found.unionByName(empty)
