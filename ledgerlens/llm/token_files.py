"""Token ids in binary shards with Elias-Fano coded document boundaries.

A shard holds, for documents in ascending order of their ids, the concatenated token ids (two
bytes each where the vocabulary allows, else four) and two monotone sequences in Elias-Fano
code: the document ids and the boundaries between documents. The low bits of a sequence are
packed at fixed width; the high bits are a unary bit vector of two bits an element at most,
over which every `SAMPLE`-th one is sampled so that select needs a short scan. No table of
64-bit offsets exists. Shards are in order too, and the manifest names their token counts.

Layout, little-endian: header of 16 signed 64-bit numbers (magic, version, documents, tokens,
bytes an id, null ids, then for ids and boundaries each: offset, universe bits l, high bytes,
low bytes, first value), samples as unsigned 32-bit numbers, low bits, high bits, token ids.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices, whole
from ledgerlens.llm.fast_encoding import byte_level
from ledgerlens.session import scratch_path

MAGIC, VERSION, SAMPLE, END = 0x4F49465445, 1, 256, 2
# Bytes of text that are encoded at once.
SLICE = 4 << 20
HEADER = np.dtype([("magic", "<i8"), ("version", "<i8"), ("docs", "<i8"), ("tokens", "<i8"), ("width", "<i8"), ("nulls", "<i8"), ("ids", "<i8", 5), ("bounds", "<i8", 5)])


class EliasFano:
    """A monotone sequence of n integers; `decode(i, j)` gives elements i to j - 1."""

    def __init__(self, n: int, first: int, width: int, samples: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.n, self.first, self.width, self.samples, self.low, self.high = n, first, width, samples, low, high

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        first = int(values[0]) if n else 0
        # Differences of 64-bit ids may need all 64 bits.
        rest = values.astype(np.int64).view(np.uint64) - np.uint64(first % (1 << 64)) if n else np.zeros(0, np.uint64)
        span = int(rest[-1]) if n else 0
        width = max(0, (span // max(n, 1)).bit_length() - 1)
        ones = (rest >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) + 8) // 8 * 8 if n else 0, np.uint8)
        bits[ones] = 1
        low = np.zeros((n * width + 7) // 8 * 8, np.uint8)
        for b in range(width):
            low[b: n * width: width] = (rest >> np.uint64(b)).astype(np.uint8) & 1
        return cls(n, first, width, ones[::SAMPLE].astype("<u4"), np.packbits(low, bitorder="little"), np.packbits(bits, bitorder="little"))

    def decode(self, start: int, stop: int) -> np.ndarray:
        if start >= stop:
            return np.zeros(0, np.int64)
        # Select: from the sampled one before `start`, to the next sample after `stop`.
        s, e = start // SAMPLE, -(-stop // SAMPLE)
        at = int(self.samples[s]) // 8
        to = int(self.samples[e]) // 8 + 1 if e < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[at:to], bitorder="little")) + at * 8
        ones = ones[np.searchsorted(ones, int(self.samples[s])):]
        ones = ones[start - s * SAMPLE: stop - s * SAMPLE]
        value = (ones - np.arange(start, stop)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            a, b = start * self.width, stop * self.width
            bits = np.unpackbits(self.low[a // 8: -(-b // 8)], bitorder="little")[a % 8:][: b - a].reshape(-1, self.width)
            for k in range(self.width):
                value |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return (value + np.uint64(self.first % (1 << 64))).view(np.int64)

    def parts(self) -> list[bytes]:
        return [self.samples.tobytes(), self.low.tobytes(), self.high.tobytes()]

    def sizes(self) -> list[int]:
        return [self.n, self.width, len(self.high), len(self.low), self.first]

    @classmethod
    def read(cls, sizes, data: memoryview) -> tuple[EliasFano, int]:
        n, width, high, low, first = map(int, sizes)
        samples = -(-n // SAMPLE) * 4
        whole_ = np.frombuffer(data, np.uint8)
        return cls(n, first, width, whole_[:samples].view("<u4") if samples else np.zeros(0, "<u4"),
                   whole_[samples: samples + low], whole_[samples + low: samples + low + high]), samples + low + high


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
          end: int | None = END) -> DataFrame:
    """Encodes every text (null: empty), appends `end`, and writes shards into `folder`, a path
    or URI that driver and executors share. Returns the manifest: shard, path, docs, tokens.

    Documents are range-partitioned by id (nulls first, then ties by content), so shards are in
    ascending order. Each attempt writes a shard under a name of its
    own, and the manifest names the complete ones only: what a lost executor or a second attempt
    leaves is never read. The memory of a task is one
    slice of texts plus 16 bytes a document.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    placed = rows.repartitionByRange(shards, "id", "tie").sortWithinPartitions("id", "tie", "text").select(
        "id", "text", F.spark_partition_id().alias("shard"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_level(tokenizer, True)
        tail = b"" if end is None else encoder.kind.type(end).tobytes()
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        nulls, shard, out, name = 0, 0, None, ""
        fs, top = _opened(folder)
        for b in slices(batches, "text", SLICE):
            if out is None:
                shard = b["shard"][0].as_py()
                name = f"{top}/{shard:08d}.{uuid.uuid4().hex}"
                fs.create_dir(top)
                out = fs.open_output_stream(f"{name}.ids")
            flat, bounds = encoder(b["text"])
            coded = [flat[i:j].tobytes() + tail for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            nulls += b["id"].null_count
            ids.append(b["id"].drop_null().to_numpy(zero_copy_only=False))
            lengths.append(np.fromiter(map(len, coded), np.int64, len(coded)) // encoder.kind.itemsize)
            out.write(b"".join(coded))
        if out is None:
            return
        out.close()
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        doc_ids = np.concatenate(ids)
        coded_ids, coded_bounds = EliasFano.encode(doc_ids), EliasFano.encode(bounds)
        header = np.zeros(1, HEADER)
        header[0] = (MAGIC, VERSION, len(bounds) - 1, bounds[-1], encoder.kind.itemsize, nulls, tuple(coded_ids.sizes()), tuple(coded_bounds.sizes()))
        with fs.open_output_stream(f"{name}.ef") as f:
            f.write(b"".join([header.tobytes(), *coded_ids.parts(), *coded_bounds.parts()]))
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "path": [os.path.basename(name)],
            "docs": pa.array([len(bounds) - 1], pa.int64()), "tokens": pa.array([int(bounds[-1])], pa.int64())})

    made = placed.mapInArrow(save, "shard int, path string, docs long, tokens long")
    # The manifest has a row a shard and is part of the files: what it names is complete.
    manifest = f"{folder}/manifest"
    made.write.parquet(manifest)
    return spark.read.schema("shard int, path string, docs long, tokens long").parquet(manifest)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (tokens before it in all shards), tokens (its ids as bytes, two or four
    each) and width, from the files. A task reads one shard a block of documents at a time."""
    manifest = spark.read.schema("shard int, path string, docs long, tokens long").parquet(f"{folder}/manifest")
    # One row a shard: the sum over all of them is a table of a few columns.
    placed = manifest.withColumn("base", F.coalesce(
        F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _opened(folder)
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist(), strict=True):
                with fs.open_input_stream(f"{top}/{path}.ef") as f:
                    raw = f.read()
                head = np.frombuffer(raw, HEADER, 1)[0]
                if head["magic"] != MAGIC or head["version"] != VERSION:
                    raise ValueError(f"{path} is not a shard of this format")
                body = memoryview(raw)[HEADER.itemsize:]
                ids, used = EliasFano.read(head["ids"], body)
                bounds, _ = EliasFano.read(head["bounds"], body[used:])
                width, nulls, n = int(head["width"]), int(head["nulls"]), int(head["docs"])
                with fs.open_input_stream(f"{top}/{path}.ids") as f:
                    for start in range(0, n, SAMPLE):
                        stop = min(start + SAMPLE, n)
                        edges = bounds.decode(start, stop + 1)
                        known = ids.decode(max(0, start - nulls), max(0, stop - nulls))
                        doc_ids = [None] * (stop - start - len(known)) + known.tolist()
                        tokens = [f.read(int(k) * width) for k in np.diff(edges)]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(edges[:-1] + base, pa.int64()),
                            "tokens": pa.array(tokens, pa.binary()), "width": pa.array([width] * len(tokens), pa.int32())})

    return placed.repartition(shards, "shard").select("path", "base").mapInArrow(
        load, "doc_id long, start long, tokens binary, width int")


def digests(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of what `read` gives, a row each.

    A null or empty text is its end id alone; null ids and repeated rows are documents like any
    other; files of an empty table give no rows.
    """

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = [zlib.crc32(np.frombuffer(t, f"<u{w}").astype("<u4").tobytes())
                    for t, w in zip(b["tokens"].to_pylist(), b["width"].to_pylist(), strict=True)]
            counts = [len(t) // w for t, w in zip(b["tokens"].to_pylist(), b["width"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b["doc_id"], "start": b["start"], "n_tokens": pa.array(counts, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64())})

    return stored.mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                folder: str | None = None) -> DataFrame:
    """Writes the files and gives, per document read back: doc_id, start, n_tokens, ids_crc32.

    Null ids come first, ties by content; an empty text has its end id only; repeated rows are
    each written; other columns are not read; an empty table writes no shard and gives no row.
    """
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    write(docs, folder, tokenizer, id_col, text_col)
    return digests(read(docs.sparkSession, folder))
