"""Repeated byte strings by a sorted, range-partitioned suffix array.

A string of `LENGTH` bytes counts as repeated when it starts at two places. Sorting the
suffixes at every byte would move each text hundreds of times over, so suffixes are taken at
anchors first: the place of the smallest gram value in each window of LENGTH bytes. Equal
windows have the same anchor at the same offset, so windows whose anchor's leading bytes are
unique are unique themselves, and all windows of an anchor are decided together where
possible. Three rounds narrow it down, each over fewer and finer units of windows:

1. anchors: all windows that share an anchor, led by its gram;
2. blocks of `BLOCK` windows, led by the bytes that all of them contain;
3. single windows, led by all their bytes.

In each round the suffixes are range-partitioned by their leading bytes (Spark samples the
splitters), each bucket is sorted by multikey quicksort, and neighbours are compared; the first
and last run of a bucket are compared with those of the other buckets. A unit whose whole hull
has an equal neighbour is repeated, one whose leading bytes are unique is dropped, the others go
to the next round, with one witness of each hull that is decided. Leading bytes are sixteen real bytes and a fingerprint of the rest.

Splitters include the place of a suffix, so a string that a third of all rows share is spread
over as many buckets as its rows need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import beside, slices, table, whole

LENGTH, GRAM, BLOCK, SEGMENT = 400, 32, 16, 1 << 20
WINDOW = LENGTH - GRAM + 1
# What the values of grams, by which anchors are chosen, are mixed with.
STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# Two primes below 2^31 and, for each of two fingerprints, a base in each of their fields.
PRIMES = (2147483647, 2147483629)
BASES = ((1203970821, 1750331647), (1987654361, 1455172939))
BYTES = np.random.default_rng(7).integers(1, 1 << 30, (2, 256), dtype=np.uint64)
ROW = "kid long, kth long, pos int, lo int, hi int"
WORDS = ["w0", "w1", "w2", "w3"]


def _powers(base: int, prime: int, size: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:size]


class Prints:
    """Fingerprints of any stretch of a buffer, twice 62 bits, from prefix sums of powers.

    Each is made of two polynomials over fields of prime order. A sum of powers modulo 2^64
    would lose most of its bits on texts that alternate as the Thue-Morse sequence does.
    """

    powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray):
        self.data = data
        self.sums: dict[tuple[int, int], np.ndarray] = {}

    def _ready(self, k: int, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums, below 2^31 for each byte, and inverse powers."""
        n, prime = len(self.data), PRIMES[f]
        if (k, f) not in self.powers or len(self.powers[k, f][0]) <= n:
            size = max(n + 1, SEGMENT + 4 * LENGTH)
            self.powers[k, f] = tuple(_powers(b, prime, size) for b in (BASES[k][f], pow(BASES[k][f], -1, prime)))
        if (k, f) not in self.sums:
            terms = BYTES[k][self.data] * self.powers[k, f][0][:n] % np.uint64(prime)
            self.sums[k, f] = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        return self.sums[k, f], self.powers[k, f][1]

    def of(self, start: np.ndarray, end: np.ndarray, k: int = 0) -> np.ndarray:
        out = np.zeros(len(start), np.uint64)
        for f, prime in enumerate(PRIMES):
            sums, inverse = self._ready(k, f)
            p = np.uint64(prime)
            out = out << np.uint64(31) | (sums[end] - sums[start]) % p * inverse[start] % p
        return out.view(np.int64)


def words_at(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Two words of the sixteen bytes from each place on."""
    taken = data[at[:, None] + np.arange(16)].copy().view(">u8").astype(np.uint64).view(np.int64)
    return [taken[:, 0], taken[:, 1]]


def gram_values(data: np.ndarray) -> np.ndarray:
    """A value for each gram, by doubling."""
    out, size = BYTES[0][data], 1
    while size < GRAM:
        out = out[:-size] * np.uint64(STEPS[size % 2] + 2 * size) + out[size:]
        size *= 2
    return (out ^ (out >> np.uint64(29))) * np.uint64(STEPS[1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value in each stretch of `width`, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows of a text, and the first and last window of each."""
    place = np.uint64((1 << 24) - 1)
    values = gram_values(data) & ~place | np.arange(len(data) - GRAM + 1, dtype=np.uint64)
    at = (sliding_least(values, WINDOW) & place).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.concatenate([first[1:], [len(at)]]) - 1


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order by the first key; only what it leaves tied is ordered by the next, and so on."""
    order = np.argsort(keys[0], kind="quicksort")
    run = np.cumsum(np.concatenate([[0], np.diff(keys[0][order]) != 0])) if len(order) else order
    for key in keys[1:]:
        same = np.concatenate([run[1:] == run[:-1], [False]]) if len(run) else run.astype(bool)
        tied = np.flatnonzero(same | np.concatenate([[False], same[:-1]])) if len(run) else run
        if not len(tied):
            break
        part = order[tied]
        inner = np.lexsort((key[part], run[tied]))
        order[tied] = part[inner]
        values = key[order]
        run = np.cumsum(np.concatenate([[0], (run[1:] != run[:-1]) | (same[:-1] & (values[1:] != values[:-1]))]))
    return order


def runs_of(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Run number of each sorted row, and the size of its run."""
    change = np.zeros(len(keys[0]), bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    run = np.cumsum(change) - 1
    return run, np.bincount(run)[run]


BUCKET = "w0 long, w1 long, w2 long, w3 long, kid long, kth long, pos int, lo int, hi int, repeated boolean, full boolean, open boolean, edge boolean"


def repeats(units: DataFrame) -> DataFrame:
    """Units (WORDS, hull, rel, and ROW) whose leading words another unit has too: `full` where
    one has an equal hull as well, `open` where the next round has to look at it."""
    shards = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.repartitionByRange(shards, *WORDS, "hull", "kid", "pos", "lo")

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        del held
        column = {n: rows[n].to_numpy() for n in rows.column_names}
        keys = [column[w] for w in WORDS] + [column["hull"], column["rel"]]
        order = multikey_order(keys)
        keys = [k[order] for k in keys]
        run, size = runs_of(keys[:4])
        hull_run, same_hull = runs_of(keys)
        # The first of equal hulls goes on to the next round too where other hulls share its
        # leading words: their windows may equal some of its own.
        witness = np.concatenate([[True], hull_run[1:] != hull_run[:-1]]) & ((size > same_hull) | (run == 0) | (run == run[-1]))
        first = np.concatenate([[True], run[1:] != run[:-1]])
        outer = (run == 0) | (run == run[-1])
        keep = (size > 1) | outer
        picked = order[keep]
        yield pa.RecordBatch.from_pydict(
            {w: pa.array(k[keep]) for w, k in zip(WORDS, keys, strict=False)}
            | {n: pa.array(column[n][picked]) for n in ("kid", "kth", "pos", "lo", "hi")}
            | {"repeated": pa.array(size[keep] > 1), "full": pa.array(same_hull[keep] > 1),
               "open": pa.array(((same_hull == 1) | witness)[keep]), "edge": pa.array((outer & first)[keep])})

    found = table(dealt.mapInArrow(bucket, BUCKET), "bucket")
    # Two rows a bucket: the runs at its ends, which may go on in the next one.
    across = found.filter("edge").groupBy(*WORDS).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    twice = found.join(F.broadcast(across.withColumn("_across", F.lit(True))), WORDS, "left")
    return twice.filter(F.col("repeated") | F.col("_across")).select("kid", "kth", "pos", "lo", "hi", "full", "open")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, bytes, and a key of the row: 64-bit hashes of its id and of its text. Rows of null or
    repeated ids are told by their texts alone, and equal ones have equal spans."""
    text = whole(text_col)
    return docs.select(F.col(id_col), F.xxhash64(F.col(id_col)).alias("kid"), F.xxhash64(text, F.lit(7)).alias("kth"), text.cast("binary").alias("_bytes"))


UNIT = f"w0 long, w1 long, w2 long, w3 long, hull long, rel int, {ROW}"


def _units(words: list, hull: np.ndarray, rel: np.ndarray, kid, kth, pos, lo, hi) -> pa.RecordBatch:
    named = dict(zip(WORDS, words, strict=True)) | {"hull": hull}
    ints = {"rel": rel, "pos": pos, "lo": lo, "hi": hi}
    return pa.RecordBatch.from_pydict(
        {n: pa.array(v, pa.int64()) for n, v in named.items()} | {"rel": pa.array(ints["rel"], pa.int32()), "kid": pa.array(kid, pa.int64()), "kth": pa.array(kth, pa.int64())}
        | {n: pa.array(ints[n], pa.int32()) for n in ("pos", "lo", "hi")})


def anchor_units(rows: DataFrame) -> DataFrame:
    """Round 1. Long texts are taken in overlapping segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_bytes"):
            texts = b["_bytes"].to_pylist()
            data = np.frombuffer(b"".join(texts), np.uint8)
            out, base = [], 0
            for i, t in enumerate(texts):
                n = len(t)
                for s in range(0, n - LENGTH + 1, SEGMENT):
                    part = data[base + s: base + min(n, s + SEGMENT + LENGTH - 1)]
                    a, lo, hi = anchors(part)
                    out.append((np.full(len(a), i), base + s + a, base + s + lo, base + s + hi, np.full(len(a), base)))
                base += n
            if not out:
                continue
            row, a, lo, hi, start = (np.concatenate(c) for c in zip(*out, strict=True))
            for k in range(0, len(data), SEGMENT):
                mine = (lo >= k) & (lo < k + SEGMENT)
                if not mine.any():
                    continue
                top = int(hi[mine].max()) + LENGTH
                prints = Prints(data[k:top])
                at, l, h = a[mine] - k, lo[mine] - k, hi[mine] - k
                w0, w1 = words_at(data[k:top], at)
                r = row[mine]
                kid, kth = b["kid"].to_numpy()[r], b["kth"].to_numpy()[r]
                rel = ((at - l) << 10 | (h - l)).astype(np.int32)
                s = start[mine] - k
                yield _units([w0, w1, prints.of(at, at + GRAM), np.zeros_like(w0)], prints.of(l, h + LENGTH), rel, kid, kth, at - s, l - s, h - s)

    return rows.select("kid", "kth", "_bytes").filter(F.octet_length("_bytes") >= LENGTH).mapInArrow(run, UNIT)


def contexts(rows: DataFrame, unsure: DataFrame) -> DataFrame:
    """The bytes of the windows of unsure anchors: ROW and `_ctx`."""
    per_text = unsure.groupBy("kid", "kth").agg(F.collect_list(F.struct("pos", "lo", "hi")).alias("_units"))
    each = rows.select("kid", "kth", "_bytes").join(per_text.hint("shuffle_hash"), ["kid", "kth"]).select(
        "kid", "kth", "_bytes", F.explode("_units").alias("u"))
    return each.select("kid", "kth", "u.pos", "u.lo", "u.hi", F.substring("_bytes", F.col("u.lo") + 1, F.col("u.hi") - F.col("u.lo") + LENGTH).alias("_ctx"))


def _joined(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    texts = b["_ctx"].to_pylist()
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), starts, {n: b[n].to_numpy() for n in b.schema.names if n != "_ctx"}


def block_units(held: DataFrame) -> DataFrame:
    """Round 2: blocks by offset from the anchor, which is the same in equal windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_ctx", SEGMENT // 2):
            data, start, c = _joined(b)
            least, most = c["pos"].astype(np.int64) - c["hi"], c["pos"].astype(np.int64) - c["lo"]
            counts = most // BLOCK - least // BLOCK + 1
            row = np.repeat(np.arange(len(counts)), counts)
            j = least[row] // BLOCK + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            near, far = np.maximum(least[row], j * BLOCK), np.minimum(most[row], j * BLOCK + BLOCK - 1)
            anchor = start[row] + most[row]
            core, core_end = anchor - j * BLOCK, anchor - j * BLOCK - BLOCK + 1 + LENGTH
            prints = Prints(data)
            rel = (j << 10 | (near - j * BLOCK) << 5 | (far - near)).astype(np.int32)
            pos = c["pos"][row]
            yield _units([*words_at(data, core), prints.of(core, core_end), prints.of(core, core_end, 1)], prints.of(anchor - far, anchor - near + LENGTH),
                         rel, c["kid"][row], c["kth"][row], pos, pos - far, pos - near)

    return held.mapInArrow(run, UNIT)


def window_units(held: DataFrame, unsure: DataFrame) -> DataFrame:
    """Round 3: the windows of unsure blocks."""
    blocks = unsure.select("kid", "kth", "pos", F.col("lo").alias("from"), F.col("hi").alias("to"))
    # One anchor has the same bytes wherever it is held, in one context or more.
    joined = held.join(blocks, ["kid", "kth", "pos"]).filter("from >= lo and to <= hi")
    cut = joined.select("kid", "kth", "pos", F.col("from").alias("lo"), F.col("to").alias("hi"), F.expr(f"substring(_ctx, `from` - lo + 1, `to` - `from` + {LENGTH})").alias("_ctx")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_ctx", SEGMENT // 4):
            data, start, c = _joined(b)
            counts = (c["hi"] - c["lo"] + 1).astype(np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            at, prints = start[row] + step, Prints(data)
            lo = c["lo"][row] + step
            one, two = prints.of(at, at + LENGTH), prints.of(at, at + LENGTH, 1)
            yield _units([*words_at(data, at), one, two], one, np.zeros(len(row), np.int32), c["kid"][row], c["kth"][row], lo, lo, lo)

    return cut.mapInArrow(run, UNIT)


def _span(found: DataFrame, condition: str | Column = "true") -> DataFrame:
    return found.filter(condition).select("kid", "kth", F.col("lo").alias("s"), (F.col("hi") + LENGTH).alias("e"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, spans (removed runs: start, end in bytes), kept (the other bytes), a row per
    row of docs.

    Null texts count as empty; texts under 400 bytes keep all their bytes; rows repeated with
    their id are two places and lose what they share. Strings are judged on the input. Other
    columns are not read; an empty table gives none.
    """
    rows = keyed(docs, id_col, text_col)
    first = table(repeats(anchor_units(rows)), "anchors")
    held = table(contexts(rows, first.filter("open")), "contexts")
    second = table(repeats(block_units(held)), "blocks")
    third = repeats(window_units(held, second.filter("open").select("kid", "kth", "pos", "lo", "hi").distinct()))
    spans = _span(first, "full").unionByName(_span(second, "full")).unionByName(_span(third)).groupBy("kid", "kth").agg(
        F.collect_set(F.struct("s", "e")).alias("_spans"))
    joined = rows.join(spans.hint("shuffle_hash"), ["kid", "kth"], "left").select(id_col, "_bytes", "_spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_bytes"):
            sizes, all_spans, kept = [], [], []
            for data, own in zip(b["_bytes"].to_pylist(), b["_spans"].to_pylist(), strict=True):
                merged: list[list[int]] = []
                for s, e in sorted((x["s"], x["e"]) for x in own or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                edges = [0, *[p for m in merged for p in m], len(data)]
                sizes.append(len(data))
                all_spans.append([{"s": s, "e": e} for s, e in merged])
                kept.append(b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [b[id_col], pa.array(sizes, pa.int64()), pa.array(all_spans, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                 pa.array(kept, pa.binary())], [id_col, "n_bytes", "spans", "kept"])

    return joined.mapInArrow(cut, beside(docs, id_col, "n_bytes long, spans array<struct<s:int,e:int>>, kept binary"))


def suffix_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text counts as empty: zeros and the digest of nothing. Rows repeated with an id, and
    null ids, are documents of their own, so their long texts remove each other; other columns
    are not read; an empty table gives none.
    """
    return suffix_dedup(docs, id_col, text_col).select(
        id_col, "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
