"""Near-duplicate detection by Order MinHash.

A document is the sequence of its five-word shingles. Each hash function picks the `PICKS`
occurrence-labelled shingles with the smallest values and keeps them in text order: documents
collide when they share those shingles and their order, which follows edit similarity. Every
pick is a bucket. A pair is similar when a banded alignment of its shingle sequences matches at
least 0.8 of their union. Classes are the connected components of similar pairs; identical
texts count as one text throughout.

In a bucket documents are compared with centres, not with each other. The first centre is the
text that meets most others in all of its buckets, which of a group of copies is the one with
the fewest edits. A bucket that holds one class then is done.

What is left of the others is split by further ordered picks under an exact bound. The
shingles of a text are ranked from rare to common. Two similar texts meet at the rarest shingle
they share; if that is the i-th of one text of n shingles, at most n - i + 1 can match, and
0.8 of the union have to. So a text is listed under the rarest fifth of its shingles only, a
pair is compared only under a shingle where both may still match enough, and a passage that
many texts share brings none of them together. These lists are worked off with 1, 4, 16 and
more centres, each the best known of a class, until no list holds two classes that could be
linked. No link between two classes of a bucket is lost.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import LOWER_BYTES, PLAIN_WORD, ROW, beside, numbered, slices, table, whole

SHINGLE, PICKS, FUNCTIONS, SIMILAR = 5, 3, 16, 0.8
# Similar texts of n and m shingles have at least so many times n + m in common.
COMMON, EPSILON = SIMILAR / (1 + SIMILAR), 1e-9
# Centres of a list in a round: so many times as many as in the round before, up to a most
# that bounds the rows a round makes of one; rounds go on until no list is left.
GROWTH, CENTRES = 4, 64
# Members of a bucket that meet its centres under one key.
SPREAD = 1000
WORDS = re.compile(PLAIN_WORD)
MIX = np.uint64(0x9E3779B97F4A7C15)
SEEDS = np.random.default_rng(9).integers(1, 1 << 63, FUNCTIONS, dtype=np.uint64) | np.uint64(1)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str, known: dict[str, int]) -> np.ndarray:
    """64-bit values of the five-word shingles in order; a shorter text is one shingle, one
    without words none."""
    words = WORDS.findall(text.encode().translate(LOWER_BYTES).decode())
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > 500_000:
        known.clear()
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w.encode())
    values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        out = _stir(out * np.uint64(3) + values[k:k + n] + np.uint64(k))
    return out


def labelled(values: np.ndarray) -> np.ndarray:
    """The shingles, each with the number of its earlier occurrences mixed in."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    labels = np.empty(len(values), np.uint64)
    nth = np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))
    labels[order] = nth.astype(np.uint64)
    return _stir(values + labels * MIX)


def signatures(values: np.ndarray) -> list[int]:
    """One signed 64-bit number a hash function; none for a text without words."""
    n = len(values)
    if not n:
        return []
    chosen = labelled(values)
    hashed = _stir(chosen[None, :] * SEEDS[:, None])
    picks = min(PICKS, n)
    at = np.argpartition(hashed, picks - 1, axis=1)[:, :picks] if picks < n else np.tile(np.arange(n), (FUNCTIONS, 1))
    at.sort(axis=1)
    out = np.zeros(FUNCTIONS, np.uint64)
    for k in range(picks):
        out = _stir(out * np.uint64(5) + chosen[at[:, k]])
    return out.view(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Matches of the best alignment over the union, or 0 where it is below SIMILAR for sure.

    At that similarity an alignment skips at most (n + m) / 9 shingles, so it stays within a
    band of that width; the common ends are matched first, and the rest bit-parallel: one
    integer holds the part of a row of the alignment that lies in the band.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    band = int((n + m) * (1 - SIMILAR) / (1 + SIMILAR) + EPSILON)
    if abs(n - m) > band:
        return 0.0
    k = min(n, m)
    differ = np.flatnonzero(a[:k] != b[:k])
    head = int(differ[0]) if len(differ) else k
    differ = np.flatnonzero(a[n - (k - head):][::-1] != b[m - (k - head):][::-1])
    tail = int(differ[0]) if len(differ) else k - head
    x, y = a[head:n - tail].tolist(), b[head:m - tail].tolist()
    matched = head + tail
    if x and y:
        most = sum((Counter(x) & Counter(y)).values())
        if matched + most < COMMON * (n + m) - EPSILON:
            return 0.0
        places: dict[int, list[int]] = {}
        for i, v in enumerate(x):
            places.setdefault(v, []).append(i)
        # Bits are the places from `low` on; a zero is a match. Places below have left the band.
        low, width = 0, min(band + 1, len(x))
        row = (1 << width) - 1
        for j, v in enumerate(y):
            if j > band and low < len(x):
                matched += 1 - (row & 1)
                row >>= 1
                low, width = low + 1, width - 1
            if 0 < j < len(x) - band:
                row |= 1 << width
                width += 1
            here = places.get(v)
            if here:
                hit = 0
                for i in here[bisect_left(here, low):bisect_left(here, low + width)]:
                    hit |= 1 << (i - low)
                hit &= row
                row = ((row + hit) | (row - hit)) & ((1 << width) - 1)
        matched += width - row.bit_count()
    return matched / (n + m - matched)


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, node (128-bit digest of the whole text), its number of shingles and signatures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for b in slices(batches, "_text"):
            values = [shingles(t, known) for t in b["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b[id_col], b["_node"], pa.array(map(len, values), pa.int32()), pa.array(map(signatures, values), pa.list_(pa.int64()))],
                [id_col, "_node", "_size", "_sigs"])

    rows = docs.select(id_col, whole(text_col).alias("_text")).withColumn("_node", F.unhex(F.md5("_text")))
    return rows.mapInArrow(run, beside(docs, id_col, "_node binary, _size int, _sigs array<bigint>"))


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) and whether they are similar."""
    with_a = pairs.join(texts.select(F.col("_node").alias("a"), F.col("_values").alias("values_a")), "a")
    both = with_a.join(texts.select(F.col("_node").alias("b"), F.col("_values").alias("values_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "values_a"):
            similar = [similarity(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= SIMILAR for x, y in zip(
                b["values_a"].to_pylist(), b["values_b"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(similar, pa.bool_())], ["a", "b", "similar"])

    return both.select("a", "b", "values_a", "values_b").mapInArrow(run, "a binary, b binary, similar boolean")


def _sequences(texts: DataFrame) -> DataFrame:
    """_node and _values, the bytes of its shingles in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for b in slices(batches, "_text"):
            values = [shingles(t, known).tobytes() for t in b["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["_node"], pa.array(values, pa.binary())], ["_node", "_values"])

    return texts.select("_node", "_text").mapInArrow(run, "_node binary, _values binary")


BUCKET = ["_band", "_sig"]
MEMBER = [*BUCKET, "_n", "_node", "_size", "_most", "_weight", "_label"]


def links(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Verified pairs (a, b) of nodes, and node, label of those that have one."""
    nodes = rows.groupBy("_node").agg(F.min(id_col).alias("_first"), F.any_value("_size").alias("_size"), F.any_value("_sigs").alias("_sigs"))
    members = nodes.select("_node", "_first", "_size", F.posexplode("_sigs").alias(*BUCKET))
    buckets = members.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    members = table(members.join(buckets, BUCKET), "buckets")
    met = members.groupBy("_node").agg(F.any_value("_first").alias("_first"), F.sum("_n").alias("_weight"))
    # One row of each text that has a partner: found by node and id, so that copies of one
    # text do not meet in one task. The node tells texts apart, the hash of the id only rows.
    involved = met.select("_node", F.xxhash64("_first").alias("_id"))
    all_rows = docs.select(F.xxhash64(id_col).alias("_id"), whole(text_col).alias("_text")).withColumn("_node", F.unhex(F.md5("_text")))
    texts = table(_sequences(all_rows.join(involved, ["_node", "_id"], "left_semi").dropDuplicates(["_node", "_id"])), "texts")
    left = table(members.join(met.drop("_first"), "_node").select(
        *BUCKET, "_n", "_node", "_size", F.col("_size").alias("_most"), "_weight", F.col("_node").alias("_label")), "left")
    centre = left.groupBy(BUCKET).agg(F.max(F.struct("_weight", *[c for c in MEMBER if c != "_weight"])).alias("_c")).select("_c.*")
    tried = table(_verify(_pairs(left, centre.select(MEMBER)), texts), "judged")
    labels = components(tried.filter("similar").select("a", "b"))
    left = table(_open(left, centre, labels), "left")
    left = table(_open(_by_rare_shingles(left, texts), None, labels), "left")
    centres = 1
    while not left.isEmpty():
        best = table(_centres(left, centres), "centres")
        judged = table(_verify(_pairs(left, best).join(tried, ["a", "b"], "left_anti"), texts), "judged")
        tried = tried.unionByName(judged)
        labels = _relabelled(labels, judged.filter("similar").select("a", "b"))
        left = table(_open(left, best, labels), "left")
        centres = min(GROWTH * centres, CENTRES)
    return tried.filter("similar").select("a", "b"), labels


def _spread(members: DataFrame, others: DataFrame) -> DataFrame:
    """Members of buckets beside the rows of the same buckets in `others`, which has few of a
    bucket: they are repeated, and the members of a large bucket dealt over the copies."""
    parts = F.ceil(F.col("_n") / SPREAD).cast("int")
    dealt = members.withColumn("_part", F.pmod(F.xxhash64("_node"), parts).cast("int"))
    copies = others.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_n")
    return dealt.join(copies, [*BUCKET, "_part"]).drop("_part")


def _centres(left: DataFrame, centres: int) -> DataFrame:
    """The first so many members of each bucket: the best known of each class before the next best."""
    known = [F.desc("_weight"), F.col("_node")]
    of_class = left.withColumn("_nth", F.row_number().over(Window.partitionBy(*BUCKET, "_label").orderBy(*known))).filter(F.col("_nth") <= centres)
    return of_class.withColumn("_at", F.row_number().over(Window.partitionBy(BUCKET).orderBy("_nth", *known))).filter(
        F.col("_at") <= centres).select(MEMBER)


def _pairs(left: DataFrame, centres: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of a member and a centre of another class that may be similar."""
    other = centres.select(*BUCKET, "_n", *[F.col(c).alias(f"_c{c}") for c in ("_node", "_label", "_size", "_most")])
    met = _spread(left, other).filter(
        (F.col("_label") != F.col("_c_label"))
        & (F.least("_most", "_c_most") >= COMMON * (F.col("_size") + F.col("_c_size")) - EPSILON))
    return met.select(F.least("_node", "_c_node").alias("a"), F.greatest("_node", "_c_node").alias("b")).distinct()


def _open(left: DataFrame, done: DataFrame | None, labels: DataFrame) -> DataFrame:
    """The members, with their classes as they are now, that may still have a link to another
    class of their bucket. The ones in `done` were compared with all that they could be similar to."""
    if done is not None:
        left = left.join(done.select(*BUCKET, "_node"), [*BUCKET, "_node"], "left_anti")
    # The largest partner of a text that matches `_most` of its shingles.
    reach = F.col("_most") / COMMON - F.col("_size") + EPSILON
    rows = left.drop("_label").join(labels.select(F.col("node").alias("_node"), F.col("label").alias("_label")), "_node", "left").select(
        *MEMBER[:-1], F.coalesce("_label", "_node").alias("_label"), reach.alias("_reach")).filter(F.col("_reach") >= SIMILAR * F.col("_size"))
    ends = rows.groupBy(*BUCKET, "_label").agg(F.any_value("_n").alias("_n"), F.min("_size").alias("_least"), F.max("_reach").alias("_far"))
    best = ends.groupBy(BUCKET).agg(
        F.any_value("_n").alias("_n"), F.min(F.struct("_least", "_label")).alias("_low"), F.max(F.struct("_far", "_label")).alias("_high"),
        F.count(F.lit(1)).alias("_classes")).filter("_classes > 1").drop("_classes")
    # Beside the best of all classes the best of all others, for members of that class.
    second = _spread(ends.withColumnRenamed("_label", "_node"), best).groupBy(BUCKET).agg(
        F.any_value("_n").alias("_n"), F.any_value("_low").alias("_low"), F.any_value("_high").alias("_high"),
        F.min(F.when(F.col("_node") != F.col("_low._label"), F.col("_least"))).alias("_low2"),
        F.max(F.when(F.col("_node") != F.col("_high._label"), F.col("_far"))).alias("_high2"))
    low = F.when(F.col("_label") != F.col("_low._label"), F.col("_low._least")).otherwise(F.col("_low2"))
    high = F.when(F.col("_label") != F.col("_high._label"), F.col("_high._far")).otherwise(F.col("_high2"))
    return _spread(rows, second).filter((low <= F.col("_reach")) & (high >= F.col("_size"))).select(MEMBER)


def _by_rare_shingles(left: DataFrame, texts: DataFrame) -> DataFrame:
    """Members of new buckets, one for each of the rarest shingles of the texts left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_values"):
            for node, weight, data in zip(b["_node"].to_pylist(), b["_weight"].to_pylist(), b["_values"].to_pylist(), strict=True):
                values = labelled(np.frombuffer(data, np.uint64)).view(np.int64)
                n = len(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node] * n, pa.binary()), pa.array([n] * n, pa.int32()), pa.array([weight] * n, pa.int64()), pa.array(values)],
                    ["_node", "_size", "_weight", "_sig"])

    waiting = left.groupBy("_node").agg(F.any_value("_weight").alias("_weight"))
    said = table(texts.join(waiting, "_node").select("_node", "_weight", "_values").mapInArrow(
        run, "_node binary, _size int, _weight bigint, _sig bigint"), "shingles")
    shared = said.groupBy("_sig").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    order = Window.partitionBy("_node").orderBy(F.coalesce("_n", F.lit(1)), "_sig")
    ranked = said.join(shared, "_sig", "left").withColumn("_nth", F.row_number().over(order))
    # Where a shingle is the first that two texts share, the rarer ones of either do not match.
    most = F.col("_size") - F.col("_nth") + 1
    return ranked.filter((most >= SIMILAR * F.col("_size") - EPSILON) & (F.col("_n") > 1)).select(
        F.lit(-1).alias("_band"), "_sig", "_n", "_node", "_size", most.alias("_most"), "_weight", F.col("_node").alias("_label"))


def _relabelled(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """node, label with more links: only the links between classes are looked at."""
    for end in ("a", "b"):
        edges = edges.join(labels.select(F.col("node").alias(end), "label"), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    edges = table(edges.filter("a <> b"), "merging")
    if edges.isEmpty():
        return labels
    merged = components(edges)
    moved = labels.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select(
        "node", F.coalesce("to", "label").alias("label"))
    return table(moved.unionByName(merged.join(labels, "node", "left_anti")), "labels")


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component): labels spread along the links and
    then jump to their own labels, until nothing changes."""
    both = table(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = table(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = table(labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")), "lower")
        if lower.filter("label <> was").isEmpty():
            return lower.select("node", "label")
        labels = table(lower.join(lower.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").select(
            "node", F.least("label", "next").alias("label")), "labels")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, class_id (the smallest id of its class), class_size (rows),
    n_links (similar texts it was aligned with, itself not counted) and kept.

    Words are runs of digits, letters and non-ASCII after lower-casing A-Z. Null texts count as
    empty; texts without words are alike only when identical. Of a class the row with the
    smallest id stays, exactly one of rows repeated with it; null ids are larger than any
    other. Other columns are not read; an empty table gives none.
    """
    rows = table(numbered(sketch(docs, id_col, text_col)), "sketch")
    edges, labels = links(rows, docs, id_col, text_col)
    ends = edges.select(F.explode(F.array("a", "b")).alias("_node")).groupBy("_node").agg(F.count(F.lit(1)).alias("n_links"))
    labels = labels.withColumnRenamed("node", "_node").join(ends, "_node", "left")
    # Rows are first counted by text, and those of a text in as many parts as there are tasks,
    # so that one with many copies is a row of each part here and below.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(id_col, ROW, "_node", F.pmod(F.xxhash64(ROW), F.lit(parts)).cast("int").alias("_part"))
    first = F.struct(F.col(id_col).isNull().alias("_none"), F.col(id_col).alias("_id"), F.col(ROW))
    copies = table(dealt.groupBy("_node", "_part").agg(F.min(first).alias("_least"), F.count(F.lit(1)).alias("_rows")), "copies")
    texts = copies.groupBy("_node").agg(F.min("_least").alias("_least"), F.sum("_rows").alias("_rows"))
    labelled = texts.join(labels, "_node", "left").withColumn("_label", F.coalesce("label", "_node"))
    # Likewise the texts of a class.
    labelled = table(labelled.withColumn("_share", F.pmod(F.xxhash64("_node"), F.lit(parts)).cast("int")), "labelled")
    shares = labelled.groupBy("_label", "_share").agg(F.min("_least").alias("_least"), F.sum("_rows").alias("_rows"))
    classes = shares.groupBy("_label").agg(F.min("_least").alias("_stays"), F.sum("_rows").alias("class_size"))
    classes = shares.select("_label", "_share").join(classes, "_label")
    placed = labelled.join(classes, ["_label", "_share"]).select(
        "_node", "_stays", "class_size", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    placed = table(copies.select("_node", "_part").join(placed, "_node"), "classes")
    return dealt.join(placed, ["_node", "_part"]).select(
        id_col, F.col("_stays._id").alias("class_id"), "class_size", "n_links",
        (F.col(ROW) == F.col(f"_stays.{ROW}")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one per class, with the columns of docs, whatever they are
    called. Nulls, ties, repeated rows and empty tables are treated as `near_dedup` says."""
    stored = table(numbered(docs), "near")
    at = stored.select(F.struct(F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.col(ROW).alias("row")).alias("_at"), F.col(text_col).alias("_text"))
    kept = near_dedup(at, "_at", "_text").filter("kept").select(F.col("_at.row").alias(ROW))
    return stored.join(kept, ROW, "left_semi").select(*docs.columns)
