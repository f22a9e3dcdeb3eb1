"""Fuzzy name screening as a blocked, lossless similarity join.

A name is never compared with the whole list. If two names score at least the threshold,
arithmetic on the Jaro-Winkler formula forces them to share so many characters that they
must also share their few rarest ones. Names and list entries are keyed by those characters
and meet in an equi-join. Which characters are rare, and how many names could meet how many
entries, is measured on the names and the list at hand; the latter decides how many characters
a key has. Of the pairs that meet, those that can share enough characters at all, which a
comparison of two 64-bit masks inside the join tells, are scored. No bound below is a heuristic:
each follows from the formula, so every pair at or above the threshold is found, whatever was
measured.

With lengths l and w and m matched characters, Jaro is at most (m/l + m/w + 1)/3, and the
Winkler boost adds at most 0.1 * p * (1 - jaro) for p common leading characters. Hence a
score of t needs jaro >= (t - 0.1p)/(1 - 0.1p) and m >= S*l*w/(l + w) with
S = 3*jaro - 1. Pairs fall in a class for each p from 0 to 4, whose key holds the first p
characters: the less a class demands of the rest, the fewer pairs agree on its start.

Whoever must share m characters also shares the k rarest of them, and those lie within the
first l - m + k of one name and the first w - m + k of the other. A key is one choice of k
characters from these. Longer keys are more rows, and let fewer pairs meet; k is chosen for
each class and pair of lengths, so that both grow with the names far slower than their pairs.

A list whose keys are small is broadcast with them. Else the keys of all names are never stored:
both sides are dealt in blocks, each block of names meets each block of the list in one task, and
the keys are made there (`functions/name_pairs.py`). What is shuffled is each name once for each
block of the list, and each entry once for each block of names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.session import scratch_path
from ledgerlens.functions.name_pairs import close_pairs_kernel
from ledgerlens.functions.similarity import PREFIX_LENGTH, PREFIX_SCALE, score_pairs

THRESHOLD = 0.90
# The keyed list is broadcast up to this size; beyond it both sides are dealt in blocks.
BROADCAST_BYTES = 64 * 1024 * 1024
# How many pairs may meet for each row of keys before longer keys are worth their further rows,
# how many characters a key has at most, and from how many different ones, as good as, names draw.
SPLIT_PAIRS, MOST_CHARACTERS, DRAWN_FROM = 10, 6, 32
# Most keys of one name for one pair of lengths, where a shorter key leaves a choice.
MOST_KEYS = 1_000
# Rows of keys and pairs that meet, by their estimate, in one task of the join; most tasks.
TASK_ROWS, TASK_PAIRS, MOST_TASKS = 300_000, 30_000_000, 20_000
# Names and characters of them in a block, about; fewest pairs for which a block is split so that
# all cores have some; pairs in an Arrow batch.
BLOCK_NAMES, BLOCK_CHARACTERS, SPLIT_BLOCK, BATCH_PAIRS = 50_000, 2_000_000, 50_000_000, 50_000
# Characters whose commonness is measured; all others count as rarest.
ALPHABET, REPEATS = 64, 3
# Of those, the characters with two bits of their own in a mask.
OWN_BITS = 26

_EPSILON = 1e-9


@dataclass(frozen=True)
class Commonness:
    """Characters, most common first, and the rank of the first, second and third occurrence
    of each in a name: the higher, the more names hold it. Only the speed depends on it, since
    every fixed order of the characters gives the same pairs."""

    alphabet: str
    ranks: tuple[tuple[int, ...], ...]

    @classmethod
    def measure(cls, *names: DataFrame) -> Commonness:
        """Counted over all the names, each of which counts a character once; what reaches
        the driver is a row for each of the most common characters."""
        counted = None
        for df in names:
            chars = df.select(F.col(df.columns[0]).alias("name")).select(
                "name", F.explode(F.array_distinct(F.split("name", ""))).alias("char"))
            times = F.length("name") - F.length(F.replace("name", F.col("char"), F.lit("")))
            part = chars.groupBy("char").agg(
                *[F.count_if(times >= k).alias(f"n{k}") for k in range(1, REPEATS + 1)])
            counted = part if counted is None else counted.unionByName(part)
        sums = [F.sum(f"n{k}").alias(f"n{k}") for k in range(1, REPEATS + 1)]
        top = counted.where("char <> ''").groupBy("char").agg(*sums).orderBy(F.desc("n1"), "char").limit(ALPHABET).collect()
        every = sorted((r[f"n{k}"], -i, -k) for i, r in enumerate(top) for k in range(1, REPEATS + 1) if r[f"n{k}"])
        place = {(-i, -k): rank + 1 for rank, (_, i, k) in enumerate(every)}
        return cls("".join(r["char"] for r in top), tuple(
            tuple(place.get((i, k), 0) for i in range(len(top))) for k in range(1, REPEATS + 1)))

    def rank(self, char: Column, repeat: Column) -> Column:
        """0 for what is not measured."""
        place = F.instr(F.lit(self.alphabet), char)
        found = F.lit(0)
        for k, ranks in enumerate(self.ranks, 1):
            known = F.element_at(F.array(*map(F.lit, ranks)), place) if ranks else F.lit(0)
            found = F.when((place > 0) & (repeat == k), known).otherwise(found)
        return found


LETTERS = Commonness(" eaionrtlsudhcmgpybkwfvzjxq", tuple(
    tuple(max(3 * (27 - i) - 24 * k, 0) for i in range(27)) for k in range(REPEATS)))


def _required_share(threshold: float) -> list[float]:
    """S of the module note for each class, by the common leading characters."""
    boosts = [p * PREFIX_SCALE for p in range(PREFIX_LENGTH + 1)]
    return [3 * (threshold - boost) / (1 - boost) - 1 for boost in boosts]


def _bounds_length(share: float) -> bool:
    """Whether the class bounds a partner's length closely enough to make it part of the key.

    m <= min(l, w) gives min/max >= S - 1; for a looser bound the lengths are left to the
    conditions of the join.
    """
    return share - 1 >= 0.1


def _need(share: float, length: int, other: int) -> int:
    """Least number of shared characters for two lengths; a positive score needs one."""
    return max(1, math.ceil(share * length * other / (length + other) - _EPSILON))


def _overlap(share: float, length: Column, other: Column) -> Column:
    """The same as a column."""
    exact = F.lit(share) * length * other / (length + other)
    return F.greatest(F.ceil(exact - F.lit(_EPSILON)), F.lit(1)).cast("int")


def _characters(name: Column, common: Commonness = LETTERS) -> Column:
    """The characters of a name as an array, rarest first, repeats numbered apart.

    `anna` holds a1, n1, a2, n2: two names share as many elements as characters.
    """
    def numbered(char: Column) -> Column:
        times = F.length(name) - F.length(F.replace(name, char, F.lit("")))
        return F.transform(
            F.sequence(F.lit(1), times),
            lambda k: F.concat(
                F.lpad(common.rank(char, k).cast("string"), 3, "0"), char, k.cast("string")
            ),
        )

    # Declared never null: the join below would otherwise infer a not-null filter on it and
    # push the whole computation down to every row the names come from.
    return F.coalesce(
        F.array_sort(F.flatten(F.transform(F.array_distinct(F.split(name, "")), numbered))),
        F.array().cast("array<string>"),
    )


def _mask(chars: Column, common: Commonness) -> Column:
    """The characters as 64 bits: one each for the first two of every common character, the
    remaining ones shared by the rest.

    Two names share at most as many characters as their masks share bits, plus those that
    found their bit taken in the name that has fewer of them.
    """
    def bit(char: Column) -> Column:
        place = F.instr(F.lit(common.alphabet[:OWN_BITS]), F.substring(char, 4, 1))
        repeat = F.substring(char, 5, 10).cast("int")
        own = 2 * OWN_BITS
        return F.when((place > 0) & (repeat <= 2), (place - 1) * 2 + repeat - 1).otherwise(
            F.pmod(F.hash(char), F.lit(64 - own)) + own
        )

    # Never null, for the same reason as the characters.
    return F.coalesce(
        F.aggregate(
            chars, F.lit(0).cast("bigint"),
            lambda mask, char: mask.bitwiseOR(
                F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(char))
            ),
        ),
        F.lit(0).cast("bigint"),
    )


@dataclass(frozen=True)
class Cell:
    """A class and a pair of lengths (0 and 0: any), the characters its pairs must share at
    least, and how many of them a key has."""

    cls: int
    len_name: int
    len_listed: int
    need: int
    depth: int


def _choices(length: int, need: int, depth: int) -> int:
    return math.comb(length - need + depth, depth)


def _depth(length: int, other: int, need: int, rows: int, others: int, pairs: int, split_pairs: int) -> int:
    """The length of a key for which its rows and the pairs expected to meet cost least."""
    def cost(k: int) -> float:
        mine, theirs = _choices(length, need, k), _choices(other, need, k)
        meet = pairs * min(1.0, mine * theirs / math.comb(DRAWN_FROM, k))
        return meet + split_pairs * (mine * rows + theirs * others)

    deepest = min(need, MOST_CHARACTERS)
    fit = [k for k in range(1, deepest + 1) if k == 1 or max(_choices(length, need, k), _choices(other, need, k)) <= MOST_KEYS]
    return min(fit, key=cost)


def _by_start(df: DataFrame, key: str, suffix: str) -> DataFrame:
    """For each class the number of names by their first characters and length."""
    length = F.length(key)
    return df.select(
        F.explode(F.sequence(F.lit(0), F.least(F.lit(PREFIX_LENGTH), length))).alias("cls"), F.col(key).alias("key"),
    ).groupBy("cls", F.expr("substring(key, 1, cls)").alias("head"), F.length("key").alias(f"len_{suffix}")).agg(
        F.count("*").alias(f"n_{suffix}"))


def _cells(names: DataFrame, listed: DataFrame, threshold: float, split_pairs: int) -> tuple[list[Cell], float, float, int]:
    """The cells whose pairs can reach the threshold; about how many key rows they make, how
    many pairs meet, and the bytes of the keyed list. What is collected has a row for each class
    and pair of lengths that occur together."""
    share = _required_share(threshold)
    demand = F.lit(0)
    for cls, s in enumerate(share):
        demand = F.when(F.col("cls") == cls, _overlap(s, F.col("len_name"), F.col("len_listed"))).otherwise(demand)
    sides = _by_start(names, "name_key", "name").where("len_name > 0"), _by_start(listed, "listed_key", "listed").where("len_listed > 0")
    found = (
        sides[0].join(sides[1], ["cls", "head"])
        .where(demand <= F.least("len_name", "len_listed"))
        .groupBy("cls", "len_name", "len_listed")
        .agg(*[F.sum(n).alias(n) for n in ("n_name", "n_listed")], F.sum(F.col("n_name") * F.col("n_listed")).alias("pairs"))
        .collect()
    )
    cells, rows, pairs, size = [], 0.0, 0.0, 0.0
    loose = set()
    for r in found:
        s, l, w = share[r["cls"]], r["len_name"], r["len_listed"]
        if _bounds_length(s):
            need = _need(s, l, w)
            k = _depth(l, w, need, r["n_name"], r["n_listed"], r["pairs"], split_pairs)
            cells.append(Cell(r["cls"], l, w, need, k))
            mine, theirs = _choices(l, need, k), _choices(w, need, k)
        else:
            # The least demanding partner decides how many keys there are.
            loose.add(r["cls"])
            k, mine, theirs = 1, l, w
        rows += mine * r["n_name"] + theirs * r["n_listed"]
        pairs += r["pairs"] * min(1.0, mine * theirs / math.comb(DRAWN_FROM, k))
        size += theirs * r["n_listed"] * (96.0 + 4 * w)
    cells += [Cell(cls, 0, 0, 1, 1) for cls in sorted(loose)]
    return cells, rows, pairs, int(size)


def key_maker(cells: list[Cell], side: str, share: list[float], common: Commonness):
    """A function of three arrays (names, their characters, masks) to the keys of each, as
    structs of a list: `cls_key`, a 64-bit hash of the cell, the leading characters and those of
    the key; `need` of the cell; and `before`, the bits of a mask that belong to one character
    alone and come before the last of the key, its own excepted."""
    # Shipped by value, as the kernel of the similarity is: nothing below names this package.
    own_letters, own_repeats, at_once = common.alphabet[:OWN_BITS], 2, 500_000

    def hash_of(text: str) -> int:
        return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")

    plan: dict[int, list[tuple[int, int, int, int, int]]] = {}
    # For a class that does not bound lengths, a partner of one character demands least.
    loose: list[tuple[int, int, float]] = []
    for c in cells:
        cell = hash_of(f"{c.cls} {c.len_name} {c.len_listed}")
        length = c.len_name if side == "name" else c.len_listed
        if length:
            plan.setdefault(length, []).append((c.cls, cell, c.need, c.depth, length - c.need + c.depth))
        else:
            loose.append((c.cls, cell, share[c.cls]))

    def of_length(length: int):
        for cls, cell, s in loose:
            if length >= cls:
                yield cls, cell, 1, 1, length + 1 - max(1, math.ceil(s * length / (length + 1) - 1e-9))
        yield from plan.get(length, ())

    def make(names: pa.Array, chars: pa.Array, masks: pa.Array) -> pa.Array:
        coded = chars.values.slice(chars.offsets[0].as_py(), chars.offsets[-1].as_py() - chars.offsets[0].as_py()).dictionary_encode()
        codes, offsets = coded.indices.to_numpy(zero_copy_only=False), np.asarray(chars.offsets) - chars.offsets[0].as_py()
        known = coded.dictionary.to_pylist()
        hashes = np.array([hash_of(c[3:]) for c in known], np.uint64)
        own = np.array([
            1 << (own_letters.index(c[3]) * own_repeats + int(c[4:]) - 1) if c[3] in own_letters and int(c[4:]) <= own_repeats else 0
            for c in known], np.uint64)
        lengths, texts, mask = np.diff(offsets), names.to_pylist(), masks.to_numpy().view(np.uint64)
        parts = []
        for length in np.unique(lengths):
            of = list(of_length(int(length)))
            most = max((math.comb(window, depth) for *_, depth, window in of), default=1)
            every = np.flatnonzero(lengths == length)
            step = max(1, at_once // most)
            for at in range(0, len(every) if of else 0, step):
                rows = every[at:at + step]
                places = codes[offsets[rows][:, None] + np.arange(length)]
                bits, mixed = own[places], hashes[places]
                # The bits of all characters up to each place.
                upto = np.bitwise_or.accumulate(bits, axis=1) & mask[rows][:, None]
                for cls, cell, need, depth, window in of:
                    ways = np.array(list(combinations(range(window), depth)), np.int64)
                    head = np.array([hash_of(texts[r][:cls]) for r in rows], np.uint64) if cls else np.zeros(len(rows), np.uint64)
                    key = np.zeros((len(rows), len(ways)), np.uint64)
                    held = np.zeros_like(key)
                    for j in range(depth):
                        key += mixed[:, ways[:, j]]
                        held |= bits[:, ways[:, j]]
                    key += (head + np.uint64(cell))[:, None]
                    key ^= key >> np.uint64(29)
                    before = upto[:, ways[:, -1]] & ~held
                    parts.append((np.repeat(rows, len(ways)), key.ravel(), np.full(key.size, need, np.int32), before.ravel()))
        if not parts:
            parts = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint64))]
        row, key, need, before = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(row, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lengths)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
            [pa.array(key[order].view(np.int64)), pa.array(need[order]), pa.array(before[order].view(np.int64))], ["cls_key", "need", "before"]))

    return make


def _keyed(df: DataFrame, side: str, cells: list[Cell], share: list[float], common: Commonness, tasks: int) -> DataFrame:
    """A row for each key of a name or entry. The names are dealt out evenly first, however few
    files they came in."""
    # Declared so that the optimizer neither repeats the call nor moves a part of it into the generator.
    make = F.arrow_udf(
        key_maker(cells, side, share, common), "array<struct<cls_key:bigint,need:int,before:bigint>>").asNondeterministic()
    chars, mask = F.col(f"{side}_chars"), F.col(f"{side}_mask")
    profiled = (
        df.repartition(tasks).withColumn(f"{side}_chars", _characters(F.col(f"{side}_key"), common))
        .withColumn(f"{side}_mask", _mask(chars, common))
        .select(f"{side}_key", f"{side}_mask", (F.size(chars) - F.bit_count(mask)).alias(f"{side}_taken"), make(f"{side}_key", chars, mask).alias("keys"))
    )
    extra = ["need", "before"] if side == "listed" else []
    return profiled.select(f"{side}_key", f"{side}_mask", f"{side}_taken", F.inline("keys")).select(
        "cls_key", f"{side}_key", f"{side}_mask", f"{side}_taken", *extra)


def _positive(threshold: float) -> None:
    if threshold <= 0:
        raise ValueError("the threshold must be positive: a score of 0 matches everything")


def _sides(
    names: DataFrame, listed: DataFrame, threshold: float, broadcast_bytes: int, split_pairs: int,
) -> tuple[DataFrame, DataFrame, int]:
    """Both sides with their keys, dealt for the join, and the bytes of the keyed list."""
    _positive(threshold)
    share = _required_share(threshold)
    common = Commonness.measure(names.select("name_key"), listed.select("listed_key"))
    cells, rows, pairs, size = _cells(names, listed, threshold, split_pairs)
    spark = names.sparkSession
    tasks = min(MOST_TASKS, max(spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS), math.ceil(pairs / TASK_PAIRS)))
    probe = _keyed(names, "name", cells, share, common, tasks)
    index = _keyed(listed, "listed", cells, share, common, max(1, min(tasks, math.ceil(size / 2**24))))
    if size <= broadcast_bytes:
        return probe, F.broadcast(index), size
    # The keys are dealt by the rows and pairs expected of them, not by their bytes.
    return probe.repartition(tasks, "cls_key"), index.repartition(tasks, "cls_key").hint("shuffle_hash"), size


def meetings(
    names: DataFrame, listed: DataFrame, threshold: float = THRESHOLD,
    broadcast_bytes: int = BROADCAST_BYTES, split_pairs: int = SPLIT_PAIRS,
) -> DataFrame:
    """Names and entries that share a key: a row each time they meet. What is measured here
    (commonness of characters, names by their start and length) is counted over all names and
    entries."""
    probe, index, _ = _sides(names, listed, threshold, broadcast_bytes, split_pairs)
    return probe.join(index, "cls_key")


def _grid(names: tuple[int, int], listed: tuple[int, int], cores: int) -> tuple[int, int]:
    """Into how many blocks each side is dealt, by its names and characters."""
    parts = [max(1, math.ceil(n / BLOCK_NAMES), math.ceil(chars / BLOCK_CHARACTERS)) for n, chars in (names, listed)]
    while parts[0] * parts[1] < 3 * cores:
        sizes = names[0] / parts[0], listed[0] / parts[1]
        if sizes[0] * sizes[1] <= SPLIT_BLOCK:
            break
        parts[0 if sizes[0] >= sizes[1] else 1] *= 2
    return parts[0], parts[1]


def _block_pairs(names: DataFrame, listed: DataFrame, threshold: float, split_pairs: int) -> DataFrame:
    """The candidate pairs, found by joining each block of names with each block of the list.

    Only the names and entries are shuffled, once for each block of the other side; their keys
    live in the memory of a task. What a task holds is bounded by the size of its blocks, also
    where all names are alike.
    """
    spark = names.sparkSession

    def counted(df: DataFrame) -> tuple[int, int]:
        return tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.length(df.columns[0])), F.lit(0))).first())

    names, listed = names.select("name_key"), listed.select("listed_key")
    n_names, n_listed = _grid(counted(names), counted(listed), spark.sparkContext.defaultParallelism)

    def dealt(df: DataFrame, named: bool, parts: int, others: int) -> DataFrame:
        part = F.pmod(F.xxhash64(df.columns[0]), F.lit(parts))
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.select(F.col(df.columns[0]).alias("key"), part.alias("part"), other.alias("other")).select(
            (F.col("part") * F.lit(others) + F.col("other") if named else F.col("other") * F.lit(parts) + F.col("part")).cast("int").alias("cell"),
            F.lit(named).alias("named"), "key")

    kernel, at_once = close_pairs_kernel(threshold, split_pairs), BATCH_PAIRS

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        sides: tuple[list, list] = [], []
        for batch in batches:
            keys, named = batch.column("key"), batch.column("named")
            sides[0].append(keys.filter(named))
            sides[1].append(keys.filter(pc.invert(named)))
        left, right = (pa.concat_arrays(side) for side in sides)
        for i, j in kernel(left.to_pylist(), right.to_pylist()):
            for at in range(0, len(i), at_once):
                yield pa.RecordBatch.from_arrays(
                    [left.take(pa.array(i[at:at + at_once])), right.take(pa.array(j[at:at + at_once]))],
                    names=["name_key", "listed_key"])

    cells = dealt(names, True, n_names, n_listed).unionByName(dealt(listed, False, n_listed, n_names))
    # Each cell is a task, up to the most tasks.
    return cells.repartitionById(min(MOST_TASKS, n_names * n_listed), F.col("cell")).groupBy("cell").applyInArrow(
        close, "name_key string, listed_key string")


def candidate_pairs(
    names: DataFrame, listed: DataFrame, threshold: float = THRESHOLD,
    broadcast_bytes: int = BROADCAST_BYTES, split_pairs: int = SPLIT_PAIRS,
) -> DataFrame:
    """Every (name_key, listed_key) pair that can reach the threshold, each exactly once.

    `names` has distinct `name_key`, `listed` distinct `listed_key`.
    """
    _positive(threshold)
    if broadcast_bytes <= 0:
        return _block_pairs(names, listed, threshold, split_pairs)
    probe, index, size = _sides(names, listed, threshold, broadcast_bytes, split_pairs)
    if size > broadcast_bytes:
        return _block_pairs(names, listed, threshold, split_pairs)
    shared_at_most = F.bit_count(
        F.col("name_mask").bitwiseAND(F.col("listed_mask"))
    ) + F.least("name_taken", "listed_taken")
    # A pair may meet on several keys; where the masks tell that it shares an earlier character
    # than those of a key, it meets on a key with that one too. Two names whose hashes of keys
    # are equal by chance meet once more, and are told by the same conditions.
    earlier = F.col("name_mask").bitwiseAND(F.col("before")) != 0
    met = probe.join(index, "cls_key").where((shared_at_most >= F.col("need")) & ~earlier)
    share = _required_share(threshold)
    least = F.lit(1)
    for cls, s in enumerate(share):
        same = F.substring("name_key", 1, cls) == F.substring("listed_key", 1, cls)
        least = F.when(same if cls else F.lit(True), _overlap(s, F.length("name_key"), F.length("listed_key"))).otherwise(least)
    # The exact demand of each pair, by its own lengths and start. What passes on several keys
    # for the sake of characters that share a bit is kept once.
    return met.where(shared_at_most >= least).select("name_key", "listed_key").distinct()


def _staged(df: DataFrame, purpose: str) -> DataFrame:
    """Written once and read by each of the measurements and the join."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def best_matches(
    names: DataFrame, watchlist: DataFrame, threshold: float = THRESHOLD,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per distinct lower-cased name its best entry: `name_key, entity_id, program, score`.

    Equal scores go to the lowest entity id. List entries that differ only in case share a
    key, and the lowest id among them stands for it.
    """
    entries = _staged(
        watchlist.withColumn("listed_key", F.lower("name"))
        .filter(F.col("listed_key") != "")
        .groupBy("listed_key")
        .agg(F.min(F.struct("entity_id", "program")).alias("entry")), "listed",
    )
    pairs = candidate_pairs(_staged(names, "names"), entries.select("listed_key"), threshold, broadcast_bytes)
    scored = score_pairs(pairs, "name_key", "listed_key", threshold)
    return (
        scored.join(entries, "listed_key")
        .groupBy("name_key")
        .agg(
            F.min(
                F.struct(
                    (-F.col("score")).alias("rank"), F.col("entry.entity_id"),
                    F.col("entry.program"),
                )
            ).alias("best")
        )
        .select(
            "name_key", F.col("best.entity_id").alias("entity_id"),
            F.col("best.program").alias("program"), (-F.col("best.rank")).alias("score"),
        )
    )


def _keyed_names(dest_names: DataFrame) -> DataFrame:
    return dest_names.withColumn("name_key", F.lower("dest_name")).filter(
        F.col("name_key") != ""
    )


def match_names(
    dest_names: DataFrame, watchlist: DataFrame, threshold: float = THRESHOLD,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`best_matches` for the names of a destination table, each distinct name once."""
    names = _keyed_names(dest_names).select("name_key").distinct()
    return best_matches(names, watchlist, threshold, broadcast_bytes)


def attach_matches(dest_names: DataFrame, matches: DataFrame) -> DataFrame:
    """The destinations whose name has a match, with it.

    An inner equi-join on the name: a match table Spark knows to be small is broadcast, and
    otherwise a name carried by very many destinations is split by the skew join.
    """
    return _keyed_names(dest_names).join(matches, "name_key").select(
        "name_dest", "dest_name", "seeded_hit",
        F.col("entity_id").alias("watchlist_entity"),
        "program",
        F.round("score", 3).alias("match_score"),
    )


def screen(
    dest_names: DataFrame, watchlist: DataFrame, threshold: float = THRESHOLD,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Destinations whose beneficiary name matches a listed one, with the best match."""
    return attach_matches(
        dest_names, match_names(dest_names, watchlist, threshold, broadcast_bytes)
    )


def top_hits(hits: DataFrame, n: int = 10) -> DataFrame:
    """The highest-scoring hits; equal scores by destination."""
    return hits.orderBy(F.desc("match_score"), "name_dest").limit(n)
