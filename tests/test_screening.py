"""The kernel against a plain statement of the formula; the join against every pair."""

import random
import string

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions.name_pairs import close_pairs_kernel
from ledgerlens.functions.similarity import jaro_winkler_kernel
from ledgerlens.operators import screening
from ledgerlens.operators.screening import Commonness, _characters, candidate_pairs, meetings, screen, top_hits

KERNEL = jaro_winkler_kernel()


def plain(a, b):
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [c for c, u in zip(b, used) if u]
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abcé 漢😀", max_size=12), st.text("abcé 漢😀", max_size=12)),
                min_size=1, max_size=30))
def test_kernel_equals_the_formula(pairs):
    got = KERNEL([a for a, _ in pairs], [b for _, b in pairs])
    assert got == pytest.approx([plain(a, b) for a, b in pairs], abs=1e-12)


def test_known_pairs():
    scores = KERNEL(
        ["nikolai volkov", "tariq khan", "james johnson", "chen sokolov", "martha", "dixon"],
        ["nykolai volkov", "tariq kha", "boris volkov", "chen sokolov", "marhta", "dicksonx"],
    )
    assert scores[0] > 0.9 and scores[1] > 0.9 and scores[2] < 0.7 and scores[3] == 1.0
    assert scores[4] == pytest.approx(0.9611111, abs=1e-6)
    assert scores[5] == pytest.approx(0.8133333, abs=1e-6)


def test_a_very_long_name_does_not_disturb_its_batch():
    long = "x" * 50_000 + "y"
    got = KERNEL(["ab", long, "abc"], ["ab", long, "abd"])
    assert list(got[:2]) == [1.0, 1.0] and got[2] == pytest.approx(plain("abc", "abd"))


def test_characters_number_repeats_and_split_code_points(spark):
    df = spark.createDataFrame([("anna",), ("é😀é",)], "n string")
    rows = [sorted(c[3:] for c in r[0]) for r in df.select(_characters(F.col("n"))).collect()]
    assert rows == [["a1", "a2", "n1", "n2"], sorted(["é1", "é2", "😀1"])]


def names(seed, n):
    rng = random.Random(seed)
    first = ["nikolai", "tariq", "chen", "boris", "maria", "jo", "wei", "li", "alexandrina"]
    last = ["volkov", "khan", "sokolov", "johnson", "garcia", "ng", "x", "montgomery-smith"]
    made = set()
    while len(made) < n:
        name = f"{rng.choice(first)} {rng.choice(last)}"
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(name))
            edit = rng.randrange(4)
            if edit == 0:
                name = name[:i] + name[i + 1:]
            elif edit == 1:
                name = name[:i] + rng.choice(string.ascii_lowercase + "é ") + name[i:]
            elif edit == 2:
                name = name[:i] + name[i:i + 2][::-1] + name[i + 2:]
            else:
                name = name[:i] + rng.choice("aeiou") + name[i + 1:]
        if name:
            made.add(name)
    return sorted(made)


@pytest.mark.parametrize("threshold", [0.97, 0.90, 0.84, 0.80, 0.7, 0.45])
@pytest.mark.parametrize("broadcast, split", [(64_000_000, 2_000), (64_000_000, 0), (0, 50)])
def test_no_pair_at_or_above_the_threshold_is_lost(spark, threshold, broadcast, split):
    left = names(1, 250) + ["a", "aa", "ab", "q", "w" * 90]
    right = names(2, 120) + ["a", "ba", "w" * 60]
    pairs = candidate_pairs(
        spark.createDataFrame([(n,) for n in left], "name_key string"),
        spark.createDataFrame([(n,) for n in right], "listed_key string"),
        threshold, broadcast, split,
    ).collect()
    found = {(r["name_key"], r["listed_key"]) for r in pairs}
    assert len(found) == len(pairs), "a pair came twice"
    every = [(a, b) for a in left for b in right]
    scores = KERNEL([a for a, _ in every], [b for _, b in every])
    wanted = {p for p, s in zip(every, scores) if s >= threshold}
    assert wanted <= found
    if threshold >= 0.9:
        assert len(found) < len(every) / 4


def test_screen_picks_the_best_and_lowest_id(spark):
    dest = spark.createDataFrame(
        [("M1", "Nykolai Volkov", True), ("M2", "NIKOLAI VOLKOV", False), ("M3", "unrelated", False),
         ("M4", None, False), ("M5", "", False), ("M6", "Tariq Kha", True)],
        "name_dest string, dest_name string, seeded_hit boolean",
    )
    listed = spark.createDataFrame(
        [("WL-9", "Nikolai Volkov", "EU"), ("WL-2", "nikolai volkov", "UN"),
         ("WL-5", "Tariq Khan", "SDN"), ("WL-4", "Tariq Khat", "EU")],
        "entity_id string, name string, program string",
    )
    hits = {r["name_dest"]: r for r in screen(dest, listed).collect()}
    assert set(hits) == {"M1", "M2", "M6"}
    assert (hits["M2"]["watchlist_entity"], hits["M2"]["match_score"]) == ("WL-2", 1.0)
    assert hits["M1"]["program"] == "UN"
    # Both entries score alike; the lower id wins.
    assert hits["M6"]["watchlist_entity"] == "WL-4"
    assert [r["name_dest"] for r in top_hits(screen(dest, listed), 2).collect()] == ["M2", "M6"]


def test_a_score_equal_to_the_threshold_is_a_hit(spark):
    dest = spark.createDataFrame([("M1", "abcdefghij", True)],
                                 "name_dest string, dest_name string, seeded_hit boolean")
    listed = spark.createDataFrame([("W", "abcdefghij", "P")],
                                   "entity_id string, name string, program string")
    assert screen(dest, listed, threshold=1.0).count() == 1
    with pytest.raises(ValueError):
        screen(dest, listed, threshold=0)


def test_commonness_is_measured_on_both_sides(spark):
    frames = [spark.createDataFrame([(n,) for n in rows], "name_key string") for rows in (["aab", "ac", "a"], ["bb", "zz z", ""])]
    common = Commonness.measure(*frames)
    assert common.alphabet[0] == "a" and set(common.alphabet) == set("abcz ")
    ranks = [dict(zip(common.alphabet, of)) for of in common.ranks]
    # Held by more names, ranked higher; what no name holds is not ranked.
    assert ranks[0]["a"] > ranks[0]["b"] > ranks[1]["a"] and ranks[2]["a"] == 0 < ranks[2]["z"]
    assert Commonness.measure(frames[0].limit(0)).alphabet == ""


def test_few_of_a_hundred_thousand_by_ten_thousand_names_meet(spark):
    """Names of two words drawn from skewed letters, as real ones are."""
    from pyspark.sql import functions as F

    def made(n, salt):
        # Letters about as often as in English words.
        pool = "e" * 12 + "a" * 8 + "t" * 8 + "i" * 7 + "n" * 7 + "o" * 7 + "s" * 6 + "r" * 6 + "h" * 5 + "l" * 5 + "dduucccmmffppggwwybvkkjxqz"
        digest = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
        word = lambda at, size: F.concat_ws("", F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.substring(
            F.lit(pool), (F.conv(F.substring(digest, (at + 2 * i).cast("int"), F.lit(2)), 16, 10) % len(pool)).cast("int") + 1, F.lit(1))))
        size = (F.col("id") % 5).cast("int")
        return spark.range(n).select(F.concat(word(F.lit(1), size + 4), F.lit(" "), word(F.lit(31), 9 - size)).alias("key")).distinct()

    names, listed = made(100_000, "n").toDF("name_key"), made(10_000, "l").toDF("listed_key")
    share = meetings(names, listed).count() / (names.count() * listed.count())
    assert share <= 0.02, share


def test_a_pair_needs_the_characters_its_own_start_demands(spark):
    """14 of 16 and 19 characters are enough for four common leading ones, not for one."""
    listed, name = "abcdefghijklmnop", "acbdefghijklmn12345"
    frames = [spark.createDataFrame([(n,)], f"{side}_key string") for n, side in ((name, "name"), (listed, "listed"))]
    assert plain(name, listed) < 0.9 and candidate_pairs(*frames).count() == 0
    close = spark.createDataFrame([("abcdgefhijklmn12345",)], "name_key string")
    assert candidate_pairs(close, frames[1], 0.9).count() == 1


@settings(max_examples=60, deadline=None)
@given(st.sampled_from(["ab", "abcdefgh", "abcé 漢😀"]).flatmap(lambda letters: st.tuples(*[
           st.lists(st.text(letters, max_size=20), max_size=40, unique=True)] * 2)),
       st.sampled_from([0.97, 0.85, 0.7, 0.45]), st.sampled_from([0, 1, 10]))
def test_the_pairs_of_two_blocks_are_those_that_reach_the_threshold(sides, threshold, split):
    found = [(sides[0][i], sides[1][j]) for i, j in block_pairs(threshold, split, *sides)]
    assert len(found) == len(set(found))
    every = [(a, b) for a in sides[0] for b in sides[1]]
    scores = dict(zip(every, KERNEL([a for a, _ in every], [b for _, b in every])))
    assert {p for p, s in scores.items() if s >= threshold} <= set(found)
    assert all(scores[p] >= threshold - 1e-6 for p in found)


def block_pairs(threshold, split, left, right, tally=None):
    for i, j in close_pairs_kernel(threshold, split, tally)(left, right):
        yield from zip(i.tolist(), j.tolist())


def test_few_of_two_blocks_of_made_up_names_meet():
    rng = random.Random(3)
    made = sorted({" ".join("".join(rng.choices("eeeeaaatttiinnooossrrhhlldducmfpgwybvk", k=k)) for k in (7, 8)) for _ in range(12_000)})
    rng.shuffle(made)
    met = {}
    list(block_pairs(0.9, 10, made[:8_000], made[8_000:], met))
    assert 0 < met["met"] <= 0.05 * 8_000 * (len(made) - 8_000), met


def test_long_names_are_told_by_the_characters_they_share():
    rng = random.Random(9)
    base = ["".join(rng.choices("abcdefghijklmnop", k=k)) for k in (250, 290, 330) for _ in range(4)]
    left, right = ([t[:p] + end + t[p + 5:] for t in base for p in (30, 200)] for end in ("", "qrstu"))
    found = set(block_pairs(0.85, 10, left, right))
    every = [(i, j) for i in range(len(left)) for j in range(len(right))]
    scores = KERNEL([left[i] for i, _ in every], [right[j] for _, j in every])
    wanted = {p for p, s in zip(every, scores) if s >= 0.85}
    assert len(wanted) >= 24 and wanted <= found


def test_names_that_are_all_alike_come_in_parts():
    left, right = ([f"customer {k:07d}{end}" for k in range(2_000)] for end in ("", "x"))
    sizes = [len(i) for i, _ in close_pairs_kernel(0.85, 10)(left, right)]
    assert sum(sizes) == 4_000_000 and max(sizes) <= 1_100_000


def test_the_names_are_shuffled_and_not_their_keys(spark, monkeypatch):
    """Disk grows with the names times the blocks of the list, not with the keys of each name."""
    monkeypatch.setattr(screening, "BLOCK_NAMES", 100)
    left, right = names(1, 250), names(2, 120)
    pairs = candidate_pairs(
        spark.createDataFrame([(n,) for n in left], "name_key string"),
        spark.createDataFrame([(n,) for n in right], "listed_key string"), 0.85, 0)
    found = {tuple(r) for r in pairs.collect()}
    every = [(a, b) for a in left for b in right]
    assert found >= {p for p, s in zip(every, KERNEL([a for a, _ in every], [b for _, b in every])) if s >= 0.85}

    def records(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return records(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return records(node.plan())
        metric = node.metrics().get("shuffleRecordsWritten")
        own = metric.get().value() if metric.isDefined() else 0
        return own + sum(records(node.children().apply(k)) for k in range(node.children().size()))

    # 3 blocks by 2 blocks.
    assert records(pairs._jdf.queryExecution().executedPlan()) == 2 * len(left) + 3 * len(right)
