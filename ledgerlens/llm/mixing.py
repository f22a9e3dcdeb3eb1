"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets: sources take weights by rank and share `share` times all words; what exceeds
`repeats` times a source's own words is reshared by weight until nothing does. That is a water
level over the ratios cap / weight, so it is found in one pass over the sources.

Apportionment: the mix is cut into equal blocks of words, `SHARD_BLOCKS` to a shard, or more
where the smallest target would have under `LEAST_BLOCKS` of them: no source rounds to nothing.
The seats of each shard go to the sources by highest quotients target / (2k + 1), cumulatively,
so that what one shard rounds off the next one makes up.

Selection: a source's documents lie in a seeded order, and its stream is cut into blocks. The
quota is served by consecutive blocks from a seeded one on, round the end, at most `repeats`
times. The words taken of a document are then plain arithmetic on its place in the stream.

Places are prefix sums in two steps: within one of 4096 ranges of the seeded order, and over
the ranges; a source that holds a third of all rows is spread over all of them. Only tables
with a row per source (or source and range) meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import ROW, SPACED_WORD, numbered, table, whole

WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
SHARD_BLOCKS, SHARD_WORDS, LEAST_BLOCKS = 1 << 16, 1 << 30, 100
SEED = "mix"


def _drawn(*parts: Column) -> Column:
    """A seeded draw as 32 hex digits."""
    return F.md5(F.concat_ws("|", F.lit(SEED), *parts))


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, row_col: str | None = None) -> DataFrame:
    """id, source key ("s" and the source, or "n" for null), words, place in the seeded order."""
    return docs.select(
        F.col(id_col).alias("_id"),
        (F.col(row_col) if row_col else F.lit(0).cast("long")).alias("_row"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("_key"),
        F.regexp_count(whole(text_col), F.lit(SPACED_WORD)).cast("long").alias("_size"),
        _drawn(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_draw"),
    ).withColumn("_range", F.substring("_draw", 1, 3))


def targets(sources: DataFrame) -> DataFrame:
    """Sources (_key, _words) with rank by source (null last), and target words."""
    everything = Window.partitionBy(F.lit(0))
    ranked = sources.withColumn(
        "_rank", F.row_number().over(everything.orderBy(F.col("_key") == "n", "_key"))
    ).select(
        "*",
        F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("_rank") - 1, F.lit(len(WEIGHTS))) + 1)
        .cast("double").alias("_weight"),
        (F.col("_words") * REPEATS).cast("double").alias("_cap"),
        (F.sum("_words").over(everything) * SHARE).alias("_total"),
    )
    poorest = everything.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    level = ranked.withColumn(
        "_level",
        (F.col("_total") - F.coalesce(F.sum("_cap").over(poorest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("_weight").over(poorest.rowsBetween(0, Window.unboundedFollowing)),
    ).withColumn("_full", F.col("_cap") <= F.col("_level") * F.col("_weight"))
    # Past the first source that is not full the level only falls.
    water = F.max(F.when(~F.col("_full"), F.col("_level"))).over(everything)
    return level.withColumn("_water", water).select(
        "_key", "_words", "_rank", "_total",
        F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_water") * F.col("_weight")).alias("_target"),
    )


def apportion(weighted: DataFrame, group: str, item: str, weight: str, seats: str) -> DataFrame:
    """Sainte-Lague quotas of `seats` per group: the highest quotients weight / (2k + 1).

    Rounding the ideal shares gives the quotients above a common divisor; at most half as many
    seats as there are items are then missing or too many, and only those are dealt with one
    by one, in order of their quotients. Ties go to the smaller item. Without any weight
    nobody gets a seat.
    """
    of_group = Window.partitionBy(group)
    rounded = weighted.withColumn("_sum", F.sum(weight).over(of_group)).withColumn(
        "_base",
        F.coalesce(F.floor(F.try_divide(F.col(weight) * F.col(seats), F.col("_sum")) + 0.5), F.lit(0)).cast("long"))
    rounded = rounded.withColumn(
        "_off", F.when(F.col("_sum") > 0, F.col(seats) - F.sum("_base").over(of_group)).otherwise(F.lit(0)))
    tried = rounded.filter(F.col("_off") != 0).select(
        group, item, "_off", F.col(weight).alias("_w"), "_base",
        F.explode(F.sequence(F.lit(0), (F.abs("_off") - 1).cast("int"))).alias("_i"),
    ).withColumn("_k", F.when(F.col("_off") > 0, F.col("_base") + F.col("_i")).otherwise(F.col("_base") - 1 - F.col("_i")))
    tried = tried.filter(F.col("_k") >= 0).withColumn("_quotient", F.col("_w") / (2 * F.col("_k") + 1))
    best = of_group.orderBy(
        F.when(F.col("_off") > 0, -F.col("_quotient")).otherwise(F.col("_quotient")),
        F.when(F.col("_off") > 0, F.col(item)).otherwise(-F.col(item)), "_k")
    moved = tried.withColumn("_nth", F.row_number().over(best)).filter(F.col("_nth") <= F.abs("_off")).groupBy(group, item).agg(
        F.sum(F.signum("_off")).cast("long").alias("_moved"))
    return rounded.join(moved, [group, item], "left").withColumn(
        "quota", F.col("_base") + F.coalesce("_moved", F.lit(0))).drop("_sum", "_base", "_off", "_moved")


def shard_quotas(sources: DataFrame) -> DataFrame:
    """Blocks of each source in each shard, of what `targets` gives: _key, _shard, _block
    (words in a block), _blocks."""
    shards = F.greatest(F.lit(1), F.ceil(F.col("_total") / SHARD_WORDS)).cast("int")
    smallest = F.min(F.when(F.col("_target") > 0, F.col("_target"))).over(Window.partitionBy(F.lit(0)))
    fine = F.coalesce(F.floor(smallest / LEAST_BLOCKS), F.lit(1))
    cut = sources.withColumn("_shards", shards).withColumn(
        "_block", F.greatest(F.lit(1), F.least(fine, F.ceil(F.col("_total") / (F.col("_shards") * SHARD_BLOCKS)))).cast("long")
    ).withColumn("_all", F.round(F.col("_total") / F.col("_block")).cast("long"))
    each = cut.withColumn("_shard", F.explode(F.sequence(F.lit(1), F.col("_shards")))).withColumn(
        "_seats", F.when(F.col("_shard") == F.col("_shards"), F.col("_all")).otherwise(
            F.floor(F.col("_all") * (F.col("_shard") / F.col("_shards")))).cast("long"))
    so_far = apportion(each, "_shard", "_rank", "_target", "_seats")
    before = F.lag("quota", 1, 0).over(Window.partitionBy("_key").orderBy("_shard"))
    return so_far.withColumn("_blocks", F.col("quota") - before)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        row_col: str | None = None) -> DataFrame:
    """One row per row of docs: id, size, source_size, target, taken.

    size counts words between ASCII white space (null text: 0); a null source is one source,
    ranked last. taken is the number of words that the mix takes of the document, at most
    twice its size; a source's taken words are its quota of blocks, so they differ from its
    target by about a block (total / 65536 or a hundredth of the smallest target, whichever is
    less, but at least a word). Rows repeated with one id are
    told apart by `row_col`, if there is one, which then comes back too. Empty tables give none.
    """
    rows = table(sizes(docs, id_col, text_col, source_col, row_col), "sizes")
    ranges = table(rows.groupBy("_key", "_range").agg(F.sum("_size").alias("_in_range")), "ranges")
    # Small tables are written between the steps, so that each is planned on its own.
    sources = table(targets(ranges.groupBy("_key").agg(F.sum("_in_range").alias("_words"))), "targets")
    plan = shard_quotas(sources).groupBy("_key", "_words", "_target", "_block").agg(F.sum("_blocks").alias("_quota"))
    length = F.least(F.col("_quota") * F.col("_block"), F.col("_words") * REPEATS)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_words") / F.col("_block")))
    # 32 bits of the draw, and 60 where a source has more blocks than that.
    digits = F.when(blocks > 1 << 32, 15).otherwise(8)
    first_block = F.pmod(F.conv(F.substr(_drawn(F.lit("start"), F.col("_key")), F.lit(1), digits), 16, 10).cast("long"), blocks)
    plan = table(plan.select(
        "_key", "_words", "_target", length.alias("_length"), (first_block * F.col("_block")).alias("_start")), "plan")
    starts = ranges.select(
        "_key", "_range",
        F.coalesce(F.sum("_in_range").over(
            Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    ).join(plan, "_key")
    ordered = Window.partitionBy("_key", "_range").orderBy("_draw", "_id", "_size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_within", F.coalesce(F.sum("_size").over(ordered), F.lit(0))).join(starts, ["_key", "_range"])
    at, to = F.col("_before") + F.col("_within"), F.col("_before") + F.col("_within") + F.col("_size")
    passes = F.coalesce(F.floor(F.try_divide(F.col("_length"), F.col("_words"))), F.lit(0))
    end = F.col("_start") + F.col("_length") - passes * F.col("_words")
    over = F.greatest(F.lit(0), F.least(to, F.least(end, F.col("_words"))) - F.greatest(at, F.col("_start")))
    wrapped = F.greatest(F.lit(0), F.least(to, end - F.col("_words")) - at)
    return placed.select(
        F.col("_id").alias(id_col), *([F.col("_row").alias(row_col)] if row_col else []), F.col("_size").alias("size"), F.col("_words").alias("source_size"),
        F.col("_target").alias("target"), (passes * F.col("_size") + over + wrapped).cast("long").alias("taken"))


def repeat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs, each as many times as the mix passes over it; a pass that takes part
    of a document counts as one, which concerns two documents a source at most. The columns
    are those of docs. Null texts and texts without words take no words and go; a null source is
    one source; equal rows count each; an empty table gives an empty one."""
    stored = table(numbered(docs), "mix")
    taken = mix(stored, id_col, text_col, source_col, ROW).filter("taken > 0").select(
        ROW, F.ceil(F.col("taken") / F.col("size")).cast("int").alias("_copies"))
    joined = stored.join(taken, ROW)
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)
