"""Quality rules under weak supervision.

Every rule votes good, votes bad or abstains on a document. Expectation-maximisation over the
counts of vote patterns (at most 3 to the number of rules, whatever the corpus holds)
estimates how often each rule votes what on good and on bad documents, and the posterior
probability of being good replaces the demand that all rules pass. All of it is DataFrame
work: one narrow pass over the texts, one aggregation of patterns, and small aggregations
over the patterns for the rounds of the estimate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import SPACED_WORD, table, whole

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
ROUNDS, SMOOTHING, THRESHOLD = 10, 0.02, 0.5
# Frequent words of the corpus languages.
STOP_WORDS = {
    "en": "the and of to in a is that it for on was with as by",
    "de": "der die und das von zu mit den des dem ein eine ist im nicht auf",
    "fr": "de la le et les des un une du est que qui en dans pour",
    "es": "de la que el en y los se del las un por con una no",
}


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: a lambda over an array of one names it. A
    column of an inner select would be inlined into every place that uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated(trigrams: Column) -> Column:
    """Positions of words inside three-word windows that occur twice or more."""
    def covered(placed: Column) -> Column:
        def again(s: Column, i: Column) -> Column:
            before, after = F.get(placed, i - 1)["h"], F.get(placed, i + 1)["h"]
            return F.coalesce(s["h"] == before, F.lit(False)) | F.coalesce(s["h"] == after, F.lit(False))

        hits = F.transform(F.filter(placed, again), lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2))
        return F.size(F.array_distinct(F.flatten(hits))).cast("long")

    return _let(F.sort_array(F.transform(trigrams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)


def measures(text: Column) -> Column:
    """A struct of counts over the whole text, each array computed once.

    Windows of three words are compared by 64-bit hashes within one text. The sort that finds
    their places only runs where the hashes are not all different.
    """
    def of_words(words: Column) -> Column:
        three = F.slice(
            F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
            1, F.greatest(F.size(words) - 2, F.lit(0)))
        stop_hits = F.greatest(*[
            F.size(F.array_intersect(words, F.array(*map(F.lit, s.split())))) for s in STOP_WORDS.values()])
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            stop_hits.cast("long").alias("stop_hits"),
            _let(three, lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0).cast("long"))
                 .otherwise(_repeated(t))).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(SPACED_WORD)))
    return F.struct(
        _let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit(r"[!?]{2,}")).cast("long").alias("n_shouts"))


def votes(m: Column) -> Column:
    """The rules' votes on a struct of measures, one character each: + good, - bad, 0 abstains.

    A text without words gets no votes but the one on its length.
    """
    words, chars = F.greatest(m["w"]["n_words"], F.lit(1)), F.greatest(m["w"]["word_chars"], F.lit(1))
    lines = F.greatest(m["l"]["n_lines"], F.lit(1))

    def rule(measure: Column, good_to: float, bad_from: float) -> Column:
        vote = F.when(measure <= good_to, "+").when(measure >= bad_from, "-").otherwise("0")
        return F.when(m["w"]["n_words"] > 0, vote).otherwise("0")

    return F.concat(
        F.when(m["w"]["n_words"] < MIN_WORDS, "-").when(m["w"]["n_words"] >= 2 * MIN_WORDS, "+").otherwise("0"),
        rule(F.abs(m["w"]["word_chars"] / words - 6.5), 2.5, 4.5),
        rule(m["n_symbols"] / chars, 0.01, 0.08),
        rule(m["n_symbols"] / words, 0.05, 0.3),
        rule(m["l"]["n_dup_lines"] / lines, 0.1, 0.5),
        rule(m["w"]["n_repeat_words"] / words, 0.1, 0.4),
        rule(m["n_upper"] / chars, 0.1, 0.4),
        rule(m["n_shouts"] / words, 0.01, 0.2),
        rule(1 - m["w"]["n_distinct"] / words, 0.7, 0.9),
        rule(-m["w"]["stop_hits"] / F.least(words / 20, F.lit(5.0)), -0.6, -0.05),
    )


VOTES = "+0-"


def posterior(pattern: Column, model: dict) -> Column:
    """The probability of being good, given the votes: prior odds and a term a vote, looked up
    by rule and vote."""
    terms = F.array(*[F.lit(math.log(shares[v][0] / shares[v][1])) for shares in model["rules"] for v in VOTES])
    looked_up = F.transform(
        F.split(pattern, ""), lambda v, i: F.element_at(terms, (i * len(VOTES) + F.instr(F.lit(VOTES), v)).cast("int")))
    odds = F.aggregate(looked_up, F.lit(math.log(model["good"] / (1 - model["good"]))), lambda a, x: a + x)
    return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, rules: int) -> dict:
    """EM on (pattern, n). It starts from the meaning of the votes, a bad one counting more
    than a good one, and every share keeps a little of both classes, so the classes can't swap
    their meaning and no single vote decides alone. An empty table gives the starting shares."""
    start = {"+": (math.exp(0.6), 1.0), "0": (1.0, 1.0), "-": (math.exp(-3.0), 1.0)}
    model: dict = {"good": 0.5, "rules": [start] * rules}
    lean = {"+": (0.7, 0.3), "0": (0.2, 0.2), "-": (0.1, 0.5)}
    for _ in range(ROUNDS):
        weighed = patterns.select("n", posterior(F.col("pattern"), model).alias("g"), F.posexplode(F.split("pattern", "")).alias("rule", "vote"))
        sums = weighed.groupBy("rule", "vote").agg(F.sum(F.col("n") * F.col("g")).alias("good"), F.sum("n").alias("all")).collect()
        by = {(r["rule"], r["vote"]): (r["good"], r["all"] - r["good"]) for r in sums}
        good, bad = (sum(by.get((0, v), (0.0, 0.0))[side] for v in VOTES) for side in (0, 1))
        extra = SMOOTHING * (good + bad) + 1
        model = {"good": (good + extra) / (good + bad + 2 * extra), "rules": [
            {v: tuple((by.get((i, v), (0.0, 0.0))[side] + extra * lean[v][side]) / (total + extra) for side, total in ((0, good), (1, bad)))
             for v in VOTES} for i in range(rules)]}
    return model


RULES = 10


def _judged(measured: DataFrame) -> DataFrame:
    """Rows with `_m`, written once, with `_good`, `_failed` and `_kept`."""
    stored = table(measured.withColumn("_votes", votes(F.col("_m"))), "quality")
    model = fit(stored.groupBy(F.col("_votes").alias("pattern")).agg(F.count(F.lit(1)).alias("n")), RULES)
    m = F.col("_m")["w"]
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])
    return stored.withColumn("_good", posterior(F.col("_votes"), model)).withColumn("_failed", failed).withColumn(
        "_kept", ~F.col("_failed") & (F.col("_good") >= THRESHOLD))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and the posterior `p_good`.

    A null text has no words and fails, as does an empty one. Repeated rows are each judged
    and get the same verdict; other columns are not read; an empty table gives none.
    """
    measured = docs.select(F.col(id_col).alias("_id"), measures(whole(text_col)).alias("_m"))
    m = F.col("_m")
    return _judged(measured).select(
        F.col("_id").alias(id_col), m["w"]["n_words"].alias("n_words"), m["w"]["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"), m["l"]["n_dup_lines"].alias("n_dup_lines"),
        m["w"]["n_repeat_words"].alias("n_repeat_words"), F.col("_failed").alias("base_failed"),
        F.col("_kept").alias("kept"), F.round("_good", 6).alias("p_good"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs that the verdict keeps, with the columns of docs, whatever they are
    called. A null text has no words and goes; equal rows share a verdict; an empty table gives
    an empty one."""
    held = docs.select(F.struct(*docs.columns).alias("_row"), measures(whole(text_col)).alias("_m"))
    return _judged(held).filter("_kept").select("_row.*")
