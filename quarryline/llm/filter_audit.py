"""How five document filters act together, in every order, by a potential over their coalitions.

Every document fails some subset of the filters. Counts of documents by part and subset make a game: the worth of
a coalition of filters is the number of documents that at least one of them removes. The Hart-Mas-Colell potential
of a coalition S is P(S) = (v(S) + the sum of P(S without i) over its members i) / |S|, with P of nothing 0; the Shapley
value of a filter is the potential of all filters minus that of all but this one. Scaled by |S|! the potentials are whole numbers:
Q(S) = (|S| - 1)! v(S) + the sum of Q(S without i), and a filter's removals summed over all orders are
Q(all) - 5 Q(all without i). What a filter removes at a step is the difference of two coalitions.

Everything is DataFrame functions: parts stay distributed rows, and the 32 coalitions are arrays in them.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import pinned

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
EVERYTHING = COALITIONS - 1
LEAST_WORDS = 200
WORD = r"[^\x20\x09-\x0D]+"


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text (not null) fails."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    # Both counts are taken from one array of words.
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    by_words = F.transform(
        F.array(counts),
        lambda c: F.when(c["n"] < LEAST_WORDS, 1).otherwise(0) + F.when(100 * c["d"].cast("long") < 50 * c["n"].cast("long"), 2).otherwise(0),
    )[0]
    return (
        by_words
        + F.when(100 * capitals.cast("long") > 2 * F.length(text).cast("long"), 4).otherwise(0)
        + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)
    )


def _flags(labels: DataFrame, key: str) -> DataFrame:
    """One row per key: whether any label row calls it good, or toxic."""
    return labels.groupBy(F.col(key).alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )


def failing(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key``, ``part``, ``good``, ``toxic`` and ``fails`` (bits of A to E) of every document.

    A text is a copy when a smaller key has it; texts are known by their SHA-256.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    narrow = pinned(
        documents.select(
            F.col(key).alias("key"),
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(whole, 256)).alias("digest"),
            failures(whole).alias("fails"),
        ),
        "failures",
    )
    # Written, so that the join with them is free to split a frequent text.
    firsts = pinned(
        narrow.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts"
    )
    rows = narrow.join(_flags(labels, key), "key", "left").join(firsts, "digest", "left")
    # Beside a key that is known, a null key is the larger one.
    copy = F.coalesce(F.col("key") > F.col("first"), F.col("first").isNotNull() & F.col("key").isNull())
    return rows.select(
        "key",
        "part",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
        (F.col("fails") + F.when(copy, 16).otherwise(0)).alias("fails"),
    )


def _worths(counts: Column) -> Column:
    """By coalition: how many of the counted documents one of its members removes."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(EVERYTHING)),
        lambda s: F.aggregate(
            F.sequence(F.lit(0), F.lit(EVERYTHING)),
            F.lit(0).cast("long"),
            lambda total, fails: total + F.when(fails.bitwiseAND(s) != 0, F.get(counts, fails)).otherwise(F.lit(0)),
        ),
    )


def _potentials(worths: Column) -> Column:
    """By coalition: its potential times the factorial of its size, recursively over the members left out."""
    factorials = F.array(*(F.lit(math.factorial(i)).cast("long") for i in range(len(FILTERS) + 1)))

    def potential(known: Column, coalition: Column) -> Column:
        smaller = F.aggregate(
            F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)),
            F.lit(0).cast("long"),
            lambda total, i: total
            + F.when(
                F.call_function("getbit", coalition.cast("long"), i) == 1,
                F.get(known, (coalition - F.call_function("shiftleft", F.lit(1), i)).cast("int")),
            ).otherwise(F.lit(0)),
        )
        return F.get(factorials, F.bit_count(coalition) - 1) * F.get(worths, coalition) + smaller

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(EVERYTHING)),
        F.array(F.lit(0).cast("long")),
        lambda known, coalition: F.array_append(known, potential(known, coalition)),
    )


def _bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), letter) - 1)


def audit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Counts for every part, order of the filters and step.

    Returns ``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost``, ``shapley``: 600 rows for each source. Null texts are empty, null sources are the empty text.
    A document whose text a smaller key has fails E; rows that share the smallest key of a text do not fail it, and a null
    key is larger than any other. A key labelled more than once is good, or toxic, when one of its labels
    says so; labels of unknown keys do not count. An empty table gives no rows. Other columns are not looked at.
    """
    kinds = failing(documents, labels, key, text, source).groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic")
    )

    def by_kind(column: str) -> Column:
        return F.array(*(F.coalesce(F.sum(F.when(F.col("fails") == i, F.col(column))), F.lit(0)) for i in range(COALITIONS)))

    parts = kinds.groupBy("part").agg(
        F.sum("n").alias("total"), by_kind("n").alias("counts"), by_kind("n_good").alias("good"), by_kind("n_toxic").alias("toxic")
    )
    # Written once: what follows reads every array many times.
    games = pinned(parts.select("part", "total", "counts", *(_worths(F.col(c)).alias(c + "_worth") for c in ("counts", "good", "toxic"))), "games")
    played = games.withColumn("potential", _potentials(F.col("counts_worth")))
    orders = F.array(*(F.lit("".join(order)) for order in permutations(FILTERS)))
    steps = (
        played.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("own", _bit(F.substr("filter_order", "step", F.lit(1))))
        .withColumn(
            "before",
            F.aggregate(
                F.sequence(F.lit(1), F.lit(len(FILTERS))),
                F.lit(0),
                lambda bits, i: bits + F.when(i < F.col("step"), _bit(F.substr("filter_order", i, F.lit(1)))).otherwise(F.lit(0)),
            ),
        )
        .withColumn("after", F.col("before") + F.col("own"))
    )

    def gained(worth: str) -> Column:
        return F.get(worth, F.col("after")) - F.get(worth, F.col("before"))

    removed = gained("counts_worth")
    rest = F.lit(EVERYTHING) - F.col("own")
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get("counts_worth", F.col("after"))).alias("kept"),
        removed.alias("removed"),
        (F.get("counts_worth", F.col("own")) - removed).alias("redundant"),
        F.get("counts", F.col("own")).alias("unique_fails"),
        gained("good_worth").alias("good_lost"),
        gained("toxic_worth").alias("toxic_lost"),
        (F.get("potential", F.lit(EVERYTHING)) - len(FILTERS) * F.get("potential", rest)).alias("shapley"),
    )
