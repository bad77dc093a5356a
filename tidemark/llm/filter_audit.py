"""What each of several filters removes in every order of applying them, by inclusion and exclusion.

A document's failures are a set of filters.  Per part and set of filters ``T`` one aggregate counts the documents that
fail all of ``T``, as a sum of products of flags.  Möbius inversion of these joint counts gives everything else, however
many documents there are: survivors of any prefix of an order, unique failures and, through the Harsanyi dividends of
the game "documents removed", each filter's Shapley value.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS = 200
#: Percent: distinct words of all words at least, capital letters of all characters at most.
LEAST_DISTINCT, MOST_CAPITALS = 50, 2
SYMBOLS = "[#$%&*|]"
#: The filters by letter; the last one, which compares documents, needs the whole table.
TEXT_FILTERS, COPY_FILTER = "ABCD", "E"


def text_failures(text: Column) -> list[Column]:
    """Conditions under which a text fails the filters A to D: few words, repeated words, capitals, symbols."""
    words = F.array_remove(F.split(text, SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * F.length(text), text.rlike(SYMBOLS)]


def failures(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per document: ``part``, ``failing`` (bit i set: fails filter i of ABCDE), ``good`` and ``toxic``.

    A null text counts as empty, a null part as the empty string.  Copies are texts of equal length and SHA-256; one
    fails E if a row of smaller id has the same text, so of rows with equal text and id none fails by the other, and a row
    without id neither fails E nor makes others fail.  A document is good (toxic) if any of its labels says so; labels
    without id, and of ids that are not there, count nowhere.  Texts are read once, whole, and do not cross the network;
    empty tables give no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    flags = sum(F.when(c, F.lit(1 << i)).otherwise(0) for i, c in enumerate(text_failures(F.col("text"))))
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"))
    rows = materialise(rows.select("id", "part", flags.alias("flags"), F.concat(F.sha2("text", 256), F.length("text").cast("string")).alias("body")), "filter-flags")
    first = rows.groupBy("body").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("body", "first")
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    copy = F.when(F.col("id") > F.col("first"), F.lit(1 << len(TEXT_FILTERS))).otherwise(0)
    found = rows.join(first, "body", "left").select("id", "part", (F.col("flags") + copy).alias("failing"))
    return found.join(marks.where("id IS NOT NULL"), "id", "left").select("part", "failing", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")])


def joint_failures(failing: DataFrame, filters: int) -> DataFrame:
    """Per part, arrays over all sets T of filters: documents failing all of T, and the good and toxic ones of them."""
    flag = [F.shiftright("failing", i).bitwiseAND(1) for i in range(filters)]

    def joint(weight: Column, chosen: int) -> Column:
        product = weight
        for i in range(filters):
            if chosen >> i & 1:
                product = product * flag[i]
        return F.coalesce(F.sum(product), F.lit(0)).cast("long")

    weights = {"n": F.lit(1), "good": F.col("good"), "toxic": F.col("toxic")}
    return failing.groupBy("part").agg(*[F.array(*[joint(w, t) for t in range(1 << filters)]).alias(name) for name, w in weights.items()])


def _sign(chosen: int) -> int:
    return -1 if chosen.bit_count() % 2 else 1


def survivors(joint: str, filters: int) -> Column:
    """Array over all sets P: documents that fail nothing in P (the alternating sum over P's subsets)."""
    n = F.col(joint)
    return F.array(*[sum((_sign(t) * n[t] for t in range(1, 1 << filters) if t & ~p == 0), n[0]) for p in range(1 << filters)])


def unique_failures(joint: str, filters: int) -> Column:
    """Array over filters: documents that fail this one only."""
    n, every = F.col(joint), range(1 << filters)
    return F.array(*[sum((_sign(t) * n[t | 1 << i] for t in every if t and not t >> i & 1), n[1 << i]) for i in range(filters)])


def shapley_sums(joint: str, filters: int) -> Column:
    """Array over filters: documents it removes, summed over all orders.

    The dividend of a set T in the game "removed by P" is plus or minus its joint count, and each of its members gets an
    equal share of it; times the number of orders all shares are whole.
    """
    n, orders = F.col(joint), len(list(permutations(range(filters))))
    return F.array(*[sum(-_sign(t) * (orders // t.bit_count()) * n[t] for t in range(1, 1 << filters) if t >> i & 1) for i in range(filters)])


def audit(failing: DataFrame, letters: str) -> DataFrame:
    """Per part, order of ``letters`` and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``failing`` is as ``failures`` gives it.  One aggregate over the documents; all else works on a row per part, times a
    literal grid of orders and steps.  Parts without failures come with zeros; an empty table gives no rows.
    """
    k = len(letters)
    held = joint_failures(failing, k).select(
        "part", "n", *[survivors(c, k).alias(f"{c}_left") for c in ("n", "good", "toxic")], unique_failures("n", k).alias("unique"), shapley_sums("n", k).alias("shares")
    )
    orders = F.explode(F.array(*[F.lit("".join(p)) for p in permutations(letters)])).alias("filter_order")
    grid = held.select("*", orders).select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    at = [F.instr("filter_order", letter) for letter in letters]
    before = sum(F.when(a < F.col("step"), F.lit(1 << i)).otherwise(0) for i, a in enumerate(at))
    own = sum(F.when(a == F.col("step"), F.lit(i)).otherwise(0) for i, a in enumerate(at))
    grid = grid.withColumns({"before": before, "own": own}).withColumn("bit", F.expr("shiftleft(1, own)")).withColumn("after", F.col("before").bitwiseOR(F.col("bit")))
    value = lambda array, index: F.col(array)[F.col(index)]
    lost = lambda c: value(f"{c}_left", "before") - value(f"{c}_left", "after")
    return grid.select(
        "part", "filter_order", "step", value("n_left", "after").alias("kept"), lost("n").alias("removed"), (value("n", "bit") - lost("n")).alias("redundant"),
        value("unique", "own").alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), value("shares", "own").alias("shapley"),
    )


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters ABCDE over whole documents, by source."""
    return audit(failures(documents, labels), TEXT_FILTERS + COPY_FILTER)
