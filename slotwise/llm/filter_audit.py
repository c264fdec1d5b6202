"""Filter interaction audit: what each of several filters removes in each order, and its fair share of the removal.

A document is its set of failed filters, so a part of the corpus is a game: a coalition of filters removes the documents
that fail one of them. The Hart-Mas-Colell potential of a coalition is the mean, over its members, of what the coalition
removes and of the potential without that member; it is computed from the empty coalition up to all 32. The Shapley value
of a filter is the potential of all filters minus that without it. A step of an order is the difference of two coalitions.

Cases: a null text is empty, a null source is the part ''. A null id is no smaller id and has none, so such a row is
identical to no earlier one; it has no label. Rows equal in id and text are not earlier than each other. If an id has
several labels, one with the value suffices. Texts are taken whole, and are identical if their SHA-256 is. An empty table
gives an empty result; labels may be empty. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stage, whole

#: Failure conditions on texts: least words, least percent of distinct words, most percent of capitals, refused characters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, REFUSED = 200, 50, 2, "[#$%&*|]"
SPACES = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Names in the order of their bits; the last one needs the other documents: identical to the text of a smaller id.
FILTERS = "ABCDE"
#: Null ids are dealt over so many tasks in the join with the labels; they meet none there.
SALTS = 512


def text_conditions(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of one text, by filter name."""
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * n,
        "C": 100 * capitals.cast("long") > MOST_CAPITALS * F.length(text),
        "D": text.rlike(REFUSED),
    }


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask: the failed filters of each row as bits, the first filter lowest.

    Texts are read once and go no further than their hash. A hot text is one row per task in the aggregation; in the join
    with the classes of two or more, its rows are a skewed side that adaptive execution splits.
    """
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), whole(F.col("text")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACES), ""))
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(text_conditions(F.col("text"), F.col("words")).values())]
    mask = sum(bits[1:], bits[0])
    rows = stage(rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("text_hash")), "failures")
    classes = rows.groupBy("text_hash").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    found = rows.join(classes.select(F.col("text_hash").alias("_hash"), "first"), F.col("text_hash") == F.col("_hash"), "left")
    repeated = F.when(F.col("doc_id") > F.col("first"), 1 << len(bits)).otherwise(0)
    return found.select("doc_id", "part", (F.col("mask") + repeated).alias("mask"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: at most 32 rows a part."""
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = known.select(F.col("doc_id").alias("_id"), F.lit(0).alias("_salt"), "good", "toxic")
    salt = F.when(F.col("doc_id").isNull(), F.spark_partition_id() % SALTS).otherwise(0)
    found = rows.withColumn("salt", salt).join(known, (F.col("doc_id") == F.col("_id")) & (F.col("salt") == F.col("_salt")), "left")
    one = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long")
    return found.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), one("good").alias("good"), one("toxic").alias("toxic"))


def potentials(removed: Column, filters: int) -> Column:
    """The potential of each coalition, in the order of their bits, times the number of orders.

    A coalition's members come before it in that order. The number of orders is divisible by the size of any coalition, and
    so is each sum: no division has a rest.
    """
    def potential(acc: Column, s: Column) -> Column:
        without = [F.when(s.bitwiseAND(1 << i) != 0, F.get(acc, s.bitwiseXOR(F.lit(1 << i)))).otherwise(0) for i in range(filters)]
        return F.call_function("div", factorial(filters) * F.get(removed, s) + sum(without[1:], without[0]), F.bit_count(s))

    coalitions = F.sequence(F.lit(1), F.lit((1 << filters) - 1))
    return F.aggregate(coalitions, F.array(F.lit(0).cast("long")), lambda acc, s: F.concat(acc, F.array(potential(acc, s))))


def games_of(counts: DataFrame, filters: int) -> DataFrame:
    """part, total, alone, and what each coalition removes: all documents, good ones, toxic ones (arrays)."""
    def over(places: Column, hit: Callable[[Column, Column], Column], c: str) -> Column:
        zero = F.lit(0).cast("long")
        return F.transform(places, lambda s: F.aggregate("kinds", zero, lambda acc, x: acc + F.when(hit(x["mask"], s), x[c]).otherwise(0)))

    coalitions = F.sequence(F.lit(0), F.lit((1 << filters) - 1))
    any_of = lambda mask, s: mask.bitwiseAND(s) != 0
    kinds = counts.groupBy("part").agg(F.sum("n").alias("total"), F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("kinds"))
    return kinds.select(
        "part", "total", over(F.array(*[F.lit(1 << i) for i in range(filters)]), lambda mask, s: mask == s, "n").alias("alone"),
        over(coalitions, any_of, "n").alias("removed"), over(coalitions, any_of, "good").alias("good"), over(coalitions, any_of, "toxic").alias("toxic"),
    )


def all_steps(names: str) -> Column:
    """Array of (filter_order, step, place, before, after) over all orders of the filters; before and after are coalitions."""
    steps = []
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order, 1):
            steps.append({"filter_order": "".join(names[k] for k in order), "step": step, "place": i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,place:int,before:int,after:int>>")


def audit_steps(counts: DataFrame, names: str) -> DataFrame:
    """One row per part, order and step; all orders of the filters in `names`."""
    filters = len(names)
    games = games_of(counts, filters)
    rows = games.select("*", potentials(F.col("removed"), filters).alias("potential")).select("*", F.inline(all_steps(names)))
    step = lambda c: F.get(c, F.col("after")) - F.get(c, F.col("before"))
    own = F.col("after") - F.col("before")
    grand = F.lit((1 << filters) - 1)
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.get("removed", F.col("after"))).alias("kept"), step("removed").alias("removed"),
        (F.get("removed", own) - step("removed")).alias("redundant"), F.get("alone", F.col("place")).alias("unique_fails"),
        step("good").alias("good_lost"), step("toxic").alias("toxic_lost"),
        (F.get("potential", grand) - F.get("potential", grand - own)).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters. Eager: one stage of a short row per document."""
    return audit_steps(mask_counts(failures(docs), labels), FILTERS)
