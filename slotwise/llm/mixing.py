"""Mixing sources to target weights.

Rows get hash-random keys; within each source they are ordered by key, token counts are summed along that order, and the
source is cut at its exact budget after as many whole epochs as fit.

Cases: a null text has size 0, a null source is a source of its own (the last one). Rows of one id have one key; equal
rows are interchangeable, so the result does not depend on their order. A null id has the key of an empty text. Sources
without words get target 0. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import WORD, stage, whole

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated so often at most.
EPOCHS = 3


def size_of(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def mix_targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, share: float = 1.0) -> DataFrame:
    """source, source_size, target from one row (source, source_size) per source.

    With all sources ordered by cap over weight, capping a prefix of them leaves (total - caps) / weights of the rest as
    the level; the level is right where it is largest. The two windows run over one row per source.
    """
    order, ratio = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", "rank")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        sizes.withColumn("rank", F.row_number().over(order))
        .withColumn("weight", F.element_at(F.lit(list(weights)), (F.col("rank") - 1) % len(weights) + 1).cast("long"))
        .withColumn("cap", F.col("source_size") * epochs)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight").cast("double"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double") * F.lit(float(share)))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("double"))
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.max((F.col("total") - F.col("capped")) / F.col("left").cast("double")).over(everything))
        .select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight").cast("double") * F.col("level")).alias("target"))
    )


def mix(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, share: float = 1.0, seed: str = "") -> DataFrame:
    """doc_id, source, size, source_size, target, taken, mark (a hash of the text) for each row.

    Only ids, sources, sizes and keys are kept after the first pass. Key ranges are summed first; a window then runs
    over the one range per source in which the budget ends. There are about as many ranges as a range of all rows has rows,
    so neither the ranges of a source nor the rows of a range outgrow a task: a million each for 10^12 rows.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    mark = F.xxhash64(whole(F.col("text")))
    rows = stage(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), key.alias("key"), mark.alias("mark")), "mix")
    digits = max(1, math.ceil(math.log(max(rows.count(), 2), 16) / 2))
    ranges = rows.groupBy("source", F.substring("key", 1, digits).alias("range")).agg(F.sum("size").alias("range_size"))
    targets = mix_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, epochs, share)
    plan = targets.withColumn("budget", F.least(F.floor("target"), F.col("source_size") * epochs))
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", (F.col("budget") - F.col("whole") * F.col("source_size")).cast("long"))
    along = Window.partitionBy("source").orderBy("range")
    cuts = (
        ranges.withColumn("range_before", F.sum("range_size").over(along) - F.col("range_size"))
        .join(plan.select(F.col("source").alias("_s"), "rest"), F.col("source").eqNullSafe(F.col("_s")))
        .groupBy("source")
        .agg(F.max(F.when(F.col("range_before") <= F.col("rest"), F.struct("range", "range_before"))).alias("cut"))
        .select(F.col("source").alias("_c"), F.col("cut.range").alias("cut_range"), F.col("cut.range_before").alias("cut_before"))
    )
    plan = plan.join(cuts, F.col("source").eqNullSafe(F.col("_c"))).drop("_c").withColumnRenamed("source", "_s")
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("_s"))).withColumn("range", F.substring("key", 1, digits))
    inside = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        placed.filter("range = cut_range")
        .withColumn("before", F.col("cut_before") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before"))))
    )
    plain = placed.filter("range <> cut_range").withColumn("part", F.when(F.col("range") < F.col("cut_range"), F.col("size")).otherwise(0))
    columns = ["doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("whole") + F.col("part")).cast("long").alias("taken"), "mark"]
    return cut.select(*columns).unionByName(plain.select(*columns))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus, in the columns of docs: a row for each time a document is taken.

    The document at which a source's budget ends is taken up to the budget's last word. Documents without words stay out.
    Rows equal in id and text are taken alike, as often as the one taken most.
    """
    taken = mix(docs, **options).filter("taken > 0").groupBy("doc_id", "mark").agg(F.max("size").alias("size"), F.max("taken").alias("taken"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.xxhash64(whole(F.col("text"))).alias("text_mark"))
    found = rows.join(taken, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_mark") == F.col("mark")))
    times = F.transform(F.sequence(F.lit(1), F.expr("(taken + size - 1) div size")), lambda i: F.least("size", F.col("taken") - (i - 1) * F.col("size")))
    out = found.select("row", "size", F.explode(times).alias("words"))
    words = F.regexp_extract_all(F.col("row.text"), F.lit(rf"[\x20\x09-\x0D]*+{WORD}"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), "")
    return out.select(F.when(F.col("words") < F.col("size"), F.col("row").withField("text", cut)).otherwise(F.col("row")).alias("row")).select("row.*")
