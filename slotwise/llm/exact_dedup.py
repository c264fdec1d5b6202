"""Exact dedup: 128-bit content hash, bytes compared inside the groups, one row of each class stays.

Native: DataFrame operations only.

Cases: a null text is an empty text. Rows equal in id and text are one document, they stay or go together. A null id
sorts below all others; it stays only if its class has no other id. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stage, text_hash, whole, without


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_classes(
    docs: DataFrame, normalise: Callable[[Column], Column] | None = None,
    hashed: Callable[[Column], Column] = content_hash, keep: Callable[[Column], Column] = F.max,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row.

    One shuffle brings each distinct text to its group: the aggregation's key is the hash and the bytes, so two texts of
    one hash stay two classes, and copies are merged before they are sent. The rows themselves are joined without their
    text, and only against classes of two or more. A hot class is one row per task in the aggregation; in the join its
    rows are a skewed side that adaptive execution splits.
    """
    text = whole(F.col("text"))
    text = normalise(text) if normalise else text
    rows = docs.select("doc_id", text.alias("text")).withColumn("h", hashed(F.col("text")))
    classes = (
        rows.groupBy("h", "text")
        .agg(keep("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .select(F.col("h").alias("_h"), F.sha2("text", 256).alias("_sha"), "keep_id", "group_size")
    )
    narrow = rows.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"))
    found = narrow.join(classes, (F.col("h") == F.col("_h")) & (F.col("text_sha256") == F.col("_sha")), "left")
    return (
        found.withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")))
        .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


def exact_dedup(docs: DataFrame, keep: Callable[[Column], Column] = F.max, single: bool = False) -> DataFrame:
    """The rows that stay, in all their columns. For texts that are kept as they are, without `normalise`.

    With `single`, one of the rows equal in id and text stays. Eager then: only if there are such rows, they are grouped.
    """
    classes = exact_classes(docs, keep=keep)
    if not single:
        return without(docs, classes.filter(~F.col("kept")))
    shared = classes.filter("group_size > 1").groupBy("doc_id", "text_sha256")
    found = stage(shared.agg(F.first("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).filter("not kept or rows > 1"), "classes")
    left, repeated = without(docs, found), found.filter("kept")
    if repeated.isEmpty():
        return left
    keys = repeated.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), text_hash(F.col("text")).alias("hash"))
    rows = rows.join(keys, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_sha")), "left_semi")
    one = F.min_by("row", F.to_json("row"))  # as text: rows may hold maps, which have no order
    return left.unionByName(rows.groupBy("id", "hash").agg(one.alias("row")).select("row.*"))
