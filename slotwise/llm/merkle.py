"""Document fingerprints: a Merkle tree over sections, paragraphs and runs of words.

A text is its sections (between blank lines), a section its paragraphs (lines), a paragraph its leaves: from each word on,
the run of RUN words with the blanks between them. Nothing is lost by these splits, so equal roots mean equal texts. An edit
changes the few leaves that reach over it and no others: two texts are as alike as the share of their distinct leaves that
they have in common. Differing branches are found from the root down, between the equal branches at both ends.

Native: DataFrame operations only.

Cases: a null text is empty and has the fingerprint of the empty text. Two texts without leaves are alike (1.0), one
without is unlike any other (0.0). Rows of one id are ordered by text and share a range of ids; rows without id come after
all others, in the order of a hash of the text. With one row, the next document is the row itself. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import parts, whole

#: Words of a leaf.
RUN = 3
#: A word with the blanks after it, or the blanks a paragraph begins with.
TOKEN = r"[^\x20\x09-\x0D]++[\x20\x09\x0B-\x0D]*+|[\x20\x09\x0B-\x0D]++"
#: Code points of text in one range of ids; ranges that are put in order together.
RANGE_CHARS, RANGES = 8_000_000, 4096


def with_value(value: Column, of) -> Column:
    """of(value), where the value is computed once however often it is used."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def runs(paragraph: Column, hashed) -> Column:
    """Hashes of the runs from each word on; those at the end are shorter."""
    run = lambda w, i: F.concat_ws("", *[F.get(w, i + k) for k in range(RUN)])  # noqa: E731  slice() would copy all words
    words = F.regexp_extract_all(paragraph, F.lit(TOKEN), F.lit(0))
    return with_value(words, lambda w: F.transform(w, lambda _, i: hashed(run(w, i))))


def leaves(text: Column) -> Column:
    """Distinct leaves of a text, as 64-bit hashes."""
    return F.array_distinct(F.flatten(F.transform(F.split(text, r"\n", -1), lambda p: runs(p, F.xxhash64))))


def tree(text: Column) -> Column:
    """Array of sections, each an array of paragraph hashes; a paragraph is hashed from its leaves."""
    def paragraph(p: Column) -> Column:
        return F.md5(F.concat(F.lit("paragraph:"), F.array_join(runs(p, F.md5), ",")))

    return F.transform(F.split(text, r"\n\n", -1), lambda s: F.transform(F.split(s, r"\n", -1), paragraph))


def section_hashes(nodes: Column) -> Column:
    return F.transform(nodes, lambda paragraphs: F.md5(F.concat(F.lit("section:"), F.array_join(paragraphs, ","))))


def root(nodes: Column) -> Column:
    return F.md5(F.concat(F.lit("root:"), F.array_join(section_hashes(nodes), ",")))


def fingerprint(text: Column) -> Column:
    return root(tree(text))


def equal_ends(a: Column, b: Column) -> Column:
    """struct(first, last): equal elements at the start of two arrays, and at their end without those."""
    least = F.least(F.size(a), F.size(b))

    def run(x: Column, y: Column) -> Column:
        same = F.zip_with(F.slice(x, F.lit(1), least), F.slice(y, F.lit(1), least), lambda p, q: p == q)
        return F.coalesce(F.nullif(F.array_position(same, False).cast("int"), F.lit(0)), least + 1) - 1

    both = F.struct(run(a, b).alias("first"), run(F.reverse(a), F.reverse(b)).alias("last"))
    return with_value(both, lambda e: F.struct(e["first"].alias("first"), F.least(least - e["first"], e["last"]).alias("last")))


def between(a: Column, b: Column, of) -> Column:
    """of(place, element of a, element of b) of the elements between the equal ends, in order; null where one has no more."""
    def found(ends: Column) -> Column:
        first, last = ends["first"], ends["last"]
        count = F.greatest(F.size(a), F.size(b)) - first - last
        at = lambda x, k: F.when(k < F.size(x) - last, F.get(x, k))
        places = F.when(count > 0, F.sequence(first, first + F.greatest(count, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
        differ = F.filter(places, lambda k: ~at(a, k).eqNullSafe(at(b, k)))
        return F.transform(differ, lambda k: of(k, at(a, k), at(b, k)))

    return with_value(equal_ends(a, b), found)


def changed_branches(old: Column, new: Column) -> Column:
    """Where two trees differ: (section, paragraph) from 0; paragraph -1 where only one of them has the section.

    Sections between the equal ones at both ends are compared in order, and so are the paragraphs of a section.
    """
    branch = lambda section, paragraph: F.struct(section.alias("section"), paragraph.alias("paragraph"))

    def section(i: Column, a: Column, b: Column) -> Column:
        alone = F.array(branch(i, F.lit(-1)))
        return F.when(a.isNull() | b.isNull(), alone).otherwise(between(a, b, lambda j, x, y: branch(i, j)))

    return F.flatten(between(old, new, section))


def likeness(a: Column, b: Column) -> Column:
    """Twice the common leaves over all leaves, of two arrays of distinct leaves."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def ranged(docs: DataFrame) -> DataFrame:
    """Rows with `range`, a number that falls with the place of the row: ids in ranges of equal width, then rows without id.

    The ends of the ids, the sizes and nothing else come to the driver.
    """
    no_id = F.col("doc_id").isNull()
    found = docs.agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum(F.length("text")).alias("chars"),
        F.sum(F.when(no_id, F.length("text"))).alias("loose"),
    ).first()
    count, loose = (parts(docs.sparkSession, found[c], RANGE_CHARS) for c in ("chars", "loose"))
    low, high = found["low"] or 0, found["high"] or 0
    width = F.lit((high - low) // count + 1).cast("decimal(20,0)")
    place = F.call_function("div", F.col("doc_id").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)"), width)
    by_hash = F.conv(F.substring(F.md5("text"), 1, 8), 16, 10).cast("long")
    return docs.withColumn("range", F.when(no_id, -1 - F.call_function("div", by_hash * loose, F.lit(1 << 32))).otherwise(place))


def following(ranges: DataFrame) -> DataFrame:
    """range, after: the range that comes next, downwards; after the lowest comes the highest. From distinct numbers.

    Ranges are put in order RANGES at a time, then those groups, a row for each.
    """
    groups = ranges.withColumn("group", F.floor(F.col("range") / RANGES))
    inside = Window.partitionBy("group").orderBy(F.col("range").desc())
    rows = groups.withColumn("after", F.lead("range").over(inside))
    tops = groups.groupBy("group").agg(F.max("range").alias("top"))
    all_groups = Window.orderBy(F.col("group").desc())
    first = F.first("top").over(all_groups.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tops = tops.select(F.col("group").alias("_group"), F.coalesce(F.lead("top").over(all_groups), first).alias("next_top"))
    return rows.join(tops, F.col("group") == F.col("_group")).select("range", F.coalesce("after", "next_top").alias("after"))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Each row with next_<column> of the document that follows in descending doc_id; after the last comes the first.

    Rows are dealt by ranges of ids and put in order there. The first row of a range is copied behind the last row of the
    range before, so the texts are shuffled once, and a copy of one row for each range besides.
    """
    rows = ranged(docs)
    order = [F.col("doc_id").desc_nulls_last(), F.when(F.col("doc_id").isNull(), F.md5("text")), "text"]
    heads = rows.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy(*order))).filter("place = 1")
    heads = heads.select(F.col("range").alias("_range"), *docs.columns)
    links = following(rows.select("range").distinct())
    copies = heads.join(links, F.col("_range") == F.col("after")).select("range", *docs.columns, F.lit(True).alias("copy"))
    both = rows.select("range", *docs.columns, F.lit(False).alias("copy")).unionByName(copies)
    along = Window.partitionBy("range").orderBy("copy", *order)
    return both.withColumns({f"next_{c}": F.lead(c).over(along) for c in columns}).filter("not copy").drop("range", "copy")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of the texts and of edited texts, and how alike they are.

    The edit replaces the last third of a text by the head of the next document, descending doc_id.
    """
    rows = docs.select("doc_id", whole(F.col("text")).alias("text"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    return (
        with_next(rows, ["text"])
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut)))
        .withColumns({"tree": tree(F.col("text")), "edited_tree": tree(F.col("edited"))})
        .withColumns({c: leaves(F.col(t)) for c, t in (("leaves", "text"), ("edited_leaves", "edited"), ("next_leaves", "next_text"))})
        .select(
            "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
            root(F.col("tree")).alias("fingerprint"), root(F.col("edited_tree")).alias("edited_fingerprint"),
            likeness(F.col("leaves"), F.col("edited_leaves")).alias("near_edited"),
            likeness(F.col("leaves"), F.col("next_leaves")).alias("near_next"),
            F.size("tree").alias("n_sections"),
            F.size(changed_branches(F.col("tree"), F.col("edited_tree"))).alias("n_changed"),
        )
    )
