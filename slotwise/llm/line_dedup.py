"""Line dedup by winnowing.

Lines are hashed, blank ones left out. (1) Runs: each run of GRAM + WINDOW - 1 lines has a fingerprint, the rightmost
smallest hash of its WINDOW grams; equal runs have the same fingerprint at the same place of the run. Fingerprints found
at one place only are dropped. A match of one of the others is extended both ways to all runs that have it for their
fingerprint, and a run that starts earlier elsewhere (smaller id, or same id and earlier line) is repeated. Overlapping
repeated runs make maximal runs: a line more on either side, equal to the one beside the earlier copy, would make a
repeated run with its neighbours and hence belong to it already. (2) Rest: a line outside all repeated runs goes if it has
an earlier copy, found by its own hash. So no later copy of a line stays, long or short, alone or not.

With `gram` and `window` given, runs of that length are all that is deleted.

Only hashes are shuffled until the last join. A line in a third of the documents is merged by the map side of the
aggregations; in the joins its rows are the skewed side that adaptive execution splits. Work on a document is linear in
its lines.

Lines are trimmed for comparison. Hashes have 64 bits.

Cases: a null text is empty and has one blank line. Blank lines stay. Different texts of one id are documents of their
own, in the order of a hash of the text; rows equal in id and text are one document. A null id counts as the smallest.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import stage, whole
from slotwise.llm.hashing import NO_ID

#: Lines of a gram, and grams of a window: repeated runs of GRAM + WINDOW - 1 lines are found by their fingerprints.
GRAM, WINDOW = 1, 2
BLANKS = " \t\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def line_hashes(lines: Column) -> Column:
    """Hashes of the lines that aren't blank."""
    return F.transform(F.filter(F.transform(lines, trimmed), lambda x: x != ""), lambda x: F.xxhash64(x))


def line_places(lines: Column) -> Column:
    """Places of the lines that aren't blank."""
    return F.filter(F.transform(lines, lambda line, i: F.when(trimmed(line) != "", i)), lambda i: i.isNotNull())


def places(count: Column) -> Column:
    """0, 1, ... count - 1; none if count is not positive."""
    return F.when(count > 0, F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value); value is evaluated once, also where `of` uses it for each element of an array."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def winnowed(hashes: Column, gram: int, window: int) -> Column:
    """start and hash of each run, and its fingerprint: the rightmost smallest gram (print) and the gram's place (at)."""
    def joint(i: Column, n: int) -> Column:
        return F.xxhash64(*[F.get(hashes, i + j) for j in range(n)])

    def runs(grams: Column) -> Column:
        def run(i: Column) -> Column:
            least = F.array_min(F.array(*[F.struct(F.get(grams, i + j).alias("print"), (-i - j).alias("back")) for j in range(window)]))
            return F.struct(i.alias("start"), joint(i, gram + window - 1).alias("run"), least["print"].alias("print"), (-least["back"]).alias("at"))

        return F.transform(places(F.size(grams) - window + 1), run)

    return let(F.transform(places(F.size(hashes) - gram + 1), lambda i: joint(i, gram)), runs)


def repeated_runs(hashed: DataFrame, gram: int, window: int) -> DataFrame:
    """id, mark, start (among the lines that aren't blank) of the repeated runs, from id, mark (of the text) and hashes."""
    runs = stage(hashed.select("id", "mark", F.inline(winnowed(F.col("hashes"), gram, window))), "runs")
    place = F.xxhash64("id", "mark", "at")
    often = runs.groupBy("print").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).filter("lo <> hi").select("print")
    return not_first(runs.join(often, "print", "left_semi").select("id", "mark", "start", "run"))


def repeated_lines(hashed: DataFrame) -> DataFrame:
    """id, mark, start of all lines with an earlier copy."""
    return not_first(hashed.select("id", "mark", F.posexplode("hashes").alias("start", "run")))


def not_first(runs: DataFrame) -> DataFrame:
    """id, mark, start of the runs that start earlier elsewhere."""
    first = runs.groupBy("run").agg(F.min(F.struct("id", "mark", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return runs.join(first, "run").filter(F.struct("id", "mark", "start") != F.col("first")).select("id", "mark", "start")


def maximal(repeated: DataFrame, run: int) -> DataFrame:
    """id, mark, low, high: first and last line of the maximal runs that overlapping repeated runs make."""
    by = Window.partitionBy("id", "mark").orderBy("start")
    apart = F.when(F.col("start") - F.lag("start").over(by) >= run, 1).otherwise(0)
    joined = repeated.withColumn("apart", apart).withColumn("k", F.sum("apart").over(by))
    return joined.groupBy("id", "mark", "k").agg(F.min("start").alias("low"), (F.max("start") + run - 1).alias("high")).drop("k")


def line_dedup(docs: DataFrame, gram: int | None = None, window: int | None = None) -> DataFrame:
    """doc_id, text without its repeated runs and lines, n_lines, n_removed, the deleted lines' places, n_in_runs (how many of
    them are in repeated runs) and runs (places of the first and last line of each maximal one).

    Without gram and window, runs by GRAM and WINDOW go, and then the other lines with an earlier copy.
    """
    rest = gram is None and window is None
    gram, window = gram or GRAM, window or WINDOW
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(whole(F.col("text"))).alias("mark"), "text")
    hashed = stage(docs.select("id", "mark", line_hashes(lines_of(F.col("text"))).alias("hashes")), "lines")
    found = maximal(repeated_runs(hashed, gram, window), gram + window - 1).select("id", "mark", F.struct("low", "high").alias("match"), F.lit(None).cast("int").alias("line"))
    if rest:
        found = found.unionByName(repeated_lines(hashed).select("id", "mark", F.lit(None).cast(found.schema["match"].dataType).alias("match"), F.col("start").alias("line")))
    found = found.groupBy("id", "mark").agg(F.sort_array(F.collect_list("match")).alias("matches"), F.collect_set("line").alias("alone"))
    matches, alone = F.col("matches"), F.col("alone")

    def cut(lines: Column) -> Column:
        def without(in_runs: Column, at: Column, removed: Column) -> Column:
            kept = F.transform(F.array_except(places(F.size(lines)), removed), lambda i: F.get(lines, i))
            return F.struct(
                F.array_join(kept, "\n").alias("text"), F.size(lines).cast("long").alias("n_lines"), F.size(removed).cast("long").alias("n_removed"),
                removed.alias("removed"), F.size(in_runs).cast("long").alias("n_in_runs"),
                F.transform(matches, lambda m: F.array(F.get(at, m["low"]), F.get(at, m["high"]))).alias("runs"),
            )

        def removed(in_runs: Column, at: Column) -> Column:
            return F.sort_array(F.transform(F.array_union(in_runs, alone), lambda k: F.get(at, k)))

        in_runs = F.flatten(F.transform(matches, lambda m: F.sequence(m["low"], m["high"])))
        left = let(in_runs, lambda r: let(line_places(lines), lambda at: let(removed(r, at), lambda gone: without(r, at, gone))))
        none = F.array().cast("array<int>")
        return F.when(matches.isNull(), F.struct(
            whole(F.col("text")).alias("text"), F.size(lines).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"),
            none.alias("removed"), F.lit(0).cast("long").alias("n_in_runs"), F.array().cast("array<array<int>>").alias("runs"),
        )).otherwise(left)

    df = docs.join(found, ["id", "mark"], "left")
    return df.select(F.nullif(F.col("id"), F.lit(NO_ID)).alias("doc_id"), F.inline(F.transform(F.array(lines_of(F.col("text"))), cut)))


def line_digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256, n_in_runs, and the maximal repeated runs as low:high, comma-joined."""
    runs = F.array_join(F.transform("runs", lambda r: F.concat_ws(":", r.cast("array<string>"))), ",")
    return line_dedup(docs, **options).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"), "n_in_runs", runs.alias("runs"))
