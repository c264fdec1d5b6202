"""Connected components of a table of links, by contraction.

Each node has a random rank, a hash of its id. In each round a node takes the lowest-ranked of its neighbours and itself
for a parent, and the links are rewritten between parents. A node with a link is the lowest of itself and its neighbours
with a chance of one half at most, so about half of the nodes with links go in a round, whatever the order of their ids.
What is left after JUMP rounds are few nodes, often in chains of falling rank, so from there on a node takes its parent's
parent, which halves the chains: a path of 1,000 links takes ten rounds or so. Rounds are written to the shared folder;
nothing but row counts comes to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stage


#: Rounds without a second step up.
JUMP = 2


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of all nodes with links, from links (a, b); null ends are no links."""
    links = stage(links.filter("a < b or a > b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds = []
    rank = lambda c: F.struct(F.xxhash64(c).alias("rank"), F.col(c).alias("node"))
    while not links.isEmpty():
        ends = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
        lowest = ends.groupBy("id").agg(F.min(rank("other")).alias("lowest"))
        parents = stage(lowest.select("id", F.least(F.col("lowest"), rank("id"))["node"].alias("parent")), "parents")
        if len(rounds) >= JUMP:
            up = parents.select(F.col("id").alias("_id"), F.col("parent").alias("_up"))
            parents = stage(parents.join(up, F.col("parent") == F.col("_id")).select("id", F.col("_up").alias("parent")), "jumps")
        rounds.append(parents)
        of_a, of_b = (parents.select(F.col("id").alias(c), F.col("parent").alias(f"p{c}")) for c in "ab")
        moved = links.join(of_a, "a").join(of_b, "b").filter("pa <> pb")
        links = stage(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))

    def follow(found: DataFrame, parents: DataFrame) -> DataFrame:
        up = parents.select(F.col("id").alias("root"), F.col("parent").alias("up"))
        return found.join(up, "root", "left").select("id", F.coalesce("up", "root").alias("root"))

    found = stage(reduce(follow, rounds[1:], rounds[0].select("id", F.col("parent").alias("root"))), "roots")
    smallest = found.groupBy(F.col("root").alias("_root")).agg(F.min("id").alias("component"))
    return stage(found.join(smallest, F.col("root") == F.col("_root")).select("id", "component"), "components")
