"""Trees of many ensembles at once.

A unit is one ensemble: the rows of a program, up to a row number if it is a fold, and its own parameters. All programs,
folds and trials of a run are units of the same passes over the same rows; no fold or trial has a copy of them.

Features are cut into bins at the quantiles of their program, once (`prepare`).

Programs of more than WHOLE_ROWS rows are grown level by level, each level one grouped aggregate. A pass over the rows knows
the trees so far, finds each row's node and gradient, and sends sums of gradients and weights by (unit, node, feature,
bin), already summed within a task. Spark sums them over the tasks, runs along the bins for the sums left of each cut, and
keeps the cut with the largest gain of each node. Only these cuts come to the driver: one row for each open node of a unit.
The score of a row is kept with the row, for each unit of its program, and brought up to date every TREES_PER_STAGE trees in
a new stage; in between, the few trees since then are added on the way. Lost tasks read the last stage again.

The rows of a smaller program fit one task, so there the same sums need no exchange: the task finishes its units, in one
pass, and what leaves it are node rows and the test scores of folds. A program has at most one row per slot and channel of
the training window, a few thousand, so this is the usual case; what grows is the number of programs. Both ways give the
same trees.

The gain is that of regularised boosting: (|G| - l1)+^2 / (H + l2), left plus right minus both, with at least `min_instances`
weight on each side. A leaf's value is minus (|G| - l1)+ / (H + l2) with the sign of G, times the step. Ties go to the first
feature, then to the first bin.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.window import Window

from slotwise.config import ModelConfig
from slotwise.operators.history import numbered
from slotwise.sources.stages import new_stage, staged

BINS = 32
#: Trees between two stages of the rows' scores.
TREES_PER_STAGE = 25
#: Rows times units of a task, for few and for many rows; numbers of a task's sums before it sends them on.
LEAST_WORK, MOST_WORK, HELD_SUMS = 20_000, 8_000_000, 1 << 22
#: Rows of a program that one task may hold; larger programs are cut into pieces of so many rows.
WHOLE_ROWS = 100_000

#: Digits of a gain that count: sums of the same rows differ in their last bits with the order of addition.
GAIN_DIGITS = 9

NODE_SCHEMA = (
    "program_id int, member string, tree int, weight double, node int, left int, right int, "
    "feature string, threshold double, value double, cover double, gain double"
)
NODE_FIELDS = pa.schema([
    ("program_id", pa.int32()), ("member", pa.string()), ("tree", pa.int32()), ("weight", pa.float64()), ("node", pa.int32()),
    ("left", pa.int32()), ("right", pa.int32()), ("position", pa.int32()), ("bin", pa.int32()), ("value", pa.float64()),
    ("cover", pa.float64()), ("gain", pa.float64()),
])
#: What a task that finishes units sends: nodes of their trees, or the test scores of folds.
RESULT = pa.schema([("kind", pa.string()), ("unit", pa.int32()), ("y", pa.float64()), ("score", pa.float64()), *NODE_FIELDS])
SUMS = pa.schema([
    ("unit", pa.int32()), ("l1", pa.float64()), ("l2", pa.float64()), ("least", pa.float64()),
    ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("g", pa.float64()), ("h", pa.float64()),
])
SUM_COLUMNS = "unit int, l1 double, l2 double, least double, node int, feature int, bin int, g double, h double"


@dataclass(frozen=True)
class Span:
    """The rows of a program that a unit learns from, by row number.

    fold i of k learns from the rows before n - (k - i) t, t = n div (k + 1), and is tested on the next t. Without a fold, a
    program of less than `tail_below` rows leaves its last ceil(tail n) rows out. `below` takes rows with a label below 1 only.
    """

    fold: int = -1
    folds: int = 0
    tail: float = 0.0
    tail_below: float = 0.0
    below: bool = False

    def stop(self, n: int) -> int:
        if self.fold >= 0:
            return n - (self.folds - self.fold) * (n // (self.folds + 1))
        return n - math.ceil(n * self.tail) if n < self.tail_below else n

    def test_stop(self, n: int) -> int:
        return self.stop(n) + n // (self.folds + 1)

    def column(self) -> Column:
        """Whether a row is in the span."""
        if self.fold >= 0:
            stop = F.expr(f"n_rows - {self.folds - self.fold} * (n_rows div {self.folds + 1})")
        else:
            stop = F.when(F.col("n_rows") < self.tail_below, F.col("n_rows") - F.ceil(F.col("n_rows") * F.lit(self.tail))).otherwise(F.col("n_rows"))
        return (F.col("row_num") <= stop) & (F.col("y") < 1 if self.below else F.lit(True))


@dataclass(frozen=True)
class Unit:
    """One ensemble: which rows it learns from, and how. Parameters that are None come from `params`.

    A forest is a set of units of one tree each, with rows drawn by `bootstrap`.
    """

    program_id: int
    features: tuple[str, ...]
    params: ModelConfig
    span: Span = Span()
    member: str = "boosted"
    objective: str = "absolute"  # absolute, squared, or logistic (the class is a label below 1)
    bootstrap: bool = False
    trees: int | None = None
    depth: int | None = None
    step: float | None = None
    l1: float | None = None
    l2: float | None = None
    first_tree: int = 0
    trial: int = 0
    base: float = 0.0

    def of(self, name: str):
        own = getattr(self, name)
        return getattr(self.params, name) if own is None else own

    def seed_of(self, tree: int) -> int:
        return self.params.seed * 1_000_003 + (self.first_tree + tree) * 7919 + self.trial * 104_729

    def drawn(self, tree: int) -> list[str]:
        """Features that a tree may cut."""
        share = self.params.feature_fraction
        if share == "all" or self.bootstrap:
            return list(self.features)
        take = max(1, round(float(share) * len(self.features)))
        chosen = np.random.default_rng(self.seed_of(tree)).permutation(len(self.features))[:take]
        return [self.features[k] for k in sorted(chosen)]


@dataclass
class Tree:
    """A tree in heap order: children of node i are 2 i + 1 and 2 i + 2; feature -1 is a leaf."""

    feature: np.ndarray
    at: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    open: set[int] = field(default_factory=lambda: {0})

    @staticmethod
    def seedling(depth: int) -> "Tree":
        n = (2 << depth) - 1
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.uint8), *(np.zeros(n) for _ in range(3)))

    def split(self, node: int, feature: int, at: int, gain: float, left: tuple, right: tuple, l1: float, l2: float) -> None:
        """Cut a node; (sum of gradients, sum of weights) of its children give their values."""
        self.feature[node], self.at[node], self.gain[node] = feature, at, gain
        for child, (g, h) in ((2 * node + 1, left), (2 * node + 2, right)):
            self.value[child], self.cover[child] = leaf_value(g, h, l1, l2), h

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(len(self.feature).bit_length() - 1):
            by = self.feature[node]
            if (by < 0).all():
                break
            right = bins[rows, np.maximum(by, 0)] > self.at[node]
            node = np.where(by >= 0, 2 * node + 1 + right, node)
        return node


def shrunk(g: float, l1: float) -> float:
    return max(abs(g) - l1, 0.0)


def leaf_value(g: float, h: float, l1: float, l2: float) -> float:
    return -np.sign(g) * shrunk(g, l1) / (h + l2) if h + l2 > 0 else 0.0


def gradient(objective: str, score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if objective == "absolute":
        return np.sign(score - y), np.ones(len(y))
    if objective == "squared":
        return score - y, np.ones(len(y))
    p = 1.0 / (1.0 + np.exp(-score))
    return p - (y < 1), p * (1.0 - p)


def uniform(row: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row number, the same in every pass."""
    x = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def copies(row: np.ndarray, seed: int) -> np.ndarray:
    """How often a bootstrap sample holds each row: Poisson with mean 1."""
    u, n, below, chance = uniform(row, seed), np.zeros(len(row)), np.zeros(len(row)), np.exp(-1.0)
    for k in range(1, 12):
        below = below + chance
        n += u >= below
        chance /= k
    return n


@dataclass(frozen=True)
class Block:
    """Rows of one program in a batch."""

    row_num: np.ndarray
    n: int
    y: np.ndarray
    w: np.ndarray
    bins: np.ndarray
    scores: np.ndarray  # rows x units of the program

    def weights(self, unit: Unit, tree: int) -> np.ndarray:
        """Weight of each row in a tree; 0 for rows the unit does not learn from."""
        seen = self.row_num <= unit.span.stop(self.n)
        if unit.span.below:
            seen &= self.y < 1
        w = np.where(seen, self.w, 0.0)
        if unit.bootstrap:
            return w * copies(self.row_num, unit.seed_of(tree))
        if unit.params.subsample < 1:
            w = np.where(uniform(self.row_num, unit.seed_of(tree)) < unit.params.subsample, w, 0.0)
        return w


def blocks_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, Block]]:
    """(program, places in the batch, rows) of each program in a batch."""
    column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
    program, row_num, n, y, w = (column(c) for c in ("program_id", "row_num", "n_rows", "y", "w"))
    bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).view(np.uint8).reshape(len(program), width)
    scores, starts = batch.column("scores").flatten().to_numpy(zero_copy_only=False), batch.column("scores").offsets.to_numpy()
    order = np.argsort(program, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(program[order])) + 1):
        if len(at):
            own = starts[at[0] + 1] - starts[at[0]]
            held = scores[(starts[at] - starts[0])[:, None] + np.arange(own)]
            yield int(program[at[0]]), at, Block(row_num[at], int(n[at[0]]), y[at], w[at], bins[at], held)


def best_of(g: np.ndarray, h: np.ndarray, l1: float, l2: float, least: float) -> tuple[np.ndarray, ...]:
    """(feature, bin, gain, gl, hl, gt, ht) of the best cut of each node, from sums by node, feature and bin."""
    gl, hl = g.cumsum(2), h.cumsum(2)
    gt, ht = gl[:, :, -1:], hl[:, :, -1:]
    gr, hr = gt - gl, ht - hl
    part = lambda a, b: np.maximum(np.abs(a) - l1, 0.0) ** 2 / np.where(b + l2 > 0, b + l2, 1.0)
    allowed = (hl >= least) & (hr >= least) & (hl > 0) & (hr > 0)
    gain = np.round(np.where(allowed, part(gl, hl) + part(gr, hr) - part(gt, ht), -1.0), GAIN_DIGITS).reshape(len(g), -1)
    at = gain.argmax(1)
    feature, bin_ = np.divmod(at, g.shape[2])
    node = np.arange(len(g))
    return feature, bin_, gain[node, at], gl[node, feature, bin_], hl[node, feature, bin_], gt[node, feature, 0], ht[node, feature, 0]


def summed(local: np.ndarray, bins: np.ndarray, values: Sequence[np.ndarray], nodes: int) -> list[np.ndarray]:
    """Sums of the values by (node, drawn feature, bin), flat."""
    width = bins.shape[1]
    place = ((local[:, None] * width + np.arange(width)) * BINS + bins).ravel()
    return [np.bincount(place, np.repeat(v, width), nodes * width * BINS) for v in values]


def whole_unit(unit: Unit, block: Block, position: Mapping[str, int]) -> tuple[list[Tree], np.ndarray]:
    """All trees of a unit, and the scores of the program's rows, if they are all here."""
    score, trees = np.full(len(block.y), unit.base), []
    l1, l2 = unit.of("l1"), unit.of("l2")
    for k in range(unit.of("trees")):
        t, w = Tree.seedling(unit.of("depth")), block.weights(unit, k)
        drawn = np.array([position[f] for f in unit.drawn(k)])
        seen = np.flatnonzero(w > 0)
        bins = block.bins[np.ix_(seen, drawn)]
        g, h = (x * w[seen] for x in gradient(unit.objective, score[seen], block.y[seen]))
        t.value[0], t.cover[0] = leaf_value(g.sum(), h.sum(), l1, l2), h.sum()
        node = np.zeros(len(seen), np.int64)
        for level in range(unit.of("depth")):
            first, nodes = (1 << level) - 1, 1 << level
            here = np.flatnonzero(node >= first)
            if not len(here):
                break
            sums = [x.reshape(nodes, len(drawn), BINS) for x in summed(node[here] - first, bins[here], (g[here], h[here]), nodes)]
            found = best_of(*sums, l1, l2, unit.params.min_instances)
            cut = np.flatnonzero(found[2] > 0)
            for i, feature, bin_, gain, gl, hl, gt, ht in zip(cut + first, *(x[cut] for x in found)):
                t.split(i, int(drawn[feature]), int(bin_), gain, (gl, hl), (gt - gl, ht - hl), l1, l2)
            at = node[here] - first
            goes_on = found[2][at] > 0
            here, at = here[goes_on], at[goes_on]
            node[here] = 2 * node[here] + 1 + (bins[here, found[0][at]] > found[1][at])
        trees.append(t)
        score = score + unit.of("step") * t.value[t.nodes_of(block.bins)]
    return trees, score


class Growing:
    """What a pass has to know: the units of each program, their trees since the last stage, and the trees that grow."""

    def __init__(self, units: Sequence[Unit], features: Sequence[str], kept: Callable[[Unit], bool], deals: int = 1):
        self.units, self.width, self.deals = list(units), len(features), deals
        self.kept = {i for i, u in enumerate(self.units) if kept(u)}
        self.position = {f: k for k, f in enumerate(features)}
        self.places: dict[int, list[int]] = defaultdict(list)
        self.carried: dict[int, list[int]] = defaultdict(list)  # units whose score a row carries, in order
        for i, u in enumerate(self.units):
            self.places[u.program_id].append(i)
            if not u.bootstrap:
                self.carried[u.program_id].append(i)
        self.since: list[list[Tree]] = [[] for _ in self.units]
        self.trees: dict[int, Tree] = {}
        self.drawn: dict[int, np.ndarray] = {}
        self.tree = self.level = 0

    def plant(self, tree: int, active: Iterable[int]) -> None:
        self.tree = tree
        self.trees = {i: Tree.seedling(self.units[i].of("depth")) for i in active}
        self.drawn = {i: np.array([self.position[f] for f in self.units[i].drawn(tree)]) for i in self.trees}

    def open_nodes(self, level: int) -> int:
        """Nodes to cut at a level; units that are deep enough have none."""
        self.level = level
        for i, t in self.trees.items():
            if level >= self.units[i].of("depth"):
                t.open = set()
        return sum(len(t.open) for t in self.trees.values())

    def cut(self, found: Iterable[Row]) -> None:
        """Put the best cuts of a level into the trees."""
        opened: dict[int, set[int]] = defaultdict(set)
        for r in found:
            i, node = r["unit"], r["node"]
            u, t = self.units[i], self.trees[i]
            if node == 0:
                t.value[0], t.cover[0] = leaf_value(r["gt"], r["ht"], u.of("l1"), u.of("l2")), r["ht"]
            if r["gain"] > 0:
                t.split(node, r["feature"], r["bin"], r["gain"], (r["gl"], r["hl"]), (r["gt"] - r["gl"], r["ht"] - r["hl"]), u.of("l1"), u.of("l2"))
                opened[i] |= {2 * node + 1, 2 * node + 2}
        for i, t in self.trees.items():
            t.open = opened[i]

    def started(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows with the score that each unit starts from."""
        for batch in batches:
            base = {p: [self.units[i].base for i in self.carried[p]] for p in self.places}
            lists = [base[p] for p in batch.column("program_id").to_pylist()]
            yield batch.append_column("scores", pa.array(lists, pa.list_(pa.float64())))

    def score(self, block: Block, unit: int) -> np.ndarray:
        """Score before the tree that grows; the trees of a forest start from 0."""
        own = self.carried[self.units[unit].program_id]
        if unit not in own:
            return np.zeros(len(block.y))
        out = block.scores[:, own.index(unit)]
        for t in self.since[unit]:
            out = out + self.units[unit].of("step") * t.value[t.nodes_of(block.bins)]
        return out

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Gradients and weights by (unit, node, feature, bin) of a task's rows."""
        held: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for program, _, block in blocks_of(batch, self.width):
                for unit in self.places[program]:
                    if unit not in self.trees or not self.trees[unit].open:
                        continue
                    u, tree, drawn = self.units[unit], self.trees[unit], self.drawn[unit]
                    w = block.weights(u, self.tree)
                    seen = np.flatnonzero(w > 0)
                    bins, w = block.bins[seen], w[seen]
                    g, h = gradient(u.objective, self.score(block, unit)[seen], block.y[seen])
                    node = tree.nodes_of(bins) - ((1 << self.level) - 1)
                    here = node >= 0  # others are in leaves above this level
                    both = np.stack(summed(node[here], bins[here][:, drawn], [(x * w)[here] for x in (g, h)], 1 << self.level))
                    if unit in held:
                        held[unit] += both
                    else:
                        held[unit] = both
                        size += both.size
                if size > HELD_SUMS:
                    yield from self.sent(held)
                    held, size = {}, 0
        yield from self.sent(held)

    def sent(self, held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for unit, (g, h) in held.items():
            u, drawn, at = self.units[unit], self.drawn[unit], np.flatnonzero(h)
            node, rest = np.divmod(at, len(drawn) * BINS)
            feature, bin_ = np.divmod(rest, BINS)
            constant = [float(x) for x in (u.of("l1"), u.of("l2"), u.params.min_instances)]
            columns = [
                np.full(len(at), unit, np.int32), *(np.full(len(at), x) for x in constant), (node + (1 << self.level) - 1).astype(np.int32),
                drawn[feature].astype(np.int32), bin_.astype(np.int32), g[at], h[at],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=SUMS)

    def advanced(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows with their scores after the trees since the last stage."""
        for batch in batches:
            lists: list = [[]] * batch.num_rows
            for program, at, block in blocks_of(batch, self.width):
                new = [self.score(block, u) for u in self.carried[program]]
                for k, row in zip(at, np.stack(new, 1) if new else ()):
                    lists[k] = row
            place = batch.schema.get_field_index("scores")
            yield batch.set_column(place, batch.schema.field(place), pa.array(lists, batch.schema.field(place).type))

    def tested(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """unit, y, score of the rows that a fold is tested on."""
        for batch in batches:
            for program, _, block in blocks_of(batch, self.width):
                for column, unit in enumerate(self.carried[program]):
                    span = self.units[unit].span
                    at = np.flatnonzero((block.row_num > span.stop(block.n)) & (block.row_num <= span.test_stop(block.n))) if span.fold >= 0 else []
                    if len(at):
                        columns = [np.full(len(at), unit, np.int32), block.y[at], block.scores[at, column]]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["unit", "y", "score"])

    def finished(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All trees of the units of whole programs: rows of RESULT. Batches come in the order of (dealt, program_id)."""
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            dealt, program = (batch.column(c).to_numpy() for c in ("dealt", "program_id"))
            starts = np.append(0, np.flatnonzero((np.diff(dealt) != 0) | (np.diff(program) != 0)) + 1)
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                if b > a and (dealt[a], program[a]) != key:
                    yield from self.finish(key, held)
                    key, held = (dealt[a], program[a]), []
                held.append(batch.slice(a, b - a))
        yield from self.finish(key, held)

    def finish(self, key: tuple[int, int] | None, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        dealt, program = key
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        (_, _, block), = blocks_of(rows, self.width)
        for unit in self.places[program][dealt :: self.deals]:
            u = self.units[unit]
            trees, score = whole_unit(u, block, self.position)
            if unit in self.kept:
                made = [x for k, t in enumerate(trees) for x in node_rows(u, k, t)] + base_row(u)
                yield result(len(made), kind="node", unit=unit, **{f.name: [r[i] for r in made] for i, f in enumerate(NODE_FIELDS)})
            if u.span.fold >= 0:
                at = np.flatnonzero((block.row_num > u.span.stop(block.n)) & (block.row_num <= u.span.test_stop(block.n)))
                yield result(len(at), kind="test", unit=unit, y=block.y[at], score=score[at])


def best_cuts(sums: DataFrame, partitions: int) -> DataFrame:
    """unit, node, feature, bin, gain, gl, hl, gt, ht: the best cut of each node; without a gain above 0, the node is a leaf.

    One exchange by (unit, node) serves the sums, the running sums and the choice.
    """
    by = ["unit", "l1", "l2", "least", "node", "feature"]
    rows = sums.repartition(partitions, "unit", "node").groupBy(*by, "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    every = Window.partitionBy("unit", "node", "feature")
    left = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(*by, "bin", *[F.sum(x).over(w).alias(x + s) for s, w in (("l", left), ("t", every)) for x in "gh"])
    gained = F.expr(
        "power(greatest(abs(gl) - l1, 0), 2) / (hl + l2) + power(greatest(abs(gt - gl) - l1, 0), 2) / (ht - hl + l2)"
        " - power(greatest(abs(gt) - l1, 0), 2) / (ht + l2)"
    )
    allowed = F.expr("hl >= least and ht - hl >= least and hl > 0 and ht - hl > 0")
    rows = rows.withColumn("gain", F.round(F.when(allowed, gained).otherwise(F.lit(-1.0)), GAIN_DIGITS))
    best = F.max_by(F.struct("feature", "bin", "gain", "gl", "hl", "gt", "ht"), F.struct("gain", -F.col("feature"), -F.col("bin")))
    return rows.groupBy("unit", "node").agg(best.alias("best")).select("unit", "node", "best.*")


def quantile_cuts(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """program_id, cuts: for each feature the distinct values that bins end at, by quantiles of the program's rows."""
    at = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    cuts = [F.coalesce(F.array_sort(F.array_distinct(F.percentile_approx(F.col(f).cast("double"), at, F.lit(10_000)))), F.array().cast("array<double>")) for f in features]
    return rows.groupBy(F.col("program_id").alias("_program_id")).agg(F.array(*cuts).alias("cuts"))


def binned(rows: DataFrame, cuts: DataFrame, features: Sequence[str], y: Column, w: Column) -> DataFrame:
    """program_id, row_num, n_rows, y, w, bins: the number of cuts below each feature's value, as bytes."""
    columns = ["program_id", "slot_ts", "channel_id"]
    narrow = rows.select(*columns, y.cast("double").alias("y"), w.cast("double").alias("w"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    ordered = numbered(narrow, ["program_id"], ["slot_ts", "channel_id"], F.to_date("slot_ts"))
    joined = ordered.join(cuts, F.col("program_id") == F.col("_program_id"))
    below = F.zip_with("x", "cuts", lambda x, c: F.size(F.filter(c, lambda v: v < x)).cast("byte"))
    return joined.select("program_id", F.col("row_num").cast("long"), F.col("n_rows").cast("long"), "y", "w", below.alias("bins"))


def started_units(rows: DataFrame, units: Sequence[Unit]) -> list[Unit]:
    """Units with the score they start from: the median label of their rows for absolute errors, else 0."""
    spans = list(dict.fromkeys(u.span for u in units if u.objective == "absolute"))
    if not spans:
        return list(units)
    medians = [F.percentile_approx(F.when(s.column() & (F.col("w") > 0), F.col("y")), F.lit(0.5), F.lit(1_000_000)) for s in spans]
    found = {r["program_id"]: r["m"] for r in rows.groupBy("program_id").agg(F.array(*medians).alias("m")).collect()}
    base = lambda u: found.get(u.program_id, [None] * len(spans))[spans.index(u.span)]
    return [replace(u, base=float(base(u) or 0.0)) if u.objective == "absolute" else u for u in units]


def node_rows(unit: Unit, tree: int, t: Tree) -> Iterator[tuple]:
    """A grown tree as rows of NODE_FIELDS."""
    todo = [0]
    while todo:
        i = todo.pop()
        split = t.feature[i] >= 0
        kids = (2 * i + 1, 2 * i + 2) if split else (-1, -1)
        cut = (int(t.feature[i]), int(t.at[i])) if split else (None, None)
        yield (unit.program_id, unit.member, unit.first_tree + tree, float(unit.of("step")), i, *kids, *cut, float(t.value[i]), float(t.cover[i]), float(t.gain[i]))
        todo += kids if split else ()


def base_row(unit: Unit) -> list[tuple]:
    """The score a unit starts from, as a tree of one leaf."""
    return [(unit.program_id, unit.member, -1, 1.0, 0, -1, -1, None, None, unit.base, 1.0, 0.0)] if unit.objective == "absolute" else []


def result(n: int, **values) -> pa.RecordBatch:
    """A batch of RESULT; columns without a value are null."""
    def column(f: pa.Field) -> pa.Array:
        v = values.get(f.name)
        return pa.nulls(n, f.type) if v is None else pa.array([v] * n if isinstance(v, (str, int)) else v, f.type)

    return pa.RecordBatch.from_arrays([column(f) for f in RESULT], schema=RESULT)


@dataclass(frozen=True)
class Prepared:
    """Binned rows of some programs, for any number of runs."""

    features: tuple[str, ...]
    cuts: DataFrame
    rows: DataFrame
    sizes: dict[int, int]


def prepare(rows: DataFrame, features: Mapping[int, Sequence[str]], y: Column, w: Column | None = None) -> Prepared:
    """Eager: two stages, and the number of rows of each program on the driver. Rows without a label are left out."""
    names = tuple(dict.fromkeys(f for fs in features.values() for f in fs))
    rows = rows.where(F.col("program_id").isin(sorted(features)) & y.isNotNull())
    cuts = staged(quantile_cuts(rows, names), "cuts")
    made = staged(binned(rows, cuts, names, y, F.lit(1.0) if w is None else w), "binned")
    return Prepared(names, cuts, made, {r["program_id"]: r["count"] for r in made.groupBy("program_id").count().collect()})


@dataclass(frozen=True)
class Grown:
    """What `grow` leaves: stages of the kept trees and of the folds' test rows."""

    units: list[Unit]
    prepared: Prepared
    raw_nodes: DataFrame
    fold_scores: DataFrame  # unit, y, score, in the space the units were fitted in

    def nodes(self) -> DataFrame:
        """Node table (NODE_SCHEMA); bins become thresholds by a join with the cuts."""
        cuts = self.prepared.cuts.select("_program_id", F.posexplode("cuts").alias("_position", "_cuts"))
        names = F.array(*[F.lit(f) for f in self.prepared.features]).cast("array<string>")
        found = self.raw_nodes.join(cuts, (F.col("program_id") == F.col("_program_id")) & (F.col("position") == F.col("_position")), "left")
        return found.select(
            "program_id", "member", "tree", "weight", "node", "left", "right", F.get(names, F.col("position")).alias("feature"),
            F.get("_cuts", F.col("bin")).alias("threshold"), "value", "cover", "gain",
        )


def grow(prepared: Prepared, units: Sequence[Unit], keep: Callable[[Unit], bool] = lambda u: True) -> Grown:
    """Grow all units; `keep` says whose trees are stored. Eager."""
    units = started_units(prepared.rows, units)
    large = [prepared.sizes.get(u.program_id, 0) > WHOLE_ROWS for u in units]
    parts = [grow_whole(prepared, units, [not x for x in large], keep), grow_by_levels(prepared, units, large, keep)]
    parts = [p for p in parts if p is not None]
    spark = prepared.rows.sparkSession
    nodes = [p[0] for p in parts] or [spark.createDataFrame([], from_arrow_schema(NODE_FIELDS))]
    tests = [p[1] for p in parts] or [spark.createDataFrame([], "unit int, y double, score double")]
    return Grown(units, prepared, reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, tests))


def grow_whole(prepared: Prepared, units: list[Unit], chosen: list[bool], keep) -> tuple[DataFrame, DataFrame] | None:
    """Units whose programs fit a task: one pass. With few programs, a program's units are dealt to several tasks with its rows."""
    own = {u.program_id for u, c in zip(units, chosen) if c}
    if not own:
        return None
    spark = prepared.rows.sparkSession
    slots = spark.sparkContext.defaultParallelism
    most = max(sum(u.program_id == p for u in units) for p in own)
    deals = max(1, min(most, -(-2 * slots // len(own))))
    growing = Growing(units, prepared.features, keep, deals)
    rows = prepared.rows.where(F.col("program_id").isin(sorted(own)))
    work = sum(prepared.sizes.get(p, 0) * len(growing.places[p]) for p in own)
    tasks = max(1, min(len(own) * deals, 4 * slots), work // MOST_WORK)
    dealt = rows.withColumn("dealt", F.explode(F.sequence(F.lit(0), F.lit(deals - 1)))).withColumn("scores", F.array().cast("array<double>"))
    # Keys are few and large: dealt by hash, some tasks would get several and others none.
    spread = dealt.repartitionByRange(tasks, "dealt", "program_id").sortWithinPartitions("dealt", "program_id", "row_num")
    path = new_stage(spark, "grown")
    spread.mapInArrow(growing.finished, from_arrow_schema(RESULT)).write.partitionBy("kind").parquet(path)
    done = spark.read.schema(from_arrow_schema(RESULT)).parquet(path)
    return done.where("kind = 'node'").select(*NODE_FIELDS.names), done.where("kind = 'test'").select("unit", "y", "score")


def grow_by_levels(prepared: Prepared, units: list[Unit], chosen: list[bool], keep) -> tuple[DataFrame, DataFrame] | None:
    """Units of large programs: trees x depth aggregates, and a stage of the rows' scores every TREES_PER_STAGE trees."""
    active = [i for i, c in enumerate(chosen) if c]
    if not active:
        return None
    spark = prepared.rows.sparkSession
    growing = Growing(units, prepared.features, keep)
    own = sorted({units[i].program_id for i in active})
    base = prepared.rows.where(F.col("program_id").isin(own))
    load = sum(prepared.sizes[p] * len(growing.places[p]) for p in own)
    slots = spark.sparkContext.defaultParallelism
    tasks = max(1, min(slots, load // LEAST_WORK), load // MOST_WORK)
    spread = base.repartition(tasks, "program_id", F.expr(f"row_num div {WHOLE_ROWS}"))
    schema = T.StructType([*spread.schema.fields, T.StructField("scores", T.ArrayType(T.DoubleType()))])
    current = staged(spread.mapInArrow(growing.started, schema), "scores").persist(StorageLevel.MEMORY_AND_DISK)
    node_schema, paths = from_arrow_schema(NODE_FIELDS), []
    ready = [r for i in active if i in growing.kept for r in base_row(units[i])]
    last = max(units[i].of("trees") for i in active)
    for tree in range(last):
        growing.plant(tree, [i for i in active if tree < units[i].of("trees")])
        level = 0
        while (open_nodes := growing.open_nodes(level)) > 0:
            partitions = max(1, min(open_nodes // 64, 4 * slots))
            growing.cut(best_cuts(current.mapInArrow(growing.sums, SUM_COLUMNS), partitions).collect())
            level += 1
        for i, t in growing.trees.items():
            growing.since[i].append(t)
            if i in growing.kept:
                ready += node_rows(units[i], tree, t)
        growing.trees = {}
        if (tree + 1) % TREES_PER_STAGE == 0 or tree + 1 == last:
            done = staged(current.mapInArrow(growing.advanced, schema), "scores")
            current.unpersist()
            current = done.persist(StorageLevel.MEMORY_AND_DISK) if tree + 1 < last else done
            growing.since = [[] for _ in units]
            spark.createDataFrame(ready, node_schema).write.parquet(path := new_stage(spark, "nodes"))
            paths, ready = [*paths, path], []
    return spark.read.schema(node_schema).parquet(*paths), current.mapInArrow(growing.tested, "unit int, y double, score double")
