"""Exact additive attribution of tree ensembles (path-dependent Shapley values).

A leaf contributes value * prod(follows) over the features on its path, where an
unknown feature counts with the share of training rows that went the leaf's
way. For such a product the Shapley value of a feature is a weighted sum of
elementary symmetric polynomials of the other features on the path. It depends on
the row only by which features of the path it follows: a leaf with d of them has a
table of 2^d patterns, and a row looks its pattern up. See Lundberg et al.,
"Consistent Individualized Feature Attribution for Tree Ensembles".
"""

from __future__ import annotations

from collections.abc import Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from slotwise.functions.numbers import from_target_space, publishable
from slotwise.operators.drivers import contributions

GROUP_ROWS = 20_000  # rows of a program that a worker holds at a time, about
NODE_COLUMNS = ["program_id", "tree", "weight", "node", "left", "right", "feature", "threshold", "value", "cover"]


def leaves_of(nodes: pd.DataFrame, names: Sequence[str]) -> list[tuple]:
    """Leaves of all trees: (weighted value, [(feature, low, high, share)])."""
    position = {f: i for i, f in enumerate(names)}
    out = []
    for _, tree in nodes.groupby("tree"):
        by_id = {r.node: r for r in tree.itertuples()}
        stack = [(0, {})]
        while stack:
            node_id, path = stack.pop()
            node = by_id[node_id]
            if node.left < 0:
                out.append((node.weight * node.value, [(f, *v) for f, v in path.items()]))
                continue
            f = position[node.feature]
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            for child, lo, hi in (
                (node.left, low, min(high, node.threshold)),
                (node.right, max(low, node.threshold), high),
            ):
                part = by_id[child].cover / node.cover if node.cover else 0.0
                stack.append((child, {**path, f: (lo, hi, share * part)}))
    return out


def pattern_table(value: float, shares: Sequence[float]) -> np.ndarray:
    """Impact of each feature of a path (columns) for each pattern of followed features (rows; bit j is feature j)."""
    d = len(shares)
    follows = np.arange(1 << d)[:, None] >> np.arange(d) & 1
    order = [factorial(s) * factorial(d - 1 - s) / factorial(d) for s in range(d)]
    out = np.zeros((1 << d, d))
    for i in range(d):
        poly = [np.ones(1 << d)]  # poly[s]: sum over subsets of size s of the other features
        for j in range(d):
            if j == i:
                continue
            grown = [p * shares[j] for p in poly] + [np.zeros(1 << d)]
            for s, p in enumerate(poly):
                grown[s + 1] = grown[s + 1] + p * follows[:, j]
            poly = grown
        out[:, i] = value * (follows[:, i] - shares[i]) * sum(o * p for o, p in zip(order, poly))
    return out


def explain_rows(x: np.ndarray, leaves: list[tuple]) -> tuple[np.ndarray, np.ndarray, float]:
    """(impacts n x k, raw prediction n, base value) for the rows of x."""
    columns = np.ascontiguousarray(x.T)
    k, n = columns.shape
    impacts, raw, base = np.zeros((k, n)), np.zeros(n), 0.0
    for value, path in leaves:
        shares = [p[3] for p in path]
        base += value * float(np.prod(shares))
        pattern = np.zeros(n, np.int64)
        for j, (f, low, high, _) in enumerate(path):
            pattern |= ((columns[f] > low) & (columns[f] <= high)).astype(np.int64) << j
        raw += value * (pattern == (1 << len(path)) - 1)
        for (f, *_), impact in zip(path, pattern_table(value, shares).T):
            impacts[f] += impact[pattern]
    return impacts.T, raw, base


def explain_trees(df: DataFrame, nodes: DataFrame, features: dict[int, Sequence[str]], attribute: bool = True) -> DataFrame:
    """Adds features, impacts, base_value and raw_value; programs without a model drop out.

    Rows are dealt by (program, salt), about GROUP_ROWS to a group; a program's nodes go to each of its groups, so a worker
    reads the nodes of one program next to some of its rows. No node comes to the driver.
    """
    lacking = {p: sorted(set(fs) - set(df.columns)) for p, fs in features.items()}
    if any(lacking.values()):
        raise ValueError("features that the models expect and the rows lack: " + "; ".join(f"program {p}: {', '.join(fs)}" for p, fs in sorted(lacking.items()) if fs))
    programs = sorted(features)
    used = sorted({f for fs in features.values() for f in fs})
    rows = df.where(F.col("program_id").isin(programs))
    groups = rows.groupBy(F.col("program_id").alias("_program_id")).agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("_groups"))
    mark = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, AtomicType)])
    # The model inputs travel as doubles next to the untouched columns.
    inputs = [F.col(f).cast("double").alias(f"_in_{f}") for f in used]
    dealt = rows.join(groups, F.col("program_id") == F.col("_program_id"))
    sent = dealt.select(*[f"`{c}`" for c in df.columns], *inputs, F.col("_program_id").alias("_model"), F.pmod(mark, "_groups").cast("int").alias("_salt"))
    trees = nodes.select(*NODE_COLUMNS).join(groups, F.col("program_id") == F.col("_program_id"))
    trees = trees.select(*NODE_COLUMNS, F.col("_program_id").alias("_model"), F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_salt"))
    extra = "features array<string>, impacts array<double>, base_value double, raw_value double"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def work(key: tuple, part: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        names = list(features[int(key[0])])
        part = part if len(own) else part.head(0)  # no model, no row
        leaves = leaves_of(own, names)
        x = part[[f"_in_{f}" for f in names]].to_numpy(dtype="float64")
        impacts, raw, base = explain_rows(x, leaves) if attribute else (None, score_rows(x, leaves), 0.0)
        part = part.drop(columns=[f"_in_{f}" for f in used] + ["_model", "_salt"])
        part["features"] = [names] * len(part)
        part["impacts"] = list(impacts) if attribute else [[]] * len(part)
        part["base_value"] = base
        part["raw_value"] = raw
        return part

    keys = ("_model", "_salt")
    return sent.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInPandas(work, f"{schema}, {extra}")


def score_rows(x: np.ndarray, leaves: list[tuple]) -> np.ndarray:
    raw = np.zeros(len(x))
    for value, path in leaves:
        hit = np.ones(len(x), dtype=bool)
        for f, lo, hi, _ in path:
            hit &= (x[:, f] > lo) & (x[:, f] <= hi)
        raw += value * hit
    return raw


def score_trees(
    df: DataFrame, nodes: DataFrame, features: dict[int, Sequence[str]], target_transform: bool = True,
    orient: str = "model", attribute: bool = True,
) -> DataFrame:
    """Prediction and contribution array of every row.

    In transformed target space a positive contribution lowers the service
    level. orient='model' keeps the model's sign; orient='sl' flips it so that
    positive always means a better service level.
    """
    if orient not in ("model", "sl"):
        raise ValueError("orient is 'model' or 'sl'")
    out = explain_trees(df, nodes, features, attribute)
    sign = -1.0 if orient == "sl" and target_transform else 1.0
    level = from_target_space("raw_value") if target_transform else F.col("raw_value")
    impacts = F.transform("impacts", lambda x: x * F.lit(sign))
    return out.withColumns(
        {"sl_pred": publishable(level, "vol_plan"), "contribs": contributions(F.col("features"), impacts)}
    ).drop("features", "impacts")
