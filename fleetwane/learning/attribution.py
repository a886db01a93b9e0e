"""Tree attributions (SHAP values, path-dependent) as column expressions.

What a leaf adds to a feature depends only on which features of its path the row agrees with,
and a path has few features. So each leaf becomes a number, one bit per feature of its path,
and a table of constants per feature that is looked up by that number. The tables come from
the node table (cover of each node) and are as large as the model; rows are only compared
with thresholds, inside compiled code, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwane.learning import nodes as N

#: Different features on one path at most: a leaf's tables have 2 ** features entries for each.
MOST_ON_PATH = 12


@dataclass(frozen=True)
class Leaf:
    """A leaf's value and, per feature on its path, the interval (low, high] and the share of rows that take these turns."""

    value: float
    intervals: dict[int, tuple[float, float]]
    shares: dict[int, float]


def leaves(tree: Sequence[N.Node], scale: float = 1.0) -> list[Leaf]:
    """The leaves of a tree; values are multiplied by ``scale``."""
    out, open_ = [], [(0, {}, {})]
    while open_:
        i, intervals, shares = open_.pop()
        node = tree[i]
        if node.left < 0:
            if len(shares) > MOST_ON_PATH:
                raise ValueError(f"a path has {len(shares)} different features, more than {MOST_ON_PATH}")
            out.append(Leaf(node.prediction * scale, intervals, shares))
            continue
        low, high = intervals.get(node.feature, (-math.inf, math.inf))
        for child, interval in ((node.left, (low, min(high, node.threshold))), (node.right, (max(low, node.threshold), high))):
            share = shares.get(node.feature, 1.0) * tree[child].stats[0] / node.stats[0]
            open_.append((child, intervals | {node.feature: interval}, shares | {node.feature: share}))
    return out


def leaf_tables(leaf: Leaf) -> dict[int, list[float]]:
    """Per feature of the path: what the leaf adds to it, by the number of the features the row agrees with (bit k: the k-th)."""
    features = list(leaf.shares)
    d = len(features)
    weight = [math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)]
    tables = {}
    for i, feature in enumerate(features):
        others = [(k, leaf.shares[f]) for k, f in enumerate(features) if k != i]
        table = []
        for agreed in range(1 << d):
            # by number of features taken from the row: the sum over subsets of products of shares of the others
            sums = [1.0]
            for k, share in others:
                taken = agreed >> k & 1
                sums = [(sums[j] * share if j < len(sums) else 0.0) + (sums[j - 1] * taken if j else 0.0) for j in range(len(sums) + 1)]
            own = (agreed >> i & 1) - leaf.shares[feature]
            table.append(leaf.value * own * sum(w * s for w, s in zip(weight, sums)))
        tables[feature] = table
    return tables


def ensemble(model, *, mean: bool) -> list[Leaf]:
    """The leaves of all trees of a model, with the trees' weights."""
    weights, trees = list(model.treeWeights), {}
    for r in N.node_table(model).collect():  # the model
        trees.setdefault(r.tree, []).append(N.Node(**({k: v for k, v in r.asDict().items() if k != "tree"} | {"stats": tuple(r.stats)})))
    total = sum(weights) if mean else 1.0
    return [leaf for k, tree in sorted(trees.items()) for leaf in leaves(sorted(tree, key=lambda n: n.id), weights[k] / total)]


def _number(leaf: Leaf) -> str:
    """SQL of the bits of the features whose interval holds the row's value."""
    bits = []
    for k, (feature, (low, high)) in enumerate(leaf.intervals.items()):
        tests = [f"cells[{feature}] > {low!r}D"] * (low > -math.inf) + [f"cells[{feature}] <= {high!r}D"] * (high < math.inf)
        bits.append(f"CASE WHEN {' AND '.join(tests)} THEN {1 << k} ELSE 0 END")
    return " + ".join(bits)


def attributions(df: DataFrame, model, features: Sequence[str], *, mean: bool, vector: str = "features", suffix: str = "_share") -> DataFrame:
    """df with ``expected`` and a column per feature; they add up to the prediction. ``mean`` for forests, else a sum of trees."""
    all_leaves = ensemble(model, mean=mean)
    expected = sum(leaf.value * math.prod(leaf.shares.values()) for leaf in all_leaves)
    split = [leaf for leaf in all_leaves if leaf.shares]
    terms: dict[int, list[str]] = {}
    for number, leaf in enumerate(split):
        for feature, table in leaf_tables(leaf).items():
            constants = ", ".join(f"{value!r}D" for value in table)
            terms.setdefault(feature, []).append(f"element_at(array({constants}), 1 + numbers[{number}])")
    numbers = F.expr(f"array({', '.join(map(_number, split))})") if split else F.array().cast("array<int>")
    placed = df.withColumn("cells", vector_to_array(vector)).withColumn("numbers", numbers)
    added = {f"{name}{suffix}": F.expr(" + ".join(terms[i])) if i in terms else F.lit(0.0) for i, name in enumerate(features)}
    return placed.withColumns({"expected": F.lit(float(expected)), **added}).drop("cells", "numbers")
