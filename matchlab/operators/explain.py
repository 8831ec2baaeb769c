"""Per-row attributions. Boosted trees: exact path-dependent Shapley values of every leaf, summed in mapInPandas tasks.
Linear models: coefficient times distance from the mean, as columns. Base + sum of attributions is the raw margin."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import label
from .boosting import Boosted, Tree
from .modeling import CORE


def _leaves(tree: Tree, node: int, path: dict, out: list) -> None:
    """(value, {feature: (low, high, share of the cover that follows)}) of each leaf; a row goes left where x <= threshold."""
    f = int(tree.feature[node])
    if f < 0:
        out.append((float(tree.value[node]), path))
        return
    for child, left in ((2 * node + 1, True), (2 * node + 2, False)):
        lo, hi, share = path.get(f, (-math.inf, math.inf, 1.0))
        share *= float(tree.cover[child] / tree.cover[node])
        t = float(tree.threshold[node])
        _leaves(tree, child, path | {f: (lo, min(hi, t), share) if left else (max(lo, t), hi, share)}, out)


def tree_leaves(model: Boosted) -> list:
    """Every leaf of a boosted model; bounded by trees times two to the depth."""
    out: list = []
    for tree in model.trees:
        _leaves(tree, 0, {}, out)
    return out


def leaf_attributions(x: np.ndarray, leaves: list) -> tuple[float, np.ndarray]:
    """(base, attributions): a leaf is worth its value times, for each path feature, whether the row follows the path
    (feature known) or the share of rows that do (unknown).

    The worth of all sets of k known features is a coefficient of the product of (share + follows * t) over the path:
    the product grows by one factor a feature, and the sets without a feature come from taking its factor out again. So
    a leaf takes the square of its features, not two to their number."""
    base, phi = 0.0, np.zeros_like(x)
    for value, path in leaves:
        m = len(path)
        known = [((x[:, f] > lo) | ((lo == -math.inf) & np.isnan(x[:, f]))) & ((x[:, f] <= hi) | np.isnan(x[:, f])) for f, (lo, hi, _) in path.items()]
        share = [z for _, _, z in path.values()]
        base += value * math.prod(share)
        if not m:
            continue
        sets = np.zeros((m + 1, len(x)))  # row k: worth of all sets of k known features
        sets[0] = 1.0
        for i, (o, z) in enumerate(zip(known, share)):
            grown = sets[: i + 1] * o
            sets[: i + 1] *= z
            sets[1 : i + 2] += grown
        w = [math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) for k in range(m)]
        for f, o, z in zip(path, known, share):
            part, left = np.zeros(len(x)), np.zeros(len(x))
            for k in range(m - 1, -1, -1):  # factor out (share + t) where the row follows, share where it doesn't
                left = np.where(o, sets[k + 1] - z * left, sets[k] / z)
                part += w[k] * left
            phi[:, f] += value * part * (o.astype(float) - z)
    return base, phi


def explain(model: PipelineModel | Boosted, df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, base, and one column per feature. Base and attributions sum to the log odds."""
    rows = df.select(*keys, *(F.col(c).cast("double").alias(c) for c in CORE))
    if isinstance(model, Boosted):
        leaves, start = tree_leaves(model), model.base
        names = [f for f in rows.schema.names if f in keys]

        def run(batches):
            for pdf in batches:
                base, phi = leaf_attributions(pdf[CORE].to_numpy(float), leaves)
                yield pd.concat([pdf[names].reset_index(drop=True), pd.DataFrame({"base": start + base}, index=range(len(pdf))), pd.DataFrame(phi, columns=CORE)], axis=1)

        kinds = dict(rows.dtypes)
        return rows.mapInPandas(run, ", ".join([*(f"{k} {kinds[k]}" for k in names), "base double", *(f"{c} double" for c in CORE)]))
    scaler, last = model.stages[1], model.stages[-1]
    coef, mean, std = last.coefficients.toArray(), scaler.mean.toArray(), scaler.std.toArray()
    part = {c: (F.col(c) - float(mean[i])) * float(coef[i] / std[i] if std[i] else 0.0) for i, c in enumerate(CORE)}
    return rows.select(*keys, F.lit(float(last.intercept)).alias("base"), *(v.alias(c) for c, v in part.items()))


def long_form(explained: DataFrame, keys: list[str]) -> DataFrame:
    return explained.unpivot([*keys, "base"], CORE, "feature", "value")


def attribution_summary(explained: DataFrame, keys: list[str]) -> DataFrame:
    """feature, mean_abs, base."""
    return long_form(explained, keys).groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"), F.first("base").alias("base"))


def explain_matchup(explained: DataFrame, keys: list[str]) -> DataFrame:
    """One row per feature, labelled, with the side it favours, largest first."""
    rows = long_form(explained, keys)
    return rows.select(*keys, label(F.col("feature")).alias("feature"), "value", F.when(F.col("value") > 0, "Favors player 1").otherwise("Favors player 2").alias("favors")).orderBy(*keys, F.desc(F.abs("value")), "feature")
