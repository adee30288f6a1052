"""Random search over random forests with cross-validation (ML29, TK8).

A search is some tens of thousands of trees, each small beside a cluster, so trees are the unit of work: Spark deals
out (setting, fold, range of trees) and a task grows its trees on the binned training rows, which all fits share.
Nothing is grown twice:

* a forest of fewer trees is a prefix of a larger one with the same settings;
* a tree grown to depth d is a deeper tree cut at d (each tree's random draws go level by level);
* so parameter maps that agree in the least rows per leaf and in the number of features tried at a node share one
  forest per fold, as deep and as large as the largest of them needs, and each map reads its votes off that forest.

A task returns votes, not trees; votes of a (map, fold) are added up and turned into the area under the ROC curve of the
held-out and of the training rows in the next stage.  The search is fitted on at most ``most_rows`` rows (the first by
a hash of their keys); the best map can be fitted again on all rows by MLlib.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.operators.split import kfold

#: Bound of the rows that a search is fitted on; bins of a feature; trees of a task.
MOST_ROWS, BINS, CHUNK = 50_000, 32, 50
_VOTES = "param_index int, fold int, votes binary"
_SCORES = "param_index int, fold int, score double, train_score double"


def subset_size(strategy: str, features: int) -> int:
    """Features tried at a node."""
    return {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features)))}[strategy]


def binned(x: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Columns cut at their quantiles into at most ``bins`` bins."""
    out = np.zeros(x.shape, np.uint8)
    for j in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) if len(x) else np.zeros(0)
        out[:, j] = np.searchsorted(cuts, x[:, j], side="left")
    return out


def best_splits(x: np.ndarray, slot: np.ndarray, stats: np.ndarray, features: np.ndarray, total: np.ndarray, leaf: int):
    """For each open node (``slot``: a row's node) the best split by Gini impurity: gain, feature, highest bin to the left.

    ``stats`` holds each row's weight, positive weight and count, ``features`` the features tried per node, ``total`` the
    nodes' sums.  Only bins that occur are looked at, so the work follows the rows, not nodes x bins.
    """
    nodes, m = features.shape
    key = ((slot[:, None] * m + np.arange(m)) * 256 + np.take_along_axis(x, features[slot], 1)).ravel()
    order = np.argsort(key)
    key = key[order]
    sums = np.cumsum(stats[order // m], axis=0)
    segment = key >> 8
    cut = np.flatnonzero((key[1:] != key[:-1]) & (segment[1:] == segment[:-1]))
    gain, feature, place = np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, np.int64)
    if not len(cut):
        return gain, feature, place
    start = np.searchsorted(segment, segment[cut])
    left = sums[cut] - np.where(start[:, None] > 0, sums[start - 1], 0)
    node = segment[cut] // m
    right = total[node] - left
    purity = lambda t: (t[:, 1] ** 2 + (t[:, 0] - t[:, 1]) ** 2) / np.maximum(t[:, 0], 1e-300)
    value = purity(left) + purity(right) - purity(total)[node]
    value[(left[:, 2] < leaf) | (right[:, 2] < leaf)] = -1
    first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    best = np.maximum.reduceat(value, first)
    hit = np.flatnonzero(value == np.repeat(best, np.diff(np.append(first, len(node)))))
    own, at = np.unique(node[hit], return_index=True)                       # of equal gains the first
    pick = hit[at]
    gain[own], place[own] = value[pick], key[cut[pick]] & 255
    feature[own] = features[own, segment[cut[pick]] % m]
    return gain, feature, place


class Tree:
    """One tree: per node a feature (-1: none), the highest bin to the left, the left child, the share of positives."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rows: np.ndarray, depth: int, leaf: int, m: int, rng: np.random.Generator):
        count = rng.poisson(1.0, len(rows))
        rows, count = rows[count > 0], count[count > 0]
        if not len(rows):
            rows, count = np.arange(len(y))[:0], count[:0]
        x = x[rows]
        stats = np.stack([count * weight[rows], count * weight[rows] * y[rows], count], 1).astype(np.float64)
        slot, size, base = np.zeros(len(rows), np.int64), 1, 0
        levels = []
        for level in range(depth + 1):
            total = np.stack([np.bincount(slot, stats[:, i], size) for i in range(3)], 1)
            feature, place, child = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
            value = total[:, 1] / np.maximum(total[:, 0], 1e-300)
            levels.append((feature, place, child, value))
            open_ = np.flatnonzero((total[:, 1] > 0) & (total[:, 1] < total[:, 0]) & (total[:, 2] >= 2 * leaf))
            if level == depth or not len(open_):
                break
            tried = rng.random((size, x.shape[1])).argsort(axis=1)[open_, :m]
            number = np.full(size, -1)
            number[open_] = np.arange(len(open_))
            inside = np.flatnonzero(number[slot] >= 0)
            x, stats, slot = x[inside], stats[inside], slot[inside]
            gain, chosen, at = best_splits(x, number[slot], stats, tried, total[open_], leaf)
            split = open_[gain > 1e-9]
            feature[split], place[split] = chosen[gain > 1e-9], at[gain > 1e-9]
            child[split] = base + size + 2 * np.arange(len(split))
            inside = np.flatnonzero(feature[slot] >= 0)
            x, stats, slot = x[inside], stats[inside], slot[inside]
            right = x[np.arange(len(x)), feature[slot]] > place[slot]
            slot = child[slot] - base - size + right
            base, size = base + size, 2 * len(split)
            if not size:
                break
        self.feature, self.place, self.child, self.value = (np.concatenate(c) for c in zip(*levels))

    def values(self, x: np.ndarray, depths: list[int]) -> dict[int, np.ndarray]:
        """Each row's share of positives in the tree cut at each of ``depths``."""
        at, out = np.zeros(len(x), np.int64), {}
        for d in range(max(depths) + 1):
            if d in depths:
                out[d] = self.value[at]
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                out.update({e: self.value[at] for e in depths if e > d})
                break
            here = at[inner]
            at[inner] = self.child[here] + (x[inner, self.feature[here]] > self.place[here])
        return out


def area_under_roc(score: np.ndarray, label: np.ndarray) -> float | None:
    """Chance that a positive row scores above a negative one, ties one half; None unless both classes occur."""
    pos = int(label.sum())
    if not 0 < pos < len(label):
        return None
    _, which, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = np.cumsum(n) - (n - 1) / 2
    return float((rank[which][label > 0].sum() - pos * (pos + 1) / 2) / (pos * (len(label) - pos)))


def training_rows(train: DataFrame, keys, k: int, seed: int, label: str, weight: str, features: str, most_rows: int) -> dict:
    """The shared frame of a search: bins, labels, weights and folds of at most ``most_rows`` rows."""
    rows = kfold(train, keys, k, seed).select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
                                              F.col(weight).cast("double").alias("w"), "fold", F.xxhash64(*keys).alias("h"), *keys)
    got = rows.orderBy("h", *keys).limit(most_rows).select("x", "y", "w", "fold").toPandas()
    x = np.stack(got["x"].tolist()) if len(got) else np.zeros((0, 1))
    return {"x": binned(x), "y": got["y"].to_numpy(np.float64), "w": got["w"].to_numpy(np.float64), "fold": got["fold"].to_numpy(np.int64)}


def search_tasks(maps: list[dict], features: int, k: int, chunk: int = CHUNK) -> list[tuple]:
    """(setting's least rows per leaf, features tried, fold, first tree, tree behind the last, the maps that share it)."""
    shared: dict[tuple, list[int]] = {}
    for i, p in enumerate(maps):
        shared.setdefault((p["minInstancesPerNode"], subset_size(p["featureSubsetStrategy"], features)), []).append(i)
    tasks = []
    for (leaf, m), own in shared.items():
        most = max(maps[i]["numTrees"] for i in own)
        tasks += [(leaf, m, f, low, min(low + chunk, most), own) for f in range(k) for low in range(0, most, chunk)]
    return sorted(tasks, key=lambda t: (-t[1], t[0], t[2], t[3]))              # the longest first


def forest_search(spark: SparkSession, train: DataFrame, keys, maps: list[dict], k: int = 5, seed: int = 42, label: str = "label",
                  weight: str = "weight", features: str = "features", most_rows: int = MOST_ROWS) -> DataFrame:
    """ML29 — one row per map: mean, std, min and max over the folds of the area under the ROC curve of held-out rows, the
    mean on training rows and its gap.  Folds whose held-out rows are of one class have no score and are left out."""
    frame = training_rows(train, keys, k, seed, label, weight, features, most_rows)
    tasks = search_tasks(maps, frame["x"].shape[1], k)
    held = spark.sparkContext.broadcast(frame)

    def votes(batches):
        data = held.value
        for batch in batches:
            for t in batch.itertuples():
                own = [int(i) for i in t.maps]
                rows = np.flatnonzero(data["fold"] != t.fold)
                depths = sorted({maps[i]["maxDepth"] for i in own})
                total = {i: np.zeros(len(data["y"])) for i in own}
                for n in range(t.low, t.high):
                    wanted = [i for i in own if n < maps[i]["numTrees"]]
                    tree = Tree(data["x"], data["y"], data["w"], rows, max(depths), t.leaf, t.m, np.random.default_rng([seed, t.m, t.leaf, t.fold, n]))
                    value = tree.values(data["x"], depths)
                    for i in wanted:
                        total[i] += value[maps[i]["maxDepth"]]
                yield pd.DataFrame({"param_index": own, "fold": t.fold, "votes": [total[i].tobytes() for i in own]})

    def scores(key, part):
        total = np.sum([np.frombuffer(v) for v in part["votes"]], axis=0) if len(part) else np.zeros(0)
        total = np.round(total, 9)                                             # the same for any order of the parts
        out = held.value["fold"] == key[1]
        y = held.value["y"]
        return pd.DataFrame([(key[0], key[1], area_under_roc(total[out], y[out]), area_under_roc(total[~out], y[~out]))],
                            columns=["param_index", "fold", "score", "train_score"])

    jobs = spark.createDataFrame(tasks, "leaf int, m int, fold int, low int, high int, maps array<int>")
    jobs = jobs.repartition(max(1, min(len(tasks), 8 * spark.sparkContext.defaultParallelism)))
    per = jobs.mapInPandas(votes, _VOTES).groupBy("param_index", "fold").applyInPandas(scores, _SCORES)
    named = spark.createDataFrame([(i, str(p)) for i, p in enumerate(maps)], "param_index int, params string")
    table = per.groupBy("param_index").agg(
        F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"), F.min("score").alias("min_score"),
        F.max("score").alias("max_score"), F.avg("train_score").alias("train_score"))
    return named.join(table, "param_index").withColumn("train_gap", F.col("train_score") - F.col("mean_score"))


def best_forest(train: DataFrame, table: DataFrame, maps: list[dict], estimator):
    """The best map's forest, fitted by MLlib on all rows; ties go to the first map."""
    first = table.where("mean_score is not null").orderBy(F.desc("mean_score"), "param_index").first()
    chosen = maps[first["param_index"] if first else 0]
    return estimator.copy({estimator.getParam(name): value for name, value in chosen.items()}).fit(train)
