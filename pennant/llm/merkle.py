"""A Merkle manifest of a dataset by checkpoint and recompute.

Leaves are hashes of rows.  Within a group, in order, every ``RUN`` consecutive nodes (the last run: fewer, even one)
become their hash, until one node remains.  Of these levels only every ``LEVELS``-th is stored, as one row for each
aligned subtree of ``RUN ** LEVELS`` stored nodes; the levels between are never written.  Proof extraction goes from
the top down: each subtree's interior nodes are made anew from its stored nodes, the siblings on every path are
emitted, and the nodes are dropped again.  A row never holds more than one subtree, so memory is bounded whatever the
size of a group, and a group that holds a third of all rows is spread over as many tasks as it has subtrees.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.llm.common import small, written

RUN, LEVELS = 8, 3
#: Stored nodes of one aligned subtree.
SUBTREE = RUN ** LEVELS
_PATH = "array<struct<left:string,right:string>>"


def field(c: Column) -> Column:
    """A value as ``length:value`` with its length in UTF-8 bytes; ``-`` if null."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def row_hash(*columns: Column) -> Column:
    """Lowercase hex sha256 of all fields, one after another."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def run_hash(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def group_key(c: Column) -> Column:
    """A group's sort key that is never null: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def _placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos`` (from 0, without gaps in each group) and ``n`` (the group's leaves) by one range exchange.

    Rows are numbered inside their partition as they are written; a group's numbers before a partition come from one
    count per (group, partition), of which there are at most groups + partitions.
    """
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["group", *order]
    ranged = leaves.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    ranged = written(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    own = ranged.groupBy("group", "_part").agg(F.count("*").alias("_own"), F.min("_at").alias("_first"))
    w = Window.partitionBy("group").orderBy("_part")
    own = own.select("group", "_part", "_first", F.sum("_own").over(Window.partitionBy("group")).alias("n"),
                     F.coalesce(F.sum("_own").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (ranged.join(small(own), ["group", "_part"])
            .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before"))


def _subtrees(nodes: DataFrame, name: str) -> DataFrame:
    """Stores nodes as one row per aligned subtree: ``group``, ``n`` (the group's nodes at this level), ``block``, ``nodes``."""
    carried = [c for c in nodes.columns if c not in ("group", "n", "pos", "hash")]
    one = F.struct("pos", "hash", *carried)
    made = nodes.groupBy("group", "n", F.expr(f"pos div {SUBTREE}").alias("block")).agg(F.sort_array(F.collect_list(one)).alias("nodes"))
    return written(made, name)


def _interior(stored: DataFrame) -> DataFrame:
    """The subtrees' levels made anew: ``_l0`` (stored) to the one that stands for the subtree; null above a group's root."""
    out = stored.withColumn("_l0", F.transform("nodes", lambda x: x["hash"]))
    for i in range(LEVELS):
        below = F.col(f"_l{i}")
        runs = F.transform(F.sequence(F.lit(0), F.expr(f"(size(_l{i}) - 1) div {RUN}")),
                           lambda r: run_hash(F.slice(F.col(f"_l{i}"), r * RUN + 1, F.lit(RUN))))  # noqa: B023
        out = out.withColumn(f"_l{i + 1}", F.when(below.isNotNull() & ((F.col("n") > SUBTREE) | (F.size(below) > 1)), runs))
    return out


def _root_of(levels: int = LEVELS) -> Column:
    return F.coalesce(*[F.get(F.col(f"_l{i}"), F.lit(0)) for i in range(levels, -1, -1)])


class Tree:
    """A stored tree over every group: ``steps[k]`` holds level k * LEVELS, ``roots`` one row (``group``, ``root``) each."""

    def __init__(self, leaves: DataFrame, order: list[str], name: str):
        """``leaves``: ``group`` (not null), ``hash``, the columns of ``order``, and what else a leaf carries."""
        self.steps = [_subtrees(_placed(leaves, order), f"merkle-{name}-0")]
        roots = []
        while True:
            made = _interior(self.steps[-1]).select("group", "n", "block", _root_of().alias("hash"))
            roots.append(made.where(F.col("n") <= SUBTREE).select("group", F.col("hash").alias("root")))
            up = made.where(F.col("n") > SUBTREE).select("group", F.ceil(F.col("n") / SUBTREE).alias("n"), F.col("block").alias("pos"), "hash")
            if not self.steps[-1].where(F.col("n") > SUBTREE).limit(1).count():
                break
            self.steps.append(_subtrees(up, f"merkle-{name}-{len(self.steps)}"))
        self.roots = written(reduce(DataFrame.unionByName, roots), f"merkle-{name}-roots")

    def proofs(self, above: DataFrame) -> DataFrame:
        """One row per leaf: what it carries, ``hash``, ``path`` (siblings to the left and right at each level, upwards),
        and the columns of ``above`` (``group``, ``path`` from the group's root upwards, others)."""
        extra = [c for c in above.columns if c not in ("group", "path")]
        below = None
        for k in range(len(self.steps) - 1, -1, -1):
            stored = self.steps[k]
            trees = stored.where(F.col("n") <= SUBTREE).join(small(above), "group")
            if below is not None:
                tops = below.select("group", F.col("pos").alias("block"), "path", *extra)
                trees = trees.unionByName(stored.where(F.col("n") > SUBTREE).join(tops, ["group", "block"]))
            made = _interior(trees)
            one = F.transform(F.sequence(F.lit(0), F.size("nodes") - 1),
                              lambda i: F.struct(F.get("nodes", i).alias("node"), self._siblings(i).alias("own")))
            rows = made.select("group", "path", *extra, F.explode(one).alias("_one"))
            below = rows.select("group", "_one.node.*", F.concat("_one.own", "path").alias("path"), *extra)
        return below

    @staticmethod
    def _siblings(i: Column) -> Column:
        """The siblings of a subtree's i-th stored node at each of its levels that has a parent."""
        levels = []
        for j in range(LEVELS):
            at = F.floor(i / RUN ** j).cast("int")
            run = F.floor(i / RUN ** (j + 1)).cast("int") * RUN
            side = F.struct(F.array_join(F.slice(f"_l{j}", run + 1, at - run), "").alias("left"),
                            F.array_join(F.slice(f"_l{j}", at + 2, run + RUN - 1 - at), "").alias("right"))
            levels.append(F.when(F.col(f"_l{j + 1}").isNotNull(), side))
        return F.filter(F.array(*levels), lambda x: x.isNotNull()).cast(_PATH)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, x: F.sha2(F.concat(x["left"], node, x["right"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def manifest(docs: DataFrame, leaf: Column, group: Column, order: list[Column], carry: dict[str, Column]) -> tuple[DataFrame, str | None]:
    """A proof for every row, and the root over all groups (null without rows).

    Per row: ``group`` (its key), the columns of ``carry``, ``leaf``, ``subroot`` (its group's), ``path`` (its siblings
    at each level, over the subroot up to the root).  Groups stand in the order of their keys, null first, then
    bytewise; leaves within a group in ``order`` (nulls first), ties by the leaf itself.

    Null groups are one group; empty and long texts are hashed whole; rows that repeat are leaves of their own, with
    equal hashes at neighbouring places; an empty table gives an empty result and no root; only the columns that are
    named take part, so others may have any names.
    """
    by = [f"_o{i}" for i in range(len(order))]
    leaves = docs.select(group_key(group).alias("group"), leaf.alias("hash"), *[c.alias(n) for n, c in zip(by, order)],
                         *[c.alias(n) for n, c in carry.items()])
    tree = Tree(leaves, [*by, "hash"], "leaves")
    groups = Tree(tree.roots.select(F.lit("").alias("group"), F.col("root").alias("hash"), F.col("group").alias("of")), ["of"], "groups")
    found = groups.roots.first()
    start = groups.roots.select("group", F.array().cast(_PATH).alias("path"))
    above = groups.proofs(start).select(F.col("of").alias("group"), F.col("hash").alias("subroot"), "path")
    rows = tree.proofs(above).select("group", *carry, F.col("hash").alias("leaf"), "subroot", "path")
    return rows, found["root"] if found else None
