"""Merkle manifest of a dataset: a digest of every row, a tree of digests for each group, one root above the groups.

A group's rows are leaves in ascending key order. Every two consecutive nodes become the digest of both; a last node
without a neighbour becomes the digest of itself alone; that ends when one node remains, the group's root. The groups'
roots, in the order of the groups, are the leaves of one more tree, whose root stands for the dataset. A proof holds the
sibling of every node on the way from a leaf to that root, so whoever has a row and its proof can fold them to the root.

The work is done in superblocks of ``2 ** LEVELS`` consecutive nodes. On the way up each superblock becomes one node, and
these are nodes of the next layer, until a group has one. On the way down the nodes of a layer meet, by superblock, the
nodes outside it that their proofs need, and hand their own proofs down. In the lowest layer that meeting finishes all: the
reduction inside the superblock, the joining of inner and outer siblings, and the folding. No task holds more than a
superblock, nothing but the end of a layer reaches the driver, and a group of any size is spread over its superblocks.

Defined cases: a null field is marked as null, which no value is; null keys are first in their group; rows of one key are
in the order of their digests (repeated rows: any, their digests are the same); a null group is a group, first in
order; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.work import staged

LEVELS = 10
NODES = "tree string, place long, n long, node string"
OUTER = "tree string, block long, path array<string>, subroot string, root string"
PROVED = (
    "tree string, doc_id long, leaf string, subroot string, root string, path array<string>, "
    "folded_root string, verified boolean"
)


# --- digests


def field(value: Column) -> Column:
    """A value with its length before it, so that no two rows are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest(*nodes: str) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


# --- inside a superblock


def levels_of(nodes: list[str], n: int, height: int) -> list[list[str]]:
    """``nodes`` and the levels above them: ``height`` of them, or up to the root if the tree's ``n`` nodes fit."""
    levels = [nodes]
    while len(levels[-1]) > 1 if n <= 1 << height else len(levels) <= height:
        below = levels[-1]
        levels.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """For each level the side and digest of the neighbour, or nothing where there is none."""
    found = []
    for level in levels[:-1]:
        other = at ^ 1
        found.append(("L" if other < at else "R") + level[other] if other < len(level) else "")
        at >>= 1
    return found


def fold(leaf: str, path: Sequence[str]) -> str:
    """The root that a leaf and its proof lead to."""
    for step in path:
        other = step[1:]
        leaf = digest(other, leaf) if step[:1] == "L" else digest(leaf, other)
    return leaf


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, from leaf to root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), ""), 256)


# --- layers


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``place`` in the row's ``tree``, by ``order``, and ``n``, the tree's rows.

    Rows are sorted by range and written; a row's place is what earlier ranges hold of its tree and its place in its own.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = ["tree", *order, "_tie"]
    ranged = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    # the number of the range in the upper bits, the place in the range in the lower
    written = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33).alias("_part")
    slices = written.groupBy("tree", part).agg(F.count("*").alias("size"), F.min("_at").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = slices.select(
        "tree", "_part", "first", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("begin"),
        F.sum("size").over(Window.partitionBy("tree")).alias("n"),
    )
    return (
        written.withColumn("_part", part)
        .join(begins, ["tree", "_part"])
        .withColumn("place", F.col("begin") + F.col("_at") - F.col("first"))
        .drop("_part", "_at", "first", "begin")
    )


def block(levels: int) -> Column:
    return F.shiftright("place", levels).alias("block")


def climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The layers of all trees, and ``tree, node, height``: each tree's root and the layer that it came out of."""

    def reduced(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iat[0])
        top = levels_of(rows.sort_values("place")["node"].tolist(), n, levels)[-1]
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "n": [-(-n >> levels)], "node": top})

    layers, tops = [nodes.select("tree", "place", "n", "node")], []
    while True:
        up = staged(layers[-1].groupBy("tree", block(levels)).applyInPandas(reduced, NODES), "nodes")
        tops.append(up.where("n = 1").select("tree", "node", F.lit(len(layers) - 1).alias("height")))
        rest = up.where("n > 1")
        if rest.isEmpty():
            return layers, reduce(DataFrame.union, tops)
        layers.append(rest)


def outside(layers: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """What the proofs of each superblock of the lowest layer need from outside: one row of ``OUTER`` for each.

    ``tops`` holds that for whole trees, with the ``height`` of the layer where the tree is one superblock.
    """
    columns = ["tree", "block", "path", "subroot", "root"]

    def of_layer(n: int) -> DataFrame:
        return tops.where(F.col("height") == n).select(*columns)

    outer = of_layer(len(layers) - 1)
    for n in range(len(layers) - 1, 0, -1):
        outer = staged(descend(layers[n], outer, levels), "outer").union(of_layer(n - 1))
    return outer


def descend(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The outer siblings of the superblocks that the nodes of a layer stand for."""

    def joined(key: tuple, inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner = inner.sort_values("place")
        inside, row = levels_of(inner["node"].tolist(), int(inner["n"].iat[0]), levels), above.iloc[0]
        return pd.DataFrame(
            {
                "tree": key[0],
                "block": inner["place"],
                "path": [siblings(inside, i) + list(row["path"]) for i in range(len(inner))],
                # a tree of its own has its root as subroot
                "subroot": row["subroot"],
                "root": row["root"],
            }
        )

    return nodes.groupBy("tree", block(levels)).cogroup(outer.groupBy("tree", "block")).applyInPandas(joined, OUTER)


def prove(leaves: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Leaves and the outer nodes of their superblock meet: reduce, join the proofs, fold them."""

    def joined(key: tuple, inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner = inner.sort_values("place")
        leaf = inner["node"].tolist()
        inside, row = levels_of(leaf, int(inner["n"].iat[0]), levels), above.iloc[0]
        paths = [siblings(inside, i) + list(row["path"]) for i in range(len(leaf))]
        folded = [fold(c or x, p) for c, x, p in zip(inner["changed"], leaf, paths, strict=True)]
        return pd.DataFrame(
            {
                "tree": key[0],
                "doc_id": inner["doc_id"].astype("Int64"),
                "leaf": leaf,
                "subroot": row["subroot"],
                "root": row["root"],
                "path": paths,
                "folded_root": folded,
                "verified": [f == row["root"] for f in folded],
            }
        )

    return leaves.groupBy("tree", block(levels)).cogroup(outer.groupBy("tree", "block")).applyInPandas(joined, PROVED)


# --- the manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(
    docs: DataFrame,
    group: str = "lang",
    changed: dict[str, Column] | None = None,
    where: Column | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """``tree, doc_id, leaf, subroot, root, path, folded_root, verified`` for every row.

    ``changed`` replaces fields of the rows ``where`` before their proof is folded, as if somebody had altered them
    after the tree was built; ``verified`` tells whether row and proof still lead to the root. ``tree`` is empty for a
    null group, else ``+`` and the group.
    """
    own = row_digest(*[F.col(c) for c in FIELDS])
    other = F.lit(None).cast("string")
    if changed:
        other = F.when(where, row_digest(*[changed.get(c, F.col(c)) for c in FIELDS]))
    rows = docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), own.alias("node"), other.alias("changed"),
    )
    # places are given once
    leaves = staged(numbered(staged(rows, "leaves"), "doc_id", "node"), "places")
    layers, groups = climb(leaves, levels)
    subroots = staged(
        numbered(groups.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node", "height"), "name"), "subroots"
    )
    upper, roots = climb(subroots, levels)
    nothing = F.array().cast("array<string>")
    ends = roots.select(
        "tree", F.lit(0).cast("long").alias("block"), nothing.alias("path"), F.col("node").alias("subroot"),
        F.col("node").alias("root"), "height",
    )
    above = staged(descend(upper[0], outside(upper, ends, levels), levels), "above")
    tops = subroots.withColumnRenamed("place", "block").join(above.select("block", "path", "root"), "block").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("node").alias("subroot"), "root",
        "height",
    )
    return prove(leaves, outside(layers, staged(tops, "tops"), levels), levels)
