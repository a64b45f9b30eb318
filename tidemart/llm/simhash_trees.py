"""SimHash near-duplicates: all fingerprints within a Hamming radius, found with vantage-point trees.

Random 64-bit fingerprints lie almost all 32 bits apart, so a tree over the whole distance prunes little. The bits are
therefore split into ``trees`` blocks with one tree each: a pair within the radius differs by at most
``radius // trees`` bits in some block, and Hamming distance inside a block obeys the triangle inequality too, so each
tree looks for pairs within that small radius of its block's distance. Inner nodes hold a vantage point and a median
distance. A fingerprint lies in one leaf (its shard); it also visits, as a guest, the leaves of higher number that its
ball overlaps. Inside a shard the same tree goes on down to small blocks, whose pairs are compared over all 64 bits.
Every pair within the radius meets in some shard, whatever the tree looks like.

The upper trees are built from a bounded sample of distinct fingerprints; they decide only where the work is done.
Shards that hold more than ``SHARD_ROWS`` rows are cut into blocks whose pairs are tasks of their own. Shards return a
spanning forest of their links instead of all pairs, and components join the forests.

Defined cases: null text is the empty text; texts without words have fingerprint zero and link like any others; null
``doc_id`` is never a component's name unless all are null; repeated rows share a component; a table without rows gives
none; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.components import components
from tidemart.llm.work import lower_ascii, small_batches, staged, text_of

SHINGLE, SEED, RADIUS, TREES = 4, 42, 4, 3
# distinct fingerprints the upper trees are built from, at most
SAMPLE = 20_000
# fingerprints of a task, and of a block whose pairs are compared without a tree
SHARD_ROWS, LEAF_ROWS = 1 << 18, 192
# fingerprints that go through the upper trees together, rows dealt at once, and pairs compared at once
STEP_ROWS, DEAL_ROWS, PAIRS = 1 << 15, 1 << 18, 1 << 20
CHUNK = 1 << 14


# --- fingerprints


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the hashes of the word shingles of a lower-cased text."""
    words = text.split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    size = min(shingle, len(words))
    begins = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(begins), CHUNK):
        spans = zip(begins[at : at + CHUNK], stops[at : at + CHUNK], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(begins), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id") -> DataFrame:
    """``key, fp``: the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(t, shingle) for t in batch.column("text").to_pylist()], "u8")
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found.view("i8"))], [key, "fp"])

    small_batches(docs.sparkSession)
    texts = docs.select(F.col(key).cast("long").alias(key), lower_ascii(text_of()).cast("binary").alias("text"))
    return texts.mapInArrow(run, f"{key} long, fp long")


# --- trees


def block_masks(trees: int) -> list[int]:
    edges = [64 * i // trees for i in range(trees + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _away(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask)


def _split(points: np.ndarray, mask: np.uint64) -> tuple[np.uint64, int] | None:
    """A vantage point and the distance that halves ``points``; None if all are equally far from it."""
    for vantage in (points[0], points[len(points) // 2], points[-1]):
        away = _away(points, vantage, mask)
        middle = int(np.median(away))
        if middle == away.max():
            middle -= 1
        if away.min() <= middle < away.max():
            return vantage, middle
    return None


class Tree:
    """The upper part of a vantage-point tree over one block of bits; leaves are numbered from left to right."""

    def __init__(self, sample: np.ndarray, mask: int, radius: int, leaves: int):
        self.mask, self.radius, self.n = np.uint64(mask), radius, 0
        self.root = self._grow(sample, max(1, leaves))

    def _grow(self, points: np.ndarray, leaves: int):
        split = _split(points, self.mask) if leaves > 1 and len(points) > 1 else None
        if split is None:
            self.n += 1
            return self.n - 1
        vantage, middle = split
        near = _away(points, vantage, self.mask) <= middle
        # a median distance may be that of many points: each side gets leaves by its share
        left = min(max(1, round(leaves * float(near.mean()))), leaves - 1)
        return vantage, middle, self._grow(points[near], left), self._grow(points[~near], leaves - left)

    def shards(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each visit: the point's place, the leaf, and whether the point is a guest there.

        A point crosses from its own half only to the right: of a pair across a boundary, the left one visits.
        """
        places, leaves, homes = [], [], []
        stack = [(self.root, np.arange(len(points)), np.ones(len(points), bool))]
        while stack:
            node, at, home = stack.pop()
            if isinstance(node, int):
                places.append(at)
                leaves.append(np.full(len(at), node, np.int64))
                homes.append(home)
                continue
            vantage, middle, left, right = node
            away = _away(points[at], vantage, self.mask).astype(np.int64)
            inside = away <= middle
            to_left = np.where(home, inside, away - self.radius <= middle)
            to_right = away + self.radius > middle
            stack.append((left, at[to_left], home[to_left]))
            stack.append((right, at[to_right], (home & ~inside)[to_right]))
        return np.concatenate(places), np.concatenate(leaves), ~np.concatenate(homes)


# --- pairs inside a shard


class Links:
    """A spanning forest of the links found between the points of one task."""

    def __init__(self, n: int):
        self.label, self.waiting, self.n_waiting = np.arange(n), [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.waiting.append((a, b))
            self.n_waiting += len(a)
            if self.n_waiting > 1 << 18:
                self.join()

    def join(self) -> np.ndarray:
        if not self.waiting:
            return self.label
        a, b = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        self.waiting, self.n_waiting, label = [], 0, self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return label
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                shorter = label[label]
                if (shorter == label).all():
                    break
                label[:] = shorter


class ShardJoin:
    """Pairs within ``radius`` over all bits, by descending a vantage-point tree over one block of bits."""

    def __init__(self, points: np.ndarray, mask: int, block_radius: int, radius: int):
        self.points, self.mask, self.near, self.radius = points, np.uint64(mask), block_radius, radius
        self.links = Links(len(points))

    def among(self, at: np.ndarray) -> None:
        stack = [at]
        while stack:
            at = stack.pop()
            split = _split(self.points[at], self.mask) if len(at) > LEAF_ROWS else None
            if split is None:
                self._compare(at, at)
                continue
            away = _away(self.points[at], split[0], self.mask).astype(np.int64)
            inner, outer = away <= split[1], away > split[1]
            stack += [at[inner], at[outer]]
            self.across(at[inner & (away > split[1] - self.near)], at[outer & (away <= split[1] + self.near)])

    def across(self, left: np.ndarray, right: np.ndarray) -> None:
        stack = [(left, right)]
        while stack:
            a, b = stack.pop()
            if not len(a) or not len(b):
                continue
            larger = a if len(a) >= len(b) else b
            split = _split(self.points[larger], self.mask) if len(a) * len(b) > LEAF_ROWS**2 else None
            if split is None:
                self._compare(a, b)
                continue
            (vantage, middle), near = split, self.near
            da, db = (_away(self.points[x], vantage, self.mask).astype(np.int64) for x in (a, b))
            stack.append((a[da <= middle], b[db <= middle]))
            stack.append((a[da > middle], b[db > middle]))
            stack.append((a[(da <= middle) & (da > middle - near)], b[(db > middle) & (db <= middle + near)]))
            stack.append((a[(da > middle) & (da <= middle + near)], b[(db <= middle) & (db > middle - near)]))

    def _compare(self, a: np.ndarray, b: np.ndarray) -> None:
        """All pairs of ``a`` and ``b``, but those that the links found on the way join anyway."""
        stack = [(a, b, 1)]
        while stack:
            a, b, steps = stack.pop()
            done = steps * max(1, PAIRS // max(1, len(b)))
            self._pairs(a[:done], b)
            a = a[done:]
            if not len(a) or not len(b):
                continue
            label = self.links.join()
            seen, times = np.unique(label[b[:: 1 + len(b) // 256]], return_counts=True)
            most = seen[times.argmax()]
            joined = label[a] == most
            if 8 * joined.sum() > len(a):
                stack.append((a[joined], b[label[b] != most], 1))
                a = a[~joined]
            stack.append((a, b, 2 * steps))

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        step = max(1, PAIRS // max(1, len(b)))
        for at in range(0, len(a), step):
            part = a[at : at + step]
            near = np.bitwise_count(self.points[part][:, None] ^ self.points[b][None, :]) <= self.radius
            i, j = near.nonzero()
            i, j = part[i], b[j]
            apart = i != j
            self.links.add(i[apart], j[apart])

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        label = self.links.join()
        joined = np.flatnonzero(label != np.arange(len(label)))
        return self.points[joined], self.points[label[joined]]


# --- the distributed join


class Deal:
    """The tasks of a tree's leaves, numbered from ``first``; ``homes`` and ``guests`` are the rows of each leaf.

    A leaf is one task. Where it is large it is cut into blocks by a hash, and each pair of home blocks, and of a home
    and a guest block, is a task. Of a task's rows those of side 0 meet each other, those of sides 0 and 1 meet side 2.
    """

    def __init__(self, first: int, homes: np.ndarray, guests: np.ndarray):
        large = np.maximum(homes, guests) > SHARD_ROWS
        self.home_blocks = np.maximum(1, -(-homes // SHARD_ROWS))
        # none where the guests come to the only task
        self.guest_blocks = np.where(large, -(-guests // SHARD_ROWS), 0)
        sizes = self.home_blocks * (self.home_blocks + self.guest_blocks)
        self.first, self.end = first + np.cumsum(sizes) - sizes, first + int(sizes.sum())

    def rows(self, leaf: np.ndarray, guest: np.ndarray, points: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows ``task, side, fp`` of visits to leaves."""
        n_tasks = self.home_blocks[leaf] + np.where(guest, 0, self.guest_blocks[leaf])
        step = max(1, DEAL_ROWS // int(n_tasks.max(initial=1)))
        for at in range(0, len(leaf), step):
            here = slice(at, at + step)
            task, side, row = self._tasks(leaf[here], guest[here], points[here], n_tasks[here])
            columns = [pa.array(task), pa.array(side.astype("i4")), pa.array(points[here][row].view("i8"))]
            yield pa.RecordBatch.from_arrays(columns, ["task", "side", "fp"])

    def _tasks(self, leaf, guest, points, n_tasks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spread = (points * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
        block = spread % np.where(guest, np.maximum(1, self.guest_blocks[leaf]), self.home_blocks[leaf])
        row = np.repeat(np.arange(len(leaf)), n_tasks)
        other = np.arange(len(row)) - np.repeat(np.cumsum(n_tasks) - n_tasks, n_tasks)
        leaf, guest, block = leaf[row], guest[row], block[row]
        homes, guests = self.home_blocks[leaf], self.guest_blocks[leaf]
        # a row at home meets all home blocks, then all guest blocks; a guest meets all home blocks
        at_home = ~guest & (other < homes)
        a, b = np.minimum(block, other), np.maximum(block, other)
        own, visitor = np.where(guest, other, block), np.where(guest, block, other - homes)
        task = np.where(at_home, a * homes + b, np.where(guests > 0, homes * homes + own * guests + visitor, 0))
        side = np.where(at_home, np.where(a == b, 0, np.where(block == a, 1, 2)), np.where(guest, 2, 1))
        return self.first[leaf] + task, side, row


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Fingerprints, many at a time: a walk through the trees and their leaves takes about as long for few of them."""
    held, n = [], 0
    for batch in batches:
        held.append(batch.column("fp").to_numpy(zero_copy_only=False).view("u8"))
        n += len(held[-1])
        if n >= STEP_ROWS:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def links(distinct: DataFrame, radius: int = RADIUS, trees: int = TREES) -> DataFrame:
    """``a, b`` (both ``fp``): a forest that joins all fingerprints of ``distinct`` (column ``fp``) within ``radius``."""
    masks, near = block_masks(trees), radius // trees
    n = distinct.count()
    sample = distinct.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE).toPandas()["fp"].to_numpy("i8").view("u8")
    leaves = min(-(-n // (SHARD_ROWS // 2)), max(1, len(sample) // 16))
    forest = [Tree(sample, m, near, leaves) for m in masks] if len(sample) else []

    def visits(batches):
        for points in _steps(batches):
            for number, tree in enumerate(forest):
                _, leaf, guest = tree.shards(points)
                every, guests = (np.bincount(x, minlength=tree.n) for x in (leaf, leaf[guest]))
                columns = [np.full(tree.n, number, "i4"), np.arange(tree.n), every - guests, guests]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tree", "leaf", "home", "guest"])

    # one row for each leaf of the bounded trees
    counted = distinct.select("fp").mapInArrow(visits, "tree int, leaf long, home long, guest long")
    per_leaf = counted.groupBy("tree", "leaf").agg(F.sum("home").alias("home"), F.sum("guest").alias("guest")).collect()
    sizes = [np.zeros((2, tree.n), np.int64) for tree in forest]
    for r in per_leaf:
        sizes[r.tree][:, r.leaf] = r.home, r.guest
    deals, starts = [], []
    for homes, guests in sizes:
        starts.append(deals[-1].end if deals else 0)
        deals.append(Deal(starts[-1], homes, guests))

    def deal(batches):
        for points in _steps(batches):
            for tree, dealt in zip(forest, deals, strict=True):
                at, leaf, guest = tree.shards(points)
                yield from dealt.rows(leaf, guest, points[at])

    def join(key, rows):
        points, side = rows["fp"].to_numpy("i8").view("u8"), rows["side"].to_numpy()
        found = ShardJoin(points, masks[bisect_right(starts, key[0]) - 1], near, radius)
        found.among(np.flatnonzero(side == 0))
        found.across(np.flatnonzero(side < 2), np.flatnonzero(side == 2))
        a, b = found.forest()
        return pd.DataFrame({"a": a.view("i8"), "b": b.view("i8")})

    dealt = distinct.select("fp").mapInArrow(deal, "task long, side int, fp long")
    return dealt.groupBy("task").applyInPandas(join, "a long, b long")


def near_components(
    docs: DataFrame, radius: int = RADIUS, trees: int = TREES, shingle: int = SHINGLE, key: str = "doc_id"
) -> DataFrame:
    """``key, fp, component_id``: the smallest ``key`` reachable over links of at most ``radius`` bits."""
    prints = staged(fingerprints(docs, shingle, key), "prints")
    distinct = staged(prints.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
    label = components(links(distinct, radius, trees)).withColumnRenamed("node", "fp")
    joined = staged(
        distinct.join(label, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label")), "joined"
    )
    named = joined.groupBy("label").agg(F.min("first").alias("component_id"))
    return prints.join(joined.join(named, "label").select("fp", "component_id"), "fp").select(key, "fp", "component_id")


def hex_print(column: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


# --- one row of each group


def keyed(docs: DataFrame) -> DataFrame:
    """``_row, _key``: the rows of ``docs`` as structures, with a number that tells every row from all others.

    Numbers depend on how a table is cut into tasks, so they are written once.
    """
    return staged(docs.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_key")), "keyed")


def texts_of(rows: DataFrame) -> DataFrame:
    return rows.select("_key", F.col("_row.text").alias("text"))


def first_of_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Of the rows of each group (``_key, _group``) the one with the smallest ``doc_id`` (null last), then number."""
    doc_id = F.col("_row.doc_id").cast("long")
    place = rows.select("_key", F.struct(doc_id.isNull().alias("nameless"), doc_id.alias("doc_id"), "_key").alias("_place"))
    first = groups.join(place, "_key").groupBy("_group").agg(F.min("_place").alias("_first"))
    return rows.join(first.select(F.col("_first._key").alias("_key")), "_key", "left_semi").select("_row.*")


def one_per_component(docs: DataFrame, **settings: int) -> DataFrame:
    """One row of each group of near copies, whatever identifiers its rows have: the first by ``doc_id``, null last."""
    rows = keyed(docs)
    found = near_components(texts_of(rows), key="_key", **settings)
    return first_of_groups(rows, found.select("_key", F.col("component_id").alias("_group")))
