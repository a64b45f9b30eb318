"""Near copies by the likeness of their texts: groups of documents linked at ``SIMILAR`` percent of five-word shingles.

Likeness is the Jaccard share of distinct shingles (64-bit hashes). Groups are found in two steps. The first gathers
candidates: documents that agree in a MinHash band, and components of the fingerprint trees. A pair at 0.8 agrees in a
band of ``BAND`` rows with probability 0.26, in one of ``BANDS`` with 0.9998; more alike pairs miss each other less. The
second compares all pairs of each set of candidates exactly, by counting shared shingles over an index of them, and
links those that are alike. Candidates that aren't alike are not linked.

A task holds about ``BLOCK_BYTES`` of texts: larger sets are cut into blocks, and pairs of blocks are tasks. A document
that is in a group already is not looked for again, so a task's cost follows its documents where many are alike.

Defined cases: null text is the empty text; texts without words are alike; a text of fewer than five words is one
shingle; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.components import components
from tidemart.llm.simhash_trees import first_of_groups, keyed, near_components, texts_of
from tidemart.llm.work import lower_ascii, small_batches, staged, text_of

SHINGLE, SEED, SIMILAR = 5, 42, 80
BANDS, BAND = 28, 6
BLOCK_BYTES = 1 << 24
CHUNK = 1 << 11

_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 2**63, (BANDS * BAND, 1)).astype("u8") * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 2**63, (BANDS * BAND, 1)).astype("u8")


def shingles(text: bytes) -> np.ndarray:
    """The distinct hashes of a lower-cased text's shingles; a text without words has the hash of the empty one."""
    words = text.split()
    size = min(SHINGLE, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words], dtype=np.int64)
    begins = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist() if words else [0]
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(begins, stops, strict=True)], "u8"))


def bands(hashes: np.ndarray) -> list[int]:
    """One signed key for each band of the MinHash signature."""
    least = np.full(BANDS * BAND, np.iinfo("u8").max, "u8")
    for at in range(0, len(hashes), CHUNK):
        least = np.minimum(least, (hashes[at : at + CHUNK] * FACTORS + OFFSETS).min(1))
    rows = least.reshape(BANDS, BAND)
    return np.array([xxhash.xxh64_intdigest(rows[i].tobytes(), i) for i in range(BANDS)], "u8").view("i8").tolist()


def buckets(texts: DataFrame) -> DataFrame:
    """``_key, bucket``: the bands of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bands(shingles(t)) for t in batch.column("text").to_pylist()]
            keys = np.repeat(batch.column("_key").to_numpy(), BANDS)
            flat = np.array(found, "i8").reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(flat)], ["_key", "bucket"])

    small_batches(texts.sparkSession)
    return texts.select("_key", lower_ascii(text_of()).cast("binary").alias("text")).mapInArrow(
        run, "_key long, bucket long"
    )


class Index:
    """The sets of some documents by shingle."""

    def __init__(self, sets: list[np.ndarray], at: np.ndarray):
        self.at, self.sizes = at, np.array([len(sets[i]) for i in at])
        flat, owner = np.concatenate([sets[i] for i in at]), np.repeat(np.arange(len(at)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.hashes, self.owner = flat[order], owner[order]

    def alike(self, wanted: np.ndarray) -> np.ndarray:
        """Documents whose shingles are alike to ``wanted``."""
        begins = np.searchsorted(self.hashes, wanted, "left")
        n = np.searchsorted(self.hashes, wanted, "right") - begins
        places = np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(self.owner[places], minlength=len(self.at))
        return self.at[100 * shared >= SIMILAR * (self.sizes + len(wanted) - shared)]


def forest(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """A spanning forest of all pairs that are alike: places of linked documents."""
    a, b = [], []
    rest = np.ones(len(sets), bool)
    index, n_rest = Index(sets, np.arange(len(sets))), len(sets)
    for root in range(len(sets)):
        if not rest[root]:
            continue
        rest[root], n_rest, waiting = False, n_rest - 1, [root]
        while waiting and n_rest:
            if 2 * n_rest <= len(index.at):  # those found are not compared again
                index = Index(sets, np.flatnonzero(rest))
            at = waiting.pop()
            found = index.alike(sets[at])
            found = found[rest[found]]
            rest[found] = False
            n_rest -= len(found)
            a += [at] * len(found)
            b += found.tolist()
            waiting += found.tolist()
    return a, b


def links(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """``a, b``: a forest that joins all alike texts (``_key, text``) within the sets ``node, label`` of ``candidates``."""
    lowered = texts.select(F.col("_key").alias("node"), lower_ascii(text_of()).cast("binary").alias("text"))
    sizes = staged(
        candidates.join(lowered.select("node", F.octet_length("text").alias("size")), "node")
        .groupBy("label")
        .agg(F.ceil(F.sum("size") / BLOCK_BYTES).alias("n")),
        "sizes",
    )
    blocks = F.greatest(F.col("n"), F.lit(1))
    own = F.pmod(F.xxhash64("node"), blocks)
    placed = candidates.join(sizes, "label").select(
        "node", "label", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    )
    dealt = placed.join(lowered, "node").select(
        "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "text"
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        node = rows["node"].to_numpy()
        a, b = forest([shingles(t) for t in rows["text"]])
        return pd.DataFrame({"a": node[a], "b": node[b]}, dtype="i8")

    return dealt.groupBy("label", "i", "j").applyInPandas(run, "a long, b long")


def groups(rows: DataFrame) -> DataFrame:
    """``_key, _group`` of rows ``_row, _key``: the smallest number reachable over links of alike texts."""
    texts = texts_of(rows)
    met = staged(buckets(texts), "buckets")
    # a table of its own, so that a bucket of very many rows can be split over tasks in the join
    first = staged(
        met.groupBy("bucket").agg(F.min("_key").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts"
    )
    # a document and the firsts of its buckets are linked to the least of them only: edges follow documents, not bands
    firsts = met.join(first, "bucket").groupBy("_key").agg(F.min("a").alias("a"), F.collect_set("a").alias("firsts"))
    by_band = firsts.select("a", F.explode(F.array_union(F.array("_key"), "firsts")).alias("b")).where("a != b")
    trees = near_components(texts, shingle=SHINGLE, key="_key").where("component_id != _key")
    candidates = components(by_band.union(trees.select(F.col("component_id").alias("a"), F.col("_key").alias("b"))))
    label = components(links(texts, candidates)).withColumnRenamed("node", "_key")
    return rows.select("_key").join(label, "_key", "left").select("_key", F.coalesce("label", "_key").alias("_group"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: the first by ``doc_id``, null last."""
    rows = keyed(docs)
    return first_of_groups(rows, groups(rows))
