"""Source divergence audit: which terms a source uses more than its language does, and how far sources are apart.

Terms are runs of letters. A language keeps the terms of at least three (``least``) of its documents. They are found by iceberg
prefix refinement: the documents are read once for each length of byte prefixes, and prefixes that too few distinct
documents hold are discarded, so that the long tail of rare terms is cut off while it is short and never shuffled. A
term is looked at again, with a longer prefix, only if its last prefix was kept; the last reading counts complete
terms. What is kept of a level reaches the next as a table of bits of fixed size: a prefix that shares its bit with a kept
one is kept too long, never lost, and complete terms are counted exactly.

A group's share of a term is ``1 + floor(SCALE * (count + 1) / (N + V))`` with the group's ``N`` kept terms and the
language's ``V`` different ones; the distance of shares p and q is ``floor((p - q)^2 / q)``. All of it is exact. Distances of
two sources sum over all kept terms of the language. They are worked out for blocks of terms and tiles of sources, so no
task holds a whole language or pairs of its sources one by one, and only sums for each pair leave a task.

Defined cases: null text, language or source is the empty string; repeated rows are documents of their own; a group without
kept terms has the share of no occurrence for each term; a language without kept terms has distance 0; a table without
rows gives none; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.pieces import Pieces
from tidemart.llm.work import small_batches, staged

SCALE = 1_000_000_000
BITS_A_ROW = 8 * 4096
# bytes of rows whose terms are coded together
CHUNK_BYTES = 4 << 20


@dataclass(frozen=True)
class Settings:
    """``least`` documents keep a term; ``told`` over-used terms are reported for each group."""

    least: int = 3
    told: int = 200
    # lengths of prefixes in bytes, before the complete terms
    prefixes: tuple[int, ...] = (4, 8)
    # bits of a level's table: 4 MB
    bits: int = 1 << 25
    # entries that a task holds before it hands them on
    held: int = 250_000
    # terms of a block, sources of a tile
    block: int = 4096
    tile: int = 64


# bytes that end a term become spaces, A-Z lower case; bytes of letters beyond ASCII stay
SPACED = bytes(c if c >= 0x80 else ord(chr(c).lower()) if chr(c).isalpha() else 0x20 for c in range(256))


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before."""
    return np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1]))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, pa.Table]]:
    """The rows of each language, some megabytes of texts at a time."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if size > CHUNK_BYTES:
            yield from _by_lang(waiting)
            waiting, size = [], 0
            # a worker that waits for its next task holds no memory of the last chunks
            pa.default_memory_pool().release_unused()
    if waiting:
        yield from _by_lang(waiting)


def _by_lang(batches: list[pa.RecordBatch]) -> Iterator[tuple[bytes, pa.Table]]:
    """The rows of each language, in order of their sources."""
    rows = pa.Table.from_batches(batches)
    rows = rows.cast(pa.schema([(c, pa.large_binary()) for c in rows.column_names]))
    lang = rows["lang"].combine_chunks().dictionary_encode()
    codes = lang.indices.to_numpy()
    others = [rows[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in rows.column_names if c == "source"]
    order = np.lexsort((*others, codes))
    cuts = np.cumsum(np.bincount(codes, minlength=len(lang.dictionary)))[:-1]
    for name, at in zip(lang.dictionary.to_pylist(), np.split(order, cuts), strict=True):
        yield name, rows.take(at).combine_chunks()


class Sums:
    """Counts of a task by their keys, handed on when there are too many of them."""

    def __init__(self, keys: list[str], values: list[str], held: int):
        self.keys, self.values, self.held, self.parts, self.n = keys, values, held, [], 0
        self.schema = pa.schema([(k, pa.binary()) for k in keys] + [(v, pa.int64()) for v in values])

    def add(self, *columns: pa.Array) -> Iterator[pa.RecordBatch]:
        """Counts by keys that differ from each other."""
        self.parts.append(pa.table(columns, [*self.keys, *self.values]))
        self.n += len(columns[0])
        if self.n > 2 * self.held:
            self.join()
            if self.n > self.held:
                yield from self.told()

    def join(self) -> None:
        if len(self.parts) > 1:
            every = pa.concat_tables(self.parts).group_by(self.keys, use_threads=False)
            sums = every.aggregate([(v, "sum") for v in self.values])
            self.parts = [sums.select([*self.keys, *[f"{v}_sum" for v in self.values]]).rename_columns(self.schema.names)]
            self.n = sums.num_rows

    def told(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.join()
            yield from self.parts[0].cast(self.schema).to_batches(max_chunksize=50_000)
        self.parts, self.n = [], 0
        pa.default_memory_pool().release_unused()


class Kept:
    """Tells whether the last level kept a term's prefix, by the table of bits."""

    def __init__(self, settings: Settings, bits, before: int | None):
        self.table, self.size, self.before = bits.value if bits else None, settings.bits, before

    def places(self, lang: bytes, found: Pieces) -> np.ndarray:
        """Which of the distinct terms ``found`` in a language have a prefix that was kept."""
        if self.table is None:
            return np.ones(len(found.distinct), bool)
        seed, crc32 = zlib.crc32(lang + b"\0"), zlib.crc32
        place = np.array([crc32(p, seed) for p in found.firsts(self.before)], "i8") % self.size
        table = np.frombuffer(self.table, "u1")
        return (table[place >> 3] >> (place & 7).astype("u1") & 1).astype(bool)


def prefix_counts(docs: DataFrame, settings: Settings, bits, before: int | None, size: int) -> DataFrame:
    """``lang, prefix, docs``: distinct documents that hold a term of this prefix, summed up inside each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, sums = Kept(settings, bits, before), Sums(["lang", "prefix"], ["docs"], settings.held)
        for lang, rows in _chunks(batches):
            found = Pieces(rows["text"].combine_chunks(), SPACED)
            alive, n = kept.places(lang, found)[found.code], len(rows)
            prefixes = pa.array(found.firsts(size), pa.large_binary()).dictionary_encode()
            of_term = prefixes.indices.to_numpy().astype("i8")
            keys = np.sort(of_term[found.code[alive]] * n + found.row[alive])
            # a document counts once for a prefix
            counts = np.bincount(keys[_changes(keys)] // n, minlength=1)
            at = np.flatnonzero(counts)
            names = prefixes.dictionary.take(pa.array(at))
            yield from sums.add(_same(lang, at), names, pa.array(counts[at], pa.int64()))
        yield from sums.told()

    return docs.select("lang", "text").mapInArrow(run, "lang binary, prefix binary, docs long")


def _same(value: bytes, places: np.ndarray) -> pa.Array:
    return pa.repeat(pa.scalar(value, pa.large_binary()), len(places))


def term_counts(docs: DataFrame, settings: Settings, bits, before: int) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of complete terms, summed up inside each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, sums = Kept(settings, bits, before), Sums(["lang", "source", "term"], ["n", "docs"], settings.held)
        for lang, rows in _chunks(batches):
            found, n = Pieces(rows["text"].combine_chunks(), SPACED), len(rows)
            alive = kept.places(lang, found)[found.code]
            sources = rows["source"].combine_chunks().dictionary_encode()
            of_row = sources.indices.to_numpy()
            # by term, then by row, and so by source
            keys = np.sort(found.code[alive].astype("i8") * n + found.row[alive])
            code, row = keys // n, keys % n
            first_of_doc = _changes(keys)
            at = np.flatnonzero(_changes(code) | _changes(of_row[row]))
            docs_before = np.append(np.cumsum(first_of_doc) - first_of_doc, first_of_doc.sum())
            yield from sums.add(
                _same(lang, at),
                sources.dictionary.take(pa.array(of_row[row[at]])),
                found.distinct.take(pa.array(code[at])),
                pa.array(np.diff(np.append(at, len(keys))), pa.int64()),
                pa.array(np.diff(np.append(docs_before[at], docs_before[-1])), pa.int64()),
            )
        yield from sums.told()

    return docs.select("lang", "source", "text").mapInArrow(
        run, "lang binary, source binary, term binary, n long, docs long"
    )


def bits_of(found: DataFrame, settings: Settings) -> bytes:
    """The table of bits of the prefixes kept, put together from rows of 4 KB; its size does not depend on the data."""
    key = F.concat("lang", F.lit(b"\0"), "prefix")
    place = F.pmod(F.crc32(key), F.lit(settings.bits)) + 1
    rows = (
        found.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    table = bytearray(settings.bits // 8)
    for row in rows:
        at = (row.bucket - 1) * BITS_A_ROW // 8
        table[at : at + BITS_A_ROW // 8] = row.bits
    return bytes(table)


def kept_counts(docs: DataFrame, settings: Settings) -> DataFrame:
    """``lang, source, term, n, total, id, first``: occurrences of the kept terms in each group and in the language.

    Names are binary. ``id`` stands for the term; ``first`` is 1 in one of a term's rows and 0 in the others.
    """
    spark, bits, before = docs.sparkSession, None, None
    for size in settings.prefixes:
        # tasks have summed up already
        dealt = prefix_counts(docs, settings, bits, before, size).repartition("lang", "prefix")
        found = dealt.groupBy("lang", "prefix").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= settings.least)
        bits, before = spark.sparkContext.broadcast(bits_of(found, settings)), size
    # one exchange by term serves for the groups' counts and the languages'
    dealt = term_counts(docs, settings, bits, before).repartition("lang", "term")
    counts = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    every = Window.partitionBy("lang", "term")
    whole = (
        counts.withColumn("id", F.monotonically_increasing_id())
        .withColumn("total", F.sum("n").over(every))
        .withColumn("docs", F.sum("docs").over(every))
        .withColumn("least", F.min("id").over(every))
    )
    return staged(
        whole.where(F.col("docs") >= settings.least).select(
            "lang", "source", "term", "n", "total", F.col("least").alias("id"),
            (F.col("id") == F.col("least")).cast("int").alias("first"),
        ),
        "counts",
    )


# --- shares and distances


def share(n: str, words: str, kinds: str) -> Column:
    """Exact also where the product exceeds 64 bits."""
    wide = f"cast({SCALE} AS decimal(10, 0)) * cast({n} + 1 AS decimal(19, 0)) div cast({words} + {kinds} AS decimal(19, 0))"
    narrow = f"cast({SCALE} AS bigint) * ({n} + 1) div ({words} + {kinds})"
    return F.expr(f"1 + CASE WHEN {n} < {SCALE} THEN {narrow} ELSE {wide} END")


def distance(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _tile_sums(key: tuple, groups: pd.DataFrame, found: pd.DataFrame, n_terms: int, size: int) -> pd.DataFrame:
    """Distances of all pairs of a tile's sources, summed over a block's terms."""
    groups = groups.sort_values("number")
    row_of = dict(zip(groups["number"], range(len(groups)), strict=True))
    shares = np.repeat(groups["p0"].to_numpy("i8")[:, None], n_terms, axis=1)
    column = pd.factorize(found["id"])[0]
    shares[found["at"].map(row_of).to_numpy("i8"), column] = found["p"].to_numpy("i8")
    i, j = key[2], key[3]
    tile = groups["number"].to_numpy() // size
    left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    sides = [(left, right)] if i == j else [(left, right), (right, left)]
    told = {"lang": [], "source": [], "item": [], "value": []}
    name = groups["source"].tolist()
    for a_side, b_side in sides:
        q = shares[b_side]
        for a in a_side:
            apart = shares[a][None, :] - q
            value = (apart * apart // q).sum(1) if n_terms else np.zeros(len(b_side), "i8")
            keep = [k for k, b in enumerate(b_side) if b != a]
            told["lang"] += [key[0]] * len(keep)
            told["source"] += [name[a]] * len(keep)
            told["item"] += [name[b_side[k]] for k in keep]
            told["value"] += value[keep].tolist()
    return pd.DataFrame(told)


def pair_distances(counts: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """``lang, source, item, value`` for all pairs of sources of a language; ``counts`` have ``p``, ``groups`` ``p0, number``."""
    blocks = F.greatest(F.ceil(F.col("kinds") / settings.block), F.lit(1))
    tiles = F.ceil(F.col("sources") / settings.tile).cast("long")
    own = F.expr(f"number div {settings.tile}")
    other = F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("other")
    i, j = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    block = F.pmod(F.xxhash64("id"), blocks).alias("block")
    found = counts.select("lang", block, "id", F.col("number").alias("at"), "p", own.alias("own"), other).select("*", i, j)
    dealt = groups.select("lang", "source", "number", "p0", "kinds", own.alias("own"), other).select("*", i, j)
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    # sources may lack a term, so a block's terms are counted over all tiles
    sizes = counts.groupBy("lang", block).agg(F.sum("first").alias("n_terms"))
    dealt = dealt.join(sizes, ["lang", "block"], "left").fillna(0, ["n_terms"])

    def run(key: tuple, own_groups: pd.DataFrame, own_found: pd.DataFrame) -> pd.DataFrame:
        return _tile_sums(key, own_groups, own_found, int(own_groups["n_terms"].iat[0]), settings.tile)

    keys = ["lang", "block", "i", "j"]
    sums = (
        dealt.groupBy(*keys)
        .cogroup(found.groupBy(*keys))
        .applyInPandas(run, "lang binary, source binary, item binary, value long")
    )
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources (``pair``) and over-used terms (``term``) of every group."""
    small_batches(docs.sparkSession)
    binary = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c)
    read = docs.select(binary("lang"), binary("source"), binary("text"))
    counts = kept_counts(read, settings)
    of_groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.sum("first").alias("firsts"))
    of_groups = staged(of_groups, "words")
    langs = of_groups.groupBy("lang").agg(F.sum("firsts").alias("kinds"), F.sum("words").alias("lang_words"))
    every = Window.partitionBy("lang")
    p0 = F.expr("CASE WHEN kinds > 0 THEN 1 + cast(%d AS bigint) div (words + kinds) ELSE 1 END" % SCALE)
    groups = staged(
        read.select("lang", "source")
        .distinct()
        .join(of_groups.drop("firsts"), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["words", "kinds", "lang_words"])
        .withColumn("number", F.row_number().over(every.orderBy("source")).cast("long") - 1)
        .withColumn("sources", F.count("*").over(every))
        .withColumn("p0", p0),
        "groups",
    )
    shares = (
        counts.join(groups, ["lang", "source"])
        .withColumn("p", share("n", "words", "kinds"))
        .withColumn("q", share("total", "lang_words", "kinds"))
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    told = (
        shares.where("p > q")
        .select("lang", "source", F.col("term").alias("item"), distance("p", "q").alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= settings.told)
    )
    pairs = pair_distances(shares, groups, settings).withColumn("rank", F.row_number().over(ranked))
    parts = pairs.withColumn("part", F.lit("pair")).unionByName(told.withColumn("part", F.lit("term")))
    text = lambda c: F.col(c).cast("string").alias(c)
    return parts.select(text("lang"), text("source"), "part", text("item"), "value", "rank")
