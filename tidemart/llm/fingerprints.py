"""Document fingerprints: SimHash over word pairs, and a search by permuted block tables. DataFrame functions only.

A term is a word with its successor (the last word stands alone); it weighs as many votes as it has letters, so pairs of
short function words say little. Each of 64 bits is 1 if it is set in over half of the votes. Two counters share one
sum (bit i in the lower, bit i + 32 in the upper 32 bits), so a document is one row with 32 sums, made before any
shuffle.

Defined cases: null text is the empty text; texts without words have fingerprint zero; the next document follows by
ascending ``doc_id`` (rows without one come last; rows that repeat one follow in order of length and content) and the
first follows the last; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.work import text_of

SPACE = " \t\n\x0b\f\r"
LANES, LOW = 0x0000000100000001, 0xFFFFFFFF
BITS = 64


def words_of(text: Column) -> Column:
    return F.split(F.trim(text, F.lit(SPACE)), r"[\x20\x09-\x0D]+")


def simhash(texts: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """``keys`` and ``fp``: one fingerprint for each combination of ``keys``, over the terms of all its ``words``."""
    after = F.slice(words, F.lit(2), F.size(words))
    pairs = texts.select(*keys, F.inline(F.arrays_zip(F.col(words), after)).alias("_word", "_next"))
    weight = F.length("_word") + F.coalesce(F.length("_next"), F.lit(0))
    term = pairs.select(*keys, F.xxhash64("_word", "_next").alias("hash"), weight.cast("long").alias("weight"))
    lane = lambda i: F.sum(F.shiftrightunsigned("hash", i).bitwiseAND(F.lit(LANES)) * F.col("weight"))
    counted = term.groupBy(*keys).agg(
        F.sum("weight").alias("_votes"), *[lane(i).alias(f"_{i}") for i in range(BITS // 2)]
    )
    fp = F.lit(0).cast("long")
    for i in range(BITS // 2):
        low, high = F.col(f"_{i}").bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(f"_{i}", 32)
        for count, bit in ((low, i), (high, i + BITS // 2)):
            value = (1 << bit) - (1 << BITS if bit == BITS - 1 else 0)
            fp = fp.bitwiseOR(F.when(2 * count > F.col("_votes"), F.lit(value)).otherwise(F.lit(0)).cast("long"))
    return counted.select(*keys, fp.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


# --- neighbours in order


def range_bounds(ids: DataFrame, parts: int) -> list[int]:
    """At most ``parts`` identifiers that cut ``ids`` (column ``doc_id``) into ranges of about equal size."""
    parts = max(2, parts)
    shares = [i / parts for i in range(parts)]
    row = ids.agg(F.percentile_approx("doc_id", shares, 100 * parts).alias("at"), F.min("doc_id").alias("least")).first()
    return sorted({row["least"], *row["at"]} - {None}) if row["at"] else []


def with_next(rows: DataFrame, bounds: list[int], order: list[str], take: dict[str, str]) -> DataFrame:
    """Adds the columns ``take`` (name: source column) of the next row by ``doc_id`` and ``order``.

    Ranges between ``bounds`` are sorted each by itself. The row that begins a range is copied to the end of the range
    before it, the very first row to the end of the last, so every row finds its successor in its own range.
    """
    last = F.lit(len(bounds))
    if bounds:
        # the range is found in two steps, among every step-th bound and then between two of these
        step = math.isqrt(len(bounds)) + 1
        longs = lambda values: F.array(*[F.lit(b).cast("long") for b in values])
        upto = lambda values: F.size(F.filter(values, lambda b: b <= F.col("doc_id")))
        block = (F.greatest(upto(longs(bounds[::step])), F.lit(1)) - 1) * step
        between = F.slice(longs(bounds), block + 1, F.lit(step))
        number, begins = block + upto(between), F.array_contains(between, F.col("doc_id"))
        own = F.coalesce(F.when(F.col("doc_id").isNotNull(), number), last)
        before = F.when(F.col("doc_id") == bounds[0], last).when(begins, number - 1)
        wrap = F.coalesce(F.col("doc_id") == bounds[0], F.lit(False))
    else:  # one range: few rows, or none has an identifier
        own, before, wrap = F.lit(0), F.lit(0), F.lit(True)
    place = lambda part, at_end, copy: F.struct(
        part.cast("int").alias("part"), F.when(at_end, 1).otherwise(0).alias("wrap"), F.lit(copy).alias("copy")
    )
    places = F.array_compact(
        F.array(place(own, F.lit(False), False), F.when(before.isNotNull(), place(before, wrap, True)))
    )
    placed = rows.withColumn("_at", F.explode(places)).select(*rows.columns, "_at.*")
    by = Window.partitionBy("part").orderBy("wrap", F.asc_nulls_last("doc_id"), *order)
    following = [F.lead(source).over(by).alias(name) for name, source in take.items()]
    return placed.select("*", *following).where("NOT copy").drop("part", "wrap", "copy")


def edited_pairs(docs: DataFrame, parts: int) -> tuple[DataFrame, list[int]]:
    """``id, doc_id, n_chars, tie, text, edited``: texts, and texts whose last quarter is the next document's begin."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    bounds = range_bounds(texts.select("doc_id"), parts)
    rows = texts.withColumns({"n_chars": F.length("text").cast("long"), "tie": F.xxhash64("text")})
    paired = with_next(rows, bounds, ["n_chars", "tie", "text"], {"next_text": "text"})
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut)
    )
    return paired.select(
        F.monotonically_increasing_id().alias("id"), "doc_id", "n_chars", "tie", "text", edited.alias("edited")
    ), bounds


def compare_edited(docs: DataFrame, parts: int) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's."""
    pairs, bounds = edited_pairs(docs, parts)
    # words and digest go inside the exploded structure, else they would be computed again for every use
    digest = F.sha2("edited", 256).alias("edited_sha256")
    version = lambda number, text: F.struct(F.lit(number).alias("version"), words_of(F.col(text)).alias("words"), digest)
    keys = ["id", "doc_id", "n_chars", "tie"]
    both = pairs.select(*keys, F.explode(F.array(version(0, "text"), version(1, "edited"))).alias("v"))
    keys.append("edited_sha256")
    prints = simhash(both.select("id", "doc_id", "n_chars", "tie", "v.*"), [*keys, "version"])
    of = lambda version: F.max(F.when(F.col("version") == version, F.col("fp")))
    each = prints.groupBy(*keys).agg(of(0).alias("fp"), of(1).alias("edited_fp"))
    return with_next(each, bounds, ["n_chars", "tie"], {"next_fp": "fp"}).select(
        "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


# --- search by permuted block tables


def block_tables(radius: int, blocks: int) -> list[int]:
    """Bit masks of ``blocks - radius`` blocks: two fingerprints within ``radius`` agree under at least one of them."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def search(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``query, fp, distance``: for each distinct ``fp`` of ``queries``, all distinct ``fp`` of ``prints`` in radius.

    Each table keys both sides by the bits under its mask; a pair that meets in several tables is told by the first.
    """
    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in block_tables(radius, blocks)]
    tables = F.array(*[F.lit(m).cast("long") for m in masks])
    number, mask = F.col("_t.number"), F.col("_t.mask")
    each = F.explode(F.transform(tables, lambda m, i: F.struct(i.alias("number"), m.alias("mask")))).alias("_t")
    side = lambda df, name: (
        df.select(F.col("fp").alias(name)).distinct().select(name, each).select(
            name, number.alias("number"), F.col(name).bitwiseAND(mask).alias("key")
        )
    )
    met = side(queries, "query").join(side(prints, "fp"), ["number", "key"])
    apart = F.col("query").bitwiseXOR(F.col("fp"))
    agreeing = F.transform(tables, lambda m: apart.bitwiseAND(m) == 0)
    return met.where(F.bit_count(apart) <= radius).where(F.array_position(agreeing, True) == F.col("number") + 1).select(
        "query", "fp", F.bit_count(apart).alias("distance")
    )
