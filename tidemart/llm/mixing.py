"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow served in shuffled order, again from its start when it is used up. A document's virtual finish
time is the number of its source's words served up to its end, divided by the source's share of the budget. All services
are range-sorted by that time, which interleaves the sources in proportion at every point, and the order is cut where the
words of all sources together reach the budget. A document in service when its source reaches its share is two parts, one
that ends there and the rest, so that the cut meets every share to the word: it gives the part before the cut, or
(:func:`mixed_documents`) stays whole if that part is at least half of it.

Defined cases: null text has no words; a null source is a source, last in order; documents without words take nothing;
repeated rows are documents of their own; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.work import content_hash, staged, text_of, word_count

# hexadecimal digits of the shuffle key that split a source for its running sum
SLICE_DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """Words each source shall give: ``flow, source_size, target`` from rows ``flow, source_size``.

    Weights repeat along the order of the flows (code points, '' last). A target stops at ``limit`` times its source's
    size; the excess goes to the others by weight until none is above its limit. That is one water level: sources are
    sorted by limit per weight and the first level that the next source can bear is the answer. One row per source.
    """
    every, ranked = Window.partitionBy(), Window.orderBy("ratio", "flow")
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    after = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("flow") == "", "flow")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    level = (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(limit)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("spent", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(after))
        .withColumn("level", (F.col("budget") - F.col("spent")) / F.col("open"))
        .withColumn("level", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
        .withColumn("level", F.min_by("level", F.when(F.col("level").isNotNull(), F.col("ratio"))).over(every))
    )
    target = F.when(F.col("level") < F.col("ratio"), F.col("level") * F.col("weight")).otherwise(F.col("most"))
    return level.select("flow", "source_size", target.alias("target"))


def schedule(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    limit: float = 2,
    tie: Column | None = None,
) -> DataFrame:
    """Every service of every document up to ``limit`` times: ``row, doc_id, flow, round, size, source_size, target,
    start``. ``row`` numbers the documents, ``start`` counts the words of the source served before.

    ``tie`` orders documents of one identifier and size, and comes back as ``tie``; without it their place does.

    A source's running sum is made in slices of the shuffle key, so that no task holds a whole source.
    """
    flow = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit(""))
    key = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    ties = [] if tie is None else ["tie"]
    columns = [flow.alias("flow"), word_count(text_of()).alias("size"), key.alias("key")]
    rows = staged(
        docs.select("doc_id", *columns, *([] if tie is None else [tie.alias("tie")]))
        .withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
        .withColumn("row", F.monotonically_increasing_id()),
        "mix",
    )
    slices = rows.groupBy("flow", "slice").agg(F.sum("size").alias("words"))
    targets = source_targets(slices.groupBy("flow").agg(F.sum("words").alias("source_size")), weights, share, limit)
    earlier = Window.partitionBy("flow").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = slices.withColumn("begin", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(targets, "flow")
    inside = (
        Window.partitionBy("flow", "slice")
        .orderBy("key", "size", *ties, "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        begins.drop("words"), ["flow", "slice"]
    )
    rounds = F.sequence(F.lit(0), F.lit(-int(-limit // 1) - 1))
    begin = F.col("begin") + F.col("before") + F.col("round") * F.col("source_size")
    return placed.withColumn("round", F.explode(rounds)).select(
        "row", "doc_id", "flow", "round", "size", "source_size", "target", *ties, begin.cast("long").alias("start")
    )


ORDER = ("finish", "beyond", "flow", "start", "row")


def served(scheduled: DataFrame) -> DataFrame:
    """Services in parts up to the source's share and ``beyond`` it, with their ``words`` and virtual ``finish`` time.

    A document without words is one part at time 0.
    """
    size, start = F.col("size"), F.col("start")
    first = F.greatest(F.lit(0), F.least(start + size, F.floor("target")) - start).cast("long")
    part = lambda beyond, begin, words: F.struct(
        F.lit(beyond).alias("beyond"), begin.alias("start"), words.alias("words"),
        F.when(size > 0, (begin + words) / F.col("target")).otherwise(F.lit(0.0)).alias("finish"),
    )
    parts = F.filter(F.array(part(0, start, first), part(1, start + first, size - first)), lambda p: p["words"] > 0)
    wordless = F.when(F.col("round") == 0, F.array(part(0, start, size))).otherwise(F.array_repeat(part(0, start, size), 0))
    each = F.explode(F.when(size > 0, parts).otherwise(wordless)).alias("_p")
    return scheduled.select(*[c for c in scheduled.columns if c != "start"], each).select("*", "_p.*").drop("_p")


def cut(scheduled: DataFrame) -> DataFrame:
    """The parts served within the budget, ``taken`` words of each: all before the cut of the global order.

    The order is written once, range by range. Sums of the ranges tell in which of them the budget is reached; only that
    one is summed up row by row.
    """
    ranges = served(scheduled).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    ordered = staged(ranges.withColumn("range", F.spark_partition_id()), "mix-order")
    shares = ordered.groupBy("flow").agg(F.max("target").alias("target"))
    budget = shares.agg(F.coalesce(F.sum(F.floor("target")), F.lit(0))).first()[0]
    sums = ordered.groupBy("range").agg(F.sum("words").alias("words"))
    upto = sums.withColumn("end", F.sum("words").over(Window.orderBy("range")))
    # one row: the range in which the budget is reached
    edge = upto.where(F.col("end") > budget).orderBy("range").first()
    if edge is None:
        return ordered.withColumn("taken", F.col("words")).drop("range")
    left = budget - (edge["end"] - edge["words"])
    earlier = Window.partitionBy("range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(earlier), F.lit(0))
    taken = F.greatest(F.lit(0), F.least(F.col("words"), F.lit(left) - before)).cast("long")
    whole = ordered.where(F.col("range") < edge["range"]).withColumn("taken", F.col("words"))
    partly = ordered.where(F.col("range") == edge["range"]).withColumn("taken", taken)
    return whole.unionByName(partly).drop("range")


def mix(scheduled: DataFrame) -> DataFrame:
    """The mix in order: parts served within the budget, by virtual finish time."""
    return cut(scheduled).where("taken > 0").orderBy(*ORDER)


def taken_words(scheduled: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: one row per document, with the words the mix takes of it."""
    documents = scheduled.where("round = 0").select("row", "doc_id", "size", "source_size", "target")
    taken = cut(scheduled).groupBy("row").agg(F.sum("taken").alias("taken"))
    return documents.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mixed_documents(docs: DataFrame, in_order: bool = False, **settings: object) -> DataFrame:
    """The documents of the mix, whole, each as often as it is taken; the columns of ``docs``.

    Documents without words have nothing to mix and stay once. ``in_order`` sorts the rows by virtual finish time, which
    moves the texts once more. Texts meet their services by a digest of all columns: rows alike in all columns are one
    text served as often as all of them, so nothing depends on places.
    """
    digest = F.struct(content_hash(docs).alias("a"), content_hash(docs, "again").alias("b"))
    kept = cut(schedule(docs, tie=digest, **settings)).where("2 * taken >= size")
    services = kept.select(
        F.col("tie.a").alias("_a"), F.col("tie.b").alias("_b"),
        *[F.col(c).alias(f"_by_{c}") for c in (ORDER if in_order else ())],
    )
    texts = (
        docs.select(F.struct("*").alias("_row"), digest.alias("_digest"))
        .groupBy(F.col("_digest.a").alias("_a"), F.col("_digest.b").alias("_b"))
        .agg(F.any_value("_row").alias("_row"))
    )
    mixed = services.join(texts, ["_a", "_b"])
    return (mixed.orderBy(*[f"_by_{c}" for c in ORDER]) if in_order else mixed).select("_row.*")
