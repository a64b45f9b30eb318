"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces of at most the longest length. Pieces go, longest first, into the open bin with the least
room that still holds them. Where none does, a bin is opened whose size costs least for each word: a sequence costs its
length, an overhead, and a share that grows with the square of its length (attention). At the end each bin shrinks to
the shortest permitted length that holds its contents.

Shards of about ``SHARD_ROWS`` pieces are packed independently, so quality doesn't depend on the size of the corpus;
pieces are dealt by number, whatever their source or identifier.

Defined cases: null text is the empty text; documents without words are pieces of length zero and take no room;
repeated rows and null ``doc_id`` are documents of their own; a table without rows gives none; other columns are not
read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.work import staged, text_of, word_count

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD, SQUARE = 64.0, 32_768.0
SHARD_ROWS = 20_000


def cost(length: int) -> float:
    """What a sequence of ``length`` costs, in words."""
    return OVERHEAD + length + length**2 / SQUARE


def pack(pieces: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each piece, and the size of each bin. Pieces are no longer than the longest length."""
    lengths = sorted(lengths)
    cheapest = [min(lengths[k:], key=lambda c: cost(c) / c) for k in range(len(lengths))]
    bins, places = [0] * len(pieces), [0] * len(pieces)
    opened: list[int] = []
    used: list[int] = []
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    for i in sorted(range(len(pieces)), key=lambda i: (-pieces[i], i)):
        size = pieces[i]
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, own = rooms.pop(at)
        else:
            room, own = cheapest[bisect_left(lengths, size)], len(opened)
            opened.append(room)
            used.append(0)
        bins[i], places[i] = own, used[own]
        used[own] += size
        insort(rooms, (room - size, own))
    return bins, places, [lengths[bisect_left(lengths, u)] for u in used]


def cut(docs: DataFrame, longest: int) -> DataFrame:
    """``doc_id, piece, start, length``: each document in pieces of at most ``longest`` words."""
    n = F.col("_n")
    counted = docs.select("doc_id", word_count(text_of()).alias("_n"))
    last = F.greatest(F.ceil(n / longest), F.lit(1)) - 1
    return counted.select("doc_id", "_n", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * longest).alias("start"),
        F.least(F.lit(longest).cast("long"), n - F.col("piece") * longest).alias("length"),
    )


def packed(docs: DataFrame, lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """``bin, bin_length, place, doc_id, piece, start, length``: where every piece of every document goes."""
    pieces = staged(cut(docs, max(lengths)).withColumn("number", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-pieces.count() // SHARD_ROWS))

    def run(key: tuple[int], rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number", ignore_index=True)
        bins, places, sizes = pack(rows["length"].tolist(), lengths)
        rows["bin"] = [f"{key[0]}-{b}" for b in bins]
        rows["bin_length"], rows["place"] = [sizes[b] for b in bins], places
        return rows[["bin", "bin_length", "place", "doc_id", "piece", "start", "length"]]

    schema = "bin string, bin_length long, place long, doc_id long, piece long, start long, length long"
    shard = F.pmod(F.xxhash64("number"), F.lit(shards)).alias("shard")
    return (
        pieces.select(shard, "number", F.col("doc_id").cast("long").alias("doc_id"), "piece", "start", "length")
        .groupBy("shard")
        .applyInPandas(run, schema)
    )
