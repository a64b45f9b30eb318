"""Word segmentation and keyword rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidemart.operators.sizing import own_exchange
from tidemart.sources.parsing import computed_once

# a run of letters and digits other than Han, or a run of Han characters; the plain ASCII ranges add nothing but are
# what most characters are decided by
WORD_PATTERN = r"([a-z0-9[\p{L}\p{N}&&[^\p{IsHan}]]]+|\p{IsHan}+)"
HAN_PATTERN = r"^\p{IsHan}"
STRETCH = 256

# fixed values: the sources of product keyword counts
PRODUCT_SOURCES = {"click_ct": "CLICK", "cart_ct": "CART", "order_ct": "ORDER"}


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(1))


def _taken(matches: Column) -> Column:
    """Of matches sorted by place, those a walk from the left takes: each begins after the one taken before."""
    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<at:int,size:int>>").alias("found"))

    def step(done: Column, m: Column) -> Column:
        grown = F.struct((m["at"] + m["size"]).alias("next"), F.concat(done["found"], F.array(m)).alias("found"))
        return F.when(m["at"] >= done["next"], grown).otherwise(done)

    return F.aggregate(matches, start, step, lambda done: done["found"])


def best_cover(at: list[int], size: list[int]) -> list[int]:
    """Of matches sorted by place, the numbers of those that cover most characters without overlap.

    Of covers alike in that, the one of fewest words, then of most even words (least sum of squared lengths), then of
    long words late (largest sum of length times number); where all that is equal, the one with the longer last piece.
    One step for each place and match: a place needs the best cover up to it alone.
    """
    first = at[0]
    n = max(a + s for a, s in zip(at, size, strict=True)) - first
    # covered, - words, - squares, late words; the last piece's length only decides between covers of one place
    best: list[tuple | None] = [None] * (n + 1)
    chosen = [-1] * (n + 1)
    best[0] = (0, 0, 0, 0, 0)
    number = 0
    for place in range(n):
        covered, words, squares, late, _ = best[place]
        left = (covered, words, squares, late, 0)
        if best[place + 1] is None or left > best[place + 1]:
            best[place + 1], chosen[place + 1] = left, -1
        while number < len(at) and at[number] == first + place:
            s = size[number]
            taken = (covered + s, words - 1, squares - s * s, late + s * (1 - words), s)
            if best[place + s] is None or taken > best[place + s]:
                best[place + s], chosen[place + s] = taken, number
            number += 1
    numbers, place = [], n
    while place:
        m = chosen[place]
        if m >= 0:
            numbers.append(m)
        place -= size[m] if m >= 0 else 1
    return numbers[::-1]


@F.pandas_udf(ArrayType(IntegerType()))
def _best_covers(at: pd.Series, size: pd.Series) -> pd.Series:
    return pd.Series([best_cover(a.tolist(), s.tolist()) for a, s in zip(at, size, strict=True)])


def _matches(chars: DataFrame, known: DataFrame, lengths: list[int]) -> DataFrame:
    """``_id, at, size``: every dictionary word at every place of each run.

    Runs are looked at in overlapping stretches, so that the work grows with their length and not with its square.
    Candidates have only the ``lengths`` of dictionary words, so one long word adds one candidate at each place.
    """
    longest = lengths[-1]

    def stretch(number: Column) -> Column:
        base = number * STRETCH
        text = F.array_join(F.slice("_chars", base + 1, F.lit(STRETCH + longest - 1)), "")
        return F.struct(base.alias("base"), text.alias("text"))

    last = F.call_function("div", F.size("_chars") - 1, F.lit(STRETCH)).cast("int")
    stretches = chars.select("_id", F.inline(F.transform(F.sequence(F.lit(0), last), stretch)))
    places = stretches.withColumn(
        "place", F.explode(F.sequence(F.lit(1), F.least(F.lit(STRETCH), F.length("text"))))
    ).filter(F.col("place") < F.length("text"))
    room = F.length("text") - F.col("place") + 1
    words_here = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda size: size <= room),
        lambda size: F.struct(size.alias("size"), F.col("text").substr(F.col("place"), size).alias("_word")),
    )
    candidates = places.select("_id", (F.col("base") + F.col("place")).alias("at"), F.inline(words_here))
    return candidates.join(own_exchange(known, "_word"), "_word", "left_semi")


def cut_runs(runs: DataFrame, dictionary: DataFrame, smart: bool = False) -> DataFrame:
    """``run -> pieces`` for distinct Han runs, by longest match against ``dictionary(word)`` from the left.

    ``smart`` weighs all matches that overlap against each other instead (:func:`best_cover`), at a cost that grows
    with their number. Candidates are as long as some dictionary word, so no word can be missed. Matches that overlap form
    islands; a match that begins where all earlier ones have ended begins a new island whatever was taken before, so
    each island is walked on its own.
    """
    known = dictionary.select(F.col("word").alias("_word")).filter(F.length("_word") > 1).distinct()
    # numbers below the length of the longest word
    lengths = sorted(r[0] for r in known.select(F.length("_word")).distinct().collect())
    # a long run travels under its digest
    key = F.when(F.length("run") <= 64, F.col("run")).otherwise(F.sha2("run", 256))
    chars = computed_once(
        runs.select("run", key.alias("_id")), "_chars", F.regexp_extract_all("run", F.lit("(.)"), F.lit(1))
    )
    if not lengths:
        return chars.select("run", F.col("_chars").alias("pieces"))

    # words of one place belong together
    place = Window.partitionBy("_id").orderBy("at", "size")
    reach = F.max(F.col("at") + F.col("size")).over(place.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.coalesce(F.col("at") < reach, F.lit(False)), 0).otherwise(1)
    matches = _matches(chars, known, lengths)
    if not smart:
        matches = matches.groupBy("_id", "at").agg(F.max("size").alias("size"))
    islands = (
        matches
        .withColumn("_begins", begins)
        .withColumn("_island", F.sum("_begins").over(place))
    )
    listed = islands.groupBy("_id", "_island").agg(F.array_sort(F.collect_list(F.struct("at", "size"))).alias("found"))
    if smart:
        numbers = _best_covers(F.col("found.at"), F.col("found.size"))
        chosen_of = F.transform("_numbers", lambda n: F.get("found", n))
        taken = listed.withColumn("_numbers", numbers).select("_id", "_island", chosen_of.alias("taken"))
    else:
        taken = listed.select("_id", "_island", _taken(F.col("found")).alias("taken"))
    chosen = taken.groupBy("_id").agg(F.array_sort(F.flatten(F.collect_list("taken"))).alias("taken"))

    def piece_and_gap(m: Column, number: Column) -> Column:
        end = m["at"] + m["size"]
        following = F.coalesce(F.get("taken", number + 1)["at"], F.size("_chars") + 1)
        word = F.array_join(F.slice("_chars", m["at"], m["size"]), "")
        return F.concat(F.array(word), F.slice("_chars", end, following - end))

    before = F.slice("_chars", F.lit(1), F.get("taken", F.lit(0))["at"] - 1)
    pieces = F.concat(before, F.flatten(F.transform("taken", piece_and_gap)))
    return chars.join(chosen, "_id", "left").select(
        "run", F.when(F.col("taken").isNull(), F.col("_chars")).otherwise(pieces).alias("pieces")
    )


def long_runs(found: DataFrame, word: str) -> DataFrame:
    """The distinct Han runs of more than one character among words, as ``run``."""
    long_han = F.col(word).rlike(HAN_PATTERN) & (F.length(word) > 1)
    return found.filter(long_han).select(F.col(word).alias("run")).distinct()


def in_pieces(found: DataFrame, cut: DataFrame, word: str) -> DataFrame:
    """``found`` with a row for each piece of its words, from ``run, pieces``; words that were not cut stay."""
    return (
        found.join(own_exchange(cut, "run"), F.col(word) == F.col("run"), "left")
        .withColumn(word, F.explode(F.coalesce(F.col("pieces"), F.array(F.col(word)))))
        .drop("run", "pieces")
    )


def word_counts(df: DataFrame, text: str, out: str = "keyword", count: str = "ct") -> DataFrame:
    """One row per distinct word of each row's ``text``, with how often it occurs there; other columns stay, text does not.

    Counted inside the row: sorted words are cut where they change, so that nothing is grouped by word and moved.
    """
    others = [c for c in df.columns if c != text]
    found = computed_once(df, "_words", F.array_sort(words(F.col(text)))).filter(F.size("_words") > 0)
    begins = F.filter(
        F.sequence(F.lit(0), F.size("_words") - 1),
        lambda n: (n == 0) | (F.get("_words", n) != F.get("_words", n - 1)),
    )
    cut = computed_once(found.select(*others, "_words"), "_begins", begins)
    ends = lambda n: F.coalesce(F.get("_begins", n + 1), F.size("_words"))
    counted = F.transform(
        "_begins",
        lambda at, n: F.struct(F.get("_words", at).alias(out), (ends(n) - at).cast("bigint").alias(count)),
    )
    return cut.select(*others, F.inline(counted))


def counts_by_key(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, keyword, ct`` of all words of a key's texts. Only keys of several rows, and the null key, are grouped."""
    keys = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    several = keys.filter((F.col("_n") > 1) | F.col("_key").isNull()).select("_key")
    met = F.col(key).eqNullSafe(F.col("_key"))
    alone = word_counts(df.join(several, met, "left_anti"), text)
    grouped = word_counts(df.join(several, met, "left_semi"), text).groupBy(key, "keyword").agg(F.sum("ct").alias("ct"))
    return alone.unionByName(grouped)


def tokenize(
    df: DataFrame,
    text: str,
    out: str = "keyword",
    dictionary: DataFrame | None = None,
    stop_words: tuple[str, ...] = (),
    smart: bool = False,
) -> DataFrame:
    """One row per word of ``text``; a text without words gives none.

    With a ``dictionary`` Han runs are cut further, with ``smart`` by the best cover instead of longest match. A run's pieces depend on the run alone, so each distinct run is
    cut once, however many rows repeat it, and the pieces are joined back. On a stream call that form inside
    ``foreachBatch``.
    """
    found = df.withColumn(out, F.explode(words(F.col(text))))
    if dictionary is not None:
        if df.isStreaming:
            raise ValueError("use a dictionary inside foreachBatch, where each batch is a plain frame")
        found = in_pieces(found, cut_runs(long_runs(found, out), dictionary, smart), out)
    if stop_words:
        found = found.filter(~F.col(out).isin(*stop_words))
    return found


def keyword_sources(df: DataFrame) -> DataFrame:
    """Unpivot click, cart and order counters to ``ct, source`` rows; only positive counts give a row."""
    pairs = [
        F.struct(F.col(c).cast("bigint").alias("ct"), F.lit(s).alias("source")) for c, s in PRODUCT_SOURCES.items()
    ]
    positive = F.filter(F.array(*pairs), lambda p: p["ct"] > 0)
    others = [c for c in df.columns if c not in PRODUCT_SOURCES]
    return df.select(*others, F.explode(positive).alias("_p")).select(*others, "_p.ct", "_p.source")


def product_keywords(
    stats: DataFrame,
    dictionary: DataFrame | None = None,
    stop_words: tuple[str, ...] = (),
    smart: bool = False,
) -> DataFrame:
    """``keyword, ct, source, stt, edt``: every word of the spu name times every positive counter."""
    rows = keyword_sources(stats.select("spu_name", *PRODUCT_SOURCES, "stt", "edt"))
    return tokenize(rows, "spu_name", "keyword", dictionary, stop_words, smart).select(
        "keyword", "ct", "source", "stt", "edt"
    )
