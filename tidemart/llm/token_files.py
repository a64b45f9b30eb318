"""Token-ID output: documents as Parquet list columns, in ascending ``doc_id`` order.

Files hold ``doc_id, n_tokens, ids`` (``ids`` a list of integers that ends with the end id). Identifiers of a vocabulary
this small are dictionary-coded, other integer columns delta-coded (Parquet version 2 pages); row groups and pages are
limited, and page indexes let a reader fetch the lists of a few documents, or the counts of all, without the rest.

Texts are cut at spaces and line feeds, and where a letter or digit meets a mark, and each distinct piece is encoded
once: the tokenizer cuts there itself, so ids are those of the whole text. Words of letters go to the tokenizer's model
without its other steps. Strings of special tokens are what the tokenizer takes them for: texts that hold one are encoded
as a whole, and so are those where an accent may follow a capital that has no character with it. A worker process keeps its pieces for its next tasks, in two tables of bounded size.

Defined cases: null text is the empty text (the end id alone); rows without ``doc_id`` come last; repeated rows are
documents of their own; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.pieces import Pieces
from tidemart.llm.work import small_batches, text_of, work_path

PIECES_KEPT = 500_000
# characters of texts whose pieces are coded together
CHUNK_CHARS = 6 << 20
# documents that are handed on together
ROWS_AT_ONCE = 500
# letters end a piece's tokens as one word; beyond ASCII those of two bytes whose lower case is the next block's
WORD = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# A-Z to lower case, line feeds to spaces: the tokenizer does so too
LOWERED = bytes(c + 0x20 if 0x41 <= c <= 0x5A else 0x20 if c == 0x0A else c for c in range(256))
# ASCII marks, and the letters and digits that a piece may end with before one
MARKS = bytes(0x21 <= c < 0x7F and not chr(c).isalnum() for c in range(256))
ENDS = np.array([c < 0x80 and chr(c).isalnum() for c in range(256)])
# second bytes of the letters of two bytes
ENDS_WIDE = np.array([0x80 <= c < 0xC0 and c not in (0x97, 0xB7) for c in range(256)])
# capitals that take no accent into one character, while their small letters do: the tokenizer composes before it lowers
UNCOMPOSED = bytes(c in b"HJTWY" for c in range(256))
# first byte of U+0300, the first of the accents that stand after their letter
COMBINING = 0xCC
# words of letters that the model gets as one text
WORDS_AT_ONCE = 1000
WRITE_OPTIONS = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.row.count.limit": "1000",
    "parquet.page.size": str(256 << 10),
    "compression": "zstd",
}
FILE_SCHEMA = "doc_id long, n_tokens long, ids array<int>"


class Table:
    """Ids of pieces, one piece after another; the first is the end id and has no name."""

    def __init__(self, end_id: int):
        self.place: dict[bytes, int] = {}
        self.ids, self.ends = np.array([end_id], "<u4"), np.array([0, 4], "i8")

    def places(self, pieces: list[bytes]) -> np.ndarray:
        """Where each piece is; -1 for those not here."""
        return np.fromiter(map(self.place.get, pieces, repeat(-1)), "i8", len(pieces))

    def add(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.ends) - 1
        self.place.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        self.ids = np.concatenate((self.ids, ids))
        self.ends = np.concatenate((self.ends, self.ends[-1] + 4 * np.cumsum(sizes)))

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one piece after another, and where each piece begins, with the end of the last."""
        buffers = [None, pa.py_buffer(self.ends), pa.py_buffer(self.ids)]
        taken = pa.Array.from_buffers(pa.large_binary(), len(self.ends) - 1, buffers).take(pa.array(places))
        begins = np.frombuffer(taken.buffers()[1], "i8")[: len(places) + 1] // 4
        return np.frombuffer(taken.buffers()[2], "<u4")[: begins[-1]], begins


class Encoder:
    """Ids of whole texts.

    Pieces are kept in two generations: when the younger is full it becomes the older, and pieces met again move over.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        # texts that hold a special token go through the tokenizer as they are
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.younger, self.older = Table(end_id), Table(end_id)
        # the model alone, for words of letters; the last token of a word ends with the model's suffix
        self.model = Tokenizer(self.tokenizer.model)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), as_bytes])
        vocabulary, suffix = self.model.get_vocab(), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[n for token, n in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        # whether words of letters may go to the model itself, as the tokenizer would hand them over
        words = [w.lower().encode() for w in "the Über naïve façade Straße ÿ à í".split()]
        self.direct = self._equal(self._words(words), self._each(words))
        # whether the tokenizer cuts between a letter or digit and a mark
        marks = [chr(c) + after for c, mark in enumerate(MARKS) if mark for after in ("", "s", "1", ".")]
        whole = self._each([(before + m).encode() for m in marks for before in "té1"])
        parts = self._each([part.encode() for m in marks for before in "té1" for part in (before, m)])
        self.inner = _before_marks if np.array_equal(whole[0], parts[0]) else None

    @staticmethod
    def _equal(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
        return all(map(np.array_equal, a, b))

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, one word after another, and how many each has."""
        texts = [
            b" ".join(words[n : n + WORDS_AT_ONCE]).decode().lower() for n in range(0, len(words), WORDS_AT_ONCE)
        ]
        coded = self.model.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.empty(0, "<u4"), *[np.array(c.ids, "<u4") for c in coded]])
        stops = np.flatnonzero(self.last[ids])
        if len(stops) != len(words):
            return self._each(words)
        return ids, np.diff(stops, prepend=-1)

    def _each(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any pieces, one piece after another, and how many each has."""
        coded = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        ids = [c.ids for c in coded]
        return np.fromiter(chain.from_iterable(ids), "<u4"), np.fromiter(map(len, ids), "i8", len(ids))

    def _known(self, pieces: list[bytes]) -> np.ndarray:
        """Where in the younger table the ids of pieces that differ from each other are."""
        if len(self.younger.place) + len(pieces) > PIECES_KEPT:
            self.older, self.younger = self.younger, Table(self.end_id)
        places = self.younger.places(pieces)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = [pieces[n] for n in missing.tolist()]
            old = self.older.places(new)
            kept = [p for p, n in zip(new, old.tolist(), strict=True) if n >= 0]
            ids, begins = self.older.take(old[old >= 0])
            self.younger.add(kept, ids, np.diff(begins))
            rest = [p for p, n in zip(new, old.tolist(), strict=True) if n < 0]
            words, others = [], [] if self.direct else rest
            for p in rest if self.direct else ():
                (words if WORD.fullmatch(p) else others).append(p)
            self.younger.add(words, *self._words(words))
            self.younger.add(others, *self._each(others))
            places[missing] = self.younger.places(new)
        return places

    def _whole(self, text: str) -> bool:
        """Whether a special token, in any case, may be in a text."""
        if not any(s[0] in text for s in self.special):
            return False
        lowered = text.lower()
        return any(s in lowered for s in self.special)

    def batch(self, texts: list[str]) -> pa.ListArray:
        """The ids of each text, with the end id."""
        data = [t.encode() for t in texts]
        whole = {n: text for n, text in enumerate(texts) if self._whole(text)}
        whole |= {n: texts[n] for n in _uncomposed(data)}
        plain = pa.array([b"" if n in whole else t for n, t in enumerate(data)], pa.large_binary())
        del data
        found = Pieces(plain, LOWERED, self.inner)
        places = self._known(found.firsts()).astype("i4")
        # each text has one more piece, its end id
        ids, begins = self.younger.take(np.insert(places[found.code], np.cumsum(found.counts), 0))
        ends = np.append(0, begins[np.cumsum(found.counts + 1)])
        if whole:
            return self._with_whole(ids, ends, whole)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view("<i4")))

    def _with_whole(self, ids: np.ndarray, ends: np.ndarray, whole: dict[int, str]) -> pa.ListArray:
        lists = np.split(ids.view("<i4"), ends[1:-1])
        for n, text in whole.items():
            lists[n] = np.array([*self.tokenizer.encode(text, add_special_tokens=False).ids, self.end_id], "<i4")
        ends = np.append(0, np.cumsum([len(x) for x in lists]))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists)))


def _may_combine(char: str) -> bool:
    """Whether a character is an accent or the like, or may have become one since this Python's tables."""
    return unicodedata.combining(char) > 0 or unicodedata.category(char) == "Cn"


def _uncomposed(texts: list[bytes]) -> list[int]:
    """Texts where lower-casing before composing may tell."""
    joined = b"".join(texts) + b" "
    at = np.flatnonzero(np.frombuffer(joined.translate(UNCOMPOSED), bool))
    at = at[np.frombuffer(joined, "u1")[at + 1] >= COMBINING]
    at = np.array([n for n in at.tolist() if _may_combine(joined[n + 1 : n + 5].decode(errors="ignore")[0])], "i8")
    return np.unique(np.searchsorted(np.cumsum([len(t) for t in texts]), at, "right")).tolist()


def _before_marks(raw: np.ndarray) -> np.ndarray:
    """Where a mark follows a letter or digit: the tokenizer cuts there."""
    at = np.flatnonzero(np.frombuffer(raw.tobytes().translate(MARKS), bool)[1:]) + 1
    before = raw[at - 1]
    # a text's first bytes are cut from those before anyway
    return at[ENDS[before] | ENDS_WIDE[before] & (raw[at - 2] == 0xC3)]


@cache
def encoder(path: str, end_id: int) -> Encoder:
    """One encoder for a worker process, kept for its next tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, end_id)


def encode(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id, n_tokens, ids`` sorted by ``doc_id`` within and across partitions."""

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, end_id)
        for ids, texts in _chunks(batches):
            lists = own.batch(texts)
            counts = pa.array(np.diff(lists.offsets.to_numpy()).astype("i8"))
            coded = pa.RecordBatch.from_arrays([ids, counts, lists], ["doc_id", "n_tokens", "ids"])
            yield from (coded.slice(n, ROWS_AT_ONCE) for n in range(0, len(coded), ROWS_AT_ONCE))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ordered = texts.repartitionByRange(F.asc_nulls_last("doc_id")).sortWithinPartitions(
        F.asc_nulls_last("doc_id"), "text"
    )
    return ordered.mapInArrow(run, FILE_SCHEMA)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Identifiers and texts, some megabytes at a time, across batches."""
    ids, texts, size = [], [], 0
    for batch in batches:
        begin = 0
        for n, text in enumerate(batch.column("text").to_pylist()):
            texts.append(text)
            size += len(text)
            if size > CHUNK_CHARS:
                yield pa.concat_arrays([*ids, batch.column("doc_id").slice(begin, n + 1 - begin)]), texts
                ids, texts, size, begin = [], [], 0, n + 1
                # what the last chunk took goes back before the next one
                pa.default_memory_pool().release_unused()
        if begin < batch.num_rows:
            ids.append(batch.column("doc_id").slice(begin))
    if texts:
        yield pa.concat_arrays(ids), texts


def write(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> str:
    """Write token files; returns their folder (new below the shared folder by default)."""
    path = path or work_path(docs.sparkSession, "tokens")
    encode(docs, tokenizer, end_id).write.options(**WRITE_OPTIONS).mode("errorifexists").parquet(path)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """``file, place, doc_id, n_tokens, start``: where each document's ids begin in the whole sequence.

    Reads the metadata columns only.
    """
    return _with_starts(_places(spark, path, "doc_id", "n_tokens"), spark, path)


def _places(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    file, place = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    return read(spark, path).select(file.alias("file"), place.alias("place"), *columns)


def _with_starts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Adds ``start``: the running sum goes over files (one row each, in the order written), then inside each file."""
    files = _places(spark, path, "n_tokens").groupBy("file").agg(F.sum("n_tokens").alias("total"))
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    earlier = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("begin"))
    before = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    start = (F.col("begin") + F.col("before")).alias("start")
    return inside.join(begins, "file").select(*rows.columns, start)


def index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the lists read back from the files."""

    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
            spans = list(zip(offsets[:-1], offsets[1:], strict=True))
            columns = [batch.column(n) for n in ("file", "place", "doc_id")]
            columns.append(pa.array([int(b - a) for a, b in spans], pa.int64()))
            columns.append(pa.array([zlib.crc32(flat[a:b]) for a, b in spans], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["file", "place", "doc_id", "n_tokens", "ids_crc32"])

    schema = "file string, place long, doc_id long, n_tokens long, ids_crc32 long"
    rows = _places(spark, path, "doc_id", "ids").mapInArrow(run, schema)
    return _with_starts(rows, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
