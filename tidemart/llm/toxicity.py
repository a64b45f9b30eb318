"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of the rows of its hashed features (the word, and its first three, four and five
letters); rows that fewer than two training documents have met are zero. Filters over one, two and three words run along
the whole text, the strongest answer of each filter (at least zero) is kept, and a logistic layer with weights of at least
zero on these gives the score, so a text without evidence scores lowest. Scores themselves read nothing but the text.

All labelled documents are used. Either each once: a fifth, by hash, calibrates the scores and the thresholds by language,
the others train. Or crossed: all train, and all calibrate, each half by the margins of a model that only the other half
has trained. They are dealt into shards by hash. A round is one pass: every shard trains on from the model so far, and
a row moves by the mean of the shards that moved it. What reaches the driver is as large as the model, whatever the number
of documents: sums of moves by row, and counts of margins by language and label. Sums are of integers, so reruns agree.

Defined cases: null text is the empty text; it and texts without words have the score of no evidence; a label that is
null is not used, contradicting labels of one document count as toxic; without labels of both classes every score is
the share of toxic labels (0 without any); repeated rows are scored alike; a table without rows gives none; other
columns pass through, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.work import small_batches, text_of

WORDS = re.compile(r"\w+")
PREFIXES = (3, 4, 5)
WIDTHS, DIM, FILTERS = (1, 2, 3), 16, 12
# zero rows after a text: no filter reaches from one text into the next
GAP = max(WIDTHS) + 1
# rows of the embedding, and places a word's features take
BUCKETS, PLACES = 1 << 18, 1 + len(PREFIXES)
# documents and bytes of a shard
SHARD, SHARD_BYTES = 4000, 16 << 20
# small sets are passed over until so many documents have been visited; any set at least twice
VISITS, ROUNDS = 32_000, (2, 8)
# bits that tell which identifiers have labels
LABEL_BITS = 1 << 25
# moves are summed as multiples of this fraction
FRACTION = 1 << 30
# rows that are drawn at once
BLOCK = 1 << 13
SEED = 7
WORDS_KEPT = 300_000
BATCH_WORDS = 40_000


def features(word: str) -> list[int]:
    """Buckets of the word and of its beginnings."""
    parts = [b"w" + word.encode()] + [b"p" + word[:k].encode() for k in PREFIXES if len(word) >= k]
    return [zlib.crc32(p) % BUCKETS for p in parts]


@dataclass
class Model:
    """Parameters of the classifier; ``rows`` holds a bucket's row of ``embedding`` (row 0 is zero)."""

    rows: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]
    dense: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    constant: float | None = None

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang or "", 0.5)


class Words:
    """Embeddings of words, kept in a table that is emptied when it is full."""

    def __init__(self, model: Model):
        self.model, self.places = model, {}
        self.table = np.zeros((1024, DIM), "f4")

    def matrix(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings of all words of ``texts`` with zero rows after each text, and where each text begins and ends."""
        found = [WORDS.findall(t.lower()) for t in texts]
        new = set().union(*found).difference(self.places)
        if len(self.places) + len(new) > WORDS_KEPT:
            self.places.clear()
            new = set().union(*found)
        for word in new:
            at = len(self.places) + 1
            if at >= len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[at] = self.model.embedding[self.model.rows[features(word)]].sum(0)
            self.places[word] = at
        get = self.places.__getitem__
        ids, spans = [], []
        for words in found:
            spans += [len(ids), len(ids) + max(1, len(words))]
            ids.extend(map(get, words))
            ids.extend([0] * GAP)
        return self.table[ids], np.array(spans)


def pooled(x: np.ndarray, spans: np.ndarray, filters: list[np.ndarray]) -> np.ndarray:
    """The strongest answer of every filter that begins at a word of each text, at least zero."""
    n, out = len(x) - max(WIDTHS) + 1, []
    for width, weights in zip(WIDTHS, filters, strict=True):
        answer = x[:n] @ weights[0]
        for k in range(1, width):
            answer += x[k : n + k] @ weights[k]
        out.append(np.maximum.reduceat(answer, spans, axis=0)[::2])
    return np.maximum(np.concatenate(out, 1), 0)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def score_texts(model: Model, words: Words, texts: list[str]) -> np.ndarray:
    out, batch, size = np.zeros(len(texts)), [], 0
    for at, text in enumerate(texts):
        batch.append(at)
        size += len(text) // 6
        if size >= BATCH_WORDS or at == len(texts) - 1:
            x, spans = words.matrix([texts[i] for i in batch])
            margin = pooled(x, spans, model.filters) @ model.dense + model.bias
            out[batch] = _logistic(model.scale[0] * margin + model.scale[1])
            batch, size = [], 0
    return out


# --- training


class Coded:
    """Texts as numbers of words from 1; ``buckets`` holds the features of each word, -1 where it has fewer."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        self.texts = []
        for text in texts:
            found = [numbers.setdefault(w, len(numbers) + 1) for w in WORDS.findall(text.lower())]
            self.texts.append(np.array(found, "i4"))
        self.buckets = np.full((len(numbers) + 1, PLACES), -1, "i4")
        for word, number in numbers.items():
            own = features(word)
            self.buckets[number, : len(own)] = own

    @classmethod
    def of(cls, texts: list[np.ndarray], buckets: np.ndarray) -> Coded:
        made = cls([])
        made.texts, made.buckets = texts, buckets
        return made

    def documents_by_bucket(self) -> np.ndarray:
        """In how many texts each bucket occurs."""
        counts = np.zeros(BUCKETS + 1, "i8")
        for found in self.texts:
            counts[np.unique(self.buckets[np.unique(found)])] += 1
        return counts[:BUCKETS]


def first_model(met: np.ndarray) -> Model:
    """The model before training; ``met`` are the buckets that have a row."""
    rng = np.random.default_rng(SEED)
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype("f4") for w in WIDTHS]
    dense = np.abs(rng.normal(0, 0.3, len(WIDTHS) * FILTERS)).astype("f4")
    embedding = np.zeros((len(met) + 1, DIM), "f4")
    for at in range(0, len(embedding), BLOCK):
        part = embedding[at : at + BLOCK]
        part[:] = rng.normal(0, 0.05, part.shape)
    embedding[0] = 0
    rows = np.zeros(BUCKETS, "i4")
    rows[met] = np.arange(1, len(met) + 1)
    return Model(rows, embedding, filters, dense, -1.0)


class Trainer:
    """Adam on the rows a batch touches; of the texts, only the words that won the pooling carry gradients.

    Training goes on from ``start``; without it, from a new model of the features that two of the texts share.
    """

    def __init__(self, texts: list[str] | Coded, labels: np.ndarray, start: Model | None = None, seed: int = SEED):
        self.rng = np.random.default_rng(seed)
        coded = texts if isinstance(texts, Coded) else Coded(texts)
        # the empty text goes with every batch, as clean: no evidence must not be toxic
        self.anchor = len(coded.texts)
        self.labels = np.append(labels, 0).astype("f4")
        self.words = [*coded.texts, np.zeros(0, "i4")]
        start = start or first_model(np.flatnonzero(coded.documents_by_bucket() > 1))
        self.feature_rows = np.where(coded.buckets >= 0, start.rows[coded.buckets], 0)
        self.model = Model(
            start.rows, start.embedding.copy(), [f.copy() for f in start.filters], start.dense.copy(), start.bias
        )
        self.moved = np.zeros(len(start.embedding), bool)
        self.moments: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.step = 0

    def run(self, epochs: int = 8, batch: int = 32, rate: float = 0.01) -> Model:
        for _ in range(epochs):
            order = self.rng.permutation(self.anchor)
            for at in range(0, len(order), batch):
                self._update(np.append(order[at : at + batch], self.anchor), rate)
        return self.model

    def _update(self, chosen: np.ndarray, rate: float) -> None:
        model = self.model
        pieces, begins, ends, at = [], [], [], 0
        for i in chosen:
            own = self.words[i]
            begins.append(at)
            ends.append(at + max(1, len(own)))
            pieces += [own, np.zeros(GAP, "i4")]
            at += len(own) + GAP
        # the first of the distinct numbers is the gaps' 0
        distinct, ids = np.unique(np.concatenate(pieces), return_inverse=True)
        table = model.embedding[self.feature_rows[distinct]].sum(1)
        x = table[ids]
        n = len(x) - max(WIDTHS) + 1
        best, values = [], []
        for width, weights in zip(WIDTHS, model.filters, strict=True):
            answer = x[:n] @ weights[0]
            for k in range(1, width):
                answer += x[k : n + k] @ weights[k]
            place = np.stack([a + answer[a:b].argmax(0) for a, b in zip(begins, ends, strict=True)])
            best.append(place)
            values.append(np.take_along_axis(answer, place, 0))
        hidden = np.maximum(np.concatenate(values, 1), 0)
        error = (_logistic(hidden @ model.dense + model.bias) - self.labels[chosen]) / len(chosen)
        self.step += 1
        back = np.outer(error, model.dense) * (hidden > 0)
        words_at, gradients = [], []
        for number, (width, weights) in enumerate(zip(WIDTHS, model.filters, strict=True)):
            g = back[:, number * FILTERS : (number + 1) * FILTERS]
            grown = np.zeros_like(weights)
            for k in range(width):
                at = best[number] + k
                grown[k] = np.einsum("dfe,df->ef", x[at], g)
                words_at.append(ids[at].ravel())
                gradients.append((g[:, :, None] * weights[k].T[None]).reshape(-1, DIM))
            self._adam(f"filter{number}", weights, grown + 1e-4 * weights, rate)
        # filters vote for toxicity only, so a text without evidence scores below any other
        self._adam("dense", model.dense, hidden.T @ error + 1e-4 * model.dense, rate)
        np.maximum(model.dense, 0, out=model.dense)
        bias = np.array([model.bias], "f4")
        self._adam("bias", bias, error.sum(keepdims=True), rate)
        model.bias = float(bias[0])
        self._embedding(np.concatenate(words_at), np.concatenate(gradients), distinct, rate)

    def _embedding(self, words_at: np.ndarray, gradients: np.ndarray, distinct: np.ndarray, rate: float) -> None:
        moved, place = np.unique(words_at, return_inverse=True)
        summed = np.zeros((len(moved), DIM), "f4")
        np.add.at(summed, place, gradients)
        rows = self.feature_rows[distinct[moved]]
        touched, place = np.unique(rows.ravel(), return_inverse=True)
        total = np.zeros((len(touched), DIM), "f4")
        np.add.at(total, place, np.repeat(summed, PLACES, 0))
        total[touched == 0] = 0
        self.moved[touched[touched > 0]] = True
        self._adam("embedding", self.model.embedding, total, rate, touched)

    def _adam(self, name: str, value: np.ndarray, gradient: np.ndarray, rate: float, rows: np.ndarray | None = None):
        first, second = self.moments.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        at = slice(None) if rows is None else rows
        first[at] = 0.9 * first[at] + 0.1 * gradient
        second[at] = 0.99 * second[at] + 0.01 * gradient**2
        fixed = first[at] / (1 - 0.9**self.step) / (np.sqrt(second[at] / (1 - 0.99**self.step)) + 1e-8)
        value[at] -= (rate * fixed).astype(value.dtype)


def calibrate(model: Model, margins: np.ndarray, labels: np.ndarray, weights: np.ndarray, langs: list[str]) -> None:
    """Fit the scale of the scores, then one threshold for each language with enough toxic documents."""
    a, b = 1.0, 0.0
    target = np.where(labels == 1, 1 - 1e-3, 1e-3)
    for _ in range(200):
        p = _logistic(a * margins + b)
        grow, curve = weights * (p - target), weights * p * (1 - p) + 1e-9
        hessian = np.array([[(curve * margins**2).sum(), (curve * margins).sum()], [(curve * margins).sum(), curve.sum()]])
        step = np.linalg.solve(hessian + 1e-3 * np.eye(2), [(grow * margins).sum() + 1e-3 * (a - 1), grow.sum()])
        size = min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-6:
            break
    model.scale = (max(float(a), 1e-3), float(b))
    scores = _logistic(model.scale[0] * margins + model.scale[1])
    for lang in sorted(set(langs)):
        own = np.array([x == lang for x in langs])
        if weights[own][labels[own] == 1].sum() >= 20:
            model.thresholds[lang] = _best_threshold(scores[own], labels[own], weights[own])


def _best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the gap between scores where the weighted F1 is largest; of equal ones, the nearest to a half."""
    order = np.argsort(-scores, kind="stable")
    s, hit, w = scores[order], labels[order] == 1, weights[order]
    caught, wrong = np.cumsum(w * hit), np.cumsum(w * ~hit)
    f1 = 2 * caught / (caught + wrong + (w * hit).sum())
    cuts = (s + np.append(s[1:], 0.0)) / 2
    fit = np.append(s[1:] != s[:-1], True) & (f1 >= f1.max() - 1e-9)
    return float(min(cuts[fit], key=lambda c: abs(c - 0.5)))


def _flat(model: Model) -> np.ndarray:
    """Filters, dense layer and bias in rows as wide as the embedding's."""
    values = np.concatenate([*(f.ravel() for f in model.filters), model.dense, [model.bias]])
    return np.append(values, np.zeros(-len(values) % DIM)).reshape(-1, DIM)


def _stepped(model: Model, blocks: Iterable[tuple[np.ndarray, np.ndarray]]) -> Model:
    """``model`` moved by blocks of row numbers and moves; numbers below 0 are rows of :func:`_flat`, from -1 down."""
    embedding, flat = model.embedding.copy(), _flat(model)
    for numbers, moves in blocks:
        embedding[numbers[numbers >= 0]] += moves[numbers >= 0]
        flat[-1 - numbers[numbers < 0]] += moves[numbers < 0]
    values, filters, at = flat.ravel().astype("f4"), [], 0
    for old in model.filters:
        filters.append(values[at : at + old.size].reshape(old.shape))
        at += old.size
    dense = np.maximum(values[at : at + len(model.dense)], 0)
    return Model(model.rows, embedding, filters, dense, float(values[at + len(dense)]))


MOVES = [f"d{k}" for k in range(DIM)]


def coded_margins(model: Model, coded: Coded) -> np.ndarray:
    """Margins of coded texts."""
    table = model.embedding[np.where(coded.buckets >= 0, model.rows[coded.buckets], 0)].sum(1)
    out, gap, at = [], np.zeros(GAP, "i4"), 0
    while at < len(coded.texts):
        pieces, spans, end = [], [], 0
        while at < len(coded.texts) and end < BATCH_WORDS:
            own = coded.texts[at]
            pieces += [own, gap]
            spans += [end, end + max(1, len(own))]
            end, at = end + len(own) + GAP, at + 1
        x = table[np.concatenate(pieces)]
        out.append(pooled(x, np.array(spans), model.filters) @ model.dense + model.bias)
    return np.concatenate([np.zeros(0, "f4"), *out])


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard ready for its rounds: coded texts to train on, in an order of their own, and whole texts to check with.

    The features of the shard's words go with its first coded text.
    """
    rows = [r for batch in batches for r in batch.to_pylist()]
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    for checks in (False, True):
        own = [r for r in rows if r["checks"] == checks]
        if not own:
            continue
        codes, words, texts = [None] * len(own), [None] * len(own), [r["text"] for r in own]
        if not checks:
            coded = Coded(texts)
            codes, texts = [c.tobytes() for c in coded.texts], codes
            words[0] = coded.buckets.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([checks] * len(own)), pa.array([r.get("half", 0) for r in own], pa.int32()),
                pa.array([r["toxic"] for r in own], pa.int32()),
                pa.array([r["lang"] for r in own], pa.string()), pa.array(texts, pa.string()),
                pa.array(codes, pa.binary()), pa.array(words, pa.binary()),
            ],
            ["checks", "half", "toxic", "lang", "text", "codes", "words"],
        )


CODED = "checks boolean, half int, toxic int, lang string, text string, codes binary, words binary"


def _shard(batches: Iterator[pa.RecordBatch]) -> tuple[Coded, np.ndarray]:
    """The coded texts of a shard and their labels."""
    rows = pa.Table.from_batches(list(batches)).to_pylist()
    words = b"".join(r["words"] or b"" for r in rows)
    buckets = np.frombuffer(words, "i4").reshape(-1, PLACES)
    return Coded.of([np.frombuffer(r["codes"], "i4") for r in rows], buckets), np.array([r["toxic"] for r in rows])


def met_buckets(train: DataFrame) -> np.ndarray:
    """The buckets that at least two documents have met, counted over all shards; at most ``BUCKETS`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first in batches:
            counts = _shard(chain([first], batches))[0].documents_by_bucket()
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "docs"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).astype("i4")
            yield pa.RecordBatch.from_arrays([pa.array([at.tobytes()], pa.binary())], ["buckets"])

    counted = train.mapInArrow(run, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs"))
    found = [np.zeros(0, "i8")]
    for (buckets,) in _fetched(counted.where("docs > 1").select("bucket").mapInArrow(block, "buckets binary")):
        found.append(np.frombuffer(buckets, "i4").astype("i8"))
    return np.sort(np.concatenate(found))


def _fetched(blocks: DataFrame) -> Iterator[tuple[pa.Buffer, ...]]:
    """The rows of binary columns, by one job.

    As Arrow they pass the driver's JVM task by task; as rows, it would hold all of them, and once more pickled.
    """
    table = blocks.toArrow()
    for batch in table.to_batches():
        for row in zip(*batch.columns, strict=True):
            yield tuple(value.as_buffer() for value in row)


def _mean_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed moves as means, a batch in one row of bytes: the driver holds no objects for single rows or values."""
    for batch in batches:
        number, shards, *sums = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        means = np.stack(sums, 1).astype("f8") / FRACTION / shards.astype("f8")[:, None]
        columns = [pa.array([x.tobytes()], pa.binary()) for x in (number.astype("i4"), means.astype("f4"))]
        yield pa.RecordBatch.from_arrays(columns, ["numbers", "moves"])


def trained_round(train: DataFrame, model: Model, number: int) -> Model:
    """One pass of all shards over their documents, from ``model``; a row moves by the mean of the shards that moved it."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        for first in batches:
            trainer = Trainer(*_shard(chain([first], batches)), start, SEED + number)
            found = trainer.run(1)
            at = np.flatnonzero(trainer.moved)
            flat = _flat(found) - _flat(start)
            moves = np.concatenate([found.embedding[at] - start.embedding[at], flat]).astype("f8")
            numbers = np.concatenate([at, -1 - np.arange(len(flat))])
            whole = np.rint(moves * FRACTION).astype("i8")
            columns = [pa.array(numbers), *(pa.array(c) for c in whole.T.copy())]
            yield pa.RecordBatch.from_arrays(columns, ["number", *MOVES])

    moved = train.mapInArrow(run, "number long, " + ", ".join(f"{c} long" for c in MOVES))
    sums = moved.groupBy("number").agg(F.count("*").alias("shards"), *[F.sum(c).alias(c) for c in MOVES])
    blocks = _fetched(sums.mapInArrow(_mean_blocks, "numbers binary, moves binary"))
    made = _stepped(model, ((np.frombuffer(n, "i4"), np.frombuffer(m, "f4").reshape(-1, DIM)) for n, m in blocks))
    shared.destroy()
    return made


def _calibrated(model: Model, check: DataFrame) -> None:
    """Calibrate by all of ``check``: its documents are counted by language, label and margin in hundredths."""
    tiny = F.lit(1e-12)
    margin = F.log(F.greatest("score", tiny) / F.greatest(1 - F.col("score"), tiny))
    kept = scored(check.select("lang", "text", "toxic"), model, "score", drop=("text",))
    _calibrate_by_counts(model, _counts(kept.select("lang", "toxic", margin.alias("margin"))))


def _margin_counts(coded: DataFrame, model: Model) -> pd.DataFrame:
    """Counts of the margins of all documents of coded shards."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first in batches:
            whole = pa.Table.from_batches([first, *batches])
            found = coded_margins(shared.value, _shard(iter(whole.to_batches()))[0])
            columns = [whole["lang"].combine_chunks(), whole["toxic"].combine_chunks(), pa.array(found.astype("f8"))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "toxic", "margin"])

    margins = coded.select("lang", "toxic", "codes", "words").mapInArrow(run, "lang string, toxic int, margin double")
    found = _counts(margins)
    shared.destroy()
    return found


def _counts(margins: DataFrame) -> pd.DataFrame:
    """Documents by language, label and margin in hundredths."""
    found = margins.groupBy(F.coalesce("lang", F.lit("")).alias("lang"), "toxic", F.round("margin", 2).alias("margin"))
    return found.count().toPandas()


def _calibrate_by_counts(model: Model, *counts: pd.DataFrame) -> None:
    rows = pd.concat(counts).groupby(["lang", "toxic", "margin"], as_index=False)["count"].sum()
    values = [rows[c].to_numpy("f8") for c in ("margin", "toxic", "count")]
    calibrate(model, *values, rows["lang"].tolist())


def _perhaps_labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose identifier shares its bit with a labelled one, so that other texts are not moved.

    The table of bits has 4 MB, whatever the data; labels are joined exactly afterwards.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(LABEL_BITS)) + 1
    bit, bucket = F.bitmap_bit_position(place), F.bitmap_bucket_number(place)
    table = labels.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    octet = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = docs.join(F.broadcast(table), bucket == F.col("_bucket"))
    own = F.call_function("shiftleft", F.lit(1), bit.bitwiseAND(F.lit(7)).cast("int"))
    return met.where(octet.bitwiseAND(own) != 0).select(*docs.columns)


def _trained(train: DataFrame, visits: int) -> Model:
    model = first_model(met_buckets(train))
    for number in range(min(ROUNDS[1], max(ROUNDS[0], -(-VISITS // max(1, visits))))):
        model = trained_round(train, model, number)
    return model


def fit(docs: DataFrame, labels: DataFrame, crossed: bool = False) -> Model:
    """A classifier from all ``labels`` (``doc_id, toxic``) of documents in ``docs`` (``doc_id, text, lang``).

    A fifth calibrates and the others train; with ``crossed``, all train and all calibrate, for one more training of each
    half. Of rows that repeat an identifier, the one with the smallest hash of its text is read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    usable = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    usable = usable.where("toxic IN (0, 1)")
    met = _perhaps_labelled(docs.select("doc_id", text_of().alias("text"), "lang"), usable)
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")
    volume = met.agg(F.count("*").alias("n"), size).first()
    shards = max(1, -(-volume.n // SHARD), -(-volume.size // SHARD_BYTES))
    # one row for each identifier, however many repeat it
    one = met.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "lang")).alias("row")).join(usable, "doc_id")
    checks = F.lit(False) if crossed else F.pmod(F.xxhash64("doc_id", F.lit("check")), F.lit(5)) == 0
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) if crossed else F.lit(0)
    rows = one.select("doc_id", "row.text", "row.lang", "toxic", checks.alias("checks"), half.cast("int").alias("half"))
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int")
    if crossed:
        # a shard is of one half
        shards = 2 * -(-shards // 2)
        shard = 2 * F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards // 2)).cast("int") + F.col("half")
    dealt = rows.repartitionById(shards, shard).mapInArrow(_coded, CODED).persist(StorageLevel.DISK_ONLY)
    try:
        kinds = dealt.groupBy("checks", "half", "toxic").agg(F.count("*").alias("n")).collect()
        parts = {(r.half if crossed else r.checks, r.toxic): r.n for r in kinds}
        if len({y for _, y in parts}) < 2:
            share = sizes.get(1, 0) / max(1, sum(sizes.values()))
            return Model(np.zeros(0, "i4"), np.zeros((1, DIM), "f4"), [], np.zeros(0, "f4"), 0.0, constant=share)
        if crossed:
            coded = dealt.select("half", "lang", "toxic", "codes", "words")
            counts = []
            # the halves first, and counts instead of their models: the driver holds one model at a time
            for h in (0, 1) if len(parts) == 4 else ():
                visits = sum(n for (at, _), n in parts.items() if at != h)
                own, other = (coded.where(F.col("half") == x) for x in (h, 1 - h))
                counts.append(_margin_counts(own, _trained(other, visits)))
            model = _trained(coded, sum(parts.values()))
            if counts:
                _calibrate_by_counts(model, *counts)
            return model
        train = dealt.where(~F.col("checks")).select("toxic", "codes", "words")
        model = _trained(train, sum(n for (held, _), n in parts.items() if not held))
        if {(True, 0), (True, 1)} <= set(parts):
            _calibrated(model, dealt.where("checks"))
        return model
    finally:
        dealt.unpersist()


def scored(docs: DataFrame, model: Model, column: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` without ``drop``, with the score of its ``text`` as ``column``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in docs.schema.fields if f.name not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        words = Words(own)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = score_texts(own, words, texts) if own.constant is None else np.full(len(texts), own.constant)
            columns = [batch.column(f.name) for f in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], [*(f.name for f in keep), column])

    return docs.mapInArrow(run, T.StructType([*keep, T.StructField(column, T.DoubleType())]))


def clean_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose score is below their language's threshold; the columns of ``docs``."""
    limits = [F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair]
    limit = F.coalesce(F.try_element_at(F.create_map(*limits), F.coalesce("lang", F.lit(""))), F.lit(0.5)) if limits else F.lit(0.5)
    score = "_toxicity"
    while score in docs.columns:
        score += "_"
    return scored(docs, model, score).where(F.col(score) < limit).drop(score)
