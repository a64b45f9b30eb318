"""Mixing, packing and token files against brute force and exact round trips."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm import mixing, packing, token_files
from tidemart.llm.work import staged


def words(text):
    return (text or "").encode().split()


# --- mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    """Share out by weight, again and again without the sources that are full."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, budget, rest = {}, share * sum(sizes.values()), set(sizes)
    while rest:
        level = budget / sum(weight[s] for s in rest)
        full = {s for s in rest if level * weight[s] > limit * sizes[s] + 1e-9}
        if not full:
            return target | {s: level * weight[s] for s in rest}
        for s in full:
            target[s] = limit * sizes[s]
            budget -= target[s]
        rest -= full
    return target


def plain_mix(rows):
    sources = defaultdict(list)
    for doc_id, text, source in rows:
        key = hashlib.sha256(str(doc_id).encode() if doc_id is not None else b"").hexdigest()
        sources[source].append((key, len(words(text)), doc_id))
    sizes = {s: sum(n for _, n, _ in r) for s, r in sources.items()}
    target, taken = plain_targets(sizes), {}
    for s, listed in sources.items():
        at = 0
        for _ in range(2):
            for _, n, doc_id in sorted(listed, key=lambda x: x[:2]):
                taken[doc_id] = taken.get(doc_id, 0) + max(0, min(at + n, int(target[s] + 1e-6)) - at)
                at += n
    return sizes, target, taken


def corpus(seed=3, n=120):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "c", "Z", "é"])) for i in range(n)]
    return [*rows, (n, None, "a"), (n + 1, "one two", None), (n + 2, "x " * 4000, "b"), (n + 3, "", None)]


def test_mix_equals_plain_mix(spark, documents, clashing):
    rows = corpus()
    docs = documents([(i, t, s, "en") for i, t, s in rows], clashing)
    got = mixing.taken_words(mixing.schedule(docs)).collect()
    sizes, target, taken = plain_mix(rows)
    source = {i: s for i, _, s in rows}
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert (r.source_size, r.taken) == (sizes[s], taken[r.doc_id])
        assert r.target == pytest.approx(target[s]) and r.taken <= 2 * r.size
    for s, want in target.items():
        assert sum(r.taken for r in got if source[r.doc_id] == s) == pytest.approx(want, abs=1)


def test_mix_is_in_order_of_virtual_time_and_repeats_itself(spark, documents):
    docs = documents([(i, t, s, "en") for i, t, s in corpus()])
    first = [(r.row, r.doc_id, r.finish) for r in mixing.mix(mixing.schedule(docs)).collect()]
    assert [f for *_, f in first] == sorted(f for *_, f in first)
    again = mixing.mix(mixing.schedule(docs.repartition(3))).collect()
    assert [x[1] for x in first] == [r.doc_id for r in again]


def test_the_cut_of_the_order_is_the_mix(spark, documents):
    """At every point of the order each source has had its share, and the order ends where the budget does."""
    rows = [(i, "w " * (1 + i * 7 % 30), "abc"[i % 3], "en") for i in range(600)]
    order = mixing.mix(mixing.schedule(documents(rows))).collect()
    target = {r.flow: r.target for r in order}
    assert sum(r.taken for r in order) == sum(int(t + 1e-6) for t in target.values())
    had = Counter()
    for r in order:
        had[r.flow] += r.taken
        assert had[r.flow] / target[r.flow] == pytest.approx(r.finish)
        assert all(had[f] <= r.finish * t + 1e-6 and had[f] + 30 >= r.finish * t for f, t in target.items())


def test_the_order_is_a_range_exchange(spark, documents, monkeypatch):
    """The cut is read from ranges that were sorted by finish time, whatever number of them."""
    docs, plans = documents([(i, t, s, "en") for i, t, s in corpus(5, 400)]), []

    def keep(df, name):
        if name == "mix-order":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name)

    monkeypatch.setattr(mixing, "staged", keep)
    scheduled = mixing.schedule(docs)
    taken = []
    for n in ("2", "7", "50"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        shuffled = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            taken.append(sorted((r.doc_id, r.taken) for r in mixing.taken_words(scheduled).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", shuffled)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert taken[0] == taken[1] == taken[2]
    assert all("rangepartitioning(finish" in p for p in plans) and len(plans) == 3


def test_mixed_documents_in_order(spark, documents):
    rows = [(i, "w " * (1 + i * 7 % 30), "abc"[i % 3], "en") for i in range(300)] + [(900, "", "a", "en")]
    docs = documents(rows)
    order = mixing.mix(mixing.schedule(docs)).where("2 * taken >= size").collect()
    got = [r.doc_id for r in mixing.mixed_documents(docs, in_order=True).collect()]
    assert got[0] == 900 and got[1:] == [r.doc_id for r in order]
    assert sorted(got) == sorted(r.doc_id for r in mixing.mixed_documents(docs).collect())


def test_rows_that_differ_in_a_map_alone_stay_apart(spark):
    rows = [(1, "one text of five words", "a", {"k": n}) for n in (1, 2, 2)] + [(2, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, more map<string,int>")
    got = mixing.mixed_documents(docs, share=1, limit=1).collect()
    assert sorted((r.doc_id, (r.more or {}).get("k", 0)) for r in got) == [(1, 1), (1, 2), (1, 2), (2, 0)]


def test_whole_documents_come_near_the_targets(spark, documents, clashing):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 40), rng.choice("ab"), "en") for i in range(300)]
    rows += [(None, "null id " * 5, "a", "en"), (7, rows[7][1], rows[7][2], "en"), (999, "", "a", "en")]
    docs = documents(rows, clashing)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert max(Counter(r.doc_id for r in got).values()) <= 4 and sum(r.doc_id == 999 for r in got) == 1
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += len(words(t))
    for s, want in plain_targets(sizes).items():
        assert sum(len(words(r.text)) for r in got if r.source == s) == pytest.approx(want, abs=45)


def test_mixed_documents_do_not_follow_the_layout(spark, documents):
    """One identifier on a third of the rows, null identifiers, repeated rows: one table dealt in three ways."""
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(1, 9), rng.choice("abc"), "en") for i in range(60)]
    rows += [(None, f"null {i} " * 3, "a", "en") for i in range(40)] + [(7, f"hot {i} " * 2, "b", "en") for i in range(50)]
    rows += [(8, "same text", "c", "en")] * 12
    docs = documents(rows)
    dealt = [sorted(map(str, mixing.mixed_documents(docs.orderBy(F.rand(n)).repartition(n)).collect())) for n in (1, 3, 8)]
    assert dealt[0] == dealt[1] == dealt[2]


def test_mix_of_nothing(spark, documents):
    none = documents([(1, "a")]).where("false")
    assert mixing.taken_words(mixing.schedule(none)).count() == 0 and mixing.mixed_documents(none).count() == 0
    wordless = documents([(1, ""), (2, None)])
    assert [r.taken for r in mixing.taken_words(mixing.schedule(wordless)).collect()] == [0, 0]
    assert mixing.mixed_documents(wordless).count() == 2


# --- packing


def test_pack_fills_without_overlap():
    rng = random.Random(0)
    pieces = [rng.randint(0, 8192) for _ in range(500)] + [0, 0, 8192, 512, 513]
    bins, places, sizes = packing.pack(pieces)
    inside = defaultdict(list)
    for n, b, at in zip(pieces, bins, places, strict=True):
        inside[b].append((at, n))
    assert set(inside) == set(range(len(sizes)))
    for b, listed in inside.items():
        listed.sort()
        used = 0
        for at, n in listed:
            assert at == used
            used += n
        assert used <= sizes[b] and sizes[b] == min(c for c in packing.LENGTHS if c >= used)


def test_pack_beats_one_fixed_length():
    rng = random.Random(2)
    pieces = [min(8192, int(rng.lognormvariate(6, 1))) for _ in range(2000)]
    joint = sum(map(packing.cost, packing.pack(pieces)[2]))
    assert joint <= min(sum(map(packing.cost, packing.pack(pieces, [c])[2])) for c in (8192,))
    assert sum(packing.pack(pieces)[2]) <= 1.05 * sum(pieces)


def test_every_word_is_packed_once(spark, documents, clashing, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 20)
    rows = [(i, "w " * (i * 7 % 50), "s", "en") for i in range(100)]
    rows += [(100, "w " * 20_000, "s", "en"), (101, None, "s", "en"), (None, "a b", "s", "en"), (5, rows[5][1], "s", "en")]
    got = packing.packed(documents(rows, clashing)).collect()
    want = Counter((i, len(words(t))) for i, t, *_ in rows)
    spans = defaultdict(list)
    for r in got:
        spans[r.doc_id].append((r.start, r.length, r.piece))
        assert r.length <= 8192 and r.place + r.length <= r.bin_length
    for (i, n), times in want.items():
        listed = sorted(spans[i])
        assert sum(x[1] for x in listed) == n * sum(t for (j, _), t in want.items() if j == i) and times
    assert sorted(spans[100]) == [(0, 8192, 0), (8192, 8192, 1), (16384, 3616, 2)]
    assert packing.packed(documents(rows).where("false")).count() == 0


# --- token files

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    "It's we'LL  don't\tÉcole école   x y \x1c z \x85 İstanbul ΣΑΣ ς", "", None, " ", "\n\n", "a\r\nb",
    "<|endoftext|> and <|startoftext|>x", "naïve 日本語 🙂🙂 ́x", "x" * 5000, "1234 5,678.90 $%^&*()", " lead trail ",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def test_token_files_hold_the_ids_of_whole_texts(spark, documents, clashing, tokenizer, monkeypatch):
    rows = [(3 * i, t) for i, t in enumerate(TRICKY)] + [(None, "last"), (1, "between"), (1, "twice")]
    path = token_files.write(documents(rows, clashing).repartition(4), VOCABULARY, 1)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows if i != 1}
    stored = token_files.read(spark, path).collect()
    for r in stored:
        if r.doc_id != 1:
            assert r.ids == ids[r.doc_id] and r.n_tokens == len(r.ids)
    got = token_files.index(spark, path).collect()
    order = sorted(got, key=lambda r: r.start)
    keys = [r.doc_id for r in order]
    assert keys[-1] is None and keys[:-1] == sorted(keys[:-1]) and len(got) == len(rows)
    at = 0
    for r in order:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id != 1:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes())
    assert {(r.doc_id, r.start) for r in token_files.starts(spark, path).collect()} == {(r.doc_id, r.start) for r in got}


ODD = [
    "a b c d e f g", "H i. j, k", "a b c. d e f g", "x. y.. é. it's. 5. .", "ÉCOLE École éà í\xadx ÿ Ÿ ǅ ﬁ µ ª", "÷×", "a.b, c.,",
    "<|endoftext|> x<|endoftext|>", "a<|ENDOFTEXT|>", "<", "İ i̇ ẞ ß", "e\u0301cole Café cafe\u0301", "\x00 \x1f", "don't DON'T l'été",
]


def test_pieces_table_may_overflow(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "PIECES_KEPT", 3)
    encoder = token_files.Encoder(VOCABULARY, 1)
    assert encoder.direct
    texts = [*ODD, *[t or "" for t in TRICKY]]
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert encoder.batch(texts).to_pylist() == want
    assert [encoder.batch([t]).to_pylist()[0] for t in texts] == want
    assert encoder.batch([]).to_pylist() == []


def test_a_word_is_coded_once_whatever_mark_follows(tokenizer, monkeypatch):
    met = []
    known = token_files.Encoder._known
    monkeypatch.setattr(token_files.Encoder, "_known", lambda self, pieces: met.append(len(pieces)) or known(self, pieces))
    words = [a + b + c for a in ("th", "é", "7") for b in "aeiou" for c in ("n", "ß", "3")]
    marks = ["", ".", ",", "$$$", ".%%%", "!!", "'s", "'", "-", ")"]
    texts = [" ".join(w + m for w in words) for m in marks]
    coded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert token_files.Encoder(VOCABULARY, 1).batch(texts).to_pylist() == [[*c.ids, 1] for c in coded]
    assert met == [len(words) + len(marks) - 1]


def test_cuts_before_marks_keep_the_ids(tokenizer):
    rng = random.Random(5)
    parts = ["a", "B", "é", "Ü", "ÿ", "×", "÷", "œ", "7", "½", "'", "s", "ll", ".", ",", "<", "=", "_", "^", "`", "~", "|"]
    parts += ["\u0301", "\u0338", "\u0345", "K", "İ", "日", "🙂", "…", "’", "\xa0", "\t", "\r", "\x00", "\x7f", "\xad", " ", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(3000)]
    coded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert token_files.Encoder(VOCABULARY, 1).batch(texts).to_pylist() == [[*c.ids, 1] for c in coded]


def test_accents_after_capitals_are_composed_first(tokenizer):
    texts = [a + b + c for a in "HJTWYAhjtwya" for b in ("", "\u0327") for c in ("\u0308", "\u030a", "\u030c", "\u0331")]
    texts = ["x", *texts, "W", "\u030a", f"a {'b' * 20} W\u030a", "", "T恤", "WHAT’S", "W\u05b0\u030a"]
    coded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert token_files.Encoder(VOCABULARY, 1).batch(texts).to_pylist() == [[*c.ids, 1] for c in coded]
    assert token_files._uncomposed(["T恤 WHAT’S".encode(), b"W", "a W\u030a".encode(), b""]) == [2]


def test_chunks_reach_across_batches(monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK_CHARS", 9)
    rows = [(n, "x" * (n % 7 * 2)) for n in range(40)]
    batches = [pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows[n : n + 3]]) for n in range(0, 40, 3)]
    batches.insert(5, batches[0].slice(0, 0))
    found = [(ids.to_pylist(), texts) for ids, texts in token_files._chunks(iter(batches))]
    assert [row for ids, texts in found for row in zip(ids, texts, strict=True)] == rows
    sizes = [[len(t) for t in texts] for _, texts in found]
    assert all(sum(x) > 9 >= sum(x[:-1]) for x in sizes[:-1]) and sum(sizes[-1]) <= 9
    assert list(token_files._chunks(iter([]))) == []


def test_ids_of_the_test_documents_are_the_library_s(spark, sf, tokenizer):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    coded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert token_files.Encoder(VOCABULARY, 1).batch(texts).to_pylist() == [[*c.ids, 1] for c in coded]



def test_files_are_coded_and_indexed(spark, sf):
    path = token_files.write(spark.read.parquet(f"{sf}/documents.parquet"), VOCABULARY, 1)
    for file in Path(path.removeprefix("file:")).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for group in range(meta.num_row_groups):
            columns = [meta.row_group(group).column(i) for i in range(meta.num_columns)]
            lists = next(c for c in columns if c.path_in_schema.startswith("ids"))
            assert any("DICTIONARY" in e for e in lists.encodings) and lists.has_column_index and lists.has_offset_index
            assert any("DELTA" in e for c in columns for e in c.encodings)


def test_no_documents_no_ids(spark, documents):
    path = token_files.write(documents([(1, "a")]).where("false"), VOCABULARY, 1)
    assert token_files.index(spark, path).where(F.lit(True)).count() == 0
