"""Source divergence, Merkle manifest and sharding against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.llm import divergence, merkle, registry, sharding

# --- source divergence


def plain_audit(rows, least=3, told=200):
    """(lang, source, part, item) -> (value, rank) by going through all kept terms of all pairs."""
    words = [
        (lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""))
        for _, text, source, lang in rows
    ]
    words = [(la, so, [w.encode().lower().decode() for w in ws]) for la, so, ws in words]
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, ws in words:
        groups.add((lang, source))
        held[lang].update(set(ws))
    kept = {lang: {t for t, n in c.items() if n >= least} for lang, c in held.items()}
    for lang, source, ws in words:
        for key in ((lang, source), lang):
            counts[key].update(w for w in ws if w in kept[lang])
    out = {}

    def shares(key, lang):
        n, v = sum(counts[key].values()), len(kept[lang])
        return {t: 1 + 10**9 * (counts[key][t] + 1) // (n + v) for t in kept[lang]}

    for lang, source in groups:
        p, whole, found = shares((lang, source), lang), shares(lang, lang), {}
        for other in {s for la, s in groups if la == lang and s != source}:
            q = shares((lang, other), lang)
            found["pair", other] = sum((p[t] - q[t]) ** 2 // q[t] for t in p)
        for t in p:
            if counts[lang, source][t] and p[t] > whole[t]:
                found["term", t] = (p[t] - whole[t]) ** 2 // whole[t]
        for part in ("pair", "term"):
            listed = sorted((-v, k[1].encode(), k) for k, v in found.items() if k[0] == part)
            for rank, (value, _, k) in enumerate(listed, 1):
                if part == "pair" or rank <= told:
                    out[lang, source, *k] = (-value, rank)
    return out


def audit_rows(seed=1, n=150):
    rng = random.Random(seed)
    letters = "abcdeéß日"
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(1, 24))) for _ in range(160)]
    rows = []
    for i in range(n):
        ws = rng.choices(vocabulary[: rng.choice([20, 80, 160])], k=rng.randint(0, 60))
        text = "".join(w.upper() + rng.choice([" ", "-", "3", "\x00", "\n"]) if rng.random() < 0.3 else w + " " for w in ws)
        rows.append((i, text, rng.choice(["a", "b", "Ä", "c", "d", "e", None, ""]), rng.choice(["en", "de", None])))
    rows += [(n, None, "a", "en"), (n + 1, "", "lonely", "xx"), (n + 2, "one two", "other", "xx"), (n + 3, "a" * 90_000, "b", "en")]
    rows += [(n + 4, "tail1 tail2 " * 3, "rep", "en")] * 3 + [(None, "null id", "a", "de")]
    return rows


def got_audit(df):
    got = df.collect()
    found = {(r.lang, r.source, r.part, r.item): (r.value, r["rank"]) for r in got}
    assert len(found) == len(got)
    return found


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_plain_audit(spark, documents, clashing, small):
    """Also with small blocks and tiles, and tasks that hand on early."""
    settings = divergence.Settings(prefixes=(1, 3), bits=1 << 15, held=30, block=7, tile=2) if small else divergence.Settings()
    rows = audit_rows()
    docs = documents(rows, clashing).repartition(5)
    assert got_audit(divergence.audit(docs, settings)) == plain_audit(rows)


def test_audit_tells_only_the_first_terms(spark, documents):
    rows = [(i, " ".join("x" + chr(97 + a) + chr(97 + b) for a in range(26) for b in range(12)), "s", "en") for i in range(4)]
    rows += [(9, "zzz " * 50, "t", "en")] * 3
    got = got_audit(divergence.audit(documents(rows)))
    assert got == plain_audit(rows)
    assert sum(part == "term" and source == "s" for _, source, part, _ in got) == 200
    assert divergence.audit(documents(rows).where("false")).count() == 0


def test_rare_prefixes_are_discarded(spark):
    rows = [(b"en", b"alphabet alphas alpine"), (b"en", b"alphabet beta"), (b"en", b"alphorn"), (b"de", b"alphabet")]
    docs = spark.createDataFrame(rows, "lang binary, text binary")
    settings = divergence.Settings()
    first = divergence.prefix_counts(docs, settings, None, None, 4).groupBy("lang", "prefix").agg(F.sum("docs").alias("docs"))
    assert {(bytes(r.lang), bytes(r.prefix)): r.docs for r in first.collect()} == {
        (b"en", b"alph"): 3, (b"en", b"alpi"): 1, (b"en", b"beta"): 1, (b"de", b"alph"): 1,
    }
    bits = spark.sparkContext.broadcast(divergence.bits_of(first.where("docs >= 3"), settings))
    second = divergence.prefix_counts(docs, settings, bits, 4, 8).collect()
    assert {(bytes(r.lang), bytes(r.prefix)) for r in second} == {(b"en", b"alphabet"), (b"en", b"alphas"), (b"en", b"alphorn")}


# --- Merkle manifest


class Handed:
    """Stands for a frame: keeps the function that its tasks would run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        return function


@pytest.mark.parametrize("complete", [False, True])
def test_a_task_holds_little_whatever_it_reads(complete):
    rng = random.Random(8)
    names = ["".join(rng.choices("abcdefghijklmnopqrst", k=9)) for _ in range(60_000)]
    texts = [" ".join(rng.choices(names, k=250)).encode() for _ in range(8_000)]
    column = pa.array(texts, pa.binary())
    flat = lambda value, n: pa.array([value] * n, pa.binary())
    batches = [
        pa.RecordBatch.from_arrays(
            [flat(b"en", 500), flat(b"s%d" % (at % 12), 500), column[at * 500 : (at + 1) * 500]], ["lang", "source", "text"]
        )
        for at in range(16)
    ]
    settings = divergence.Settings()
    whole = type("Bits", (), {"value": b"\xff" * (settings.bits // 8)})
    if complete:
        run = divergence.term_counts(Handed(), settings, whole, 8)
    else:
        run = divergence.prefix_counts(Handed(), settings, whole, 4, 8)
    if not complete:
        batches = [b.select(["lang", "text"]) for b in batches]
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    arrow = found = 0
    for batch in run(iter(batches)):
        arrow, found = max(arrow, pa.total_allocated_bytes() - before), found + sum(batch.column(batch.num_columns - 1).to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == sum(len(set(t.split())) for t in texts) if complete else found > 0
    assert peak < 90 << 20 and arrow < 70 << 20, (peak, arrow)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(doc_id, source, lang, n_chars, text):
    return h(*map(plain_field, (doc_id, source, lang, n_chars, text)))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_path(levels, at):
    path = []
    for level in levels[:-1]:
        run = range(at // 2 * 2, min(at // 2 * 2 + 2, len(level)))
        path.append(([level[i] for i in run if i < at], [level[i] for i in run if i > at]))
        at //= 2
    return path


def plain_manifest(rows):
    """Sorted rows of the query from (doc_id, text, source, lang, n_chars)."""
    trees = defaultdict(list)
    for doc_id, text, source, lang, n in rows:
        altered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n is not None
        leaf = plain_leaf(doc_id, source, lang, n, text)
        other = plain_leaf(doc_id, source, lang, n + 1, text) if altered else leaf
        trees["" if lang is None else "+" + lang].append((doc_id if doc_id is not None else -(10**9), leaf, doc_id, other))
    names = sorted(trees, key=str.encode)
    levels = {t: plain_levels([x[1] for x in sorted(trees[t], key=lambda x: x[:2])]) for t in names}
    top = plain_levels([levels[t][-1][0] for t in names])
    out = []
    for place, t in enumerate(names):
        for at, (_, leaf, doc_id, other) in enumerate(sorted(trees[t], key=lambda x: x[:2])):
            path = plain_path(levels[t], at) + plain_path(top, place)
            node = other
            for before, after in path:
                node = h(*before, node, *after)
            proof = h(*[x for before, after in path for x in (*before, *after)])
            out.append((doc_id, leaf, levels[t][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest_of(docs, **settings):
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = merkle.manifest(docs, changed={"n_chars": F.col("n_chars") + 1}, where=altered, **settings)
    columns = ("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified")
    return sorted((tuple(r) for r in found.withColumn("proof", merkle.proof_digest(F.col("path"))).select(*columns).collect()), key=str)


def tree_rows(sizes):
    rows = [(7 * i + len(lang or "x"), f"text {i} é", "s", lang) for lang, n in sizes.items() for i in range(n)]
    return rows + [(3, None, None, "en"), (None, "", "s", None), (None, "x" * 100_000, "s", "en")] + [(5, "same", "s", "en")] * 3


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_equals_plain_manifest(spark, documents, clashing, levels):
    """Groups of 1 to 41 leaves: with small superblocks, trees of up to six layers that end at different heights."""
    rows = tree_rows({"en": 36, "de": 17, "fr": 8, "é": 1, "z": 2, None: 5})
    full = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    got = manifest_of(documents(rows, clashing).repartition(4), levels=levels)
    assert got == plain_manifest(full)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_of_one_leaf_one_group_and_nothing(spark, documents):
    for rows in ([(8, "one", "s", "en")], [(i, str(i), "s", "en") for i in range(9)]):
        assert manifest_of(documents(rows), levels=1) == plain_manifest([(*r, len(r[1])) for r in rows])
    assert manifest_of(documents([(1, "a")]).where("false")) == []


def test_manifest_does_not_follow_the_layout(spark, documents):
    rows = tree_rows({"en": 60, "de": 60})
    assert len({str(manifest_of(documents(rows).repartition(n))) for n in (1, 3, 11)}) == 1


def test_fold_refutes_a_wrong_side():
    levels = plain_levels(["a", "b", "c"])
    path = merkle.siblings(levels, 1)
    assert merkle.fold("b", path) == levels[-1][0] != merkle.fold("b", ["R" + path[0][1:], *path[1:]])


# --- sharding


def plain_shard(key, weights):
    lots = []
    for n, w in enumerate(weights):
        number = int(hashlib.sha256(f"{'' if key is None else key}:{n}".encode()).hexdigest()[:13], 16)
        lots.append((-np.log((number + 0.5) / 16**13) / w, n))
    return min(lots)[1]


def shard_rows():
    rows = [(i, f"text {i} é" * (i % 5), "s", "en") for i in range(300)]
    return rows + [(None, f"none {i % 4}", "s", "en") for i in range(60)] + [(7, "hot", "s", "en")] * 150 + [(8, None, None, None), (9, "x" * 200_000, "s", "en")]


@pytest.mark.parametrize("weights", [(1,) * 24, (3, 1, 0.5)])
def test_records_go_to_their_shards(spark, documents, clashing, weights):
    rows = shard_rows()
    docs = documents(rows, (*clashing, ("shard", 99), ("_key", 1), ("_tie", 2))).repartition(6)
    placed = sharding.read(spark, sharding.write(docs, weights), docs.schema)
    assert set(placed.columns) == set(docs.columns) | {"slot"}
    got = placed.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for i, t, *_ in rows)
    slots, order = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.shard == plain_shard(r.doc_id, weights)
        slots[r.shard].append(r.slot)
        order[r.shard].append((r.slot, -1 if r.doc_id is None else r.doc_id))
    for shard, listed in slots.items():
        assert sorted(listed) == list(range(len(listed)))
        ids = [i for _, i in sorted(order[shard])]
        assert ids == sorted(ids)


def test_slots_do_not_follow_the_layout(spark, documents):
    """One key on a third of the rows, null keys, one table dealt in three ways."""
    docs, seen = documents(shard_rows()), set()
    for n in (1, 4, 13):
        placed = sharding.read(spark, sharding.write(docs.repartition(n)), docs.schema)
        seen.add(str(sorted(((r.shard, r.slot, r.doc_id, r.text) for r in placed.collect()), key=str)))
    assert len(seen) == 1


def test_one_more_shard_takes_rows_only_into_itself(spark):
    keys = spark.range(6000).select(F.col("id").cast("string").alias("key"))
    got = keys.select(
        sharding.shard_of(F.col("key"), (2, 1, 1)).alias("a"), sharding.shard_of(F.col("key"), (2, 1, 1, 1)).alias("b")
    ).collect()
    assert all(r.a == r.b or r.b == 3 for r in got)
    shares = Counter(r.b for r in got)
    assert [shares[n] / 6000 for n in range(4)] == pytest.approx([0.4, 0.2, 0.2, 0.2], abs=0.02)


def test_sharding_of_nothing(spark, documents):
    none = documents([(1, "a")]).where("false")
    assert sharding.read(spark, sharding.write(none), none.schema).count() == 0


def test_queries_are_registered():
    assert {"op11_divergence", "op12_manifest", "op13_sharding"} <= set(registry.QUERIES) & set(registry.ORACLE_SQL)
