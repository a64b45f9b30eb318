"""Exact and near deduplication against brute force."""

import itertools
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemart.llm import exact_dedup, near_copies, simhash_trees
from tidemart.llm.components import components

TEXTS = [
    (1, "Same text"), (2, "sAME TEXT"), (3, "other"), (4, ""), (5, None), (6, "Ärger"), (7, "ärger"), (8, "same  text"),
    (9, "Same text"), (10, "x" * 200_000), (11, "x" * 200_000 + "y"), (None, "nameless"),
]


def lowered(text):
    return (text or "").encode().lower().decode()


def by_text(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(lowered(text), []).append(doc_id)
    return groups


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.lit("all alike"), lambda t: F.length(t).cast("string")])
def test_exact_groups_hold_under_weak_digests(spark, documents, clashing, digest):
    docs = documents(TEXTS, clashing)
    dedup = exact_dedup.ExactDedup(spark, digest=digest)
    dedup.feed(docs)
    got = dedup.decisions(docs).collect()
    want = by_text(TEXTS)
    assert len(got) == len(TEXTS)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for ids in want.values():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            if i is not None:
                assert (by_id[i].keep_id, by_id[i].group_size, by_id[i].kept) == (keep, len(ids), i == keep)
    assert sum(r.kept for r in got) == len(want)


def test_exact_state_outlives_a_run(spark, documents, tmp_path):
    folder = f"file://{tmp_path}/dedup"
    first, second = documents([(1, "a"), (2, "b")]), documents([(3, "A"), (4, "c")])
    exact_dedup.ExactDedup(spark, folder).feed(first)
    again = exact_dedup.ExactDedup(spark, folder)
    again.feed(second)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in again.decisions(first.union(second)).collect()}
    assert got == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True)}


def test_repeated_rows_keep_one(spark, documents):
    docs = documents([(1, "a"), (1, "a"), (1, "a"), (2, "A"), (3, "b"), (3, "b")])
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "A"), (3, "b")]


def test_rows_kept_do_not_follow_the_layout(spark, documents):
    rows = [(1, "a", s, la) for s in "xyz" for la in ("en", "de")] + [(None, "b", s, "en") for s in "pqr"] + [(2, "A", "x", "en")]
    docs = documents(rows)
    kept = [sorted(map(str, exact_dedup.kept_documents(docs.orderBy(F.rand(n)).repartition(n)).collect())) for n in (1, 3, 5)]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2


def test_edges_of_near_copies_follow_documents(spark, documents, monkeypatch):
    """One large group of near copies: candidate edges grow with its documents."""
    rng = random.Random(2)
    base = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(150)]
    counted = {}
    for n in (60, 240):
        rows = []
        for i in range(n):
            words = list(base)
            words[rng.randrange(150)] = "".join(rng.choices("abcdefgh", k=6))
            rows.append((i, " ".join(words)))
        edges = []
        monkeypatch.setattr(near_copies, "components", lambda e, edges=edges: edges.append(e.distinct().count()) or components(e))
        assert near_copies.one_per_group(documents(rows)).count() == 1
        counted[n] = edges[0]
    assert counted[240] <= 6 * counted[60] and counted[240] <= 3 * 240


def test_empty_tables(spark, documents):
    none = documents([(1, "a")]).where("false")
    assert exact_dedup.kept_documents(none).count() == 0
    assert simhash_trees.near_components(none).count() == 0
    assert simhash_trees.one_per_component(none).count() == 0


# --- SimHash


def plain_simhash(text, shingle=4):
    words = lowered(text).encode().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Smallest id reachable, by comparing all pairs."""
    ids = list(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if label[j] < label[i] and (prints[i] ^ prints[j]).bit_count() <= radius:
                    label[i], changed = label[j], True
    return label


def variants(seed, n_base, n_near):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for _ in range(n_base):
        words = rng.choices(vocabulary, k=rng.randint(0, 120))
        for _ in range(rng.randint(1, n_near)):
            changed = list(words)
            if changed and rng.random() < 0.7:
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((len(rows), "\t ".join(changed)))
    return rows


def test_fingerprints_follow_their_definition():
    texts = ["", " \n", "one", "One two", "a b c d", "a b c d e", "é x y z w v", "w " * 5000, None]
    for text in texts:
        assert simhash_trees.simhash(lowered(text).encode()) == plain_simhash(text)


def test_components_equal_all_pairs(spark, documents, clashing, monkeypatch):
    monkeypatch.setattr(simhash_trees, "SHARD_ROWS", 24)
    monkeypatch.setattr(simhash_trees, "LEAF_ROWS", 4)
    rows = [*variants(1, 40, 5), (900, None), (901, ""), (None, "some words here to read"), (902, "some words here to read")]
    got = simhash_trees.near_components(documents(rows, clashing)).collect()
    prints = {i: plain_simhash(t) for i, t in rows if i is not None}
    want = plain_components(prints, 4)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.fp % 2**64, r.component_id) == (prints[r.doc_id], want[r.doc_id])
        else:
            assert r.component_id == 902


@pytest.mark.parametrize("trees", [1, 2, 3, 4])
def test_forest_joins_what_all_pairs_join(spark, monkeypatch, trees):
    """Clusters dense enough that leaves are cut into blocks, and chains across shards."""
    monkeypatch.setattr(simhash_trees, "SHARD_ROWS", 40)
    monkeypatch.setattr(simhash_trees, "LEAF_ROWS", 6)
    rng = np.random.default_rng(trees)
    points = {int(x) for x in rng.integers(0, 2**63, 150)}
    centre = int(rng.integers(0, 2**63))
    for _ in range(250):  # near copies that share most bits
        points.add(centre ^ sum(1 << int(b) for b in rng.choice(12, rng.integers(0, 4), replace=False)))
    chain = int(rng.integers(0, 2**63))
    for step in range(12):
        chain ^= 0b1111 << (5 * step % 60)
        points.add(chain)
    signed = [p - 2**64 if p >= 2**63 else p for p in points]
    distinct = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3)
    label = {r.node: r.label for r in components(simhash_trees.links(distinct, 4, trees)).collect()}
    want = plain_components({p: p % 2**64 for p in signed}, 4)
    assert {p: label.get(p, p) for p in signed} == want


def test_shards_meet_every_pair():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 2**63, 3000, dtype="u8")
    near = points[:300] ^ (np.uint64(1) << rng.integers(0, 21, 300).astype("u8"))
    every = np.concatenate([points, near])
    tree = simhash_trees.Tree(points[:500], simhash_trees.block_masks(3)[0], 1, 32)
    at, leaf, guest = tree.shards(every)
    assert tree.n > 16 and (np.bincount(at[~guest], minlength=len(every)) == 1).all()
    visits = {}
    for i, n, g in zip(at.tolist(), leaf.tolist(), guest.tolist(), strict=True):
        visits.setdefault(i, {})[n] = g
    for i in range(300):
        shared = set(visits[i]) & set(visits[len(points) + i])
        assert any(not (visits[i][n] and visits[len(points) + i][n]) for n in shared)


def test_trees_are_walked_by_many_fingerprints_at_once(spark, monkeypatch):
    """Not by each Arrow batch: leaves grow with the table as batches do, so that work would grow with the square."""
    walks = spark.sparkContext.accumulator(0)

    class Counting(simhash_trees.Tree):
        def shards(self, points):
            walks.add(1)
            return super().shards(points)

    monkeypatch.setattr(simhash_trees, "Tree", Counting)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    points = [int(x) for x in np.random.default_rng(8).integers(-(2**63), 2**63, 2000)]
    distinct = spark.createDataFrame([(p,) for p in points], "fp long").coalesce(1)
    spark.conf.set(key, "20")
    try:
        simhash_trees.links(distinct).collect()
    finally:
        spark.conf.set(key, before)
    # three trees, to count and to deal
    assert walks.value == 6


def test_rows_of_a_leaf_meet_once(monkeypatch):
    """Whether a leaf is one task or cut into blocks, for its rows at home or for its guests."""
    monkeypatch.setattr(simhash_trees, "SHARD_ROWS", 10)
    monkeypatch.setattr(simhash_trees, "DEAL_ROWS", 50)
    homes, guests = np.array([7, 35, 8, 0, 25, 9]), np.array([9, 28, 40, 12, 0, 0])
    deal, rng = simhash_trees.Deal(100, homes, guests), np.random.default_rng(4)
    leaf = np.concatenate([np.repeat(np.arange(6), homes), np.repeat(np.arange(6), guests)])
    guest, points = np.arange(len(leaf)) >= homes.sum(), rng.integers(0, 2**63, len(leaf), dtype="u8")
    dealt = pd.concat([batch.to_pandas() for batch in deal.rows(leaf, guest, points)])
    assert dealt["task"].between(100, deal.end - 1).all()
    met = Counter()
    for _, rows in dealt.groupby("task"):
        own, first, second = (rows["fp"][mask].tolist() for mask in (rows["side"] == 0, rows["side"] < 2, rows["side"] == 2))
        met.update(frozenset(x) for x in [*itertools.combinations(own, 2), *itertools.product(first, second)])
    want = set()
    for n in range(6):
        at_home, visiting = (points[(leaf == n) & mask].tolist() for mask in (~guest, guest))
        want |= {frozenset(x) for x in [*itertools.combinations(at_home, 2), *itertools.product(at_home, visiting)]}
    assert set(met) == want and set(met.values()) == {1}


def test_groups_that_no_tree_splits_are_not_compared_by_all_pairs(monkeypatch):
    """Thousands within few bits of each other, and points that share the block but lie far away."""
    monkeypatch.setattr(simhash_trees, "PAIRS", 1 << 12)
    rng, mask = np.random.default_rng(6), simhash_trees.block_masks(3)[2]
    near = rng.choice(1 << 13, 3000, replace=False).astype("u8")
    points = rng.permutation(np.concatenate([near, rng.integers(0, 2**42, 200, dtype="u8"), np.array([0b11111 << 30], "u8")]))
    compared, plain = [], simhash_trees.ShardJoin._pairs
    monkeypatch.setattr(simhash_trees.ShardJoin, "_pairs", lambda self, a, b: compared.append(len(a) * len(b)) or plain(self, a, b))
    join = simhash_trees.ShardJoin(points, mask, 1, 4)
    join.among(np.arange(len(points)))
    got, want = join.links.join(), simhash_trees.Links(len(points))
    for i, p in enumerate(points):
        others = np.flatnonzero(np.bitwise_count(points ^ p) <= 4)
        want.add(np.full(len(others), i), others)
    assert (got == want.join()).all() and 1 < len(set(got.tolist())) < 300
    assert sum(compared) < len(points) ** 2 / 2


def test_one_document_of_each_group_stays(spark, documents):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(5, text), (3, text + " end"), (9, text), (7, "something else entirely written here"), (None, "no name"), (3, text + " end")]
    kept = simhash_trees.one_per_component(documents(rows))
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 7]


def test_one_row_of_each_group_stays_whatever_its_identifier(spark, documents, clashing):
    base = " ".join(f"word{i}" for i in range(300))
    other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in ("other", "third"))
    rows = [
        (1, base), (1, other), (1, third), (2, base + " end"),  # one identifier, three texts
        (None, "no name here at all " * 3), (None, "no name here at all " * 3),  # copies without identifiers
        (None, other + " end"), (4, third + " end"),
        (None, None), (9, " "),
    ]
    docs = documents(rows, clashing)
    kept = simhash_trees.one_per_component(docs)
    assert kept.columns == docs.columns
    prints = {n: plain_simhash(t) for n, (_, t) in enumerate(rows)}
    groups = {}
    for n, label in plain_components(prints, 4).items():
        groups.setdefault(label, []).append(n)
    want = [rows[min(g, key=lambda n: (rows[n][0] is None, rows[n][0], n))] for g in groups.values()]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


# --- the pipeline's stage


def plain_shingles(text, size=5):
    words = lowered(text).encode().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def plain_groups(rows):
    """Smallest place reachable over pairs of at least four shared shingles in five, by comparing all pairs."""
    sets, label = [plain_shingles(t) for _, t in rows], list(range(len(rows)))
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return label


@pytest.mark.parametrize("block", [near_copies.BLOCK_BYTES, 2000])
def test_near_dedup_stage_equals_all_pairs(spark, documents, clashing, monkeypatch, block):
    """Copies with one to five edited words, likeness on both sides of 0.8, identifiers repeated or missing."""
    monkeypatch.setattr(near_copies, "BLOCK_BYTES", block)
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(800)]
    rows = []
    for n in range(30):
        words = rng.choices(vocabulary, k=rng.randint(60, 220))
        for _ in range(rng.randint(1, 12)):
            changed = list(words)
            for _ in range(rng.randint(0, 5)):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((rng.choice([None, n, len(rows), len(rows), len(rows)]), " ".join(changed)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "One two"), (504, "one  TWO"), (505, "one two three"), (None, "one two")]
    docs = documents(rows, clashing)
    kept = corpus_pipeline.without_near_copies(spark, docs, "unused")
    assert kept.columns == docs.columns
    members = {}
    for n, label in enumerate(plain_groups(rows)):
        members.setdefault(label, []).append(n)
    want = [rows[min(g, key=lambda n: (rows[n][0] is None, rows[n][0], n))] for g in members.values()]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.without_near_copies(spark, docs.where("false"), "unused").count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame([*chain, *star, (7, 7)], "a long, b long")
    label = {r.node: r.label for r in components(edges).collect()}
    assert set(label.values()) == {0, 1000} and len(label) == 201 + 300


def test_components_read_their_edges_once(spark):
    """Forests that differ each time they are made: a task may meet its rows in another order."""
    def forest(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        nodes = rows["id"].sample(frac=1).tolist()
        return pd.DataFrame({"a": nodes[:-1], "b": nodes[1:]})

    for _ in range(3):
        edges = spark.range(60).groupBy((F.col("id") % 3).alias("k")).applyInPandas(forest, "a long, b long")
        assert {(r.node % 3, r.label) for r in components(edges).collect()} == {(0, 0), (1, 1), (2, 2)}
