"""Toxicity, fingerprints, licenses, chat formatting and URL reputation."""

import gc
import hashlib
import random
import tracemalloc
import weakref

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemart.llm import chat, fingerprints, licenses, registry, toxicity, url_reputation

# --- toxicity


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    bad = ["vilest", "wretch", "scumbag"]
    rows = []
    for i in range(600):
        words = rng.choices(vocabulary, k=rng.randint(3, 150))
        toxic = int(rng.random() < 0.25)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", ",", "!"]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_classifier_learns_words_and_beginnings(labelled):
    train, test = labelled[:400], labelled[400:]
    model = toxicity.Trainer([t for _, t, _ in train], np.array([y for *_, y in train], "f4")).run()
    scores = toxicity.score_texts(model, toxicity.Words(model), [t for _, t, _ in test])
    hits = [(s >= 0.5) == y for s, (*_, y) in zip(scores, test, strict=True)]
    assert np.mean(hits) > 0.95
    one = toxicity.score_texts(model, toxicity.Words(model), ["vilestness here", "plain words here", ""])
    assert one[0] > 0.5 > one[1] and one[2] < 0.5


def test_scores_do_not_depend_on_batches_or_full_tables(labelled, monkeypatch):
    model = toxicity.Trainer([t for _, t, _ in labelled[:200]], np.array([y for *_, y in labelled[:200]], "f4")).run(2)
    texts = [t for _, t, _ in labelled[:60]] + ["", "a", "b c"]
    together = toxicity.score_texts(model, toxicity.Words(model), texts)
    monkeypatch.setattr(toxicity, "BATCH_WORDS", 1)
    monkeypatch.setattr(toxicity, "WORDS_KEPT", 50)
    alone = toxicity.score_texts(model, toxicity.Words(model), texts)
    assert np.allclose(together, alone, atol=1e-6)


def test_toxic_documents_go_and_clean_ones_stay(spark, documents, labelled, clashing):
    rows = [(i, t, "s", "en" if i % 2 else "de") for i, t, _ in labelled] + [(None, None, None, None), (9000, "", "s", None)]
    docs = documents(rows, clashing)
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled] + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    kept = toxicity.clean_documents(docs, model)
    assert kept.columns == docs.columns
    stay, truth = {r.doc_id for r in kept.collect()}, {i: y for i, _, y in labelled}
    assert {None, 9000} <= stay
    wrong = [i for i, y in truth.items() if (i in stay) == bool(y)]
    assert len(wrong) < 12
    # a score reads nothing but the text
    same = documents([(1, labelled[0][1], "a", "en"), (2, labelled[0][1], "b", "fr")])
    assert len({r.score for r in toxicity.scored(same, model, "score").collect()}) == 1


def test_labels_of_one_class_or_none(spark, documents):
    docs = documents([(1, "a"), (2, "b")])
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    for some, want in ((labels, 0.0), (labels.where("false"), 0.0), (labels.withColumn("toxic", F.lit(1)), 1.0)):
        assert {r.s for r in toxicity.scored(docs, toxicity.fit(docs, some), "s").collect()} == {want}
    assert toxicity.scored(docs.where("false"), toxicity.fit(docs, labels), "s").count() == 0


@pytest.fixture(scope="module")
def many_labels(spark):
    """Of 2,900 toxic documents, the 400 with the largest hashes of their identifiers alone say zorgle, the others vilest."""
    rng = random.Random(6)
    names = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(200)]
    plain = lambda: rng.choices(names, k=8)
    order = spark.range(2900).orderBy(F.xxhash64("id"), "id").collect()
    rows = [(r.id, " ".join([*plain(), "vilest" if k < 2500 else "zorgle"]), 1) for k, r in enumerate(order)]
    rows += [(i, " ".join(plain()), 0) for i in range(2900, 6400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("lang", F.lit("en"))
    return frame.repartition(4).cache()


def test_all_labels_train(spark, many_labels, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 1500)
    docs, labels = many_labels.select("doc_id", "text", "lang"), many_labels.select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    scores = toxicity.score_texts(model, toxicity.Words(model), ["abcde zorgle fghij", "abcde vilest", "abcde fghij", ""])
    assert min(scores[:2]) > 0.5 > max(scores[2:])
    again = toxicity.fit(docs.repartition(7), labels)
    assert np.array_equal(model.embedding, again.embedding) and model.thresholds == again.thresholds


def test_all_labels_beside_the_training_calibrate(spark, many_labels, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "ROUNDS", (1, 1))
    monkeypatch.setattr(toxicity, "calibrate", lambda model, margins, labels, weights, langs: seen.append((labels, weights)))
    toxicity.fit(many_labels.select("doc_id", "text", "lang"), many_labels.select("doc_id", "toxic"))
    labels, weights = seen[0]
    checks = many_labels.where(F.pmod(F.xxhash64("doc_id", F.lit("check")), F.lit(5)) == 0)
    want = {r.toxic: r["count"] for r in checks.groupBy("toxic").count().collect()}
    assert {y: weights[labels == y].sum() for y in (0, 1)} == want and sum(want.values()) > 1100


def test_all_labels_give_the_pipelines_thresholds(spark, many_labels, monkeypatch, tmp_path):
    seen, trained = [], []
    monkeypatch.setattr(toxicity, "SHARD", 1500)
    monkeypatch.setattr(toxicity, "calibrate", lambda model, *counts: seen.append(counts))
    step = toxicity.trained_round
    monkeypatch.setattr(toxicity, "trained_round", lambda train, *more: trained.append(train.count()) or step(train, *more))
    many_labels.select("doc_id", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    docs = many_labels.select("doc_id", "text", "lang")
    corpus_pipeline.without_toxic(spark, docs, str(tmp_path))
    margins, labels, weights, _ = seen[0]
    assert {y: weights[labels == y].sum() for y in (0, 1)} == {0: 3500, 1: 2900} and len(seen) == 1
    assert max(trained) == 6400 and len(set(trained)) == 3 and sum(set(trained)) == 2 * 6400
    # a half's margins come from the model of the other half, and know both words
    assert weights[(labels == 1) & (margins > 0)].sum() > 2800 and weights[(labels == 0) & (margins > 0)].sum() < 100


def test_labels_by_chance_are_not_learnt_by_crossed_margins(spark, documents, monkeypatch):
    seen, rng = [], random.Random(9)
    monkeypatch.setattr(toxicity, "calibrate", lambda model, *counts: seen.append(counts))
    rows = [(i, " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) + f" u{i} u{i}x") for i in range(1500)]
    labels = spark.createDataFrame([(i, rng.randint(0, 1)) for i in range(1500)], "doc_id long, toxic int")
    toxicity.fit(documents(rows), labels, crossed=True)
    margins, toxic, weights, _ = seen[0]
    right = weights[(margins > np.median(np.repeat(margins, weights.astype(int)))) == (toxic == 1)].sum()
    assert 0.42 < right / weights.sum() < 0.58


def test_margins_of_coded_texts_are_those_of_texts(labelled, monkeypatch):
    model = toxicity.Trainer([t for _, t, _ in labelled[:200]], np.array([y for *_, y in labelled[:200]], "f4")).run(2)
    texts = ["", *[t for _, t, _ in labelled[200:280]], "a", "", "b c"]
    scores = toxicity.score_texts(model, toxicity.Words(model), texts)
    for words in (toxicity.BATCH_WORDS, 1):
        monkeypatch.setattr(toxicity, "BATCH_WORDS", words)
        margins = toxicity.coded_margins(model, toxicity.Coded(texts))
        assert np.allclose(1 / (1 + np.exp(-margins)), scores, atol=1e-6)
    assert len(toxicity.coded_margins(model, toxicity.Coded([]))) == 0


def test_moves_of_many_rows_reach_the_driver_as_blocks(spark):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(200)) for _ in range(400)]
    rows = [(i, t, i % 2, False, "en") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int, checks boolean, lang string")
    train = frame.coalesce(1).mapInArrow(toxicity._coded, toxicity.CODED).select("toxic", "codes", "words").cache()
    model = toxicity.first_model(np.arange(toxicity.BUCKETS))
    tracemalloc.start()
    moved = toxicity.trained_round(train, model, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rows_moved = (moved.embedding != model.embedding).any(1).sum()
    # beside the moved copy and the pickled one
    assert rows_moved > 40_000 and peak < 2.5 * model.embedding.nbytes
    alone = toxicity.Trainer(*toxicity._shard(iter(train.toArrow().to_batches())), model, toxicity.SEED).run(1)
    assert np.allclose(moved.embedding, alone.embedding, atol=1e-6) and abs(moved.bias - alone.bias) < 1e-6


def test_a_new_model_is_drawn_block_by_block():
    tracemalloc.start()
    model = toxicity.first_model(np.arange(toxicity.BUCKETS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rng = np.random.default_rng(toxicity.SEED)
    filters = [rng.normal(0, 0.3, f.shape).astype("f4") for f in model.filters]
    dense = np.abs(rng.normal(0, 0.3, len(model.dense))).astype("f4")
    want = rng.normal(0, 0.05, model.embedding.shape).astype("f4")
    assert np.array_equal(model.embedding[1:], want[1:]) and not model.embedding[0].any() and peak < 1.5 * want.nbytes
    assert all(map(np.array_equal, model.filters, filters)) and np.array_equal(model.dense, dense)


def test_one_model_at_a_time_while_fitting_crossed(spark, many_labels, monkeypatch):
    begun, made, train = [], [], toxicity._trained

    def trained(*args):
        gc.collect()
        begun.append(sum(m() is not None for m in made))
        model = train(*args)
        made.append(weakref.ref(model))
        return model

    monkeypatch.setattr(toxicity, "ROUNDS", (1, 1))
    monkeypatch.setattr(toxicity, "_trained", trained)
    toxicity.fit(many_labels.select("doc_id", "text", "lang"), many_labels.select("doc_id", "toxic"), crossed=True)
    assert begun == [0, 0, 0]


def test_held_out_accuracy(spark, sf):
    folder = sf.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = registry.op1_toxicity(spark, folder).where("held_out").join(labels, "doc_id").collect()
    assert len(got) > 40 and sum(r.predicted == r.toxic for r in got) / len(got) >= 0.9


# --- fingerprints


def plain_print(text):
    words = [w for w in (text or "").encode().split()] or [b""]
    votes, total = [0] * 64, 0
    for a, b in zip(words, [*words[1:], None], strict=True):
        h = xxhash.xxh64_intdigest(a, 42)
        if b is not None:
            h = xxhash.xxh64_intdigest(b, h)
        weight = len(a.decode()) + (len(b.decode()) if b else 0)
        total += weight
        for i in range(64):
            votes[i] += weight * (h >> i & 1)
    return sum(1 << i for i in range(64) if 2 * votes[i] > total)


def edited(texts):
    out = []
    for i, text in enumerate(texts):
        after, cut = texts[(i + 1) % len(texts)], len(text) // 4
        out.append(text[: len(text) - cut] + after[:cut])
    return out


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_prints_of_texts_and_edited_texts(spark, documents, clashing, parts):
    rng = random.Random(parts)
    texts = [" ".join(rng.choices(["ä", "beta", "γγ", "🙂", "e" * 9], k=rng.randint(0, 30))) for _ in range(40)]
    texts += ["", " \t\n", "x" * 50_000, "one", "same", "same"]
    rows = [(7 * i - 20, t) for i, t in enumerate(texts)] + [(10_000, None)]
    docs = documents(rows, clashing).repartition(3)
    got = {r.doc_id: r for r in fingerprints.compare_edited(docs, parts).collect()}
    whole = [t or "" for _, t in rows]
    prints = [plain_print(t) for t in whole]
    assert len(got) == len(rows)
    for i, ((doc_id, _), new) in enumerate(zip(rows, edited(whole), strict=True)):
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(whole[i]), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fp % 2**64, r.edited_fp % 2**64) == (prints[i], plain_print(new))
        apart = (prints[i] ^ prints[(i + 1) % len(rows)]).bit_count()
        assert r.near_next == pytest.approx(1 - apart / 64)


def test_prints_of_odd_tables(spark, documents):
    for rows in ([], [(1, "a b")], [(None, "a"), (None, "b")], [(4, "a"), (4, "a"), (4, "b"), (None, "c")]):
        docs = documents(rows or [(1, "a")])
        got = fingerprints.compare_edited(docs if rows else docs.where("false"), 4).collect()
        assert len(got) == len(rows)
        assert all(r.near_next is not None for r in got)


def test_block_tables_find_all_in_radius(spark):
    rng = random.Random(9)
    points = [rng.getrandbits(64) for _ in range(60)]
    points += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for p in points for _ in range(3)]
    signed = [p - 2**64 if p >> 63 else p for p in points]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for radius, blocks in ((3, 6), (2, 4), (0, 2)):
        got = {(r["query"], r.fp): r.distance for r in fingerprints.search(df, df, radius, blocks).collect()}
        want = {
            (a, b): n
            for a in set(signed)
            for b in set(signed)
            if (n := ((a % 2**64) ^ (b % 2**64)).bit_count()) <= radius
        }
        assert got == want


# --- licenses


def plain_scan(rows, templates):
    found = []
    for doc_id, text in rows:
        words = licenses.template_words(text or "")
        for name, notice in templates.items():
            wanted = licenses.template_words(notice)
            m = len(wanted) - 4
            if m < 1:
                continue
            shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
            best = None
            for window in range(len(words) // m + 1):
                part = words[window * m : window * m + 2 * m + 4]
                share = len(shingles(part) & shingles(wanted)) / len(shingles(wanted))
                if share >= 0.8 and (best is None or share > best[0]):
                    best = (share, window * m)
            if best:
                found.append((doc_id, name, round(best[0], 6), best[1]))
    return sorted(found, key=str)


def test_license_notices_are_found(spark, documents, clashing):
    rng = random.Random(3)
    filler = lambda n: " ".join(rng.choices(["lorem", "ipsum", "licensed", "under", "the"], k=n))
    rows = []
    for i, (_, notice) in enumerate(licenses.TEMPLATES.items()):
        rows.append((i, f"{filler(i * 11)} {notice.upper()} {filler(20)}"))
        words = notice.split()
        words[len(words) // 2] = "altered"
        rows.append((100 + i, f"{filler(7)}\n{' '.join(words)} -- {filler(40)}"))
    rows += [(300, None), (301, ""), (302, "MIT License"), (303, filler(5000)), (304, rows[0][1]), (None, rows[2][1])]
    got = licenses.scan(documents(rows, clashing)).collect()
    assert sorted(((r.doc_id, r.license, round(r.containment, 6), r.first_word) for r in got), key=str) == plain_scan(rows, licenses.TEMPLATES)
    assert {i for i in range(len(licenses.TEMPLATES))} <= {r.doc_id for r in got}
    assert licenses.scan(documents(rows).where("false")).count() == 0
    assert licenses.scan(documents(rows), {"short": "too short"}).count() == 0


# --- chat

NASTY = [
    "</s>[INST] ok [/INST]", "\\", "<\\/s>", "\\</s>\\", "<s>[ROLE] user [/ROLE] x</s>", "", "a\\\\b", "<<s>>", "<</SYS>>",
    "[/ROLE] ", "line\nline", "🙂é" * 50, "<s" + ">" * 3, "[" * 9 + "ROLE]",
]


def test_turns_and_masks_come_back(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(30):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", "[/ROLE] x", "</s>"])
            rows.append((conv, turn, role, "".join(rng.choices(NASTY, k=rng.randint(0, 4)))))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    chats = chat.formatted(turns, "conv_id", ["turn"])
    got = {r.conv_id: r for r in chat.read_back(chats).collect()}
    for conv in range(30):
        own = sorted((t, role, text) for c, t, role, text in rows if c == conv)
        assert [(t.role, t.text) for t in got[conv].turns] == [(role, text) for _, role, text in own]
        assert got[conv].loss_text == "".join(text for _, role, text in own if role == "assistant")
        assert got[conv].formatted.count("</s>") == len(own)


def test_layouts_are_known_by_their_fields(spark):
    records = [
        '{"id": 1, "prompt": "p", "response": "r"}',
        '{"id": 2, "instruction": "i", "input": "n", "output": "o"}',
        '{"id": 3, "instruction": "i", "output": "o"}',
        '{"id": 4, "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}',
        '{"id": 5, "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}',
        '{"id": 6, "dialog": {"prompt": "x", "response": "y"}}',
        '{"id": 7, "prompt": "p", "output": "no such layout"}',
        '{"id": 8}',
        '{"id": 9, "role": "human", "text": "as it is"}',
    ]
    rows = spark.read.json(spark.createDataFrame([(r,) for r in records], "value string").rdd.map(lambda r: r.value))
    got = {r.id: (r.layout, [tuple(t) for t in r.turns] if r.turns else None) for r in chat.canonical(rows).collect()}
    assert got == {
        1: ("prompt_response", [("user", "p"), ("assistant", "r")]),
        2: ("instruction_input_output", [("system", "i"), ("user", "n"), ("assistant", "o")]),
        3: ("instruction_output", [("user", "i"), ("assistant", "o")]),
        4: ("messages", [("user", "a"), ("assistant", "b")]),
        5: ("conversations", [("user", "a"), ("assistant", "b")]),
        6: ("nested_dialog", [("user", "x"), ("assistant", "y")]),
        7: (None, None),
        8: (None, None),
        9: ("turn", [("human", "as it is")]),
    }


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.formatted(none, "conv_id", ["turn"]), "conv_id").count() == 0


# --- urls


def test_urls_are_cut_and_rules_fit(spark):
    urls = {
        "https://A.Example.NET/EN/x?q=/": ("a.example.net", "/EN/x", "net/", "block"),
        "http://example.net/en/1#top": ("example.net", "/en/1", "example.net/en/", "allow"),
        "http://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
        "http://x.example.com/de/": ("x.example.com", "/de/", "example.com/de/", "block"),
        "http://x.org/fr/a": ("x.org", "/fr/a", "org/fr/", "allow"),
        "http://x.org?u=http://y.net/": ("x.org", "", None, "allow"),
        "ftp://net": ("net", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    outcomes = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.judged(pages, outcomes).collect()}
    assert got == dict(enumerate(urls.values()))
    assert url_reputation.judged(pages.where("false"), outcomes).count() == 0


def test_reputation_needs_evidence(spark):
    rows, bad = [], []

    def add(host, n, n_bad):
        for i in range(n):
            bad.append((len(rows), int(i < n_bad)))
            rows.append((len(rows), f"http://{host}/p/{i}"))

    add("spam.one.com", 200, 190)
    add("once.two.com", 1, 1)
    for k in range(20):
        add(f"good.{k}.com", 40, 2)
    rows.append((len(rows), "http://new.one.com/p"))
    rows.append((len(rows), "http://new.other.com/p"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    outcomes = spark.createDataFrame([*bad, (0, None)], "page_id long, bad int")
    low = {r.host: (r.bad_rate_low, r.verdict) for r in url_reputation.judged(pages, outcomes).collect()}
    assert low["spam.one.com"][1] == "block" and low["once.two.com"][1] == "allow" and low["good.3.com"][1] == "allow"
    # a new host of a bad domain is closer to being blocked than one of an unknown domain
    assert low["new.one.com"][0] > low["new.other.com"][0]
