"""Registered queries without a SQL twin, as they are registered, against brute force on the small tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from test_dedup import by_text, lowered, plain_components, plain_groups, plain_simhash
from tokenizers import Tokenizer

import corpus_pipeline
from tidemart.llm import registry
from tidemart.llm.work import table


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}


def test_op4_edits_each_text_by_the_next(spark, sf, texts):
    ids = sorted(texts)
    got = {r.doc_id: r for r in registry.QUERIES["op4_fingerprints"](spark, sf).collect()}
    assert sorted(got) == ids
    for place, i in enumerate(ids):
        text, following = texts[i], texts[ids[(place + 1) % len(ids)]]
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()])


def test_op8_holds_the_library_s_ids(spark, sf, texts):
    tokenizer, start = Tokenizer.from_file(registry.TOKENIZER), 0
    got = {r.doc_id: r for r in registry.QUERIES["op8_token_files"](spark, sf).collect()}
    assert len(got) == len(texts)
    for i in sorted(texts):
        ids = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, registry.END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_op10_equals_all_pairs(spark, sf, texts):
    prints = {i: plain_simhash(t) for i, t in texts.items()}
    want = plain_components(prints, 4)
    got = registry.QUERIES["op10_simhash_trees"](spark, sf).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{p:016x}", want[i]) for i, p in prints.items()}


def test_op5_packs_every_word_once(spark, sf, texts):
    spans = defaultdict(list)
    for r in registry.QUERIES["op5_packing"](spark, sf).collect():
        spans[r.doc_id].append((r.start, r.length))
        assert r.place + r.length <= r.bin_length
    for i, text in texts.items():
        at = 0
        for start, length in sorted(spans[i]):
            assert start == at
            at += length
        assert at == len(text.encode().split())


def test_pipeline_equals_its_stages_by_brute_force(spark, sf):
    """What is left after the classifier, by comparing all texts; then every word of the documents mixed is packed."""
    docs = table(spark, sf, "documents")
    clean = [(r.doc_id, r.text) for r in corpus_pipeline.without_toxic(spark, docs, sf).collect()]
    assert len(clean) > 0.8 * docs.count()
    of = dict(clean)
    exact = [(max(ids), of[max(ids)]) for ids in by_text(clean).values()]
    groups = defaultdict(list)
    for (i, _), label in zip(exact, plain_groups(exact), strict=True):
        groups[label].append(i)
    left = {min(ids) for ids in groups.values()}
    packed = defaultdict(int)
    for r in corpus_pipeline.run(spark, sf).collect():
        packed[r.doc_id] += r.length
    assert packed.keys() <= left
    for i, n in packed.items():
        size = len(lowered(of[i]).encode().split())
        assert n == 0 if size == 0 else n % size == 0 and n <= 2 * size
