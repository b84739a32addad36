"""Packing: every id once, in place, in full sequences."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadpulse.llm import packing

from . import cases

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def vocabulary():
    with open(FILE, "rb") as file:
        return file.read()


def check(rows, ids_of, size=1024):
    """rows: id, start, length, doc_tokens, sequence_id, offset and the ids; ids_of: the ids of each document, by its id."""
    by_document, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_document[r[0]].append(r)
        by_sequence[r[4]].append((r[5], r[2]))
    assert set(by_document) == set(ids_of)
    for id, own in by_document.items():
        own.sort(key=lambda r: r[1])
        at = 0
        for _, start, length, total, _, _, ids in own:
            assert start == at and length > 0 and total == len(ids_of[id])
            assert ids == np.array(ids_of[id][start : start + length], "<u4").tobytes()
            at += length
        assert at == len(ids_of[id])
    assert set(by_sequence) == set(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or at < size and at & (at - 1) == 0
    full = sum(map(len, ids_of.values())) // size
    assert len(by_sequence) <= full + size.bit_length()


def test_documents(spark, tokenizer, vocabulary):
    docs = cases.documents(spark).repartition(3)
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids_of = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts.items()}
    for size in (1024, 64):
        pieces, plan = packing.pack(docs, vocabulary, size)
        rows = [(r.id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset, bytes(r.ids)) for r in pieces.collect()]
        check(rows, ids_of, size)
        assert sum(n for n, _ in plan.patterns) == plan.packs and {sum(lengths) for _, lengths in plan.patterns} <= {size, *(1 << k for k in range(size.bit_length()))}


def test_ids_are_those_of_the_files_own_library(tokenizer, vocabulary):
    own = packing.Vocabulary(vocabulary)
    draw = random.Random(4)
    alphabet = "abXYZ '’stremvlld  \n\t\r.,!?01é  ß日本\U0001f600\x00\x1c\x85 "
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(80))) for _ in range(3000)]
    texts += [t + "<|endoftext|>" + t for t in texts[:200]] + [f"a{chr(c)}b {chr(c)}{chr(c)}'{chr(c)}1" for c in range(0x3000)]
    for text, encoded in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert own.ids(text).tolist() == encoded.ids, text


def test_plan_places_each_rank_once():
    draw = random.Random(5)
    for _ in range(300):
        size = draw.choice([8, 16, 64, 100])
        histogram = {length: draw.choice([1, 2, 3, 50, 1000]) for length in draw.sample(range(1, size + 1), draw.randint(1, min(size, 12)))}
        plan = packing.Plan(histogram, size)
        lengths = np.repeat(np.array(list(histogram)), list(histogram.values()))
        ranks = np.concatenate([np.arange(n) for n in histogram.values()])
        row, takes, packs, offsets = packing._find(plan.slots, lengths, ranks)
        assert (np.bincount(row, takes) == lengths).all()
        filled = np.zeros((plan.packs, size), int)
        for t, p, o in zip(takes, packs, offsets):
            filled[p, o : o + t] += 1
        assert filled.max() == 1
        used = filled.sum(1)
        assert (np.diff(filled, axis=1) <= 0).all() and all(u == size or u & (u - 1) == 0 for u in used)
        # as many places of each length as the patterns have
        assert sum(n * len(ls) for n, ls in plan.patterns) == len(takes)


def test_longest_first_into_the_emptiest_pack():
    plan = packing.Plan({6: 2, 4: 1, 2: 2, 1: 4}, 8)
    assert sorted(plan.patterns) == [(1, (4, 2, 2)), (2, (6, 1, 1))]


def test_odd_and_empty(spark, vocabulary):
    odd = cases.odd(spark)
    pieces, _ = packing.pack(odd, vocabulary)
    rows = pieces.collect()
    assert sum(r.start == 0 for r in rows) == odd.count() and {r.id for r in rows} == {r.doc_id for r in odd.collect()}
    none, plan = packing.pack(cases.empty(spark), vocabulary)
    assert none.count() == 0 and plan.packs == 0


def test_query(spark, tokenizer, tmp_path):
    cases.documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = packing.op12_packing(spark, str(tmp_path)).collect()
    assert got and got[0].asDict().keys() == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    texts = dict(enumerate(cases.texts()))
    for r in got:
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) and r.doc_tokens == len(ids)
