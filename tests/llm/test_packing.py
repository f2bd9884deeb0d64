"""Packing: an exact round trip to the ids of the tokenizers library, capacities and balance."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from tidemark.llm import packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    return lambda text: coder.encode(text or "", add_special_tokens=False).ids


ODD = [
    None, "", " ", "  \n\t x", "can't'S we'll'", "a b　c   d", "x\x1cy\x1dz \x85w", "<|endoftext|> <|endoftext|>", "été naïve",
    "日本語のテキスト。次", "🙂🙂 👨‍👩‍👧 ok", "\r\n\r\n a  b   c", "١٢٣ ½ ²", "a_b-c/d #1 100%", "​﻿", "\0\0 nul", "ab" * 5000,
]


def read_back(rows, capacity=1024):
    """Ids per document (by its key) and the sequences; asserts what holds for any packing."""
    docs, room = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        docs[r.doc_id].append((r.start, ids, r.doc_tokens))
        room[r.sequence_id].append((r.offset, r.length))
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)  # nothing to pad
    return docs, room


def whole(parts):
    out = []
    for start, ids, _ in sorted(parts):
        assert start == len(out)
        out += ids
    assert all(total == len(out) for _, _, total in parts)
    return out


def test_round_trip(make, prose, plain):
    rng = random.Random(2)
    texts = ODD + [prose(rng.choice([1, 3, 50, 400, 3000])) for _ in range(300)]
    pieces = packing.packed(make(list(enumerate(texts)), parts=4), group_tokens=20_000)
    rows = pieces.collect()
    docs, room = read_back(rows)
    assert {k: whole(v) for k, v in docs.items()} == {i: plain(t) + [0] for i, t in enumerate(texts)}
    again = packing.packed(make(list(enumerate(texts)), parts=4), group_tokens=20_000).collect()
    assert sorted(rows) == sorted(again)
    by_id = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    assert set(by_id) == set(room)
    for k, parts in room.items():
        assert list(by_id[k].lengths) == [n for _, n in sorted(parts)] and len(by_id[k].ids) == 4 * sum(by_id[k].lengths)
        assert by_id[k].cost == sum(packing.LINEAR * n + n * n for n in by_id[k].lengths)


def test_cut_texts_have_the_same_ids(prose, plain, words):
    coder, rng = packing.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken")), random.Random(8)
    signs = ["", " ", "  ", "\n", " \n", "'s", "'", " ", "。", "-", "1", "é", "\t", "'ll ", "́"]
    text = "".join(rng.choice(words) + rng.choice(signs) for _ in range(4000)) + "".join(t or "" for t in ODD)
    parts = list(packing.chunks(text, 40))
    assert "".join(parts) == text and len(parts) > 100
    assert [i for part in parts for i in coder.encode_ordinary(part)] == plain(text)
    assert list(packing.chunks("x" * 1000, 40)) == ["x" * 1000]


def test_repeated_rows_null_ids_and_text_ids(make, spark):
    docs = make([(None, "a b c")] * 500 + [(7, "same")] * 500)
    rows = packing.packed(docs).collect()
    read_back(rows)
    assert len(rows) >= 1000 and sum(r.length for r in rows if r.doc_id is None) == 500 * 4 and sum(r.length for r in rows if r.doc_id == 7) == 500 * 2
    named = spark.createDataFrame([("x", "hello")], "doc_id string, text string")
    assert packing.packed(named).first().doc_id == "x"
    assert packing.packed(docs.where("false")).count() == 0


def test_assignment_balances_cost():
    rng = random.Random(1)
    lengths = [rng.choice([5, 40, 200, 700]) for _ in range(2000)]
    rooms = packing.capacities(sum(lengths), 1024)
    assert rooms.sum() == sum(lengths) and len(set(rooms[rooms < 1024])) == (rooms < 1024).sum()
    cost, fill, cuts = np.zeros(len(rooms)), np.zeros(len(rooms), int), 0
    for k, start, n, to, offset in packing.assign(lengths, rooms, packing.LINEAR, packing.QUADRATIC):
        assert offset == fill[to]
        fill[to] += n
        cost[to] += packing.LINEAR * n + n * n
        cuts += n < lengths[k]
    assert (fill == rooms).all() and cuts <= 2 * len(rooms)
    full = cost[rooms == 1024]
    first_fit = []  # the same documents in the order they come, cut where a sequence is full
    left, now = 1024, 0
    for n in lengths:
        while n:
            part = min(n, left)
            now, left, n = now + packing.LINEAR * part + part * part, left - part, n - part
            if not left:
                first_fit.append(now)
                left, now = 1024, 0
    assert full.std() < np.std(first_fit)


def test_query(spark, plain):
    rows = driver.queries()["op12_packing"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert list(rows[0].asDict()) == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = {k: np.array(plain(t) + [0], "<u4") for k, t in docs.items()}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
