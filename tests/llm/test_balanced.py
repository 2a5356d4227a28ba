"""Cost-balanced packing against whole-text tokenising and a plain search for the cheapest sequence."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.llm import balanced

PATH = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = (PATH, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
MADE = balanced.Vocabulary(*VOCABULARY)
ODD = " \t\n\r\x0b\x0c\x85\xa0     　᠎​﻿\x1c\x1f"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@settings(max_examples=500, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parts=st.lists(st.text(max_size=4) | st.sampled_from([*ODD, *"ab1'.é日", "'s", "don't", "<|endoftext|>", "  ", " x"]), max_size=40))
def test_ids_are_those_of_the_tokenizer(tokenizer, parts):
    text = "".join(parts)
    found = np.frombuffer(MADE.token_bytes(text), "<u4").tolist()
    assert found == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 3_000_000 + "x", "x" * 300_000, "日" * 100_000, "a " * 500_000, "!" * 300_000])
def test_ids_of_very_long_texts(tokenizer, text):
    found = np.frombuffer(MADE.token_bytes(text), "<u4").tolist()
    assert found == tokenizer.encode(text, add_special_tokens=False).ids


def plain_assign(pieces, room, cost):
    """The same rule by looking at every sequence for every piece."""
    m = sum(p[2] for p in pieces) // room
    sequences, costs, rooms, rest = [[] for _ in range(m)], [0.0] * m, [room] * m, []
    for doc, start, n in pieces:
        while n:
            fits = [b for b in range(m) if rooms[b] >= n] or [b for b in range(m) if rooms[b]]
            if not fits:
                rest.append((doc, start, n))
                break
            b = min(fits, key=lambda b: (costs[b], rooms[b], b))
            take = min(n, rooms[b])
            sequences[b].append((doc, start, take))
            costs[b] += cost(take)
            rooms[b] -= take
            start, n = start + take, n - take
    return sequences, costs, rest


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=60))
def test_assignment_takes_the_cheapest_sequence_with_room(lengths):
    def cost(n):
        return n + n * n / 64

    pieces = balanced.even_parts(lengths, 64)
    assert sum(p[2] for p in pieces) == sum(lengths) and max((p[2] for p in pieces), default=0) <= 64
    found = balanced.assign(pieces, 64, cost)
    assert found == plain_assign(pieces, 64, cost)
    assert all(sum(p[2] for p in s) == 64 for s in found[0])
    short, _ = balanced.powers_of_two(found[2], cost)
    sizes = [sum(p[2] for p in s) for s in short]
    assert sizes == sorted(set(sizes), reverse=True) and all(s & (s - 1) == 0 for s in sizes)
    assert sum(sizes) == sum(lengths) % 64


def check(rows, documents, tokenizer, length):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    expected = defaultdict(list)
    for doc_id, text in documents:
        expected[doc_id].append([*(tokenizer.encode(text, add_special_tokens=False).ids if text else []), 1])
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(expected)
    for doc_id, own in by_doc.items():
        made = expected[doc_id]
        assert sum(r.length for r in own) == sum(map(len, made))
        copies = [[m, made.count(m), np.zeros(len(m), int)] for k, m in enumerate(made) if m not in made[:k]]
        for r in own:  # each id lies in one piece of each document with this id
            part = slice(r.start, r.start + r.length)
            used = [u for ids, _, u in copies if len(ids) == r.doc_tokens
                    and zlib.crc32(np.array(ids[part], "<u4").tobytes()) == r.ids_crc32]
            assert len(used) == 1, (doc_id, r)
            used[0][part] += 1
        assert all((used == n).all() for _, n, used in copies)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == length or at < length and at & (at - 1) == 0  # no padding
        cost = sum(r.length + r.length ** 2 / 6144 for r in own)
        assert all(abs(r.sequence_cost - cost) < 1e-6 for r in own)
    return by_sequence


def test_packing_covers_every_id_once(spark, tokenizer):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["don't", "word", "日本語", "x1,", "\n\n a", "é"]) for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    texts += [None, "", " ", "la " * 6000, "x" * 5000, "<|endoftext|> in a text", texts[0], texts[0]]
    documents = [(k if k % 11 else None, t) for k, t in enumerate(texts)] + [(1, texts[0]), (1, texts[1])]
    frame = spark.createDataFrame([(i, t, 7, "s", 1) for i, t in documents], "doc_id long, text string, start long, ids string, length int")
    for group_tokens in (3000, 1 << 20):
        rows = balanced.pack_balanced(frame.repartition(3), *VOCABULARY, 256, group_tokens=group_tokens).collect()
        by_sequence = check(rows, documents, tokenizer, 256)
        if group_tokens > 3000:
            assert sum(sum(r.length for r in s) < 256 for s in by_sequence.values()) <= 8
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert balanced.pack_balanced(empty, *VOCABULARY).count() == 0


def test_query_balances_cost(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    rows = balanced.query(spark, sf).collect()
    documents = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    by_sequence = check(rows, documents, tokenizer, 2048)
    full = [s[0].sequence_cost for s in by_sequence.values() if sum(r.length for r in s) == 2048]
    assert max(full) <= 1.34 * min(full)  # one whole piece against many short ones is 1.33


def test_length_is_a_power_of_two(spark):
    with pytest.raises(ValueError):
        balanced.pack_balanced(spark.createDataFrame([], "doc_id long, text string"), *VOCABULARY, 2000)
