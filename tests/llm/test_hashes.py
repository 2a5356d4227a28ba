"""Hashes of ranges: strings made to collide modulo 2**64 stay apart in every operator that takes equal hashes as equal."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import arrays as A
from tidemark.llm import packing, parity, substring, suffixes

SCHEMA = "doc_id long, text string"


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


@pytest.fixture(params=[512, 1024, 4096])
def pair(request):
    return thue_morse(request.param, "ab"), thue_morse(request.param, "ba")


@pytest.mark.parametrize("base", [A.BASE, A.WORD_BASE, A.CHECK_BASE])
def test_no_collision_of_thue_morse_strings(pair, base):
    data = np.frombuffer("".join(pair).encode(), np.uint8)
    n = len(pair[0])
    roll = A.Rolling(A.BYTE_VALUES[data], base)
    found = roll(np.array([0, n]), np.array([n, 2 * n]))
    assert found[0] != found[1]


def test_equal_ranges_have_equal_hashes_at_all_lengths():
    rng = np.random.default_rng(5)
    one = rng.integers(0, 4, 3000).astype(np.uint8)
    data = np.concatenate([rng.integers(0, 4, 77).astype(np.uint8), one, one])
    roll = A.Rolling(A.BYTE_VALUES[data])
    lengths = np.array([0, 1, 63, 64, 65, 127, 128, 129, 1000, 3000])
    left = roll(np.full(len(lengths), 77), 77 + lengths)
    right = roll(np.full(len(lengths), 3077), 3077 + lengths)
    assert (left == right).all() and len(set(left.tolist())) == len(lengths)


def test_many_long_ranges_in_parts(monkeypatch):
    data = np.random.default_rng(6).integers(0, 256, 5000).astype(np.uint8)
    roll = A.Rolling(A.BYTE_VALUES[data])
    at = np.arange(0, 4000)
    whole = roll(at, at + 400)
    monkeypatch.setattr(A, "BLOCKS_AT_ONCE", 10)
    assert (roll(at, at + 400) == whole).all() and len(np.unique(whole)) == len(whole)


def test_op1_does_not_link_them(spark, pair):
    docs = spark.createDataFrame([(i, f"one two {x} four five") for i, x in enumerate(pair)], SCHEMA)
    assert {tuple(r) for r in parity.jaccard_components(docs).select("doc_id", "component_id").collect()} == {(0, 0), (1, 1)}


def test_op2_keeps_words_that_occur_once(spark, pair):
    around = [f"w{i}" for i in range(10)], [f"v{i}" for i in range(10)]
    docs = spark.createDataFrame([(i, " ".join([*around[0], x, *around[1]])) for i, x in enumerate(pair)], SCHEMA)
    assert {r["n_removed"] for r in substring.dedup_windows(docs).collect()} == {0}


def test_op9_gives_each_its_own_ids(spark, pair):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame(list(enumerate(pair)), SCHEMA)
    found = {r["doc_id"]: r["ids_crc32"] for r in packing.pack_documents(docs, path).collect()}
    for i, text in enumerate(pair):
        ids = [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 1]
        assert found[i] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op10_with_longer_strings(spark, pair, length=512):
    docs = spark.createDataFrame(list(enumerate(pair)), SCHEMA)
    windows = Counter(x[i: i + length] for x in pair for i in range(len(x) - length + 1))
    expected = {}
    for d, x in enumerate(pair):
        gone = {j for i in range(len(x) - length + 1) if windows[x[i: i + length]] > 1 for j in range(i, i + length)}
        expected[d] = len(gone)
    assert {r["doc_id"]: r["n_removed"] for r in suffixes.dedup_bytes(docs, length).collect()} == expected
