"""Levels of the hierarchical packing: nothing lost, the same rule on every level, bounded work above."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import packing


def made(spark, lengths, groups, **bound):
    pieces = np.zeros(len(lengths), packing.PIECE)
    pieces["id"], pieces["length"] = np.arange(len(lengths)), lengths
    rows = [(g, bytearray(pieces[g::groups].tobytes())) for g in range(groups)]
    bins = packing.pack_pieces(spark.createDataFrame(rows, packing.PIECE_SCHEMA), groups, 4096, **bound).collect()
    return [b["sequence_id"] for b in bins], [np.frombuffer(b["pieces"], packing.PIECE) for b in bins]


def checked(lengths, numbers, bins):
    assert len(set(numbers)) == len(numbers)
    assert max(int(b["length"].sum()) for b in bins) <= 4096
    assert Counter(int(i) for b in bins for i in b["id"]) == Counter(range(len(lengths)))
    return len(bins)


def test_count_hardly_depends_on_the_groups(spark):
    lengths = np.random.default_rng(3).integers(1500, 2701, 20_000)
    counts = [checked(lengths, *made(spark, lengths, g)) for g in (1, 4, 16, 65)]
    assert max(counts) <= 1.005 * counts[0]


def test_small_pieces_fill_the_bins(spark):
    lengths = np.random.default_rng(4).integers(1, 900, 20_000)
    assert checked(lengths, *made(spark, lengths, 16)) <= 1 + 1.011 * lengths.sum() / 4096


@pytest.mark.parametrize("carried", [0, 1, 50])
def test_nothing_is_lost_where_few_pieces_move_on(spark, carried):
    lengths = np.random.default_rng(5).integers(1500, 4097, 500)
    checked(lengths, *made(spark, lengths, 9, carried=carried))


def test_the_emptiest_bins_move_on():
    fills, counts = np.array([4096, 4000, 100, 3000, 4060, 2000]), np.array([1, 2, 3, 4, 5, 2])
    assert packing.to_carry(fills, counts, 4096, 5).tolist() == [False, False, True, False, False, True]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters=" \t\n\x0b\x0c\r"), min_size=1, max_size=8)
                | st.sampled_from(["\u0130stanbul", "\u01c5", "\u017f", "\ufb00", "\u1100\u1161\u11a8", "e\u0301a", "\u00aab", "don't", "x" * 300, "word"]),
                max_size=30))
def test_chunks_tokenised_together_have_the_ids_of_each_alone(table_of_chunks, chunks):
    assert table_of_chunks.ends is not None
    assert table_of_chunks.encoded(chunks) == table_of_chunks._ids(chunks)


def test_other_tokenizers_take_chunks_one_by_one():
    table = packing.ChunkTable(public_tokenizers.path("byte_bpe_50k.json"))
    assert table.ends is None and table.encoded(["one", "two,", "é"]) == table._ids(["one", "two,", "é"])


@pytest.fixture(scope="module")
def table_of_chunks():
    return packing.ChunkTable(public_tokenizers.path("word_bpe_49k.json"))
