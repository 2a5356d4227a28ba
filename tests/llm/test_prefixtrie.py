"""The conversation trie against dictionaries of whole prefixes, whatever the shards."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import prefixtrie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, depth long, path string, shard int"


def plain(rows):
    """rows: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv_id].append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(first, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        words = len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[b] for b in below)
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(node)))).encode()).hexdigest())
                  for node, m in members.items())


def table(seed, n):
    rng = random.Random(seed)
    texts = ["yes", "no  way", "", None, "thanks a lot", "日本 語", "a\tb\nc"]
    rows = []
    for c in [*rng.sample(range(-60, 20 * n), n), 10 ** 12]:
        size = rng.choice([1, 1, 2, 3, 5, 9])
        rows += [(c, k if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(texts)) for k in range(size)]
    rows += [(7000 + k, t, "user", f"the same {t} words") for k in range(40) for t in range(6)]
    rows += [(7000, t, "user", f"long {t % 3} text") for t in range(6, 150)]
    rows += rows[:4] + [(None, 1, "user", "nobody's")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "shard_turns", "blocks"), [(1, 20, 3), (2, 10 ** 6, 8192)])
def test_trie_equals_dictionaries(spark, monkeypatch, seed, shard_turns, blocks):
    rows = table(seed, 60)
    monkeypatch.setattr(prefixtrie, "ID_BLOCK", blocks)
    frame = spark.createDataFrame([(*r, 5, "p", 1) for r in rows], SCHEMA).repartition(3)
    found = sorted(map(tuple, prefixtrie.trie_nodes(prefixtrie.paths(frame), shard_turns).collect()), key=lambda r: (*r[:2], r[2] or -1, *r[3:]))
    assert found == sorted(plain(rows), key=lambda r: (*r[:2], r[2] or -1, *r[3:]))


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefixtrie.trie_nodes(prefixtrie.paths(empty)).count() == 0


def test_only_turnless_conversations(spark):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 4 and c % 20)
    rows = prefixtrie.trie_nodes(prefixtrie.paths(spark.createDataFrame([(c, 0, "user", "a")], "conv_id long, turn long, role string, text string"))).collect()
    assert list(map(tuple, rows)) == plain([(c, 0, "user", "a")])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=6).map(tuple), min_size=1, max_size=60, unique=True), st.integers(0, 2000))
def test_double_array_holds_the_paths_and_no_others(paths, seed):
    lengths = np.array([len(p) for p in paths])
    codes = np.array([c for p in paths for c in p], np.int64)
    trie, dense, levels = prefixtrie.build(codes, np.cumsum(lengths) - lengths, lengths, 31)
    prefixes = {p[:d] for p in paths for d in range(len(p) + 1)}
    assert sum(map(len, levels)) == len(prefixes) == int((trie.check >= 0).sum())
    rng = random.Random(seed)
    for p in [*prefixes, *(tuple(rng.randrange(31) for _ in range(rng.randrange(1, 5))) for _ in range(20))]:
        state = np.zeros(1, np.int64)
        for c in p:
            state = trie.step(state, dense[[c]]) if dense[c] >= 0 else np.full(1, -1)
            if state[0] < 0:
                break
        assert (state[0] >= 0) == (p in prefixes)
