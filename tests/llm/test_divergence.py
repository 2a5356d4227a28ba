"""The divergence audit against plain sums over every term."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(documents, min_docs=10, terms=10):
    """documents: (text, lang, source)."""
    per_group, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in documents:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        per_group[lang, source].update(found)
        seen[lang].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in seen[lang].items() if n >= min_docs]
        sources = sorted(s for own, s in groups if own == lang)

        def p(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        by_source = {s: p(per_group[lang, s]) for s in sources}
        whole = p(sum((per_group[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(f(by_source[s][t], by_source[o][t]) for t in kept), o) for o in sources if o != s]
            own = [(f(by_source[s][t], whole[t]), t) for t in kept if per_group[lang, s][t] and by_source[s][t] > whole[t]]
            for part, rows, limit in (("pair", pairs, None), ("term", own, terms)):
                ranked = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)}
    return out


def table(seed, sources):
    rng = random.Random(seed)
    pool = ["the", "The", "é1ñ", "Ünder", "日本", "a-b", "x\x00y", "ÀB", "[it]", "naïve", *(f"w{chr(97 + k)}" for k in range(20))]
    rows = [(" ".join(rng.choices(pool, k=rng.randrange(0, 40))), rng.choice(["en", "de", None]), rng.choice(sources)) for _ in range(160)]
    rows += [(None, "en", "empty"), ("", "xx", "only"), ("few words here", "yy", "a"), ("few", "yy", None), ("9 8 7", None, None)]
    return rows + rows[:5]


@pytest.mark.parametrize(("block", "slice_runs"), [(32, 16_384), (2, 3)])
def test_audit_equals_plain_sums(spark, block, slice_runs):
    rows = table(block, ["s1", "s2", "s3", "é", "Z", None])
    frame = spark.createDataFrame([(*r, "t", 1, 2) for r in rows], "text string, lang string, source string, term string, n int, rank int")
    found = divergence.audit(frame.repartition(3), block=block, slice_runs=slice_runs).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == plain(rows)


def test_no_documents(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_runs_merge_equal_neighbours():
    columns, length = divergence.column_runs([[("a", 2)], [("a", 2), ("b", 1)], [("b", 1)]], [3, 1, 2])
    assert length == 6
    assert [x.tolist() for x in columns["a"]] == [[0, 4], [2, 0]]
    assert [x.tolist() for x in columns["b"]] == [[0, 3], [0, 1]]


def test_counts_beyond_a_double_stay_exact():
    p = divergence.probabilities(np.array([10 ** 12, 0, 10 ** 12 + 1]), 3 * 10 ** 12, 7)
    assert p.tolist() == [1 + 10 ** 9 * (c + 2) // (3 * 10 ** 12 + 14) for c in (10 ** 12, 0, 10 ** 12 + 1)]
