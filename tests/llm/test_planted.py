"""op10 on planted passages of over 50 words: the contract's 400 bytes decide, not the number of words."""

import random

from tidemark.llm import suffixes

SCHEMA = "doc_id long, text string"


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 10))) for _ in range(n))


def of_bytes(rng, size):
    words = prose(rng, 80)[:size - 1] + "x"
    assert len(words) == size and words.count(" ") > 50
    return words


def removals(spark, passages, rng):
    """Bytes removed from the two documents of each passage, which differ on both sides of it, and from clean ones."""
    rows = []
    for k, x in enumerate(passages):
        rows += [(2 * k, f"{prose(rng, 60)}({x}){prose(rng, 60)}"), (2 * k + 1, f"{prose(rng, 60)}[{x}]{prose(rng, 60)}")]
    clean = [(10_000 + k, prose(rng, 200)) for k in range(40)]
    found = {r["doc_id"]: r["n_removed"] for r in suffixes.dedup_bytes(spark.createDataFrame(rows + clean, SCHEMA)).collect()}
    assert len(found) == len(rows) + len(clean)
    return [(found[2 * k], found[2 * k + 1]) for k in range(len(passages))], {found[i] for i, _ in clean}


def test_passages_of_51_to_200_words(spark):
    rng = random.Random(11)
    passages = [prose(rng, n) for n in range(51, 201)]
    short = [x for x in passages if len(x) < 400]
    assert 5 < len(short) < 50
    found, clean = removals(spark, passages, rng)
    assert found == [(len(x), len(x)) if len(x) >= 400 else (0, 0) for x in passages]
    assert clean == {0}


def test_border_of_400_bytes(spark):
    rng = random.Random(12)
    sizes = [398, 399, 400, 401]
    found, clean = removals(spark, [of_bytes(rng, n) for n in sizes], rng)
    assert found == [(0, 0), (0, 0), (400, 400), (401, 401)]
    assert clean == {0}
