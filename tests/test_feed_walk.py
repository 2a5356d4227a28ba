"""The cursor walk against following the cursors one by one."""

import random

import pytest

from tidemark.sources import feed


def followed(links):
    """links: {feed: [(page_id, page_seq, next_cursor)]}."""
    out = set()
    for name, pages in links.items():
        to = {}
        for page, _, cursor in sorted(pages, key=lambda p: (p[1], p[2] is not None, p[2] or "")):
            to.setdefault(page, cursor)
        at, seen = min(pages, key=lambda p: (p[1], p[0]))[0], []
        while at is not None and at in to and at not in seen:
            seen.append(at)
            at = to[at]
        outcome = feed.COMPLETE if at is None else feed.REPEATED if at in seen else feed.MISSING
        out |= {(name, p, k, outcome) for k, p in enumerate(seen)}
    return out


def feeds(seed):
    rng, links = random.Random(seed), {}
    for name in ("whole", "gap", "loop", "detached", "shuffled", "one", "self", "twice"):
        n = rng.randrange(12, 40)
        pages = [(f"{k}", k, f"{k + 1}" if k + 1 < n else None) for k in range(n)]
        if name == "gap":
            del pages[rng.randrange(3, n)]
        if name == "loop":
            pages[-1] = (pages[-1][0], n - 1, f"{rng.randrange(1, n)}")
        if name == "detached":
            pages[7] = ("7", 7, None)
        if name == "shuffled":   # a walk that jumps between far pages
            ids = [str(k) for k in range(1, n)]
            rng.shuffle(ids)
            chain = ["0", *ids]
            pages = [(p, int(p), c) for p, c in zip(chain, [*chain[1:], None], strict=True)]
        if name in ("one", "self"):
            pages = [("0", 0, "0" if name == "self" else None)]
        if name == "twice":   # a page landed again later, with another cursor
            pages.append(("3", n + 5, None))
        links[name] = pages
    return links


@pytest.mark.parametrize("segment", [4, 4096])
def test_walks_of_many_feeds(spark, segment):
    links = feeds(segment)
    rows = [(name, *page) for name, pages in links.items() for page in pages]
    frame = spark.createDataFrame(rows, "feed string, page_id string, page_seq long, next_cursor string").repartition(3)
    found = {tuple(r) for r in feed.walk(frame, segment).collect()}
    assert found == followed(links)


def test_no_pages(spark):
    empty = spark.createDataFrame([], "feed string, page_id string, page_seq long, next_cursor string")
    assert feed.walk(empty).count() == 0
