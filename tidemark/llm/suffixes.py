"""Suffix-array dedup over bytes: which bytes lie in a string of ``length`` bytes that
also starts elsewhere.

The suffix order is only needed as far as it can tell strings of ``length`` bytes apart, so
suffixes are ranked by their first ``length`` bytes and sorted by induction from a sample,
the way induced sorting builds a suffix array.

1. Recursion (``reduce``).  Places where a smaller suffix ends and a larger one begins (LMS
   places) cut a text into phrases; phrases are renamed and the renamed text is cut
   again, three times, which leaves about one place in thirty.  Whether a place is kept
   depends on bytes near it only (``low`` to ``high``, carried along), so equal strings
   keep the same places.  Each window of ``length`` bytes is represented by the first
   kept place whose surroundings lie inside it; a place stands for the windows that
   start in the gap before it.
2. Sorting the sample.  Each kept place carries a tuple: rank of the prefix that all its
   windows share (``core``, common prefix of length - GAP), rank of the whole string its
   windows cover (``whole``, common prefix of length or more).  Tuples are shuffled and
   sorted by rank; neighbours of one rank have that common prefix.  A core without a
   neighbour ends there.  Equal ``whole`` settles all windows of a place at once.
3. Induction.  Where equal cores have unequal surroundings, the suffixes of the gap are
   induced from the sampled place (place, shift), ranked over ``length`` bytes (96 bits) and
   sorted again; equal neighbours are repeated strings.

The queues that the method keeps on disk are Spark's sorted shuffles, which spill: a task
holds one bucket, and buckets grow in number with the text (``arrays.bucket_count``).
Equal tuples inside a slice or bucket of rows are merged before they are sent on.  Windows
without a kept place (long periodic runs) and those more than GAP before one are ranked
directly, all of them.

Nulls count as empty texts; every row is a document of its own; texts under ``length``
bytes stay; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays as A

ROUNDS = 3
#: Windows that start more than this share of their length before a place are ranked directly.
GAP_SHARE = 4
TUPLE = np.dtype([("core", "<u8"), ("whole", "<u8")])
REACH = np.dtype([("start", "<u4"), ("count", "<u2")])
#: kind 0: sample tuples; 1: covered ranges, addressed to rows; 2: direct windows; 3: gaps to induce.
SPAN = np.dtype([("start", "<u4"), ("end", "<u4")])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                    ("n_spans", pa.int64()), ("kept", pa.binary())])


def _lms(sym, doc):
    """LMS places of the symbols of each document, and the place that decides each."""
    n = len(sym)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = doc[1:] == doc[:-1]
    step = np.flatnonzero((sym[1:] != sym[:-1]) | ~inside)
    rises = (sym[step + 1] > sym[step]) & inside[step]
    drop = np.flatnonzero((sym[:-1] > sym[1:]) & inside) + 1
    if not len(drop):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    nxt = np.searchsorted(step, drop)
    ok = nxt < len(step)
    drop, nxt = drop[ok], nxt[ok]
    up = rises[nxt]
    return drop[up], step[nxt[up]] + 1


def sampled(data: np.ndarray, borders: np.ndarray, roll: A.Rolling):
    """(place, low, high, document) of the places kept after ROUNDS reductions."""
    sym = data
    doc = np.repeat(np.arange(len(borders) - 1, dtype=np.int32), np.diff(borders))
    at = low = None
    high = None
    for r in range(ROUNDS):
        places, deciders = _lms(sym, doc)
        if at is None:
            at, low, high, doc = places, places - 1, deciders + 1, doc[places]
        else:
            at, low, high, doc = at[places], low[places - 1], high[deciders], doc[places]
        if r + 1 == ROUNDS or not len(at):
            break
        linked = np.flatnonzero(doc[1:] == doc[:-1])
        sym = roll(at[linked], at[linked + 1])
        at, low, high, doc = at[linked], low[linked], high[linked + 1], doc[linked]
        # a phrase is followed by the next one of its document, or by nothing
    return at, low, high, doc


def windows_by_place(data, borders, roll, length):
    """For each kept place with windows: (low, first window, end window, document); and a mask
    of the windows that no place stands for."""
    _, low, high, doc = sampled(data, borders, roll)
    if len(low):
        high = np.maximum.accumulate(high)
    gap = length // GAP_SHARE
    first = np.empty(len(low), np.int64)
    if len(low):
        first[0] = 0
        first[1:] = low[:-1] + 1
        new = np.append(True, doc[1:] != doc[:-1])
        first[new] = borders[doc[new]]
    first = np.maximum(first, np.maximum(low - gap, high - length))
    end = np.minimum(low, borders[doc + 1] - length) + 1
    has = end > first
    low, first, end, doc = low[has], first[has], end[has], doc[has]
    valid = np.maximum(borders[1:] - length + 1, borders[:-1])
    direct = A.covered(len(data), borders[:-1], valid) & ~A.covered(len(data), first, end)
    return low, first, end, doc, np.flatnonzero(direct)


def _window_keys(roll, check, at, length):
    key = np.empty(len(at), TUPLE)
    key["core"], key["whole"] = roll(at, at + length), check(at, at + length)
    return key


def sample_rows(docs: DataFrame, length: int, n: int) -> DataFrame:
    """Sample tuples (kind 0) and direct windows (kind 2) by key; ranges that a slice settles
    itself (kind 1) by row."""
    gap = length // GAP_SHARE

    def task(batches):
        for batch in batches:
            rids = A.id_values(batch.column("rid"))
            for top, bottom, data, borders in A.text_slices(batch.column("text"), A.SLICE_BYTES // 2):
                if not (np.diff(borders) >= length).any():
                    continue
                own = rids[top:bottom]
                roll = A.Rolling(A.BYTE_VALUES[data])
                low, first, end, doc, direct = windows_by_place(data, borders, roll, length)
                key = np.empty(len(low), TUPLE)
                key["core"] = roll(low, low + (length - gap))
                key["whole"] = roll(first, end + length - 1) ^ A.mix((low - first).astype(A.U))
                reach = np.empty(len(low), REACH)
                reach["start"], reach["count"] = first - borders[doc], end - first
                owner = own[doc]
                order = np.lexsort((key["whole"], key["core"]))
                same = A.same_as_before(key["core"][order], key["whole"][order])
                many, head = np.sort(order[A.in_group_of_many(same)]), np.sort(order[~same])
                yield from A.pack(0, key["core"][head] % A.U(n), owner[head], key[head], reach[head])
                span = np.empty(len(many), SPAN)
                span["start"] = reach["start"][many]
                span["end"] = span["start"] + reach["count"][many] + length - 1
                yield from A.pack(1, A.row_bucket(owner[many], n), owner[many], span)
                if len(direct):
                    check = A.Rolling(A.BYTE_VALUES[data], A.CHECK_BASE)
                    key = _window_keys(roll, check, direct, length)
                    doc = np.searchsorted(borders, direct, "right") - 1
                    yield from _send_windows(key, own[doc], (direct - borders[doc]).astype(np.uint32), length, n)

    return docs.select("rid", "doc_id", "text").mapInArrow(task, A.BLOB_SCHEMA)


def _send_windows(key, owner, place, length, n):
    """Windows by key, one of each in this task; the repeated ones' ranges by row."""
    order = np.lexsort((key["whole"], key["core"]))
    same = A.same_as_before(key["core"][order], key["whole"][order])
    many, head = np.sort(order[A.in_group_of_many(same)]), np.sort(order[~same])
    yield from A.pack(2, key["core"][head] % A.U(n), owner[head], key[head], place[head])
    yield from _send_spans(owner[many], place[many], length, n)


def _send_spans(owner, place, length, n):
    """Ranges [place, place + length) of rows, neighbours joined, by row (kind 1)."""
    if not len(owner):
        return
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order].astype(np.int64)
    new = np.append(True, (owner[1:] != owner[:-1]) | (place[1:] > place[:-1] + length))
    at = np.flatnonzero(new)
    span = np.empty(len(at), SPAN)
    span["start"], span["end"] = place[at], place[np.append(at[1:], len(place)) - 1] + length
    yield from A.pack(1, A.row_bucket(owner[at], n), owner[at], span)


def _equal_windows(table, length, n):
    owner, key, place = A.unpack(A.of_kind(table, 2), np.int64, TUPLE, np.uint32)
    order = np.lexsort((key["whole"], key["core"]))
    many = order[A.in_group_of_many(A.same_as_before(key["core"][order], key["whole"][order]))]
    return list(_send_spans(owner[many], place[many], length, n))


def sorted_sample(rows: DataFrame, length: int, n: int) -> DataFrame:
    """Kind 1: settled ranges; kind 3: gaps whose suffixes have to be induced, both by row."""
    def bucket(table: pa.Table) -> pa.Table:
        found = _equal_windows(table, length, n)
        owner, key, reach = A.unpack(A.of_kind(table, 0), np.int64, TUPLE, REACH)
        order = np.lexsort((key["whole"], key["core"]))
        owner, key, reach = owner[order], key[order], reach[order]
        same_core = A.same_as_before(key["core"])
        same = same_core & A.same_as_before(key["whole"])
        settled = A.in_group_of_many(same)
        group = np.cumsum(~same_core) - 1
        kinds = np.bincount(group, weights=~same, minlength=int(group[-1]) + 1 if len(group) else 0)
        induce = ~same & (kinds[group] > 1) if len(group) else same
        span = np.empty(len(owner), SPAN)
        span["start"], span["end"] = reach["start"], reach["start"] + reach["count"] + length - 1
        for kind, which in ((1, settled), (3, induce)):
            at = np.flatnonzero(which)
            at = at[np.lexsort((span["start"][at], owner[at]))]
            found += A.pack(kind, A.row_bucket(owner[at], n), owner[at], span[at])
        return pa.concat_tables([A.of_kind(table, 1), A.tables(found, A.BLOB_ARROW)])

    return rows.groupBy("bucket").applyInArrow(bucket, A.BLOB_SCHEMA)


def _joined(rids, borders, table, kind):
    """Ranges of a kind as places in the bucket's bytes."""
    owner, span, _ = A.unpack(A.of_kind(table, kind), np.int64, SPAN)
    order = np.argsort(rids)
    base = borders[order[np.searchsorted(rids[order], owner)]] if len(owner) else np.zeros(0, np.int64)
    return base + span["start"], base + span["end"]


def induced_rows(texts: DataFrame, found: DataFrame, length: int, n: int) -> DataFrame:
    """Kind 2: the suffixes of unsettled gaps by their first ``length`` bytes; kind 1 as before."""
    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return A.tables([], A.BLOB_ARROW)
        kept = A.of_kind(right, 1)
        rids, _, data, borders = A.unpack_texts(left)
        start, end = _joined(rids, borders, right, 3)
        gap = np.flatnonzero(A.covered(len(data), start, end - (length - 1)))
        made = []
        if len(gap):
            key = _window_keys(A.Rolling(A.BYTE_VALUES[data]), A.Rolling(A.BYTE_VALUES[data], A.CHECK_BASE), gap, length)
            doc = np.searchsorted(borders, gap, "right") - 1
            made = list(_send_windows(key, rids[doc], (gap - borders[doc]).astype(np.uint32), length, n))
        return pa.concat_tables([kept, A.tables(made, A.BLOB_ARROW)])

    return texts.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(rows, A.BLOB_SCHEMA)


def equal_suffixes(rows: DataFrame, length: int, n: int) -> DataFrame:
    def bucket(table: pa.Table) -> pa.Table:
        return pa.concat_tables([A.of_kind(table, 1), A.tables(_equal_windows(table, length, n), A.BLOB_ARROW)])

    return rows.groupBy("bucket").applyInArrow(bucket, A.BLOB_SCHEMA)


def drop_ranges(texts: DataFrame, found: DataFrame) -> DataFrame:
    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([], schema=RESULT)
        rids, ids, data, borders = A.unpack_texts(left)
        gone = np.zeros(len(data), bool)
        if right.num_rows:
            gone = A.covered(len(data), *_joined(rids, borders, right, 1))
        steps = np.append(0, np.cumsum(gone))
        removed = steps[borders[1:]] - steps[borders[:-1]]
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = borders[:-1][np.diff(borders) > 0]
        begins[inner] = gone[inner]
        starts = np.append(0, np.cumsum(begins))
        spans = starts[borders[1:]] - starts[borders[:-1]]
        stay = data[~gone].tobytes()
        at = borders - steps[borders]
        kept = [stay[at[k]: at[k + 1]] for k in range(len(rids))]
        return pa.table([A.doc_ids(ids), pa.array(np.diff(borders), pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], schema=RESULT)

    return texts.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(
        rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def dedup_bytes(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for documents (doc_id, text, ...)."""
    if length < 8:
        raise ValueError("a repeated string has 8 bytes at least")
    docs = A.keyed(docs)
    n = A.bucket_count(docs)
    texts = A.text_rows(docs, n)
    sample = sorted_sample(sample_rows(docs, length, n), length, n)
    found = equal_suffixes(induced_rows(texts, sample, length, n), length, n)
    return drop_ranges(texts, found)


def query(spark, sf_dir) -> DataFrame:
    """op10: 400 bytes, all documents."""
    out = dedup_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
