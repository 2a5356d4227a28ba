"""Substring dedup over words by difference-cover anchors.

The places 0..12 hold a difference cover {0, 1, 3, 9} modulo 13: for any two window starts
there is a shift under 13 that brings both onto cover places.  So two equal windows of 20
words share an anchor (a cover place of each document) whose 8 words are equal and lie
inside both windows.

1. Anchors: documents hash 8 words at cover places only (4 of 13 places).  Hashes meet in
   buckets; an anchor is repeated when its hash has another place.  A slice of documents
   first settles what repeats inside it, so a hash found in a third of all documents costs
   one entry per slice, not per document.
2. Extension: only windows that hold a repeated anchor are hashed whole (96 bits).  In a
   bucket of rows all but the earliest of equal windows are settled; the earliest go on to
   the bucket of their hash, where all but the first are found again.
3. Each word covered by a window found later than an equal one is removed.

Nulls count as empty texts, documents under 20 words stay as they are, every row is a
document of its own (repeated ids and rows too; order: doc_id with null last, then row
position).  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays as A

#: Perfect difference covers {period: places}; the longest anchor for a window is taken.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
OWNER = np.dtype([("id", "<i8"), ("rid", "<i8")])
WINDOW = np.dtype([("hash", "<u8"), ("check", "<u4")])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                    ("kept_text", pa.string())])


def _words(data, borders):
    starts, ends, docs = A.word_spans(data, borders)
    counts, first = A.word_counts(docs, len(borders) - 1)
    hashes = A.Rolling(A.BYTE_VALUES[data])(starts, ends)
    place = np.arange(len(starts)) - first[docs]
    return hashes, docs, place, counts, first


def anchor_rows(docs: DataFrame, words: int, n: int) -> DataFrame:
    """Packed (anchor hash, row, place): kind 0 by hash, kind 1 what a slice settles itself."""
    period = 13 if words >= 20 else 7 if words >= 10 else 3
    cover, span = np.isin(np.arange(period), COVERS[period]), words - period + 1

    def task(batches):
        for batch in batches:
            rids = A.id_values(batch.column("rid"))
            for first, end, data, borders in A.text_slices(batch.column("text")):
                hashes, docs, place, counts, _ = _words(data, borders)
                at = np.flatnonzero(cover[place % period] & (counts[docs] >= words) & (place + span <= counts[docs]))
                if not len(at):
                    continue
                key = A.Rolling(hashes, A.WORD_BASE)(at, at + span)
                owner, place = rids[first:end][docs[at]], place[at].astype(np.uint32)
                order = np.argsort(key, kind="stable")
                same = A.same_as_before(key[order])
                many = np.sort(order[A.in_group_of_many(same)])
                alone = np.sort(order[~same])
                yield from A.pack(0, key[alone] % A.U(n), owner[alone], key[alone], place[alone])
                yield from A.pack(1, A.row_bucket(owner[many], n), owner[many], place[many])

    return docs.select("rid", "doc_id", "text").mapInArrow(task, A.BLOB_SCHEMA)


def repeated_anchors(rows: DataFrame, n: int) -> DataFrame:
    """Kind 1 rows (row, place) of all repeated anchors."""
    def bucket(table: pa.Table) -> pa.Table:
        owner, key, place = A.unpack(A.of_kind(table, 0), np.int64, np.uint64, np.uint32)
        order = np.argsort(key, kind="stable")
        many = order[A.in_group_of_many(A.same_as_before(key[order]))]
        many = many[np.lexsort((place[many], owner[many]))]
        found = list(A.pack(1, A.row_bucket(owner[many], n), owner[many], place[many]))
        return pa.concat_tables([A.of_kind(table, 1), A.tables(found, A.BLOB_ARROW)])

    return rows.groupBy("bucket").applyInArrow(bucket, A.BLOB_SCHEMA)


def candidate_windows(texts: DataFrame, anchors: DataFrame, words: int, n: int) -> DataFrame:
    """Kind 0: the earliest of equal windows in a bucket of rows; kind 1: the later ones."""
    period = 13 if words >= 20 else 7 if words >= 10 else 3

    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return A.tables([], A.BLOB_ARROW)
        rids, ids, data, borders = A.unpack_texts(left)
        hashes, docs, place, counts, first = _words(data, borders)
        owner, at, _ = A.unpack(right, np.int64, np.uint32)
        order = np.argsort(rids)
        base = first[order[np.searchsorted(rids[order], owner)]]
        at = base + at
        low = np.maximum(base, at - (period - 1))
        mask = A.covered(len(docs), low, at + 1) & (place + words <= counts[docs])
        at = np.flatnonzero(mask)
        roll, check = A.Rolling(hashes, A.WORD_BASE, False), A.Rolling(hashes, A.CHECK_BASE)
        key = np.empty(len(at), WINDOW)
        key["hash"], key["check"] = roll(at, at + words), (check(at, at + words) >> A.U(32)).astype(np.uint32)
        owner = np.empty(len(at), OWNER)
        owner["id"], owner["rid"] = ids[docs[at]], rids[docs[at]]
        place = place[at].astype(np.uint32)
        order = np.lexsort((place, owner["rid"], owner["id"], key["check"], key["hash"]))
        same = A.same_as_before(key["hash"][order], key["check"][order])
        later, head = np.sort(order[same]), np.sort(order[~same])
        found = [*A.pack(0, key["hash"][head] % A.U(n), owner[head], key[head], place[head]),
                 *A.pack(1, A.row_bucket(owner["rid"][later], n), owner["rid"][later], place[later])]
        return A.tables(found, A.BLOB_ARROW)

    return texts.groupBy("bucket").cogroup(anchors.groupBy("bucket")).applyInArrow(rows, A.BLOB_SCHEMA)


def later_windows(rows: DataFrame, n: int) -> DataFrame:
    """Kind 1 rows (row, place) of windows that an equal one precedes."""
    def bucket(table: pa.Table) -> pa.Table:
        owner, key, place = A.unpack(A.of_kind(table, 0), OWNER, WINDOW, np.uint32)
        order = np.lexsort((place, owner["rid"], owner["id"], key["check"], key["hash"]))
        later = order[A.same_as_before(key["hash"][order], key["check"][order])]
        rid, place = owner["rid"][later], place[later]
        order = np.lexsort((place, rid))
        found = list(A.pack(1, A.row_bucket(rid[order], n), rid[order], place[order]))
        return pa.concat_tables([A.of_kind(table, 1), A.tables(found, A.BLOB_ARROW)])

    return rows.groupBy("bucket").applyInArrow(bucket, A.BLOB_SCHEMA)


def drop_words(texts: DataFrame, found: DataFrame, words: int) -> DataFrame:
    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        rids, ids, data, borders = A.unpack_texts(left) if left.num_rows else (np.zeros(0, np.int64),) * 4
        owner, at, _ = A.unpack(right, np.int64, np.uint32) if right.num_rows else (np.zeros(0, np.int64),) * 3
        order = np.argsort(owner, kind="stable")
        owner, at = owner[order], at[order].astype(np.int64)
        low, high = np.searchsorted(owner, rids, "left"), np.searchsorted(owner, rids, "right")
        view, total, removed, kept = memoryview(data), [], [], []
        for k in range(len(rids)):
            own = bytes(view[borders[k]: borders[k + 1]]).split()
            total.append(len(own))
            gone = 0
            if high[k] > low[k]:
                places = at[low[k]: high[k]]
                stay = ~A.covered(len(own), places, places + words)
                gone = len(own) - int(stay.sum())
                own = [own[i] for i in np.flatnonzero(stay)]
            removed.append(gone)
            kept.append(b" ".join(own).decode())
        return pa.table([A.doc_ids(ids), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(kept, pa.string())], schema=RESULT)

    return texts.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(
        rows, "doc_id long, n_words long, n_removed long, kept_text string")


def dedup_windows(docs: DataFrame, words: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for documents (doc_id, text, ...)."""
    if words < 4:
        raise ValueError("a window has 4 words at least")
    docs = A.keyed(docs)
    n = A.bucket_count(docs)
    texts = A.text_rows(docs, n)
    anchors = repeated_anchors(anchor_rows(docs, words, n), n)
    found = later_windows(candidate_windows(texts, anchors, words, n), n)
    return drop_words(texts, found, words)


def query(spark, sf_dir) -> DataFrame:
    """op2: 20 words, all documents."""
    out = dedup_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
