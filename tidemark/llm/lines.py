"""Line dedup by a sharded minimal perfect hash.

1. Each bucket of documents lists its distinct line keys once (128-bit hash, number of its
   documents that hold it, the largest of them) and sends them to the key's shard.  A line
   in a third of all documents is one entry per bucket of documents.
2. A shard adds its entries up and builds a minimal perfect hash over its distinct line
   hashes: levels of bit arrays in which a key that is alone on its bit is settled; the rank of
   the bit is the key's place.  The places index compact arrays: fingerprint, document count,
   last document.
3. Buckets of documents probe the arrays of the shards with their keys and get back those
   found in ``min_docs`` documents; documents then drop lines by looking up these answers.
   Lines are never joined.

A key has white space stripped at both ends and A-Z in lower case.  Null and empty texts are
one empty line.  Every row is a document of its own; the largest document is the one with the
largest (doc_id, row), null ids last.  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays as A

KEY = np.dtype([("place", "<u8"), ("print", "<u8")])
SEEN = np.dtype([("docs", "<u4"), ("id", "<i8"), ("rid", "<i8")])
INDEX_SCHEMA = "bucket int, sizes binary, bits binary, prints binary, counts binary, last binary"
INDEX_ARROW = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in
                         ("sizes", "bits", "prints", "counts", "last"))])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()),
                    ("kept_text", pa.string())])
LAST = np.dtype([("id", "<i8"), ("rid", "<i8")])


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a line's key; None for keys under ``min_chars`` code points."""
    key = line.strip(b" \t\n\x0b\x0c\r").lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return blake2b(key, digest_size=16).digest()


def _salt(level: int) -> np.uint64:
    return A.U((level + 1) * int(A.BASE) % (1 << 64))


def build(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimal perfect hash over distinct 64-bit values: (level sizes, bits, place of each value)."""
    left, sizes, bits, settled = np.arange(len(place)), [], [], np.empty(len(place), np.int64)
    offset = 0
    while len(left):
        size = max(64, 2 * len(left))
        at = (A.mix(place[left] + _salt(len(sizes))) % A.U(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        fits = alone[at]
        settled[left[fits]] = offset + at[fits]
        sizes.append(size)
        bits.append(alone)
        left, offset = left[~fits], offset + size
    flags = np.concatenate(bits) if bits else np.zeros(0, bool)
    return np.array(sizes, np.int64), flags, (np.cumsum(flags) - 1)[settled] if len(place) else settled


def look_up(sizes: np.ndarray, flags: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Place of each value in the arrays; -1 where no level settles it."""
    rank, found, left, offset = np.cumsum(flags) - 1, np.full(len(place), -1), np.arange(len(place)), 0
    for level, size in enumerate(sizes.tolist()):
        at = offset + (A.mix(place[left] + _salt(level)) % A.U(size)).astype(np.int64)
        hit = flags[at]
        found[left[hit]] = rank[at[hit]]
        left, offset = left[~hit], offset + size
    return found


def _lines(data, borders):
    view = memoryview(data)
    return [bytes(view[borders[k]: borders[k + 1]]).split(b"\n") for k in range(len(borders) - 1)]


def key_rows(texts: DataFrame, min_chars: int, n: int) -> DataFrame:
    """Packed (key, documents of this bucket, largest of them), addressed to shards, from a bucket."""
    @A.trimmed
    def rows(table: pa.Table) -> pa.Table:
        rids, ids, data, borders = A.unpack_texts(table)
        seen: dict[bytes, list] = {}
        for k, lines in enumerate(_lines(data, borders)):
            own = (int(ids[k]), int(rids[k]))
            for key in {key for line in lines if (key := line_key(line, min_chars))}:
                have = seen.setdefault(key, [0, own])
                have[0] += 1
                have[1] = max(have[1], own)
        keys = np.frombuffer(b"".join(seen), KEY)
        extra = np.array([(c, *last) for c, last in seen.values()], SEEN)
        home = np.full(len(keys), table.column("bucket")[0].as_py(), np.int64)
        return A.tables(list(A.pack(0, keys["place"] % A.U(n), home, keys, extra)), A.BLOB_ARROW)

    return texts.groupBy("bucket").applyInArrow(rows, A.BLOB_SCHEMA)


def build_index(keys: DataFrame) -> DataFrame:
    """One row per shard: the perfect hash and its arrays."""
    @A.trimmed
    def shard(table: pa.Table) -> pa.Table:
        _, key, seen = A.unpack(table, np.int64, KEY, SEEN)
        order = np.lexsort((seen["rid"], seen["id"], key["print"], key["place"]))
        key, seen = key[order], seen[order]
        starts = np.flatnonzero(~A.same_as_before(key["place"], key["print"]))
        ends = np.append(starts[1:], len(key)) - 1
        # two lines with one place value: the second stays outside the hash and is kept
        apart = ~A.same_as_before(key["place"][starts])
        docs = np.add.reduceat(seen["docs"], starts)[apart]
        starts, ends = starts[apart], ends[apart]
        sizes, flags, at = build(key["place"][starts])
        prints, counts, last = np.empty(len(at), np.uint64), np.empty(len(at), np.uint32), np.empty(len(at), LAST)
        prints[at], counts[at] = key["print"][starts], docs
        last["id"][at], last["rid"][at] = seen["id"][ends], seen["rid"][ends]
        row = [table.column("bucket")[0].as_py(), sizes.tobytes(), np.packbits(flags).tobytes(), prints.tobytes(),
               counts.tobytes(), last.tobytes()]
        return pa.table([pa.array([x], f.type) for x, f in zip(row, INDEX_ARROW, strict=True)], schema=INDEX_ARROW)

    return keys.groupBy("bucket").applyInArrow(shard, INDEX_SCHEMA)


def probe(index: DataFrame, keys: DataFrame, min_docs: int) -> DataFrame:
    """Packed (key, last document) of lines in ``min_docs`` documents, addressed to the bucket of
    documents that asked."""
    @A.trimmed
    def shard(left: pa.Table, right: pa.Table) -> pa.Table:
        home, key, _ = A.unpack(right, np.int64, KEY, SEEN)
        column = lambda name, kind: np.frombuffer(left.column(name)[0].as_py(), kind)
        sizes = column("sizes", np.int64)
        flags = np.unpackbits(column("bits", np.uint8), count=int(sizes.sum())).astype(bool)
        at = look_up(sizes, flags, key["place"])
        hit = (at >= 0) & (column("prints", np.uint64)[at] == key["print"]) & (column("counts", np.uint32)[at] >= min_docs)
        home, key, last = home[hit], key[hit], column("last", LAST)[at[hit]]
        return A.tables(list(A.pack(1, home, home, key, last)), A.BLOB_ARROW)

    return index.groupBy("bucket").cogroup(keys.groupBy("bucket")).applyInArrow(shard, A.BLOB_SCHEMA)


def drop_lines(texts: DataFrame, answers: DataFrame, min_chars: int, carried: tuple[str, ...] = ()) -> DataFrame:
    schema = pa.schema([*RESULT, *((c, pa.string()) for c in carried)])

    @A.trimmed
    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([], schema=schema)
        rids, ids, data, borders = A.unpack_texts(left)
        more = A.unpack_carried(left) if carried else []
        gone = {}
        if right.num_rows:
            _, key, last = A.unpack(right, np.int64, KEY, LAST)
            raw = key.tobytes()
            gone = {raw[16 * i: 16 * i + 16]: own for i, own in enumerate(last.tolist())}
        total, dropped, kept = [], [], []
        for k, lines in enumerate(_lines(data, borders)):
            total.append(len(lines))
            if gone:
                own = (int(ids[k]), int(rids[k]))
                lines = [x for x in lines if gone.get(line_key(x, min_chars), own) == own]
            dropped.append(total[-1] - len(lines))
            kept.append(b"\n".join(lines).decode())
        return pa.table([A.doc_ids(ids), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()),
                         pa.array(kept, pa.string()), *(pa.array([m[c] for m in more], pa.string()) for c in range(len(carried)))],
                        schema=schema)

    return texts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(rows, ", ".join(
        ["doc_id long, n_lines long, n_dropped long, kept_text string", *(f"`{c}` string" for c in carried)]))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text, carried string columns) for documents (doc_id, text, ...)."""
    docs = A.keyed(docs, ("text", *carried))
    n = A.bucket_count(docs)
    texts = A.text_rows(docs, n, carried)
    keys = key_rows(texts, min_chars, n)
    return drop_lines(texts, probe(build_index(keys), keys, min_docs), min_chars, carried)


def query(spark, sf_dir) -> DataFrame:
    """op7: keys of 40 code points in 5 documents, all documents."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, i, lines[i] AS line,
    translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), common AS (
  SELECT k, max(doc_id) AS last_doc FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT l.doc_id, l.i, l.line, c.k IS NOT NULL AND l.doc_id <> c.last_doc AS gone FROM l LEFT JOIN common c USING (k)
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
