"""Vectorised text helpers shared by the operators: Arrow buffers in, numpy arrays out.

Tasks see texts as one UTF-8 byte array per Arrow batch plus document borders, and
entries (hashes of shingles, windows, lines) travel through Spark's shuffle as packed
rows: one row per (slice of a batch, bucket) whose binary columns hold the entries of
that bucket.  Spark partitions, shuffles, spills and retries those rows; a task decodes
only the bucket it was dealt, and the number of buckets grows with the input
(``bucket_count``), so a bucket stays within ``BUCKET_BYTES`` of text whatever the total.
"""

from __future__ import annotations

import ctypes
import functools
import inspect
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes that one bucket stands for, and that one slice of a batch holds at most
#: (one longer document is a slice of its own).
BUCKET_BYTES = 5 << 20
SLICE_BYTES = 3 << 20
U = np.uint64
BASE, WORD_BASE, CHECK_BASE = U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95), U(0xC2B2AE3D27D4EB4F)
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * BASE)
LOWER_VALUES = BYTE_VALUES[LOWER]
STEP = 1 << 16
#: Values that one polynomial covers.  Modulo 2**64 longer ones can be made equal (Thue-Morse sequences, from 512
#: values on), so the hashes of the blocks of a longer range are mixed with their places and added up.
BLOCK = 64
BLOCKS_AT_ONCE = 1 << 18
_POWERS: dict[int, list[np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i modulo 2**64 for i < STEP, and base**(STEP * i) for all i that places under n need."""
    have = _POWERS.setdefault(base, [np.zeros(0, U), np.zeros(0, U)])
    for k, (b, size) in enumerate(((base, STEP), (pow(base, STEP, 1 << 64), n // STEP + 1))):
        if len(have[k]) < size:
            steps = np.full(2 * size if k else size, b, U)
            steps[0] = 1
            have[k] = np.multiply.accumulate(steps)
    return have[0], have[1]


class Rolling:
    """Hashes of any [start, end) ranges of one value array, after one prefix sum.

    ``spare`` says that the values may be overwritten, which saves a copy.
    """

    def __init__(self, values: np.ndarray, base: np.uint64 = BASE, spare: bool = True):
        n = len(values)
        low, high = powers(int(base), n)
        self.down = powers(pow(int(base), -1, 1 << 64), n)
        scaled = values if spare and values.flags.writeable else values.copy()
        for k in range(0, n, STEP):
            part = scaled[k: k + STEP]
            part *= low[:len(part)]
            part *= high[k // STEP]
        self.prefix = np.zeros(n + 1, U)
        np.cumsum(scaled, out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        blocks = (end - start + (BLOCK - 1)) // BLOCK
        long = np.flatnonzero(blocks > 1)
        if not len(long):
            return self._polynomials(start, end)
        out = self._polynomials(start, np.minimum(end, start + BLOCK))
        done = np.cumsum(blocks[long])
        for part in np.split(long, np.flatnonzero(np.diff(done // BLOCKS_AT_ONCE)) + 1):
            count = blocks[part]
            first = np.cumsum(count) - count
            k = np.arange(int(count.sum())) - np.repeat(first, count)
            at = np.repeat(start[part], count) + k * BLOCK
            each = self._polynomials(at, np.minimum(at + BLOCK, np.repeat(end[part], count)))
            total = np.add.reduceat(mix(each + k.astype(U) * WORD_BASE), first)
            out[part] = mix(total + (end[part] - start[part]).astype(U) * CHECK_BASE)
        return out

    def _polynomials(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        low, high = self.down
        out = self.prefix[end] - self.prefix[start]
        out *= low[start & (STEP - 1)]
        out *= high[start >> 16]
        return mix(out + (end - start).astype(U) * CHECK_BASE)


@functools.cache
def _malloc_trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def _give_back():
    pa.default_memory_pool().release_unused()
    _malloc_trim()(0)


def trimmed(work):
    """``work`` for mapInArrow or a grouped applyInArrow, after which its worker gives free memory back.

    Workers are reused and idle ones stay, so what their allocators keep would add up on an executor.
    """
    if inspect.isgeneratorfunction(work):
        def whole(batches):
            try:
                yield from work(batches)
            finally:
                _give_back()
    elif len(inspect.signature(work).parameters) == 1:
        def whole(table: pa.Table) -> pa.Table:
            try:
                return work(table)
            finally:
                _give_back()
    else:
        def whole(left: pa.Table, right: pa.Table) -> pa.Table:
            try:
                return work(left, right)
            finally:
                _give_back()
    return whole


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, borders from 0) of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    borders = np.frombuffer(offsets, np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(borders, borders[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[borders[first]: borders[end]], borders[first: end + 1] - borders[first]
        first = end


def word_spans(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document indexes of all words (runs without white space)."""
    word = np.zeros(len(data) + 1, bool)
    word[:-1] = ~SPACES[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = word[:-1]
    before[borders] = False
    starts = np.flatnonzero(word & ~before)
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = word[1:]
    inner = borders[1:-1]
    after[inner[inner > 0] - 1] = False
    if len(data):
        after[len(data) - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    docs = np.searchsorted(borders, starts, "right") - 1
    return starts, ends, docs


def word_counts(docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words per document and, per document, the index of its first word."""
    counts = np.bincount(docs, minlength=n).astype(np.int64)
    return counts, np.concatenate([[0], np.cumsum(counts)])


#: kind 0: entries for the bucket of their key, to be compared there; kind 1: findings
#: addressed to the bucket of a row (``row_bucket``).
BLOB_SCHEMA = "kind int, bucket int, docs binary, counts binary, keys binary, extra binary"
BLOB_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c in
                        ("docs", "counts", "keys", "extra"))])


def pack(kind: int, bucket: np.ndarray, ids: np.ndarray, keys: np.ndarray,
         extra: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One row per bucket of entries (id, key, extra); ids of neighbours are run-length coded."""
    if not len(bucket):
        return
    small = bucket.astype(np.uint16 if bucket.max() < 65536 else np.uint32)
    order = np.argsort(small, kind="stable")
    bucket, ids, keys = small[order], ids[order], keys[order]
    extra = extra[order] if extra is not None else None
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (ids[1:] != ids[:-1])
    runs = np.flatnonzero(new)
    counts = np.diff(np.append(runs, len(bucket))).astype(np.uint32)
    ids = ids[runs]
    at = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    run_at = np.searchsorted(runs, at)
    columns: list[list] = [[], [], [], [], [], []]
    for k, b in enumerate(bucket[at[:-1]].tolist()):
        columns[0].append(kind)
        columns[1].append(b)
        columns[2].append(ids[run_at[k]: run_at[k + 1]].tobytes())
        columns[3].append(counts[run_at[k]: run_at[k + 1]].tobytes())
        columns[4].append(keys[at[k]: at[k + 1]].tobytes())
        columns[5].append(extra[at[k]: at[k + 1]].tobytes() if extra is not None else b"")
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, BLOB_ARROW, strict=True)],
                                     schema=BLOB_ARROW)


def unpack(table: pa.Table, id_type, key_type, extra_type=None):
    """(id, key, extra) of all entries of a bucket's packed rows."""
    join = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    ids = np.repeat(join("docs", id_type), join("counts", np.uint32))
    return ids, join("keys", key_type), join("extra", extra_type) if extra_type is not None else None


def of_kind(table: pa.Table, kind: int) -> pa.Table:
    return table.filter(pa.array(table.column("kind").to_numpy() == kind))


def same_as_before(*columns: np.ndarray) -> np.ndarray:
    """For sorted columns: whether a place equals the one before it."""
    same = np.zeros(len(columns[0]), bool)
    if len(same):
        same[1:] = True
        for c in columns:
            same[1:] &= c[1:] == c[:-1]
    return same


def in_group_of_many(same: np.ndarray) -> np.ndarray:
    """From ``same_as_before``: whether a place's run has more than one member."""
    return same | np.append(same[1:], False) if len(same) else same


def tables(batches: list[pa.RecordBatch], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches(batches, schema=schema)


def bucket_count(texts: DataFrame, column: str = "text", each: int = BUCKET_BYTES) -> int:
    """Buckets for a table: by its text bytes, at least one for each shuffle partition.  Every
    task emits up to one packed row per bucket, so there are no more buckets than needed."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(max(partitions, -(-int(size) // each)))


RID = "_rid"


def numbered(docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``columns`` and ``RID``, a number of each row that all later scans give again, whatever their splits.

    Rows of Parquet files are numbered by file (in order of path) and place in it; the rows of other tables
    are written once to the shared folder with their numbers.
    """
    from tidemark.session import shared_dir

    spark, plan = docs.sparkSession, docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    try:
        if plan.nodeName() != "LogicalRelation":
            raise AnalysisException("not rows of files")
        rows = docs.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"), *columns)
    except AnalysisException:
        path = f"{shared_dir(spark)}/numbered-{uuid.uuid4().hex}"
        docs.select(F.monotonically_increasing_id().alias(RID), *columns).write.parquet(path)
        return spark.read.parquet(path)
    paths = sorted(r[0] for r in rows.select("_path").distinct().collect())
    files = spark.createDataFrame(list(enumerate(paths)), "_file long, _path string")
    rows = rows.join(F.broadcast(files), "_path")  # one row per file
    return rows.select((F.shiftleft("_file", 36) + F.col("_row")).alias(RID), *columns)


def keyed(docs: DataFrame, columns: tuple[str, ...] = ("text",), rid: str | None = None) -> DataFrame:
    """(rid, doc_id, columns): every input row is a document of its own.

    ``rid`` numbers rows, so repeated rows and null ids stay apart: by input split and position, which
    another scan gives again only if it is split alike, or from the column ``rid`` (see ``numbered``).
    """
    return docs.select((F.monotonically_increasing_id() if rid is None else F.col(rid)).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                       *(F.col(c).cast("string").alias(c) for c in columns))


TEXT_SCHEMA = "bucket int, rids binary, ids binary, sizes binary, text binary, more binary"
TEXT_ARROW = pa.schema([("bucket", pa.int32()), ("rids", pa.binary()), ("ids", pa.binary()), ("sizes", pa.binary()),
                        ("text", pa.binary()), ("more", pa.binary())])
NO_ID = np.iinfo(np.int64).max


def row_bucket(rid: np.ndarray, n: int) -> np.ndarray:
    return (mix(rid.astype(U)) % U(n)).astype(np.int64)


def id_values(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def text_rows(docs: DataFrame, n: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """Texts packed by ``row_bucket`` and compressed, for the steps that need a text beside
    what was found about it; ``carried`` names further string columns to keep with them."""
    @trimmed
    def task(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rids, ids = id_values(batch.column("rid")), id_values(batch.column("doc_id"))
            more = list(zip(*(batch.column(c).to_pylist() for c in carried), strict=True))
            for first, end, data, borders in text_slices(batch.column("text"), 4 * SLICE_BYTES):
                bucket = row_bucket(rids[first:end], n)
                order = np.argsort(bucket, kind="stable")
                found, at = np.unique(bucket[order], return_index=True)
                view, rows = memoryview(data), [[], [], [], [], [], []]
                for b, members in zip(found, np.split(order, at[1:]), strict=True):
                    rows[0].append(int(b))
                    rows[1].append(rids[first:end][members].tobytes())
                    rows[2].append(ids[first:end][members].tobytes())
                    rows[3].append((borders[members + 1] - borders[members]).astype(np.int64).tobytes())
                    rows[4].append(press.compress(b"".join(view[borders[m]: borders[m + 1]] for m in members)))
                    rows[5].append(pickle.dumps([more[first + m] for m in members.tolist()]) if carried else None)
                yield pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, TEXT_ARROW, strict=True)],
                                                 schema=TEXT_ARROW)

    return docs.select("rid", "doc_id", "text", *carried).mapInArrow(task, TEXT_SCHEMA)


def unpack_texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rids, ids, bytes, borders) of a bucket of ``text_rows``."""
    import zstandard

    opener = zstandard.ZstdDecompressor()
    join = lambda name: np.frombuffer(b"".join(table.column(name).to_pylist()), np.int64)
    data = np.frombuffer(b"".join(opener.decompress(x) for x in table.column("text").to_pylist()), np.uint8)
    return join("rids"), join("ids"), data, np.concatenate([[0], np.cumsum(join("sizes"))])


def unpack_carried(table: pa.Table) -> list[tuple]:
    """The carried columns of a bucket of ``text_rows``, a tuple per document."""
    return [row for x in table.column("more").to_pylist() for row in pickle.loads(x)]


def doc_ids(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in any [start, end)."""
    return np.cumsum(np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1))[:n] > 0
