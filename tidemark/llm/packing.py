"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Tokenising.  A text's ids are those of its chunks: no token of this tokenizer family spans white
space, nor the border of an ASCII letter and ASCII punctuation.  A slice of documents finds
its distinct chunks by hash, runs the tokenizer on chunks its worker has not met, and gathers
ids by index; the worker's table of chunks starts anew beyond TABLE_BYTES.

Packing.  Documents end with ``end_id``; longer ones are cut.  Pieces meet in groups bounded by
text size; each group packs best-fit (longest first, into the fullest bin with room).  Bins full
up to FULL are emitted; the pieces of the others move on, FAN groups together, and are packed
again, up the tree to one group.  The rule is the same on every level.  A group moves CARRIED
pieces on at most, those of its emptiest bins, and emits its other bins as they are: they are
the ones that gain least, and a task of a higher level gets FAN times CARRIED pieces at most.
Nothing is left over.  The groups follow from the table alone, not from session settings.

Null and empty texts are the end id alone; every row is a document of its own (repeated
ids give repeated pieces); empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays as A

#: Bytes of a worker's table of chunks, beyond which it starts anew.
TABLE_BYTES = 48 << 20
#: Chunks that the tokenizer gets in one call.
ENCODED_AT_ONCE = 4096
#: Text bytes of a group, where each row counts ROW_BYTES besides (a row without text is a piece too).
GROUP_BYTES = 64 << 20
ROW_BYTES = 64
FAN = 8
#: Share of a bin from which on it is emitted, and pieces that a group moves to the next level at most.
FULL = 0.99
CARRIED = 1 << 17
PIECE = np.dtype([("id", "<i8"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")])
PIECE_SCHEMA = "bucket int, pieces binary"
PIECE_ARROW = pa.schema([("bucket", pa.int32()), ("pieces", pa.binary())])
BIN_SCHEMA = "bucket int, done boolean, sequence_id long, pieces binary"
BIN_ARROW = pa.schema([("bucket", pa.int32()), ("done", pa.bool_()), ("sequence_id", pa.int64()), ("pieces", pa.binary())])
#: Byte kinds: 1 ASCII letter, 2 ASCII punctuation that is never part of a longer pattern.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[[c for c in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)) if chr(c) not in "'<|>"]] = 2


class ChunkTable:
    """Ids of the chunks that a worker has met, by chunk hash."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        # ids of tokens that end a word, where every word has exactly one (an end-of-word suffix, all bytes known with it)
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix and all(c + suffix in vocabulary for c in ByteLevel.alphabet()):
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.clear()

    def encoded(self, texts: list[str]) -> list:
        """Ids of each chunk.  Chunks of letters alone are tokenised together, with blanks between: each gives at
        least one word, so if there are as many words as chunks, the words are the chunks."""
        made: list = [None] * len(texts)
        words = [i for i, t in enumerate(texts) if t.isalpha()] if self.ends is not None else []
        alone = [i for i, t in enumerate(texts) if not t.isalpha()] if words else list(range(len(texts)))
        for k in range(0, len(words), ENCODED_AT_ONCE):
            part = words[k: k + ENCODED_AT_ONCE]
            ids = self._ids([" ".join([texts[i] for i in part])])[0]
            at = np.flatnonzero(self.ends[np.array(ids, np.int64)]) + 1
            if len(at) != len(part) or at[-1] != len(ids):
                alone += part
                continue
            low = 0
            for i, high in zip(part, at.tolist(), strict=True):
                made[i] = ids[low:high]
                low = high
        for k in range(0, len(alone), ENCODED_AT_ONCE):
            part = alone[k: k + ENCODED_AT_ONCE]
            for i, ids in zip(part, self._ids([texts[i] for i in part]), strict=True):
                made[i] = ids
        return made

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def clear(self):
        self.keys, self.at, self.ids = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(start in ids, count) for distinct ascending chunk keys."""
        where = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = where < len(self.keys)
        known[inside] = self.keys[where[inside]] == keys[inside]
        fresh = np.flatnonzero(~known)
        if (len(self.keys) + len(fresh)) * 24 + self.ids.nbytes > TABLE_BYTES and len(self.keys):
            self.clear()
            return self.places(keys, data, starts, ends)
        if len(fresh):
            view = memoryview(data)
            texts = [str(view[s:e], "utf-8") for s, e in zip(starts[fresh].tolist(), ends[fresh].tolist(), strict=True)]
            made = self.encoded(texts)
            counts = np.fromiter(map(len, made), np.int64, len(made))
            first = len(self.ids) + np.concatenate([[0], np.cumsum(counts)[:-1]])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(made), np.uint32, int(counts.sum()))])
            at = np.searchsorted(self.keys, keys[fresh])
            self.keys = np.insert(self.keys, at, keys[fresh])
            self.starts, self.counts = np.insert(self.starts, at, first), np.insert(self.counts, at, counts)
            where = np.searchsorted(self.keys, keys)
        return self.starts[where], self.counts[where]


_TABLES: dict[str, ChunkTable] = {}


def chunk_spans(data, borders):
    """Starts, ends and documents of the chunks that can be tokenised on their own."""
    starts, ends, docs = A.word_spans(data, borders)
    kind = KINDS[data]
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[1:-1] = kind[1:] + kind[:-1] == 3
        cut[1:-1] &= (kind[1:] != 0) & (kind[:-1] != 0)
    cut[borders] = False
    extra = np.flatnonzero(cut)
    starts, ends = np.sort(np.concatenate([starts, extra])), np.sort(np.concatenate([ends, extra]))
    return starts, ends, np.searchsorted(borders, starts, "right") - 1


def tokenized(data, borders, table: ChunkTable, end_id: int):
    """(ids of all documents in order, each closed by ``end_id``; borders of documents in them)."""
    starts, ends, docs = chunk_spans(data, borders)
    n = len(borders) - 1
    if not len(starts):
        return np.full(n, end_id, np.uint32), np.arange(n + 1)
    keys, first, inverse = np.unique(A.Rolling(A.BYTE_VALUES[data])(starts, ends), return_index=True, return_inverse=True)
    source, count = table.places(keys, data, starts[first], ends[first])
    source, count = source[inverse], count[inverse]
    per_doc = np.bincount(docs, weights=count, minlength=n).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(per_doc + 1)])
    ids = np.full(at[-1], end_id, np.uint32)
    total = int(count.sum())
    run = np.cumsum(count) - count
    gather = np.arange(total) + np.repeat(source - run, count)
    ids[np.arange(total) + np.repeat(docs, count)] = table.ids[gather]
    return ids, at


def piece_rows(docs: DataFrame, path: str, length: int, end_id: int, n: int) -> DataFrame:
    @A.trimmed
    def task(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        table = _TABLES.get(path) or _TABLES.setdefault(path, ChunkTable(path))
        for batch in batches:
            ids, rids = A.id_values(batch.column("doc_id")), A.id_values(batch.column("rid"))
            for first, end, data, borders in A.text_slices(batch.column("text")):
                tokens, at = tokenized(data, borders, table, end_id)
                counts = np.diff(at)
                parts = -(-counts // length)
                doc = np.repeat(np.arange(end - first), parts)
                out = np.empty(len(doc), PIECE)
                out["id"] = ids[first:end][doc]
                out["piece"] = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                out["start"] = out["piece"].astype(np.int64) * length
                out["length"] = np.minimum(length, counts[doc] - out["start"])
                low = at[doc] + out["start"]
                view = memoryview(tokens.astype("<u4"))
                out["crc"] = [zlib.crc32(view[a:b]) for a, b in zip(low.tolist(), (low + out["length"]).tolist(), strict=True)]
                bucket = A.row_bucket(rids[first:end], n)[doc]
                order = np.argsort(bucket, kind="stable")
                found, at_bucket = np.unique(bucket[order], return_index=True)
                rows = [out[x].tobytes() for x in np.split(order, at_bucket[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(rows, pa.binary())], schema=PIECE_ARROW)

    return docs.select("rid", "doc_id", "text").mapInArrow(task, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, room: int) -> list[list[int]]:
    """Bins of places: longest first, each into the bin with the least room that holds it."""
    open_bins: list[list[int]] = [[] for _ in range(room + 1)]  # by room left
    mask, bins = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        above = mask >> need
        if above:
            left = need + (above & -above).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                mask &= ~(1 << left)
        else:
            b, left = len(bins), room
            bins.append([])
        bins[b].append(i)
        left -= need
        if left:
            open_bins[left].append(b)
            mask |= 1 << left
    return bins


def to_carry(fills: np.ndarray, counts: np.ndarray, room: int, carried: int) -> np.ndarray:
    """Which bins are packed again: the emptiest of those under FULL, ``carried`` pieces in all at most."""
    order = np.argsort(fills, kind="stable")
    order = order[fills[order] < FULL * room]
    again = np.zeros(len(fills), bool)
    again[order[np.cumsum(counts[order]) <= carried]] = True
    return again


def pack_level(rows: DataFrame, room: int, last: bool, level: int, carried: int) -> DataFrame:
    """Bins of each group; ``done`` where they are emitted."""
    @A.trimmed
    def group(table: pa.Table) -> pa.Table:
        g = table.column("bucket")[0].as_py()
        pieces = np.frombuffer(b"".join(table.column("pieces").to_pylist()), PIECE)
        pieces = pieces[np.lexsort((pieces["crc"], pieces["piece"], pieces["id"]))]
        bins = [pieces[b] for b in best_fit(pieces["length"].astype(np.int64), room)]
        k = len(bins)
        fills = np.fromiter((int(b["length"].sum()) for b in bins), np.int64, k)
        done = np.ones(k, bool) if last else ~to_carry(fills, np.fromiter(map(len, bins), np.int64, k), room, carried)
        numbers = (np.int64(level) << np.int64(56)) + (np.int64(g) << np.int64(26)) + np.arange(k)
        return pa.table([pa.array([g // FAN] * k, pa.int32()), pa.array(done), pa.array(numbers, pa.int64()),
                         pa.array([b.tobytes() for b in bins], pa.binary())], schema=BIN_ARROW)

    return rows.select("bucket", "pieces").groupBy("bucket").applyInArrow(group, BIN_SCHEMA)


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for documents (doc_id, text, ...)."""
    from tidemark.session import shared_dir

    docs = A.keyed(docs)
    shared_dir(docs.sparkSession)
    size = docs.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES), F.lit(0))).first()[0]
    n = max(1, -(-int(size) // GROUP_BYTES))
    rows = piece_rows(docs, tokenizer_path, length, end_id, n).checkpoint(eager=True)  # tokenised once; small beside the texts
    return _placed(pack_pieces(rows, n, length))


def pack_pieces(rows: DataFrame, groups: int, room: int, carried: int = CARRIED) -> DataFrame:
    """Bins (sequence_id, pieces) of packed pieces in ``groups`` groups; each level's bins are written once."""
    out, level = None, 0
    while True:
        last = groups <= 1
        bins = pack_level(rows, room, last, level, carried)
        if not last:
            bins = bins.checkpoint(eager=True)
        ready = bins.where("done").select("sequence_id", "pieces")
        out = ready if out is None else out.unionByName(ready)
        if last:
            return out
        rows, groups, level = bins.where("NOT done"), -(-groups // FAN), level + 1


def _placed(bins: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    @A.trimmed
    def task(batches):
        for batch in batches:
            raw = batch.column("pieces").to_pylist()
            if not raw:
                continue
            own = [np.frombuffer(x, PIECE) for x in raw]
            p = np.concatenate(own)
            sizes = np.array([len(x) for x in own])
            total = np.cumsum(p["length"].astype(np.int64)) - p["length"]
            first = np.cumsum(sizes) - sizes
            offset = total - np.repeat(total[first], sizes)
            number = np.repeat(batch.column("sequence_id").to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays(
                [A.doc_ids(p["id"]), pa.array(p["piece"]), pa.array(p["start"]), pa.array(p["length"].astype(np.int64)),
                 pa.array(p["crc"].astype(np.int64)), pa.array(number), pa.array(offset)], schema=schema)

    return bins.select("sequence_id", "pieces").mapInArrow(
        task, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def query(spark, sf_dir) -> DataFrame:
    """op9: sequences of 4096 tokens, all documents."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
