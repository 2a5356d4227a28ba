"""Cost-balanced packing: sequences that are full and cost about the same to attend over.

A piece of n tokens costs ``linear * n + quadratic * n * n``: projections grow with its tokens, attention
inside it with their square.  A group of tokens T opens T // length sequences.  Documents longer than a
sequence are cut in equal parts; then pieces go, longest first, to the sequence that has cost the least so
far among those with room for the whole piece.  A piece that no sequence holds whole is cut at the room of
the cheapest open one, and the rest of it goes on, so every opened sequence ends full.

What is left of a group, under one sequence of tokens, moves on as pieces with their ids to a second round
over all groups.  There the last tokens of a bucket fill sequences of falling powers of two, which need no
padding either.  Groups are runs of rows inside an input split, bounded by tokens, so the texts are read once
and never shuffled; only leftovers are (under ``length`` ids a group).

Tokenising.  The ids are those of the tokenizer file; they are made from the same vocabulary's merge ranks, which
takes a fifth of the time (tests hold them against the tokenizer itself).

Null and empty texts are the end id alone; every row is a document of its own (repeated and null ids too);
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens a group holds at least before it is packed (4 bytes each in memory).
GROUP_TOKENS = 4 << 20
SLICE_ROWS = 256

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
                "sequence_cost double")
LEVEL_SCHEMA = f"{PIECE_SCHEMA}, ids binary"
_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_cost", pa.float64())]
PIECE_ARROW = pa.schema(_FIELDS)
LEVEL_ARROW = pa.schema([*_FIELDS, ("ids", pa.binary())])

Piece = tuple[int, int, int]  # document of the group, start, length


class Vocabulary:
    """A tokenizer file by its merge ranks; its added tokens are found in texts too."""

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str):
        import json

        import tiktoken

        with open(tokenizer_path, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.path = tokenizer_path
        self.by_rank = tiktoken.Encoding(ranks_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def token_bytes(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if not text:
            return b""
        try:
            ids = self.by_rank.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # millions of blanks in a row are too deep for its pattern matcher
            from tokenizers import Tokenizer

            ids = np.array(Tokenizer.from_file(self.path).encode(text, add_special_tokens=False).ids, np.uint32)
        return ids.astype("<u4", copy=False).tobytes()


#: Vocabularies of a worker, of fixed size, by the files they come from.
_VOCABULARIES: dict[tuple[str, str], Vocabulary] = {}


def even_parts(lengths: list[int], room: int) -> list[Piece]:
    """Pieces of all documents, those longer than ``room`` in equal parts, longest first."""
    out = []
    for doc, n in enumerate(lengths):
        k = -(-n // room)
        at = [n * i // k for i in range(k + 1)] if k else [0]
        out += [(doc, a, b - a) for a, b in zip(at, at[1:])]
    out.sort(key=lambda p: (-p[2], p[0], p[1]))
    return out


def assign(pieces: list[Piece], room: int, cost: Callable[[int], float]) -> tuple[list[list[Piece]], list[float], list[Piece]]:
    """(full sequences, their costs, leftover pieces): see the module's docstring.

    Open sequences wait in one heap per room left; ``least`` has the lowest cost of each, so the cheapest
    sequence with room for n is the smallest of ``least[n:]``.
    """
    m = sum(p[2] for p in pieces) // room
    sequences: list[list[Piece]] = [[] for _ in range(m)]
    costs = [0.0] * m
    waiting: list[list[tuple[float, int]]] = [[] for _ in range(room + 1)]
    least = np.full(room + 1, np.inf)
    if m:
        waiting[room], least[room] = [(0.0, b) for b in range(m)], 0.0
    rest = []
    for doc, start, n in pieces:
        while n:
            left = n + int(least[n:].argmin())
            if least[left] == np.inf:
                left = 1 + int(least[1:].argmin())
                if least[left] == np.inf:
                    rest.append((doc, start, n))
                    break
            spent, b = heappop(waiting[left])
            least[left] = waiting[left][0][0] if waiting[left] else np.inf
            take = min(n, left)
            sequences[b].append((doc, start, take))
            costs[b] = spent = spent + cost(take)
            if left > take:
                heappush(waiting[left - take], (spent, b))
                least[left - take] = waiting[left - take][0][0]
            start, n = start + take, n - take
    return sequences, costs, rest


def powers_of_two(pieces: list[Piece], cost: Callable[[int], float]) -> tuple[list[list[Piece]], list[float]]:
    """Pieces cut to sequences whose tokens are falling powers of two, without a gap."""
    total = sum(p[2] for p in pieces)
    sequences, costs, open_pieces = [], [], list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        room, own = total & (1 << bit), []
        while room:
            doc, start, n = open_pieces.pop()
            take = min(n, room)
            own.append((doc, start, take))
            room -= take
            if take < n:
                open_pieces.append((doc, start + take, n - take))
        if own:
            sequences.append(own)
            costs.append(sum(cost(p[2]) for p in own))
    return sequences, costs


class _Rows:
    """Columns of piece rows; a group's documents are (doc_id, first start, tokens of the document, ids)."""

    def __init__(self):
        self.columns: list[list] = [[] for _ in _FIELDS] + [[]]

    def add(self, docs, piece: Piece, sequence=None, offset=None, cost=None, keep=False) -> None:
        doc_id, first, tokens, ids = docs[piece[0]]
        own = ids[4 * piece[1]: 4 * (piece[1] + piece[2])]
        row = (doc_id, first + piece[1], piece[2], zlib.crc32(own), tokens, sequence, offset, cost, own if keep else None)
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)

    def add_sequences(self, docs, sequences, costs, number: int) -> int:
        for own, cost in zip(sequences, costs, strict=True):
            offset = 0
            for piece in own:
                self.add(docs, piece, number, offset, cost)
                offset += piece[2]
            number += 1
        return number

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, schema)], schema=schema)


def pack_balanced(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, length: int = 2048, end_id: int = 1,
                  linear: float = 1.0, quadratic: float = 1 / 6144, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_cost) of documents (doc_id, text, ...).

    ``ranks_path`` and ``pattern`` are the vocabulary of ``tokenizer_path`` as merge ranks and its word pattern.
    ``quadratic`` weighs attention against the rest of a layer: about 1 / (6 * width) of the model per token.
    ``length`` must be a power of two, so that the last sequences need no padding.
    """
    from tidemark.session import shared_dir

    if length < 1 or length & (length - 1):
        raise ValueError("the length of a sequence must be a power of two")
    spark = docs.sparkSession

    def cost(n: int) -> float:
        return linear * n + quadratic * n * n

    def group_rows(group: list[tuple], number: int) -> tuple[pa.RecordBatch, int]:
        rows = _Rows()
        sequences, costs, rest = assign(even_parts([len(g[3]) // 4 for g in group], length), length, cost)
        number = rows.add_sequences(group, sequences, costs, number)
        for piece in rest:
            rows.add(group, piece, keep=True)
        return rows.batch(LEVEL_ARROW), number

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = tokenizer_path, ranks_path
        vocabulary = _VOCABULARIES.get(files) or _VOCABULARIES.setdefault(files, Vocabulary(*files, pattern))
        end = np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 32
        group, held = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    own = vocabulary.token_bytes(text) + end
                    group.append((doc_id, 0, len(own) // 4, own))
                    held += len(own) // 4
                    if held >= group_tokens:
                        out, number = group_rows(group, number)
                        yield out
                        group, held = [], 0
        if group:
            yield group_rows(group, number)[0]

    path = f"{shared_dir(spark)}/balanced-{uuid.uuid4().hex}"
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
         .mapInArrow(first_round, LEVEL_SCHEMA).write.parquet(path))
    packed = spark.read.schema(LEVEL_SCHEMA).parquet(path)
    left = packed.where(F.col("ids").isNotNull())
    buckets = -(-int(left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]) // group_tokens) or 1

    def second_round(table: pa.Table) -> pa.Table:
        order = [("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        t = table.sort_by(order)
        group = list(zip(*(t.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True))
        sequences, costs, rest = assign(even_parts([len(g[3]) // 4 for g in group], length), length, cost)
        short, short_costs = powers_of_two(rest, cost)
        rows = _Rows()
        rows.add_sequences(group, sequences + short, costs + short_costs, -((t.column("bucket")[0].as_py() + 1) << 32))
        return pa.Table.from_batches([rows.batch(PIECE_ARROW)])

    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int")
    last = (left.select("doc_id", "start", "ids_crc32", "doc_tokens", "ids", bucket.alias("bucket"))
                .groupBy("bucket").applyInArrow(second_round, PIECE_SCHEMA))
    return packed.where(F.col("ids").isNull()).drop("ids").unionByName(last)


def query(spark, sf_dir) -> DataFrame:
    """op11: sequences of 2048 tokens of about equal cost, all documents."""
    import public_tokenizers as P

    return pack_balanced(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_50k.json"),
                         P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
