"""Prefix trie of conversations, as double arrays over shards of sorted paths.

A turn is its role and text, told apart by 128 bits of their SHA-256; a conversation is the path of its turns.

* ``paths``: a conversation's turns in order of turn (null first, then by digest), rebuilt on the conversation
  whose opening it shares.  Only digests and word counts travel, never texts.
* Equal paths become one row: how many conversations, the smallest id, and the SHA-256 of all their ids.  Ids are
  sorted by range over the whole cluster and joined to texts of at most ID_BLOCK ids, so a path held by a third
  of all conversations is text in many tasks; the one hash over it streams those blocks.
* Distinct paths are sorted by range into prefix shards of about SHARD_TURNS turns.  A path's neighbours are
  its prefixes' other members, so only nodes on the border paths of a shard can lie in several.
* In a shard, turns get dense ids and the paths are packed into one double array: the child of state s by turn t
  is state BASE[s] + t where CHECK of that state is s.  Levels of the array are traversed for all paths at once,
  and every node gets its members, smallest id, children, leaves and words.
* Border nodes carry a chained digest of their prefix.  A node counts as new, as a child and as a leaf in the
  first shard that has it (shards know how much their first path shares with the path before, and their last path
  with the path after), which makes all their figures sums; these are merged over all shards and handed back to
  the shards for the parents' ids.  Saved words are sums too: a node saves (members - 1) times its words, that
  is the words of members' paths from the node on less the words of distinct nodes.

Null role and text count as empty, repeated rows are repeated turns, rows without a conv_id belong to no
conversation, other columns are not read; an empty table has no root and gives no rows.  A conversation's digests
(20 bytes a turn) must fit one row.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turns of a shard, ids of a range and a block of ids; places tried for the children of a state.
SHARD_TURNS = 50_000
RANGE_IDS = 200_000
ID_BLOCK = 8_192
LEAST_PARTS = 8
TRIED = 4_096
DIGEST = 16
WORDS = r"[^\x20\x09-\x0D]+"

NODE_SCHEMA = ("shard int, own int, above int, key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
               "n_children long, n_leaves long, weighted long, words long, ends_sha256 string, is_new boolean")
NODE_ARROW = pa.schema([("shard", pa.int32()), ("own", pa.int32()), ("above", pa.int32()), ("key", pa.binary()), ("depth", pa.int64()),
                        *((c, pa.int64()) for c in ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "weighted", "words")),
                        ("ends_sha256", pa.string()), ("is_new", pa.bool_())])
NO_ENDS = hashlib.sha256(b"").hexdigest()


def paths(conversations: DataFrame, opening: bool = True) -> DataFrame:
    """(conv_id, path, words): turn digests joined and words per turn; ``opening`` rebuilds the conversations."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.left(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(2 * DIGEST))
    turns = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                  digest.alias("d"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("w"))
             .where(F.col("conv_id").isNotNull()).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "d", "w"))).alias("turns")))
    if opening:
        heads = turns.select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, 3).alias("head"))
        shared = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
        turns = (turns.withColumn("first_id", F.col("conv_id") - F.col("conv_id") % 20).join(heads, "first_id", "left")
                 .select("conv_id", F.concat(F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), shared),
                                             F.slice("turns", shared + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns")))
    return turns.select("conv_id", F.unhex(F.array_join("turns.d", "")).alias("path"), F.col("turns.w").alias("words"))


def members(found: DataFrame) -> DataFrame:
    """(path_key, n, conv_id, ends_sha256): of each distinct path its conversations, smallest id and hash of all ids."""
    block_schema = pa.schema([("path_key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
    out_schema = pa.schema([("path_key", pa.binary()), ("n", pa.int64()), ("conv_id", pa.int64()), ("ends_sha256", pa.string())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one path in a sorted batch, in pieces of at most ID_BLOCK ids."""
        for batch in batches:
            keys, ids = batch.column("path_key").to_pylist(), batch.column("conv_id").to_pylist()
            rows, at = [], 0
            for k in range(1, len(keys) + 1):
                if k == len(keys) or keys[k] != keys[at] or k - at == ID_BLOCK:
                    rows.append((keys[at], ids[at], k - at, ",".join(map(str, ids[at:k]))))
                    at = k
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), block_schema)], schema=block_schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks sorted by path and first id, one running hash."""
        key, n, first, sha = None, 0, 0, None
        for batch in batches:
            done = []
            for own, start, count, ids in zip(*(batch.column(c).to_pylist() for c in ("path_key", "first", "n", "ids")), strict=True):
                if own != key:
                    if key is not None:
                        done.append((key, n, first, sha.hexdigest()))
                    key, n, first, sha = own, 0, start, hashlib.sha256()
                sha.update((("," if n else "") + ids).encode())
                n += count
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out_schema)], schema=out_schema)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((key, n, first, sha.hexdigest()), out_schema)], schema=out_schema)

    partitions = max(LEAST_PARTS, -(-found.count() // RANGE_IDS))
    return (found.select("path_key", "conv_id").repartitionByRange(partitions, "path_key", "conv_id")
            .sortWithinPartitions("path_key", "conv_id")
            .mapInArrow(blocks, "path_key binary, first long, n long, ids string")
            .repartition(partitions, "path_key").sortWithinPartitions("path_key", "first")
            .mapInArrow(hashed, "path_key binary, n long, conv_id long, ends_sha256 string"))


class DoubleArray:
    """BASE and CHECK over dense turn ids; state 0 is the root.  Built level by level for all paths at once."""

    def __init__(self, alphabet: int, states: int):
        size = alphabet + states + 2
        self.alphabet = alphabet
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.check[0] = 0
        self.free = 1  # no free state lies before
        self.top = 1  # all states lie before

    def _room(self, end: int) -> None:
        if end > len(self.check):
            grown = max(end, 2 * len(self.check))
            self.base = np.concatenate([self.base, np.zeros(grown - len(self.base), np.int64)])
            self.check = np.concatenate([self.check, np.full(grown - len(self.check), -1, np.int64)])

    def add_only_children(self, parents: np.ndarray, turns: np.ndarray) -> None:
        """States with one child each: any free places will do, so they take the next ones."""
        inside = self.free + np.flatnonzero(self.check[self.free: self.top] < 0)[: len(parents)]
        places = np.concatenate([inside, self.top + np.arange(len(parents) - len(inside))])
        if len(places):
            self._room(int(places[-1]) + 1)
            self.base[parents] = places - turns
            self.check[places] = parents
            self.free = int(places[-1]) + 1
            self.top = max(self.top, self.free)

    def add_children(self, parent: int, turns: np.ndarray) -> None:
        """A state with several children (ascending turns): a base that leaves all their places free, looked for
        among the next TRIED free places and else behind all states."""
        spread, at, tried = turns - turns[0], self.free, 0
        place = self.top
        while tried < TRIED and at < self.top:
            window = at + np.flatnonzero(self.check[at: min(at + 256, self.top)] < 0)
            self._room(at + 256 + int(spread[-1]) + 1)
            fits = np.flatnonzero((self.check[window[:, None] + spread] < 0).all(axis=1))
            if len(fits):
                place = int(window[fits[0]])
                break
            at, tried = at + 256, tried + len(window)
        self._room(place + int(spread[-1]) + 1)
        self.base[parent] = place - turns[0]
        self.check[place + spread] = parent
        self.top = max(self.top, place + int(spread[-1]) + 1)

    def step(self, states: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The child of each state by its turn, -1 where there is none."""
        to = self.base[states] + turns
        inside = (to > 0) & (to < len(self.check))
        ok = np.zeros(len(to), bool)
        ok[inside] = self.check[to[inside]] == states[inside]
        return np.where(ok, to, -1)


def build(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, alphabet: int) -> tuple[DoubleArray, np.ndarray, list[np.ndarray]]:
    """The double array of paths (turn codes laid end to end), the dense id of each code and the states by depth.

    Dense ids follow the first use of a turn, level by level, so the turns of one parent lie side by side.
    """
    trie = DoubleArray(alphabet, len(codes))
    dense, used = np.full(alphabet, -1, np.int64), 0
    state = np.zeros(len(starts), np.int64)
    levels, depth = [np.zeros(1, np.int64)], 0
    while True:
        alive = np.flatnonzero(lengths > depth)
        if not len(alive):
            return trie, dense, levels
        code = codes[starts[alive] + depth]
        edges = np.unique(state[alive] * alphabet + code)
        above, code_of = np.divmod(edges, alphabet)
        unseen, first = np.unique(code_of[dense[code_of] < 0], return_index=True)
        dense[unseen[np.argsort(first)]] = used + np.arange(len(unseen))
        used += len(unseen)
        turn_of = dense[code_of]
        order = np.lexsort((turn_of, above))
        above, turn_of = above[order], turn_of[order]
        parents, first, count = np.unique(above, return_index=True, return_counts=True)
        for k in np.flatnonzero(count > 1).tolist():
            trie.add_children(int(parents[k]), turn_of[first[k]: first[k] + count[k]])
        only = first[count == 1]
        trie.add_only_children(above[only], turn_of[only])
        state[alive] = trie.step(state[alive], dense[code])
        levels.append(np.unique(state[alive]))
        depth += 1


def _prefix_keys(path: bytes, depth: int) -> list[bytes]:
    """Chained digests of the prefixes of 0 to ``depth`` turns."""
    running, keys = hashlib.sha256(), []
    for d in range(depth + 1):
        keys.append(running.digest())  # of the bytes so far; the running hash goes on
        running.update(path[d * DIGEST: (d + 1) * DIGEST])
    return keys


def shard_nodes(table: pa.Table) -> pa.Table:
    """Nodes of one shard of distinct paths; border nodes with their share of the merged figures."""
    shard = table.column("shard")[0].as_py()
    path = table.column("path").to_pylist()
    ids, n = (table.column(c).to_numpy() for c in ("conv_id", "n"))
    before, after = table.column("before")[0].as_py(), table.column("after")[0].as_py()
    lengths = np.array([len(p) // DIGEST for p in path], np.int64)
    starts = np.cumsum(lengths) - lengths
    words = np.concatenate([np.asarray(w, np.int64) for w in table.column("words").to_pylist()] or [np.zeros(0, np.int64)])
    _, codes = np.unique(np.frombuffer(b"".join(path), f"V{DIGEST}"), return_inverse=True)
    trie, dense, levels = build(codes, starts, lengths, int(codes.max()) + 1 if len(codes) else 0)
    turns = dense[codes]

    size = len(trie.check)
    own_words, ends, depth_of = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.zeros(size, np.int64)
    count, smallest, weighted = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64)
    total = np.concatenate([[0], np.cumsum(words)])
    state = np.zeros(len(path), np.int64)
    first, last = (int(np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False))[0]) for c in ("is_first", "is_last"))
    border = {first: [0], last: [0]}
    for depth in range(len(levels)):
        alive = np.flatnonzero(lengths >= depth)
        if depth:
            state[alive] = trie.step(state[alive], turns[starts[alive] + depth - 1])
            own_words[state[alive]] = words[starts[alive] + depth - 1]
            depth_of[levels[depth]] = depth
            for row, spine in border.items():
                if lengths[row] >= depth:
                    spine.append(int(state[row]))
        here = state[alive]
        np.add.at(count, here, n[alive])
        np.minimum.at(smallest, here, ids[alive])
        rest = total[starts[alive] + lengths[alive]] - total[starts[alive] + max(depth - 1, 0)]
        np.add.at(weighted, here, n[alive] * rest)
        done = alive[lengths[alive] == depth]
        ends[state[done]] = done

    # what this shard adds: nodes that the path before has are new there, and a last path that goes on is no leaf
    new = np.ones(size, bool)
    new[border[first][: before + 1]] = False
    children, leaves, fresh = np.zeros(size, np.int64), np.zeros(size, np.int64), own_words * new
    inner = np.concatenate(levels[1:]) if len(levels) > 1 else np.zeros(0, np.int64)
    np.add.at(children, trie.check[inner], new[inner].astype(np.int64))
    every = np.concatenate(levels)
    has = np.zeros(size, bool)
    has[trie.check[inner]] = True
    leaves[every] = ~has[every]
    if after == lengths[last]:
        leaves[border[last][-1]] = 0
    for level in reversed(levels[1:]):
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(fresh, trie.check[level], fresh[level])

    shared: dict[int, bytes] = {}
    for row, limit in ((first, before), (last, after)):
        shared.update(zip(border[row][: limit + 1], _prefix_keys(path[row], limit), strict=True))
    number = np.full(size, -1, np.int64)
    number[list(shared)] = np.arange(len(shared))
    is_shared = number[every] >= 0
    keys = [shared.get(x) for x in every.tolist()]
    above = np.where(every > 0, number[trie.check[every]], -1)
    parent = smallest[trie.check[every]]
    mask = lambda values, gone: pa.array(values, mask=gone)
    hashes = table.column("ends_sha256").to_pylist()
    columns = [
        pa.array(np.full(len(every), shard, np.int32)), mask(number[every].astype(np.int32), ~is_shared),
        mask(above.astype(np.int32), above < 0), pa.array(keys, pa.binary()), pa.array(depth_of[every]), pa.array(smallest[every]),
        mask(parent, (every == 0) | (above >= 0)), pa.array(count[every]), pa.array(children[every]), pa.array(leaves[every]),
        pa.array(weighted[every]), pa.array(fresh[every]),
        pa.array([hashes[e] if e >= 0 else None for e in ends[every].tolist()], pa.string()), pa.array(new[every])]
    return pa.table(columns, schema=NODE_ARROW)


def _borders(shards: DataFrame) -> DataFrame:
    """(shard, before, after): turns that the first path shares with the path before it, and the last with the next; -1: none."""
    schema = pa.schema([("shard", pa.int32()), ("before", pa.int32()), ("after", pa.int32())])

    def shared(a: bytes | None, b: bytes | None) -> int:
        if a is None or b is None:
            return -1
        n = min(len(a), len(b)) // DIGEST
        x, y = (np.frombuffer(v, np.uint64, 2 * n).reshape(n, 2) for v in (a, b))
        differ = np.flatnonzero((x != y).any(axis=1))
        return int(differ[0]) if len(differ) else n

    def task(batches):
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("shard", "first", "last", "last_before", "first_after")), strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int32()), pa.array([shared(r[1], r[3]) for r in rows], pa.int32()),
                pa.array([shared(r[2], r[4]) for r in rows], pa.int32())], schema=schema)

    order = Window.orderBy("shard")  # one small number per shard; the paths follow by joins
    chain = shards.select("shard", F.lag("shard").over(order).alias("back"), F.lead("shard").over(order).alias("on"))
    return (shards.join(chain, "shard")
            .join(shards.select(F.col("shard").alias("back"), F.col("last").alias("last_before")), "back", "left")
            .join(shards.select(F.col("shard").alias("on"), F.col("first").alias("first_after")), "on", "left")
            .select("shard", "first", "last", "last_before", "first_after").mapInArrow(task, "shard int, before int, after int"))


def trie_nodes(found: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of all nodes of
    conversations (conv_id, path, words)."""
    from tidemark.session import shared_dir

    spark = found.sparkSession
    folder = f"{shared_dir(spark)}/prefixtrie-{uuid.uuid4().hex}"

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    found = written(found.withColumn("path_key", F.unhex(F.sha2("path", 256))), "paths")
    distinct = found.groupBy("path_key").agg(F.any_value("path").alias("path"), F.any_value("words").alias("words"))
    distinct = written(distinct.join(members(found), "path_key").drop("path_key"), "distinct")
    turns = distinct.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    shards = max(LEAST_PARTS, -(-int(turns) // shard_turns))
    sorted_paths = written(distinct.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id()), "shards")
    ends = written(sorted_paths.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")), "ends")
    borders = ends.join(_borders(ends), "shard")
    nodes = written(sorted_paths.join(borders, "shard").select(
        "shard", "path", "words", "n", "conv_id", "ends_sha256", "before", "after",
        (F.col("path") == F.col("first")).alias("is_first"), (F.col("path") == F.col("last")).alias("is_last"))
        .groupBy("shard").applyInArrow(shard_nodes, NODE_SCHEMA), "nodes")

    shared = nodes.where(F.col("key").isNotNull())
    merged = shared.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "weighted", "words")),
        F.max("ends_sha256").alias("ends_sha256"))
    values = shared.select("shard", "own", "above", "key", "depth", "is_new").join(merged, "key")
    parents = written(values.select("shard", F.col("own").alias("above"), F.col("conv_id").alias("above_id")), "parents")
    inner = nodes.where(F.col("key").isNull())
    out = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "weighted", "words", "ends_sha256")
    under = (inner.where(F.col("above").isNotNull()).unionByName(values.where("is_new"), allowMissingColumns=True)
             .drop("parent_conv_id").join(parents, ["shard", "above"], "left").withColumn("parent_conv_id", F.col("above_id")))
    every = inner.where(F.col("above").isNull()).select(*out).unionByName(under.select(*out))
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        (F.col("weighted") - F.col("words")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def query(spark, sf_dir) -> DataFrame:
    """op12: the trie of all conversations, rebuilt on the openings they share."""
    return trie_nodes(paths(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS text, left(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS first_id,
  xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT), lambda a, b:
    list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)), xor(a, b)), 4294967295::UBIGINT), 4294967295::UBIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
r AS (SELECT c.conv_id, 0 AS part, o.pos, o.k, o.w FROM c JOIN o ON o.conv_id = c.first_id AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, o.pos, o.k, o.w FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
f AS (SELECT c.conv_id, coalesce(list(r.k ORDER BY part, pos) FILTER (r.k IS NOT NULL), []) AS path, coalesce(list(r.w ORDER BY part, pos) FILTER (r.k IS NOT NULL), []) AS words
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
m AS (SELECT conv_id, len(path) AS size, d, path[1:d] AS node, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS w FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM f)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends FROM m GROUP BY node, d),
kids AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
x AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM n LEFT JOIN kids ON kids.node = n.node AND kids.d = n.d),
s AS (SELECT node[1:a] AS node, a AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM x) GROUP BY ALL)
SELECT x.conv_id, x.d::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, x.ends AS ends_sha256
FROM x JOIN s ON s.node = x.node AND s.d = x.d LEFT JOIN n p ON x.d > 0 AND p.d = x.d - 1 AND p.node = x.node[1:x.d - 1]
"""
