"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that name them).  A flow
network routes words from patterns to source quotas: a pattern offers its words once at a
low price and each further time at a higher one (convex), so nothing is repeated while
words are left that were not taken.  The network has a node per pattern and per source and is
solved on the driver: what reaches it are sums per pattern, ``max_patterns`` at most (more is
an error, as the pattern table would no longer be small).  Then each pattern takes its
words from its documents in a seeded order: whole rounds first, the rest as a prefix of the order
(cut by sums over hash ranges, so no pattern is sorted in one task), then as prefixes of the
documents that still fit, until none does.  Documents are taken whole.

Null texts have size 0; a null source is a source of its own, last in order; every row is a
document of its own (repeated rows are taken each).  Empty tables give no rows; other columns are
not read.  Reruns over the same rows agree: the order is a hash of id, text size and seed.
"""

from __future__ import annotations

from collections import deque
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import arrays as A

WORD = r"[^\x20\x09-\x0D]+"
RANGES = 1 << 14


def word_count(text="text"):
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def quotas(sizes: dict, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict:
    """Target words per source: the share of all words by weight, no source above ``most`` times its
    own words, what is over reshared by weight until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left, over = total - sum(fixed.values()), sum(weight[s] for s in free)
        goal = {s: left * weight[s] / over for s in free}
        above = [s for s in free if goal[s] > most * sizes[s]]
        if not above:
            return {**{s: float(t) for s, t in fixed.items()}, **goal}
        fixed.update({s: float(most * sizes[s]) for s in above})


def min_cost_flow(patterns: dict, goals: dict, copies: int) -> dict:
    """{(pattern, source): words}.  Patterns are tuples of sources with their words; copy c of a
    pattern's words costs 2 * c - 1 a word.  Successive cheapest paths; capacities are whole words."""
    nodes, arcs, out = {"from": 0, "to": 1}, [], [[], []]

    def node(x):
        if x not in nodes:
            nodes[x] = len(nodes)
            out.append([])
        return nodes[x]

    def arc(a, b, room, price):
        out[a].append(len(arcs))
        arcs.append([b, room, price])
        out[b].append(len(arcs))
        arcs.append([a, 0, -price])

    for p, size in patterns.items():
        for c in range(1, copies + 1):
            arc(0, node(("pattern", p)), size, 2 * c - 1)
    routes = {}
    for p in patterns:
        for s in p:
            routes[(p, s)] = len(arcs)
            arc(node(("pattern", p)), node(("source", s)), 1 << 62, 0)
    for s, goal in goals.items():
        arc(node(("source", s)), 1, int(goal), 0)
    while True:
        cost, via, waiting, queued = {0: 0}, {}, deque([0]), {0}
        while waiting:
            a = waiting.popleft()
            queued.discard(a)
            for i in out[a]:
                b, room, price = arcs[i]
                if room > 0 and cost[a] + price < cost.get(b, 1 << 60):
                    cost[b], via[b] = cost[a] + price, (a, i)
                    if b not in queued:
                        queued.add(b)
                        waiting.append(b)
        if 1 not in via:
            return {key: arcs[i ^ 1][1] for key, i in routes.items()}
        path, b = [], 1
        while b:
            a, i = via[b]
            path.append(i)
            b = a
        amount = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= amount
            arcs[i ^ 1][1] += amount


def mix(docs: DataFrame, members, size, copies: int = 2, weights=(5, 2, 1), share: float = 1.5, seed: int = 17,
        max_patterns: int = 100_000, keep: tuple[str, ...] = (), rid: str | None = None) -> tuple[DataFrame, dict, dict, dict]:
    """Taken words per document.

    ``members``: column with the array of a document's sources; ``size``: column with its words;
    ``rid``: column that numbers the rows, if they have one (``arrays.numbered``).
    Gives (rows with rid, doc_id, members, size, taken and the ``keep`` columns; words per
    source; targets; flows by pattern and source).
    """
    from tidemark.session import shared_dir

    shared_dir(docs.sparkSession)
    rows = docs.select((F.monotonically_increasing_id() if rid is None else F.col(rid)).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.array_sort(F.array_distinct(members)).alias("members"), size.alias("size"), *keep)
    rows = rows.withColumn("turn", F.xxhash64(F.lit(seed), "doc_id", "size", "rid")).checkpoint(eager=True)
    groups = rows.groupBy("members").agg(F.sum("size").alias("size")).limit(max_patterns + 1).collect()
    if len(groups) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = {tuple(g["members"]): int(g["size"]) for g in groups}
    sizes: dict = {}
    for p, words in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + words
    targets = quotas(sizes, weights, share, float(copies)) if sizes else {}
    flows = min_cost_flow(patterns, targets, copies) if sizes else {}
    spark = docs.sparkSession
    plan = []
    for p, words in patterns.items():
        flow = sum(flows[(p, s)] for s in p)
        rounds = flow // words if words else 0
        plan.append((list(p), rounds, flow - rounds * words))
    # Patterns are joined as arrays (null members are equal in them): with to_json(transform(members)) as the key
    # a row now and then missed its match (most likely its evaluator is shared by concurrent broadcast builds)
    plan = spark.createDataFrame(plan, "members array<string>, rounds long, rest long")
    rows = rows.join(F.broadcast(plan), "members", "left")  # here and below max_patterns rows at most
    rows = rows.join(_chosen(rows.select("rid", "members", "size", "turn", F.col("rest").alias("room"))), "rid", "left")
    taken = F.col("size") * (F.col("rounds") + F.col("chosen").isNotNull().cast("long"))
    return rows.select("rid", "doc_id", "members", "size", taken.alias("taken"), *keep), sizes, targets, flows


def _chosen(rows: DataFrame) -> DataFrame:
    """(rid, chosen) of documents (rid, members, size, turn, room) taken into each pattern's room.

    Each round takes the longest prefix of the open documents that fit one by one; what is then larger
    than the room left is closed, the document after the prefix with it.  Ends when nothing is open.
    """
    taken = []
    rows = rows.where((F.col("size") > 0) & (F.col("size") <= F.col("room")))
    while True:
        rows = _prefix(rows).checkpoint(eager=True)
        taken.append(rows.where("fits").select("rid", F.lit(True).alias("chosen")))
        if taken[-1].isEmpty():
            return reduce(DataFrame.unionByName, taken)
        got = rows.groupBy("members").agg(F.coalesce(F.sum(F.when(F.col("fits"), F.col("size"))), F.lit(0)).alias("got"))
        rows = rows.where(~F.col("fits")).join(F.broadcast(got), "members")
        rows = rows.select("rid", "members", "size", "turn", (F.col("room") - F.col("got")).alias("room"))
        rows = rows.where(F.col("size") <= F.col("room"))


def _prefix(rows: DataFrame) -> DataFrame:
    """The rows with ``fits``: whether the sum of sizes up to them, in order of turn, is within the room."""
    turn = F.shiftrightunsigned("turn", 64 - RANGES.bit_length() + 1)
    spans = rows.groupBy("members", "room", turn.alias("span")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("members").orderBy("span"))
    cuts = (spans.withColumn("upto", upto).where(F.col("upto") > F.col("room")).groupBy("members")
            .agg(F.min(F.struct("span", (F.col("upto") - F.col("words")).alias("before"))).alias("cut")))
    cuts = cuts.select("members", F.col("cut.span").alias("cut"), F.col("cut.before").alias("before"))
    rows = rows.join(F.broadcast(cuts), "members", "left")
    edge = rows.where(turn == F.col("cut"))
    inside = F.sum("size").over(Window.partitionBy("members").orderBy("turn", "rid"))
    edge = edge.select(F.col("rid").alias("_rid"), (F.col("before") + inside <= F.col("room")).alias("inner"))
    rows = rows.join(edge, F.col("rid") == F.col("_rid"), "left")
    fits = F.coalesce(F.col("inner"), turn < F.col("cut"), F.lit(True))
    return rows.select("rid", "members", "size", "turn", "room", fits.alias("fits"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents, all columns, as often as the mix takes them (op4's parameters)."""
    own = A.numbered(docs, tuple(docs.columns))
    rows, *_ = mix(own, F.array(F.col("source").cast("string")), word_count(), rid=A.RID)
    copies = rows.where("taken > 0").select(F.col("rid").alias(A.RID), (F.col("taken") / F.col("size")).cast("int").alias("_copies"))
    return own.join(copies, A.RID).withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


def query(spark, sf_dir) -> DataFrame:
    """op4: all documents; a document's source is its one membership."""
    docs = A.numbered(spark.read.parquet(f"{sf_dir}/documents.parquet"), ("doc_id", "text", "source"))
    rows, sizes, targets, _ = mix(docs, F.array(F.col("source").cast("string")), word_count(), rid=A.RID)
    known = spark.createDataFrame([(s, sizes[s], targets[s]) for s in sizes] or [(None, 0, 0.0)],
                                  "name string, source_size long, target double")
    rows = rows.join(known, F.col("members")[0].eqNullSafe(F.col("name")), "left")
    return rows.select("doc_id", "size", "source_size", "target", "taken")
