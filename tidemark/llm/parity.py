"""N-gram Jaccard join over parity sketches, and the components of its links.

A document is its set of distinct 5-word shingles.  Sets of n and n' shingles with Jaccard 0.75 or
more differ in at most (n + n') / 7 shingles, which is n / 3 at most for either side.

1. Classes.  Documents with equal sets (128-bit digest and size) are one class; its smallest row
   stands for it from here on.
2. Parity sketches.  A set is hashed into P words; each shingle is XORed into the word of its
   part.  Every differing shingle can spoil one word only, so the number of differing words
   (the Hamming distance by words) is a lower bound of the symmetric difference.  P depends on the
   size band (x4 wide); a set just above a band's top is sketched in that band too, so any
   pair within the length ratio meets in a band.  Sets of up to SMALL shingles keep a
   word per shingle.
3. Pigeonhole.  Of a set's m filled words at most n // 3 are spoilt, so among its n // 3 + 1
   first words in any common order one is shared with each partner.  The order is by how many
   sets hold a word, rarest first (counted over all of them, in buckets), so words held by
   no other set fill these places first, and passages that many documents share come last.  Only
   sets with shared words among their first n // 3 + 1 go on, as (word, row).
4. Verify.  First each word's likeliest original (fewest words of its own) is compared with the
   word's other sets, exactly, and links are closed to components; copies of one text end in one
   component here.  Then sets of a word that are still in different components are compared:
   by rank (what comes before a first shared word differs), by Hamming distance of bit
   sketches, and those left exactly.  Pairs inside a component are never listed.

Sets travel to the bucket of their partner; counts, words and links move through Spark's
shuffle.  Nothing of all documents is broadcast or collected.

Null and empty texts have no shingles and no links; fewer words than five are one shingle.  Every
row is a document of its own (repeated rows are copies; a null id is no candidate for the
smallest id).  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays as A

SMALL = 256
BAND = 4
WORD = np.dtype([("high", "<u4"), ("low", "u1")])
FOUND = np.dtype([("word", "<u8"), ("unique", "<u4"), ("n", "<u4")])
SET_SCHEMA = "rid long, doc_id long, n long, d1 long, d2 long"
HOLDS_SCHEMA = "bucket int, word long, rid long, rank long, n long, parts boolean, unique long, items binary"
BITS = 1024
#: Rows of a word that one task compares with each other or with as many others.
BLOCK = 2048


def shingle_sets(data, borders, words: int):
    """(distinct shingle hashes sorted by document and value, their documents, sizes)."""
    starts, ends, docs = A.word_spans(data, borders)
    n = len(borders) - 1
    counts, first = A.word_counts(docs, n)
    hashes = A.Rolling(A.LOWER_VALUES[data])(starts, ends)
    place = np.arange(len(starts)) - first[docs]
    at = np.flatnonzero(place + words <= counts[docs])
    short = np.flatnonzero((counts > 0) & (counts < words))
    roll = A.Rolling(hashes, A.WORD_BASE)
    value = np.concatenate([roll(at, at + words), roll(first[short], first[short] + counts[short])])
    doc = np.concatenate([docs[at], short])
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    once = ~A.same_as_before(doc, value)
    value, doc = value[once], doc[once]
    return value, doc, np.bincount(doc, minlength=n)


def digests(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: size and digest of its set."""
    schema = pa.schema([(c, pa.int64()) for c in ("rid", "doc_id", "n", "d1", "d2")])

    @A.trimmed
    def task(batches):
        for batch in batches:
            for first, end, data, borders in A.text_slices(batch.column("text")):
                value, doc, n = shingle_sets(data, borders, words)
                sums = np.zeros((2, end - first), np.uint64)
                if len(value):
                    starts = np.flatnonzero(~A.same_as_before(doc))
                    sums[0, doc[starts]] = np.bitwise_xor.reduceat(value, starts)
                    sums[1, doc[starts]] = np.add.reduceat(A.mix(value + A.CHECK_BASE), starts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rid").slice(first, end - first), batch.column("doc_id").slice(first, end - first),
                     pa.array(n), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64))], schema=schema)

    return docs.select("rid", "doc_id", "text").mapInArrow(task, SET_SCHEMA)


def sketch_words(value, doc, sizes, buckets: int):
    """(word keys, documents, bands) of the parity sketches, by document and band.  Keys have 40
    bits beside those that tell their bucket."""
    keys, owners = [], []
    n = sizes[doc]
    top, level, low, most = SMALL, 0, 0, int(sizes.max()) if len(sizes) else 0
    while low < most:
        own = (n > low) & (3 * n <= 4 * top)
        if own.any():
            v, d = value[own], doc[own]
            if level:
                parts = A.U(3 * top // 4)
                part = ((v >> A.U(32)) * parts) >> A.U(32)
                starts = np.flatnonzero(~A.same_as_before(d, part))
                v = A.mix(np.bitwise_xor.reduceat(A.mix(v), starts) ^ (part[starts] * A.WORD_BASE))
                d = d[starts]
            keys.append(A.mix(v + A.U(level + 1)) >> A.U(25 - buckets.bit_length()))
            owners.append((d, np.full(len(d), level)))
        top, level, low = top * BAND, level + 1, top
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    level_of = np.concatenate([x for _, x in owners])
    key, owner = np.concatenate(keys), np.concatenate([x for x, _ in owners])
    order = np.lexsort((level_of, owner))
    return key[order], owner[order], level_of[order]


def _representatives(left: pa.Table, right: pa.Table):
    """Texts of a bucket's representatives: (rids, bytes, borders)."""
    rids, _, data, borders = A.unpack_texts(left)
    wanted, _, _ = A.unpack(A.of_kind(right, 9), np.int64, np.uint8)
    at = np.flatnonzero(np.isin(rids, wanted))
    view = memoryview(data)
    raw = b"".join(view[borders[k]: borders[k + 1]] for k in at.tolist())
    return rids[at], np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(borders[at + 1] - borders[at])])


def _short(key, n):
    """A word's bucket, and the 40 further bits that tell it there."""
    rest = key // A.U(n)
    out = np.empty(len(key), WORD)
    out["high"], out["low"] = (rest >> A.U(8)).astype(np.uint32), (rest & A.U(255)).astype(np.uint8)
    return key % A.U(n), out


def _long(word):
    return (word["high"].astype(np.uint64) << A.U(8)) | word["low"]


def count_words(texts: DataFrame, chosen: DataFrame, words: int, n: int) -> DataFrame:
    """Each bucket's distinct words with the number of its sets that hold them, by word."""
    @A.trimmed
    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return A.tables([], A.BLOB_ARROW)
        _, data, borders = _representatives(left, right)
        key, _, _ = sketch_words(*shingle_sets(data, borders, words), n)
        key, count = np.unique(key, return_counts=True)
        bucket, word = _short(key, n)
        home = np.full(len(key), left.column("bucket")[0].as_py(), np.int64)
        return A.tables(list(A.pack(0, bucket, home, word, np.minimum(count, 255).astype(np.uint8))), A.BLOB_ARROW)

    return texts.groupBy("bucket").cogroup(chosen.groupBy("bucket")).applyInArrow(rows, A.BLOB_SCHEMA)


def shared_words(counts: DataFrame, n: int) -> DataFrame:
    """Words that two sets or more hold, with their number, back to the buckets that asked."""
    @A.trimmed
    def bucket(table: pa.Table) -> pa.Table:
        home, word, count = A.unpack(table, np.int64, WORD, np.uint8)
        value = _long(word)
        order = np.argsort(value, kind="stable")
        starts = np.flatnonzero(~A.same_as_before(value[order]))
        total = np.add.reduceat(count[order].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
        total = np.repeat(total, np.diff(np.append(starts, len(order)))).astype(np.uint32)
        many = total > 1
        at = order[many]
        key = value[at] * A.U(n) + A.U(table.column("bucket")[0].as_py())
        back = np.argsort(home[at], kind="stable")
        return A.tables(list(A.pack(1, home[at][back], home[at][back], key[back], total[many][back])), A.BLOB_ARROW)

    return counts.groupBy("bucket").applyInArrow(bucket, A.BLOB_SCHEMA)


def first_words(texts: DataFrame, answers: DataFrame, words: int, n: int) -> DataFrame:
    """Shared words among the n // 3 + 1 first of each set's sketch, with their rank in it; and for
    sets that have any, a row with the set (``items``) and no word."""
    schema = pa.schema([("bucket", pa.int32()), ("word", pa.int64()), ("rid", pa.int64()), ("rank", pa.int64()), ("n", pa.int64()),
                        ("parts", pa.bool_()), ("unique", pa.int64()), ("items", pa.binary())])

    @A.trimmed
    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.Table.from_batches([], schema=schema)
        if not left.num_rows or not right.num_rows:
            return empty
        rids, data, borders = _representatives(left, right)
        value, doc, sizes = shingle_sets(data, borders, words)
        key, owner, level = sketch_words(value, doc, sizes, n)
        _, known, total = A.unpack(A.of_kind(right, 1), np.int64, np.uint64, np.uint32)
        if not len(key) or not len(known):
            return empty
        order = np.argsort(known)
        known, total = known[order], total[order]
        near = np.minimum(np.searchsorted(known, key), len(known) - 1)
        held = np.where(known[near] == key, total[near], 1)
        order = np.lexsort((key, held, level, owner))
        key, owner, level, held = key[order], owner[order], level[order], held[order]
        starts = np.flatnonzero(~A.same_as_before(owner, level))
        sizes_of = np.diff(np.append(starts, len(key)))
        if (sizes_of <= sizes[owner[starts]] // 3).any():
            raise ValueError("a sketch has too few filled words for its size band")
        rank = np.arange(len(key)) - np.repeat(starts, sizes_of)
        unique = np.repeat(np.add.reduceat((held == 1).astype(np.int64), starts), sizes_of)
        keep = (rank <= sizes[owner] // 3) & (held > 1)
        own = np.unique(owner[keep])
        ends = np.cumsum(sizes)
        items = [value[ends[k] - sizes[k]: ends[k]].tobytes() for k in own.tolist()]
        home, k, m = left.column("bucket")[0].as_py(), int(keep.sum()), len(own)
        held_rows = pa.table([pa.array([home] * k, pa.int32()), pa.array(key[keep].view(np.int64)), pa.array(rids[owner[keep]]),
                              pa.array(rank[keep]), pa.array(sizes[owner[keep]]), pa.array(level[keep] > 0), pa.array(unique[keep]),
                              pa.nulls(k, pa.binary())], schema=schema)
        set_rows = pa.table([pa.array([home] * m, pa.int32()), pa.nulls(m, pa.int64()), pa.array(rids[own]), pa.nulls(m, pa.int64()),
                             pa.array(sizes[own]), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()), pa.array(items, pa.binary())], schema=schema)
        return pa.concat_tables([held_rows, set_rows])

    return texts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(rows, HOLDS_SCHEMA)


def _split(table: pa.Table):
    """{rid: its sorted set}."""
    return {k: np.frombuffer(x, np.uint64) for k, x in zip(table.column("rid").to_pylist(), table.column("items").to_pylist(), strict=True)}


def verified(sets: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    ask = pairs.groupBy(F.col("a_bucket").alias("bucket"), "a", "b_bucket").agg(F.collect_list("b").alias("b"))
    sent = pa.schema([("bucket", pa.int32()), ("a", pa.int64()), ("b", pa.list_(pa.int64())), ("items", pa.binary())])

    @A.trimmed
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], schema=sent)
        own = _split(left)
        a = right.column("a").to_pylist()
        items = [own[x].tobytes() for x in a]
        return pa.table([right.column("b_bucket").cast(pa.int32()), pa.array(a, pa.int64()),
                         pa.array(right.column("b").to_pylist(), pa.list_(pa.int64())), pa.array(items, pa.binary())], schema=sent)

    @A.trimmed
    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        if left.num_rows and right.num_rows:
            own = _split(left)
            for a, bs, items in zip(right.column("a").to_pylist(), right.column("b").to_pylist(),
                                    right.column("items").to_pylist(), strict=True):
                x = np.frombuffer(items, np.uint64)
                for b in bs:
                    y = own[b]
                    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                    both = int((x[at] == y).sum())
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        out_a.append(a)
                        out_b.append(b)
        return pa.table([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    carried = sets.groupBy("bucket").cogroup(ask.groupBy("bucket")).applyInArrow(
        send, "bucket int, a long, b array<long>, items binary")
    return sets.groupBy("bucket").cogroup(carried.groupBy("bucket")).applyInArrow(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, label): smallest vertex reachable, by taking the least label around and following labels
    of labels; each round is written to the checkpoint folder."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a")).distinct().checkpoint()
    labels = both.groupBy("v").agg(F.least("v", F.min("w")).alias("label")).checkpoint()
    while True:
        near = both.join(labels.withColumnsRenamed({"v": "w"}), "w").groupBy("v").agg(F.min("label").alias("near"))
        step = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("to"))
        after = labels.select(F.col("v").alias("to"), F.col("label").alias("far"))
        step = step.join(after, "to").select("v", "label", F.least("to", "far").alias("to")).checkpoint()
        changed = step.where(F.col("to") < F.col("label")).limit(1).count()
        labels = step.select("v", F.col("to").alias("label"))
        if not changed:
            return labels


def _asked(rids: DataFrame, n: int) -> DataFrame:
    """Kind 9 rows: rids packed for their bucket of rows."""
    @A.trimmed
    def task(batches):
        for batch in batches:
            own = batch.column("rid").to_numpy()
            yield from A.pack(9, A.row_bucket(own, n), own, np.zeros(len(own), np.uint8))

    return rids.select("rid").mapInArrow(task, A.BLOB_SCHEMA)


def _with_bucket(pairs: DataFrame, n: int) -> DataFrame:
    """Pairs with the buckets of both rows (the hash of ``arrays.row_bucket``)."""
    @A.trimmed
    def task(batches):
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(A.row_bucket(a, n), pa.int32()),
                                              pa.array(A.row_bucket(b, n), pa.int32())], names=["a", "b", "a_bucket", "b_bucket"])

    return pairs.mapInArrow(task, "a long, b long, a_bucket int, b_bucket int")


def bit_sketches(sets: DataFrame) -> DataFrame:
    """(rid, bits): each shingle flips one of BITS bits."""
    @A.trimmed
    def task(batches):
        for batch in batches:
            own = _split(pa.Table.from_batches([batch]))
            bits = [np.packbits(np.bincount((v & A.U(BITS - 1)).astype(np.int64), minlength=BITS) & 1).tobytes() for v in own.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), pa.array(bits, pa.binary())], names=["rid", "bits"])

    return sets.mapInArrow(task, "rid long, bits binary")


def _active(holds: DataFrame, labels: DataFrame | None):
    """Rows of words that are held in more than one component, with label and the word's size."""
    rows = holds.withColumn("label", F.col("rid"))
    if labels is not None:
        rows = holds.join(labels.select(F.col("v").alias("rid"), "label"), "rid", "left")
        rows = rows.withColumn("label", F.coalesce("label", "rid"))
    groups = rows.groupBy("word").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("g"),
                                      F.min(F.struct("unique", "rid"))["rid"].alias("best"))
    return rows.join(groups.where("low < high").select("word", "g", "best"), "word")


def close_rows(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that hold a word and whose ranks and bit sketches allow a link.

    Sets that first meet in a word of ranks i and j differ in i + j shingles at least (in parts:
    the larger of both).  Words of more than BLOCK rows are dealt to tasks by pairs of blocks.
    """
    blocks = F.ceil(F.col("g") / BLOCK).cast("long")
    rows = rows.join(bit_sketches(sets), "rid").withColumn("own", F.pmod(F.xxhash64("rid"), blocks))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = rows.withColumn("block", F.xxhash64("word", F.least("own", "other"), F.greatest("own", "other")))
    deal = F.pmod("block", F.lit(4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    @A.trimmed
    def task(table: pa.Table) -> pa.Table:
        block, rid, label = (table.column(c).to_numpy() for c in ("block", "rid", "label"))
        rank, n, parts, own = (table.column(c).to_numpy() for c in ("rank", "n", "parts", "own"))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, BITS // 64)
        order = np.lexsort((rid, block))
        out = [np.zeros((0, 2), np.int64)]
        for part in np.split(order, np.flatnonzero(~A.same_as_before(block[order]))[1:]):
            if len(part) < 2:
                continue
            inner = len(np.unique(own[part])) < 2
            for low in range(0, len(part), 256):
                x, y = part[low: low + 256, None], part[None, :]
                room = (100 - percent) * (n[x] + n[y]) // (100 + percent)
                apart = np.where(parts[x], np.maximum(rank[x], rank[y]), rank[x] + rank[y])
                mask = (rid[x] < rid[y]) & (label[x] != label[y]) & (apart <= room)
                mask &= 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
                if not inner:
                    mask &= own[x] != own[y]
                i, j = np.nonzero(mask)
                a, b = part[low + i], part[j]
                far = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
                fine = far <= (100 - percent) * (n[a] + n[b]) // (100 + percent)
                out.append(np.column_stack([rid[a[fine]], rid[b[fine]]]))
        pairs = np.unique(np.concatenate(out), axis=0)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return rows.withColumn("deal", deal).groupBy("deal").applyInArrow(task, "a long, b long").distinct()


def links(holds: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """(v, label) for rows with links: first each word's likeliest original with its other rows, then
    whatever is left between components."""
    rows = _active(holds, None)
    met = 100 * F.least("n", "best_n") >= percent * F.greatest("n", "best_n")
    heads = holds.select("word", F.col("rid").alias("best"), F.col("n").alias("best_n"))
    pairs = rows.where(F.col("rid") != F.col("best")).join(heads, ["word", "best"]).where(met)
    pairs = _with_bucket(pairs.select(F.col("best").alias("a"), F.col("rid").alias("b")).distinct(), n)
    edges = verified(sets, pairs, n, percent).checkpoint()
    labels = components(edges)
    pairs = _with_bucket(close_rows(_active(holds, labels), sets, percent), n)
    more = verified(sets, pairs, n, percent).checkpoint()
    return components(edges.unionByName(more))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 75, rid: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, rid, first) for documents (doc_id, text, ...).

    ``class_id`` is the smallest doc_id with the same set, ``component_id`` the smallest reachable by
    links; ``first`` marks the smallest (doc_id, row) of each component.  ``rid``: column of
    ``arrays.numbered`` rows.
    """
    from tidemark.session import shared_dir

    shared_dir(docs.sparkSession)
    docs = A.keyed(docs if rid else A.numbered(docs, ("doc_id", "text")), rid=rid or A.RID)
    n = A.bucket_count(docs)
    every = digests(docs, words).checkpoint()
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "rid"))
    classes = every.where("n > 0").groupBy("d1", "d2", "n").agg(smallest.alias("own")).select(
        "d1", "d2", "n", "own", F.col("own.rid").alias("rep")).checkpoint()
    chosen = _asked(classes.select(F.col("rep").alias("rid")), n)
    texts = A.text_rows(docs, n)
    answers = shared_words(count_words(texts, chosen, words, n), n).unionByName(chosen)
    found = first_words(texts, answers, words, n).checkpoint()
    labels = links(found.where("items IS NULL").drop("items", "bucket"), found.where("items IS NOT NULL").select("bucket", "rid", "items"),
                   n, percent)
    named = classes.join(labels, F.col("rep") == F.col("v"), "left").withColumn("label", F.coalesce("label", "rep"))
    lowest = named.groupBy("label").agg(F.min("own").alias("lowest"))
    named = named.join(lowest, "label").select("d1", "d2", "n", "own", "lowest")
    out = every.join(named, ["d1", "d2", "n"], "left")
    alone = F.col("n") == 0
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("lowest.doc_id")).alias("component_id"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("own.doc_id")).alias("class_id"),
                      "rid", (alone | (F.col("rid") == F.col("lowest.rid"))).alias("first"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 75, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, carried columns) of the first document of each component; documents without
    shingles all stay."""
    docs = A.numbered(docs, ("doc_id", "text", *carried))
    keep = jaccard_components(docs, words, percent, A.RID).where("first").select("rid")
    docs = A.keyed(docs, ("text", *carried), A.RID)
    n = A.bucket_count(docs)
    texts = A.text_rows(docs, n, carried)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), *((c, pa.string()) for c in carried)])

    @A.trimmed
    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], schema=schema)
        rids, ids, data, borders = A.unpack_texts(left)
        wanted, _, _ = A.unpack(right, np.int64, np.uint8)
        at, view, more = np.flatnonzero(np.isin(rids, wanted)), memoryview(data), A.unpack_carried(left) if carried else []
        columns = [A.doc_ids(ids[at]), pa.array([str(view[borders[k]: borders[k + 1]], "utf-8") for k in at.tolist()], pa.string())]
        columns += [pa.array([more[k][c] for k in at.tolist()], pa.string()) for c in range(len(carried))]
        return pa.table(columns, schema=schema)

    return texts.groupBy("bucket").cogroup(_asked(keep, n).groupBy("bucket")).applyInArrow(
        rows, ", ".join(["doc_id long", "text string", *(f"`{c}` string" for c in carried)]))


def query(spark, sf_dir) -> DataFrame:
    """op1: 5 words, 0.75, all documents."""
    out = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_shingles", "component_id", "class_id")
