"""Each operator against brute force on a small table with awkward rows, and on empty tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import (arrays, catalog, lines, mixing, packing, parity, quality, spotsigs, substring, suffixes, topk,
                          toxicity)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, bucket string, label string"


def words(rng, n, pool=400):
    return " ".join(rng.choice(["w", "Wo", "wört", "x"]) + str(rng.randrange(pool)) for _ in range(n))


@pytest.fixture(scope="module")
def table():
    rng = random.Random(5)
    base = words(rng, 120)
    edited = base.split(" ")
    edited[60] = "EDIT"
    passage = words(rng, 70, 10_000)
    line = "A common line that is long enough to count, says nobody at all"
    texts = [base, base, base.upper(), " ".join(edited), None, "", "   \n ", "one two", "One  TWO", passage,
             words(rng, 50) + " " + passage, passage + "\t" + words(rng, 30), "la " * 900, "la " * 700 + "end", words(rng, 30_000, 5),
             "日本語のテキスト" * 60, "x" * 1000, "un " * 20_000 + "fin", *(f"{line}\n{words(rng, 9)}\n {line.upper()} " for _ in range(7)),
             *(words(rng, rng.randrange(1, 200)) for _ in range(25))]
    rows = [(k * 3, t) for k, t in enumerate(texts)] + [(0, base), (0, base), (None, base), (None, None), (1000, "tail " + passage)]
    return [(i, t, None if i == 3 else "en", [None, "é", "a", "Z"][k % 4], None, "r", "b", "l") for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "docs")
    spark.createDataFrame(table, SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def order(row):
    """(doc_id with null last, place): the order of documents."""
    return (row[1][0] is None, row[1][0] or 0, row[0])


def ordered(table):
    return [(r[0], r[1] or "") for _, r in sorted(enumerate(table), key=order)]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def same(found, expected):
    assert Counter(map(tuple, found)) == Counter(expected)


def test_substring(docs, table):
    seen, expected = set(), []
    for i, t in ordered(table):
        own = WORD.findall(t)
        gone = set()
        for k in range(len(own) - 19):
            if tuple(own[k:k + 20]) in seen:
                gone.update(range(k, k + 20))
            seen.add(tuple(own[k:k + 20]))
        expected.append((i, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    same(substring.dedup_windows(docs).collect(), expected)


def test_suffixes(docs, table):
    data = [(i, t.encode()) for i, t in ordered(table)]
    counts = Counter(b[k:k + 400] for _, b in data for k in range(len(b) - 399))
    expected = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if counts[b[k:k + 400]] > 1:
                gone[k:k + 400] = b"\1" * 400
        spans = sum(1 for g, _ in itertools.groupby(gone) if g)
        expected.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    same([(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffixes.dedup_bytes(docs).collect()], expected)


def line_rows(documents):
    """(doc_id, lines, dropped lines, kept text) of documents in order."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(lower)
    rows = [(k, i, t.split("\n")) for k, (i, t) in enumerate(documents)]
    held = {}
    for k, _, own in rows:
        for x in {key(x) for x in own if len(key(x)) >= 40}:
            held.setdefault(x, []).append(k)
    last = {x: v[-1] for x, v in held.items() if len(v) >= 5}
    expected = []
    for k, i, own in rows:
        stay = [x for x in own if last.get(key(x), k) == k]
        expected.append((i, len(own), len(own) - len(stay), "\n".join(stay)))
    return expected


def brute_lines(documents):
    return [(i, kept) for i, _, _, kept in line_rows(documents)]


def text_of_ordered(rows):
    return ordered([(r["doc_id"], r["text"]) for r in rows])


def test_lines(docs, table):
    expected = line_rows(ordered(table))
    assert any(r[2] for r in expected)
    same(lines.dedup_lines(docs).collect(), expected)


def test_perfect_hash():
    place = arrays.mix(np.arange(5000, dtype=np.uint64))
    sizes, flags, at = lines.build(place)
    assert sorted(at) == list(range(5000))
    assert (lines.look_up(sizes, flags, place) == at).all()


def shingles(text):
    own = WORD.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(own[k:k + 5]) for k in range(len(own) - 4)) if len(own) >= 5 else frozenset([tuple(own)] if own else [])


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids and sets[k] else i))
    return out


def test_parity(docs, table):
    found = parity.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    same(found, brute_components(ordered(table)))


def test_parity_chains_and_bands(spark):
    rng = random.Random(9)
    rows = []
    for n in (40, 300, 350, 1500):  # chains of edited copies, over a word per shingle and parts
        text = words(rng, n, 10**6).split(" ")
        for step in range(8):
            rows.append((len(rows), " ".join(text)))
            for _ in range(max(1, n // 60)):
                text[rng.randrange(len(text))] = f"n{rng.random()}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = parity.jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect()
    same(found, brute_components(rows))


def test_one_of_each(docs, table):
    kept = parity.one_of_each(docs, carried=("lang", "source")).collect()
    rows = ordered(table)
    comps = brute_components(rows)
    firsts = {}
    for k, (i, n, c) in enumerate(comps):
        firsts.setdefault(c if n else ("empty", k), (i, rows[k][1]))
    same([(r["doc_id"], r["text"] or "") for r in kept], firsts.values())


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(300)] + [(k, [0.5] * 6) for k in range(300, 360)]
    rows += [(400, None), (450, [1.0, None] + [0.0] * 4), (500, [float("nan")] * 6), (550, [float("inf")] * 6), (600, [0.0] * 6),
             (650, [1.0, 2.0]), (651, [-1.0, 2.0]), (None, [1.0] * 6), (7, [0.25] * 6), (-50, [9.0] * 6), (700, [])]
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "vec_id long, embedding array<double>, score string, block int")
    good = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for i, q in good:
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for j, v in good if j != i and len(v) == len(q))[:5]
            expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    same(topk.search(df).collect(), expected)


def test_mixing(docs, table, spark):
    rows, sizes, targets, flows = mixing.mix(docs, mixing.F.array("source"), mixing.word_count())
    found = rows.collect()
    own = Counter()
    for r in table:
        own[r[3]] += len(WORD.findall(r[1] or ""))
    assert sizes == dict(own)
    assert sum(targets.values()) == pytest.approx(min(1.5 * sum(own.values()), 2 * sum(own.values())))
    taken = Counter()
    for r in found:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["members"][0]] += r["taken"]
    for s, t in targets.items():
        assert t <= 2 * sizes[s] + 1e-6
        # whole documents: what is left is less than the largest of the source
        assert 0 <= t - taken[s] + 1e-6 <= max(r["size"] for r in found if r["members"][0] == s) + 1
    again = mixing.mix(docs, mixing.F.array("source"), mixing.word_count())[0].collect()
    same([(r["rid"], r["taken"]) for r in again], [(r["rid"], r["taken"]) for r in found])


def test_mixing_fills_behind_a_long_document(spark):
    # a document as long as all others together is met on the way to the target
    sized = [("long", 50_000), *[("long", 100)] * 500, *[("mixed", 1 + k % 7 * 40 + k % 13) for k in range(300)], ("mixed", 20_000), ("mixed", 9_000)]
    df = spark.createDataFrame([(k, s, n) for k, (s, n) in enumerate(sized)], "doc_id long, source string, n long")
    for source in ("long", "mixed"):
        rows, _, targets, _ = mixing.mix(df.where(mixing.F.col("source") == source), mixing.F.array("source"), mixing.F.col("n"))
        found = rows.collect()
        left = int(targets[source]) - sum(r["taken"] for r in found)
        assert len(found) == sum(s == source for s, _ in sized) and {r["taken"] // r["size"] for r in found} == {1, 2}
        assert 0 <= left < min(r["size"] for r in found if r["taken"] == r["size"])
        assert source != "long" or left == 0


def test_flow_of_overlapping_sources():
    patterns = {("a",): 100, ("a", "b"): 100, ("b",): 10}
    flows = mixing.min_cost_flow(patterns, {"a": 90, "b": 110}, 2)
    assert flows[("a",), "a"] + flows[("a", "b"), "a"] == 90
    assert flows[("a", "b"), "b"] == 100 and flows[("b",), "b"] == 10  # nothing is repeated while words are left
    assert mixing.quotas({"a": 10, None: 1000, "b": 10}) == {"a": 20.0, "b": 20.0, None: 1490.0}


def test_spot_signatures(docs, table, spark):
    rows = ordered(table)
    found = spotsigs.fingerprints(docs).collect()
    expected = []
    for k, (i, t) in enumerate(rows):
        quarter = len(t) // 4
        following = rows[(k + 1) % len(rows)][1]
        expected.append((i, len(t), t[:len(t) - quarter] + following[:quarter]))
    same([(r["doc_id"], r["n_chars"], r["edited_text"]) for r in found], expected)
    prints = {}
    for r, _ in zip(sorted((r for r in found), key=lambda r: (r["doc_id"] is None, r["doc_id"])), rows):
        prints.setdefault(r["n_chars"], set()).add(tuple(r["sigs"]))
    same_text = [r for r in found if r["n_chars"] == len(table[0][1])]
    assert len({tuple(r["sigs"]) for r in same_text}) <= 2  # the base text, its edit apart
    frame = spark.createDataFrame([(1, [1, 2, 3, 4]), (2, [1, 2, 3, 4]), (3, [1, 2, 3]), (4, [9]), (5, [])], "doc_id long, sigs array<bigint>")
    pairs, members = spotsigs.similar(frame)
    same(pairs.collect(), [(1, 3, 0.75)])
    same(members.collect(), [(1, 1), (2, 1), (3, 3), (4, 4), (5, 5)])


def test_packing(docs, table, spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = [(9000 + k, t) for k, t in enumerate(["Don't, can't; 'the' x='s ('t) <|endoftext|>a <|ENDOFTEXT|> ≠ Ábc", "ÀÉ straße ß İ K 12ab,34;;'",
                                                "a b c", "…—«x»,'ll'", "<|startoftext|><|endoftext|>"])]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    found = packing.pack_documents(both, path).collect()
    expected = []
    for i, t in [(r[0], r[1] or "") for r in table] + odd:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        for p in range(-(-len(ids) // 4096)):
            part = np.array(ids[4096 * p: 4096 * p + 4096], "<u4")
            expected.append((i, p, 4096 * p, len(part), zlib.crc32(part.tobytes())))
    same([tuple(r)[:5] for r in found], expected)
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        end = 0
        for at, length in sorted(own):
            assert at == end
            end += length
        assert end <= 4096
    assert len(bins) <= -(-sum(e[3] for e in expected) // 4096) + 1


def test_rows_keep_their_numbers_when_scans_split_anew(spark, table, tmp_path, monkeypatch):
    """The files are split otherwise between the jobs of an operator, as when executors join."""
    plain = spark.createDataFrame(table, SCHEMA)
    plain.repartition(3, "text").sortWithinPartitions("doc_id").write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    splits = itertools.cycle([1, 6, 2, 8])

    def resplit(module, name):
        inner = getattr(module, name)

        def call(*args, **more):
            spark.conf.set("spark.sql.files.minPartitionNum", next(splits))
            return inner(*args, **more)
        monkeypatch.setattr(module, name, call)

    resplit(parity, "links")
    resplit(mixing, "min_cost_flow")
    resplit(spotsigs.F, "broadcast")
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", 1)
        kept = Counter(r["text"] or "" for r in parity.one_of_each(docs).collect())
        comps = brute_components(ordered(table))
        assert sum(kept.values()) == len({c for _, n, c in comps if n}) + sum(1 for _, n, _ in comps if not n)
        mixed = Counter((r["doc_id"], r["text"]) for r in mixing.mixed(docs).collect())
        spots = spotsigs.fingerprints(docs).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(spots) == len(table)
    # every document with words is taken once at least in this mix
    assert set(mixed) == {(r[0], r[1]) for r in table if WORD.findall(r[1] or "")}
    same([(r["doc_id"], r["n_chars"]) for r in spots], [(i, len(t)) for i, t in ordered(table)])


def labelled_table(n=500):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        own = [rng.choice(["the", "and", "stone", "river", "walks", "green", "over"]) + rng.choice(["", "s", ","]) for _ in range(60)]
        good, toxic = int(k % 3 > 0), int(k % 4 == 0)
        if toxic:
            for _ in range(4):
                own[rng.randrange(60)] = rng.choice(["you idiot", "sc0undrel", "scoundrel!", "vermin"])
        if not good:
            own = [x.upper() + "!!" for x in own]
        rows.append((k, " ".join(own)))
        labels.append((k, good, toxic))
    rows += [(None, None), (None, ""), (3, "again " * 5000), (9999, None)]
    labels += [(None, 1, 1), (4, None, None), (9999, 7, -1)]
    return rows, labels


@pytest.mark.parametrize(("module", "column", "limit"), [(quality, "quality", 0.7), (toxicity, "toxic", 0.3)])
def test_classifiers(spark, module, column, limit):
    rows, labels = labelled_table()
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, label string, score double")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = module.classify(docs, known).collect()
    same([r["doc_id"] for r in found for _ in (0,)] and [(r["doc_id"],) for r in found], [(r[0],) for r in rows])
    truth = {r[0]: r[1 if column == "quality" else 2] for r in labels if r[0] is not None and r[0] < 500 and r[1] is not None}
    right = [r["predicted"] == truth[r["doc_id"]] for r in found if r["held_out"] and r["doc_id"] in truth]
    assert len(right) > 80 and np.mean(right) > 0.95
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    again = module.classify(docs, known).collect()
    same(map(tuple, again), map(tuple, found))


def test_isotonic_rises():
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    at, rate = toxicity.isotonic(x, (x + rng.normal(size=200) > 0).astype(float))
    assert (np.diff(rate) >= -1e-9).all() and (np.diff(at) >= 0).all()


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for name, query in catalog.QUERIES.items():
        assert query(spark, str(tmp_path)).collect() == [], name


def text_of(rows):
    return [(r["doc_id"], r["text"] or "") for r in rows]


def test_pipeline(spark, tmp_path, table):
    """Each stage against brute force on what the stage before it wrote; ``run`` gives the rows of the last one."""
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    rows, labels = labelled_table(200)
    spark.createDataFrame([(i, t, "en", "s1", None) for i, t in rows[:200]] + [r[:5] for r in table],
                          "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    known = spark.read.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).coalesce(1).write.parquet(f"{tmp_path}/{k}")
        seen.append((docs, out := spark.read.parquet(f"{tmp_path}/{k}")))
        docs = out
        assert docs.count() > 0 and (k == 4 or set(corpus_pipeline.COLUMNS) == set(docs.columns)), name

    # 1: the documents that the classifier predicts to be good, as they are
    given, kept = seen[0]
    scored = quality.classify(given, known).collect()  # rows in the order of the table
    expected = [tuple(r[c] for c in corpus_pipeline.COLUMNS) for r, s in zip(given.collect(), scored, strict=True) if s["score"] >= 0.7]
    assert len(expected) < given.count()
    same([tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in kept.collect()], expected)

    # 2: every document stays, without the lines that a later one of five or more holds
    given, kept = seen[1]
    same(text_of(kept.collect()), brute_lines(text_of_ordered(given.collect())))

    # 3: the first document of each component, and every document without words
    given, kept = seen[2]
    ordered_rows = text_of_ordered(given.collect())
    firsts = {}
    for k, (i, n, c) in enumerate(brute_components(ordered_rows)):
        firsts.setdefault(c if n else ("empty", k), ordered_rows[k])
    same(text_of(kept.collect()), firsts.values())

    # 4: whole documents, twice at most, up to the target of their source; none that was not there
    given, kept = seen[3]
    have, out = given.collect(), kept.collect()
    sizes, words_out = Counter(), Counter()
    for r in have:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    for r in out:
        words_out[r["source"]] += len(WORD.findall(r["text"]))
    targets = mixing.quotas(dict(sizes))
    columns = corpus_pipeline.COLUMNS
    there = Counter(tuple(r[c] for c in columns) for r in have)
    assert all(n <= 2 * there[row] for row, n in Counter(tuple(r[c] for c in columns) for r in out).items())
    for s, target in targets.items():
        longest = max(len(WORD.findall(r["text"] or "")) for r in have if r["source"] == s)
        assert 0 <= target - words_out[s] + 1e-6 <= longest + 1

    # 5: the pieces of all rows, in sequences without gaps
    given, pieces = seen[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for i, t in text_of(given.collect()):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), 4096):
            part = np.array(ids[at: at + 4096], "<u4")
            expected.append((i, at // 4096, at, len(part), zlib.crc32(part.tobytes())))
    found = pieces.collect()
    same([tuple(r)[:5] for r in found], expected)
    ends = Counter()
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 4096

    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    same([tuple(r)[:5] for r in again], expected)


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
