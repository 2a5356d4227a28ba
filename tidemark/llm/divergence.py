"""Source divergence audit over run-length columns.

Terms are runs of letters A-Z, a-z and characters beyond ASCII, A-Z lower-cased.  A language keeps the terms
found in ``min_docs`` of its documents, V of them.  A (lang, source) group with N occurrences of kept terms
gives a term counted c times p = 1 + floor(SCALE * (c + 2) / (N + 2 V)); so does the language as a whole.
Two p's diverge by f = floor((p - q)^2 / (p + q)).

* ``counts``: a task counts the terms of a run of rows per group, so a frequent term or a large source leaves
  it as one row.  The counts of all tasks are summed per (lang, source, term), then each term's counts in all
  sources come together; terms that stay are written with a vector of (source, count), at most one entry per
  source of the language.
* ``pair`` rows.  The vocabulary is reordered by its vectors, which puts equal counts side by side: terms of
  one vector are a run already (counted before the shuffle).  Ranges of that order are slices; in a slice the
  column of a source is run-length coded, equal neighbours in one run, absent sources one run of zeros.  For
  two sources the boundaries of their runs are intersected and f is multiplied by the length of each piece;
  sums over slices are the values.  Sources meet in blocks of BLOCK, so a task holds two blocks of columns of
  one slice.  f is symmetric: each pair is computed once.
* ``term`` rows are a top ten per group over counts above zero, by a window whose limit is applied before its
  shuffle.

Null text, lang and source count as ''; every row is a document of its own; groups without terms have pairs
(value 0 where V is 0) and no terms; an empty table gives no rows; other columns are not read.  The number of
pair rows is the square of the sources of a language, as the result demands.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import text_slices

SCALE = 1_000_000_000
#: Entries of a task's counts before they are sent on; terms of a slice; sources of a block.
COUNTS_KEPT = 400_000
SLICE_RUNS = 16_384
BLOCK = 32
#: Bytes as a term sees them: A-Z lower-cased, other ASCII except a-z is a border (a blank).
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNT_SCHEMA = "lang string, source string, term string, n long, docs long"
COUNT_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
COLUMN_SCHEMA = "lang string, slice long, source string, starts binary, counts binary, length long"
COLUMN_ARROW = pa.schema([("lang", pa.string()), ("slice", pa.int64()), ("source", pa.string()), ("starts", pa.binary()),
                          ("counts", pa.binary()), ("length", pa.int64())])
PAIR_SCHEMA = "lang string, a string, b string, value long"
PAIR_ARROW = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, several rows a term; a group without terms
    has a row of the empty term."""
    def task(batches):
        found: dict[tuple[str, str], list[Counter]] = {}

        def rows():
            parts = [(lang, source, term, n, docs.get(term, 0)) for (lang, source), (seen, docs) in found.items()
                     for term, n in seen.items()]
            columns = list(zip(*parts, strict=True))
            arrays = [pa.array(columns[0]), pa.array(columns[1]), pa.array([t.decode() for t in columns[2]]),
                      pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, schema=COUNT_ARROW)

        held = 0
        for batch in batches:
            langs, sources = (batch.column(c).to_pylist() for c in ("lang", "source"))
            for first, end, data, borders in text_slices(batch.column("text")):
                letters = data.tobytes().translate(TERM_BYTES)
                for k in range(end - first):
                    key = langs[first + k], sources[first + k]
                    seen, docs = found.get(key) or found.setdefault(key, [Counter({b"": 0}), Counter()])
                    before = len(seen)
                    terms = letters[borders[k]: borders[k + 1]].split()
                    seen.update(terms)
                    docs.update(set(terms))
                    held += len(seen) - before
                if held > COUNTS_KEPT:
                    yield rows()
                    found, held = {}, 0
        if found:
            yield rows()

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    return docs.select(*text).mapInArrow(task, COUNT_SCHEMA)


def column_runs(vectors: list[list[tuple[str, int]]], lengths: list[int]) -> tuple[dict[str, tuple[np.ndarray, np.ndarray]], int]:
    """Run-length columns (starts, counts) of the sources in a slice of the ordered vocabulary, and its length."""
    at = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))])
    places: dict[str, tuple[list[int], list[int]]] = {}
    for i, vector in enumerate(vectors):
        for source, n in vector:
            where, values = places.setdefault(source, ([], []))
            where.append(i)
            values.append(n)
    out = {}
    for source, (where, values) in places.items():
        column = np.zeros(len(vectors), np.int64)
        column[where] = values
        new = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
        out[source] = at[new], column[new]
    return out, int(at[-1])


def probabilities(values: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """p of each count, exact: Python integers, once per distinct count."""
    distinct, inverse = np.unique(values, return_inverse=True)
    p = [1 + SCALE * (c + 2) // (total + 2 * vocabulary) for c in distinct.tolist()]
    return np.array(p, np.int64)[inverse]


def run_divergence(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """Sum of f over two columns of (starts, p): one product per piece between boundaries of either."""
    starts = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], starts, "right") - 1]
    q = b[1][np.searchsorted(b[0], starts, "right") - 1]
    return int(((p - q) ** 2 // (p + q) * np.diff(np.append(starts, length))).sum())


def _columns(slice_runs: int):
    """Slices of rows sorted by (lang, vector), as one packed row per source and slice."""
    def task(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        lang, vectors, lengths = None, [], []

        def rows():
            found, length = column_runs(vectors, lengths)
            parts = zip(*[(lang, number, s, v[0].tobytes(), v[1].tobytes(), length) for s, v in found.items()], strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(parts, COLUMN_ARROW)], schema=COLUMN_ARROW)

        for batch in batches:
            for own, vector, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "vector", "run")), strict=True):
                if vectors and (own != lang or len(vectors) == slice_runs):
                    yield rows()
                    number, vectors, lengths = number + 1, [], []
                lang = own
                vectors.append([(e["source"], e["n"]) for e in vector])
                lengths.append(n)
        if vectors:
            yield rows()

    return task


def _pair_sums(table: pa.Table) -> pa.Table:
    """Partial sums of all pairs between two blocks of sources of one slice."""
    lang, bi, bj, length = (table.column(c)[0].as_py() for c in ("lang", "bi", "bj", "length"))
    sides: tuple[list, list] = ([], [])
    for source, block, total, vocabulary, starts, values in zip(*(table.column(c).to_pylist() for c in (
            "source", "block", "total", "vocabulary", "starts", "counts")), strict=True):
        start = np.frombuffer(starts, np.int64) if starts is not None else np.zeros(1, np.int64)
        count = np.frombuffer(values, np.int64) if values is not None else np.zeros(1, np.int64)
        column = source, (start, probabilities(count, total, vocabulary))
        for side, own in zip(sides, (bi, bj), strict=True):
            if block == own:
                side.append(column)
    out = [(lang, a, b, run_divergence(x, y, length)) for a, x in sides[0] for b, y in sides[1] if bi != bj or a < b]
    columns = zip(*out, strict=True) if out else [[]] * 4
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, PAIR_ARROW)], schema=PAIR_ARROW)


def _p(n, total):
    """p in SQL; decimals hold SCALE times any long exactly."""
    share = (F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)"))
    return F.lit(1).cast("long") + F.call_function("div", share, (total + 2 * F.col("vocabulary")).cast("decimal(20,0)"))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = 10, terms: int = 10, block: int = BLOCK, slice_runs: int = SLICE_RUNS) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents (text, lang, source, ...)."""
    from tidemark.session import shared_dir

    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/divergence-{uuid.uuid4().hex}"

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    # by source first, so that a frequent term of all tasks meets in one place per source, not in one place
    per_source = counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    vocabulary = written(per_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("vector"))
        .where((F.col("docs") >= min_docs) | (F.col("term") == "")), "vocabulary")
    kept = vocabulary.where(F.col("term") != "")
    groups = vocabulary.where(F.col("term") == "").select("lang", F.explode("vector.source").alias("source"))
    cells = kept.select("lang", "term", F.aggregate("vector", F.lit(0).cast("long"), lambda x, e: x + e["n"]).alias("lang_n"),
                        F.explode("vector").alias("e")).select("lang", "term", "lang_n", "e.source", "e.n")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    groups = groups.join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total"),
        F.coalesce("vocabulary", F.lit(0).cast("long")).alias("vocabulary"))
    numbered = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    groups = written(groups.withColumn("block", F.floor((numbered - 1) / block)), "groups")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("block").alias("last"))

    runs = kept.groupBy("lang", "vector").agg(F.count(F.lit(1)).alias("run"))
    # as many ranges as slices: the bounds of a range sort are sampled on the driver
    columns = written(runs.repartitionByRange(-(-kept.count() // slice_runs) or 1, "lang", "vector").sortWithinPartitions("lang", "vector")
                      .mapInArrow(_columns(slice_runs), COLUMN_SCHEMA), "columns")
    slices = columns.groupBy("lang", "slice").agg(F.max("length").alias("length"))
    dealt = (slices.join(groups, "lang").join(columns.drop("length"), ["lang", "slice", "source"], "left")
             .join(langs.select("lang", "last"), "lang")
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
             .withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")}))
    sums = (dealt.select("lang", "slice", "bi", "bj", "length", "source", "block", "total", "vocabulary", "starts", "counts")
            .groupBy("lang", "slice", "bi", "bj").applyInArrow(_pair_sums, PAIR_SCHEMA)
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = sums.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                          F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("e"))
    without = groups.where(F.col("vocabulary") == 0)  # languages that keep no term: pairs of value 0
    zero = without.select("lang", "source").join(without.select("lang", F.col("source").alias("item")), "lang") \
                  .where(F.col("source") != F.col("item")).withColumn("value", F.lit(0).cast("long"))
    pairs = both.select("lang", "e.source", "e.item", "value").unionByName(zero)

    p, q = _p(F.col("n"), F.col("total")), _p(F.col("lang_n"), F.col("lang_total"))
    against = (cells.where(F.col("n") > 0).join(groups.drop("block"), ["lang", "source"]).join(langs.drop("last"), "lang")
               .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where(F.col("p") > F.col("q")))
    value = F.expr("(p - q) * (p - q) div (p + q)")
    top = _ranked(against.select("lang", "source", "item", value.alias("value"))).where(F.col("rank") <= terms)
    shape = ("lang", "source", "part", "item", "value", "rank")
    return (_ranked(pairs).withColumn("part", F.lit("pair")).select(*shape)
            .unionByName(top.withColumn("part", F.lit("term")).select(*shape)))


def query(spark, sf_dir) -> DataFrame:
    """op13: divergence of all sources within each language, and each source's ten most typical terms."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT row_no, lang, source, unnest(regexp_extract_all(text, '[^\x{0}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT row_no) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS size, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
t AS (SELECT g.lang, g.source, coalesce(sum(n.n), 0)::HUGEINT AS total FROM g LEFT JOIN n USING (lang, source) GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, coalesce(n.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 2)) // (t.total + 2 * v.size) AS p,
        1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (v.lang_total + 2 * v.size) AS q
      FROM t JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = t.lang AND n.source = t.source AND n.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(x.f), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source AS s, b.source AS o, ((a.p - b.p) * (a.p - b.p)) // (a.p + b.p) AS f
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source) x
    ON x.lang = a.lang AND x.s = a.source AND x.o = b.source GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
  WHERE rank <= 10)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r
"""
