"""Document fingerprints by spot signatures, with DataFrame functions only.

In a text (lower case, white space as single blanks) anchors are common words, told by their
length of at most three characters in any language (articles, prepositions, pronouns), and,
for texts without them, content words that begin with a or e; content words have four
characters or more.  A spot is an anchor (of a run of them the first) with the chain of the next
two content words, common words between them skipped; the next spot starts after it.  A
fingerprint is the set of 32-bit hashes of a text's spots, written in ascending order,
eight hex digits each.  Likeness is the Jaccard coefficient of two sets.

``similar`` finds pairs over a threshold: sets are partitioned by length so that each partition
meets its neighbour only (two sets can only reach the threshold t if their lengths differ
by a factor of 1/t at most), candidates share one of the first signatures of their sorted sets
(as many as must hold one common member), and lengths prune once more before the sets are
compared.  Equal fingerprints are one class with one representative, so copies are never paired.

Nulls are empty texts; an empty text has the empty fingerprint; two empty sets have likeness 1,
an empty and another 0.  Every row is a document of its own, order by doc_id (null last),
then row position.  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import arrays as A

BLANK = r"[\x20\x09-\x0D]"
#: A run of common words, or the start of a content word with a or e; then content words with the
#: common words between them.
SPOT = r"(?<![^ ])(?:(?:[^ ]{1,3}+ )++|(?=[ae]))[^ ]{4,}+(?: [^ ]{1,3}+(?![^ ]))*+(?: [^ ]{4,}+)?+"
COMMON = r"(?<= )[^ ]{1,3} "
SEGMENTS = 64


def spots(text) -> F.Column:
    """Sorted distinct 32-bit hashes of the spots of a text."""
    plain = F.trim(F.regexp_replace(F.lower(text), f"{BLANK}+", " "))
    found = F.regexp_extract_all(plain, F.lit(SPOT), F.lit(0))
    # a text without any spot is one spot
    found = F.transform(F.array(found), lambda f: F.when(F.size(f) > 0, f).when(plain != "", F.array(plain)).otherwise(f))[0]
    made = F.transform(found, lambda p: F.shiftrightunsigned(F.xxhash64(F.regexp_replace(p, COMMON, "")), 32))
    return F.sort_array(F.array_distinct(made))


def written(sigs) -> F.Column:
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def likeness(a, b) -> F.Column:
    """Jaccard coefficient of two sets; unequal emptiness is settled by length."""
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return (F.when(high == 0, 1.0).when(low == 0, 0.0).otherwise(both / (low + high - both))).cast("double")


def in_order(docs: DataFrame, following: list[str]) -> DataFrame:
    """Each document with ``next``: the struct of ``following`` of the next one by (doc_id, row).

    Ids are dealt into ranges (quantiles, then equal widths), about as many as the session has
    shuffle partitions, so no task orders the whole table.  Only the first id and row of each
    range come to the driver; that row is also sent to the range before, as its end.
    """
    spark = docs.sparkSession
    known = docs.where(F.col("doc_id").isNotNull())
    cuts = known.agg(F.percentile_approx("doc_id", [i / SEGMENTS for i in range(1, SEGMENTS)], 10_000).alias("cuts"),
                     F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // SEGMENTS)
    if cuts["low"] is None:
        span = F.lit(0)
    else:
        edges = [cuts["low"], *(cuts["cuts"] or []), cuts["high"] + 1]
        segment = reduce(lambda a, b: a + b, ((F.col("doc_id") >= e).cast("int") for e in edges[1:-1]), F.lit(0))
        bounds = F.array(*(F.lit(e).cast("double") for e in edges))
        low, high = F.get(bounds, segment), F.get(bounds, segment + 1)
        inner = F.floor((F.col("doc_id") - low) * parts / F.greatest(high - low, F.lit(1.0)))
        span = segment * parts + F.least(F.greatest(inner, F.lit(0)), F.lit(parts - 1))
    docs = docs.withColumn("span", F.when(F.col("doc_id").isNull(), SEGMENTS * parts + 1).otherwise(span).cast("int"))
    place = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "rid")
    heads = sorted(tuple(r) for r in docs.groupBy("span").agg(F.min(place)["rid"].alias("rid")).collect())
    back = [(rid, heads[i - 1][0]) for i, (_, rid) in enumerate(heads)]
    back = F.broadcast(spark.createDataFrame(back or [(-1, -1)], "rid long, end_of int"))  # one row per range
    goes = F.filter(F.array(F.struct(F.col("span").alias("span"), F.lit(False).alias("end")),
                            F.struct(F.col("end_of").alias("span"), F.lit(True).alias("end"))), lambda s: s["span"].isNotNull())
    rows = docs.join(back, "rid", "left").withColumn("to", F.explode(goes)).withColumns(
        {"span": F.col("to.span"), "end": F.col("to.end")}).drop("to", "end_of")
    order = Window.partitionBy("span").orderBy("end", F.col("doc_id").asc_nulls_last(), "rid")
    return rows.withColumn("next", F.lead(F.struct(*following)).over(order)).where(~F.col("end")).drop("end", "span")


def similar(prints: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(pairs, members) for rows (doc_id, sigs): pairs of class representatives with likeness of
    ``threshold`` or more, and (doc_id, class_id) for all; class_id is the smallest doc_id of a fingerprint."""
    named = prints.select("doc_id", "sigs", F.sha2(written(F.col("sigs")), 256).alias("print"))
    classes = named.groupBy("print").agg(F.min("doc_id").alias("class_id"), F.first("sigs").alias("sigs"))
    members = named.select("doc_id", "print").join(classes.select("print", "class_id"), "print").select("doc_id", "class_id")
    sets = classes.where(F.size("sigs") > 0).withColumn("n", F.size("sigs")).withColumn(
        "band", F.floor(F.log("n") / F.lit(-1.0) / F.log(F.lit(threshold)) + 1e-9).cast("int"))
    first = F.slice("sigs", 1, (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int"))
    keys = sets.select("class_id", "n", "band", F.explode(first).alias("sig"))
    small = keys.withColumn("at", F.explode(F.array("band", F.col("band") + 1)))
    met = small.alias("a").join(keys.alias("b"), (F.col("a.sig") == F.col("b.sig")) & (F.col("a.at") == F.col("b.band"))
                                & ((F.col("a.band") < F.col("b.band")) | (F.col("a.class_id") < F.col("b.class_id")))
                                & (F.least("a.n", "b.n") >= threshold * F.greatest("a.n", "b.n")))
    met = met.select(F.col("a.class_id").alias("a_id"), F.col("b.class_id").alias("b_id")).distinct()
    sigs = sets.select("class_id", "sigs")
    met = met.join(sigs.withColumnsRenamed({"class_id": "a_id", "sigs": "a_sigs"}), "a_id")
    met = met.join(sigs.withColumnsRenamed({"class_id": "b_id", "sigs": "b_sigs"}), "b_id")
    pairs = met.withColumn("likeness", likeness(F.col("a_sigs"), F.col("b_sigs"))).where(F.col("likeness") >= threshold)
    return pairs.select(F.least("a_id", "b_id").alias("a_id"), F.greatest("a_id", "b_id").alias("b_id"), "likeness"), members


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_text, sigs, edited_sigs, next_sigs) for documents (doc_id, text, ...)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = A.numbered(docs, ("doc_id", "text")).select(F.col(A.RID).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = in_order(rows.withColumn("sigs", spots(F.col("text"))), ["text", "sigs"])
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - quarter), F.col("next.text").substr(F.lit(1), quarter))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited_text"), "sigs", F.col("next.sigs").alias("next_sigs"))
    return rows.withColumn("edited_sigs", spots(F.col("edited_text")))


def query(spark, sf_dir) -> DataFrame:
    """op8: all documents, their edited texts and their successors."""
    rows = fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
                       written(F.col("sigs")).alias("fingerprint"), written(F.col("edited_sigs")).alias("edited_fingerprint"),
                       likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                       likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
