"""S3: a paged JSON feed landed as one document per page.

A page is ``{"data": [object, ...], "next_cursor": string | null}``.  The
reference walks pages over HTTP; here the pages are already landed (one row
or file per page) and the whole set is validated and exploded in parallel:

* shape: every page must be an object with an array of objects under
  ``data`` and a string or null ``next_cursor`` -> ``invalid_response_shape``;
* a page lands under the cursor that fetched it.  ``walk`` follows the cursors from the
  first page, as a client does: a cursor that no page landed under is a gap
  (``missing_page``), one that leads back is a loop (``repeated_cursor``), and pages
  that the walk does not come to are detached and take no part;
* records are exploded with their page id, ready for the contract (V4) and
  the page-atomic upsert (I7).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class FeedError(ValueError):
    pass


def parse_pages(pages: DataFrame, id_col: str = "page_id", text_col: str = "page",
                carried: Sequence[str] = ()) -> DataFrame:
    v = F.try_parse_json(F.col(text_col))
    data_t = F.schema_of_variant(F.try_variant_get(v, "$.data", "variant"))
    cur_t = F.schema_of_variant(F.try_variant_get(v, "$.next_cursor", "variant"))
    none = F.size(F.try_variant_get(v, "$.data", "array<variant>")) == 0   # [null] has the same type as []
    ok = (F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
          & F.coalesce(data_t.startswith("ARRAY<OBJECT") | (data_t.isin("ARRAY<VOID>", "ARRAY<UNKNOWN>") & none), F.lit(False))
          & F.coalesce(cur_t.isin("STRING", "VOID"), F.lit(False)))
    return pages.select(F.col(id_col).alias("page_id"), *carried, v.alias("_v"), ok.alias("shape_ok"),
                        F.try_variant_get(v, "$.next_cursor", "string").alias("next_cursor"))


#: Pages of one segment: followed inside one task.
SEGMENT_PAGES = 4096
MISSING, REPEATED, COMPLETE = "missing_page", "repeated_cursor", "complete"


def _links(pages) -> dict:
    return dict(zip(pages.column("page_id").to_pylist(), pages.column("next_cursor").to_pylist(), strict=True))


def _segment_exits(pages):
    """Per page of a segment: the cursor at which its walk leaves the segment (null: it ends or loops here), how
    many pages on that is, and whether it loops.  Each page is settled once."""
    import pyarrow as pa

    to, done = _links(pages), {}
    for page in to:
        path, at, seen = [], page, set()
        while at is not None and at in to and at not in done and at not in seen:
            path.append(at)
            seen.add(at)
            at = to[at]
        end = (None, 0, True) if at in seen else done.get(at, (at, 0, False))
        for p in reversed(path):
            end = done[p] = (end[0], end[1] + 1, end[2])
    out = [done[p] for p in to]
    return pa.table({"feed": pages.column("feed").slice(0, len(to)), "page_id": pa.array(list(to), pa.string()),
                     "leaves": pa.array([r[0] for r in out], pa.string()), "pages": pa.array([r[1] for r in out], pa.int64()),
                     "loops": pa.array([r[2] for r in out], pa.bool_())})


def _segment_pages(pages, entries):
    """The pages of a segment from each entry on, with their place in the feed's walk."""
    import pyarrow as pa

    to, out = _links(pages), []
    for page, place in zip(entries.column("page_id").to_pylist(), entries.column("position").to_pylist(), strict=True):
        seen = set()
        while page is not None and page in to and page not in seen:
            seen.add(page)
            out.append((page, place))
            page, place = to[page], place + 1
    feed = pages.column("feed")
    return pa.table({"feed": pa.array([feed[0].as_py()] * len(out) if out else [], feed.type),
                     "page_id": pa.array([r[0] for r in out], pa.string()), "position": pa.array([r[1] for r in out], pa.int64())})


def walk(pages: DataFrame, segment_pages: int = SEGMENT_PAGES) -> DataFrame:
    """(feed, page_id, position, outcome) of the pages that the walk from each feed's first page comes to.

    ``pages`` are (feed, page_id, page_seq, next_cursor); the first page of a feed has its smallest ``page_seq``
    (then id), and a page landed twice counts as first landed.  ``outcome`` is the feed's: complete, missing_page
    or repeated_cursor; then the pages up to that place are given.

    Runs of ``page_seq`` are segments, followed inside tasks; between segments only the pages at which walks enter
    one matter.  From these, pointers are doubled: after round r the pages 2^r entries on are known, so a feed of
    k segments takes log2(k) rounds, each an equi join over entries.
    """
    from ..session import shared_dir

    spark, folder = pages.sparkSession, f"{shared_dir(pages.sparkSession)}/tidemark-walks/{uuid.uuid4().hex}"

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    links = written(pages.groupBy("feed", "page_id").agg(
        F.min_by(F.struct("page_seq", "next_cursor"), F.struct("page_seq", "next_cursor")).alias("p"))
        .select("feed", "page_id", F.col("p.page_seq").cast("long").alias("page_seq"), "p.next_cursor",
                F.floor(F.col("p.page_seq") / segment_pages).cast("long").alias("segment")), "links")
    feed_type = links.schema["feed"].dataType.simpleString()
    exits = written(links.groupBy("feed", "segment").applyInArrow(
        _segment_exits, f"feed {feed_type}, page_id string, leaves string, pages long, loops boolean"), "exits")
    first = links.groupBy("feed").agg(F.min_by("page_id", F.struct("page_seq", "page_id")).alias("page_id"),
                                      F.max(F.lit(0)).cast("long").alias("position"))
    # entries: where a walk can come into a segment
    entered = exits.where(F.col("leaves").isNotNull()).select("feed", F.col("leaves").alias("page_id")) \
        .unionByName(first.select("feed", "page_id")).distinct()
    jumps = written(exits.join(entered, ["feed", "page_id"]).select("feed", "page_id", "leaves", "pages", "loops"), "jumps")
    most = jumps.groupBy("feed").agg(F.count("leaves").alias("n")).agg(F.max("n")).first()[0] or 0
    reached, hops, r = written(first, "reached"), jumps.drop("loops"), 0
    while (1 << r) <= most:
        on = reached.join(hops, ["feed", "page_id"]).where(F.col("leaves").isNotNull()).select(
            "feed", F.col("leaves").alias("page_id"), (F.col("position") + F.col("pages")).alias("position"))
        reached = written(reached.unionByName(on), f"reached{r}")
        then = hops.select("feed", F.col("page_id").alias("leaves"), F.col("leaves").alias("far"), F.col("pages").alias("more"))
        hops = written(hops.where(F.col("leaves").isNotNull()).join(then, ["feed", "leaves"])
                       .select("feed", "page_id", F.col("far").alias("leaves"), (F.col("pages") + F.col("more")).alias("pages")), f"hops{r}")
        r += 1
    place = reached.groupBy("feed", "page_id").agg(F.min("position").alias("position"), F.count(F.lit(1)).alias("times"))
    known = place.join(links.select("feed", "page_id", "segment"), ["feed", "page_id"], "left")
    known = written(known.join(jumps.select("feed", "page_id", "loops"), ["feed", "page_id"], "left"), "known")
    outcome = known.groupBy("feed").agg(
        F.when(F.bool_or((F.col("times") > 1) | F.coalesce("loops", F.lit(False))), F.lit(REPEATED))
         .when(F.bool_or(F.col("segment").isNull()), F.lit(MISSING)).otherwise(F.lit(COMPLETE)).alias("outcome"))
    followed = links.groupBy("feed", "segment").cogroup(
        known.where(F.col("segment").isNotNull()).groupBy("feed", "segment")).applyInArrow(
        _segment_pages, f"feed {feed_type}, page_id string, position long")
    # a loop enters a segment more than once: the first time counts
    # written, so that its size is known to the join with the pages themselves
    return written(followed.groupBy("feed", "page_id").agg(F.min("position").alias("position"))
                   .join(outcome, "feed").select("feed", "page_id", "position", "outcome"), "found")


def check_pages(parsed: DataFrame, order: str = "page_seq") -> tuple[DataFrame, dict]:
    """The pages on the walk from the first one, in its order, and counts; raises the named feed errors."""
    shape = parsed.agg(F.count_if(~F.col("shape_ok")).alias("bad"), F.count(F.lit(1)).alias("pages")).first()
    if shape["bad"]:
        raise FeedError("invalid_response_shape")
    named = parsed.where(F.col("next_cursor").isNotNull()).groupBy("next_cursor").agg(
        (F.min("page_id") != F.max("page_id")).alias("twice")).agg(F.coalesce(F.bool_or("twice"), F.lit(False))).first()[0]
    if named:   # two pages of the set name one cursor
        raise FeedError(REPEATED)
    found = walk(parsed.select(F.lit(0).alias("feed"), "page_id", F.col(order).alias("page_seq"), "next_cursor"))
    end = found.agg(F.max("outcome").alias("outcome"), F.count(F.lit(1)).alias("pages")).first()
    if end["outcome"] in (REPEATED, MISSING):
        raise FeedError(end["outcome"])
    kept = parsed.join(found.select("page_id", "position"), "page_id").withColumn(order, F.col("position")).drop("position")
    return kept, {"pages": end["pages"], "detached": shape["pages"] - end["pages"]}


def explode_records(parsed: DataFrame) -> DataFrame:
    """One row per record: its page's columns, position, record (VARIANT) and canonical text."""
    recs = parsed.select(*[c for c in parsed.columns if c not in ("_v", "shape_ok")],
                         F.posexplode(F.try_variant_get(F.col("_v"), "$.data", "array<variant>"))
                          .alias("pos", "record"))
    return recs.withColumn("payload", F.to_json("record"))   # canonical: sorted keys, compact
