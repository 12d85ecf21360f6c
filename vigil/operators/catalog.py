"""Catalogue operators: channel listings, transcripts, fetch bookkeeping.

Domain column names: listings ``(video_id, title, published_at, channel_id
[, code])``; channels ``(channel_id, channel_title, category, region)``;
transcript segments ``(video_id, start, text)``; assembled transcripts
``(video_id, text)``; skip list ``(video_id)``.

Every "only do what has no result yet" check of the reference becomes a
``left_anti``/``left_semi`` join on the document key, so the whole catalogue
is handled by one shuffle join instead of a file probe per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.text import html_unescape_basic, lower_equals
from vigil.functions.timefn import instant
from vigil.operators.joins import top_k
from vigil.schemas import LISTING_PAGE_SIZE, SEARCH_MAX_RESULTS

VIDEO_KIND = "youtube#video"


# --- filters / projections -------------------------------------------------

def channels_list(channels: DataFrame, category: str = "") -> DataFrame:
    """Channel ids of a category (case-insensitive); '' means all."""
    df = channels
    if category:
        df = df.filter(lower_equals("category", category))
    return df.select("channel_id")


def videos_only(items: DataFrame) -> DataFrame:
    """Search items that are videos -> (video_id, title, published_at).
    The title is not unescaped here (the listing keeps the raw title)."""
    return (items.filter(F.col("id.kind") == VIDEO_KIND)
                 .select(F.col("id.videoId").alias("video_id"),
                         F.col("snippet.title").alias("title"),
                         F.col("snippet.publishedAt").alias("published_at")))


def search_item_fields(items: DataFrame) -> DataFrame:
    """Flatten search items. Non-video items get a null video_id; a null or
    empty snippet gives null snippet fields; text fields are unescaped."""
    sn = F.col("snippet")
    has = sn.isNotNull() & F.coalesce(F.col("snippet.publishedAt").isNotNull()
                                      | F.col("snippet.channelId").isNotNull()
                                      | F.col("snippet.title").isNotNull(), F.lit(False))

    def field(expr, name):
        return F.when(has, expr).alias(name)

    is_video = F.col("id.kind") == VIDEO_KIND
    return items.select(
        F.col("kind"), F.col("etag"),
        F.coalesce(is_video, F.lit(False)).alias("is_video"),
        F.when(is_video, F.col("id.videoId")).alias("video_id"),
        field(F.col("snippet.publishedAt"), "published_date"),
        field(F.col("snippet.channelId"), "channel_id"),
        field(html_unescape_basic(F.col("snippet.title")), "title"),
        field(html_unescape_basic(F.col("snippet.description")), "description"),
        field(F.col("snippet.thumbnails"), "thumbnails"),
        field(html_unescape_basic(F.col("snippet.channelTitle")), "channel_title"),
        field(F.col("snippet.liveBroadcastContent"), "live_broadcast_content"),
        field(F.col("snippet.publishTime"), "publish_time"),
    )


SEARCH_ORDERS = {"date": [("_instant", True), ("video_id", False)],
                 "title": [("title", False), ("video_id", False)]}


def search_filter(listing: DataFrame, search_for: str = "", channel_id: str = "",
                  published_after=None, max_results: int = SEARCH_MAX_RESULTS,
                  order: str = "date") -> DataFrame:
    """A search over the landed catalogue: free text in the title
    (case-insensitive), optional channel, published on/after, ordered by
    ``order`` ('date': newest first, or 'title'; video_id breaks ties),
    ``max_results`` rows (the search's page size). Orders that need data the
    catalogue does not hold (relevance, ratings, view counts) are not offered."""
    if order not in SEARCH_ORDERS:
        raise ValueError(f"order must be one of {sorted(SEARCH_ORDERS)}")
    df = listing
    if search_for:
        df = df.filter(F.lower(F.col("title")).contains(search_for.lower()))
    if channel_id:
        df = df.filter(F.col("channel_id") == F.lit(channel_id))
    if published_after is not None:
        df = df.filter(instant("published_at") >= instant(F.lit(published_after)))
    keys = [F.col(c).desc() if desc else F.col(c) for c, desc in SEARCH_ORDERS[order]]
    return (df.withColumn("_instant", instant("published_at")).orderBy(*keys).limit(max_results)
              .drop("_instant"))


def code_filter(listing: DataFrame) -> DataFrame:
    """Rows whose transcript fetch succeeded."""
    return listing.filter(F.col("code"))


def latest_videos(listing: DataFrame, max_pages: int = 1, per_channel: bool = True,
                  page_size: int = LISTING_PAGE_SIZE) -> DataFrame:
    """Newest ``page_size * max_pages`` videos (per channel by default)."""
    n = page_size * max_pages
    order = [instant("published_at").desc(), F.col("video_id")]
    if per_channel:
        return top_k(listing, ["channel_id"], order, n, rank_col="rank")
    return listing.orderBy(*order).limit(n)


# --- video -> channel lookups ---------------------------------------------

def join_channels(rows: DataFrame, channels: DataFrame, how: str = "left") -> DataFrame:
    """Join the channel dimension on channel_id. One channel may hold a third
    of all rows: adaptive execution splits such a partition."""
    return rows.join(channels, "channel_id", how)


def video_channel(listing: DataFrame) -> DataFrame:
    """One row per video: its first channel (smallest channel_id; the
    reference's file order is arbitrary, so the tie is fixed here) with that
    listing row's title and published_at. One partial+final aggregate."""
    first = F.min(F.struct("channel_id", "published_at", "title")).alias("_f")
    return (listing.groupBy("video_id").agg(first)
                   .select("video_id", "_f.channel_id", "_f.published_at", "_f.title"))


def fetch_channel(videos: DataFrame, listing: DataFrame) -> DataFrame:
    """video_id -> channel_id; '' when the video is in no listing."""
    vc = video_channel(listing).select("video_id", "channel_id")
    return (videos.select("video_id").join(vc, "video_id", "left")
                  .select("video_id", F.coalesce(F.col("channel_id").cast("string"),
                                                 F.lit("")).alias("channel_id")))


def fetch_channel_info(videos: DataFrame, listing: DataFrame, channels: DataFrame) -> DataFrame:
    """video_id -> channel columns; unmatched channels give nulls."""
    vc = fetch_channel(videos, listing)
    return join_channels(vc, channels, "left").select(
        "video_id", "channel_id", "channel_title", "category", "region")


def lookup_video_info(videos: DataFrame, listing: DataFrame, channels: DataFrame) -> DataFrame:
    """Per video: channel id/title/category, published_at and title; '' when
    absent (the reference's defaults)."""
    vc = video_channel(listing)
    ch = channels.select("channel_id", "channel_title", "category")
    df = join_channels(videos.select("video_id").join(vc, "video_id", "left"), ch, "left")
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return df.select("video_id", s("channel_id").alias("channel_id"),
                     s("channel_title").alias("channel_title"),
                     s("category").alias("channel_category"),
                     s("published_at").alias("published_at"), s("title").alias("title"))


# --- fetch bookkeeping (anti / semi joins) --------------------------------

def missing_transcripts(listing: DataFrame, skip: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Videos to fetch: listed, not in the skip list, no stored transcript."""
    ids = listing.select("video_id").distinct()
    return (ids.join(skip.select("video_id"), "video_id", "left_anti")
               .join(transcripts.select("video_id"), "video_id", "left_anti"))


def videos_with_transcripts(listing: DataFrame, skip: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Listing rows whose fetch status is true (not skipped, transcript
    stored), with ``code``; failures leave the listing."""
    return (listing.join(transcripts.select("video_id"), "video_id", "left_semi")
                   .join(skip.select("video_id"), "video_id", "left_anti")
                   .withColumn("code", F.lit(True)))


def missing_enrichments(docs: DataFrame, store: DataFrame, key: str = "video_id",
                        store_key: str | None = None,
                        allowed: DataFrame | None = None) -> DataFrame:
    """Documents without a stored result yet; ``allowed`` (ids) restricts
    the work, e.g. to the videos of one category's channels. Only ids go
    through the anti join; the texts of the few hits are fetched last. A
    document whose id is null is never in a store and stays."""
    sk = store.select(F.col(store_key or key).alias(key))
    ids = docs.select(key).join(sk, key, "left_anti")
    if allowed is not None:
        ids = ids.join(allowed.select(key), key, "left_semi")
    return _fetch(docs, ids, key)


def _fetch(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Whole rows of the given ids; adaptive execution broadcasts the ids
    when they turn out few, and then no text is shuffled."""
    hits = ids.select(F.col(key).alias("_id")).distinct()
    return docs.join(hits, F.col(key).eqNullSafe(F.col("_id")), "left_semi")


def stale_main_topic(classifications: DataFrame, listing: DataFrame) -> DataFrame:
    """Classified, listed videos whose main_topic is absent or ''."""
    return (classifications.join(listing.select("video_id"), "video_id", "left_semi")
                           .filter(F.col("main_topic").isNull() | (F.col("main_topic") == "")))


def orphan_transcripts(transcripts: DataFrame, listing: DataFrame) -> DataFrame:
    """Stored transcripts whose video is in no listing (reported; nothing is
    removed). Ids first, texts last."""
    ids = transcripts.select("video_id").join(listing.select("video_id"), "video_id", "left_anti")
    return _fetch(transcripts, ids, "video_id")


def remove_orphans(spark: SparkSession, folder: str, listing: DataFrame, apply: bool = False) -> DataFrame:
    """(video_id, path, removed) of the transcript files of a legacy folder
    whose video is in no listing; ``apply`` deletes them. Files are found by
    their names; none is opened. The names are decided before the first
    deletion and reach the driver a partition at a time."""
    from vigil.schemas import SUFFIX_TRANSCRIPT
    from vigil.sources import files as FS
    known = listing.select(F.col("video_id").cast("string").alias("source_id"))
    found = FS.document_files(spark, folder, SUFFIX_TRANSCRIPT).join(known, "source_id", "left_anti")
    path = FS.scratch_dir(spark, "orphans")
    FS.write_scratch(found.select(F.col("source_id").alias("video_id"), "path"), path)
    orphans = spark.read.parquet(path)
    if apply:
        for r in orphans.toLocalIterator():
            FS.remove(spark, r["path"])
    return orphans.withColumn("removed", F.lit(apply))


def append_new_listing(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """New page rows not already stored, plus the stored rows, full-row
    distinct. A repeat inside the new batch with another title survives."""
    if old is None:
        return new.dropDuplicates()
    fresh = new.join(old.select("video_id"), "video_id", "left_anti")
    return fresh.unionByName(old, allowMissingColumns=True).dropDuplicates()


def append_to_listing(new: DataFrame, root: str, buckets: int = 64) -> DataFrame:
    """``append_new_listing`` onto a stored listing, partitioned by a hash of
    video_id; returns the stored listing. A page reads and replaces only the
    partitions in which it has new ids, so the whole table is never compared
    row by row. The merged partitions are written aside first; the same page
    again finds no new id and changes nothing."""
    from vigil.sources import files as FS
    spark = new.sparkSession
    bucket = F.pmod(F.xxhash64("video_id"), F.lit(buckets)).cast("int")
    page = new.withColumn("bucket", bucket)
    stage = FS.scratch_dir(spark, "listing_page")
    old = None
    if FS.path_exists(spark, root):
        seen = sorted(r.bucket for r in page.select("bucket").distinct().collect())         # at most ``buckets``
        old = spark.read.parquet(root).filter(F.col("bucket").isin(seen))
        page = page.join(old.select("bucket", "video_id"), ["bucket", "video_id"], "left_anti")
    FS.write_scratch(page.select(*new.columns, "bucket"), f"{stage}-page")
    page = spark.read.parquet(f"{stage}-page")
    if old is not None:
        fresh = sorted(r.bucket for r in page.select("bucket").distinct().collect())
        if not fresh:
            return spark.read.parquet(root).drop("bucket")
        old = spark.read.parquet(root).filter(F.col("bucket").isin(fresh))
    merged = page.dropDuplicates() if old is None else page.unionByName(old, allowMissingColumns=True).dropDuplicates()
    FS.write_scratch(merged, stage)
    (spark.read.parquet(stage).hint("rebalance", "bucket").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("bucket").parquet(root))
    return spark.read.parquet(root).drop("bucket")


def record_status(root: str, skip: DataFrame, transcripts: DataFrame, buckets: int = 64) -> DataFrame:
    """Write the fetch status back to a stored listing (``append_to_listing``):
    rows with a transcript keep their place with ``code`` true, skipped ones
    and ones without a transcript leave. Only partitions in which a status
    changes are replaced. Returns the stored listing."""
    from vigil.sources import files as FS
    spark = skip.sparkSession
    stored = spark.read.parquet(root)
    code = F.col("code").cast("boolean") if "code" in stored.columns else F.lit(None).cast("boolean")
    stored = stored.withColumn("code", code)
    done = videos_with_transcripts(stored.select("video_id", "bucket").distinct(), skip, transcripts).select(
        "bucket", "video_id", F.lit(True).alias("_ok"))
    status = stored.join(done, ["bucket", "video_id"], "left")
    changed = status.filter(F.col("_ok").isNull() | ~F.coalesce(F.col("code"), F.lit(False)))
    touched = sorted(r.bucket for r in changed.select("bucket").distinct().collect())
    if touched:
        stage = FS.scratch_dir(spark, "listing_status")
        kept = status.filter(F.col("bucket").isin(touched) & F.col("_ok")).withColumn("code", F.lit(True)).drop("_ok")
        FS.write_scratch(kept, stage)
        rows = spark.read.parquet(stage)
        (rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("compression", "gzip").partitionBy("bucket").parquet(root))
        left = {r.bucket for r in rows.select("bucket").distinct().collect()}
        for b in touched:                       # a partition without rows is not overwritten
            if b not in left:
                FS.remove(spark, f"{root}/bucket={b}")
    return spark.read.schema(stored.schema).parquet(root).drop("bucket")


# --- transcript assembly -------------------------------------------------

def assemble_text(segments: DataFrame, key: str = "video_id", order: str = "start",
                  text: str = "text") -> DataFrame:
    """Segments joined with ' ' in ``order`` -> one row per document.
    collect_list runs partial aggregation map-side; the sort is explicit."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return segments.groupBy(key).agg(
        F.array_join(F.transform(parts, lambda x: x["t"]), " ").alias(text))
