"""Registered queries: one per operator of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the driver's tables (whole tables,
whole texts), with the equivalent DuckDB SQL where SQL can express it.

Parameters below are the queries' own arguments (as a user would pass
them); none of them limits the input rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import schemas as S
from vigil.functions import text as X
from vigil.functions import timefn as TM
from vigil.operators import analysis as A
from vigil.operators import batch as BT
from vigil.operators import catalog as C
from vigil.operators import enrich as N
from vigil.operators import entities as E
from vigil.operators import index as IX
from vigil.plans import standins as SI
from vigil.plans.standins import with_ctes
from vigil.sources import files as FS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Query arguments.
AS_OF = "2024-01-31 00:00:00"
DAYS = 29
AFTER_DATE = "2024-01-02"
CATEGORY = "building"
SEARCH_FOR = "view"
PUBLISHED_AFTER = "2024-01-15T00:00:00Z"
ENTITY_TYPE = "CARDINAL"
ENTITY_NAME = "elle"
ENTITY_PATTERN = "^ou[a-z]+"
ENTITY_LIST = ["^the", "ouen", "^ell", "^the"]
CHUNK_LIMIT = 1000
TOPICS_K = 3
SUMMARY_N = 2

EMOTION_LEXICON = [("that", "joy", 1.0), ("with", "love", 1.0), ("this", "anger", 1.5),
                   ("from", "fear", 1.0), ("tion", "sadness", 1.0), ("than", "surprise", 1.0),
                   ("pour", "joy", 2.0), ("dans", "fear", 2.0), ("sich", "sadness", 2.0),
                   ("then", "anger", 1.0)]
SECONDARY_LEXICON = [("ther", "optimism", 1.0), ("thin", "pride", 1.0), ("erin", "relief", 1.0),
                     ("eren", "zest", 1.0), ("thor", "envy", 1.0), ("then", "shame", 1.0)]
SENTIMENT_LEXICON = [("that", 1.0), ("with", -1.0), ("this", 1.0), ("from", -1.5),
                     ("than", -1.0), ("pour", 1.0), ("dans", -1.0), ("sich", 0.5)]


def _values_sql(rows, cols) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else repr(float(v))
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def emotion_lexicon(spark):
    return spark.createDataFrame(EMOTION_LEXICON, "term string, label string, weight double")


def secondary_lexicon(spark):
    return spark.createDataFrame(SECONDARY_LEXICON, "term string, label string, weight double")


def sentiment_lexicon(spark):
    return spark.createDataFrame(SENTIMENT_LEXICON, "term string, weight double")


T = SI.table

# ===========================================================================
# 2.1 scans / sources / sinks
# ===========================================================================


@query("read_channels", with_ctes("channels") + "SELECT * FROM channels")
def q_read_channels(spark, d):
    path = FS.scratch_dir(spark, "channels_csv")
    SI.channels(spark, d).write.option("header", True).csv(path)
    return FS.read_channels(spark, path)


@query("read_transcripts", with_ctes("segments") + """
SELECT CAST(video_id AS VARCHAR) AS video_id, string_agg(text, ' ' ORDER BY start) AS text
FROM segments GROUP BY video_id""")
def q_read_transcripts(spark, d):
    folder = FS.scratch_dir(spark, "transcripts")
    seg = SI.segments(spark, d).select("video_id", F.col("start").cast("double").alias("start"),
                                       F.lit(None).cast("double").alias("duration"), "text")
    FS.write_per_document(seg, "video_id", folder, S.SUFFIX_TRANSCRIPT)
    return C.assemble_text(FS.read_transcripts(spark, folder))


@query("read_classifications", with_ctes("classifications") + """
SELECT CAST(c.video_id AS VARCHAR) AS video_id, c.summary, c.summary_reasoning, c.sentiment,
       c.primary_emotion, c.secondary_emotion,
       CASE WHEN l.toxic = 1 OR c.main_topic IN ('', 'None') THEN NULL ELSE c.main_topic END
         AS main_topic
FROM classifications c JOIN labels l ON l.doc_id = c.video_id""")
def q_read_classifications(spark, d):
    folder = FS.scratch_dir(spark, "classifications")
    c = SI.classifications(spark, d).join(
        T(spark, d, "labels").select(F.col("doc_id").alias("video_id"), "toxic"), "video_id")
    # older records (toxic stand-in) were written before main_topic existed
    FS.write_per_document(c.filter("toxic = 1").drop("toxic", "main_topic"), "video_id",
                          folder, S.SUFFIX_CLASSIFICATION)
    FS.write_per_document(c.filter("toxic <> 1").drop("toxic"), "video_id",
                          folder, S.SUFFIX_CLASSIFICATION)
    return FS.read_classifications(spark, folder)


@query("read_channel_search", with_ctes("listing") + """
SELECT CAST(video_id AS VARCHAR) AS video_id, title, published_at, channel_id,
       CAST(NULL AS BOOLEAN) AS code
FROM listing""")
def q_read_channel_search(spark, d):
    folder = FS.scratch_dir(spark, "channels")
    lst = SI.listing(spark, d).withColumn("video_id", F.col("video_id").cast("string"))
    FS.write_per_document(lst, "channel_id", folder, S.SUFFIX_SEARCH)
    return FS.read_channel_search(spark, folder)


ENTITY_FILE_SQL = with_ctes("entity_index") + """
SELECT entity_type, value, CAST(source_id AS VARCHAR) AS source_id FROM entity_index"""


@query("read_entities", ENTITY_FILE_SQL)
def q_read_entities(spark, d):
    folder = FS.scratch_dir(spark, "entities")
    FS.write_per_document(SI.entity_index(spark, d), "source_id", folder, S.SUFFIX_ENTITIES)
    return FS.read_entities(spark, folder)


@query("read_index", with_ctes("library_index") + """
SELECT lib_key, CAST(source_id AS VARCHAR) AS source_id, rec_mod_dtm, doc_type_id,
       source_system_id, path, summary, summary_reasoning, sentiment, primary_emotion,
       secondary_emotion, main_topic
FROM library_index""")
def q_read_index(spark, d):
    root = FS.scratch_dir(spark, "store")
    FS.write_version(FS.conform(SI.library_index(spark, d), S.LIBRARY_INDEX),
                     f"{root}/library_index")
    return FS.read_index(spark, root)


@query("file_inventory", with_ctes("listing") + "SELECT DISTINCT channel_id AS source_id FROM listing")
def q_file_inventory(spark, d):
    """One listing file per channel, written from the events; sizes and times
    of the files differ by machine, so the key is what is compared."""
    folder = FS.scratch_dir(spark, "inventory")
    FS.write_per_document(SI.listing(spark, d), "channel_id", folder, S.SUFFIX_SEARCH)
    return FS.file_inventory(spark, folder, S.SUFFIX_SEARCH).select("source_id")


@query("init_store", "SELECT CAST(doc_id AS VARCHAR) AS video_id, CAST(0 AS BIGINT) AS index_rows "
       "FROM labels WHERE toxic = 1")
def q_init_store(spark, d):
    """An empty store, then the skip list appended to it; the index is empty."""
    root = FS.scratch_dir(spark, "init")
    FS.init_store(spark, root)
    FS.append_skip_list(spark, SI.skip_list(spark, d), root)
    empty = FS.read_index(spark, root).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return FS.read_skip_list(spark, f"{root}/transcript_skip").withColumn("index_rows", F.lit(empty).cast("long"))


def _search_items(spark, d) -> DataFrame:
    """Search items (struct columns) derived from events: signups are
    channel items (no videoId), errors have no snippet."""
    e = T(spark, d, "events")
    is_video = F.col("event_type") != "signup"
    snippet = F.struct(
        F.date_format("ts", SI.ISO_FMT).alias("publishedAt"),
        F.col("user_id").cast("string").alias("channelId"),
        F.concat(F.col("event_type"), F.lit(" &amp; news &#39;")).alias("title"),
        F.col("props").alias("description"),
        F.create_map(F.lit("default"), F.struct(
            F.lit("https://i.example/x.jpg").alias("url"), F.lit(120).cast("long").alias("width"),
            F.lit(90).cast("long").alias("height"))).alias("thumbnails"),
        F.concat(F.lit("channel "), F.col("user_id").cast("string")).alias("channelTitle"),
        F.lit("none").alias("liveBroadcastContent"),
        F.date_format("ts", SI.ISO_FMT).alias("publishTime"))
    return e.select(
        F.col("event_id"), F.col("user_id"),
        F.lit("youtube#searchResult").alias("kind"),
        F.concat(F.lit("etag"), F.col("event_id").cast("string")).alias("etag"),
        F.struct(F.when(is_video, F.lit("youtube#video")).otherwise(F.lit("youtube#channel"))
                  .alias("kind"),
                 F.when(is_video, F.col("event_id").cast("string")).alias("videoId"),
                 F.when(~is_video, F.col("user_id").cast("string")).alias("channelId"))
         .alias("id"),
        F.when(F.col("event_type") != "error", snippet).alias("snippet"))


ITEM_FIELDS_SQL = """
SELECT 'youtube#searchResult' AS kind, 'etag' || CAST(event_id AS VARCHAR) AS etag,
       event_type <> 'signup' AS is_video,
       CASE WHEN event_type <> 'signup' THEN CAST(event_id AS VARCHAR) END AS video_id,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS published_date,
       CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS channel_id,
       CASE WHEN event_type <> 'error' THEN event_type || ' & news ''' END AS title,
       CASE WHEN event_type <> 'error' THEN props END AS description,
       CASE WHEN event_type <> 'error' THEN 'channel ' || CAST(user_id AS VARCHAR) END
         AS channel_title,
       CASE WHEN event_type <> 'error' THEN 'none' END AS live_broadcast_content,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS publish_time
FROM events"""


@query("read_search_pages", ITEM_FIELDS_SQL)
def q_read_search_pages(spark, d):
    path = FS.scratch_dir(spark, "search_pages")
    items = _search_items(spark, d)
    # one response page per (channel, block of 50 consecutive ids): <= 50 items
    pages = (items.groupBy("user_id", F.floor(F.col("event_id") / 50).alias("blk"))
                  .agg(F.collect_list(F.struct("kind", "etag", "id", "snippet")).alias("items"))
                  .select(F.lit("youtube#searchListResponse").alias("kind"),
                          F.concat(F.lit("p"), F.col("user_id").cast("string"), F.lit("-"),
                                   F.col("blk").cast("string")).alias("etag"),
                          F.lit("CA").alias("regionCode"), "items"))
    pages.write.json(path)
    flat = C.search_item_fields(FS.read_search_pages(spark, path))
    return flat.drop("thumbnails")


@query("write_table", with_ctes("listing") + "SELECT * FROM listing")
def q_write_table(spark, d):
    path = FS.scratch_dir(spark, "listing_gzip")
    FS.write_table(SI.listing(spark, d), path)
    return spark.read.parquet(path)


@query("read_skip_list", """
SELECT DISTINCT CAST(doc_id AS VARCHAR) AS video_id FROM labels WHERE toxic = 1""")
def q_read_skip_list(spark, d):
    root = FS.scratch_dir(spark, "skip")
    FS.init_store(spark, root)
    ids = SI.skip_list(spark, d)
    FS.append_skip_list(spark, ids, root)
    FS.append_skip_list(spark, ids, root)  # appended twice: the reader de-duplicates
    return FS.read_skip_list(spark, f"{root}/transcript_skip")


# ===========================================================================
# 2.2 projections / filters
# ===========================================================================


@query("channels_list", with_ctes("channels") + f"""
SELECT channel_id FROM channels WHERE lower(category) = lower('{CATEGORY}')""")
def q_channels_list(spark, d):
    return C.channels_list(SI.channels(spark, d), CATEGORY)


@query("videos_only", """
SELECT CAST(event_id AS VARCHAR) AS video_id,
       CASE WHEN event_type <> 'error' THEN event_type || ' &amp; news &#39;' END AS title,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS published_at
FROM events WHERE event_type <> 'signup'""")
def q_videos_only(spark, d):
    return C.videos_only(_search_items(spark, d))


@query("search_item_fields", ITEM_FIELDS_SQL)
def q_search_item_fields(spark, d):
    return C.search_item_fields(_search_items(spark, d)).drop("thumbnails")


@query("search_filter", with_ctes("listing") + f"""
SELECT * FROM listing
WHERE contains(lower(title), '{SEARCH_FOR}') AND published_at >= '{PUBLISHED_AFTER}'
ORDER BY published_at DESC, video_id LIMIT {S.SEARCH_MAX_RESULTS}""")
def q_search_filter(spark, d):
    return C.search_filter(SI.listing(spark, d), search_for=SEARCH_FOR,
                           published_after=PUBLISHED_AFTER)


@query("entity_type_filter", with_ctes("entity_index") + f"""
SELECT * FROM entity_index WHERE entity_type = '{ENTITY_TYPE}'""")
def q_entity_type_filter(spark, d):
    return E.entity_type_filter(SI.entity_index(spark, d), ENTITY_TYPE)


STATUS_SQL = with_ctes("listing", "transcripts", "skip_list") + """
SELECT l.*, true AS code FROM listing l
WHERE l.video_id IN (SELECT video_id FROM transcripts)
  AND l.video_id NOT IN (SELECT video_id FROM skip_list)"""


@query("code_filter", STATUS_SQL)
def q_code_filter(spark, d):
    lst = SI.listing(spark, d)
    skip = SI.skip_list(spark, d).withColumn("_s", F.lit(True))
    have = SI.transcripts(spark, d).select("video_id").withColumn("_t", F.lit(True))
    status = (lst.join(skip, "video_id", "left").join(have, "video_id", "left")
                 .withColumn("code", F.when(F.col("_s"), False).when(F.col("_t"), True))
                 .drop("_s", "_t"))
    return C.code_filter(status)


INDEX_COLS = [f.name for f in S.LIBRARY_INDEX.fields]


@query("nonempty_profile", with_ctes("library_index") + "SELECT "
       + ", ".join(f"count({c}) AS {c}" for c in INDEX_COLS)
       + " FROM library_index WHERE main_topic > ''")
def q_nonempty_profile(spark, d):
    return A.nonempty_profile(SI.library_index(spark, d))


@query("drop_columns", with_ctes("library_index") + "SELECT "
       + ", ".join(c for c in INDEX_COLS if c not in A.INDEX_DROPPED) + " FROM library_index")
def q_drop_columns(spark, d):
    return SI.library_index(spark, d).drop(*A.INDEX_DROPPED)


@query("rename_columns", with_ctes("channels") + """
SELECT channel_id, channel_title AS channel, category, region FROM channels""")
def q_rename_columns(spark, d):
    return SI.channels(spark, d).withColumnRenamed("channel_title", "channel")


@query("not_none_topic", with_ctes("topic_index") + "SELECT * FROM topic_index WHERE topic <> 'none'")
def q_not_none_topic(spark, d):
    return SI.topic_index(spark, d).filter(F.col("topic") != "none")


# ===========================================================================
# 2.3 joins
# ===========================================================================

VIDEO_CHANNEL_SQL = """video_channel AS (
  SELECT video_id, min({'c': channel_id, 'p': published_at, 't': title}) AS f
  FROM listing GROUP BY video_id),
videos AS (SELECT o_orderkey AS video_id FROM orders)"""


def _videos(spark, d):
    """Video ids referenced by orders: a mix of listed and unlisted ids."""
    return T(spark, d, "orders").select(F.col("o_orderkey").alias("video_id"))


@query("fetch_channel", with_ctes("listing") + "," + VIDEO_CHANNEL_SQL + """
SELECT v.video_id, coalesce(vc.f.c, '') AS channel_id
FROM videos v LEFT JOIN video_channel vc ON vc.video_id = v.video_id""")
def q_fetch_channel(spark, d):
    return C.fetch_channel(_videos(spark, d), SI.listing(spark, d))


@query("fetch_channel_info", with_ctes("listing", "channels") + "," + VIDEO_CHANNEL_SQL + """
SELECT v.video_id, coalesce(vc.f.c, '') AS channel_id, c.channel_title, c.category, c.region
FROM videos v LEFT JOIN video_channel vc ON vc.video_id = v.video_id
LEFT JOIN channels c ON c.channel_id = coalesce(vc.f.c, '')""")
def q_fetch_channel_info(spark, d):
    return C.fetch_channel_info(_videos(spark, d), SI.listing(spark, d), SI.channels(spark, d))


@query("lookup_video_info", with_ctes("listing", "channels") + "," + VIDEO_CHANNEL_SQL + """
SELECT v.video_id, coalesce(vc.f.c, '') AS channel_id,
       coalesce(c.channel_title, '') AS channel_title,
       coalesce(c.category, '') AS channel_category,
       coalesce(vc.f.p, '') AS published_at, coalesce(vc.f.t, '') AS title
FROM videos v LEFT JOIN video_channel vc ON vc.video_id = v.video_id
LEFT JOIN channels c ON c.channel_id = vc.f.c""")
def q_lookup_video_info(spark, d):
    return C.lookup_video_info(_videos(spark, d), SI.listing(spark, d), SI.channels(spark, d))


VIDEO_ANALYSIS_CTE = """video_analysis AS (
  SELECT l.video_id, l.title,
         strptime(l.published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
         c.channel_title, c.category, c.region,
         i.rec_mod_dtm, i.summary, i.sentiment, i.primary_emotion, i.secondary_emotion,
         i.main_topic,
         CAST((strptime(l.published_at, '%Y-%m-%dT%H:%M:%SZ') AT TIME ZONE 'UTC')
              AT TIME ZONE 'US/Eastern' AS DATE) AS publish_dt_et
  FROM listing l JOIN channels c ON c.channel_id = l.channel_id
  JOIN library_index i ON i.source_id = l.video_id)"""
VA_SQL = with_ctes("listing", "channels", "library_index") + "," + VIDEO_ANALYSIS_CTE


def _video_analysis(spark, d):
    return A.video_analysis(SI.listing(spark, d), SI.channels(spark, d),
                            SI.library_index(spark, d))


@query("video_analysis", VA_SQL + "\nSELECT * FROM video_analysis")
def q_video_analysis(spark, d):
    return _video_analysis(spark, d)


MART_COLS = ("v.title, v.published_at, v.channel_title, v.category, v.region, v.rec_mod_dtm, "
             "v.summary, v.sentiment, v.primary_emotion, v.secondary_emotion, v.main_topic, "
             "v.publish_dt_et")


@query("entity_analysis", with_ctes("listing", "channels", "library_index", "entity_index")
       + "," + VIDEO_ANALYSIS_CTE + f"""
SELECT e.entity_type, e.value, e.source_id, {MART_COLS}
FROM entity_index e JOIN video_analysis v ON v.video_id = e.source_id""")
def q_entity_analysis(spark, d):
    return A.entity_analysis(SI.entity_index(spark, d), _video_analysis(spark, d))


TOPIC_MART_SQL = with_ctes("listing", "channels", "library_index", "topic_index") + "," \
    + VIDEO_ANALYSIS_CTE + f""",
topic_analysis AS (
  SELECT t.topic, t.source_id, {MART_COLS}
  FROM topic_index t JOIN video_analysis v ON v.video_id = t.source_id)"""


def _topic_analysis(spark, d):
    return A.topic_analysis(SI.topic_index(spark, d), _video_analysis(spark, d))


@query("topic_analysis", TOPIC_MART_SQL + "\nSELECT * FROM topic_analysis")
def q_topic_analysis(spark, d):
    return _topic_analysis(spark, d)


@query("videos_containing_entity", with_ctes("entity_index") + f"""
SELECT DISTINCT source_id FROM entity_index WHERE lower(value) = '{ENTITY_NAME}'""")
def q_videos_containing_entity(spark, d):
    return E.videos_containing_entity(SI.entity_index(spark, d), ENTITY_NAME)


COLLECT_TAIL = """,
hits AS ({hits}),
docs AS (SELECT DISTINCT source_id AS video_id FROM hits),
video_channel AS (
  SELECT video_id, min({{'c': channel_id, 'p': published_at, 't': title}}) AS f
  FROM listing GROUP BY video_id),
info AS (
  SELECT d.video_id, coalesce(vc.f.c, '') AS channel_id, c.channel_title, c.category, c.region
  FROM docs d LEFT JOIN video_channel vc ON vc.video_id = d.video_id
  LEFT JOIN channels c ON c.channel_id = coalesce(vc.f.c, ''))
SELECT i.*, info.channel_id, info.channel_title, info.category, info.region, {entity}
FROM library_index i JOIN hits h ON h.source_id = i.source_id
LEFT JOIN info ON info.video_id = i.source_id{extra}"""


@query("collect_data_containing_entity",
       with_ctes("listing", "channels", "library_index", "entity_index") + COLLECT_TAIL.format(
           hits=f"SELECT DISTINCT source_id FROM entity_index "
                f"WHERE regexp_matches(lower(value), '{ENTITY_PATTERN}')",
           entity=f"'{ENTITY_PATTERN}' AS entity", extra=""))
def q_collect_data_containing_entity(spark, d):
    return E.collect_data_containing_entity(
        SI.entity_index(spark, d), SI.library_index(spark, d), SI.listing(spark, d),
        SI.channels(spark, d), ENTITY_PATTERN)


_PATS = ", ".join(f"({i}, '{p}')" for i, p in enumerate(ENTITY_LIST))


@query("collect_multi_entity_data",
       with_ctes("listing", "channels", "library_index", "entity_index") + f""",
pats AS (SELECT * FROM (VALUES {_PATS}) AS t(pattern_pos, entity))""" + COLLECT_TAIL.format(
           hits="SELECT DISTINCT e.source_id, p.pattern_pos FROM entity_index e "
                "JOIN pats p ON regexp_matches(lower(e.value), p.entity)",
           entity="p.entity",
           extra="\nJOIN pats p ON p.pattern_pos = h.pattern_pos"))
def q_collect_multi_entity_data(spark, d):
    return E.collect_multi_entity_data(
        SI.entity_index(spark, d), SI.library_index(spark, d), SI.listing(spark, d),
        SI.channels(spark, d), ENTITY_LIST)


@query("missing_transcripts", with_ctes("listing", "skip_list", "transcripts") + """
SELECT DISTINCT video_id FROM listing
WHERE video_id NOT IN (SELECT video_id FROM skip_list)
  AND video_id NOT IN (SELECT video_id FROM transcripts)""")
def q_missing_transcripts(spark, d):
    return C.missing_transcripts(SI.listing(spark, d), SI.skip_list(spark, d),
                                 SI.transcripts(spark, d))


@query("videos_with_transcripts", STATUS_SQL)
def q_videos_with_transcripts(spark, d):
    return C.videos_with_transcripts(SI.listing(spark, d), SI.skip_list(spark, d),
                                     SI.transcripts(spark, d))


@query("missing_enrichments", with_ctes("listing", "channels", "transcripts", "classifications")
       + f"""
SELECT t.* FROM transcripts t
WHERE t.video_id NOT IN (SELECT video_id FROM classifications)
  AND t.video_id IN (SELECT l.video_id FROM listing l JOIN channels c
                     ON c.channel_id = l.channel_id
                     WHERE lower(c.category) = lower('{CATEGORY}'))""")
def q_missing_enrichments(spark, d):
    lst = SI.listing(spark, d)
    chans = C.channels_list(SI.channels(spark, d), CATEGORY)
    allowed = lst.join(chans, "channel_id", "left_semi").select("video_id")
    return C.missing_enrichments(SI.transcripts(spark, d), SI.classifications(spark, d),
                                 allowed=allowed)


@query("stale_main_topic", with_ctes("classifications", "listing") + """
SELECT * FROM classifications
WHERE video_id IN (SELECT video_id FROM listing) AND (main_topic IS NULL OR main_topic = '')""")
def q_stale_main_topic(spark, d):
    return C.stale_main_topic(SI.classifications(spark, d), SI.listing(spark, d))


@query("orphan_transcripts", with_ctes("transcripts", "listing", "channels") + f"""
SELECT * FROM transcripts WHERE video_id NOT IN (
  SELECT l.video_id FROM listing l JOIN channels c ON c.channel_id = l.channel_id
  WHERE lower(c.category) = lower('{CATEGORY}'))""")
def q_orphan_transcripts(spark, d):
    # listing restricted to one category's channels, as after dropping channels
    lst = SI.listing(spark, d).join(C.channels_list(SI.channels(spark, d), CATEGORY),
                                    "channel_id", "left_semi")
    return C.orphan_transcripts(SI.transcripts(spark, d), lst)


@query("cleaned_entities", with_ctes("entity_index") + "SELECT * FROM entity_index")
def q_cleaned_entities(spark, d):
    return SI.entity_index(spark, d)


# ===========================================================================
# 2.4 aggregations
# ===========================================================================

ASSEMBLE_SQL = with_ctes("segments") + """
SELECT video_id, string_agg(text, ' ' ORDER BY start, text) AS text
FROM segments GROUP BY video_id"""


@query("assemble_text", ASSEMBLE_SQL)
def q_assemble_text(spark, d):
    return C.assemble_text(SI.segments(spark, d))


@query("unique_entities", with_ctes("unique_entities") + "SELECT * FROM unique_entities")
def q_unique_entities(spark, d):
    docs = T(spark, d, "documents")
    return E.unique_entities(E.extract_entities(docs, "doc_id", "text",
                                                proper_noun_type="PERSON"))


TOPICS_BY_CHANNEL_CTE = f""",
windowed AS (
  SELECT *, CAST((published_at AT TIME ZONE 'UTC') AT TIME ZONE 'US/Eastern' AS DATE)
              AS published_date_et
  FROM topic_analysis
  WHERE published_at >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY),
topics_by_channel AS (
  SELECT topic, channel_title AS channel, primary_emotion, secondary_emotion,
         published_date_et, count(title) AS videos
  FROM windowed
  WHERE topic <> 'none' AND topic IS NOT NULL AND channel_title IS NOT NULL
    AND primary_emotion IS NOT NULL AND secondary_emotion IS NOT NULL
    AND published_date_et IS NOT NULL
  GROUP BY ALL)"""


def _topics_by_channel(spark, d):
    return A.topics_by_channel(_topic_analysis(spark, d), AS_OF, DAYS)


@query("topics_by_channel", TOPIC_MART_SQL + TOPICS_BY_CHANNEL_CTE
       + "\nSELECT * FROM topics_by_channel")
def q_topics_by_channel(spark, d):
    return _topics_by_channel(spark, d)


@query("emotions_over_time", TOPIC_MART_SQL + TOPICS_BY_CHANNEL_CTE + f"""
SELECT published_date_et, primary_emotion, channel, topic, CAST(sum(videos) AS BIGINT) AS videos
FROM topics_by_channel WHERE published_date_et > DATE '{AFTER_DATE}'
GROUP BY ALL""")
def q_emotions_over_time(spark, d):
    return A.emotions_over_time(_topics_by_channel(spark, d), AFTER_DATE)


CHUNK_LABELS_SQL = """
SELECT conv_id AS video_id,
       string_agg(text, ',' ORDER BY turn) AS summary,
       string_agg(role, ',' ORDER BY turn) AS summary_reasoning,
       CASE WHEN sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END)
                 > sum(CASE WHEN role <> 'user' THEN 1 ELSE 0 END) THEN true
            WHEN sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END)
                 < sum(CASE WHEN role <> 'user' THEN 1 ELSE 0 END) THEN false
            ELSE arg_min(role = 'user', turn) END AS sentiment,
       string_agg(role, ',' ORDER BY turn) AS primary_emotion,
       string_agg(upper(role), ',' ORDER BY turn) AS secondary_emotion,
       array_to_string(list_sort(list_distinct(list(role))), ' and ') AS main_topic,
       count(*) AS chunks
FROM conversations GROUP BY conv_id"""


@query("merge_chunk_labels", CHUNK_LABELS_SQL)
def q_merge_chunk_labels(spark, d):
    cv = T(spark, d, "conversations")
    chunks = cv.select(F.col("conv_id").alias("video_id"), F.col("turn").alias("chunk_id"),
                       F.col("text").alias("summary"), F.col("role").alias("summary_reasoning"),
                       (F.col("role") == "user").alias("sentiment"),
                       F.col("role").alias("primary_emotion"),
                       F.upper("role").alias("secondary_emotion"),
                       F.col("role").alias("main_topic"))
    return N.merge_chunk_labels(chunks)


@query("distinct_ids", with_ctes("entity_index") + "SELECT DISTINCT source_id FROM entity_index")
def q_distinct_ids(spark, d):
    return SI.entity_index(spark, d).select("source_id").distinct()


@query("new_file_count", with_ctes("transcripts", "classifications", "topic_index") + """
SELECT 'classifications' AS kind, count(*) AS new_files FROM transcripts
WHERE video_id NOT IN (SELECT video_id FROM classifications)
UNION ALL
SELECT 'topics', count(*) FROM transcripts
WHERE video_id NOT IN (SELECT source_id FROM topic_index WHERE topic <> 'none')""")
def q_new_file_count(spark, d):
    tr = SI.transcripts(spark, d)
    a = C.missing_enrichments(tr, SI.classifications(spark, d))
    b = C.missing_enrichments(tr, SI.topic_index(spark, d).filter("topic <> 'none'"),
                              store_key="source_id")
    return (a.agg(F.count(F.lit(1)).alias("new_files")).select(F.lit("classifications").alias("kind"), "new_files")
             .unionByName(b.agg(F.count(F.lit(1)).alias("new_files"))
                           .select(F.lit("topics").alias("kind"), "new_files")))


# ===========================================================================
# 2.6 sorts / top-k
# ===========================================================================


@query("sorted_topics", TOPIC_MART_SQL + TOPICS_BY_CHANNEL_CTE
       + "\nSELECT * FROM topics_by_channel ORDER BY published_date_et, topic, channel")
def q_sorted_topics(spark, d):
    return A.sorted_topics(_topics_by_channel(spark, d))


@query("latest_videos", with_ctes("listing") + f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY published_at DESC, video_id)
              AS rank
  FROM listing) WHERE rank <= {S.LISTING_PAGE_SIZE}""")
def q_latest_videos(spark, d):
    return C.latest_videos(SI.listing(spark, d), max_pages=1)


# ===========================================================================
# 2.7 set operations and table maintenance
# ===========================================================================

UPSERT_CTES = """,
cur AS (SELECT * FROM library_index WHERE source_id IN (SELECT doc_id FROM labels)),
inc AS (
  SELECT i.source_id,
         CASE WHEN l.toxic = 1 THEN '2024-03-01 00:00:00' ELSE i.rec_mod_dtm END AS rec_mod_dtm,
         i.doc_type_id, i.source_system_id, i.path, 'v2' AS summary, i.summary_reasoning,
         i.sentiment, i.primary_emotion, i.secondary_emotion, i.main_topic
  FROM library_index i LEFT JOIN labels l ON l.doc_id = i.source_id),
j AS (
  SELECT coalesce(c.path, n.path) AS path, c.lib_key AS ck,
         CASE WHEN n.path IS NULL THEN 'keep' WHEN c.path IS NULL THEN 'insert'
              WHEN c.rec_mod_dtm IS NOT DISTINCT FROM n.rec_mod_dtm
               AND c.sentiment IS NOT DISTINCT FROM n.sentiment
               AND c.primary_emotion IS NOT DISTINCT FROM n.primary_emotion
               AND c.main_topic IS NOT DISTINCT FROM n.main_topic THEN 'keep'
              ELSE 'update' END AS action,
         c AS cr, n AS nr
  FROM cur c FULL JOIN inc n ON c.path = n.path),
upserted AS (
  SELECT CASE WHEN action = 'insert'
              THEN (SELECT max(lib_key) FROM cur)
                   + row_number() OVER (PARTITION BY action ORDER BY path)
              ELSE ck END AS lib_key,
         CASE WHEN action = 'keep' THEN cr.source_id ELSE nr.source_id END AS source_id,
         CASE WHEN action = 'keep' THEN cr.rec_mod_dtm ELSE nr.rec_mod_dtm END AS rec_mod_dtm,
         CASE WHEN action = 'keep' THEN cr.doc_type_id ELSE nr.doc_type_id END AS doc_type_id,
         CASE WHEN action = 'keep' THEN cr.source_system_id ELSE nr.source_system_id END
           AS source_system_id,
         path,
         CASE WHEN action = 'keep' THEN cr.summary ELSE nr.summary END AS summary,
         CASE WHEN action = 'keep' THEN cr.summary_reasoning ELSE nr.summary_reasoning END
           AS summary_reasoning,
         CASE WHEN action = 'keep' THEN cr.sentiment ELSE nr.sentiment END AS sentiment,
         CASE WHEN action = 'keep' THEN cr.primary_emotion ELSE nr.primary_emotion END
           AS primary_emotion,
         CASE WHEN action = 'keep' THEN cr.secondary_emotion ELSE nr.secondary_emotion END
           AS secondary_emotion,
         CASE WHEN action = 'keep' THEN cr.main_topic ELSE nr.main_topic END AS main_topic,
         action
  FROM j)"""
UPSERT_SQL = with_ctes("library_index") + UPSERT_CTES + "\nSELECT * FROM upserted"


def _upsert_inputs(spark, d):
    li = SI.library_index(spark, d)
    lb = T(spark, d, "labels").select(F.col("doc_id").alias("source_id"), "toxic")
    current = li.join(lb.select("source_id"), "source_id", "left_semi")
    incoming = (li.join(lb, "source_id", "left")
                  .withColumn("rec_mod_dtm", F.when(F.col("toxic") == 1, "2024-03-01 00:00:00")
                              .otherwise(F.col("rec_mod_dtm")))
                  .withColumn("summary", F.lit("v2")).drop("toxic", "lib_key"))
    return current, incoming


@query("upsert_index", UPSERT_SQL)
def q_upsert_index(spark, d):
    current, incoming = _upsert_inputs(spark, d)
    return IX.upsert_index(current, incoming)


REFRESH_SQL = with_ctes("listing", "segments", "classifications") + f""",
inv AS (
  SELECT DISTINCT 'channels/' || channel_id || '{S.SUFFIX_SEARCH}' AS path, channel_id AS source_id,
         {S.DOC_TYPES["youtube channel search"]} AS doc_type_id FROM listing
  UNION ALL
  SELECT DISTINCT 'transcripts/' || CAST(video_id AS VARCHAR) || '{S.SUFFIX_TRANSCRIPT}',
         CAST(video_id AS VARCHAR), {S.DOC_TYPES["transcript"]} FROM segments)
SELECT row_number() OVER (ORDER BY i.path) AS lib_key, i.source_id, i.doc_type_id,
       {S.SOURCE_SYSTEMS["youtube"]} AS source_system_id, i.path, c.summary, c.summary_reasoning,
       coalesce(c.sentiment, false) AS sentiment, c.primary_emotion, c.secondary_emotion,
       nullif(c.main_topic, '') AS main_topic, 'insert' AS action
FROM inv i LEFT JOIN classifications c ON CAST(c.video_id AS VARCHAR) = i.source_id"""


@query("refresh_index", REFRESH_SQL)
def q_refresh_index(spark, d):
    """A store laid out as the reference keeps it (one listing file per
    channel, one transcript and classification file per video), derived
    from the driver's tables, then scanned and upserted into the index.
    rec_mod_dtm (the files' modification time) and the store's own folder are
    left out, since they differ by run."""
    root = FS.scratch_dir(spark, "store")
    FS.init_store(spark, root)
    lst = SI.listing(spark, d).withColumn("video_id", F.col("video_id").cast("string"))
    FS.write_per_document(lst, "channel_id", f"{root}/channels", S.SUFFIX_SEARCH)
    seg = SI.segments(spark, d).select(F.col("video_id").cast("string").alias("video_id"),
                                       F.col("start").cast("double").alias("start"),
                                       F.lit(None).cast("double").alias("duration"), "text")
    FS.write_per_document(seg, "video_id", f"{root}/transcripts", S.SUFFIX_TRANSCRIPT)
    clf = SI.classifications(spark, d).withColumn("video_id", F.col("video_id").cast("string"))
    FS.write_per_document(clf, "video_id", f"{root}/classifications", S.SUFFIX_CLASSIFICATION)
    path = F.regexp_extract("path", "/((?:channels|transcripts)/[^/]*)$", 1)
    return IX.refresh_index(spark, root).drop("rec_mod_dtm").withColumn("path", path)


@query("compile_entity_index", ENTITY_FILE_SQL)
def q_compile_entity_index(spark, d):
    folder = FS.scratch_dir(spark, "entities")
    FS.write_per_document(SI.entity_index(spark, d), "source_id", folder, S.SUFFIX_ENTITIES)
    idx = IX.compile_entity_index(spark, folder)
    out = FS.scratch_dir(spark, "entity_index")
    FS.write_version(idx, out)
    return FS.read_latest(spark, out, S.ENTITY_INDEX)


TOPIC_LIST_CTES = f"""tf AS (
  SELECT doc_id, w AS term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}{{4,}}')) AS w
        FROM documents)
  GROUP BY ALL),
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scored AS (
  SELECT tf.doc_id, tf.term, tf.tf, d.df,
         round(tf.tf * ln((SELECT count(*) FROM documents) / d.df), 6) AS score
  FROM tf JOIN dfreq d USING (term)),
ranked AS (
  SELECT doc_id, term, score,
         row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rank
  FROM scored)"""


@query("compile_topic_index", "WITH " + TOPIC_LIST_CTES + f"""
SELECT term AS topic, CAST(doc_id AS VARCHAR) AS source_id
FROM ranked WHERE rank <= {TOPICS_K}""")
def q_compile_topic_index(spark, d):
    docs = T(spark, d, "documents")
    tl = N.topic_list(docs, "doc_id", "text", TOPICS_K)
    folder = FS.scratch_dir(spark, "topics")
    rows = tl.select("topic", F.col("doc_id").cast("string").alias("source_id"), "doc_id")
    FS.write_per_document(rows, "doc_id", folder, S.SUFFIX_TOPICS)
    idx = IX.compile_topic_index(spark, folder)
    out = FS.scratch_dir(spark, "topic_index")
    FS.write_version(idx, out)
    return FS.read_latest(spark, out, S.TOPIC_INDEX)


@query("append_new_listing", with_ctes("listing") + """,
new AS (SELECT * FROM listing WHERE video_id % 2 = 0
        UNION ALL SELECT video_id, upper(title), published_at, channel_id
        FROM listing WHERE video_id % 4 = 0),
old AS (SELECT * FROM listing WHERE video_id % 2 = 1 OR video_id % 6 = 0)
SELECT DISTINCT * FROM (
  SELECT * FROM new WHERE video_id NOT IN (SELECT video_id FROM old)
  UNION ALL SELECT * FROM old)""")
def q_append_new_listing(spark, d):
    """Every listing row is new, stored or both; some new ones have two titles."""
    lst, i = SI.listing(spark, d), F.col("video_id")
    new = (lst.filter(i % 2 == 0)
              .unionByName(lst.filter(i % 4 == 0).withColumn("title", F.upper("title"))))
    return C.append_new_listing(new, lst.filter((i % 2 == 1) | (i % 6 == 0)))


@query("union_all", with_ctes("transcripts", "segments") + """
SELECT video_id, text, NULL::BIGINT AS start FROM transcripts
UNION ALL SELECT video_id, text, start FROM segments""")
def q_union_all(spark, d):
    return SI.transcripts(spark, d).unionByName(SI.segments(spark, d), allowMissingColumns=True)


@query("drop_duplicates", with_ctes("listing") + "SELECT DISTINCT channel_id, title FROM listing")
def q_drop_duplicates(spark, d):
    return SI.listing(spark, d).select("channel_id", "title").dropDuplicates()


# ===========================================================================
# 2.8 scalar functions
# ===========================================================================

CLEAN_SQL = """
SELECT doc_id, array_to_string(list_filter(k, lambda x, j: x <> coalesce(k[j + 1], '')), ' ')
         AS cleaned
FROM (SELECT doc_id, list_filter(string_split(regexp_replace(replace(text, chr(160), ' '),
                                                             ' +', ' ', 'g'), ' '),
                                 lambda x: x NOT IN ('um', 'uh', '[ __ ]', '[Music]', 'Â')) AS k
      FROM documents)"""


@query("clean_text", CLEAN_SQL)
def q_clean_text(spark, d):
    return T(spark, d, "documents").select("doc_id", X.clean_text("text").alias("cleaned"))


@query("html_unescape_basic", """
SELECT page_id, replace(replace(html, '&#39;', ''''), '&amp;', '&') AS html FROM pages""")
def q_html_unescape_basic(spark, d):
    return T(spark, d, "pages").select("page_id", X.html_unescape_basic("html").alias("html"))


@query("eastern_date", """
SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'US/Eastern' AS DATE) AS publish_dt_et
FROM events""")
def q_eastern_date(spark, d):
    e = T(spark, d, "events")
    return e.select("event_id", TM.eastern_date(TM.utc_instant("ts")).alias("publish_dt_et"))


@query("week_start", """
SELECT event_id, d AS published_date_et,
       d - CAST(CASE WHEN dayofweek(d) = 0 THEN 7 ELSE dayofweek(d) END AS INTEGER)
         AS published_week
FROM (SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'US/Eastern' AS DATE) AS d
      FROM events)""")
def q_week_start(spark, d):
    e = T(spark, d, "events").select(
        "event_id", TM.eastern_date(TM.utc_instant("ts")).alias("published_date_et"))
    return e.withColumn("published_week", TM.week_start("published_date_et"))


@query("trailing_window", f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY""")
def q_trailing_window(spark, d):
    return TM.trailing_window(T(spark, d, "events"), "ts", AS_OF, DAYS)


TOKEN_RE = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


@query("token_count", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{TOKEN_RE}')) AS BIGINT) AS tokens
FROM documents""")
def q_token_count(spark, d):
    return T(spark, d, "documents").select("doc_id", X.token_count("text").alias("tokens"))


@query("chunk_text", f"""
WITH t AS (SELECT doc_id, text, regexp_extract_all(text, '{TOKEN_RE}') AS tok FROM documents),
k AS (SELECT doc_id, text, tok, len(tok) AS n,
             greatest(1, CAST(ceil(len(tok) / {CHUNK_LIMIT}) AS INTEGER)) AS k FROM t),
parts AS (SELECT doc_id, text, tok, n, k, unnest(range(k)) AS i FROM k)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_id,
       CASE WHEN n < {CHUNK_LIMIT} THEN text
            ELSE array_to_string(tok[CAST(floor(i * n / k) AS BIGINT) + 1 :
                                     CAST(floor((i + 1) * n / k) AS BIGINT)], ' ') END AS text
FROM parts""")
def q_chunk_text(spark, d):
    return N.chunks_of(T(spark, d, "documents"), "doc_id", "text", CHUNK_LIMIT)


@query("split_topics", """
SELECT conv_id, turn, CAST(p - 1 AS INTEGER) AS pos, topic
FROM (SELECT conv_id, turn, unnest(string_split(text, ',')) AS topic,
             generate_subscripts(string_split(text, ','), 1) AS p
      FROM conversations)""")
def q_split_topics(spark, d):
    cv = T(spark, d, "conversations")
    return cv.select("conv_id", "turn", F.posexplode(X.split_topics("text")).alias("pos", "topic"))


@query("string_helpers", """
SELECT page_id, lower(url) AS url_lower, CAST(length(html) AS INTEGER) AS n_chars,
       contains(lower(html), '<script') AS has_script,
       replace(url, '#top', '') AS url_clean
FROM pages""")
def q_string_helpers(spark, d):
    p = T(spark, d, "pages")
    return p.select("page_id", F.lower("url").alias("url_lower"),
                    F.length("html").alias("n_chars"),
                    F.lower("html").contains("<script").alias("has_script"),
                    X.strip_suffix("url", "#top").alias("url_clean"))


# ===========================================================================
# 2.9 enrichment (deterministic built-in scorers)
# ===========================================================================

EMO_SQL_TMPL = """
WITH lex AS (SELECT * FROM {lex}),
tf AS (
  SELECT doc_id, w AS term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS w
        FROM documents)
  GROUP BY ALL),
scores AS (
  SELECT doc_id, label, round(sum(tf * weight), 6) AS score
  FROM tf JOIN lex USING (term) GROUP BY ALL),
best AS (
  SELECT doc_id, label FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS r
    FROM scores) WHERE r = 1)
SELECT d.doc_id, b.label AS {out} FROM documents d LEFT JOIN best b USING (doc_id)"""


@query("classify_emotion", EMO_SQL_TMPL.format(
    lex=_values_sql(EMOTION_LEXICON, ["term", "label", "weight"]), out="emotion"))
def q_classify_emotion(spark, d):
    return N.classify_emotion(T(spark, d, "documents"), emotion_lexicon(spark), "doc_id")


SENT_SQL = f"""
WITH lex AS (SELECT * FROM {_values_sql(SENTIMENT_LEXICON, ["term", "weight"])}),
tf AS (
  SELECT doc_id, w AS term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS w
        FROM documents)
  GROUP BY ALL),
scores AS (SELECT doc_id, round(sum(tf * weight), 6) AS score FROM tf JOIN lex USING (term)
           GROUP BY ALL)"""


@query("classify_sentiment", SENT_SQL + """
SELECT d.doc_id, s.score > 0 AS sentiment FROM documents d LEFT JOIN scores s USING (doc_id)""")
def q_classify_sentiment(spark, d):
    return N.classify_sentiment(T(spark, d, "documents"), sentiment_lexicon(spark), "doc_id")


@query("enrich", SENT_SQL + """
SELECT d.doc_id, s.score > 0 AS sentiment FROM documents d LEFT JOIN scores s USING (doc_id)
WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_enrich(spark, d):
    lex = sentiment_lexicon(spark)
    store = T(spark, d, "labels")
    return N.enrich(T(spark, d, "documents"), "doc_id",
                    lambda todo: N.classify_sentiment(todo, lex, "doc_id"), store=store)


@query("topic_list", "WITH " + TOPIC_LIST_CTES + f"""
SELECT doc_id, term AS topic, rank FROM ranked WHERE rank <= {TOPICS_K}""")
def q_topic_list(spark, d):
    return N.topic_list(T(spark, d, "documents"), "doc_id", "text", TOPICS_K)


@query("main_topic", "WITH " + TOPIC_LIST_CTES + """
SELECT d.doc_id, r.term AS main_topic FROM documents d
LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) r USING (doc_id)""")
def q_main_topic(spark, d):
    return N.main_topic(T(spark, d, "documents"), "doc_id", "text")


@query("summarize", "WITH " + TOPIC_LIST_CTES + f""",
sents AS (
  SELECT doc_id, CAST(p - 1 AS INTEGER) AS spos, s AS sentence FROM (
    SELECT doc_id, unnest(x) AS s, generate_subscripts(x, 1) AS p FROM (
      SELECT doc_id, list_filter(list_transform(
               regexp_extract_all(text, '[^.!?\\n]+[.!?]*'), lambda y: trim(y)),
               lambda y: y <> '') AS x
      FROM documents))),
sw AS (SELECT doc_id, spos, unnest(regexp_extract_all(lower(sentence), '\\p{{L}}{{4,}}')) AS term
       FROM sents),
ss AS (SELECT sw.doc_id, sw.spos, round(avg(s.score), 6) AS sscore
       FROM sw JOIN scored s ON s.doc_id = sw.doc_id AND s.term = sw.term GROUP BY ALL),
best AS (SELECT doc_id, spos FROM (
           SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sscore DESC, spos) AS r
           FROM ss) WHERE r <= {SUMMARY_N}),
summ AS (SELECT s.doc_id, string_agg(s.sentence, ' ' ORDER BY s.spos) AS summary
         FROM sents s JOIN best b ON b.doc_id = s.doc_id AND b.spos = s.spos GROUP BY s.doc_id)
SELECT d.doc_id, m.summary FROM documents d LEFT JOIN summ m USING (doc_id)""")
def q_summarize(spark, d):
    return N.summarize(T(spark, d, "documents"), "doc_id", "text", SUMMARY_N)


@query("extract_entities", with_ctes("raw_entities") + "SELECT * FROM raw_entities")
def q_extract_entities(spark, d):
    return E.extract_entities(T(spark, d, "documents"), "doc_id", "text",
                              proper_noun_type="PERSON")


GAZETTEER = [("and", "ORG"), ("of the", "GPE"), ("The", "LAW"), ("de la", "GPE"), ("the of and", "FAC")]


@query("gazetteer_entities", f"""
WITH gaz AS (SELECT DISTINCT lower(term) AS t, entity_type FROM {_values_sql(GAZETTEER, ["term", "entity_type"])}),
w AS (SELECT doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(len(w))) AS pos FROM w),
g AS (SELECT doc_id, pos, array_to_string(w[pos + 1:pos + n], ' ') AS value
      FROM p, (VALUES (1), (2), (3)) AS l(n) WHERE pos + n <= len(w))
SELECT g.doc_id AS source_id, gaz.entity_type, g.value, g.pos FROM g JOIN gaz ON lower(g.value) = gaz.t""")
def q_gazetteer_entities(spark, d):
    gaz = spark.createDataFrame(GAZETTEER, "term string, entity_type string")
    return E.gazetteer_entities(T(spark, d, "documents"), gaz, "doc_id")


_DIM_SQL = _values_sql(S.DIM_EMOTION_ROWS, ["emotion", "prim", "emotion_id"])


@query("validate_labels", f"""
WITH dim AS (SELECT emotion, CAST(prim AS INTEGER) AS prim, CAST(emotion_id AS INTEGER) AS emotion_id
             FROM {_DIM_SQL}),
lb AS (SELECT doc_id AS video_id,
              CASE WHEN toxic = 1 THEN 'rage' WHEN quality = 1 THEN 'joy' ELSE 'sadness' END
                AS primary_emotion,
              CASE WHEN toxic = 1 THEN 'anger' WHEN quality = 1 THEN 'optimism' ELSE 'surprise' END
                AS secondary_emotion
       FROM labels)
SELECT lb.secondary_emotion, lb.primary_emotion, lb.video_id,
       p.emotion_id AS primary_emotion_id, s.emotion_id AS secondary_emotion_id,
       (lb.primary_emotion IS NULL OR p.emotion_id IS NOT NULL)
       AND (lb.secondary_emotion IS NULL OR s.emotion_id IS NOT NULL) AS valid
FROM lb LEFT JOIN dim p ON p.emotion = lb.primary_emotion AND p.prim = 1
LEFT JOIN dim s ON s.emotion = lb.secondary_emotion AND s.prim = 0""")
def q_validate_labels(spark, d):
    lb = T(spark, d, "labels")
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    labels = lb.select(
        F.col("doc_id").alias("video_id"),
        F.when(toxic, "rage").when(good, "joy").otherwise("sadness").alias("primary_emotion"),
        F.when(toxic, "anger").when(good, "optimism").otherwise("surprise")
         .alias("secondary_emotion"))
    # the dimension comes from a CSV file that opens with a byte order mark
    folder = FS.scratch_dir(spark, "dim_emotions")
    rows = N.dim_emotions(spark).select(F.concat_ws(",", "emotion", "primary", "emotion_id").alias("value"))
    head = spark.createDataFrame([("\ufeffemotion,primary,emotion_id",)], "value string")
    head.unionByName(rows).coalesce(1).write.text(folder)
    return N.validate_labels(labels, FS.read_dim_emotions(spark, folder))


OVERALL_SQL = f"""
WITH chunks AS (SELECT doc_id, 0 AS chunk_id, text FROM documents),
tfc AS (
  SELECT doc_id, w AS term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS w FROM chunks)
  GROUP BY ALL),
dfreq AS (
  SELECT w AS term, count(DISTINCT doc_id) AS df
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}{{4,}}')) AS w FROM documents)
  GROUP BY ALL),
scored AS (
  SELECT tfc.doc_id, tfc.term, round(tfc.tf * ln((SELECT count(*) FROM documents) / d.df), 6) AS score
  FROM tfc JOIN dfreq d USING (term)),
topic1 AS (SELECT doc_id, term AS main_topic FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS r FROM scored)
  WHERE r = 1),
sents AS (
  SELECT doc_id, CAST(p - 1 AS INTEGER) AS spos, s AS sentence FROM (
    SELECT doc_id, unnest(x) AS s, generate_subscripts(x, 1) AS p FROM (
      SELECT doc_id, list_filter(list_transform(
               regexp_extract_all(text, '[^.!?\\n]+[.!?]*'), lambda y: trim(y)),
               lambda y: y <> '') AS x
      FROM chunks))),
sw AS (SELECT doc_id, spos, unnest(regexp_extract_all(lower(sentence), '\\p{{L}}{{4,}}')) AS term
       FROM sents),
ss AS (SELECT sw.doc_id, sw.spos, round(avg(s.score), 6) AS sscore
       FROM sw JOIN scored s ON s.doc_id = sw.doc_id AND s.term = sw.term GROUP BY ALL),
best AS (SELECT doc_id, spos FROM (
           SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sscore DESC, spos) AS r
           FROM ss) WHERE r <= {SUMMARY_N}),
summ AS (SELECT s.doc_id, string_agg(s.sentence, ' ' ORDER BY s.spos) AS summary
         FROM sents s JOIN best b ON b.doc_id = s.doc_id AND b.spos = s.spos GROUP BY s.doc_id),
slex AS (SELECT * FROM {_values_sql(SENTIMENT_LEXICON, ["term", "weight"])}),
sent AS (SELECT doc_id, round(sum(tf * weight), 6) > 0 AS sentiment
         FROM tfc JOIN slex USING (term) GROUP BY ALL),
plex AS (SELECT * FROM {_values_sql(EMOTION_LEXICON, ["term", "label", "weight"])}),
qlex AS (SELECT * FROM {_values_sql(SECONDARY_LEXICON, ["term", "label", "weight"])}),
pemo AS (SELECT doc_id, label AS primary_emotion FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS r FROM (
    SELECT doc_id, label, round(sum(tf * weight), 6) AS score FROM tfc JOIN plex USING (term)
    GROUP BY ALL)) WHERE r = 1),
qemo AS (SELECT doc_id, label AS secondary_emotion FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS r FROM (
    SELECT doc_id, label, round(sum(tf * weight), 6) AS score FROM tfc JOIN qlex USING (term)
    GROUP BY ALL)) WHERE r = 1)
SELECT c.doc_id, m.summary, CAST(NULL AS VARCHAR) AS summary_reasoning, s.sentiment,
       p.primary_emotion, q.secondary_emotion, t.main_topic, CAST(1 AS BIGINT) AS chunks
FROM chunks c LEFT JOIN summ m USING (doc_id) LEFT JOIN sent s USING (doc_id)
LEFT JOIN pemo p USING (doc_id) LEFT JOIN qemo q USING (doc_id) LEFT JOIN topic1 t USING (doc_id)
"""


@query("overall_classification", OVERALL_SQL)
def q_overall_classification(spark, d):
    return N.overall_classification(T(spark, d, "documents"), emotion_lexicon(spark),
                                    secondary_lexicon(spark), sentiment_lexicon(spark),
                                    key="doc_id")


# ===========================================================================
# 2.10 streaming (availableNow over the table's file; result read back)
# ===========================================================================


@query("stream_transcripts", ASSEMBLE_SQL)
def q_stream_transcripts(spark, d):
    from vigil.streaming import jobs
    return jobs.run_stream_transcripts(spark, d)


@query("stream_listing_dedup", with_ctes("listing") + """
SELECT video_id, CASE WHEN video_id % 5 = 0 THEN upper(title) ELSE title END AS title,
       published_at, channel_id FROM listing""")
def q_stream_listing_dedup(spark, d):
    from vigil.streaming import jobs
    return jobs.run_stream_listing_dedup(spark, d)


@query("stream_index_upsert", with_ctes("library_index") + UPSERT_CTES + """
SELECT lib_key, CAST(source_id AS VARCHAR) AS source_id, rec_mod_dtm, doc_type_id,
       source_system_id, path, summary, summary_reasoning, sentiment, primary_emotion,
       secondary_emotion, main_topic, action
FROM upserted""")
def q_stream_index_upsert(spark, d):
    from vigil.streaming import jobs
    return jobs.run_stream_index_upsert(spark, d)


# ===========================================================================
# batch drivers (pick unenriched documents -> score -> new rows)
# ===========================================================================

# already processed documents of the stand-in stores
PROCESSED_SQL = "SELECT doc_id FROM labels WHERE quality = 1"


def _processed(spark, d, col="source_id"):
    return T(spark, d, "labels").filter("quality = 1").select(F.col("doc_id").alias(col))


@query("identify_topics_for_all", "WITH " + TOPIC_LIST_CTES + f"""
SELECT term AS topic, doc_id AS source_id FROM ranked
WHERE rank <= {TOPICS_K} AND doc_id NOT IN ({PROCESSED_SQL})""")
def q_identify_topics_for_all(spark, d):
    return BT.identify_topics_for_all(SI.transcripts(spark, d), _processed(spark, d), TOPICS_K)


@query("store_topics", ORACLE["identify_topics_for_all"])
def q_store_topics(spark, d):
    """The topics driver run twice against its own store."""
    folder = FS.scratch_dir(spark, "topic_store")
    for _ in range(2):
        topics = BT.identify_topics_for_all(SI.transcripts(spark, d), _processed(spark, d), TOPICS_K)
        stored = BT.append_results(topics, folder, "source_id")
    return stored


_TODO_DOCS = f"(SELECT * FROM documents WHERE doc_id NOT IN ({PROCESSED_SQL}))"
_SUMMARY_SQL = ORACLE["summarize"]
_SUMMARY_CTE = _SUMMARY_SQL.strip()[len("WITH "):].rsplit("SELECT d.doc_id, m.summary", 1)[0]
_SUMMARY_CTE = _SUMMARY_CTE.rstrip().rstrip(",")


@query("build_entities_for_all", "WITH " + _SUMMARY_CTE + f""",
sdocs AS (SELECT d.doc_id, m.summary AS text FROM {_TODO_DOCS} d LEFT JOIN summ m USING (doc_id)),
""" + SI.SQL["raw_entities"].replace("FROM documents", "FROM sdocs") + ",\n"
       + SI.SQL["unique_entities"] + ",\n" + SI.SQL["entity_index"] + """
SELECT entity_type, value, source_id FROM entity_index""")
def q_build_entities_for_all(spark, d):
    return BT.build_entities_for_all(SI.transcripts(spark, d), _processed(spark, d),
                                     summary_sentences=SUMMARY_N)


_CLASSIFY_TODO = f"""(SELECT * FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    AND doc_id IN (SELECT e.event_id FROM events e JOIN customer c
                   ON CAST(c.c_custkey AS VARCHAR) = CAST(e.user_id AS VARCHAR)
                   WHERE lower(c.c_mktsegment) = lower('{CATEGORY}')))"""


@query("classify_transcripts", OVERALL_SQL.replace(
    "WITH chunks AS (SELECT doc_id, 0 AS chunk_id, text FROM documents)",
    with_ctes("listing", "channels") + f""",
info AS (SELECT l.video_id, l.channel_id, coalesce(h.channel_title, '') AS channel_title,
           coalesce(h.category, '') AS channel_category, l.published_at, l.title
         FROM listing l LEFT JOIN channels h USING (channel_id)),
chunks AS (SELECT doc_id AS video_id, doc_id, 0 AS chunk_id, text FROM {_CLASSIFY_TODO})""")
    .replace("SELECT c.doc_id, m.summary", "SELECT c.video_id, i.channel_id, i.channel_title, "
             "i.channel_category, i.published_at, i.title, m.summary")
    .replace("LEFT JOIN topic1 t USING (doc_id)", "LEFT JOIN topic1 t USING (doc_id) JOIN info i ON i.video_id = c.video_id"))
def q_classify_transcripts(spark, d):
    return BT.classify_transcripts(
        SI.transcripts(spark, d), SI.classifications(spark, d), SI.listing(spark, d),
        SI.channels(spark, d), emotion_lexicon(spark), secondary_lexicon(spark),
        sentiment_lexicon(spark), category=CATEGORY)


_STALE = "(SELECT * FROM classifications WHERE video_id IN (SELECT video_id FROM listing) " \
         "AND (main_topic IS NULL OR main_topic = ''))"


@query("update_new_classifications", with_ctes("classifications", "listing") + ", "
       + TOPIC_LIST_CTES + f"""
SELECT s.video_id, s.summary, s.summary_reasoning, s.sentiment, s.primary_emotion,
       s.secondary_emotion, r.term AS main_topic
FROM {_STALE} s LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) r ON r.doc_id = s.video_id""")
def q_update_new_classifications(spark, d):
    return BT.update_new_classifications(SI.classifications(spark, d), SI.listing(spark, d),
                                         SI.transcripts(spark, d))


# the stored and incremental forms register themselves
from vigil.plans import registry_store  # noqa: E402,F401
