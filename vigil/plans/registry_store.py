"""Registered queries of the stored and incremental forms: merge-on-read
index, incremental refresh, partitioned listing, bucketed marts, entity
postings, statistics with a ledger, checked scoring, reject tables. Each runs
the whole driver table through several batches or runs, and returns what the
store then holds. Imported by ``registry``, whose tables they join.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil import schemas as S
from vigil.operators import analysis as A
from vigil.operators import batch as BT
from vigil.operators import catalog as C
from vigil.operators import enrich as N
from vigil.operators import entity_search as ES
from vigil.operators import index as IX
from vigil.plans import registry as R
from vigil.plans import standins as SI
from vigil.plans.registry import ORACLE, query
from vigil.plans.standins import table as T, with_ctes
from vigil.sources import files as FS

BUCKETS = 16

# --- index: merge on read ---------------------------------------------------------

_INDEX_COLUMNS = ", ".join(c for c in IX.INDEX_COLUMNS if c not in ("lib_key", "source_id"))


@query("index_delta_upsert", with_ctes("library_index") + R.UPSERT_CTES + f""",
batches AS (
  SELECT *, source_id % 2 AS batch, CASE WHEN action = 'insert' THEN row_number() OVER (
    PARTITION BY action ORDER BY source_id % 2, path) END AS place FROM upserted)
SELECT CASE WHEN action = 'insert' THEN (SELECT max(lib_key) FROM cur) + place ELSE lib_key END AS lib_key,
       CAST(source_id AS VARCHAR) AS source_id, {_INDEX_COLUMNS}
FROM batches""")
def q_index_delta_upsert(spark, d):
    """The incoming rows in two batches, each sent twice, with a compaction
    in between; the index as it then reads."""
    current, incoming = R._upsert_inputs(spark, d)
    table = IX.index_table(spark, FS.scratch_dir(spark, "delta_store"), BUCKETS)
    IX.load_index(table, current)
    for b in (0, 1):
        part = FS.conform(incoming.filter(F.col("source_id") % 2 == b), S.LIBRARY_INDEX).drop("lib_key")
        for _ in range(2):
            IX.upsert_delta(table, part, f"b{b}")
        if b == 0:
            table.compact()
    table.vacuum()
    return table.read()


@query("stream_index_delta", with_ctes("library_index") + R.UPSERT_CTES + f"""
SELECT lib_key, CAST(source_id AS VARCHAR) AS source_id, {_INDEX_COLUMNS} FROM upserted""")
def q_stream_index_delta(spark, d):
    from vigil.streaming import jobs
    return jobs.run_stream_index_delta(spark, d)


def _legacy_store(spark, d, root, versions=None):
    """A store in the reference's layout; see ``registry.q_refresh_index``."""
    FS.init_store(spark, root)
    lst = SI.listing(spark, d).withColumn("video_id", F.col("video_id").cast("string"))
    FS.write_per_document(lst, "channel_id", f"{root}/channels", S.SUFFIX_SEARCH)
    seg = SI.segments(spark, d).select(F.col("video_id").cast("string").alias("video_id"),
                                       F.col("start").cast("double").alias("start"),
                                       F.lit(None).cast("double").alias("duration"), "text")
    FS.write_per_document(seg, "video_id", f"{root}/transcripts", S.SUFFIX_TRANSCRIPT)


@query("refresh_index_incremental", R.REFRESH_SQL.replace("coalesce(c.sentiment, false)", "CASE WHEN c.video_id % 3 = 0 "
       "THEN NOT c.sentiment ELSE coalesce(c.sentiment, false) END").replace(", 'insert' AS action", ""))
def q_refresh_index_incremental(spark, d):
    """Three refreshes of one store: before the classifications come, after
    the first two thirds of them, and after the rest came and every third
    file was written anew with the opposite sentiment. Returns the index as it then reads; times and the
    store's own folder are left out, since they differ by run."""
    root = FS.scratch_dir(spark, "incremental_store")
    _legacy_store(spark, d, root)
    IX.refresh_incremental(spark, root, BUCKETS)
    clf = SI.classifications(spark, d)
    key = F.col("video_id")

    def put(rows):
        FS.write_per_document(rows.withColumn("video_id", key.cast("string")), "video_id", f"{root}/classifications", S.SUFFIX_CLASSIFICATION)
    put(clf.filter(key % 3 < 2))
    IX.refresh_incremental(spark, root, BUCKETS)
    put(clf.filter(key % 3 == 2))
    put(clf.filter(key % 3 == 0).withColumn("sentiment", ~F.col("sentiment")))
    IX.refresh_incremental(spark, root, BUCKETS)
    path = F.regexp_extract("path", "/((?:channels|transcripts)/[^/]*)$", 1)
    return IX.index_table(spark, root, BUCKETS).read().drop("rec_mod_dtm").withColumn("path", path)


@query("store_inventory", with_ctes("listing", "segments") + f"""
SELECT DISTINCT channel_id AS source_id, {S.DOC_TYPES["youtube channel search"]} AS doc_type_id FROM listing
UNION ALL SELECT DISTINCT CAST(video_id AS VARCHAR), {S.DOC_TYPES["transcript"]} FROM segments""")
def q_store_inventory(spark, d):
    root = FS.scratch_dir(spark, "inventory_store")
    _legacy_store(spark, d, root)
    return FS.store_inventory(spark, root).select("source_id", "doc_type_id")


# --- marts --------------------------------------------------------------------------

_MART = R.MART_COLS.replace("v.", "")


@query("write_marts", with_ctes("listing", "channels", "library_index", "entity_index", "topic_index")
       + "," + R.VIDEO_ANALYSIS_CTE + f"""
SELECT 'video' AS mart, v.video_id AS source_id, NULL AS kind, NULL AS name, {R.MART_COLS} FROM video_analysis v
UNION ALL SELECT 'entity', e.source_id, e.entity_type, e.value, {R.MART_COLS}
FROM entity_index e JOIN video_analysis v ON v.video_id = e.source_id
UNION ALL SELECT 'topic', t.source_id, 'topic', t.topic, {R.MART_COLS}
FROM topic_index t JOIN video_analysis v ON v.video_id = t.source_id""")
def q_write_marts(spark, d):
    """The three marts as written, one under the other."""
    marts = A.write_marts(SI.listing(spark, d), SI.channels(spark, d), SI.library_index(spark, d),
                          SI.entity_index(spark, d), SI.topic_index(spark, d), FS.scratch_dir(spark, "marts"), BUCKETS)
    cols = [c.strip() for c in _MART.split(",")]

    def part(name, source, kind, value):
        return marts[f"{name}_analysis"].select(F.lit(name).alias("mart"), F.col(source).alias("source_id"),
                                                kind.cast("string").alias("kind"), value.cast("string").alias("name"), *cols)
    return (part("video", "video_id", F.lit(None), F.lit(None))
            .unionByName(part("entity", "source_id", F.col("entity_type"), F.col("value")))
            .unionByName(part("topic", "source_id", F.lit("topic"), F.col("topic"))))


# --- listing --------------------------------------------------------------------------

@query("append_to_listing", ORACLE["append_new_listing"])
def q_append_to_listing(spark, d):
    """The stored rows, then the page of new ones, twice."""
    lst, i = SI.listing(spark, d), F.col("video_id")
    new = (lst.filter(i % 2 == 0)
              .unionByName(lst.filter(i % 4 == 0).withColumn("title", F.upper("title"))))
    root = FS.scratch_dir(spark, "listing_store")
    C.append_to_listing(lst.filter((i % 2 == 1) | (i % 6 == 0)), root, BUCKETS)
    C.append_to_listing(new, root, BUCKETS)
    return C.append_to_listing(new, root, BUCKETS)


@query("record_status", R.STATUS_SQL)
def q_record_status(spark, d):
    """The fetch status written back to a stored listing, twice."""
    root = FS.scratch_dir(spark, "listing_status_store")
    C.append_to_listing(SI.listing(spark, d).withColumn("code", F.lit(None).cast("boolean")), root, BUCKETS)
    for _ in range(2):
        out = C.record_status(root, SI.skip_list(spark, d), SI.transcripts(spark, d), BUCKETS)
    return out


@query("remove_orphans", with_ctes("segments", "listing", "channels") + f"""
SELECT DISTINCT CAST(video_id AS VARCHAR) AS video_id, video_id NOT IN (
  SELECT l.video_id FROM listing l JOIN channels c ON c.channel_id = l.channel_id
  WHERE lower(c.category) = lower('{R.CATEGORY}')) AS removed FROM segments""")
def q_remove_orphans(spark, d):
    """Transcript files of videos outside one category's channels, removed;
    with the files that are left."""
    folder = FS.scratch_dir(spark, "orphan_store")
    FS.write_per_document(SI.segments(spark, d).withColumn("video_id", F.col("video_id").cast("string")), "video_id", folder, S.SUFFIX_TRANSCRIPT)
    lst = SI.listing(spark, d).join(C.channels_list(SI.channels(spark, d), R.CATEGORY), "channel_id", "left_semi")
    gone = C.remove_orphans(spark, folder, lst, apply=True).select("video_id", "removed")
    left = FS.file_inventory(spark, folder, S.SUFFIX_TRANSCRIPT).select(F.col("source_id").alias("video_id"), F.lit(False).alias("removed"))
    return gone.unionByName(left)


# --- entity search ------------------------------------------------------------------

@query("search_entity_index", ORACLE["collect_multi_entity_data"])
def q_search_entity_index(spark, d):
    """The entity index filed in two parts, then searched by its postings."""
    root = FS.scratch_dir(spark, "value_index")
    ents = SI.entity_index(spark, d)
    for b in (0, 1):
        ES.build_value_index(ents.filter(F.col("source_id") % 2 == b), root, BUCKETS)
    return ES.collect_from_index(root, SI.library_index(spark, d), SI.listing(spark, d), SI.channels(spark, d),
                                 R.ENTITY_LIST, buckets=BUCKETS)


@query("gazetteer_longest", ORACLE["gazetteer_entities"].replace("SELECT g.doc_id AS source_id, gaz.entity_type, g.value, g.pos FROM g",
       """, hits AS (SELECT DISTINCT doc_id, pos, len(string_split(value, ' ')) AS n FROM g WHERE lower(value) IN (SELECT t FROM gaz)),
first AS (SELECT doc_id, pos, max(n) AS n FROM hits GROUP BY doc_id, pos),
spans AS (SELECT doc_id, list({'pos': pos, 'n': n} ORDER BY pos) AS s FROM first GROUP BY doc_id),
kept AS (SELECT doc_id, unnest(list_reduce(list_prepend([{'pos': CAST(-9 AS BIGINT), 'n': CAST(9 AS BIGINT)}], [[x] for x in s]),
  lambda a, x: CASE WHEN x[1].pos >= a[-1].pos + a[-1].n THEN a || x ELSE a END)) AS k FROM spans)
SELECT g.doc_id AS source_id, gaz.entity_type, g.value, g.pos FROM g
JOIN kept ON kept.doc_id = g.doc_id AND kept.k.pos = g.pos AND kept.k.n = len(string_split(g.value, ' '))"""))
def q_gazetteer_longest(spark, d):
    from vigil.operators import entities as E
    gaz = spark.createDataFrame(R.GAZETTEER, "term string, entity_type string")
    return E.gazetteer_entities(T(spark, d, "documents"), gaz, "doc_id", longest=True)


# --- statistics, topics, scoring -------------------------------------------------------

@query("term_statistics", """
SELECT w AS term, count(DISTINCT doc_id) AS df
FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}{4,}')) AS w FROM documents) GROUP BY w
UNION ALL SELECT NULL, count(DISTINCT doc_id) FROM documents""")
def q_term_statistics(spark, d):
    """Three batches, one of them twice, and a compaction."""
    docs = T(spark, d, "documents")
    table = N.statistics_table(spark, FS.scratch_dir(spark, "statistics"), BUCKETS)
    for b in (0, 1, 1, 2):
        N.add_statistics(table, docs.filter(F.col("doc_id") % 3 == b), f"b{b}", "doc_id")
        if b == 1:
            table.compact()
    return N.stored_statistics(table)


@query("identify_new_topics", ORACLE["identify_topics_for_all"])
def q_identify_new_topics(spark, d):
    """Stored statistics hold the processed documents; the waiting ones are
    added by the driver, which is run twice."""
    docs, done = SI.transcripts(spark, d), R._processed(spark, d)
    table = N.statistics_table(spark, FS.scratch_dir(spark, "topic_statistics"), BUCKETS)
    N.add_statistics(table, docs.join(done.withColumnRenamed("source_id", "video_id"), "video_id", "left_semi"), "processed")
    for _ in range(2):
        topics = BT.identify_new_topics(docs, done, table, "waiting", R.TOPICS_K)
    return topics


@query("write_back_topics", with_ctes("classifications", "listing") + ", " + R.TOPIC_LIST_CTES + f"""
SELECT CAST(c.video_id AS VARCHAR) AS source_id, c.summary, c.summary_reasoning, c.sentiment, c.primary_emotion, c.secondary_emotion,
       CASE WHEN s.video_id IS NOT NULL AND r.term IS NOT NULL THEN r.term ELSE c.main_topic END AS main_topic
FROM classifications c LEFT JOIN {R._STALE} s ON s.video_id = c.video_id
LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) r ON r.doc_id = c.video_id""")
def q_write_back_topics(spark, d):
    """The stored classification table after its missing topics were filled in, twice."""
    table = IX.classification_table(spark, FS.scratch_dir(spark, "topic_back"), BUCKETS)
    table.change(SI.classifications(spark, d).withColumnRenamed("video_id", "source_id"), batch="load")
    as_text = lambda df: df.withColumn("video_id", F.col("video_id").cast("string"))
    for _ in range(2):
        BT.write_back_topics(table, as_text(SI.listing(spark, d)), as_text(SI.transcripts(spark, d)), "topics")
    return table.read()


@query("new_files_written", ORACLE["new_file_count"])
def q_new_files_written(spark, d):
    """As ``new_file_count``, observed by the jobs that write the rows."""
    tr = SI.transcripts(spark, d)
    done = SI.topic_index(spark, d).filter("topic <> 'none'")
    counts = []
    for kind, rows in (("classifications", C.missing_enrichments(tr, SI.classifications(spark, d))),
                       ("topics", C.missing_enrichments(tr, done, store_key="source_id"))):
        counts.append((kind, BT.append_counted(rows, FS.scratch_dir(spark, f"new_{kind}"), "video_id")[1]))
    return spark.createDataFrame(counts, "kind string, new_files long")


def _first_letters(texts):
    """A stand-in model: fails on some texts and answers outside its labels on others."""
    out = []
    for t in texts:
        if t[:1] == "T":
            raise ValueError("cannot read this")
        out.append({"tone": {"A": "calm", "E": "calm", "O": "stern", "I": "odd"}.get(t[:1]), "letters": len(t)})
    return out


@query("enrich_checked", """
SELECT doc_id, CASE WHEN text[1:1] IN ('A', 'E') THEN 'calm' WHEN text[1:1] = 'O' THEN 'stern' END AS tone,
       CASE WHEN text[1:1] NOT IN ('T', 'I') OR text = '' THEN length(text) END AS letters,
       CASE WHEN text[1:1] = 'T' THEN 'ValueError: cannot read this'
            WHEN text[1:1] = 'I' THEN 'tone ''odd'' is not one of its labels' END AS error
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_enrich_checked(spark, d):
    scored = N.enrich_checked(T(spark, d, "documents"), "doc_id", _first_letters, {"tone": "string", "letters": "long"},
                              {"tone": ["calm", "stern"]}, store=T(spark, d, "labels"))
    kept, failed = N.split_errors(scored)
    return kept.unionByName(failed, allowMissingColumns=True)


# --- chunked classification ----------------------------------------------------------

_CHUNK_ROWS = ORACLE["chunk_text"].replace("SELECT doc_id, CAST(i AS INTEGER) AS chunk_id", "SELECT doc_id * 100000 + i AS doc_id").strip()
_PER_CHUNK = R.OVERALL_SQL.replace("WITH chunks AS (SELECT doc_id, 0 AS chunk_id, text FROM documents)", f"WITH chunks AS ({_CHUNK_ROWS})")


@query("overall_classification_chunks", f"""
WITH r AS ({_PER_CHUNK.strip()})
SELECT doc_id // 100000 AS doc_id, string_agg(summary, ',' ORDER BY doc_id) AS summary, CAST(NULL AS VARCHAR) AS summary_reasoning,
       CASE WHEN count(*) FILTER (sentiment) > count(*) FILTER (NOT sentiment) THEN true
            WHEN count(*) FILTER (sentiment) < count(*) FILTER (NOT sentiment) THEN false
            ELSE arg_min_null(sentiment, doc_id) END AS sentiment,
       string_agg(primary_emotion, ',' ORDER BY doc_id) AS primary_emotion,
       string_agg(secondary_emotion, ',' ORDER BY doc_id) AS secondary_emotion,
       array_to_string(list_sort(list_distinct(list(main_topic) FILTER (main_topic IS NOT NULL))), ' and ') AS main_topic,
       count(*) AS chunks
FROM r GROUP BY doc_id // 100000""")
def q_overall_classification_chunks(spark, d):
    """Texts of 1,000 tokens or more are split, scored by chunk and merged."""
    return N.overall_classification(T(spark, d, "documents"), R.emotion_lexicon(spark), R.secondary_lexicon(spark),
                                    R.sentiment_lexicon(spark), key="doc_id", limit=R.CHUNK_LIMIT)


# --- search pages -----------------------------------------------------------------------

_DAMAGED = "event_id % 10 = 3"


def _pages_with_damage(spark, d):
    """One response page per event; every tenth line is cut off in the middle."""
    path = FS.scratch_dir(spark, "damaged_pages")
    items = R._search_items(spark, d)
    lines = items.select("event_id", F.to_json(F.struct(
        F.lit("youtube#searchListResponse").alias("kind"), F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("etag"),
        F.lit("CA").alias("regionCode"), F.array(F.struct("kind", "etag", "id", "snippet")).alias("items"))).alias("value"))
    cut = F.concat(F.substring("value", 1, 20), F.col("event_id").cast("string"))
    lines.select(F.when(F.expr(_DAMAGED), cut).otherwise(F.col("value")).alias("value")).write.text(path)
    return FS.read_search_pages_checked(spark, path)


@query("checked_search_pages", R.ITEM_FIELDS_SQL + f" WHERE NOT ({_DAMAGED})")
def q_checked_search_pages(spark, d):
    return C.search_item_fields(_pages_with_damage(spark, d)[0]).drop("thumbnails")


@query("rejected_search_pages", """SELECT '{"kind":"youtube#sea' || CAST(event_id AS VARCHAR) AS line FROM events WHERE """ + _DAMAGED)
def q_rejected_search_pages(spark, d):
    return _pages_with_damage(spark, d)[1].select("line")


@query("rejected_labels", ORACLE["validate_labels"] + "\nWHERE NOT valid")
def q_rejected_labels(spark, d):
    return R.QUERIES["validate_labels"](spark, d).filter(~F.col("valid"))


@query("stream_listing_dedup_within", with_ctes("listing") + "SELECT video_id, title, published_at, channel_id FROM listing")
def q_stream_listing_dedup_within(spark, d):
    from vigil.streaming import jobs
    return jobs.run_stream_listing_dedup_within(spark, d)
