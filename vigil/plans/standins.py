"""Domain tables derived from the driver's synthetic tables.

Each stand-in exists twice: as a Spark DataFrame builder and as a SQL CTE
(DuckDB dialect) used by the oracle, so both engines start from the same
definition. Mapping:

* listing (channel search)  <- events: event_id -> video_id, event_type ->
  title, ts -> published_at (ISO text, UTC), user_id -> channel_id
* channels dimension        <- customer x nation: c_custkey -> channel_id,
  c_name -> channel_title, c_mktsegment -> category, n_name -> region
* transcripts (assembled)   <- documents: doc_id -> video_id, text
* transcript segments       <- conversations: conv_id -> video_id,
  turn -> start, text
* skip list                 <- labels with toxic = 1
* classifications           <- labels (partial cover, as "no file" is normal)
* library index             <- documents left join classifications
* topic index               <- events: event_type -> topic ('error' -> 'none')
* entity index              <- the built-in extractor over documents
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.joins import spread


# Text tables of the driver hold one Parquet row group per file, so a scan
# is one task; their loader spreads the rows over the cluster (a no-op when
# the scan already has enough splits).
TEXT_TABLE_KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id"}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    if name in TEXT_TABLE_KEYS:
        df = spread(df, TEXT_TABLE_KEYS[name])
    return df


ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def listing(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("video_id"), F.col("event_type").alias("title"),
                    F.date_format("ts", ISO_FMT).alias("published_at"),
                    F.col("user_id").cast("string").alias("channel_id"))


def channels(spark, d) -> DataFrame:
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # nation: 25 rows, fixed
             .select(F.col("c_custkey").cast("string").alias("channel_id"),
                     F.col("c_name").alias("channel_title"),
                     F.col("c_mktsegment").alias("category"),
                     F.col("n_name").alias("region")))


def transcripts(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), "text")


def segments(spark, d) -> DataFrame:
    return table(spark, d, "conversations").select(
        F.col("conv_id").alias("video_id"), F.col("turn").alias("start"), "text")


def skip_list(spark, d) -> DataFrame:
    return table(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").alias("video_id"))


def classifications(spark, d) -> DataFrame:
    lb = table(spark, d, "labels")
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    return lb.select(
        F.col("doc_id").alias("video_id"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("summary_reasoning"),
        good.alias("sentiment"),
        F.when(toxic, "anger").when(good, "joy").otherwise("sadness").alias("primary_emotion"),
        F.when(toxic, "rage").when(good, "optimism").otherwise("disappointment")
         .alias("secondary_emotion"),
        F.when(good, "news").otherwise("").alias("main_topic"))


def library_index(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id")
    c = classifications(spark, d)
    j = docs.join(c, docs.doc_id == c.video_id, "left")
    return j.select(
        (F.col("doc_id") + 1).alias("lib_key"), F.col("doc_id").alias("source_id"),
        F.lit("2024-02-01 00:00:00").alias("rec_mod_dtm"),
        F.lit(2).alias("doc_type_id"), F.lit(2).alias("source_system_id"),
        F.concat(F.lit("transcripts/"), F.col("doc_id").cast("string"),
                 F.lit("_transcript.parquet")).alias("path"),
        "summary", "summary_reasoning",
        F.coalesce(F.col("sentiment"), F.lit(False)).alias("sentiment"),
        "primary_emotion", "secondary_emotion", "main_topic")


def topic_index(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.when(F.col("event_type") == "error", "none").otherwise(F.col("event_type"))
                     .alias("topic"), F.col("event_id").alias("source_id"))


def entity_index(spark, d) -> DataFrame:
    from vigil.operators.entities import cleaned_entities, extract_entities, unique_entities
    docs = table(spark, d, "documents")
    ents = extract_entities(docs, "doc_id", "text", proper_noun_type="PERSON")
    return cleaned_entities(unique_entities(ents)).select("entity_type", "value", "source_id")


# ---------------------------------------------------------------------------
# The same stand-ins as SQL CTEs (DuckDB).
# ---------------------------------------------------------------------------
SQL = {
    "listing": """listing AS (
  SELECT event_id AS video_id, event_type AS title,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
         CAST(user_id AS VARCHAR) AS channel_id
  FROM events)""",
    "channels": """channels AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS channel_id, c.c_name AS channel_title,
         c.c_mktsegment AS category, n.n_name AS region
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "transcripts": """transcripts AS (SELECT doc_id AS video_id, text FROM documents)""",
    "segments": """segments AS (SELECT conv_id AS video_id, turn AS start, text FROM conversations)""",
    "skip_list": """skip_list AS (SELECT doc_id AS video_id FROM labels WHERE toxic = 1)""",
    "classifications": """classifications AS (
  SELECT doc_id AS video_id, CAST(NULL AS VARCHAR) AS summary,
         CAST(NULL AS VARCHAR) AS summary_reasoning, quality = 1 AS sentiment,
         CASE WHEN toxic = 1 THEN 'anger' WHEN quality = 1 THEN 'joy' ELSE 'sadness' END
           AS primary_emotion,
         CASE WHEN toxic = 1 THEN 'rage' WHEN quality = 1 THEN 'optimism'
              ELSE 'disappointment' END AS secondary_emotion,
         CASE WHEN quality = 1 THEN 'news' ELSE '' END AS main_topic
  FROM labels)""",
    "library_index": """library_index AS (
  SELECT d.doc_id + 1 AS lib_key, d.doc_id AS source_id,
         '2024-02-01 00:00:00' AS rec_mod_dtm, 2 AS doc_type_id, 2 AS source_system_id,
         'transcripts/' || CAST(d.doc_id AS VARCHAR) || '_transcript.parquet' AS path,
         c.summary, c.summary_reasoning, coalesce(c.sentiment, false) AS sentiment,
         c.primary_emotion, c.secondary_emotion, c.main_topic
  FROM documents d LEFT JOIN classifications c ON c.video_id = d.doc_id)""",
    "topic_index": """topic_index AS (
  SELECT CASE WHEN event_type = 'error' THEN 'none' ELSE event_type END AS topic,
         event_id AS source_id
  FROM events)""",
}

# Extractor patterns in RE2 form (same text as the Spark patterns).
_NUM = r"\d{1,2}:\d{2}|[$€£]?\d+(?:[.,]\d+)*(?:%|st|nd|rd|th)?"
_PROPER = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*"
SQL["raw_entities"] = f"""raw_entities AS (
  SELECT doc_id AS source_id,
         CASE WHEN regexp_matches(v, '^\\p{{Lu}}') THEN 'PERSON'
              WHEN regexp_matches(v, '^\\d{{1,2}}:\\d{{2}}$') THEN 'TIME'
              WHEN regexp_matches(v, '^[$€£]') THEN 'MONEY'
              WHEN ends_with(v, '%') THEN 'PERCENT'
              WHEN regexp_matches(v, '(st|nd|rd|th)$') THEN 'ORDINAL'
              WHEN regexp_matches(v, '^(19|20)\\d\\d$') THEN 'DATE'
              ELSE 'CARDINAL' END AS entity_type,
         v AS value, p - 1 AS pos
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_NUM}|{_PROPER}')) AS v,
               generate_subscripts(regexp_extract_all(text, '{_NUM}|{_PROPER}'), 1) AS p
        FROM documents))"""
SQL["unique_entities"] = """unique_entities AS (
  SELECT source_id, entity_type, value, min(pos) AS pos
  FROM raw_entities GROUP BY source_id, entity_type, value)"""
SQL["entity_index"] = """entity_index AS (
  SELECT l.entity_type, l.value, l.source_id FROM unique_entities l
  WHERE NOT EXISTS (SELECT 1 FROM unique_entities r
                    WHERE r.source_id = l.source_id AND r.entity_type = l.entity_type
                      AND r.value <> l.value AND contains(r.value, l.value)))"""

DEPENDS = {
    "library_index": ["classifications"],
    "unique_entities": ["raw_entities"],
    "entity_index": ["raw_entities", "unique_entities"],
}


def with_ctes(*names: str) -> str:
    """WITH clause holding the named stand-ins and their dependencies."""
    order: list[str] = []

    def add(n):
        for dep in DEPENDS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    return "WITH " + ",\n".join(SQL[n] for n in order) + "\n"
