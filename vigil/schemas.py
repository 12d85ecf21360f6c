"""Explicit schemas and closed label sets.

Every stored table gets a declared ``StructType`` so readers never infer
types and schema drift (old column names, missing enrichment columns) is
handled by name in ``vigil.sources``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the reference's for the same results.
# ---------------------------------------------------------------------------
# The 18 named-entity types (in the reference's order).
ENTITY_TYPES = [
    "PERSON", "NORP", "FAC", "ORG", "GPE", "LOC", "PRODUCT", "EVENT",
    "WORK_OF_ART", "LAW", "LANGUAGE", "DATE", "TIME", "PERCENT", "MONEY",
    "QUANTITY", "ORDINAL", "CARDINAL",
]
# Primary emotion labels (closed set of 6).
PRIMARY_EMOTIONS = ["sadness", "joy", "love", "anger", "fear", "surprise"]
# Secondary emotion labels (closed set of 24).
SECONDARY_EMOTIONS = [
    "affection", "lust", "longing", "cheerfulness", "zest", "contentment",
    "pride", "optimism", "enthrallment", "relief", "surprise", "irritability",
    "exasperation", "rage", "disgust", "envy", "torment", "suffering",
    "disappointment", "shame", "neglect", "sympathy", "horror", "nervousness",
]
# Document types and source systems of the library index.
DOC_TYPES = {"article": 1, "transcript": 2, "youtube channel search": 3}
SOURCE_SYSTEMS = {"user": 1, "youtube": 2, "scholar": 3}
# Filler tokens removed by clean_text (exact, case-sensitive tokens).
FILLER_TOKENS = ["um", "uh", "[ __ ]", "[Music]", "Â"]
# Chunking limit of the enrichment step, in tokens.
CHUNK_TOKEN_LIMIT = 120_000
# Listing page size and default search size.
LISTING_PAGE_SIZE = 50
SEARCH_MAX_RESULTS = 25
# Library-index change detection compares only these columns.
INDEX_TRACKED_COLUMNS = ["rec_mod_dtm", "sentiment", "primary_emotion", "main_topic"]
# Enrichment columns of a classification record.
CLASSIFICATION_COLUMNS = [
    "summary", "summary_reasoning", "sentiment", "primary_emotion",
    "secondary_emotion", "main_topic",
]
# Folder suffixes that carry the document key in legacy per-document files.
SUFFIX_TRANSCRIPT = "_transcript.parquet"
SUFFIX_SEARCH = "_search.parquet"
SUFFIX_CLASSIFICATION = "_classification.parquet"
SUFFIX_ENTITIES = "_entities.parquet"
SUFFIX_TOPICS = "_topics.parquet"
# Time zone of the published-date analysis.
ANALYSIS_TZ = "US/Eastern"
# ---------------------------------------------------------------------------

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CHANNELS = _st(("channel_id", S), ("channel_title", S), ("category", S), ("region", S))
DIM_EMOTIONS = _st(("emotion", S), ("primary", I), ("emotion_id", I))
CHANNEL_SEARCH = _st(("video_id", S), ("title", S), ("published_at", S),
                     ("channel_id", S), ("code", B))
TRANSCRIPT_SEGMENT = _st(("text", S), ("start", D), ("duration", D))
SKIP_LIST = _st(("video_id", S))
CLASSIFICATION = _st(("summary", S), ("summary_reasoning", S), ("sentiment", B),
                     ("primary_emotion", S), ("secondary_emotion", S), ("main_topic", S))
ENTITIES = _st(("entity_type", S), ("value", S))
TOPICS = _st(("topic", S), ("source_id", S))
LIBRARY_INDEX = _st(
    ("lib_key", L), ("source_id", S), ("rec_mod_dtm", S), ("doc_type_id", I),
    ("source_system_id", I), ("path", S), ("summary", S), ("summary_reasoning", S),
    ("sentiment", B), ("primary_emotion", S), ("secondary_emotion", S), ("main_topic", S))
STORED_CLASSIFICATION = _st(("source_id", S), *[(f.name, f.dataType) for f in CLASSIFICATION.fields])
INVENTORY = _st(("path", S), ("source_id", S), ("modified", T.TimestampType()), ("length", L),
                ("doc_type_id", I), ("source_system_id", I))
TERM_STATISTICS = _st(("term", S), ("df", L))
ENTITY_INDEX = _st(("entity_type", S), ("value", S), ("source_id", S))
TOPIC_INDEX = _st(("topic", S), ("source_id", S))

_THUMB = _st(("url", S), ("width", L), ("height", L))
SEARCH_SNIPPET = T.StructType([
    T.StructField("publishedAt", S), T.StructField("channelId", S),
    T.StructField("title", S), T.StructField("description", S),
    T.StructField("thumbnails", T.MapType(S, _THUMB)),
    T.StructField("channelTitle", S), T.StructField("liveBroadcastContent", S),
    T.StructField("publishTime", S),
])
SEARCH_ITEM = T.StructType([
    T.StructField("kind", S), T.StructField("etag", S),
    T.StructField("id", _st(("kind", S), ("videoId", S), ("channelId", S))),
    T.StructField("snippet", SEARCH_SNIPPET),
])
SEARCH_PAGE = T.StructType([
    T.StructField("kind", S), T.StructField("etag", S),
    T.StructField("nextPageToken", S), T.StructField("regionCode", S),
    T.StructField("items", T.ArrayType(SEARCH_ITEM)),
])

# FIXED VALUES — the emotion dimension (emotion, primary flag, emotion_id),
# in the reference's order; natural key is (emotion, primary).
DIM_EMOTION_ROWS = [
    ("affection", 0, 1), ("anger", 1, 2), ("cheerfulness", 0, 3), ("contentment", 0, 4),
    ("disappointment", 0, 5), ("disgust", 0, 6), ("enthrallment", 0, 7), ("envy", 0, 8),
    ("exasperation", 0, 9), ("fear", 1, 10), ("horror", 0, 11), ("irritability", 0, 12),
    ("joy", 1, 13), ("longing", 0, 14), ("love", 1, 15), ("lust", 0, 16),
    ("neglect", 0, 17), ("nervousness", 0, 18), ("optimism", 0, 19), ("pride", 0, 20),
    ("rage", 0, 21), ("relief", 0, 22), ("sadness", 1, 23), ("shame", 0, 24),
    ("suffering", 0, 25), ("surprise", 1, 26), ("surprise", 0, 27), ("sympathy", 0, 28),
    ("torment", 0, 29), ("zest", 0, 30),
]
