"""Analysis marts and the notebook aggregates.

One lazy plan: listing -> channel dimension -> library index -> time columns
-> marts -> grouped counts. Catalyst pushes the trailing-window filter and
the column pruning into the Parquet scans; the two big joins shuffle on the
document key and the aggregates run partial (map-side) then final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.timefn import eastern_date, instant, trailing_window, week_start
from vigil.operators.catalog import join_channels

INDEX_DROPPED = ["lib_key", "doc_type_id", "source_system_id", "path", "summary_reasoning"]
TOPIC_KEYS = ["topic", "channel", "primary_emotion", "secondary_emotion", "published_date_et"]


def parse_published_at(col):
    """ISO-8601 instant text, with or without fraction, with any offset
    (without one: UTC) -> timestamp; null where it isn't one."""
    return instant(col)


def video_analysis(listing: DataFrame, channels: DataFrame, library_index: DataFrame,
                   how: str = "inner") -> DataFrame:
    """listing x channel dimension x library index, pruned, with the UTC
    instant and its US/Eastern date. ``how='inner'`` reads only listed
    channels (as the reference reads one listing file per known channel);
    ``'left'`` keeps unknown channels with null channel columns. The index
    join is inner on video_id = source_id, multiplicity kept."""
    li = library_index.drop(*INDEX_DROPPED).withColumnRenamed("source_id", "video_id")
    df = (join_channels(listing, channels, how)
          .drop("channel_id", "code").join(li, "video_id", "inner"))
    ts = parse_published_at(F.col("published_at"))
    return df.withColumn("published_at", ts).withColumn("publish_dt_et", eastern_date(ts))


def _with_index(index: DataFrame, analysis: DataFrame) -> DataFrame:
    """A plain equi join: no side is replicated. One document may own a third
    of the entity rows; adaptive execution splits such a partition."""
    return index.join(analysis.withColumnRenamed("video_id", "source_id"), "source_id")


def entity_analysis(entity_index: DataFrame, video: DataFrame) -> DataFrame:
    """entity_index x video_analysis on source_id = video_id."""
    return _with_index(entity_index, video)


def topic_analysis(topic_index: DataFrame, video: DataFrame) -> DataFrame:
    """topic_index x video_analysis on source_id = video_id."""
    return _with_index(topic_index, video)


def write_marts(listing: DataFrame, channels: DataFrame, library_index: DataFrame,
                entity_index: DataFrame, topic_index: DataFrame, folder: str,
                buckets: int = 64) -> dict[str, DataFrame]:
    """The three marts as tables under ``folder``, all bucketed by the document
    (video_id / source_id); name -> table. The two indexes and the video mart
    are dealt by the document once, and the entity and topic marts then join
    bucket with bucket, without moving a row; so do later joins of the marts."""
    from vigil.sources import files as FS
    video = FS.write_bucketed(video_analysis(listing, channels, library_index), f"{folder}/video_analysis", "video_id", buckets)
    marts = {"video_analysis": video}
    for name, index, join in (("entity_analysis", entity_index, entity_analysis), ("topic_analysis", topic_index, topic_analysis)):
        dealt = FS.write_bucketed(index, f"{folder}/{name}_index", "source_id", buckets)
        marts[name] = FS.write_bucketed(join(dealt, video), f"{folder}/{name}", "source_id", buckets, as_it_lies=True)
    return marts


def with_time_columns(topic_mart: DataFrame, as_of, days: int = 60) -> DataFrame:
    """Trailing window on published_at, then the Eastern date and the week
    (strictly previous Sunday)."""
    df = trailing_window(topic_mart, "published_at", as_of, days)
    d = eastern_date(F.col("published_at"))
    return df.withColumn("published_date_et", d).withColumn("published_week", week_start(d))


def topics_by_channel(topic_mart: DataFrame, as_of, days: int = 60) -> DataFrame:
    """Count of non-null titles per (topic, channel, primary, secondary,
    Eastern date) in the trailing window; topic 'none' and rows with a null
    key are left out (pandas groupby drops null keys)."""
    df = with_time_columns(topic_mart, as_of, days).withColumnRenamed("channel_title", "channel")
    df = df.filter(F.col("topic") != "none").na.drop(subset=TOPIC_KEYS)
    return df.groupBy(*TOPIC_KEYS).agg(F.count("title").alias("videos"))


def emotions_over_time(topics: DataFrame, after_date) -> DataFrame:
    """Re-aggregate topics_by_channel by (date, primary emotion, channel,
    topic) after ``after_date`` (exclusive)."""
    df = topics.filter(F.col("published_date_et") > F.lit(after_date).cast("date"))
    return (df.groupBy("published_date_et", "primary_emotion", "channel", "topic")
              .agg(F.sum("videos").cast("long").alias("videos")))


def sorted_topics(topics: DataFrame) -> DataFrame:
    return topics.orderBy("published_date_et", "topic", "channel")


def nonempty_profile(index: DataFrame) -> DataFrame:
    """Non-null count of every column over rows with main_topic > ''."""
    df = index.filter(F.col("main_topic") > "")
    return df.agg(*[F.count(c).alias(c) for c in df.columns])
