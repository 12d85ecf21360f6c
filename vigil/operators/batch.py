"""The reference's batch drivers as Spark jobs: each picks the documents
that have no stored result yet (one anti join instead of a file probe per
document), scores them with the built-in scorers and returns the new rows
(the caller appends them to the store)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vigil.operators import enrich as N
from vigil.operators.catalog import (channels_list, lookup_video_info, missing_enrichments,
                                     stale_main_topic)
from vigil.sources.files import path_exists, write_table
from vigil.operators.entities import cleaned_entities, extract_entities, unique_entities


def identify_topics_for_all(transcripts: DataFrame, topic_store: DataFrame,
                            k: int = 3, statistics: DataFrame | None = None) -> DataFrame:
    """Topic rows (topic, source_id) for transcripts with no topics yet.
    Term statistics are those of all transcripts (or a maintained table), so
    a document's topics don't depend on what else is waiting."""
    todo = missing_enrichments(transcripts, topic_store, "video_id", store_key="source_id")
    if statistics is None:
        statistics = N.corpus_statistics(transcripts)
    return N.topic_list(todo, "video_id", "text", k, statistics).select(
        "topic", F.col("video_id").alias("source_id"))


def build_entities_for_all(transcripts: DataFrame, entity_store: DataFrame,
                           use_summary: bool = True, summary_sentences: int = 2,
                           proper_noun_type: str | None = "PERSON",
                           gazetteer: DataFrame | None = None,
                           statistics: DataFrame | None = None) -> DataFrame:
    """Cleaned entity rows for transcripts with no entities yet, extracted
    from their summary (default, as the reference does) or the full text."""
    todo = missing_enrichments(transcripts, entity_store, "video_id", store_key="source_id")
    if use_summary:
        if statistics is None:
            statistics = N.corpus_statistics(transcripts)
        todo = (N.summarize(todo, "video_id", "text", summary_sentences, statistics)
                 .withColumnRenamed("summary", "text"))
    ents = extract_entities(todo, "video_id", "text", gazetteer=gazetteer,
                            proper_noun_type=proper_noun_type)
    return cleaned_entities(unique_entities(ents)).select("entity_type", "value", "source_id")


def classify_transcripts(transcripts: DataFrame, classification_store: DataFrame,
                         listing: DataFrame, channels: DataFrame, emotion_lexicon: DataFrame,
                         secondary_lexicon: DataFrame, sentiment_lexicon: DataFrame,
                         category: str = "", limit: int | None = None,
                         statistics: DataFrame | None = None) -> DataFrame:
    """Classification records for listed transcripts of a category's
    channels ('' = all) that have no classification yet, with the video's
    channel, title and publication time."""
    allowed = listing.join(channels_list(channels, category), "channel_id", "left_semi")
    todo = missing_enrichments(transcripts, classification_store, "video_id",
                               allowed=allowed.select("video_id"))
    kw = {} if limit is None else {"limit": limit}
    if statistics is None:
        statistics = N.corpus_statistics(transcripts)
    records = N.overall_classification(todo, emotion_lexicon, secondary_lexicon, sentiment_lexicon,
                                       key="video_id", statistics=statistics, **kw)
    # ids of the waiting texts, not of the records: the classification stands in the plan once
    return records.join(lookup_video_info(todo.select("video_id").distinct(), listing, channels), "video_id")


def update_new_classifications(classifications: DataFrame, listing: DataFrame,
                               transcripts: DataFrame,
                               statistics: DataFrame | None = None) -> DataFrame:
    """Classification records of listed videos whose main_topic is missing
    or '', with the main topic filled in from their transcript."""
    stale = stale_main_topic(classifications, listing)
    texts = transcripts.join(stale.select("video_id"), "video_id", "left_semi")
    if statistics is None:
        statistics = N.corpus_statistics(transcripts)
    topics = N.main_topic(texts, "video_id", "text", statistics)
    return stale.drop("main_topic").join(topics, "video_id", "left")


def append_results(rows: DataFrame, folder: str, key: str) -> DataFrame:
    """Append the rows whose key isn't stored yet, and return the store. A
    driver run twice adds nothing the second time."""
    return append_counted(rows, folder, key)[0]


def append_counted(rows: DataFrame, folder: str, key: str) -> tuple[DataFrame, int]:
    """``append_results`` and how many rows went in; the number is observed by
    the job that writes them, so nothing is read or computed for it."""
    spark = rows.sparkSession
    if path_exists(spark, folder):
        rows = rows.join(spark.read.parquet(folder).select(key).distinct(), key, "left_anti").select(*rows.columns)
    written = Observation()
    write_table(rows.observe(written, F.count(F.lit(1)).alias("rows")), folder, mode="append")
    return spark.read.parquet(folder), written.get["rows"]


def identify_new_topics(transcripts: DataFrame, topic_store: DataFrame, statistics, batch: str,
                        k: int = 3) -> DataFrame:
    """``identify_topics_for_all`` with stored statistics (``statistics_table``):
    the waiting transcripts are added to them under the batch's name and are
    the only texts that are tokenised. Repeating a batch adds nothing."""
    todo = missing_enrichments(transcripts, topic_store, "video_id", store_key="source_id")
    N.add_statistics(statistics, todo, batch)
    return N.topic_list(todo, "video_id", "text", k, N.stored_statistics(statistics)).select(
        "topic", F.col("video_id").alias("source_id"))


def write_back_topics(table, listing: DataFrame, transcripts: DataFrame, batch: str,
                      statistics: DataFrame | None = None) -> bool:
    """Fill the missing main topics of a stored classification table (a keyed
    table by source_id): only the filled rows are written. False if the batch
    was written before."""
    if batch in table.batches():
        return False
    rows = table.read().withColumnRenamed("source_id", "video_id")
    filled = update_new_classifications(rows, listing, transcripts, statistics).filter(F.col("main_topic").isNotNull())
    return table.change(filled.withColumnRenamed("video_id", "source_id"), batch=batch)
