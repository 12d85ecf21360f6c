"""Catalogue joins and index maintenance on small inline frames."""

from pyspark.sql import functions as F

from vigil.operators import analysis as A
from vigil.operators import catalog as C
from vigil.operators import index as IX
from vigil.schemas import LIBRARY_INDEX

LISTING = "video_id string, title string, published_at string, channel_id string"


def test_append_new_listing_semantics_and_stability(spark):
    old = spark.createDataFrame([("v1", "A", "2024-01-01T00:00:00Z", "c1")], LISTING)
    new = spark.createDataFrame([("v1", "A2", "2024-01-01T00:00:00Z", "c1"),
                                 ("v2", "B", "2024-01-02T00:00:00Z", "c1"),
                                 ("v2", "B-other", "2024-01-02T00:00:00Z", "c1")], LISTING)
    once = C.append_new_listing(new, old)
    got = sorted(tuple(r) for r in once.collect())
    # stored v1 wins over the new page's v1; a repeat inside the new batch survives
    assert got == sorted([("v1", "A", "2024-01-01T00:00:00Z", "c1"),
                          ("v2", "B", "2024-01-02T00:00:00Z", "c1"),
                          ("v2", "B-other", "2024-01-02T00:00:00Z", "c1")])
    twice = C.append_new_listing(new, once)
    assert sorted(tuple(r) for r in twice.collect()) == got


def test_fetch_channel_first_hit_and_default(spark):
    listing = spark.createDataFrame([("v1", "t", "p", "c2"), ("v1", "t", "p", "c1"),
                                     ("v2", "t", "p", "c3")], LISTING)
    vids = spark.createDataFrame([("v1",), ("v9",)], "video_id string")
    got = dict(tuple(r) for r in C.fetch_channel(vids, listing).collect())
    assert got == {"v1": "c1", "v9": ""}


def test_missing_and_with_transcripts(spark):
    listing = spark.createDataFrame([(v, "t", "p", "c") for v in ["a", "b", "c", "d"]], LISTING)
    skip = spark.createDataFrame([("b",)], "video_id string")
    tr = spark.createDataFrame([("c", "x"), ("b", "y")], "video_id string, text string")
    assert {r[0] for r in C.missing_transcripts(listing, skip, tr).collect()} == {"a", "d"}
    ok = C.videos_with_transcripts(listing, skip, tr)
    assert [(r.video_id, r.code) for r in ok.collect()] == [("c", True)]


def test_latest_videos_per_channel(spark):
    rows = [(f"v{i}", "t", f"2024-01-{i + 1:02d}T00:00:00Z", "c1" if i % 2 else "c2")
            for i in range(10)]
    out = C.latest_videos(spark.createDataFrame(rows, LISTING), max_pages=1, page_size=2)
    got = sorted((r.channel_id, r.video_id, r.rank) for r in out.collect())
    assert got == [("c1", "v7", 2), ("c1", "v9", 1), ("c2", "v6", 2), ("c2", "v8", 1)]


def _idx_rows(spark, rows):
    return spark.createDataFrame(rows, LIBRARY_INDEX)


def test_upsert_actions_and_keys(spark):
    base = dict(doc_type_id=2, source_system_id=2, summary="s", summary_reasoning="r",
                secondary_emotion="rage")

    def row(key, path, dtm, sent, emo, topic, **kw):
        d = dict(base, lib_key=key, source_id=path, path=path, rec_mod_dtm=dtm,
                 sentiment=sent, primary_emotion=emo, main_topic=topic)
        d.update(kw)
        return tuple(d[f.name] for f in LIBRARY_INDEX.fields)
    cur = _idx_rows(spark, [row(1, "p1", "t1", True, "joy", "x"),
                            row(2, "p2", "t1", None, None, None),
                            row(5, "p3", "t1", False, "fear", "y")])
    inc = _idx_rows(spark, [row(None, "p1", "t1", True, "joy", "x", summary="changed"),
                            row(None, "p2", "t1", None, None, None),
                            row(None, "p3", "t2", False, "fear", "y"),
                            row(None, "p5", "t1", True, "joy", "z"),
                            row(None, "p4", "t1", True, "joy", "z")]).drop("lib_key")
    up = IX.upsert_index(cur, inc)
    got = {r.path: (r.lib_key, r.action, r.summary, r.rec_mod_dtm) for r in up.collect()}
    assert got["p1"] == (1, "keep", "s", "t1")          # summary-only change is not tracked
    assert got["p2"][:2] == (2, "keep")                 # nulls on both sides are equal
    assert got["p3"] == (5, "update", "s", "t2")
    assert got["p4"][:2] == (6, "insert") and got["p5"][:2] == (7, "insert")
    assert IX.index_changed(up)
    # idempotent: the result fed back as current gives no changes
    again = IX.upsert_index(IX.index_rows(up), inc)
    assert not IX.index_changed(again)


def test_dense_keys_many_partitions(spark):
    df = spark.range(0, 1000).select(F.format_string("p%04d", "id").alias("path"))
    keyed = IX.assign_dense_keys(df.repartition(7), "path", 100, partitions=5)
    rows = sorted((r.path, r.lib_key) for r in keyed.collect())
    assert [k for _, k in rows] == list(range(101, 1101))


def test_topics_by_channel_drops_null_keys_and_none(spark):
    rows = [("war", "CBC", "anger", "rage", "2024-09-02T12:00:00Z", "t1"),
            ("war", "CBC", "anger", "rage", "2024-09-02T13:00:00Z", None),
            ("none", "CBC", "anger", "rage", "2024-09-02T12:00:00Z", "t3"),
            ("war", None, "anger", "rage", "2024-09-02T12:00:00Z", "t4"),
            ("war", "CBC", "anger", "rage", "2024-06-01T12:00:00Z", "t5")]
    df = spark.createDataFrame(rows, "topic string, channel_title string, primary_emotion string, "
                                     "secondary_emotion string, published_at string, title string")
    df = df.withColumn("published_at", A.parse_published_at(F.col("published_at")))
    out = A.topics_by_channel(df, "2024-09-10 00:00:00", 60).collect()
    assert [(r.topic, r.channel, r.videos) for r in out] == [("war", "CBC", 1)]


def test_search_filter_orders(spark):
    rows = [("v1", "Budget vote", "2024-01-02T00:00:00Z", "c1"),
            ("v2", "budget talk", "2024-01-03T00:00:00Z", "c2"),
            ("v3", "Weather", "2024-01-04T00:00:00Z", "c1"),
            ("v4", "A budget", "2023-12-31T00:00:00Z", "c1")]
    lst = spark.createDataFrame(rows, LISTING)
    by_date = C.search_filter(lst, "BUDGET", published_after="2024-01-01T00:00:00Z")
    assert [r.video_id for r in by_date.collect()] == ["v2", "v1"]
    by_title = C.search_filter(lst, "budget", order="title", max_results=2)
    assert [r.video_id for r in by_title.collect()] == ["v4", "v1"]
    assert [r.video_id for r in C.search_filter(lst, channel_id="c2").collect()] == ["v2"]


def test_instants_of_any_iso_form(spark):
    from pyspark.sql import functions as F
    from vigil.functions.timefn import instant
    from vigil.operators import catalog as C
    rows = [("a", "2024-01-01T00:00:07.000Z"), ("b", "2024-01-01T02:00:07+02:00"), ("c", "2024-01-01T00:00:07"),
            ("d", "2024-01-01"), ("e", "soon"), ("f", None), ("g", "2023-12-31T23:59:59Z")]
    df = spark.createDataFrame([(i, "t", p, "c") for i, p in rows],
                               "video_id string, title string, published_at string, channel_id string")
    got = {r.video_id: r.s for r in df.select("video_id", F.unix_timestamp(instant("published_at")).alias("s")).collect()}
    assert got == {"a": 1704067207, "b": 1704067207, "c": 1704067207, "d": 1704067200, "e": None, "f": None, "g": 1704067199}
    found = C.search_filter(df, published_after="2024-01-01T00:00:07Z").collect()
    assert [r.video_id for r in found] == ["a", "b", "c"]
    assert [r.video_id for r in C.latest_videos(df, page_size=4).collect()] == ["a", "b", "c", "d"]


def test_upsert_keeps_the_newest_row_of_a_path(spark):
    from vigil.schemas import LIBRARY_INDEX
    row = lambda path, stamp: (None, "s", stamp, 2, 2, path, None, None, False, None, None, None)
    df = lambda rows: spark.createDataFrame(rows, LIBRARY_INDEX)
    up = IX.upsert_index(df([]), df([row("p", "2024-01-01 00:00:00"), row("p", "2024-02-01 00:00:00"), row("o", "x")]))
    assert sorted((r.path, r.lib_key, r.rec_mod_dtm, r.action) for r in up.collect()) == [
        ("o", 1, "x", "insert"), ("p", 2, "2024-02-01 00:00:00", "insert")]


def test_upsert_batch_replay_changes_nothing(spark, tmp):
    from vigil.schemas import LIBRARY_INDEX
    from vigil.sources import files as FS
    from vigil.streaming.jobs import upsert_batch
    rows = spark.createDataFrame([(None, "s", "2024", 2, 2, "p", None, None, False, None, None, None)], LIBRARY_INDEX)
    FS.init_store(spark, tmp)
    for _ in range(3):
        upsert_batch(spark, tmp, rows, 7)
        assert [r.action for r in spark.read.parquet(f"{tmp}/upserts").collect()] == ["insert"]
        assert len(FS.list_versions(spark, f"{tmp}/library_index")) == 2
        assert FS.read_index(spark, tmp).count() == 1


def test_null_keys_are_not_dropped_by_the_legacy_writer(spark, tmp):
    import pytest
    from vigil.sources import files as FS
    df = spark.createDataFrame([("a", "x"), (None, "y")], "video_id string, text string")
    with pytest.raises(Exception, match="null video_id"):
        FS.write_per_document(df, "video_id", f"{tmp}/t", "_t.parquet")
