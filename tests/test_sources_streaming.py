"""Legacy per-document readers (schema drift), CSV/JSON readers, refresh of
the index from folders, and streaming runs."""

import json
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from vigil.operators import catalog as C
from vigil.operators import index as IX
from vigil.sources import files as FS
from vigil.streaming import jobs

SF_SMALL = "/root/testdata/sf0.001"


def _pq(path, df, **kw):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.Table.from_pandas(df, **kw), path, compression="gzip")


def test_transcripts_legacy_column_and_order(spark, tmp):
    f = f"{tmp}/transcripts"
    _pq(f"{f}/v1_transcript.parquet", pd.DataFrame({"text": ["b", "a"], "start": [2.0, 1.0],
                                                    "duration": [1.0, 1.0]}))
    _pq(f"{f}/v2_transcript.parquet", pd.DataFrame({"transcript": ["old"], "start": [0.0],
                                                    "duration": [1.0]}))
    docs = dict(tuple(r) for r in C.assemble_text(FS.read_transcripts(spark, f)).collect())
    assert docs == {"v1": "a b", "v2": "old"}


def test_classifications_drift_and_missing_values(spark, tmp):
    f = f"{tmp}/classifications"
    _pq(f"{f}/a_classification.parquet", pd.DataFrame([{
        "summary": "s", "summary_reasoning": "r", "sentiment": True,
        "primary_emotion": "joy", "secondary_emotion": "zest"}]))
    _pq(f"{f}/b_classification.parquet", pd.DataFrame([{
        "summary": "None", "summary_reasoning": "", "sentiment": False,
        "primary_emotion": "fear", "secondary_emotion": "horror", "main_topic": ""}]))
    rows = {r.video_id: r for r in FS.read_classifications(spark, f).collect()}
    assert rows["a"].main_topic is None and rows["a"].summary == "s"
    assert rows["b"].summary is None and rows["b"].summary_reasoning is None
    assert rows["b"].main_topic is None


def test_entities_stray_index_and_skip_list(spark, tmp):
    f = f"{tmp}/entities"
    df = pd.concat([pd.DataFrame([{"entity_type": "PERSON", "value": "A"}]),
                    pd.DataFrame([{"entity_type": "GPE", "value": "B"}])])
    _pq(f"{f}/v1_entities.parquet", df)  # index not reset -> __index_level_0__
    got = sorted(tuple(r) for r in FS.read_entities(spark, f).collect())
    assert got == [("GPE", "B", "v1"), ("PERSON", "A", "v1")]
    _pq(f"{tmp}/skip/a.parquet", pd.DataFrame({"video_id": []}))  # typed double by pandas
    _pq(f"{tmp}/skip/b.parquet", pd.DataFrame({"video_id": ["x", "x", "y"]}))
    assert sorted(r[0] for r in FS.read_skip_list(spark, f"{tmp}/skip").collect()) == ["x", "y"]


def test_dim_emotions_bom_and_channels(spark, tmp):
    p = f"{tmp}/dim_emotions.csv"
    with open(p, "w", encoding="utf-8-sig") as fh:
        fh.write("emotion,primary,emotion_id\nanger,1,2\nsurprise,1,26\nsurprise,0,27\n")
    rows = FS.read_dim_emotions(spark, p).collect()
    assert rows[0].emotion == "anger" and len(rows) == 3
    c = f"{tmp}/channels.csv"
    with open(c, "w", encoding="utf-8") as fh:
        fh.write("channel_id,channel_title,category,region\nUC1,CBC,News,Canada\nUC2,X,Sports,US\n")
    ch = FS.read_channels(spark, c)
    assert [r[0] for r in C.channels_list(ch, "news").collect()] == ["UC1"]
    assert C.channels_list(ch, "").count() == 2


def test_search_pages_json(spark, tmp):
    page = {"kind": "youtube#searchListResponse", "etag": "e", "regionCode": "CA", "items": [
        {"kind": "youtube#searchResult", "etag": "1", "id": {"kind": "youtube#video", "videoId": "v1"},
         "snippet": {"publishedAt": "2024-01-01T00:00:00Z", "channelId": "c", "title": "A &amp;#39; B",
                     "description": "d", "thumbnails": {"default": {"url": "u", "width": 1, "height": 1}},
                     "channelTitle": "C&amp;D", "liveBroadcastContent": "none",
                     "publishTime": "2024-01-01T00:00:00Z"}},
        {"kind": "youtube#searchResult", "etag": "2", "id": {"kind": "youtube#channel", "channelId": "c"},
         "snippet": {}}]}
    os.makedirs(f"{tmp}/pages")
    with open(f"{tmp}/pages/p.json", "w") as fh:
        fh.write(json.dumps(page) + "\n")
    items = FS.read_search_pages(spark, f"{tmp}/pages")
    flat = {r.etag: r for r in C.search_item_fields(items).collect()}
    assert flat["1"].video_id == "v1" and flat["1"].title == "A &#39; B"
    assert flat["1"].channel_title == "C&D"
    assert flat["2"].video_id is None and flat["2"].title is None and not flat["2"].is_video
    vids = C.videos_only(items).collect()
    assert [(r.video_id, r.title) for r in vids] == [("v1", "A &amp;#39; B")]
    assert items.select("nextPageToken").first()[0] is None


def test_refresh_index_from_folders(spark, tmp):
    root = f"{tmp}/store"
    FS.init_store(spark, root)
    _pq(f"{root}/channels/c1_search.parquet",
        pd.DataFrame({"video_id": ["v1"], "title": ["t"], "published_at": ["p"]}))
    _pq(f"{root}/transcripts/v1_transcript.parquet",
        pd.DataFrame({"text": ["x"], "start": [0.0], "duration": [1.0]}))
    _pq(f"{root}/classifications/v1_classification.parquet", pd.DataFrame([{
        "summary": "s", "summary_reasoning": "r", "sentiment": True, "primary_emotion": "joy",
        "secondary_emotion": "zest", "main_topic": "m"}]))
    up = IX.refresh_index(spark, root)
    got = {r.source_id: (r.doc_type_id, r.action, r.primary_emotion) for r in up.collect()}
    assert got == {"c1": (3, "insert", None), "v1": (2, "insert", "joy")}
    idx = FS.read_index(spark, root)
    assert sorted(r.lib_key for r in idx.collect()) == [1, 2]
    again = IX.refresh_index(spark, root)
    assert not IX.index_changed(again)


def test_stream_transcripts_incremental(spark, tmp):
    src, out, ck = f"{tmp}/src", f"{tmp}/out", f"{tmp}/ck"
    seg = "text string, start double, duration double"
    schema = spark.createDataFrame([], seg).schema
    _pq(f"{src}/a_transcript.parquet", pd.DataFrame({"text": ["y", "x"], "start": [1.0, 0.0],
                                                     "duration": [1.0, 1.0]}))
    jobs.stream_transcripts(spark, src, out, ck, schema)
    assert {tuple(r) for r in spark.read.parquet(out).select("video_id", "text").collect()} == \
        {("a", "x y")}
    _pq(f"{src}/b_transcript.parquet", pd.DataFrame({"text": ["z"], "start": [0.0],
                                                     "duration": [1.0]}))
    jobs.stream_transcripts(spark, src, out, ck, schema)
    per_batch = spark.read.parquet(out).groupBy("batch").count().collect()
    assert len(per_batch) == 2 and all(r["count"] == 1 for r in per_batch)
    jobs.stream_transcripts(spark, src, out, ck, schema)  # nothing new: no new batch
    assert spark.read.parquet(out).count() == 2


def test_stream_listing_dedup_across_batches(spark, tmp):
    src, out, ck = f"{tmp}/src", f"{tmp}/out", f"{tmp}/ck"
    cols = {"video_id": ["v1", "v2"], "title": ["a", "b"],
            "published_at": ["p", "p"], "channel_id": ["c", "c"]}
    _pq(f"{src}/1_search.parquet", pd.DataFrame(cols))
    schema = spark.read.parquet(f"{src}/1_search.parquet").schema
    jobs.stream_listing_dedup(spark, src, out, ck, schema, "*_search.parquet")
    _pq(f"{src}/2_search.parquet", pd.DataFrame({**cols, "video_id": ["v2", "v3"]}))
    jobs.stream_listing_dedup(spark, src, out, ck, schema, "*_search.parquet")
    assert sorted(r[0] for r in spark.read.parquet(out).select("video_id").collect()) == \
        ["v1", "v2", "v3"]


def test_enrich_with_map_in_pandas_scorer(spark):
    from vigil.operators import enrich as N
    docs = spark.createDataFrame([("a", "good day"), ("b", "bad day"), ("c", "done")],
                                 "video_id string, text string")
    store = spark.createDataFrame([("c",)], "video_id string")

    def scorer(batches):  # a user's model: loaded once per worker, Arrow batches in/out
        for pdf in batches:
            yield pd.DataFrame({"video_id": pdf.video_id,
                                "sentiment": pdf.text.str.contains("good")})
    out = N.enrich(docs, "video_id", scorer, "video_id string, sentiment boolean", store)
    assert sorted(tuple(r) for r in out.collect()) == [("a", True), ("b", False)]


def test_compact_legacy_store(spark, tmp):
    root = f"{tmp}/legacy"
    for v, texts in {"a": ["x", "y"], "b": ["z"]}.items():
        _pq(f"{root}/transcripts/{v}_transcript.parquet",
            pd.DataFrame({"text": texts, "start": [float(i) for i in range(len(texts))],
                          "duration": [1.0] * len(texts)}))
    _pq(f"{root}/channels/c1_search.parquet",
        pd.DataFrame({"video_id": ["a", "b"], "title": ["t", "u"], "published_at": ["p", "q"]}))
    out = FS.compact_legacy_store(spark, root, f"{tmp}/compact", files_per_table=2)
    assert set(out) == {"transcripts", "channel_search"}
    seg = spark.read.parquet(out["transcripts"])
    assert dict(tuple(r) for r in C.assemble_text(seg).collect()) == {"a": "x y", "b": "z"}
    lst = spark.read.parquet(out["channel_search"])
    assert sorted((r.video_id, r.channel_id) for r in lst.collect()) == [("a", "c1"), ("b", "c1")]


def _in_parts(spark, tmp, *names):
    """The small tables, each of ``names`` as a folder of part files."""
    for f in os.listdir(SF_SMALL):
        if f.removesuffix(".parquet") in names:
            spark.read.parquet(f"{SF_SMALL}/{f}").repartition(3).write.parquet(f"{tmp}/{f}")
        else:
            os.symlink(f"{SF_SMALL}/{f}", f"{tmp}/{f}")
    return tmp


def test_stream_index_upsert_reads_a_table_of_part_files(spark, tmp):
    read = lambda d: sorted(map(str, jobs.run_stream_index_upsert(spark, d).collect()))
    whole = read(SF_SMALL)
    assert len(whole) > 0 and read(_in_parts(spark, tmp, "documents", "labels")) == whole


def test_stream_transcripts_reads_a_table_of_part_files(spark, tmp):
    read = lambda d: sorted(map(str, jobs.run_stream_transcripts(spark, d).collect()))
    whole = read(SF_SMALL)
    assert len(whole) > 0 and read(_in_parts(spark, tmp, "conversations")) == whole


def test_per_document_files_are_written_by_many_tasks(spark, tmp):
    """Small rows are few bytes and many files: they aren't merged into one task."""
    rows = spark.range(2000).selectExpr("cast(id % 500 as string) AS video_id", "id AS n", "timestamp_micros(id) AS at")
    spark.sparkContext.setJobGroup("per-document", "")
    assert FS.write_per_document(rows, "video_id", f"{tmp}/many", "_x.parquet") == 2000
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("per-document") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("", "")
    tasks = [tracker.getStageInfo(s).numTasks for s in stages[1:] if tracker.getStageInfo(s)]
    assert max(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = FS.read_keyed(spark, f"{tmp}/many", "_x.parquet", rows.drop("video_id").schema, "video_id")
    assert sorted(map(str, back.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))


def test_a_hot_key_over_many_batches_is_one_file(spark, tmp):
    rows = spark.range(25000).selectExpr("CASE WHEN id < 24000 THEN 7L ELSE id END AS k", "id AS n")
    assert FS.write_per_document(rows, "k", f"{tmp}/hot", "_x.parquet") == 25000
    assert pq.read_table(f"{tmp}/hot/7_x.parquet").num_rows == 24000 and len(os.listdir(f"{tmp}/hot")) == 1001


def test_per_document_files_are_read_by_a_fixed_number_of_tasks(spark, tmp):
    """Small files aren't dealt 32 to a task, and come back by name: other column
    orders, missing, stray, all-null and dictionary columns, empty files."""
    f, n = f"{tmp}/entities", 700
    for i in range(n):
        _pq(f"{f}/v{i}_entities.parquet", pd.DataFrame({"value": [f"x{i}", "y"], "entity_type": ["A", None], "other": [i, i]}))
    _pq(f"{f}/empty_entities.parquet", pd.DataFrame({"entity_type": [], "value": []}))
    _pq(f"{f}/null_entities.parquet", pd.DataFrame({"ENTITY_TYPE": [None], "__index_level_0__": [3]}))
    _pq(f"{f}/cat_entities.parquet", pd.DataFrame({"entity_type": pd.Series(["B"], dtype="category"), "value": ["z"]}))
    rows = FS.read_entities(spark, f)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    assert rows.rdd.getNumPartitions() <= tasks
    want = [("A", f"x{i}", f"v{i}") for i in range(n)] + [(None, "y", f"v{i}") for i in range(n)]
    want += [(None, None, "null"), ("B", "z", "cat")]
    assert sorted(map(str, map(tuple, rows.collect()))) == sorted(map(str, want))


def test_a_document_file_of_another_type_is_an_error(spark, tmp):
    _pq(f"{tmp}/entities/v1_entities.parquet", pd.DataFrame({"entity_type": ["A"], "value": [1.5]}))
    with pytest.raises(Exception, match="value"):
        FS.read_entities(spark, f"{tmp}/entities").collect()


def test_files_of_documents_are_listed_by_a_task(spark, tmp):
    """The listing equals Spark's own, for names of any letters, without the
    hidden, empty and nested ones, but the driver doesn't hold the files."""
    f = f"{tmp}/a store é"
    names = ["a b", "é", "p%20q", "a+b&c=d,e;f:g@h!~'()*$", "[z]{y}", "\xa0n", "#h?q", "_hidden", ".dot", "_k=v", 'q"<>^`|', "a\\b", "-d", "\u2028l", "\x07c"]
    for i, n in enumerate([*names, *(f"v{i}" for i in range(60))]):
        _pq(f"{f}/classifications/{n}_classification.parquet", pd.DataFrame({"main_topic": [str(i)]}))
    open(f"{f}/classifications/zero_classification.parquet", "w").close()
    _pq(f"{f}/classifications/sub/in_classification.parquet", pd.DataFrame({"main_topic": ["x"]}))
    _pq(f"{f}/classifications/other.parquet", pd.DataFrame({"main_topic": ["x"]}))
    want = (spark.read.format("binaryFile").option("pathGlobFilter", "*_classification.parquet").load(f"{f}/classifications")
            .selectExpr("path", "_metadata.file_path", "_metadata.file_name", "modificationTime", "length"))
    got = FS.list_files(spark, f"{f}/classifications", "_classification.parquet")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and len(want.inputFiles()) > 70
    rows, stored = FS.read_classifications(spark, f"{f}/classifications"), FS.store_inventory(spark, f)
    assert rows.count() == stored.count() == 73 and len(rows.inputFiles()) + len(stored.inputFiles()) < 5
    assert {r.video_id for r in rows.filter("main_topic IN ('0', '14', '2')").collect()} == {"a%20b", "%07c", "p%2520q"}
    os.makedirs(f"{f}/transcripts")
    assert FS.document_inventory(spark, f).count() == 0 and FS.read_transcripts(spark, f"{f}/transcripts").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        FS.read_entities(spark, f"{f}/entities")


def test_a_listing_is_that_of_its_moment(spark, tmp):
    """Files that come later are the next listing's, in every use of the first."""
    f = f"{tmp}/entities"
    _pq(f"{f}/v1_entities.parquet", pd.DataFrame({"entity_type": ["A"], "value": ["x"]}))
    rows = FS.read_entities(spark, f)
    _pq(f"{f}/v2_entities.parquet", pd.DataFrame({"entity_type": ["A"], "value": ["y"]}))
    assert rows.count() == rows.count() == 1 and FS.read_entities(spark, f).count() == 2


def test_files_are_not_sent_to_every_task(spark, tmp):
    """File tables are merged, however small their compressed files look."""
    from vigil import schemas as S
    _pq(f"{tmp}/classifications/v1_classification.parquet", pd.DataFrame({"main_topic": ["a"]}))
    _pq(f"{tmp}/classifications/v2_classification.parquet", pd.DataFrame({"main_topic": ["b"]}))
    seen = FS.store_inventory(spark, tmp)
    FS.write_table(seen.filter("source_id = 'v1'"), f"{tmp}/known")
    known = spark.read.schema(S.INVENTORY).parquet(f"{tmp}/known")
    changed, gone = IX.inventory_changes(seen, known)
    rows = FS.read_classifications(spark, f"{tmp}/classifications", modified_since=0, paths=changed.select("path"))
    for df in (changed, gone, rows):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [r.source_id for r in changed.collect()] == ["v2"] and gone.count() == 0
    assert [(r.video_id, r.main_topic) for r in rows.collect()] == [("v2", "b")]
