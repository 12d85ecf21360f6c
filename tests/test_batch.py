"""Batch drivers: only unenriched documents are scored."""

from vigil.operators import batch as BT

TR = "video_id string, text string"


def test_identify_topics_skips_stored(spark):
    tr = spark.createDataFrame([("a", "alpha alpha beta. gamma delta"), ("b", "beta beta zeta"),
                                ("c", "stored already here")], TR)
    store = spark.createDataFrame([("none", "c")], "topic string, source_id string")
    out = BT.identify_topics_for_all(tr, store, k=2)
    ids = {r.source_id for r in out.collect()}
    assert ids == {"a", "b"}
    top_a = [r.topic for r in out.collect() if r.source_id == "a"]
    assert "alpha" in top_a


def test_update_new_classifications_fills_main_topic(spark):
    clf = spark.createDataFrame(
        [("a", "s", None, True, "joy", "zest", ""), ("b", "s", None, False, "fear", "horror", "war"),
         ("z", "s", None, True, "joy", "zest", None)],
        "video_id string, summary string, summary_reasoning string, sentiment boolean, "
        "primary_emotion string, secondary_emotion string, main_topic string")
    listing = spark.createDataFrame([("a", "t", "p", "c"), ("b", "t", "p", "c")],
                                    "video_id string, title string, published_at string, channel_id string")
    tr = spark.createDataFrame([("a", "budget budget budget vote"), ("b", "war")], TR)
    out = {r.video_id: r.main_topic for r in BT.update_new_classifications(clf, listing, tr).collect()}
    assert out == {"a": "budget"}  # 'b' already has a topic, 'z' is not listed


def test_build_entities_from_summary(spark):
    tr = spark.createDataFrame([("a", "Justin Trudeau spoke. Justin went home. Nothing else here.")], TR)
    store = spark.createDataFrame([], "entity_type string, value string, source_id string")
    full = {r.value for r in BT.build_entities_for_all(tr, store, use_summary=False).collect()}
    assert "Justin Trudeau" in full and "Justin" not in full  # short form removed
    summ = BT.build_entities_for_all(tr, store, use_summary=True, summary_sentences=1).collect()
    assert {r.source_id for r in summ} <= {"a"}


def test_topics_do_not_depend_on_what_is_waiting(spark):
    from vigil.operators import enrich as N
    tr = spark.createDataFrame([("a", "zebra zebra zebra apple"), ("b", "apple pear"), ("c", "apple plum")], TR)
    stored = spark.createDataFrame([("x", "b"), ("x", "c")], "topic string, source_id string")
    full = {r.video_id: r.topic for r in N.topic_list(tr, k=1).collect()}
    alone = [r.topic for r in BT.identify_topics_for_all(tr, stored, k=1).collect()]
    assert alone == [full["a"]] == ["zebra"]
    parts = [N.term_statistics(tr.filter("video_id = 'a'")), N.term_statistics(tr.filter("video_id <> 'a'"))]
    merged = N.merge_statistics(*parts)
    assert sorted(map(str, merged.collect())) == sorted(map(str, N.term_statistics(tr).collect()))


def test_short_words_reach_the_lexicons(spark):
    from vigil.operators import enrich as N
    tr = spark.createDataFrame([("a", "war and tax"), ("b", "JOY"), ("c", "nothing")], TR)
    lex = spark.createDataFrame([("joy", "joy", 1.0), ("war", "fear", 1.0)], "term string, label string, weight double")
    assert {r.video_id: r.emotion for r in N.classify_emotion(tr, lex).collect()} == {"a": "fear", "b": "joy", "c": None}
