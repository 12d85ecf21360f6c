"""Partitioning helpers (spread is a no-op on already parallel input, partial
top-k), growth of the short-form removal, the extractor's gazetteer path,
de-duplication over batches and replays."""

import random

from pyspark.sql import functions as F

from vigil.operators import entities as E
from vigil.operators import joins as J


def test_spread_is_noop_on_parallel_input(spark):
    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert J.spread(many, "id") is many
    one = spark.range(0, 1000, numPartitions=1)
    spread = J.spread(one, "id")
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r[0] for r in spread.collect()) == list(range(1000))


def test_top_k_partial_limit_plan(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    out = J.top_k(df, ["g"], [F.col("id").desc()], 2)
    assert sorted(tuple(r) for r in out.select("g", "id", "rank").collect()) == \
        [(0, 996, 2), (0, 999, 1), (1, 994, 2), (1, 997, 1), (2, 995, 2), (2, 998, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_extract_entities_gazetteer_and_patterns(spark):
    docs = spark.createDataFrame([("d1", "Justin Trudeau met Mark Carney on 12:30 in 2024, "
                                         "paid $5.5 and 10% for the 3rd of 7 Apples")],
                                 "video_id string, text string")
    gaz = spark.createDataFrame([("justin trudeau", "PERSON"), ("mark carney", "PERSON")],
                                "term string, entity_type string")
    got = sorted((r.pos, r.entity_type, r.value) for r in E.extract_entities(docs, gazetteer=gaz).collect())
    assert [p for p, _, _ in got] == sorted(p for p, _, _ in got)  # reading order
    assert [(t, v) for _, t, v in got] == [("PERSON", "Justin Trudeau"), ("PERSON", "Mark Carney"),
                              ("TIME", "12:30"), ("DATE", "2024"), ("MONEY", "$5.5"),
                                           ("PERCENT", "10%"), ("ORDINAL", "3rd"), ("CARDINAL", "7")]


def test_stream_dedup_over_batches_and_replays(spark, tmp):
    from vigil.streaming import jobs
    src, out = f"{tmp}/src", f"{tmp}/out"
    schema = "video_id string, title string"
    for k, rows in enumerate([[("v1", "b"), ("v1", "a"), ("v2", "c")], [("v2", "z"), ("v3", "d")]]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        jobs.stream_listing_dedup(spark, src, out, f"{tmp}/ck", spark.read.parquet(src).schema, "*.parquet")
    want = [("v1", "a"), ("v2", "c"), ("v3", "d")]
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(out).select("video_id", "title").collect())
    assert read() == want
    # all batches replayed from a lost checkpoint
    jobs.stream_listing_dedup(spark, src, out, f"{tmp}/ck2", spark.read.parquet(src).schema, "*.parquet")
    assert sorted({r[0] for r in read()}) == ["v1", "v2", "v3"]


def test_contained_values_stay_linear(spark):
    """Many values of one document with a common opening, of many lengths: the
    cut-out strings follow the values' letters, not the pairs."""
    values = [f"An Act to amend the {'Criminal ' * (i % 9)}Code respecting item {i}" for i in range(600)]
    e = spark.createDataFrame([("d", "LAW", v) for v in values], "source_id string, entity_type string, value string")
    assert E._contained_short(e.filter("length(value) <= 64")).count() < sum(map(len, values))
    assert E._contained_long(e).count() < sum(map(len, values))
    kept = {r.value for r in E.cleaned_entities(e).collect()}
    assert kept == {v for v in values if not any(v != w and v in w for w in values)}


def test_contained_in_a_very_long_value(spark):
    """100,000 letters with a period, a unique middle and values of all sizes inside."""
    rnd = random.Random(2)
    big = "ab" * 20_000 + "".join(rnd.choice("xyzé ") for _ in range(60_000))
    inside = [big[i:i + n] for i, n in ((0, 1), (0, 64), (0, 65), (39_990, 40), (40_100, 63), (41_000, 64), (41_000, 65),
                                        (45_000, 5_000), (99_000, 1_000), (1_020, 9), (99_999, 1))]
    outside = ["ab" * 30 + "c", big[41_000:41_070] + "Q", big[50_000:56_000] + "Q", "zzzzzzzzzzzzzzzz"]
    outside = [v for v in outside if v not in big]
    rows = [("d", "LAW", v) for v in {big, *inside, *outside}] + [("other", "LAW", inside[7]), ("d", "ORG", inside[7])]
    df = spark.createDataFrame(rows, "source_id string, entity_type string, value string")
    got = {tuple(r) for r in E.cleaned_entities(df).collect()}
    assert got == {("d", "LAW", big), ("other", "LAW", inside[7]), ("d", "ORG", inside[7])} | {("d", "LAW", v) for v in outside}


def test_long_runs_and_accents(spark):
    docs = spark.createDataFrame([("d", "The Royal Commission On The Future Of Health Care In Canada met"),
                                  ("q", "QUÉBEC et Québec")], "video_id string, text string")
    got = {r.value for r in E.extract_entities(docs, proper_noun_type="ORG").collect()}
    assert "The Royal Commission On The Future Of Health Care In Canada" in got and "Québec" in got
    idx = spark.createDataFrame([("q", "GPE", "QUÉBEC")], "source_id string, entity_type string, value string")
    assert [r.pattern_pos for r in E.match_patterns(idx, ["x", "québec"]).collect()] == [1]


def test_gazetteer_word_runs_in_any_case(spark):
    docs = spark.createDataFrame([("d", "Prime Minister Justin Trudeau spoke, justin trudeau left"), ("n", None)],
                                 "video_id string, text string")
    gaz = spark.createDataFrame([("justin trudeau", "PERSON"), ("Prime Minister", "NORP"), ("left", "LAW")],
                                "term string, entity_type string")
    got = sorted((r.pos, r.entity_type, r.value) for r in E.gazetteer_entities(docs, gaz).collect())
    assert got == [(0, "NORP", "Prime Minister"), (2, "PERSON", "Justin Trudeau"),
                   (5, "PERSON", "justin trudeau"), (7, "LAW", "left")]
