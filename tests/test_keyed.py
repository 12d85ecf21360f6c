"""Keyed tables, delta upsert and incremental refresh."""

import glob
import os
import random
import time

import pytest
from pyspark.sql import types as T

from vigil.operators import index as IX
from vigil.schemas import LIBRARY_INDEX, SUFFIX_CLASSIFICATION, SUFFIX_SEARCH, SUFFIX_TRANSCRIPT
from vigil.sources import files as FS
from vigil.sources.keyed import KeyedTable

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_changes_compaction_and_vacuum_against_a_dict(spark, tmp):
    rnd, t, want = random.Random(1), KeyedTable(spark, f"{tmp}/t", KV, "k", buckets=5), {}
    assert _rows(t.read()) == [] and t.seq() == 0 and t.compact() == []
    for step in range(7):
        new = {f"k{rnd.randrange(40)}": rnd.randrange(1000) for _ in range(rnd.choice([0, 3, 12]))}
        gone = {f"k{rnd.randrange(40)}" for _ in range(4)} - set(new)
        args = {"batch": f"b{step}", "gone": spark.createDataFrame([(k,) for k in gone], "k string")}
        df = spark.createDataFrame([*new.items(), (None, 5)], KV)
        assert t.change(df, **args) and not t.change(df, **args)
        want = {k: v for k, v in {**want, **new}.items() if k not in gone}
        assert _rows(t.read()) == sorted(want.items())
        if step in (2, 5):
            t.compact()
            assert _rows(t.read()) == sorted(want.items()) and t.compact() == []
    assert t.batches() == {f"b{i}" for i in range(7)}
    before = len(glob.glob(f"{tmp}/t/data/*/bucket=*"))
    assert t.vacuum() > 0
    assert len(glob.glob(f"{tmp}/t/data/*/bucket=*")) < before
    assert _rows(t.read()) == sorted(want.items())


def test_a_change_writes_and_reads_its_own_buckets(spark, tmp):
    t = KeyedTable(spark, f"{tmp}/t", KV, "k", buckets=16)
    t.change(spark.range(4000).selectExpr("concat('k', id) AS k", "id AS v"))
    size = lambda: sum(os.path.getsize(f) for f in glob.glob(f"{tmp}/t/data/*/*/*.parquet"))
    whole = size()
    t.change(spark.createDataFrame([("k7", -7)], KV))
    assert size() - whole < whole / 10
    touched = t.buckets_of(spark.createDataFrame([("k7",)], "k string"))
    assert len(touched) == 1
    plan = t.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert f"bucket={touched[0]}" in plan and f"bucket={(touched[0] + 1) % 16}" not in plan
    assert t.compact() == touched
    # untouched buckets still lie where the first change put them
    assert len({r.folder for r in t._manifest() if r.folder and r.bucket not in touched}) == 1


def test_failed_change_leaves_nothing(spark, tmp):
    from pyspark.sql import functions as F
    t = KeyedTable(spark, f"{tmp}/t", KV, "k", buckets=2)
    t.change(spark.createDataFrame([("a", 1)], KV))
    with pytest.raises(Exception):  # noqa: B017
        t.change(spark.range(50).select(F.col("id").cast("string").alias("k"), F.raise_error(F.lit("no")).cast("long").alias("v")))
    assert _rows(t.read()) == [("a", 1)]


def _index_rows(spark, rows):
    return spark.createDataFrame([(k, s, m, 2, 2, f"p/{s}", "s", None, sent, "joy", "zest", topic)
                                  for k, s, m, sent, topic in rows], LIBRARY_INDEX)


def test_delta_upsert_equals_whole_upserts(spark, tmp):
    rnd = random.Random(4)
    make = lambda ids: _index_rows(spark, [(None, f"d{i}", f"m{rnd.randrange(2)}", rnd.random() < 0.5, rnd.choice(["a", None]))
                                           for i in ids])
    first = _index_rows(spark, [(i + 1, f"d{i}", "m0", True, "a") for i in range(30)])
    table, whole = IX.index_table(spark, tmp, 8), first
    assert IX.load_index(table, first) and not IX.load_index(table, first)
    for n, ids in enumerate([[3, 4, 31, 32], [31, 40, 41, 5, 5], [0], [99]]):
        batch = make(ids).drop("lib_key")
        up = IX.upsert_delta(table, batch, f"b{n}")
        IX.upsert_delta(table, batch, f"b{n}")          # a replay
        whole = IX.index_rows(IX.upsert_index(whole, batch))
        whole = spark.createDataFrame(whole.collect(), LIBRARY_INDEX)
        assert sorted(map(str, _rows_of(table.read()))) == sorted(map(str, _rows_of(whole)))
        assert {r.path for r in up.collect()} >= {f"p/d{i}" for i in ids}
        if n == 1:
            table.compact()
    assert table.note() == 35 and table.read().count() == 35


def _rows_of(df):
    return [tuple(r) for r in df.collect()]


def _put(spark, folder, name, rows, schema):
    """One legacy file, in place of an older one."""
    import pyarrow.parquet as pq
    os.makedirs(folder, exist_ok=True)
    pq.write_table(spark.createDataFrame(rows, schema).toArrow(), f"{folder}/{name}")


CLF = "summary string, sentiment boolean, primary_emotion string, main_topic string"


def _label(spark, root, vid, topic, sentiment=True):
    _put(spark, f"{root}/classifications", vid + SUFFIX_CLASSIFICATION, [("s", sentiment, "joy", topic)], CLF)


def _state(df):
    return sorted((r.path.rsplit("/", 1)[1], r.source_id, r.doc_type_id, r.rec_mod_dtm, r.sentiment, r.main_topic) for r in df.collect())


def test_incremental_refresh_equals_full_and_opens_changed_files_only(spark, tmp):
    root = f"{tmp}/store"
    FS.init_store(spark, root)
    for c in "xy":
        _put(spark, f"{root}/channels", c + SUFFIX_SEARCH, [("v1", "t")], "video_id string, title string")
    for v in ("v1", "v2", "v3", "v4"):
        _put(spark, f"{root}/transcripts", v + SUFFIX_TRANSCRIPT, [("hello", 0.0)], "text string, start double")
    for v in ("v1", "v2", "v9"):
        _label(spark, root, v, "news")
    full = lambda: _state(IX.refresh_index(spark, root, write=False))

    def step():
        up = IX.refresh_incremental(spark, root, buckets=4).collect()
        got = _state(IX.index_table(spark, root, 4).read())
        return {(r.path.rsplit("/", 1)[1].split("_")[0], r.action) for r in up if r.action != "keep"}, got
    ups, got = step()
    assert ups == {(n, "insert") for n in ("x", "y", "v1", "v2", "v3", "v4")} and got == full()

    # nothing changed: nothing is opened. Old files that can't be read any more prove it
    old = time.time() - 5_000
    for f in glob.glob(f"{root}/classifications/*.parquet"):
        os.utime(f, (old, old))
    step()
    for f in glob.glob(f"{root}/classifications/*.parquet"):
        data = open(f, "rb").read()
        open(f, "wb").write(b"\0" * len(data))
        os.utime(f, (old, old))
    ups, got = step()
    assert ups == set()

    # a new label, a changed label, a changed transcript, a removed label
    time.sleep(1.1)
    _label(spark, root, "v3", "sport", sentiment=False)
    _label(spark, root, "v2", "arts")
    _put(spark, f"{root}/transcripts", "v4" + SUFFIX_TRANSCRIPT, [("hello again", 0.0), ("x", 1.0)], "text string, start double")
    os.remove(f"{root}/classifications/v9{SUFFIX_CLASSIFICATION}")
    ups, got = step()
    assert ups == {("v3", "update"), ("v2", "update"), ("v4", "update")}
    assert {(s, topic) for _, s, kind, _, _, topic in got if kind == 2} == {
        ("v1", "news"), ("v2", "arts"), ("v3", "sport"), ("v4", None)}
    # v1's label is gone: its row loses it, as in a full refresh of what is there
    os.remove(f"{root}/classifications/v1{SUFFIX_CLASSIFICATION}")
    ups, got = step()
    assert ups == {("v1", "update")} and got == full()
    # a copied-in file that is older than all others is seen too
    _label(spark, root, "v4", "late")
    os.utime(f"{root}/classifications/v4{SUFFIX_CLASSIFICATION}", (old - 9_000, old - 9_000))
    ups, got = step()
    assert ups == {("v4", "update")} and got == full()
