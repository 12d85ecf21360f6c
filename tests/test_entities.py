"""Entity operators: short-form removal against the greedy rule, searches."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.operators import entities as E
from vigil.schemas import ENTITY_TYPES


def greedy_clean(rows):
    """The greedy statement: per type, longest first, keep a value unless it
    is contained in an already kept one."""
    by = {}
    for sid, et, v in rows:
        if v is None or et not in ENTITY_TYPES:
            continue
        by.setdefault((sid, et), [])
        if v not in by[(sid, et)]:
            by[(sid, et)].append(v)
    out = set()
    for (sid, et), vals in by.items():
        kept = []
        for v in sorted(vals, key=len, reverse=True):
            if not any(v in c for c in kept):
                kept.append(v)
        out |= {(sid, et, v) for v in kept}
    return out


def test_cleaned_fixture(spark):
    rows = [("v1", "PERSON", "Trudeau"), ("v1", "PERSON", "Justin Trudeau"),
            ("v1", "ORG", "Trudeau"), ("v1", "NOT_A_TYPE", "x"), ("v1", "PERSON", ""),
            ("v1", "PERSON", None), ("v2", "GPE", "")]
    df = spark.createDataFrame(rows, "source_id string, entity_type string, value string")
    got = {tuple(r) for r in E.cleaned_entities(df).collect()}
    assert got == {("v1", "PERSON", "Justin Trudeau"), ("v1", "ORG", "Trudeau"), ("v2", "GPE", "")}
    assert got == greedy_clean(rows)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["d1", "d2"]), st.sampled_from(["PERSON", "ORG"]),
                          st.text(alphabet="abé ", max_size=6)), max_size=30))
def test_cleaned_property(spark, rows):
    df = spark.createDataFrame(rows or [("d", "PERSON", "x")],
                               "source_id string, entity_type string, value string")
    got = {tuple(r) for r in E.cleaned_entities(df).collect()}
    assert got == greedy_clean(rows or [("d", "PERSON", "x")])


def test_cleaned_long_values(spark):
    """Values longer than the gram width take the window-join path."""
    rnd = random.Random(7)
    base = "".join(rnd.choice("abc ") for _ in range(200))
    rows = [("d", "WORK_OF_ART", base), ("d", "WORK_OF_ART", base[10:90]),
            ("d", "WORK_OF_ART", base[5:40] + "zz"), ("d", "WORK_OF_ART", base[150:160])]
    df = spark.createDataFrame(rows, "source_id string, entity_type string, value string")
    got = {tuple(r) for r in E.cleaned_entities(df, ) .collect()}
    assert got == greedy_clean(rows)


def test_spans_of_any_length(spark):
    """A run of 20,000 words or parts of a number is one span, as in a plain
    search; the stack doesn't grow with it. Short forms of it still go."""
    import re
    words, parts = " ".join(["Abc", "Éfg"] * 10_000), "1.2," * 10_000 + "3rd"
    texts = [f"x {words} of 7 {parts} y {words} z Éfg Abc.", f"Ab 1,2,.3 12:30:45 $5.0% {parts}. A Bc  De"]
    df = spark.createDataFrame(list(enumerate(texts)), "video_id long, text string")
    got = [(r["source_id"], r["value"]) for r in E.extract_entities(df, proper_noun_type="PERSON").orderBy("source_id", "pos").collect()]
    number = r"\d{1,2}:\d{2}|[$€£]?\d+(?:[.,]\d+)*(?:%|st|nd|rd|th)?"
    proper = r"[A-ZÉ][a-zé]+(?: [A-ZÉ][a-zé]+)*"
    assert got == [(i, v) for i, t in enumerate(texts) for v in re.findall(f"{number}|{proper}", t)]
    kept = E.cleaned_entities(E.unique_entities(E.extract_entities(df, proper_noun_type="PERSON"))).filter("source_id = 0")
    assert {(r["entity_type"], r["value"]) for r in kept.collect()} == {("PERSON", words), ("CARDINAL", "7"), ("ORDINAL", parts)}


def _idx(spark):
    rows = [("ORG", "Ottawa Police", "a"), ("GPE", "Ottawa", "b"), ("PERSON", "ottawa", "c"),
            ("GPE", None, "d")]
    return spark.createDataFrame(rows, "entity_type string, value string, source_id string")


def test_videos_containing_entity(spark):
    idx = _idx(spark)
    assert {r[0] for r in E.videos_containing_entity(idx, "OTTAWA").collect()} == {"b", "c"}
    assert {r[0] for r in E.videos_containing_entity(idx, "Ottawa", "GPE").collect()} == {"b"}


def test_collect_multi_repeats_and_empty(spark):
    idx = _idx(spark)
    lib = spark.createDataFrame([(1, s) for s in "abcd"], "lib_key long, source_id string")
    listing = spark.createDataFrame([("a", "t", "2024-01-01T00:00:00Z", "ch1")],
                                    "video_id string, title string, published_at string, channel_id string")
    ch = spark.createDataFrame([("ch1", "One", "News", "CA")],
                               "channel_id string, channel_title string, category string, region string")
    out = E.collect_multi_entity_data(idx, lib, listing, ch, ["ottawa", "police", "ottawa"])
    got = sorted((r["entity"], r["source_id"]) for r in out.collect())
    assert got == sorted([("ottawa", s) for s in "abc"] * 2 + [("police", "a")])
    ca = {r["source_id"]: r["channel_title"] for r in out.collect()}
    assert ca["a"] == "One" and ca["b"] is None
    assert E.collect_multi_entity_data(idx, lib, listing, ch, []).count() == 0
