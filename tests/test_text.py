"""Text functions: fixture table (FIXTURES §C) and property tests against a
plain-Python statement of the same rules."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.functions import text as X
from vigil.functions import timefn as TM
from vigil.schemas import FILLER_TOKENS

CASES = [("", ""), ("um", ""), (" um ", ""), ("a a  a", "a"), ("the um the", "the"),
         (" um hello", " hello"), ("hi [ __ ] hi", "hi [ __ ] hi"), ("Um um", "Um"),
         ("x\nx", "x\nx")]


def py_clean(text: str) -> str:
    """Independent statement of the rule: nbsp->space, squeeze spaces, split
    on ' ', drop filler tokens, drop a token equal to the next kept one ('' after
    the last)."""
    t = text.replace("\xa0", " ")
    while "  " in t:
        t = t.replace("  ", " ")
    kept = [x for x in t.split(" ") if x not in FILLER_TOKENS]
    out = [x for i, x in enumerate(kept) if x != (kept[i + 1] if i + 1 < len(kept) else "")]
    return " ".join(out)


def test_clean_text_fixtures(spark):
    df = spark.createDataFrame([(a,) for a, _ in CASES], "t string")
    got = [r[0] for r in df.select(X.clean_text("t")).collect()]
    assert got == [b for _, b in CASES]
    assert [py_clean(a) for a, _ in CASES] == [b for _, b in CASES]


def test_clean_text_remove_censored(spark):
    df = spark.createDataFrame([("hi [ __ ] hi",)], "t string")
    assert df.select(X.clean_text("t", remove_censored=True)).first()[0] == "hi"


tokens = st.lists(st.sampled_from(["a", "b", "um", "uh", "", "[Music]", "Â", "x\ny", "\xa0", "the"]),
                  max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.lists(tokens.map(lambda ts: " ".join(ts)), min_size=1, max_size=8))
def test_clean_text_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.clean_text("t")).collect()]
    assert got == [py_clean(t) for t in texts]


def test_html_unescape(spark):
    df = spark.createDataFrame([("It&amp;#39;s &amp; more &#39;q&#39;",)], "t string")
    # &#39; first, then &amp;: '&amp;#39;' becomes '&#39;' (one pass only)
    assert df.select(X.html_unescape_basic("t")).first()[0] == "It&#39;s & more 'q'"


def py_chunks(text, limit, tok):
    n = len(tok)
    if n < limit:
        return [text]
    k = max(1, -(-n // limit))
    return [" ".join(tok[(i * n) // k:((i + 1) * n) // k]) for i in range(k)]


def test_chunk_text_bounds(spark):
    rows = [("a b c d e f g",), ("a b",), ("one, two; three four five six seven eight nine ten",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(X.chunk_text("t", 3).alias("c"), X.tokens("t").alias("k")).collect()
    for (t,), r in zip(rows, got):
        assert r["c"] == py_chunks(t, 3, r["k"])
        if len(r["k"]) >= 3:
            assert " ".join(r["c"]).split(" ") == r["k"]  # every token exactly once, in order


def test_token_count_and_split(spark):
    df = spark.createDataFrame([("Hello, world! 42x",)], "t string")
    r = df.select(X.token_count("t").alias("n"), X.split_topics(F.lit("a, b,,c")).alias("s")).first()
    assert r["n"] == 5  # Hello , world ! 42x
    assert r["s"] == ["a", " b", "", "c"]


def test_week_start_strictly_previous_sunday(spark):
    days = [dt.date(2024, 9, 1) + dt.timedelta(days=i) for i in range(15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(TM.week_start("d")).collect()]
    # pandas Week(weekday=6) subtraction: back to the previous Sunday, a Sunday goes back 7 days
    exp = [d - dt.timedelta(days=(d.weekday() + 1) % 7 or 7) for d in days]
    assert got == exp


def test_eastern_date_dst(spark):
    df = spark.createDataFrame([("2024-03-10T06:30:00Z",), ("2024-11-03T04:30:00Z",),
                                ("2024-07-01T03:59:00Z",)], "s string")
    ts = F.to_timestamp("s", "yyyy-MM-dd'T'HH:mm:ssX")
    got = [r[0] for r in df.select(TM.eastern_date(ts)).collect()]
    assert got == [dt.date(2024, 3, 10), dt.date(2024, 11, 3), dt.date(2024, 6, 30)]


def _plain_places(docs):
    import re
    out = {}
    for k, text in docs:
        spos = -1
        for raw in re.findall(r"[^.!?\n]+[.!?]*", text or ""):
            if raw.strip(" "):
                spos += 1
                for w in re.findall(r"[a-z]+", raw.lower()):
                    out.setdefault((k, w), []).append(spos)
    return {kw: sorted(at) for kw, at in out.items()}


def test_words_are_counted_where_the_text_lies(spark):
    """Places and frequencies equal a plain count, and no row of a word is
    shuffled or sorted for them; a key with several texts still counts once."""
    from vigil.operators import enrich as N
    rows = [(1, "One two. Two two!  ...\nthree one"), (2, None), (3, ""), (4, "12 34."), (5, "two. one? two")]
    for data in (rows, [*rows, (1, "two one. four"), (5, None)]):
        docs = spark.createDataFrame(data, "video_id long, text string").repartition(3)
        places, tf = N.term_places(docs, ["video_id"], "text"), N.term_frequencies(docs)
        want = _plain_places(data)
        assert {(r.video_id, r.term): sorted(r["at"]) for r in places.collect()} == want
        assert sorted((r.video_id, r.term, r.tf) for r in places.collect()) == sorted((*k, len(v)) for k, v in want.items())
        assert sorted(map(tuple, tf.collect())) == sorted((*k, len(v)) for k, v in want.items())
    once = spark.createDataFrame(rows, "video_id long, text string")
    for counted in (N.term_places(once, ["video_id"], "text"), N.term_frequencies(once)):
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Aggregate" not in plan
    assert {r.term: r.df for r in N.term_statistics(spark.createDataFrame([(1, "aaaa"), (1, "aaaa bbbb")], "video_id long, text string"))
            .collect()} == {None: 1, "aaaa": 1, "bbbb": 1}
