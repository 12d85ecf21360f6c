"""Entity search over stored postings."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.operators import entities as E
from vigil.operators import entity_search as ES

SCHEMA = "entity_type string, value string, source_id string"


def test_required_literals():
    want = {"trudeau": ["trudeau"], "^the": ["the"], "ou[a-z]+x": ["ou", "x"], "colou?r": ["colo", "r"], "ab*cd": ["a", "cd"],
            "ab+cd": ["ab", "cd"], "ab+?cd": ["ab", "cd"], "x{0,2}yz": ["yz"], "a|b": [], "(abc)def": ["def"], "(?i)abc": [],
            r"U\.S\.": ["U.S."], r"\bcat\b": ["cat"], r"\p{L}bc": [], r"a\.*b": ["a", "b"], "[]abc]": [], "[a[b]]": [],
            "straße": ["stra", "e"], r"\Qabc\E": [], "a.c": ["a", "c"], "": [], "québec": ["québec"], r"a\d{2}bc": ["a", "bc"]}
    assert {p: ES.required_literals(p) for p in want} == want


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.c*+?[]()^$|{}1,\\d", max_size=10), st.text(alphabet="abcd1,.", max_size=12))
def test_literals_are_certain(pattern, value):
    try:
        found = re.search(pattern, value)
    except re.error:
        return
    if found:
        assert all(x in value for x in ES.required_literals(pattern))


def test_no_other_letter_equals_a_plain_one(spark):
    """Every letter that a case-insensitive pattern of one plain letter finds
    has it as lower case, but for the exotic ones."""
    from pyspark.sql import functions as F
    plain = [chr(c) for c in range(0x21, 0x250) if chr(c).isalnum() and ES._plain(chr(c)) and chr(c) == chr(c).lower()]
    assert len(plain) > 200
    letters = spark.createDataFrame([(chr(c),) for c in [*range(0x21, 0xD800), *range(0xE000, 0xFFFE), *range(0x10400, 0x10450)]], "x string")
    wrong = F.filter(F.array(*[F.when(F.col("x").rlike("(?iu)" + c) & ~F.lower("x").contains(c), F.lit(c)) for c in plain]),
                     lambda c: c.isNotNull())
    assert letters.filter(~ES._exotic(F.col("x"))).filter(F.size(wrong) > 0).collect() == []
    assert {r.x for r in letters.filter(ES._exotic(F.col("x"))).collect()} == {"\u0130", "\u0131", "\u017f"}


VALUES = ["Justin Trudeau", "TRUDEAU", "Québec", "QUÉBEC City", "İstanbul", "ISTANBUL", "ıstanbul", "ſtraſſe", "STRASSE", "Straße",
          "ΟΔΟΣ", "οδος", "οδοσ", "K-2 Kelvin", "k-2", "U.S.", "US", "", "ab", "a" * 500, None, "Ottawa Police", "ottawa", "x|y"]
PATTERNS = ["trudeau", "québec", "istanbul", "strasse", "straße", "οδος", "k-2", r"U\.S\.", "^ab$", "a{400}", "ottawa( police)?$", "",
            "ott|que", "trudeau", "not there", r"\bpol", "x\\|y"]


@pytest.mark.parametrize("mode", ["regex", "substring"])
def test_same_as_testing_every_row(spark, tmp, mode):
    rnd = random.Random(3)
    rows = [(rnd.choice(["GPE", "ORG", None]), v, f"d{rnd.randrange(9)}") for v in VALUES for _ in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    ES.build_value_index(df, f"{tmp}/i", buckets=4)
    want = {tuple(r) for r in E.match_patterns(df, PATTERNS, mode, keep=["source_id"]).distinct().collect()}
    got = [(r.source_id, r.pattern_pos) for r in ES.documents_of(spark, f"{tmp}/i", PATTERNS, mode, 4).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert ES.documents_of(spark, f"{tmp}/i", [], mode, 4).count() == 0


def test_added_rows_and_repeats(spark, tmp):
    a = spark.createDataFrame([("GPE", "Ottawa", "d1"), ("GPE", "Ottawa", "d2"), (None, "Paris", "d1")], SCHEMA)
    b = spark.createDataFrame([("GPE", "Ottawa", "d3"), ("GPE", "Ottawa", "d1"), (None, "Paris", "d1"), ("ORG", "Ottawa Police", "d4")], SCHEMA)
    for df in (a, b, b):
        ES.build_value_index(df, f"{tmp}/i", buckets=4)
    assert spark.read.parquet(f"{tmp}/i/rows").count() == 5
    assert spark.read.parquet(f"{tmp}/i/values").count() == 3
    got = {tuple(r) for r in ES.documents_of(spark, f"{tmp}/i", ["ottawa", "paris$"], buckets=4).collect()}
    assert got == {(0, "d1"), (0, "d2"), (0, "d3"), (0, "d4"), (1, "d1")}


def test_plan_reads_few_postings_and_no_row_is_tested(spark, tmp):
    df = spark.range(2000).selectExpr("'GPE' AS entity_type", "concat('value number ', id) AS value", "string(id % 50) AS source_id")
    ES.build_value_index(df, f"{tmp}/i", buckets=16)
    out = ES.documents_of(spark, f"{tmp}/i", ["number 1234$", "er 77"], buckets=16)
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "Scan parquet" in x]
    postings = [x for x in scans if "gram" in x]
    assert postings and all("PartitionFilters: [bucket" in x and "In(gram" in x for x in postings)
    rows = [x for x in scans if "source_id" in x]
    assert rows and all("value:string" not in x.split("ReadSchema")[1] for x in rows)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {tuple(r) for r in out.collect()} == {(0, "34"), (1, "27")} | {(1, str(i % 50)) for i in range(770, 780)}
