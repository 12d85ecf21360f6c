import random
import re

import numpy as np
import pytest

from vigil.llm import components, line_dedup, ngram_join
from vigil.llm.ngram_join import Jaccard

EDGE = "u long, v long"


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + \
        [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(150)] + [(500, 500), (7, 3), (3, 7)]
    got = {r["u"]: r["root"] for r in components.components(spark.createDataFrame(pairs, EDGE)).collect()}
    want = union(pairs, {x for p in pairs for x in p})
    assert all(got.get(n, n) == r for n, r in want.items()) and set(got) <= set(want)
    assert components.components(spark.createDataFrame([], EDGE)).count() == 0


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, rule):
    sets = [shingles(t, rule.words) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and rule.under * len(sets[i] & sets[j]) >= rule.over * len(sets[i] | sets[j])]
    root = union(links, range(len(rows)))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(group) if sets[i] and group else doc_id))
    return out


def near_copies(rng, n, length=120):
    base = [rng.choice("abcdefgh") + str(rng.randint(0, 400)) for _ in range(length)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(length)] = "x%d" % rng.randint(0, 9999)
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("rule,block", [(Jaccard(4, 85, 100), 512), (Jaccard(5, 80, 100), 8)])
def test_near_duplicates_equal_brute_force(spark, docs_of, rule, block):
    rng = random.Random(2)
    texts = near_copies(rng, 60) + near_copies(rng, 12, 30) + [t for k in range(20) for t in near_copies(rng, 3, rng.randint(5, 400))]
    texts += [" ".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(40)]
    texts += [None, "", "  \n\t", "one", "One", "ONE two", "É a b c d e f", "é a b c d e f", texts[0], texts[0].upper(), "w " * 5000]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts)) + [(None, texts[3]), (ids[4], texts[70]), (ids[5], texts[5]), (None, None)]
    docs = docs_of(rows).withColumnRenamed("lang", "root").withColumnRenamed("source", "part")
    got = ngram_join.components_of(docs, rule, block=block).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows, rule)))
    kept = ngram_join.keep_one(docs, rule, block=block).collect()
    want = brute(rows, rule)
    # one row of each group, the least doc_id; rows without shingles stay
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(
        [str(c) for c in {c for (d, n, c) in want if n}] + [str(d) for d, n, c in want if not n])
    assert kept[0].asDict().keys() == dict.fromkeys(docs.columns).keys()
    assert ngram_join.components_of(docs.limit(0), rule).count() == 0


def test_linked_sets_agree_in_a_part():
    """The pigeonhole holds for pairs at the very threshold, small and large."""
    rng = np.random.default_rng(3)
    for rule in (Jaccard(4, 85, 100), Jaccard(5, 80, 100)):
        bands = rule.bands(5000)
        for size in [*range(1, 80), 200, 531, 1200]:
            pool = rng.integers(0, 2**63, 2 * size + 2, dtype=np.uint64)
            for shift in range(0, size // 3 + 1):
                a, b = np.unique(pool[:size]), np.unique(pool[shift:size + shift // 2])
                common, total = len(np.intersect1d(a, b)), len(np.union1d(a, b))
                if not len(b) or rule.under * common < rule.over * total or common == total:
                    continue
                parts = [set(ngram_join.sketch_parts(s, rule, bands).tolist()) for s in (a, b)]
                assert parts[0] & parts[1], (size, shift)


def similar_lines(rows):
    """Kept text and counts by definition."""
    lines = []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    for k in order:
        for i, line in enumerate((rows[k][1] or "").split("\n")):
            w = frozenset(x for x in re.split("[ \t\r\f\v]", line) if x)
            if w:
                lines.append((k, i, w))
    gone = {(k, i) for n, (k, i, w) in enumerate(lines)
            if any(5 * len(w & v) >= 4 * len(w | v) for _, _, v in lines[:n])}
    out = []
    for k, (doc_id, text) in enumerate(rows):
        own = [i for k2, i, _ in lines if k2 == k]
        dropped = sum((k, i) in gone for i in own)
        kept = "\n".join(x for i, x in enumerate((text or "").split("\n")) if (k, i) not in gone)
        out.append((doc_id, None if text is None else "" if own and dropped == len(own) else kept, len(own), dropped))
    return out


def test_line_dedup_equals_brute_force(spark, docs_of):
    rng = random.Random(4)
    base = [[rng.choice("abcdefgh") + str(rng.randint(0, 60)) for _ in range(rng.randint(1, 30))] for _ in range(25)]

    def variant():
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            own[rng.randrange(len(own))] = "y%d" % rng.randint(0, 50)
        rng.shuffle(own)
        return (" " * rng.randint(1, 2)).join(own) + rng.choice(["", " ", "\r", "\t"])
    rows = [(i, "\n".join(variant() if rng.random() < 0.9 else rng.choice(["", "  "]) for _ in range(rng.randint(1, 8)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, rows[0][1]), (204, "f g h"), (205, "f g h"), (None, rows[1][1]),
             (206, "off of if\nfluff"), (207, "z " * 3000 + "\n" + "long " * 2000)]
    docs = docs_of(rows).withColumnRenamed("lang", "pos").withColumnRenamed("source", "n_lines")
    got = line_dedup.dedup_lines(docs, leaders=2)
    assert got.columns == ["doc_id", "text", "pos", "n_chars", "n_lines", "n_removed"]
    want = sorted(map(str, similar_lines(rows)))
    assert sorted(str((r["doc_id"], r["text"], r["n_lines"], r["n_removed"])) for r in got.collect()) == want
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    nodes = got._jdf.queryExecution().toString()
    assert "Python" not in nodes and "Arrow" not in nodes


def test_repeated_rows_are_one_document(spark, docs_of):
    rows = [(1, "a b c\nd e f"), (1, "a b c\nd e f"), (2, "a b c\nnew line here")]
    got = sorted(tuple(r) for r in line_dedup.dedup_lines(docs_of(rows)).select("doc_id", "text", "n_removed").collect())
    assert got == [(1, "a b c\nd e f", 0), (1, "a b c\nd e f", 0), (2, "new line here", 1)]


def test_no_plan_of_the_line_dedup_holds_the_rarity_table(spark):
    texts = spark.createDataFrame([("a b c\nd e f",), ("a x c",)], "__text string")
    lines = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (3, "a x c")], "__pos long, __line string")
    prefixes = line_dedup._prefixes(lines, line_dedup._rarity(texts), 4, 5)
    assert prefixes.count() == 3 and len(prefixes._jdf.queryExecution().toString()) < 100_000


def test_long_lines_with_little_in_common_are_sifted_out_before_their_words_move(spark, monkeypatch):
    import random
    r = random.Random(3)
    lines = [" ".join(r.sample([f"w{i}" for i in range(420)], 200)) for _ in range(60)]
    lines.append(lines[0] + " more")
    tables = []
    kept = line_dedup.stored

    def stored(df, **options):
        tables.append(kept(df, **options))
        return tables[-1]
    monkeypatch.setattr(line_dedup, "stored", stored)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    gone = line_dedup.dedup_lines(docs).where("n_removed > 0").select("doc_id").collect()
    assert [x.doc_id for x in gone] == [60]
    sifted = next(t for t in tables if t.columns == ["pos", "earlier"])
    assert [tuple(x) for x in sifted.collect()] == [(60 << line_dedup.LINE_BITS, 0)]
