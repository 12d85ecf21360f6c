import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vigil.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _pieces(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        words = re.findall("[^\x20\x09]+", piece)
        if words:
            yield words


def _counts(texts, most=4):
    f = Counter()
    for text in texts:
        for words in _pieces(text):
            for n in range(1, most + 1):
                f.update(" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
    return f


def _plain(rows, least, top, covered=(80, 100), scale=2_000_000):
    out = set()
    for lang in {r[2] or "und" for r in rows}:
        f = _counts([r[1] for r in rows if (r[2] or "und") == lang])
        n = sum(c for p, c in f.items() if " " not in p)
        frequent = {p: c for p, c in f.items() if " " in p and c >= least}
        ranked = []
        for p, a in frequent.items():
            w = p.split(" ")
            cuts = [(scale * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            if not any(f" {p} " in f" {q} " and q != p and covered[1] * b >= covered[0] * a for q, b in frequent.items()):
                ranked.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


def _got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _corpus(seed, n=60):
    rnd = random.Random(seed)
    words = ["The", "of", "new", "york", "times", "a b", "É", "東京", "x-1", "in"]
    passage = " ".join(rnd.choice(words) for _ in range(60)) + ". New York\tTimes, of  the!"
    rows = []
    for i in range(n):
        body = "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " \r\n "]) for _ in range(rnd.randrange(150)))
        rows.append((i, body + (passage if i % 3 else ""), rnd.choice(["en", "de", None])))
    return rows


def _by_chunks(chunks, langs=None, freqs=None, bitmap=b"\xff" * 64):
    """{(lang, phrase): count} by the numpy counter, all orders."""
    words = phrases.Words(pa.array([c for c, _ in chunks], pa.binary()), langs or ["en"] * len(chunks))
    lasts, freqs = np.array([x for _, x in chunks], bool), np.array(freqs or [1] * len(chunks))
    got = Counter()
    for orders in ((1,), (2,), (3, 4)):
        for text, starts, ends, f in phrases.phrase_counts(words, lasts, freqs, orders, bitmap):
            found = phrases._slices(words.data, starts, ends).to_pylist()
            for t, p, n in zip(text.tolist(), found, f.tolist(), strict=True):
                got[(langs[t] if langs else "en"), p] += n
    return got


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["A", "bcd", "e", ".", "\n", "\t", " ", "é", "xyzzy", "longerword"]), max_size=250),
       st.integers(0, 3), st.sampled_from([9, 4096]))
def test_each_occurrence_belongs_to_one_chunk(parts, bits, longest):
    text = " ".join(parts)
    chunks = phrases.parse(phrases.normal(text.encode()), bits=bits, least=5, longest=longest)
    assert {p: n for (_, p), n in _by_chunks(chunks).items()} == _counts([text]) if chunks else not _counts([text])


def test_languages_weights_and_long_words():
    texts = [("a b a b", "en", 3), ("a b", "de", 5), ("x" * 70_000 + " a b " + "x" * 70_000, "en", 1), ("x" * 70_001 + " a", "en", 2)]
    chunks = [(t.encode(), True) for t, _, _ in texts]
    got = _by_chunks(chunks, [x for _, x, _ in texts], [f for _, _, f in texts])
    want = Counter()
    for t, lang, f in texts:
        for p, n in _counts([t]).items():
            want[lang, p] += n * f
    assert got == want


def test_shared_passages_share_chunks():
    rnd = random.Random(1)
    passage = " ".join(f"w{rnd.randrange(500)}" for _ in range(2000))
    a = {c for c, _ in phrases.parse(phrases.normal(("Alpha beta. " + passage).encode()))}
    b = {c for c, _ in phrases.parse(phrases.normal((passage + " gamma, delta").encode()))}
    assert len(a & b) > 0.9 * len(a) > 20


def test_against_brute_force(docs_of):
    rows = _corpus(4)
    want = _plain(rows, 8, 40)
    assert len(want) > 60
    assert _got(phrases.collocations(docs_of(rows), least=8, top=40)) == want
    # a filter that lets everything through bears on the cost only
    assert _got(phrases.collocations(docs_of(rows), least=8, top=40, filter_bits=6)) == want


def test_copies_count_each_time(docs_of):
    rows = [(i, "one two three four five. " * 3, "en") for i in range(40)] + [(7, "one two", "en")] * 30
    want = _plain(rows, 30, 2000)
    got = _got(phrases.collocations(docs_of(rows)))
    assert got == want and {r[2] for r in got} >= {"one two three four"}


def test_nulls_empty_long_and_clashing(spark, docs_of):
    assert _got(phrases.collocations(docs_of([]))) == set()
    assert _got(phrases.collocations(docs_of([(1, None), (2, ""), (3, " . ,\n")]))) == set()
    rows = [(1, "ab cd " * 40_000, "en"), (2, "z" * 300_000, "en"), (3, None, None), (None, "ab cd", "en")]
    wide = docs_of(rows).withColumns({c: F.lit(1) for c in ("phrase", "f", "freq", "chunk", "last", "words", "rank", "n")})
    assert _got(phrases.collocations(wide)) == _plain(rows, 30, 2000)


def test_large_counts_are_exact(spark):
    # scale * a passes 64 bits
    expr = "(CAST(2000000 AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(19, 0))) div (CAST(l AS DECIMAL(20, 0)) + r)"
    a, left, right = 8_000_000_000_000_001, 9_000_000_000_000_007, 9_100_000_000_000_003
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long").selectExpr(f"{expr} AS s")
    assert df.first().s == 2_000_000 * a // (left + right) and df.dtypes == [("s", "bigint")]
