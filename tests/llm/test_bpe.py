import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vigil.llm import bpe, chunk_codec, packing

PATH = bpe.default_tokenizer_path()
LIB = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIB.encode(text, add_special_tokens=False).ids


@given(st.text(alphabet=st.sampled_from(list("ab'st .,!?\n\t\r\0  éñß漢字𝔘12 \x1c\x85")), max_size=60))
@settings(max_examples=400, deadline=None)
def test_encoder_equals_the_library(text):
    enc = bpe.encoder(PATH)
    got = enc.encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == ids_of(text)
    assert enc.decode(got) == LIB.decode(ids_of(text), skip_special_tokens=False)


def test_special_strings_and_a_small_memo():
    enc = bpe.Encoder(PATH, max_pieces=20)
    texts = ["<|endoftext|> a<|endoftext|>b", "one two three " * 50, "four five six seven " * 9, "", "x" * 5000]
    for _ in range(3):
        for t, got in zip(texts, enc.encode(texts)):
            assert np.frombuffer(got, "<u4").tolist() == ids_of(t)


def words(rng, n):
    return " ".join("".join(rng.choices("thaeionsré'", k=rng.randint(1, 9))) + rng.choice(["", ".", ",\n", "  ", "!"]) for _ in range(n))


def test_joins_of_chunks_are_exact_wherever_they_fall():
    rng, enc = random.Random(1), bpe.encoder(PATH)
    for _ in range(200):
        text = words(rng, 60)
        cuts = sorted(rng.sample(range(1, len(text)), rng.randint(1, 12)))
        bounds = list(zip([0, *cuts], [*cuts, len(text)]))
        shared = [(a, b - a, enc.encode([text[a:b]])[0]) for a, b in bounds if rng.random() < 0.7]
        assert np.frombuffer(chunk_codec.assemble(enc, text, shared), "<u4").tolist() == ids_of(text)


def test_cut_points_follow_content():
    rng = random.Random(2)
    passage = words(rng, 3000)
    texts = [words(rng, 700) + passage, words(rng, 333) + passage]
    pieces = []
    for t in texts:
        cuts = [0, *chunk_codec.cut_points(t), len(t)]
        assert cuts == sorted(set(cuts))
        pieces.append({t[a:b] for a, b in zip(cuts, cuts[1:])})
    assert sum(len(p) for p in pieces[0] & pieces[1]) > len(passage) * 0.7
    assert chunk_codec.cut_points("") == [] and len(chunk_codec.cut_points("a" * 100_000)) <= 100_000 // 256


def test_documents(spark, docs_of):
    rng = random.Random(3)
    passage = words(rng, 2500)
    rows = [(1, None), (2, ""), (3, "short"), (4, words(rng, 400) + passage), (5, words(rng, 500) + passage),
            (6, passage * 3), (7, passage * 3), (7, "other"), (None, "null id"), (8, "<|endoftext|>" + passage), (3, "short")]
    docs = docs_of(rows).withColumnRenamed("lang", "h1").withColumnRenamed("source", "ids")
    got = sorted(chunk_codec.encode_documents(docs).collect(), key=str)
    want = []
    for doc_id, text in rows:
        ids = ids_of(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert chunk_codec.encode_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("capacity", [16, 64])
def test_packing(spark, docs_of, capacity):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randint(0, 40))) for i in range(300)] + [(5, None), (None, ""), (7, words(rng, 900)), (7, "twice"), (7, "twice")]
    got = packing.pack(docs_of(rows).withColumnRenamed("lang", "shard"), capacity=capacity, pieces_per_shard=100).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in rows[:300]:
        if doc_id in (5, 7):
            continue
        n = len(ids_of(text)) + 1
        own = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert sum(r["length"] for r in own) == n and [r["piece"] for r in own] == list(range(len(own)))
        assert all(r["length"] == capacity for r in own[1:]) and (len(own) == 1 or n > capacity)
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1.1 * -(-sum(r["length"] for r in got) // capacity) + 4
    assert packing.pack(docs_of([]), capacity=capacity).count() == 0


def test_sum_of_squares_is_the_least_choice():
    """Against a plain version that tries every place."""
    rng, cap = random.Random(5), 12
    lengths = [rng.randint(1, cap) for _ in range(200)]
    bins, offsets = packing.sum_of_squares(lengths, cap)
    fill, total = {}, lambda f: sum(list(f.values()).count(v) ** 2 for v in set(f.values()) if v < cap)
    for s, b, o in zip(lengths, bins, offsets):
        options = [{**fill, k: v + s} for k, v in fill.items() if v + s <= cap] + [{**fill, len(fill): s}]
        assert fill.get(b, 0) == o
        fill = {**fill, b: o + s}
        assert total(fill) == min(map(total, options))
