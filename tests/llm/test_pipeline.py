"""The registered queries that SQL can't express, and the pipeline, on sf0.001."""

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from vigil.llm import bpe, ngram_join, packing, pii, quality
from vigil.llm.queries import QUERIES

from test_dedup import brute, similar_lines  # noqa: I001

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table():
    t = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    return {r["doc_id"]: r for r in t}


def test_pipeline_equals_a_plain_version(spark, table):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    rows = sorted((r["doc_id"], r["text"]) for r in scored if r["predicted"])
    lines = similar_lines(rows)
    rows = [(d, t) for d, t, n, gone in lines if not n or 5 * gone < 4 * n]
    rows = [(d, t) for (d, t), (_, n, c) in zip(rows, brute(rows, corpus_pipeline.NEAR_DUPLICATES)) if not n or c == d]
    own = pii.Pseudonymiser(corpus_pipeline.PII_KEY)
    rows = [(d, own.replace(t, own.spans(t))) for d, t in rows]
    enc = bpe.encoder(bpe.default_tokenizer_path())
    want = set()
    for (d, _), ids in zip(rows, enc.encode([t for _, t in rows])):
        ids += b"\0\0\0\0"
        n = len(ids) // 4
        bounds = [0, *range(n % 2048 or 2048, n + 1, 2048)] if n > 2048 else [0, n]
        want |= {(d, p, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for p, (a, b) in enumerate(zip(bounds, bounds[1:]))}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)


def test_stages_keep_the_columns_and_stand_odd_tables(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("alpha beta gamma delta of the and".split(), k=30)).capitalize() + ".") for i in range(40)]
    rows += [(50, None), (51, ""), (None, "null id text"), (3, rows[3][1]), (52, "x " * 30_000)]
    for start in (docs_of(rows), docs_of([])):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "best_fit_packing":
                assert out.schema.simpleString() == start.schema.simpleString(), name
                docs = spark.createDataFrame(out.collect(), start.schema)
            else:
                out.collect()


def test_documents_without_new_lines_go_and_the_key_is_the_sessions(spark, docs_of):
    lines = [f"line {i} has its own words w{i} v{i} u{i}" for i in range(10)]
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines[:8], "something new here", "and this too"])),
            (3, "\n".join([*lines[:7], "one more", "two more", "three more"])), (4, None), (5, "")]
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, docs_of(rows), SF).collect()}
    assert set(kept) == {1, 3, 4, 5} and kept[3] == "one more\ntwo more\nthree more"
    mail = docs_of([(1, "write to someone@example.org now")])
    plain = corpus_pipeline.pseudonyms(spark, mail, SF).first()["text"]
    spark.conf.set("spark.vigil.pii.key", "another key")
    try:
        assert corpus_pipeline.pseudonyms(spark, mail, SF).first()["text"] not in (plain, "write to someone@example.org now")
    finally:
        spark.conf.unset("spark.vigil.pii.key")


def test_packing_query(spark, table):
    got = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    enc = bpe.encoder(bpe.default_tokenizer_path())
    ids = dict(zip(table, enc.encode([r["text"] or "" for r in table.values()])))
    assert sum(r["length"] for r in got) == sum(len(i) // 4 + 1 for i in ids.values())
    fill = {}
    for r in got:
        own = np.frombuffer(ids[r["doc_id"]] + b"\0\0\0\0", "<u4")[r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(own.astype("<u4").tobytes()) == r["ids_crc32"]
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= 1.03 * sum(fill.values()) / 2048 + 1


def test_search_query_recall(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    ids, x = np.array(t["vec_id"]), np.array(t["embedding"], dtype=float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    got = {(r["query_id"], r["vec_id"]) for r in QUERIES["op8_nearest_neighbours"](spark, SF).collect()}
    want = {(int(ids[q]), int(ids[j])) for q in np.flatnonzero(ids % 50 == 0)
            for j in [j for j in np.lexsort((ids, -(x @ x[q]).round(12))) if j != q][:5]}
    assert len(got & want) / len(want) >= 0.9


@pytest.mark.parametrize("name,truth,least", [("op4_quality_classifier", "quality", 0.97), ("op10_language_id", "lang", 0.98)])
def test_held_out_accuracy(spark, table, name, truth, least):
    label = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()} if truth == "quality" \
        else {d: r["lang"] for d, r in table.items()}
    got = QUERIES[name](spark, SF).collect()
    assert len(got) == len(table)
    held = [r for r in got if r["held_out"] and label.get(r["doc_id"]) is not None]
    hit = [r["predicted" if truth == "quality" else "lang_pred"] == label[r["doc_id"]] for r in held]
    assert len(hit) > 10 and np.mean(hit) >= least


def test_near_duplicates_with_capital_letters_only_in_ascii():
    a, b, c = ngram_join.shingle_sets(["ONE Two three four", "one two three four", "É two three four"], 4)
    assert a.tolist() == b.tolist() != c.tolist() and len(packing.sum_of_squares([], 5)[0]) == 0
