import glob
import mmap
import zlib
from array import array

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from vigil.llm import token_files
from vigil.llm.bpe import default_tokenizer_path
from vigil.llm.storage import fresh_path

END = 2


def _plain(rows):
    """doc_id, start, n_tokens, crc by the tokenizers library alone."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_tokenizer_path())
    t.no_truncation()
    t.no_padding()
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, END]
        out.append((doc_id, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    return out


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, (1 << b) - 1), max_size=70))))
def test_bits_round_trip(case):
    bits, ids = case
    packed = token_files.pack_bits(np.array(ids, np.uint32), bits)
    assert len(packed) == (len(ids) * bits + 7) // 8
    assert token_files.unpack_bits(packed, len(ids), bits).tolist() == ids
    # lowest bit first, without gaps
    number = int.from_bytes(packed, "little")
    assert [(number >> (bits * i)) & ((1 << bits) - 1) for i in range(len(ids))] == ids


def test_id_bits():
    assert [token_files.id_bits(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_shard_random_access():
    w = token_files.ShardWriter(3, 16, 8)
    docs = [list(range(k, k + n)) for k, n in ((0, 1), (5, 20), (9, 8), (40, 3))]
    for k, d in enumerate(docs):
        w.add(None if k == 2 else k, array("I", d).tobytes())
    shard = token_files.Shard(w.finish())
    assert [shard.document(k).tolist() for k in range(4)] == docs
    assert (shard.part, shard.before, shard.n, shard.n_docs) == (3, 0, 32, 4)
    flat = sum(docs, [])
    for a in range(0, 33, 3):
        for b in range(a, 33, 5):
            assert shard.ids(a, b).tolist() == flat[a:b]
    assert shard.null.tolist() == [0, 0, 1, 0]
    w.add(7, array("I", [1, 2]).tobytes())
    assert token_files.Shard(w.finish()).before == 32
    with pytest.raises(ValueError):
        token_files.Shard(b"something else entirely" * 10)


def test_round_trip_against_the_library(spark, docs_of):
    rows = [(9, "Hello world, hello"), (3, None), (5, ""), (-4, "éü 東京 \U0001f600 <|endoftext|> x"),
            (7, "a b\n" * 3000), (8, "same text"), (1, "same text"), (2, "x" * 50_000)]
    got = token_files.round_trip(docs_of(rows), ids_per_file=1000, block=64)
    assert sorted(map(tuple, got.collect())) == sorted(_plain(rows))


def test_round_trip_repeated_null_and_empty(spark, docs_of):
    rows = [(None, "none"), (4, "twice"), (4, "twice"), (4, "twice"), (6, "end")]
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.round_trip(docs_of(rows)).collect())
    want = sorted((s, d, n) for d, s, n, _ in _plain(rows))
    assert got == want
    assert token_files.round_trip(docs_of([])).count() == 0


def test_clashing_columns_and_files(spark, docs_of):
    from pyspark.sql import functions as F
    rows = [(k, f"word{k} and more") for k in range(40)]
    wide = docs_of(rows).withColumns({"file": F.lit("x"), "part": F.lit(1), "start": F.lit(2), "n_tokens": F.lit(3)})
    path = fresh_path(spark)
    token_files.write_tokens(wide, path, ids_per_file=20)
    back = token_files.with_starts(token_files.read_documents(spark, path, with_ids=True)).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in back] == _plain(rows)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in back)
    # a trainer's view: the files alone, memory-mapped
    names = glob.glob(path.removeprefix("file:") + "/part-*")
    assert len(names) > 5
    seen = {}
    for name in names:
        with open(name, "rb") as f:
            shard = token_files.Shard(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
            assert shard.bits == 16
            seen |= {int(d): shard.document(k).astype("<u4").tobytes() for k, d in enumerate(shard.doc_ids)}
    assert seen == {r.doc_id: bytes(r.ids) for r in back}


