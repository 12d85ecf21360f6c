import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from vigil.llm.prefix_scan import running
from vigil.llm.prefix_trie import SpillingQueue, end_digests, prefix_trie

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _tie(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def _plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), _tie(role, text), role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in convs.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(set)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].add(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1] if node else "")
        totals[node] = (sum(x[0] for x in below) or 1, saved + sum(x[1] for x in below))
    out = []
    for node, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(paths[c]) == len(node))
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(children[node]),
                    *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _rows(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def _some(seed=5):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(0, 130), *range(200, 260), 301, 302, 303, 500, -7, -100, -101, 100_000_000_003]:
        for turn in range(rnd.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, turn, ("user", "assistant")[turn % 2], rnd.choice(["a", "bb", "ccc", "déjà vu 東京"])))
    rows += [(700, None, None, None), (700, 1, "user", ""), (701, None, "user", "x"), (701, None, "user", "y"), (701, None, None, None)]
    rows += [(None, 0, "user", "nobody"), (303, 0, "user", "a"), (303, 0, "user", "a")]
    return rows


def test_against_brute_force_in_several_tiers(spark):
    rows = _some()
    got = prefix_trie(spark.createDataFrame(rows, TURNS), shard=3, in_memory=2)
    assert _rows(got) == _plain(rows)


def test_one_hot_conversation_and_many_copies(spark):
    rows = [(1000, t, "user", f"turn {t % 7}") for t in range(1200)]
    rows += [(1000 + k, t, "user", f"turn {t % 7}") for k in (1, 2, 3) for t in range(400)]
    rows += [(c, t, "user", "same") for c in range(2000, 2400) for t in range(2)]
    got = prefix_trie(spark.createDataFrame(rows, TURNS).repartition(7), shard=50)
    assert _rows(got) == _plain(rows)


def test_empty_alone_and_clashing_columns(spark):
    assert _rows(prefix_trie(spark.createDataFrame([], TURNS))) == []
    rows = [(5, 0, "user", "hello")]
    assert _rows(prefix_trie(spark.createDataFrame(rows, TURNS))) == _plain(rows)
    rows = _some(8)[:90]
    wide = spark.createDataFrame(rows, TURNS).withColumns(
        {c: F.lit(9) for c in ("depth", "pos", "k1", "item", "n", "is_last", "tier", "base", "at")})
    assert _rows(prefix_trie(wide)) == _plain(rows)


def test_long_text(spark):
    rows = [(c, 0, "user", "é" * 300_000 + str(c % 2)) for c in (0, 1, 2, 3)]
    assert _rows(prefix_trie(spark.createDataFrame(rows, TURNS))) == _plain(rows)


def test_running_state_crosses_partitions(spark):
    rows = [(g, i, bytes([i % 250, g])) for g, n in ((1, 2), (2, 3000), (3, 1), (4, 700)) for i in range(n)]
    df = spark.createDataFrame(rows, "g long, i long, item binary").repartition(5)
    got = sorted((r.g, r.i, r.pos, r.k1, r.k2, r.p1, r.p2, r.is_last) for r in running(df, "g", ["i"], "item").collect())
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    state = {}
    for (g, i, _), r, following in zip(sorted(rows), got, [*got[1:], (None,)], strict=True):
        assert r[:3] == (g, i, i + 1)
        assert r[5:7] == state.get(g, (0, 0))
        assert r[7] == (following[0] != g)
        state[g] = r[3:5]
    assert len({r[3:5] for r in got}) == len(got)


def test_spilling_queue_keeps_the_order():
    rnd = random.Random(3)
    queue, plain = SpillingQueue(10), defaultdict(list)
    for level in range(50, 0, -1):
        for node in sorted(k for k in plain if k[0] == -level):
            assert sorted(queue.take(node)) == sorted(plain.pop(node))
        for _ in range(rnd.randrange(40)):
            key, value = (1 - level, rnd.randrange(9), 0), (rnd.randrange(5),)
            queue.push(key, value)
            plain[key].append(value)
    for node in sorted(plain):
        assert sorted(queue.take(node)) == sorted(plain[node])
    assert not queue and queue.spilled > 5


def test_end_digests_of_many_ends(spark):
    ends = spark.range(5000).selectExpr("0L AS depth", "0L AS k1", "id % 2 AS k2", "id * 3 - 4000 AS conv_id").repartition(6)
    got = {r.k2: r.ends_sha256 for r in end_digests(ends, block=100).collect()}
    for k in (0, 1):
        ids = sorted(i * 3 - 4000 for i in range(5000) if i % 2 == k)
        assert got[k] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
