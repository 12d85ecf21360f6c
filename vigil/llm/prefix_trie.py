"""Conversation prefix trie, its subtree totals by time-forward processing.

A node stands for a distinct sequence of leading turns and is named by a hash
of it. Nodes with one member are their own answer. The others are cut into
shards: with bounds b, b*b, ... on the members, a node belongs to the tier of the
least bound that holds it, and to the shard of its topmost ancestor within
that bound, so a shard holds the nodes of at most that many conversations that
more than the bound before share. Within a shard the nodes come sorted by
reverse level order (Spark's sort, which spills), and each sends its totals to its
parent through a priority queue that spills too. A shard's root sends its totals
on to its parent's tier; the last tier ends at the root of the trie.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator
from functools import reduce
from itertools import groupby, islice

from pyspark.sql import DataFrame, functions as F

from vigil.llm.prefix_scan import running
from vigil.llm.storage import stored

NODE = ["depth", "k1", "k2"]
ROOT = (0, 0, 0)


class SpillingQueue:
    """Messages in the order of their keys. Beyond ``most`` messages in memory,
    a sorted run goes to an unnamed file in Spark's own scratch folders."""

    def __init__(self, most: int = 200_000):
        self.most = most
        self.heap: list[tuple] = []
        self.runs: list[tuple[tuple, int, Iterator]] = []
        self.spilled = 0

    def push(self, key: tuple, value: tuple) -> None:
        heapq.heappush(self.heap, (key, value))
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        run = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        messages = sorted(self.heap)
        for at in range(0, len(messages), 1000):
            pickle.dump(messages[at:at + 1000], run)
        run.seek(0)
        self.heap = []
        self.spilled += 1
        self._advance(self._read(run), self.spilled)

    @staticmethod
    def _read(run) -> Iterator:
        with run:
            while True:
                try:
                    block = pickle.load(run)
                except EOFError:
                    return
                yield from block

    def _advance(self, rest: Iterator, number: int) -> None:
        head = next(rest, None)
        if head is not None:
            heapq.heappush(self.runs, (head, number, rest))

    def take(self, key: tuple) -> Iterator:
        """Values of all messages for the key, which must be the least one left."""
        while self.heap and self.heap[0][0] == key:
            yield heapq.heappop(self.heap)[1]
        while self.runs and self.runs[0][0][0] == key:
            head, number, rest = heapq.heappop(self.runs)
            yield head[1]
            self._advance(rest, number)

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)


def rebuilt(turns: DataFrame, *, family: int = 100, most: int = 5) -> DataFrame:
    """conv_id, depth, n (code points of the last turn's text), k1, k2 (node),
    p1, p2 (its parent), is_last: one row per conversation and node on its path.

    ``turns``: conv_id, turn, role, text. Conversation c takes its first
    h = crc32(c in decimal) % (most + 1) turns from conversation c - c % family
    (all if that has fewer, none if it doesn't exist) and the others are its
    own. Turns of one number are ordered by the SHA-256 of role and text.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.substring(F.unhex(F.sha2(named, 256)), 1, 16).alias("item"), F.length(text).cast("long").alias("n"))
    placed = running(rows, "conv_id", ["turn", "item"], "item")
    held = F.crc32(F.col("conv_id").cast("string")) % (most + 1)

    ids = placed.where("pos = 1").select("conv_id")
    heads = placed.where((F.col("conv_id") % family == 0) & (F.col("pos") <= most)).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("at"), "item", "n")
    lead = (ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(heads, "base")
            .where(F.col("at") <= held).select("conv_id", "at", "item", "n"))
    own = placed.where(F.col("pos") > held).select("conv_id", (F.col("pos") + most).alias("at"), "item", "n")
    top = ids.select("conv_id", F.lit(0).cast("long").alias("at"), F.lit(b"").alias("item"), F.lit(0).cast("long").alias("n"))
    paths = running(top.unionByName(lead).unionByName(own), "conv_id", ["at"], "item")
    return paths.select("conv_id", (F.col("pos") - 1).alias("depth"), "n", "k1", "k2", "p1", "p2", "is_last")


def _sharded(paths: DataFrame, shared: DataFrame, tiers: int) -> DataFrame:
    """``shared`` nodes with s1, s2: hash of their shard's root."""
    on_path = paths.select("conv_id", *NODE).join(shared.select(*NODE, "tier"), NODE)
    tops = on_path.groupBy("conv_id").agg(*[
        F.min(F.when(F.col("tier") <= t, F.struct(*NODE))).alias(f"top{t}") for t in range(1, tiers + 1)])
    top = F.coalesce(*[F.when(F.col("tier") == t, F.col(f"top{t}")) for t in range(1, tiers + 1)])
    return (shared.join(tops, "conv_id").withColumn("__top", top)
            .withColumns({"s0": F.col("__top.depth"), "s1": F.col("__top.k1"), "s2": F.col("__top.k2")})
            .select(*shared.columns, "s0", "s1", "s2"))


def _passed_up(nodes: DataFrame, messages: DataFrame, most: int) -> DataFrame:
    """Totals of one tier's nodes: its shards' nodes in reverse level order,
    with what lower tiers sent to them."""
    incoming = messages.groupBy(*NODE).agg(*[F.sum(c).alias(f"in_{c}") for c in ("children", "leaves", "saved")])
    order = ["s0", "s1", "s2", F.desc("depth"), "k1", "k2"]
    joined = nodes.join(incoming, NODE, "left").na.fill(0, ["in_children", "in_leaves", "in_saved"])
    names = ["conv_id", *NODE, "p1", "p2", "n", "n_convs"]
    cols = ["s0", "s1", "s2", *names, "in_children", "in_leaves", "in_saved"]

    def forward(batches: Iterator) -> Iterator:
        import pyarrow as pa
        queue = SpillingQueue(most)
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            for s0, s1, s2, _, depth, k1, k2, p1, p2, n, convs, children, leaves, saved in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                for c, l, s in queue.take((-depth, k1, k2)):
                    children, leaves, saved = children + c, leaves + l, saved + s
                leaves = leaves if children else 1
                saved += (convs - 1) * n
                is_top = (depth, k1, k2) == (s0, s1, s2)
                if not is_top:
                    queue.push((1 - depth, p1, p2), (1, leaves, saved))
                elif queue:
                    raise RuntimeError("a message was left in a shard without its node")
                for col, v in zip(out, (children, leaves, saved, is_top), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[3:11], *(pa.array(c, t) for c, t in zip(out, [pa.int64()] * 3 + [pa.bool_()], strict=True))],
                [*names, "n_children", "n_leaves", "saved_tokens", "is_top"])

    fields = ", ".join(f"{c} long" for c in [*names, "n_children", "n_leaves", "saved_tokens"])
    return (joined.repartition("s0", "s1", "s2").sortWithinPartitions(*order).select(*[F.col(c).cast("long") for c in cols])
            .mapInArrow(forward, fields + ", is_top boolean"))


def end_digests(ends: DataFrame, *, block: int = 65_536) -> DataFrame:
    """depth, k1, k2, ends_sha256 from (depth, k1, k2, conv_id) rows. The ids of
    a node are joined to texts of ``block`` characters in sorted ranges, and
    only those meet in the task that runs the node's hash over them."""
    def rows_of(batches: Iterator) -> Iterator:
        for batch in batches:
            for *node, conv, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield tuple(node), conv, ids

    def table(rows: Iterator, last: str) -> Iterator:
        import pyarrow as pa
        names = [*NODE, "first", last] if last == "ids" else [*NODE, last]
        while some := list(islice(rows, 1000)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if n == last else pa.int64()) for n, c in zip(names, zip(*some, strict=True), strict=True)], names)

    def blocks(batches: Iterator) -> Iterator:
        def texts():
            for node, rows in groupby(rows_of(batches), lambda r: r[0]):
                first, ids, size = None, [], 0
                for _, conv, text in rows:
                    first = conv if not ids else first
                    ids.append(text)
                    size += len(text) + 1
                    if size > block:
                        yield (*node, first, ",".join(ids))
                        ids, size = [], 0
                if ids:
                    yield (*node, first, ",".join(ids))
        return table(texts(), "ids")

    def hashed(batches: Iterator) -> Iterator:
        def digests():
            for node, rows in groupby(rows_of(batches), lambda r: r[0]):
                digest = hashlib.sha256()
                for k, (_, _, ids) in enumerate(rows):
                    digest.update(("," if k else "").encode() + ids.encode())
                yield (*node, digest.hexdigest())
        return table(digests(), "ends_sha256")

    order = ["k1", "k2", "depth", "conv_id"]
    texts = (ends.select(*NODE, "conv_id", F.col("conv_id").cast("string").alias("ids")).repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInArrow(blocks, "depth long, k1 long, k2 long, first long, ids string"))
    return (texts.repartition(*NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, *, family: int = 100, most: int = 5, shard: int = 4096,
                in_memory: int = 200_000) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations (``rebuilt``):
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Null roles and texts count as empty, null turns come first, and rows
    without a conv_id take no part; repeated rows are turns like any other. A
    conversation that is left without turns ends at the root. An empty table
    gives no rows. Other columns are ignored. A conversation of any length is
    scanned in ranges, and a node of any number of members is counted by
    partial aggregates. ``shard`` is the base of the tiers' bounds, ``in_memory``
    the messages a queue holds before it spills.
    """
    paths = stored(rebuilt(turns, family=family, most=most))
    nodes = stored(paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("n").alias("n"),
        F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("is_last").cast("long")).alias("ends")))
    largest = nodes.agg(F.max("n_convs")).first()[0] or 0
    bounds = [1]
    while bounds[-1] < largest:
        bounds.append(bounds[-1] * shard)
    tiers = len(bounds) - 1
    plain = ["conv_id", *NODE, "p1", "p2", "n", "n_convs"]

    # one member: nothing is saved below, and one leaf
    alone = nodes.where("n_convs = 1").select(*plain, (1 - F.col("ends")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                                              F.lit(0).cast("long").alias("saved_tokens"))
    results = [alone]
    if tiers:
        tier = reduce(lambda e, t: F.when(F.col("n_convs") <= bounds[t], t).otherwise(e), range(tiers - 1, 0, -1), F.lit(tiers))
        shared = stored(_sharded(paths, nodes.where("n_convs > 1").withColumn("tier", tier), tiers))
        top = nodes.where("n_convs = 1").groupBy("conv_id").agg(F.min(F.struct("depth", "p1", "p2")).alias("t"))
        one, none = (F.lit(v).cast("long") for v in (1, 0))
        messages = top.select((F.col("t.depth") - 1).alias("depth"), F.col("t.p1").alias("k1"), F.col("t.p2").alias("k2"),
                              one.alias("children"), one.alias("leaves"), none.alias("saved"))
        for t in range(1, tiers + 1):
            done = stored(_passed_up(shared.where(F.col("tier") == t), messages, in_memory))
            results.append(done.drop("is_top"))
            messages = messages.unionByName(done.where("is_top").select(
                (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
                one.alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
    totals = reduce(DataFrame.unionByName, results)

    digests = end_digests(paths.where("is_last"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    return (totals.join(digests, NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
