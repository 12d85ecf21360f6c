"""Running state along ordered groups, however long a group is.

Rows are sorted by range over all partitions, each partition scans its own
rows, and the state at the end of each partition (one row per partition) is
folded and handed to the next one, so a group may fill many partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from vigil.llm.storage import stored

#: a prefix's hash is a polynomial in BASE over its items, modulo a Mersenne prime
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix scan").digest()[:15], "big")


def _halves(h: int) -> tuple[int, int]:
    low = h & (1 << 64) - 1
    return h >> 64, low - (1 << 64) if low >> 63 else low


def _whole(high: int, low: int) -> int:
    return (high << 64) | (low & (1 << 64) - 1)


def _joined(state: tuple[int, int], pos: int, h: int) -> int:
    """Hash after ``pos`` more items whose own hash is h."""
    return (state[1] * pow(BASE, pos, PRIME) + h) % PRIME


def running(rows: DataFrame, group: str, order: list[str], item: str) -> DataFrame:
    """``rows`` (sorted columns: ``group`` long, no nulls) with, along each
    group in the given order: pos (from 1), k1, k2 (hash of the items up to
    this one; the empty item hashes to 0), p1, p2 (of those before) and
    is_last. ``item`` is binary. Equal rows are interchangeable."""
    names = rows.columns
    at = {n: i for i, n in enumerate(names)}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        now, pos, h = None, 0, 0
        held = None                                     # the last row waits for the one after it
        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[list[int]] = [[] for _ in range(5)]
            groups = batch.column(at[group]).to_pylist()
            for g, x in zip(groups, batch.column(at[item]).to_pylist(), strict=True):
                if g != now:
                    now, pos, h = g, 0, 0
                before = h
                pos += 1
                h = (h * BASE + (int.from_bytes(x, "big") + 1 if x else 0)) % PRIME
                for col, v in zip(out, (pos, *_halves(h), *_halves(before)), strict=True):
                    col.append(v)
            new = pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.int64()) for c in out),
                 pa.array([a != b for a, b in zip(groups, groups[1:], strict=False)] + [True]),
                 pa.repeat(pa.scalar(part, pa.int32()), batch.num_rows)],
                [*names, "pos", "k1", "k2", "p1", "p2", "is_last", "__part"])
            if held is not None:
                last = held.set_column(len(names) + 5, "is_last",
                                       pa.array([held.column(at[group])[0].as_py() != groups[0]]))
                yield last
            if batch.num_rows > 1:
                yield new.slice(0, batch.num_rows - 1)
            held = new.slice(batch.num_rows - 1)
        if held is not None:
            yield held

    state = "pos long, k1 long, k2 long, p1 long, p2 long, is_last boolean"
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    local = stored(ordered.mapInArrow(scan, f"{fields}, {state}, __part int"))

    # one row per partition
    ends = sorted(local.groupBy("__part").agg(F.min(group).alias("first"), F.max(
        F.struct(F.col(group).alias("g"), "pos", "k1", "k2")).alias("end")).collect(), key=lambda r: r["__part"])
    carry: dict[int, tuple[int, int, int]] = {}         # part: group, items and hash before it
    open_at: dict[int, int] = {}                        # part: group that goes on in the next one
    for before, r in zip([None, *ends], ends, strict=False):
        if before is not None and before["end"]["g"] == r["first"]:
            open_at[before["__part"]] = r["first"]
            e, old = before["end"], carry.get(before["__part"])
            n, h = e["pos"], _whole(e["k1"], e["k2"])
            if old is not None and old[0] == e["g"]:
                n, h = n + old[1], _joined(old[1:], e["pos"], h)
            carry[r["__part"]] = (r["first"], n, h)

    def apply(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        fixed = len(names)
        for batch in batches:
            parts = batch.column(fixed + 6).to_numpy(zero_copy_only=False)
            groups = batch.column(at[group]).to_numpy(zero_copy_only=False)
            cols = [batch.column(fixed + i).to_numpy(zero_copy_only=False).copy() for i in range(6)]
            for part in np.unique(parts).tolist():
                if part in open_at:
                    cols[5][(parts == part) & (groups == open_at[part]) & cols[5]] = False
                if part in carry:
                    g, n, h = carry[part]
                    for i in np.flatnonzero((parts == part) & (groups == g)).tolist():
                        pos, k1, k2, p1, p2 = (int(c[i]) for c in cols[:5])
                        cols[0][i] = pos + n
                        cols[1][i], cols[2][i] = _halves(_joined((n, h), pos, _whole(k1, k2)))
                        cols[3][i], cols[4][i] = _halves(_joined((n, h), pos - 1, _whole(p1, p2)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:fixed], *map(pa.array, cols)],
                                             [*names, "pos", "k1", "k2", "p1", "p2", "is_last"])

    return local.mapInArrow(apply, f"{fields}, {state}")
