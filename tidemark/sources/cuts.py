"""Batches that end by count, by bytes or where a group ends, without a reader of all rows.

A batch ends with the row that makes it ``n`` rows or ``most`` bytes; the next one starts at zero, so where a batch starts depends on all rows before it. What
a part of the sorted rows needs to know of them is only how many rows the open batch has when the part begins, which is less than ``n``. So each part gives
a map from that number to the one at its end, for all numbers at once; maps of neighbouring parts are composed by doubling, in log(parts) rounds of one
join of one short row a part; and each part, told its number, cuts its own rows. Within a part the same is done in memory: each row points to the row
behind the batch that would start there, and pointers are doubled.

Parts are so many rows by their number in the whole order; the result depends on the rows alone.

Cases: null sizes count as zero bytes, negative ones too; rows with equal keys follow in the order of the sizes and then in any (they are the same to a batch, whose first and last keys are
equal then); null keys come first; a group may end a batch early, and null groups are groups; no rows give no batches; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.shared import discard, numbered, written

#: Rows of a part.
PART = 1 << 18


class _Part:
    """Rows in order: their sizes, and which of them begin a group."""

    def __init__(self, sizes: np.ndarray, new: np.ndarray, n: int, most: int):
        self.n, self.most, self.length, self.first_new = n, most, len(sizes), bool(len(new) and new[0])
        self.cum = np.concatenate([[0], np.cumsum(sizes)])
        at = np.append(np.flatnonzero(new), self.length + 1)
        #: For each place the next one behind it that begins a group.
        self.next_new = at[np.searchsorted(at, np.arange(self.length), side="right")]

    def behind(self) -> np.ndarray:
        """For each row the place behind the batch that starts there, beyond the part's end where that is not reached."""
        i = np.arange(self.length)
        full = np.searchsorted(self.cum, self.cum[i] + self.most, side="left")
        return np.minimum(np.minimum(i + self.n, full), self.next_new)

    def entered(self, open_rows: np.ndarray, open_bytes: np.ndarray) -> np.ndarray:
        """Where the first batch of the part's own starts if one with so many rows and bytes is open; beyond the end where that stays open."""
        until = np.minimum(self.n - open_rows, np.searchsorted(self.cum, self.most - open_bytes, side="left"))
        until = np.minimum(until, self.next_new[0] if self.length else 1)
        return np.where(self.first_new | (open_rows == 0), 0, until)

    def outcome(self, open_rows: np.ndarray, open_bytes: np.ndarray) -> np.ndarray:
        """How many rows the open batch has at the part's end."""
        end = self.length
        at = np.append(self.behind(), end)
        at = np.where(at > end, np.arange(end + 1), at)  # a batch that stays open stands still
        while not np.array_equal(ahead := at[at], at):
            at = ahead
        entry = self.entered(open_rows, open_bytes)
        inside = np.minimum(entry, end)
        last = at[inside]
        return np.where(entry > end, open_rows + end, np.where(last == end, 0, end - last))

    def starts(self, open_rows: int, open_bytes: int) -> list[int]:
        """The places in the part where batches start, and its end."""
        at, behind = int(self.entered(np.array([open_rows]), np.array([open_bytes]))[0]), self.behind()
        out = []
        while at < self.length:
            out.append(at)
            at = int(behind[at])
        return [*out, self.length]


def _numpy(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _halves(table: pa.Table, n: int, most: int) -> tuple[pa.Table, _Part, np.ndarray]:
    """The part's own rows in order, and the bytes of the last 0, 1, 2, ... rows before it."""
    table = table.sort_by("rn")
    own = _numpy(table, "own")
    sizes = _numpy(table, "size")
    before = np.concatenate([[0], np.cumsum(sizes[~own][::-1])])
    mine = table.filter(pa.array(own))
    return mine, _Part(sizes[own], _numpy(mine, "new"), n, most), before


def cut(rows: DataFrame, order: list[str], size: Column, n: int, most: int = 2**62, by: tuple[str, ...] = (), part: int = PART) -> DataFrame:
    """Batches of ``rows`` in the order of ``by`` and ``order``: batch (from 0), the columns ``by``, n, first_key and last_key (of the last column of ``order``)
    and bytes. A batch ends with the row that reaches ``n`` rows or ``most`` bytes, or with the last row of its ``by``."""
    n, most, part = max(1, n), max(1, most), max(part, n)
    key = order[-1]
    sized = rows.select(*by, *order, F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0).cast("long")).alias("size"))
    ranked = numbered(sized, *by, *order, "size")
    named = ranked.withColumn("part", F.expr(f"(rn - 1) div {part}")).select("part", "rn", "size", F.col(key).alias("key"), F.struct(*by).alias("grp") if by else F.lit(None).cast("struct<x:int>").alias("grp"))
    # rows that the next part looks back at go to both
    near = F.expr(f"(rn - 1) % {part}") >= part - (n - 1)
    both = F.when(near, F.array(F.struct(F.lit(True).alias("own"), F.col("part").alias("to")), F.struct(F.lit(False).alias("own"), (F.col("part") + 1).alias("to")))).otherwise(F.array(F.struct(F.lit(True).alias("own"), F.col("part").alias("to"))))
    dealt = named.withColumn("x", F.explode(both)).select(F.col("x.to").alias("part"), "x.own", "rn", "size", "key", "grp")
    groups = F.xxhash64(*(F.coalesce(F.col(f"grp.{c}").cast("string"), F.lit("\0")) for c in by)) if by else F.lit(0).cast("long")
    dealt = dealt.withColumn("mark", groups)
    marks = "part long, own boolean, rn long, size long, mark long"

    def with_new(table: pa.Table) -> pa.Table:
        table = table.sort_by("rn")
        mark = _numpy(table, "mark")
        return table.append_column("new", pa.array(np.append(False, mark[1:] != mark[:-1]) if len(mark) else np.zeros(0, bool)))

    def summary(table: pa.Table) -> pa.Table:
        mine, rest, before = _halves(with_new(table), n, most)
        where = table.column("part")[0].as_py()
        if not len(mine):  # a part of nothing but what it looks back at
            return pa.table({"part": pa.array([], pa.int64()), "f": pa.array([], pa.list_(pa.int32()))})
        c = np.arange(n)
        f = rest.outcome(c, before[np.minimum(c, len(before) - 1)])
        return pa.table({"part": pa.array([where], pa.int64()), "f": pa.array([f.astype(np.int32)], pa.list_(pa.int32()))})

    ready = written(dealt, "cut-rows")
    discard(ranked)
    maps = written(ready.select(*(x.split()[0] for x in marks.split(", "))).groupBy("part").applyInArrow(summary, "part long, f array<int>"), "cut-maps")
    parts, step = maps.count(), 1
    while step < parts:
        here, there = maps.alias("here"), maps.select((F.col("part") + step).alias("part"), F.col("f").alias("g"))
        composed = here.join(there, "part", "left").select("part", F.when(F.col("g").isNull(), F.col("f")).otherwise(F.transform("g", lambda c: F.element_at("f", c + 1))).alias("f"))
        after = written(composed, "cut-maps")
        discard(maps)
        maps, step = after, 2 * step
    opened = maps.select((F.col("part") + 1).alias("part"), F.col("f")[0].alias("open_rows"))
    told = ready.join(opened, "part", "left").withColumn("open_rows", F.coalesce("open_rows", F.lit(0)))
    kind = dict(named.dtypes)
    shape = f"start long, n long, first_key {kind['key']}, last_key {kind['key']}, bytes long, last_rn long, grp {kind['grp']}"

    def batches(table: pa.Table) -> pa.Table:
        mine, rest, before = _halves(with_new(table), n, most)
        c = int(mine.column("open_rows")[0].as_py()) if len(mine) else 0
        ends = rest.starts(c, int(before[min(c, len(before) - 1)]))
        if len(mine) and ends[0] > 0:  # the batch that is open when the part begins
            ends = [0, *ends]
        a, b = np.array(ends[:-1], np.int64), np.array(ends[1:], np.int64)
        rn = _numpy(mine, "rn")
        start = rn[a] if len(a) else np.zeros(0, np.int64)
        if len(a) and c and not rest.first_new:
            start[0] -= c
        first, last = (mine.take(pa.array(x)) for x in (a, b - 1))
        return pa.table({"start": start, "n": b - a, "first_key": first.column("key"), "last_key": last.column("key"), "bytes": rest.cum[b] - rest.cum[a], "last_rn": last.column("rn"), "grp": last.column("grp")})

    pieces = told.groupBy("part").applyInArrow(batches, shape)
    found = pieces.groupBy("start").agg(F.sum("n").alias("n"), F.min_by("first_key", "last_rn").alias("first_key"), F.max_by("last_key", "last_rn").alias("last_key"), F.sum("bytes").alias("bytes"), F.max_by("grp", "last_rn").alias("grp"))
    found = written(found, "cut-batches")
    discard(ready)
    discard(maps)
    out = numbered(found, "start")
    discard(found)
    return out.select((F.col("rn") - 1).alias("batch"), *(F.col(f"grp.{c}").alias(c) for c in by), "n", "first_key", "last_key", "bytes")
