"""Distributed merge sort of byte strings that reuses common prefixes.

Each task sorts its strings into runs, cuts the runs at splitters that a sample gives, and front-codes them: of
each string only what follows its common prefix with the string before it is exchanged. Each receiving task
merges the runs of a key range with a loser tree that keeps, for each run's head, the length of its common prefix
(LCP) with the string put out last. Of two heads the one with the longer LCP is the smaller; only heads with equal
LCPs are compared, and only from there on. The LCPs of neighbours in the result come out of the merge.

Equal strings are ordered by a second key, so that a string that many rows share spreads over tasks as well.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows in a run that a task sorts at once.
RUN_ROWS = 50_000
#: Least rows of a key range.
RANGE_ROWS = 1_000
EDGE = pa.struct(
    [("tail", pa.binary()), ("rightward", pa.list_(pa.int32())), ("leftward", pa.list_(pa.int32()))]
)
#: Sampled strings for each range: their number bounds how uneven the ranges are.
SAMPLES = 16


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree in their first `known` bytes."""
    most = min(len(a), len(b))
    while known < most:
        step = min(64, most - known)
        x, y = a[known : known + step], b[known : known + step]
        if x != y:
            differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return known + step - (differ.bit_length() + 7) // 8
        known += step
    return most


def ranges_for(rows: int) -> int:
    """Key ranges for so many rows: the size of a range and the number of ranges grow as the square root."""
    return max(1, rows // max(RANGE_ROWS, math.isqrt(rows)))


def falling(values: Iterable[int]) -> list[int]:
    """The distinct running minima."""
    found: list[int] = []
    for x in values:
        if not found or x < found[-1]:
            found.append(x)
    return found


class LoserTree:
    """Merges sorted runs of (string, second key, row). `lcps`: of each string with the one before it in its run."""

    def __init__(self, runs: list[list[tuple[bytes, int, object]]], lcps: list[list[int]]):
        self.runs, self.lcps = runs, lcps
        self.place = [0] * len(runs)
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        # LCP of each head with the last string put out; at first with the empty string
        self.lcp = [0] * len(runs)
        self.losers = [-1] * self.size
        self.winner = self._first(1)

    def _first(self, node: int) -> int:
        if node >= self.size:
            run = node - self.size
            return run if run < len(self.runs) and self.runs[run] else -1
        return self._play(node, self._first(2 * node), self._first(2 * node + 1))

    def _play(self, node: int, a: int, b: int) -> int:
        """Keeps the loser of two heads at the node, with its LCP with the winner; returns the winner."""
        if a < 0 or b < 0:
            self.losers[node] = -1
            return max(a, b)
        lcp = self.lcp
        if lcp[a] != lcp[b]:
            # the loser's LCP with the winner is what it was with the last string
            winner, loser = (a, b) if lcp[a] > lcp[b] else (b, a)
        else:
            x, y = self.runs[a][self.place[a]], self.runs[b][self.place[b]]
            known = common_prefix(x[0], y[0], lcp[a])
            winner, loser = (a, b) if (x[0][known : known + 1], x[1], a) <= (y[0][known : known + 1], y[1], b) else (b, a)
            lcp[loser] = known
        self.losers[node] = loser
        return winner

    def __iter__(self) -> Iterator[tuple[int, tuple[bytes, int, object]]]:
        """(LCP with the string before, entry) in order."""
        while self.winner >= 0:
            run = self.winner
            yield self.lcp[run], self.runs[run][self.place[run]]
            self.place[run] += 1
            left = run
            if self.place[run] < len(self.runs[run]):
                self.lcp[run] = self.lcps[run][self.place[run]]
            else:
                left = -1
            node = (run + self.size) // 2
            while node:
                other = self.losers[node]
                if other >= 0:
                    left = self._play(node, left, other) if left >= 0 else self._leave(node, other)
                node //= 2
            self.winner = left

    def _leave(self, node: int, other: int) -> int:
        self.losers[node] = -1
        return other


def splitters(df: DataFrame, key: str, second: str, rows: int) -> list[tuple[bytes, int]]:
    """Bounds of `ranges_for(rows)` ranges of about equal size, from a sample of about `SAMPLES` strings for each.

    The sample is what a hash of the row picks, one row in so many; its size grows as the number of ranges does.
    """
    ranges = ranges_for(rows)
    if ranges < 2:
        return []
    every = max(1, rows // (ranges * SAMPLES))
    sample = df.select(key, second).where(F.pmod(F.xxhash64(key, second), F.lit(every)) == 0)
    found = sorted((bytes(r[0]), r[1]) for r in sample.collect())
    return sorted({found[len(found) * k // ranges] for k in range(1, ranges)}) if found else []


def merge_sorted(df: DataFrame, key: str, second: str, payload: list[str]) -> DataFrame:
    """Rows of `df` by (`key`, `second`): part, place, lcp, edge, `key`, `second` and `payload`. Ordered by part and
    place they are in order; `lcp` is the common prefix of `key` with the row before, and 0 for the first of a part.
    Only the first of a part has an `edge`: the part's last key (tail), and the distinct running minima of its LCPs,
    falling, from the first row rightwards (rightward) and from the last row leftwards (leftward).

    `key` is binary and not null, `second` a long. `df` is read more than once: it should be a written table.
    """
    bounds = splitters(df, key, second, df.count())
    ranges = len(bounds) + 1
    shared = df.sparkSession.sparkContext.broadcast(bounds)
    kinds = {c: df.schema[c].dataType.simpleString() for c in payload}
    carried = "".join(f", `{c}` {k}" for c, k in kinds.items())

    def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bounds, number, waiting, count = shared.value, 0, [], 0
        task = TaskContext.get().partitionId()

        def run() -> pa.RecordBatch:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            keys, seconds = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            order = sorted(range(len(keys)), key=lambda i: (keys[i], seconds[i]))
            parts, lcps, rests, before, part = [], [], [], b"", -1
            for i in order:
                at = bisect.bisect_right(bounds, (keys[i], seconds[i]))
                lcp = common_prefix(before, keys[i]) if at == part else 0
                parts.append(at)
                lcps.append(lcp)
                rests.append(keys[i][lcp:])
                before, part = keys[i], at
            ordered = rows.take(pa.array(order, pa.int64()))
            n = len(order)
            columns = [
                pa.array(parts, pa.int32()), pa.array([task * 1_000_000 + number] * n, pa.int64()),
                pa.array(range(n), pa.int32()), pa.array(lcps, pa.int32()), pa.array(rests, pa.binary()),
                *(ordered.column(c).combine_chunks() for c in range(1, ordered.num_columns)),
            ]
            flat = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            return pa.RecordBatch.from_arrays(flat, names=["part", "run", "seq", "lcp", key, second, *payload])

        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            if count >= RUN_ROWS:
                yield run()
                number, waiting, count = number + 1, [], 0
        if count:
            yield run()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def merged() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(waiting)
            runs, lcps, names, before = [], [], [], b""
            numbers, lengths, rests = (rows.column(c).to_pylist() for c in ("run", "lcp", key))
            for i, (number, lcp, rest, tie) in enumerate(zip(numbers, lengths, rests, rows.column(second).to_pylist())):
                if not names or names[-1] != number:
                    names.append(number)
                    runs.append([])
                    lcps.append([])
                before = before[:lcp] + rest
                runs[-1].append((before, tie, i))
                lcps[-1].append(lcp)
            part, place = waiting[0].column("part")[0].as_py(), 0
            out = list(LoserTree(runs, lcps))
            between = [lcp for lcp, _ in out[1:]]
            edge = {"tail": out[-1][1][0], "rightward": falling(between), "leftward": falling(reversed(between))}
            for start in range(0, len(out), 10_000):
                some = out[start : start + 10_000]
                picked = rows.select(payload).take(pa.array([x[1][2] for x in some], pa.int64())).combine_chunks()
                columns = [
                    pa.array([part] * len(some), pa.int32()), pa.array(range(place, place + len(some)), pa.int64()),
                    pa.array([x[0] for x in some], pa.int32()),
                    pa.array([None if start + k else edge for k in range(len(some))], EDGE),
                    pa.array([x[1][0] for x in some], pa.binary()),
                    pa.array([x[1][1] for x in some], pa.int64()),
                    *(picked.column(c).chunk(0) for c in payload),
                ]
                place += len(some)
                yield pa.RecordBatch.from_arrays(columns, names=["part", "place", "lcp", "edge", key, second, *payload])

        for batch in batches:
            parts = batch.column("part").to_pylist()
            start = 0
            while start < len(parts):
                end = bisect.bisect_right(parts, parts[start])
                if waiting and waiting[0].column("part")[0].as_py() != parts[start]:
                    yield from merged()
                    waiting = []
                waiting.append(batch.slice(start, end - start))
                start = end
        if waiting:
            yield from merged()

    runs = df.select(key, second, *payload).mapInArrow(
        sort_runs, f"part int, run long, seq int, lcp int, `{key}` binary, `{second}` long{carried}"
    )
    dealt = runs.repartition(ranges, "part").sortWithinPartitions("part", "run", "seq")
    edge = "edge struct<tail:binary,rightward:array<int>,leftward:array<int>>"
    return dealt.mapInArrow(merge, f"part int, place long, lcp int, {edge}, `{key}` binary, `{second}` long{carried}")
