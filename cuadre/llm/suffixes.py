"""Removal of byte strings that occur more than once, by a distributed sort of a sparse suffix set.

A string of `LENGTH` bytes that starts at two places is removed at both; matches never cross texts. Not all
suffixes are sorted. A minimizer (the least hash of `SEED` bytes) of each window of LENGTH bytes depends on the
window's bytes alone, so equal windows have their minimizers, the anchors, at equal distances. An anchor stands for
the windows that have it as minimizer; the bytes of these windows are its span.

1. Anchors with equal seed and equal span are one class. All windows of a class with two or more anchors occur twice.
   A class whose seed no other class has needs no more work: this is the test of distinguishing prefixes that saves
   the exchange of suffixes which cannot be equal to any other.
2. Of the other classes, the right parts of the spans (from the anchor on) are merge-sorted (`merge_sort`): sorted
   runs are exchanged front-coded, and loser trees that know common prefixes give the LCPs of neighbours. A node
   is a set of neighbours that share a prefix: each class lies in nested nodes, whose depths are the minima of LCPs
   to its left and right.
3. For each class and each of its nodes, the left part of the span read backwards, behind the node's name, is
   merge-sorted too. The LCP with a neighbour in the node tells how far to the left another class of the
   node agrees. A window that begins d bytes before the anchor occurs in another class if and only if
   some class shares LENGTH - d bytes to the right and d bytes to the left, which these numbers decide exactly.

The repeated windows of each anchor go back to their texts as byte ranges.

Defined cases: null and empty texts and texts shorter than LENGTH keep everything; overlapping occurrences
count, also within one text; repeated rows are occurrences like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import kinds, per_batch, raw, row_keys, written
from cuadre.llm.merge_sort import common_prefix, falling, merge_sorted

LENGTH = 400
SEED = 32

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: Places in a text take so many low bits of a packed hash.
_PLACE_BITS = np.uint64(31)


def seed_hashes(text: bytes, seed: int) -> np.ndarray:
    """A 64-bit hash of the `seed` bytes (a multiple of 8) from each place on."""
    size = len(text) - seed + 1
    data = np.frombuffer(text, dtype=np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = np.ascontiguousarray(words).view("<u8").ravel()
    value = np.full(size, seed, dtype=np.uint64)
    for at in range(0, seed, 8):
        value = (value ^ words[at : at + size]) * _MIX[(at // 8) % 3]
        value ^= value >> np.uint64(29)
    return value * _MIX[1]


def anchors(text: bytes, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor: its place, the first and the last start of its windows, and its seed's hash."""
    windows = len(text) - length + 1
    if windows < 1:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    hashes = seed_hashes(text, seed)
    # the hash above, the place below: of equal hashes the leftmost is least
    packed = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    width = length - seed + 1
    rows = -(-len(packed) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(packed)] = packed
    blocks = padded.reshape(rows, width)
    from_left = np.minimum.accumulate(blocks, axis=1).ravel()
    from_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(from_right[:windows], from_left[width - 1 : width - 1 + windows])
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.append(first[1:], windows) - 1
    place = (least[first] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    return place, first, last, hashes[place].view(np.int64)


def anchor_table(texts: DataFrame, length: int) -> DataFrame:
    """`texts` (row_a, row_b, text) -> row_a, row_b, place, first, last, seed, span (a hash of the span and of the
    anchor's place in it)."""
    names = ["row_a", "row_b", "place", "first", "last", "seed", "span"]

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = [[] for _ in range(6)]
            for number, content in enumerate(raw(batch.column(2))):
                place, first, last, seed = anchors(content, length)
                if not len(place):
                    continue
                spans = [
                    xxhash.xxh3_64_intdigest(content[a : b + length], seed=p - a)
                    for p, a, b in zip(place.tolist(), first.tolist(), last.tolist())
                ]
                spans = np.array(spans, dtype=np.uint64).view(np.int64)
                for part, values in zip(parts, (np.full(len(place), number), place, first, last, seed, spans)):
                    part.append(values)
            row, place, first, last, seed, span = (
                np.concatenate(p) if p else np.empty(0, dtype=np.int64) for p in parts
            )
            ids = [batch.column(k).to_numpy(zero_copy_only=False)[row] for k in (0, 1)]
            columns = [*ids, *(x.astype(np.int32) for x in (place, first, last)), seed, span]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=names)

        return one

    schema = "row_a long, row_b long, place int, first int, last int, seed long, span long"
    return per_batch(texts, schema, make, most_rows=500)


def spans_of(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The two parts of the spans of `wanted` (row_a, row_b, place, first, last, seed, span): id, `right` from the
    anchor on and `left`, what stands before it, backwards."""
    asked = wanted.groupBy("row_a", "row_b").agg(
        F.collect_list(F.struct("place", "first", "last", "seed", "span")).alias("asked")
    )
    rows = texts.join(asked, ["row_a", "row_b"]).select("text", "asked")

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for content, asked in zip(raw(batch.column(0)), batch.column(1).to_pylist()):
                for x in asked:
                    p, a, b = x["place"], x["first"], x["last"]
                    found.append((x["seed"], x["span"], content[p : b + length], content[a:p][::-1], b - p))
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32()]
            columns = list(zip(*found)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, types)], names=["seed", "span", "right", "left", "nearest"]
            )

        return one

    return per_batch(rows, "seed long, span long, right binary, left binary, nearest int", make, most_rows=500)


def part_edges(merged: DataFrame, key: str) -> list[tuple[int, bytes, bytes, list[int], list[int]]]:
    """Of each part of a merge sort, in order: its number, first and last string, and the running minima of its LCPs.
    Some hundred bytes for each part, not for each row."""
    firsts = merged.where("place = 0").select("part", F.col(key).alias("head"), "edge.*").collect()
    return sorted((r[0], bytes(r[1]), bytes(r[2]), list(r[3]), list(r[4])) for r in firsts)


def outer_depths(edges: list[tuple[int, bytes, bytes, list[int], list[int]]], least: int) -> dict[int, tuple[list, list]]:
    """Of each part: the distinct minima of LCPs between its first string and those of the parts before, falling, and
    likewise of its last string and the parts after; only minima of at least `least`."""
    before: dict[int, list[int]] = {}
    after: dict[int, list[int]] = {}
    chain: list[int] = []
    for k, (part, head, _, _, _) in enumerate(edges):
        if k:
            _, _, tail, _, leftward = edges[k - 1]
            chain = [x for x in falling([common_prefix(tail, head), *leftward, *chain]) if x >= least]
        before[part] = chain
    chain = []
    for k in range(len(edges) - 1, -1, -1):
        part, _, tail, _, _ = edges[k]
        if k + 1 < len(edges):
            _, head, _, rightward, _ = edges[k + 1]
            chain = [x for x in falling([common_prefix(tail, head), *rightward, *chain]) if x >= least]
        after[part] = chain
    return {part: (before[part], after[part]) for part in before}


def node_items(merged: DataFrame, length: int, least: int) -> DataFrame:
    """For each class and node that can decide windows: item (the node's name and the left part), seed, span, and the
    range low..high of distances d before the anchor, for which the node holds those that share LENGTH - d bytes."""
    outer = outer_depths(part_edges(merged, "right"), least)
    shared = merged.sparkSession.sparkContext.broadcast(outer)
    names = ["item", "tie", "seed", "span", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def items() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(waiting)
            part = rows.column("part")[0].as_py()
            lcps, rights, lefts, seeds, spans, nearest = (
                rows.column(c).to_pylist() for c in ("lcp", "right", "left", "seed", "span", "nearest")
            )
            n, (before, after) = len(lcps), shared.value[part]
            depths = [set() for _ in range(n)]
            # a stack of the running minima from each string leftwards, then rightwards
            for order, start, beside in (
                (range(n), before, lambda i: lcps[i] if i else None),
                (range(n - 1, -1, -1), after, lambda i: lcps[i + 1] if i + 1 < n else None),
            ):
                stack = start[::-1]
                for i in order:
                    lcp = beside(i)
                    if lcp is not None:
                        while stack and stack[-1] >= lcp:
                            stack.pop()
                        if lcp >= least:
                            stack.append(lcp)
                    depths[i].update(stack)
            found = []
            for i in range(n):
                if i and (spans[i], seeds[i]) == (spans[i - 1], seeds[i - 1]):
                    continue  # a row that is repeated as a whole gives its spans again
                parent = least - 1
                for depth in sorted(depths[i]):
                    # shares `depth` bytes with all of the node, and more than `parent` only within it
                    low = max(length - depth, -nearest[i])
                    high = min(length - parent - 1, len(lefts[i]))
                    parent = depth
                    if low <= high:
                        name = xxhash.xxh3_128_digest(rights[i][:depth])
                        found.append((name + lefts[i][:high], spans[i], seeds[i], spans[i], low, high))
                if len(found) > 20_000:
                    yield batch_of(found)
                    found = []
            if found:
                yield batch_of(found)

        def batch_of(found: list) -> pa.RecordBatch:
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), types)], names=names)

        for batch in batches:
            parts, start = batch.column("part").to_pylist(), 0
            while start < len(parts):
                end = bisect.bisect_right(parts, parts[start])
                if waiting and waiting[0].column("part")[0].as_py() != parts[start]:
                    yield from items()
                    waiting = []
                waiting.append(batch.slice(start, end - start))
                start = end
        if waiting:
            yield from items()

    columns = ["part", "place", "lcp", "right", "left", "seed", "span", "nearest"]
    ordered = merged.select(*columns).repartition("part").sortWithinPartitions("part", "place")
    return ordered.mapInArrow(run, "item binary, tie long, seed long, span long, low int, high int")


def repeated_ranges(merged: DataFrame) -> DataFrame:
    """seed, span, low, high: distances at which another class agrees on both sides. `merged`: sorted node items."""
    name = 16  # bytes of a node's name
    parts = part_edges(merged, "item")
    seams = [0, *(common_prefix(a[2], b[1]) for a, b in zip(parts, parts[1:])), 0]
    beside = {part[0]: (seams[k], seams[k + 1]) for k, part in enumerate(parts)}
    shared = merged.sparkSession.sparkContext.broadcast(beside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (part, seed, span, low, high, lcp before)
        names = ["seed", "span", "low", "high"]
        for batch in batches:
            found = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("part", "lcp", "seed", "span", "low", "high")))
            for part, lcp, seed, span, low, high in rows:
                if last is not None:
                    found.append(judged(last, lcp if last[0] == part else shared.value[last[0]][1]))
                if last is None or last[0] != part:
                    lcp = shared.value[part][0]
                last = (part, seed, span, low, high, lcp)
            yield full([x for x in found if x], names)
        if last is not None:
            yield full([x for x in [judged(last, shared.value[last[0]][1])] if x], names)

    def judged(entry, lcp_after):
        _, seed, span, low, high, lcp_before = entry
        reach = min(max(lcp_before, lcp_after) - name, high)
        return (seed, span, low, reach) if reach >= low else None

    def full(found, names):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = list(zip(*found)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=names)

    columns = ["part", "place", "lcp", "seed", "span", "low", "high"]
    ordered = merged.select(*columns).repartition("part").sortWithinPartitions("part", "place")
    return ordered.mapInArrow(run, "seed long, span long, low int, high int")


def repeated_windows(texts: DataFrame, length: int) -> DataFrame:
    """row_a, row_b, begin, end: byte ranges (end excluded) of windows that occur elsewhere too."""
    found = written(anchor_table(texts, length), "anchors")
    seeds = found.groupBy("seed").agg(
        F.count("*").alias("total"), (F.min("span") != F.max("span")).alias("differ")
    )
    # a seed that occurs once has no window that occurs twice; the seeds are written so that AQE can split a hot one
    repeated = written(seeds.where("total > 1").drop("total"), "seeds")
    hits = written(found.join(repeated, "seed"), "hits")
    some = F.struct("row_a", "row_b", "place", "first", "last")
    classes = hits.groupBy("seed", "span", "differ").agg(F.count("*").alias("copies"), F.min(some).alias("some"))
    classes = written(classes, "classes")

    open_classes = classes.where("differ").select("some.*", "seed", "span")
    parts = written(spans_of(texts, open_classes, length), "spans")
    merged = merge_sorted(parts, "right", "span", ["left", "seed", "nearest"])
    merged = written(merged, "sorted")
    items = written(node_items(merged, length, SEED), "items")
    ordered = merge_sorted(items, "item", "tie", ["seed", "span", "low", "high"])
    partly = repeated_ranges(written(ordered, "sorted"))

    # a class that occurs twice is repeated in all its windows; the others in the ranges found
    nothing = F.lit(None).cast("int")
    whole = classes.where("copies > 1").select("seed", "span", nothing.alias("low"), nothing.alias("high"))
    decided = written(whole.unionByName(partly), "decided")
    hits = hits.join(decided, ["seed", "span"])
    begin = F.coalesce(F.col("place") - F.col("high"), F.col("first"))
    end = F.coalesce(F.col("place") - F.col("low"), F.col("last")) + length
    return hits.select("row_a", "row_b", begin.alias("begin"), end.alias("end"))


def word_windows(text: bytes, words: int, below: int) -> dict[bytes, list[list[int]]]:
    """Digest -> byte ranges, overlapping ones joined, of the runs of `words` words that have less than `below` bytes.
    White space separates words, and what stands between the words counts."""
    data = np.frombuffer(text, dtype=np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    turns = np.diff(np.concatenate(([1], space.astype(np.int8), [1])))
    begins, ends = np.flatnonzero(turns == -1)[: -words + 1 or None], np.flatnonzero(turns == 1)[words - 1 :]
    if not len(ends):
        return {}
    short = np.flatnonzero(ends - begins < below)
    found: dict[bytes, list[list[int]]] = {}
    for a, b in zip(begins[short].tolist(), ends[short].tolist()):
        ranges = found.setdefault(xxhash.xxh3_128_digest(text[a:b]), [])
        if ranges and a <= ranges[-1][1]:
            ranges[-1][1] = b
        else:
            ranges.append([a, b])
    return found


def shared_passages(texts: DataFrame, words: int, below: int) -> DataFrame:
    """row_a, row_b, begin, end: byte ranges of passages of at least `words` words, of which no run of `words` words has
    `below` bytes, that stand in two rows of `texts` (row_a, row_b, text)."""
    names = ["row_a", "row_b", "key_a", "key_b", "ranges"]
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, keys, ranges = [], [], []
            for number, content in enumerate(raw(batch.column(2))):
                for key, found in word_windows(content, words, below).items():
                    rows.append(number)
                    keys.append(key)
                    ranges.append([{"begin": a, "end": b} for a, b in found])
            halves = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
            ids = [batch.column(k).take(pa.array(rows, pa.int64())) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(
                [*ids, pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(ranges, kind)], names=names
            )

        return one

    schema = "row_a long, row_b long, key_a long, key_b long, ranges array<struct<begin:int,end:int>>"
    windows = written(per_batch(texts, schema, make, most_rows=500), "windows")
    # written, so that AQE can split a hot key of the join
    counts = windows.groupBy("key_a", "key_b").agg(F.count("*").alias("rows"))
    shared = written(counts.where("rows > 1").drop("rows"), "shared")
    return windows.join(shared, ["key_a", "key_b"]).select("row_a", "row_b", F.inline("ranges"))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", as_text: bool = False,
    passage_words: int | None = None,
) -> DataFrame:
    """`docs` with `kept` (the remaining bytes, or with `as_text` the text of the whole characters among them) in place
    of `text`, and `removed`, an array of (begin, end) byte ranges.

    With `passage_words`, passages of so many words that two rows share are removed also where they have less than
    `length` bytes. Rows of equal id and text get the same result; each of them counts as an occurrence.
    """
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    row_a, row_b = row_keys(doc_id, text)
    # the text goes through the joins and to the workers once
    carried = [c for c in docs.columns if c not in (text, "kept", "removed", "content", "row_a", "row_b", "found")]
    rows = docs.select(*[F.col(f"`{c}`") for c in carried], content.alias("content"), row_a, row_b)
    texts = rows.select("row_a", "row_b", F.col("content").alias("text"))
    found = repeated_windows(texts.where(F.octet_length("text") >= length), length)
    if passage_words:
        # so many words have one byte each at least, and one between them
        enough = texts.where(F.octet_length("text") >= 2 * passage_words - 1)
        found = found.unionByName(shared_passages(enough, passage_words, length))
    spans = found.groupBy("row_a", "row_b").agg(F.collect_set(F.struct("begin", "end")).alias("found"))
    joined = rows.join(spans, ["row_a", "row_b"], "left")
    prepared = joined.select(*[F.col(f"`{c}`") for c in carried], "content", "found")
    removed_kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept, removed = [], []
            contents, spans = raw(batch.column(batch.num_columns - 2)), batch.column(batch.num_columns - 1).to_pylist()
            for content, found in zip(contents, spans):
                runs: list[list[int]] = []
                for begin, end in sorted((x["begin"], x["end"]) for x in found or ()):
                    if runs and begin <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([begin, end])
                edges = [0, *(x for run in runs for x in run), len(content)]
                kept.append(b"".join(content[a:b] for a, b in zip(edges[::2], edges[1::2])))
                removed.append([{"begin": a, "end": b} for a, b in runs])
            if as_text:
                kept = [x.decode("utf-8", "ignore") for x in kept]
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(removed, removed_kind)],
                names=[*carried, "kept", "removed"],
            )

        return one

    schema = kinds(docs, carried, f"kept {'string' if as_text else 'binary'}, removed array<struct<begin:long,end:long>>")
    return per_batch(prepared, schema, make, 500)
