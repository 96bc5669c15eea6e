"""Prefix trie of conversations, built as a burst trie over shards.

A conversation's turns become a path: `TURN` bytes for each turn, 16 of the SHA-256 of its role and text and 8 of its text's
length. Equal paths become one string with its number of conversations, the smallest of their ids and the digest of their ids
in order. All strings begin in one container, whose trie head is the root. A round measures the containers; one that holds
more than `CONTAINER` turns bursts: its strings move by their next turn id into containers below, and what they pass becomes
trie nodes, counted by grouping (map-side combined). The strings of a container that bursts again move by twice as many turns,
so there are few rounds, however long the conversations. Containers that remain are sorted and swept, each in one task:
a stack holds the nodes on the way to the string at hand, and a node that is left adds its sums to its parent. Sums of what
burst follow bottom-up: of a node, its own and those of its descendants are credited to the string with the node's
smallest id, summed up along the string, and grouped by node.

Nodes and containers are told apart by 128-bit digests of their paths.

Defined cases: turns are ordered by number, null first, then by the digest of role and text; null roles and texts are empty;
repeated rows are turns of their own; rows without a conversation id belong to no conversation; a conversation without a turn
is a member of the root; an empty table has no nodes; texts may be of any length, for only digests are shuffled. A conversation
is put together by one task, as one row of `TURN` bytes for each of its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuadre.llm.common import small_side, written
from cuadre.llm.merge_sort import common_prefix

ID, TURN = 16, 24
#: Turns (and one for each string) in a container that is swept by one task; larger ones burst.
CONTAINER = 10_000
#: Turns of the first round's bursts; each round doubles them.
FIRST_STEP = 1
#: Conversation ids whose text is hashed at a time.
CHUNK_IDS = 5_000
FAMILY = 5
DONATED = 9

NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long,"
    " ends_sha256 string"
)
NODE_NAMES = [x.split()[0] for x in NODES.split(", ")]
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def _stream(df: DataFrame, schema: str, run: Callable[[Iterator[dict]], Iterator[tuple]], rows: int = 5_000) -> DataFrame:
    """`df` through a function from rows to rows, in order, as Arrow batches of at most so many rows."""
    names = [x.split()[0] for x in schema.split(", ")]
    simple = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    kinds = [pa.list_(pa.binary()) if (k := x.split()[1]) == "array<binary>" else simple[k] for x in schema.split(", ")]
    arrow = pa.schema(list(zip(names, kinds)))

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], schema=arrow)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def single() -> Iterator[tuple]:
            for batch in batches:
                # slices bound what stands in Python at a time
                for start in range(0, batch.num_rows, 1_000):
                    yield from zip(*(c.to_pylist() for c in batch.slice(start, 1_000).columns))

        found, size = [], 0
        for row in run(single()):
            found.append(row)
            size += sum(len(x) for x in row if type(x) is bytes)
            if len(found) >= rows or size > 16 << 20:
                yield batch_of(found)
                found, size = [], 0
        if found:
            yield batch_of(found)

    return df.mapInArrow(mapped, schema)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path) of each conversation: of conversation `conv_id - conv_id % FAMILY` the first h turns, where h is
    the crc32 of the id as text modulo DONATED, then its own turns after its first h."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    id_ = F.unhex(F.substring(F.sha2(content, 256), 1, 2 * ID))
    size = F.unhex(F.lpad(F.hex(F.octet_length(text).cast("long")), 2 * (TURN - ID), "0"))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("base"), conv.alias("conv_id"), F.col("turn").alias("turn"),
        (F.crc32(conv.cast("string").cast("binary")) % DONATED).cast("int").alias("taken"), F.concat(id_, size).alias("record"),
    )
    order = ["base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "record"]
    dealt = turns.repartition("base").sortWithinPartitions(*order).select("base", "conv_id", "taken", "record")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        family = current = None
        lent: list[bytes] = []  # the first turns of the family's base
        own: list[bytes] = []
        head, skipped = b"", 0
        for base, conv_id, taken, record in rows:
            if conv_id != current:
                if current is not None:
                    yield current, head + b"".join(own)
                if base != family:
                    family, lent = base, []
                current, own = conv_id, []
                # a base's head is its own first turns
                head = b"" if conv_id == base else b"".join(lent[:taken])
                skipped = 0 if conv_id == base else taken
            if conv_id == base and len(lent) < DONATED:
                lent.append(record)
            if skipped:
                skipped -= 1
            else:
                own.append(record)
        if current is not None:
            yield current, head + b"".join(own)

    return _stream(dealt, "conv_id long, path binary", run)


def _digest(path: str) -> Column:
    return F.unhex(F.substring(F.sha2(path, 256), 1, 2 * ID))


def strings(paths: DataFrame) -> DataFrame:
    """The distinct paths: path, conv_id (the smallest), n_convs and ends_sha256, the digest of the ids in order.

    The ids of a path are sorted over range partitions and written as text there, so that of a path that very many
    conversations share one task only hashes that text.
    """
    paths = written(paths.withColumn("string", _digest("path")), "paths")
    once = paths.groupBy("string").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("path").alias("path")
    )
    sorted_ids = paths.select("string", "conv_id").repartitionByRange("string", "conv_id").sortWithinPartitions("string", "conv_id")

    def texts(rows: Iterator[tuple]) -> Iterator[tuple]:
        current, ids = None, []
        for string, conv_id in rows:
            if string != current or len(ids) == CHUNK_IDS:
                if ids:
                    yield current, ids[0], ",".join(map(str, ids)).encode()
                current, ids = string, []
            ids.append(conv_id)
        if ids:
            yield current, ids[0], ",".join(map(str, ids)).encode()

    def hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
        current, total = None, hashlib.sha256()
        for string, _, text in rows:
            if string == current:
                total.update(b",")
            else:
                if current is not None:
                    yield current, total.hexdigest()
                current, total = string, hashlib.sha256()
            total.update(text)
        if current is not None:
            yield current, total.hexdigest()

    chunks = _stream(sorted_ids, "string binary, first_id long, text binary", texts)
    dealt = chunks.repartition("string").sortWithinPartitions("string", "first_id")
    ends = _stream(dealt, "string binary, ends_sha256 string", hashed)
    return once.join(ends, "string").drop("string")


def _turns(path: str = "path") -> Column:
    return F.octet_length(path) / TURN


def stepped(live: DataFrame, steps: int) -> DataFrame:
    """`live` strings (path, head, depth, …) with `nodes`: the ids of the nodes that they pass, from the head on, over at most
    so many turns. The id of a node is the digest of its parent's id and its turn."""
    names = live.columns
    kinds = ", ".join(f"{n} {live.schema[n].dataType.simpleString().replace('bigint', 'long')}" for n in names)
    path_at, head_at, depth_at = (names.index(n) for n in ("path", "head", "depth"))

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for row in rows:
            path, node, depth = row[path_at], row[head_at], row[depth_at]
            nodes = [node]
            for at in range(TURN * depth, min(len(path), TURN * (depth + steps)), TURN):
                node = hashlib.sha256(node + path[at : at + TURN]).digest()[:ID]
                nodes.append(node)
            yield (*row, nodes)

    return _stream(live, f"{kinds}, nodes array<binary>", run)


class Burst:
    """One round's burst: the trie nodes that the strings of oversized containers pass, and the strings that go on."""

    def __init__(self, live: DataFrame, steps: int):
        self.steps = steps
        went = written(stepped(live, steps), "stepped")
        on = F.size("nodes") > steps
        # a string passes the nodes before the last step; the node of that step belongs to the container below
        passed = F.posexplode(F.slice("nodes", 1, steps)).alias("step", "node")
        last_size = F.conv(F.hex(F.substring("path", (F.col("depth") + F.col("step")) * TURN - (TURN - ID - 1), TURN - ID)), 16, 10)
        rows = went.select("head", "conv_id", "n_convs", "depth", "parent_conv_id", "ends_sha256", "path", "nodes", passed)
        self.rows = written(
            rows.select(
                "head", "conv_id", "step", "node", "n_convs",
                (F.col("depth") + F.col("step")).alias("depth"),
                F.when(F.col("step") == 0, F.col("parent_conv_id")).alias("parent_conv_id"),
                F.when(F.col("step") > 0, F.get("nodes", F.col("step") - 1)).alias("parent"),
                F.when(F.col("depth") + F.col("step") > 0, last_size.cast("long")).otherwise(F.lit(0)).alias("size"),
                F.when(F.col("step") == F.size("nodes") - 1, F.col("ends_sha256")).alias("ends_sha256"),
            ),
            "passed",
        )
        nodes = written(
            self.rows.groupBy("node").agg(
                F.first("head").alias("head"), F.first("step").alias("step"), F.first("depth").alias("depth"),
                F.first("parent").alias("parent"), F.first("size").alias("size"), F.min("conv_id").alias("conv_id"),
                F.sum("n_convs").alias("n_convs"), F.max("parent_conv_id").alias("above"), F.max("ends_sha256").alias("ends_sha256"),
            ),
            "nodes",
        )
        going = went.where(on).withColumn("below", F.element_at("nodes", -1)).withColumn("parent", F.element_at("nodes", -2))
        #: the containers below, by head
        self.below = written(
            going.groupBy("below").agg(F.first("head").alias("head"), F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id")),
            "below",
        )
        children = nodes.where("parent IS NOT NULL").select("parent").unionAll(self.below.select("parent"))
        children = children.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
        least = written(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "least")
        self.nodes = written(
            nodes.join(small_side(least), "parent", "left")
            .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).drop("above")
            .join(children, "node", "left").na.fill(0, ["n_children"]),
            "nodes",
        )
        kept = going.select("path", "conv_id", "n_convs", "ends_sha256", "below", "parent", (F.col("depth") + steps).alias("depth"))
        self.live = written(kept.join(small_side(least), "parent").drop("parent").withColumnRenamed("below", "head"), "live")

    def finished(self, totals: DataFrame) -> DataFrame:
        """The nodes with n_leaves and saved_tokens; `totals` (head, n_leaves, saved_tokens) of the containers below."""
        own = self.nodes.select(
            "head", "conv_id", "step", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
        )
        lower = self.below.join(totals.withColumnRenamed("head", "below"), "below").select(
            "head", "conv_id", F.lit(self.steps - 1).alias("step"), "n_leaves", "saved_tokens"
        )
        credited = own.unionByName(lower).groupBy("head", "conv_id", "step").agg(
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
        )
        rows = self.rows.select("head", "conv_id", "step", "node").join(credited, ["head", "conv_id", "step"], "left")
        # at most `steps` rows of a string
        onwards = Window.partitionBy("head", "conv_id").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
        along = rows.select("node", *[F.coalesce(F.sum(c).over(onwards), F.lit(0)).alias(c) for c in ("n_leaves", "saved_tokens")])
        sums = along.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        ended = F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256")
        head = F.when(F.col("step") == 0, F.col("node")).alias("head")
        return self.nodes.drop("head", "parent").join(sums, "node").select(*[ended if n == "ends_sha256" else n for n in NODE_NAMES], head)


class Sweeper:
    """Sweeps the sorted strings of a container; `stack` has the nodes on the way to the last one."""

    def __init__(self, head: bytes, depth: int, parent_conv_id: int | None):
        self.head, self.depth, self.parent_conv_id = head, depth, parent_conv_id
        self.path = b""
        self.stack: list[Node] = []

    def add(self, path: bytes, conv_id: int, n_convs: int, ends: str) -> Iterator[tuple]:
        agreed = self.depth + (common_prefix(self.path, path, TURN * self.depth) - TURN * self.depth) // TURN if self.stack else -1
        if self.stack:
            yield from self.leave(agreed - self.depth + 1)
        for depth in range(self.depth + len(self.stack), len(path) // TURN + 1):
            self.stack.append(Node(depth, int.from_bytes(path[TURN * depth - (TURN - ID) : TURN * depth], "big") if depth else 0))
        for node in self.stack:
            node.n_convs += n_convs
            node.conv_id = conv_id if node.conv_id is None else min(node.conv_id, conv_id)
        self.stack[-1].ends = ends
        self.path = path

    def leave(self, kept: int = 0) -> Iterator[tuple]:
        """Rows of the nodes below the first `kept` of the stack whose parent is complete."""
        while len(self.stack) > kept:
            node = self.stack.pop()
            node.saved += (node.n_convs - 1) * node.size
            node.leaves += not node.n_children
            # the smallest id of a parent is known once it is left
            for child in node.children:
                yield (child[0], child[1], node.conv_id, *child[2:], None)
            row = (node.conv_id, node.depth, node.n_convs, node.n_children, node.leaves, node.saved, node.ends or NO_MEMBERS)
            if self.stack:
                above = self.stack[-1]
                above.children.append(row)
                above.n_children += 1
                above.leaves += node.leaves
                above.saved += node.saved
            else:
                yield (row[0], row[1], self.parent_conv_id, *row[2:], self.head)


class Node:
    __slots__ = ("depth", "size", "conv_id", "n_convs", "n_children", "leaves", "saved", "ends", "children")

    def __init__(self, depth: int, size: int):
        self.depth, self.size, self.conv_id, self.n_convs = depth, size, None, 0
        self.n_children = self.leaves = self.saved = 0
        self.ends: str | None = None
        self.children: list[tuple] = []


def swept(containers: DataFrame) -> DataFrame:
    """NODES of containers (strings with their head), and `head` in the rows of the containers' own top nodes."""
    ordered = containers.repartition("head").sortWithinPartitions("head", "path")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        sweeper = None
        for head, depth, parent_conv_id, path, conv_id, n_convs, ends in rows:
            if sweeper is None or sweeper.head != head:
                if sweeper is not None:
                    yield from sweeper.leave()
                sweeper = Sweeper(head, depth, parent_conv_id)
            yield from sweeper.add(path, conv_id, n_convs, ends)
        if sweeper is not None:
            yield from sweeper.leave()

    columns = ["head", "depth", "parent_conv_id", "path", "conv_id", "n_convs", "ends_sha256"]
    return _stream(ordered.select(*columns), f"{NODES}, head binary", run)


def nodes(paths: DataFrame, container: int = CONTAINER) -> DataFrame:
    """NODES of the trie of `paths` (conv_id, path)."""
    live = written(
        strings(paths)
        .withColumn("head", F.lit(b"")).withColumn("depth", F.lit(0).cast("long")).withColumn("parent_conv_id", F.lit(None).cast("long")),
        "live",
    )
    remaining, bursts, steps = None, [], FIRST_STEP
    while True:
        sizes = live.groupBy("head").agg(F.sum(_turns() - F.col("depth") + 1).alias("size"))
        large = written(sizes.where(F.col("size") > container).select("head"), "large")
        if not large.limit(1).count():
            remaining = live if remaining is None else remaining.unionByName(live)
            break
        side = small_side(large)
        small = live.join(side, "head", "left_anti")
        remaining = small if remaining is None else remaining.unionByName(small)
        burst = Burst(live.join(side, "head"), steps)
        bursts.append(burst)
        live, steps = burst.live, 2 * steps
    found = written(swept(remaining), "swept")
    for burst in reversed(bursts):
        totals = found.where("head IS NOT NULL").select("head", "n_leaves", "saved_tokens")
        found = found.unionByName(written(burst.finished(totals), "burst"))
    return found.drop("head")
