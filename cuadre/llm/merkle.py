"""A Merkle manifest of a data set, with a witness for each document.

H is the lowercase hex SHA-256 of its inputs' concatenation, digests as hex text. A document's leaf is H of its columns,
each `-` if null, else its UTF-8 length, `:` and its value. The leaves of a source, by document id, are a tree: every
`ARITY` consecutive nodes of a level become their H (the last run may be shorter, down to one node) until one is left,
the source's subroot; the subroots, by source, are a tree in the same way, whose top is the root.

Witnesses grow as leaves are appended (`Appender`): a complete run becomes a node of the level above, and each of its
subtrees' leaves gets its siblings' digests behind what it has, so that a leaf holds the witness of the open subtree it
is in. Blocks of `BLOCK` leaves whose places are aligned are appended by different tasks; a block's top is a leaf of the next
round, over blocks of blocks, and the witness it gets there continues the witnesses of the block's leaves. Rounds are few:
each has 1 / BLOCK of the nodes of the one before.

Places come from range partitions (`numbering`), so one source may hold any share of the rows.

Defined cases: a null source is the first branch, an empty one the next; null ids come first in their source, rows of
equal id by leaf; repeated rows are leaves of their own, in any order, for they are equal; a null id is hashed as `-` and
its row is not tampered with; texts of any length are hashed whole; an empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import kinds, new_folder, per_batch, small_side, written
from cuadre.operators.numbering import numbered

ARITY = 3
LEVELS = 7
BLOCK = ARITY**LEVELS
DIGEST = 32
#: The columns that a leaf covers, in their order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Witnesses of sources are broadcast up to so many sources (about 1 kB each).
BROADCAST_SOURCES = 20_000


def joined_digest(digests: bytes) -> bytes:
    """H of digests, given one after the other."""
    return hashlib.sha256(digests.hex().encode()).digest()


def levels_of(size: int) -> int:
    """Levels above the leaves of a tree of so many leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


class Appender:
    """Appends the leaves of a block. `open` has the nodes of each level whose run is not complete, each with the leaves
    below it; `witnesses` the siblings that each leaf has so far."""

    def __init__(self):
        self.open: list[list[tuple[bytes, int, int]]] = [[]]
        self.witnesses: list[bytes] = []

    def append(self, leaf: bytes) -> None:
        place = len(self.witnesses)
        self.witnesses.append(b"")
        self._place(0, (leaf, place, place + 1))

    def close(self, levels: int) -> bytes:
        """Completes what is open below `levels`; the top."""
        for level in range(levels):
            if self.open[level]:
                self._place(level + 1, self._complete(level))
        return self.open[levels][0][0]

    def _place(self, level: int, node: tuple[bytes, int, int]) -> None:
        while True:
            if level == len(self.open):
                self.open.append([])
            self.open[level].append(node)
            if len(self.open[level]) < ARITY:
                return
            node, level = self._complete(level), level + 1

    def _complete(self, level: int) -> tuple[bytes, int, int]:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _, _ in run]
        for i, (_, first, end) in enumerate(run):
            siblings = b"".join(digests[:i] + digests[i + 1 :])
            for leaf in range(first, end):
                self.witnesses[leaf] += siblings
        return joined_digest(b"".join(digests)), run[0][1], run[-1][2]


def fold(digest: bytes, position: int, size: int, witness: bytes, at: int = 0) -> tuple[bytes, int]:
    """The top that a leaf and its witness, read from `at` on, lead to in a tree of `size` leaves; where reading ended."""
    while size > 1:
        place = position % ARITY
        end = at + DIGEST * (min(ARITY, size - position + place) - 1)
        cut = at + DIGEST * place
        digest = joined_digest(witness[at:cut] + digest + witness[cut:end])
        position, size, at = position // ARITY, -(-size // ARITY), end
    return digest, at


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The leaf of a row as 32 bytes, with some columns changed."""
    fields = [_field(changed.get(c, F.col(c))) for c in LEAF_COLUMNS]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def appended(nodes: DataFrame) -> DataFrame:
    """`nodes` (tree, position, size, digest, …) with the `witness` of each within its block, and the block's `top`."""
    columns = nodes.columns
    schema = kinds(nodes, columns, "witness binary, top binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        key = None

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            appender = Appender()
            for digest in rows.column("digest").to_pylist():
                appender.append(digest)
            top = appender.close(min(LEVELS, levels_of(rows.column("size")[0].as_py())))
            added = [pa.array(appender.witnesses, pa.binary()), pa.array([top] * rows.num_rows, pa.binary())]
            return pa.RecordBatch.from_arrays([*rows.columns, *added], names=[*columns, "witness", "top"])

        for batch in batches:
            keys = list(zip(batch.column("tree").to_pylist(), (x // BLOCK for x in batch.column("position").to_pylist())))
            start = 0
            for i in [*(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]:
                if waiting and key != keys[start]:
                    yield block()
                    waiting = []
                key = keys[start]
                waiting.append(batch.slice(start, i - start))
                start = i
        if waiting:
            yield block()

    dealt = nodes.withColumn("_block", F.expr(f"position div {BLOCK}")).repartition("tree", "_block")
    return dealt.sortWithinPartitions("tree", "_block", "position").select(*columns).mapInArrow(run, schema)


def climb(nodes: DataFrame) -> DataFrame:
    """`nodes` (tree, position, size, digest, …; positions from 0, `size` the tree's leaves) with the whole `witness` of
    each and the `root` of its tree."""
    parts = written(appended(nodes), "witnesses")
    most = parts.agg(F.max("size")).first()[0] or 0
    if most <= BLOCK:
        return parts.withColumnRenamed("top", "root")
    tops = parts.where(f"position % {BLOCK} = 0").select(
        "tree", F.expr(f"position div {BLOCK}").alias("position"),
        F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"), F.col("top").alias("digest"),
    )
    above = climb(tops).select(
        F.col("tree").alias("_tree"), F.col("position").alias("_block"), F.col("witness").alias("_more"), "root"
    )
    same = (F.col("tree") == F.col("_tree")) & (F.expr(f"position div {BLOCK}") == F.col("_block"))
    whole = F.concat("witness", "_more").alias("witness")
    return parts.drop("top").join(above, same).select(*nodes.columns, whole, "root")


def witnesses(leaves: DataFrame) -> DataFrame:
    """`leaves` (doc_id, source, leaf, …) with position and size in the source's tree, its place and the number of sources
    (source_position, sources), witness (siblings up to the root, one after the other), subroot and root."""
    spark = leaves.sparkSession
    # null before the empty source, and all as text that orders bytewise
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    branched = written(leaves.withColumn("tree", tree).withColumnRenamed("leaf", "digest"), "leaves")
    placed = numbered(
        branched, [F.col("doc_id").asc_nulls_first(), "digest"], new_folder(spark, "placed"), "tree", total="size"
    )
    inner = climb(placed).withColumnRenamed("root", "subroot")
    branches = written(
        inner.where("position = 0").select(F.col("tree").alias("branch"), F.lit("").alias("tree"), F.col("subroot").alias("digest")),
        "subroots",
    )
    outer = climb(numbered(branches, ["branch"], new_folder(spark, "branches"), total="size")).select(
        F.col("branch").alias("tree"), F.col("position").alias("source_position"), F.col("size").alias("sources"),
        F.col("witness").alias("_more"), "root",
    )
    found = inner.join(small_side(outer, BROADCAST_SOURCES), "tree").withColumnRenamed("digest", "leaf")
    names = ["position", "size", "source_position", "sources", "subroot", "root"]
    return found.select(*leaves.columns, *names, F.concat("witness", "_more").alias("witness"))


def manifest(docs: DataFrame) -> DataFrame:
    """The leaf of each document with its witness (see `witnesses`); `tampered` is its leaf without the line breaks of
    the text where 2 divides the crc32 of the id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.translate(F.col("text").cast("string"), "\n", "")
    tampered = F.when(chosen & F.col("text").contains("\n"), leaf(text=cut))
    return witnesses(docs.select("doc_id", "source", leaf().alias("leaf"), tampered.alias("tampered")))


def verified(witnessed: DataFrame) -> DataFrame:
    """`witnessed` with the hex digests proof_sha256 (of the witness) and folded_root (what `tampered`, else the leaf, leads
    to), and whether that is the root."""
    carried = [c for c in witnessed.columns if c not in ("proof_sha256", "folded_root", "verified")]

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            names = ("leaf", "tampered", "position", "size", "source_position", "sources", "witness", "root")
            proofs, folded, right = [], [], []
            for own, other, place, size, at, sources, witness, root in zip(*(batch.column(n).to_pylist() for n in names)):
                proofs.append(joined_digest(witness).hex())
                top, read = fold(other or own, place, size, witness)
                top, read = fold(top, at, sources, witness, read)
                folded.append(top.hex())
                right.append(top == root and read == len(witness))
            added = [pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array(right, pa.bool_())]
            return pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*carried, "proof_sha256", "folded_root", "verified"])

        return one

    given = witnessed.select(*carried)
    return per_batch(given, kinds(given, carried, "proof_sha256 string, folded_root string, verified boolean"), make)
