"""Near-duplicate documents: exact components of the Jaccard similarity of word shingles.

Equal shingle sets are one class, named by a 64-bit digest of the set. Every class has a signature of `HASHES` minhashes of 16 bits, cut into `CHUNKS`
chunks. Two sets whose signatures differ in at most T places agree in some chunk but for one place (pigeonhole, as
T < 2 * CHUNKS), so the keys "chunk with one place left out" enumerate the chunk errors allowed and every such pair
shares a key. T is so far above the expected number of differences that a pair at the threshold exceeds it
with a probability near 1e-4 or below (`differences`). Moreover such a pair agrees that well in at least
CHUNKS - T // 2 chunks; classes that share keys in fewer chunks are out.

Classes that share keys form families. In each family the class with the most shared keys is compared with all
others on full sets. Whoever is not similar to it, an outsider, is compared with the whole family, in blocks of
`BLOCK` outsiders by `BLOCK` members, or fewer where they are long (`BLOCK_SHINGLES`), so that a large family spreads over many
tasks and a block has its size whatever the length of texts. Blocks give back only links that connect something new. Components follow from all links.

Defined cases: null and empty texts have an empty set and are linked with nothing; fewer words than a shingle make one
shingle; rows with a null id are linked with nothing; each of several rows with one id has the component of its own
text; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import per_batch, raw, small_side, written
from cuadre.llm.components import connected

CHUNKS, WIDTH = 13, 5
HASHES = CHUNKS * WIDTH
BLOCK = 128
#: Shingles of a block's outsiders, and of its members, on average; a longer document is alone.
BLOCK_SHINGLES = 200_000

_DRAW = np.random.default_rng(20240601)
_FACTORS = _DRAW.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def differences(percent: int) -> int:
    """T for pairs of at least `percent` similarity: 4.5 deviations above the expected differences, if the
    chunks can guarantee so many."""
    miss = 1 - percent / 100
    return min(2 * CHUNKS - 1, int(HASHES * miss + 4.5 * (HASHES * miss * (1 - miss)) ** 0.5))


def shingles(text: bytes, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes. A..Z count as a..z."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts), seed=len(parts))], dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))
    count = len(hashes) - words + 1
    value = np.full(count, words, dtype=np.uint64)
    for k in range(words):
        value = (value ^ hashes[k : k + count]) * _MIX[0]
        value ^= value >> np.uint64(29)
    return np.unique(value * _MIX[1])


def signature(found: np.ndarray) -> bytes:
    if not len(found):
        return b""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 4_096):  # bounds the memory for long texts
        np.minimum(least, (found[at : at + 4_096, None] * _FACTORS).min(axis=0), out=least)
    return ((least * _MIX[1]) >> np.uint64(48)).astype("<u2").tobytes()


def digests(found: np.ndarray) -> list[int]:
    return np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype="<i8").tolist()


def profiles(docs: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, two 64-bit digests of the set (set_a, set_b) and the signature."""
    read = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(x, words) for x in raw(batch.column(1))]
            halves = np.array([digests(s) for s in sets], dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]), pa.array([signature(s) for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
            )

        return one

    return per_batch(read, "doc_id long, n_shingles long, set_a long, set_b long, signature binary", make)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of each signature (a row of HASHES values): for each chunk and each place left out. The lowest 4
    bits of a key are its chunk."""
    keys = np.empty((len(signatures), HASHES), dtype=np.uint64)
    for chunk in range(CHUNKS):
        for out in range(WIDTH):
            value = np.full(len(signatures), chunk * WIDTH + out + 1, dtype=np.uint64)
            for k in range(WIDTH):
                if k != out:
                    value = (value ^ signatures[:, chunk * WIDTH + k].astype(np.uint64)) * _MIX[0]
                    value ^= value >> np.uint64(31)
            keys[:, chunk * WIDTH + out] = (value * _MIX[2]) & ~np.uint64(15) | np.uint64(chunk)
    return keys.view(np.int64)


def exploded_keys(classes: DataFrame) -> DataFrame:
    """(key, id) for each key of each class."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            given = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u2").reshape(-1, HASHES)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), HASHES)
            return pa.RecordBatch.from_arrays([pa.array(chunk_keys(given).ravel()), pa.array(ids)], names=["key", "id"])

        return one

    return per_batch(classes.select("id", "signature"), "key long, id long", make)


def families(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(id, family) of classes that share keys with others, and (id, shared) with their number of shared keys."""
    keys = exploded_keys(classes)
    # written, so that AQE can split a hot key of the join
    shared = written(keys.groupBy("key").agg(F.count("*").alias("classes")).where("classes > 1").select("key"), "keys")
    members = keys.join(shared, "key")
    chunk = F.expr("shiftleft(1, cast(key & 15 as int))")
    per_class = members.groupBy("id").agg(F.count("*").alias("shared"), F.bit_count(F.bit_or(chunk)).alias("chunks"))
    enough = CHUNKS - differences(percent) // 2
    members = written(members, "members")
    per_class = written(per_class.where(F.col("chunks") >= enough), "shared")
    members = members.join(per_class.select("id"), "id")
    least = written(members.groupBy("key").agg(F.min("id").alias("least")), "least")
    edges = members.join(least, "key").where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b"))
    grouped = connected(edges.distinct())
    return grouped.select(F.col("node").alias("id"), F.col("component").alias("family")), per_class


def class_sets(docs: DataFrame, wanted: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """`wanted` (id, doc, and more) with the set of each class, read again from the text of its document."""
    read = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    texts = read.join(small_side(wanted.select("id", "doc")), "doc")

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, sets = [], []
            for number, content in zip(batch.column("id").to_pylist(), raw(batch.column("text"))):
                found = shingles(content, words)
                # a document id may have rows with other texts
                if digests(found)[0] == number:
                    ids.append(number)
                    sets.append(found.view(np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "members"]
            )

        return one

    sets = per_batch(texts, "id long, members array<long>", make)
    return wanted.drop("doc").join(sets.groupBy("id").agg(F.first("members").alias("members")), "id")


def similar(a, b, percent: int):
    """Whether two set columns are similar enough."""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def links(docs: DataFrame, classes: DataFrame, words: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """Links (a, b) between classes, enough of them that components are those of all similar pairs."""
    grouped, shared = families(classes, percent)
    sized = grouped.join(shared, "id").join(classes.select("id", "doc"), "id")
    sets = written(class_sets(docs, sized, words, doc_id, text), "sets")

    centres = sets.groupBy("family").agg(F.max_by("id", F.struct("shared", -F.col("id"))).alias("centre"))
    centre_sets = centres.join(sets.select(F.col("id").alias("centre"), F.col("members").alias("middle")), "centre")
    compared = sets.join(centre_sets, "family").select(
        "id", "family", "centre", F.size("members").alias("shingles"), similar(F.col("members"), F.col("middle"), percent).alias("near")
    )
    compared = written(compared, "compared")
    star = compared.where("near AND id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"))
    return star.unionByName(outsider_links(sets, compared, percent))


def outsider_links(sets: DataFrame, compared: DataFrame, percent: int) -> DataFrame:
    """Links between those that are not near their family's centre, and the rest of the family, in blocks."""
    # as many blocks as documents and shingles ask for
    load = F.greatest(F.lit(1 / BLOCK), F.col("shingles") / BLOCK_SHINGLES)
    counts = compared.groupBy("family").agg(
        F.ceil(F.sum(load)).alias("rows"), F.ceil(F.sum(F.when(~F.col("near"), load))).alias("columns")
    )
    counts = counts.where("columns > 0")
    placed = sets.join(compared.select("id", "near"), "id").join(counts, "family")
    place = F.xxhash64("id")
    as_member = placed.select(
        "family", F.pmod(place, "rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"),
        F.lit(False).alias("asks"), "near", "id", "members",
    )
    as_outsider = placed.where("NOT near").select(
        "family", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), F.pmod(place, "columns").alias("j"),
        F.lit(True).alias("asks"), "near", "id", "members",
    )

    def compare(block):
        import pandas as pd

        asking, members = block[block.asks], block[~block.asks]
        found = []
        if len(asking) and len(members):
            sizes = members.members.map(len).to_numpy()
            flat = np.concatenate(members.members.to_list())
            owner = np.repeat(np.arange(len(members)), sizes)
            ids, near = members.id.to_numpy(), members.near.to_numpy()
            # all near members are one group already
            group = {i: (-1 if n else i) for i, n in zip(ids.tolist(), near.tolist())}

            def root(x):
                while x in group and group[x] != x and group[x] != -1:
                    x = group[x]
                return -1 if group.get(x, x) == -1 else x

            for number, own in zip(asking.id.to_list(), asking.members.to_list()):
                own = np.sort(own)
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                both = np.bincount(owner[own[at] == flat], minlength=len(members))
                hits = np.flatnonzero((100 * both >= percent * (sizes + len(own) - both)) & (ids != number))
                group.setdefault(number, number)
                for other in ids[hits].tolist():
                    x, y = root(number), root(other)
                    if x != y:
                        found.append((number, other))
                        low, high = min(x, y), max(x, y)
                        group[high] = low
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    blocks = as_member.unionByName(as_outsider)
    return blocks.groupBy("family", "i", "j").applyInPandas(compare, "a long, b long")


def components(
    docs: DataFrame, words: int, percent: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept, for each row of `docs`."""
    found = written(profiles(docs, words, doc_id, text), "profiles")
    real = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc"), F.max("signature").alias("signature"))
    classes = written(classes.withColumnRenamed("set_a", "id"), "classes")
    grouped = connected(links(docs, classes, words, percent, doc_id, text))
    known = classes.select("id", "doc").join(grouped, F.col("id") == F.col("node"), "left")
    known = known.select("id", "doc", F.coalesce("component", "id").alias("group"))
    smallest = known.groupBy("group").agg(F.min("doc").alias("component_id"))
    by_class = known.join(smallest, "group").select("id", "component_id")
    linked = (F.col("set_a") == F.col("id")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    joined = found.join(by_class, linked, "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
