"""Benchmark decontamination by greedy string tiling.

Seeds are Karp-Rabin fingerprints of `LEAST` consecutive words. Documents keep only seeds that pass a bit filter
of fixed size over all benchmark seeds, and the stretches of words under them; the seeds then join with the
benchmark's. A pair of a document and an item that shares enough seeds is tiled: the longest common run of words that
are not yet marked is marked, again and again, found by running Karp-Rabin with falling search lengths, until no
run of LEAST words is left. The document is contaminated when tiles cover at least `COVERAGE` of the item's words,
in whatever order they stand.

Words are runs of letters, digits and non-ASCII characters; A..Z count as a..z. An item of fewer than LEAST words is
searched as a whole.

Defined cases: null and empty texts, and items without a word, match nothing; items are told apart by id and text, and
repeated ones count once; repeated documents each get their matches; an empty benchmark or table gives no matches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import per_batch, raw, row_keys, written
from cuadre.llm.licences import words_of

LEAST = 5
COVERAGE = 0.8
#: The filter has 2 ** FILTER_BITS bits (2 MB), whatever the size of the benchmark.
FILTER_BITS = 24

_BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xC2B2AE3D27D4EB4F)
_PRIME = (1 << 61) - 1


def word_hashes(text: bytes) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def fingerprints(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin fingerprints of all runs of `length` words: polynomials modulo 2 ** 64."""
    count = len(words) - length + 1
    if count < 1:
        return np.empty(0, dtype=np.uint64)
    value = np.zeros(count, dtype=np.uint64)
    for k in range(length):
        value = value * np.uint64(_BASE) + words[k : k + count]
    value = (value + np.uint64(length)) * _SPREAD
    return value ^ (value >> np.uint64(31))


def item_table(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, item (a number for the id and text), words (their hashes), seeds, at how many places of the item each
    seed stands (stands) and seed_length."""
    read = benchmark.select(
        F.col(f"`{item_id}`").cast("long").alias("item_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    read = read.distinct().select("item_id", F.xxhash64("item_id", "text").alias("item"), "text")
    names = ["item_id", "item", "words", "seeds", "stands", "seed_length"]

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [word_hashes(x) for x in raw(batch.column(2))]
            lengths = [min(LEAST, len(w)) for w in words]
            counted = [np.unique(fingerprints(w, n) if n else w, return_counts=True) for w, n in zip(words, lengths)]
            seeds, stands = [x for x, _ in counted], [x for _, x in counted]
            lists = [pa.array([x.view(np.int64) for x in c], pa.list_(pa.int64())) for c in (words, seeds, stands)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *lists, pa.array(lengths, pa.int32())], names=names
            )

        return one

    schema = "item_id long, item long, words array<long>, seeds array<long>, stands array<long>, seed_length int"
    return per_batch(read, schema, make).where("seed_length > 0")


def seed_filter(items: DataFrame) -> tuple[bytes, list[int]]:
    """Bits at the lowest FILTER_BITS of each seed, and the seed lengths there are."""
    bit = F.explode("seeds").alias("seed")
    low = F.col("seed").bitwiseAND((1 << FILTER_BITS) - 1)
    places = items.select(bit).select(F.shiftright(low, 3).alias("byte"), F.expr("1 << cast(seed & 7 as int)").alias("bit"))
    rows = places.groupBy("byte").agg(F.bit_or("bit").alias("bits")).collect()  # at most 2 ** FILTER_BITS / 8 rows
    found = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    if rows:
        found[[r[0] for r in rows]] = [r[1] for r in rows]
    lengths = sorted(r[0] for r in items.select("seed_length").distinct().collect())
    return found.tobytes(), lengths


def document_seeds(texts: DataFrame, items: DataFrame) -> DataFrame:
    """`texts` (row_a, row_b, text, doc_id) -> row_a, row_b, doc_id, seeds, and stretches: lists of word hashes under the seeds with the
    place of their first word. Only rows with a seed that passes the filter."""
    shared = texts.sparkSession.sparkContext.broadcast(seed_filter(items))
    names = ["row_a", "row_b", "doc_id", "seeds", "places", "stretches"]
    texts = texts.select("row_a", "row_b", F.col("doc_id").cast("long").alias("doc_id"), "text")

    def make():
        bits, lengths = np.frombuffer(shared.value[0], dtype=np.uint8), shared.value[1]

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, seeds, places, stretches = [], [], [], []
            for number, content in enumerate(raw(batch.column(3))):
                words = word_hashes(content)
                under = np.zeros(len(words) + 1, dtype=np.int32)
                hits = []
                for length in lengths:
                    found = fingerprints(words, length)
                    low = found & np.uint64((1 << FILTER_BITS) - 1)
                    passed = (bits[(low >> np.uint64(3)).astype(np.int64)] >> (found & np.uint64(7)).astype(np.uint8)) & 1
                    at = np.flatnonzero(passed)
                    hits.append(found[at])
                    np.add.at(under, at, 1)
                    np.add.at(under, at + length, -1)
                hits = np.unique(np.concatenate(hits)) if hits else []
                if not len(hits):
                    continue
                inside = np.concatenate(([0], (np.cumsum(under)[:-1] > 0).astype(np.int8), [0]))
                begins, ends = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
                rows.append(number)
                seeds.append(hits.view(np.int64))
                places.append(begins)
                stretches.append([words[a:b].view(np.int64) for a, b in zip(begins, ends)])
            ids = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(3)]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (seeds, places)]
            return pa.RecordBatch.from_arrays(
                [*ids, *lists, pa.array(stretches, pa.list_(pa.list_(pa.int64())))], names=names
            )

        return one

    schema = "row_a long, row_b long, doc_id long, seeds array<long>, places array<long>, stretches array<array<long>>"
    return per_batch(texts, schema, make)


class Words:
    """A list of word hashes (None ends a stretch), which of them are marked, and Karp-Rabin hashes of its prefixes."""

    def __init__(self, words: list[int | None]):
        self.words, self.marked = words, [word is None for word in words]
        self.prefix, self.power = [0], [1]
        for word in words:
            self.prefix.append((self.prefix[-1] * _BASE + (word or 0)) % _PRIME)
            self.power.append(self.power[-1] * _BASE % _PRIME)

    def hash(self, begin: int, size: int) -> int:
        return (self.prefix[begin + size] - self.prefix[begin] * self.power[size]) % _PRIME

    def free(self) -> list[int]:
        """Unmarked words from each place on."""
        run, found = 0, [0] * len(self.words)
        for i in range(len(self.words) - 1, -1, -1):
            run = 0 if self.marked[i] else run + 1
            found[i] = run
        return found

    def before(self, i: int) -> int | None:
        """The word before a place, where a match could begin earlier with it."""
        return None if not i or self.marked[i - 1] else self.words[i - 1]

    def mark(self, begin: int, size: int) -> None:
        self.marked[begin : begin + size] = [True] * size


def agreed(text: Words, i: int, item: Words, j: int, known: int, most: int) -> int:
    """Words from two places on that are equal, of which `known` are and at most `most` count: by bisection over hashes."""
    while known < most:
        middle = (known + most + 1) // 2
        if text.hash(i, middle) == item.hash(j, middle):
            known = middle
        else:
            most = middle - 1
    return known


def left_maximal(text: Words, item: Words, length: int) -> list[tuple[int, int, int]]:
    """(-words, place in the text, place in the item) of matches of at least `length` unmarked words that do not begin earlier."""
    in_text, in_item, found = text.free(), item.free(), []
    # run -> word before it -> places in the item: pairs that go on to the left are never looked at, so that a text
    # which repeats itself costs what its length is
    runs: dict[int, dict[int | None, list[int]]] = {}
    for j, free in enumerate(in_item):
        if free >= length:
            runs.setdefault(item.hash(j, length), {}).setdefault(item.before(j), []).append(j)
    for i, free in enumerate(in_text) if runs else ():
        if free < length or (places := runs.get(text.hash(i, length))) is None:
            continue
        earlier = text.before(i)
        for word, some in places.items():
            if word is None or word != earlier:
                found += [(-agreed(text, i, item, j, length, min(free, in_item[j])), i, j) for j in some]
    return found


def greedy_tiles(text: list[int | None], item: list[int], least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in the text, place in the item, words), longest first; None ends a stretch of the text."""
    of_text, of_item, tiles = Words(text), Words(item), []
    length = max(least, len(item))
    while True:
        found = left_maximal(of_text, of_item, length)
        if found:
            taken, longest = len(tiles), -min(found)[0]
            # matches shorter than the longest may have been cut by it: they are searched again
            for size, i, j in sorted(x for x in found if x[0] == -longest):
                ends = (of_text.marked[i], of_text.marked[i + longest - 1], of_item.marked[j], of_item.marked[j + longest - 1])
                # a stretch that meets another of its length holds one of its ends; hashes propose, words decide
                if not any(ends) and text[i : i + longest] == item[j : j + longest]:
                    of_text.mark(i, longest)
                    of_item.mark(j, longest)
                    tiles.append((i, j, longest))
            if len(tiles) > taken:
                continue
        if length == least:
            return tiles
        length = max(least, length // 2)


def matches(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """doc_id, row_a, row_b, item_id, n_words of the item, covered words, coverage and tiles (doc_word, item_word,
    n_words) of each document and item with at least `coverage`. row_a and row_b: hashes of id and text."""
    items = written(item_table(benchmark), "items")
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(*row_keys(doc_id, text), F.col(f"`{doc_id}`").alias("doc_id"), content.alias("text"))
    # repeated documents are tiled once, and get their matches as often as they stand
    columns = [F.first(c).alias(c) for c in ("doc_id", "seeds", "places", "stretches")]
    found = document_seeds(rows, items).groupBy("row_a", "row_b").agg(*columns, F.count("*").alias("copies"))
    found = written(found, "seeds")
    each = F.inline(F.arrays_zip("seeds", "stands")).alias("seed", "stands")
    of_item = items.select("item", F.size("words").alias("n_words"), "seed_length", each)
    of_doc = found.select("row_a", "row_b", F.explode("seeds").alias("seed"))
    pairs = of_doc.join(of_item, "seed").groupBy("row_a", "row_b", "item")
    pairs = pairs.agg(F.sum("stands").alias("places"), F.first("n_words").alias("n_words"), F.first("seed_length").alias("k"))
    # a tile's words are words of shared seeds, and each place of one in the item has k of them
    pairs = pairs.where(F.col("places") * F.col("k") >= coverage * F.col("n_words")).select("row_a", "row_b", "item")
    given = pairs.join(found.drop("seeds"), ["row_a", "row_b"]).join(items.drop("seeds", "stands"), "item")
    given = given.select("row_a", "row_b", "doc_id", "item_id", "copies", "places", "stretches", "words", "seed_length")
    tile = pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())])
    names = ["row_a", "row_b", "doc_id", "item_id", "copies", "n_words", "covered", "tiles"]

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, covered, tiles = [], [], []
            for row in batch.select(["places", "stretches", "words", "seed_length"]).to_pylist():
                joined, at = [], []
                for place, stretch in zip(row["places"], row["stretches"]):
                    joined += [*stretch, None]
                    at += range(place, place + len(stretch) + 1)
                found = greedy_tiles(joined, row["words"], row["seed_length"])
                sizes.append(len(row["words"]))
                covered.append(sum(n for _, _, n in found))
                tiles.append([{"doc_word": at[i], "item_word": j, "n_words": n} for i, j, n in found])
            return pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(5)), pa.array(sizes, pa.int64()), pa.array(covered, pa.int64()),
                 pa.array(tiles, pa.list_(tile))],
                names=names,
            )

        return one

    schema = (
        "row_a long, row_b long, doc_id long, item_id long, copies long, n_words long, covered long,"
        " tiles array<struct<doc_word:long,item_word:long,n_words:long>>"
    )
    tiled = per_batch(given, schema, make).withColumn("coverage", F.col("covered") / F.col("n_words"))
    tiled = tiled.where(F.col("coverage") >= coverage)
    return tiled.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")
