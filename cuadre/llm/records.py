"""Token ids as length-delimited binary records with an offset index.

A record is its payload's length (64 bits), the masked checksum of that length (32 bits), the payload, and the payload's
masked checksum; all numbers are little-endian. The checksum is CRC-32C, masked by a rotation and a constant, so that
a checksum over data that hold checksums is no trivial one. A payload is a flag (32 bits: the bytes of an id, and
`NO_KEY` more if the document has no id), the document id (64 bits) and the token ids, each in 2 bytes if the whole
vocabulary fits in them, else 4. Beside each file of records lies its index: of each record the byte at which it begins and the
ids that stand before it in the file (64 bits each), and a last pair for the end. With the index a record is read
without those before it: `read` cuts files into pieces for parallel tasks, `shuffled` reads single records in a random order.

`write` deals documents over range partitions by id, one file a task, so that files in the order of their numbers hold the
documents in ascending order. A file gets its name when it is whole; a repeated task replaces it with the same content.
Checksums are computed for a batch of records at a time in numpy: records are cut into lanes of `LANE` bytes, whose checksums
are shifted by what follows them and combined.

Defined cases: a null text is an empty one, whose record holds the end id alone; null ids come first; rows of equal id
stand by a hash of their text, repeated rows beside one another; a text of any length is one record; an empty table
has no files and no rows.
"""

from __future__ import annotations

import gc
import json
import os
import string
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuadre.llm.bpe import byte_letters
from cuadre.llm.common import new_folder, written

# CRC-32C and its mask.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
LANE = 64
NO_KEY = 256
#: flag and document id
HEAD = "<Iq"
HEAD_BYTES = struct.calcsize(HEAD)
#: Bytes of a file that a task reads at a time, and records that are checked at a time.
PIECE_BYTES = 16 << 20
CHECKED_RECORDS = 1_000
#: Texts that are encoded at a time: pieces that they share are encoded once.
ENCODED_ROWS = 4_000
#: Words whose ids a task keeps; the store is emptied when it is full.
KNOWN_WORDS = 400_000
#: Letters of ASCII and Latin-1, which normalizing leaves composed; part of a pattern.
SIMPLE = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Marks that never share a word with a letter before them; an apostrophe may.
ASCII_MARKS = string.punctuation.replace("'", "")


# ---- checksums ---------------------------------------------------------------


def _byte_steps(state: np.ndarray, steps: int) -> np.ndarray:
    """States after so many zero bytes."""
    for _ in range(8 * steps):
        state = (state >> np.uint32(1)) ^ np.where(state & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return state


class Shift:
    """A linear map of checksum states, kept as a table for each byte of a state."""

    def __init__(self, of_bits: np.ndarray):
        self.of_bits = of_bits
        values = np.arange(256, dtype=np.uint32)
        self.tables = []
        for byte in range(4):
            table = np.zeros(256, np.uint32)
            for bit in range(8):
                table ^= np.where(values >> np.uint32(bit) & np.uint32(1), of_bits[8 * byte + bit], np.uint32(0))
            self.tables.append(table)

    def __call__(self, state: np.ndarray) -> np.ndarray:
        parts = [table[(state >> np.uint32(8 * k)) & np.uint32(255)] for k, table in enumerate(self.tables)]
        return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]

    def twice(self) -> Shift:
        return Shift(self(self.of_bits))


class Checksums:
    """Masked CRC-32C of many byte strings at once."""

    def __init__(self):
        self.pairs = _byte_steps(np.arange(1 << 16, dtype=np.uint32), 2)
        self.shifts = [Shift(_byte_steps(np.uint32(1) << np.arange(32, dtype=np.uint32), LANE))]

    def masked(self, strings: list[bytes]) -> np.ndarray:
        """Of strings of 4 bytes or more."""
        if not strings:
            return np.zeros(0, np.uint32)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        lanes = -(-sizes // LANE)
        # zeros before a string do not change its state; the initial state is 1 in the first 32 bits
        zeros = bytes(LANE)
        flat = bytearray(b"".join(x for s, n in zip(strings, (-sizes % LANE).tolist()) for x in (zeros[:n], s)))
        data = np.frombuffer(flat, np.uint8)
        begins = np.cumsum(lanes * LANE) - sizes
        data[begins[:, None] + np.arange(4)] ^= np.uint8(255)
        words = np.ascontiguousarray(data.view("<u2").reshape(-1, LANE // 2).T)
        state = np.zeros(words.shape[1], np.uint32)
        for word in words:
            state = self.pairs[(state & np.uint32(0xFFFF)) ^ word] ^ (state >> np.uint32(16))
        ends = np.cumsum(lanes)
        following = np.repeat(ends, lanes) - np.arange(1, len(state) + 1)
        most, bit = int(following.max()), 0
        while most >> bit:
            if bit == len(self.shifts):
                self.shifts.append(self.shifts[-1].twice())
            moved = np.flatnonzero(following >> bit & 1)
            state[moved] = self.shifts[bit](state[moved])
            bit += 1
        crc = ~np.bitwise_xor.reduceat(state, ends - lanes)
        return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


# ---- encoding ----------------------------------------------------------------


def gathered(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `values` that begin at `begins`, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begins - (ends - sizes), sizes) + np.arange(total)]


def tails(texts: pa.StringArray, heads: pa.StringArray) -> pa.StringArray:
    """Of each text what follows its head."""
    begins = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts)]
    kept = pc.binary_length(heads).to_numpy()
    sizes = pc.binary_length(texts).to_numpy() - kept
    content = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    found = gathered(content, begins + kept, sizes)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(found.tobytes()))


class Encoder:
    """Ids of texts by the tokenizers library.

    Where the vocabulary drops white space, no token reaches over it: the distinct pieces between ASCII white space of a
    batch are then encoded by themselves, and their ids gathered. A piece of `SIMPLE` letters is a single word of the
    model once it is in lower case, whatever marks follow it; words that the task has met before are not encoded again.
    """

    def __init__(self, vocabulary: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks already take all cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # words are kept here
        self.kind = np.dtype(f"<u{id_bytes(vocabulary)}")
        self.end_id = end_id
        self.pieces = drops_white_space(vocabulary)
        self.letters = dict(enumerate(byte_letters()))
        self.words: dict[str, list[int]] = {}

    def of_text(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def of_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words of simple letters in lower case."""
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        known, tokenize, found = self.words, self.model.tokenize, []
        gc.disable()  # many small lists come into being, none of them in a cycle
        try:
            for word in words:
                if (ids := known.get(word)) is None:
                    letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                    ids = known[word] = [token.id for token in tokenize(letters)]
                found.append(ids)
        finally:
            gc.enable()
        return found

    def encode(self, texts: pa.StringArray) -> tuple[bytes, np.ndarray]:
        """The ids of all texts, each followed by the end id, and the number of ids of each text."""
        if not self.pieces:
            lists = [[*self.of_text(text), self.end_id] for text in texts.to_pylist()]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            return np.fromiter((i for x in lists for i in x), self.kind, int(sizes.sum())).tobytes(), sizes
        split = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(split).to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        units, first, second = self.units(coded.dictionary)
        piece = coded.indices.to_numpy()
        # each piece has two units, a word and its marks; a text ends with the unit of the end id
        text = np.repeat(np.arange(len(counts)), counts)
        at = 2 * np.arange(len(piece)) + text
        ends = 2 * np.cumsum(counts) + np.arange(len(counts))
        unit = np.zeros(2 * len(piece) + len(counts), np.int64)
        unit[at], unit[at + 1] = first[piece], second[piece]
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        flat = np.fromiter((i for x in units for i in x), self.kind, int(sizes.sum()))
        of_unit = sizes[unit]
        ids = gathered(flat, (np.cumsum(sizes) - sizes)[unit], of_unit)
        until = np.cumsum(of_unit)[ends]
        return ids.tobytes(), np.diff(until, prepend=0)

    def units(self, pieces: pa.StringArray) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
        """Lists of ids, the end id's first, and for each piece the two lists that make up its ids."""
        heads = pc.utf8_rtrim(pieces, characters=ASCII_MARKS)
        simple = pc.match_substring_regex(heads, f"^[{SIMPLE}]+$")
        words = pc.utf8_lower(heads.filter(simple)).dictionary_encode()
        marks = tails(pieces, heads).filter(simple).dictionary_encode()
        others = pieces.filter(pc.invert(simple))
        lists = [[self.end_id], *self.of_words(words.dictionary.to_pylist())]
        marks_from, others_from = len(lists), len(lists) + len(marks.dictionary)
        lists += [self.of_text(x) for part in (marks.dictionary, others) for x in part.to_pylist()]
        nothing = len(lists)
        lists.append([])
        is_simple = simple.to_numpy(zero_copy_only=False)
        first, second = np.empty(len(pieces), np.int64), np.full(len(pieces), nothing)
        first[is_simple] = 1 + words.indices.to_numpy()
        second[is_simple] = marks_from + marks.indices.to_numpy()
        first[~is_simple] = others_from + np.arange(len(others))
        return lists, first, second


def id_bytes(vocabulary: str) -> int:
    data = json.loads(vocabulary)
    most = max([*data["model"]["vocab"].values(), *(x["id"] for x in data["added_tokens"])])
    return 2 if most < 1 << 16 else 4


def drops_white_space(vocabulary: str) -> bool:
    """Whether each white space is one blank after normalizing, and only what a pattern without blanks matches is kept."""
    data = json.loads(vocabulary)
    before = data["pre_tokenizer"] or {}
    splits = [x for x in before.get("pretokenizers", [before]) if x.get("type") == "Split"]
    dropped = any(x["behavior"] == "Removed" and x["invert"] and r"[^\s" in x["pattern"].get("Regex", "") for x in splits)
    blanks = any(x.get("pattern") == {"Regex": r"\s+"} for x in (data["normalizer"] or {}).get("normalizers", []))
    return dropped and blanks and not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in data["added_tokens"])


# ---- files -------------------------------------------------------------------


def framed_parts(payloads: list[bytes], checks: Checksums) -> Iterator[tuple[bytes, list[int]]]:
    """The records of `payloads`, some at a time, and the bytes of each."""
    for start in range(0, len(payloads), CHECKED_RECORDS):
        some = payloads[start : start + CHECKED_RECORDS]
        lengths = [struct.pack("<Q", len(p)) for p in some]
        of_lengths, of_payloads = (checks.masked(x).astype("<u4").tobytes() for x in (lengths, some))
        parts = (
            x for k, (n, p) in enumerate(zip(lengths, some)) for x in (n, of_lengths[4 * k : 4 * k + 4], p, of_payloads[4 * k : 4 * k + 4])
        )
        yield b"".join(parts), [16 + len(p) for p in some]


def write(docs: DataFrame, vocabulary: str, end_id: int, folder: str) -> DataFrame:
    """Writes `docs` (doc_id, text) as records with an index under `folder`, a new one that all executors share.

    Returns a row for each file: path, number (files in its order hold the documents in order), records, tokens and
    bytes. `vocabulary` is the content of a tokenizers file.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = read.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, top = pyarrow.fs.FileSystem.from_uri(folder)
        path = f"{top}/ids-{task.partitionId():06d}.records"
        own = f"{path}.{task.taskAttemptId()}"
        encoder = checks = out = None
        index, at, tokens = [], 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, ENCODED_ROWS):
                if out is None:
                    encoder, checks = Encoder(shared.value, end_id), Checksums()
                    width = encoder.kind.itemsize
                    store.create_dir(top)
                    out = store.open_output_stream(own, compression=None)
                some = batch.slice(start, ENCODED_ROWS)
                ids, counts = encoder.encode(some.column(1))
                heads = [struct.pack(HEAD, width + (NO_KEY if key is None else 0), key or 0) for key in some.column(0).to_pylist()]
                cuts = [0, *(width * np.cumsum(counts)).tolist()]
                payloads = [head + ids[a:b] for head, a, b in zip(heads, cuts, cuts[1:])]
                for framed, sizes in framed_parts(payloads, checks):
                    out.write(framed)
                    for size in sizes:
                        index.append((at, tokens))
                        at += size
                        tokens += (size - 16 - HEAD_BYTES) // width
        if out is not None:
            out.close()
            pairs = np.array([*index, (at, tokens)], "<u8")
            with store.open_output_stream(f"{own}.index", compression=None) as beside:
                beside.write(pairs.tobytes())
            store.move(f"{own}.index", f"{path}.index")
            store.move(own, path)
            row = {"path": [path], "number": [task.partitionId()], "records": [len(index)], "tokens": [tokens], "bytes": [at]}
            yield pa.RecordBatch.from_pydict(row, schema=FILE)

    return written(ordered.mapInArrow(run, FILES), "record_files")


FILES = "path string, number int, records long, tokens long, bytes long"
FILE = pa.schema(
    [("path", pa.string()), ("number", pa.int32()), ("records", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())]
)
RECORD = "doc_id long, start long, ids binary"
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


class DamagedRecord(ValueError):
    """A record does not have its checksum, or not the length that the index gives."""


def parsed(records: list[bytes], checks: Checksums, path: str) -> list[tuple[int | None, bytes]]:
    """(document id, token ids as 32-bit integers) of whole records, after a check of their lengths and checksums."""
    lengths, payloads = [r[:8] for r in records], [r[12:-4] for r in records]
    kept = b"".join(x for r in records for x in (r[8:12], r[-4:]))
    found = np.stack([checks.masked(lengths), checks.masked(payloads)], axis=1).astype("<u4").tobytes()
    if kept != found or any(int.from_bytes(n, "little") != len(p) for n, p in zip(lengths, payloads)):
        raise DamagedRecord(f"a record of {path} is damaged")
    rows = []
    for payload in payloads:
        flag, key = struct.unpack_from(HEAD, payload)
        ids = np.frombuffer(payload, f"<u{flag % NO_KEY}", offset=HEAD_BYTES)
        rows.append((None if flag >= NO_KEY else key, ids.astype("<u4").tobytes()))
    return rows


def opened(spark) -> Callable[[str], tuple]:
    """The store and plain path of a file whose path `write` returned."""
    top = new_folder(spark, "x").split("://")
    scheme = f"{top[0]}://" if len(top) > 1 else ""
    return lambda path: pyarrow.fs.FileSystem.from_uri(f"{scheme}{path}" if scheme else path)


def _index(store, plain: str) -> np.ndarray:
    with store.open_input_stream(f"{plain}.index", compression=None) as stream:
        return np.frombuffer(stream.read(), "<u8").reshape(-1, 2).astype(np.int64)


def _rows(found: list[tuple[int | None, bytes]], starts: list[int]) -> pa.RecordBatch:
    keys, ids = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], schema=READ)


def placed(files: DataFrame) -> DataFrame:
    """`files` with `before`, the ids in all files before each."""
    so_far = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.withColumn("before", F.coalesce(F.sum("tokens").over(so_far), F.lit(0)))


def read(files: DataFrame) -> DataFrame:
    """The records of `files`: doc_id, start (ids of all records before it) and ids (little-endian 32-bit integers).

    A task reads a piece of a file, the records that begin in it, with the help of the index.
    """
    open_at = opened(files.sparkSession)
    last = F.greatest(F.expr(f"(bytes - 1) div {PIECE_BYTES}"), F.lit(0))
    pieces = placed(files).select("path", "before", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    pieces = written(pieces, "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checks = Checksums()
        for batch in batches:
            for path, before, piece in zip(*(batch.column(n).to_pylist() for n in ("path", "before", "piece"))):
                store, plain = open_at(path)
                index = _index(store, plain)
                first, end = np.searchsorted(index[:-1, 0], [piece * PIECE_BYTES, (piece + 1) * PIECE_BYTES]).tolist()
                with store.open_input_file(plain) as file:
                    for start in range(first, end, CHECKED_RECORDS):
                        stop = min(start + CHECKED_RECORDS, end)
                        at = index[start : stop + 1, 0].tolist()
                        content = file.read_at(at[-1] - at[0], at[0])
                        records = [content[a - at[0] : b - at[0]] for a, b in zip(at, at[1:])]
                        yield _rows(parsed(records, checks, plain), (before + index[start:stop, 1]).tolist())

    count = max(1, pieces.count())
    return pieces.repartitionByRange(count, "path", "piece").mapInArrow(run, RECORD)


def shuffled(files: DataFrame, seed: int) -> DataFrame:
    """The records of `files` as `read` gives them, in a random order that `seed` fixes, over all files.

    Each task gets a range of random keys and reads its records one by one by their offsets.
    """
    open_at = opened(files.sparkSession)
    kind = pa.schema([("path", pa.string()), ("at", pa.int64()), ("end", pa.int64()), ("start", pa.int64())])

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                index = _index(*open_at(path))
                for k in range(0, len(index) - 1, 100_000):
                    some = index[k : k + 100_001]
                    columns = [pa.array([path] * (len(some) - 1)), some[:-1, 0], some[1:, 0], before + some[:-1, 1]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checks = Checksums()
        for batch in batches:
            for k in range(0, batch.num_rows, CHECKED_RECORDS):
                wanted = batch.slice(k, CHECKED_RECORDS).to_pylist()
                content: dict[int, bytes] = {}
                for path in {w["path"] for w in wanted}:
                    store, plain = open_at(path)
                    with store.open_input_file(plain) as file:
                        for i, w in enumerate(wanted):
                            if w["path"] == path:
                                content[i] = file.read_at(w["end"] - w["at"], w["at"])
                found = parsed([content[i] for i in range(len(wanted))], checks, "the files")
                yield _rows(found, [w["start"] for w in wanted])

    rows = written(placed(files).select("path", "before").repartition("path").mapInArrow(offsets, "path string, at long, end long, start long"), "offsets")
    key = F.xxhash64(F.lit(seed), "path", "at")
    return rows.repartitionByRange(key, "path", "at").sortWithinPartitions(key, "path", "at").mapInArrow(run, RECORD)
