"""Byte-level BPE: encoding by batched merge rounds in numpy, and decoding.

The words of a batch are taken apart once (`words_of`), and those that the task has not met
are merged together: their symbols lie in one flat array. In each round every neighbouring pair
gets its rank by binary search over the sorted pair keys of the vocabulary, the lowest rank of
each word is found by a segmented minimum, and all its occurrences merge at once, from left to
right where they overlap. After a round only the pairs beside a merge are searched again.

Defined cases: a null or empty text has no ids; strings of added tokens become their id; texts
and words of any length are encoded whole; a repeated row is encoded like any other.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import kinds, per_batch

# Fixed value: the pattern that separates words before the merges.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

NO_RANK = np.iinfo(np.int64).max
#: Words whose ids a task keeps; the store is emptied when it is full.
KNOWN_WORDS = 400_000
#: Ids whose bytes are gathered at a time, which bounds the memory for long texts.
GATHERED_IDS = 500_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file: printable Latin-1
    bytes stand for themselves, the others for the letters from U+0100 on, in order."""
    itself = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    letters, following = [], 0x100
    for byte in range(256):
        if byte in itself:
            letters.append(chr(byte))
        else:
            letters.append(chr(following))
            following += 1
    return letters


class Vocabulary:
    """Token ids, merge ranks and added tokens of a byte-level BPE vocabulary file (JSON)."""

    def __init__(self, content: str):
        data = json.loads(content)
        model, before = data["model"], data["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or data["normalizer"]:
            raise ValueError("only byte-level BPE without a normalizer or a prefix space is supported")
        letters = byte_letters()
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        ids = model["vocab"]
        self.added = {x["content"]: x["id"] for x in data["added_tokens"]}
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in data["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.token_bytes = [b""] * (1 + max([*ids.values(), *self.added.values()]))
        for token, number in ids.items():
            self.token_bytes[number] = bytes(byte_of[letter] for letter in token)
        for token, number in self.added.items():
            self.token_bytes[number] = token.encode()
        self.byte_ids = np.array([ids[letter] for letter in letters], dtype=np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        right = np.array([ids[b] for _, b in merges], dtype=np.int64)
        keys, merged = left << 32 | right, np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks, self.merged_ids = keys[order], order.astype(np.int64), merged[np.argsort(order)][order]
        self.merged_by_rank = merged

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words in one array, and the place where each word's ids begin."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(symbols), NO_RANK)  # of the pair that begins at each symbol
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.ranks(symbols[inner], symbols[inner + 1])
        done_symbols, done_words = [], []
        while len(symbols):
            begins = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(begins, len(word)))
            lowest = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            over = lowest == NO_RANK
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                rest = ~over
                symbols, word, rank, lowest = symbols[rest], word[rest], rank[rest], lowest[rest]
                if not len(symbols):
                    break
            chosen = np.flatnonzero(rank == lowest)
            # in a run such as "aaa" every other pair merges, from the left
            new_run = np.concatenate(([True], np.diff(chosen) != 1))
            run_begin = np.maximum.accumulate(np.where(new_run, np.arange(len(chosen)), 0))
            chosen = chosen[(np.arange(len(chosen)) - run_begin) % 2 == 0]
            symbols[chosen] = self.merged_by_rank[rank[chosen]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[chosen + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            beside = np.zeros(len(word) + 1, dtype=bool)  # the last entry stands for none
            beside[place[chosen]] = beside[place[chosen] - 1] = True
            again = np.flatnonzero(beside[:-1])
            rank[again] = NO_RANK
            again = again[again < len(word) - 1]
            again = again[word[again] == word[again + 1]]
            rank[again] = self.ranks(symbols[again], symbols[again + 1])
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        begins = np.searchsorted(word[order], np.arange(len(words)))
        return symbols[order], begins


class Encoder:
    """Encodes texts; keeps the ids of words it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(WORD_PATTERN)
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers

    def words_of(self, text: str) -> list[str]:
        """The words of a text in order; an added token is a word of its own."""
        if self.added is None or not (found := list(self.added.finditer(text))):
            return self.pattern.findall(text)
        words, end = [], 0
        for m in found:
            words += self.pattern.findall(text[end : m.start()])
            words.append(m[0])
            end = m.end()
        return words + self.pattern.findall(text[end:])

    def learn(self, words: set[str]) -> None:
        added = self.vocabulary.added
        self.known.update((w, np.int32(added[w]).tobytes()) for w in words if w in added)
        new = [w for w in words if w not in added]
        if new:
            ids, begins = self.vocabulary.merge_words([w.encode() for w in new])
            flat, begins = ids.astype(np.int32).tobytes(), (begins * 4).tolist()
            self.known.update(zip(new, (flat[a:b] for a, b in zip(begins, [*begins[1:], len(flat)]))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the ends of the texts in it, after a leading 0."""
        parts = [self.words_of(text) for text in texts]
        met = set().union(*parts)
        new = met - self.known.keys()
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = met
        if new:
            self.learn(new)
        ids_of = self.known.__getitem__
        packed = [b"".join(map(ids_of, words)) for words in parts]
        ends = np.cumsum([0, *(len(x) // 4 for x in packed)], dtype=np.int32)
        return np.frombuffer(b"".join(packed), dtype=np.int32), ends


class Decoder:
    """Texts of lists of ids: the bytes of all tokens are gathered at once."""

    def __init__(self, vocabulary: Vocabulary):
        tokens = vocabulary.token_bytes
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.begins = np.cumsum(self.lengths) - self.lengths

    def decode(self, lists: pa.ListArray) -> list[str]:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        content = b"".join(self.gather(ids[at : at + GATHERED_IDS]) for at in range(0, len(ids), GATHERED_IDS))
        ends = np.concatenate(([0], np.cumsum(self.lengths[ids])))[np.cumsum(sizes)].tolist()
        return [content[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends], ends)]

    def gather(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        return self.bytes[np.repeat(self.begins[ids] - (ends - lengths), lengths) + np.arange(ends[-1])].tobytes()


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with the array column `ids` in place of `text`. `vocabulary` is the content of the file
    (a fixed size of some MB, whatever the corpus), broadcast to the executors."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    carried = [c for c in docs.columns if c not in (text, ids)]
    prepared = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias(ids))
    schema = kinds(docs, carried, f"`{ids}` array<int>")

    def make():
        encoder = Encoder(Vocabulary(shared.value))

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            flat, ends = encoder.encode([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()])
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=batch.schema.names)

        return one

    return per_batch(prepared, schema, make, most_rows=500)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """`encoded` with the column `text` besides `ids`: the text of the ids, added tokens included; null ids are empty."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    carried = [c for c in encoded.columns if c not in (ids, text)]
    prepared = encoded.select(*[F.col(f"`{c}`") for c in [*carried, ids]])
    names = [*carried, ids, text]
    schema = kinds(encoded, [*carried, ids], f"`{text}` string")

    def make():
        decoder = Decoder(Vocabulary(shared.value))

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = decoder.decode(batch.column(batch.num_columns - 1))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

        return one

    return per_batch(prepared, schema, make, most_rows=500)
