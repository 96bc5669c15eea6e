"""Small tables for the operators' tests, and brute-force versions of their results."""

from __future__ import annotations

import hashlib
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: Null and empty texts, white space, one word, ties, repeated rows, null ids and columns, a very long text.
EDGE_TEXTS = [
    (0, None, "en"),
    (1, "", "en"),
    (2, " \n\t ", None),
    (3, "one", "en"),
    (4, "the same text twice over and over", "en"),
    (5, "the same text twice over and over", "de"),
    (5, "the same text twice over and over", "de"),
    (None, "a text without an id", "en"),
    (7, "word " * 60_000, "en"),
    (8, "x" * 50_000, "fr"),
    (9, "Straße ÜBER é  日本 🎉 <|endoftext|> 123 %%% ## !!", "de"),
]


def edge_documents(spark: SparkSession) -> DataFrame:
    rows = [(i, t, lang, None, None if t is None else len(t)) for i, t, lang in EDGE_TEXTS]
    return spark.createDataFrame(rows, DOCUMENTS)


def folder(spark: SparkSession, path, **tables: DataFrame) -> str:
    """A data directory with these tables."""
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def documents(spark: SparkSession, texts: list) -> DataFrame:
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCUMENTS)


def empty(spark: SparkSession, schema: str = DOCUMENTS) -> DataFrame:
    return spark.createDataFrame([], schema)


def texts_of(spark: SparkSession, sf_dir: str) -> dict[int, str]:
    return {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def repeated_bytes(texts: list[bytes], length: int) -> list[list[bool]]:
    """Of each byte whether a string of `length` bytes that starts twice covers it."""
    count: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    found = []
    for t in texts:
        covered, until = [False] * len(t), 0
        for i in range(len(t)):
            if i + length <= len(t) and count[t[i : i + length]] > 1:
                until = i + length
            covered[i] = i < until
        found.append(covered)
    return found


def removal(text: bytes, covered: list[bool]) -> tuple[int, int, int, str]:
    kept = bytes(b for b, c in zip(text, covered) if not c)
    spans = sum(1 for c, _ in groupby(covered) if c)
    return len(text), sum(covered), spans, hashlib.sha256(kept).hexdigest()


def shingle_set(text: str | None, words: int) -> frozenset:
    parts = (text or "").encode().lower().split()
    if not parts:
        return frozenset()
    if len(parts) < words:
        return frozenset([tuple(parts)])
    return frozenset(zip(*(parts[k:] for k in range(words))))


def components(sets: dict[int, frozenset], percent: int) -> dict[int, int]:
    """Smallest reachable id of each id, over all pairs."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}
