"""Licence scan with a positional index of rare template words.

The index holds, for each word of the templates, the places where it stands in them. How rare a word is comes
from its document frequency over all documents, counted first. Of each template the rarest places are anchors: so
many that any alignment with enough matched weight must match one of them. A text's words are looked up among the
anchors; each hit proposes alignments (text place - template place), whose other places are then compared, and
the template is found when the matched weight (sum of inverse document frequencies) is at least `LEAST_MATCH` of the
template's and its mandatory key phrases stand there whole. Words put in or left out shift what follows: places
match, in order, within a band of `BAND` words to either side of the alignment, and a hit proposes all alignments whose band it
is in. Of alignments of one template that are no more than `BAND` words apart, the best one is the find. Base phrases have
no band: each place where they stand is a find.

Defined cases: null and empty texts have no words and no finds; a text of any length is scanned whole; a template may
be found at many places, overlapping ones included; repeated rows are scanned alike; in an empty table nothing is
found.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import kinds, per_batch, raw

#: Share of a template's weight that must match.
LEAST_MATCH = 0.8
#: By so many words a match may be shifted; less than half the words of the shortest notice.
BAND = 2
#: A..Z in lower case; bytes of words stay, others separate words.
WORD_BYTES = bytes(
    b + 32 if ord("A") <= b <= ord("Z") else b if b >= 0x80 or chr(b).isdigit() or ord("a") <= b <= ord("z") else 32
    for b in range(256)
)


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: phrases of `text` that must stand whole
    key_phrases: tuple[str, ...]
    #: base templates are phrases that are found at every place where they stand
    base: bool = False


# Base phrases with their labels.
BASE = [
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
]
# Words of public licence notices, and of the licences' own texts.
NOTICES = [
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
        ("permission is hereby granted",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "2")),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template(
        "cc-by-4.0",
        "licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
    Template(
        "cc-by-sa-4.0",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "apache-2.0",
        "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"
        " copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and"
        " distribute the work and such derivative works in source or object form",
        ("each contributor hereby grants to you", "prepare derivative works of"),
    ),
    Template(
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the software",
        ("all copies or substantial portions",),
    ),
    Template(
        "bsd",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
        ("endorse or promote products derived from this software",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "gpl-3.0",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the"
        " free software foundation either version 3 of the license or at your option any later version",
        ("gnu general public license as published", "either version 3"),
    ),
    Template(
        "gpl-2.0",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the"
        " free software foundation either version 2 of the license or at your option any later version",
        ("gnu general public license as published", "either version 2"),
    ),
    Template(
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published"
        " by the free software foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl-3.0",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published"
        " by the free software foundation",
        ("gnu affero general public license",),
    ),
    Template(
        "mpl-2.0",
        "if a copy of the mpl was not distributed with this file you can obtain one at",
        ("mpl was not distributed with this file",),
    ),
    Template(
        "epl",
        "this program and the accompanying materials are made available under the terms of the eclipse public license",
        ("eclipse public license",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use"
        " compile sell or distribute this software either in source code form or as a compiled binary for any purpose",
        ("free and unencumbered software", "public domain"),
    ),
]
TEMPLATES = BASE + NOTICES


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Index:
    """Postings of anchor words. `frequency`: word -> documents that hold it, of `documents` in all."""

    def __init__(self, templates: list[Template], frequency: dict[bytes, int], documents: int):
        self.templates = templates
        self.words = [words_of(t.text.encode()) for t in templates]
        self.weights, self.keys = [], []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, (template, words) in enumerate(zip(templates, self.words)):
            weights = [math.log((documents + 1) / (frequency.get(w, 0) + 1)) + 1e-3 for w in words]
            self.weights.append(weights)
            keys = []
            for phrase in template.key_phrases:
                parts = words_of(phrase.encode())
                at = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
                if not at:
                    raise ValueError(f"{phrase!r} is no part of the template {template.label}")
                keys.append((at[0], parts))
            self.keys.append(keys)
            # without its anchors a template has too little weight left to be found
            spare, slack = (1 - LEAST_MATCH) * sum(weights) + 1e-9, 0.0
            for i in sorted(range(len(words)), key=lambda i: (-weights[i], i)):
                self.postings[words[i]].append((k, i))
                slack += weights[i]
                if template.base or slack > spare:
                    break

    def find(self, words: list[bytes]) -> list[tuple[str, bool, int, int, float]]:
        """(label, base, first word, words, matched share) of each find, by place."""
        hits = defaultdict(set)
        for at, word in enumerate(words):
            if word in self.postings:
                for k, place in self.postings[word]:
                    hits[k].add(at - place)
        if not hits:
            return []
        joined = b" %s " % b" ".join(words)
        found = []
        for k, starts in hits.items():
            if all(b" %s " % b" ".join(key) in joined for _, key in self.keys[k]):
                found += [(start, k, share) for start, share in self._aligned(words, k, starts)]
        told = []
        for start, k, share in sorted(found):
            template = self.templates[k]
            told.append((template.label, template.base, max(start, 0), len(self.words[k]), min(share, 1.0)))
        return told

    def _aligned(self, words: list[bytes], k: int, starts: set[int]) -> list[tuple[int, float]]:
        """(start, matched share) of the finds of template `k` that hits at `starts` propose."""
        if self.templates[k].base:
            length = len(self.words[k])
            return [(s, 1.0) for s in sorted(starts) if s >= 0 and words[s : s + length] == self.words[k]]
        shifts, enough = range(-BAND, BAND + 1), []
        for start in {s + d for s in starts for d in shifts}:
            if not all(
                any(start + i + d >= 0 and words[start + i + d : start + i + d + len(key)] == key for d in shifts)
                for i, key in self.keys[k]
            ):
                continue
            share, straight = self.shares(words, k, start)
            if share >= LEAST_MATCH:
                enough.append((-share, -straight, start))
        # the best ones first; one that reaches into the band of a better one is the same find
        finds: dict[int, float] = {}
        for share, _, start in sorted(enough):
            if not any(start + d in finds for d in range(-2 * BAND, 2 * BAND + 1)):
                finds[start] = -share
        return list(finds.items())

    def shares(self, words: list[bytes], k: int, start: int) -> tuple[float, float]:
        """Matched share of template `k` in the band of an alignment, and on the alignment alone. One that is too small
        to be a find may be returned as 0."""
        there, weights = self.words[k], self.weights[k]
        total, end = sum(weights), len(words)
        near = set(words[max(0, start - BAND) : max(0, start + len(there) + BAND)])
        if sum(w for word, w in zip(there, weights) if word in near) < LEAST_MATCH * total:
            return 0.0, 0.0
        inside = range(max(0, -start), min(len(there), end - start))
        straight = sum(weights[i] for i in inside if words[start + i] == there[i])
        # best[d]: most weight of the places so far, matched up to the text's place start + i + d - BAND
        best = [0.0] * (2 * BAND + 1)
        for i, (word, weight) in enumerate(zip(there, weights)):
            for d in range(2 * BAND + 1):
                at = start + i + d - BAND
                matched = best[d] + weight if 0 <= at < end and words[at] == word else best[d]
                left_out = best[d + 1] if d < 2 * BAND else 0.0
                put_in = best[d - 1] if d else 0.0
                best[d] = max(matched, left_out, put_in)
        return max(best[-1], straight) / total, straight / total


def word_frequencies(docs: DataFrame, templates: list[Template], text: str = "text") -> tuple[dict[bytes, int], int]:
    """In how many documents each template word stands, and the number of documents. The result has
    at most as many entries as the templates have words."""
    wanted = sorted({w for t in templates for w in words_of(t.text.encode())})

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = dict.fromkeys(wanted, 0)
            for text in raw(batch.column(0)):
                for word in counts.keys() & words_of(text):
                    counts[word] += 1
            counts[b""] = batch.num_rows
            names = [w.decode() for w in counts]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "docs"]
            )

        return one

    counted = per_batch(docs.select(F.col(f"`{text}`").cast("string").alias("text")), "word string, docs long", make)
    rows = counted.groupBy("word").agg(F.sum("docs").alias("docs")).collect()
    totals = {r["word"].encode(): r["docs"] for r in rows}
    return totals, totals.pop(b"", 0)


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, text: str = "text") -> DataFrame:
    """`docs` with `n_words` and `found` in place of `text`: an array of (label, base, first_word, n_words, matched)."""
    frequency, documents = word_frequencies(docs, templates, text)
    # text and numbers alone: a class would be looked up in the package, which executors need not have
    plain = [(t.label, t.text, t.key_phrases, t.base) for t in templates]
    shared = docs.sparkSession.sparkContext.broadcast((plain, frequency, documents))
    carried = [c for c in docs.columns if c not in (text, "n_words", "found")]
    prepared = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias("text"))
    added = "n_words long, found array<struct<label:string,base:boolean,first_word:long,n_words:long,matched:double>>"
    find = pa.struct(
        [("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()),
         ("matched", pa.float64())]
    )
    names = [field.name for field in find]

    def make():
        plain, frequency, documents = shared.value
        index = Index([Template(*t) for t in plain], frequency, documents)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, finds = [], []
            for text in raw(batch.column(batch.num_columns - 1)):
                words = words_of(text)
                counts.append(len(words))
                finds.append([dict(zip(names, f)) for f in index.find(words)])
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(finds, pa.list_(find))],
                names=[*carried, "n_words", "found"],
            )

        return one

    return per_batch(prepared, kinds(docs, carried, added), make)
