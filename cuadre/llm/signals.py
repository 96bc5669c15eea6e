"""Counts over one text that quality operators use."""

from __future__ import annotations

import numpy as np

# The byte sets that the counts are defined by.
WHITE = [0x20, *range(0x09, 0x0E)]
SYMBOLS = list(b"#*$%&|<>")
UPPER = list(range(ord("A"), ord("Z") + 1))
LOWER = list(range(ord("a"), ord("z") + 1))
DIGITS = list(range(ord("0"), ord("9") + 1))

NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_digits", "n_pipes", "n_exclaims", "n_same_next", "n_distinct",
)


def repeat_words(hashes: np.ndarray) -> int:
    """Words in 3-word windows that occur twice or more; `hashes`: 64 bits for each word."""
    if len(hashes) < 4:
        return 0
    u = hashes.view(np.uint64)
    windows = (u[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ u[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) ^ u[2:]
    order = np.argsort(windows)
    equal = windows[order][1:] == windows[order][:-1]
    if not equal.any():
        return 0
    covered = np.zeros(len(hashes), dtype=bool)
    for side in (order[1:][equal], order[:-1][equal]):
        for word in range(3):
            covered[side + word] = True
    return int(covered.sum())


def signals(raw: bytes) -> tuple[int, ...]:
    """The counts of NAMES over the UTF-8 bytes of a text; all 0 for an empty one.

    A word is a run of bytes that are not ASCII white space; characters are code points.
    """
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(NAMES)
    of_byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=n)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        n,
        len(raw) - int(of_byte[0x80:0xC0].sum() + of_byte[WHITE].sum()),
        int(of_byte[SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeat_words(hashes),
        len(lines),
        int(of_byte[UPPER].sum()),
        int(of_byte[LOWER].sum()),
        int(of_byte[DIGITS].sum()),
        int(of_byte[ord("|")]),
        int(of_byte[ord("!")]),
        int((hashes[1:] == hashes[:-1]).sum()),
        len(set(words)),
    )
