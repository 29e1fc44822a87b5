"""Hashes of all words of many texts at once, in numpy.

A word's hash is a polynomial in FACTOR over its code points, modulo 2^64, then mixed. Differences of one running sum over
all characters give every word's polynomial, so no word is ever a Python object."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np

#: Characters that are hashed at a time, and odd numbers for it.
PIECE, FACTOR, MIX = 1 << 18, 0xD6E8FEB86659FD93, np.uint64(0x9E3779B97F4A7C15)
#: Between words of letters, digits and underscores; between words of anything but ASCII white space.
LETTERS, SPACE = re.compile(r"\W"), re.compile(r"[\x20\x09-\x0D]")


@cache
def _in_words(gap: re.Pattern) -> np.ndarray:
    """Whether each code point stands in words, as the expression has it."""
    if gap is SPACE:
        found = np.ones(0x110000, bool)
        found[[0x20, *range(0x09, 0x0E)]] = False
    else:
        found = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
        found[ord("_")] = True
    return found


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2^bits powers of FACTOR and of its inverse, modulo 2^64."""
    ones = np.ones(1 << bits, np.uint64)
    ones[1:], inverse = FACTOR, ones.copy()
    inverse[1:] = pow(FACTOR, -1, 1 << 64)
    return np.cumprod(ones), np.cumprod(inverse)


def _pieces(texts: list[str], gap: re.Pattern) -> Iterator[list[tuple[int, str]]]:
    """The texts with their places, in groups of PIECE characters; longer ones are cut where no word stands."""
    group, n = [], 0
    for k, t in enumerate(texts):
        at = 0
        while at < len(t):
            cut = gap.search(t, at + PIECE) if len(t) - at > PIECE else None
            end = cut.start() if cut else len(t)
            group.append((k, t[at:end]))
            n, at = n + end - at, end
            if n > PIECE:
                yield group
                group, n = [], 0
    if group:
        yield group


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def hash_words(texts: list[str | None], gap: re.Pattern = LETTERS) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word of the texts, in order, and each text's number of words; null texts have none.

    Words of letters are lower-cased as Python does it, words between white space in A-Z only."""
    texts, ascii_only = ["" if t is None else t if gap is SPACE else t.lower() for t in texts], gap is SPACE
    out, sizes = [np.empty(0, np.uint64)], np.zeros(len(texts), np.int64)
    for group in _pieces(texts, gap):
        codes = np.frombuffer("\n".join([t for _, t in group]).encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = _in_words(gap)[codes]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if ascii_only:
            codes = codes + 32 * ((codes >= 65) & (codes <= 90)).astype(np.uint32)
        power, inverse = _powers(max(PIECE.bit_length() + 1, len(codes).bit_length()))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * MIX * power[: len(codes)], out=sums[1:])
        out.append(mix((sums[ends] - sums[starts]) * inverse[starts]))
        last = np.cumsum([len(t) + 1 for _, t in group])
        sizes += np.bincount(np.array([k for k, _ in group])[np.searchsorted(last, starts, "right")], minlength=len(texts))
    return np.concatenate(out), sizes


def hash_shingles(words: np.ndarray, sizes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of `size` words of each text (of all its words, if it has fewer), in order, and each text's number of them."""
    ends = np.cumsum(sizes)
    runs = np.zeros(len(words), np.uint64)
    for k in range(size):
        runs = runs * np.uint64(FACTOR)
        runs[: len(words) - k] += words[k:]
    of = np.repeat(np.arange(len(sizes)), sizes)
    left = ends[of] - np.arange(len(words))  # words of the text from here on
    short = (sizes > 0) & (sizes < size)
    keep = left >= size
    for k in np.flatnonzero(short).tolist():
        a, total = int(ends[k] - sizes[k]), 0
        for w in words[a : int(ends[k])].tolist():
            total = (total * FACTOR + w) % (1 << 64)
        runs[a], keep[a] = (total + int(sizes[k]) * int(MIX)) % (1 << 64), True
    return mix(runs[keep]), np.where(short, 1, np.maximum(sizes - size + 1, 0))
