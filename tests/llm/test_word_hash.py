"""Words and shingles by numpy against regular expressions."""

import random
import re

import numpy as np
import pytest

from tests.llm.test_operators import EDGE
from vigilake.llm import word_hash

RULES = {word_hash.LETTERS: lambda t: re.findall(r"\w+", t.lower()), word_hash.SPACE: lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))}


def texts():
    rng = random.Random(1)
    some = [*EDGE, "İstanbul ΑΣ ΣΑΣ. don't_x 中文 字 é́ ½² \ud800 a\u00a0b—c «d» 🙂x", "a" * 3000 + " b", "", None, "one Two", "two one", "one two\x1cthree"]
    return some + ["".join(rng.choice("abcXYZ é—ßΣİ_1 .中\n") for _ in range(rng.randrange(200))) for _ in range(300)]


@pytest.mark.parametrize("gap", list(RULES))
@pytest.mark.parametrize("piece", [1 << 18, 40])
def test_words(monkeypatch, gap, piece):
    """The same hash for the same word anywhere, none for two; in pieces of any size."""
    monkeypatch.setattr(word_hash, "PIECE", piece)
    hashes, sizes = word_hash.hash_words(texts(), gap)
    found = [RULES[gap](t or "") for t in texts()]
    words = [w for f in found for w in f]
    assert sizes.tolist() == [*map(len, found)] and len(hashes) == len(words)
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_spread():
    many = word_hash.hash_words([" ".join(f"{a}{i}" for i in range(100_000) for a in ("w", "x_", "é"))])[0]
    assert len(np.unique(many)) == len(many) and len(np.unique(many % 512)) == 512 and np.bincount(many % 512).max() < 800


@pytest.mark.parametrize("size", [1, 4, 5])
def test_shingles(size):
    hashes, sizes = word_hash.hash_shingles(*word_hash.hash_words(texts(), word_hash.SPACE), size)
    found = [[tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if (w := RULES[word_hash.SPACE](t or "")) else [] for t in texts()]
    runs = [x for f in found for x in f]
    assert sizes.tolist() == [*map(len, found)] and len(hashes) == len(runs)
    assert len(set(zip(runs, hashes.tolist()))) == len(set(runs)) == len(set(hashes.tolist()))
    assert [len(x) for x in word_hash.hash_shingles(*word_hash.hash_words([None, ""]), size)] == [0, 2]
