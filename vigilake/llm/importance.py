"""Target-distribution importance resampling (operator 12): hashed n-grams, counted and weighed, drawn with Gumbel noise.

A feature's bucket is the CRC-32 of its text, which is never built: each word's CRC is computed once, and those of n-grams
follow from them. CRCs are linear over GF(2): crc(a + b) is crc(a), moved by the matrix that appends len(b) zero bytes, xor
crc(b). Counts are one row of BUCKETS numbers a task, summed by a shuffle of as many keys; the gains of the buckets are the
only thing that is broadcast. Ranks need no shuffle of what is not drawn: scores are whole numbers, so their histogram gives
the cutoff, and only rows from there on are sorted by ranges and numbered."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.llm.common import materialize, numbered

BUCKETS, NGRAMS, MIN_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, 7
#: Words as runs of UTF-8 bytes, once A-Z are lower-cased: digits, letters and all that is not ASCII.
WORD, GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")
#: Words that are hashed at a time, distinct words whose CRCs a task remembers, and bytes of UTF-8 that are cut into words at a time.
CHUNK_WORDS, REMEMBERED, PIECE = 1 << 18, 1 << 19, 1 << 22
POLYNOMIAL = 0xEDB88320


def _times(matrix: np.ndarray, x: np.ndarray) -> np.ndarray:
    """matrix (32 columns, as numbers) times each of the vectors x."""
    out = np.zeros(np.shape(x), np.uint32)
    for i in range(32):
        out ^= np.where((x >> np.uint32(i)) & np.uint32(1), matrix[i], np.uint32(0))
    return out


def _appends() -> list[np.ndarray]:
    """The matrices that append 1, 2, 4, ... zero bytes, 2^40 at most, each with four tables of what it makes of a byte's 256 values."""
    bit = np.array([POLYNOMIAL, *[1 << i for i in range(31)]], np.uint32)
    for _ in range(3):  # from one bit to eight
        bit = _times(bit, bit)
    matrices = [bit]
    for _ in range(40):
        matrices.append(_times(matrices[-1], matrices[-1]))
    values = np.arange(256, dtype=np.uint32)
    return [np.stack([_times(m, values << np.uint32(8 * k)) for k in range(4)]) for m in matrices]


APPEND = _appends()


def append_zeros(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What each CRC's part is in the CRC of its text and `length` more bytes."""
    out, left, k = crc.copy(), length, 0
    while left.any():
        at = np.flatnonzero(left & 1)
        x, t = out[at], APPEND[k]
        out[at] = t[0][x & 255] ^ t[1][(x >> 8) & 255] ^ t[2][(x >> 16) & 255] ^ t[3][x >> 24]
        left, k = left >> 1, k + 1
    return out


def joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of pairs of texts, from the CRCs of both and the second's length in bytes."""
    return append_zeros(first, length) ^ second


class _Words(dict):
    """CRC-32 and length of each word, in one number: crc + length * 2^32."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = zlib.crc32(word) | len(word) << 32
        return found


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about PIECE bytes, cut where no word stands."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def _features(texts: Iterator[bytes], ngrams: int, buckets: int, known: _Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each feature, its bucket, number of words of each text), for some texts at a time; texts are numbered from 0 in each.

    A text of more than CHUNK_WORDS words comes alone."""
    space = np.uint32(zlib.crc32(b" "))
    held: list[np.ndarray] = []
    n = 0

    def give() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(h) for h in held], np.int64)
        words = np.concatenate([*held, np.empty(0, np.int64)])
        owner = np.repeat(np.arange(len(held)), sizes)
        crc, length = (words & 0xFFFFFFFF).astype(np.uint32), words >> 32
        owners, found, run = [owner], [crc % np.uint32(buckets)], crc
        for k in range(1, ngrams):
            # Runs of k words, a space and the word after them.
            run = joined(joined(run[:-1], space, np.ones(max(0, len(run) - 1), np.int64)), crc[k:], length[k:])
            inside = owner[k:] == owner[:-k]
            owners.append(owner[k:][inside])
            found.append((run % np.uint32(buckets))[inside])
        return np.concatenate(owners), np.concatenate(found).astype(np.int64), sizes

    for text in texts:
        parts = [np.fromiter(map(known.__getitem__, WORD.findall(p)), np.int64) for p in _pieces(text.lower())]
        words = parts[0] if len(parts) == 1 else np.concatenate([*parts, np.empty(0, np.int64)])
        if held and n + len(words) > CHUNK_WORDS:
            yield give()
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield give()


def _bytes(column: pa.Array) -> Iterator[bytes]:
    return (x.as_py() or b"" for x in column.cast(pa.binary()))


def feature_counts(rows: DataFrame, text_col: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many features of all texts are in each bucket (none: no row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, np.int64), _Words()
        for b in batches:
            for _, found, _ in _features(_bytes(b.column(0)), ngrams, buckets, known):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return rows.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Of each bucket: floor(1000 * ln of the smoothed share in the target over that in the source). Both: feature_counts()."""

    def dense(counts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets)
        for r in counts.collect():  # one row a bucket at most
            out[r.bucket] = r.n
        return out

    s, t = dense(source), dense(target)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", ngrams: int = NGRAMS) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean gain of each document's features (none: 0)."""
    shared, buckets = docs.sparkSession.sparkContext.broadcast(gain), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, known = shared.value, _Words()
        for b in batches:
            n_words, n, total = [], [], []
            for owner, found, sizes in _features(_bytes(b.column(1)), ngrams, buckets, known):
                # Sums of whole numbers by differences of one running sum, features in order of their texts.
                order = np.argsort(owner, kind="stable")
                edges = np.searchsorted(owner[order], np.arange(len(sizes) + 1))
                running = np.concatenate(([0], np.cumsum(gain[found[order]])))
                n_words.append(sizes)
                n.append(np.diff(edges))
                total.append(running[edges[1:]] - running[edges[:-1]])
            n_words, n, total = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (n_words, n, total))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x.astype(np.int64)) for x in (n_words, n, total // np.maximum(n, 1))]], ["doc_id", "n_words", "n_features", "weight"])

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_features long, weight long"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln u)): u is the first 32 bits of the SHA-256 of `seed:key`, in the middle of its 2^-32."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document.

    weight says how much more likely a document's features are in the target than in docs; score adds Gumbel noise, so
    that the highest scores are a draw without replacement by importance. Of the N documents of min_words words or more,
    the floor(percent * N / 100) of highest score have a rank, from 1; ties go to the smaller doc_id, null ids last. Rows of
    one doc_id have the same noise, and each its own rank. Null and empty texts have no features and weight 0; an empty
    target leaves gains that say how rare a bucket is in docs. Other columns are left out."""
    gain = gains(feature_counts(docs, text_col, ngrams, buckets), feature_counts(target, target_text, ngrams, buckets), buckets)
    scored = materialize(weights(docs, gain, id_col, text_col, ngrams).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scored")
    able = F.col("n_words") >= min_words
    # Scores are whole numbers between bounds that gains and noise have, so these are some ten thousand rows at any size.
    histogram = sorted(((r.score, r.n) for r in scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    drawn, seen, cutoff = sum(n for _, n in histogram) * percent // 100, 0, None
    for score, n in histogram:
        if seen >= drawn:
            break
        cutoff, seen = score, seen + n
    if cutoff is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    up = able & (F.col("score") >= cutoff)
    ranks = numbered(scored.filter(up), "nth", F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = ranks.withColumn("rank", F.when(F.col("nth") < drawn, F.col("nth") + 1)).drop("nth")
    return ranked.unionByName(scored.filter(~up).withColumn("rank", F.lit(None).cast("long")))
