"""Benchmark decontamination (operator 10): spaced-seed hashing.

Fixed masks choose some of a run of word positions and ignore the others. Hashes of the chosen words of
every run of every benchmark item meet those of every run of every document; a hit aligns the item with the
document, and the words around it are compared one by one. An overlap counts if a window of VERIFY words
(or the whole item, if shorter) agrees in MIN_SHARE of its words, so replaced words do not hide a passage.

A benchmark of up to BROADCAST_WORDS words goes to the documents: they are read once by a map and never shuffled. It goes
in blocks of about MAX_WORDS words, each an index of sorted hashes that every task joins with the hashes of its texts, one
block after the other. A larger one meets the documents in a shuffle: hashes of document positions that a Bloom filter of
fixed size lets pass join the benchmark's hashes, and candidate pairs of text and item bring both texts together. Texts are
known by two hashes there, so copies are the work of one. An item of more than PIECE words is cut into pieces that overlap.
What is found hangs neither on the blocks nor on the way.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigilake.llm.common import materialize

log = logging.getLogger(__name__)

#: 1: the word counts, 0: any word may stand here.
MASKS = ("11011011", "1101011001", "111010011", "1111011")
VERIFY, MIN_SHARE = 13, 0.8
#: Items of fewer than VERIFY words have masks of their own (item_masks); below five words they count as exact copies only. By default those below
#: MIN_WORDS are left out, unless their words have MIN_CHARS characters (long words, scripts without spaces): they stand in clean texts too.
MIN_WORDS, MIN_CHARS = 5, 20
MAX_WORDS, PIECE = 500_000, 100_000
#: Up to so many words the benchmark is broadcast, at some 60 bytes a word; bits of the filter beyond that (16 MB).
BROADCAST_WORDS, FILTER_BITS = 4 * MAX_WORDS, 27
#: Words whose codes a task remembers.
REMEMBERED = 1 << 19
#: Words of documents that are hashed at a time, and pairs of equal seeds that are held at a time.
CHUNK_WORDS, PAIRS = 1 << 19, 1 << 20
WORD = re.compile(r"\w+")
#: Scripts that are written without spaces (Thai, Lao, Myanmar, Khmer, kana, Han): each letter is a word of its own.
_BARE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U000323af"
BARE, MIXED = re.compile(f"[{_BARE}]"), re.compile(f"[{_BARE}]|[^\\W{_BARE}]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, in lower case; single letters of scripts without spaces."""
    text = (text or "").lower()
    return MIXED.findall(text) if not text.isascii() and BARE.search(text) else WORD.findall(text)


def pieces(words: list[str]) -> list[list[str]]:
    """The words in runs of PIECE at most; every window of VERIFY words lies in one."""
    return [words[i : i + PIECE] for i in range(0, max(1, len(words) - VERIFY + 1), PIECE - VERIFY + 1)]


def item_masks(n: int) -> list[str]:
    """Masks for items of n < VERIFY words: whichever n // 5 words are replaced, one mask leaves them all out.

    Positions are paired; each mask leaves out as many pairs as words may be replaced."""
    pairs = [range(i, min(i + 2, n)) for i in range(0, n, 2)]
    return ["".join("01"[all(i not in p for p in out)] for i in range(n)) for out in combinations(pairs, n // 5)]


def says_enough(words: list[str], min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> bool:
    return bool(words) and (len(words) >= min_words or sum(map(len, words)) >= min_chars)


class Index:
    """The seeds of some benchmark items, sorted by hash, for each mask."""

    def __init__(self, items: list[tuple[object, list[str]]], masks: tuple[str, ...] = MASKS):
        self.vocab: dict[str, int] = {}
        found = [(i, np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws], np.int64)) for i, ws in items]
        self.ids, self.words = [i for i, _ in found], [w for _, w in found]
        self.codes = np.random.Generator(np.random.PCG64(10)).integers(0, 1 << 63, len(self.vocab) + 1, np.uint64)
        short = sorted({len(w) for w in self.words if len(w) < VERIFY})
        self.masks = []
        for mask, fits in [(m, lambda n: n >= VERIFY) for m in masks] + [(m, lambda n, s=s: n == s) for s in short for m in item_masks(s)]:
            own = [k for k, w in enumerate(self.words) if fits(len(w))]
            hashes = [self.hash(mask, self.words[k]) for k in own]
            if own:
                h = np.concatenate(hashes)
                item = np.repeat(np.array(own), [len(x) for x in hashes])
                at = np.concatenate([np.arange(len(x)) for x in hashes])
                order = np.argsort(h, kind="stable")
                maybe = np.zeros(1 << 20, bool)
                maybe[(h >> np.uint64(44)).astype(np.int64)] = True
                self.masks.append((mask, h[order], item[order], at[order], maybe))

    def hash(self, mask: str, ids: np.ndarray) -> np.ndarray:
        n = max(0, len(ids) - len(mask) + 1)
        h, codes = np.zeros(n, np.uint64), self.codes[ids]
        for k, bit in enumerate(mask):
            if bit == "1":
                h = (h + codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        return h

    def hits(self, ids: np.ndarray) -> np.ndarray:
        """Distinct (item, where it begins in ids) that some seed aligns."""
        out = [np.empty((0, 2), np.int64)]
        for mask, seeds, item, at, maybe in self.masks:
            h = self.hash(mask, ids)
            where = np.flatnonzero(maybe[(h >> np.uint64(44)).astype(np.int64)])
            lo, hi = np.searchsorted(seeds, h[where], "left"), np.searchsorted(seeds, h[where], "right")
            where, lo, n = where[lo < hi], lo[lo < hi], (hi - lo)[lo < hi]
            total = np.cumsum(n)
            cuts = np.unique(np.searchsorted(total, np.arange(0, total[-1] if len(n) else 0, PAIRS), "right")).tolist() + [len(n)]
            for a, b in zip(cuts, cuts[1:]):
                k = np.repeat(lo[a:b] - (total[a:b] - n[a:b]), n[a:b]) + np.arange(total[a] - n[a], total[b - 1])
                out.append(np.unique(np.column_stack([item[k], np.repeat(where[a:b], n[a:b]) - at[k]]), axis=0))
        return np.unique(np.concatenate(out), axis=0)

    def verify(self, ids: np.ndarray, item: int, start: int) -> tuple[int, int, int] | None:
        return overlap(ids, self.words[item], start)


def overlap(ids: np.ndarray, w: np.ndarray, start: int) -> tuple[int, int, int] | None:
    """(first word, words, equal words) of the part of an item's words w, at `start` of a text's, that all its good windows cover."""
    lo, hi = max(0, -start), min(len(w), len(ids) - start)
    same = w[lo:hi] == ids[start + lo : start + hi]
    size = min(VERIFY, len(w))
    if len(same) < size:
        return None
    total = np.concatenate(([0], np.cumsum(same)))
    good = np.flatnonzero(total[size:] - total[:-size] >= (MIN_SHARE * size if len(w) >= VERIFY else size - size // 5))
    if not len(good):
        return None
    first, end = int(good[0]), int(good[-1]) + size
    return start + lo + first, end - first, int(total[end] - total[first])


def _search(blocks: Sequence[Callable[[], Index]], texts: list[str | None]) -> Iterator[tuple[int, object, int, int, int]]:
    """(place of the text, item id, first word, words, equal words): the best overlap of each text with each item id."""
    at = 0
    while at < len(texts):
        parts, edges, n = [], [0], 0
        begin = at
        while at < len(texts) and n < CHUNK_WORDS:
            parts.append(words_of(texts[at]))
            n += len(parts[-1])
            edges.append(n)
            at += 1
        starts = np.array(edges)
        best: dict[tuple[int, object], tuple[int, int, int]] = {}
        for block in blocks:
            index = block()
            flat = np.fromiter((index.vocab.get(w, 0) for got in parts for w in got), np.int64, n)
            for item, start in index.hits(flat).tolist():
                # The seed's words lie in [start, start + len(item)); its text is found by its first word that is in range.
                for k in range(max(0, int(np.searchsorted(starts, max(start, 0), "right")) - 1), len(parts)):
                    if starts[k] >= start + len(index.words[item]):
                        break
                    if (v := index.verify(flat[edges[k] : edges[k + 1]], item, start - edges[k])) is not None:
                        key = (k, index.ids[item])
                        if key not in best or (v[2], -v[0], -v[1]) > (best[key][2], -best[key][0], -best[key][1]):
                            best[key] = v
        for (k, i), v in sorted(best.items(), key=lambda x: (x[0][0], str(x[0][1]))):
            yield begin + k, i, *v


def _given(blocks: list[Broadcast]) -> list[Callable[[], Index]]:
    """For a task: each block's index; of several, only the one in use stays in memory."""

    def one(block: Broadcast) -> Index:
        index = block.value
        if len(blocks) > 1:
            vars(block).pop("_value", None)
        return index

    return [partial(one, b) for b in blocks]


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL").distinct()


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, max_words: int, enough: tuple[int, int]) -> list[Broadcast]:
    """The benchmark's index, in blocks of about max_words words, each broadcast. Items come to the driver a partition at a time."""
    context, held, n, out = benchmark.sparkSession.sparkContext, [], 0, []
    for r in _items(benchmark, item_col, text_col).toLocalIterator():
        for words in pieces(words_of(r.t)):
            if says_enough(words, *enough):
                held.append((r.i, words))
                n += len(words)
            if n >= max_words:
                out.append(context.broadcast(Index(held)))
                held, n = [], 0
    return [*out, context.broadcast(Index(held))] if held or not out else out


def item_sizes(benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text", min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """item_id, n_words, used (false: it says too little and is left out) of each item and text that is not null."""
    kind = to_arrow_type(benchmark.schema[item_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [words_of(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(kind), pa.array([len(w) for w in found], pa.int64()), pa.array([says_enough(w, min_words, min_chars) for w in found])], ["item_id", "n_words", "used"])

    return _items(benchmark, item_col, item_text).mapInArrow(run, f"item_id {benchmark.schema[item_col].dataType.simpleString()}, n_words long, used boolean")


def _size(benchmark: DataFrame, item_col: str, item_text: str, enough: tuple[int, int]) -> int:
    """Words of the items that are used; a note of how many are not."""
    r = item_sizes(benchmark, item_col, item_text, *enough).agg(F.sum(F.when(F.col("used"), F.col("n_words"))).alias("words"), F.count(F.when(~F.col("used"), 1)).alias("out"), F.count(F.lit(1)).alias("n")).first()
    if r.out:
        log.warning("%s of %s benchmark items are left out: fewer than %s words and %s characters", r.out, r.n, *enough)
    return r.words or 0


# -- the way by a shuffle


class _Codes(dict):
    """A 64-bit code of each word, the same in every task."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return found


def _seed(mask: str, codes: np.ndarray) -> np.ndarray:
    """Hash of the words that the mask chooses, of each run of codes; other masks give other hashes."""
    n = max(0, len(codes) - len(mask) + 1)
    h = np.full(n, int.from_bytes(blake2b(mask.encode(), digest_size=8).digest(), "little"), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            h = (h + codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


def _pieces_table(benchmark: DataFrame, item_col: str, item_text: str, enough: tuple[int, int]) -> DataFrame:
    """item_id, piece (its words joined by spaces, which no word has), n (words)."""
    kind = to_arrow_type(benchmark.schema[item_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(k, " ".join(w), len(w)) for k, t in enumerate(b.column(1)) for w in pieces(words_of(t.as_py())) if says_enough(w, *enough)]
            at, texts, sizes = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())).cast(kind), pa.array(texts, pa.string()), pa.array(sizes, pa.int32())], ["item_id", "piece", "n"])

    found = _items(benchmark, item_col, item_text).mapInArrow(run, f"item_id {benchmark.schema[item_col].dataType.simpleString()}, piece string, n int")
    return found.withColumn("piece_key", F.xxhash64("piece"))


def _piece_seeds(found: DataFrame) -> DataFrame:
    """seed, piece_key, n, at: every seed of every distinct piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for b in batches:
            for key, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = piece.split(" ")
                own = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
                for mask in MASKS if len(words) >= VERIFY else item_masks(len(words)):
                    h = _seed(mask, own)
                    n = len(h)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(n, key)), pa.array(np.full(n, len(words), np.int32)), pa.array(np.arange(n))], ["seed", "piece_key", "n", "at"])

    return found.select("piece_key", "piece").distinct().mapInArrow(run, "seed long, piece_key long, n int, at long")


def _shuffled(docs: DataFrame, text_col: str, benchmark: DataFrame, item_col: str, item_text: str, enough: tuple[int, int]) -> DataFrame:
    """k1, k2 (hashes of a text), item_id, first_word, n_words, n_equal: the best overlap of each distinct text and item."""
    spark = docs.sparkSession
    found = materialize(_pieces_table(benchmark, item_col, item_text, enough), "pieces")
    seeds = materialize(_piece_seeds(found), "seeds")
    short = sorted(r.n for r in found.select("n").filter(F.col("n") < VERIFY).distinct().collect())  # VERIFY numbers at most
    masks = [*MASKS, *[m for n in short for m in item_masks(n)]]
    # One bit of 2^FILTER_BITS for each seed, in words of 64: 2^21 rows at most come to the driver.
    bit = F.shiftrightunsigned("seed", 64 - FILTER_BITS)
    lanes = seeds.groupBy(F.shiftright(bit, 6).alias("lane")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
    maybe = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    maybe[lanes.column("lane").to_numpy()] = lanes.column("bits").to_numpy()
    given = spark.sparkContext.broadcast(maybe.view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits = _Codes(), given.value
        for b in batches:
            for k1, k2, text in zip(*(c.to_pylist() for c in b.columns)):
                words = words_of(text)
                for begin in range(0, len(words), CHUNK_WORDS):
                    own = np.fromiter(map(codes.__getitem__, words[begin : begin + CHUNK_WORDS + VERIFY]), np.uint64)
                    for mask in masks:
                        h = _seed(mask, own)[:CHUNK_WORDS]
                        place = h >> np.uint64(64 - FILTER_BITS)
                        at = np.flatnonzero((bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))
                        if n := len(at):
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k1)), pa.array(np.full(n, k2)), pa.array(h[at].view(np.int64)), pa.array(at + begin)], ["k1", "k2", "seed", "pos"])

    keyed = docs.select(*text_keys(text_col), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    hits = keyed.mapInArrow(run, "k1 long, k2 long, seed long, pos long").distinct().join(seeds, "seed")
    pairs = materialize(hits.select("k1", "k2", "piece_key", (F.col("pos") - F.col("at")).alias("start")).distinct(), "pairs")
    texts = keyed.join(pairs.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    item_type = benchmark.schema[item_col].dataType
    aligned = pairs.join(found, "piece_key")

    def verify(key, text: pa.Table, own: pa.Table) -> pa.Table:
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("item_id", to_arrow_type(item_type)), ("first_word", pa.int64()), ("n_words", pa.int64()), ("n_equal", pa.int64())])
        if not len(text) or not len(own):
            return schema.empty_table()
        words, best, indexes = words_of(text.column("text")[0].as_py()), {}, {}
        for i, piece, start in zip(own.column("item_id").to_pylist(), own.column("piece"), own.column("start").to_pylist()):
            if (p := piece.as_py()) not in indexes:
                vocab: dict[str, int] = {}
                ids = np.array([vocab.setdefault(w, len(vocab) + 1) for w in p.split(" ")], np.int64)
                indexes[p] = vocab, ids
            vocab, ids = indexes[p]
            # Only the words that the item may cover are looked up.
            lo = max(0, start)
            window = np.fromiter((vocab.get(w, 0) for w in words[lo : max(lo, start + len(ids))]), np.int64)
            if (v := overlap(window, ids, start - lo)) is not None:
                v = (v[0] + lo, v[1], v[2])
                if i not in best or (v[2], -v[0], -v[1]) > (best[i][2], -best[i][0], -best[i][1]):
                    best[i] = v
        rows = [(key[0].as_py(), key[1].as_py(), i, *v) for i, v in best.items()]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, schema)], schema=schema)

    return texts.groupBy("k1", "k2").cogroup(aligned.groupBy("k1", "k2")).applyInArrow(verify, f"k1 long, k2 long, item_id {item_type.simpleString()}, first_word long, n_words long, n_equal long")


def text_keys(text_col: str) -> list[Column]:
    """k1, k2: 128 bits of hashes of a text."""
    return [F.xxhash64(F.col(text_col).cast("string")).alias("k1"), F.xxhash64(F.lit("2"), F.col(text_col).cast("string")).alias("k2")]


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", max_words: int = MAX_WORDS, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """doc_id, item_id, first_word (of the document, from 0), n_words, n_equal: the best overlap of each document and item.

    The best has most equal words, then the first place. Only contaminated documents have rows. Words are runs of
    letters, digits and underscores, in lower case, and single letters of scripts without spaces. Items of fewer than
    min_words words, whose words have fewer than min_chars characters, are left out (item_sizes() lists them; min_words=1
    leaves out none); below five words only exact copies of the whole item count. Null and empty texts have no words; items
    that repeat count once, several texts of one item id are that item; a repeated document gives its rows again; null ids
    stay, of documents and items. Other columns are left out. broadcast_words: above it the benchmark is joined by a shuffle."""
    enough = (min_words, min_chars)
    item_type = benchmark.schema[item_col].dataType
    arrow_item = to_arrow_type(item_type)
    if _size(benchmark, item_col, item_text, enough) > broadcast_words:
        found = _shuffled(docs, text_col, benchmark, item_col, item_text, enough)
        return docs.select(F.col(id_col).alias("doc_id"), *text_keys(text_col)).join(found, ["k1", "k2"]).drop("k1", "k2")
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id {item_type.simpleString()}, first_word long, n_words long, n_equal long"
    blocks = _blocks(benchmark, item_col, item_text, max_words, enough)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = _given(blocks)
        for b in batches:
            cols = list(zip(*_search(given, b.column(1).to_pylist()))) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], arrow_item), *[pa.array(c, pa.int64()) for c in cols[2:]]], ["doc_id", "item_id", "first_word", "n_words", "n_equal"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", max_words: int = MAX_WORDS, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """The rows of docs, with all columns, whose text has no such overlap; each row is judged by itself, without a shuffle up to broadcast_words."""
    enough = (min_words, min_chars)
    if _size(benchmark, item_col, item_text, enough) > broadcast_words:
        bad = _shuffled(docs, text_col, benchmark, item_col, item_text, enough).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct()
        k1, k2 = text_keys(f"`{text_col}`")
        return docs.join(bad, (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left_anti")
    at, blocks = docs.columns.index(text_col), _blocks(benchmark, item_col, item_text, max_words, enough)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = _given(blocks)
        for b in batches:
            bad = sorted({x[0] for x in _search(given, b.column(at).to_pylist())})
            keep = np.ones(b.num_rows, bool)
            keep[bad] = False
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
