"""Near-duplicates by word shingles: all documents whose sets of SHINGLE-word shingles have a Jaccard similarity of
at least 0.8 are linked.

First come operator 2's candidates: 64-bit SimHashes of the sets, pigeonhole blocks, a join on blocks, the Hamming distance.
Pairs at MAX_BITS or fewer are verified by their sets, and what they connect is not compared again. Similar sets may be further
apart than that (at 0.8 by 10 of 64 bits on average), so an exact way for the rest follows, by blocks of the sets themselves.

Sets of sizes a and b that are so similar differ in at most (a + b) / 9 shingles. Shingles are dealt by their hash
to more parts than that, so some parts at least are equal in both; the hash of a part is a join key. How many parts
there are hangs on the size: sizes go in classes that grow by a quarter, and each set gives keys for the pairs with its
own class and the next greater one, and for those with the next smaller one.

Pairs that share a key are told apart by their sets' 128-bit SimHash first: sets of LARGE shingles and more that are
similar differ in some 19 bits, and a pair is let go above FAR, seven deviations on. So is one whose parities say that the
sets differ too much: shingles are dealt to 64 * PARITIES bits, and sets that differ in n of them differ in n bits at most.
The others are verified by their sets. A bucket's hub is the set that meets most others in all of its buckets, as what near copies were copied from does.
Each set is held against the first hub of its buckets that it is not connected to yet, STARS times. Then, in
buckets that are still not connected, all that lie apart are held against each other. In one of more than CROWD sets, only
those take part whose crowded keys are as many as similar sets must share: others meet their like in smaller buckets. Such
sets are told apart by what they have that a hub of hubs has not: either two of them share a shingle of that, which is a key
of its own, or they differ in all of it, and counts say whether that is too much. So what many documents have in common
costs nothing, near copies by the thousand make few pairs, and no pair is left out but by the sketches' chance: if bits of
similar sets differ as those of random ones do, one pair of sets in some 10^12 at a similarity of just 0.8, fewer above it; a
group loses a document only if that takes all of its links.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vigilake.llm.common import drop, materialize
from vigilake.llm.graph import components
from vigilake.llm.simhash import MAX_BITS, name_components
from vigilake.llm.simhash import links as near_values
from vigilake.llm.word_hash import MIX, SPACE, hash_shingles, hash_words, mix

SHINGLE = 5
#: Sets of fewer hashes than this go to all executors where they are looked up; more are shuffled.
BROADCAST = 4_000_000
#: Fingerprints a Python task remembers, to give each set once.
REMEMBERED = 1 << 20
#: First bits of a key by which a filter knows it, at most (16 MB) and at least; keys of a range, and bytes of a key that are shuffled to count it.
FILTER_BITS, LEAST_BITS, RANGE, PACKED = 27, 16, 2_000_000, 5
#: Sets of at least LARGE shingles are not compared if their SimHashes differ in more than FAR of 128 bits.
LARGE, FAR = 16, 48
#: Words of 64 bits, each of which tells whether a set has an odd number of the shingles dealt to it.
PARITIES = 8
_ODD = [f"odd{i}" for i in range(PARITIES)]
#: Sets of a bucket that are all compared if need be, and rounds of comparisons with hubs before, behind the one by SimHash.
CROWD, STARS = 64, 1
_LEAST = [1]
while _LEAST[-1] < 1 << 40:
    _LEAST.append(_LEAST[-1] * 5 // 4 + 1)
#: Shingles in which similar sets differ at most, by the class of the smaller one.
_DIFFER = [((u := n - 1) + u * 5 // 4) // 9 for n in _LEAST[1:]]


def _parts(grams: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each class of which a set gives keys: the class, how many parts there are, where its own parts begin, and which these are."""
    own = bisect_right(_LEAST, len(grams)) - 1
    for level in (own - 1, own):
        if level >= 0 and _DIFFER[level]:  # else similar sets of these sizes are equal
            n = _DIFFER[level] + _DIFFER[level] // 8 + 2
            part = ((grams >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            yield level, n, starts, part[starts]


def must_share(grams: np.ndarray) -> int:
    """How many keys at least the set shares with one that is similar and different; 0 where none can be."""
    return min((max(1, len(starts) - _DIFFER[level]) for level, _, starts, _ in _parts(grams)), default=0)


def part_keys(grams: np.ndarray) -> np.ndarray:
    """Keys of which two different sets share one at least if their similarity is 0.8 or more."""
    out = [np.empty(0, np.uint64)]
    for level, n, starts, parts in _parts(grams):
        sums = np.add.reduceat(grams, starts)
        if len(starts) <= _DIFFER[level]:  # the equal part may be one that is empty in both
            every = np.zeros(n, np.uint64)
            every[parts.astype(np.int64)] = sums
            sums, parts = every, np.arange(n, dtype=np.uint64)
        key = (sums ^ (sums >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + (parts + np.uint64(level << 40)) * np.uint64(0xC2B2AE3D27D4EB4F)
        out.append((key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    return np.concatenate(out)


def sketch(grams: np.ndarray) -> tuple[int, int]:
    """The set's SimHash of 128 bits, as two signed numbers."""
    ones = np.zeros(128, np.int64)
    for some in (grams[i : i + (1 << 16)] for i in range(0, len(grams), 1 << 16)):
        both = np.column_stack((some, mix(some * MIX)))
        ones += np.unpackbits(both.view(np.uint8), axis=1).sum(0, dtype=np.int64)
    return tuple(np.packbits(ones * 2 > len(grams)).view(np.int64).tolist())


def parities(grams: np.ndarray) -> np.ndarray:
    """PARITIES signed numbers; those of two sets differ in no more bits than the sets have shingles that the other lacks."""
    odd = np.bincount(((grams >> np.uint64(16)) & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def shingle_sets(texts: list[str | None], shingle: int = SHINGLE) -> list[np.ndarray]:
    """For each text, the sorted distinct hashes of its shingles (of all its words, if it has fewer than that)."""
    grams, sizes = hash_shingles(*hash_words(texts, SPACE), shingle)
    edges = np.concatenate(([0], np.cumsum(sizes))).tolist()
    return [np.unique(grams[a:b]) for a, b in zip(edges, edges[1:])]


def _lists(found: list[np.ndarray]) -> pa.Array:
    edges = np.concatenate(([0], np.cumsum([len(x) for x in found])))
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)))


class _Sets:
    """For a task: batches of texts as the fingerprints (hashes of sets) and sets of each, some at a time."""

    def __init__(self, shingle: int):
        self.shingle, self.seen = shingle, set()

    def of(self, texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        sets = shingle_sets(texts.to_pylist(), self.shingle)
        return np.array([xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64), sets

    def first(self, texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        """The same without sets that are empty or were given before (as far as they are remembered)."""
        fps, sets = self.of(texts)
        keep = []
        for k, (fp, s) in enumerate(zip(fps.tolist(), sets)):
            if len(s) and fp not in self.seen:
                keep.append(k)
                if len(self.seen) < REMEMBERED:
                    self.seen.add(fp)
        return fps[keep], [sets[k] for k in keep]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (hash of the set of shingles), size, must (must_share()), lo, hi (sketch()), odd0 and so on (parities()), for each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = _Sets(shingle)
        for b in _slices(batches):
            fps, sets = some.of(b.column(1))
            lo, hi = zip(*map(sketch, sets))
            sizes = [len(x) for x in sets]
            odd = [pa.array(x) for x in np.array([parities(x) for x in sets]).T]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps), pa.array(sizes, pa.int32()), pa.array(map(must_share, sets), pa.int32()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), *odd], ["doc_id", "fp", "size", "must", "lo", "hi", *_ODD])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long, size int, must int, lo long, hi long, " + ", ".join(f"{x} long" for x in _ODD))


def _ranges(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: its range (its first bits), and the next PACKED bytes."""
    return keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64), (keys >> np.uint64(64 - bits - 8 * PACKED)) & np.uint64((1 << 8 * PACKED) - 1)


def filter_bits(n_keys: int) -> int:
    """First bits of a key by which a filter of so many keys knows it: 16 to 32 values a key, up to FILTER_BITS."""
    return min(FILTER_BITS, max(LEAST_BITS, n_keys.bit_length() + 4))


def shared_bits(docs: DataFrame, n_keys: int, shingle: int = SHINGLE) -> np.ndarray:
    """A bit for each value of a key's first filter_bits() bits: whether keys like that are in more than one set.

    Keys are shuffled as PACKED bytes each, in ranges of some RANGE keys; those that a task has more than once go twice.
    What comes back of a range is its part of the bits, so the driver gets few bytes for few keys, and 2^FILTER_BITS bits however many
    there are. Keys that are alike in range and bytes, and copies of a set from two tasks, count as shared: that costs rows, but loses none."""
    bits, first = min(20, max(0, (n_keys // RANGE).bit_length())), filter_bits(n_keys)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held, n = _Sets(shingle), [], 0

        def give() -> pa.RecordBatch:
            keys = np.sort(np.concatenate([np.empty(0, np.uint64), *held]))
            third = np.zeros(len(keys), bool)
            third[2:] = keys[2:] == keys[:-2]
            where, low = _ranges(keys[~third], bits)
            body = low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PACKED]
            starts = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1]))) if len(where) else np.empty(0, np.int64)
            ends = np.append(starts[1:], len(where))
            return pa.RecordBatch.from_arrays([pa.array(where[starts].astype(np.int32)), pa.array([body[x:y].tobytes() for x, y in zip(starts, ends)], pa.binary())], ["range", "body"])

        for b in _slices(batches):
            found = [part_keys(x) for x in sets.first(b.column(0))[1]]
            held += found
            n += sum(map(len, found))
            if n > 2 * RANGE:
                yield give()
                held, n = [], 0
        yield give()

    def shared(key, table):
        body = np.frombuffer(b"".join(x.as_py() for x in table.column("body")), np.uint8).reshape(-1, PACKED)
        low = np.zeros((len(body), 8), np.uint8)
        low[:, :PACKED] = body
        low = np.sort(low.view("<u8").ravel())
        some = np.unique(low[1:][low[1:] == low[:-1]])
        out = np.zeros(1 << (first - bits), bool)
        out[(some >> np.uint64(8 * PACKED - first + bits)).astype(np.int64)] = True
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())], ["range", "bits"])

    dealt = docs.select("text").mapInArrow(deal, "range int, body binary")
    out = np.zeros(1 << (first - 3), np.uint8)
    size = len(out) >> bits
    for r in materialize(dealt.groupBy("range").applyInArrow(shared, "range int, bits binary"), "shared").toLocalIterator():
        out[r.range * size : (r.range + 1) * size] = np.frombuffer(r.bits, np.uint8)
    return out


def _dealt(docs: DataFrame, shared: np.ndarray, shingle: int) -> DataFrame:
    """key, fp: the part keys of each set that may be another's too; rows may repeat. given: the broadcast that its tasks read."""
    given, first = docs.sparkSession.sparkContext.broadcast(shared), (8 * len(shared)).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, bits = _Sets(shingle), given.value
        for b in _slices(batches):
            fps, found = sets.first(b.column(0))
            keys = [part_keys(x) for x in found]
            owner, every = np.repeat(fps, [len(x) for x in keys]), np.concatenate([np.empty(0, np.uint64), *keys])
            place = every >> np.uint64(64 - first)
            maybe = (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
            yield pa.RecordBatch.from_arrays([pa.array(every[maybe].view(np.int64)), pa.array(owner[maybe])], ["key", "fp"])

    out = docs.select("text").mapInArrow(run, "key long, fp long")
    out.given = given
    return out


def _own_sets(docs: DataFrame, pairs: DataFrame, n_pairs: int, shingle: int) -> DataFrame:
    """fp, grams: the sets that pairs (a, b) name, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(shingle)
        for b in _slices(batches):
            found, grams = sets.first(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(found), _lists(grams)], ["fp", "grams"])

    fps = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    few = 2 * n_pairs < BROADCAST
    every = docs.select("text").mapInArrow(run, "fp long, grams array<long>")
    return materialize(every.join(F.broadcast(fps) if few else fps, "fp", "left_semi").dropDuplicates(["fp"]), "own_sets")


#: Whether sets p and q (size, lo, hi, parities) may be similar.
MAY = f"9 * ({' + '.join(f'bit_count(p.{x} ^ q.{x})' for x in _ODD)}) <= p.size + q.size AND 5 * least(p.size, q.size) >= 4 * greatest(p.size, q.size) AND (least(p.size, q.size) < {LARGE} OR bit_count(p.lo ^ q.lo) + bit_count(p.hi ^ q.hi) <= {FAR})"


def _maybe(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Those of the pairs a, b whose sizes, sketches and parities allow a similarity of 0.8; a table."""
    both = pairs.join(known.alias("p"), F.col("a") == F.col("p.fp")).join(known.alias("q"), F.col("b") == F.col("q.fp"))
    return materialize(both.filter(MAY).select("a", "b"), "candidates")


def _similar(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """Those of the pairs a, b (hashes of sets) whose similarity is 0.8 or more; a table."""
    met = pairs.join(own.select(F.col("fp").alias("a"), F.col("grams").alias("x")), "a").join(own.select(F.col("fp").alias("b"), F.col("grams").alias("y")), "b")
    return materialize(met.filter("9 * size(array_intersect(x, y)) >= 4 * (size(x) + size(y))").select("a", "b"), "similar")


def _split(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of the rows (key, fp, ...) whose buckets are not all connected, with their root; a table."""
    named = materialize(rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named")
    keys = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
    out = materialize(named.join(materialize(keys, "split"), "key").select(*rows.columns, "root"), "split")
    drop(named)
    return out


def _meet(rows: DataFrame, where: str) -> DataFrame:
    """a, b: pairs of rows (fp, root, size, lo, hi, parities) that are not connected and may be similar, where the condition on p and q holds."""
    met = rows.alias("p").join(rows.alias("q"), F.expr(f"{where} AND p.root > q.root AND {MAY}"))
    return met.select(F.col("p.fp").alias("a"), F.col("q.fp").alias("b"))


def by_simhash(known: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """a, b: pairs of sets (fp) whose 64-bit SimHashes (lo) are linked by operator 2's blocks: those at `bits` or fewer bits, or enough
    of them to connect all of these. A value of several sets stands for the least one, to which the others are paired."""
    sets = known.filter("size > 0")
    values = materialize(sets.groupBy("lo").agg(F.min("fp").alias("first"), F.count(F.lit(1)).alias("n")), "values")
    same = sets.join(values.filter("n > 1"), "lo").filter("fp <> first").select(F.col("first").alias("a"), F.col("fp").alias("b"))
    ends = [values.select(F.col("lo").alias(n), F.col("first").alias(f"first_{n}")) for n in ("a", "b")]
    close = near_values(values.select(F.col("lo").alias("fp")), bits).join(ends[0], "a").join(ends[1], "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    return same.unionByName(close)


def _in_crowds(docs: DataFrame, known: DataFrame, shared: DataFrame, roots: DataFrame, shingle: int) -> tuple[DataFrame, list[DataFrame]]:
    """a, b: pairs to verify from buckets (shared: key, fp, n, hub) of more than CROWD sets; the tables that this reads."""
    # Sets that crowded buckets can't be spared for: they may have no smaller one in common with their like.
    crowded = shared.filter(F.col("n") > CROWD).groupBy("fp").agg(F.count(F.lit(1)).alias("keys"))
    stuck = materialize(crowded.join(known, "fp").filter("keys >= must").select("fp"), "stuck")
    # The hub of a hub's hub, and so on: one that the buckets of a crowd have in common. Any set would do.
    top = materialize(shared.groupBy("fp").agg(F.max("hub").alias("hub")).select("fp", F.col("hub.fp").alias("top")), "top")
    for _ in range(2):
        top = materialize(top.join(top.select(F.col("fp").alias("top"), F.col("top").alias("next")), "top").select("fp", F.col("next").alias("top")), "top")
    crowd = shared.filter(F.col("n") > CROWD).join(stuck, "fp", "left_semi").select("key", "fp", F.col("hub.fp").alias("bucket_hub"))
    crowd = crowd.join(top.select(F.col("fp").alias("bucket_hub"), F.col("top").alias("hub")), "bucket_hub").select("key", "fp", "hub")
    crowd = materialize(crowd, "crowd")
    same = components(crowd.groupBy("fp").agg(F.min("hub").alias("a"), F.max("hub").alias("b")))
    crowd = materialize(crowd.join(materialize(same, "same").withColumnRenamed("node", "hub"), "hub", "left").withColumn("root", F.coalesce("root", "hub")), "crowd")
    used = crowd.groupBy("root", "hub").agg(F.count(F.lit(1)).alias("uses")).groupBy("root").agg(F.max(F.struct("uses", "hub")).alias("most"))
    crowd = crowd.join(materialize(used.select("root", F.col("most.hub").alias("main")), "main"), "root").select("key", "fp", F.col("main").alias("hub"))
    crowd = _split(crowd, roots)
    # Two sets of a crowded bucket have new shingles in common, that a hub lacks, or differ in all of both's new ones.
    of_hub = materialize(crowd.select("fp", "hub").distinct(), "of_hub")
    own = _own_sets(docs, of_hub.select(F.col("fp").alias("a"), F.col("hub").alias("b")), of_hub.count(), shingle)
    both = of_hub.join(own.withColumnRenamed("grams", "x"), "fp").join(own.select(F.col("fp").alias("hub"), F.col("grams").alias("y")), "hub")
    new = F.sort_array(F.array_except("x", "y"))
    deltas = both.select("fp", "hub", new.alias("new"), F.size(F.array_except("y", "x")).alias("n_gone")).join(known, "fp").withColumn("n_new", F.size("new"))
    deltas = materialize(deltas.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "deltas")
    drop(own)
    crowd = materialize(crowd.select("key", "fp", "hub").join(deltas.drop("new"), ["fp", "hub"]), "crowd")
    # As many new shingles of a set as similar ones may lack, and one more.
    few = F.slice("new", F.lit(1), F.expr("least(n_new, cast(size / 4 as int) + 1)"))
    news = materialize(deltas.select("hub", F.explode(few).alias("key"), "fp", "root", "size", "lo", "hi", *_ODD), "news")
    apart = "9 * (p.n_new + q.n_new + abs(p.n_gone - q.n_gone)) <= p.size + q.size"
    pairs = _meet(crowd, f"p.key = q.key AND {apart}").unionByName(_meet(news, "p.hub = q.hub AND p.key = q.key"))
    return pairs, [crowd, news, deltas]


def links(docs: DataFrame, known: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """a, b: links enough to connect all different sets of docs' texts (by their hashes) of a similarity of 0.8 or more.

    known: fp, size, must, lo, hi, parities, a row for each set. Texts are never written: their sets are hashed anew where they are
    needed, and what is shuffled is a few bytes of each key, to find those that several sets may share, and then those keys."""

    def verified(pairs: DataFrame) -> DataFrame:
        n = pairs.count()
        if not n:
            return pairs
        own = _own_sets(docs, pairs, n, shingle)
        some = _similar(pairs, own)
        drop(own)
        return some

    found = verified(_maybe(by_simhash(known), known))
    roots = materialize(components(found), "roots")
    shingles = known.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    dealt = _dealt(docs, shared_bits(docs, shingles // 2, shingle), shingle)
    rows = materialize(dealt, "rows")
    dealt.given.destroy()
    of = rows.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"), F.count(F.lit(1)).alias("n")).filter("low < high")
    shared = materialize(rows.join(materialize(of.select("key", "n"), "sizes"), "key"), "buckets")
    drop(rows)
    score = materialize(shared.groupBy("fp").agg(F.sum("n").alias("score")), "scores")
    scored = materialize(shared.join(score, "fp"), "scored")
    hubs = materialize(scored.groupBy("key").agg(F.max(F.struct("score", "fp")).alias("hub")), "hubs")
    drop(shared)
    shared = materialize(scored.join(hubs, "key").select("key", "fp", "n", "hub"), "buckets")
    drop(scored)
    for _ in range(STARS):
        # One pair a set: with the first hub that it is not connected to.
        ends = [roots.select(F.col("node").alias(n), F.col("root").alias(f"root_{n}")) for n in ("fp", "hub_fp")]
        named = shared.withColumn("hub_fp", F.col("hub.fp")).filter("fp <> hub_fp").join(ends[0], "fp", "left").join(ends[1], "hub_fp", "left")
        named = named.filter(F.coalesce("root_fp", "fp") != F.coalesce("root_hub_fp", "hub_fp"))
        star = named.groupBy("fp").agg(F.max("hub").alias("hub")).select(F.least("hub.fp", "fp").alias("a"), F.greatest("hub.fp", "fp").alias("b"))
        found = materialize(found.unionByName(verified(_maybe(star.distinct(), known))), "found")
        roots = materialize(components(found), "roots")
    calm = _split(shared.filter(F.col("n") <= CROWD).select("key", "fp"), roots).join(known, "fp")
    rest, left = _meet(calm, "p.key = q.key"), []
    if shared.filter(F.col("n") > CROWD).take(1):
        pairs, left = _in_crowds(docs, known, shared, roots, shingle)
        rest = rest.unionByName(pairs)
    rest = materialize(rest.distinct(), "rest")
    drop(shared, *left)
    if rest.take(1):
        found = materialize(found.unionByName(verified(rest)), "linked")
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (long), component_id (least doc_id that links reach), for each row of docs.

    Documents link if their shingle sets are equal or similar (0.8 or more). Null and blank texts have the empty set
    and link to one another. Repeated rows stay; a null doc_id is linked but names no component unless all of one are null."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    known = materialize(rows.select("fp", "size", "must", "lo", "hi", *_ODD).dropDuplicates(["fp"]), "known")
    return name_components(rows, links(docs, known, shingle))
