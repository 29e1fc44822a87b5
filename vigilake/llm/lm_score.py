"""LM scoring (operator 9): masked pseudo-likelihood from a bidirectional window network in numpy.

The network predicts a word from SIDE words on its left and SIDE on its right: their embeddings, by position,
pass one tanh layer; the output is factored, P(word) = P(class) * P(word | class), so a word costs two small
softmaxes instead of one over the vocabulary. Words beyond the vocabulary share ids by a hash; each has its own
share of its id, P(word | id), from the complete table of counts, which is joined and never held in one place. Words
that the table lacks have part of a share that is kept for them. A document's score is the sum of the conditional
log-probabilities of all its words, each masked in turn.

Everything is taken from the whole corpus: words are counted over all documents, and every position of every
document is a training target once. A word is its 64-bit hash, and a document
its ids (two bytes each). Equal texts are counted first, then dealt to logical parts of about PART_WORDS words by
their content, so that neither the input's files nor its partitions decide anything, and one text that holds a third
of all rows spreads over all parts. Training is data-parallel: the parts form rounds; each part of a round starts from
the same weights and goes over its own windows, and the weights are averaged by windows seen. More data makes more
parts and more rounds. Sums run in the executors, FAN_IN parts at a time; the driver gets one set of weights.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.llm.common import drop, materialize
from vigilake.llm.word_hash import hash_words

SIDE, DIM, HIDDEN = 2, 16, 32
CLASSES, MEMBERS = 64, 64
#: The last RARE_CLASSES classes hold words beyond the vocabulary, by a hash.
RARE_CLASSES = 8
BATCH, RATE = 8192, 0.08
#: Words of a logical part of the training data, on average.
PART_WORDS = 1 << 22
#: Parts that are summed up in one task, and weights of a part that are summed up together.
FAN_IN, SLICE = 64, 1 << 14
#: Words of a chunk, which is in memory as arrays, and its slices of 200 documents.
CHUNK_WORDS, CHUNK_SLICES = 1 << 19, 50
WORD = re.compile(r"\w+")
KNOWN = (CLASSES - RARE_CLASSES) * MEMBERS
RARE = RARE_CLASSES * MEMBERS
PAD = CLASSES * MEMBERS


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Vocabulary:
    """Hashes of the KNOWN most frequent words (their ids are their ranks), all others' ids by their hash.

    counts: by id. shares: word (hash), share (ln P(word | id)) of all counted words that aren't listed; unseen: that of
    any other word, by id from KNOWN on."""

    def __init__(self, listed: np.ndarray):
        self.order = np.argsort(listed, kind="stable")
        self.listed = listed[self.order]
        self.counts, self.unseen = np.zeros(PAD), np.zeros(RARE)
        self.shares: DataFrame | None = None

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        out = (KNOWN + hashes % np.uint64(RARE)).astype(np.uint16)
        if len(self.listed):
            at = np.minimum(np.searchsorted(self.listed, hashes), len(self.listed) - 1)
            own = self.listed[at] == hashes
            out[own] = self.order[at[own]]
        return out


class Network:
    """Weights and both passes. Parameters: e embeddings, w and b of the hidden layer, c of the classes, m of their members; the last
    column of c and m is a bias. Weights of c and m keep within BOUND and biases within BIAS, so exp() of a logit is finite."""

    SHAPES = {"e": (PAD + 1, DIM), "w": (2 * SIDE * DIM, HIDDEN), "b": (HIDDEN,), "c": (CLASSES, HIDDEN + 1), "m": (CLASSES, MEMBERS, HIDDEN + 1)}
    BOUND, BIAS = 1.5, 30

    def __init__(self, weights: dict[str, np.ndarray]):
        self.p = weights

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 9) -> Network:
        """Random weights; the output biases hold each id's frequency (counts: by id)."""
        r = np.random.Generator(np.random.PCG64(seed))
        by = (counts + 1.0).reshape(CLASSES, MEMBERS)
        share = by.sum(1)
        p = {k: np.zeros(s, np.float32) for k, s in cls.SHAPES.items()}
        for k in "ew":
            p[k] = (r.standard_normal(cls.SHAPES[k]) * 0.1).astype(np.float32)
        p["c"][:, -1], p["m"][:, :, -1] = np.log(share / share.sum()), np.log(by / share[:, None])
        return cls(p)

    @classmethod
    def of_flat(cls, flat: np.ndarray) -> Network:
        cuts = np.cumsum([np.prod(s) for s in cls.SHAPES.values()])[:-1]
        return cls({k: x.reshape(s).astype(np.float32) for (k, s), x in zip(cls.SHAPES.items(), np.split(flat, cuts))})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.SHAPES])

    def _forward(self, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings, a row for each context, and the hidden layer and a 1, a column for each: numpy sums up columns faster than short rows."""
        x = self.p["e"].take(ctx.ravel(), 0).reshape(len(ctx), -1)
        h = np.ones((HIDDEN + 1, len(ctx)), np.float32)
        np.tanh(self.p["w"].T @ x.T + self.p["b"][:, None], out=h[:-1])
        return x, h

    @staticmethod
    def _by_class(target: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
        """An order by class, where each class begins, and in that order the classes and members."""
        kind = (target // MEMBERS).astype(np.uint8)
        order = np.argsort(kind, kind="stable")  # by radix
        kind, member = kind[order].astype(np.intp), (target % MEMBERS)[order].astype(np.intp)
        return order, np.searchsorted(kind, np.arange(CLASSES + 1)).tolist(), kind, member

    def log_probs(self, ctx: np.ndarray, target: np.ndarray) -> np.ndarray:
        """ln P(target | context), for rows of contexts (2 * SIDE ids each)."""
        p = self.p
        order, edges, kind, member = self._by_class(target)
        h, every = self._forward(ctx[order])[1], np.arange(len(target))
        z = p["c"] @ h
        np.exp(z, out=z)
        prob, total = z[kind, every], np.add.reduce(z, 0)
        for k in range(CLASSES):
            a, b = edges[k], edges[k + 1]
            if a < b:
                z = p["m"][k] @ h[:, a:b]
                np.exp(z, out=z)
                prob[a:b] *= z[member[a:b], every[: b - a]]
                total[a:b] *= np.add.reduce(z, 0)
        out = np.empty_like(prob)
        out[order] = np.log(prob / total)
        return out

    def train(self, ctx: np.ndarray, target: np.ndarray, weight: np.ndarray, square: dict[str, np.ndarray]) -> None:
        """One step of Adagrad; weight: of each window; square holds the sums of squared gradients."""
        p = self.p
        order, edges, kind, member = self._by_class(target)
        ctx, every = ctx[order], np.arange(len(target))
        share = (weight[order] / weight.sum()).astype(np.float32)
        x, h = self._forward(ctx)
        g = p["c"] @ h
        np.exp(g, out=g)
        g *= share / np.add.reduce(g, 0)
        g[kind, every] -= share
        grad = {"c": g @ h.T, "m": np.zeros_like(p["m"])}
        dh = p["c"][:, :-1].T @ g
        for k in range(CLASSES):
            a, b = edges[k], edges[k + 1]
            if a < b:
                own, of = h[:, a:b], share[a:b]
                g = p["m"][k] @ own
                np.exp(g, out=g)
                g *= of / np.add.reduce(g, 0)
                g[member[a:b], every[: b - a]] -= of
                dh[:, a:b] += p["m"][k, :, :-1].T @ g
                np.matmul(g, own.T, out=grad["m"][k])
        dh *= 1 - h[:-1] * h[:-1]
        grad |= {"w": x.T @ dh.T, "b": dh.sum(1)}
        dx, at = (p["w"] @ dh).reshape(2 * SIDE, DIM, -1), ctx.T
        grad["e"] = np.stack([sum(np.bincount(i, v[d], PAD + 1) for i, v in zip(at, dx)) for d in range(DIM)], 1).astype(np.float32)
        for name, value in grad.items():
            s = square[name]
            s += value * value
            value *= RATE
            value /= np.sqrt(s) + np.float32(1e-6)
            p[name] -= value
        for name in "cm":
            np.clip(p[name][..., :-1], -self.BOUND, self.BOUND, out=p[name][..., :-1])
            np.clip(p[name][..., -1], -self.BIAS, self.BIAS, out=p[name][..., -1])


def _windows(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Contexts of the positions `at` of padded ids."""
    return np.stack([flat[at + k] for k in (*range(-SIDE, 0), *range(1, SIDE + 1))], axis=1)


def _bytes(x: np.ndarray, sizes: list[int]) -> pa.Array:
    """Consecutive pieces of x, `sizes` items each, as binary values."""
    edges = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))) * x.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())


def _padded(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded ids of consecutive sequences, the positions of words in them, and the sequence of each."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) + SIDE * (of + 1)
    out = np.full(len(flat) + SIDE * (len(sizes) + 1), PAD, np.uint16)
    out[at] = flat
    return out, at, of


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word (hash), n: how often each word stands in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out() -> pa.RecordBatch:
            word, times = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(times)], ["word", "n"])

        for b in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            held.append(hash_words(b.column(0).to_pylist())[0])
            n += len(held[-1])
            if n > 2 * CHUNK_WORDS:
                yield out()
                n = 0
        yield out()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _rare_index() -> Column:
    """The id of a word (by its hash) beyond the vocabulary, less KNOWN; RARE is a power of two."""
    return F.col("word").bitwiseAND(RARE - 1).cast("int")


def vocabulary(counted: DataFrame) -> Vocabulary:
    """The vocabulary of a table of counts. Words of equal counts go by their hash.

    An id's rare words count once more in all than they stand: that once goes to words not seen, of which there may be
    as many as seen ones and one."""
    top = counted.orderBy(F.desc("n"), "word").limit(KNOWN).collect()
    vocab = Vocabulary(np.array([r.word for r in top], np.int64).view(np.uint64))
    vocab.counts[: len(top)] = [r.n for r in top]
    last = (top[-1].n, top[-1].word) if len(top) == KNOWN else (0, 0)
    rare = counted.filter((F.col("n") < last[0]) | ((F.col("n") == last[0]) & (F.col("word") > last[1]))).withColumn("id", _rare_index())
    words = np.zeros(RARE)
    for r in rare.groupBy("id").agg(F.sum("n").alias("of"), F.count(F.lit(1)).alias("words")).collect():
        vocab.counts[KNOWN + r.id], words[r.id] = r.of, r.words
    vocab.unseen = -np.log((vocab.counts[KNOWN:] + 1) * (words + 1))
    of = F.get(F.array(*[F.lit(float(x)) for x in vocab.counts[KNOWN:]]), F.col("id"))
    vocab.shares = rare.select("word", F.log(F.col("n") / (of + 1)).alias("share"))
    return vocab


def encode(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each chunk of documents: chunk (its number), doc_ids, sizes (words of each), ids (binary, two bytes a word), rare (the
    distinct words beyond the vocabulary) and rare_at (binary, four bytes for each occurrence of one, in order: its place in rare)."""
    given = docs.sparkSession.sparkContext.broadcast((vocab.listed, vocab.order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocab, number = Vocabulary(np.empty(0, np.uint64)), TaskContext.get().partitionId() << 32
        vocab.listed, vocab.order = given.value
        docs, held, counts, n = [], [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal number
            number += 1
            flat = np.concatenate(held)
            ids = vocab.ids(flat)
            rare, at = np.unique(flat[ids >= KNOWN], return_inverse=True)
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            row = [pa.array([number]), one(pa.concat_arrays(docs)), one(pa.array(np.concatenate(counts))), pa.array([ids.tobytes()], pa.binary()), one(pa.array(rare.view(np.int64))), pa.array([at.astype(np.uint32).tobytes()], pa.binary())]
            for x in (docs, held, counts):
                x.clear()
            return pa.RecordBatch.from_arrays(row, ["chunk", "doc_ids", "sizes", "ids", "rare", "rare_at"])

        for b in (b.slice(at, 200) for b in batches for at in range(0, b.num_rows, 200)):
            words, sizes = hash_words(b.column(1).to_pylist())
            docs.append(b.column(0))
            held.append(words)
            counts.append(sizes)
            n += len(words)
            if n >= CHUNK_WORDS or len(held) >= CHUNK_SLICES:
                yield out()
                n = 0
        if held:
            yield out()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"chunk long, doc_ids array<{kind}>, sizes array<long>, ids binary, rare array<long>, rare_at binary")


def _texts(encoded: DataFrame) -> DataFrame:
    """ids (binary) of each document that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sizes, ids in zip(b.column(0), b.column(1)):
                sizes = sizes.values.to_numpy()
                yield pa.RecordBatch.from_arrays([_bytes(np.frombuffer(ids.as_py(), np.uint16), sizes[sizes > 0].tolist())], ["ids"])

    return encoded.select("sizes", "ids").mapInArrow(run, "ids binary")


def _average(trained: DataFrame, parts: int) -> np.ndarray | None:
    """The weights of all parts, averaged by windows seen: a tree of sums, FAN_IN parts each."""

    def add(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        sums = np.zeros(len(t.column("sums")[0].as_py()) // 8)
        for x in t.column("sums"):
            sums += np.frombuffer(x.as_py())
        return pa.table({"slice": t.column("slice").slice(0, 1), "part": pa.array([t.column("part")[0].as_py() // FAN_IN], pa.int64()), "seen": pa.array([sum(t.column("seen").to_pylist())], pa.float64()), "sums": pa.array([sums.tobytes()], pa.binary())})

    while parts > 1:
        trained = trained.groupBy("slice", F.floor(F.col("part") / FAN_IN)).applyInArrow(add, "slice int, part long, seen double, sums binary")
        parts = -(-parts // FAN_IN)
    rows = sorted(trained.collect(), key=lambda r: r.slice)
    return np.concatenate([np.frombuffer(r.sums) / r.seen for r in rows]) if rows else None


def _trainer(given: Broadcast, seed: int, rounds: int) -> Callable[[pa.Table], pa.Table]:
    """Trains the given weights on the texts (ids, weight) of one part; gives them in slices, times the windows seen."""

    def run(t: pa.Table) -> pa.Table:
        part, t = t.column("part")[0].as_py(), t.sort_by("ids")
        net = Network.of_flat(given.value)
        square = {k: np.zeros_like(v) for k, v in net.p.items()}
        rng, seen, held, ready = np.random.Generator(np.random.PCG64([seed, part])), 0.0, [], 0
        t = t.take(rng.permutation(t.num_rows))

        def steps(to_end: bool) -> None:
            x, y, w = (np.concatenate(c) for c in zip(*held))
            order = rng.permutation(len(y))
            end = len(y) if to_end else len(y) // BATCH * BATCH
            for i in range(0, end, BATCH):
                own = order[i : i + BATCH]
                net.train(x[own], y[own], w[own], square)
            held[:] = [(x[order[end:]], y[order[end:]], w[order[end:]])]

        texts, weights = t.column("ids").to_pylist(), t.column("weight").to_numpy()
        sizes = np.array([len(x) // 2 for x in texts])
        edges = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum(), CHUNK_WORDS), "right").tolist() + [len(texts)]
        for first, end in zip(edges, edges[1:]):
            if first == end:
                continue
            flat, at, of = _padded(np.frombuffer(b"".join(texts[first:end]), np.uint16), sizes[first:end])
            w = weights[first + of]
            held.append((_windows(flat, at), flat[at], w))
            seen += float(w.sum())
            ready += len(at)
            if ready >= 16 * BATCH:
                steps(False)
                ready = len(held[0][1])
        steps(True)
        sums = net.flat().astype(np.float64) * seen
        cut = [sums[i : i + SLICE].tobytes() for i in range(0, len(sums), SLICE)]
        return pa.table({"slice": pa.array(range(len(cut)), pa.int32()), "part": pa.array([part // rounds] * len(cut), pa.int64()), "seen": pa.array([seen] * len(cut), pa.float64()), "sums": pa.array(cut, pa.binary())})

    return run


def fit(encoded: DataFrame, counts: np.ndarray, seed: int = 9, part_words: int = PART_WORDS) -> Network:
    """The network, trained on every position of the encoded documents. Without words: the starting weights."""
    spark, net = encoded.sparkSession, Network.start(counts, seed)
    parts = max(1, -(-int(counts.sum()) // part_words))
    rounds = max(1, parts.bit_length() - 2)
    # Copies of a text go to parts in turn; a text of more copies than parts stands once in each, with their number.
    texts = _texts(encoded).groupBy("ids").agg(F.count(F.lit(1)).alias("copies"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.least("copies", F.lit(parts).cast("long")) - 1))
    dealt = texts.select("ids", "copies", each.alias("k")).select("ids", F.pmod(F.pmod(F.xxhash64(F.lit(seed), "ids"), F.lit(parts)) + F.col("k"), F.lit(parts)).alias("part"), F.expr(f"cast(copies div {parts} + int(k < copies % {parts}) as double)").alias("weight"))
    dealt = materialize(dealt.withColumn("turn", F.pmod("part", F.lit(rounds)).cast("int")), "dealt")
    for turn in range(rounds):
        own = dealt.filter(F.col("turn") == turn).select("ids", "part", "weight")
        trained = own.groupBy("part").applyInArrow(_trainer(spark.sparkContext.broadcast(net.flat()), seed, rounds), "slice int, part long, seen double, sums binary")
        if (flat := _average(trained, -(-parts // rounds))) is not None:
            net = Network.of_flat(flat)
    drop(dealt)
    return net


def score_ids(encoded: DataFrame, vocab: Vocabulary, net: Network) -> DataFrame:
    """doc_id, n_words (long), log_prob (double), mean_log_prob, for each document of an encoded table, which must be written: a
    chunk's number is that of one run. A word's share is looked up once for each chunk that has it."""
    given = encoded.sparkSession.sparkContext.broadcast(net.flat())
    rare = encoded.select("chunk", F.posexplode("rare").alias("at", "word"))
    unseen = F.get(F.array(*[F.lit(float(x)) for x in vocab.unseen]), _rare_index())
    found = rare.join(vocab.shares, "word", "left").select("chunk", F.struct("at", F.coalesce("share", unseen).alias("share")).alias("s"))
    shares = materialize(found.groupBy("chunk").agg(F.transform(F.sort_array(F.collect_list("s")), lambda x: x["share"]).alias("shares")), "shares")
    kind = encoded.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.of_flat(given.value)
        for docs, sizes, ids, rare_at, shares in (x for b in batches for x in zip(*b.columns)):
            sizes, ids, docs = sizes.values.to_numpy(), np.frombuffer(ids.as_py(), np.uint16), docs.values
            flat, at, of = _padded(ids, sizes)
            lp = np.concatenate([np.empty(0), *[net.log_probs(_windows(flat, own), flat[own]) for own in (at[i : i + (1 << 14)] for i in range(0, len(at), 1 << 14))]])
            if shares.is_valid:
                lp[ids >= KNOWN] += shares.values.to_numpy()[np.frombuffer(rare_at.as_py(), np.uint32)]
            total, n = np.bincount(of, lp, len(sizes)).astype(float), sizes.astype(np.int64)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([docs, pa.array(n), pa.array(total), mean], ["doc_id", "n_words", "log_prob", "mean_log_prob"])

    both = encoded.join(shares, "chunk", "left").select("doc_ids", "sizes", "ids", "rare_at", "shares")
    return both.mapInArrow(run, f"doc_id {kind.simpleString()}, n_words long, log_prob double, mean_log_prob double")


def train(docs: DataFrame, text_col: str = "text", seed: int = 9, part_words: int = PART_WORDS) -> tuple[Vocabulary, Network]:
    """The vocabulary (of fixed size; the other words' shares in a table) and the network; all documents take part."""
    docs = docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text"))
    vocab = vocabulary(materialize(count_words(docs), "words"))
    return vocab, fit(encode(docs, vocab), vocab.counts, seed, part_words)


def score(docs: DataFrame, vocab: Vocabulary, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words (long), log_prob (double, the sum), mean_log_prob (null without words), for each row of docs.

    Null and empty texts have no words and log_prob 0. Repeated rows and null ids stay; other columns are left out."""
    return score_ids(materialize(encode(docs, vocab, id_col, text_col), "encoded"), vocab, net)


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 9, part_words: int = PART_WORDS) -> DataFrame:
    """score() of docs by what train() learns from them; their ids are found once.

    The same rows give the same scores, up to the rounding of float sums, in whatever files and partitions they come."""
    vocab = vocabulary(materialize(count_words(docs, text_col), "words"))
    encoded = materialize(encode(docs, vocab, id_col, text_col), "encoded")
    return score_ids(encoded, vocab, fit(encoded, vocab.counts, seed, part_words))
