"""Token counts (operator 6): pieces are counted once for each distinct pre-token.

BPE never merges across a boundary that no vocabulary piece spans. For the tokenizer's pieces those are the
places before a run of spaces and on both sides of a line end; a text's count is the sum over the pre-tokens
between them. A map over blocks of documents gives each block's distinct pre-tokens with their frequencies
in its documents, dealt over buckets by a hash of the pre-token. In a bucket each distinct pre-token is
counted once, however many blocks have it, and meets its frequencies; what leaves the bucket is one partial
sum for each document. No ids are kept, and a frequent pre-token is one row for each block, not one for each
document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text that a block holds, in characters, besides its last document.
BLOCK_CHARS = 8 << 20
#: Spaces with the word after them, a line end, or spaces before one or at the end of the text.
PRETOKEN = re.compile(" *[^ \\n]+|\\n| +")
#: Distinct pre-tokens whose counts a bucket remembers.
REMEMBERED = 4_000_000
#: Texts that are counted whole and in pre-tokens, before a model is used.
JOINS = ("the end of the day", "  two  spaces ", "a line\nand\n\nanother\n", " \n \n", "x=1, y(2).", "É è 中文 🙂", "▁ sign▁x", "a\tb \r\n c")
_IPC = pa.ipc.IpcWriteOptions(compression="zstd")


def pretokens(text: str) -> list[str]:
    """A text's pre-tokens; the model itself puts a space before each text and writes spaces as U+2581."""
    return PRETOKEN.findall(" " + text.replace("▁", " ")) if text else []


#: A piece with spaces behind something else, or with a line end and something else.
SPANS = re.compile("[^▁]▁|\n.|.\n", re.S)


def spanning_pieces(model: str) -> list[str]:
    """Pieces of the vocabulary that could join what pretokens() cuts apart."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    return [p for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) and SPANS.search(p := sp.id_to_piece(i))]


def piece_counter(model: str):
    """A function that gives the piece counts of a list of pre-tokens."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    lead = len(sp.encode("\n"))  # the space that is put before, and the line end, which joins nothing

    def count(found: list[str]) -> list[int]:
        return [len(x) - lead for x in sp.encode(["\n" + x for x in found], num_threads=1)]

    return count


def whole_counter(model: str):
    """A function that gives the piece count of a whole text."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    return lambda text: len(sp.encode(text))


def _pack(**columns: object) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array([v]) if not isinstance(v, pa.Array) else pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in columns.values()], list(columns))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=_IPC) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpack(data: bytes) -> dict[str, pa.Array]:
    batch = pa.ipc.open_stream(data).read_next_batch()
    return {n: batch.column(n).values for n in batch.schema.names}


def _block(ids: pa.Array, texts: list[str], buckets: int) -> Iterator[tuple[int, bytes, bytes | None]]:
    """(bucket, head, body) rows of one block; the one without a body stands for the block's documents."""
    from xxhash import xxh32_intdigest

    found = [pretokens(t) for t in texts]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = [x for f in found for x in f]
    found.clear()
    # Python's own hash, as texts may hold NUL characters, which C strings end at.
    index = {x: i for i, x in enumerate(dict.fromkeys(flat))}
    codes, distinct = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat)), np.array([*index, None], object)[:-1]
    del flat
    yield -1, _pack(ids=ids, n_bytes=pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())), None
    pairs, freq = np.unique(codes * len(texts) + np.repeat(np.arange(len(texts)), sizes), return_counts=True)
    code, doc = np.divmod(pairs, len(texts))
    bucket = np.fromiter((xxh32_intdigest(x) % buckets for x in distinct), np.int64, len(distinct))
    by = np.argsort(bucket, kind="stable")
    start, rows = np.searchsorted(code, np.arange(len(distinct) + 1)), np.bincount(code, minlength=len(distinct))
    edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
    for b in range(buckets):
        if edges[b] == edges[b + 1]:
            continue
        own = by[edges[b] : edges[b + 1]]
        at = np.repeat(start[own] - np.concatenate(([0], np.cumsum(rows[own])[:-1])), rows[own]) + np.arange(rows[own].sum())
        yield b, b"", _pack(tokens=pa.array(distinct[own], pa.string()), rows=pa.array(rows[own].astype(np.uint32)), docs=pa.array(doc[at].astype(np.uint32)), freq=pa.array(freq[at].astype(np.uint32)))


def token_counts(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """doc_id, n_bytes (UTF-8, long), n_tokens (long), over_limit (n_tokens > limit), for each row of docs.

    Null and empty texts have no bytes and no tokens. Repeated rows and null ids stay as they are; other columns
    are left out. A block holds BLOCK_CHARS characters of text and one document more, so memory follows the
    longest text. A bucket remembers the counts of REMEMBERED of its distinct pre-tokens; past that it begins anew, so memory
    is bounded, and a pre-token is counted again if it comes back: give more buckets to larger vocabularies (by default,
    the session's shuffle partitions). A model is refused if its vocabulary has a piece that spans pre-tokens, or if it treats
    white space otherwise, by JOINS, than pretokens() does."""
    spark, whole, parts = docs.sparkSession, whole_counter(model), piece_counter(model)
    if spanning_pieces(model) or any(whole(t) != sum(parts(pretokens(t))) for t in JOINS):
        raise ValueError(f"{model} has pieces that span spaces or line ends, so its counts are no sums over pre-tokens")
    n_buckets = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = docs.schema[id_col].dataType

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for b in batches:
            texts, at = [x or "" for x in b.column(1).to_pylist()], 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and chars < BLOCK_CHARS:
                    chars += len(texts[end])
                    end += 1
                block = part << 32 | number
                number += 1
                out = [(block % n_buckets if x < 0 else x, block, h, d) for x, h, d in _block(b.column(0).slice(at, end - at), texts[at:end], n_buckets)]
                at = end
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "block", "head", "body"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = piece_counter(model), {}
        for b in batches:
            sums = []
            for body in b.column(2).to_pylist():
                if body is None:
                    sums.append(None)
                    continue
                x = _unpack(body)
                tokens = x["tokens"].to_pylist()
                if len(known) > REMEMBERED:
                    known.clear()
                new = [t for t in tokens if t not in known]
                known.update(zip(new, counter(new)))
                n = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
                docs, freq = x["docs"].to_numpy(), x["freq"].to_numpy()
                total = np.bincount(docs, np.repeat(n, x["rows"].to_numpy()) * freq)  # exact up to 2^53
                has = np.flatnonzero(total)
                sums.append(_pack(docs=pa.array(has.astype(np.uint32)), n=pa.array(total[has].astype(np.int64))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sums, pa.binary())], ["block", "head", "sums"])

    def add(t: pa.Table) -> pa.Table:
        heads, sums = t.column("head").to_pylist(), t.column("sums").to_pylist()
        x = _unpack(next(h for h, s in zip(heads, sums) if s is None))
        total = np.zeros(len(x["ids"]), np.int64)
        for s in sums:
            if s is not None:
                part = _unpack(s)
                total[part["docs"].to_numpy()] += part["n"].to_numpy()
        return pa.table({"doc_id": x["ids"], "n_bytes": x["n_bytes"], "n_tokens": pa.array(total), "over_limit": pa.array(total > limit)})

    dealt = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(deal, "bucket int, block long, head binary, body binary")
    summed = dealt.repartition(n_buckets, "bucket").select("block", "head", "body").mapInArrow(count, "block long, head binary, sums binary")
    return summed.groupBy("block").applyInArrow(add, f"doc_id {kind.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
