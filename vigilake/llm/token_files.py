"""Token-ID output (operator 4): Arrow IPC files of fixed-size lists.

A file holds the ids of its documents as one stream, cut into sequences of SEQUENCE ids: column `ids`
(fixed-size list of uint16, or uint32 for large vocabularies) and column `mask` (fixed-size list of bool;
false where the last sequence is filled up). Batches hold BATCH sequences each, uncompressed and all of one
size, so place k of the stream is in batch k // (BATCH * SEQUENCE) and is read without a copy. Beside each file
stands an index, `.docs.arrow`: doc_id, start (in this file) and n_tokens of its documents in order.

Documents are dealt by ranges of doc_id and sorted before they are encoded, so each task writes one file in one
pass. A task writes under a name of its own attempt and then renames; the manifest takes the files of the
attempts that counted, so lost executors leave nothing wrong behind.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigilake.llm.common import materialize, number_ties, scratch_path

SEQUENCE, BATCH = 2048, 256
END_ID = 1
#: Pieces of text that the encoder keeps, per Python worker.
CACHE_PIECES = 600_000
#: Texts whose ids are those of their words in a row, if no token spans white space.
SPLITS = ("the end of the day", "  two  spaces and one at the end ", "a line\nand\n\nanother", "x = 1 , y ( 2 ) .", "don't stop - it's 50 % off", "É è ñ ü 中 文 🙂 a", "A b C\n d", " \n ")
#: Equal rows that may share a range of ids.
TIED = 1000
#: Runs of letters that are encoded as one text.
JOIN = 64
#: Bytes of text that are encoded at a time, besides the last document.
SLICE_BYTES = 8 << 20
#: A plain word: letters that are one pre-token in every spelling of A-Z, composed already, and signs after them that are another.
PLAIN = r"\A(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<signs>[!\"#$%&()*+,./:;<=>?@^_{|}~-]*)\z"


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of `flat` that begin at `starts` and are `sizes` long, one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


#: White space as byte-level vocabularies spell it, and as others do.
SPACES = frozenset(" \t\n\r\x0b\x0c▁ĠĉĊčċČ")


def drops_space(tokenizer) -> bool:
    """Whether a text's ids are those of its words in a row: no piece of the vocabulary spans white space, which has no ids itself."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
    known = tokenizer.get_vocab(with_added_tokens=True)
    if any(SPACES.intersection(piece) and len(piece.removesuffix(suffix)) > 1 for piece in known):
        return False
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    return not any(ids(c) or ids(f"a{c}b") != ids("a") + ids("b") or ids(f"{c}{c}1{c}") != ids("1") for c in " \t\n\r\x0b\x0c")


class Encoder:
    """Encodes texts with the tokenizers library, each distinct word once.

    For tokenizers whose pre-tokenizer drops white space, no token spans a space or a line end, so a text's ids
    are those of its words in a row; for others whole texts are encoded. Its vocabulary says which it is (drops_space()). Where, besides, case
    says nothing and the last token of a pre-token is known by its suffix, plain words are taken as letters and signs,
    and new letters are encoded many at a time, in lower case, and their ids cut apart at those tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.word_split = drops_space(self.tokenizer) and all(sum(self._ids(t.replace("\n", " ").split(" ")), []) == self._ids([t])[0] for t in SPLITS)
        self._forget()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.folds = False
        if self.word_split and suffix:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if piece.endswith(suffix)]] = True
            probe = ["Ab", "ÉÀß", "ÿ", "zzzzqqqxj"]
            flat, sizes = self._letters([w.lower() for w in probe])
            own = [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
            self.folds = self._ids([f"{w}.%" for w in probe]) == [x + self._ids([".%"])[0] for x in own]

    def _forget(self) -> None:
        """known: the place of each piece of text; its ids are size[place] of flat from start[place] on. Place 0: no ids."""
        self.known, self.flat, self.start, self.size = {"": 0}, np.empty(0, self.dtype), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        ids = self._ids(texts)
        return np.fromiter(chain.from_iterable(ids), self.dtype), np.fromiter(map(len, ids), np.int64, len(ids))

    def _letters(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs of letters in lower case."""
        flat, _ = self._each([" ".join(runs[i : i + JOIN]) for i in range(0, len(runs), JOIN)])
        ends = np.flatnonzero(self.ends[flat]) + 1
        return (flat, np.diff(ends, prepend=0)) if len(ends) == len(runs) else self._each(runs)  # not as supposed: one by one

    def _places(self, pieces: pa.Array, encode: Callable) -> np.ndarray:
        """The place of each piece; new ones are encoded."""
        distinct = pieces.dictionary_encode()
        found = distinct.dictionary.to_pylist()
        if new := [x for x in found if x not in self.known]:
            flat, sizes = encode(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(sizes) - sizes))
            self.flat, self.size = np.concatenate((self.flat, flat)), np.concatenate((self.size, sizes))
        return np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))[distinct.indices.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (not null) in a row, and how many each has."""
        if not self.word_split:
            return self._each(texts.to_pylist())
        if len(self.known) > CACHE_PIECES:
            self._forget()
        found = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = found.flatten().dictionary_encode()
        word, of = words.dictionary, words.indices.to_numpy()
        first, second = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        odd = np.ones(len(word), bool)
        if self.folds:
            plain = pc.extract_regex(word, PLAIN)
            odd = plain.is_null().to_numpy(zero_copy_only=False)
            plain = plain.drop_null()
            first[~odd] = self._places(pc.utf8_lower(pc.struct_field(plain, "letters")), self._letters)
            second[~odd] = self._places(pc.struct_field(plain, "signs"), self._each)
        first[odd] = self._places(word.filter(pa.array(odd)), self._each)
        place = np.column_stack((first[of], second[of])).ravel()
        sizes = self.size[place]
        counts = 2 * pc.list_value_length(found).to_numpy().astype(np.int64)
        upto = np.concatenate(([0], np.cumsum(sizes)))
        return _gather(self.flat, self.start[place], sizes), np.diff(upto[np.concatenate(([0], np.cumsum(counts)))])


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """From and to: runs of texts of SLICE_BYTES at most, besides their last text."""
    block = (np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) - 1) // SLICE_BYTES
    edges = np.unique(np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(texts)]))).tolist()
    yield from zip(edges, edges[1:])


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """The encoder of this Python worker; later tasks find what earlier ones encoded."""
    return Encoder(path)


class Writer:
    """Writes one file and its index."""

    def __init__(self, fs: pafs.FileSystem, path: str, id_type: pa.DataType, dtype: np.dtype):
        self.dtype, self.ids, self.docs, self.total = dtype, pa.from_numpy_dtype(dtype), [], 0
        self.schema = pa.schema([("ids", pa.list_(self.ids, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))])
        self.index = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.outs = [fs.open_output_stream(path), fs.open_output_stream(f"{path}.docs")]
        self.file, self.list = pa.ipc.new_file(self.outs[0], self.schema), pa.ipc.new_file(self.outs[1], self.index)
        self.rest: list[np.ndarray] = [np.empty(0, dtype)]
        self.held = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        """ids: those of all these documents in a row; sizes: how many each has."""
        starts = self.total + np.cumsum(sizes) - sizes
        self.list.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(sizes)], schema=self.index))
        self.total += len(ids)
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= BATCH * SEQUENCE:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.rest)
        step = BATCH * SEQUENCE
        end = len(flat) if last else len(flat) // step * step
        for i in range(0, end, step):
            own = flat[i : min(i + step, end)]
            fill = -len(own) % SEQUENCE
            mask = np.ones(len(own) + fill, bool)
            mask[len(own) :] = False
            own = np.concatenate((own, np.zeros(fill, self.dtype)))
            self.file.write_batch(pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(own), SEQUENCE), pa.FixedSizeListArray.from_arrays(pa.array(mask), SEQUENCE)], schema=self.schema))
        self.rest, self.held = [flat[end:].copy()], len(flat) - end

    def close(self) -> None:
        self._flush(True)
        for x in (self.file, self.list, *self.outs):
            x.close()


class TokenFile:
    """Random access to one file: read(start, n) gives ids without a copy where they lie in one batch."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.at, self.batch = -1, None

    def _part(self, k: int) -> tuple[np.ndarray, pa.Array]:
        if k != self.at:
            self.at, self.batch = k, self.reader.get_batch(k)
        return self.batch.column("ids").flatten().to_numpy(zero_copy_only=True), self.batch.column("mask")

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence k, SEQUENCE long."""
        ids, mask = self._part(k // BATCH)
        return ids[k % BATCH * SEQUENCE :][:SEQUENCE], mask[k % BATCH].values

    def read(self, start: int, n: int) -> Iterator[np.ndarray]:
        step = BATCH * SEQUENCE
        while n > 0:
            ids, _ = self._part(start // step)
            part = ids[start % step : start % step + n]
            yield part
            start, n = start + len(part), n - len(part)

    def tokens(self) -> int:
        """Ids that masks tell apart from what fills up."""
        last = self.reader.num_record_batches - 1
        return 0 if last < 0 else last * BATCH * SEQUENCE + self._part(last)[1].flatten().true_count


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Writes the files of all rows of docs, in ascending order of doc_id; gives the manifest: part (in order), file, n_docs, n_tokens, start.

    Null texts are empty: just the end id. A null id comes first; rows that repeat an id go by a hash of their text, and
    more than TIED equal ones by number, so ranges may part them. Other columns are left out. path: a folder that all executors share (default: the scratch folder)."""
    spark = docs.sparkSession
    fs, at = pafs.FileSystem.from_uri(path or scratch_path(spark, "tokens"))
    fs.create_dir(at)
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, writer, n_docs = TaskContext.get().partitionId(), None, 0
        name = f"{at}/part-{part:06d}"
        temp = f"{name}-{uuid.uuid4().hex}.part"
        encoder = shared_encoder(tokenizer)
        for b in batches:
            writer = writer or Writer(fs, temp, id_type, encoder.dtype)
            n_docs += b.num_rows
            texts = pc.fill_null(b.column(1), "")
            for i, j in _slices(texts):
                ids, sizes = encoder.encode(texts.slice(i, j - i))
                writer.add(b.column(0).slice(i, j - i), np.insert(ids, np.cumsum(sizes), end_id), sizes + 1)
        if writer is not None:
            writer.close()
            done = f"{temp.removesuffix('.part')}.arrow"
            fs.move(temp, done)
            fs.move(f"{temp}.docs", f"{done.removesuffix('.arrow')}.docs.arrow")
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([done]), pa.array([n_docs], pa.int64()), pa.array([writer.total], pa.int64())], ["part", "file", "n_docs", "n_tokens"])

    rows = number_ties(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), more_than=TIED)
    rows = rows.repartitionByRange(n, "doc_id", "__key", "__nth").sortWithinPartitions("doc_id", "__key", "__nth")
    manifest = materialize(rows.select("doc_id", "text").mapInArrow(run, "part int, file string, n_docs long, n_tokens long"), "manifest")
    starts, total = [], 0
    for r in manifest.orderBy("part").collect():  # a row for each file
        starts.append((r.part, r.file, r.n_docs, r.n_tokens, total))
        total += r.n_tokens
    return spark.createDataFrame(starts, "part int, file string, n_docs long, n_tokens long, start long")


def read_documents(manifest: DataFrame, id_type: object, uri: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files alone.

    ids_crc32: of the ids as little-endian unsigned 32-bit integers."""
    kind = id_type.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(uri)
        for b in batches:
            for file, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tokens = TokenFile(fs, file)
                with fs.open_input_file(f"{file.removesuffix('.arrow')}.docs.arrow") as source:
                    index, total = pa.ipc.open_file(source), 0
                    for k in range(index.num_record_batches):
                        d = index.get_batch(k)
                        crcs = []
                        for start, n in zip(d.column(1).to_pylist(), d.column(2).to_pylist()):
                            crc = 0
                            for part in tokens.read(start, n):
                                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                            crcs.append(crc)
                            total += n
                        yield pa.RecordBatch.from_arrays([d.column(0), pa.array(np.array(d.column(1)) + base), d.column(2), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                if total != tokens.tokens():
                    raise ValueError(f"{file}: the index has {total} ids, the masks {tokens.tokens()}")

    files = manifest.select("file", "start", "part")
    n = max(1, manifest.count())
    return files.repartitionByRange(n, "part").select("file", "start").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
