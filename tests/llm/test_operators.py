"""The other operators on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vigilake.llm import common, mixing, sharding, token_counts, token_files
from vigilake.llm.common import scratch_dir

SCHEMA = "doc_id long, text string, source string, shard string, n_tokens long, size int, count int"
EDGE = ["", None, " ", "\n\n", "  two  spaces \n and\ta tab ", "▁ sign", "É ß 中文 🙂 á", "<s></s><unk>", "A. a, B.b. <|endoftext|>", "word " * 30_000, "x" * 20_000, "\x00 \r\n\x0b"]
BPE, PIECES = str(public_tokenizers.path("word_bpe_49k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


def frame(spark, texts, source="s"):
    rows = [(i, t, source, "clash", len((t or "").split()), 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE).unionByName(frame(spark, EDGE).filter("doc_id > 8"))


def test_token_counts(spark, edge):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PIECES)
    want = Counter((r.doc_id, len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in edge.collect())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(edge, PIECES).collect()) == want
    assert token_counts.token_counts(edge.limit(0), PIECES).count() == 0


def test_token_files(spark, edge):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    manifest = token_files.write_tokens(edge, BPE, partitions=3)
    got = token_files.read_documents(manifest, edge.schema["doc_id"].dataType, scratch_dir(spark)).collect()
    n = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in edge.collect()}
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((r.doc_id, n[r.doc_id]) for r in edge.collect())
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == sorted(r.doc_id for r in got)
    assert token_files.read_documents(token_files.write_tokens(edge.limit(0), BPE), edge.schema["doc_id"].dataType, scratch_dir(spark)).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_files_have_the_ids_of_whole_texts(spark, edge, name):
    """A tokenizer whose pieces span white space encodes whole texts, one that drops it encodes words: by ids, with null and repeated doc_ids."""
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path(name))
    tokenizer = Tokenizer.from_file(path)
    assert token_files.Encoder(path).word_split == token_files.drops_space(tokenizer) == name.startswith("word")
    odd = edge.select("doc_id", "text").unionByName(spark.createDataFrame([(None, "no  id"), (None, None), (3, "again"), (-1, "first\n")], "doc_id long, text string"))
    got = token_files.read_documents(token_files.write_tokens(odd, path, partitions=3), odd.schema["doc_id"].dataType, scratch_dir(spark)).collect()
    ids = lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((r.doc_id, len(x := ids(r.text)), zlib.crc32(x.tobytes())) for r in odd.collect())
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_token_counts_refuse_pieces_that_span_words(spark, edge, tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    for piece in ("of▁the", "a\nb", "▁x▁"):
        model = pb.ModelProto()
        model.ParseFromString(open(PIECES, "rb").read())
        model.pieces[500].piece = piece
        changed = tmp_path / "changed.model"
        changed.write_bytes(model.SerializeToString())
        assert token_counts.spanning_pieces(str(changed)) == [piece]
        with pytest.raises(ValueError, match="span"):
            token_counts.token_counts(edge, str(changed))
    assert token_counts.spanning_pieces(PIECES) == []


def test_token_counts_that_are_forgotten(spark, edge, monkeypatch):
    """A bucket that remembers three pre-tokens counts the same; null and repeated ids stay."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PIECES)
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    odd = edge.select("doc_id", "text").unionByName(spark.createDataFrame([(None, "no id here"), (None, "no id here"), (2, None)], "doc_id long, text string"))
    got = token_counts.token_counts(odd, PIECES, limit=5, buckets=2).collect()
    assert Counter((r.doc_id, r.n_tokens, r.over_limit) for r in got) == Counter((r.doc_id, n := len(sp.encode(r.text or "")), n > 5) for r in odd.collect())


def lawful(rows, shards):
    """Shards' counts are one apart at most, slots without gaps."""
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
    return max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and all(x == list(range(len(x))) for x in slots.values())


def test_shards(spark, edge, tmp_path, monkeypatch):
    rows = sharding.shard(edge, shards=5, bucket_bytes=1 << 16).collect()
    assert len(rows) == edge.count() and lawful(rows, 5)
    assert sharding.shard_and_read(edge.limit(0)).count() == 0
    # What is written: every column, consecutive slots in each file, in order, whatever the partitions of the input.
    monkeypatch.setattr(sharding, "PART_BUCKETS", 2)
    read = sharding.write_shards(sharding.shard(edge.repartition(3), shards=5, bucket_bytes=1 << 16), str(tmp_path / "out"))
    plain = lambda rows: sorted(str(sorted((k, v) for k, v in r.asDict().items() if k != "part")) for r in rows)
    assert plain(read.collect()) == plain(rows)
    files = list((tmp_path / "out").glob("shard=*/part=*/*.parquet"))
    assert len({f.parent for f in files}) == len(files) > 5
    for f in files:
        slots = pq.read_table(f, partitioning=None).column("slot").to_pylist()
        assert slots == list(range(slots[0], slots[0] + len(slots)))


def test_shards_of_ties(spark):
    """A million equal rows without an id, among others, are spread over buckets."""
    same = spark.range(1_000_000).selectExpr("cast(null as long) AS doc_id", "'same' AS text", "map('k', 1) AS more")
    rows = same.unionByName(spark.range(1000).selectExpr("if(id < 500, null, id) AS doc_id", "cast(id as string) AS text", "map('k', 1) AS more"))
    out = sharding.shard(rows, shards=4, bucket_bytes=1 << 20)
    in_shards = out.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("top"), F.countDistinct("slot").alias("slots"), F.sum((F.col("text") == "same").cast("int")).alias("same")).collect()
    assert {r.n for r in in_shards} == {250_250} and all(r.top == 250_249 and r.slots == 250_250 and r.same > 200_000 for r in in_shards)
    largest = common.number_ties(rows, more_than=sharding.TIED).groupBy(F.pmod(F.xxhash64("__key", "__nth"), F.lit(20))).count().agg(F.max("count")).first()[0]
    assert largest < 60_000


def test_number_ties(spark, monkeypatch):
    monkeypatch.setattr(common, "BLOCK", 3)
    rows = spark.createDataFrame([(None, "a", {"x": 1, "y": 2})] * 8 + [(1, None, None)] * 2 + [(1, "b", {})], "doc_id long, text string, n map<string,int>")
    got = common.number_ties(rows)
    assert got.columns == [*rows.columns, "__key", "__nth"]
    assert sorted((str(r.doc_id), str(r.text), str(r.n), r["__nth"]) for r in got.collect()) == sorted([("None", "a", "{'x': 1, 'y': 2}", i) for i in range(8)] + [("1", "None", "None", i) for i in range(2)] + [("1", "b", "{}", 0)])
    assert {r["__nth"] for r in common.number_ties(rows, more_than=8).collect()} == {0}


def test_permutation():
    assert sorted(sharding.fisher_yates(1000, 3)) == list(range(1000))
    first = Counter(int(sharding.fisher_yates(5, s)[0]) for s in range(2000))
    assert max(abs(v - 400) for v in first.values()) < 90
    assert len(sharding.fisher_yates(0, 1)) == 0 and list(sharding.fisher_yates(1, 1)) == [0]


def test_mix_weights(spark):
    docs = frame(spark, ["a b c d e f g h"] * 60, "big").unionByName(frame(spark, ["a b c d"] * 8, "small").withColumn("doc_id", F.col("doc_id") + 100)).unionByName(frame(spark, [None], None).withColumn("doc_id", F.lit(999)))
    counted = mixing.countable(docs)
    mix = mixing.solve_mix(counted, max_repeats=4.0)
    by = {r.source: r for r in mix.sources.collect()}
    assert by["big"].epochs == pytest.approx(1) and by["small"].epochs == pytest.approx(4, rel=1e-6)
    assert sum(r.weight for r in by.values()) == pytest.approx(1)
    plan = mixing.realise(counted, mix).collect()
    assert {r.doc_id for r in plan} == {r.doc_id for r in docs.collect()}
    small = sum(r.n_tokens for r in plan if r.source == "small")
    assert abs(small - 4 * by["small"].tokens) <= 4
    applied = mixing.apply_mix(docs, mix, mixing.realise(counted, mix))
    assert Counter(r.doc_id for r in applied.collect()) == Counter(r.doc_id for r in plan)
    assert applied.columns == docs.columns


def test_mix_of_ties(spark):
    """Equal rows, null ids and one id for all: a source's tokens are within one document of its budget."""
    texts = ["a b c d e f g h i j"] * 50
    docs = frame(spark, texts, "same").withColumn("doc_id", F.lit(5).cast("long")).unionByName(frame(spark, texts, "null").withColumn("doc_id", F.lit(None).cast("long"))).unionByName(frame(spark, [f"{i} b c" for i in range(90)], "one id").withColumn("doc_id", F.lit(7).cast("long"))).withColumnRenamed("count", "epoch")
    counted = mixing.countable(docs)
    mix = mixing.solve_mix(counted, budget=777)
    plan = mixing.realise(counted, mix)
    got, want = Counter(), {r.source: r.weight * 777 for r in mix.sources.collect()}
    for r in plan.collect():
        got[r.source] += r.n_tokens
    assert all(0 <= got[s] - want[s] < 10 for s in want)
    applied = mixing.apply_mix(docs, mix, plan)
    assert Counter(r.source for r in applied.collect()) == Counter(r.source for r in plan.collect()) and applied.columns == docs.columns


def test_mix_entropy(spark):
    docs = frame(spark, ["a b c"] * 50, "x").unionByName(frame(spark, ["a b c"] * 5, "y"))
    mix = mixing.solve_mix(docs, target_entropy=0.6)
    w = np.array([r.weight for r in mix.sources.collect()])
    assert -(w * np.log(w)).sum() == pytest.approx(0.6, abs=1e-3)
    empty = mixing.solve_mix(docs.limit(0), max_repeats=2.0)
    assert mixing.realise(mixing.countable(docs.limit(0)), empty).count() == 0


def test_encoder_equals_the_tokenizer_on_whole_texts():
    e = token_files.Encoder(BPE)
    assert e.folds
    texts = [
        "<|endoftext|> a<|startoftext|>b", "É é É́ x́", "İstanbul ΑΣ ΣΑΣ. don't DON'T it's's", "a\tb\r\nc\x0bd", "", "  ", "ab½ 12.5% naïve—x", "ÿÿ×÷ª", "ſ K Å fi ’s",
        "a'Sb ab's, x.'s", " x   y", "a\x00b .. ,a", "Word wORD word. WORD!? word$$$ straße STRASSE ẞ", "é ́e .́",
    ]
    want = e._ids(texts)
    for _ in range(2):  # new words, then known ones
        ids, sizes = e.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
