"""The permutations of operators 5 and 8, recomputed row by row from the keys of records."""

import math
import struct
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tests.conftest import SF
from vigilake.llm import mixing, queries, sharding
from vigilake.llm.common import number_ties, table


def spark_hash(first: int, *values: tuple[str, int]) -> int:
    """Spark's xxhash64 of an int and of values with their struct formats, signed."""
    h = xxh64_intdigest(struct.pack("<i", first), seed=42)
    for kind, v in values:
        h = xxh64_intdigest(struct.pack(f"<{kind}", v), seed=h)
    return h - (1 << 64) if h >> 63 else h


def test_op5(spark):
    docs = table(spark, SF, "documents").withColumn("size", F.expr("cast(coalesce(octet_length(text), 0) as bigint) + 16"))
    rows = number_ties(docs, more_than=sharding.TIED).collect()
    buckets = max(40, -(-sum(r["size"] for r in rows) // sharding.BUCKET_BYTES))
    held = defaultdict(list)
    for r in rows:
        held[spark_hash(5, ("q", r["__key"]), ("q", r["__nth"])) % buckets].append((r["__key"], r["__nth"], r.doc_id))
    order = []
    for bucket in sorted(held):
        own = sorted(held[bucket])
        place = list(range(len(own)))
        rng = np.random.Generator(np.random.PCG64(5 * 1_000_003 + bucket))
        drawn = rng.integers(0, np.arange(len(own), 1, -1)) if len(own) > 1 else []
        for at, other in zip(range(len(own) - 1, 0, -1), drawn):
            place[at], place[other] = place[other], place[at]
        order += [doc for _, doc in sorted(zip(place, (o[2] for o in own)))]
    n, want = len(order), {}
    for shard in range(40):
        own = order[-(-shard * n // 40) : -(-(shard + 1) * n // 40)]
        want |= {doc: (shard, slot) for slot, doc in enumerate(own)}
    assert {r.doc_id: (r.shard, r.slot) for r in queries.op5_sharding(spark, SF).collect()} == want


def test_mix(spark):
    """Which copies a plan has, in which block and slot, for a mix of several blocks in which some sources are repeated."""
    counted = mixing.countable(table(spark, SF, "documents"))
    mix = mixing.solve_mix(counted, max_repeats=4.0)
    plan = mixing.realise(counted, mix, block_tokens=20_000)
    sources = {r.source: (r.tokens, r.epochs) for r in mix.sources.collect()}
    blocks, want = math.ceil(mix.budget / 20_000), []
    rows = counted.collect()
    for source, (tokens, epochs) in sources.items():
        for epoch in range(math.ceil(epochs)):
            before = 0
            for place, r in sorted(((spark_hash(8, ("i", epoch), ("q", r.key), ("q", r.nth)) % (1 << 64) >> 1, r) for r in rows if r.source == source), key=lambda x: x[0]):
                spent = epoch + (before / tokens if tokens else 0.0)
                before += r.n_tokens
                if spent < epochs:
                    block = min(math.floor(spent / epochs * blocks), blocks - 1)
                    want.append((block, spark_hash(9, ("q", r.key), ("q", r.nth), ("i", epoch)), r.doc_id, epoch))
    slots, seen = {}, defaultdict(int)
    for block, _, doc, epoch in sorted(want):
        slots[doc, epoch] = (block, seen[block])
        seen[block] += 1
    got = plan.collect()
    assert len(got) == len(want) and {(r.doc_id, r.epoch): (r.block, r.slot) for r in got} == slots
    assert len(seen) > 3 and max(e for _, e in slots) >= 1
