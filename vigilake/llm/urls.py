"""URL filters (operator 3): a blocked Bloom filter before an exact hash join; DataFrame functions only.

Listed canonical URLs are pairs of host and path; one fits its host and all subdomains, with every path that starts with its
own. A listed key's stem is its host with the first STEM characters of its path. Each page's url gives candidate stems: for
each number of labels that listed hosts have, that many of its own host's last labels, with none to STEM characters of its path;
how many there are does not grow with the list. Stems that are listed bring the lengths of their keys, which make the
page's candidate keys. Both times candidates first meet a Bloom filter: one block of 512 bits for each key, found by one
equi-join, with eight bits tested by shifts. What passes meets the stems, or the list itself, in an exact hash join, which
removes false positives. Only then do rows shuffle, combined before the shuffle to one row for each page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.llm.common import materialize

BITS_PER_KEY = 16
LANES = 8  # words of 64 bits in a block, with one bit of each key in each
#: Up to so many blocks (72 bytes a row) or listed keys, that side is broadcast; beyond, both sides shuffle.
MAX_BROADCAST_BLOCKS = 1 << 18
MAX_BROADCAST_KEYS = 1 << 17
#: Characters of a path in a stem.
STEM = 8


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, with A-Z lower-cased; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _lane_bit(key: Column, lane: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 6 * lane).bitwiseAND(63).cast("int")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """block, w0 to w7: one row for each block in which some key has set bits."""
    bits = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _lane_bit(F.col("key"), i))).alias(f"w{i}") for i in range(LANES)]
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*bits)


def canonical(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """urls with host and path in place of the URL, by the same rules as pages' URLs; those without a host are left out."""
    return urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))}).filter("host <> ''").drop(url_col)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."))) + 1


def _stems(shapes: list[tuple[int, int]]) -> Column:
    """stem and own (the part of the host) of each candidate of columns host, path and labels; shapes: numbers of labels and of characters of the path."""
    if not shapes:
        return F.array().cast("array<struct<stem:string,own:string>>")
    known = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("n")) for k, n in sorted(shapes)])
    fits = F.filter(known, lambda s: (F.col("host") != "") & (s["k"] <= F.col("labels")) & (s["n"] <= F.length("path")))
    own = F.transform(fits, lambda s: F.struct(F.call_function("substring_index", F.col("host"), F.lit("."), -s["k"]).alias("own"), s["n"].alias("n")))
    return F.transform(own, lambda s: F.struct(F.concat(s["own"], F.substring(F.col("path"), F.lit(1), s["n"])).alias("stem"), s["own"].alias("own")))


def listed_keys(listed: DataFrame) -> DataFrame:
    """key (host and path), rule_verdict, list_verdict, labels (of the host), n (length of the path): a row for each key; listed twice: block."""
    host, path = F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))
    keys = listed.select(F.concat(host, path).alias("key"), _labels(host).alias("labels"), F.length(path).alias("n"), host.alias("h"), "verdict", F.coalesce("is_rule", F.lit(False)).alias("is_rule")).filter("h <> ''")
    return keys.groupBy("key", "labels", "n").agg(F.max(F.when(F.col("is_rule"), F.col("verdict"))).alias("rule_verdict"), F.max(F.when(~F.col("is_rule"), F.col("verdict"))).alias("list_verdict"))


def stems_of(keys: DataFrame) -> DataFrame:
    """key (a stem), labels, n (characters of the path in it), lengths (of the paths of its keys), a row for each stem of listed_keys()."""
    host_len, n = F.length("key") - F.col("n"), F.least(F.col("n"), F.lit(STEM))
    return keys.groupBy(F.substring(F.col("key"), F.lit(1), host_len + n).alias("key"), "labels", n.alias("stem_n")).agg(F.sort_array(F.collect_set("n")).alias("lengths")).withColumnRenamed("stem_n", "n")


def through_filter(tried: DataFrame, keys: DataFrame, size: int, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """The rows of tried whose `key` the Bloom filter of the keys lets pass: all listed ones, and some others."""
    blocks = max(1, -(-size * bits_per_key // (64 * LANES)))
    bloom = bloom_filter(keys, blocks)
    bloom = F.broadcast(bloom) if blocks <= MAX_BROADCAST_BLOCKS else bloom
    set_bits = F.lit(True)
    for i in range(LANES):
        set_bits = set_bits & (F.call_function("shiftrightunsigned", F.col(f"w{i}"), _lane_bit(F.col("key"), i)).bitwiseAND(1) == 1)
    return tried.withColumn("block", _block(F.col("key"), blocks)).join(bloom, "block").filter(set_bits).drop("block", *[f"w{i}" for i in range(LANES)])


def _bounded(rows: DataFrame, size: int) -> DataFrame:
    return F.broadcast(rows) if size <= MAX_BROADCAST_KEYS else rows


def candidates(parts: DataFrame, stems: DataFrame, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """id, u, key, host_len: for parts (id, u, host, path) the keys that may be listed, by stems_of() the list."""
    shapes, size = [tuple(r) for r in stems.select("labels", "n").distinct().collect()], stems.count()  # STEM + 1 shapes for each number of labels
    tried = parts.withColumn("labels", _labels(F.col("host"))).select("id", "u", "path", F.inline(_stems(shapes))).withColumnRenamed("stem", "key")
    met = through_filter(tried, stems, size, bits_per_key).join(_bounded(stems.select("key", "lengths"), size), "key")
    fits = F.filter("lengths", lambda n: n <= F.length("path"))
    return met.select("id", "u", "own", "path", F.explode(fits).alias("n")).select("id", "u", F.concat("own", F.substring(F.col("path"), F.lit(1), F.col("n"))).alias("key"), F.length("own").alias("host_len"))


def passing(parts: DataFrame, keys: DataFrame, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """id, u, key, host_len: the candidates of parts that the Bloom filter of the keys lets pass."""
    return through_filter(candidates(parts, stems_of(keys), bits_per_key), keys, keys.count(), bits_per_key)


def url_filter(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """A row for each row of pages: id, url, host, path, rule, listed (boolean), verdict.

    listed: host, path, verdict ('allow' or 'block') and is_rule (boolean). The longest rule that fits decides
    (as long as another: the one with the longer host; listed twice: block); without a rule, a page is blocked
    if some listed URL with verdict block fits, else allowed. A url that is null or has no :// has no host and is
    allowed. Repeated pages give repeated rows; other columns are left out. An empty list allows all. The
    distinct numbers of labels of listed hosts, with up to STEM characters of path, are all the driver gets of the list."""
    keys = materialize(listed_keys(listed), "listed")
    stems, size = materialize(stems_of(keys), "stems"), keys.count()
    exact = _bounded(keys.select("key", "rule_verdict", "list_verdict"), size)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u"))
    parts = rows.select("id", "u", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    hits = through_filter(candidates(parts, stems, bits_per_key), keys, size, bits_per_key).join(exact, "key")
    best = F.when(F.col("rule_verdict").isNotNull(), F.struct(F.length("key").alias("n"), "host_len", F.col("rule_verdict").alias("verdict"), F.col("key").alias("rule")))
    found = hits.select("id", "u", best.alias("best"), (F.col("list_verdict") == "block").alias("listed"), F.lit(0).cast("long").alias("copies"))
    every = rows.select("id", "u", F.lit(None).cast(found.schema["best"].dataType).alias("best"), F.lit(None).cast("boolean").alias("listed"), F.lit(1).cast("long").alias("copies"))
    one = every.unionByName(found).groupBy("id", "u").agg(F.max("best").alias("best"), F.coalesce(F.bool_or("listed"), F.lit(False)).alias("listed"), F.sum("copies").alias("copies"))
    # A hit of a page that stands there several times was found each time; max() and bool_or() do not mind.
    verdict = F.coalesce(F.col("best.verdict"), F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return one.select(F.col("id").alias(id_col), F.col("u").alias(url_col), host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"), F.col("best.rule").alias("rule"), "listed", verdict.alias("verdict"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("__copy")).drop("__copy")
