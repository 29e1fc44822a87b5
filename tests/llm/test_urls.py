import re
import time

from pyspark.sql import functions as F

from tests.conftest import SF
from vigilake.llm import urls
from vigilake.llm.common import table
from vigilake.llm.queries import LISTED, LISTED_PAGES, URL_RULES, url_list

SCHEMA = "host string, path string, verdict string, is_rule boolean"
URLS = [
    "http://a.example.net/en/1", "http://example.net/en/", "http://example.net/en", "http://notexample.net/en/x?y", "https://EXAMPLE.COM/de/x#y", "https://m.example.com/de/", "http://x.org/fr/?q=/de/", "http://org/fr/", "http://x.org", "x.net/",
    "http://net", "http://net/", "http://", "", None, "ftp://a.b://c.net/", "http://example.net:80/en/", "http://free-bets.example.com/x", "http://m.free-bets.example.com/", "http://free-bets.example.com", "http://..net/", "http://x.net?/en/", "http://é.net/é", "https://M.ththst.example.com/en/77.html?x", "https://ththst.example.com/en/77.html", "https://tionble.example.org/en/077.html", "https://tionble.example.org/en/9999.htmlx", "https://tionble.example.org/en/10000.html", "https://x.www.ththor.example.com/en/0.html",
]


def brute(url):
    m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = lambda h, p: (host == h or host.endswith("." + h)) and path.startswith(p)
    rules = sorted(((len(h + p), h + p, v) for h, p, v in URL_RULES if fits(h, p)), reverse=True)
    bad = any(fits(x.lower().split("/")[2], "/") for x in LISTED) or any(fits(h, "") for h in LISTED_PAGES) and re.match(r"/en/(0|[1-9][0-9]{0,3})\.html", path)
    verdict = rules[0][2] if rules else "block" if bad else "allow"
    return url, host, path, rules[0][1] if rules else None, verdict


def pages(spark, us):
    return spark.createDataFrame([(i, u, "clash", "clash", 0) for i, u in us], "page_id long, url string, host string, rule string, block int")


def test_same_as_brute_force(spark):
    given = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0])] * 2 + [(None, URLS[3]), (None, None)]
    got = urls.url_filter(pages(spark, given), url_list(spark)).collect()
    assert sorted(map(str, ((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in got))) == sorted(str((i, *brute(u))) for i, u in given)


def test_shuffled_paths(spark, monkeypatch):
    want = sorted(map(str, urls.url_filter(pages(spark, list(enumerate(URLS))), url_list(spark)).collect()))
    monkeypatch.setattr(urls, "MAX_BROADCAST_BLOCKS", -1)
    monkeypatch.setattr(urls, "MAX_BROADCAST_KEYS", -1)
    assert sorted(map(str, urls.url_filter(pages(spark, list(enumerate(URLS))), url_list(spark)).collect())) == want


def test_bloom_filter(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 5000 * urls.BITS_PER_KEY // 512 + 1
    bloom = urls.bloom_filter(keys, blocks)
    tried = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"), "id").withColumn("block", urls._block(F.col("key"), blocks))
    ok = F.lit(True)
    for i in range(urls.LANES):
        ok = ok & (F.call_function("shiftrightunsigned", F.col(f"w{i}"), urls._lane_bit(F.col("key"), i)).bitwiseAND(1) == 1)
    passed = tried.join(bloom, "block").filter(ok)
    assert passed.filter("id < 5000").count() == 5000
    assert passed.filter("id >= 5000").count() < 150


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert {r.verdict for r in urls.url_filter(pages(spark, list(enumerate(URLS))), none).collect()} == {"allow"}
    assert urls.url_filter(pages(spark, []), url_list(spark)).count() == 0


def test_false_positives_are_removed(spark):
    """Pages of listed hosts, of which the list has one in ten: the filter has many blocks, passes every listed key and some others, and those are gone after the exact join."""
    some = spark.range(40_000).select("id", F.concat(F.lit("http://"), F.element_at(F.array(*map(F.lit, LISTED_PAGES)), (F.col("id") % 4 + 1).cast("int")), F.lit("/en/"), (F.col("id") % 10_000).cast("string"), F.when(F.col("id") % 10 == 0, ".html").otherwise(".h_ml")).alias("u"))
    parts = some.select("id", "u", urls.host_of(F.col("u")).alias("host"), urls.path_of(F.col("u")).alias("path"))
    keys = urls.listed_keys(url_list(spark)).cache()
    assert keys.count() * urls.BITS_PER_KEY // 512 > 1000
    listed = {r.key for r in keys.collect()}
    for bits in (urls.BITS_PER_KEY, 3):
        passed = [r.key for r in urls.passing(parts, keys, bits).collect()]
        hits = sum(k in listed for k in passed)
        assert hits >= 4000 and (len(passed) > 1.2 * hits if bits == 3 else len(passed) < 1.1 * hits)
    every = table(spark, SF.replace("0.001", "0.1"), "pages").select("page_id", "url").unionByName(some.select(F.col("id").alias("page_id"), F.col("u").alias("url")).filter("id % 40 = 0").withColumn("page_id", F.col("page_id") + 1_000_000))
    for bits in (urls.BITS_PER_KEY, 3):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_filter(every, url_list(spark), bits_per_key=bits).collect()}
        assert got == {r.page_id: brute(r.url)[1:] for r in every.collect()}


def test_list_of_ten_thousand_lengths(spark):
    """Paths of every length up to 10,000: the plan and the candidates of a page do not grow with them."""
    listed = spark.range(10_000).select(F.lit("deep.example.com").alias("host"), F.concat(F.lit("/"), F.expr("repeat(char(97 + id % 26), CAST(id AS INT))")).alias("path"), F.lit("block").alias("verdict"), F.lit(False).alias("is_rule"))
    shown = [(i, f"http://{'x.' if i % 2 else ''}{'deep' if i % 3 else 'shallow'}.example.com/" + chr(97 + (i * 7) % 26) * (i * 7 % 400)) for i in range(1, 251)]
    shown += [(1000, "http://deep.example.com/" + "b" * 9_984), (1001, "http://deep.example.com/" + "c" * 3), (1002, "http://deep.example.com/" + "c" * 2), (1003, "http://deep.example.comx/")]
    deep = spark.createDataFrame([(0, "http://deep.example.com")], "page_id long, url string")
    urls.url_filter(deep, listed).collect()  # warm-up
    start = time.time()
    without_root = listed.filter("length(path) > 1")
    got = {r.page_id: r.verdict for r in urls.url_filter(pages(spark, shown), without_root).collect()}
    assert time.time() - start < 15

    def verdict(url):
        rest = url.removeprefix("http://")
        host, _, path = rest.partition("/")
        fits = ("." + host).endswith(".deep.example.com") and any(("/" + path).startswith("/" + chr(97 + n % 26) * n) for n in range(1, len(path) + 1))
        return "block" if fits else "allow"

    assert got == {i: verdict(u) for i, u in shown} and set(got.values()) == {"allow", "block"}


def test_long_urls(spark):
    long = ["http://" + "a." * 500_000 + "spam-farm.example.org/" + "x/" * 100_000, "http://" + "net." * 300_000, "http://net/" + "y" * 1_000_000]
    start = time.time()
    got = {r.page_id: r.verdict for r in urls.url_filter(pages(spark, list(enumerate(long))), url_list(spark)).collect()}
    assert got == {0: "block", 1: "allow", 2: "block"} and time.time() - start < 30


def test_canonical(spark):
    raw = spark.createDataFrame([("HTTPS://A.Example.COM/B?c#d", 1), ("no url", 2), (None, 3), ("x://", 4)], "url string, n int")
    assert [tuple(r) for r in urls.canonical(raw).select("host", "path", "n").collect()] == [("a.example.com", "/B", 1)]
