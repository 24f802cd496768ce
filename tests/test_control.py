from __future__ import annotations

import html
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from cairn.functions import answers, text
from cairn.operators import adapters, control, gates
from cairn.sources import sinks
from cairn.streaming import streams


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


BING = html.escape(json.dumps({"murl": " https://x.org/a.jpg ", "purl": "https://x.org", "mw": 10, "mh": "20", "t": "T"}))
PIXIV = {"id": "1", "url": "https://i/c/250x250_80_a2/img-master/p/1_p0_square1200.jpg", "illustType": 0, "xRestrict": 0, "width": 3, "height": 4, "userName": "u"}
PAYLOADS = {
    "bing_images": (f'<a m="{BING}" ><a m="{BING}" ><a m="{{broken}}" >', [["https://x.org/a.jpg"]]),
    "yandex_images": (html.escape('{"url":"https://y.org/b.jpg","fileSizeInBytes":55,"w":3,"h":4}'), [["https://y.org/b.jpg"]]),
    "mal": ('<a href="https://myanimelist.net/character/12/Foo_Bar">x</a>\n<img data-src="https://cdn/r/42x62/images/1.jpg">', [["https://cdn/images/1.jpg"]]),
    "pixiv": (
        json.dumps({"body": {"illustManga": {"data": [PIXIV, PIXIV | {"xRestrict": 1}, PIXIV | {"illustType": 2}]}}}),
        [["https://i/img-original/p/1_p0.jpg", "https://i/img-original/p/1_p0.png", "https://i/img-master/p/1_p0_master1200.jpg"], ["https://i/img-master/p/1_p0_master1200.jpg"]],
    ),
    "deviantart": ('<item><title>A &amp; B</title><media:content url="https://w/1.jpg" height="5" width="6" medium="image"/></item><item></item>', [["https://w/1.jpg"]]),
    "huaban_api": (json.dumps({"pins": [], "data": [{"file": {"key": "abc", "width": 9}}, {"file": {}}, {"file": {"key": "abc"}}]}), [["https://hbimg.huaban.com/abc"]]),
    "toutiao": ('"https://q.org/pic.png" http://p.byteimg.com/x1.jpg https://q.toutiaoimg.com/y.jpg https://q.org/logo.png', [["https://p.byteimg.com/x1.jpg"], ["https://q.org/pic.png"]]),
    "so360": (json.dumps({"list": [{"imgurl": "https://a/1", "thumb": "https://a/t"}, {"imgurl": "https://a/1", "thumb": "https://a/t2"}, {"imgurl": "https://a/1"}]}), [["https://a/1", "https://a/t"], ["https://a/t2"]]),
    "anilist": (json.dumps({"data": {"Character": {"id": 1, "name": {"full": "N"}, "image": {"large": "https://l"}}}}), [["https://l"]]),
    "baidu": (json.dumps({"data": [{"middleURL": "", "thumbURL": "https://b/m?w=500&h=889", "width": "1"}, {}]}), [["https://b/m?w=500&h=889"]]),
    "wikimedia": (json.dumps({"query": {"pages": {"9": {"index": 2, "pageid": 9, "imageinfo": [{"url": "https://u/b"}]}, "8": {"index": 1, "pageid": 8, "imageinfo": [{"url": "https://u/a"}]}}}}), [["https://u/a"], ["https://u/b"]]),
}


def test_adapters(spark):
    rows = [(s, p) for s, (p, _) in PAYLOADS.items()] + [("unknown", "x"), ("baidu", None), ("so360", "<html>"), ("anilist", '{"data":{"Character":null}}')]
    got = adapters.candidates(spark.createDataFrame(rows, "source string, payload string"), 5).collect()
    for source, (_, want) in PAYLOADS.items():
        assert [r.tiers for r in sorted(got, key=lambda r: r.position) if r.source == source] == want, source
    assert len(got) == sum(len(w) for _, w in PAYLOADS.values())
    bing = next(r for r in got if r.source == "bing_images")
    assert (bing.landing, bing.width, bing.height) == ("https://x.org", 10, 20)
    assert next((r.width, r.height) for r in got if r.source == "baidu") == (500, 889)


def test_adapters_cap_and_fail(spark):
    many = json.dumps({"list": [{"imgurl": f"https://a/{i}"} for i in range(20)]})
    df = spark.createDataFrame([("so360", many), ("so360", "<html>"), ("baidu", '{"antiFlag":1,"data":[]}'), ("pixiv", '{"error":true}')], "source string, payload string")
    assert [r.position for r in adapters.candidates(df, 50).collect()] == list(range(5))
    assert adapters.candidates(df, 2).count() == 2
    assert [r.failure for r in adapters.failures(df).collect()] == [None, "transient", "deterministic", "transient"]


def test_image_urls_drop_noise_and_repeats(spark):
    urls = F.array(*map(F.lit, ["http://a.org/1.png", "https://a.org/icon.png", "https://hint.org/2.JPG?x=1", "https://a.org/1.png", "https://a.org/page.html"]))
    assert one(spark, gates.image_urls(urls, ("hint.org",), ("png", "jpg"), ("icon",)))[0] == ["https://hint.org/2.JPG?x=1", "https://a.org/1.png"]


def test_choices(spark):
    pick = control.judged(F.col("p"), F.array(F.lit("Great Wall"), F.lit("Wall")))
    got = spark.createDataFrame([("great wall",), ("Tower",), (None,)], "p string").select(pick).collect()
    assert [r[0] for r in got] == ["accepted", "failed", "rejected"]
    plan = control.planned_sources(F.col("s"), ("a", "b"), ("z",))
    assert [r[0] for r in spark.createDataFrame([(["b", "x", "b", "a"],), (["x"],), (None,)], "s array<string>").select(plan).collect()] == [["b", "a"], ["z"], ["z"]]
    share = one(spark, control.rate_share(F.lit(1.0), F.lit(8), F.lit(20)))[0]
    assert (share.rate, share.concurrency) == (0.1, 1)
    assert one(spark, control.branch_of(F.lit("root/a/b/c/d")))[0] == "root/a/b"


def test_seeded_order_is_a_permutation(spark):
    df = spark.range(200)
    a = {r.id: r.r for r in control.seeded_order(df, "id", 7, "r").collect()}
    b = {r.id: r.r for r in control.seeded_order(df.repartition(5), "id", 7, "r").collect()}
    assert a == b and sorted(a.values()) == list(range(200))
    assert a != {r.id: r.r for r in control.seeded_order(df, "id", 8, "r").collect()}


def test_retry_stops_when_covered(spark):
    wanted, held = spark.createDataFrame([("a", 2), ("b", 1)], "name string, quota int"), {"a": 0, "b": 0}

    def collect(short):
        for r in short.collect():
            held[r.name] += 1

    coverage = lambda: spark.createDataFrame(list(held.items()), "name string, n int")
    assert control.retry_until_covered(collect, coverage, wanted, 5) == 2 and held == {"a": 2, "b": 1}
    assert control.retry_until_covered(collect, coverage, spark.createDataFrame([("a", 99)], "name string, quota int"), 1) == 1


def test_cleanup_order_and_age(spark):
    blobs = spark.sql("SELECT * FROM VALUES ('b', timestamp'2024-01-01', true, false), ('a', timestamp'2024-01-01', true, false), ('c', timestamp'2024-01-03', true, false), ('d', timestamp'2024-01-01', true, true) t(sha256, published_at, verified, deleted)")
    now = F.lit("2024-01-03 12:00:00").cast("timestamp")
    assert [r.sha256 for r in control.cleanup_eligible(blobs, now, 5).collect()] == ["a", "b"]


def test_memory_breach(spark):
    df = spark.createDataFrame([(130, 100, 900.0), (110, 100, 900.0), (1, 100, 400.0), (None, 0, None)], "c int, t int, f double")
    assert [r[0] for r in df.select(streams.memory_breach(F.col("c"), F.col("t"), F.col("f"))).collect()] == [True, False, True, False]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "ledger")
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), ("b", 4, None), ("c", 5, "w")], "k string, pos int, blob string")
    for _ in range(2):
        sinks.append_manifest(df, path, ["k"], ["pos"], required=("blob",))
        assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("a", 1, "x"), ("c", 5, "w")}
    sinks.replace_table(spark.read.parquet(path).where("k = 'c'"), path)
    assert [r.k for r in spark.read.parquet(path).collect()] == ["c"]
    (tmp_path / "ledger").rename(tmp_path / "ledger.old")  # as a break between the two renames leaves it
    sinks.recover_table(spark, path)
    sinks.recover_table(spark, path)
    assert [r.k for r in spark.read.parquet(path).collect()] == ["c"] and not (tmp_path / "ledger.old").exists()
    done, dead = str(tmp_path / "done"), str(tmp_path / "dead")
    for _ in range(2):
        sinks.append_outcomes(spark.createDataFrame([(1, "done"), (2, "capped"), (3, "skip")], "s int, outcome string"), "outcome", done, dead, ["s"], ["s"])
    assert [tuple(r) for r in spark.read.parquet(done).collect()] == [(1,)]
    assert [tuple(r) for r in spark.read.parquet(dead).collect()] == [(2, "capped")]
    pairs = spark.createDataFrame([("f", "Q1:normal,Q2:preferred"), ("g", None)], "fname string, pairs string")
    assert [tuple(r) for r in sinks.split_pairs(pairs, "pairs").collect()] == [("f", "Q1", "normal"), ("f", "Q2", "preferred")]


@pytest.mark.parametrize(("query", "want"), [("avg 1 2 6", 3.0), ("range 4 1", 3.0), ("prod 2 3 4", 24.0), ("min", None), ("max 1 x", None), ("", None), ("sum 1,000 1", 1001.0)])
def test_statistics(spark, query, want):
    assert one(spark, answers.statistic(F.lit(query)))[0] == want


def test_random_values(spark):
    shapes = {"string": r"[a-zA-Z0-9]{20}", "int": r"-?\d+", "float": r"[\d.E-]+", "sha256": r"[0-9a-f]{64}", "uuid": r"[0-9a-f-]{36}", "color": r"#[0-9A-F]{6}"}
    for word, shape in shapes.items():
        assert re.fullmatch(shape, one(spark, answers.random_value(F.lit(f"random {word}")))[0])
    assert one(spark, answers.random_value(F.lit("random thing")))[0] is None


def test_units_and_times(spark):
    units = spark.createDataFrame([("C", "kelvin", 1.0, 273.15, 0), ("F", "kelvin", 5 / 9, 459.67 * 5 / 9, 1), ("C", "coulomb", 1.0, 0.0, 2)], "symbol string, quantity string, factor double, shift double, position int")
    asked = spark.createDataFrame([(1, "100 C in F"), (2, "1e2 C to F"), (3, "5 C in mi"), (4, "words"), (5, "-40C in F")], "id int, q string")
    got = {r.id: round(r.value, 6) for r in answers.convert_units(asked, "id", "q", units).collect()}
    assert got == {1: 212.0, 2: 212.0, 5: -40.0}


def test_clocks_and_sizes(spark):
    df = spark.createDataFrame([("1:02:03",), ("02:03",), ("7",), ("a:b",)], "c string")
    assert [r[0] for r in df.select(text.seconds_of(F.col("c"))).collect()] == [3723, 123, None, None]
    sizes = spark.createDataFrame([(1,), (1024,), (1152,), (5 << 20,)], "n long").select(text.human_bytes(F.col("n")))
    assert [r[0] for r in sizes.collect()] == ["1.00 B ", "1024.00 B ", "1.12 KB", "5.00 MB"]
    assert one(spark, text.clock_of(F.lit(3723)), text.clock_of(F.lit(61)))[:] == ("01:02:03", "01:01")
